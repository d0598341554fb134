"""Query plans: the library's operators applied to the driver tables.

Each plan module maps a reference dataset onto stand-ins derived from the
driver tables (``standins``) and registers (spark query, DuckDB oracle SQL)
pairs in ``registry``.
"""

from quarry.plans.registry import ORACLE, QUERIES, all_queries, all_oracles  # noqa: F401

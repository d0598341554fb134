"""quarry: business-analytics operators on Spark DataFrames.

Every public operator takes DataFrames plus column names and parameters and
returns a lazy DataFrame built from native Spark expressions (no Python UDFs,
no actions inside operators).  See README.md for the module map.
"""

__version__ = "0.1.0"

"""Customer state journeys: neighbours, transitions, mix as of a date, time to
a state, and the payment schedule they imply (analyses 3.0-3.12; survey ids
E1, E2, E7, E12, H24, D12).

All per-key orderings go through ``quarry.operators.ordered``: lag, lead and
row numbers come from one exchange on (key, day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.dates import as_date
from quarry.operators import ordered as O
from quarry.operators._util import cols, ratio


def with_neighbors(df: DataFrame, key, ts: str, state: str, tie=None, prev: bool = True, nxt: bool = True,
                   seq: str | None = "state_seq", granularity: str | None = "day") -> DataFrame:
    """Add prev_/next_ state and date plus the row's position (E1, E7), or
    those of them that are asked for.

    Skew-safe: computed per (key, day) and stitched across days
    (``quarry.operators.ordered``)."""
    return O.stitched(df, key, [ts] + cols(tie), prev=[state, ts] if prev else [], nxt=[state, ts] if nxt else [],
                      seq=seq, granularity=granularity)


def transition_counts(df: DataFrame, key, ts: str, state: str, tie=None,
                      start=None, end=None) -> DataFrame:
    """Count of (from, to) transitions whose *to* date is in [start, end]
    (3.10; LAG over ascending dates, ruling X8)."""
    x = (O.stitched(df.select(*cols(key), ts, state, *cols(tie)), key, [ts] + cols(tie), prev=[state])
         .where(F.col(f"prev_{state}").isNotNull()))
    if start is not None:
        x = x.where(F.col(ts) >= as_date(start))
    if end is not None:
        x = x.where(F.col(ts) <= as_date(end))
    return (x.groupBy(F.col(f"prev_{state}").alias(f"from_{state}"),
                      F.col(state).alias(f"to_{state}"))
             .agg(F.count(F.lit(1)).alias("n_transitions")))


def next_state_share(df: DataFrame, key, ts: str, state: str, from_state, tie=None) -> DataFrame:
    """What follows ``from_state``: count and share per next state (3.6)."""
    x = (O.stitched(df.select(*cols(key), ts, state, *cols(tie)), key, [ts] + cols(tie), nxt=[state])
         .where((F.col(state) == F.lit(from_state)) & F.col(f"next_{state}").isNotNull()))
    g = x.groupBy(F.col(f"next_{state}").alias(f"next_{state}")).agg(
        F.count(F.lit(1)).alias("n"))
    total = x.select(F.count(F.lit(1))).scalar()
    return g.withColumn("share", ratio("n", total))


def customers_with_transition(df: DataFrame, key, ts: str, state: str, from_state, to_state,
                              tie=None) -> DataFrame:
    """Distinct keys that went straight from ``from_state`` to ``to_state``,
    and their share of all keys (3.5, ruling X7)."""
    x = (O.stitched(df.select(*cols(key), ts, state, *cols(tie)), key, [ts] + cols(tie), nxt=[state])
         .where((F.col(state) == F.lit(from_state))
                & (F.col(f"next_{state}") == F.lit(to_state))))
    n = x.select(F.count_distinct(*[F.col(k) for k in cols(key)]).alias("n_customers"))
    total = df.select(F.count_distinct(*[F.col(k) for k in cols(key)])).scalar()
    return n.withColumn("share", ratio("n_customers", total))


def state_as_of(df: DataFrame, key, ts: str, state: str, at, tie=None) -> DataFrame:
    """Each key's state on date ``at`` (the last row with ts <= at), then the
    count and share per state (3.7).  max_by over a struct (ts, tie) picks the
    last row in one aggregation with map-side partial results."""
    order = F.struct(F.col(ts), *[F.col(t) for t in cols(tie)])
    last = (df.where(F.col(ts) <= as_date(at))
              .groupBy(*cols(key)).agg(F.max_by(F.col(state), order).alias(state)))
    g = last.groupBy(state).agg(F.count(F.lit(1)).alias("n"))
    total = last.select(F.count(F.lit(1))).scalar()
    return g.withColumn("share", ratio("n", total))


def entered_state_in_range(df: DataFrame, key, ts: str, state: str, target,
                           start, end) -> DataFrame:
    """Distinct keys with a ``target`` row dated in [start, end] (3.8)."""
    x = df.where((F.col(state) == F.lit(target))
                 & F.col(ts).between(as_date(start), as_date(end)))
    return x.select(F.count_distinct(*[F.col(k) for k in cols(key)]).alias("n_customers"))


def days_between_states(df: DataFrame, key, ts: str, state: str, target) -> DataFrame:
    """Mean days from a key's first row to its first ``target`` row (3.9,
    ruling X20), in one groupBy: min(ts) and min(ts) filtered to the target."""
    per = (df.groupBy(*cols(key))
             .agg(F.min(ts).alias("_first"),
                  F.min(F.when(F.col(state) == F.lit(target), F.col(ts))).alias("_hit"))
             .where(F.col("_hit").isNotNull())
             .select(F.datediff("_hit", "_first").alias("_days")))
    return per.agg(ratio(F.sum("_days"), F.count(F.lit(1))).alias("avg_days"),
                   F.count(F.lit(1)).alias("n_customers"))


def _month_index(later, earlier):
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def payment_schedule(states: DataFrame, prices: DataFrame, key: str, ts: str, state: str,
                     cutoff, tie=None, monthly=(1, 2), annual=(3,),
                     prorate_from=(1,), defer_annual_from=(2,), price: str = "price",
                     name: str = "plan_name") -> DataFrame:
    """Payments implied by a state log, up to ``cutoff`` (3.11, ruling X11).

    * a monthly plan pays on its start date and every month after it, on the
      same day of month (clamped to month end, never drifting);
    * an annual plan pays on its start and every 12 months;
    * a plan is billed until the next state starts (exclusive), whatever that
      state is; states that are neither monthly nor annual (trial, churn) bill
      nothing, and a plan taken up again after one is billed again;
    * an upgrade from a ``prorate_from`` plan to a dearer plan starts at once
      and its first payment is reduced by the previous plan's price;
    * an annual plan following a ``defer_annual_from`` plan starts at that
      plan's next monthly anniversary.

    ``prices`` (state, price, name) is joined; Spark broadcasts it when it has
    measured it to be small.  Each state row expands to an array of dates bounded by the
    row's own interval, so the expansion happens inside the task that holds
    the row -- there is no per-key collection.
    """
    p = prices.select(F.col(state), F.col(price), F.col(name))
    prev_price = p.select(F.col(state).alias("prev_state_"), F.col(price).alias("prev_price_"))
    x = O.stitched(states.select(key, ts, state, *cols(tie)), key, [ts] + cols(tie),
                   prev=[state, ts], nxt=[ts])
    x = (x.withColumnRenamed(f"prev_{state}", "_prev")
          .withColumnRenamed(f"prev_{ts}", "_prev_ts")
          .withColumnRenamed(f"next_{ts}", "_next_ts")
          .where(F.col(state).isin(list(monthly) + list(annual))))
    x = x.join(p, state).join(prev_price, F.col("_prev") == F.col("prev_state_"), "left")
    cut = as_date(cutoff)
    # deferred annual start: first monthly anniversary of the previous plan >= ts
    j = _month_index(F.col(ts), F.col("_prev_ts"))
    cand = F.add_months(F.col("_prev_ts"), j)
    deferred = F.when(cand >= F.col(ts), cand).otherwise(F.add_months(F.col("_prev_ts"), j + 1))
    is_annual = F.col(state).isin(list(annual))
    begin = F.when(is_annual & F.col("_prev").isin(list(defer_annual_from)), deferred) \
             .otherwise(F.col(ts))
    end_excl = F.col("_next_ts")
    step = F.when(is_annual, F.lit(12)).otherwise(F.lit(1))
    x = x.withColumn("_begin", begin)
    last = F.when(end_excl.isNull() | (F.date_sub(end_excl, 1) > cut), cut) \
            .otherwise(F.date_sub(end_excl, 1))
    n = F.floor(_month_index(last, F.col("_begin")) / step).cast("int")
    idx = F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    dates = F.filter(F.transform(idx, lambda i: F.struct(
                         i.alias("i"), F.add_months(F.col("_begin"), i * step).alias("d"))),
                     lambda s: s["d"] <= last)
    credit = (F.col("_prev").isin(list(prorate_from)) & (F.col("_prev_ts") < F.col(ts))
              & (F.col(price) > F.col("prev_price_")))
    out = (x.select(key, state, name, price, "prev_price_", credit.alias("_credit"),
                    F.explode(dates).alias("_p"))
             .select(key, state, name,
                     F.col("_p.d").alias("payment_date"),
                     F.when((F.col("_p.i") == 0) & F.col("_credit"),
                            F.col(price) - F.col("prev_price_"))
                      .otherwise(F.col(price)).cast("double").alias("amount")))
    # payment dates of one key are distinct (its state intervals do not
    # overlap), so a key has at most one row per day here: a plain window
    wo = Window.partitionBy(key).orderBy("payment_date")
    return out.withColumn("payment_order", F.row_number().over(wo).cast("bigint"))

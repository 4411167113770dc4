"""Seeded order, distributed running totals and exact quantiles.

All three rest on one step: a stratum is cut into a bounded number of ordered buckets,
bucket totals give each bucket its offset, and only rows of one bucket are ordered
together. A stratum that holds a third of all rows is thus spread over its buckets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import cut_lineage

#: Strata whose cut points may be broadcast: about 600 bytes each.
BROADCAST_STRATA = 20_000


def draw_key(seed: int, *parts: str | Column) -> Column:
    """Random-looking but repeatable order: md5 of seed and row key.

    It depends on neither partitioning nor executor, so a lost task recomputes the same draw.
    """
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *columns).cast("binary"))


def draw_bucket(key: Column) -> Column:
    """4,096 equal slices of the md5 order."""
    return F.substr(key, F.lit(1), F.lit(3))


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)], F.lit(True))


def _told(rows: DataFrame, facts: DataFrame, by: list[str], few: bool) -> DataFrame:
    """Inner join of ``facts`` per ``by``, null-safe; broadcast when they were counted to be ``few``."""
    named = facts.withColumnsRenamed({c: f"_f{i}" for i, c in enumerate(by)})
    joined = rows.join(F.broadcast(named) if few else named, _same(by, [f"_f{i}" for i in range(len(by))]), "inner")
    return joined.drop(*[f"_f{i}" for i in range(len(by))])


def cut_points(rows: DataFrame, by: list[str], value: str, buckets: int = 64) -> tuple[DataFrame, bool]:
    """Approximate quantiles of each stratum, one bounded list each, and whether the strata are few enough to broadcast."""
    shares = [k / buckets for k in range(1, buckets)]
    cuts = cut_lineage(rows.groupBy(*by).agg(F.percentile_approx(value, shares, 1_000).alias("_cuts")))
    return cuts, cuts.count() <= BROADCAST_STRATA


def fitted_buckets(rows: DataFrame, by: list[str], value: str, buckets: int = 64) -> DataFrame:
    """Add ``_slice``, an order-preserving bucket number fitted to the values of each stratum.

    Values that lie close together spread over the buckets as well as those that lie far apart. Rows stay where they are while the strata can be
    broadcast.
    """
    cuts, few = cut_points(rows, by, value, buckets)
    below = F.size(F.filter("_cuts", lambda c: c < F.col(value)))
    return _told(rows, cuts, by, few).withColumn("_slice", below).drop("_cuts")


def running_total(
    df: DataFrame,
    by: list[str],
    bucket: Column,
    order: list[Column],
    weight: Column,
) -> DataFrame:
    """Add ``_running`` (inclusive running sum of ``weight`` in ``order``) and ``_whole`` (its end).

    ``bucket`` must be non-decreasing along ``order``. One shuffle of the rows on
    (stratum, bucket) serves both the join and the window.
    """
    keys = [*by, "_bucket"]
    sliced = df.withColumn("_bucket", bucket).withColumn("_weight", weight)
    totals = sliced.groupBy(*keys).agg(F.sum("_weight").alias("_in_bucket"))
    # At most one row per bucket: the window holds thousands of rows, not the data.
    upto = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = totals.select(
        *keys,
        (F.sum("_in_bucket").over(upto) - F.col("_in_bucket")).alias("_before"),
        F.sum("_in_bucket").over(Window.partitionBy(*by)).alias("_whole"),
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        sliced.join(offsets, keys)
        .withColumn("_running", F.sum("_weight").over(inside) + F.col("_before"))
        .drop("_bucket", "_weight", "_before")
    )


def fit_budget(
    df: DataFrame, by: list[str], seed: int, key: list[str], weight: str | None, budget: Column
) -> DataFrame:
    """Draw rows of each stratum in seeded order and count how many copies of each fit ``budget``.

    Equal rows are merged into one row with ``_copies`` first, so a row that makes up a third
    of the data stays one row. Adds ``_fits`` (copies whose running total is within the budget),
    ``_drawn`` (the draw key) and ``_whole`` (total weight of the stratum). ``weight`` None counts rows.
    """
    merged = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    merged = merged.withColumn("_drawn", draw_key(seed, *key))
    w = F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")
    ranked = running_total(
        merged, by, draw_bucket(F.col("_drawn")), [F.col("_drawn"), *[F.col(c) for c in dict.fromkeys([*key, *df.columns])]],
        w * F.col("_copies"),
    )
    before = F.col("_running") - w * F.col("_copies")
    room = (budget - before).cast("double")
    # Copy j (1..copies) is within the budget when before + j * w <= budget.
    rising = F.floor(room / F.nullif(w, F.lit(0)))
    falling = F.col("_copies") + 1 - F.greatest(F.ceil(room / F.nullif(w, F.lit(0))), F.lit(1))
    level = F.when(room >= 0, F.col("_copies")).otherwise(0)
    fits = F.when(w > 0, rising).when(w < 0, falling).otherwise(level)
    return ranked.withColumn("_fits", F.greatest(F.lit(0), F.least(fits, F.col("_copies")))).drop("_running")


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` times, in two steps so that no single array grows with the count."""
    step = 10_000
    n = F.col(times)
    blocks = df.filter(n > 0).withColumn("_block", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / step))))
    left = F.least(F.lit(step), n - F.col("_block") * step)
    return blocks.withColumn("_one", F.explode(F.sequence(F.lit(1), left))).drop("_block", "_one")


def first_n(df: DataFrame, by: list[str], seed: int, key: list[str], n: int) -> DataFrame:
    """Seeded sample without replacement of at most ``n`` rows per stratum.

    Up to Spark's limit for it, each task keeps its own first n rows of a stratum before the shuffle; a larger draw goes through
    buckets. Both draw the same rows.
    """
    if n <= int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        order = [draw_key(seed, *key), *[F.col(f"`{c}`") for c in dict.fromkeys([*key, *df.columns])]]
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return df.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")
    drawn = fit_budget(df, by, seed, key, None, F.lit(n).cast("bigint"))
    return repeat_rows(drawn, "_fits").select(*df.columns)


def exact_quantiles(df: DataFrame, by: list[str], value: str, probabilities: dict[str, float]) -> DataFrame:
    """Interpolated quantiles with count, min and max per stratum; NULL values are ignored.

    Multiway selection: approximate cut points, exact counts per bucket (combined before the shuffle), and then only the buckets that
    hold a wanted rank are ordered. Of all other rows nothing but their count moves. Values are written once, narrow, and read
    three times.
    """
    rows = cut_lineage(df.select(*by, F.col(value).cast("double").alias("_x")).filter(F.col("_x").isNotNull()))
    cuts, few = cut_points(rows, by, "_x")
    below = F.size(F.filter("_cuts", lambda c: c < F.col("_x")))
    placed = _told(rows, cuts, by, few).select(*by, "_x", below.alias("_slice"))
    # At most one row per bucket from here to the picks.
    sizes = placed.groupBy(*by, "_slice").agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_low"), F.max("_x").alias("_high"))
    whole = Window.partitionBy(*by)
    upto = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = sizes.select(
        *by, "_slice", "_n", (F.sum("_n").over(upto) - F.col("_n")).alias("_before"), F.sum("_n").over(whole).alias("_whole"),
        F.min("_low").over(whole).alias("_min"), F.max("_high").over(whole).alias("_max"),
    )
    last = (F.col("_whole") - 1).cast("double")

    def holds(rank: Column) -> Column:
        return (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_n"))

    wanted = [holds(end(last * p)) for p in probabilities.values() for end in (F.floor, F.ceil)]
    picks = known.filter(reduce(Column.__or__, wanted)).drop("_n")
    # Two buckets a probability and stratum: as few as the strata are.
    chosen = _told(placed, picks, [*by, "_slice"], few)
    merged = chosen.groupBy(*by, "_slice", "_x").agg(F.count(F.lit(1)).alias("_c"), *[F.first(c).alias(c) for c in ("_before", "_whole", "_min", "_max")])
    inside = Window.partitionBy(*by, "_slice").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = merged.withColumn("_running", F.col("_before") + F.sum("_c").over(inside))

    def at(rank: Column) -> Column:
        here = (F.col("_running") - F.col("_c") <= rank) & (rank < F.col("_running"))
        return F.max(F.when(here, F.col("_x")))

    parts = []
    for name, p in probabilities.items():
        parts += [at(F.floor(last * p)).alias(f"_lo_{name}"), at(F.ceil(last * p)).alias(f"_hi_{name}")]
    found = ranked.groupBy(*by).agg(F.max("_whole").alias("n"), F.min("_min").alias("min"), F.max("_max").alias("max"), *parts)
    top = (F.col("n") - 1).cast("double")
    return found.select(
        *by, "n", "min", "max",
        *[
            (
                F.col(f"_lo_{name}")
                + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * (top * p - F.floor(top * p))
            ).alias(name)
            for name, p in probabilities.items()
        ],
    )

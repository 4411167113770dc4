"""Interval sets as such: summaries, coverage, match targets and base-pair budget sampling.

BED rows: ``contig, start0, end0`` (0-based, half-open) with ``width`` and ``chrom_order``.
Overlaps are not merged here; widths are summed as they stand.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metrics
from . import ranking

# GRCh38 length and the contigs of the karyotype, in order.
GRCH38_BP = 3_088_269_832
KARYOTYPE = [*[f"chr{i}" for i in range(1, 23)], "chrX", "chrY"]
# Fixed value: a set this many times larger than the next is worth downsampling.
DOMINANT_RATIO = 5

BED_COLUMNS = ["contig", "start0", "end0", "width", "chrom_order"]


def karyotype_rank(contig: Column) -> Column:
    """1-24 for chr1-22, X, Y; NULL for any other contig."""
    names = F.array(*[F.lit(c) for c in KARYOTYPE])
    return F.nullif(F.array_position(names, contig).cast("int"), F.lit(0))


def standard_intervals(raw: DataFrame) -> DataFrame:
    """Add width and karyotype rank, drop intervals on other contigs."""
    return (
        raw.withColumn("width", (F.col("end0") - F.col("start0")).cast("bigint"))
        .withColumn("chrom_order", karyotype_rank(F.col("contig")))
        .filter(F.col("chrom_order").isNotNull())
    )


def _percent(bp: Column) -> Column:
    return 100 * bp / F.lit(GRCH38_BP).cast("double")


def interval_summary(sets: DataFrame) -> DataFrame:
    """Count, base pairs, mean and median width (truncated), share of GRCh38 per set; largest first."""
    totals = sets.groupBy("set_name").agg(
        F.count(F.lit(1)).alias("intervals"),
        F.sum("width").alias("total_bp"),
        F.avg("width").cast("bigint").alias("mean_width"),
    )
    medians = ranking.exact_quantiles(sets, ["set_name"], "width", {"median": 0.5})
    return (
        totals.join(medians.select("set_name", F.col("median").cast("bigint").alias("median_width")), "set_name")
        .withColumn("total_bp_text", metrics.base_pairs(F.col("total_bp")))
        .withColumn("percent_grch38", _percent(F.col("total_bp")))
        .orderBy(F.desc("total_bp"), "set_name")
    )


def set_totals(sets: DataFrame) -> DataFrame:
    return sets.groupBy("set_name").agg(F.sum("width").alias("total_bp"))


def chromosome_coverage(sets: DataFrame) -> DataFrame:
    """Base pairs per set and karyotype contig, 0 where a set has nothing there."""
    zeros = sets.select("set_name").distinct().select(
        "set_name", F.explode(F.array(*[F.lit(c) for c in KARYOTYPE])).alias("contig"), F.lit(0).cast("bigint").alias("width")
    )
    return (
        sets.select("set_name", "contig", "width").unionByName(zeros)
        .groupBy("set_name", "contig").agg(F.sum("width").alias("total_bp"))
        .withColumn("chrom_order", karyotype_rank(F.col("contig")))
    )


def width_distribution(sets: DataFrame) -> DataFrame:
    """Width quartiles per set, narrowest median first."""
    return ranking.exact_quantiles(
        sets, ["set_name"], "width", {"q1": 0.25, "median": 0.5, "q3": 0.75}
    ).orderBy("median", "set_name")


def match_target(totals: DataFrame, stat: str = "max") -> DataFrame:
    """One row ``target_bp``: max, min, median or mean of the sets' totals, truncated."""
    bp = F.col("total_bp")
    stats = {"max": F.max(bp), "min": F.min(bp), "median": F.median(bp), "mean": F.avg(bp)}
    if stat not in stats:
        raise ValueError(f"unknown match statistic {stat!r}, expected one of {sorted(stats)}")
    return totals.agg(stats[stat].cast("bigint").alias("target_bp"))


def dominance(totals: DataFrame) -> DataFrame:
    """The largest set against the next; no row for fewer than two sets."""
    top = totals.orderBy(F.desc("total_bp"), "set_name").limit(2)
    pair = F.array_sort(F.collect_list(F.struct((-F.col("total_bp")).alias("neg"), "set_name")))
    row = top.agg(pair.alias("_top")).filter(F.size("_top") == 2)
    first, second = F.get(F.col("_top"), 0), F.get(F.col("_top"), 1)
    ratio = F.coalesce(
        (-first["neg"]).cast("double") / F.nullif(-second["neg"], F.lit(0)), F.lit(float("inf"))
    )
    return row.select(
        first["set_name"].alias("largest"),
        (-first["neg"]).alias("largest_bp"),
        second["set_name"].alias("second"),
        (-second["neg"]).alias("second_bp"),
        ratio.alias("ratio"),
        (ratio > DOMINANT_RATIO).alias("downsample"),
    )


def downsample(
    intervals: DataFrame, target_bp: int | Column, stratify: bool = True, seed: int = 42,
    key: list[str] | None = None,
) -> DataFrame:
    """Seeded draw of intervals up to ``target_bp`` base pairs; everything when it covers the input.

    Stratified: each contig gets its share of the budget, and the narrowest interval where
    none fits. Uniform: one budget over all, and the first drawn where none fits.
    ``target_bp`` may be a scalar subquery, so nothing needs collecting.
    """
    key = key or ["contig", "start0", "end0"]
    target = F.lit(target_bp) if isinstance(target_bp, int) else target_bp
    total = intervals.agg(F.sum("width").alias("bp")).scalar()
    if stratify:
        by = ["contig"]
        share = target.cast("double") * F.col("_whole") / total.cast("double")
        budget = F.greatest(F.lit(1).cast("bigint"), F.floor(share))
        fallback_order = ["width", "_drawn", *key]
    else:
        by = []
        budget = target
        fallback_order = ["_drawn", *key]
    drawn = ranking.fit_budget(intervals, by, seed, key, "width", budget)
    drawn = drawn.withColumn("_fits", F.when(target >= total, F.col("_copies")).otherwise(F.col("_fits")))
    kept = ranking.repeat_rows(drawn, "_fits").select(*intervals.columns)
    nothing_fits = (
        drawn.groupBy(*by)
        .agg(
            F.max("_fits").alias("_most"),
            F.min_by(F.struct(*intervals.columns), F.struct(*fallback_order)).alias("_row"),
        )
        .filter(F.col("_most") == 0)
        .select("_row.*")
    )
    return kept.unionByName(nothing_fits)


def karyotype_order(intervals: DataFrame) -> DataFrame:
    return intervals.orderBy("chrom_order", "start0", "end0")


def breakdown(before: DataFrame, after: DataFrame) -> DataFrame:
    """Intervals and base pairs per contig before and after; the missing side is NULL."""
    both = before.select("contig", "width", F.lit(True).alias("_in")).unionByName(
        after.select("contig", "width", F.lit(False).alias("_in"))
    )
    one, w, was = F.lit(1).cast("bigint"), F.col("width"), F.col("_in")
    return (
        both.groupBy("contig")
        .agg(
            F.sum(F.when(was, one)).alias("input_intervals"),
            F.sum(F.when(was, w)).alias("input_bp"),
            F.sum(F.when(~was, one)).alias("output_intervals"),
            F.sum(F.when(~was, w)).alias("output_bp"),
        )
        .withColumn("chrom_order", karyotype_rank(F.col("contig")))
        .orderBy("chrom_order")
    )


def breakdown_totals(parts: DataFrame) -> DataFrame:
    """One row of totals over a breakdown, with the reduction in per cent."""
    names = ["input_intervals", "input_bp", "output_intervals", "output_bp"]
    totals = parts.agg(*[F.coalesce(F.sum(n), F.lit(0).cast("bigint")).alias(n) for n in names])
    kept = F.col("output_bp").cast("double") / F.nullif(F.col("input_bp"), F.lit(0))
    return totals.select(
        *names,
        (100 * (1 - kept)).alias("reduction_percent"),
        _percent(F.col("input_bp")).alias("input_percent_grch38"),
        _percent(F.col("output_bp")).alias("output_percent_grch38"),
    )


def named_union(sets: dict[str, DataFrame]) -> DataFrame:
    """Several interval frames as one, each row carrying its set's name."""
    return reduce(
        DataFrame.unionByName, [df.withColumn("set_name", F.lit(name)) for name, df in sets.items()]
    )

"""Sample labels: merging, filtering, counting and stratified sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import ranking


def merge_labels(
    ancestry: DataFrame,
    groups: DataFrame,
    ancestries: list[str] | None = None,
    group_values: list[str] | None = None,
) -> DataFrame:
    """Inner join of (sample_id, ancestry) and (sample_id, grp), with optional value filters.

    The filters sit on single columns, so they reach both scans before the join.
    """
    merged = ancestry.join(groups, "sample_id", "inner").select("sample_id", "ancestry", "grp")
    if ancestries is not None:
        merged = merged.filter(F.col("ancestry").isin(ancestries))
    if group_values is not None:
        merged = merged.filter(F.col("grp").isin(group_values))
    return merged


def unmatched_counts(ancestry: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of either side without a partner, by side."""
    left = ancestry.join(groups, "sample_id", "left_anti").select(F.lit("ancestry").alias("side"))
    right = groups.join(ancestry, "sample_id", "left_anti").select(F.lit("group").alias("side"))
    return left.unionByName(right).groupBy("side").agg(F.count(F.lit(1)).alias("n"))


def label_counts(labels: DataFrame) -> DataFrame:
    """Samples per (ancestry, grp)."""
    return labels.groupBy("ancestry", "grp").agg(F.count(F.lit(1)).alias("n"))


def distinct_labels(labels: DataFrame) -> DataFrame:
    """One row: samples, distinct ancestries, distinct groups."""
    return labels.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.countDistinct("ancestry").alias("n_ancestries"),
        F.countDistinct("grp").alias("n_groups"),
    )


def one_label_each(labels: DataFrame) -> DataFrame:
    """One row per sample, for lookups: the smallest (ancestry, grp) where a sample has several, complete ones first."""
    gaps = (F.col("ancestry").isNull().cast("int") + F.col("grp").isNull().cast("int")).alias("gaps")
    picked = labels.groupBy("sample_id").agg(F.min(F.struct(gaps, "ancestry", "grp")).alias("_label"))
    return picked.select("sample_id", "_label.ancestry", "_label.grp")


def subsample(
    labels: DataFrame, samples_per_group: int | None, min_samples_per_group: int = 50, seed: int = 42
) -> DataFrame:
    """At most ``samples_per_group`` samples per (grp, ancestry), strata below the minimum dropped."""
    if samples_per_group is None:
        return labels
    if samples_per_group < min_samples_per_group:
        raise ValueError(
            f"samples_per_group={samples_per_group} is below min_samples_per_group={min_samples_per_group}: "
            "every group would be dropped"
        )
    # The minimum is no more than the cap, so what is left after the cap tells whether a stratum has enough.
    drawn = ranking.first_n(labels, ["ancestry", "grp"], seed, ["sample_id"], samples_per_group)
    size = F.count(F.lit(1)).over(Window.partitionBy("ancestry", "grp"))
    return drawn.withColumn("_size", size).filter(F.col("_size") >= min_samples_per_group).select(*labels.columns)


def require_rows(labels: DataFrame) -> DataFrame:
    """The labels, or an error when no group was large enough. Looks at one row."""
    if labels.isEmpty():
        raise ValueError("No groups with sufficient samples after filtering")
    return labels


def group_values(labels: DataFrame) -> list[str]:
    """Sorted distinct group labels; a handful of values, never sample-level data."""
    rows = labels.select("grp").filter(F.col("grp").isNotNull()).distinct().orderBy("grp").toLocalIterator()
    return [row.grp for row in rows]

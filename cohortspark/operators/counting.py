"""Counters per (sample, interval set), derived metrics and group summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metrics
from . import labels as label_ops

# Which allele class and zygosity each counter counts.
COUNTED = {
    "snp_ti_het": ("ti", "het"),
    "snp_tv_het": ("tv", "het"),
    "snp_ti_hom": ("ti", "hom"),
    "snp_tv_hom": ("tv", "hom"),
    "indel_ins_het": ("ins", "het"),
    "indel_del_het": ("del", "het"),
    "indel_ins_hom": ("ins", "hom"),
    "indel_del_hom": ("del", "hom"),
}


def _counter(name: str) -> Column:
    cls, zyg = COUNTED[name]
    return F.count_if((F.col("allele_class") == cls) & (F.col("zygosity") == zyg)).alias(name)


def sample_counts(carriers: DataFrame, samples: DataFrame, set_names: list[str]) -> DataFrame:
    """Eight counters per (sample, set), zero where a sample of the callset has none.

    ``carriers``: sample_id, set_name, allele_class, zygosity. ``samples``: sample_id of
    every sample in the callset. The zero rows enter the same aggregation as rows that no
    counter counts, so filling needs no second shuffle and no join; partial aggregation
    absorbs a sample that owns a third of the calls.
    """
    counted = carriers.select("sample_id", "set_name", "allele_class", "zygosity")
    spine = samples.select(
        "sample_id",
        F.explode(F.array(*[F.lit(n) for n in set_names])).alias("set_name"),
        F.lit(None).cast("string").alias("allele_class"),
        F.lit(None).cast("string").alias("zygosity"),
    )
    return counted.unionByName(spine).groupBy("sample_id", "set_name").agg(
        *[_counter(name) for name in metrics.COUNTERS]
    )


def add_labels(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """Ancestry and group per sample, looked up after counting; unlabelled samples drop out."""
    return counts.join(label_ops.one_label_each(labels), "sample_id", "inner")


def derived_metrics(counts: DataFrame) -> DataFrame:
    """Add the twelve derived metrics to the eight counters."""
    return counts.select("*", *metrics.derived_columns())


def widen(sample_metrics: DataFrame, set_names: list[str], columns: list[str] | None = None) -> DataFrame:
    """One row per sample with ``{set}_{metric}`` columns."""
    columns = columns or metrics.METRICS
    keys = [c for c in ("sample_id", "ancestry", "grp") if c in sample_metrics.columns]
    return (
        sample_metrics.groupBy(*keys)
        .pivot("set_name", set_names)
        .agg(*[F.first(c, ignorenulls=True).alias(c) for c in columns])
    )


def _long(row_keys: list[str], names: list[str], parts: list[str]) -> list[Column]:
    """Turn ``{metric}_{part}`` columns of an aggregated row into one row per metric."""
    rows = [
        F.struct(F.lit(m).alias("metric_type"), *[F.col(f"{m}_{p}").alias(p) for p in parts]) for m in names
    ]
    return [*[F.col(k) for k in row_keys], F.inline(F.array(*rows))]


def group_summaries(sample_metrics: DataFrame) -> DataFrame:
    """Mean, sample std and non-missing count of every metric per (ancestry, grp, set), long form."""
    keys = ["ancestry", "grp", "set_name"]
    labelled = sample_metrics.filter(F.col("ancestry").isNotNull() & F.col("grp").isNotNull())
    wide = labelled.groupBy(*keys).agg(*_summary_parts())
    return wide.select(*_long(keys, metrics.METRICS, ["mean", "std", "count"]))


def _summary_parts() -> list[Column]:
    out = []
    for m in metrics.METRICS:
        x = F.col(m).cast("double")
        out += [F.avg(x).alias(f"{m}_mean"), F.stddev_samp(x).alias(f"{m}_std"), F.count(x).alias(f"{m}_count")]
    return out


def group_summaries_wide(sample_metrics: DataFrame, set_names: list[str]) -> DataFrame:
    """One row per (ancestry, grp) with ``{set}_{metric}_{mean,std,count}`` columns."""
    labelled = sample_metrics.filter(F.col("ancestry").isNotNull() & F.col("grp").isNotNull())
    return labelled.groupBy("ancestry", "grp").pivot("set_name", set_names).agg(*_summary_parts())

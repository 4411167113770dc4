"""Result tables and BED files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import bed, ranking


def write_tsv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Tab-separated with header. ``single_file`` only for tables known to be small.

    The one task of a single file begins behind a shuffle of finished rows, so it computes none of them.
    """
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").csv(path, sep="\t", header=True)


def sampled_rows(sample_stats: DataFrame, n: int = 2000, seed: int = 42, key: str = "sample_id") -> DataFrame:
    """A seeded sample of exactly ``n`` rows, or all rows when there are no more (top-k by draw key)."""
    drawn = ranking.draw_key(seed, key)
    return sample_stats.orderBy(drawn, key).limit(n)


def write_results(
    folder: str,
    sample_stats: DataFrame,
    group_summaries: DataFrame,
    comparisons: DataFrame,
    comparison: str,
    export_per_sample: bool = True,
    export_sampled: bool = False,
    sampled_n: int = 2000,
    seed: int = 42,
) -> dict[str, str]:
    """The result tables of a run. A drawn sample of the per-sample table is a file of its own beside the full one."""
    base = folder.rstrip("/")
    written = {}
    named = sample_stats.withColumnsRenamed({"sample_id": "s", "grp": comparison})
    if export_per_sample:
        written["sample_stats"] = f"{base}/sample_stats.tsv"
        write_tsv(named, written["sample_stats"])
    if export_sampled:
        written["sampled_stats"] = f"{base}/sample_stats_sampled.tsv"
        write_tsv(sampled_rows(named, sampled_n, seed, "s"), written["sampled_stats"])
    written["group_summaries"] = f"{base}/group_summaries.tsv"
    write_tsv(group_summaries.withColumnRenamed("grp", comparison), written["group_summaries"], single_file=True)
    written["comparisons"] = f"{base}/pairwise_comparisons.tsv"
    write_tsv(comparisons, written["comparisons"], single_file=True)
    return written


def write_bed(intervals: DataFrame, path: str, single_file: bool = False) -> None:
    """Three columns, no header, karyotype order across the part files."""
    ordered = bed.karyotype_order(intervals).select("contig", "start0", "end0")
    out = ordered.coalesce(1) if single_file else ordered
    out.write.mode("overwrite").csv(path, sep="\t", header=False)

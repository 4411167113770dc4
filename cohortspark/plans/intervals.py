"""Interval tools end to end: probing a group of BED files, downsampling one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metrics
from ..operators import bed
from ..shared import cut_lineage
from ..sinks import write_bed
from ..sources import intervals as interval_source


@dataclass
class ProbeTables:
    summary: DataFrame
    chromosomes: DataFrame
    widths: DataFrame
    dominance: DataFrame


def probe_sets(spark: SparkSession, paths: dict[str, str]) -> ProbeTables:
    return _probe(interval_source.read_bed_sets(spark, paths))


def _probe(sets: DataFrame) -> ProbeTables:
    return ProbeTables(
        bed.interval_summary(sets), bed.chromosome_coverage(sets), bed.width_distribution(sets),
        bed.dominance(bed.set_totals(sets)),
    )


def resolve_target(
    spark: SparkSession, target_bp: int | None = None, match_files: list[str] | None = None, stat: str = "max"
) -> Column:
    """The budget as a column: given, or taken from other BED files' totals."""
    if target_bp is not None:
        return F.lit(target_bp).cast("bigint")
    if not match_files:
        raise ValueError("give target_bp or match_files")
    totals = bed.set_totals(interval_source.read_bed_sets(spark, {p: p for p in match_files}))
    return bed.match_target(totals, stat).scalar()


def downsample_file(
    spark: SparkSession,
    input_path: str,
    output_path: str | None = None,
    target_bp: int | None = None,
    match_files: list[str] | None = None,
    stat: str = "max",
    stratify: bool = True,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Downsampled intervals, the per-contig breakdown, and its totals.

    With ``output_path``, how the file came to be is written beside it, as ``{output_path}.manifest``.
    """
    before = interval_source.read_bed(spark, input_path)
    target = resolve_target(spark, target_bp, match_files, stat)
    after = cut_lineage(bed.downsample(before, target, stratify, seed))
    # A row per contig; read for the totals, the manifest and by the caller.
    parts = cut_lineage(bed.breakdown(before, after)).orderBy("chrom_order")
    if output_path:
        write_bed(after, output_path)
        source = "given" if target_bp is not None else f"{stat} of {', '.join(match_files)}"
        write_manifest(provenance(parts, input_path, output_path, target, source, stratify, seed), output_path)
    return bed.karyotype_order(after), parts, bed.breakdown_totals(parts)


def provenance(
    parts: DataFrame, input_path: str, output_path: str, target: Column, target_source: str, stratify: bool, seed: int
) -> DataFrame:
    """One row: when, from what, to what, with which budget and settings, and the breakdown per contig in karyotype order."""
    names = ["input_intervals", "input_bp", "output_intervals", "output_bp"]
    none = F.lit(0).cast("bigint")
    row = parts.agg(
        *[F.coalesce(F.sum(n), none).alias(n) for n in names],
        F.array_sort(F.collect_list(F.struct("chrom_order", "contig", *names))).alias("contigs"),
    ).select("*", target.alias("target"))

    def side(name: str, path: str) -> Column:
        bp = F.col(f"{name}_bp")
        return F.struct(
            F.lit(path).alias("path"), F.col(f"{name}_intervals").alias("intervals"), bp.alias("total_bp"), metrics.base_pairs(bp).alias("total_bp_text")
        ).alias(name)

    return row.select(
        F.current_timestamp().alias("created"), side("input", input_path), side("output", output_path),
        F.struct(F.col("target").alias("bp"), metrics.base_pairs(F.col("target")).alias("bp_text"), F.lit(target_source).alias("source")).alias("target"),
        F.struct(F.lit(seed).alias("seed"), F.lit(stratify).alias("stratified")).alias("params"),
        F.transform("contigs", lambda c: c.dropFields("chrom_order")).alias("per_contig"),
    )


def write_manifest(row: DataFrame, output_path: str) -> str:
    """The provenance row as JSON beside the BED output; returns its path."""
    path = f"{output_path.rstrip('/')}.manifest"
    row.coalesce(1).write.mode("overwrite").json(path)
    return path


def downsample_context(
    spark: SparkSession, input_path: str, after: DataFrame, siblings: dict[str, str] | None = None
) -> ProbeTables:
    """The probe tables of a downsampled set beside its source and the sibling sets.

    The source's set is named after its file, the result ``{name} (downsampled)``. Siblings are the other sets of the source's folder, unless given;
    the source itself never counts as one.
    """
    folder, _, file = input_path.rstrip("/").rpartition("/")
    name = file.split(".bed")[0]
    name = interval_source.SET_NAMES.get(name, name)
    if siblings is None:
        siblings = interval_source.discover_beds(spark, folder or ".")
    paths = {n: p for n, p in siblings.items() if p.rstrip("/") != input_path.rstrip("/") and n != name} | {name: input_path}
    sets = interval_source.read_bed_sets(spark, paths)
    drawn = after.select(*[c for c in sets.columns if c != "set_name"]).withColumn("set_name", F.lit(f"{name} (downsampled)"))
    return _probe(sets.unionByName(drawn))

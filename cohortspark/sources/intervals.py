"""Interval files: BED in two flavours, interval_list, and named sets of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import bed as bed_ops
from ..operators import membership
from ..shared import cut_lineage
from . import files

# Published BED file stems and the set names they stand for.
SET_NAMES = {
    "acmg59_allofus_19dec2019.GRC38.wGenes.NEW": "ACMG59",
    "GRCh38_lowmappabilityall": "Low_Mappability",
    "GRCh38_gc85_slop50": "GC_gt_85",
    "GRCh38_gclt25_merged": "GC_lt_25",
    "giab_highconf_wgs_calling_regions_hg38_intersection": "HighConf_Genome",
}


def _columns(spark: SparkSession, path: str, comment: str) -> DataFrame:
    lines = spark.read.text(path).filter((F.col("value") != "") & ~F.col("value").rlike(comment))
    f = F.split("value", "\t")
    return lines.select(
        F.get(f, 0).alias("contig"), F.get(f, 1).cast("int").alias("a"), F.get(f, 2).cast("int").alias("b")
    )


def _tolerant(spark: SparkSession, path: str, comment: str) -> DataFrame:
    """The same columns with NULL for what is no number, and whether the line is ``broken``."""
    lines = spark.read.text(path).filter((F.col("value") != "") & ~F.col("value").rlike(comment))
    f = F.split("value", "\t")
    a, b = F.get(f, 1).try_cast("int"), F.get(f, 2).try_cast("int")
    return lines.select(F.get(f, 0).alias("contig"), a.alias("a"), b.alias("b"), (a.isNull() | b.isNull()).alias("broken"))


def read_bed_sites(spark: SparkSession, path: str) -> DataFrame:
    """BED for matching sites: 1-based closed ``start, end``; empty and reversed intervals dropped."""
    raw = _columns(spark, path, "^#")
    return raw.filter(F.col("b") > F.col("a")).select(
        "contig", (F.col("a") + 1).alias("start"), F.col("b").alias("end")
    )


def read_interval_list(spark: SparkSession, path: str) -> DataFrame:
    """interval_list: already 1-based closed; header lines start with ``@``."""
    return _columns(spark, path, "^[#@]").select("contig", F.col("a").alias("start"), F.col("b").alias("end"))


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    return read_interval_list(spark, path) if ".interval_list" in path else read_bed_sites(spark, path)


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """BED for the interval tools: first three columns, width, karyotype rank; other contigs dropped."""
    raw = _columns(spark, path, "^#")
    return bed_ops.standard_intervals(
        raw.select("contig", F.col("a").alias("start0"), F.col("b").alias("end0"))
    )


def parse_specs(specs: list[str]) -> dict[str, str]:
    """``NAME=path`` texts as a dict."""
    out = {}
    for spec in specs:
        name, sign, path = spec.partition("=")
        if not sign:
            raise ValueError(f"expected NAME=path, got {spec!r}")
        out[name] = path
    return out


def discover_beds(spark: SparkSession, folder: str) -> dict[str, str]:
    """Set name to path for the ``.bed`` files of a folder, without earlier downsampling outputs."""
    found = {}
    for name in files.list_names(spark, folder):
        stem = name.removesuffix(".bed")
        if stem != name and not stem.endswith("_downsampled"):
            found[SET_NAMES.get(stem, stem)] = f"{folder.rstrip('/')}/{name}"
    return found


def present_sets(spark: SparkSession, paths: dict[str, str], on_missing: str) -> dict[str, str]:
    """The named paths or globs that exist; a missing one is an error, or left out with ``skip``."""
    if on_missing not in ("error", "skip"):
        raise ValueError("on_missing is 'error' or 'skip'")
    there = {name: path for name, path in paths.items() if files.exists(spark, path)}
    missing = sorted(set(paths) - set(there))
    if missing and on_missing == "error":
        raise FileNotFoundError(f"interval sets not found: {missing}")
    if not there:
        raise FileNotFoundError("no interval set could be read")
    return there


def _readable(spark: SparkSession, there: dict[str, str], comment: str) -> tuple[list[str], DataFrame]:
    """Sets without a broken line, and their rows (set_name, contig, a, b): every file is read once.

    Broken lines are counted per set while the rows are stored; sets that have some are left out of what is read afterwards.
    """
    rows = membership.union_sets([_tolerant(spark, path, comment).withColumn("set_name", F.lit(name)) for name, path in there.items()])
    seen = Observation()
    counts = [F.count_if(F.col("broken") & (F.col("set_name") == name)).alias(f"n{i}") for i, name in enumerate(there)]
    stored = cut_lineage(rows.observe(seen, *counts))
    names = [name for i, name in enumerate(there) if not seen.get[f"n{i}"]]
    if not names:
        raise FileNotFoundError("no interval set could be read")
    return names, stored.filter(F.col("set_name").isin(names)).drop("broken")


def load_site_sets(spark: SparkSession, paths: dict[str, str], on_missing: str = "error") -> tuple[list[str], DataFrame]:
    """Names of the sets that were read, and ``(set_name, contig, start, end)``; sets that are missing or do not parse are left out with ``skip``."""
    there = present_sets(spark, paths, on_missing)
    if on_missing == "error":
        sets = [read_sites(spark, path).withColumn("set_name", F.lit(name)) for name, path in there.items()]
        return list(there), membership.union_sets(sets).select("set_name", "contig", "start", "end")
    names, rows = _readable(spark, there, "^[#@]")
    listed = F.col("set_name").isin([name for name in names if ".interval_list" in there[name]])
    return names, rows.filter(listed | (F.col("b") > F.col("a"))).select(
        "set_name", "contig", F.when(listed, F.col("a")).otherwise(F.col("a") + 1).alias("start"), F.col("b").alias("end")
    )


def read_site_sets(spark: SparkSession, paths: dict[str, str], on_missing: str = "error") -> DataFrame:
    """``(set_name, contig, start, end)`` of named files. Skipped sets are left out altogether."""
    return load_site_sets(spark, paths, on_missing)[1]


def read_bed_sets(spark: SparkSession, paths: dict[str, str], on_missing: str = "error") -> DataFrame:
    """Named BED files for the interval tools, as one frame."""
    there = present_sets(spark, paths, on_missing)
    if on_missing == "error":
        return bed_ops.named_union({name: read_bed(spark, path) for name, path in there.items()})
    _, rows = _readable(spark, there, "^[#@]")
    named = rows.withColumnsRenamed({"a": "start0", "b": "end0"}).select("contig", "start0", "end0", "set_name")
    return bed_ops.standard_intervals(named).select(*bed_ops.BED_COLUMNS, "set_name")

"""Result tables of an earlier run, as a report reads them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metrics
from . import files
from .labels import label, read_tsv

# Columns that a comparison file must have, and the numeric ones.
REQUIRED = {"group_x", "group_y", "comparison"}
_LABELS = ["comparison", "ancestry", "group_x", "group_y"]
_COUNTS = ["n_x", "n_y"]
_NUMBERS = ["mean_x", "std_x", "mean_y", "std_y", "cohens_d", "p_value", "neg_log10_p"]


@dataclass
class ResultTables:
    comparisons: DataFrame
    group_summaries: DataFrame
    sample_stats: DataFrame | None
    comparison_name: str
    threshold: float = metrics.APPRECIABLE


def check_columns(comparisons: DataFrame) -> DataFrame:
    missing = REQUIRED - set(comparisons.columns)
    if missing:
        raise ValueError(f"comparisons lack required columns: {sorted(missing)}")
    return comparisons


def _typed(raw: DataFrame) -> DataFrame:
    columns = []
    for name in raw.columns:
        c = F.col(f"`{name}`")
        if name in _COUNTS:
            c = metrics.number(c).cast("bigint")
        elif name in _NUMBERS:
            c = metrics.number(c)
        elif name in _LABELS:
            c = label(c)
        columns.append(c.alias(name))
    typed = raw.select(*columns)
    return typed if "ancestry" in raw.columns else typed.withColumn("ancestry", F.lit("all"))


def _label_column(summaries: DataFrame) -> str:
    """The group column of a summary table: the one that is neither ancestry nor a statistic."""
    labels = [c for c in summaries.columns if c != "ancestry" and not c.endswith(("_mean", "_std", "_count"))]
    return labels[0] if labels else "group"


def read_results(
    spark: SparkSession,
    folder: str,
    load_sample_stats: bool = True,
    threshold: float = metrics.APPRECIABLE,
    comparison_name: str | None = None,
) -> ResultTables:
    """Comparisons and summaries of a run folder, and its sample table where there is one.

    The comparison's name is the one given, that of the first comparison, or the label
    column of the summaries.
    """
    base = folder.rstrip("/")
    comparisons = _typed(check_columns(read_tsv(spark, f"{base}/pairwise_comparisons.tsv")))
    summaries = read_tsv(spark, f"{base}/group_summaries.tsv")
    stats_path = f"{base}/sample_stats.tsv"
    stats = read_tsv(spark, stats_path) if load_sample_stats and files.exists(spark, stats_path) else None
    if comparison_name is None:
        first = comparisons.select("comparison").first()
        comparison_name = first.comparison if first else _label_column(summaries)
    return ResultTables(comparisons, summaries, stats, comparison_name, threshold)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _as_number(column: str | None) -> str:
    """SQL text of ``metrics.number`` for a column name; one text for hundreds of columns parses fast."""
    if column is None:
        return "CAST(NULL AS DOUBLE)"
    escaped = column.replace("`", "``")
    return f"nullif(try_cast(`{escaped}` AS DOUBLE), double('NaN'))"


def _inlined(wide: DataFrame, ids: dict[str, str], rows: list[str]) -> DataFrame:
    """One output row per struct in ``rows``; a narrow step, nothing is shuffled."""
    return wide.select(
        *[F.col(f"`{c}`").alias(alias) for c, alias in ids.items()], F.expr(f"inline(array({', '.join(rows)}))")
    )


def long_summaries(wide: DataFrame, group_column: str) -> DataFrame:
    """``{set}_{metric}_{mean,std,count}`` columns back to rows."""
    present = set(wide.columns)
    rows = []
    for column in wide.columns:
        stem = column.removesuffix("_mean")
        if stem == column:
            continue
        set_name, metric_type = metrics.parse_name(stem)
        std, count = (c if (c := f"{stem}_{part}") in present else None for part in ("std", "count"))
        rows.append(
            f"struct({_quoted(set_name)} AS set_name, {_quoted(metric_type)} AS metric_type, {_as_number(column)} AS mean, "
            f"{_as_number(std)} AS std, CAST({_as_number(count)} AS BIGINT) AS count)"
        )
    return _inlined(wide, {"ancestry": "ancestry", group_column: "grp"}, rows)


def long_sample_stats(wide: DataFrame, group_column: str) -> DataFrame:
    """``{set}_{metric}`` columns of the sample table back to rows."""
    ids = {"s": "sample_id", "ancestry": "ancestry", group_column: "grp"}
    rows = []
    for column in wide.columns:
        if column in ids:
            continue
        set_name, metric_type = metrics.parse_name(column)
        rows.append(
            f"struct({_quoted(set_name)} AS set_name, {_quoted(metric_type)} AS metric_type, {_as_number(column)} AS value)"
        )
    return _inlined(wide, ids, rows)


def numeric(wide: DataFrame, ids: set[str]) -> DataFrame:
    """All but the id columns as numbers."""
    return wide.select(
        *[(F.col(f"`{c}`") if c in ids else metrics.number(F.col(f"`{c}`"))).alias(c) for c in wide.columns]
    )

"""All report tables of a run folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import pca, report
from ..shared import cut_lineage
from ..sources import results as result_source


def build_report(
    spark: SparkSession,
    folder: str,
    threshold: float = 0.5,
    load_sample_stats: bool = True,
    comparison_name: str | None = None,
    ancestry_x: str | None = None,
    ancestry_y: str | None = None,
    max_per_group: int | None = None,
    max_samples: int | None = None,
    seed: int = 42,
) -> dict[str, DataFrame]:
    """One frame per report table; tables without their input are left out.

    ``load_sample_stats=False`` leaves the per-sample table unread, and with it distributions and PCA. ``ancestry_x`` and
    ``ancestry_y`` are the two that are matched up. ``max_per_group`` and ``max_samples`` cap the samples drawn for
    distributions and PCA; all by default.
    """
    data = result_source.read_results(spark, folder, load_sample_stats, threshold, comparison_name)
    comparisons = cut_lineage(report.parsed(data.comparisons))
    flagged = report.flagged(comparisons, threshold)
    pairs = report.stored_pairs(comparisons)
    matched = report.cross_ancestry(comparisons, ancestry_x, ancestry_y)
    tables = {
        "flag_totals": report.flag_totals(comparisons, threshold),
        "flagged": flagged.orderBy("abs_d", ascending=False),
        "flagged_top": report.flagged_top(flagged),
        "most_affected_sets": report.most_affected_sets(flagged),
        "heatmap": report.heatmap(comparisons, pairs),
        "heatmap_text": report.heatmap(comparisons, pairs, "cell_text"),
        "volcano": report.volcano(comparisons, threshold),
        "cross_ancestry": matched,
        "cross_correlation": report.cross_correlation(matched),
        "group_means": report.group_means(
            result_source.long_summaries(data.group_summaries, data.comparison_name)
        ),
        "sample_sizes": report.sample_sizes(comparisons),
    }
    if data.sample_stats is not None:
        stats = cut_lineage(data.sample_stats)
        long_rows = result_source.long_sample_stats(stats, data.comparison_name)
        tables["distributions"] = report.distributions(long_rows, max_per_group, seed)
        ids = {"s", "ancestry", data.comparison_name}
        numbers = result_source.numeric(stats, ids)
        components = pca.metric_pca(
            numbers, [c for c in stats.columns if c not in ids], "ancestry", ["s", data.comparison_name],
            max_samples, seed,
        )
        if components is not None:
            tables["pca"] = components
    return tables

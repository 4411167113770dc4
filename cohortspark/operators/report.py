"""The tables behind a results report, from the comparison and summary tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metrics
from . import ranking


def parsed(comparisons: DataFrame) -> DataFrame:
    """Comparisons with ``set_name``, ``metric_type`` and ``group_pair`` columns."""
    out = comparisons
    if "metric_type" not in comparisons.columns:
        out = out.withColumn("_m", metrics.parse_metric(F.col("metric"))).select("*", "_m.*").drop("_m")
    return out.withColumn("group_pair", metrics.pair_label(F.col("group_x"), F.col("group_y")))


def key_metrics_only(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("metric_type").isin(metrics.KEY_METRICS))


def is_flagged(threshold: float) -> Column:
    """Effect above the threshold or p below 0.05, both strict; unknown counts as no."""
    big = F.coalesce(F.abs("cohens_d") > threshold, F.lit(False))
    return big | F.coalesce(F.col("p_value") < 0.05, F.lit(False))


def flagged(comparisons: DataFrame, threshold: float = metrics.APPRECIABLE) -> DataFrame:
    """Flagged comparisons with parsed metric, severity and display name."""
    rows = parsed(comparisons.filter(is_flagged(threshold)))
    return (
        rows.withColumn("abs_d", F.abs("cohens_d"))
        .withColumn("severity", metrics.severity(F.col("cohens_d")))
        .withColumn("metric_name", metrics.display_metric(F.col("metric_type")))
    )


def flagged_top(flagged_rows: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` largest effects (top-k, no full sort)."""
    return flagged_rows.orderBy(
        F.desc_nulls_last("abs_d"), "ancestry", "group_pair", "set_name", "metric_type"
    ).limit(n)


def flag_totals(comparisons: DataFrame, threshold: float = metrics.APPRECIABLE) -> DataFrame:
    """All, flagged, and appreciable among the flagged."""
    hit = is_flagged(threshold)
    strong = F.coalesce(F.abs("cohens_d") >= metrics.APPRECIABLE, F.lit(False))
    return comparisons.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(hit).alias("n_flagged"),
        F.count_if(hit & strong).alias("n_appreciable"),
    )


def most_affected_sets(flagged_rows: DataFrame, n: int = 3) -> DataFrame:
    return (
        flagged_rows.groupBy("set_name").agg(F.count(F.lit(1)).alias("n_flagged"))
        .orderBy(F.desc("n_flagged"), "set_name").limit(n)
    )


def heatmap_cells(comparisons: DataFrame) -> DataFrame:
    """Effect, p and starred text per ancestry, row label and group pair, key metrics only."""
    rows = key_metrics_only(parsed(comparisons))
    cells = rows.groupBy(
        "ancestry", metrics.row_label(F.col("set_name"), F.col("metric_type")).alias("row_label"), "group_pair"
    ).agg(
        F.first("cohens_d", ignorenulls=True).alias("cohens_d"),
        F.first("p_value", ignorenulls=True).alias("p_value"),
    )
    return cells.withColumn("cell_text", metrics.starred(F.col("cohens_d"), F.col("p_value")))


def heatmap(comparisons: DataFrame, group_pairs: list[str], value: str = "cohens_d") -> DataFrame:
    """Heatmap matrix: one column per group pair; ``value`` is cohens_d, p_value or cell_text."""
    return (
        heatmap_cells(comparisons).groupBy("ancestry", "row_label")
        .pivot("group_pair", group_pairs).agg(F.first(value, ignorenulls=True))
    )


def stored_pairs(comparisons: DataFrame) -> list[str]:
    """The group pairs that occur, sorted; a handful of values."""
    return [r.group_pair for r in comparisons.select("group_pair").distinct().orderBy("group_pair").toLocalIterator() if r.group_pair]


def pair_names(groups: list[str]) -> list[str]:
    """Labels of all pairs of group values, in comparison order."""
    ordered = sorted(groups)
    return [f"{x} vs {y}" for i, x in enumerate(ordered) for y in ordered[i + 1:]]


def bonferroni_line(comparisons: DataFrame) -> Column:
    """-log10(0.05 / number of tests), 5 without tests, as a scalar subquery."""
    n = F.count(F.lit(1))
    line = F.when(n > 0, -F.log10(0.05 / F.nullif(n, F.lit(0)))).otherwise(5.0)
    return comparisons.agg(line.alias("line")).scalar()


def volcano(comparisons: DataFrame, threshold: float = metrics.APPRECIABLE) -> DataFrame:
    """Points of the volcano chart with the test line and the labelled outliers."""
    rows = parsed(comparisons).withColumn("bonferroni", bonferroni_line(comparisons))
    return rows.select(
        "ancestry", "group_pair", "set_name", "metric_type", "cohens_d", "neg_log10_p", "bonferroni",
        F.coalesce(F.abs("cohens_d") > threshold, F.lit(False)).alias("beyond_threshold"),
        F.coalesce(
            (F.abs("cohens_d") > metrics.LABELLED) & (F.col("neg_log10_p") > F.col("bonferroni")), F.lit(False)
        ).alias("labelled"),
    )


def cross_ancestry(comparisons: DataFrame, ancestry_x: str | None = None, ancestry_y: str | None = None) -> DataFrame:
    """Effects of two ancestries side by side; by default the first two in alphabetical order."""
    rows = key_metrics_only(parsed(comparisons))
    names = F.array_sort(F.collect_set("ancestry"))
    listed = rows.agg(names.alias("names"))
    x_name = F.lit(ancestry_x) if ancestry_x else listed.select(F.get("names", F.lit(0)).alias("x")).scalar()
    y_name = F.lit(ancestry_y) if ancestry_y else listed.select(F.get("names", F.lit(1)).alias("y")).scalar()
    # The two may name the groups of a pair in either order; the effect then changes its sign.
    rows = rows.withColumns({"_low": F.least("group_x", "group_y"), "_high": F.greatest("group_x", "group_y")})
    key = ["_low", "_high", "metric"]
    x = rows.filter(F.col("ancestry") == x_name).select(
        *key, "group_pair", "set_name", "metric_type", F.col("ancestry").alias("ancestry_x"), F.col("cohens_d").alias("d_x"),
        F.col("group_x").alias("_first_x"),
    ).dropDuplicates(key)
    y = rows.filter(F.col("ancestry") == y_name).select(
        *key, F.col("ancestry").alias("ancestry_y"), F.col("cohens_d").alias("_d"), F.col("group_x").alias("_first_y")
    ).dropDuplicates(key)
    apart = F.abs(F.col("d_x") - F.col("d_y"))
    strongest = F.greatest(F.abs("d_x"), F.abs("d_y"))
    return (
        x.join(y, key)
        .withColumn("d_y", F.when(F.col("_first_x") == F.col("_first_y"), F.col("_d")).otherwise(-F.col("_d")))
        .select("group_pair", "metric", "set_name", "metric_type", "ancestry_x", "d_x", "ancestry_y", "d_y")
        .withColumn("comparison_key", F.concat_ws(" | ", "group_pair", "metric"))
        .withColumn(
            "labelled",
            F.coalesce((strongest > metrics.LABELLED) | (apart > metrics.LABELLED), F.lit(False)),
        )
    )


def cross_correlation(matched: DataFrame) -> DataFrame:
    """Matched comparisons and Pearson r of their effects."""
    both = F.col("d_x").isNotNull() & F.col("d_y").isNotNull()
    return matched.agg(
        F.count(F.lit(1)).alias("n_matched"), F.corr(F.when(both, F.col("d_x")), F.when(both, F.col("d_y"))).alias("r")
    )


def group_means(summaries: DataFrame) -> DataFrame:
    """Mean and std per ancestry, group, set and key metric; 0 for a cell that does not occur.

    The spine of cells comes from the distinct labels, a handful of values.
    """
    rows = key_metrics_only(summaries)
    groups = rows.agg(F.collect_set("grp").alias("groups")).scalar()
    bars = rows.agg(F.collect_set(F.struct("set_name", "metric_type")).alias("bars")).scalar()
    spine = (
        rows.select("ancestry").distinct()
        .select("ancestry", F.explode(groups).alias("grp"))
        .select("ancestry", "grp", F.inline(bars))
    )
    present = rows.withColumn("_here", F.lit(True))
    joined = spine.join(present, ["ancestry", "grp", "set_name", "metric_type"], "left")
    absent = F.col("_here").isNull()
    return joined.select(
        "ancestry", "grp", "set_name", "metric_type",
        metrics.display_metric(F.col("metric_type")).alias("metric_name"),
        F.when(absent, F.lit(0.0)).otherwise(F.col("mean")).alias("mean"),
        F.when(absent, F.lit(0.0)).otherwise(F.col("std")).alias("std"),
    )


def long_metrics(sample_metrics: DataFrame, names: list[str] = metrics.KEY_METRICS) -> DataFrame:
    """One row per sample, set and metric."""
    rows = [F.struct(F.lit(m).alias("metric_type"), F.col(m).cast("double").alias("value")) for m in names]
    return sample_metrics.select("sample_id", "ancestry", "grp", "set_name", F.inline(F.array(*rows)))


def distributions(long_rows: DataFrame, max_per_group: int | None = None, seed: int = 42) -> DataFrame:
    """Quartiles, min, max and count per ancestry, group, set and key metric.

    ``long_rows``: sample_id, ancestry, grp, set_name, metric_type, value. All samples by
    default; ``max_per_group`` draws at most that many samples per (group, ancestry) first,
    as a chart would.
    """
    rows = key_metrics_only(long_rows)
    if max_per_group is not None:
        people = rows.select("sample_id", "ancestry", "grp").distinct()
        drawn = ranking.first_n(people, ["grp", "ancestry"], seed, ["sample_id"], max_per_group)
        rows = rows.join(drawn.select("sample_id"), "sample_id", "left_semi")
    return ranking.exact_quantiles(
        rows, ["ancestry", "grp", "set_name", "metric_type"], "value",
        {"q1": 0.25, "median": 0.5, "q3": 0.75},
    )


def sample_sizes(comparisons: DataFrame) -> DataFrame:
    """Largest sample count per group and ancestry, over both sides of all comparisons."""
    sides = comparisons.select(
        "ancestry",
        F.inline(
            F.array(
                F.struct(F.col("group_x").alias("grp"), F.col("n_x").alias("n")),
                F.struct(F.col("group_y").alias("grp"), F.col("n_y").alias("n")),
            )
        ),
    )
    return sides.groupBy("grp", "ancestry").agg(F.max("n").alias("n"))


def sample_size_table(comparisons: DataFrame, ancestries: list[str]) -> DataFrame:
    return sample_sizes(comparisons).groupBy("grp").pivot("ancestry", ancestries).agg(F.max("n"))

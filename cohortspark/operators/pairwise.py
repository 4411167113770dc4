"""Effect sizes and Welch tests between all pairs of groups inside each ancestry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metrics, student

# The columns of the comparison file.
COMPARISON_COLUMNS = [
    "comparison", "ancestry", "group_x", "group_y", "metric", "mean_x", "std_x", "n_x",
    "mean_y", "std_y", "n_y", "cohens_d", "p_value", "neg_log10_p",
]


def moments(sample_metrics: DataFrame) -> DataFrame:
    """Row count, and count, mean, population std and sample variance of each key metric.

    One partial aggregation over the sample table; all later work is on these few rows.
    """
    keys = ["ancestry", "grp", "set_name"]
    parts = [F.count(F.lit(1)).alias("n_rows")]
    for m in metrics.KEY_METRICS:
        x = F.col(m).cast("double")
        parts += [
            F.count(x).alias(f"{m}_n"),
            F.avg(x).alias(f"{m}_mean"),
            F.stddev_pop(x).alias(f"{m}_sd"),
            F.var_samp(x).alias(f"{m}_var"),
        ]
    wide = sample_metrics.groupBy(*keys).agg(*parts)
    rows = [
        F.struct(F.lit(m).alias("metric_type"), *[F.col(f"{m}_{p}").alias(p) for p in ("n", "mean", "sd", "var")])
        for m in metrics.KEY_METRICS
    ]
    return wide.select(*keys, "n_rows", F.inline(F.array(*rows)))


def cohens_d(
    mean_x: Column, sd_x: Column, n_x: Column, mean_y: Column, sd_y: Column, n_y: Column
) -> Column:
    """Mean difference over the (n-1)-weighted pooled deviation; NULL when that is zero or unknown."""
    pooled = F.sqrt(((n_x - 1) * sd_x * sd_x + (n_y - 1) * sd_y * sd_y) / F.nullif(n_x + n_y - 2, F.lit(0)))
    return (mean_x - mean_y) / F.nullif(pooled, F.lit(0.0))


def compare_groups(
    sample_metrics: DataFrame,
    comparison: str = "group",
    min_samples: int = 50,
    min_values: int = 10,
    ddof: int = 0,
    group_order: list[str] | None = None,
) -> DataFrame:
    """All group pairs within an ancestry, per interval set and key metric.

    ``min_samples`` counts rows per group, ``min_values`` non-missing values per metric.
    ``ddof=0`` pools population deviations; 1 gives the textbook pooled value. Pairs are
    ordered alphabetically unless ``group_order`` names the order. Keeps ``set_name`` and
    ``metric_type`` as columns beside the glued ``metric``.
    """
    usable = moments(sample_metrics).filter((F.col("n_rows") >= min_samples) & (F.col("n") >= min_values))
    if min_values < 1:
        raise ValueError("min_values must be at least 1")
    if group_order is None:
        rank = F.col("grp")
    else:
        rank = F.array_position(F.array(*[F.lit(g) for g in group_order]), F.col("grp"))
        usable = usable.filter(rank > 0)
    side = usable.withColumn("_rank", rank).withColumn("std", F.col("sd") if ddof == 0 else F.sqrt("var"))
    cell = ["ancestry", "set_name", "metric_type"]
    own = ["grp", "_rank", "n", "mean", "std", "var"]
    x = side.select(*cell, *[F.col(c).alias(f"{c}_x") for c in own])
    y = side.select(*cell, *[F.col(c).alias(f"{c}_y") for c in own])
    # Pairs are formed from one aggregated row per group; the equi key keeps it a hash join.
    pairs = x.join(y, cell).filter(F.col("_rank_x") < F.col("_rank_y"))
    c = F.col
    return (
        student.with_welch_p(pairs)
        .withColumn("cohens_d", cohens_d(c("mean_x"), c("std_x"), c("n_x"), c("mean_y"), c("std_y"), c("n_y")))
        .withColumn("neg_log10_p", student.neg_log10(c("p_value")))
        .withColumn("comparison", F.lit(comparison))
        .withColumn("metric", F.concat_ws("_", "set_name", "metric_type"))
        .withColumnsRenamed({"grp_x": "group_x", "grp_y": "group_y"})
        .select(*COMPARISON_COLUMNS, "set_name", "metric_type")
    )

"""Principal components of per-sample metrics inside each stratum.

Spark has no grouped covariance, so this is the one place with Python in the tasks: each
partition folds its Arrow batches into a count, mean and co-moment matrix per stratum, the
partials are merged in two rounds, and one small matrix per stratum is decomposed. One pass
over the rows serves all strata, and a stratum with a third of the rows stays spread over
its partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import cut_lineage
from . import ranking

MIN_METRICS = 3
MIN_SAMPLES = 10
BROADCAST_STRATA = 10_000


def stratum_moments(rows: DataFrame, stratum: str, width: int) -> DataFrame:
    """One row per stratum: ``n, mean, comoment`` (a flattened width x width matrix).

    Partials are merged in two rounds. Partition p goes to group isqrt(p): of P partitions that makes about sqrt(P) groups
    of at most twice as many partials, so both rounds grow with the square root.
    """
    kind = rows.schema[stratum].dataType.simpleString()
    schema = f"stratum {kind}, part int, n bigint, mean array<double>, comoment array<double>"

    # Nested, so that they travel with the job and executors need no installed package.
    def merge(a, b):
        import numpy as np

        n = a[0] + b[0]
        gap = b[1] - a[1]
        return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)

    def fold(batches):
        import math

        import numpy as np
        import pandas as pd
        from pyspark import TaskContext

        seen = {}
        for batch in batches:
            for value, group in batch.groupby("stratum", sort=False):
                x = np.stack(group["x"].to_numpy())
                mean = x.mean(axis=0)
                centred = x - mean
                part = (len(x), mean, centred.T @ centred)
                seen[value] = merge(seen[value], part) if value in seen else part
        part = math.isqrt(TaskContext.get().partitionId())
        for value, (n, mean, comoment) in seen.items():
            yield pd.DataFrame(
                {"stratum": [value], "part": [part], "n": [n], "mean": [mean], "comoment": [comoment.ravel()]}
            )

    def combine(key, group):
        import numpy as np
        import pandas as pd

        total = None
        for n, mean, flat in zip(group["n"], group["mean"], group["comoment"]):
            item = (int(n), np.asarray(mean), np.asarray(flat).reshape(width, width))
            total = item if total is None else merge(total, item)
        return pd.DataFrame(
            {"stratum": [key[0]], "part": [0], "n": [total[0]], "mean": [total[1]], "comoment": [total[2].ravel()]}
        )

    vectors = rows.select(F.col(stratum).alias("stratum"), F.col("_x").alias("x"))
    partials = vectors.mapInPandas(fold, schema)
    return partials.groupBy("stratum", "part").applyInPandas(combine, schema).groupBy("stratum").applyInPandas(
        combine, schema
    )


def _components(moments: DataFrame, stratum: str, width: int) -> DataFrame:
    """Weights and shares of the first two components of the standardised columns."""
    kind = moments.schema["stratum"].dataType.simpleString()
    schema = (
        f"`{stratum}` {kind}, w1 array<double>, c1 double, w2 array<double>, c2 double, "
        "percent_1 double, percent_2 double"
    )

    def decompose(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            out = []
            for value, n, mean, flat in zip(batch["stratum"], batch["n"], batch["mean"], batch["comoment"]):
                mean = np.asarray(mean)
                cov = np.asarray(flat).reshape(width, width) / n
                spread = np.sqrt(np.diag(cov))
                spread[spread == 0] = 1.0  # a constant column standardises to zeros
                strengths, axes = np.linalg.eigh(cov / np.outer(spread, spread))
                whole = strengths.sum()
                row = [value]
                for k in (-1, -2):
                    axis = axes[:, k]
                    # Component signs are arbitrary: the loading of largest size is made positive.
                    axis = axis * (1.0 if axis[np.abs(axis).argmax()] >= 0 else -1.0)
                    weights = axis / spread
                    row += [weights, float(weights @ mean)]
                row += [float(100 * strengths[k] / whole) if whole > 0 else 0.0 for k in (-1, -2)]
                out.append(row)
            yield pd.DataFrame(out, columns=[stratum, "w1", "c1", "w2", "c2", "percent_1", "percent_2"])

    return moments.mapInPandas(decompose, schema)


def _score(weights: str, offset: str) -> Column:
    products = F.zip_with("_x", weights, lambda x, w: x * w)
    return F.aggregate(products, F.lit(0.0), lambda total, v: total + v) - F.col(offset)


def metric_pca(
    rows: DataFrame,
    features: list[str],
    stratum: str,
    keep: list[str],
    max_samples: int | None = None,
    seed: int = 42,
) -> DataFrame | None:
    """Two components per stratum: ``keep`` columns, pc1, pc2 and their shares of variance.

    Columns are standardised with the population deviation. Missing values count as 0. None
    with fewer than three metrics; a stratum with fewer than ten rows is left out.
    ``max_samples`` draws a seeded sample per stratum first.
    """
    if len(features) < MIN_METRICS:
        return None
    values = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in features]
    named = [stratum, *[c for c in keep if c != stratum]]
    vectors = rows.filter(F.col(stratum).isNotNull()).select(*named, F.array(*values).alias("_x"))
    if max_samples is not None:
        vectors = ranking.first_n(vectors, [stratum], seed, [keep[0]], max_samples)
    moments = stratum_moments(vectors, stratum, len(features)).filter(F.col("n") >= MIN_SAMPLES)
    # A few kilobytes per stratum, materialised once: the count below decides how to join it.
    model = cut_lineage(_components(moments, stratum, len(features)))
    if model.count() <= BROADCAST_STRATA:
        model = F.broadcast(model)
    return vectors.join(model, stratum).select(
        *named, _score("w1", "c1").alias("pc1"), _score("w2", "c2").alias("pc2"), "percent_1", "percent_2"
    )

"""Sharding along a Hilbert curve, in DataFrame operations alone.

Metadata columns are quantised to ``2 ** bits`` levels each by corpus quantiles (strings by whole values), every cell of the grid gets its
index on the Hilbert curve, and the rows, sorted by that index, are cut into runs with row counts at most one
apart. Neighbours on the curve are near in every dimension, so each shard covers a small box of all
of them and its files' column ranges prune filters on any.

The rank of a row is the offset of its bucket plus its place in it. A bucket is a cell, or for a cell with many
rows a hashed part of it, so no sort ever sees more than one bucket; offsets come from at most
``2 ** (bits * dimensions)`` cells and their parts.

Edge cases: null metadata is the lowest level; equal rows are ordered by id, then by the row's hash, and equal rows
are interchangeable; fewer rows than shards leave the last shards empty. Input columns named like an output column
are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortspark.shared import cut_lineage

ADDED = ["shard", "slot"]


def _number_cuts(df: DataFrame, dims: Sequence[str], shares: list[float], accuracy: int) -> dict[str, list[float]]:
    """Quantiles of number columns: one aggregate for all of them."""
    if not dims:
        return {}
    found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, accuracy) for c in dims]).first()
    return {c: cuts or [] for c, cuts in zip(dims, found)}


def _text_cuts(df: DataFrame, dim: str, levels: int) -> list[str]:
    """Exact quantiles of a string column, by cumulated counts of whole values.

    Values are counted in the tasks first, so a hot value is one row. Distinct values are laid out in ranges; a range begins
    at the count of those before it, and at most ``levels - 1`` values, those in which a wanted rank falls, reach the driver.
    """
    counts = df.filter(F.col(dim).isNotNull()).groupBy(F.col(dim).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    # Stored, since a range's number must not change between the two reads.
    ranges = cut_lineage(counts.repartitionByRange("value").select("value", "n", F.spark_partition_id().alias("range")))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, as many as the shuffle has partitions.
    starts = ranges.groupBy("range").agg(F.sum("n").alias("n")).select(
        "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"), F.sum("n").over(Window.partitionBy()).alias("total"))
    within = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranges.join(F.broadcast(starts), "range").withColumn("upto", F.col("start") + F.sum("n").over(within))

    def ranks(upto: Column) -> Column:
        """How many of the wanted ranks, the k-th being k / levels of all rows, lie in the rows up to here."""
        return F.least(F.call_function("div", upto * levels, F.col("total")), F.lit(levels - 1))

    held = placed.filter(ranks(F.col("upto")) > ranks(F.col("upto") - F.col("n")))
    return [r.value for r in held.select("value").collect()]


def _levels(df: DataFrame, dims: Sequence[str], bits: int, accuracy: int) -> list[Column]:
    """The quantile each value falls in: at most ``2 ** bits - 1`` cuts a dimension."""
    texts = [c for c in dims if isinstance(df.schema[c].dataType, T.StringType)]
    shares = [k / 2**bits for k in range(1, 2**bits)]
    cuts = _number_cuts(df, [c for c in dims if c not in texts], shares, accuracy)
    cuts |= {c: _text_cuts(df, c, 2**bits) for c in texts}
    out = []
    for c in dims:
        place = F.col(c) if c in texts else F.col(c).cast("double")
        level = sum((F.when(place >= F.lit(edge), 1).otherwise(0) for edge in sorted(set(cuts[c]))), F.lit(0))
        out.append(F.when(place.isNull(), 0).otherwise(level))
    return out


def hilbert_index(levels: Sequence[Column], bits: int) -> Column:
    """Index of a grid cell on the Hilbert curve.

    From the highest bit down, a set bit of a coordinate mirrors the lower bits of the first one, a clear bit swaps
    them with its own (the transpose form of the curve); a Gray code over the transposed bits then gives the index.
    """
    dims = len(levels)
    x = F.array(*[c.cast("int") for c in levels])

    def turn(point: Column, step: Column) -> Column:
        q, axis = step["q"], step["axis"]
        own, first = F.get(point, axis), F.get(point, F.lit(0))
        lower = q - 1
        swap = first.bitwiseXOR(own).bitwiseAND(lower)
        set_bit = own.bitwiseAND(q) != 0
        return F.transform(point, lambda v, i: F.when(set_bit, F.when(i == 0, v.bitwiseXOR(lower)).otherwise(v)).otherwise(
            F.when((i == 0) | (i == axis), v.bitwiseXOR(F.when(axis == 0, 0).otherwise(swap))).otherwise(v)))

    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(a).alias("axis")) for b in range(bits - 1, 0, -1) for a in range(dims)])
    turned = F.aggregate(steps, x, turn) if bits > 1 else x
    gray = F.transform(turned, lambda v, i: F.aggregate(F.slice(turned, 1, i + 1), F.lit(0), lambda a, b: a.bitwiseXOR(b)))
    mask = F.aggregate(
        F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)]) if bits > 1 else F.expr("CAST(array() AS ARRAY<INT>)"), F.lit(0),
        lambda t, q: F.when(F.get(gray, F.lit(dims - 1)).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t),
    )
    digits = F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(a).alias("axis")) for b in range(bits - 1, -1, -1) for a in range(dims)])
    return F.aggregate(
        digits, F.lit(0).cast("bigint"),
        lambda h, d: h * 2 + F.pmod(F.floor(F.get(gray, d["axis"]).bitwiseXOR(mask) / F.pow(F.lit(2.0), d["bit"])), F.lit(2)),
    ).cast("bigint")


def hilbert_shards(
    rows: DataFrame, dims: Sequence[str], key: str = "doc_id", shards: int = 40, bits: int = 4, accuracy: int = 10_000,
    bucket_rows: int = 1_000_000,
) -> DataFrame:
    """``rows`` with shard (0 to ``shards`` - 1) and slot (gapless from 0 in it), in Hilbert order of ``dims``."""
    rows = rows.drop(*ADDED)
    columns = rows.columns
    table = cut_lineage(rows)
    total = table.count()
    levels = _levels(table, dims, bits, accuracy)
    grid = [f"_q{i}" for i in range(len(dims))]
    placed = table.withColumns(dict(zip(grid, levels)))
    part_rows = min(bucket_rows, max(100, total // 2_048))
    cells = cut_lineage(
        placed.groupBy(*grid).agg(F.count(F.lit(1)).alias("n"))
        .select(*grid, hilbert_index([F.col(c) for c in grid], bits).alias("_index"), F.ceil(F.col("n") / part_rows).cast("bigint").alias("_parts"))
    )
    # The grid bounds the table of cells: 2 ** (bits * dimensions) rows.
    part = F.pmod(F.xxhash64(key, *columns), F.col("_parts")).alias("_part")
    bucketed = placed.join(F.broadcast(cells), grid).select(*columns, "_index", part)
    sizes = bucketed.groupBy("_index", "_part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_index", "_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_index", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_index", "_part").orderBy(key, F.xxhash64(*columns))
    ranked = bucketed.join(F.broadcast(offsets), ["_index", "_part"]).withColumn("_rank", F.col("_offset") + F.row_number().over(within) - 1)
    # The first ``more`` shards take one row more than the others.
    base, more = divmod(total, shards)
    edge = more * (base + 1)
    first = F.col("_rank") < edge
    by = lambda width, rank: F.floor(rank / F.lit(width)).cast("bigint")
    shard = F.when(first, by(base + 1, F.col("_rank"))).otherwise(more + by(max(base, 1), F.col("_rank") - edge))
    slot = F.when(first, F.col("_rank") - shard * (base + 1)).otherwise(F.col("_rank") - edge - (shard - more) * base)
    return ranked.select(*columns, shard.cast("int").alias("shard"), slot.cast("bigint").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order, so that Parquet's column ranges prune."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

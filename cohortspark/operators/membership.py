"""Which interval sets contain a site: a range join over position blocks.

Intervals are cut at block borders and merged inside each block, so one block holds at
most ``block_bp / 2`` disjoint pieces per set however many intervals overlap there. A site
meets only the pieces of its own block, and each set at most once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import cut_lineage

BLOCK_BP = 2048
# Entries of the block index that may be broadcast: about 100 bytes each, so under 500 MB.
BROADCAST_ENTRIES = 4_000_000
# Beyond that, a block with more than one slice of all points is cut up.
HOT_SLICES = 65_536
# Base pairs of a sweep's cell: a genome has a few thousand.
CELL_BP = 1 << 20


def union_sets(sets: list[DataFrame]) -> DataFrame:
    """Concatenate interval sets."""
    return reduce(DataFrame.unionByName, sets)


def _block(position: Column, block_bp: int) -> Column:
    return F.call_function("div", position, F.lit(block_bp)).cast("int")


def block_index(intervals: DataFrame, block_bp: int = BLOCK_BP) -> DataFrame:
    """Disjoint pieces ``(_contig, _block, set_name, _from, _to)`` of 1-based closed intervals."""
    cut = intervals.filter(F.col("start") <= F.col("end")).select(
        "set_name",
        F.col("contig").alias("_contig"),
        "start",
        "end",
        F.explode(F.sequence(_block(F.col("start"), block_bp), _block(F.col("end"), block_bp))).alias("_block"),
    )
    pieces = cut.select(
        "set_name",
        "_contig",
        "_block",
        F.greatest(F.col("start"), F.col("_block") * block_bp).alias("_from"),
        F.least(F.col("end"), F.col("_block") * block_bp + (block_bp - 1)).alias("_to"),
    )
    # Of the pieces with one start only the longest matters: combined before the shuffle,
    # this bounds a block to block_bp rows per set, even where a third of all intervals lie.
    longest = pieces.groupBy("set_name", "_contig", "_block", "_from").agg(F.max("_to").alias("_to"))
    place = Window.partitionBy("set_name", "_contig", "_block").orderBy("_from")
    reached = F.max("_to").over(place.rowsBetween(Window.unboundedPreceding, -1))
    marked = longest.withColumn("_new", F.coalesce((F.col("_from") > reached + 1).cast("int"), F.lit(1)))
    islands = marked.withColumn("_island", F.sum("_new").over(place))
    return (
        islands.groupBy("set_name", "_contig", "_block", "_island")
        .agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"))
        .drop("_island")
    )


def index_bound(intervals: DataFrame, block_bp: int = BLOCK_BP) -> int:
    """Upper bound of the rows ``block_index`` can give: one aggregate over the interval table."""
    blocks = _block(F.col("end"), block_bp) - _block(F.col("start"), block_bp) + 1
    row = intervals.filter(F.col("start") <= F.col("end")).agg(F.sum(blocks.cast("bigint"))).first()
    return row[0] or 0


def _hot_blocks(keyed: DataFrame, min_hot_rows: int) -> DataFrame:
    """Blocks with more than a slice of all points, and the number of parts to cut them into.

    A slice is 1/65,536 of the points, so there are fewer than 65,536 hot blocks and as many
    extra parts at most, whatever the data.
    """
    sizes = cut_lineage(keyed.groupBy("contig", "_blk").agg(F.count(F.lit(1)).alias("_n")))
    total = sizes.agg(F.sum("_n").alias("total")).scalar()
    slice_rows = F.greatest(F.ceil(total / HOT_SLICES), F.lit(min_hot_rows))
    return cut_lineage(
        sizes.filter(F.col("_n") > slice_rows).select(
            F.col("contig").alias("_hot_contig"),
            F.col("_blk").alias("_hot_block"),
            F.ceil(F.col("_n") / slice_rows).alias("_parts"),
        )
    )


def sweep_membership(points: DataFrame, intervals: DataFrame, cell_bp: int = CELL_BP) -> DataFrame:
    """Distinct ``(contig, pos, set_name)`` by a sweep over positions, for indexes of any size.

    An interval is two steps, one up at its start and one down behind its end, however long it is; equal steps of a set are added up before they move. Steps
    and sites are dealt by cell and sorted by position; a running count of open intervals per set says which sets a site lies in. What is
    open where a cell begins is carried there as one row per set, worked out from the sums of the cells before. A
    task holds one Arrow batch and a count per set.
    """
    spark_type = points.schema["contig"].dataType.simpleString()
    pos_type = points.schema["pos"].dataType.simpleString()
    cell = F.call_function("div", F.col("pos"), F.lit(cell_bp))
    places = points.select("contig", F.col("pos").cast("bigint").alias("pos")).filter("contig IS NOT NULL AND pos IS NOT NULL").distinct()
    up = F.struct(F.col("start").cast("bigint").alias("pos"), F.lit(1).cast("bigint").alias("delta"))
    down = F.struct((F.col("end").cast("bigint") + 1).alias("pos"), F.lit(-1).cast("bigint").alias("delta"))
    ends = intervals.filter(F.col("start") <= F.col("end")).select("contig", "set_name", F.inline(F.array(up, down)))
    steps = ends.filter("contig IS NOT NULL AND set_name IS NOT NULL").groupBy("contig", "set_name", "pos").agg(F.sum("delta").alias("delta")).filter("delta <> 0").withColumn("cell", cell)
    # One row per set and cell with a step or a site: what a cell begins with is the sum of the cells before it.
    sums = steps.groupBy("contig", "set_name", "cell").agg(F.sum("delta").alias("delta"))
    # Not the column itself: were it a constant, the optimizer would take it out of the join's keys.
    named = F.when(F.col("pos") > -(1 << 62), F.col("contig"))
    visited = places.select(named.alias("contig"), cell.alias("cell")).distinct()
    still = visited.join(sums.select("contig", "set_name").distinct(), "contig").select("contig", "set_name", "cell", F.lit(0).cast("bigint").alias("delta"))
    order = Window.partitionBy("contig", "set_name").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    every = sums.unionByName(still).groupBy("contig", "set_name", "cell").agg(F.sum("delta").alias("delta"))
    carried = every.withColumn("delta", F.sum("delta").over(order)).filter("delta > 0")
    none = F.lit(None).cast("string")
    columns = ["contig", "cell", "pos", "kind", "set_name", "delta"]
    rows = (
        carried.withColumns({"pos": F.col("cell") * cell_bp - 1, "kind": F.lit(0)}).select(*columns)
        .union(steps.withColumn("kind", F.lit(1)).select(*columns))
        .union(places.withColumns({"cell": cell, "kind": F.lit(2), "set_name": none, "delta": F.lit(0).cast("bigint")}).select(*columns))
    )

    # Nested, so that it travels with the job.
    def sweep(batches):
        import numpy as np
        import pyarrow as pa

        state, here = {}, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            contig, place = batch.column(0).dictionary_encode(), batch.column(1).to_numpy(zero_copy_only=False)
            code = contig.indices.to_numpy(zero_copy_only=False)
            fresh = np.concatenate([[(batch.column(0)[0].as_py(), int(place[0])) != here], (code[1:] != code[:-1]) | (place[1:] != place[:-1])])
            begun = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))
            sites = np.flatnonzero(batch.column(3).to_numpy(zero_copy_only=False) == 2)
            sets = batch.column(4).dictionary_encode()
            of, names = sets.indices.fill_null(-1).to_numpy(zero_copy_only=False), sets.dictionary.to_pylist()
            delta = batch.column(5).to_numpy(zero_copy_only=False)
            left, rows, found = {}, [], []
            for name in dict.fromkeys([*state, *names]):
                total = np.cumsum(np.where(of == names.index(name), delta, 0)) if name in names else np.zeros(n, np.int64)
                # What a cell began with does not count, unless it began in an earlier batch.
                count = total - np.where(begun > 0, total[np.maximum(begun, 1) - 1], 0) + np.where(begun < 0, state.get(name, 0), 0)
                inside = sites[count[sites] > 0]
                rows.append(inside)
                found.append(pa.array([name] * len(inside), pa.string()))
                if count[-1]:
                    left[name] = int(count[-1])
            state, here = left, (batch.column(0)[n - 1].as_py(), int(place[-1]))
            if rows:
                own = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(2).take(own), pa.concat_arrays(found)], ["contig", "pos", "set_name"])

    dealt = rows.repartition("contig", "cell").sortWithinPartitions("contig", "cell", "pos", "kind")
    placed = dealt.mapInArrow(sweep, f"contig {spark_type}, pos bigint, set_name string")
    return placed.select("contig", F.col("pos").cast(pos_type).alias("pos"), "set_name")


def attach_sets(
    points: DataFrame,
    intervals: DataFrame,
    block_bp: int = BLOCK_BP,
    broadcast_entries: int = BROADCAST_ENTRIES,
    min_hot_rows: int = 100_000,
    large: str = "sweep",
    cell_bp: int = CELL_BP,
) -> DataFrame:
    """One row per (point, containing set): filters points outside all sets and names the sets.

    The points, which carry the calls, do not move while the index is small enough to
    broadcast. Beyond that their distinct places are swept and the points are shuffled once, by place. With ``large="blocks"`` they are
    shuffled once by block instead; a hot block is cut into parts and only its index rows are repeated, one copy per part.
    """
    if large not in ("sweep", "blocks"):
        raise ValueError("large is 'sweep' or 'blocks'")
    small = index_bound(intervals, block_bp) <= broadcast_entries
    if not small and large == "sweep":
        placed = sweep_membership(points, intervals, cell_bp).withColumnsRenamed({"contig": "_contig", "pos": "_pos"})
        return points.join(placed, (F.col("contig") == F.col("_contig")) & (F.col("pos") == F.col("_pos")), "inner").select(*points.columns, "set_name")
    index = block_index(intervals, block_bp)
    keyed = points.withColumn("_blk", _block(F.col("pos"), block_bp))
    inside = (
        (F.col("contig") == F.col("_contig"))
        & (F.col("_blk") == F.col("_block"))
        & F.col("pos").between(F.col("_from"), F.col("_to"))
    )
    if small:
        joined = keyed.join(F.broadcast(index), inside, "inner")
    else:
        hot = F.broadcast(_hot_blocks(keyed, min_hot_rows))
        parts = F.coalesce(F.col("_parts"), F.lit(1).cast("bigint"))
        plain = [c for c, t in points.dtypes if not t.startswith(("array", "map", "struct"))]
        # The row and its partition, not rand(): a recomputed task sends each row the same way,
        # and equal rows of different partitions still part.
        part = F.pmod(F.xxhash64(*plain, F.spark_partition_id()), parts)
        spread = keyed.join(
            hot, (F.col("contig") == F.col("_hot_contig")) & (F.col("_blk") == F.col("_hot_block")), "left"
        ).select(*keyed.columns, part.alias("_salt"))
        repeated = index.join(
            hot, (F.col("_contig") == F.col("_hot_contig")) & (F.col("_block") == F.col("_hot_block")), "left"
        ).select(*index.columns, F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("_part"))
        joined = spread.join(repeated, inside & (F.col("_salt") == F.col("_part")), "inner")
    return joined.select(*points.columns, "set_name")


def membership(points: DataFrame, intervals: DataFrame, **options) -> DataFrame:
    """Distinct ``(contig, pos, set_name)``: overlapping intervals of a set count a site once."""
    if options.get("large", "sweep") == "sweep" and index_bound(intervals, options.get("block_bp", BLOCK_BP)) > options.get("broadcast_entries", BROADCAST_ENTRIES):
        return sweep_membership(points, intervals, options.get("cell_bp", CELL_BP))
    places = points.select("contig", "pos").distinct()
    return attach_sets(places, intervals, **options)

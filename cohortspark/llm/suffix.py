"""Removal of repeated byte passages by a depth-limited radix sort of suffixes.

Only the first ``WINDOW`` bytes of a suffix matter: a byte goes if a window of that length over it starts anywhere else as
well. Suffixes are told apart digit by digit, most significant first, and leave the sort as soon as they are
alone; the groups still together after the last digit are exactly the repeated windows. Only equality is needed, so a
pass partitions by digit and counts instead of ordering.

The digits are chosen so that neighbouring suffixes share them and travel as one run:

1. the window's least hashed stretch of ``GRAM`` bytes (equal windows have the same one at the same place), for the run of all
   windows that have it; runs whose bytes agree altogether are settled, lone runs are dropped;
2. for what is left, the bytes common to ``STEP`` neighbouring windows;
3. the windows one by one.

A group in which some runs agree and some do not sends one of the agreeing ones on, for the others to meet. The first pass
shuffles about one pair of hashes per 46 bytes, added up on both sides of the shuffle; a filter of fixed size
(``bitmap``) then lets the tasks of a second scan return only runs that are not alone. Past the filter's capacity they
return more, and the exact join drops them. Digits are compared by two independent 64-bit hashes.

Edge cases: a null text is empty; a text shorter than the window keeps all bytes; a row repeated as a whole loses all
bytes when it is long enough, in every copy; ids may be null or repeat. Input columns named like an output column are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm import bitmap
from cohortspark.llm.common import lookup, text_of
from cohortspark.shared import cut_lineage

ADDED = ["n_bytes", "n_removed", "n_spans", "kept", "removed"]
WINDOW, GRAM, STEP = 200, 100, 10
PLACES = WINDOW - GRAM + 1
#: Window starts handled at once, and the bits of a position among them.
_CHUNK, _PLACE_BITS = 1 << 15, 16
_M1, _M2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(32)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _M2)
    h *= _M1
    h ^= h >> _M2
    h *= _M1
    h ^= h >> _M2
    return h


class _Rolling:
    """Hash of any stretch of a buffer, modulo 2**64 over random byte values."""

    def __init__(self, base: int, seed: int, size: int):
        self.values = np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        self.up = np.cumprod(steps)
        steps[1:] = pow(base, -1, 1 << 64)
        self.down = np.cumprod(steps)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=sums[1:])
        return sums

    def of(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (prefix[end] - prefix[start]) * self.down[start]


def _hashes(size: int) -> tuple[_Rolling, _Rolling]:
    return _Rolling(0x9E3779B97F4A7C15, 1, size), _Rolling(0xC2B2AE3D27D4EB4F, 2, size)


def _shape(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where a run's windows lie around its digit."""
    return _mix((low * 1_000 + high).astype(np.uint64) + np.uint64(1))


def _runs(data: np.ndarray, left: np.ndarray, first: _Rolling, second: _Rolling):
    """Runs of windows of ``data``: digit, hash of all their bytes, first and last start, place of the digit.

    ``left`` is the number of bytes from each position to the end of its text.
    """
    grams = len(data) - GRAM + 1
    sums = first.prefix(data)
    digit = _mix((sums[GRAM:] - sums[:-GRAM]) * first.down[:grams])
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    least = np.where(left[:grams] >= GRAM, (digit & ~mask) | np.arange(grams, dtype=np.uint64), ~np.uint64(0))
    width = 1
    while 2 * width <= PLACES:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = PLACES - width
    least = np.minimum(least[: len(least) - rest], least[rest:])
    starts = np.flatnonzero(left[: len(least)] >= WINDOW)
    if not len(starts):
        return None
    places = (least[starts] & mask).astype(np.int64)
    breaks = np.flatnonzero((places[1:] != places[:-1]) | (starts[1:] != starts[:-1] + 1))
    low, high = starts[np.concatenate([[0], breaks + 1])], starts[np.concatenate([breaks, [len(starts) - 1]])]
    place = places[np.concatenate([[0], breaks + 1])]
    whole = _mix(second.of(second.prefix(data), low, high + WINDOW)) ^ _shape(place - high, place - low)
    return digit[place], whole, low, high, place


def _chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of at most ``_CHUNK`` bytes: texts are cut at multiples of it from their own first byte, short neighbours go together.

    So where a run is cut depends on its text alone, not on the rows that share a batch.
    """
    begin = stop = int(offsets[0])
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        for cut in [*range(start + _CHUNK, end, _CHUNK), end]:
            if cut - begin > _CHUNK:
                yield begin, stop
                begin = stop
            stop = cut
    if stop > begin:
        yield begin, stop


def _scan(column: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of a batch of texts: row, digit, whole, then low, high and place counted in the row's text; and the bytes."""
    offsets = np.frombuffer(column.buffers()[1], np.int32 if pa.types.is_binary(column.type) else np.int64)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if offsets[-1] == offsets[0]:
        return
    data = np.frombuffer(column.buffers()[2], np.uint8)
    first, second = _hashes(_CHUNK + WINDOW + 1)
    for begin, stop in _chunks(offsets):
        # Windows that start before ``stop`` may end after it.
        end = min(stop + WINDOW - 1, int(offsets[-1]))
        if end - begin < WINDOW:
            continue
        a, b = np.searchsorted(offsets, begin, "right") - 1, np.searchsorted(offsets, end, "left")
        bounds = np.clip(offsets[a : b + 1], begin, end)
        left = np.repeat(offsets[a + 1 : b + 1], np.diff(bounds)) - np.arange(begin, end)
        found = _runs(data[begin:end], left, first, second)
        if found is not None:
            digit, whole, low, high, place = found
            row = np.searchsorted(offsets, low + begin, "right") - 1
            shift = begin - offsets[row]
            yield row, digit, whole, low + shift, high + shift, place + shift, data, offsets


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _digits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, digit, whole, *_ in _scan(batch.column(0)):
            yield pa.RecordBatch.from_arrays([_long(digit), _long(whole)], ["digit", "whole"])


def _mark(content: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Hash of a run's place, by which the filter of chosen runs knows it again."""
    return _mix(content.view(np.uint64) + _mix(low.astype(np.uint64))).view(np.int64)


def _kept_runs(repeated, size: int):
    """Runs whose digit the filter may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = repeated.value
        for batch in batches:
            content = batch.column(1).to_numpy(zero_copy_only=False)
            for row, digit, whole, low, high, *_ in _scan(batch.column(2)):
                at = np.flatnonzero(bitmap._get(bits, digit.view(np.int64) & np.int64(size - 1)))
                own = pa.array(row[at])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(own), batch.column(1).take(own), _long(digit[at]), _long(whole[at]), pa.array(low[at]), pa.array(high[at]),
                     pa.array(_mark(content[row[at]], low[at]))],
                    ["id", "content", "digit", "whole", "low", "high", "mark"],
                )

    return run


def _near_bytes(chosen, size: int):
    """Bytes under the runs that the filter may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = chosen.value
        for batch in batches:
            content = batch.column(1).to_numpy(zero_copy_only=False)
            for row, digit, _, low, high, place, data, offsets in _scan(batch.column(2)):
                at = np.flatnonzero(bitmap._get(bits, _mark(content[row], low) & np.int64(size - 1)))
                own = pa.array(row[at])
                begin, end = offsets[row[at]] + low[at], offsets[row[at]] + high[at] + WINDOW
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(own), batch.column(1).take(own), pa.array(low[at]), pa.array(place[at]), _long(digit[at]),
                     pa.array([data[x:y].tobytes() for x, y in zip(begin, end)], pa.binary())],
                    ["id", "content", "low", "place", "anchor", "near"],
                )

    return run


def _split(step: int):
    """Runs cut into parts of at most ``step`` windows at fixed distances from their digit, with the part's own digit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = _hashes(3 * WINDOW)
        for batch in batches:
            out = {k: [] for k in ("run", "digit", "whole", "low", "high")}
            for number, low, high, start, place, anchor, near in zip(*(batch.column(k).to_pylist() for k in ("run", "low", "high", "start", "place", "anchor", "near"))):
                data = np.frombuffer(near, np.uint8)
                p, q = first.prefix(data), second.prefix(data)
                # Distance from a window's start to the digit, from the last window to the first.
                near_end, far_end = place - high, place - low
                parts = np.arange(near_end // step, far_end // step + 1)
                a, b = np.maximum(parts * step, near_end), np.minimum(parts * step + step - 1, far_end)
                nearest, farthest = parts * step, np.minimum(parts * step + step - 1, PLACES - 1)
                at = place - start
                common = _mix(first.of(p, at - nearest, at - farthest + WINDOW) + np.uint64(anchor & (1 << 64) - 1)) + parts.astype(np.uint64)
                out["run"].append(np.full(len(parts), number))
                out["digit"].append(common.view(np.int64))
                out["whole"].append((_mix(second.of(q, at - b, at - a + WINDOW)) ^ _shape(a, b)).view(np.int64))
                out["low"].append(place - b)
                out["high"].append(place - a)
            if out["run"]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).astype(np.int64)) for v in out.values()], list(out))

    return run


def _settle(rows: DataFrame, groups: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """One pass: runs now known to be repeated, and runs that need the next digit.

    ``rows`` have digit, whole and ``ref``; ``groups`` the count of rows per digit with the least and greatest whole.
    """
    together = cut_lineage(lookup(rows, groups.filter("n > 1"), ["digit"], "n", total, F.col("ref")).filter("n IS NOT NULL"))
    columns = rows.columns
    alike = together.filter("least = greatest").select(*columns)
    mixed = together.filter("least <> greatest").select(*columns)
    same = mixed.groupBy("digit", "whole").agg(F.count(F.lit(1)).alias("n_same"), F.min("ref").alias("first_ref"))
    judged = cut_lineage(lookup(mixed, same, ["digit", "whole"], "n_same", total, F.col("ref")))
    return (
        alike.union(judged.filter("n_same > 1").select(*columns)),
        judged.filter("n_same = 1 OR ref = first_ref").select(*columns),
    )


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digit").agg(F.count(F.lit(1)).alias("n"), F.min("whole").alias("least"), F.max("whole").alias("greatest"))


def repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = bitmap.MAX_BITS) -> DataFrame:
    """Runs of repeated window starts per text: id, content (hash of the text), low, high."""
    content = F.xxhash64(text_of(text))
    source = docs.select(F.col(key).alias("id"), content.alias("content"), text_of(text).cast("binary").alias("data"))
    kind = source.schema["id"].dataType.simpleString()
    groups = cut_lineage(_groups(source.select("data").mapInArrow(_digits, "digit bigint, whole bigint")).filter("n > 1"))
    spark = docs.sparkSession
    n_groups = groups.count()
    size = bitmap.size_for(n_groups, most=max_bits)
    repeated = bitmap.build(groups.select("digit"), size)
    # A row's own hash tells runs of a group apart; equal texts share it, and so do their results.
    ref = F.xxhash64("id", "content", "low")
    runs = source.mapInArrow(_kept_runs(repeated, size), f"id {kind}, content bigint, digit bigint, whole bigint, low bigint, high bigint, mark bigint").withColumn("ref", ref)
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    settled, chosen = _settle(runs, groups, total)

    chosen = cut_lineage(chosen.select("id", "content", "low", "high", "mark").distinct())
    n_chosen = chosen.count()
    size = bitmap.size_for(n_chosen, bits_per_row=64, most=max_bits)
    wanted = bitmap.build(chosen.select("mark"), size)
    near = source.mapInArrow(_near_bytes(wanted, size), f"id {kind}, content bigint, start bigint, place bigint, anchor bigint, near binary")
    same_text = F.col("c.id").eqNullSafe(F.col("n.id")) & (F.col("c.content") == F.col("n.content")) & (F.col("c.low") == F.col("n.start"))
    # Copies of a row bring the same bytes; one of them is enough.
    open_runs = cut_lineage(
        chosen.alias("c").join(near.alias("n"), same_text).select("c.id", "c.content", "low", "high", "start", "place", "anchor", "near")
        .dropDuplicates(["id", "content", "low"]).withColumn("run", F.monotonically_increasing_id())
    )
    results = [settled.select("id", "content", "low", "high")]
    pending = open_runs.select("run", "low", "high", "start", "place", "anchor", "near")
    for step in (STEP, 1):
        parts = cut_lineage(pending.mapInArrow(_split(step), "run bigint, digit bigint, whole bigint, low bigint, high bigint")).withColumn("ref", F.xxhash64("run", "low"))
        done, left = _settle(parts, _groups(parts), parts.count())
        results.append(done.join(open_runs.select("run", "id", "content"), "run").select("id", "content", "low", "high"))
        pending = left.select("run", "low", "high").join(open_runs.select("run", "start", "place", "anchor", "near"), "run")
    return results[0].union(results[1]).union(results[2])


def _cut(data: bytes, runs: list[dict]) -> tuple[bytes, list[dict]]:
    spans: list[list[int]] = []
    for low, end in sorted((r["low"], r["high"] + WINDOW) for r in runs):
        if spans and low <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([low, end])
    kept, at = [], 0
    for low, end in spans:
        kept.append(data[at:low])
        at = end
    return b"".join([*kept, data[at:]]), [{"start": a, "end": b} for a, b in spans]


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = bitmap.MAX_BITS) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, kept (the bytes left) and removed (byte spans, end exclusive)."""
    docs = docs.drop(*ADDED)
    runs = repeated_runs(docs, key, text, max_bits).groupBy("id", "content").agg(F.collect_set(F.struct("low", "high")).alias("_runs"))

    @F.arrow_udf("struct<kept binary, removed array<struct<start bigint, end bigint>>>")
    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        rows = [_cut(t.as_py(), r.as_py() or []) for t, r in zip(texts, found)]
        spans = pa.array([r[1] for r in rows], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        return pa.StructArray.from_arrays([pa.array([r[0] for r in rows], pa.binary()), spans], ["kept", "removed"])

    joined = docs.withColumn("_content", F.xxhash64(text_of(text))).join(
        runs, F.col(key).eqNullSafe(F.col("id")) & (F.col("_content") == F.col("content")), "left"
    )
    data = text_of(text).cast("binary")
    out = joined.select(*docs.columns, F.octet_length(data).cast("bigint").alias("n_bytes"), cut(data, "_runs").alias("_cut"))
    return out.select(
        *docs.columns, "n_bytes", (F.col("n_bytes") - F.octet_length("_cut.kept")).alias("n_removed"),
        F.size("_cut.removed").cast("bigint").alias("n_spans"), "_cut.kept", "_cut.removed",
    )

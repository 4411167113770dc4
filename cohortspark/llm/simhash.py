"""SimHash near-deduplication by meet-in-the-middle ball hashing.

Two fingerprints at distance 3 or less differ in at most 2 bits outside one of four 16-bit blocks (the one
with most differing bits). So every distinct fingerprint emits, for each block left out, all variants of the other 48
bits within half of that radius, 1 bit; two linked fingerprints meet in at least one variant. Rows are shuffled on
variants; those that collide are verified on all 64 bits, and each variant returns a spanning forest of its verified
links, never all pairs. A variant meets at most 49 * 65,536 distinct fingerprints, so groups are bounded
whatever the data; large ones are linked in linear time by looking up what may differ.

Edge cases: a null, empty or blank text has fingerprint zero and is linked like any other; fewer words than a shingle
make one shingle; rows with equal ids count as documents of their own; null ids never name a component unless it
has no other. An empty table gives an empty one. Input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import lookup, text_of
from cohortspark.llm.components import connected_components
from cohortspark.shared import cut_lineage

ADDED = ["fingerprint", "component_id"]
RADIUS, BLOCKS, BLOCK_BITS = 3, 4, 16
REST_BITS = 64 - BLOCK_BITS
_PIECE = 1 << 20
#: Groups up to this size are compared pair by pair in memory.
_SMALL = 512


def _pieces(data: bytes) -> Iterator[bytes]:
    """``data`` cut at white space, so that a long text needs little memory."""
    start = 0
    while len(data) - start > _PIECE:
        end = start + _PIECE
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield data[start:end]
        start = end
    yield data[start:]


def fingerprint(data: bytes, shingle: int = 3) -> int:
    """64-bit SimHash over word shingles, A-Z lower-cased; a bit is set if more than half of the hashes have it."""
    digest, join = xxhash.xxh64_intdigest, b" ".join
    counts, total, tail = np.zeros(64, np.int64), 0, []
    for piece in _pieces(data):
        words = tail + piece.lower().split()
        if len(words) >= shingle:
            hashes = np.array([digest(join(s), 42) for s in zip(*(words[i:] for i in range(shingle)))], np.uint64)
            counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(hashes)
        tail = words[-(shingle - 1):] if shingle > 1 else []
    if not total:
        return digest(join(tail), 42) if tail else 0
    return int.from_bytes(np.packbits(counts * 2 > total, bitorder="little").tobytes(), "little")


def fingerprints(text: str | Column, shingle: int = 3) -> Column:
    """The fingerprint of a text as a bigint."""

    @F.arrow_udf("bigint")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64).view(np.int64))

    return run(text_of(text).cast("binary"))


def _rest(fps: np.ndarray, block) -> np.ndarray:
    """The 48 bits outside a block."""
    shift = np.uint64(BLOCK_BITS) * np.asarray(block, np.uint64)
    low = fps & ((np.uint64(1) << shift) - np.uint64(1))
    high = np.where(shift == REST_BITS, np.uint64(0), fps >> ((shift + np.uint64(BLOCK_BITS)) & np.uint64(63)))
    return low | (high << shift)


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flips = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(REST_BITS, dtype=np.uint64)])
    for batch in batches:
        own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for k in range(0, len(own), 1_000):
            fps = own[k : k + 1_000]
            for block in range(BLOCKS):
                keys = (_rest(fps, block)[:, None] ^ flips) | np.uint64(block << REST_BITS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(fps, len(flips)).view(np.int64))], ["variant", "fp"]
                )


def _forest(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of a small group: each fingerprint with the first one it is connected to."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= RADIUS
    labels = np.arange(len(fps))
    while True:
        lower = np.where(near, labels[None, :], len(fps)).min(axis=1)
        if (lower == labels).all():
            break
        labels = lower
    moved = np.flatnonzero(labels != np.arange(len(fps)))
    return fps[labels[moved]], fps[moved]


def _large_forest(fps: np.ndarray, key: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for a large group, in linear time.

    Within a variant the bits outside the block differ by at most 2, so members with equal block values are linked, and
    those whose values differ in one bit too. Three differing bits inside the block are a link when nothing else
    differs: two members that equal the variant itself (elsewhere they meet there). Every other link has
    another block to leave out, where it falls under the first two rules.
    """
    block = key >> REST_BITS
    values = (fps >> np.uint64(BLOCK_BITS * block)) & np.uint64((1 << BLOCK_BITS) - 1)
    centre = _rest(fps, block) == np.uint64(key & ((1 << REST_BITS) - 1))
    classes, first, inverse = np.unique(values, return_index=True, return_inverse=True)
    parent = np.arange(len(classes))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(own: np.ndarray, mask: int) -> None:
        other = own ^ np.uint64(mask)
        found = own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other
        for a, b in zip(own[found], other[found]):
            x, y = root(int(np.searchsorted(classes, a))), root(int(np.searchsorted(classes, b)))
            parent[max(x, y)] = min(x, y)

    for bit in range(BLOCK_BITS):
        join(classes, 1 << bit)
    central = np.unique(values[centre])
    for bits in combinations(range(BLOCK_BITS), 3) if len(central) else ():
        join(central, sum(1 << b for b in bits))
    roots = np.array([root(i) for i in range(len(classes))])
    heads = fps[first[roots[inverse]]]
    other = heads != fps
    return heads[other], fps[other]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by variant; the last, perhaps unfinished group of a batch waits for the next."""

    def group(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(starts, len(keys)))
        pairs = starts[sizes == 2]
        x, y = fps[pairs], fps[pairs + 1]
        near = np.bitwise_count(x ^ y) <= RADIUS
        a, b = [x[near]], [y[near]]
        for s, n in zip(starts[sizes > 2], sizes[sizes > 2]):
            own = fps[s : s + n]
            found = _forest(own) if n <= _SMALL else _large_forest(own, int(keys[s]))
            a.append(found[0])
            b.append(found[1])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).view(np.int64)) for v in (a, b)], ["a", "b"])

    keys, fps = [], []
    for batch in batches:
        if not len(batch):
            continue
        own = batch.column(0).to_numpy(zero_copy_only=False)
        last = np.searchsorted(own, own[-1])
        values = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        if keys and (last > 0 or own[0] != keys[-1][-1]):
            cut = last if last > 0 else 0
            yield group(np.concatenate([*keys, own[:cut]]), np.concatenate([*fps, values[:cut]]))
            keys, fps = [], []
            own, values = own[cut:], values[cut:]
        elif last > 0:
            yield group(own[:last], values[:last])
            own, values = own[last:], values[last:]
        keys.append(own)
        fps.append(values)
    if keys:
        yield group(np.concatenate(keys), np.concatenate(fps))


def near_links(distinct: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints (single bigint column, distinct) within ``RADIUS`` bits."""
    variants = distinct.mapInArrow(_variants, "variant bigint, fp bigint")
    return variants.repartition("variant").sortWithinPartitions("variant").mapInArrow(_links, "a bigint, b bigint")


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """A row per row: ``key``, content (hash of the text), fp (bigint fingerprint), component_id (smallest id reachable over links) and root.

    ``root`` names the component by one of its fingerprints.
    """
    table = cut_lineage(docs.select(F.col(key), F.xxhash64(text_of(text)).alias("content"), fingerprints(text, shingle).alias("fp")))
    total = table.count()
    fps = cut_lineage(table.groupBy("fp").agg(F.min(key).alias("first_id"), F.count(F.lit(1)).alias("n")))
    comps = connected_components(near_links(fps.select("fp")))
    rooted = cut_lineage(fps.join(comps, fps.fp == comps.node, "left").select("fp", "first_id", "n", F.coalesce("component", "fp").alias("root")))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("n_fps"))
    named = lookup(rooted, ids, ["root"], "n_fps", total, F.col("fp")).select("fp", "root", "component_id", "n")
    return lookup(table, named, ["fp"], "n", total, F.col(key)).select(key, "content", "fp", "component_id", "root")


def near_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay: of every component the one with the smallest id (then hash of its text).

    Rows equal in id and text are one document and stay or go together.
    """
    found = cut_lineage(components(docs, key, text, shingle))
    order = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), F.col("content").alias("content"))
    first = found.groupBy("root").agg(F.min(order).alias("first")).select(F.col("first.id").alias("_id"), F.col("first.content").alias("_first"))
    content = F.xxhash64(text_of(F.col(text)))
    return docs.join(first, F.col(key).eqNullSafe(F.col("_id")) & (content == F.col("_first")), "left_semi")


def hex_digits(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))

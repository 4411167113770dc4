"""Ranked lexical search: MaxScore whose bounds come from term pairs.

Documents are folded once into the terms that the queries ask for. From that table two kinds of impact lists are computed
before any query runs: one per term and one per pair of terms that stand next to each other in some query's order (lightest term first). A list
keeps the greatest (joint) impact and a floor that ``k`` of its documents reach.

A query's bound for its first j terms is the least sum over all ways to cover them by single terms and neighbouring pairs; a pair's bound is
its joint maximum, or that of either term alone where only one occurs. Terms whose bound stays below the
query's threshold are not essential: no document is looked at for them alone. Documents with an essential term are scored term by term,
heaviest first, and dropped as soon as the bound of what is left cannot lift them to the threshold. The threshold starts at the
best floor of the query's lists and rises with the task's own k best. Skipping is exact: only what stays below k found scores goes.

Tasks keep k documents per query; the bounds, weights and terms of a block of queries (``BLOCK_ENTRIES`` query terms at most,
unless one query alone has more) are what is broadcast, whatever the number of queries or documents.

Edge cases: null, empty or wordless documents are in no count and no result; wordless queries and those whose terms occur nowhere
have no rows; rows with equal query ids are one query with all their terms; rows with equal document ids are documents of their own;
equal scores go by document id, nulls last. Empty tables give an empty one. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cohortspark.llm.common import FOLDED, text_of, words
from cohortspark.shared import cut_lineage

TOP = 50
#: Query terms of all queries that are searched together.
BLOCK_ENTRIES = 1 << 16
# Fixed by the contract: saturation and length terms in thousandths.
SCALE, SATURATION, LENGTH_SHARE = 1_000_000_000, 1_000, 20
#: No impact reaches this (one occurrence or many, whatever the length).
IMPACT_BOUND = SCALE // SATURATION
#: Steps in which a list remembers how many documents reach an impact.
BUCKETS = 32
#: Documents scored together.
_SLICE = 2_048
_PIECE = 1 << 20


def _pieces(data: bytes) -> Iterator[bytes]:
    """``data`` cut at spaces, so that a long text needs little memory."""
    start = 0
    while len(data) - start > _PIECE:
        end = data.find(b" ", start + _PIECE)
        if end < 0:
            break
        yield data[start:end]
        start = end
    yield data[start:]


def _fold(vocabulary: Broadcast, width: int, key_type: pa.DataType):
    """Per document with a term: key, n (all terms), and its query terms (ascending numbers) with their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for batch in batches:
            lengths, held, found = [], [], []
            for text in batch.column(1):
                n = own = 0
                for piece in _pieces(text.as_py().translate(FOLDED)):
                    terms = piece.split()
                    n += len(terms)
                    hits = list(filter(None, map(number, terms)))
                    own += len(hits)
                    found.append(np.array(hits, np.int32))
                lengths.append(n)
                held.append(own)
            lengths = np.array(lengths, np.int64)
            codes = np.repeat(np.arange(len(held)), held) * width + np.concatenate([np.zeros(0, np.int32), *found])
            codes, counts = np.unique(codes, return_counts=True)
            ends = np.searchsorted(codes, np.arange(len(held) + 1) * width).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32))) for v in (codes % width, counts)]
            out = pa.RecordBatch.from_arrays([batch.column(0).cast(key_type), pa.array(lengths), *lists], ["key", "n", "terms", "tfs"])
            yield out.filter(pa.array(lengths > 0))

    return run


@dataclass
class Plan:
    """What a block of queries needs to be scored; entries are (query, term), by query, then weight."""

    weights: np.ndarray
    n_docs: int
    n_terms: int
    starts: np.ndarray
    terms: np.ndarray
    pairs: np.ndarray
    items: list
    bounds: np.ndarray | None = None
    thresholds: np.ndarray | None = None

    @property
    def width(self) -> int:
        return len(self.weights)

    @property
    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.items)), np.diff(self.starts))


def _postings(batch: pa.RecordBatch, plan: Plan) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of documents: first row, ascending codes (row * width + term), terms and weighted impacts."""
    for first in range(0, len(batch), _SLICE):
        part = batch.slice(first, _SLICE)
        n = part.column(1).to_numpy(zero_copy_only=False)
        terms, tfs = (part.column(k).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for k in (2, 3))
        rows = np.repeat(np.arange(len(part)), pc.list_value_length(part.column(2)).to_numpy(zero_copy_only=False))
        m = 50 + (50 * n * plan.n_docs) // plan.n_terms
        values = plan.weights[terms] * ((SCALE * tfs) // (SATURATION * tfs + LENGTH_SHARE * m[rows]))
        yield first, rows * plan.width + terms, terms, values


def _expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each i once per member of range(low[i], high[i]), and the members."""
    sizes = high - low
    rows = np.repeat(np.arange(len(sizes)), sizes)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[rows]


def _at(codes: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of the wanted codes, -1 where there is none."""
    if not len(codes):
        return np.full(len(wanted), -1, np.int64)
    place = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
    return np.where(codes[place] == wanted, values[place], -1)


def _lists(broadcast: Broadcast, k: int):
    """Impacts of the lists in steps: list, bucket, n, least and most impact; a task sends the steps of its own best k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = broadcast.value
        first, second = plan.pairs
        limits = IMPACT_BOUND * np.concatenate([plan.weights, plan.weights[first] + plan.weights[second]])
        n = np.zeros(len(limits) * BUCKETS, np.int64)
        least, most = np.full(len(n), np.iinfo(np.int64).max), np.zeros(len(n), np.int64)
        for batch in batches:
            for _, codes, terms, values in _postings(batch, plan):
                own, pair = _expand(np.searchsorted(first, terms), np.searchsorted(first, terms, "right"))
                other = _at(codes, values, codes[own] - terms[own] + second[pair])
                both = other >= 0
                lists = np.concatenate([terms, plan.width + pair[both]])
                impacts = np.concatenate([values, values[own[both]] + other[both]])
                slots = lists * BUCKETS + (impacts * BUCKETS) // np.maximum(limits[lists], 1)
                order = np.argsort(slots, kind="stable")
                slots, heads = np.unique(slots[order], return_index=True)
                if len(slots):
                    n[slots] += np.diff(np.append(heads, len(order)))
                    least[slots] = np.minimum(least[slots], np.minimum.reduceat(impacts[order], heads))
                    most[slots] = np.maximum(most[slots], np.maximum.reduceat(impacts[order], heads))
        steps = n.reshape(-1, BUCKETS)
        above = steps[:, ::-1].cumsum(axis=1)[:, ::-1] - steps
        sent = np.flatnonzero(((steps > 0) & (above < k)).ravel())
        yield pa.RecordBatch.from_arrays(
            [pa.array((sent // BUCKETS).astype(np.int32)), pa.array((sent % BUCKETS).astype(np.int32)), pa.array(n[sent]), pa.array(least[sent]), pa.array(most[sent])],
            ["list", "bucket", "n", "least", "most"],
        )

    return run


def list_facts(folded: DataFrame, plan: Plan, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Greatest impact of every list, and an impact that k of its documents reach (0 where fewer have it)."""
    sent = folded.sparkSession.sparkContext.broadcast(plan)
    steps = folded.mapInArrow(_lists(sent, k), "list int, bucket int, n bigint, least bigint, most bigint")
    merged = steps.groupBy("list", "bucket").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
    reached = F.sum("n").over(Window.partitionBy("list").orderBy(F.desc("bucket")))
    facts = merged.withColumn("reached", reached).groupBy("list").agg(
        F.max("most").alias("most"), F.coalesce(F.max(F.when(F.col("reached") >= k, F.col("least"))), F.lit(0)).alias("floor")
    )
    most, floor = np.zeros(plan.width + plan.pairs.shape[1], np.int64), np.zeros(plan.width + plan.pairs.shape[1], np.int64)
    # A row per list: no more than twice the block's entries.
    for number, top, low in facts.toLocalIterator():
        most[number], floor[number] = top, low
    sent.destroy()
    return most, floor


def with_bounds(plan: Plan, most: np.ndarray, floor: np.ndarray) -> Plan:
    """Bounds of every query's first terms, and its threshold."""
    first, second = plan.pairs
    bounds, thresholds = np.zeros(len(plan.terms), np.int64), np.ones(len(plan.items), np.int64)
    code = first * plan.width + second
    for q, (a, b) in enumerate(zip(plan.starts, plan.starts[1:])):
        terms = plan.terms[a:b]
        low, high = np.minimum(terms[1:], terms[:-1]), np.maximum(terms[1:], terms[:-1])
        pairs = plan.width + np.searchsorted(code, low * plan.width + high)
        thresholds[q] = max([1, *floor[terms], *floor[pairs]])
        before, last = 0, 0
        for j, term in enumerate(terms):
            bound = last + most[term]
            if j:
                bound = min(bound, before + max(most[pairs[j - 1]], most[terms[j - 1]], most[term]))
            before, last = last, bound
            bounds[a + j] = bound
    plan.bounds, plan.thresholds = bounds, thresholds
    return plan


def _best(broadcast: Broadcast, k: int, key_type: pa.DataType, item_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = broadcast.value
        owners, thresholds = plan.owners, plan.thresholds.copy()
        by_term = np.argsort(plan.terms, kind="stable")
        queries = len(plan.items)
        pool = pa.table({"q": pa.array([], pa.int64()), "score": pa.array([], pa.int64()), "key": pa.array([], key_type)})
        for batch in batches:
            for first, codes, terms, values in _postings(batch, plan):
                # The essential entries now, by term.
                light = plan.bounds < thresholds[owners]
                skipped = np.bincount(owners[light], minlength=queries)
                entries = by_term[~light[by_term]]
                own, entry = _expand(*(np.searchsorted(plan.terms[entries], terms, side) for side in ("left", "right")))
                found, inverse = np.unique((codes[own] // plan.width) * queries + owners[entries[entry]], return_inverse=True)
                # Sums stay below 2**53, where doubles are exact.
                score = np.bincount(inverse, weights=values[own], minlength=len(found)).astype(np.int64)
                row, q = found // queries, found % queries
                place = plan.starts[q] + skipped[q] - 1
                while True:
                    left = place >= plan.starts[q]
                    stay = np.where(left, score + plan.bounds[np.maximum(place, 0)], score) >= thresholds[q]
                    row, q, score, place, left = row[stay], q[stay], score[stay], place[stay], left[stay]
                    if not left.any():
                        break
                    more = _at(codes, values, row * plan.width + plan.terms[np.maximum(place, 0)])
                    score += np.where(left & (more > 0), more, 0)
                    place -= left
                if len(q):
                    keys = batch.column(0).take(pa.array(row + first))
                    pool = pa.concat_tables([pool, pa.table({"q": q, "score": score, "key": keys.cast(key_type)})])
                    pool = pool.take(pc.sort_indices(pool, [("q", "ascending"), ("score", "descending"), ("key", "ascending")]))
                    q = pool["q"].to_numpy()
                    rank = np.arange(len(q)) - np.searchsorted(q, q)
                    last = np.flatnonzero(rank == k - 1)
                    thresholds[q[last]] = np.maximum(thresholds[q[last]], pool["score"].to_numpy()[last])
                    pool = pool.filter(pa.array(rank < k))
        pool = pool.combine_chunks()
        for part in pool.to_batches():
            items = pa.array([plan.items[i] for i in part.column(0).to_pylist()], item_type)
            yield pa.RecordBatch.from_arrays([items, part.column(2), part.column(1)], ["item", "key", "score"])

    return run


def _blocks(wanted: DataFrame, entries: int) -> tuple[DataFrame, int]:
    """Queries dealt to blocks, none over ``entries`` query terms unless a single query is."""
    total, queries = wanted.agg(F.count(F.lit(1)), F.countDistinct(F.struct("item"))).first()
    n = max(1, -(-total // entries))
    while True:
        dealt = wanted.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(n)))
        if n == 1 or n > 4 * queries:
            return dealt, n
        if dealt.groupBy("block").count().agg(F.max("count")).first()[0] <= entries:
            return dealt, n
        n *= 2


def _search_block(docs: DataFrame, wanted: list, item_type: pa.DataType, k: int) -> DataFrame:
    """The k best documents per task and query; ``wanted`` holds (item, term) of one block."""
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    vocabulary = {t.encode(): i + 1 for i, t in enumerate(sorted({t for _, t in wanted}))}
    width, kind = len(vocabulary) + 1, docs.schema["key"].dataType
    known, key_type = sc.broadcast(vocabulary), to_arrow_type(kind)
    folded = cut_lineage(docs.mapInArrow(_fold(known, width, key_type), f"key {kind.simpleString()}, n bigint, terms array<int>, tfs array<int>"))
    known.destroy()
    n_docs, n_terms = folded.agg(F.count(F.lit(1)), F.sum("n")).first()
    hits = f"item {item_type[1]}, key {kind.simpleString()}, score bigint"
    if not n_docs:
        return spark.createDataFrame([], hits)
    df = np.zeros(width, np.int64)
    for number, n in folded.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1))).toLocalIterator():
        df[number] = n
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) for n in df], np.int64)
    # A query's terms from the lightest on; terms in no document add nothing.
    items = sorted({i for i, _ in wanted}, key=lambda i: (i is None, i))
    place = {item: q for q, item in enumerate(items)}
    entries = sorted((place[i], int(weights[v]), v) for i, t in wanted for v in [vocabulary[t.encode()]] if df[v])
    q = np.array([e[0] for e in entries], np.int64)
    terms = np.array([e[2] for e in entries], np.int64)
    starts = np.searchsorted(q, np.arange(len(items) + 1))
    beside = q[1:] == q[:-1]
    low, high = np.minimum(terms[1:], terms[:-1])[beside], np.maximum(terms[1:], terms[:-1])[beside]
    pairs = np.unique(low * width + high)
    plan = Plan(weights, n_docs, n_terms, starts, terms, np.array([pairs // width, pairs % width]), items)
    sent = sc.broadcast(with_bounds(plan, *list_facts(folded, plan, k)))
    found = cut_lineage(folded.mapInArrow(_best(sent, k, key_type, item_type[0]), hits))
    sent.destroy()
    return found


def search(
    docs: DataFrame, items: DataFrame, k: int = TOP, key: str = "doc_id", text: str = "text", item: str = "item_id", query: str = "text",
    block_entries: int = BLOCK_ENTRIES,
) -> DataFrame:
    """``item``, rank, ``key`` and score of the k best documents of every query."""
    wanted = cut_lineage(items.select(F.col(item).alias("item"), F.explode(words(query)).alias("term")).distinct())
    own = docs.select(F.col(key).alias("key"), text_of(text).cast("binary").alias("text"))
    kind = wanted.schema["item"].dataType
    dealt, n = _blocks(wanted, block_entries)
    found = None
    for block in range(n):
        rows = [(r.item, r.term) for r in dealt.filter(F.col("block") == block).select("item", "term").toLocalIterator()]
        if rows:
            hits = _search_block(own, rows, (to_arrow_type(kind), kind.simpleString()), k)
            found = hits if found is None else found.union(hits)
    if found is None:
        found = docs.sparkSession.createDataFrame([], f"item {kind.simpleString()}, key {own.schema['key'].dataType.simpleString()}, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")

"""Periodic runs of words, by the branching-tandem test on an enhanced suffix array.

The words of a document are sorted as suffixes (prefix doubling), which gives the suffix array, its inverse and the lengths of
common prefixes. Every LCP interval of depth d is visited through the suffixes of all its children but the largest: when the
suffix d words before or after lies in another child of the interval (looked up in the inverse array), the two start a branching square
of period d, which no word extends to the right. Squares are rotated to the left as far as the period holds; squares
that end together and lie in a run of a divisor of their period belong to that run. No tree is built: intervals are pairs of nearest smaller values.

Documents of an Arrow batch are treated as one array in which words of different documents are different symbols, so that
numpy does the work for many short documents at once; a longer document is an array of its own. Nothing is shuffled. A task holds one array: ``_GROUP`` words,
or one document, at about 150 bytes a word.

Edge cases: null and blank texts have no words and no run; texts shorter than a run have none; rows with equal ids are documents of their own; an empty
table gives an empty one. Input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import text_of

ADDED = ["runs", "n_words", "collapsed_text"]
MIN_LENGTH = 12
#: Words of short documents that share an array.
_GROUP = 1 << 17
_JUMPS = 32


def _suffixes(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and the ranks of all suffixes by their first 1, 2, 4, ... symbols; the last are the inverse array."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int32)
    # A rank is the number of smaller suffixes, so that ranks of finished suffixes never change.
    counts = np.bincount(rank)
    rank = (np.cumsum(counts) - counts).astype(np.int32)[rank]
    order = np.argsort(rank, kind="stable").astype(np.int32)
    ranks, step = [rank], 1
    while True:
        # Only groups of equal rank are sorted again.
        sorted_ranks = rank[order]
        same = np.zeros(n + 1, bool)
        same[1:n] = sorted_ranks[1:] == sorted_ranks[:-1]
        open_ = np.flatnonzero(same[:-1] | same[1:])
        if not len(open_):
            return order, ranks
        suffixes = order[open_]
        behind = suffixes.astype(np.int64) + step
        second = np.where(behind < n, rank[np.minimum(behind, n - 1)], -1).astype(np.int64)
        codes = rank[suffixes].astype(np.int64) * (n + 1) + second + 1
        again = np.argsort(codes, kind="stable")
        suffixes, codes = suffixes[again], codes[again]
        order[open_] = suffixes
        # A new group starts where the code changes; its rank is its place.
        fresh = np.concatenate([[True], codes[1:] != codes[:-1]])
        rank = rank.copy()
        rank[suffixes] = open_[np.maximum.accumulate(np.where(fresh, np.arange(len(open_)), 0))]
        ranks.append(rank)
        step *= 2


def _common(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of suffixes a and b, from the ranks of their doublings."""
    n = len(ranks[0])
    a, b = a.astype(np.int64), b.astype(np.int64)
    length = np.zeros(len(a), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        inside = (a < n) & (b < n)
        equal = inside & (ranks[k][np.minimum(a, n - 1)] == ranks[k][np.minimum(b, n - 1)])
        step = np.where(equal, 1 << k, 0)
        a, b, length = a + step, b + step, length + step
    return length


def _nearest(values: np.ndarray, strict: bool) -> np.ndarray:
    """For each positive place the last one before it with a smaller (or, not ``strict``, an equal) value; place 0 is not positive.

    Pointers jump over what is larger; the few that have still not landed after ``_JUMPS`` rounds are found with a stack.
    """
    near = np.arange(len(values)) - 1
    todo = np.flatnonzero(values > 0)
    for _ in range(_JUMPS):
        there = values[near[todo]]
        todo = todo[(there >= values[todo]) if strict else (there > values[todo])]
        if not len(todo):
            return near
        near[todo] = near[near[todo]]
    stack, wanted, plain = [], set(todo.tolist()), values.tolist()
    for i, v in enumerate(plain):
        while stack and (plain[stack[-1]] >= v if strict else plain[stack[-1]] > v):
            stack.pop()
        if i in wanted:
            near[i] = stack[-1]
        stack.append(i)
    return near


def _squares(order: np.ndarray, ranks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of all branching squares."""
    n, isa = len(order), ranks[-1].astype(np.int64)
    lcp = np.full(n + 1, -1, np.int64)  # of the suffixes at j - 1 and j; -1 at both ends
    if n > 1:
        lcp[1:n] = _common(ranks, order[:-1], order[1:])
    # Stretches of the suffix array without a common word hold no interval: only the others are looked at.
    border = np.flatnonzero(lcp > 0)
    if not len(border):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kept = np.unique(np.concatenate([border - 1, border, border + 1]))
    depth = np.where(lcp[kept] > 0, lcp[kept], -1)
    low, equal_low = _nearest(depth, True), _nearest(depth, False)
    back = depth[::-1]
    last = len(depth) - 1
    high, equal_high = last - _nearest(back, True)[::-1], last - _nearest(back, False)[::-1]
    inner = np.flatnonzero(depth > 0)
    # Children: the one left of every border, and the one right of an interval's last border.
    final = inner[equal_high[inner] == high[inner]]
    owner = np.concatenate([inner, final])
    child_low = kept[np.concatenate([equal_low[inner], final])]
    child_high = kept[np.concatenate([inner, high[final]])]
    interval_low, interval_high, d = kept[low[owner]], kept[high[owner]], depth[owner]
    sizes = child_high - child_low
    # By interval, the largest child first: it is left out.
    by = np.lexsort((-sizes, interval_high, interval_low))
    a, b = interval_low[by], interval_high[by]
    largest = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    small = by[~largest]
    child_low, child_high, interval_low, interval_high, d, sizes = (v[small] for v in (child_low, child_high, interval_low, interval_high, d, sizes))
    rows = np.repeat(np.arange(len(small)), sizes)
    suffix = order[np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + child_low[rows]].astype(np.int64)
    starts, periods = [], []
    for sign in (1, -1):
        other = suffix + sign * d[rows]
        inside = (other >= 0) & (other < n)
        at = isa[np.clip(other, 0, n - 1)]
        hit = inside & (at >= interval_low[rows]) & (at < interval_high[rows]) & ((at < child_low[rows]) | (at >= child_high[rows]))
        starts.append(np.minimum(suffix, other)[hit])
        periods.append(d[rows][hit])
    return np.concatenate(starts), np.concatenate(periods)


def _left_of(symbols: np.ndarray, start: int, period: int) -> int:
    """How far the period reaches to the left of a square."""
    at, step = start, 64
    while at > 0:
        low = max(0, at - step)
        differ = np.flatnonzero(symbols[low:at] != symbols[low + period : at + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        at, step = low, step * 2
    return 0


def find_runs(symbols: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Start, length and smallest period of all runs of at least ``min_length`` symbols and two periods, by start, then period."""
    if len(symbols) < max(2, min_length):
        return np.zeros((0, 3), np.int64)
    order, ranks = _suffixes(symbols)
    starts, periods = _squares(order, ranks)
    del order, ranks
    # Short squares must be part of something longer; the few words before them tell.
    for back in range(1, min_length - 1):
        need = 2 * periods + back <= min_length
        before = np.maximum(starts - back, 0)
        whole = (starts >= back) & (symbols[before] == symbols[np.minimum(before + periods, len(symbols) - 1)])
        stay = ~need | whole
        starts, periods = starts[stay], periods[stay]
    ends = starts + 2 * periods
    found, at, here = set(), -1, []
    for k in np.lexsort((periods, ends)):
        start, period, end = int(starts[k]), int(periods[k]), int(ends[k])
        if end != at:
            at, here = end, []
        if any(period % p == 0 and s <= start for s, p in here):
            continue
        begin = _left_of(symbols, start, period)
        here.append((begin, period))
        if end - begin >= min_length:
            found.add((begin, end - begin, period))
    return np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def _kept(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words are left when every run keeps its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:n]) == 0


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


def _collapse(texts: list[list[bytes]], min_length: int) -> Iterator[tuple[list[dict], bytes]]:
    """Runs and what is left of each text; the texts share one array."""
    numbers = _Numbers()
    sizes = np.array([len(w) for w in texts], np.int64)
    ids = np.fromiter((numbers[w] for t in texts for w in t), np.int64, int(sizes.sum()))
    found = find_runs(np.repeat(np.arange(len(texts)), sizes) * max(1, len(numbers)) + ids, min_length)
    ends = np.cumsum(sizes)
    cuts = np.searchsorted(found[:, 0], np.concatenate([[0], ends]))
    for k, own in enumerate(texts):
        runs = found[cuts[k] : cuts[k + 1]] - [ends[k] - sizes[k], 0, 0]
        if len(runs):
            own = [w for w, stays in zip(own, _kept(len(own), runs).tolist()) if stays]
        yield [{"start": s, "length": n, "period": p} for s, n, p in runs.tolist()], b" ".join(own)


def _run(min_length: int):
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    kind = pa.struct([("runs", pa.list_(run_type)), ("n_words", pa.int64()), ("collapsed_text", pa.string())])

    def groups(texts: pa.Array) -> Iterator[list[list[bytes]]]:
        waiting, total = [], 0
        for text in texts:
            own = text.as_py().split()
            if waiting and total + len(own) > _GROUP:
                yield waiting
                waiting, total = [], 0
            waiting.append(own)
            total += len(own)
        if waiting:
            yield waiting

    @F.arrow_udf("struct<runs array<struct<start bigint, length bigint, period bigint>>, n_words bigint, collapsed_text string>")
    def run(texts: pa.Array) -> pa.Array:
        out = []
        for group in groups(texts):
            for own, (runs, left) in zip(group, _collapse(group, min_length)):
                out.append({"runs": runs, "n_words": len(own), "collapsed_text": left.decode()})
        return pa.array(out, kind)

    return run


def periodic_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` with runs (by start, then period), n_words and collapsed_text: the words without the repetitions, joined by spaces."""
    found = docs.withColumn("_runs", _run(min_length)(text_of(text).cast("binary")))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ADDED], "_runs.*")

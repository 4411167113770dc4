"""Sequence packing by Karmarkar-Karp multiway differencing.

Documents become token ids followed by an end id. Whole windows are cut off the front of a document; the rest is cut
into a few near-equal pieces. Blocks of pieces are then split into windows by multiway differencing: the two
partial partitions with the largest imbalances are merged, the fullest windows of one with the emptiest of the
other, until one partition is left. When one of its windows exceeds the capacity, the window count
rises and the block is done again.

A task packs its own documents, block by block, so nothing is shuffled and memory holds one block. Sequence ids
combine the partition with a counter; a task that runs again gives the same rows.

Edge cases: a null or empty text is the end id alone; a special token that a text spells out is that token; equal rows are packed like any others; a partition without rows has
no sequence.
"""

from __future__ import annotations

import heapq
import json
import sys
import types
from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import text_of

CAPACITY, END_ID = 1024, 0
#: Rests are cut into pieces of at most this many ids.
PIECE = 256
#: Pieces packed together.
BLOCK = 2_048
#: How byte-level vocabularies spell a byte: printable ones as themselves, the others, in order, from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SPELLED = {chr(b): b for b in _PRINTABLE} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}
# Fixed value: how byte-level tokenizers cut a text into words.
_WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


def _byte_level(spec: dict):
    """The same tokenizer as a ``tiktoken`` encoding, several times as fast; None where the description has more than it can say.

    Ids in the order of the merges are ranks, so equal vocabularies give equal ids.
    """
    model, cut, added = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("added_tokens", [])
    plain = (
        model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True) and not spec.get("normalizer")
        and not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    own = {t["content"] for t in added}
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in own}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ids = [vocabulary.get(a + b) for a, b in merges]
    if not plain or None in ids or ids != sorted(set(ids)) or len(ids) + 256 != len(vocabulary) or any(c not in _SPELLED for t in vocabulary for c in t):
        return None
    import tiktoken

    ranks = {bytes(_SPELLED[c] for c in t): i for t, i in vocabulary.items()}
    return tiktoken.Encoding("byte_level", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={t["content"]: t["id"] for t in added})


class _Encoder:
    """Ids of whole texts, as the plain call of the tokenizer gives them: spelled-out special tokens are those tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.fast = _byte_level(json.load(file))
        if self.fast is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        if self.fast is not None:
            return [self.fast.encode_to_numpy(t, allowed_special="all").astype("<u4", copy=False).tobytes() for t in texts]
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _encoder(path: str) -> _Encoder:
    """One per worker process, kept from task to task."""
    state = sys.modules.setdefault("_packing_state", types.ModuleType("_packing_state"))
    if getattr(state, "path", None) != path:
        state.path, state.encoder = path, _Encoder(path)
    return state.encoder


def difference(sizes: np.ndarray, windows: int) -> np.ndarray:
    """Window of each piece after multiway differencing into ``windows`` windows.

    A partial partition is its non-empty windows, emptiest first: their sums and their numbers. Its imbalance is that of the
    fullest and the emptiest window. Windows that meet get a new number; in the end the numbers are followed back.
    """
    met_from, met_to, counter = [], [], len(sizes)
    heap = [(-int(s), i, [int(s)], [i]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, a, ids_a = heapq.heappop(heap)
        _, tie, b, ids_b = heapq.heappop(heap)
        if len(a) < len(b):
            a, ids_a, b, ids_b = b, ids_b, a, ids_a
        shared = len(a) + len(b) - windows
        if len(b) == 1:
            # The commonest case: one piece joins a partition, in its emptiest window.
            total, number = b[0], ids_b[0]
            if shared > 0:
                total += a.pop(0)
                met_from += [ids_a.pop(0), number]
                met_to += [counter, counter]
                number = counter
                counter += 1
            place = bisect(a, total)
            a.insert(place, total)
            ids_a.insert(place, number)
        else:
            shared = max(0, shared)
            pairs = [*zip(a[shared:], ids_a[shared:]), *zip(b[shared:], ids_b[shared:])]
            # The emptiest ``shared`` windows of one meet those of the other, small with large.
            for x, i, y, j in zip(a[:shared], ids_a[:shared], reversed(b[:shared]), reversed(ids_b[:shared])):
                pairs.append((x + y, counter))
                met_from += [i, j]
                met_to += [counter, counter]
                counter += 1
            pairs.sort()
            a, ids_a = [x for x, _ in pairs], [i for _, i in pairs]
        heapq.heappush(heap, (-(a[-1] - (a[0] if len(a) == windows else 0)), tie, a, ids_a))
    owner = [-1] * counter
    for window, number in enumerate(heap[0][3]):
        owner[number] = window
    for own, to in zip(reversed(met_from), reversed(met_to)):
        owner[own] = owner[to]
    return np.array(owner[: len(sizes)])


def pack_block(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Window of each piece, no window over ``capacity``."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        owner = difference(sizes, windows)
        if np.bincount(owner, weights=sizes).max() <= capacity:
            return owner
        windows += 1


def _cuts(n: int, capacity: int, piece: int) -> Iterator[tuple[int, int]]:
    """Start and length of the pieces of a document of ``n`` ids: whole windows, then near-equal parts."""
    whole = n - n % capacity
    for start in range(0, whole, capacity):
        yield start, capacity
    parts = -(-(n - whole) // piece)
    for k in range(parts):
        a, b = whole + (n - whole) * k // parts, whole + (n - whole) * (k + 1) // parts
        yield a, b - a


def _pack(path: str, capacity: int, piece: int, key_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, partition = _encoder(path), TaskContext.get().partitionId()
        end, sequence = np.array([END_ID], "<u4").tobytes(), partition << 33
        whole, parts = [], []

        def rows(found):
            """``found``: (key, start, ids, document's ids, sequence, offset)."""
            key, start, ids, total, seq, offset = zip(*found)
            return pa.RecordBatch.from_arrays(
                [pa.array(key, key_type), pa.array(start, pa.int64()), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(total, pa.int64()), pa.array(seq, pa.int64()), pa.array(offset, pa.int64())],
                ["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        def packed():
            nonlocal sequence, parts
            sizes = np.array([len(p[2]) // 4 for p in parts])
            owner = pack_block(sizes, capacity)
            filled, out = np.zeros(owner.max() + 1, np.int64), []
            for p, w, n in zip(parts, owner, sizes):
                out.append((*p, sequence + int(w), int(filled[w])))
                filled[w] += n
            sequence += len(filled)
            parts = []
            return rows(out)

        for batch in batches:
            for k in range(0, len(batch), 64):
                keys, texts = (batch.column(c).slice(k, 64).to_pylist() for c in (0, 1))
                for key, ids in zip(keys, encoder.encode(texts)):
                    ids += end
                    n = len(ids) // 4
                    for start, length in _cuts(n, capacity, piece):
                        part = (key, start, ids[4 * start : 4 * (start + length)], n)
                        if length == capacity:
                            whole.append((*part, sequence, 0))
                            sequence += 1
                        else:
                            parts.append(part)
                        if len(parts) == BLOCK:
                            yield packed()
                        if len(whole) == BLOCK:
                            yield rows(whole)
                            whole = []
        if whole:
            yield rows(whole)
        if parts:
            yield packed()

    return run


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY, piece: int = PIECE) -> DataFrame:
    """Pieces of all documents: ``key``, start, length, ids (binary, little-endian 32-bit), doc_tokens, sequence_id, offset."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    own = docs.select(F.col(key), text_of(text))
    kind = own.schema[0].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = f"key {kind.simpleString()}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    return own.mapInArrow(_pack(path, capacity, piece, to_arrow_type(kind)), schema).withColumnRenamed("key", key)

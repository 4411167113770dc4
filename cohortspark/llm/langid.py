"""Language identification with error-correcting output codes.

Every language gets a codeword of bits; one binary n-gram classifier per bit tells the languages with a 1
from those with a 0. A text is scored by all classifiers, and loss-weighted decoding picks the language
whose codeword is nearest; when the runner-up is about as near, the text is flagged ambiguous.

Training is one aggregation over all labelled texts: hashed byte trigrams per language, added up per task and
summed in the shuffle. What reaches the driver is ``BUCKETS`` counts per language, however large the corpus. The classifiers
follow from the counts in closed form (log odds of the mean trigram distributions of both sides).

Edge cases: a null text or one without a letter is ``und`` with score 0; so is every text when nothing was learned; with
one learned language everything else is that language. Input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ADDED = ["lang_pred", "score", "ambiguous"]
BUCKETS = 1 << 15
UNKNOWN = "und"
_SLICE = 1 << 21
#: ASCII bytes that are no lower-case letter become a space.
_FOLD = np.array([c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256)], np.uint8)


def _grams(data: np.ndarray) -> np.ndarray:
    """Bucket of the trigram at each position but the last two."""
    folded = _FOLD[data].astype(np.uint32)
    code = (folded[:-2] << np.uint32(16)) | (folded[1:-1] << np.uint32(8)) | folded[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - 15)


def _slices(texts: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Texts side by side: their indexes, the trigram buckets and where each text begins.

    A text longer than a slice comes in several.
    """
    index, parts, size = [], [], 0

    def flush():
        grams = _grams(np.frombuffer(b"".join(parts), np.uint8))
        starts = np.cumsum([0, *(len(p) for p in parts[:-1])])
        return index, grams, starts

    for i, text in enumerate(texts):
        data = b" " + text.lower().encode("utf-8", "replace") + b" "
        for k in range(0, len(data) - 2, _SLICE):
            piece = data[k : k + _SLICE + 2]
            if parts and size + len(piece) > _SLICE:
                yield flush()
                index, parts, size = [], [], 0
            index.append(i)
            parts.append(piece)
            size += len(piece)
    if parts:
        yield flush()


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums per text, without the trigrams that reach into the next text."""
    ends = np.append(starts[1:] - 2, len(values))
    bounds = np.stack([starts, ends], axis=1).ravel()
    padded = np.concatenate([values, np.zeros((1, *values.shape[1:]), values.dtype)])
    return np.add.reduceat(padded, bounds, axis=0)[::2]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        by_lang: dict[str, list[str]] = {}
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            total = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for _, grams, starts in _slices(texts):
                keep = np.ones(len(grams), bool)
                keep[np.concatenate([starts[1:] - 1, starts[1:] - 2])] = False
                total += np.bincount(grams[keep], minlength=BUCKETS)
    for lang, total in totals.items():
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used)), pa.array(used.astype(np.int32)), pa.array(total[used])], ["lang", "bucket", "n"])


def codewords(k: int, seed: int = 1) -> np.ndarray:
    """One row of +1/-1 per language: the exhaustive code up to 7 languages, else the best of random dense codes."""
    if k <= 7:
        columns = max(1, 2 ** (k - 1) - 1)
        return np.array([[1 if i == 0 or (c >> (i - 1)) & 1 else -1 for c in range(columns)] for i in range(k)])
    rng, best = np.random.default_rng(seed), None
    for _ in range(100):
        code = rng.choice([-1, 1], size=(k, 15 * int(np.ceil(np.log2(k)))))
        code = code[:, np.abs(code.sum(axis=0)) < k]
        distance = min((code[i] != code[j]).sum() for i in range(k) for j in range(i))
        if best is None or distance > best[0]:
            best = (distance, code)
    return best[1]


class Model:
    """Weights per trigram bucket and bit, the code, and how far each classifier can be trusted."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        shares = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
        self.code = codewords(len(languages))
        ones = np.maximum(self.code, 0).T / np.maximum(self.code > 0, 0).sum(axis=0)[:, None]
        zeros = np.maximum(-self.code, 0).T / np.maximum((self.code < 0).sum(axis=0), 1)[:, None]
        weights = np.log(ones @ shares) - np.log(np.maximum(zeros @ shares, 1e-12)) if len(languages) > 1 else np.zeros((1, BUCKETS))
        margins = self.code * (shares @ weights.T)
        scale = np.maximum(np.abs(margins).mean(axis=0), 1e-9)
        self.weights = (weights / scale[:, None]).T.astype(np.float32).copy()
        trust = np.maximum((margins / scale).min(axis=0), 0.05)
        self.trust = trust / trust.sum()

    def losses(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Weighted exponential loss of every codeword, a row per text."""
        margins = sums / np.maximum(counts, 1)[:, None]
        return (self.trust * np.exp(np.clip(-self.code[None] * margins[:, None, :], -8, 8))).sum(axis=2)


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """A model from all rows with a label; None when there are none."""
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    counts = rows.mapInArrow(_count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(counts.column("lang").to_pylist()))
    if not languages:
        return None
    table = np.zeros((len(languages), BUCKETS))
    at = {name: i for i, name in enumerate(languages)}
    table[[at[x] for x in counts.column("lang").to_pylist()], counts.column("bucket").to_numpy()] = counts.column("n").to_numpy()
    return Model(languages, table)


def identify(docs: DataFrame, model: Model | None, text: str = "text", sharpness: float = 4.0, margin: float = 0.1) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and ambiguous: the two nearest codewords are within ``margin``."""
    docs = docs.drop(*ADDED)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred string, score double, ambiguous boolean>")
    def run(texts: pa.Array) -> pa.Array:
        own, model = texts.to_pylist(), shared.value
        known = [i for i, t in enumerate(own) if model and t is not None and any(map(str.isalpha, t))]
        names, scores, unsure = [UNKNOWN] * len(own), np.zeros(len(own)), np.zeros(len(own), bool)
        if known:
            sums, counts = np.zeros((len(known), model.weights.shape[1])), np.zeros(len(known))
            for index, grams, starts in _slices([own[i] for i in known]):
                np.add.at(sums, index, _sums(model.weights[grams], starts))
                np.add.at(counts, index, np.append(starts[1:] - 2, len(grams)) - starts)
            losses = model.losses(sums, counts)
            order = np.argsort(losses, axis=1, kind="stable")
            best = np.take_along_axis(losses, order[:, :1], axis=1)
            scores[known] = 1 / np.exp(-sharpness * (losses - best)).sum(axis=1)
            if losses.shape[1] > 1:
                unsure[known] = np.take_along_axis(losses, order[:, 1:2], axis=1)[:, 0] - best[:, 0] < margin
            for i, k in zip(known, order[:, 0]):
                names[i] = model.languages[k]
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores), pa.array(unsure)], ["lang_pred", "score", "ambiguous"])

    return docs.withColumn("_lang", run(F.col(text))).select(*docs.columns, "_lang.lang_pred", "_lang.score", "_lang.ambiguous")

"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations alone.

A window is ``window`` consecutive words of a benchmark item (a shorter item is one window). Seen as the set
of its word shingles, a window lies in a document only if every one of them does, so the join needs a
prefix of one shingle per window: the rarest in the corpus. Its place in the window gives the only
place where the window can start (position bound), the document's word count whether it fits (length
bound), and the words themselves decide.

Nothing of the documents is shuffled but counts of benchmark shingles and the hits. The windows are broadcast in
blocks of at most ``block`` windows, each block one pass over the documents, so a benchmark of any size
fits.

Edge cases: null and word-free texts have no words, no hits; a word-free item has no window; repeated items
and rows count like single ones, per row; a null item id hits words but is not listed. Input columns named like an output
column are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import text_of, words
from cohortspark.shared import cut_lineage

ADDED = ["n_words", "n_hit", "n_items", "item_ids", "contaminated"]
#: Words in a shingle; a window of fewer words is one shingle.
SHINGLE = 3


def _shingle(array: str, at: Column, size: int) -> Column:
    """Hash of ``size`` words from position ``at`` (from 0)."""
    return F.xxhash64(F.lit(size), *[F.get(array, at + i) for i in range(size)])


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = 10) -> DataFrame:
    """Distinct windows: their words and the ids of the items that have them."""
    parts = benchmark.select(F.col(item).cast("string").alias("item"), words(text).alias("w")).filter("size(w) > 0")
    at = parts.withColumn("start", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))))
    return at.select("item", F.slice("w", F.col("start") + 1, F.lit(window)).alias("window")).groupBy("window").agg(F.collect_set("item").alias("items"))


def _tokens(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """Every shingle of every document of the sizes in use; rows live inside one task only."""
    at = docs.select("id", "content", "w", F.posexplode("w").alias("pos", "_word"))
    fits = F.size("w") - F.col("pos")
    hashes = [F.when(fits >= s, _shingle("w", F.col("pos"), s)) for s in sizes]
    token = F.explode(F.array(*hashes)) if len(hashes) > 1 else hashes[0]
    return at.select("id", "content", "w", "pos", token.alias("token"))


def _hits(docs: DataFrame, prefixes: DataFrame, sizes: list[int]) -> DataFrame:
    """Verified windows per document: id, content, start, length and items."""
    start = F.col("pos") - F.col("offset")
    length = F.size("window")
    # Compared word by word: the slice is made only for what passed both bounds.
    return (
        _tokens(docs, sizes).join(F.broadcast(prefixes), "token")
        .filter((start >= 0) & (start + length <= F.size("w")))
        .filter(F.slice("w", F.greatest(start, F.lit(0)) + 1, length) == F.col("window"))
        .select("id", "content", start.alias("start"), length.alias("length"), "items")
    )


def _covered(spans: Column) -> Column:
    """Words under the union of spans sorted by start."""
    step = F.aggregate(
        spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["start"] + s["length"] - F.greatest(a["end"], s["start"]))).alias("n"),
            F.greatest(a["end"], s["start"] + s["length"]).alias("end"),
        ),
    )
    return step["n"]


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = 10, block: int = 200_000,
) -> DataFrame:
    """``docs`` with n_words, n_hit (words under windows), n_items, item_ids (sorted as text) and contaminated."""
    docs = docs.drop(*ADDED)
    content = F.xxhash64(text_of(text))
    found = cut_lineage(windows(benchmark, item, item_text, window))
    n, *lengths = [found.count(), *(r[0] for r in found.select(F.least(F.size("window"), F.lit(SHINGLE))).distinct().collect())]
    counted = docs.withColumn("n_words", F.regexp_count(text_of(text), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("bigint"))
    none = F.expr("CAST(array() AS ARRAY<STRING>)")
    if not n:
        return counted.withColumns({"n_hit": F.lit(0).cast("bigint"), "n_items": F.lit(0).cast("bigint"), "item_ids": none, "contaminated": F.lit(False)})
    sizes = sorted(lengths)
    corpus = docs.select(F.col(key).alias("id"), content.alias("content"), words(text).alias("w"))
    blocks = -(-n // block)
    offsets = found.withColumns({
        "part": F.pmod(F.xxhash64("window"), F.lit(blocks)),
        "offset": F.explode(F.sequence(F.lit(0), F.greatest(F.size("window") - SHINGLE, F.lit(0)))),
    }).withColumn("token", F.coalesce(*[F.when(F.size("window") >= s, _shingle("window", F.col("offset"), s)) for s in reversed(sizes)]))

    # Rarity over the whole corpus, for the benchmark's shingles.
    def corpus_counts(k: int) -> DataFrame:
        own = offsets.filter(F.col("part") == k).select("token").distinct()
        return _tokens(corpus, sizes).join(F.broadcast(own), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n_corpus"))

    counts = reduce(DataFrame.union, [corpus_counts(k).withColumn("part", F.lit(k)) for k in range(blocks)])
    # A shingle that the corpus lacks rules its window out.
    ranked = offsets.join(counts, ["token", "part"], "left").groupBy("window", "part").agg(
        F.first("items").alias("items"), F.min(F.struct(F.coalesce("n_corpus", F.lit(0)).alias("n"), "offset", "token")).alias("rarest")
    )
    prefixes = cut_lineage(ranked.filter("rarest.n > 0").select("window", "part", "items", "rarest.offset", "rarest.token"))
    hits = reduce(DataFrame.union, [
        _hits(corpus, prefixes.filter(F.col("part") == k).drop("part"), sizes) for k in range(blocks)
    ])
    per_doc = hits.groupBy("id", "content").agg(
        F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")
    ).select("id", "content", _covered(F.col("spans")).cast("bigint").alias("n_hit"), F.array_sort("items").alias("item_ids"))
    return (
        counted.withColumn("_content", content)
        .join(per_doc, F.col(key).eqNullSafe(F.col("id")) & (F.col("_content") == F.col("content")), "left")
        .select(
            *counted.columns, F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce(F.size("item_ids").cast("bigint"), F.lit(0)).alias("n_items"),
            F.coalesce("item_ids", none).alias("item_ids"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )

"""Line deduplication in DataFrame operations alone.

Lines are exploded as digests of their normalised form, documents are counted per digest, and the
positions of the lines to drop come back to the documents, which are put together from what is left.
Only digests, never lines, are shuffled by line; the texts move once, by document.

Edge cases: a null or empty text is one empty line; keys shorter than ``min_points`` are never dropped;
every row is a document of its own, also when ids repeat or are null; a text that loses all lines
becomes empty. Input columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import SPACE, ascii_lower, lookup, text_of
from cohortspark.shared import cut_lineage

ADDED = ["n_lines", "n_dropped", "kept_text"]


def _digests(text: str, min_points: int) -> Column:
    """One digest per line, null where the key is too short to be dropped."""

    def one(line: Column) -> Column:
        key = F.btrim(line, F.lit(SPACE))
        return F.when(F.char_length(key) >= min_points, F.md5(key.cast("binary")))

    return F.transform(F.split(ascii_lower(text_of(text)), "\n"), one)


def _without(lines: Column, dropped: Column) -> Column:
    """The lines between the sorted dropped positions; linear in both."""
    starts = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda p: p + 1))
    ends = F.concat(dropped, F.array(F.size(lines)))
    return F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 1, b - a)))


def line_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = 10, min_points: int = 1) -> DataFrame:
    """``docs`` with n_lines (before dropping), n_dropped and kept_text.

    Lines whose key (stripped, A-Z lower-cased) is found in ``min_docs`` documents or more go from all of them.
    """
    docs = docs.drop(*ADDED)
    content = F.xxhash64(text_of(text))
    keyed = cut_lineage(docs.select(F.col(key).alias("id"), content.alias("content"), _digests(text, min_points).alias("digests")))
    total = keyed.agg(F.coalesce(F.sum(F.size("digests")), F.lit(0))).first()[0]
    frequent = (
        keyed.select(F.explode(F.array_distinct("digests")).alias("digest")).filter("digest IS NOT NULL")
        .groupBy("digest").agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") >= min_docs)
    )
    places = keyed.select("id", "content", F.posexplode("digests").alias("pos", "digest")).filter("digest IS NOT NULL")
    dropped = (
        lookup(places, frequent, ["digest"], "n_docs", total, F.struct("content", "pos")).filter("n_docs IS NOT NULL")
        .groupBy("id", "content").agg(F.array_sort(F.collect_set("pos")).alias("_dropped"))
    )
    lines = F.split(text_of(text), "\n")
    none = F.expr("CAST(array() AS ARRAY<INT>)")
    return (
        docs.withColumn("_content", content)
        .join(dropped, F.col(key).eqNullSafe(F.col("id")) & (F.col("_content") == F.col("content")), "left")
        .withColumn("_dropped", F.coalesce("_dropped", none))
        .select(
            *docs.columns, F.size(lines).cast("bigint").alias("n_lines"), F.size("_dropped").cast("bigint").alias("n_dropped"),
            F.when(F.size("_dropped") == 0, text_of(text)).otherwise(F.array_join(_without(lines, F.col("_dropped")), "\n")).alias("kept_text"),
        )
    )

"""Exact deduplication by two-pass Bloom filtering.

The first pass over the texts sets one bit per hash in a filter of fixed size and keeps the slots hit
twice. The second pass sends on every row whose slot was hit once: no other row has its text. Only
the others, possibly repeated, are shuffled and grouped by the SHA-256 of their text.

Past the filter's capacity (``bitmap.MAX_BITS`` / 16, 67 million rows) more unique rows take the shuffle, with
the same result. Edge cases: a null text counts as empty and equals any text of white space only; of
rows equal in text, length and id exactly one is kept; null ids lose ties against any id. An empty table gives an
empty table. Input columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.llm import bitmap
from cohortspark.llm.common import lookup, text_of
from cohortspark.shared import cut_lineage

ADDED = ["keep_id", "group_size", "kept", "text_sha256"]
#: Fixed by the contract: what is deleted before texts are compared.
IGNORED = r"[\x20\x09-\x0D]+"


def digest(text: str) -> Column:
    """SHA-256 of the text without white space, lower-case hex."""
    return F.sha2(F.regexp_replace(text_of(text), IGNORED, "").cast("binary"), 256)


def with_digests(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with what decides: the digest and the length of the original text in code points."""
    return docs.drop(*ADDED, "_points").withColumns({"text_sha256": digest(text), "_points": F.char_length(text_of(text))})


def resolve(digested: DataFrame, key: str = "doc_id", max_bits: int = bitmap.MAX_BITS) -> DataFrame:
    """One row per row of ``with_digests``: its columns, keep_id, group_size, kept."""
    columns = [c for c in digested.columns if c not in ("text_sha256", "_points")]
    size = bitmap.size_for(digested.count(), most=max_bits)
    hashed = digested.withColumn("_hash", F.xxhash64("text_sha256"))
    repeated = bitmap.build(hashed.select("_hash"), size, twice=True)
    flagged = hashed.withColumn("_maybe", bitmap.hit(repeated, size, F.col("_hash")))
    passed = flagged.filter(~F.col("_maybe")).select(
        *columns, F.col(key).alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    # Stored once, so that the row numbers are the same for every later reader.
    suspects = cut_lineage(
        flagged.filter("_maybe").select(*columns, "text_sha256", "_points", F.monotonically_increasing_id().alias("_row"))
    )
    groups = suspects.groupBy("text_sha256").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct((-F.col("_points")).alias("p"), F.col(key).isNull().alias("none"), F.col(key).alias("id"), F.col("_row").alias("row"))).alias("_first"),
    )
    joined = lookup(suspects, groups, ["text_sha256"], "group_size", suspects.count(), F.col("_row"))
    decided = joined.select(
        *columns, F.col("_first.id").alias("keep_id"), "group_size", (F.col("_row") == F.col("_first.row")).alias("kept"), "text_sha256"
    )
    return passed.unionByName(decided)


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with keep_id, group_size, kept and text_sha256; every row comes back."""
    return resolve(with_digests(docs, text), key)

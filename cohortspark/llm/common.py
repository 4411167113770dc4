"""Column expressions and joins shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed by the contracts: white space, and the characters that end a word.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Every byte that ends a word as a space, A-Z as a-z: what is left between spaces are words of letters, digits and non-ASCII characters.
FOLDED = bytes(b if b >= 128 else (ord(chr(b).lower()) if chr(b).isalnum() else 32) for b in range(256))

#: A key is hot when it has more than one row in this many; so there are fewer hot keys than this.
HOT_SHARE = 1_000


def text_of(column: str | Column) -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(column, UPPER, LOWER)


def words(column: str) -> Column:
    """Words of a text: runs of digits, ASCII letters (lower-cased) and all non-ASCII characters."""
    return F.filter(F.split(ascii_lower(text_of(column)), NOT_WORD), lambda w: w != "")


def hot_limit(rows: int) -> int:
    """More rows than this make a key hot."""
    return max(HOT_SHARE, rows // HOT_SHARE)


def lookup(rows: DataFrame, facts: DataFrame, keys: Sequence[str], size: str, total: int, spread: Column) -> DataFrame:
    """Left join of ``facts`` (one row per key, non-null keys) to ``rows``, safe for hot keys.

    ``size`` is the column of ``facts`` with the number of ``rows`` that have the key, ``total`` the number of
    all rows. At most ``HOT_SHARE`` keys can be hot, so those facts are broadcast; their rows get a
    scattered key in the shuffle that serves all the others. ``spread`` is any column that differs
    between rows. Every column of ``facts`` but the keys is added.
    """
    added = [c for c in facts.columns if c not in keys]
    limit = hot_limit(total)
    hot = facts.filter(F.col(size) > limit).select(*keys, *[F.col(c).alias(f"_hot_{c}") for c in added], F.lit(True).alias("_hot"))
    # Not a literal: the optimizer would take a constant out of the join keys, and the rows of a hot key would meet again.
    zero = F.when(F.col(size) < 0, 1).otherwise(0).cast("bigint")
    cold = facts.filter(F.col(size) <= limit).select(*keys, *[F.col(c).alias(f"_cold_{c}") for c in added], zero.alias("_scatter"))
    marked = rows.join(F.broadcast(hot), list(keys), "left").withColumn(
        "_scatter", F.when(F.col("_hot"), F.shiftrightunsigned(F.xxhash64(spread), 1) + 1).otherwise(F.lit(0).cast("bigint"))
    )
    return marked.join(cold, [*keys, "_scatter"], "left").select(
        *rows.columns, *[F.when(F.col("_hot"), F.col(f"_hot_{c}")).otherwise(F.col(f"_cold_{c}")).alias(c) for c in added]
    )

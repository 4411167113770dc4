"""A training corpus from raw documents: stages over whole tables, each stored before the next.

``STAGES`` lists (name, function) pairs; a function takes (spark, docs, sf_dir) and returns what its stage keeps, with the
columns of documents. The last one returns packed token sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.llm import decontam, exact, langid, packing, simhash
from cohortspark.llm.queries import held_out
from cohortspark.shared import cut_lineage

#: A document is rejected when its language is less likely than all others together.
MIN_SCORE = 0.5


def _narrow(docs: DataFrame) -> DataFrame:
    """Id and text, with all other columns in one, where no operator's names can clash with theirs."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others or [F.lit(0).alias("none")]).alias("_others"))


def _widen(narrow: DataFrame, columns: list[str]) -> DataFrame:
    return narrow.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"_others.`{c}`").alias(c) for c in columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a clear language; with no labels to learn from, all of them."""
    model = langid.train(docs.filter(~held_out()))
    if model is None:
        return docs
    found = langid.identify(_narrow(docs), model)
    return _widen(found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE)), docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group of equal texts."""
    return _widen(exact.exact_dedup(_narrow(docs)).filter("kept"), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every component of texts whose SimHash fingerprints differ in three bits or fewer."""
    return _widen(simhash.near_dedup(_narrow(docs)), docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without a window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _widen(decontam.decontaminate(_narrow(docs), benchmark).filter(~F.col("contaminated")), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of what is left, with their places in sequences of 1024."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Fingerprints, learned languages and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""Tab-separated label tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# What label tables write for a missing label.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
    "None", "n/a", "nan", "null",
)


def label(column: Column) -> Column:
    """A label, NULL where it is one of the words for a missing one. Ids are never read this way."""
    return F.when(~column.isin(*MISSING), column)


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """A TSV with header; every column as text, so an id such as ``007`` keeps its zeros."""
    return spark.read.csv(path, sep="\t", header=True, inferSchema=False)


def _label(df: DataFrame, id_column: str, label_column: str, name: str) -> DataFrame:
    return df.select(
        F.col(f"`{id_column}`").cast("string").alias("sample_id"), label(F.col(f"`{label_column}`")).alias(name)
    )


def read_ancestry(
    spark: SparkSession, path: str, id_column: str = "research_id", ancestry_column: str = "ancestry_pred_other"
) -> DataFrame:
    """``(sample_id, ancestry)``; all other columns are pruned at the scan."""
    return _label(read_tsv(spark, path), id_column, ancestry_column, "ancestry")


def read_groups(
    spark: SparkSession, path: str, group_column: str, id_column: str = "research_id"
) -> DataFrame:
    """``(sample_id, grp)``."""
    return _label(read_tsv(spark, path), id_column, group_column, "grp")

"""Helpers shared by the operators: words, written intermediates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine.session import scratch_path

#: A run of the ASCII white space that separates words.
WORD_GAP = r"[\x20\x09-\x0D]+"


def body(text: Column | str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text in order (maximal runs of other characters)."""
    return F.array_remove(F.split(text, WORD_GAP), "")


def let(value: Column, use) -> Column:
    """Evaluate ``value`` once and hand it to ``use`` as a variable."""
    return F.element_at(F.transform(F.array(value), use), 1)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written below the shared folder and read again:
    a lost executor then costs one table read, not the whole lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

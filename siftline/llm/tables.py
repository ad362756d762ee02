"""Reading the given tables, and tables written between steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path

# A word is a run of anything but ASCII space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write rows below the shared folder and read them back.

    Later steps then read columns of a fixed copy: nothing is computed twice, and
    a lost executor changes nothing.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str | Column) -> Column:
    """Null texts count as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, GAP), lambda w: w != "")


def n_words_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")

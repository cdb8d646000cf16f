"""Word and line expressions, row keys, and the tables that the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = " \t\n\x0b\f\r"
#: Everything in ASCII that is neither a digit nor a lower-case letter parts words.
ITEM_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE_SEPARATORS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case and nothing else. Texts of ASCII alone take the quick way; both give the same."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def item_words(c: Column) -> Column:
    """Words of digits, letters and all that is not ASCII, A-Z in lower case. Null has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(c, F.lit(""))), ITEM_SEPARATORS), "")


def space_words(c: Column) -> Column:
    """Words between white space, as they stand. Null has none."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), SPACE_SEPARATORS), "")


def bind(value: Column, body) -> Column:
    """body(value), with value worked out once however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def positions(n: Column) -> Column:
    """0 to n - 1; empty where n is 0 or less."""
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))


def row_key(*columns: Column) -> Column:
    """A key of what the row holds. Rows that repeat share it, and get the same result."""
    parts = [F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns]
    return F.md5(F.concat_ws("\x01", *parts))


def written(df: DataFrame, *partition_by: str) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends here, and lost executors recompute nothing above."""
    path = shared_folder(df.sparkSession)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

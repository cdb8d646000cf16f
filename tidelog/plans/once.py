"""Computing a costly expression once per row, and a costly table once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.session import shared_folder


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed in one place only.

    A plain ``withColumn`` is copied into every later expression that uses it, and into filters pushed below it, so
    a regular expression or a parse would run several times per row. A generated row (a one-element array, inlined)
    is a border the copies do not cross; filters on other columns still pass through it.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def materialised(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read again.

    For tables that several branches of a plan read: what is above runs once, whatever reads the result, and a lost
    executor does not bring it back.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

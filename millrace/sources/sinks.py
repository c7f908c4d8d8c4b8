"""Sinks. Every one returns the written data read back, so that callers can check it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_text(df: DataFrame, path: str, sep: str = "\t") -> DataFrame:
    """One line per row, columns joined with ``sep``."""
    df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns]).alias("value")).write.text(path)
    return df.sparkSession.read.text(path)


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ";", header: bool = True) -> DataFrame:
    df.write.option("sep", sep).option("header", header).csv(path)
    return df.sparkSession.read.schema(df.schema).option("sep", sep).option("header", header).csv(path)


def chart_rows(df: DataFrame, name: str, first: str, age: str) -> DataFrame:
    """Rows of a script chart: ``,['name',first,age]``."""
    return df.select(F.format_string(",['%s',%s,%s]", F.col(name), F.col(first).cast("string"),
                                     F.col(age).cast("string")).alias("value"))

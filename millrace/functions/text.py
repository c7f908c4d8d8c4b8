"""Line and word splitting, and file-name parsing, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def lines_of(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """One row per line of a text column."""
    return df.select(*keep, F.explode(F.split(column, "\n", -1)).alias("line"))


def words_of(df: DataFrame, column: str = "line", *keep: str) -> DataFrame:
    """One row per word, split on single blanks.

    Trailing blanks make no words, inner double blanks make an empty word, a line of blanks
    makes none and an empty line makes one empty word.
    """
    body = F.rtrim(F.col(column))
    tokens = df.where((body != "") | (F.col(column) == ""))
    return tokens.select(*keep, F.explode(F.split(body, " ", -1)).alias("word"))


def blank_separated(df: DataFrame, column: str = "line", *keep: str) -> DataFrame:
    """One row per non-empty token between blanks and tabs."""
    return (df.select(*keep, F.explode(F.split(column, "[ \t]")).alias("word"))
            .where(F.length("word") > 0))


def whitespace_tokens(df: DataFrame, column: str = "line", *keep: str) -> DataFrame:
    """One row per token between runs of white space; trailing white space makes no token."""
    return df.select(*keep, F.explode(F.split(F.regexp_replace(column, r"\s+$", ""), r"\s+")).alias("word"))


def file_extension(name: Column) -> Column:
    """Text after the last dot, or ``undef`` without a dot."""
    return F.when(F.contains(name, F.lit(".")), F.element_at(F.split(name, r"\."), -1)).otherwise(F.lit("undef"))


def filename_timestamp(name: Column) -> Column:
    """Timestamp held in parts 5 (yyyyMMdd) and 6 (HHmmss) of a file name, else null.

    Parts are separated by any of colon, underscore, dot, hyphen or blank and the name must
    have at least seven.
    """
    parts = F.split(name, "[:_. -]", -1)
    day, clock = F.get(parts, F.lit(5)), F.get(parts, F.lit(6))
    usable = (F.size(parts) >= 7) & day.rlike("^[0-9]{8}$") & clock.rlike("^[0-9]{6}$")
    return F.when(usable, F.try_to_timestamp(F.concat_ws(" ", day, clock), F.lit("yyyyMMdd HHmmss"))
                  .cast("timestamp_ntz"))


def page_view(line: Column) -> Column:
    """Tab-separated ``url status zip user`` as a struct."""
    part = F.split(line, "\t")
    return F.struct(part[0].alias("url"), part[1].try_cast("int").alias("status"),
                    part[2].try_cast("bigint").alias("zip"), part[3].try_cast("bigint").alias("user_id"))

"""Array and vector helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F


def parse_vector(text: Column, sep: str = " ") -> Column:
    """Separated numbers as a dense vector."""
    return array_to_vector(F.transform(F.split(F.trim(text), sep), lambda x: x.cast("double")))


def labelled_point(text: Column) -> list[Column]:
    """``label,f1 f2 ...`` as label and dense vector."""
    part = F.split(text, ",", 2)
    return [part[0].cast("double").alias("label"), parse_vector(part[1]).alias("features")]


def libsvm_line(label: Column, features: Column) -> Column:
    """``label 1:x1 2:x2 ...`` from a label and an array of numbers."""
    cells = F.transform(features, lambda x, i: F.concat_ws(":", (i + 1).cast("string"), x.cast("string")))
    return F.concat_ws(" ", label.cast("string"), F.array_join(cells, " "))


def spread(df: DataFrame, vector: str, names: Sequence[str], *keep: str, digits: int = 6) -> DataFrame:
    """A vector column as one rounded double column per position."""
    array = df.select(*keep, vector_to_array(F.col(vector)).alias("_a"))
    return array.select(*keep, *[F.round(F.col("_a")[i], digits).alias(n) for i, n in enumerate(names)])

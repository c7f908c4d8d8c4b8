"""Sources: text, delimited, vector, LIBSVM and Parquet files, listings and catalog tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.vectors import labelled_point, parse_vector


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("line"))


def read_ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place: file, start of the split and a number rising inside the split.

    (file, split, pos) orders the lines of a file of any size without reading it in one task.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"))


def read_log_folders(spark: SparkSession, path: str) -> DataFrame:
    """Lines of logs that lie in folders ``file=<name>`` below ``path``, each cut into part files in the order of their names.

    (file, split, pos) orders a log's lines: ``split`` is the part file's name and the offset of the range read from it,
    so large parts are read by many tasks.
    """
    return spark.read.text(path).select(
        F.col("file").cast("string").alias("file"),
        F.concat_ws("#", "_metadata.file_name", F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0")).alias("split"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"))


def read_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """LIBSVM points. Give the training width when reading a test file."""
    reader = spark.read.format("libsvm")
    if num_features:
        reader = reader.option("numFeatures", str(num_features))
    return reader.load(path)


def read_delimited(spark: SparkSession, path: str, sep: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("sep", sep).option("mode", "FAILFAST").csv(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(parse_vector(F.col("value")).alias("features"))


def read_labelled_points(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(*labelled_point(F.col("value")))


def in_memory_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def file_inventory(spark: SparkSession, root: str, name_contains: str = "") -> DataFrame:
    """Every file below ``root`` whose name contains the text. File contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .load(root).where(F.element_at(F.split("path", "/"), -1).contains(name_contains))
            .select("path", "length", "modificationTime"))


def catalog_table(spark: SparkSession, name: str, rows: DataFrame, location: str) -> DataFrame:
    """Create the table if it is missing, load it and return it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{location}'")
    rows.write.mode("overwrite").insertInto(name)
    return spark.table(name)


def temp_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)

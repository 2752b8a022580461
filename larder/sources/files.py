"""Scans of CSV, JSON and image files with the catalogue's notions of a missing value."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts that a table reader with default settings takes for missing.
NA_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
    "NaN", "None", "n/a", "nan", "null",
)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reads."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _texts(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None) -> DataFrame:
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def csv_default_na(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed columns; any of NA_TEXTS is null, and so is what the type cannot hold."""
    raw = _texts(spark, path, schema.names)
    clean = {f.name: F.when(~F.col(f.name).isin(*NA_TEXTS), F.col(f.name)).try_cast(f.dataType) for f in schema}
    return raw.select([c.alias(n) for n, c in clean.items()])


def csv_empty_na(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Texts; only the empty field is null."""
    return _texts(spark, path, columns)


def csv_texts(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Texts; an empty field is an empty text."""
    return _texts(spark, path, columns).na.fill("")


def csv_if_there(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """As csv_texts; no rows where there is no file."""
    if exists(spark, path):
        return csv_texts(spark, path, columns)
    return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def csv_union(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All files that are there, by column name; a column that a file lacks is null."""
    there = [_texts(spark, p, None) for p in paths if exists(spark, p)]
    if not there:
        raise FileNotFoundError(f"none of {list(paths)} is there")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), there)


def json_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A file that holds one JSON object; one row of nulls where there is no file."""
    if exists(spark, path):
        return spark.read.schema(schema).option("multiLine", True).json(path)
    return spark.createDataFrame([tuple(None for _ in schema)], schema)


def image_files(spark: SparkSession, path: str) -> DataFrame:
    """Images of a folder, by name: path, size, and the content's md5."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.{png,PNG,jpg,JPG,jpeg,JPEG}").load(path)
    return found.select("path", F.col("length").alias("size"), F.md5("content").alias("md5"))

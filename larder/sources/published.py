"""Documents and tables that readers see whole: the old version or the new one, never a mixture.

    path/versions/<digest>/part-...    a version's files, named by what they hold
    path/current/<number>-<digest>     an empty file for each publication; the last one counts

A version is written beside the others and then published by one small file, so a
write that fails leaves the old version. Content that is published already is
neither written nor published again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.sources.files import exists


def _names(spark: SparkSession, folder: str) -> list[str]:
    if not exists(spark, folder):
        return []
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in store.listStatus(target))


def _publications(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    return sorted((int(n), d) for n, _, d in (x.partition("-") for x in _names(spark, f"{path}/current")) if n.isdigit())


def digest(df: DataFrame) -> str:
    """A text that two DataFrames share if they have the same columns and rows, in any order, repeats counted.

    Sums of hashes of rows, combined in each task: one row leaves it.
    """
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    low, high = F.conv(F.substring(F.sha2(row, 256), 1, 15), 16, 10).cast("decimal(38,0)"), F.conv(F.substring(F.sha2(row, 256), 16, 15), 16, 10).cast("decimal(38,0)")
    n, a, b = df.agg(F.count("*"), F.coalesce(F.sum(low), F.lit(0)), F.coalesce(F.sum(high), F.lit(0))).first()
    return df.sparkSession.range(1).select(F.md5(F.lit(f"{df.schema.simpleString()}:{n}:{int(a)}:{int(b)}"))).first()[0]


def publish(df: DataFrame, path: str, write: Callable[[DataFrame, str], None] | None = None) -> bool:
    """Make the rows the current version of `path`; False if they are that already.

    write: writes a DataFrame to a folder, as Parquet where none is given. The
    current version and the one before it stay; older ones go.
    """
    spark = df.sparkSession
    name = digest(df)
    done = _publications(spark, path)
    if done and done[-1][1] == name:
        return False
    place = f"{path}/versions/{name}"
    if not exists(spark, f"{place}/_SUCCESS"):
        (write or (lambda d, at: d.write.mode("overwrite").parquet(at)))(df, place)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/current/{done[-1][0] + 1 if done else 0}-{name}")
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # of two writers of one number one fails here, and has published nothing
    store.create(target, False).close()
    keep = {name, *(d for _, d in done[-1:])}
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    for n, d in done[:-1]:
        store.delete(fs.Path(f"{path}/current/{n}-{d}"), True)
    for d in _names(spark, f"{path}/versions"):
        if d not in keep:
            store.delete(fs.Path(f"{path}/versions/{d}"), True)
    return True


def current_path(spark: SparkSession, path: str) -> str:
    """The folder of the current version."""
    done = _publications(spark, path)
    if not done:
        raise FileNotFoundError(f"nothing is published at {path}")
    return f"{path}/versions/{done[-1][1]}"


def json_lines(df: DataFrame, path: str) -> None:
    """A writer for publish(): one JSON document a line, null fields written out."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def rewrite(df_of: Callable[[DataFrame], DataFrame], path: str, read: Callable[[str], DataFrame], spark: SparkSession, write: Callable[[DataFrame, str], None] | None = None) -> bool:
    """Change the published rows by a function of them; False, with no file written, if they come out as they were."""
    return publish(df_of(read(current_path(spark, path))), path, write)

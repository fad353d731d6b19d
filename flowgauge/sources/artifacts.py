"""Paths, importance tables and stored models."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the name under which a cleaned flow table is looked for.
CLEANED_FILE = "cicids2017_cleaned.csv"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _system(path: str):
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file:///"):
        path = path.replace("file:/", "file:///", 1)
    return fs.FileSystem.from_uri(path)


def open_file(path: str):
    """A seekable file by URI, from any task."""
    system, name = _system(path)
    return system.open_input_file(name)


def create_file(path: str):
    """A new file by URI for any task to write; its folder is there."""
    system, name = _system(path)
    return system.open_output_stream(name)


def write_file(spark: SparkSession, path: str, content: bytes) -> str:
    """A small file written by the driver; returns its full URI, which ``open_file`` takes in any task."""
    found = _path(spark, path)
    system = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = system.create(found, True)
    try:
        out.write(content)
    finally:
        out.close()
    return system.makeQualified(found).toString()


def exists(spark: SparkSession, path: str) -> bool:
    """True when the path, or a match of the glob, is there."""
    found = _path(spark, path)
    system = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    matches = system.globStatus(found)
    return matches is not None and len(matches) > 0


def require(spark: SparkSession, path: str, what: str) -> str:
    if not exists(spark, path):
        raise FileNotFoundError(f"{what} not found at {path}; train and save it first")
    return path


def write_importance(table: DataFrame, path: str) -> None:
    table.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_importance(spark: SparkSession, path: str) -> DataFrame:
    require(spark, path, "importance table")
    found = spark.read.csv(path, header=True, schema="feature string, importance double")
    return found.orderBy(F.col("importance").desc(), "feature")

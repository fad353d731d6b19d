"""Flow tables from CSV folders."""

import csv
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cleaning import clean
from ..schemas import LABEL, RAW_LABEL
from .artifacts import CLEANED_FILE, exists, open_file

TEXT_COLUMNS = (LABEL, RAW_LABEL, "Flow ID", "Source IP", "Src IP", "Destination IP", "Dst IP", "Timestamp")
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday"]
ORDER = ["_day", "_file", "_block", "_row"]
HEADER_BYTES = 1 << 16


def _first_line(source) -> str:
    """A file's first line, however long."""
    line = b""
    while b"\n" not in line and (part := source.read(HEADER_BYTES)):
        line += part
    return line.split(b"\n", 1)[0].decode("latin-1").rstrip("\r")


def _headers(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """(file, column names) of every CSV file under a path, by file name.

    One job reads the first line of each file. Names are trimmed, and a
    repeated name gets a numeric suffix.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).select("path")

    def first_lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            lines = []
            for name in frame["path"]:
                with open_file(name) as f:
                    lines.append(_first_line(f))
            yield pd.DataFrame({"path": frame["path"], "line": lines})

    found = []
    for row in listed.mapInPandas(first_lines, "path string, line string").orderBy("path").collect():
        seen, names = {}, []
        for name in (c.strip() for c in next(csv.reader([row.line]), [])):
            n = seen.get(name, 0)
            seen[name] = n + 1
            names.append(f"{name}.{n}" if n else name)
        found.append((row.path, names))
    return found


def read_flow_csvs(spark: SparkSession, folder: str, schema: T.StructType | None = None, with_order: bool = False) -> DataFrame:
    """All CSV files of a folder as one table, with latin-1 text and trimmed names.

    Columns are DOUBLE except the label and address columns, unless a schema is
    given; no value is inferred. Files with another header are read with their
    own and united by name. ``with_order`` adds day, file, block and row, which
    together give the order in the files: weekdays first, by file name.
    """
    if not exists(spark, f"{folder.rstrip('/')}/*.csv"):
        raise FileNotFoundError(f"no CSV files in {folder}")
    by_header: dict[tuple, list[str]] = {}
    for path, names in _headers(spark, folder):
        by_header.setdefault(tuple(names), []).append(path)
    table = None
    for names, paths in by_header.items():
        kinds = {f.name: f.dataType for f in schema.fields} if schema else {}
        fields = T.StructType([
            T.StructField(c, kinds.get(c, T.StringType() if c in TEXT_COLUMNS else T.DoubleType())) for c in names
        ])
        part = spark.read.csv(paths, schema=fields, header=True, encoding="ISO-8859-1", positiveInf="Infinity",
                              negativeInf="-Infinity", nanValue="NaN", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
        if with_order:
            file = F.col("_metadata.file_name")
            day = F.lit(len(DAYS))
            for i, name in enumerate(DAYS):
                day = F.when(F.lower(file).contains(name.lower()), i).otherwise(day)
            part = part.withColumns({
                "_day": day, "_file": file, "_block": F.col("_metadata.file_block_start"),
                "_row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
            })
        table = part if table is None else table.unionByName(part, allowMissingColumns=True)
    return table


def read_flows(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaned file when there is one, else all files cleaned."""
    ready = f"{folder.rstrip('/')}/{CLEANED_FILE}"
    if exists(spark, ready):
        names = _headers(spark, ready)[0][1]
        fields = T.StructType([T.StructField(c, T.StringType() if c in TEXT_COLUMNS else T.DoubleType()) for c in names])
        return spark.read.csv(ready, schema=fields, header=True)
    return clean(read_flow_csvs(spark, folder))

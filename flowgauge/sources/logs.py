"""Alert and audit logs as JSON lines, and the whitelist file."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ALERT_JSON, AUDIT_JSON
from .artifacts import exists

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
LISTS = ("shap_contributions", "top_features")


def _tolerant(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with blank and broken lines left out and unreadable times NULL."""
    if not exists(spark, path):
        rows = spark.createDataFrame([], schema)
    else:
        kept = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
        read = spark.read.schema(kept).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
        rows = read.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    return rows.withColumn("timestamp", F.try_to_timestamp("timestamp"))


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Alerts, newest first. Contribution maps become (feature, value) arrays in logged order."""
    rows = _tolerant(spark, path, ALERT_JSON)
    rows = rows.withColumns({
        c: F.transform(F.map_entries(c), lambda e: F.struct(e["key"].alias("feature"), e["value"].alias("value")))
        for c in LISTS
    })
    return rows.orderBy(F.col("timestamp").desc_nulls_last())


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return _tolerant(spark, path, AUDIT_JSON)


def alert_rows(alerts: DataFrame) -> DataFrame:
    """Alerts in logged form: known fields in order, ISO times, contribution maps."""
    have = [f.name for f in ALERT_JSON.fields if f.name in alerts.columns]
    shaped = {"timestamp": F.date_format("timestamp", ISO)}
    for c in LISTS:
        if c in have:
            shaped[c] = F.map_from_entries(c)
    return alerts.select(*have).withColumns(shaped)


def write_alerts(alerts: DataFrame, path: str) -> None:
    """Append alerts as JSON lines; absent values are left out of a line."""
    alert_rows(alerts).write.mode("append").json(path)


def write_audit(audit: DataFrame, path: str) -> None:
    rows = audit.select(F.date_format("timestamp", ISO).alias("timestamp"), "action", "ip", "reason")
    rows.write.mode("append").json(path)


def stream_alerts(alerts: DataFrame, path: str, checkpoint: str):
    """Append a stream of alerts as JSON lines; the checkpoint makes restarts exact."""
    return alert_rows(alerts).writeStream.format("json").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint
    )


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """One ``ip`` per line, trimmed; blank lines and # comments are dropped. No file, no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], "ip string")
    lines = spark.read.text(path).select(F.trim("value").alias("ip"))
    return lines.filter((F.col("ip") != "") & ~F.col("ip").startswith("#")).distinct()

"""Operations reports over alert and audit tables. ``now`` is always given."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import lead_feature, percent_text
from ..schemas import ANOMALY

BLOCKS = ("BLOCK", "BLOCK_DRYRUN")
UNBLOCKS = ("UNBLOCK", "UNBLOCK_DRYRUN")


def _at(now) -> Column:
    return F.lit(now).cast("timestamp")


def alert_kpis(alerts: DataFrame, now) -> DataFrame:
    """Totals for the header row; zeros when there are no alerts."""
    fresh = F.col("timestamp") >= _at(now) - F.expr("INTERVAL 5 MINUTES")
    anomaly = F.col("attack_type") == ANOMALY
    return alerts.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("severity") == "HIGH").alias("high_severity"),
        F.coalesce(F.avg(F.when(fresh & ~anomaly, F.col("confidence"))), F.lit(0.0)).alias("avg_confidence"),
        F.count_distinct("attack_type").alias("attack_types"),
        F.coalesce(F.date_format(F.max("timestamp"), "HH:mm:ss"), F.lit("—")).alias("most_recent"),
        F.count_if(anomaly).alias("anomaly_count"),
    )


def alert_timeline(alerts: DataFrame, now, minutes: int = 30) -> DataFrame:
    """Alerts per minute and severity over the last half hour."""
    recent = alerts.filter(F.col("timestamp") >= _at(now) - F.expr(f"INTERVAL {int(minutes)} MINUTES"))
    return recent.groupBy(F.date_trunc("minute", "timestamp").alias("minute"), "severity").agg(
        F.count("*").alias("count")
    )


def _top(alerts: DataFrame, column: str, n: int | None) -> DataFrame:
    counted = alerts.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    ordered = counted.orderBy(F.col("count").desc(), column)
    return ordered if n is None else ordered.limit(n)


def attack_breakdown(alerts: DataFrame, n: int = 10) -> DataFrame:
    return _top(alerts, "attack_type", n)


def severity_counts(alerts: DataFrame) -> DataFrame:
    return _top(alerts, "severity", None)


def top_sources(alerts: DataFrame, n: int = 5) -> DataFrame:
    return _top(alerts, "src_ip", n)


def top_ports(alerts: DataFrame, n: int = 5) -> DataFrame:
    return _top(alerts, "dst_port", n).withColumn("dst_port", F.col("dst_port").cast("string"))


def alert_feed(alerts: DataFrame, n: int = 50, order: str = "alert_id") -> DataFrame:
    """The newest alerts as display text."""
    have = set(alerts.columns)
    listed = [
        F.col(c) if c in have else F.lit(None).alias(c) for c in ("shap_contributions", "top_features")
    ]
    empty = F.array().cast("array<struct<feature:string,value:double>>")
    arrays = [c if name in have else empty for c, name in zip(listed, ("shap_contributions", "top_features"))]
    newest = alerts.orderBy(F.col("timestamp").desc_nulls_last(), F.col(order).desc()).limit(n)

    def shown(name):
        return F.coalesce(F.col(name).cast("string"), F.lit("—")).alias(name)

    return newest.select(
        F.coalesce(F.date_format("timestamp", "HH:mm:ss"), F.lit("—")).alias("timestamp"),
        shown("severity"), shown("attack_type"), shown("src_ip"), shown("dst_ip"), shown("dst_port"),
        percent_text(F.col("confidence")).alias("confidence"),
        lead_feature(*arrays).alias("top_feature"),
    )


def audit_kpis(audit: DataFrame) -> DataFrame:
    """Block and unblock totals. Unique addresses count real blocks only."""
    blocks, unblocks = F.count_if(F.col("action").isin(*BLOCKS)), F.count_if(F.col("action").isin(*UNBLOCKS))
    return audit.agg(
        (blocks - unblocks).alias("active_blocks"),
        blocks.alias("total_blocks"),
        unblocks.alias("total_unblocks"),
        F.count_distinct(F.when(F.col("action") == "BLOCK", F.col("ip"))).alias("unique_ips"),
    )


def currently_blocked(audit: DataFrame, order: str = "seq") -> DataFrame:
    """First block row of every address that was never unblocked.

    One aggregate per address; rows of one address combine before the shuffle.
    """
    block = F.col("action").isin(*BLOCKS)
    found = audit.groupBy("ip").agg(
        F.min(F.when(block, F.struct(order, "timestamp", "reason"))).alias("first"),
        F.max(F.col("action").isin(*UNBLOCKS)).alias("unblocked"),
    )
    return found.filter("first IS NOT NULL AND NOT unblocked").select("ip", "first.timestamp", "first.reason")


def last_real_blocks(audit: DataFrame, order: str = "seq") -> DataFrame:
    """Last real BLOCK row of every address, unblocked or not."""
    found = audit.filter("action = 'BLOCK'").groupBy("ip").agg(
        F.max(F.struct(order, "timestamp", "reason")).alias("last")
    )
    return found.select("ip", "last.timestamp", "last.reason")


def recent_audit(audit: DataFrame, n: int = 20, order: str = "seq") -> DataFrame:
    newest = audit.orderBy(F.col("timestamp").desc_nulls_last(), F.col(order).desc()).limit(n)
    return newest.select("timestamp", "action", "ip", "reason")

"""Sources and sinks: a view goes out through a sink and comes back through a source."""

import struct
import uuid

import pandas as pd
from pyspark.sql import functions as F

from .. import views
from ..operators.cleaning import clean, regroup_labels
from ..sources import artifacts, captures, flow_csv, logs
from ..storage import shared_folder
from . import table_queries as tq


def _place(spark) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"


def _frame(row) -> bytes:
    """An Ethernet frame of the given length with IPv4 and TCP headers."""
    src, dst = (bytes(int(p) for p in ip.split(".")) for ip in (row.src_ip, row.dst_ip))
    ip = struct.pack(">BBHHHBBH4s4s", 0x45, 0, row.length - 14, 0, 0, 64, row.protocol, 0, src, dst)
    tcp = struct.pack(">HHIIBBHHH", row.src_port, row.dst_port, 0, 0, 5 << 4, row.tcp_flags, 0, 0, 0)
    return (b"\0" * 12 + b"\x08\0" + ip + tcp).ljust(row.length, b"\0")


def captures_read(spark, folder):
    """The packet view as capture files, read back. Frames are padded to 60 bytes."""
    base = _place(spark)

    def write(frames):
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(base if "://" in base else f"file://{base}")
        system.create_dir(root, recursive=True)
        for frame in frames:
            name = f"{root}/{frame['name'].iloc[0]}.pcap"
            with system.open_output_stream(name) as out:
                out.write(struct.pack("<IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1))
                for row in frame.itertuples():
                    data = _frame(row)
                    out.write(struct.pack("<IIII", row.us // 1_000_000, row.us % 1_000_000, len(data), len(data)) + data)
            yield pd.DataFrame({"packets": [len(frame)]})

    rows = views.packets(spark, folder).withColumns({
        "length": F.greatest(F.lit(60), F.col("length")), "us": F.unix_micros("ts"),
        # One file per stretch of 2,000 packets.
        "name": F.floor(F.col("seq") / 2000).cast("string"),
    })
    rows.groupBy("name").applyInPandas(lambda f: next(write(iter([f.sort_values("seq")]))), "packets long").count()
    found = captures.read_captures(spark, f"{base}/*.pcap", chunk_bytes=64 << 10)
    return found.select(F.unix_micros("ts").alias("us"), "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "length", "tcp_flags")


def flow_csvs(spark, folder):
    """The uncleaned view as latin-1 CSV files, read back and cleaned."""
    path = _place(spark)
    views.raw_flows(spark, folder).write.csv(path, header=True, encoding="ISO-8859-1", ignoreLeadingWhiteSpace=False,
                                             ignoreTrailingWhiteSpace=False)
    return clean(flow_csv.read_flow_csvs(spark, path))


def flow_csv_cleaned(spark, folder):
    """A folder that holds the cleaned file: it is taken as it is, copies and all."""
    path = _place(spark)
    regroup_labels(tq.raw(spark, folder)).write.csv(
        f"{path}/{artifacts.CLEANED_FILE}", header=True)
    rate = F.col("Flow Bytes/s")
    known = rate.isNotNull() & ~F.isnan(rate)
    return flow_csv.read_flows(spark, path).groupBy("Attack Type").agg(
        F.count("*").alias("n"), F.sum("Flow Duration").alias("total"),
        F.count_if(known & (F.abs(rate) == float("inf"))).alias("infinite"), F.count_if(~known).alias("missing"))


def alert_log(spark, folder):
    path = _place(spark)
    logs.write_alerts(views.alerts(spark, folder), path)
    found = logs.read_alerts(spark, path)
    return found.select(F.unix_micros("timestamp").alias("us"), "src_ip", "dst_ip", "src_port", "dst_port", "protocol",
                        "attack_type", "confidence", "severity")


def audit_log(spark, folder):
    path = _place(spark)
    logs.write_audit(views.audit(spark, folder), path)
    return logs.read_audit(spark, path).select(F.unix_micros("timestamp").alias("us"), "action", "ip", "reason")


def whitelist_file(spark, folder):
    """Customer addresses as whitelist lines, with comments, blanks and spaces."""
    path = _place(spark)
    ip = views.USER_IP.replace("user_id", "c_custkey")
    views.table(spark, folder, "customer").selectExpr(
        f"case c_custkey % 4 when 0 then concat('# ', {ip}) when 1 then '' when 2 then concat('  ', {ip}, ' ') else {ip} end as value"
    ).write.text(path)
    return logs.read_whitelist(spark, path)


def importance_table(spark, folder):
    """Mean feature values stand for importances."""
    from ..operators.scaling import scaler_stats
    from ..schemas import FEATURES

    path = _place(spark)
    stats = scaler_stats(views.labelled(spark, folder), FEATURES)
    artifacts.write_importance(stats.select("feature", F.round("mean", 3).alias("importance")), path)
    return artifacts.read_importance(spark, path)


CLEAN_ROWS = f"""WITH {tq.RAW} SELECT {tq.GROUPED} AS "Attack Type", count(*) AS n, sum("Flow Duration") AS total,
  count(*) FILTER (isinf("Flow Bytes/s")) AS infinite, count(*) FILTER ("Flow Bytes/s" IS NULL OR isnan("Flow Bytes/s")) AS missing
  FROM raw GROUP BY 1"""
CUSTOMER_IP = views.USER_IP_SQL.replace("user_id", "c_custkey")
QUERIES = {
    "captures_read": (captures_read, f"""SELECT us, src_ip, dst_ip, src_port, dst_port, protocol, greatest(60, length) AS length, tcp_flags FROM ({views.PACKETS_SQL})"""),
    "flow_csvs": (flow_csvs, tq.QUERIES["dedup"][1]),
    "flow_csv_cleaned": (flow_csv_cleaned, CLEAN_ROWS),
    "alert_log": (alert_log, f"""SELECT us, src_ip, dst_ip, src_port, dst_port, protocol, attack_type, confidence, severity FROM ({views.ALERTS_SQL})"""),
    "audit_log": (audit_log, f"""SELECT epoch_us("timestamp") AS us, action, ip, reason FROM ({views.AUDIT_SQL})"""),
    "whitelist_file": (whitelist_file, f"SELECT DISTINCT {CUSTOMER_IP} AS ip FROM customer WHERE c_custkey % 4 >= 2"),
    "importance_table": (importance_table, f"WITH {tq.LAB} " + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg(\"{c}\"), 3) AS importance FROM lab" for c in views.FEATURE_FORMULAS)),
}

"""Scored flows to alerts."""

from pyspark.sql import functions as F

from .. import views
from ..functions.columns import severity
from ..operators import alerts, scaling
from ..schemas import CLASS_IDS, FEATURES

SCORED = f"sc AS ({views.SCORED_SQL})"
NAME = "CASE predicted " + " ".join(f"WHEN {v} THEN '{k}'" for k, v in CLASS_IDS.items()) + " ELSE 'CLS_' || predicted END"
KEYS = ", ".join(views.ROW_KEYS)
ALERTS = f"""{SCORED}, al AS (SELECT {KEYS}, epoch_us(last_ts) AS us, src_ip, dst_ip, src_port, dst_port, protocol,
  CASE WHEN predicted = 0 THEN 'Unknown / Anomaly' ELSE {NAME} END AS attack_type,
  CASE WHEN predicted = 0 THEN 0.0 ELSE round(confidence, 4) END AS confidence,
  CASE WHEN predicted = 0 THEN 'LOW' WHEN confidence >= 0.9 THEN 'HIGH' WHEN confidence >= 0.7 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
  CASE WHEN predicted = 0 THEN round(anomaly_score, 4) END AS anomaly_score
  FROM sc WHERE (predicted = 0 AND anomaly_score < 0) OR (predicted <> 0 AND confidence >= 0.7))"""


def raised(spark, folder):
    return alerts.to_alerts(views.scored_flows(spark, folder), keep=views.ROW_KEYS)


def to_alerts(spark, folder):
    found = raised(spark, folder)
    return found.select(F.unix_micros("timestamp").alias("us"), *[c for c in found.columns if c != "timestamp"])


def severities(spark, folder):
    return views.scored_flows(spark, folder).groupBy(severity(F.col("confidence")).alias("severity")).agg(F.count("*").alias("n"))


def top(spark, folder):
    df = views.scored_flows(spark, folder)
    found = alerts.top_features(df, scaling.fit_scaler(df, FEATURES), places=11)
    parts = [F.col("top_features")[i][k].alias(f"{k}_{i + 1}") for i in range(3) for k in ("feature", "value")]
    return found.select(*views.ROW_KEYS, *parts)


TOP_SQL = f"""WITH {SCORED}, st AS (SELECT {', '.join(f'avg("{c}") AS m{i}, stddev_pop("{c}") AS s{i}' for i, c in enumerate(FEATURES))} FROM sc),
z AS (SELECT {KEYS}, list_sort([{', '.join(f'''struct_pack(r := -abs(greatest(-5, least(5, ("{c}" - m{i}) / s{i}))), i := {i}, f := '{c}', v := round("{c}", 11))''' for i, c in enumerate(FEATURES))}]) AS l FROM sc, st)
SELECT {KEYS}, {', '.join(f'l[{k}].f AS feature_{k}, l[{k}].v AS value_{k}' for k in (1, 2, 3))} FROM z"""


def rate(spark, folder):
    return alerts.alert_rate(views.scored_flows(spark, folder), raised(spark, folder))


def quarantined(spark, folder):
    """Raw rows stand for flows; rates are missing or infinite in some."""
    from .table_queries import raw

    good, bad = alerts.quarantine(raw(spark, folder), ["Flow Duration", "Flow Bytes/s", "Flow Packets/s"])
    return good.agg(F.count("*").alias("usable"), F.sum("Flow Duration").alias("usable_total")).crossJoin(
        bad.agg(F.count("*").alias("faulty"), F.sum("Flow Duration").alias("faulty_total")))


BAD = '("Flow Bytes/s" IS NULL OR isinf("Flow Bytes/s") OR isnan("Flow Packets/s"))'
QUERIES = {
    "to_alerts": (to_alerts, f"WITH {ALERTS} SELECT * FROM al"),
    "severity": (severities, f"""WITH {SCORED} SELECT CASE WHEN confidence >= 0.9 THEN 'HIGH' WHEN confidence >= 0.7 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
       count(*) AS n FROM sc GROUP BY 1"""),
    "top_features": (top, TOP_SQL),
    "alert_rate": (rate, f"""WITH {ALERTS} SELECT a AS flows, b AS alerts, round(b * 100 / a, 2) AS rate_pct
       FROM (SELECT (SELECT count(*) FROM sc) AS a, (SELECT count(*) FROM al) AS b)"""),
    "quarantine": (quarantined, f"""SELECT count(*) FILTER (NOT {BAD}) AS usable, sum("Flow Duration") FILTER (NOT {BAD}) AS usable_total,
       count(*) FILTER ({BAD}) AS faulty, sum("Flow Duration") FILTER ({BAD}) AS faulty_total FROM ({views.RAW_SQL})"""),
}

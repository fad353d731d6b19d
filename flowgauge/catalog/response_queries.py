"""Response decisions, block ledger, and alert and audit reports."""

from pyspark.sql import functions as F

from .. import views
from ..operators import response
from ..plans import reports

HOURS = 12 * 3600
NOW = "2024-01-15 00:00:00"
FLUSH = "2024-01-10 06:00:00"
POLICY = response.Policy(window_seconds=HOURS, escalate_at=3)


def _whitelist(spark, folder):
    """Addresses of customers in debt stand for the whitelist."""
    ips = views.USER_IP.replace("user_id", "c_custkey")
    return views.table(spark, folder, "customer").filter("c_acctbal < 0").selectExpr(f"{ips} as ip")


WHITELIST_SQL = f"SELECT {views.USER_IP_SQL.replace('user_id', 'c_custkey')} AS ip FROM customer WHERE c_acctbal < 0"

DECIDE_CTES = f"""
al AS (SELECT *, src_ip IN ({WHITELIST_SQL}) AS ex FROM ({views.ALERTS_SQL})),
md AS (SELECT *, row_number() OVER (PARTITION BY src_ip ORDER BY us, alert_id) AS rn FROM al WHERE NOT ex AND severity = 'MEDIUM'),
mc AS (SELECT alert_id, rn - min(rn) OVER (PARTITION BY src_ip ORDER BY us RANGE BETWEEN {HOURS}000000 PRECEDING AND CURRENT ROW) + 1 AS c FROM md),
de AS (SELECT al.*, CASE WHEN ex THEN 'IGNORE'
    WHEN severity = 'HIGH' THEN CASE WHEN attack_type IN ('DDoS','DoS','Port Scanning','Brute Force') THEN 'BLOCK' ELSE 'LOG_ONLY' END
    WHEN severity = 'MEDIUM' THEN CASE WHEN c >= 3 THEN 'BLOCK' ELSE 'ESCALATE' END ELSE 'LOG_ONLY' END AS action,
  CASE WHEN ex THEN 0
    WHEN severity = 'HIGH' THEN CASE WHEN attack_type IN ('DDoS','DoS','Brute Force') THEN 3600 WHEN attack_type = 'Port Scanning' THEN 1800 ELSE 0 END
    WHEN severity = 'MEDIUM' THEN CASE WHEN c >= 3 THEN 900 ELSE 0 END ELSE 0 END AS duration_sec,
  CASE WHEN ex THEN src_ip || ' is whitelisted'
    WHEN severity = 'HIGH' THEN CASE WHEN attack_type IN ('DDoS','DoS','Port Scanning','Brute Force')
       THEN 'HIGH severity ' || attack_type || ' from ' || src_ip ELSE attack_type || ' precision too low for auto-block' END
    WHEN severity = 'MEDIUM' THEN CASE WHEN c >= 3 THEN 'Escalated: ' || c || ' MEDIUM alerts from ' || src_ip || ' within {HOURS}s'
       ELSE 'MEDIUM alert ' || c || '/3' END
    ELSE 'LOW severity — monitoring only' END AS reason
  FROM al LEFT JOIN mc USING (alert_id))"""


# The ledger runs on longer blocks so that blocks overlap at this alert rate.
def _stretched(decisions):
    return decisions.withColumn("duration_sec", F.col("duration_sec") * 24)


def ledger_ctes(flush: bool = False) -> str:
    epoch = f"CASE WHEN us >= epoch_us(TIMESTAMP '{FLUSH}') THEN 1 ELSE 0 END" if flush else "0"
    flush_us = f"CASE WHEN us < epoch_us(TIMESTAMP '{FLUSH}') THEN epoch_us(TIMESTAMP '{FLUSH}') END" if flush else "CAST(NULL AS BIGINT)"
    return f"""WITH RECURSIVE {DECIDE_CTES},
bl AS (SELECT src_ip AS ip, {epoch} AS ep, us, {flush_us} AS flush_us, alert_id, CAST(duration_sec AS BIGINT) * 24000000 AS dur, reason
  FROM de WHERE action = 'BLOCK'),
pt AS (SELECT ip, ep, us, any_value(flush_us) AS flush_us, arg_min(dur, alert_id) AS dur, arg_min(reason, alert_id) AS reason FROM bl GROUP BY ip, ep, us),
nx AS (SELECT a.ip, a.ep, a.us, min(b.us) AS nxt FROM pt a JOIN pt b ON a.ip = b.ip AND a.ep = b.ep AND b.us >= a.us + a.dur GROUP BY ALL),
ch AS (SELECT ip, ep, min(us) AS us FROM pt GROUP BY ip, ep
  UNION ALL SELECT nx.ip, nx.ep, nx.nxt FROM ch JOIN nx USING (ip, ep, us)),
iv AS (SELECT ip, us AS block_us, coalesce(flush_us < us + dur, false) AS flushed,
   CASE WHEN coalesce(flush_us < us + dur, false) THEN flush_us ELSE us + dur END AS expiry_us, reason
   FROM ch JOIN pt USING (ip, ep, us))"""


def decisions(spark, folder):
    return response.decide(views.alerts(spark, folder), _whitelist(spark, folder), POLICY)


def response_decide(spark, folder):
    return decisions(spark, folder).select("alert_id", "action", "duration_sec", "reason")


def response_enrich(spark, folder):
    return response.enrich(decisions(spark, folder)).select("alert_id", "src_ip", "severity", "ips_action", "ips_reason")


def response_disabled(spark, folder):
    found = response.decide(views.alerts(spark, folder), enabled=False)
    return found.groupBy("action", "duration_sec", "reason").agg(F.count("*").alias("n"))


def ledger(spark, folder, flush_times=()):
    return response.block_intervals(_stretched(decisions(spark, folder)), flush_times, slice_seconds=86_400)


def block_ledger(spark, folder):
    return ledger(spark, folder).select(
        "ip", F.unix_micros("block_ts").alias("block_us"), F.unix_micros("expiry_ts").alias("expiry_us"), "flushed", "reason")


def block_ledger_flushed(spark, folder):
    return ledger(spark, folder, [FLUSH]).select(
        "ip", F.unix_micros("block_ts").alias("block_us"), F.unix_micros("expiry_ts").alias("expiry_us"), "flushed", "reason")


def _micros(df):
    return df.select(F.unix_micros("timestamp").alias("us"), *[c for c in df.columns if c != "timestamp"])


def block_audit(spark, folder):
    return _micros(response.audit_events(ledger(spark, folder), NOW))


def block_audit_dry_run(spark, folder):
    return _micros(response.audit_events(ledger(spark, folder), NOW, dry_run=True))


def blocks_active(spark, folder):
    return response.active_blocks(ledger(spark, folder), NOW).select(
        "ip", F.unix_micros("expires_at").alias("expires_us"), "seconds_remaining")


def blocks_listed(spark, folder):
    return response.blocked_ips(ledger(spark, folder), NOW)


def blocks_flush_all(spark, folder):
    closed, record = response.flush_all(ledger(spark, folder), NOW)
    return _micros(record).crossJoin(closed.agg(F.count_if("flushed").alias("closed")))


AUDIT_UNION = """SELECT block_us AS us, 'BLOCK{s}' AS action, ip, reason FROM iv WHERE block_us <= epoch_us(TIMESTAMP '{now}')
 UNION ALL SELECT expiry_us, 'UNBLOCK{s}', ip, 'block duration expired' FROM iv
 WHERE block_us <= epoch_us(TIMESTAMP '{now}') AND expiry_us <= epoch_us(TIMESTAMP '{now}')"""
NOW_US = f"epoch_us(TIMESTAMP '{NOW}')"
OPEN = f"block_us <= {NOW_US} AND expiry_us > {NOW_US}"


def _alerts(spark, folder):
    return views.alerts(spark, folder)


def _audit(spark, folder):
    return views.audit(spark, folder)


def alert_kpis(spark, folder):
    return reports.alert_kpis(_alerts(spark, folder), NOW).withColumn("avg_confidence", F.round("avg_confidence", 6))


def alert_timeline(spark, folder):
    found = reports.alert_timeline(_alerts(spark, folder), NOW, minutes=30_000)
    return found.withColumn("minute", F.unix_micros("minute"))


def recent_audit(spark, folder):
    return _micros(reports.recent_audit(_audit(spark, folder)))


def currently_blocked(spark, folder):
    return _micros(reports.currently_blocked(_audit(spark, folder)))


def last_real_blocks(spark, folder):
    return _micros(reports.last_real_blocks(_audit(spark, folder)))


def lead_feature(spark, folder):
    """Lead-feature text of every event: a contribution, a top feature, or a dash."""
    from ..functions.columns import lead_feature as text

    one = F.array(F.struct(F.col("event_type").alias("feature"), (F.col("value") - 20).alias("value")))
    none = F.array().cast("array<struct<feature:string,value:double>>")
    events = views.table(spark, folder, "events")
    shap = F.when(F.col("event_id") % 3 == 0, one).otherwise(none)
    top = F.when(F.col("event_id") % 3 == 1, one).otherwise(none)
    return events.select("event_id", text(shap, top).alias("top_feature"))


def _count_sql(column, tail=""):
    return f'SELECT {column}, count(*) AS "count" FROM ({views.ALERTS_SQL}) GROUP BY 1 ORDER BY 2 DESC, {column} {tail}'


QUERIES = {
    "response_decide": (response_decide, f"WITH {DECIDE_CTES} SELECT alert_id, action, duration_sec, reason FROM de"),
    "response_enrich": (response_enrich, f"WITH {DECIDE_CTES} SELECT alert_id, src_ip, severity, action AS ips_action, reason AS ips_reason FROM de"),
    "response_disabled": (response_disabled, "SELECT 'IGNORE' AS action, 0 AS duration_sec, 'IPS disabled' AS reason, count(*) AS n FROM events"),
    "block_ledger": (block_ledger, f"{ledger_ctes()} SELECT ip, block_us, expiry_us, flushed, reason FROM iv"),
    "block_ledger_flushed": (block_ledger_flushed, f"{ledger_ctes(True)} SELECT ip, block_us, expiry_us, flushed, reason FROM iv"),
    "block_audit": (block_audit, f"{ledger_ctes()} " + AUDIT_UNION.format(s="", now=NOW)),
    "block_audit_dry_run": (block_audit_dry_run, f"{ledger_ctes()} " + AUDIT_UNION.format(s="_DRYRUN", now=NOW)),
    "blocks_active": (blocks_active, f"{ledger_ctes()} SELECT ip, expiry_us AS expires_us, (expiry_us - {NOW_US}) // 1000000 AS seconds_remaining FROM iv WHERE {OPEN}"),
    "blocks_listed": (blocks_listed, f"{ledger_ctes()} SELECT DISTINCT ip FROM iv WHERE {OPEN}"),
    "blocks_flush_all": (blocks_flush_all, f"""{ledger_ctes()} SELECT {NOW_US} AS us, 'FLUSH_ALL' AS action, '*' AS ip,
       'emergency flush — ' || count(*) || ' IPs released' AS reason, count(*) AS closed FROM iv WHERE {OPEN}"""),
    "alert_kpis": (alert_kpis, f"""SELECT count(*) AS total, count(*) FILTER (severity = 'HIGH') AS high_severity,
       round(coalesce(avg(confidence) FILTER ("timestamp" >= TIMESTAMP '{NOW}' - INTERVAL 5 MINUTE AND attack_type <> 'Unknown / Anomaly'), 0), 6) AS avg_confidence,
       count(DISTINCT attack_type) AS attack_types, strftime(max("timestamp"), '%H:%M:%S') AS most_recent,
       count(*) FILTER (attack_type = 'Unknown / Anomaly') AS anomaly_count FROM ({views.ALERTS_SQL})"""),
    "alert_timeline": (alert_timeline, f"""SELECT epoch_us(date_trunc('minute', "timestamp")) AS minute, severity, count(*) AS "count"
       FROM ({views.ALERTS_SQL}) WHERE "timestamp" >= TIMESTAMP '{NOW}' - INTERVAL 30000 MINUTE GROUP BY ALL"""),
    "attack_breakdown": (lambda s, f: reports.attack_breakdown(_alerts(s, f)), _count_sql("attack_type", "LIMIT 10")),
    "severity_counts": (lambda s, f: reports.severity_counts(_alerts(s, f)), _count_sql("severity")),
    "top_sources": (lambda s, f: reports.top_sources(_alerts(s, f)), _count_sql("src_ip", "LIMIT 5")),
    "top_ports": (lambda s, f: reports.top_ports(_alerts(s, f)),
                  f'SELECT CAST(dst_port AS VARCHAR) AS dst_port, "count" FROM ({_count_sql("dst_port", "LIMIT 5")})'),
    "alert_feed": (lambda s, f: reports.alert_feed(_alerts(s, f)), f"""SELECT strftime("timestamp", '%H:%M:%S') AS "timestamp", severity,
       attack_type, src_ip, dst_ip, CAST(dst_port AS VARCHAR) AS dst_port,
       CASE WHEN confidence > 0 THEN printf('%.1f%%', confidence * 100) ELSE '—' END AS confidence, '—' AS top_feature
       FROM (SELECT * FROM ({views.ALERTS_SQL}) ORDER BY us DESC, alert_id DESC LIMIT 50)"""),
    "lead_feature": (lead_feature, """SELECT event_id, CASE event_id % 3 WHEN 0 THEN printf('%s (%+.2f)', event_type, value - 20)
       WHEN 1 THEN event_type ELSE '—' END AS top_feature FROM events"""),
    "audit_kpis": (lambda s, f: reports.audit_kpis(_audit(s, f)), f"""SELECT b - u AS active_blocks, b AS total_blocks, u AS total_unblocks, unique_ips FROM (
       SELECT count(*) FILTER (action IN ('BLOCK','BLOCK_DRYRUN')) AS b, count(*) FILTER (action IN ('UNBLOCK','UNBLOCK_DRYRUN')) AS u,
       count(DISTINCT ip) FILTER (action = 'BLOCK') AS unique_ips FROM ({views.AUDIT_SQL}))"""),
    "currently_blocked": (currently_blocked, f"""WITH a AS ({views.AUDIT_SQL}) SELECT epoch_us(arg_min("timestamp", seq)) AS us, ip, arg_min(reason, seq) AS reason
       FROM a WHERE action IN ('BLOCK','BLOCK_DRYRUN') AND ip NOT IN (SELECT ip FROM a WHERE action IN ('UNBLOCK','UNBLOCK_DRYRUN')) GROUP BY ip"""),
    "last_real_blocks": (last_real_blocks, f"""SELECT epoch_us(arg_max("timestamp", seq)) AS us, ip, arg_max(reason, seq) AS reason
       FROM ({views.AUDIT_SQL}) WHERE action = 'BLOCK' GROUP BY ip"""),
    "recent_audit": (recent_audit, f"""SELECT epoch_us("timestamp") AS us, action, ip, reason FROM ({views.AUDIT_SQL}) ORDER BY 1 DESC, seq DESC LIMIT 20"""),
}

"""Driver tables seen as packets, alerts, audit rows, labelled flows and predictions.

Each view is plain arithmetic on one table, written once for Spark and once as
SQL text for the comparison engine. All rows are kept.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import FEATURES


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


USER_IP = "concat('10.', cast(user_id div 65536 as string), '.', cast((user_id div 256) % 256 as string), '.', cast(user_id % 256 as string))"
USER_IP_SQL = "'10.' || (user_id // 65536) || '.' || ((user_id // 256) % 256) || '.' || (user_id % 256)"


def packets(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as traffic between a user and one of three servers."""
    to_server = "event_type in ('view', 'click', 'purchase')"
    server_ip = "concat('192.168.0.', cast(10 + event_id % 3 as string))"
    server_port = "case event_id % 3 when 0 then 80 when 1 then 443 else 22 end"
    user_port = "cast(40000 + user_id % 20000 as int)"
    return table(spark, folder, "events").selectExpr(
        "cast(ts as timestamp) as ts",
        "event_id as seq",
        f"case when {to_server} then {USER_IP} else {server_ip} end as src_ip",
        f"case when {to_server} then {server_ip} else {USER_IP} end as dst_ip",
        f"case when {to_server} then {user_port} else {server_port} end as src_port",
        f"case when {to_server} then {server_port} else {user_port} end as dst_port",
        "6 as protocol",
        "cast(40 + floor(value * 10) as int) as length",
        "case event_type when 'signup' then 2 when 'view' then 16 when 'error' then 17 else 24 end as tcp_flags",
    )


PACKETS_SQL = f"""
SELECT epoch_us(ts) AS us, event_id AS seq,
  CASE WHEN event_type IN ('view','click','purchase') THEN {USER_IP_SQL} ELSE '192.168.0.' || (10 + event_id % 3) END AS src_ip,
  CASE WHEN event_type IN ('view','click','purchase') THEN '192.168.0.' || (10 + event_id % 3) ELSE {USER_IP_SQL} END AS dst_ip,
  CASE WHEN event_type IN ('view','click','purchase') THEN CAST(40000 + user_id % 20000 AS INT)
       ELSE CASE event_id % 3 WHEN 0 THEN 80 WHEN 1 THEN 443 ELSE 22 END END AS src_port,
  CASE WHEN event_type IN ('view','click','purchase') THEN CASE event_id % 3 WHEN 0 THEN 80 WHEN 1 THEN 443 ELSE 22 END
       ELSE CAST(40000 + user_id % 20000 AS INT) END AS dst_port,
  6 AS protocol, CAST(40 + floor(value * 10) AS INT) AS length,
  CASE event_type WHEN 'signup' THEN 2 WHEN 'view' THEN 16 WHEN 'error' THEN 17 ELSE 24 END AS tcp_flags
FROM events
"""

ATTACK_OF_EVENT = """case when event_id % 29 = 0 then 'Unknown / Anomaly' when event_id % 17 = 0 then 'Bots'
  when event_type = 'signup' then 'Port Scanning' when event_type = 'purchase' then 'DDoS'
  when event_type = 'error' then 'Brute Force' when event_type = 'view' then 'Web Attacks' else 'DoS' end"""
CONFIDENCE_OF_EVENT = "case when event_id % 29 = 0 then cast(0 as double) else cast(70 + event_id % 30 as double) / cast(100 as double) end"
SEVERITY_OF_EVENT = "case when event_id % 29 = 0 then 'LOW' when event_id % 30 >= 20 then 'HIGH' else 'MEDIUM' end"


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as an alert log, one alert per event."""
    return table(spark, folder, "events").selectExpr(
        "event_id as alert_id",
        "cast(ts as timestamp) as timestamp",
        f"{USER_IP} as src_ip",
        "concat('192.168.0.', cast(10 + event_id % 3 as string)) as dst_ip",
        "cast(40000 + user_id % 20000 as int) as src_port",
        "cast(20 + event_id % 8 as int) as dst_port",
        "6 as protocol",
        f"{ATTACK_OF_EVENT} as attack_type",
        f"cast({CONFIDENCE_OF_EVENT} as double) as confidence",
        f"{SEVERITY_OF_EVENT} as severity",
        "value",
    )


ALERTS_SQL = f"""
SELECT event_id AS alert_id, ts AS "timestamp", epoch_us(ts) AS us, {USER_IP_SQL} AS src_ip,
  '192.168.0.' || (10 + event_id % 3) AS dst_ip, CAST(40000 + user_id % 20000 AS INT) AS src_port,
  CAST(20 + event_id % 8 AS INT) AS dst_port, 6 AS protocol,
  {ATTACK_OF_EVENT} AS attack_type, CAST({CONFIDENCE_OF_EVENT} AS DOUBLE) AS confidence,
  {SEVERITY_OF_EVENT} AS severity, value
FROM events
"""

AUDIT_ACTION = """case when event_id % 97 = 0 then 'UNBLOCK' when event_id % 211 = 0 then 'UNBLOCK_DRYRUN'
  when event_type in ('click', 'error') then 'BLOCK' when event_type = 'view' then 'BLOCK_DRYRUN' else 'FLUSH_ALL' end"""


def audit(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as an audit log of block and unblock actions."""
    return table(spark, folder, "events").selectExpr(
        "event_id as seq",
        "cast(ts as timestamp) as timestamp",
        f"{AUDIT_ACTION} as action",
        f"{USER_IP} as ip",
        "concat(event_type, ' ', cast(event_id % 10 as string)) as reason",
    )


AUDIT_SQL = f"""
SELECT event_id AS seq, ts AS "timestamp", {AUDIT_ACTION} AS action, {USER_IP_SQL} AS ip,
  event_type || ' ' || (event_id % 10) AS reason FROM events
"""

# Feature formulas over lineitem; both engines evaluate the same IEEE arithmetic.
FEATURE_FORMULAS = {
    "Flow Duration": "l_quantity * 1000 + l_linenumber",
    "Total Fwd Packets": "l_quantity",
    "Bwd Packets/s": "l_discount * 100",
    "Total Length of Fwd Packets": "l_extendedprice",
    "Min Packet Length": "cast(l_partkey % 60 as double)",
    "Fwd Packet Length Max": "l_extendedprice / 64",
    "Fwd Packet Length Min": "cast(l_suppkey % 40 as double)",
    "Fwd Packet Length Mean": "l_extendedprice / 128 + l_linenumber",
    "Bwd Packet Length Max": "l_tax * 1000",
    "Bwd Packet Length Min": "cast(l_orderkey % 30 as double)",
    "Bwd Packet Length Mean": "l_tax * 500 + l_discount",
    "Flow Bytes/s": "l_extendedprice / l_quantity",
    "Flow Packets/s": "l_quantity * l_discount",
    "Flow IAT Mean": "l_extendedprice / 256",
    "Flow IAT Std": "l_extendedprice * l_tax",
    "Fwd IAT Mean": "l_quantity * l_tax",
    "Bwd IAT Mean": "l_quantity / 4",
    "PSH Flag Count": "cast(l_linenumber as double)",
    "FIN Flag Count": "cast(l_partkey % 2 as double)",
    "ACK Flag Count": "cast(l_orderkey % 5 as double)",
}
CLASS_OF_ITEM = """case when l_partkey % 100 < 60 then 'Normal Traffic' when l_partkey % 100 < 75 then 'DoS'
  when l_partkey % 100 < 85 then 'Port Scanning' when l_partkey % 100 < 92 then 'DDoS'
  when l_partkey % 100 < 96 then 'Brute Force' when l_partkey % 100 < 98 then 'Web Attacks'
  when l_partkey % 100 < 99 then 'Bots' else 'Mystery' end"""
ROW_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _quoted(names: dict, quote: str) -> list[str]:
    return [f"{formula} as {quote}{name}{quote}" for name, formula in names.items()]


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """``lineitem`` as labelled flows: four row keys, twenty features, the class name."""
    return table(spark, folder, "lineitem").selectExpr(
        *ROW_KEYS, *_quoted(FEATURE_FORMULAS, "`"), f"{CLASS_OF_ITEM} as `Attack Type`"
    )


LABELLED_SQL = (
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    + ", ".join(_quoted(FEATURE_FORMULAS, '"'))
    + f', {CLASS_OF_ITEM} AS "Attack Type" FROM lineitem'
)

RAW_LABEL = """case l_partkey % 16 when 0 then 'BENIGN' when 1 then 'DoS Hulk' when 2 then 'DoS GoldenEye'
  when 3 then 'DoS slowloris' when 4 then 'DoS Slowhttptest' when 5 then 'Heartbleed' when 6 then 'DDoS'
  when 7 then 'PortScan' when 8 then 'FTP-Patator' when 9 then 'SSH-Patator'
  when 10 then 'Web Attack \x96 Brute Force' when 11 then 'Web Attack \x96 XSS'
  when 12 then 'Web Attack \x96 Sql Injection' when 13 then 'Infiltration' when 14 then 'Bot' else 'Mystery' end"""

# Rates are infinite where the quantity is 1, missing where it is 2; 16 coarse columns make duplicates.
RAW_FORMULAS = {
    " Flow Duration": "l_quantity",
    " Flow Bytes/s": "case when l_quantity = 1 then cast('Infinity' as double) when l_quantity = 2 then cast(null as double) else l_discount / l_quantity end",
    "Flow Packets/s ": "case when l_quantity = 50 then cast('NaN' as double) else cast(l_linenumber as double) end",
    " ACK Flag Count": "l_tax",
}


def raw_flows(spark: SparkSession, folder: str) -> DataFrame:
    """``lineitem`` as uncleaned flow rows with padded names and raw labels."""
    return table(spark, folder, "lineitem").selectExpr(*_quoted(RAW_FORMULAS, "`"), f"{RAW_LABEL} as ` Label`")


RAW_SQL = (
    "SELECT " + ", ".join(f'{formula} AS "{name.strip()}"' for name, formula in RAW_FORMULAS.items())
    + f', {RAW_LABEL} AS "Label" FROM lineitem'
)

TRUTH = "case when l_partkey % 10 < 6 then 0 else cast(l_partkey % 6 as int) end"
GUESS = f"case when (l_orderkey + l_linenumber) % 5 = 0 then cast(l_suppkey % 7 as int) else {TRUTH} end"


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """``lineitem`` as scored rows: truth, guess and the seven class scores."""
    scores = ", ".join(
        f"cast(((l_orderkey * 7 + l_suppkey * {k + 3}) % 100 + case when ({TRUTH}) = {k} then 35 else 0 end) as double) / cast(100 as double)"
        for k in range(7)
    )
    return table(spark, folder, "lineitem").selectExpr(
        *ROW_KEYS, f"{TRUTH} as y", f"{GUESS} as p", f"array({scores}) as scores"
    )


def score_sql(k: int) -> str:
    return f"CAST(((l_orderkey * 7 + l_suppkey * {k + 3}) % 100 + CASE WHEN ({TRUTH}) = {k} THEN 35 ELSE 0 END) AS DOUBLE) / CAST(100 AS DOUBLE)"


PREDICTIONS_SQL = (
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {TRUTH} AS y, {GUESS} AS p, "
    f"[{', '.join(score_sql(k) for k in range(7))}] AS scores FROM lineitem"
)

CONFIDENCE = "cast(40 + (l_orderkey * 7 + l_linenumber * 13) % 61 as double) / cast(100 as double)"
PREDICTED = "cast(case when l_partkey % 3 = 0 then 0 else l_partkey % 8 end as int)"
ANOMALY_SCORE = "cast(l_suppkey % 41 - 20 as double) / cast(100 as double)"


def scored_flows(spark: SparkSession, folder: str) -> DataFrame:
    """``lineitem`` as flows that a classifier and an anomaly model have scored."""
    return table(spark, folder, "lineitem").selectExpr(
        *ROW_KEYS, *_quoted(FEATURE_FORMULAS, "`"),
        "cast(l_shipdate as timestamp) as last_ts",
        "concat('10.0.', cast(l_suppkey % 200 as string), '.', cast(l_partkey % 250 as string)) as src_ip",
        "concat('192.168.0.', cast(l_linenumber as string)) as dst_ip",
        "cast(1024 + l_orderkey % 60000 as int) as src_port",
        "cast(20 + l_linenumber as int) as dst_port",
        "6 as protocol",
        f"{PREDICTED} as predicted",
        f"cast({CONFIDENCE} as double) as confidence",
        f"cast({ANOMALY_SCORE} as double) as anomaly_score",
    )


SCORED_SQL = (
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, " + ", ".join(_quoted(FEATURE_FORMULAS, '"'))
    + ", l_shipdate AS last_ts, '10.0.' || (l_suppkey % 200) || '.' || (l_partkey % 250) AS src_ip, "
    "'192.168.0.' || l_linenumber AS dst_ip, CAST(1024 + l_orderkey % 60000 AS INT) AS src_port, "
    "CAST(20 + l_linenumber AS INT) AS dst_port, 6 AS protocol, "
    f"{PREDICTED} AS predicted, CAST({CONFIDENCE} AS DOUBLE) AS confidence, "
    f"CAST({ANOMALY_SCORE} AS DOUBLE) AS anomaly_score FROM lineitem"
)


def embedding_flows(spark: SparkSession, folder: str) -> DataFrame:
    """``embeddings`` as labelled flows: all dimensions folded into twenty sums, class = label % 7."""
    def folded(i):
        mine = F.filter("embedding", lambda _, place: place % len(FEATURES) == i)
        return F.aggregate(mine, F.lit(0.0), lambda total, x: total + x.cast("double"))

    wide = [folded(i).alias(name) for i, name in enumerate(FEATURES)]
    return table(spark, folder, "embeddings").select("vec_id", *wide, (F.col("label") % 7).cast("int").alias("label"))


SEGMENTS = {"AUTOMOBILE": "Normal Traffic", "BUILDING": "DoS", "FURNITURE": "DDoS", "HOUSEHOLD": "Bots", "MACHINERY": "Port Scanning"}
CLASS_OF_CUSTOMER = "case c_mktsegment " + " ".join(f"when '{a}' then '{b}'" for a, b in SEGMENTS.items()) + " else 'Mystery' end"


def separable(spark: SparkSession, folder: str) -> DataFrame:
    """``customer`` as flows whose class five of the features tell: one is near 10 for its market segment, near 0 for others.

    The other fifteen features have nothing to do with the class.
    """
    telling = [F.when(F.col("c_mktsegment") == s, 10.0).otherwise(0.0) + (F.col("c_custkey") % (3 + i)) / 10.0 for i, s in enumerate(SEGMENTS)]
    noise = [F.col("c_acctbal"), F.col("c_nationkey").cast("double"),
             *[(F.pmod(F.xxhash64("c_custkey", F.lit(i)), F.lit(1000))).cast("double") for i in range(13)]]
    return table(spark, folder, "customer").select(
        "c_custkey", *[c.alias(n) for c, n in zip([*telling, *noise], FEATURES, strict=True)], F.expr(CLASS_OF_CUSTOMER).alias("Attack Type"))

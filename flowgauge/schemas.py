"""Record layouts and the fixed values every stage agrees on."""

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Feature names and their model order, class names and ids,
# raw-label groups, thresholds and response tables. Results depend on them.
# ---------------------------------------------------------------------------

LABEL = "Attack Type"
RAW_LABEL = "Label"
BENIGN = "Normal Traffic"
ANOMALY = "Unknown / Anomaly"

FEATURES = [
    "Flow Duration",
    "Total Fwd Packets",
    "Bwd Packets/s",
    "Total Length of Fwd Packets",
    "Min Packet Length",
    "Fwd Packet Length Max",
    "Fwd Packet Length Min",
    "Fwd Packet Length Mean",
    "Bwd Packet Length Max",
    "Bwd Packet Length Min",
    "Bwd Packet Length Mean",
    "Flow Bytes/s",
    "Flow Packets/s",
    "Flow IAT Mean",
    "Flow IAT Std",
    "Fwd IAT Mean",
    "Bwd IAT Mean",
    "PSH Flag Count",
    "FIN Flag Count",
    "ACK Flag Count",
]

CLASS_IDS = {
    "Normal Traffic": 0,
    "Port Scanning": 1,
    "Web Attacks": 2,
    "Brute Force": 3,
    "DDoS": 4,
    "Bots": 5,
    "DoS": 6,
}

RAW_LABEL_GROUPS = {
    "BENIGN": "Normal Traffic",
    "DoS Hulk": "DoS",
    "DoS GoldenEye": "DoS",
    "DoS slowloris": "DoS",
    "DoS Slowhttptest": "DoS",
    "Heartbleed": "DoS",
    "DDoS": "DDoS",
    "PortScan": "Port Scanning",
    "FTP-Patator": "Brute Force",
    "SSH-Patator": "Brute Force",
    "Web Attack \x96 Brute Force": "Web Attacks",
    "Web Attack \x96 XSS": "Web Attacks",
    "Web Attack \x96 Sql Injection": "Web Attacks",
    "Infiltration": "Bots",
    "Bot": "Bots",
}

MEDIAN_FEATURES = [
    "Flow Duration", "Total Fwd Packets", "Flow Bytes/s", "Flow Packets/s",
    "Min Packet Length", "PSH Flag Count", "FIN Flag Count", "ACK Flag Count",
]
BOX_FEATURES = [
    "Flow Duration", "Total Fwd Packets", "Flow Bytes/s", "Flow Packets/s",
    "Min Packet Length", "Fwd Packet Length Mean", "PSH Flag Count",
    "FIN Flag Count",
]
VIOLIN_FEATURES = ["Flow Duration", "Flow Bytes/s", "Total Fwd Packets"]

TCP_FIN = 0x01
TCP_PSH = 0x08
TCP_ACK = 0x10

IDLE_SECONDS = 5
CAP_SECONDS = 120

CLIP = 5.0
CONFIDENCE_FLOOR = 0.70
HIGH_FROM = 0.90
MEDIUM_FROM = 0.70
ANOMALY_BELOW = 0.0
CONTAMINATION = 0.05

HIGH_ACTIONS = {
    "DDoS": "BLOCK",
    "DoS": "BLOCK",
    "Port Scanning": "BLOCK",
    "Brute Force": "BLOCK",
    "Web Attacks": "LOG_ONLY",
    "Bots": "LOG_ONLY",
}
BLOCK_SECONDS = {
    "DDoS": 3600,
    "DoS": 3600,
    "Port Scanning": 1800,
    "Brute Force": 3600,
}
DEFAULT_BLOCK_SECONDS = 1800
ESCALATE_AT = 3
ESCALATE_WINDOW_SECONDS = 60
ESCALATE_BLOCK_SECONDS = 900

# ---------------------------------------------------------------------------
# Record layouts
# ---------------------------------------------------------------------------

PACKET = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
    T.StructField("src_ip", T.StringType()),
    T.StructField("dst_ip", T.StringType()),
    T.StructField("src_port", T.IntegerType()),
    T.StructField("dst_port", T.IntegerType()),
    T.StructField("protocol", T.IntegerType()),
    T.StructField("length", T.IntegerType()),
    T.StructField("tcp_flags", T.IntegerType()),
])

FLOW_META = ["src_ip", "dst_ip", "src_port", "dst_port", "protocol"]

CONTRIBUTIONS = T.ArrayType(T.StructType([
    T.StructField("feature", T.StringType()),
    T.StructField("value", T.DoubleType()),
]))

ALERT_JSON = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("src_ip", T.StringType()),
    T.StructField("dst_ip", T.StringType()),
    T.StructField("src_port", T.IntegerType()),
    T.StructField("dst_port", T.IntegerType()),
    T.StructField("protocol", T.IntegerType()),
    T.StructField("attack_type", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("severity", T.StringType()),
    T.StructField("anomaly_score", T.DoubleType()),
    T.StructField("shap_contributions", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("top_features", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("ips_action", T.StringType()),
    T.StructField("ips_reason", T.StringType()),
])

AUDIT_JSON = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("reason", T.StringType()),
])


def flow_schema(label: str = LABEL) -> T.StructType:
    """Twenty DOUBLE feature columns followed by the label."""
    fields = [T.StructField(f, T.DoubleType()) for f in FEATURES]
    return T.StructType(fields + [T.StructField(label, T.StringType())])

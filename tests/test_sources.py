import json
import struct

import pytest
from pyspark.sql import functions as F

from flowgauge.operators.flows import assemble_flows
from flowgauge.schemas import FEATURES, LABEL
from flowgauge.sources import artifacts, captures, flow_csv, logs


def frame(src="10.0.0.1", dst="10.0.0.2", sport=1000, dport=80, proto=6, flags=0x12, kind=0x0800, vlan=False, pad=0, fragment=0):
    ip = struct.pack(">BBHHHBBH4s4s", 0x45, 0, 40, 0, fragment, 64, proto, 0, *(bytes(map(int, a.split("."))) for a in (src, dst)))
    top = struct.pack(">HHIIBBHHH", sport, dport, 0, 0, 0x50, flags, 0, 0, 0) if proto == 6 else struct.pack(">HHHH", sport, dport, 8, 0)
    link = b"\0" * 12 + (struct.pack(">HH", 0x8100, 5) if vlan else b"") + struct.pack(">H", kind)
    return link + ip + top + b"\0" * pad


def write(path, packets, order="<", nano=False, link=1):
    magic = 0xA1B23C4D if nano else 0xA1B2C3D4
    data = struct.pack(order + "IHHiIII", magic, 2, 4, 0, 0, 65535, link)
    for seconds, part, body in packets:
        data += struct.pack(order + "IIII", seconds, part, len(body), len(body)) + body
    path.write_bytes(data)


def read(spark, glob, **options):
    found = captures.read_captures(spark, str(glob), **options).orderBy("seq")
    return found.withColumn("us", F.unix_micros("ts")).collect()


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("nano", [False, True])
def test_capture_headers(spark, tmp_path, order, nano):
    part = 5_000 if nano else 5
    write(tmp_path / "a.pcap", [(100, part, frame()), (100, part, frame(kind=0x0806)), (101, 0, frame(proto=17, vlan=True, pad=9)),
                                (102, 0, frame(proto=1))], order, nano)
    rows = read(spark, tmp_path / "*.pcap")
    assert [(r.us, r.src_port, r.dst_port, r.protocol, r.tcp_flags) for r in rows] == [
        (100_000_005, 1000, 80, 6, 0x12), (101_000_000, 1000, 80, 17, 0), (102_000_000, 0, 0, 1, 0)]
    assert [r.length for r in rows] == [54, 14 + 4 + 20 + 8 + 9, 42]
    assert [r.seq for r in rows] == [0, 2, 3]


def test_captures_in_small_chunks_and_broken_files(spark, tmp_path):
    for name in ("a", "b"):
        write(tmp_path / f"{name}.pcap", [(100 + i, i, frame(sport=2000 + i)) for i in range(50)])
    (tmp_path / "c.pcap").write_bytes(b"not a capture")
    whole = tmp_path / "d.pcap"
    write(whole, [(1, 1, frame()), (2, 2, frame())])
    whole.write_bytes(whole.read_bytes()[:-7])  # the last record is cut off
    rows = read(spark, tmp_path / "*.pcap", chunk_bytes=300)
    assert [r.src_port for r in rows[:50]] == [2000 + i for i in range(50)]
    assert len(rows) == 101 and len({r.seq for r in rows}) == 101


def test_broken_captures_are_listed(spark, tmp_path):
    write(tmp_path / "a.pcap", [(1, 1, frame()), (2, 2, frame())])
    write(tmp_path / "b.pcap", [(1, 1, frame()), (2, 2, frame())])
    whole = (tmp_path / "b.pcap").read_bytes()
    (tmp_path / "b.pcap").write_bytes(whole[:-7])
    (tmp_path / "c.pcap").write_bytes(b"not a capture, but longer than a header")
    found = {r.path.rsplit("/", 1)[1]: (r.start, r.stop, r.reason) for r in captures.broken_ranges(spark, str(tmp_path / "*.pcap")).collect()}
    assert found == {"b.pcap": (24 + 16 + 54, len(whole) - 7, "record cut short"), "c.pcap": (0, 39, "not a capture")}


def test_header_of_any_length(spark, tmp_path):
    names = [f"column number {i} of a very wide table" for i in range(4000)]
    (tmp_path / "wide.csv").write_bytes((",".join(names) + "\n" + ",".join("1" for _ in names) + "\n").encode())
    assert flow_csv._headers(spark, str(tmp_path))[0][1] == names


def test_raw_ip_and_later_fragments(spark, tmp_path):
    write(tmp_path / "r.pcap", [(1, 0, frame()[14:]), (2, 0, frame(fragment=8)[14:])], link=101)
    rows = read(spark, tmp_path / "r.pcap")
    assert [(r.src_port, r.tcp_flags, r.length) for r in rows] == [(1000, 0x12, 40), (0, 0, 40)]


def block(kind, body, order):
    body += b"\0" * (-len(body) % 4)
    size = struct.pack(order + "I", len(body) + 12)
    return struct.pack(order + "I", kind) + size + body + size


@pytest.mark.parametrize("order", ["<", ">"])
def test_block_captures(spark, tmp_path, order):
    def section():
        return block(0x0A0D0D0A, struct.pack(order + "IHHq", 0x1A2B3C4D, 1, 0, -1), order)

    def interface(link, resolution=None):
        options = b"" if resolution is None else struct.pack(order + "HHB3x", 9, 1, resolution)
        return block(1, struct.pack(order + "HHI", link, 0, 65535) + options, order)

    def packet(number, ticks, body):
        return block(6, struct.pack(order + "IIIII", number, ticks >> 32, ticks & 0xFFFFFFFF, len(body), len(body)) + body, order)

    data = section() + interface(1) + packet(0, 1_700_000_000_000_005, frame(sport=1)) + block(5, b"stats", order)
    data += interface(101, 9) + packet(1, 1_700_000_001_000_007_000, frame(sport=2)[14:]) + packet(0, 1_700_000_002_000_000, frame(sport=3))
    data += section() + interface(1, 0x80 | 10) + packet(0, 1_700_000_003 * 1024 + 512, frame(sport=4))
    (tmp_path / "x.pcapng").write_bytes(data)
    for size in (1, 32 << 20):
        rows = read(spark, tmp_path / "*.pcapng", chunk_bytes=size)
        assert [(r.src_port, r.us - 1_700_000_000_000_000) for r in rows] == [(1, 5), (2, 1_000_007), (3, 2_000_000), (4, 3_500_000)]
        assert len({r.seq for r in rows}) == 4


def test_capture_to_flow(spark, tmp_path):
    write(tmp_path / "f.pcap", [(1, 0, frame(flags=2)), (1, 500_000, frame("10.0.0.2", "10.0.0.1", 80, 1000)), (2, 0, frame(flags=17))])
    row = assemble_flows(captures.read_captures(spark, str(tmp_path / "f.pcap")), None, None).first()
    assert (row["Total Fwd Packets"], row["FIN Flag Count"], row["ACK Flag Count"], row["Flow Duration"]) == (2, 1, 2, 1_000_000)


def test_csv_folder(spark, tmp_path):
    head = " Flow Duration, Flow Bytes/s,Fwd Header Length,Fwd Header Length, Label\n"
    (tmp_path / "Friday.csv").write_bytes((head + "1,Infinity,0,0,BENIGN\n2,3.5,0,0,Bot\n2,3.5,0,0,Bot\n").encode("latin-1"))
    (tmp_path / "Monday.csv").write_bytes((head + "5,NaN,0,0,BENIGN\n7,inf,1,0,DDoS\n6,1,0,0,Web Attack \x96 XSS\n").encode("latin-1"))
    df = flow_csv.read_flow_csvs(spark, str(tmp_path), with_order=True)
    assert "Fwd Header Length.1" in df.columns
    assert [r["Flow Duration"] for r in df.orderBy(*flow_csv.ORDER).collect()] == [5, 7, 6, 1, 2, 2]
    cleaned = flow_csv.read_flows(spark, str(tmp_path)).collect()
    assert sorted((r["Flow Duration"], r[LABEL]) for r in cleaned) == [(2.0, "Bots"), (6.0, "Web Attacks")]
    (tmp_path / artifacts.CLEANED_FILE).write_text(f"Flow Duration,{LABEL}\n4,DoS\n4,DoS\n")
    assert flow_csv.read_flows(spark, str(tmp_path)).count() == 2


def test_no_csv(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        flow_csv.read_flow_csvs(spark, str(tmp_path))


def test_alert_log(spark, tmp_path):
    path = tmp_path / "alerts.jsonl"
    good = {"timestamp": "2024-05-01T10:00:00.250000+00:00", "src_ip": "a", "confidence": 0.9, "severity": "HIGH",
            "shap_contributions": {"z": 0.5, "a": -0.25}}
    odd = {"timestamp": "yesterday", "src_ip": "b"}
    late = {"timestamp": "2024-05-01T11:00:00Z", "src_ip": "c"}
    path.write_text("\n".join([json.dumps(good), "", "{broken", json.dumps(odd), json.dumps(late)]) + "\n")
    rows = logs.read_alerts(spark, str(path)).collect()
    assert [r.src_ip for r in rows] == ["c", "a", "b"] and rows[2].timestamp is None
    assert [(c.feature, c.value) for c in rows[1].shap_contributions] == [("z", 0.5), ("a", -0.25)]
    out = str(tmp_path / "out")
    logs.write_alerts(logs.read_alerts(spark, str(path)), out)
    again = logs.read_alerts(spark, out).collect()
    assert [r.asDict(True) for r in again] == [r.asDict(True) for r in rows]
    assert logs.read_alerts(spark, str(tmp_path / "none")).count() == 0


def test_audit_log(spark, tmp_path):
    path = tmp_path / "audit.jsonl"
    path.write_text('{"timestamp": "2024-05-01T10:00:00Z", "action": "BLOCK", "ip": "a", "reason": "r"}\n\nxx\n')
    assert [r.action for r in logs.read_audit(spark, str(path)).collect()] == ["BLOCK"]


def test_whitelist(spark, tmp_path):
    path = tmp_path / "w.txt"
    path.write_text("# note\n   # indented note\n\n 10.0.0.1 \n10.0.0.2\n10.0.0.2\n")
    assert sorted(r.ip for r in logs.read_whitelist(spark, str(path)).collect()) == ["10.0.0.1", "10.0.0.2"]
    assert logs.read_whitelist(spark, str(tmp_path / "none")).count() == 0


def test_importance_table(spark, tmp_path):
    df = spark.createDataFrame([(FEATURES[0], 0.2), (FEATURES[1], 0.8)], "feature string, importance double")
    artifacts.write_importance(df, str(tmp_path / "i"))
    assert [r.feature for r in artifacts.read_importance(spark, str(tmp_path / "i")).collect()] == [FEATURES[1], FEATURES[0]]
    with pytest.raises(FileNotFoundError):
        artifacts.read_importance(spark, str(tmp_path / "none"))

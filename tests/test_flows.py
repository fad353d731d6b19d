"""Flow assembly against literal cases and a packet-by-packet walk."""

import random
import statistics
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from flowgauge.operators import flows
from flowgauge.schemas import FEATURES, PACKET

START = datetime(2024, 5, 1, tzinfo=timezone.utc)
A, B = ("1.1.1.1", 1234), ("2.2.2.2", 80)


def packet(us, seq, src=A, dst=B, length=60, flags=0, protocol=6):
    return (START + timedelta(microseconds=us), seq, src[0], dst[0], src[1], dst[1], protocol, length, flags)


def table(spark, rows):
    return spark.createDataFrame(rows, PACKET)


def walk(rows, idle, cap, min_packets=2):
    """The same flows, one packet at a time."""
    done, open_flows = [], {}

    def close(key):
        done.append(open_flows.pop(key))

    for ts, seq, sip, dip, sp, dp, proto, length, flags in sorted(rows, key=lambda r: (r[0], r[1])):
        us = round((ts - START) / timedelta(microseconds=1))
        here, back = (sip, dip, sp, dp, proto), (dip, sip, dp, sp, proto)
        key = here if here in open_flows else back if back in open_flows else None
        if key:
            f = open_flows[key]
            if (idle is not None and us - f[-1][0] > idle * 1e6) or (cap is not None and us - f[0][0] >= cap * 1e6):
                close(key)
                key = None
        if key is None:
            key = here
            open_flows[key] = []
        open_flows[key].append((us, key == here, length, flags, key))
    for key in list(open_flows):
        close(key)
    return [describe(f) for f in done if len(f) >= min_packets]


def describe(f):
    us = [p[0] for p in f]
    micros = us[-1] - us[0]
    seconds = micros / 1e6 if micros else 1.0
    fwd, bwd = [p for p in f if p[1]], [p for p in f if not p[1]]

    def gaps(ps):
        return [b[0] - a[0] for a, b in zip(ps, ps[1:])] or [0]

    def mean(xs):
        return sum(xs) / len(xs)

    fl, bl = [p[2] for p in fwd] or [0], [p[2] for p in bwd] or [0]
    values = [
        max(micros, 1), len(fwd), len(bwd) / seconds, sum(fl), min(p[2] for p in f), max(fl), min(fl), mean(fl),
        max(bl), min(bl), mean(bl), sum(p[2] for p in f) / seconds, len(f) / seconds, mean(gaps(f)),
        statistics.pstdev(gaps(f)), mean(gaps(fwd)), mean(gaps(bwd)),
        sum(bool(p[3] & 8) for p in f), sum(bool(p[3] & 1) for p in f), sum(bool(p[3] & 16) for p in f),
    ]
    return (us[0], *f[0][4], *[round(float(v), 4) for v in values])


def found(df):
    rows = df.select(F.unix_micros("first_ts").alias("us"), "src_ip", "dst_ip", "src_port", "dst_port", "protocol",
                     *[F.col(f"`{f}`") for f in FEATURES]).collect()
    base = round(START.timestamp() * 1e6)
    return sorted((r[0] - base, *r[1:6], *[round(v, 4) for v in r[6:]]) for r in rows)


def handshake():
    us = [0, 100_000, 200_000, 300_000, 400_000]
    return [packet(us[0], 0, flags=0x02), packet(us[1], 1, B, A, flags=0x12), packet(us[2], 2, flags=0x10),
            packet(us[3], 3, length=500, flags=0x18), packet(us[4], 4, B, A, flags=0x10)]


def test_handshake_features(spark):
    row = flows.assemble_flows(table(spark, handshake())).first()
    want = {"Flow Duration": 400_000, "Total Fwd Packets": 3, "Bwd Packets/s": 5, "Total Length of Fwd Packets": 620,
            "Min Packet Length": 60, "Fwd Packet Length Max": 500, "Fwd Packet Length Min": 60, "Flow Bytes/s": 1850,
            "Flow Packets/s": 12.5, "Flow IAT Mean": 100_000, "Flow IAT Std": 0, "Fwd IAT Mean": 150_000, "Bwd IAT Mean": 300_000,
            "PSH Flag Count": 1, "FIN Flag Count": 0, "ACK Flag Count": 4, "Bwd Packet Length Mean": 60}
    for name, value in want.items():
        assert row[name] == pytest.approx(value), name
    assert row["Fwd Packet Length Mean"] == pytest.approx(206.6667, abs=1e-3)
    assert (row.src_ip, row.src_port, row.dst_ip, row.dst_port) == ("1.1.1.1", 1234, "2.2.2.2", 80)


def test_single_packet_makes_no_flow(spark):
    assert flows.assemble_flows(table(spark, [packet(0, 0)])).count() == 0


@pytest.mark.parametrize("gap, expected", [(5_000_000, 1), (5_000_001, 2)])
def test_idle_boundary(spark, gap, expected):
    rows = [packet(0, 0), packet(1, 1), packet(1 + gap, 2), packet(2 + gap, 3)]
    assert flows.assemble_flows(table(spark, rows)).count() == expected


@pytest.mark.parametrize("at, expected", [(119_999_999, 1), (120_000_000, 2)])
def test_cap_boundary(spark, at, expected):
    steps = list(range(0, 119_000_000, 4_000_000))
    rows = [packet(us, i) for i, us in enumerate(steps)] + [packet(at, 900), packet(at + 1, 901)]
    assert flows.assemble_flows(table(spark, rows)).count() == expected


def test_under_cap_is_kept_and_lowered_cap_cuts(spark):
    rows = [packet(i * 455_000, i) for i in range(10)]
    assert flows.assemble_flows(table(spark, rows), cap=10).count() == 1
    assert flows.assemble_flows(table(spark, rows), cap=2).count() == 2


def test_first_packet_from_the_higher_endpoint(spark):
    row = flows.assemble_flows(table(spark, [packet(0, 0, B, A), packet(10, 1, A, B, 99)])).first()
    assert (row.src_ip, row["Total Fwd Packets"], row["Bwd Packet Length Max"]) == ("2.2.2.2", 1, 99)


def test_equal_times_use_seq_and_zero_duration(spark):
    row = flows.assemble_flows(table(spark, [packet(0, 2, A, B), packet(0, 1, B, A)])).first()
    assert (row.src_ip, row["Flow Duration"], row["Flow Packets/s"]) == ("2.2.2.2", 1.0, 2.0)


def random_packets(seed, n, keys, step):
    rng = random.Random(seed)
    us, rows = 0, []
    for i in range(n):
        us += rng.choice([0, 1, 1000, 100_000, step, step])
        k = 0 if rng.random() < 0.4 else rng.randrange(keys)  # one key holds much of the traffic
        ends = ((f"10.0.0.{k}", 1000 + k), ("10.9.9.9", 443))
        src, dst = ends if rng.random() < 0.6 else ends[::-1]
        rows.append(packet(us, i, src, dst, rng.randrange(40, 1500), rng.choice([0, 1, 2, 16, 24, 25])))
    return rows


@pytest.mark.parametrize("idle, cap, slice_seconds", [
    (5, 120, None), (5, 20, 3), (2, None, 1), (None, None, 7), (None, 15, 4), (5, 8, 60),
])
def test_matches_packet_walk(spark, idle, cap, slice_seconds):
    rows = random_packets(3, 1500, 5, 700_000)
    got = found(flows.assemble_flows(table(spark, rows), idle=idle, cap=cap, slice_seconds=slice_seconds))
    assert got == sorted(walk(rows, idle, cap))


def test_direction_of_whole_capture(spark):
    rows = random_packets(5, 300, 4, 200_000)
    got = {r.seq: r.direction for r in flows.with_direction(table(spark, rows)).collect()}
    first = {}
    for r in rows:
        pair = frozenset([(r[2], r[4]), (r[3], r[5])])
        first.setdefault(pair, (r[2], r[4]))
        assert got[r[1]] == ("fwd" if (r[2], r[4]) == first[pair] else "bwd")


def test_hot_key_is_spread(spark):
    """All packets of one key: the packet shuffle still uses many groups."""
    rows = table(spark, [packet(i * 1_000_000, i) for i in range(2000)])
    plan = flows._lean(rows, 60_000_000).select("slice").distinct().count()
    assert plan >= 33
    assert flows.assemble_flows(rows).count() == 17

"""Streams equal batches, over several disordered files."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from flowgauge.operators import flows, response
from flowgauge.schemas import FEATURES, PACKET
from flowgauge.sources import captures, logs
from flowgauge.storage import lookup
from flowgauge.streaming import flows as stream_flows
from flowgauge.streaming import response as stream_response
from flowgauge.streaming import runs
from test_flows import START, random_packets

MARK = START + timedelta(days=900)


def in_files(rows, schema, spark, path, files, jitter, closing, time):
    """Rows in rough time order over several files, each written on its own, then a closing row."""
    rng = random.Random(9)
    shaken = sorted(rows, key=lambda r: time(r) + timedelta(microseconds=rng.randrange(jitter)))
    size = -(-len(shaken) // files)
    for i in range(0, len(shaken), size):
        spark.createDataFrame(shaken[i: i + size], schema).coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([closing], schema).coalesce(1).write.mode("append").parquet(path)


def drained(spark, df, name, checkpoint):
    query = df.writeStream.format("memory").queryName(name).option("checkpointLocation", str(checkpoint)).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.table(name)


def test_flows(spark, tmp_path):
    rows = random_packets(11, 900, 5, 900_000)
    path = str(tmp_path / "in")
    closing = (MARK, -1, "9.9.9.9", "9.9.9.8", 1, 2, 6, 0, 0)
    in_files(rows, PACKET, spark, path, 4, 3_000_000, closing, lambda r: r[0])
    stream = captures.read_packet_stream(spark, path, files_per_trigger=1)
    got = drained(spark, stream_flows.stream_flows(stream, 2, 30, "4 seconds"), "flows_out", tmp_path / "c")
    want = flows.assemble_flows(spark.createDataFrame(rows, PACKET), 2, 30)

    def shown(df):
        return df.select("first_ts", "last_ts", "src_ip", "src_port", *[F.round(F.col(f"`{f}`"), 3).alias(f) for f in FEATURES])

    assert got.count() == want.count() > 20
    assert shown(got).exceptAll(shown(want)).count() == 0


@pytest.mark.parametrize("gap, sessions", [(5_000_000, 1), (5_000_001, 2)])
def test_session_window_boundary(spark, tmp_path, gap, sessions):
    rows = [(START + timedelta(microseconds=us), i, "a", "b", 1, 2, 6, 60, 0) for i, us in enumerate([0, gap])]
    path = str(tmp_path / "in")
    spark.createDataFrame(rows, PACKET).coalesce(1).write.parquet(path)
    spark.createDataFrame([(MARK, 9, "x", "y", 1, 2, 6, 60, 0)], PACKET).coalesce(1).write.mode("append").parquet(path)
    stream = captures.read_packet_stream(spark, path)
    got = drained(spark, stream_flows.stream_sessions(stream), f"sessions_{sessions}", tmp_path / "c")
    assert got.count() == sessions


def test_responses(spark, tmp_path):
    schema = "alert_id long, timestamp timestamp, src_ip string, attack_type string, severity string"
    rng = random.Random(2)
    rows, now = [], datetime(2024, 5, 1, tzinfo=timezone.utc)
    for i in range(400):
        now += timedelta(seconds=rng.choice([0, 1, 20, 300]))
        # Ids that a double cannot hold.
        rows.append(((1 << 60) + i, now, rng.choice("aaabc"), rng.choice(["DDoS", "Bots", "Port Scanning"]), rng.choice(["HIGH", "MEDIUM", "MEDIUM", "LOW", None])))
    path = str(tmp_path / "in")
    in_files(rows, schema, spark, path, 3, 5_000_000, (-1, MARK, "z", "DoS", "LOW"), lambda r: r[1])
    listed = spark.createDataFrame([("c",)], "ip string")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = drained(spark, stream_response.stream_response(stream, listed, None, "10 seconds"), "responses_out", tmp_path / "c")
    want = response.decide(spark.createDataFrame(rows, schema), listed)
    columns = ["alert_id", "action", "duration_sec", "reason"]
    decided = got.filter("kind = 'decision' AND ip <> 'z'").select(*columns)
    assert decided.count() == 400 and decided.exceptAll(want.select(*columns)).count() == 0
    audit = response.audit_events(response.block_intervals(want), "2090-01-01").select("timestamp", "action", "ip", "reason")
    mine = got.filter("kind = 'audit'").select("timestamp", "action", "ip", "reason")
    assert mine.count() == audit.count() > 10 and mine.exceptAll(audit).count() == 0


def test_alert_sink(spark, tmp_path):
    schema = "timestamp timestamp, src_ip string, confidence double"
    spark.createDataFrame([(START, "a", 0.5)], schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    query = logs.stream_alerts(stream, str(tmp_path / "out"), str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [(r.src_ip, r.confidence) for r in logs.read_alerts(spark, str(tmp_path / "out")).collect()] == [("a", 0.5)]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_with_hot_and_missing_keys(spark, how):
    rows = [("hot", i) for i in range(50)] + [("x", 100), ("y", 101), (None, 102)]
    big = spark.createDataFrame(rows, "k string, i long")
    small = spark.createDataFrame([("hot", 1), ("x", 2), ("q", 3)], "k string, v long")
    plain = sorted(big.join(small, ["k"], how).collect(), key=str)
    assert sorted(lookup(big, small, ["k"], how, rows=2, hot_rows=10).collect(), key=str) == plain


def test_query_detects_with_all_parts(spark, monkeypatch):
    """The registered query trains the published forest and hands the anomaly model to the stream, with explanations."""
    from flowgauge.catalog import stream_queries
    from flowgauge.operators import models

    class Called(Exception):
        pass

    seen = {}

    def streamed(packets, model, scaler, whitelist, policy=None, anomaly=None, explained=False, **_):
        seen.update(anomaly=anomaly, explained=explained)
        raise Called

    monkeypatch.setattr(models, "train_forest", lambda df, **params: seen.update(params=params))
    monkeypatch.setattr(stream_queries.detection, "detect_stream", streamed)
    with pytest.raises(Called):
        stream_queries.stream_detect(spark, "/root/testdata/sf0.001")
    assert seen["params"] == {} and seen["explained"] and len(seen["anomaly"].nodes) > 0


def test_late_rows_are_counted_over_restarts(spark, tmp_path):
    """Rows behind the watermark: none in the first run, five in one batch and three in another of the second, two in the third."""
    path, place = str(tmp_path / "in"), str(tmp_path / "run")

    def send(at, n, key="a"):
        rows = [(START + timedelta(seconds=at, microseconds=i), i, key, "b", 1, 2, 6, 60, 0) for i in range(n)]
        spark.createDataFrame(rows, PACKET).coalesce(1).write.mode("append").parquet(path)

    def run():
        stream = captures.read_packet_stream(spark, path, files_per_trigger=1)
        return runs.drained(stream_flows.stream_flows(stream, 2, 30, "4 seconds"), place)

    send(0, 4)
    send(100, 4)
    send(200, 2)
    run()
    assert runs.late_rows(spark, place) == 0
    send(10, 5)
    send(20, 3)
    run()
    assert runs.late_rows(spark, place) == 8
    send(30, 2)
    send(900, 2)
    out = run()
    assert runs.late_rows(spark, place) == 10
    # The first three flows are out, each once; what came late is in none.
    assert sorted(r[0] for r in spark.read.parquet(out).select("`Total Fwd Packets`").collect()) == [2.0, 4.0, 4.0]


def state_rows(df, name, place):
    """The most rows of state that a stream over all its files has kept."""
    query = df.writeStream.format("memory").queryName(name).option("checkpointLocation", str(place)).start()
    try:
        query.processAllAvailable()
        return max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"])
    finally:
        query.stop()


def test_many_flows_share_few_pieces_of_state(spark, tmp_path):
    """State has a row per shard, not per key; ports that are missing and ids that a double cannot hold stay as they are."""
    rows = [(START + timedelta(seconds=j), (1 << 60) + j, f"10.0.0.{i}", "192.168.0.1", 5 if i else None, 80, 6, 60 + i, 16) for i in range(60) for j in range(3)]
    path = str(tmp_path / "packets")
    for part in (rows[:100], rows[100:]):
        spark.createDataFrame(part, PACKET).coalesce(1).write.mode("append").parquet(path)

    def flowing():
        return stream_flows.stream_flows(captures.read_packet_stream(spark, path, files_per_trigger=1), 2, 30, "1 day", shards=4)

    assert 0 < state_rows(flowing(), "open_flows", tmp_path / "open") <= 4
    spark.createDataFrame([(MARK, -1, "9.9.9.9", "9.9.9.8", 1, 2, 6, 0, 0)], PACKET).coalesce(1).write.mode("append").parquet(path)
    got = drained(spark, flowing(), "closed_flows", tmp_path / "closed")
    found = {r.src_ip: (r.src_port, r["Total Fwd Packets"], r["Min Packet Length"]) for r in got.collect()}
    assert found == {f"10.0.0.{i}": (5 if i else None, 3.0, 60.0 + i) for i in range(60)}


def test_many_sources_share_few_pieces_of_state(spark, tmp_path):
    alerts = [((1 << 60) + i, START + timedelta(seconds=i), f"10.0.0.{i}", "Bots", "MEDIUM") for i in range(60)]
    schema = "alert_id long, timestamp timestamp, src_ip string, attack_type string, severity string"
    spark.createDataFrame(alerts, schema).coalesce(1).write.parquet(str(tmp_path / "alerts"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "alerts"))
    assert 0 < state_rows(stream_response.stream_response(stream, None, None, "1 day", shards=4), "open_sources", tmp_path / "open") <= 4

"""Streams equal batches; restarts lose and repeat nothing."""

import datetime as dt
import json

import numpy as np
import pytest
from frames import rows
from pyspark.sql import functions as F

from ledgerlake.operators import windows
from ledgerlake.plans import gold
from ledgerlake.queries import streams
from ledgerlake.sources.readers import stream_files
from ledgerlake.streaming import corrections, velocity
from ledgerlake.streaming import trades as st

STAMP = "2024-01-01T00:00:00"
BODY = "Body binary"


def envelope(spark, items):
    return spark.createDataFrame([(bytearray(json.dumps(i).encode()),) for i in items], BODY)


def trade(n, price=20.0, minute=0):
    return {"timestamp": f"2024-01-01T10:{minute:02d}:00", "ticker": "A", "preco": price, "quantidade": 100,
            "tipo": "compra", "corretora": "c", "id_transacao": str(n)}


def test_restart_continues(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    for part in ([1, 2], [3]):
        envelope(spark, [trade(n) for n in part]).coalesce(1).write.mode("append").parquet(src)
        raw = stream_files(spark, src, BODY)
        st.drain(st.run_trades_stream(raw, out, ckpt, STAMP))
        assert rows(spark.read.parquet(out), "id_transacao") == [(str(n),) for n in range(1, part[-1] + 1)]
    batch = st.decode_trades(spark.read.parquet(src), STAMP)
    assert rows(spark.read.parquet(out).select(*batch.columns)) == rows(batch)


def test_bad_messages_go_to_quarantine(spark, tmp_path):
    src, good, bad = (str(tmp_path / n) for n in ("src", "good", "bad"))
    wrong = [trade(2, price="x"), {k: v for k, v in trade(3).items() if k != "tipo"}]
    for part in ([trade(1)], wrong):
        envelope(spark, part).coalesce(1).write.mode("append").parquet(src)
    spark.createDataFrame([(bytearray(b"{not json"),), (None,)], BODY).coalesce(1).write.mode("append").parquet(src)
    for _ in range(2):  # a second run finds nothing new
        raw = stream_files(spark, src, BODY)
        st.drain(st.run_quarantine_stream(raw, bad, str(tmp_path / "c1")))
        st.drain(st.run_trades_stream(raw, good, str(tmp_path / "c2"), STAMP, validate=True))
    assert rows(spark.read.parquet(good), "id_transacao") == [("1",)]
    kept = spark.read.parquet(bad)
    assert kept.count() == 4 and kept.where("motivo is null").isEmpty()
    assert bytearray(b"{not json") in [r["Body"] for r in kept.collect()]


def test_replay_refuses_a_used_target(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    envelope(spark, [trade(1)]).write.parquet(src)
    st.replay(stream_files(spark, src, BODY), lambda d: d, out, str(tmp_path / "one"))
    with pytest.raises(FileExistsError):
        st.replay(stream_files(spark, src, BODY), lambda d: d, out, str(tmp_path / "two"))


def test_every_batch_is_recorded(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(30).repartition(5).write.parquet(src)
    raw = stream_files(spark, src, "id bigint", max_files=1)
    got = st.drain_recorded(lambda: st.stream_to_table(raw, str(tmp_path / "o"), str(tmp_path / "c")), spark, str(tmp_path / "m"))
    busy = got.where("linhas_entrada > 0")
    assert busy.select("batch_id").distinct().count() == 5 and busy.agg(F.sum("linhas_entrada")).first()[0] == 30


def test_foreach_batch_replay_overwrites(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    envelope(spark, [trade(1), trade(2, 30.0)]).coalesce(1).write.parquet(src)
    bench = spark.createDataFrame(
        [("A", "e", "s", 20.0, 1.0, 1000.0)],
        "ticker string, empresa string, setor string, preco_medio double, volatilidade double, volume_medio double",
    )
    fns = st.gold_batch(bench, "2024-01-01")
    for ckpt in ("one", "two"):  # a lost checkpoint replays batch 0 into the same folder
        raw = st.decode_trades(stream_files(spark, src, BODY), STAMP)
        st.drain(st.foreach_batch_refresh(raw, out, str(tmp_path / ckpt), fns))
    tables = st.finish_gold(spark, out, bench, "2024-01-01")
    batch = st.decode_trades(spark.read.parquet(src), STAMP)
    assert rows(tables["ranking"]) == rows(gold.ranking(batch, bench, "2024-01-01"))
    assert rows(tables["volume"]) == rows(gold.intraday_volume(batch, bench, "2024-01-01"))
    assert rows(tables["anomalias"]) == rows(gold.intraday_anomalies(batch, bench, "2024-01-01"))
    fraud = gold.fraud_trades(batch, bench, "2024-01-01")
    assert rows(tables["fraude"].select(*fraud.columns)) == rows(fraud)


def test_named_query_is_replaced_only_by_name(spark, tmp_path):
    src = str(tmp_path / "src")
    envelope(spark, [trade(1)]).write.parquet(src)

    def start(name):
        raw = stream_files(spark, src, BODY)
        return st.run_trades_stream(raw, str(tmp_path / f"out_{name}"), str(tmp_path / f"ckpt_{name}"), STAMP, "1 second", name)

    a, b = start("a"), start("b")
    a.processAllAvailable()
    again = start("a")  # same checkpoint and target, kept as they are
    try:
        assert not a.isActive and b.isActive and again.isActive
        again.processAllAvailable()
        assert rows(spark.read.parquet(str(tmp_path / "out_a")), "id_transacao") == [("1",)]
        assert not st.stop_named(spark, "unknown")
    finally:
        assert st.stop_named(spark, "a") and st.stop_named(spark, "b")
    assert not spark.streams.active


def test_late_rows_and_duplicates(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = "id int, u string, ts timestamp_ntz, v double"

    def land(*items):
        data = [(i, "u", dt.datetime(2024, 1, 1, h, m), 1.0) for i, h, m in items]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(src)

    land((1, 1, 0), (2, 1, 30), (2, 1, 30))
    land((3, 9, 0))
    land((6, 9, 5))  # late rows are judged by the watermark of the batch before
    land((4, 1, 10), (5, 12, 0))  # row 4 is far behind it
    out = str(tmp_path / "agg")
    agg = st.stream_tumbling(stream_files(spark, src, schema), "u", "ts", "v", "1 hour", "1 hour")
    st.drain(st.stream_to_table(agg, out, str(tmp_path / "c1")))
    got = {r["inicio"].hour: r["eventos"] for r in spark.read.parquet(out).collect()}
    assert got == {1: 3, 9: 2}  # hour 12 is still open, row 4 was dropped
    dedup = st.stream_dedup(stream_files(spark, src, schema), "id", "ts", "2 hours").select("id")
    st.drain(st.stream_to_table(dedup, str(tmp_path / "ids"), str(tmp_path / "c2")))
    assert rows(spark.read.parquet(str(tmp_path / "ids"))) == [(1,), (2,), (3,), (5,), (6,)]


def test_sessions_equal_batch(spark, tmp_path):
    src = str(tmp_path / "src")
    data = [(i, f"u{i % 2}", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=7 * i * (1 + i % 3)), 1.5) for i in range(40)]
    spark.createDataFrame(data, "id int, u string, ts timestamp_ntz, v double").write.parquet(src)
    raw = stream_files(spark, src, "id int, u string, ts timestamp_ntz, v double", max_files=100)
    streamed = st.complete_result(
        st.stream_sessions(raw, "u", "ts", "v", "30 minutes"), str(tmp_path / "out"), str(tmp_path / "c")
    )
    batch = windows.sessionize(spark.read.parquet(src), "u", "ts", 1800, "v")
    assert rows(streamed.select(*batch.columns)) == rows(batch)


def test_metrics_listener(spark, tmp_path):
    src, path = str(tmp_path / "src"), str(tmp_path / "metrics")
    envelope(spark, [trade(1), trade(2)]).coalesce(1).write.parquet(src)
    listener = st.StreamMetrics(spark, path)
    spark.streams.addListener(listener)
    try:
        query = st.drain(st.run_trades_stream(stream_files(spark, src, BODY), str(tmp_path / "o"), str(tmp_path / "c"), STAMP))
        assert st.progress_rows(query).agg(F.sum("linhas_entrada")).first()[0] == 2
        for _ in range(100):
            try:
                total = spark.read.parquet(path).agg(F.sum("linhas_entrada")).first()[0]
                if total == 2:
                    break
            except Exception:  # noqa: BLE001 - nothing written yet
                pass
            import time

            time.sleep(0.1)
        assert total == 2
    finally:
        spark.streams.removeListener(listener)


def land(spark, path, items, schema="id int, k string, ts timestamp, value double"):
    stamped = [(i, k, None if at is None else dt.datetime(2024, 1, 1) + dt.timedelta(seconds=at), x) for i, k, at, x in items]
    spark.createDataFrame(stamped, schema).coalesce(1).write.mode("append").parquet(path)


def drained(spark, path, start):
    raw = stream_files(spark, path, "id int, k string, ts timestamp, value double", max_files=1)
    return st.drain(start(raw))


def test_velocity_equals_batch_and_state_is_given_back(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    first = [(1, "a", 0, 1.0), (2, "a", 5, 1.0), (3, "b", 5, 1.0), (4, "a", 5, 1.0), (5, None, 6, 1.0), (6, "a", None, 1.0)]
    land(spark, src, first)
    land(spark, src, [(7, "a", 12, 1.0), (8, "b", 500, 1.0), (9, "a", 11, 1.0)])
    start = lambda raw: st.stream_to_table(velocity.stream_velocity(raw, "k", "ts", 10, 2, "1 minute"), out, ckpt)
    drained(spark, src, start)
    # in a later run, from the same checkpoint: the state of "b" still counts, that of "a" is gone
    land(spark, src, [(10, "b", 505, 1.0), (11, "z", 5000, 1.0)])
    done = drained(spark, src, start)
    got = rows(spark.read.parquet(out).select("id", "eventos_janela", "alerta_velocidade"))
    events = spark.read.parquet(src)
    assert got == rows(windows.velocity_flag(events, "k", "ts", 10, 2).select("id", "eventos_janela", "alerta_velocidade"))
    assert done.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 1  # only "z"


@pytest.mark.parametrize("kind", ["bigint", "string", "double"])
def test_velocity_counts_keys_in_groups(spark, tmp_path, kind):
    src, schema = str(tmp_path / "src"), f"id int, k {kind}, ts timestamp, value double"
    key = {"bigint": int, "string": str, "double": float}[kind]
    for part in range(3):  # times in order across files, not inside them
        items = [(100 * part + i, key(i * 7 % 20), 40 * part + i * 13 % 40, 1.0) for i in range(100)]
        land(spark, src, items, schema)
    raw = stream_files(spark, src, schema)
    rule = velocity.stream_velocity(raw, "k", "ts", 25, 4, groups=3)
    done = st.drain(st.stream_to_table(rule, str(tmp_path / "out"), str(tmp_path / "ckpt")))
    picked = ("id", "eventos_janela", "alerta_velocidade")
    want = rows(windows.velocity_flag(spark.read.parquet(src), "k", "ts", 25, 4), *picked)
    assert rows(spark.read.parquet(str(tmp_path / "out")), *picked) == want
    groups = done.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    assert groups == 20 if kind == "double" else 1 <= groups <= 3  # a call and a state for each group, not each key


def test_velocity_counts_over_all_times():
    far = 62_135_596_800_000_000  # microseconds from 1970 back to year 1
    places, times, events, entry = velocity.merged(
        np.array([1, 0, 1, 0, 2, 1]), np.array([5, far, 5, far - 3, -far, 2]), np.array([1, 1, 2, 1, 1, 1])
    )
    assert [places.tolist(), times.tolist(), events.tolist()] == [[0, 0, 1, 1, 2], [far - 3, far, 2, 5, -far], [1, 1, 1, 3, 1]]
    assert entry.tolist() == [3, 1, 3, 0, 4, 2]
    assert velocity.counted(places, times, events, 3).tolist() == [1, 2, 1, 4, 1]
    assert velocity.counted(places, times, events, 2).tolist() == [1, 1, 1, 3, 1]


@pytest.fixture
def many_parts(spark, tmp_path):
    """Events of a table of several files, each over the whole time but one week."""
    week = dt.timedelta(days=7)
    data = [
        (i, dt.datetime(2024, 1, 1) + week * (0, 2, 3)[i % 3] + dt.timedelta(minutes=i * 37 % 500), i % 5, "a", 1.0, "{}")
        for i in range(400)
    ]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(data, schema).repartition(6).write.option("parquet.block.size", 1).parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def test_a_landed_week_is_one_micro_batch(spark, many_parts, tmp_path):
    events = spark.read.parquet(f"{many_parts}/events.parquet")
    raw = stream_files(spark, streams.land_by_week(spark, many_parts), events.schema, max_files=streams.WEEK_FILES)
    done = st.drain_recorded(
        lambda: st.stream_to_table(raw, str(tmp_path / "o"), str(tmp_path / "c")), spark, str(tmp_path / "m")
    )
    sizes = [134, 0, 133, 133, events.where("ts < '2024-01-01 01:00:00'").count()]
    assert [r["linhas_entrada"] for r in done.orderBy("batch_id").collect()] == sizes and sizes[-1] > 0


def test_velocity_keeps_the_rows_of_all_parts(spark, many_parts):
    events = spark.read.parquet(f"{many_parts}/events.parquet")
    got = rows(streams.stream_velocity(spark, many_parts), "event_id", "eventos_janela", "alerta_velocidade")
    assert got == rows(windows.velocity_flag(events, "user_id", "ts", 600, 2), "event_id", "eventos_janela", "alerta_velocidade")


def test_late_rows_correct_closed_windows(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    land(spark, src, [(1, "a", 0, 1.5), (2, "a", 3599, None), (3, "b", 10, 2.0)])
    land(spark, src, [(4, "a", 4 * 3600, 1.0), (5, None, 4 * 3600, 1.0), (6, "a", None, 9.0)])
    land(spark, src, [(7, "a", 60, 0.25), (8, "b", 3 * 3600, 4.0)])
    start = lambda raw: corrections.corrected_windows(raw, "k", "ts", "value", out, ckpt)
    drained(spark, src, start)
    events = spark.read.parquet(src)
    schema = corrections.partial_schema(events, "k")
    want = rows(events.where("ts is not null").groupBy("k", F.window("ts", "1 hour")["start"].alias("inicio")).agg(
        F.count("*").alias("eventos"), F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 2).alias("valor_total")
    ))
    read = lambda: corrections.windows_so_far(spark, out, schema, "k")
    assert rows(read(), "k", "inicio", "eventos", "valor_total") == want
    # the row of minute 1 reopens a window; the one of 3:00 is not behind the watermark
    assert [tuple(r) for r in read().where("reaberta").select("k", "eventos", "atrasados").collect()] == [("a", 3, 1)]
    assert [r["id"] for r in spark.read.parquet(f"{out}/atrasadas").collect()] == [7]
    # compacted, then one more batch, then compacted again: always the same windows
    merge = lambda df: corrections.merge_windows(df, "k")
    assert corrections.compact_partials(spark, f"{out}/parciais", schema, merge) == 2
    assert rows(read(), "k", "inicio", "eventos", "valor_total") == want
    land(spark, src, [(9, "b", 20, 1.0)])
    drained(spark, src, start)
    assert corrections.compact_partials(spark, f"{out}/parciais", schema, merge) == 3
    assert corrections.compact_partials(spark, f"{out}/parciais", schema, merge) == 3
    assert [tuple(r)[3:7] for r in rows(read().where("k = 'b' and eventos = 2"))] == [(2, 1, True, 3.0)]
    assert len(corrections.stored_partials(spark, f"{out}/parciais", schema).inputFiles()) >= 1

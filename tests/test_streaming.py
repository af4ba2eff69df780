"""Streams run with availableNow and compared with the batch result of the same operator."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.operators import indicators
from candlewick.operators.series import HOURLY, TICK
from candlewick.plans.streaming import ALERT
from candlewick.sources import files, tables
from candlewick.streaming import consolidators as con
from candlewick.streaming import jobs


def frame(df, *order):
    return df.toPandas().sort_values(list(order)).reset_index(drop=True)


@pytest.fixture()
def ticks(spark, sf):
    return fx.ticks(spark, sf)


def in_files(df, folder, order, n):
    """The rows in ``n`` files in time order, one per micro-batch."""
    pdf = df.toPandas().sort_values(order)
    step = -(-len(pdf) // n)
    for i in range(n):
        part = pdf.iloc[i * step:(i + 1) * step]
        df.sparkSession.createDataFrame(part, df.schema).coalesce(1).write.mode("append").parquet(folder)
    return folder


def stream_of(spark, df, folder):
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def drain(df, name, mode, tmp):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp / f"cp-{name}")).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def test_ingest_with_rejects(spark, sf, tmp_path):
    minute = fx.minute_like(spark, sf).select(*[f.name for f in files.MINUTE.fields])
    good = files.to_messages(minute).select("value")
    bad = spark.sql("SELECT * FROM VALUES ('not json'), ('{\"open\": 1}') AS t(value)")
    good.unionByName(bad).repartition(3).write.text(str(tmp_path / "in"))
    lines = spark.readStream.text(str(tmp_path / "in"))
    args = dict(target=str(tmp_path / "out"), rejects=str(tmp_path / "bad"), checkpoint=str(tmp_path / "cp"), once=True)
    jobs.ingest(lines, **args).awaitTermination()
    jobs.ingest(lines, **args).awaitTermination()  # nothing new: nothing is written twice
    out = spark.read.parquet(args["target"])
    assert out.count() == minute.count()
    assert out.select(F.sum("close")).first()[0] == minute.select(F.sum("close")).first()[0]
    assert sorted(r.value for r in spark.read.parquet(args["rejects"]).collect()) == ['not json', '{"open": 1}']


def test_upsert_keeps_last(spark, sf, tmp_path):
    e = fx.table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    in_files(e, str(tmp_path / "in"), "event_id", 3)
    jobs.upsert_stream(stream_of(spark, e, str(tmp_path / "in")), str(tmp_path / "t"), str(tmp_path / "cp"), ["user_id", "event_type"], ["event_id"], once=True).awaitTermination()
    got = frame(jobs.current(spark, str(tmp_path / "t"), ["user_id", "event_type"], ["event_id"]), "event_id")
    want = frame(tables.keep_last(e, ["user_id", "event_type"], ["event_id"]), "event_id")
    pd.testing.assert_frame_equal(got[want.columns.tolist()], want)


def test_first_seen_drops_copies(spark, sf, tmp_path, ticks):
    doubled = ticks.unionByName(ticks)
    doubled.coalesce(1).write.parquet(str(tmp_path / "in"))
    out = drain(jobs.first_seen(stream_of(spark, doubled, str(tmp_path / "in")), ["symbol", "seq"], "ts", "1 hour"), "first_seen", "append", tmp_path)
    assert out.count() == ticks.count()


def test_windowed_bars(spark, sf, tmp_path, ticks):
    in_files(ticks, str(tmp_path / "in"), "ts", 4)
    out = drain(jobs.windowed_bars(stream_of(spark, ticks, str(tmp_path / "in")), "4 hours", "10 minutes"), "windowed", "append", tmp_path)
    got = frame(out, "symbol", "ts")
    want = frame(jobs.windowed_bars(ticks, "4 hours", "10 minutes"), "symbol", "ts")
    closed = want.merge(got[["symbol", "ts"]], on=["symbol", "ts"])
    assert len(want) - len(got) <= 10  # windows still inside the delay at the end of the feed
    pd.testing.assert_frame_equal(got, closed)


@pytest.mark.parametrize("name,step", [
    ("time_bars", lambda k: con.time_step(k, 7200)), ("count_bars", lambda k: con.count_step(k, 7)),
    ("range_bars", lambda k: con.range_step(k, 30.0)), ("quote_bars", lambda k: con.quote_step(k, 7200)),
])
def test_consolidators_on_streams(spark, sf, tmp_path, ticks, name, step):
    rows = con.prices(ticks, "price", "size").select("symbol", "ts", "seq", "open", "high", "low", "close", "volume")
    in_files(rows, str(tmp_path / "in"), "ts", 3)
    out = drain(con.consolidate_stream(stream_of(spark, rows, str(tmp_path / "in")), ["symbol"], step), f"s_{name}", "append", tmp_path)
    got, want = frame(out, "symbol", "start"), frame(con.consolidate(rows, TICK.by(span=86400 * 5), step), "symbol", "start")
    assert len(want) > 20
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_count_bars_without_state_agree_with_the_step(spark, sf, ticks):
    rows = con.prices(ticks, "price", "size")
    a = frame(con.count_bars(rows, TICK, 7), "symbol", "start")
    b = frame(con.consolidate(rows, TICK.by(span=86400 * 400), lambda k: con.count_step(k, 7)), "symbol", "start")
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_bricks_do_not_depend_on_the_buckets(spark, sf):
    bars = fx.hourly(spark, sf)
    a = frame(con.renko(bars, HOURLY.by(span=86400 * 3), "close", 5.0), "symbol", "start", "open")
    b = frame(con.renko(bars, HOURLY.by(span=86400 * 4000), "close", 5.0), "symbol", "start", "open")
    pd.testing.assert_frame_equal(a, b)


def test_live_indicators_and_alerts(spark, sf, tmp_path):
    bars = fx.hourly(spark, sf)
    in_files(bars, str(tmp_path / "in"), "ts", 3)
    wanted = {
        "sma": ("sma", {"period": 5}), "ema": ("ema", {"period": 4}), "rsi": ("rsi", {"period": 5}), "macd": ("macd", {"fast": 3, "slow": 6, "signal": 3}),
        "bands": ("bollinger", {"period": 5}), "atr": ("atr", {"period": 4}), "stoch": ("stochastic", {}), "roc": ("roc", {"period": 3}),
        "momentum": ("momentum", {"period": 3}), "williams": ("williams_r", {}), "cci": ("cci", {}), "adx": ("adx", {"period": 4}),
    }
    wanted = {k: v for k, v in wanted.items() if v[0] in indicators.REGISTRY}
    assert len(wanted) >= 11
    p = lambda n: str(tmp_path / n)
    jobs.indicator_stream(stream_of(spark, bars, p("in")), wanted, p("out"), p("tail"), p("cp"), keep=400, once=True).awaitTermination()
    got = frame(spark.read.parquet(p("out")).drop("batch"), "symbol", "ts")
    want = frame(indicators.compute(bars, wanted), "symbol", "ts")
    names = [c for c in want.columns if c in got.columns]
    assert len(got) == len(want) and len(names) > 15
    pd.testing.assert_frame_equal(got[names], want[names], rtol=1e-9, atol=1e-9)
    assert got["ready"].any() and not got["ready"].all()

    jobs.alert_stream(stream_of(spark, bars, p("in")), ALERT, p("alerts"), p("tail2"), p("cp2"), keep=100, once=True).awaitTermination()
    got = frame(spark.read.parquet(p("alerts")).drop("batch"), "symbol", "ts")
    pd.testing.assert_frame_equal(got, frame(jobs.alerts(bars, ALERT), "symbol", "ts"))


def test_latest_per_topic_on_stream(spark, sf, tmp_path):
    e = fx.table(spark, sf, "events").select(F.col("event_type").alias("topic"), F.col("ts").cast("timestamp").alias("ts"), "value")
    in_files(e, str(tmp_path / "in"), "ts", 3)
    out = drain(jobs.latest_per_topic(stream_of(spark, e, str(tmp_path / "in")), "topic", "ts", "value", "1 hour"), "latest", "update", tmp_path)
    got = frame(out.groupBy("topic", "interval").agg(F.max("ts").alias("ts"), F.max_by("value", "ts").alias("value")), "topic", "interval")
    pd.testing.assert_frame_equal(got, frame(jobs.latest_per_topic(e, "topic", "ts", "value", "1 hour"), "topic", "interval"))


def test_hourly_counts_on_stream(spark, sf, tmp_path):
    e = fx.table(spark, sf, "events").select(F.col("event_type").alias("category"), F.col("ts").cast("timestamp").alias("ts"))
    in_files(e, str(tmp_path / "in"), "ts", 3)
    s = stream_of(spark, e, str(tmp_path / "in"))
    got = frame(drain(jobs.hourly_counts(s, "category", "ts", "10 minutes"), "counts", "append", tmp_path), "category", "hour")
    want = frame(jobs.hourly_counts(e, "category", "ts", "10 minutes"), "category", "hour")
    pd.testing.assert_frame_equal(got, want.merge(got[["category", "hour"]], on=["category", "hour"]))
    assert len(want) - len(got) <= 10


def test_replay_is_paced(spark, sf, tmp_path):
    m = fx.minute_like(spark, sf).select(*[f.name for f in files.MINUTE.fields])
    m.repartition(4).write.option("header", True).csv(str(tmp_path / "in"))
    seen = []
    q = files.replay(spark, str(tmp_path / "in"), files.MINUTE).writeStream.foreachBatch(lambda d, i: seen.append(d.count())).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert len([n for n in seen if n]) == 4 and sum(seen) == m.count()
    assert os.path.isdir(tmp_path / "cp")

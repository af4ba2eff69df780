"""Silver layout, paced replay, record mapping, numbering of common values and pieces of pair sums."""

import re
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.operators import joins, ranking, risk, windows
from candlewick.plans.sources import BAR, mixed_records, silver_days
from candlewick.sources import replay, tables
from test_plans import plan


def frame(df, *order):
    return df.toPandas().sort_values(list(order)).reset_index(drop=True)


def test_silver_scans_prune_and_its_days_need_no_shuffle(spark, sf, tmp_path):
    bars = tables.write_silver(fx.minute_like(spark, sf).select(*BAR, "seq"), "silver_test", str(tmp_path / "silver"), buckets=4)
    assert bars.count() == fx.minute_like(spark, sf).count()
    part = tables.silver_range(spark, "silver_test", "2024-01-05", "2024-01-25")
    text = plan(part)
    assert "PartitionFilters: [isnotnull(month" in text and "2024-01" in text and "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp" in text
    days = plan(silver_days(bars))
    assert "Exchange" not in days and "SelectedBucketsCount: 4 out of 4" in days
    got = frame(silver_days(bars), "symbol", "seq")
    want = frame(silver_days(fx.minute_like(spark, sf).withColumn("day", F.to_date("timestamp"))), "symbol", "seq")
    pd.testing.assert_frame_equal(got, want)


def test_replay_keeps_its_pace_and_its_place(spark, tmp_path):
    rows = spark.range(90).select(F.col("id").alias("at"), F.lit("A").alias("symbol"))
    path = lambda n: str(tmp_path / n)
    assert replay.number_messages(rows.repartition(7), ["at"], path("rows")) == 90
    sent = []

    def sink(messages, number):
        sent.append((number, time.monotonic(), sorted(int(r.v) for r in messages.select(F.get_json_object("value", "$.at").alias("v")).collect())))

    first = replay.paced(spark, path("rows"), 90, 40, sink, path("cp"), every_s=0.5)
    while len(sent) < 2:
        first.awaitTermination(0.05)
    while first.status["isTriggerActive"]:
        time.sleep(0.02)
    first.stop()
    again = replay.paced(spark, path("rows"), 90, 40, sink, path("cp"), every_s=0.5)  # goes on where the first one stopped
    replay.finish(again, 90, 40, every_s=0.5)
    batches = {n: values for n, _, values in sent}
    assert [v for n in sorted(batches) for v in batches[n]] == list(range(90))
    assert [len(batches[n]) for n in sorted(batches)] == [20, 20, 20, 20, 10]
    times = [t for n, t, _ in sent]
    assert times[-1] - times[0] >= 1.2  # 70 messages at 40 a second


def test_looped_replay_counts_its_passes(spark, tmp_path):
    rows = spark.range(7).select(F.col("id").alias("at"), F.lit("A").alias("symbol"))
    path = lambda n: str(tmp_path / n)
    replay.number_messages(rows, ["at"], path("rows"))
    sent = []
    query = replay.paced(spark, path("rows"), 7, 20, lambda m, i: sent.append([tuple(r) for r in m.select(F.get_json_object("value", "$.pass_no"), F.get_json_object("value", "$.at")).collect()]), path("cp"), once=False, every_s=0.5)
    while len(sent) < 3:
        query.awaitTermination(0.05)
    while query.status["isTriggerActive"]:
        time.sleep(0.02)
    query.stop()
    got = [(int(p), int(a)) for batch in sent[:3] for p, a in sorted((int(p), int(a)) for p, a in batch)]
    assert got == [(i // 7, i % 7) for i in range(30)]


def test_unknown_schemas_and_shared_targets(spark, sf):
    rows = mixed_records(spark, sf).collect()
    assert {r.schema for r in rows if r.errors == ["unknown schema"]} == {"NONE"}
    order = next(r for r in rows if r.schema == "ORDER")
    assert order.type == "MARKET" and order.price is None and order.symbol == order.symbol.upper()
    empty = tables.normalise_stream(spark.createDataFrame([(1, None, None)], "id int, schema string, value string"), "value", "schema", {"QUOTE": [{"target": "price", "expression": "$.p"}]}, {})
    assert [tuple(r) for r in empty.collect()] == [(1, None, None, ["unknown schema"])]


@pytest.mark.parametrize("common", [3, 100_000])
def test_numbers_of_common_values(spark, common):
    rng = np.random.default_rng(4)
    rows = pd.DataFrame({"g": rng.integers(0, 2, 900).astype(str), "v": np.where(rng.random(900) < 0.5, 1.0, rng.integers(0, 9, 900)), "id": [f"s{i:04d}" for i in rng.permutation(900)]})
    df = spark.createDataFrame(rows).withColumn("v", F.when(F.col("v") != 5, F.col("v")))
    got = frame(ranking.ordinals(df, ["g"], "v", ["id"], "n", common), "id")
    want = frame(df, "id")
    want["n"] = want[want["v"].notna()].groupby(["g", "v"]).cumcount() + 1
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_a_common_value_is_not_numbered_by_one_window(spark, monkeypatch):
    monkeypatch.setattr(ranking.ordinals, "__defaults__", (50,))
    df = spark.range(400).select(F.lit(7.0).alias("value"), F.lit(0).alias("ts"), F.format_string("s%04d", "id").alias("symbol"))
    ranked = windows.cross_rank(df, "value")
    assert "_piece" in plan(ranked) and [r["rank"] for r in ranked.orderBy("symbol").collect()] == list(range(1, 401))


def panel_rows(fill, seed=3, times=60, symbols=11):
    rng = np.random.default_rng(seed)
    cells = [(t, f"s{s:02d}", float(rng.normal())) for t in range(times) for s in range(symbols) if rng.random() < fill]
    return pd.DataFrame(cells, columns=["t", "symbol", "ret"]).assign(ts=lambda d: pd.Timestamp("2024-01-01") + pd.to_timedelta(d["t"], unit="D")).drop(columns="t")


@pytest.mark.parametrize("fill, sparse, blocks", [(0.9, 0.05, 4), (0.5, 1.1, 1), (0.3, 1.1, 3)])
def test_dense_and_listed_pieces(spark, monkeypatch, fill, sparse, blocks):
    monkeypatch.setattr(joins, "SPARSE", sparse)
    monkeypatch.setattr(joins, "PAIRS", 50)
    monkeypatch.setattr(joins, "BLOCK_SYMBOLS", -(-11 // blocks))
    monkeypatch.setattr(joins, "CHUNK_TIMES", 16)
    rows = panel_rows(fill)
    df = spark.createDataFrame(rows)
    assert joins.plan_pieces(df, "ts", "symbol")[0] == blocks
    got = frame(joins.correlation_pairs(df, "ts", "symbol", "ret"), "a", "b")
    wide = rows.pivot(index="ts", columns="symbol", values="ret")
    cov, corr = wide.cov(), wide.corr()
    known = wide.notna().astype(int)
    assert len(got) == (np.triu(known.T @ known) > 0).sum() >= 60
    for r in got.itertuples():
        n = (wide[r.a].notna() & wide[r.b].notna()).sum()
        assert r.n == n and r.cov == pytest.approx(cov.loc[r.a, r.b]) and r.corr == pytest.approx(corr.loc[r.a, r.b])


def test_frontier_in_tiles(spark):
    rows = spark.createDataFrame(panel_rows(0.95))
    means = rows.groupBy("symbol").agg(F.avg("ret").alias("mean"))
    cov = risk.covariance(rows)
    one, many = (frame(risk.random_frontier(cov, means, 60, seed=3, buckets=5, block=b), "bucket") for b in (512, 3))
    pd.testing.assert_frame_equal(one, many, rtol=1e-9)


def test_pieces_of_one_chunk_are_not_summed_again(spark, monkeypatch):
    """Blocks follow from the number of symbols, a symbol travels as one row, and rows without a time or symbol meet nothing."""
    monkeypatch.setattr(joins, "BLOCK_SYMBOLS", 3)
    rows = panel_rows(0.9, symbols=17)
    odd = pd.DataFrame({"symbol": [None, "s03"], "ret": [5.0, 7.0], "ts": [rows["ts"].iloc[0], pd.NaT]})
    df = spark.createDataFrame(pd.concat([rows, odd], ignore_index=True))
    out = joins.pair_sums(df, "ts", "symbol", "ret", times=1)
    assert plan(out).count("hashpartitioning(a") == 0
    got, want = frame(out, "a", "b"), frame(joins.pair_sums(spark.createDataFrame(rows), "ts", "symbol", "ret", blocks=1, times=4), "a", "b")
    pd.testing.assert_frame_equal(got, want)
    assert len(got) == 17 * 18 / 2 and got.equals(got[got["a"] <= got["b"]])


def test_a_value_travels_once_per_stack_of_blocks(spark, monkeypatch):
    """Many blocks are no reason to send a symbol's values to as many tasks: the copies shuffled do not grow with the blocks."""
    monkeypatch.setattr(joins, "BLOCK_SYMBOLS", 1)
    rows = panel_rows(0.7, symbols=40)
    df = spark.createDataFrame(rows)
    blocks, times, stacks = joins.plan_pieces(df, "ts", "symbol")
    assert blocks > 30 and times == 1 and stacks * stacks <= 16 * spark.sparkContext.defaultParallelism and stacks < blocks
    out = joins.pair_sums(df, "ts", "symbol", "ret")
    assert re.search(rf"_own#\d+ % {stacks}\)", out._jdf.queryExecution().optimizedPlan().toString())
    got, want = frame(out, "a", "b"), frame(joins.pair_sums(df, "ts", "symbol", "ret", blocks=1, times=1), "a", "b")
    pd.testing.assert_frame_equal(got, want)


def test_radius_in_pieces_of_cubes(spark, monkeypatch):
    """Crowded cubes are dealt to pieces, no side is sent whole to every task, and poles and the date line hold."""
    monkeypatch.setattr(joins, "REACHED", 40)
    rng = np.random.default_rng(5)
    lat = np.concatenate([rng.uniform(-90, 90, 150), rng.uniform(88, 90, 40), rng.uniform(50, 51, 200), [np.nan]])
    lon = np.concatenate([rng.uniform(-180, 180, 150), rng.uniform(-180, 180, 40), np.where(rng.random(200) < 0.5, 179.9, -179.9), [0.0]])
    places = pd.DataFrame({"lat": lat, "lon": lon}).reset_index(names="point")
    points = spark.createDataFrame(places).replace(float("nan"), None)
    centres = points.filter("point % 3 = 0").withColumnRenamed("point", "centre")
    out = joins.within_radius(centres, points, 300.0)
    text = plan(out)
    assert "_piece" in text and "BroadcastHashJoin [_x" not in text
    got = {(r.centre, r.point): r.distance_km for r in out.collect()}
    p = np.radians(places[["lat", "lon"]].to_numpy()[:-1])
    d = p[:, None] - p[None]
    a = np.sin(d[..., 0] / 2) ** 2 + np.cos(p[:, None, 0]) * np.cos(p[None, :, 0]) * np.sin(d[..., 1] / 2) ** 2
    km = 2 * 6371 * np.arctan2(np.sqrt(a), np.sqrt(1 - a))
    want = {(i, j): km[i, j] for i in range(0, len(p), 3) for j in range(len(p)) if km[i, j] <= 300}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)


def test_top_rows_rank_no_others(spark):
    """The first rows of a cross-section need neither a join nor counts of all its values; nulls and NaN are not ranked, ties go by symbol."""
    rng = np.random.default_rng(6)
    rows = pd.DataFrame({"ts": rng.integers(0, 4, 300), "symbol": [f"s{i:03d}" for i in rng.permutation(300)], "close": rng.integers(0, 8, 300).astype(float)})
    df = spark.createDataFrame(rows).withColumn("close", F.when(F.col("close") == 7, F.lit(None)).when(F.col("close") == 6, F.lit(float("nan"))).otherwise(F.col("close")))
    known = rows[rows["close"] < 6]
    for bottom in (False, True):
        out = windows.cross_top(df, "close", 5, bottom=bottom)
        assert "Join" not in plan(out)
        want = known.sort_values(["close", "symbol"], ascending=[bottom, True]).groupby("ts").head(5)
        want = want.assign(rank=want.groupby("ts").cumcount() + 1).sort_values(["ts", "rank"]).reset_index(drop=True)
        pd.testing.assert_frame_equal(frame(out, "ts", "rank")[want.columns], want, check_dtype=False)

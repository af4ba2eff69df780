"""File and table sources on a scratch folder."""

import os

import pytest
from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.sources import files, tables


@pytest.fixture()
def minute(spark, sf):
    return fx.minute_like(spark, sf).select(*[f.name for f in files.MINUTE.fields])


def test_csv_glob_and_pipeline(spark, minute, tmp_path):
    for i in range(2):
        minute.filter(F.pmod(F.xxhash64("timestamp"), F.lit(2)) == i).write.option("header", True).csv(str(tmp_path / f"in/part{i}"))
    back = files.read_minute_csv(spark, str(tmp_path / "in/*/*.csv"))
    assert back.count() == minute.count() and back.schema.fieldNames() == files.MINUTE.fieldNames()
    status = tables.medallion(spark, str(tmp_path / "in/*/*.csv"), str(tmp_path / "silver"), str(tmp_path / "gold"))
    assert status == {"hourly": "ok", "daily": "ok"}
    gold = spark.read.parquet(str(tmp_path / "gold/daily"))
    symbols = {d.split("=")[1] for d in os.listdir(tmp_path / "gold/daily") if d.startswith("symbol=")}
    assert symbols == {r.symbol for r in minute.select("symbol").distinct().collect()}
    plan = gold.filter("symbol = 'click'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan


def test_fan_out_reports_every_sink_and_fails(spark, minute, tmp_path):
    def broken(_):
        raise IOError("disk gone")

    done = []
    with pytest.raises(RuntimeError, match="broken"):
        tables.fan_out(minute, {"broken": broken, "fine": lambda d: done.append(d.count())})
    assert done == [minute.count()]
    assert tables.fan_out(minute.limit(0), {"broken": broken}) == {"broken": "skipped"}


def test_upsert_replay_changes_nothing(spark, minute):
    keys, order = ["symbol", "timestamp"], ["timestamp"]
    once = tables.upsert(minute.limit(0), minute, keys, order)
    twice = tables.upsert(once, minute, keys, order)
    assert once.exceptAll(twice).count() == 0 and once.count() == twice.count()


def test_backfill_resumes(spark, tmp_path):
    life = spark.sql("SELECT 'A' AS symbol, DATE '2024-01-01' AS first_day, DATE '2024-01-05' AS last_day")
    days = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-31')) AS day").filter(F.weekday("day") < 5)
    ledger = spark.sql("SELECT DATE '2024-01-02' AS day, 'A' AS symbol")
    todo = tables.pending_units(days, life, ledger, ["day", "symbol"])
    assert todo.count() == 4
    assert tables.pending_units(days, life, ledger, ["day", "symbol"], force=True).count() == 5
    t, l = str(tmp_path / "t"), str(tmp_path / "l")
    assert tables.backfill(spark, todo, lambda u: u.withColumn("x", F.lit(1)), t, l, ["day", "symbol"]) == 4
    rest = tables.pending_units(days, life, ledger.unionByName(spark.read.parquet(l)), ["day", "symbol"])
    assert tables.backfill(spark, rest, lambda u: u, t, l, ["day", "symbol"]) == 0

    def fails(u):
        raise IOError("no feed")

    with pytest.raises(IOError):
        tables.backfill(spark, tables.pending_units(days, life, ledger, ["day", "symbol"], True), fails, t, l, ["day", "symbol"])
    assert spark.read.parquet(l).count() == 4


def test_csv_texts(spark):
    df = spark.sql("SELECT 1 AS id, 'a;b\r\n1;x\r\n2;\r\n\r\n' AS text")
    got = files.parse_csv_text(df, "text", "a int, b string", ";", header=True).orderBy("line_no").collect()
    assert [(r.a, r.b) for r in got] == [(1, "x"), (2, None)]


def test_envelopes(spark):
    lines = spark.sql("""SELECT * FROM VALUES ('{"success":true,"data":{"type":"table","rows":[{"a":1},{"a":2}]}}'), ('{"a":3}'), ('oops'), ('{"success":false}') AS t(value)""")
    rows, bad = files.parse_envelopes(lines, "value", "a int")
    assert sorted(r.a for r in rows.collect()) == [1, 2, 3]
    assert sorted(r.value for r in bad.collect()) == ["oops", '{"success":false}']


def test_sinks_spread_a_large_value(spark, tmp_path):
    df = spark.range(20000).select(F.lit("BIG").alias("symbol"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # partitions this small are merged otherwise
    try:
        files.write_parquet(df, str(tmp_path / "g"), by=["symbol"], files_per_part=4)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = [f for f in os.listdir(tmp_path / "g/symbol=BIG") if f.endswith(".parquet")]
    assert 1 < len(parts) <= 4

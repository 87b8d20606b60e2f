from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rillflow.schemas import SILVER
from rillflow.streaming.sessions import TOTALS, SessionStream, merge_totals, run_available, session_totals

NAMES = SILVER["weblogs_clean"].names


def silver(spark, rows):
    absent = [f for f in SILVER["weblogs_clean"].fields if f.name not in rows.columns]
    return rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent]).select(*NAMES)


def logs(spark, *rows):
    """``(log_id, session, action, minutes after midnight)``"""
    made = spark.createDataFrame(
        [(i, s, a, m) for i, s, a, m in rows], "log_id long, session_id string, action string, m int"
    )
    ts = F.expr("timestampadd(MINUTE, m, TIMESTAMP_NTZ'2024-01-01')")
    return silver(spark, made.withColumn("action_ts", ts).drop("m"))


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_closed_sessions_equal_the_batch_result(spark, tmp_path):
    rows = spark.range(4000).select(
        F.expr("concat('sess_', id % 40)").alias("session_id"),
        F.expr("CASE id % 3 WHEN 0 THEN 'view' WHEN 1 THEN 'add_to_cart' ELSE NULL END").alias("action"),
        F.expr(
            "timestampadd(MINUTE, cast(id % 40 * 2000 + id DIV 40 AS int), TIMESTAMP_NTZ'2024-01-01')"
        ).alias("action_ts"),
    )
    silver(spark, rows).write.parquet(str(tmp_path / "silver"))
    got = run_available(spark, str(tmp_path / "silver"), str(tmp_path / "out"))
    horizon = rows.agg(F.max("action_ts")).first()[0]
    every = session_totals(rows, "1 day")
    assert same(got, every)
    stream = SessionStream(spark, str(tmp_path / "out"))
    ended = F.col("session_end") + F.expr("INTERVAL 2 DAYS") < F.lit(horizon)
    assert every.where(ended).count() == 38
    assert same(stream.closed(), every.where(ended)) and same(stream.open(), every.where(~ended))
    assert stream.late().isEmpty()


def test_neighbours_exactly_one_gap_apart_fall_together_as_in_a_batch(spark):
    some = logs(spark, (1, "a", "view", 0), (2, "a", "view", 60), (3, "a", "view", 121), (4, "b", None, 5))
    whole = session_totals(some, "60 minutes")
    parts = None
    for i in range(1, 5):
        one = session_totals(some.where(F.col("log_id") == i), "60 minutes")
        parts = one if parts is None else parts.unionByName(one)
    assert same(merge_totals(parts, "60 minutes"), whole)


def arrivals(stream, *batches):
    for n, batch in enumerate(batches):
        stream.process_batch(batch, n)


def test_three_arrivals_with_late_logs(spark, tmp_path):
    first = logs(
        spark, (1, "a", "view", 0), (2, "a", "purchase", 30), (3, "b", "view", 500), (4, None, "view", 9000)
    )
    second = logs(
        spark, (5, "a", "view", 31), (6, "b", "add_to_cart", 520), (7, "c", "view", 439), (8, "c", "view", 440)
    )
    third = logs(spark, (9, "b", "view", 575), (10, "d", "view", 2000))
    stream = SessionStream(spark, str(tmp_path / "s"), "60 minutes", "60 minutes")
    arrivals(stream, first, second, third)
    # 440 is the watermark after the first arrival
    assert sorted((r.log_id, r.batch) for r in stream.late().collect()) == [(5, 1), (7, 1)]
    everything = first.unionByName(second).unionByName(third)
    in_time = everything.where(~F.col("log_id").isin(5, 7))
    assert same(stream.totals(), session_totals(in_time, "60 minutes"))
    assert [r.session_id for r in stream.open().collect()] == ["d"]
    assert same(stream.reconciled(), session_totals(everything, "60 minutes"))


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    batches = [
        logs(spark, (1, "a", "view", 0), (2, "b", "view", 10)),
        logs(spark, (3, "a", "view", 50), (4, "c", "view", 300)),
        logs(spark, (5, "c", "purchase", 310), (6, "a", "view", 20)),
    ]
    stream = SessionStream(spark, str(tmp_path / "s"), "60 minutes", "30 minutes")
    arrivals(stream, *batches)
    before = [df.collect() for df in (stream.closed(), stream.open(), stream.late())]
    stream.process_batch(batches[2], 2)
    after = [df.collect() for df in (stream.closed(), stream.open(), stream.late())]
    assert [sorted(x) for x in before] == [sorted(x) for x in after]


def test_a_batch_that_stopped_before_its_end_does_not_count(spark, tmp_path, monkeypatch):
    stream = SessionStream(spark, str(tmp_path / "s"), "60 minutes", "30 minutes")
    first, second = logs(spark, (1, "a", "view", 0)), logs(spark, (2, "a", "view", 10), (3, "b", "view", 900))
    stream.process_batch(first, 0)
    write = SessionStream._write

    def stops(self, df, output, batch_id):
        if output == "horizon":
            raise RuntimeError("stopped")
        write(self, df, output, batch_id)

    monkeypatch.setattr(SessionStream, "_write", stops)
    with pytest.raises(RuntimeError, match="stopped"):
        stream.process_batch(second, 1)
    assert same(stream.totals(), session_totals(first, "60 minutes")) and stream.closed().isEmpty()
    monkeypatch.setattr(SessionStream, "_write", write)
    stream.process_batch(second, 1)
    assert same(stream.totals(), session_totals(first.unionByName(second), "60 minutes"))
    assert [r.session_end for r in stream.closed().collect()] == [datetime(2024, 1, 1, 0, 10)]


def test_nothing_came(spark, tmp_path):
    stream = SessionStream(spark, str(tmp_path / "s"))
    assert stream.totals().isEmpty() and stream.late().isEmpty() and stream.totals().schema == TOTALS
    empty = logs(spark, (1, "a", "view", 0)).where("false")
    stream.process_batch(empty, 0)
    assert stream.totals().isEmpty()
    stream.process_batch(logs(spark, (1, "a", "view", 0)), 1)
    assert stream.open().count() == 1 and stream.reconciled().count() == 1


def test_one_file_per_batch_and_a_trigger(spark, tmp_path):
    rows = logs(spark, *[(i, f"s{i % 3}", "view", i * 7) for i in range(60)])
    for k in range(3):  # in event order, so that nothing is late
        rows.where(F.col("log_id").between(20 * k, 20 * k + 19)).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    stream = SessionStream(spark, str(tmp_path / "s"), "10 minutes", "5 minutes")
    stream.run_available(str(tmp_path / "in/*"), trigger={"once": True})
    assert same(stream.totals(), session_totals(rows, "10 minutes"))

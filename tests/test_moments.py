import numpy as np
import pytest
from pyspark.sql import functions as F

from rillflow.operators.moments import Moments, merge, moments
from rillflow.schemas import AGG
from rillflow.sources.lake import Lake


def test_merged_parts_equal_the_whole(spark):
    rng = np.random.default_rng(4)
    values = (1e9 + rng.normal(0, 3, 5000)).tolist()  # a plain sum of squares would lose all digits
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(5000, None)], "id long, v double")
    parts = [moments(frame.where(F.col("id") % 7 == k), "v") for k in range(7)] + [Moments()]
    got = merge(parts)
    assert got.n == 5000 and got.mean == pytest.approx(np.mean(values), abs=1e-6)
    assert got.limit(2) == pytest.approx(np.mean(values) + 2 * np.std(values, ddof=1), abs=1e-5)
    assert merge([]).limit(2) is None and moments(frame.where("id = 3"), "v").limit(2) is None
    assert moments(frame.where("false"), "v") == Moments()


def sessions(spark, first, *durations):
    rows = spark.createDataFrame([(f"s{first + i}", float(d)) for i, d in enumerate(durations)], "session_id string, session_duration_s double")
    absent = [f for f in AGG.fields if f.name not in rows.columns]
    out = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])
    return out.withColumn("etl_run_date", F.lit("2024-06-07").cast("date")).select(*AGG.names)


def test_loads_note_their_moments(spark, tmp_path, ctx, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.init_gold(ctx)
    name = "agg_session_metrics"
    assert lake.gold_moments(name) == Moments()
    lake.append_gold(sessions(spark, 0, 1, 2, 3), name, sort=["session_id"])
    lake.append_gold(sessions(spark, 3, 10, 20), name, sort=["session_id"])
    want = [1, 2, 3, 10, 20]
    assert lake.gold_moments(name).limit(2) == pytest.approx(np.mean(want) + 2 * np.std(want, ddof=1))
    # rows that came without a note: the table itself decides
    sessions(spark, 9, 500).drop("etl_run_date").write.parquet(f"{lake.root}/gold/{name}/etl_run_date=2024-06-09")
    want.append(500)
    assert lake.gold_moments(name).limit(2) == pytest.approx(np.mean(want) + 2 * np.std(want, ddof=1))
    lake.overwrite_gold(sessions(spark, 0, 4, 6), name, sort=["session_id"])
    got = lake.gold_moments(name)
    assert (got.n, got.mean, got.m2) == (2, 5.0, pytest.approx(2.0))

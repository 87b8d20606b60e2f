from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rillflow.functions.scalars import parse_timestamp
from rillflow.operators.formats import parse_by_first_format, shape

TIMES = [
    ("2024-06-01", datetime(2024, 6, 1), datetime(2024, 6, 1)),
    ("2024-06-01T10:00:00", datetime(2024, 6, 1, 10), datetime(2024, 6, 1, 10)),
    ("2024-06-01T10:00:00Z", None, datetime(2024, 6, 1, 10)),
    ("2024-06-01 10:00:00.25+02:00", None, datetime(2024, 6, 1, 8, 0, 0, 250000)),
    ("2024-06-01T10:00+0530", None, datetime(2024, 6, 1, 4, 30)),
    ("2024-06-01T01:00:00-03", None, datetime(2024, 6, 1, 4)),
    ("1969-12-31T23:59:59.999999Z", None, datetime(1969, 12, 31, 23, 59, 59, 999999)),
    ("2024-10-27T01:30:00+01:00", None, datetime(2024, 10, 27, 0, 30)),
    ("2024-06-01Z", None, None),
    ("2024-06-31T10:00:00Z", None, None),
    ("2024-06-01T10:00:00 Europe/Paris", None, None),
    ("invalid", None, None),
    (None, None, None),
]


@pytest.mark.parametrize("session_zone", ["UTC", "Europe/Berlin", "America/New_York"])
def test_zones(spark, session_zone):
    keep = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(TIMES)], "i int, t string")
        got = df.select("i", parse_timestamp(F.col("t")).alias("a"), parse_timestamp(F.col("t"), "utc").alias("b"))
        assert [(r.a, r.b) for r in got.orderBy("i").collect()] == [(a, b) for _, a, b in TIMES]
    finally:
        spark.conf.set("spark.sql.session.timeZone", keep)
    with pytest.raises(ValueError, match="Unknown zone rule"):
        parse_timestamp(F.col("t"), "local")


def test_shapes(spark):
    texts = ["2024-06-01", "2024-06-01 10:00:00", "2024-06-01 10:00:00.5", "2024-06-01 10:00:00.123+02", "2024-06-01T10:00-0530"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(shape(F.col("t"))).collect()] == [
        "0000-00-00", "0000-00-00 00:00:00", "0000-00-00 00:00:00.0", "0000-00-00 00:00:00.0z", "0000-00-00T00:00z",
    ]


def test_first_value_of_a_chunk_decides(spark):
    texts = [None, "2024-01-01 00:00:00", "2024-01-01T00:00:00", "2024-01-02 00:00:00", "bad"]
    texts += ["bad", "2024-01-01", "2024-01-01T00:00:00", None, "2024-01-03 00:00:00"]
    texts += [None] * 5 + ["2024-01-01T00:00:00Z", "2024-01-01T02:00:00+0200", "2024-01-01T00:00:00"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row_index long, t string").repartition(3)
    got = parse_by_first_format(df, "t", "ts", chunk_rows=5, zone="utc").orderBy("row_index").collect()
    assert [r.row_index for r in got if r.ts is not None] == [1, 3, 6, 7, 9, 15, 16]
    assert got[16].ts == got[15].ts == datetime(2024, 1, 1)
    default = parse_by_first_format(df, "t", "ts", chunk_rows=5).orderBy("row_index").collect()
    assert [r.row_index for r in default if r.ts is not None] == [1, 3, 6, 7, 9, 17]

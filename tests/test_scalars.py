from datetime import datetime

from pyspark.sql import functions as F

from rillflow.functions import scalars as S
from rillflow.operators.sessions import abandoned_cart, high_activity


def values(spark, texts, function, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, t {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("t"))).collect()]


def test_timestamps_follow_one_fixed_rule(spark):
    texts = [
        "2024-06-01T10:00:00", "2024-06-01 10:00:00.25", "2024-06-01", "garbage", None,
        "2024-13-01", "2024", "12345", "06/02/2024", "2024-06-01T10:00:00Z",
    ]
    assert values(spark, texts, S.parse_timestamp) == [
        datetime(2024, 6, 1, 10), datetime(2024, 6, 1, 10, 0, 0, 250000), datetime(2024, 6, 1),
        None, None, None, None, None, None, None,
    ]


def test_emails(spark):
    texts = ["a@example.com", "invalid_email", None, "no-at-sign.com", "b@x.co", "a b@x.com"]
    assert values(spark, texts, S.valid_email) == [True, False, False, False, True, False]


def test_sessions(spark):
    texts = ["sess_1", "sess_", "bad", None, "xsess_1", "sess_12x"]
    assert values(spark, texts, S.valid_session) == [True, False, False, False, False, False]


def test_actions(spark):
    texts = [" View ", "PURCHASE", "add_to_cart", "bogus", "\tview\n", " VIEW ", None]
    assert values(spark, texts, S.known_action) == [
        "view", "purchase", "add_to_cart", None, "view", "view", None,
    ]


def test_ids_and_numbers(spark):
    texts = ["5", "5.0", "5.7", "abc", None, "9007199254740993", "NaN", "1e30", "5d", " 7 "]
    assert values(spark, texts, S.to_id) == [
        5, 5, None, None, None, 9007199254740993, None, None, None, 7,
    ]
    assert values(spark, ["1.5", "NaN", "inf", "x", "2f"], S.to_double) == [
        1.5, None, None, None, None,
    ]


def test_ratio_never_divides_by_zero(spark):
    df = spark.createDataFrame([(2, 4), (0, 0), (5, 0)], "p long, v long")
    got = [r[0] for r in df.select(S.safe_ratio(F.col("p"), F.col("v"))).collect()]
    assert got == [0.5, None, None]


def test_session_rules(spark):
    df = spark.createDataFrame([(3, 0, 10), (0, 0, 51), (2, 1, 50)], "a long, p long, n long")
    rows = df.select(abandoned_cart(F.col("a"), F.col("p")), high_activity(F.col("n"))).collect()
    assert [tuple(r) for r in rows] == [(True, False), (False, True), (False, False)]


def test_durations_do_not_depend_on_the_session_zone(spark):
    # The two differ by 3602.2 seconds although the clock of Berlin jumps in between.
    sql = "TIMESTAMP_NTZ'2024-03-31 01:59:59.9' AS a, TIMESTAMP_NTZ'2024-03-31 03:00:02.1' AS b"
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", name)
            df = spark.sql(f"SELECT {sql}")
            row = df.select(S.elapsed_seconds("a", "b"), S.elapsed_whole_seconds("a", "b")).first()
            assert abs(row[0] - 3602.2) < 1e-9 and row[1] == 3603.0
            micros = df.select(S.as_utc("a").cast("double")).first()[0]
            assert micros == 1711850399.9
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_whole_seconds_count_boundaries(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00.9' AS a, TIMESTAMP_NTZ'2024-01-01 00:00:02.1' AS b"
    )
    assert df.select(S.elapsed_whole_seconds("a", "b")).first()[0] == 2.0


def test_na_words_become_null(spark):
    texts = ["NA", "None", "null", "", "N/A", "nan", "ok", "na"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.t for r in S.blank_na(df).orderBy("i").collect()]
    assert got == [None, None, None, None, None, None, "ok", "na"]

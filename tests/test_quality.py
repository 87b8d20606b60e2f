import json

import pytest
from pyspark.sql import functions as F

from rillflow.operators import joins
from rillflow.operators.quality import classify, clean, quarantine, required_mask, validate
from rillflow.schemas import QUARANTINE
from tests.conftest import PRODUCTS, USERS, WEBLOGS, column


def test_users(raw, ctx):
    kept, lost = validate(raw("users", USERS), "users", ctx, "users.csv")
    assert column(kept, "user_id") == [1, 2, 3, 5]
    assert column(kept, "is_invalid_email") == [False] * 4
    assert column(kept, "is_duplicate_email") == [False] * 4
    assert column(kept, "user_name")[-1] == "unknown"
    assert lost.count() == 0 and lost.columns == QUARANTINE.names


def test_the_latest_version_decides_even_when_it_is_bad(raw):
    rows = [(1, "old", "a@x.com", "2024-01-01"), (1, "new", "a@x.com", "invalid_date")]
    judged = classify(raw("users", rows), "users")
    assert column(judged, "rejection_reason") == ["invalid signup_date"]
    assert clean(judged, "users").count() == 0


def test_null_and_unreadable_user_ids_are_rejected_each(raw):
    rows = [(None, "a", None, "bad"), (None, "b", None, "2024-01-01"), ("x1", "c", None, "2024-01-01")]
    judged = classify(raw("users", rows), "users")
    assert column(judged, "rejection_reason") == ["null user_id"] * 3


def test_emails_are_flagged_on_kept_rows_only(raw):
    rows = [
        (1, "a", "s@x.com", "invalid_date"),
        (2, "b", "s@x.com", "2024-01-01"),
        (3, "c", "s@x.com", "2024-01-01"),
        (4, "d", "invalid_email", "2024-01-01"),
        (5, "e", None, "2024-01-01"),
        (6, "f", None, "2024-01-01"),
    ]
    kept = clean(classify(raw("users", rows), "users"), "users")
    assert column(kept, "is_duplicate_email") == [False, True, False, False, False]
    assert column(kept, "is_invalid_email") == [False, False, True, True, True]


def test_products(raw, ctx):
    kept, lost = validate(raw("products", PRODUCTS), "products", ctx, "products.csv")
    assert column(kept, "product_id") == [10, 20, 30, 50]
    assert column(kept, "price") == [9.99, 0.0, 19.99, 49.99]
    assert lost.count() == 0
    _, lost = validate(
        raw("products", [(10, "W", "E", 9.99), (None, "G", "B", 19.99)]), "products", ctx, "p.csv"
    )
    assert column(lost, "rejection_reason") == ["null product_id"]


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_weblogs(raw, dims, ctx, monkeypatch, limit):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
    users, products = dims
    kept, lost = validate(
        raw("weblogs", WEBLOGS), "weblogs", ctx, "weblogs.csv", users=users, products=products
    )
    assert column(kept, "log_id") == [1, 2]
    assert column(lost, "rejection_reason") == [
        "null user_id", "orphan user_id", "orphan product_id", "duplicate log_id",
    ]
    assert column(lost, "row_index") == [2, 3, 4, 5]


def test_a_later_batch_sees_ids_of_rejected_rows(raw, dims, ctx):
    users, products = dims
    first = classify(raw("weblogs", WEBLOGS), "weblogs", users=users, products=products)
    seen = first.select("log_id").distinct()
    assert sorted(r.log_id for r in seen.collect()) == [1, 2, 3, 4, 5]
    later = raw(
        "weblogs",
        [(2, 1, 10, "sess_1", "view", "2024-06-01T11:00:00"),
         (100, 2, 20, "sess_3", "view", "2024-06-01T11:05:00")],
        first=6,
    )
    kept, lost = validate(
        later, "weblogs", ctx, "w.csv", users=users, products=products, seen=seen
    )
    assert column(kept, "log_id") == [100]
    assert column(lost, "rejection_reason") == ["duplicate log_id"]
    assert json.loads(column(lost, "raw_row")[0])["log_id"] == "2"


def test_a_copy_of_a_rejected_row_is_still_a_duplicate(raw, dims):
    users, products = dims
    rows = [(1, None, 10, "sess_1", "view", "2024-06-01"), (1, 1, 10, "sess_1", "view", "2024-06-01")]
    judged = classify(raw("weblogs", rows), "weblogs", users=users, products=products)
    assert column(judged, "rejection_reason") == ["null user_id", "duplicate log_id"]


def test_null_log_and_product_ids_pass_and_words_do_not(raw, dims):
    users, products = dims
    rows = [
        (None, 1, None, "sess_1", "view", "2024-06-01"),
        (None, 1, None, "sess_1", "view", "2024-06-01"),
        (7, "abc", 10, "sess_1", "view", "2024-06-01"),
        (8, 1, "abc", "sess_1", "view", "2024-06-01"),
        (9, "1.0", "10.0", "bad", "view", "nope"),
        (10, 1, 10, "sess_1", "view", "nope"),
    ]
    judged = classify(raw("weblogs", rows), "weblogs", users=users, products=products)
    assert column(judged, "rejection_reason") == [
        None, None, "orphan user_id", "orphan product_id", "invalid session_id",
        "invalid timestamp",
    ]


def test_classification_does_not_depend_on_partitions(raw, dims):
    users, products = dims
    frame = raw("weblogs", WEBLOGS * 20)
    want = column(classify(frame, "weblogs", users=users, products=products), "rejection_reason")
    mixed = frame.repartition(7, F.rand(3))
    got = column(classify(mixed, "weblogs", users=users, products=products), "rejection_reason")
    assert got == want


def test_quarantine_record(raw, ctx):
    rows = [(None, "a", None, "2024-01-01"), (None, 'q"uote', "x", "2024-01-01")]
    judged = classify(raw("users", rows, first=10), "users")
    records = quarantine(judged, "users", "users.csv", ctx).orderBy("row_index").collect()
    assert [r.row_index for r in records] == [10, 11]
    assert json.loads(records[0].raw_row) == {
        "user_id": None, "user_name": "a", "email": None, "signup_date": "2024-01-01",
    }
    assert json.loads(records[1].raw_row)["user_name"] == 'q"uote'
    assert records[0].etl_run_id == "run-a" and records[0].source_file == "users.csv"


def test_unknown_source_and_missing_columns_raise(raw, spark):
    with pytest.raises(ValueError, match="Unknown validation source"):
        classify(raw("users", USERS), "bogus")
    with pytest.raises(ValueError, match="Missing required columns"):
        classify(raw("users", USERS).drop("email"), "users")


def test_required_mask(spark):
    df = spark.createDataFrame([(0, 1, 1), (1, None, 2), (2, 3, None)], "i int, a int, b int")
    got = [r.is_complete for r in required_mask(df, ["a", "b"]).orderBy("i").collect()]
    assert got == [True, False, False]
    with pytest.raises(ValueError, match="Missing required columns"):
        required_mask(df, ["a", "z"])

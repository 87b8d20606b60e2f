from __future__ import annotations

import sys
from datetime import date, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rillflow.context import RunContext  # noqa: E402
from rillflow.schemas import RAW_COLUMNS, all_text  # noqa: E402
from rillflow.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ctx():
    return RunContext("run-a", date(2024, 6, 7), datetime(2024, 6, 7, 10, 0, 0))


@pytest.fixture
def ctx_next():
    return RunContext("run-b", date(2024, 6, 8), datetime(2024, 6, 8, 10, 0, 0))


@pytest.fixture
def raw(spark):
    """``raw(source, rows)``: a raw frame whose row_index is the place in the list."""

    def build(source, rows, first=0):
        text = [
            (first + i, *[None if v is None else str(v) for v in row]) for i, row in enumerate(rows)
        ]
        schema = all_text(*RAW_COLUMNS[source])
        fields = "row_index long, " + ", ".join(f"{f.name} string" for f in schema.fields)
        return spark.createDataFrame(text, fields)

    return build


USERS = [
    (1, "Alice", "a@x.com", "2024-01-01"),
    (2, "Bob", "b@x.com", "2024-02-01"),
    (3, "Carol", "invalid_email", "invalid_date"),
    (3, "Carol", "c@x.com", "2024-02-01"),
    (5, None, "e@x.com", "2024-03-01"),
]
PRODUCTS = [
    (10, "Widget", "Electronics", 9.99),
    (20, "Gadget", "Home", None),
    (30, "Gizmo", "Books", 19.99),
    (30, "Gizmo", "Books", 19.99),
    (50, "Doohickey", "Sports", 49.99),
]
WEBLOGS = [
    (1, 1, 10, "sess_1", "view", "2024-06-01T10:00:00"),
    (2, 2, 20, "sess_1", "purchase", "2024-06-01T10:05:00"),
    (3, None, 30, None, "view", "2024-06-01T10:10:00"),
    (4, 999, 40, "sess_2", "bogus_action", "invalid_timestamp"),
    (5, 5, 999, "sess_2", "add_to_cart", "2024-06-01T10:15:00"),
    (1, 1, 10, "sess_1", "view", "2024-06-01T10:00:00"),
]


@pytest.fixture
def dims(raw):
    from rillflow.operators.quality import classify, clean

    users = clean(classify(raw("users", USERS), "users"), "users")
    products = clean(classify(raw("products", PRODUCTS), "products"), "products")
    return users, products


def column(df, name, order="row_index"):
    return [r[name] for r in df.orderBy(order).collect()]

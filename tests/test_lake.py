import os

import pytest
from pyspark.sql import functions as F

from rillflow.operators.quality import classify, clean, quarantine
from rillflow.plans.silver import snapshot
from rillflow.schemas import BRONZE, RAW_COLUMNS, table
from rillflow.sources.lake import Lake
from rillflow.sources.tables import land, load_by_name, project, scan
from tests.conftest import PRODUCTS, USERS, column


@pytest.fixture(params=["parquet", "csv"])
def lake(spark, tmp_path, request):
    return Lake(spark, str(tmp_path / "lake"), request.param)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_bronze_round_trip_and_rerun(lake, raw, ctx):
    users = clean(classify(raw("users", USERS), "users"), "users")
    assert lake.write_bronze(users, "users", ctx)["rows"] == 4
    assert os.path.isdir(f"{lake.root}/bronze/users/ingest_date=2024-06-07")
    assert rows(lake.read_bronze("users", ctx)) == rows(users)
    lake.write_bronze(users.where("user_id < 3"), "users", ctx)  # nothing of the first run stays
    assert lake.read_bronze("users", ctx).count() == 2


def test_text_survives_both_formats(lake, raw, ctx):
    tricky = [(1, 'a "quoted", name', " x@y.z ", "2024-01-01"), (2, "line\\slash", None, "2024-01-01")]
    users = clean(classify(raw("users", tricky), "users"), "users")
    lake.write_bronze(users, "users", ctx)
    assert rows(lake.read_bronze("users", ctx)) == rows(users)


def test_quarantine_layout(lake, raw, ctx):
    judged = classify(raw("products", [*PRODUCTS, (None, "x", "y", 1.0)]), "products")
    records = quarantine(judged, "products", "p.csv", ctx)
    counts = {"null product_id": F.count_if(F.col("rejection_reason") == "null product_id")}
    assert lake.write_quarantine(records, "products", ctx, counts=counts) == {
        "rows": 1, "null product_id": 1,
    }
    path = f"{lake.root}/quarantine/source=products/etl_run_date=2024-06-07/etl_run_id=run-a"
    assert os.path.isdir(path) and lake.quarantine_path("products", ctx) == path
    got = lake.read_quarantine()
    assert rows(got.drop("source")) == rows(records)


def test_silver_layout_and_unknown_dataset(lake, raw, ctx):
    users = clean(classify(raw("users", USERS), "users"), "users")
    snap = snapshot(users, "users_clean", ctx)
    assert lake.write_silver(snap, "users_clean", ctx)["rows"] == 4
    assert os.path.isdir(f"{lake.root}/silver/users_clean/etl_run_date=2024-06-07")
    assert rows(lake.read_silver("users_clean")) == rows(snap)
    with pytest.raises(ValueError, match="Unknown silver dataset"):
        lake.write_silver(snap, "bogus", ctx)


def test_nothing_written_reads_as_empty(lake, ctx):
    assert lake.read_bronze("weblogs", ctx).schema == BRONZE["weblogs"]
    assert lake.read_bronze("weblogs", ctx).isEmpty()
    assert lake.read_silver("weblogs_clean").isEmpty() and lake.read_dim("dim_user").isEmpty()
    assert lake.read_gold("fact_user_activity").isEmpty()
    assert not lake.exists("silver") and lake.inventory("bronze").isEmpty()


def test_dimension_versions(lake, spark, ctx):
    lake.init_gold(ctx)
    assert lake.newest_version("dim_product") == 1 and lake.read_dim("dim_product").isEmpty()
    row = spark.createDataFrame(
        [(1, 10, "W", "C", 1.0)],
        "product_sk long, product_id long, product_name string, category string, price double",
    ).withColumn("dw_created_at", ctx.ts_col())
    for version in (2, 3):
        lake.write_dim(lake.read_dim("dim_product").unionByName(row), "dim_product", ctx)
        assert lake.newest_version("dim_product") == version
        assert lake.read_dim("dim_product").count() == version - 1
    # a version folder that was never listed as finished is not read
    row.write.format(lake.fmt).save(f"{lake.root}/gold/dim_product/version=4")
    assert lake.read_dim("dim_product").count() == 2
    lake.init_gold(ctx)
    assert lake.read_dim("dim_product").isEmpty()


def test_inventory_counts_rows_per_file(lake, raw, ctx):
    users = clean(classify(raw("users", USERS), "users"), "users")
    lake.write_bronze(users.repartition(2), "users", ctx)
    files = lake.inventory("bronze", "users")
    assert files.agg(F.sum("rows")).first()[0] == 4 and lake.exists("bronze", "users")


def test_export(lake, ctx):
    lake.init_gold(ctx)
    lake.export(ctx)
    assert os.path.isdir(f"{lake.root}/export/dim_user")


def test_land_numbers_rows_over_files_and_blocks(spark, tmp_path):
    lines = [f"{i},u{i % 7},\"name, {i}\",NA" for i in range(5000)]
    for part, name in ((lines[:2000], "a.csv"), (lines[2000:2100], "b.csv"), (lines[2100:], "c.csv")):
        (tmp_path / name).write_text("\n".join(["user_id,user_name,email,signup_date", *part]) + "\n")
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")  # many blocks per file
    try:
        df, n = land(spark, str(tmp_path), RAW_COLUMNS["users"])
        got = df.orderBy("row_index").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    assert n == 5000
    assert [(r.row_index, r.user_id) for r in got] == [(i, str(i)) for i in range(5000)]
    assert got[3].email == "name, 3" and got[3].signup_date is None


def test_land_needs_all_columns(spark, tmp_path):
    (tmp_path / "u.csv").write_text("user_id,user_name\n1,a\n")
    with pytest.raises(ValueError, match="Missing required columns"):
        land(spark, str(tmp_path), RAW_COLUMNS["users"])


def test_load_by_name(spark, tmp_path):
    (tmp_path / "one.csv").write_text("Price,PRODUCT_ID,extra\n1.5,1,x\noops,2,x\nNA,3,x\n")
    (tmp_path / "two.csv").write_text("product_id,product_name\n4,Widget\n")
    schema = table("product_id long, product_name string, price double")
    good, bad = load_by_name(spark, [str(tmp_path / "one.csv"), str(tmp_path / "two.csv")], schema)
    assert rows(good) == [(1, None, 1.5), (3, None, None), (4, "Widget", None)]
    assert [r.raw_row for r in bad.collect()] == ['{"product_id":"2","product_name":null,"price":"oops"}']


def test_scan_by_pattern_and_projection(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n2,1\n")
    (tmp_path / "x.txt").write_text("b,a\n9,9\n")
    df = project(scan(spark, str(tmp_path), pattern="*.csv"), table("a long, b double"))
    assert rows(df) == [(1, 2.0)]

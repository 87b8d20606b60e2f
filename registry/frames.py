"""Layer frames over one folder of test tables, built when first asked for."""

from __future__ import annotations

from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.context import RunContext
from rillflow.operators import quality, sessions
from rillflow.operators.joins import fits_broadcast, pairs_fit
from rillflow.plans import gold, silver
from rillflow.schemas import AGG, DIM_PRODUCT, DIM_USER, FACT
from rillflow.session import pin, together
from rillflow.sources.testtables import RAW_FRAMES

# Fixed run identities, so that results can be compared.
RUN_1 = RunContext("run-0001", date(2024, 2, 1), datetime(2024, 2, 1, 3, 0, 0))
RUN_2 = RunContext("run-0002", date(2024, 2, 2), datetime(2024, 2, 2, 3, 0, 0))


class Frames:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def ready(self, *names: str) -> None:
        """Build frames that do not need each other at the same time."""
        missing = [n for n in names if n not in self.__dict__]
        if missing:
            together(*[lambda n=n: getattr(self, n) for n in missing])

    def raw(self, source: str) -> DataFrame:
        return RAW_FRAMES[source](self.spark, self.sf_dir)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def empty(self, schema) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    # clean tables and dimensions are written once, as a run does, before the next layer reads them --------
    @cached_property
    def users_classified(self) -> DataFrame:
        return quality.classify(self.raw("users"), "users")

    @cached_property
    def products_classified(self) -> DataFrame:
        return quality.classify(self.raw("products"), "products")

    @cached_property
    def users(self) -> DataFrame:
        return pin(quality.clean(self.users_classified, "users"))

    @cached_property
    def products(self) -> DataFrame:
        return pin(quality.clean(self.products_classified, "products"))

    @cached_property
    def fits(self) -> dict[str, bool]:
        self.ready("users", "products")
        return {
            "users_fit": fits_broadcast(self.users),
            "products_fit": fits_broadcast(self.products),
        }

    @cached_property
    def id_fits(self) -> dict[str, bool]:
        """Of the ids with one more number, which is what most lookups need."""
        self.ready("users", "products")
        return {"users_fit": pairs_fit(self.users.count()), "products_fit": pairs_fit(self.products.count())}

    # logs ---------------------------------------------------------------------------------
    @cached_property
    def weblogs_classified(self) -> DataFrame:
        fits = self.id_fits
        return quality.classify(
            self.raw("weblogs"), "weblogs", users=self.users, products=self.products, **fits
        )

    @cached_property
    def weblogs(self) -> DataFrame:
        return pin(quality.clean(self.weblogs_classified, "weblogs"))

    @cached_property
    def silver_plain(self) -> DataFrame:
        """Silver logs without the user and product columns, which Gold does not read."""
        return silver.to_silver(self.weblogs, RUN_1)

    @cached_property
    def silver(self) -> DataFrame:
        return silver.enrich(self.silver_plain, self.users, self.products, **self.fits)

    @cached_property
    def sessions(self) -> DataFrame:
        return sessions.session_metrics(self.silver_plain)

    # gold ---------------------------------------------------------------------------------
    @cached_property
    def dim_user(self) -> DataFrame:
        source = silver.snapshot(self.users, "users_clean", RUN_1)
        return pin(gold.user_dimension(self.empty(DIM_USER), source, RUN_1).drop("_change"))

    @cached_property
    def dim_product(self) -> DataFrame:
        source = silver.snapshot(self.products, "products_clean", RUN_1)
        return pin(gold.product_dimension(self.empty(DIM_PRODUCT), source, RUN_1).drop("_change"))

    def fact_of(self, logs: DataFrame, loaded: DataFrame | None = None, how="inner") -> DataFrame:
        return gold.fact_rows(logs, self.dim_user, self.dim_product, loaded, how=how, **self.id_fits)

    @cached_property
    def fact(self) -> DataFrame:
        self.ready("users", "products")
        self.ready("weblogs", "dim_user", "dim_product")
        return self.fact_of(self.silver_plain)

    def agg_of(self, logs: DataFrame, loaded: DataFrame | None = None) -> DataFrame:
        return sessions.gold_session_metrics(
            logs, self.dim_user, loaded, users_fit=self.id_fits["users_fit"]
        )

    @cached_property
    def agg(self) -> DataFrame:
        self.ready("users", "products")
        self.ready("weblogs", "dim_user")
        return self.agg_of(self.silver_plain)

    @cached_property
    def broken_fact(self) -> DataFrame:
        """Facts of all raw logs by left joins: repeats and missing keys stay in, for the checks."""
        self.ready("users", "products")
        self.ready("dim_user", "dim_product")
        raw = self.raw("weblogs")
        logs = raw.select(
            "row_index",
            *[F.col(c).cast("bigint").alias(c) for c in ("log_id", "user_id", "product_id")],
            "session_id",
            "action",
            "timestamp",
        )
        return self.fact_of(silver.to_silver(logs, RUN_1), how="left")


__all__ = ["AGG", "FACT", "Frames", "RUN_1", "RUN_2"]

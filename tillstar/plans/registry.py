"""Queries by name: each is a function of a ``Context``, with the same question in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.operators import customers, forecast, similarity
from tillstar.plans import retail
from tillstar.plans.driver_tables import driver_tables, raw_tables
from tillstar.plans.oracle_base import AS_OF, MIN_CATEGORIES
from tillstar.session import kept_table
from tillstar.sources.export import bi_types
from tillstar.sources.tables import Tables

ELITE_SIZE = 10
TARGET_NAME = "red bolt"
REFERENCE_NAME = "blue ring"
TRAIN_END = date(2000, 12, 1)
TEST_END = date(2001, 3, 1)


class Context:
    """The layers over one folder of test tables, built as they are asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = datetime.fromisoformat(AS_OF)

    @cached_property
    def driver(self) -> Tables:
        return driver_tables(self.spark, self.sf_dir)

    @cached_property
    def raw(self) -> Tables:
        return raw_tables(self.spark, self.sf_dir)

    @cached_property
    def silver(self) -> Tables:
        return retail.silver(self.raw, self.as_of)

    @cached_property
    def gold(self) -> Tables:
        return retail.gold(self.silver, self.raw["brands"], self.as_of, MIN_CATEGORIES, ELITE_SIZE, self.raw)

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with their product and its category, without allocation."""
        return retail.lines_with_product(self.raw, "quantity").withColumnRenamed("quantity", "quantidade")

    @cached_property
    def metrics(self) -> DataFrame:
        return customers.order_metrics(self.silver["pedidos"])

    @cached_property
    def diversity(self) -> DataFrame:
        return customers.category_diversity(self.silver["pedidos"], self.lines)

    @cached_property
    def unified(self) -> DataFrame:
        r = self.raw
        return forecast.unified_items(r["order_items"], r["product_variants"], r["products"], r["orders"])

    @cached_property
    def target_ids(self) -> DataFrame:
        return forecast.ids_of_name(self.raw["products"], TARGET_NAME)

    @cached_property
    def dense(self) -> DataFrame:
        monthly = forecast.monthly_units(self.unified, self.target_ids)
        return forecast.dense_months(monthly, forecast.first_month(self.raw["orders"]), TEST_END)

    @cached_property
    def forecasts(self) -> DataFrame:
        return forecast.with_forecasts(self.dense, TRAIN_END)

    @cached_property
    def training(self) -> DataFrame:
        return forecast.training_rows(self.dense, TRAIN_END)

    @cached_property
    def purchases(self) -> DataFrame:
        """Lines with customer, product and status, for similarity."""
        return self.unified.select("order_id", "customer_id", "product_id", "produto", "status")

    @cached_property
    def reference(self) -> Column:
        """The smallest id carrying the reference name, as a scalar."""
        return forecast.ids_of_name(self.raw["products"], REFERENCE_NAME).agg(F.min("product_id")).scalar()

    @cached_property
    def pairs(self) -> DataFrame:
        """Who bought what, kept as a table: every similarity reads it several times."""
        return kept_table(similarity.interactions(self.purchases), "interactions")

    @cached_property
    def similar(self) -> DataFrame:
        """One row per item, read for its statistics and again for its ranking."""
        return kept_table(similarity.similar_to(self.pairs, self.reference), "similar")

    @cached_property
    def labels(self) -> DataFrame:
        return similarity.labels(self.raw["products"])

    @cached_property
    def star(self) -> Tables:
        """The star with the two model facts."""
        gold = {name: (lambda name=name: self.gold[name]) for name in self.gold}
        return Tables(gold | {
            "fct_previsao": lambda: forecast.forecast_fact(self.forecasts),
            "fct_similaridade_produto": lambda: similarity.similarity_fact(
                self.similar, self.lines, self.reference, REFERENCE_NAME, self.labels),
        })


@dataclass(frozen=True)
class Query:
    build: Callable[[Context], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Context`` under ``name``."""

    def register(build: Callable[[Context], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(build, sql)
        return build

    return register


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of a query with BI-readable types, as it would be exported."""
    return bi_types(QUERIES[name].build(Context(spark, sf_dir)))

"""The checks of a published layer run once, whoever asks for them."""

from helpers import rows
from pyspark.sql import functions as F

from tillstar.plans import queries_layered


def test_checks_run_once(spark):
    seen = []

    def checks(tables):
        seen.append(tables)
        return spark.range(1).select(F.lit("key").alias("check"), F.lit(True).alias("ok"))

    check = queries_layered._once(checks, "checks")
    first, second = check("tables"), check("tables")
    assert seen == ["tables"] and rows(first) == rows(second) == [("key", True)]
    assert "FileScan parquet" in second._jdf.queryExecution().executedPlan().toString()

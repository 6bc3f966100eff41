"""What publishing the layers leaves on disk, and holds there meanwhile."""

import re
import threading
import time

from helpers import rows
from pyspark.sql import functions as F

from tillstar.plans import queries_layered
from tillstar.plans.registry import Context
from tillstar.session import FREE_SHUFFLES, freed_shuffles
from tillstar.sources import export, publish


def _shuffles(spark):
    """Numbers of the shuffles that have files."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return set(re.findall(r"shuffle_(\d+)_", manager.getAllFiles().mkString(" ")))


def _counts(spark):
    return spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))


def test_shuffle_files_go_when_a_table_is_written(spark, tmp_path):
    known, seen = _shuffles(spark), []

    def checks(written):
        for _ in range(50):
            if not (left := _shuffles(spark) - known):
                break
            time.sleep(0.1)
        seen.append(left)
        return written["a"].agg((F.sum("n") == 1000).alias("ok")).select(F.lit("rows").alias("check"), F.lit(1).alias("expected"), F.lit(1).alias("actual"), "ok")

    tables = publish.publish(spark, f"{tmp_path}/lake", {"a": _counts(spark), "b": _counts(spark)}, "run", checks)
    assert seen == [set()]
    assert rows(tables["a"]) == rows(tables["b"]) == rows(_counts(spark))


def test_the_session_gets_its_setting_back(spark):
    for before in (None, "false", "true"):
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)
        try:
            with freed_shuffles(spark):
                assert spark.conf.get(FREE_SHUFFLES) == "true"
                raise KeyError
        except KeyError:
            pass
        assert spark.conf.get(FREE_SHUFFLES, None) == before
    spark.conf.unset(FREE_SHUFFLES)


def test_layers_are_written_one_table_at_a_time(spark, monkeypatch):
    """Several are written at the same time only where nobody says otherwise."""
    used = []

    def recorded(spark, root, tables, run, checks=None, base=None, jobs=publish.JOBS):
        used.append(jobs)
        return tables

    monkeypatch.setattr(publish, "publish", recorded)
    monkeypatch.setattr(queries_layered, "_once", lambda checks, name: lambda tables: spark.range(1))
    queries_layered._publish_layers(Context(spark, "/root/testdata/sf0.001"))
    assert used == [1, 1] and publish.JOBS > 1


def test_jobs_bound_the_writes_at_a_time(spark, tmp_path):
    threads = set()

    class Seen(dict):
        def __getitem__(self, name):
            threads.add(threading.current_thread().name)
            return super().__getitem__(name)

    publish.publish(spark, f"{tmp_path}/lake", Seen({t: spark.range(3) for t in "abcd"}), "run", jobs=1)
    assert len(threads) == 1


def test_layers_are_stored_small_and_exports_as_snappy(spark, tmp_path):
    kept = publish.publish(spark, f"{tmp_path}/lake", {"t": spark.range(3)}, "run")["t"]
    export.write_parquet(kept, f"{tmp_path}/export")
    assert all(f.endswith(".zstd.parquet") for f in kept.inputFiles())
    assert all(f.endswith(".snappy.parquet") for f in spark.read.parquet(f"{tmp_path}/export").inputFiles())
    assert rows(kept) == rows(spark.read.parquet(f"{tmp_path}/export")) == [(0,), (1,), (2,)]

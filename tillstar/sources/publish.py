"""All-or-nothing publication of a set of tables.

Every attempt writes its tables into a folder of its own and checks what was written. Only then a small pointer
file, complete before it gets its name, is put into the folder of pointers, of which readers follow the last.
A failed attempt, also one under the name of the live run, leaves the published tables as they are. Pointers are
numbered, and a number is given once: of two publishers that began at the same version, the later one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillstar.operators.quality import require
from tillstar.session import freed_shuffles
from tillstar.sources.csv import check_files, file_names, load_tables, one_row_per_table, path_exists, reconcile
from tillstar.sources.tables import Tables

# Tables written at the same time, unless the caller says otherwise.
JOBS = 4
# Layers are read by Spark; what BI tools read is exported (``export.write_parquet``) as snappy.
CODEC = "zstd"
POINTERS = "current"


def publish(
    spark: SparkSession,
    root: str,
    tables: Mapping[str, DataFrame],
    run: str,
    checks: Callable[[Tables], DataFrame] | None = None,
    base: int | None = None,
    jobs: int = JOBS,
) -> Tables:
    """Write ``tables`` below ``root`` as an attempt named after ``run``; make them current if ``checks`` hold.

    ``checks`` gets the written tables and returns rows of (check, expected, actual, ok). ``base`` is the version the
    tables were made from (``current_version``), by default the one that is current now; if another one is published
    before the end, ``RivalError`` is raised and that one stays. ``jobs`` tables are written at the same time; the shuffle
    files of all of them lie side by side, and those of a table go when it is written.
    """
    base = current_version(spark, root) if base is None else base
    attempt = f"{run}-{uuid.uuid4().hex}"

    def write(name: str) -> None:
        tables[name].write.option("compression", CODEC).parquet(f"{root}/run={attempt}/{name}")

    with freed_shuffles(spark):
        # Each table is a Spark job of its own; submitting several keeps the executors busy.
        with ThreadPoolExecutor(max_workers=jobs) as pool:
            list(pool.map(write, tables))
        written = read_run(spark, root, attempt, tuple(tables))
        if checks is not None:
            require(checks(written))
    _point_at(spark, root, attempt, tuple(tables), base + 1)
    return written


def _pointers(spark: SparkSession, root: str) -> list[str]:
    """Names of the pointer files, oldest first."""
    folder = f"{root}/{POINTERS}"
    if not path_exists(spark, folder):
        return []
    return sorted(n for n in file_names(spark, folder) if n.endswith(".json") and not n.startswith("."))


class RivalError(RuntimeError):
    """Another version was published since the one that an attempt began from."""


def current_version(spark: SparkSession, root: str) -> int:
    """The number of the published version, 0 if there is none."""
    pointers = _pointers(spark, root)
    return int(pointers[-1][:12]) if pointers else 0


def _point_at(spark: SparkSession, root: str, attempt: str, names: tuple[str, ...], number: int) -> None:
    """Write the pointer under a hidden name and give it the one of its version, if nobody has that."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    hidden, final = path(f"{root}/{POINTERS}/.{attempt}"), path(f"{root}/{POINTERS}/{number:012d}.json")
    fs = hidden.getFileSystem(conf)
    out = fs.create(hidden, False)
    out.write(bytearray(json.dumps({"run": attempt, "tables": ",".join(names)}).encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            # Renaming would replace a local file; a second link to it is made only under a free name.
            at = lambda p: jvm.java.nio.file.Paths.get(fs.makeQualified(p).toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0))
            jvm.java.nio.file.Files.createLink(at(final), at(hidden))
        else:
            rename = jvm.org.apache.hadoop.fs.Options.Rename
            once = spark.sparkContext._gateway.new_array(rename, 1)
            once[0] = rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(hidden, final, once)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            raise RivalError(f"version {number} of {root} was published by another run") from e
        raise
    finally:
        fs.delete(hidden, False)


def read_run(spark: SparkSession, root: str, attempt: str, names) -> Tables:
    return Tables({n: lambda n=n: spark.read.parquet(f"{root}/run={attempt}/{n}") for n in names})


def read_current(spark: SparkSession, root: str) -> Tables:
    """The tables of the last published run."""
    pointers = _pointers(spark, root)
    if not pointers:
        raise FileNotFoundError(f"nothing is published below {root}")
    row = spark.read.schema("run string, tables string").json(f"{root}/{POINTERS}/{pointers[-1]}").first()
    return read_run(spark, root, row["run"], row["tables"].split(","))


def create_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Temporary views, so that published tables can be queried in SQL."""
    for name in tables:
        tables[name].createOrReplaceTempView(f"{prefix}{name}")


def bulk_load(
    spark: SparkSession, paths: Mapping[str, str], declared: Mapping, root: str, run: str, folder: str | None = None
) -> DataFrame:
    """Load files into typed tables, all or none, and return the load report.

    Files and headers are checked first; with ``folder``, files in it that nobody listed are warned of. Rows are counted by the job that writes them, compared
    with the lines of the files and with the stored tables, and the load becomes current only
    if all three agree for every table.
    """
    found = check_files(spark, paths, folder)
    observed = {t: Observation(f"load {t}") for t in paths}
    tables = {
        t: df.observe(observed[t], F.count(F.lit(1)).alias("rows"))
        for t, df in load_tables(spark, paths, declared).items()
    }
    reports = []

    def verify(written: Tables) -> DataFrame:
        loaded = {t: o.get["rows"] for t, o in observed.items()}
        reports.append(one_row_per_table(reconcile(found, loaded, written)))
        return reports[0].select(
            F.concat(F.lit("rows of "), "table").alias("check"), F.col("n_file").alias("expected"),
            F.col("n_stored").alias("actual"), "ok",
        )

    publish(spark, root, tables, run, verify)
    return reports[0]

"""Bulk loading of header-named CSV files: bound by name, uncleaned, checked before and after."""

from __future__ import annotations

import csv
import warnings
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.sources.tables import Tables


class LoadError(ValueError):
    """Files and declared tables do not fit together."""


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a file (one line is read), as they stand. A byte-order mark is dropped."""
    first = spark.read.text(path, lineSep="\n").head()
    if first is None:
        raise LoadError(f"{path}: empty file, no header")
    line = first["value"].removeprefix("\ufeff").rstrip("\r")
    names = next(csv.reader([line]))
    bare = [name.strip() for name in names]
    repeated = sorted({n for n in bare if bare.count(n) > 1})
    if repeated:
        raise LoadError(f"{path}: repeated column {', '.join(repeated)}")
    return names


def check_columns(names: Iterable[str], declared: T.StructType | None, table: str) -> None:
    """Every column of the file must be declared, before anything is read."""
    if declared is None:
        raise LoadError(f"{table}: no such table")
    missing = [n.strip() for n in names if n.strip() not in declared.names]
    if missing:
        raise LoadError(f"{table}: columns in the file but not in the table: {', '.join(missing)}")


def read_csv(spark: SparkSession, path: str, declared: T.StructType) -> DataFrame:
    """The file with each column bound to the declared column of the same name.

    Spark binds a schema by position, so it is put in header order first. Values are neither
    trimmed nor cleaned; an empty field is NULL; a row with more or fewer fields is an error.
    """
    names = read_header(spark, path)
    check_columns(names, declared, path)
    # Spark compares names with the header as it stands, so blanks around a name are taken off after the read.
    schema = T.StructType([T.StructField(n, declared[n.strip()].dataType, True) for n in names])
    read = (
        spark.read.schema(schema)
        .options(header=True, enforceSchema=False, mode="FAILFAST", nullValue="", encoding="UTF-8",
                 ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )
    return read.toDF(*[n.strip() for n in names])


def read_strings(spark: SparkSession, path: str) -> DataFrame:
    """The file with every column as text, for profiling."""
    names = read_header(spark, path)
    return read_csv(spark, path, T.StructType([T.StructField(n, T.StringType()) for n in names]))


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row: data lines and line terminator of a file, without the CSV parser.

    Lines are split at newlines alone and read by all tasks, so this count is independent of the
    load it verifies. A missing final newline does not lose the last line; it shows as a byte
    that the file is short of, and that line counts for neither terminator.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")
    )
    per_file = lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("value").endswith("\r")).alias("crlf"),
        (F.sum(F.octet_length("value") + 1) - F.max("size")).alias("open_end"),
    )
    lf = F.sum(F.col("total") - F.col("crlf") - F.col("open_end"))
    crlf = F.sum("crlf")
    kind = F.when(crlf == 0, "LF").when(lf == 0, "CRLF").otherwise("mixed")
    return per_file.agg(
        F.coalesce(F.sum(F.col("total") - 1), F.lit(0)).alias("n_file"),
        F.coalesce(kind, F.lit("LF")).alias("terminator"),
    )


def inventory(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Columns, data lines and terminator per file: the dry run. Nothing is loaded."""
    rows = [
        file_lines(spark, path).select(
            F.lit(table).alias("table"), F.lit(len(read_header(spark, path))).alias("n_cols"),
            "terminator", "n_file",
        )
        for table, path in paths.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), rows)


def check_files(spark: SparkSession, paths: Mapping[str, str], folder: str | None = None) -> DataFrame:
    """All files present, none with mixed terminators; warn about files nobody listed.

    Returns the inventory, kept as one local row per table so that files are not counted again.
    """
    missing = [p for p in paths.values() if not path_exists(spark, p)]
    if missing:
        raise LoadError(f"missing files: {', '.join(missing)}")
    if folder is not None:
        extra = sorted(set(csv_names(spark, folder)) - set(paths))
        if extra:
            warnings.warn(f"files outside the table list are ignored: {', '.join(extra)}", stacklevel=2)
    found = one_row_per_table(inventory(spark, paths))
    mixed = [r["table"] for r in found.filter("terminator = 'mixed'").collect()]
    if mixed:
        raise LoadError(f"mixed line terminators in {', '.join(mixed)}: the extract is damaged")
    return found


def one_row_per_table(report: DataFrame) -> DataFrame:
    """A report computed once: its rows, as few as there are tables, become a local relation."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    listing = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(hadoop)
    return [s.getPath().getName() for s in listing]


def csv_names(spark: SparkSession, folder: str) -> list[str]:
    """Table names of the CSV files in a folder."""
    return [n.removesuffix(".csv") for n in file_names(spark, folder) if n.endswith(".csv")]


def load_tables(spark: SparkSession, paths: Mapping[str, str], declared: Mapping[str, T.StructType]) -> Tables:
    """All files as typed tables; headers are checked before any table is read."""
    for table, path in paths.items():
        check_columns(read_header(spark, path), declared.get(table), table)
    return Tables({t: lambda t=t, p=p: read_csv(spark, p, declared[t]) for t, p in paths.items()})


def reconcile(found: DataFrame, loaded: Mapping[str, int], stored: Mapping[str, DataFrame]) -> DataFrame:
    """The load report: lines in the file, rows loaded and rows stored per table, and whether all agree.

    ``found`` is the inventory of the files, ``loaded`` the row counts taken while loading, and
    ``stored`` the tables as they can be read now: three counts from three different readings.
    """
    counts = found.sparkSession.createDataFrame(list(loaded.items()), "table string, n_loaded bigint")
    rows = [df.agg(F.count(F.lit(1)).alias("n_stored")).select(F.lit(t).alias("table"), "n_stored") for t, df in stored.items()]
    report = found.join(counts, "table").join(reduce(lambda a, b: a.unionByName(b), rows), "table")
    agree = (F.col("n_file") == F.col("n_loaded")) & (F.col("n_loaded") == F.col("n_stored"))
    return report.withColumn("ok", agree)


def report_totals(report: DataFrame, subset: Iterable[str]) -> DataFrame:
    """Tables, rows, and rows of a chosen subset of tables."""
    chosen = F.when(F.col("table").isin(*subset), F.col("n_stored"))
    return report.agg(
        F.count(F.lit(1)).alias("tables"),
        F.sum("n_stored").alias("rows"),
        F.coalesce(F.sum(chosen), F.lit(0)).alias("subset_rows"),
        F.bool_and("ok").alias("ok"),
    )

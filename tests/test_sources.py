"""Files: headers, terminators, counts, all-or-nothing loads, profiles and keys."""

from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from helpers import rows
from pyspark.sql import types as T

from tillstar.operators import profile, quality
from tillstar.sources import csv, export, publish

SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("code", T.StringType()), T.StructField("id", T.IntegerType())])


def write(path, text: bytes):
    path.write_bytes(text)
    return str(path)


def test_columns_bind_by_name_and_values_stay_as_they_are(spark, tmp_path):
    path = write(tmp_path / "t.csv", b"\xef\xbb\xbfid,name,code\r\n1, a ,007\r\n2,,n/a\r\n")
    df = csv.read_csv(spark, path, SCHEMA)
    assert df.columns == ["id", "name", "code"]
    assert rows(df) == [(1, " a ", "007"), (2, None, "n/a")]


def test_ragged_rows_fail(spark, tmp_path):
    path = write(tmp_path / "t.csv", b"id,name,code\n1,a,b\n2,c\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        csv.read_csv(spark, path, SCHEMA).collect()


@pytest.mark.parametrize("header,message", [
    (b"id,id\n1,2\n", "repeated"), (b"", "empty"), (b"id,extra\n1,2\n", "not in the table"),
])
def test_bad_headers_are_refused(spark, tmp_path, header, message):
    with pytest.raises(csv.LoadError, match=message):
        csv.read_csv(spark, write(tmp_path / "t.csv", header), SCHEMA)


@pytest.mark.parametrize("text,lines,kind", [
    (b"id\n1\n2\n", 2, "LF"), (b"id\n1\n2", 2, "LF"), (b"id\r\n1\r\n2\r\n", 2, "CRLF"), (b"id\r\n1\r\n2", 2, "CRLF"),
    (b"id\r\n1\n2\r\n", 2, "mixed"), (b"id\n", 0, "LF"), (b"id\r\n1\n", 1, "mixed"),
])
def test_lines_and_terminators(spark, tmp_path, text, lines, kind):
    row = csv.file_lines(spark, write(tmp_path / "t.csv", text)).first()
    assert (row["n_file"], row["terminator"]) == (lines, kind)


def test_load_is_all_or_nothing_and_repeatable(spark, tmp_path):
    good = write(tmp_path / "good.csv", b"id,name,code\n1,a,b\n2,c,d\n")
    declared = {"t": SCHEMA, "u": SCHEMA}
    root = str(tmp_path / "warehouse")
    for run in ("one", "two"):
        report = publish.bulk_load(spark, {"t": good, "u": good}, declared, root, run)
        assert rows(report, "table", "n_file", "n_loaded", "n_stored", "ok") == [("t", 2, 2, 2, True), ("u", 2, 2, 2, True)]
    # A quoted line break makes one record of two lines: the independent counts disagree.
    odd = write(tmp_path / "odd.csv", b'id,name,code\n1,a,b\n2,"c",d\n\n')
    with pytest.raises(AssertionError):
        publish.bulk_load(spark, {"t": odd, "u": good}, declared, root, "three")
    assert publish.read_current(spark, root)["t"].count() == 2
    assert "run=two" in publish.read_current(spark, root)["t"].inputFiles()[0]


def test_a_failed_attempt_under_the_live_name_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "layer")
    none, bad = (lambda t: quality.count_is(t["t"], 3, "rows")), spark.range(1)
    publish.publish(spark, root, {"t": spark.range(3)}, "r1", none)
    with pytest.raises(quality.CheckFailed):
        publish.publish(spark, root, {"t": bad}, "r1", none)
    assert publish.read_current(spark, root)["t"].count() == 3

    def crash(*_):
        raise OSError("lost between the tables and the pointer")

    with monkeypatch.context() as m:
        m.setattr(publish, "_point_at", crash)
        with pytest.raises(OSError):
            publish.publish(spark, root, {"t": bad}, "r2")
    assert publish.read_current(spark, root)["t"].count() == 3
    for n in (4, 5):
        publish.publish(spark, root, {"t": spark.range(n)}, "r1")
        assert publish.read_current(spark, root)["t"].count() == n


def test_of_two_publishers_on_one_version_one_fails(spark, tmp_path):
    root = str(tmp_path / "layer")
    publish.publish(spark, root, {"t": spark.range(1)}, "first")
    assert publish.current_version(spark, root) == 1
    together = Barrier(2)

    def attempt(n):
        def both_written(_):
            together.wait(60)
            return quality.count_is(spark.range(1), 1, "rows")

        try:
            publish.publish(spark, root, {"t": spark.range(n)}, f"run{n}", both_written)
            return n
        except publish.RivalError:
            return None

    with ThreadPoolExecutor(2) as pool:
        won = [n for n in pool.map(attempt, (5, 7)) if n]
    assert len(won) == 1 and publish.read_current(spark, root)["t"].count() == won[0] and publish.current_version(spark, root) == 2
    # Tables made from a version that is no longer current are refused, the others go on.
    with pytest.raises(publish.RivalError):
        publish.publish(spark, root, {"t": spark.range(9)}, "late", base=1)
    publish.publish(spark, root, {"t": spark.range(9)}, "next", base=2)
    assert publish.read_current(spark, root)["t"].count() == 9


def test_blanks_around_header_names(spark, tmp_path):
    path = write(tmp_path / "blank.csv", b"id, name,code \n1,a,b\n")
    df = csv.read_csv(spark, path, SCHEMA)
    assert df.columns == ["id", "name", "code"] and df.count() == 1


def test_unlisted_files_are_warned_of_on_the_load_path(spark, tmp_path):
    good = write(tmp_path / "t.csv", b"id,name,code\n1,a,b\n")
    write(tmp_path / "other.csv", b"id\n1\n")
    with pytest.warns(UserWarning, match="other"):
        publish.bulk_load(spark, {"t": good}, {"t": SCHEMA}, str(tmp_path / "w"), "one", folder=str(tmp_path))


def test_missing_and_mixed_files_stop_the_load(spark, tmp_path):
    with pytest.raises(csv.LoadError, match="missing"):
        csv.check_files(spark, {"t": str(tmp_path / "none.csv")})
    path = write(tmp_path / "t.csv", b"id\r\n1\n2\r\n")
    with pytest.raises(csv.LoadError, match="mixed"):
        csv.check_files(spark, {"t": path})
    other = write(tmp_path / "u.csv", b"id\n1\n")
    with pytest.warns(UserWarning, match="ignored: t"):
        csv.check_files(spark, {"u": other}, str(tmp_path))


def test_type_cascade(spark, tmp_path):
    columns = {
        "empty": ["", ""], "sku": ["1", "2"], "zero": ["007", "12"], "truth": ["TRUE", "false"], "day": ["2024-01-31", ""],
        "moment": ["2024-01-31 10:00:00", "2024-01-31T10:00:00.5"], "small": ["-5", "2147483647"], "large": ["1", "2147483648"],
        "huge": ["12345678901234567890", "1"], "mixed": ["1", "1.000"], "price": ["0.75", "-12.5"], "word": ["a" * 9, "b"], "long": ["x" * 300, "y"],
    }
    lines = [",".join(columns)] + [",".join(v[i] for v in columns.values()) for i in (0, 1)]
    path = write(tmp_path / "t.csv", ("\n".join(lines) + "\n").encode())
    stats = profile.profile_columns(csv.read_strings(spark, path), "t")
    types = {r["coluna"]: r["tipo"] for r in profile.infer_types(stats).collect()}
    assert types == {
        "empty": "TEXT", "sku": "VARCHAR(8)", "zero": "VARCHAR(8)", "truth": "BOOLEAN", "day": "DATE", "moment": "TIMESTAMP",
        "small": "INTEGER", "large": "BIGINT", "huge": "TEXT", "mixed": "NUMERIC(6,3)", "price": "NUMERIC(6,2)", "word": "VARCHAR(16)", "long": "TEXT",
    }
    assert {r["tipo"] for r in profile.infer_types(stats, varchar="text").filter("coluna in ('word', 'zero')").collect()} == {"TEXT"}
    schema = profile.schema_of(profile.infer_types(stats), ["small"])
    assert schema["mixed"].dataType == T.DecimalType(6, 3) and not schema["small"].nullable and schema["day"].nullable
    assert schema.names == list(columns)
    loaded = csv.read_csv(spark, path, schema)
    assert profile.type_mismatches(loaded, schema) == []
    assert loaded.first()["zero"] == "007"


def test_profile_of_a_table_without_rows(spark):
    stats = profile.profile_columns(spark.createDataFrame([], "a string, b string"), "t").collect()
    assert [(r["n_total"], r["pct_preenchido"], r["so_inteiro"]) for r in stats] == [(0, 0.0, True)] * 2


def test_keys_by_name(spark):
    assert [profile.singular(t) for t in ("categories", "addresses", "orders", "boxes", "branches", "sheep")] == [
        "category", "address", "order", "box", "branch", "sheep"]
    found = profile.infer_foreign_keys({
        "purchase_orders": ["id", "buyer_id"], "purchase_order_items": ["id", "purchase_order_id"],
        "goods_receipt_items": ["id", "purchase_order_item_id"], "order_items": ["id"], "employees": ["id"],
        "categories": ["id", "parent_category_id", "tax_id"], "stock_movements": ["id", "reference_id"],
    })
    assert sorted((k.table, k.column, k.target, k.origin) for k in found) == [
        ("categories", "parent_category_id", "categories", "name"),
        ("goods_receipt_items", "purchase_order_item_id", "purchase_order_items", "name"),
        ("purchase_order_items", "purchase_order_id", "purchase_orders", "name"),
        ("purchase_orders", "buyer_id", "employees", "override"),
    ]
    pairs = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "a_id int, b_id int, v string")
    assert profile.infer_primary_key(pairs) == ["a_id", "b_id"]
    assert profile.infer_primary_key(pairs.union(pairs)) == []
    assert profile.infer_primary_key(pairs.select("v")) == []


def test_orphans_are_counted_and_nulls_allowed(spark):
    tables = {
        "a": spark.createDataFrame([(1, 1), (2, None), (3, 9), (4, 9)], "id int, b_id int"),
        "b": spark.createDataFrame([(1,)], "id int"),
    }
    keys = profile.infer_foreign_keys({t: df.columns for t, df in tables.items()}, overrides={("a", "b_id"): ("b", "id")})
    assert rows(profile.foreign_key_report(tables, keys), "tabela", "orfaos") == [("a", 2)]


def test_foreign_keys_of_several_types_and_tables(spark):
    """Several keys of a table, one target of two keys, text that is no number, a frequent value, empty tables."""
    tables = {
        "a": spark.createDataFrame([(i, "1" if i < 50 else "x", 2 if i % 2 else None) for i in range(60)], "id int, b_id string, c_id int"),
        "b": spark.createDataFrame([(1,), (1,), (None,)], "id int"),
        "c": spark.createDataFrame([], "id bigint"),
        "d": spark.createDataFrame([], "b_id int"),
    }
    keys = profile.infer_foreign_keys({t: df.columns for t, df in tables.items()})
    report = profile.foreign_key_report(tables, keys)
    assert rows(report, "tabela", "coluna", "destino", "orfaos") == [
        ("a", "b_id", "b", 10), ("a", "c_id", "c", 30), ("d", "b_id", "b", 0)]
    assert profile.foreign_key_report(tables, []).columns == report.columns


def test_export_types(spark, tmp_path):
    df = spark.sql("SELECT CAST(1.5 AS DECIMAL(9,2)) AS d, DATE '2024-01-01' AS t, NULL AS n, NULL AS m")
    assert export.unportable_columns(df) == [("d", "decimal(9,2)"), ("t", "date"), ("n", "void"), ("m", "void")]
    export.write_parquet(df, str(tmp_path / "x"), {"m": "int"})
    assert spark.read.parquet(str(tmp_path / "x")).dtypes == [("d", "double"), ("t", "timestamp_ntz"), ("n", "string"), ("m", "int")]

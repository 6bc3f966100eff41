"""Text cleaning, labels and discount allocation on literal rows."""

import random
from datetime import datetime
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tillstar.functions import text
from tillstar.functions.numbers import proportional_share
from tillstar.operators import cleaning, quality
from tillstar.operators.allocate import allocate
from tillstar.operators.skew import hot_keys, hot_keys_if_any


def test_junk_tokens_become_null_and_text_is_trimmed(spark):
    values = ["?", " n/a ", "  ", "", "ASDF", "None", "—", "ok", "  two words ", "\tx", None, "nab"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(text.null_if_junk("v")).collect()]
    assert got == [None] * 7 + ["ok", "two words", "\tx", None, "nab"]


def test_junk_function_in_sql(spark):
    text.register_sql_functions(spark)
    row = spark.sql("SELECT null_if_junk(' x '), null_if_junk('TBD'), null_if_junk(NULL)").first()
    assert tuple(row) == ("x", None, None)


def test_labels_carry_the_id_where_a_name_is_junk_or_shared(spark):
    df = spark.createDataFrame([(1, "rope", 2), (2, "?", 1), (3, "sail", 1), (4, None, 1)], "id int, name string, n long")
    assert [r[0] for r in df.select(text.display_label("id", "name", "n")).collect()] == [
        "rope (id=1)", "[sem nome] (id=2)", "sail", "[sem nome] (id=4)"]


def test_all_caps_are_repaired_word_by_word(spark):
    df = spark.createDataFrame([("SEGURANÇA",), ("COLETES SALVA-VIDAS",), ("Coletes Salva-Vidas",), ("GPS",)], "n string")
    assert [r[0] for r in df.select(text.fix_all_caps("n")).collect()] == [
        "Segurança", "Coletes Salva-Vidas", "Coletes Salva-Vidas", "GPS"]


def test_suspicious_labels_are_case_sensitive(spark):
    df = spark.createDataFrame([("asdf (id=9)",), ("ASDF",), ("N/A",), ("rope (id=1)",), ("",)], "l string")
    assert [r[0] for r in df.select(text.is_suspicious_label("l")).collect()] == [True, False, True, False, True]


@pytest.mark.parametrize("amount,part,whole,expected", [
    ("0.03", "1", "6", "0.01"),            # half a cent rounds up
    ("10.00", "1", "3", "3.33"),
    ("0.00", "5", "9", "0.00"),
    ("5.00", "0", "0", "0.00"),            # nothing to divide by
    ("-0.03", "1", "6", "-0.01"),
    ("90000000000000.00", "70000000000000.00", "140000000000000.00", "45000000000000.00"),
])
def test_proportional_share(spark, amount, part, whole, expected):
    df = spark.createDataFrame([(Decimal(amount), Decimal(part), Decimal(whole))], "a decimal(18,2), p decimal(18,2), w decimal(28,2)")
    assert df.select(proportional_share(F.col("a"), F.col("p"), F.col("w"))).first()[0] == Decimal(expected)


LINES = [
    (1, 10, "10.00"), (2, 10, "10.00"), (3, 10, "10.00"),     # three equal lines
    (4, 20, "0.00"), (5, 20, "0.00"),                         # order of value zero
    (6, 30, "7.00"), (7, 30, "2.50"), (8, 30, "0.33"),
    (9, 99, "1.00"),                                          # no header
]
HEADERS = [(10, "0.10"), (20, "5.00"), (30, "1.99"), (40, "3.00")]


def test_shares_round_only_the_result(spark):
    """Halves of a cent go up at any size, and four decimals are not cut before the division."""
    df = spark.createDataFrame([(Decimal(a), Decimal(p), Decimal(p)) for a in ("1.0050", "0.1250") for p in ("1", "30000000")], "a decimal(18,4), p decimal(18,4), w decimal(18,4)")
    got = [r[0] for r in df.select(proportional_share(F.col("a"), F.col("p"), F.col("w"), 4, 4)).collect()]
    assert got == [Decimal("1.01")] * 2 + [Decimal("0.13")] * 2


@pytest.mark.parametrize("hot_rows", [1, 2, 1000])
def test_allocation_is_exact_however_orders_are_split(spark, hot_rows):
    lines = spark.createDataFrame([(i, o, Decimal(v)) for i, o, v in LINES], "id int, o int, v decimal(18,2)")
    heads = spark.createDataFrame([(o, Decimal(a)) for o, a in HEADERS], "o int, amount decimal(18,2)")
    got = {r["id"]: r["allocated"] for r in allocate(lines, heads, "o", "v", "amount", ["id"], hot=hot_keys(lines, ["o"], hot_rows)).collect()}
    assert got == {
        1: Decimal("0.04"), 2: Decimal("0.03"), 3: Decimal("0.03"),
        4: Decimal("5.00"), 5: Decimal("0.00"),
        6: Decimal("1.41"), 7: Decimal("0.51"), 8: Decimal("0.07"),
    }


def test_one_order_with_most_lines_is_split_and_still_exact(spark):
    n = 5000
    lines = spark.range(n).select(
        F.col("id").cast("int").alias("id"), F.when(F.col("id") < n - 100, 1).otherwise(F.col("id")).cast("int").alias("o"),
        ((F.col("id") % 7 + 1).cast("decimal(18,2)")).alias("v"))
    heads = lines.select("o").distinct().withColumn("amount", F.lit("123.45").cast("decimal(18,2)"))
    split = allocate(lines, heads, "o", "v", "amount", ["id"], hot=hot_keys(lines, ["o"], 500))
    whole = allocate(lines, heads, "o", "v", "amount", ["id"])
    found = allocate(lines, heads, "o", "v", "amount", ["id"], hot_rows=500)
    assert rows(split) == rows(whole) == rows(found)
    assert quality.allocation_differences(split, heads, "o", "allocated", "amount").count() == 0
    counted = found.withColumn("task", F.spark_partition_id()).filter("o = 1").groupBy("task").count()
    assert counted.agg(F.max("count")).first()[0] < n - 100


def test_hot_keys_are_looked_for_only_in_larger_tables(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,), (None,)], "k int")
    assert hot_keys_if_any(df, ["k"], 7) is None
    assert hot_keys_if_any(df, ["k"], 3) is None
    assert rows(hot_keys_if_any(df, ["k"], 2)) == [(1, 2)]
    assert hot_keys_if_any(df.limit(0), ["k"], 0) is None


def test_allocation_is_the_same_split_or_not(spark):
    rng = random.Random(1)
    places = lambda n, top: Decimal(rng.randrange(-top // 5, top)).scaleb(-n)
    made = []
    for o in range(60):
        ids = [rng.choice([None, "a", "b", "c"]) for _ in range(rng.randrange(1, 9))]
        made += [(i, o, rng.choice([Decimal(0), None, Decimal("50"), places(4, 10**6), places(4, 4 * 10**11)]), rng.choice("xy")) for i in ids]
    made += [("a", 90, Decimal("50"), "x"), ("a", 90, Decimal("50"), "x"), ("b", 90, Decimal("0.01"), "x"),
             ("a", 91, Decimal("7"), "x"), ("b", 91, Decimal("-7"), "x")]
    lines = spark.createDataFrame(made, "id string, o int, v decimal(18,4), other string")
    heads = spark.createDataFrame([(o, places(2, 10**7) if o % 2 else places(2, 4 * 10**9)) for o in range(92)], "o int, amount decimal(18,2)")
    whole = allocate(lines, heads, "o", "v", "amount", ["id"])
    for hot_rows in (1, 3):
        assert rows(allocate(lines, heads, "o", "v", "amount", ["id"], hot=hot_keys(lines, ["o"], hot_rows))) == rows(whole)
    exact = {r["o"]: r["amount"] for r in heads.collect()}
    sums = {}
    for r in whole.collect():
        sums[r["o"]] = sums.get(r["o"], 0) + r["allocated"]
    assert sums == {o: exact[o] for o in sums} and whole.count() == len(made)


@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_homonyms_and_null_names(spark, hot_rows):
    products = spark.createDataFrame(
        [(1, "rope"), (2, "rope"), (3, "sail"), (4, None), (5, None), (6, "?")], "id int, name string"
    ).withColumns({"brand_id": F.lit(1), "category_id": F.lit(1), "is_active": F.lit(True)})
    got = rows(cleaning.clean_products(products, hot_rows), "product_id", "flag_homonimo", "flag_nome_suspeito")
    assert got == [(1, True, False), (2, True, False), (3, False, False), (4, True, True), (5, True, True), (6, False, True)]


def test_future_is_relative_to_the_given_date(spark):
    base = {"order_number": "x", "channel": "pos", "customer_id": 1, "salesperson_id": 1, "location_id": 1,
            "status": "paid", "subtotal": 1, "discount_amount": 0, "total": 1}
    df = spark.createDataFrame([(1, datetime(2020, 1, 1)), (2, datetime(2021, 1, 2))], "id int, created_at timestamp_ntz")
    df = df.withColumns({k: F.lit(v) for k, v in base.items()})
    got = rows(cleaning.clean_orders(df, datetime(2021, 1, 1)), "order_id", "eh_futuro", "eh_pago", "eh_receita_efetivada")
    assert got == [(1, False, True, True), (2, True, True, True)]


def test_stock_reorder_point_of_blanks_is_null_integer(spark):
    df = spark.createDataFrame([(1, 1, 2.0, ""), (2, 1, 2.0, " 7 "), (3, 1, 2.0, None)],
                               "product_variant_id int, location_id int, quantity_on_hand double, reorder_point string")
    got = cleaning.clean_stock(df.withColumn("updated_at", F.lit(None)))
    assert dict(got.dtypes)["ponto_de_reposicao"] == "int"
    assert rows(got, "product_variant_id", "ponto_de_reposicao") == [(1, None), (2, 7), (3, None)]


def test_checks_name_what_failed(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    with pytest.raises(quality.CheckFailed, match="keys"):
        quality.require(quality.key_is_unique(df, ["k"], "keys"))
    quality.require(quality.count_is(df, 3, "rows"))
    found = quality.relationship(df, "k", spark.createDataFrame([(2,)], "k int"), "k", "r").first()
    assert (found["orfaos"], found["chaves_repetidas"], found["chaves_nulas"]) == (2, 0, 0)


def test_table_checks_in_one_pass(spark):
    df = spark.createDataFrame(
        [(1, "a", True, "1.10"), (1, "a", False, "2.20"), (1, "b", None, None), (None, "a", True, "3.30"), (2, None, False, "0.40")],
        "k int, j string, flag boolean, v string").withColumn("v", F.col("v").cast("decimal(18,2)"))
    got = {r["check"]: (str(r["expected"]), str(r["actual"]), r["ok"]) for r in quality.table_checks(
        df, "t", ["k", "j"], rows=5, counts={"flagged": (F.col("flag"), 1)}, totals={"sum": ("v", F.lit(7))}).collect()}
    assert got == {"t: key": ("0.00", "3.00", False), "t: rows": ("5.00", "5.00", True), "flagged": ("1.00", "2.00", False),
                   "sum": ("7.00", "7.00", True)}
    empty = quality.table_checks(df.limit(0), "t", ["k"], rows=0, counts={"flagged": (F.col("flag"), 0)}, totals={"sum": ("v", None)})
    assert {(r["check"], r["ok"]) for r in empty.collect()} == {("t: key", True), ("t: rows", True), ("flagged", True), ("sum", True)}


def test_allocation_checks_agree_with_the_single_ones(spark):
    lines = spark.createDataFrame([(1, 3.0), (1, 2.0), (2, 1.0), (3, 4.0), (None, 0.5), (5, None), (6, 2.0)], "k int, a double")
    heads = spark.createDataFrame([(1, 5.0), (2, 1.5), (4, 9.0), (5, 1.0), (6, None), (None, 7.0)], "k int, d double")
    lines, heads = (df.withColumn(c, F.col(c).cast("decimal(18,2)")) for df, c in ((lines, "a"), (heads, "d")))
    both = {r["check"]: (r["expected"], r["actual"]) for r in quality.allocation_checks(lines, heads, "k", "a", "d", "each", "total").collect()}
    each = quality.allocation_differences(lines, heads, "k", "a", "d").count()
    total = quality.allocation_reconciles(lines, heads, "k", "a", "d", "total").first()
    assert both == {"each": (0, each), "total": (total["expected"], total["actual"])} and each == 1
    none = quality.allocation_checks(lines.limit(0), heads, "k", "a", "d", "each", "total").collect()
    assert all(r["ok"] for r in none)

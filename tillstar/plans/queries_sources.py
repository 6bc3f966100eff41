"""Profiling, key inference, bulk loading and publication, over data derived from the test tables."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.operators import profile, quality
from tillstar.plans.oracle_base import over_ctes
from tillstar.plans.registry import Context, query
from tillstar.session import shared_dir
from tillstar.sources import csv, export, publish
from tillstar.sources.tables import Tables

# Tables as text, the way files hold them: codes, leading zeros, an empty column, mixed scales,
# timestamps and truth values, all functions of the test tables.
_TEXT_SQL = {
    "orders": (
        "SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS customer_id, "
        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created_at, "
        "strftime(o_orderdate, '%Y-%m-%d') AS due_at, CASE WHEN o_orderkey % 2 = 0 THEN 'TRUE' ELSE 'false' END AS is_open, "
        "o_orderpriority AS priority, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS order_code, "
        "CAST(o_orderkey % 900 + 100 AS VARCHAR) AS series, CAST(NULL AS VARCHAR) AS notes, "
        "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(o_custkey % 15 + 1 AS VARCHAR) END AS salesperson_id, "
        "'1' || lpad(CAST(o_orderkey AS VARCHAR), 43, '7') AS access_key, "
        "CASE WHEN o_orderkey % 2 = 0 THEN '-' || CAST(o_orderkey % 40 + 1 AS VARCHAR) ELSE CAST(o_orderkey % 10 AS VARCHAR) || '.125' END AS movement, "
        "CAST(o_orderkey * 100000 + 3000000000 AS VARCHAR) AS big_number FROM orders"),
    "order_items": (
        "SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_linenumber AS VARCHAR) AS line, "
        "CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) AS discount, l_returnflag AS return_flag FROM lineitem"),
    "products": "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, substr(p_brand, 7) AS category_id FROM part",
    "categories": "SELECT DISTINCT substr(p_brand, 7) AS id, p_brand AS name FROM part",
    "customers": "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS legal_name, lpad(CAST(c_custkey AS VARCHAR), 11, '5') AS tax_id FROM customer",
    "product_suppliers": (
        "SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS supplier_id FROM lineitem"),
    "suppliers": "SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS legal_name FROM supplier",
}


def text_tables(c: Context) -> Tables:
    d = c.driver
    key = F.col("o_orderkey")

    def s(column: Column) -> Column:
        return column.cast("string")

    orders = lambda: d["orders"].select(
        s(key).alias("id"), s(F.col("o_custkey")).alias("customer_id"),
        s(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("due_at"),
        F.when(key % 2 == 0, "TRUE").otherwise("false").alias("is_open"),
        F.col("o_orderpriority").alias("priority"),
        F.lpad(s(key), 12, "0").alias("order_code"),
        s(key % 900 + 100).alias("series"),
        F.lit(None).cast("string").alias("notes"),
        F.when(key % 3 == 0, "").otherwise(s(F.col("o_custkey") % 15 + 1)).alias("salesperson_id"),
        F.concat(F.lit("1"), F.lpad(s(key), 43, "7")).alias("access_key"),
        F.when(key % 2 == 0, F.concat(F.lit("-"), s(key % 40 + 1)))
        .otherwise(F.concat(s(key % 10), F.lit(".125"))).alias("movement"),
        s(key * 100000 + 3000000000).alias("big_number"),
    )
    return Tables({
        "orders": orders,
        "order_items": lambda: d["lineitem"].select(
            s(F.col("l_orderkey")).alias("order_id"), s(F.col("l_partkey")).alias("product_id"),
            s(F.col("l_linenumber")).alias("line"), s(F.col("l_discount").cast("decimal(4,2)")).alias("discount"),
            F.col("l_returnflag").alias("return_flag")),
        "products": lambda: d["part"].select(
            s(F.col("p_partkey")).alias("id"), F.col("p_name").alias("name"),
            F.substring("p_brand", 7, 10).alias("category_id")),
        "categories": lambda: d["part"].select(
            F.substring("p_brand", 7, 10).alias("id"), F.col("p_brand").alias("name")).distinct(),
        "customers": lambda: d["customer"].select(
            s(F.col("c_custkey")).alias("id"), F.col("c_name").alias("legal_name"),
            F.lpad(s(F.col("c_custkey")), 11, "5").alias("tax_id")),
        "product_suppliers": lambda: d["lineitem"].select(
            s(F.col("l_partkey")).alias("product_id"), s(F.col("l_suppkey")).alias("supplier_id")).distinct(),
        "suppliers": lambda: d["supplier"].select(
            s(F.col("s_suppkey")).alias("id"), F.col("s_name").alias("legal_name")),
    })


_TEXT_COLUMNS: Mapping[str, list[str]] = {
    "orders": ["id", "customer_id", "total", "created_at", "due_at", "is_open", "priority", "order_code", "series", "notes",
               "salesperson_id", "access_key", "movement", "big_number"],
    "order_items": ["order_id", "product_id", "line", "discount", "return_flag"],
    "products": ["id", "name", "category_id"], "categories": ["id", "name"],
    "customers": ["id", "legal_name", "tax_id"], "product_suppliers": ["product_id", "supplier_id"],
    "suppliers": ["id", "legal_name"],
}


def _profile_sql(table: str) -> str:
    """The profile of one text table, one select per column."""
    parts = []
    for i, col in enumerate(_TEXT_COLUMNS[table]):
        number = f"regexp_matches(v, '{profile.INTEGER}') OR regexp_matches(v, '{profile.DECIMAL}')"
        parts.append(
            f"SELECT '{table}' AS tabela, {i} AS posicao, '{col}' AS coluna, count(*) AS n_total, count(*) - count(v) AS n_vazio, "
            "coalesce(max(length(v)), 0) AS len_max, "
            "coalesce(bool_or(length(v) > 1 AND v[1] = '0' AND v[2] <> '.'), false) AS zero_a_esquerda, "
            f"coalesce(bool_and(regexp_matches(v, '{profile.INTEGER}')), true) AS so_inteiro, "
            f"coalesce(bool_and({number}), true) AS so_decimal, "
            f"coalesce(bool_and(v IN {profile.BOOLEANS}), true) AS so_booleano, "
            f"coalesce(bool_and(regexp_matches(v, '{profile.DATE}')), true) AS so_data, "
            f"coalesce(bool_and(regexp_matches(v, '{profile.TIMESTAMP}')), true) AS so_timestamp, "
            f"coalesce(max(CASE WHEN {number} THEN length(split_part(ltrim(v, '-'), '.', 1)) END), 0) AS digitos_max, "
            f"coalesce(max(CASE WHEN regexp_matches(v, '{profile.DECIMAL}') THEN length(split_part(v, '.', 2)) ELSE 0 END), 0) AS escala_max, "
            f"coalesce(max(CASE WHEN regexp_matches(v, '{profile.INTEGER}') AND length(ltrim(v, '-')) <= 18 THEN CAST(ltrim(v, '-') AS BIGINT) END), 0) AS maior_abs, "
            "list_sort(list_distinct([min(v), max(v), substr(min(lpad(CAST(length(v) AS VARCHAR), 9, '0') || v), 10), substr(max(lpad(CAST(length(v) AS VARCHAR), 9, '0') || v), 10), reverse(min(reverse(v)))])) AS amostras "
            f"FROM (SELECT CASE WHEN {col} <> '' THEN {col} END AS v FROM t_{table})")
    return " UNION ALL ".join(parts)


def _text_ctes(*tables: str) -> str:
    return ",\n".join(f"t_{t} AS ({_TEXT_SQL[t]})" for t in tables)


_STATS = (
    "tabela, posicao, coluna, n_total, n_vazio, len_max, zero_a_esquerda, so_inteiro, so_decimal, so_booleano, so_data, so_timestamp, "
    "digitos_max, escala_max, maior_abs, array_to_string(list_filter(amostras, lambda x: x IS NOT NULL), '|') AS amostras, "
    "CASE WHEN n_total > 0 THEN 100.0 * (n_total - n_vazio) / n_total ELSE 0 END AS pct_preenchido"
)


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumn("amostras", F.array_join("amostras", "|"))


for _table in ("orders", "order_items", "products", "customers"):
    query(f"profile_{_table}", f"WITH {_text_ctes(_table)} SELECT {_STATS} FROM ({_profile_sql(_table)})")(
        lambda c, t=_table: _flat(profile.profile_columns(text_tables(c)[t], t)))

_ALL = tuple(_TEXT_SQL)
_VARCHAR = "CASE " + " ".join(f"WHEN len_max <= {n} THEN 'VARCHAR({n})'" for n in profile.VARCHAR_SIZES) + " ELSE 'TEXT' END"
_TYPES_SQL = (
    f"SELECT tabela, coluna, CASE WHEN n_total = n_vazio THEN 'TEXT' WHEN coluna IN {profile.CODE_NAMES} THEN {_VARCHAR} "
    f"WHEN zero_a_esquerda THEN {_VARCHAR} WHEN so_booleano THEN 'BOOLEAN' WHEN so_data THEN 'DATE' WHEN so_timestamp THEN 'TIMESTAMP' "
    f"WHEN so_inteiro AND digitos_max > 18 THEN 'TEXT' WHEN so_inteiro AND maior_abs <= {profile.MAX_INT4} THEN 'INTEGER' "
    "WHEN so_inteiro THEN 'BIGINT' WHEN so_decimal THEN format('NUMERIC({},{})', digitos_max + escala_max + 2, escala_max) "
    f"ELSE {_VARCHAR} END AS tipo FROM ("
)


def all_profiles(c: Context) -> DataFrame:
    tables = text_tables(c)
    return quality.all_checks([profile.profile_columns(tables[t], t) for t in _ALL])


@query("inferred_types", f"WITH {_text_ctes(*_ALL)} " + _TYPES_SQL + " UNION ALL ".join(_profile_sql(t) for t in _ALL) + ")")
def inferred_types(c: Context):
    return profile.infer_types(all_profiles(c)).select("tabela", "coluna", "tipo")


@query("inferred_types_text_mode", f"WITH {_text_ctes(*_ALL)} " + _TYPES_SQL.replace(_VARCHAR, "'TEXT'")
       + " UNION ALL ".join(_profile_sql(t) for t in _ALL) + ")")
def inferred_types_text_mode(c: Context):
    return profile.infer_types(all_profiles(c), varchar="text").select("tabela", "coluna", "tipo")


@query("inferred_type_reasons", f"WITH {_text_ctes('orders')} SELECT coluna, CASE "
       "WHEN n_total = n_vazio THEN format('no value in {} rows; the type cannot be determined', n_total) "
       f"WHEN coluna IN {profile.CODE_NAMES} THEN format('a code, not a quantity (longest {{}})', len_max) "
       "WHEN zero_a_esquerda THEN format('leading zero (such as {}) would be lost in a number', list_filter(amostras, lambda x: x[1] = '0')[1]) "
       "WHEN so_booleano THEN format('{} values, all true or false', n_total - n_vazio) "
       "WHEN so_data THEN format('{} values, all dates without a time', n_total - n_vazio) "
       "WHEN so_timestamp THEN format('{} values, all date and time', n_total - n_vazio) "
       "WHEN so_inteiro AND digitos_max > 18 THEN format('{} digits exceed a big integer; an identifier', digitos_max) "
       f"WHEN so_inteiro AND maior_abs <= {profile.MAX_INT4} THEN format('{{}} whole numbers up to {{}}', n_total - n_vazio, maior_abs) "
       "WHEN so_inteiro THEN format('{} whole numbers up to {}, beyond four bytes', n_total - n_vazio, maior_abs) "
       "WHEN so_decimal THEN format('{} decimals: up to {} whole digits and {} decimals, with 2 to spare', n_total - n_vazio, digitos_max, escala_max) "
       f"ELSE format('{{}} texts, longest {{}}', n_total - n_vazio, len_max) END AS justificativa FROM ({_profile_sql('orders')})")
def inferred_type_reasons(c: Context):
    return profile.infer_types(profile.profile_columns(text_tables(c)["orders"], "orders")).select("coluna", "justificativa")


@query("profile_overview", f"WITH {_text_ctes(*_ALL)} SELECT tabela, max(n_total) AS linhas, count(*) AS colunas, "
       "count(*) FILTER (n_total = n_vazio) AS colunas_vazias, "
       "round(avg(CASE WHEN n_total > 0 THEN 100.0 * (n_total - n_vazio) / n_total ELSE 0 END), 6) AS preenchimento_medio FROM ("
       + " UNION ALL ".join(_profile_sql(t) for t in _ALL) + ") GROUP BY tabela")
def profile_overview(c: Context):
    return profile.table_overview(all_profiles(c)).withColumn("preenchimento_medio", F.round("preenchimento_medio", 6))


_KEYS = {"orders": "id", "order_items": "order_id,product_id", "products": "id", "categories": "id", "customers": "id",
         "product_suppliers": "product_id,supplier_id", "suppliers": "id"}


@query("primary_keys", f"WITH {_text_ctes(*_ALL)} " + " UNION ALL ".join(
    f"SELECT '{t}' AS tabela, '{k}' AS chave, count(*) AS linhas, (SELECT count(*) FROM (SELECT DISTINCT {k} FROM t_{t})) AS combinacoes, "
    f"{'true' if k == 'id' else f'count(*) = (SELECT count(*) FROM (SELECT DISTINCT {k} FROM t_{t}))'} AS declarada FROM t_{t}"
    for t, k in _KEYS.items()))
def primary_keys(c: Context):
    tables = text_tables(c)
    return quality.all_checks([profile.key_report(tables[t], t) for t in _ALL])


def _foreign_keys() -> list[profile.ForeignKey]:
    return profile.infer_foreign_keys(_TEXT_COLUMNS, overrides={("orders", "salesperson_id"): ("suppliers", "id")})


@query("foreign_key_integrity", f"WITH {_text_ctes(*_ALL)} " + " UNION ALL ".join(
    f"SELECT '{k.table}' AS tabela, '{k.column}' AS coluna, '{k.target}' AS destino, '{k.origin}' AS origem, count(*) AS orfaos "
    f"FROM t_{k.table} WHERE nullif({k.column}, '') IS NOT NULL AND {k.column} NOT IN (SELECT {k.target_column} FROM t_{k.target})"
    for k in _foreign_keys()))
def foreign_key_integrity(c: Context):
    tables = Tables({t: df.replace("", None) for t, df in text_tables(c).items()})
    return profile.foreign_key_report(tables, _foreign_keys())


@query("orphan_values", over_ctes(
    "SELECT CAST(o_custkey AS BIGINT) AS value, count(*) AS rows FROM orders WHERE o_custkey NOT IN "
    "(SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY 1"))
def orphan_values(c: Context):
    """Orders of customers missing from the active part of the customer table."""
    return quality.orphans(c.raw["orders"], "customer_id", c.raw["customers"].filter("is_active"), "id")


# -- files -------------------------------------------------------------------------------------

_FILES = ("orders", "order_items", "products", "categories", "customers", "suppliers")
_runs = count()


def write_files(c: Context) -> dict[str, str]:
    """The text tables as CSV in the shared folder: the files that the loading queries read.

    Every query call writes a folder of its own, so concurrent runs do not meet.
    """
    tables = text_tables(c)
    root = f"{shared_dir(c.spark)}/tillstar-csv/{c.spark.sparkContext.applicationId}-{next(_runs)}"
    for name in _FILES:
        tables[name].write.mode("overwrite").options(header=True, emptyValue="", nullValue="", quote="").csv(f"{root}/{name}")
    return {name: f"{root}/{name}" for name in _FILES}


def published_root(paths: Mapping[str, str]) -> str:
    return paths["orders"].removesuffix("/orders") + "-published"


def _declared(columns: list[str], **typed: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, typed.get(n, T.StringType())) for n in columns])


DECLARED = {
    "orders": _declared(
        # Declared in another order than the files have: columns bind by name.
        list(reversed(_TEXT_COLUMNS["orders"])), id=T.LongType(), customer_id=T.LongType(), total=T.DecimalType(18, 2),
        created_at=T.TimestampNTZType(), due_at=T.DateType(), is_open=T.BooleanType(), salesperson_id=T.IntegerType(),
        movement=T.DecimalType(8, 3), big_number=T.LongType()),
    "order_items": _declared(_TEXT_COLUMNS["order_items"], order_id=T.LongType(), product_id=T.LongType(),
                             line=T.IntegerType(), discount=T.DecimalType(4, 2)),
    "products": _declared(_TEXT_COLUMNS["products"], id=T.LongType(), category_id=T.LongType()),
    "categories": _declared(_TEXT_COLUMNS["categories"], id=T.LongType()),
    "customers": _declared(_TEXT_COLUMNS["customers"], id=T.LongType()),
    "suppliers": _declared(_TEXT_COLUMNS["suppliers"], id=T.LongType()),
}


@query("csv_load_typed", f"WITH {_text_ctes('orders')} SELECT CAST(id AS BIGINT) AS id, CAST(customer_id AS BIGINT) AS customer_id, "
       "CAST(total AS DOUBLE) AS total, CAST(created_at AS TIMESTAMP) AS created_at, CAST(due_at AS TIMESTAMP) AS due_at, "
       "CAST(is_open AS BOOLEAN) AS is_open, priority, order_code, series, notes, CAST(nullif(salesperson_id, '') AS INTEGER) AS salesperson_id, "
       "access_key, CAST(movement AS DOUBLE) AS movement, CAST(big_number AS BIGINT) AS big_number FROM t_orders")
def csv_load_typed(c: Context):
    return csv.load_tables(c.spark, write_files(c), DECLARED)["orders"]


@query("load_report", f"WITH {_text_ctes(*_FILES)} " + " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", {len(_TEXT_COLUMNS[t])} AS n_cols, 'LF' AS terminator, count(*) AS n_file, count(*) AS n_loaded, "
    f"count(*) AS n_stored, true AS ok FROM t_{t}" for t in _FILES))
def load_report(c: Context):
    paths = write_files(c)
    return publish.bulk_load(c.spark, paths, DECLARED, published_root(paths), "first")


@query("load_report_totals", f"WITH {_text_ctes(*_FILES)} SELECT 6::BIGINT AS tables, sum(n)::BIGINT AS rows, "
       "sum(n) FILTER (t IN ('orders', 'customers'))::BIGINT AS subset_rows, true AS ok FROM ("
       + " UNION ALL ".join(f"SELECT '{t}' AS t, count(*) AS n FROM t_{t}" for t in _FILES) + ")")
def load_report_totals(c: Context):
    paths = write_files(c)
    report = publish.bulk_load(c.spark, paths, DECLARED, published_root(paths), "first")
    return csv.report_totals(report, ["orders", "customers"])


@query("csv_inventory", f"WITH {_text_ctes(*_FILES)} " + " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", {len(_TEXT_COLUMNS[t])} AS n_cols, 'LF' AS terminator, count(*) AS n_file FROM t_{t}" for t in _FILES))
def csv_inventory(c: Context):
    return csv.inventory(c.spark, write_files(c))


@query("published_layer_view", over_ctes(
    "SELECT c.category_id, c.categoria, count(*) AS produtos FROM s_produtos p JOIN s_categorias c ON c.category_id = p.category_id GROUP BY 1, 2"))
def published_layer_view(c: Context):
    """Two cleaned tables published, read back through the pointer, and queried as views."""
    root = f"{shared_dir(c.spark)}/tillstar-layer/{c.spark.sparkContext.applicationId}-{next(_runs)}"
    layer = Tables({t: lambda t=t: c.silver[t] for t in ("produtos", "categorias")})
    publish.publish(c.spark, root, layer, "first", lambda t: quality.all_checks([
        quality.key_is_unique(t["produtos"], ["product_id"], "produtos: key"),
        quality.key_is_unique(t["categorias"], ["category_id"], "categorias: key")]))
    publish.create_views(publish.read_current(c.spark, root), "silver_")
    return c.spark.sql(
        "SELECT c.category_id, c.categoria, count(*) AS produtos FROM silver_produtos p "
        "JOIN silver_categorias c ON c.category_id = p.category_id GROUP BY c.category_id, c.categoria")


@query("parquet_export", over_ctes(
    "SELECT product_variant_id, location_id, CAST(quantity_on_hand AS DOUBLE) AS quantity_on_hand, CAST(NULL AS VARCHAR) AS ponto_de_reposicao, "
    "CAST('2001-08-01' AS TIMESTAMP) AS atualizado FROM r_stock"))
def parquet_export(c: Context):
    """Stock written for BI tools (decimal, date and untyped columns) and read back."""
    path = f"{shared_dir(c.spark)}/tillstar-export/{c.spark.sparkContext.applicationId}-{next(_runs)}"
    stock = c.raw["stock_levels"].select(
        "product_variant_id", "location_id", "quantity_on_hand", F.lit(None).alias("ponto_de_reposicao"),
        F.to_date("updated_at").alias("atualizado"))
    export.write_parquet(stock, path)
    return c.spark.read.parquet(path)

"""Profiling untyped tables: statistics per column, then types, keys and foreign keys."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that hold codes, on which arithmetic makes no sense.
CODE_NAMES = (
    "tax_id", "cpf", "cnpj", "phone", "postal_code", "barcode_ean", "series",
    "nfe_access_key", "nfe_number", "ncm_code", "state_registration", "sku", "supplier_sku",
)

# Foreign keys named after a role, the polymorphic column, and ids that refer to nothing.
FK_OVERRIDES = {
    ("orders", "salesperson_id"): ("employees", "id"),
    ("purchase_orders", "buyer_id"): ("employees", "id"),
    ("return_items", "exchange_variant_id"): ("product_variants", "id"),
}
FK_IGNORED = (("stock_movements", "reference_id"),)
NOT_FKS = ("tax_id",)

# Patterns of typed text, truth values, text sizes and the four-byte limit.
INTEGER = r"^-?\d+$"
DECIMAL = r"^-?\d+\.\d+$"
DATE = r"^\d{4}-\d{2}-\d{2}$"
TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d+)?$"
BOOLEANS = ("TRUE", "FALSE", "true", "false", "True", "False")
VARCHAR_SIZES = (8, 16, 32, 64, 128, 255)
MAX_INT4 = 2_147_483_647
MAX_DIGITS = 18

def as_strings(df: DataFrame) -> DataFrame:
    """Every column as the text a file would hold; NULL is the empty field."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _samples(name: str) -> Column:
    """Up to five values of a column, from state of constant size: extremes by value, by length
    and by reversed text."""
    raw = F.col(f"`{name}`")
    v = F.when(raw != "", raw)
    width = 9
    by_length = F.concat(F.lpad(F.length(v).cast("string"), width, "0"), v)
    picked = F.array(
        F.min(v), F.max(v),
        F.substr(F.min(by_length), F.lit(width + 1)), F.substr(F.max(by_length), F.lit(width + 1)),
        F.reverse(F.min(F.reverse(v))),
    )
    return F.struct(
        F.lit(name).alias("_name"),
        F.array_sort(F.array_distinct(F.array_compact(picked))).alias("amostras"),
    )


def profile_columns(strings: DataFrame, table: str) -> DataFrame:
    """One row of statistics per column of an all-text table.

    The cells are unpivoted and aggregated by column name with buffers of fixed size, so the
    work is one hash aggregate however many columns there are. Samples are one more scan.
    The empty string is the only empty value; a column without values keeps its "only ..." flags.
    """
    positions = {name: i for i, name in enumerate(strings.columns)}
    cells = strings.unpivot([], strings.columns, "coluna", "_raw").select(
        "coluna", F.when(F.col("_raw") != "", F.col("_raw")).alias("v")
    )
    v = F.col("v")
    # What a pattern cannot match is told by its point or its length (a line end may follow), so most cells meet one pattern.
    dotted = v.contains(".")
    tested = cells.select(
        "coluna", "v",
        (~dotted & v.rlike(INTEGER)).alias("_int"), (dotted & v.rlike(DECIMAL)).alias("_dec"),
        F.ltrim(v, F.lit("-")).alias("_body"),
        v.isin(*BOOLEANS).alias("_bool"), (F.length(v).between(10, 12) & v.rlike(DATE)).alias("_date"),
        ((F.length(v) >= 19) & v.rlike(TIMESTAMP)).alias("_ts"),
    )
    body, number = F.col("_body"), F.col("_int") | F.col("_dec")
    leading_zero = (F.length(v) > 1) & v.startswith("0") & (F.substring(v, 2, 1) != ".")
    small = F.when(F.col("_int") & (F.length(body) <= MAX_DIGITS), body.try_cast("bigint"))
    fraction = F.when(F.col("_dec"), F.length(F.substring_index(body, ".", -1)))

    def all_true(c: str | Column) -> Column:
        return F.coalesce(F.bool_and(c), F.lit(True))

    statistics = tested.groupBy("coluna").agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(v.isNull()).alias("n_vazio"),
        F.coalesce(F.max(F.length(v)), F.lit(0)).alias("len_max"),
        F.coalesce(F.bool_or(leading_zero), F.lit(False)).alias("zero_a_esquerda"),
        all_true("_int").alias("so_inteiro"),
        all_true(number).alias("so_decimal"),
        all_true("_bool").alias("so_booleano"),
        all_true("_date").alias("so_data"),
        all_true("_ts").alias("so_timestamp"),
        F.coalesce(F.max(F.when(number, F.length(F.substring_index(body, ".", 1)))), F.lit(0)).alias("digitos_max"),
        F.coalesce(F.max(fraction), F.lit(0)).alias("escala_max"),
        F.coalesce(F.max(small), F.lit(0).cast("bigint")).alias("maior_abs"),
    )
    samples = strings.agg(F.array(*[_samples(c) for c in strings.columns]).alias("s")).select(F.inline("s"))
    position = F.create_map(*[F.lit(x) for item in positions.items() for x in item])
    filled = F.when(
        F.col("n_total") > 0,
        F.lit(100.0) * (F.col("n_total") - F.col("n_vazio")) / F.col("n_total"),
    ).otherwise(F.lit(0.0))
    # One row per column on both sides; a table without rows has samples but no statistics.
    joined = samples.join(statistics, F.col("_name") == F.col("coluna"), "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_total", "n_vazio", "len_max", "digitos_max", "escala_max", "maior_abs")}
    flags = {c: F.coalesce(c, F.lit(True)) for c in ("so_inteiro", "so_decimal", "so_booleano", "so_data", "so_timestamp")}
    return joined.withColumns(
        zero | flags | {"zero_a_esquerda": F.coalesce("zero_a_esquerda", F.lit(False)), "coluna": F.col("_name")}
    ).select(
        F.lit(table).alias("tabela"), position[F.col("coluna")].alias("posicao"), "coluna",
        "n_total", "n_vazio", "len_max", "zero_a_esquerda", "so_inteiro", "so_decimal", "so_booleano",
        "so_data", "so_timestamp", "digitos_max", "escala_max", "maior_abs", "amostras",
        filled.alias("pct_preenchido"),
    )


def _text_type(varchar: str) -> Column:
    if varchar == "text":
        return F.lit("TEXT")
    size = F.lit("TEXT")
    for n in reversed(VARCHAR_SIZES):
        size = F.when(F.col("len_max") <= n, F.lit(f"VARCHAR({n})")).otherwise(size)
    return size


def infer_types(profile: DataFrame, varchar: str = "bucket", code_names: Sequence[str] = CODE_NAMES) -> DataFrame:
    """The type of each profiled column and the reason for it. The first rule that matches wins.

    ``varchar`` is ``bucket`` (smallest text size that fits) or ``text``.
    """
    filled = (F.col("n_total") - F.col("n_vazio")).cast("string")
    text = _text_type(varchar)
    digits, scale, length = (F.col(c).cast("string") for c in ("digitos_max", "escala_max", "len_max"))
    precision = F.col("digitos_max") + F.col("escala_max") + 2
    zero_example = F.element_at(F.filter("amostras", lambda s: s.startswith("0")), 1)
    largest = F.col("maior_abs").cast("string")
    rules = [
        (F.col("n_total") == F.col("n_vazio"), F.lit("TEXT"),
         F.format_string("no value in %s rows; the type cannot be determined", F.col("n_total").cast("string"))),
        (F.col("coluna").isin(*code_names), text,
         F.format_string("a code, not a quantity (longest %s)", length)),
        (F.col("zero_a_esquerda"), text,
         F.format_string("leading zero (such as %s) would be lost in a number", F.coalesce(zero_example, F.lit("0...")))),
        (F.col("so_booleano"), F.lit("BOOLEAN"), F.format_string("%s values, all true or false", filled)),
        (F.col("so_data"), F.lit("DATE"), F.format_string("%s values, all dates without a time", filled)),
        (F.col("so_timestamp"), F.lit("TIMESTAMP"), F.format_string("%s values, all date and time", filled)),
        (F.col("so_inteiro") & (F.col("digitos_max") > MAX_DIGITS), F.lit("TEXT"),
         F.format_string("%s digits exceed a big integer; an identifier", digits)),
        (F.col("so_inteiro") & (F.col("maior_abs") <= MAX_INT4), F.lit("INTEGER"),
         F.format_string("%s whole numbers up to %s", filled, largest)),
        (F.col("so_inteiro"), F.lit("BIGINT"),
         F.format_string("%s whole numbers up to %s, beyond four bytes", filled, largest)),
        (F.col("so_decimal"),
         F.format_string("NUMERIC(%s,%s)", precision.cast("string"), scale),
         F.format_string("%s decimals: up to %s whole digits and %s decimals, with 2 to spare", filled, digits, scale)),
    ]
    kind, reason = text, F.format_string("%s texts, longest %s", filled, length)
    for condition, type_name, why in reversed(rules):
        kind = F.when(condition, type_name).otherwise(kind)
        reason = F.when(condition, why).otherwise(reason)
    return profile.withColumn("tipo", kind).withColumn("justificativa", reason)


_SPARK_TYPES: Mapping[str, T.DataType] = {
    "TEXT": T.StringType(), "BOOLEAN": T.BooleanType(), "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(), "INTEGER": T.IntegerType(), "BIGINT": T.LongType(),
}


def spark_type(type_name: str) -> T.DataType:
    """The Spark type for an inferred type name. NUMERIC beyond 38 digits stays text."""
    if type_name.startswith("VARCHAR"):
        return T.StringType()
    if type_name.startswith("NUMERIC"):
        precision, scale = (int(n) for n in type_name[8:-1].split(","))
        return T.DecimalType(precision, scale) if precision <= 38 else T.StringType()
    return _SPARK_TYPES[type_name]


def schema_of(types: DataFrame, primary_key: Sequence[str] = ()) -> T.StructType:
    """The table's schema from its typed profile: metadata, one row per column.

    Only primary key columns are declared not NULL: one extract proves nothing about the others.
    """
    rows = types.select("coluna", "tipo", "justificativa", "posicao").orderBy("posicao").collect()
    return T.StructType([
        T.StructField(r["coluna"], spark_type(r["tipo"]), r["coluna"] not in primary_key,
                      {"source_type": r["tipo"], "comment": r["justificativa"]})
        for r in rows
    ])


def type_mismatches(df: DataFrame, expected: T.StructType) -> list[tuple[str, str, str]]:
    """Columns whose type is not the declared one, as ``(name, declared, found)``."""
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    return [
        (f.name, f.dataType.simpleString(), found.get(f.name, "missing"))
        for f in expected
        if found.get(f.name) != f.dataType.simpleString()
    ]


def key_candidate(columns: Sequence[str]) -> list[str]:
    """``id`` where there is one, else the ``*_id`` columns that the table starts with."""
    if "id" in columns:
        return ["id"]
    leading = []
    for name in columns:
        if not name.endswith("_id"):
            break
        leading.append(name)
    return leading


def key_report(df: DataFrame, table: str) -> DataFrame:
    """One row: the candidate key, rows, distinct combinations, and whether it is declared.

    ``id`` is taken as it is; a composite key must be unique over the whole table.
    """
    candidate = key_candidate(df.columns)
    rows = df.agg(F.count(F.lit(1)).alias("linhas"))
    if not candidate:
        return rows.select(F.lit(table).alias("tabela"), F.lit("").alias("chave"), "linhas",
                           F.lit(0).cast("bigint").alias("combinacoes"), F.lit(False).alias("declarada"))
    distinct = df.select(*candidate).distinct().agg(F.count(F.lit(1))).scalar()
    counted = rows.withColumn("combinacoes", distinct)
    declared = F.lit(True) if candidate == ["id"] else F.col("linhas") == F.col("combinacoes")
    return counted.select(
        F.lit(table).alias("tabela"), F.lit(",".join(candidate)).alias("chave"),
        "linhas", "combinacoes", declared.alias("declarada"),
    )


def infer_primary_key(df: DataFrame, table: str = "") -> list[str]:
    """The primary key columns, or an empty list where no candidate holds."""
    if key_candidate(df.columns) == ["id"]:
        return ["id"]
    row = key_report(df, table).first()
    return row["chave"].split(",") if row["declarada"] else []


def singular(table: str) -> str:
    """The singular of an English plural table name."""
    endings = (("ies", "y"), ("sses", "ss"), ("shes", "sh"), ("ches", "ch"), ("xes", "x"), ("zes", "z"), ("s", ""))
    for plural, one in endings:
        if table.endswith(plural):
            return table.removesuffix(plural) + one
    return table


@dataclass(frozen=True)
class ForeignKey:
    table: str
    column: str
    target: str
    target_column: str
    origin: str


def infer_foreign_keys(
    columns: Mapping[str, Sequence[str]],
    overrides: Mapping[tuple[str, str], tuple[str, str]] = FK_OVERRIDES,
    ignored: Iterable[tuple[str, str]] = FK_IGNORED,
    not_keys: Iterable[str] = NOT_FKS,
) -> list[ForeignKey]:
    """Foreign keys by name: ``<table in singular>_id``, longest table name first.

    Only names are looked at, so this is metadata work; whether the references hold is checked
    on the data by ``foreign_key_report``.
    """
    by_singular = {singular(t): t for t in columns}
    skip, never = set(ignored), set(not_keys)
    found = []
    for table in sorted(columns):
        for column in columns[table]:
            if not column.endswith("_id") or column in never or (table, column) in skip:
                continue
            if (table, column) in overrides:
                target, target_column = overrides[table, column]
                found.append(ForeignKey(table, column, target, target_column, "override"))
                continue
            words = column.removesuffix("_id").split("_")
            suffixes = ("_".join(words[i:]) for i in range(len(words)))
            target = next((by_singular[s] for s in suffixes if s in by_singular), None)
            if target is not None and "id" in columns[target]:
                found.append(ForeignKey(table, column, target, "id", "name"))
    return found


def foreign_key_report(tables: Mapping[str, DataFrame], keys: Sequence[ForeignKey]) -> DataFrame:
    """Rows and orphan rows per foreign key. NULL references nothing and is allowed. No keys give no rows.

    Every table is read once for all its foreign keys and once for each column that is referred to. Values are counted
    in the map tasks, so a frequent one travels once; they are compared as text, after a cast to the type they refer to.
    """
    names = ("tabela", "coluna", "destino", "origem")
    if not keys:
        return SparkSession.active().range(0).select(*[F.lit("").alias(c) for c in names], F.lit(0).cast("long").alias("orfaos"))
    targets = list(dict.fromkeys((k.target, k.target_column) for k in keys))

    def value(k: ForeignKey) -> Column:
        kind = tables[k.target].schema[k.target_column].dataType
        own = F.col(f"`{k.column}`")
        plain = own.cast("string")
        return plain if tables[k.table].schema[k.column].dataType == kind else F.coalesce(own.try_cast(kind).cast("string"), plain)

    by_table: dict[str, list[tuple[int, ForeignKey]]] = {}
    for i, k in enumerate(keys):
        by_table.setdefault(k.table, []).append((i, k))
    cells = [
        tables[t].select(F.inline(F.array(*[
            F.struct(F.lit(i).alias("fk"), F.lit(targets.index((k.target, k.target_column))).alias("target"), value(k).alias("value")) for i, k in own])))
        for t, own in by_table.items()
    ]
    values = reduce(DataFrame.unionByName, cells).filter("value is not null").groupBy("fk", "target", "value").agg(F.count(F.lit(1)).alias("rows"))
    known = reduce(DataFrame.unionByName, [
        tables[t].select(F.lit(i).alias("target"), F.col(f"`{c}`").cast("string").alias("value")) for i, (t, c) in enumerate(targets)])
    lost = values.join(known, ["target", "value"], "left_anti").select("fk", "rows")
    # One row per key, also where nothing is lost.
    listed = SparkSession.active().range(len(keys)).select(F.col("id").cast("int").alias("fk"), F.lit(0).cast("long").alias("rows"))
    sums = lost.unionByName(listed).groupBy("fk").agg(F.sum("rows").alias("orfaos"))
    label = lambda f: F.element_at(F.array(*[F.lit(f(k)) for k in keys]), F.col("fk") + 1)
    fields = (lambda k: k.table, lambda k: k.column, lambda k: k.target, lambda k: k.origin)
    return sums.select(*[label(f).alias(c) for c, f in zip(names, fields, strict=True)], "orfaos")


def table_overview(profile: DataFrame) -> DataFrame:
    """Rows, columns, empty columns and mean fill per table of a profile."""
    return profile.groupBy("tabela").agg(
        F.max("n_total").alias("linhas"),
        F.count(F.lit(1)).alias("colunas"),
        F.count_if(F.col("n_total") == F.col("n_vazio")).alias("colunas_vazias"),
        F.avg("pct_preenchido").alias("preenchimento_medio"),
    )

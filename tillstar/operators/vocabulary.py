"""Free text to a short list of classes, and attribute rows to typed columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.text import null_if_junk

ACCENTED, BARE = "áàâãäéèêëíìîïóòôõöúùûüç", "aaaaaeeeeiiiiooooouuuuc"


def plain_text(c: Column | str) -> Column:
    """Lower case without accents; all that is neither letter nor digit is one space; NULL for junk."""
    bare = F.translate(F.lower(null_if_junk(c)), ACCENTED, BARE)
    return F.nullif(F.trim(F.regexp_replace(bare, "[^a-z0-9]+", " ")), F.lit(""))


def canonical_values(rows: DataFrame, column: str, classes: Mapping[str, Sequence[str]], max_edits: int = 2) -> DataFrame:
    """Every distinct value of ``column``: ``valor, linhas, classe, regra, edicoes``.

    ``classes`` names the canonical spellings and known other spellings of each. Rules, in order: ``nulo`` (null, blank or
    junk), ``exata`` (the canonical spelling, apart from case, accents and punctuation), ``variante`` (a known one),
    ``distancia`` (one class has the fewest edits to a spelling, at most ``max_edits`` and a quarter of its length),
    ``ambigua`` (several classes have them), ``sem_classe``. The last two keep a NULL class and are counted, not
    dropped. Only distinct values are compared, each with the spellings of the list.
    """
    counted = rows.groupBy(F.col(column).alias("valor")).agg(F.count(F.lit(1)).alias("linhas")).withColumn("_p", plain_text("valor"))

    def of(spellings: Mapping[str, Sequence[str]]) -> Column:
        found = F.lit(None).cast("string")
        for name, known in spellings.items():
            if known:
                found = F.when(F.col("_p").isin(*known), name).otherwise(found)
        return found

    exact = of({name: [_plain(name)] for name in classes})
    variant = of({name: [_plain(x) for x in known] for name, known in classes.items()})
    near = F.filter(F.array(*[
        F.struct(F.levenshtein("_p", F.lit(s), min(max_edits, len(s) // 4)).alias("d"), F.lit(name).alias("c"))
        for name, known in classes.items() for s in sorted({_plain(name), *map(_plain, known)})]), lambda x: x["d"] >= 0)
    least = F.array_min(F.transform("_near", lambda x: x["d"]))
    closest = F.array_distinct(F.transform(F.filter("_near", lambda x: x["d"] == F.col("_d")), lambda x: x["c"]))
    judged = counted.select("valor", "linhas", "_p", exact.alias("_exact"), variant.alias("_variant"), near.alias("_near")) \
        .withColumn("_d", least).withColumn("_closest", closest)
    one = F.size("_closest") == 1
    rule = (F.when(F.col("_p").isNull(), "nulo").when(F.col("_exact").isNotNull(), "exata").when(F.col("_variant").isNotNull(), "variante")
            .when(F.col("_d").isNull(), "sem_classe").when(one, "distancia").otherwise("ambigua"))
    return judged.select(
        "valor", "linhas", F.coalesce("_exact", "_variant", F.when(one, F.get("_closest", F.lit(0)))).alias("classe"), rule.alias("regra"),
        F.when(F.col("_exact").isNull() & F.col("_variant").isNull(), F.col("_d")).alias("edicoes"))


def _plain(text: str) -> str:
    """``plain_text`` of a spelling of the list."""
    bare = text.lower().translate(str.maketrans(ACCENTED, BARE))
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in bare).split())


def with_class(rows: DataFrame, column: str, values: DataFrame, name: str = "classe") -> DataFrame:
    """``rows`` with the class of their value; no row is lost."""
    known = values.select(F.col("valor").alias("_value"), F.col("classe").alias("_class"))
    return rows.join(known, F.col(column).eqNullSafe(F.col("_value")), "left").withColumn(name, F.col("_class")).drop("_value", "_class")


def _named(rows: DataFrame, name: str) -> Column:
    return F.lower(F.trim(name))


def typed(value: Column, kind: str) -> Column:
    """A text value as ``kind``; numbers may have a comma before the decimals, truth may be told in words. NULL if it is none."""
    plain = F.trim(value)
    if kind == "boolean":
        return F.when(F.lower(plain).isin("sim", "true", "1", "s"), True).when(F.lower(plain).isin("nao", "não", "false", "0", "n"), False)
    return F.nullif(plain, F.lit("")) if kind == "string" else F.replace(plain, F.lit(","), F.lit(".")).try_cast(kind)


def unpack_attributes(rows: DataFrame, declared: Mapping[str, str], entity: str, name: str, value: str, order: str) -> DataFrame:
    """One row per entity with a typed column for every declared attribute, from rows of entity, name and value.

    Names are compared trimmed and in lower case. Of several values of one attribute the one with the largest ``order`` that
    has the declared type counts, of equal orders the smallest text. ``conflitos`` counts attributes with different typed
    values, ``invalidos`` values that have not the type, ``desconhecidos`` rows whose name is not declared (or null).
    One aggregation whatever the number of attributes; the columns come from the list, never from the data. Texts are
    aggregated by sorting, so rows are dealt by entity first: a task sorts one partition of them, not all that it read.
    """
    attr, text = _named(rows, name), F.col(value).cast("string")
    known = attr.isin(*declared)
    parts = []
    for n, kind in declared.items():
        v = F.when(attr == n, typed(text, kind))
        pick = F.struct((-F.col(order)).alias("late"), text.alias("text"), v.alias("v"))
        parts += [F.min(F.when(v.isNotNull(), pick)).alias(f"_{n}"), (F.min(v) != F.max(v)).alias(f"_conflict_{n}"),
                  F.count_if((attr == n) & (F.trim(text) != "") & v.isNull()).alias(f"_bad_{n}")]
    dealt = rows.select(entity, name, value, order).repartition(F.col(entity))
    summed = dealt.groupBy(F.col(entity)).agg(*parts, F.count_if(~F.coalesce(known, F.lit(False))).alias("desconhecidos"))
    conflicts = sum((F.coalesce(F.col(f"_conflict_{n}").cast("int"), F.lit(0)) for n in declared), F.lit(0))
    invalid = sum((F.col(f"_bad_{n}") for n in declared), F.lit(0).cast("long"))
    return summed.select(entity, *[F.col(f"_{n}.v").alias(n) for n in declared], conflicts.alias("conflitos"), invalid.alias("invalidos"), "desconhecidos")


def undeclared_names(rows: DataFrame, declared: Mapping[str, str], name: str, value: str) -> DataFrame:
    """Names outside the list: ``nome, linhas, exemplo`` (the smallest value)."""
    attr = _named(rows, name)
    return rows.filter(~F.coalesce(attr.isin(*declared), F.lit(False))).groupBy(attr.alias("nome")).agg(
        F.count(F.lit(1)).alias("linhas"), F.min(F.col(value).cast("string")).alias("exemplo"))

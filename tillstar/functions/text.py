"""Text cleaning: junk tokens become NULL, names become labels, capitals are repaired."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Tokens that count as "no text", compared trimmed and in lower case.
JUNK_TOKENS = (
    "?", "??", "-", "--", "—", "...", "n/a", "na", "tbd", "todo",
    "fixme", "asdf", "test", "xxx", "sem nome", "null", "none",
)

# Names that a ranking marks as suspicious, compared exactly.
SUSPICIOUS_NAMES = (
    "?", "??", "-", "--", "—", "...", "n/a", "N/A", "TBD", "TODO",
    "FIXME", "asdf", "test", "xxx", "Sem Nome", "",
)

UNNAMED = "[sem nome]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_junk(c: Column | str) -> Column:
    """The space-trimmed value, or NULL where it is blank or one of ``JUNK_TOKENS``."""
    trimmed = F.trim(_col(c))
    return F.when((trimmed != "") & ~F.lower(trimmed).isin(*JUNK_TOKENS), trimmed)


def register_sql_functions(spark: SparkSession) -> None:
    """``null_if_junk`` for SQL users, as a SQL function that the optimizer sees through."""
    tokens = ", ".join(f"'{t}'" for t in JUNK_TOKENS)
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION null_if_junk(v STRING) RETURNS STRING RETURN "
        f"CASE WHEN trim(v) <> '' AND lower(trim(v)) NOT IN ({tokens}) THEN trim(v) END"
    )


def is_junk(c: Column | str) -> Column:
    return null_if_junk(c).isNull()


def _id_suffix(id_col: Column | str) -> Column:
    return F.concat(F.lit(" (id="), _col(id_col).cast("string"), F.lit(")"))


def display_label(id_col: Column | str, name: Column | str, same_name_count: Column | str) -> Column:
    """A label that is never NULL and never ambiguous: unnamed and homonym rows carry their id."""
    return (
        F.when(is_junk(name), F.concat(F.lit(UNNAMED), _id_suffix(id_col)))
        .when(_col(same_name_count) > 1, F.concat(_col(name), _id_suffix(id_col)))
        .otherwise(_col(name))
    )


def homonym_label(id_col: Column | str, name: Column | str, same_name_count: Column | str) -> Column:
    """The name as it is, with the id added only where several ids share it."""
    return F.when(_col(same_name_count) > 1, F.concat(_col(name), _id_suffix(id_col))).otherwise(_col(name))


def label_or_id(id_col: Column | str, name: Column | str) -> Column:
    """The cleaned name, or the unnamed label with the id."""
    return F.coalesce(null_if_junk(name), F.concat(F.lit(UNNAMED), _id_suffix(id_col)))


def is_suspicious_label(label: Column | str) -> Column:
    """Whether a ranking label is a junk name once its id suffix is removed."""
    return F.substring_index(_col(label), " (id=", 1).isin(*SUSPICIOUS_NAMES)


def is_shouting(c: Column | str) -> Column:
    """All-caps text of more than three characters."""
    return (_col(c) == F.upper(_col(c))) & (F.length(_col(c)) > 3)


def word_caps(c: Column | str) -> Column:
    """First letter of every word in upper case; any non-alphanumeric character ends a word."""
    words = F.split(F.lower(_col(c)), r"(?<=[^\p{L}\p{N}])")
    return F.array_join(F.transform(words, lambda w: F.initcap(w)), "")


def fix_all_caps(c: Column | str) -> Column:
    return F.when(is_shouting(c), word_caps(c)).otherwise(_col(c))

"""The corpus queries by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import chat, decontaminate, exact, language, lines, pack, pii, quality, repair, search, secret_scan, shard, simhash

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of (session, folder) under ``name``."""

    def register(build):
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return register


_WORDS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


@query("op1_winnowing", f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
        array_to_string(list_slice(w, s, s + least(len(w), 10) - 1), ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)),
hits AS (SELECT doc_id, n, s, item_id FROM dw JOIN bw USING (n, win)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, n, s FROM hits)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.size(decontaminate.hit_positions(F.col("hit_starts"))).cast("long")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


SHARDS = 24


@query("op2_kd_tree_shards")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = shard.document_shards(table(spark, sf_dir, "documents"), shards=SHARDS)
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"))


@query("op3_exact_dedup", """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                  regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS body FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY chars DESC, doc_id NULLS LAST) AS place FROM d),
g AS (SELECT body, count(*) AS group_size, max(doc_id) FILTER (place = 1) AS keep_id FROM n GROUP BY body)
SELECT n.doc_id, g.keep_id, g.group_size, n.place = 1 AS kept, sha256(n.body) AS text_sha256
FROM n JOIN g USING (body)""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


OPENING = "</s>[INST] ok [/INST]"


@query("op7_chat_windows")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(OPENING).alias("text"))
    read = chat.read_back(chat.chat_windows(turns.unionByName(extra)))
    return read.select(
        "conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


def _span_digest(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id", *[pii.count_of(F.col("spans"), k).alias(f"n_{k}") for k in kinds],
        F.sha2(pii.span_list(base), 256).alias("base_sha256"), pii.span_list(F.col("spans")).alias("spans"))


@query("op5_personal_data")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digest(pii.personal_data(table(spark, sf_dir, "documents")), pii.BASE_KINDS)


@query("op6_secrets")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digest(secret_scan.secrets(table(spark, sf_dir, "documents")), secret_scan.BASE_KINDS)


@query("op4_min_slack_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.packed(table(spark, sf_dir, "documents"))


@query("op9_simhash_pigeonring")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op10_line_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc.doc_id", F.col("n_lines").cast("long"), F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


@query("op8_crf_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= quality.PREDICT).cast("int").alias("predicted"))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns as op11 wants them damaged, by a hash of conversation and turn; nulls count as one space."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.pmod(F.crc32(F.encode(F.concat(known("conv_id"), F.lit(":"), known("turn")), "UTF-8")), F.lit(20))
    text = F.when(h == 1, "").when(h == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    role = F.when(h == 4, "user").otherwise(known("role"))
    copies = F.when(h == 0, 0).when(h == 3, 2).otherwise(1)
    row = F.struct("conv_id", "turn", role.alias("role"), text.alias("text"))
    return turns.select(F.explode(F.array_repeat(row, copies)).alias("r")).select("r.*")


@query("op11_role_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = repair.summary(repair.repair(damaged(turns))).withColumnRenamed("conv_id", "c")
    every = turns.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    counts = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@query("op12_language_codes")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    code = language.train(docs.filter(~language.held_out(F.col("doc_id"))))
    found = language.identify(docs, code)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op13_signature_search", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS ws FROM documents),
w AS (SELECT r, doc_id, len(ws)::BIGINT AS n, unnest(ws) AS term FROM d),
size AS (SELECT count(DISTINCT r)::BIGINT AS n_docs, count(*)::BIGINT AS n_terms FROM w),
asked AS (SELECT item_id, term, count(*)::BIGINT AS qtf FROM (SELECT item_id, unnest({_WORDS_SQL}) AS term FROM benchmark) GROUP BY 1, 2),
tfs AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM w WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
ws AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
       FROM (SELECT term, count(*)::BIGINT AS df FROM tfs GROUP BY 1), size),
s AS (SELECT item_id, r, doc_id, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
      FROM tfs JOIN ws USING (term) JOIN asked USING (term), size GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r) AS rank FROM s WHERE score > 0) WHERE rank <= 20""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

"""The pipeline's stages, each against a brute-force version on its own input, and the registered corpus queries."""

from collections import defaultdict

import numpy as np
import pytest
from oracle import compare, connect

import brute
import corpus_pipeline
from tillstar.llm import lines, quality
from tillstar.llm.common import stored
from tillstar.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(spark):
    docs = stored(spark.read.parquet(f"{FOLDER}/documents.parquet"), "in")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = texts(docs)
        docs = stored(stage(spark, docs, FOLDER), "out")
        if name != "packing":
            assert docs.columns == columns
            after = seen[name] = texts(docs)
            assert docs.count() == len(after)
        if name == "quality classifier":
            field = quality.train(*(spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels")))
            ids = list(before)
            scores = quality.score_texts(field, [before[i] or "" for i in ids])
            assert set(after) == {i for i, s in zip(ids, scores, strict=True) if s >= quality.PREDICT}
            assert 0.5 < len(after) / len(before) < 1
        elif name == "line dedup":
            removed = brute.removed_lines(list(before.items()), lines.MIN_CHARS, shorter=True)
            kept = {i: "\n".join(x for n, x in enumerate((t or "").split("\n")) if n not in removed[i]) for i, t in before.items()}
            assert after == {i: t for i, t in kept.items() if t.strip(" ") or not removed[i]}
        elif name == "simhash near-dedup":
            group = brute.near_groups(before.items())
            assert after == {i: t for i, t in before.items() if group[i] == i}
        elif name == "benchmark decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
            assert set(after) == {d for d, _, hits, _ in brute.contamination(list(before.items()), items) if not hits}
            assert len(after) < len(before)
        else:
            tokens = defaultdict(int)
            for r in docs.collect():
                tokens[r.doc_id] += r.length
            assert set(tokens) == set(before)
    assert corpus_pipeline.run(spark, FOLDER).count() == docs.count()


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, removed string, doc string, `a.b` int"


def test_stages_on_odd_rows(spark):
    """Null ids and texts, repeated rows, extra columns with the names the operators use, no rows at all."""
    clean = " ".join(f"Ordinary sentence number {i}." for i in range(30))
    rows = [(1, None, None, None, None, "r", "d", 1), (None, "", "en", "s", 0, "r", "d", 2), (2, clean, "en", "s", 5, "r", "d", 3), (2, clean, "en", "s", 5, "r", "d", 3),
            (3, "word " * 50_000, "en", "s", 6, "r", "d", 4)]
    for some in (rows, []):
        docs = spark.createDataFrame(some, SCHEMA)
        for name, stage in corpus_pipeline.STAGES:
            out = stored(stage(spark, docs, FOLDER), "odd")
            if name != "packing":
                assert out.columns == docs.columns, name
                assert out.count() <= len(some)
                # Equal rows are near duplicates of each other; the other stages tell nothing between them.
                if some and name != "quality classifier":
                    assert out.filter("doc_id = 2").count() == (1 if name == "simhash near-dedup" else 2), name


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in SQL:
        con = connect(FOLDER)
        assert compare(df, con, SQL[name]) == []
        con.close()
    elif name != "op4_min_slack_packing":
        # Op7 has a conversation of its own besides those of the table.
        table, key = ("conversations", "conv_id") if name.startswith(("op7", "op11")) else ("documents", "doc_id")
        rows = spark.read.parquet(f"{FOLDER}/{table}.parquet")
        assert df.count() == (rows.select(key).distinct().count() if key == "conv_id" else rows.count()) + name.startswith("op7")


def test_native_queries_have_no_python(spark):
    for number in (1, 2, 3, 7, 10):
        name = next(q for q in QUERIES if q.startswith(f"op{number}_"))
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExistingRDD")), name


def test_simhash_recall_is_whole(spark):
    rows = QUERIES["op9_simhash_pigeonring"](spark, FOLDER).collect()
    roots = brute.hamming_components([int(r.fingerprint, 16) for r in rows])
    groups = defaultdict(list)
    for r in rows:
        groups[roots[int(r.fingerprint, 16)]].append(r)
    assert all(r.component_id == min(x.doc_id for x in g) for g in groups.values() for r in g)
    assert np.mean([len(g) for g in groups.values()]) > 1

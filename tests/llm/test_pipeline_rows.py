"""Stages that drop rows tell them apart by id and content."""

import pytest

import corpus_pipeline
from tillstar.llm.common import stored

SCHEMA = "doc_id long, text string, lang string, `a.b` int"
PASSAGE = " ".join(f"passage{i}" for i in range(12))


def words(name):
    return " ".join(f"{name}{i}" for i in range(40))


def kept(df):
    return sorted(((r.doc_id, r.text, r.lang) for r in df.collect()), key=repr)


@pytest.fixture
def folder(spark, tmp_path):
    items = [(None, PASSAGE), (1, words("item"))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_contaminated_rows_name_no_other_row(spark, folder):
    clean = [(None, words("a"), "en"), (None, None, "en"), (7, words("b"), "en"), (8, words("c"), "en"), (8, words("c"), "en")]
    dirty = [(None, f"so {words('item')}", "en"), (7, words("item"), "en"), (9, f"x {PASSAGE} y", "en")]
    docs = spark.createDataFrame([(*r, 1) for r in clean + dirty], SCHEMA)
    assert kept(corpus_pipeline.drop_contaminated(spark, docs, folder)) == sorted(clean, key=repr)


def test_one_row_of_each_group_stays(spark, folder):
    a, b, c, d = map(words, "abcd")
    rows = [(None, a, "en"), (None, a, "de"), (None, b, "en"), (2, c, "en"), (2, c, "en"), (2, d, "en"), (None, d, "en"), (5, d, "en")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    out = stored(corpus_pipeline.drop_near_duplicates(spark, docs, folder), "kept")
    assert out.columns == docs.columns
    got = kept(out)
    assert [(i, t) for i, t, _ in got] == sorted([(None, a), (None, b), (2, c), (2, d)], key=repr)
    assert kept(corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), folder)) == []

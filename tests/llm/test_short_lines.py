"""Exact repeats of lines of every length."""

from tillstar.llm import lines
from tillstar.llm.queries import QUERIES


def test_short_lines_repeat_exactly(spark, tmp_path):
    rows = [(1, "All rights reserved.\nfirst text\n\nx"), (2, " All rights reserved.\nsecond text\n\ny"), (3, "all rights reserved.\nx\nx"), (4, "x"), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {1: [], 2: [0], 3: [1, 2], 4: [0], 5: []}
    assert {r.doc.doc_id: r.removed for r in lines.dedup_lines(docs).collect()} == want
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op10_line_dedup"](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.removed for r in got} == {i: ",".join(map(str, n)) for i, n in want.items()}
    # A length that the caller names leaves shorter lines alone.
    assert not any(r.removed for r in lines.dedup_lines(docs, min_chars=21).collect())

"""Types told by point and length first are those the patterns alone give."""

import re

from tillstar.operators import profile

CELLS = ["1", "-12", "1.5", "-0.25", ".5", "5.", "1.2.3", "2020-01-31", "2020-01-31\n", "2020-01-31\r\n", "12\n", "2020-1-31", "x2020-01-31",
         "2020-01-31 10:00:00", "2020-01-31T10:00:00.25", "2020-01-31 10:00:00\n", "2020-01-31 10:00", "true", "00.10", "a.b", "é" * 10, " "]


def test_flags_are_those_of_the_patterns(spark):
    df = spark.createDataFrame([tuple(CELLS), (None,) * len(CELLS)], ", ".join(f"c{i} string" for i in range(len(CELLS))))
    got = {r.coluna: r for r in profile.profile_columns(df, "t").collect()}
    # Java's $ also matches before a final line end.
    hit = lambda pattern, v: re.search(pattern.replace("$", r"(\r\n|[\n\r\x85])?\Z"), v) is not None
    for i, v in enumerate(CELLS):
        whole, point = hit(profile.INTEGER, v), hit(profile.DECIMAL, v)
        row = got[f"c{i}"]
        assert (row.so_inteiro, row.so_decimal, row.so_data, row.so_timestamp) == (
            whole, whole or point, hit(profile.DATE, v), hit(profile.TIMESTAMP, v)), v


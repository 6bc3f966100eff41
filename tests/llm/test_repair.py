"""Repaired conversations against a search over all edits, in one chunk and in many."""

import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from brute import sha

from tillstar.llm import repair
from tillstar.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
WHITE = " \t\n\x0b\x0c\r"
GOAL = re.compile("(s?(ua)+)?")
BEGIN = re.compile("(s?(ua)*u?)?")


def faults(rows):
    """First fault of every row: blank, duplicate, truncated or none."""
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(WHITE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired lines) by trying every edit; partial results are kept per role string's last two initials."""
    bad = faults(rows)
    # Results so far by the state of the role string (empty, s, and the last initial): all that the rest depends on.
    best = {"": (0, "", "", ())}

    def state(roles):
        return roles if roles in ("", "s") else roles[-1]

    def put(into, cost, audit, roles, lines):
        if BEGIN.fullmatch(roles):
            into.setdefault(state(roles), []).append((cost, audit, roles, lines))

    def inserted(some):
        out = list(some)
        for cost, audit, roles, lines in some:
            for n in (1, 2, 3):
                for names in itertools.product(("user", "assistant"), repeat=n):
                    more = roles + "".join(x[0] for x in names)
                    if BEGIN.fullmatch(more):
                        out.append((cost + 2 * n, audit + "I" * n, more, lines + tuple(x + ":" for x in names)))
        return out

    for (role, text), fault in zip(rows, bad):
        found = {}
        for cost, audit, roles, lines in inserted(best.values()):
            put(found, cost + 3, audit + "D", roles, lines)
            if fault not in ("blank", "duplicate"):
                stays = cost + (fault == "truncated")
                put(found, stays, audit + "K", roles + (role[:1] or "?"), (*lines, f"{role}:{text}"))
                for name in ("user", "assistant"):
                    put(found, stays + 2, audit + "R", roles + name[0], (*lines, f"{name}:{text}"))
        best = {k: min(v, key=lambda w: w[:2]) for k, v in found.items()}
    cost, audit, _, lines = min((w for w in inserted(best.values()) if GOAL.fullmatch(w[2])), key=lambda w: w[:2])
    return cost, audit, lines


def expected(rows):
    """The whole answer for one conversation of (turn, role, text) after damage."""
    rows = sorted(((t, r or " ", x or " ") if x != "" else (t, r or " ", "") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    plain = [r[1:] for r in rows]
    turns = {r[0] for r in rows if r[0] is not None}
    initials = [r[:1] for r, _ in plain]
    cost, audit, lines = cheapest(plain)
    bad = faults(plain)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(bad.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, audit, sha("\n".join(lines)))


def conversations(rng, n, longest):
    out = []
    for c in range(n):
        size = rng.randrange(1, longest)
        for t in range(size):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "Sys", None, ""])
            text = rng.choice(["Fine.", "Why?", "cut off", "", None, " \n", f"turn {t}.", f"open {t}", "ä 🙂!"])
            out.append((c if c % 17 else None, rng.choice([t, t, t, None, t + 3]), role, text))
    return out


def grouped(rows):
    groups = defaultdict(list)
    for c, t, r, x in rows:
        groups[c].append((t, r, x))
    return groups


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, piece int")
    got = repair.summary(repair.repair(df)).collect()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert {r.conv_id: tuple(r[n] for n in names) for r in got} == {c: expected(g) for c, g in grouped(rows).items()}


def test_against_all_edits(spark):
    check(spark, conversations(random.Random(5), 150, 9))


@pytest.mark.parametrize("turns", [1, 3])
def test_chunks_give_the_same(spark, monkeypatch, turns):
    """Tables of short chunks, put together, equal the whole parse; one conversation has most of the rows."""
    rng = random.Random(turns)
    for _ in range(40):
        rows = [(rng.choice(["user", "assistant", "system", "x"]), rng.choice(["a.", "b", "", "c?", f"{rng.random()}."])) for _ in range(rng.randrange(1, 14))]
        chunks = []
        for at in range(0, len(rows), turns):
            chunk = repair._Chunk(1, at == 0)
            for n, ((role, text), fault) in enumerate(list(zip(rows, faults(rows)))[at:at + turns]):
                chunk.add(at + n, role, text, 1, fault == "duplicate")
            chunks.append(chunk.row() | {"chunk": at})
        one = repair.fold(chunks)
        audit = "".join(next(m["audit"] for m in c["moves"] if (m["a"], m["z"]) == (p["a"], p["z"])) + "I" * p["more"]
                        for c, p in zip(chunks, sorted(one["path"], key=lambda p: p["chunk"])))
        assert (one["cost"], audit) == cheapest(rows)[:2]
    many = [(1, t, "user" if t % 3 else "assistant", f"turn {t}{'.' if t % 7 else ''}") for t in range(1500)] + [(c, 0, "user", "hi.") for c in range(2, 40)]
    check(spark, many)


def test_a_row_that_repeats_very_often_is_one_entry(spark):
    rows = [(1, 0, "user", "same.")] * 5000 + [(1, 1, "assistant", "answer."), (2, None, "user", "x."), (2, None, "user", "x.")]
    got = {r.conv_id: r for r in repair.summary(repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    assert (got[1].duplicate, got[1].illegal, got[1].cost, got[1].audit) == (4999, 4999, 3 * 4999, "K" + "D" * 4999 + "K")
    assert (got[2].gaps, got[2].audit) == (0, "KDI")


def test_empty_table_and_texts_of_repaired_turns(spark):
    schema = "conv_id string, turn int, role string, text string"
    assert repair.summary(repair.repair(spark.createDataFrame([], schema))).count() == 0
    long = "word " * 300_000 + "end."
    rows = [("a", 0, "user", long), ("a", 1, "user", "So?"), ("a", 2, "assistant", "Yes.")]
    pieces = repair.repair(spark.createDataFrame(rows, schema)).collect()
    assert [(t.role, t.text) for p in sorted(pieces, key=lambda p: p.piece) for t in p.turns] == [
        ("user", long), ("assistant", ""), ("user", "So?"), ("assistant", "Yes.")]


def test_query(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(9000 + c, t, role, text) for c in range(60) for t, role, text in
             ((0, "system", "Be brief."), (1, "user", "One. Two!"), (None, None, None), (4, "assistant", "end"))] + [(None, 0, "user", "x.")] + [(9100 + c, 0, "user", "only.") for c in range(60)]
    spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, cost int").write.parquet(f"{tmp_path}/conversations.parquet")
    after = defaultdict(list)
    for c, t, role, text in rows:
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", " " if text is None else text) if h == 2 else text
        after[c] += [(t, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    got = QUERIES["op11_role_repair"](spark, str(tmp_path)).collect()
    assert len(got) == len({r[0] for r in rows})
    for r in got:
        assert tuple(r)[1:] == (expected(after[r.conv_id]) if after[r.conv_id] else (0, 0, 0, 0, 0, 0, "", sha(""))), r
    assert any(not after[c] for c in after) and {"D", "I", "K", "R"} <= set("".join(r.audit for r in got))

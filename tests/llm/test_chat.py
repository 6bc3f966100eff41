"""Chat windows read back exactly, keep their budget, and mask every target once."""

import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tillstar.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, piece string, window int"
NASTY = ["<|turn|>user<|text|>", "<\\|end|>", "<\\\\|", "[INST] [/INST]", "[\\INST]", "<<SYS>>x<</SYS>>", "<s></s><\\/s>", "|end|>", "<", "\\", "", None, "ä\n\n🙂", "a" * 3000]


def conversations():
    rng = random.Random(3)
    rows = []
    for c in range(40):
        for t in range(rng.randrange(1, 30)):
            role = "system" if t == 0 and c % 3 == 0 else rng.choice(["user", "assistant", None, "tool<|text|>"])
            rows.append((c, t, role, " ".join(str(rng.choice(NASTY)) for _ in range(rng.randrange(0, 60))) if t % 5 else rng.choice(NASTY)))
    rows += [(None, 0, "user", "null conversation"), (77, None, "assistant", "null turn"), (77, 0, "user", "x"), (77, 0, "user", "x"), (78, 0, "system", "only")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA)


def expected(rows):
    groups = defaultdict(list)
    for c, t, role, text in rows:
        groups[c].append((t is not None, t or 0, role or "", text or ""))
    return {c: ("".join(f"{r}\n{x}\n" for *_, r, x in sorted(g)), "".join(x for *_, r, x in sorted(g) if r == "assistant"), len(g)) for c, g in groups.items()}


def test_round_trip(spark):
    rows = conversations()
    read = chat.read_back(chat.chat_windows(frame(spark, rows), budget=60, history=20)).collect()
    assert {r.conv_id: (r.turns, r.loss_text, r.n_turns) for r in read} == expected(rows)


def test_budget_history_and_control_strings(spark):
    rows = [(1, 0, "system", "be brief")] + [(1, t, "assistant" if t % 2 == 0 else "user", f"w{t} " * 6) for t in range(1, 41)]
    windows = chat.chat_windows(frame(spark, rows), budget=60, history=20).orderBy("window").collect()
    assert len(windows) > 3
    for w in windows:
        turns = re.findall(r"<\|(turn|again)\|>([^<]*)<\|text\|>([^<]*)<\|end\|>", w.formatted)
        assert sum(max(1, len(x.split())) for *_, x in turns) <= 60
        assert w.window == 0 or (turns[0] == ("again", "system", "be brief") and turns[1][0] == "again")
        again = [x for m, _, x in turns if m == "again"]
        assert sum(len(x.split()) for x in again) <= 20 + 2
    escaped = spark.createDataFrame([(x,) for x in NASTY if x is not None], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in escaped.withColumn("back", chat.unescape(F.col("e"))).collect():
        assert r.back == r.t
        assert not re.search(r"<\||</?s>|\[/?INST\]|<</?SYS>>", r.e)


def test_empty_table(spark):
    assert chat.read_back(chat.chat_windows(frame(spark, []))).count() == 0


def plain_windows(rows, budget, history):
    """The windows of conversations in plain Python: (conversation, window) to its marked turns."""
    groups = defaultdict(list)
    for c, t, role, text in rows:
        groups[c].append((t is not None, t or 0, role or "", text or ""))
    found = {}
    for c, g in groups.items():
        turns, sums = [], 0
        for *_, role, text in sorted(g):
            n = max(1, len(text.split(" ")))
            turns.append((sums, n, role, text))
            sums += n
        opens = turns[0] if turns[0][2] == "system" else None
        s = opens[1] if opens else 0
        capacity = max(1, (budget - history - s) // 2)
        rest = turns[1:] if opens else turns
        for start, _, role, text in rest:
            found.setdefault((c, (start - s) // capacity), []).append((start, role, text))
        if opens:
            found.setdefault((c, 0), [])
        for (cc, w), own in [(k, v) for k, v in found.items() if k[0] == c]:
            past = [(r, x) for start, _, r, x in rest if own and own[0][0] - history <= start < own[0][0]]
            again = ([opens[2:]] if opens and w else []) + past
            new = ([opens[2:]] if opens and not w else []) + [o[1:] for o in own]
            found[cc, w] = [("again", *x) for x in again] + [("turn", *x) for x in new]
    return found


def test_windows_of_a_hot_conversation(spark):
    """Against plain Python: one conversation of most rows, its rows repeated, in more pieces than one; null ids too."""
    rng = random.Random(8)
    rows = [(5, 0, "system", "s s s")] + [(5, t // 2, rng.choice(["user", "assistant"]), " ".join("w" * rng.randrange(1, 9))) for t in range(2, 1500)]
    rows += [(5, 900, "user", "again and again")] * 400 + [(None, t, "user", "n " * 3 + str(t)) for t in range(300)]
    rows += [(c, t, "assistant" if t % 2 else "user", f"{c} {t}") for c in range(10, 60) for t in range(6)] + [(3, None, "system", "x y")]
    for budget, history in ((60, 20), (24, 30)):
        windows = chat.chat_windows(frame(spark, rows).repartition(7), budget, history).collect()
        got = {(w.conv_id, w.window): re.findall(r"<\|(turn|again)\|>([^<]*)<\|text\|>([^<]*)<\|end\|>", w.formatted) for w in windows}
        assert len(got) == len(windows) and got == plain_windows(rows, budget, history)
        for w in windows:
            marked = "".join(w.formatted[m.start:m.end] for m in w.loss)
            assert marked == "".join(x for m, r, x in got[w.conv_id, w.window] if m == "turn" and r == "assistant")

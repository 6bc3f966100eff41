"""Personal data and secrets against the patterns as they are stated."""

import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillstar.llm import pii, secret_scan

SCHEMA = "doc_id long, text string, spans string, kind int"


def plain_pii(text):
    found = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    found += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= len(digits(m)) <= 19 and plain_luhn(digits(m))]
    found += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m)) <= 15]
    return Counter(found)


def plain_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_secrets(text):
    assign = r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    found = [("assign", m.start(), m.end()) for m in re.finditer(assign, text) if len(m.group(2)) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    return Counter(found + [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24])


def test_base_kinds_on_random_strings():
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice(["@", ".", "a", "b-", "1", "25", "4", " ", "+1", "(", "-", "é", "@@", "a.b@c.d"]) for _ in range(rng.randrange(30)))
        assert Counter(pii.base_spans(text)) == plain_pii(text), text
        text = "".join(rng.choice(["password", "TOKEN", "api_key", "ApiKey", "=", ":", " ", '"', "abc12", "AKIA", "ABCDEFGHIJKLMNOP", "0af9" * 5, "é", "ſecret"]) for _ in range(rng.randrange(12)))
        assert Counter(secret_scan.base_spans(text)) == plain_secrets(text), text


def test_checks_and_context():
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765433")
    kinds = lambda t: [s[0] for s in pii.scored(t)]
    assert "iban" in kinds("pay to GB82 WEST 1234 5698 7654 32 please")
    assert kinds("his social security number is 219-09-9999") == ["ssn"]
    assert kinds("part 219-09-9999 in stock") == [] and kinds("ssn 000-12-3456") == []
    card = next(s for s in pii.scored("credit card 4111 1111 1111 1111"))
    assert card[0] == "card" and card[3] > next(s for s in pii.scored("number 4111 1111 1111 1111"))[3]


LONG = {
    "letters": lambda n: "a" * n, "digits": lambda n: "1" * n, "at": lambda n: "a@" * (n // 2), "dots": lambda n: "1." * (n // 2), "plus": lambda n: "+1 " * (n // 3),
    "signs": lambda n: "@" * n, "names": lambda n: "token " * (n // 6), "keys": lambda n: "AKIA" * (n // 4),
    "two runs": lambda n: "a" * (n // 2) + " " + "b" * (n // 2) + "@x.y", "hex pairs": lambda n: ("0a1b2c3d" * 3 + "/" + "q8Zx0LmP2vTr7NcK5wJd9HbYxQe ") * (n // 53)}


@pytest.mark.parametrize("name", LONG)
def test_long_runs_take_linear_time(name):
    """Four times the text takes about four times as long."""
    ratios = dict.fromkeys((a + b for a in "^" + secret_scan.ALPHABET for b in secret_scan.ALPHABET), 3.0)

    def seconds(n):
        text, best = LONG[name](n), []
        for _ in range(3):
            start = time.process_time()
            pii.scored(text)
            secret_scan.scanned(text, ratios)
            best.append(time.process_time() - start)
        return min(best)

    assert seconds(200_000) < 9 * seconds(50_000) + 0.05


def test_numbers_of_very_many_digits():
    assert [s[:3] for s in pii.base_spans("0" * 5000 + ".1.1.1")] == [("ip", 0, 5006)]
    assert [s for s in pii.base_spans("1" + "0" * 5000 + ".1.1.1") if s[0] == "ip"] == [] and pii.scored("9" * 6000) == []


def test_a_secret_beside_a_base_span_of_its_run():
    ratios = dict.fromkeys((a + b for a in "^" + secret_scan.ALPHABET for b in secret_scan.ALPHABET), 5.0)
    text = "x " + "0a1b2c3d" * 3 + "/" + "q8Zx0LmP2vTr7NcK5wJd9HbYxQe" + " y"
    assert [s[:3] for s in secret_scan.scanned(text, ratios)] == [("hex", 2, 26), ("random", 26, 54)]


def test_frames(spark):
    texts = [(1, None), (2, ""), (3, "mail a@b.cc now"), (3, "mail a@b.cc now"), (None, "1.2.3.4 😀 1.2.3.4"), (4, "ordinary words here and there " * 50),
             (5, "key q8Zx0LmP2vTr7NcK5wJd9HbY is odd"), (6, "token = 'abcdef123'")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], SCHEMA)
    got = Counter((r.doc_id, r.s) for r in pii.personal_data(df).select("doc_id", pii.span_list(F.col("spans")).alias("s")).collect())
    want = Counter((i, ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(plain_pii(t or ""), key=lambda x: x[1]))) for i, t in texts)
    assert got == want
    many = df.unionByName(spark.range(100, 700).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("ordinary words and identifiers like user_name or "), F.col("id").cast("string")).alias("text"),
        F.lit("x").alias("spans"), F.lit(1).alias("kind")))
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans or []] for r in secret_scan.secrets(many).collect()}
    assert found[5] == [("random", 4, 28)] and found[4] == [] and found[6] == [("assign", 0, 18)]
    assert pii.personal_data(df.limit(0)).count() == 0 and secret_scan.secrets(df.limit(0)).count() == 0

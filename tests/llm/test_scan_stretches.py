"""Account numbers followed by other tokens; secrets that ordinary words are glued to."""

import math
import random
import string

import pytest

from tillstar.llm import pii, secret_scan


@pytest.mark.parametrize("text, numbers", [
    ("BE68 5390 0754 7034 BIC", ["BE68 5390 0754 7034"]),
    ("ES91 2100 0418 4502 0005 1332 EUR", ["ES91 2100 0418 4502 0005 1332"]),
    ("AT61 1904 3002 3457 3201 2026 x", ["AT61 1904 3002 3457 3201"]),
    ("BE68 5390 0754 7034 DE89 3704 0044 0532 0130 00", ["BE68 5390 0754 7034", "DE89 3704 0044 0532 0130 00"]),
    ("AB12 CDEF BE68 5390 0754 7034", ["BE68 5390 0754 7034"]),
    ("NO93 8601 1117 947 BIC", ["NO93 8601 1117 947"]),
    ("BE68 5390 0754 7035 BIC", []),
])
def test_account_numbers_have_the_length_of_their_country(text, numbers):
    assert [text[s:e] for kind, s, e in pii.more_spans(text) if kind == "iban"] == numbers


# Ratios like those of a trained model: random strings mix classes, ordinary ones stay in small letters.
def ratio(a, b):
    return -1.5 if b.islower() and (a.islower() or a in "^/_-=") else (-0.5 if b in "/_-=" else 4.0)


RATIOS = {a + b: ratio(a, b) for a in "^" + secret_scan.ALPHABET for b in secret_scan.ALPHABET}
SECRET = "Q7XK2MZ9PW4RT8VB3NH6YD5L"


def found(text):
    return [text[s:e] for kind, s, e, _, _ in secret_scan.scanned(text, RATIOS) if kind == "random"]


def test_secrets_glued_to_words():
    path = f"/services/monitoring/production/webhook/{SECRET}"
    assert secret_scan.log_ratio(RATIOS, path) < secret_scan.MIN_RATIO * len(path)
    assert found(f"see {path} now") == [SECRET]
    assert found(f"{path}/settings_of_the_service") == [SECRET]
    assert found(f"a_long_name_of_a_setting_in_a_file={SECRET}") == [SECRET]
    assert found(f"{path}/and/some/more/of/the/path/{SECRET[::-1]}/end") == [SECRET, SECRET[::-1]]
    assert found(f"so {SECRET} so") == [SECRET]
    assert found("/services/monitoring/production/webhook/settings") == found("x/Ab1/y/Cd2/short/path/of/Ef3") == []


def test_maximal_stretches_against_recursion():
    def slow(x, low, high):
        sums = [(math.fsum(x[i:j]), i, j) for i in range(low, high) for j in range(i + 1, high + 1)]
        top, i, j = max(sums, default=(0, 0, 0))
        return [*slow(x, low, i), (i, j), *slow(x, j, high)] if top > 0 else []

    rng = random.Random(5)
    for _ in range(300):
        x = [rng.gauss(-0.1, 1) for _ in range(rng.randrange(12))]
        assert secret_scan._maximal(x) == slow(x, 0, len(x))
    long = "".join(rng.choice(string.ascii_lowercase + "/") for _ in range(200_000))
    assert found(long) == []

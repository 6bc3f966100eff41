"""What the tokenizer of the packing keeps."""

import struct

import pytest

from tillstar.llm import pack


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return pack.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))


def test_a_word_is_kept_once(tokenizer):
    text = "plain words, naïve (words) don't 12 plain"
    whole = tokenizer.whole.encode(text, add_special_tokens=False).ids
    for _ in range(2):
        assert tokenizer.ids(text) == struct.pack(f"<{len(whole)}I", *whole)
    assert set(tokenizer.chunks) == {"plain", "words,", "naïve", "(words)", "don't", "12"}
    assert set(tokenizer.words) == {"words", ",", "(", ")", "don", "'t", "1", "2"}


def test_caches_take_no_more_than_before(tokenizer):
    fresh = [c.room + sum(190 + 2 * len(k) + len(v) for k, v in c.items()) for c in (tokenizer.words, tokenizer.chunks)]
    assert sum(fresh) == 2 * pack.CACHE_BYTES


def test_a_kept_chunk_serves_as_word(tokenizer):
    fresh = pack.WordTokenizer.__new__(pack.WordTokenizer)
    fresh.__dict__.update(tokenizer.__dict__)
    fresh.words, fresh.chunks = pack.Kept(fresh._word, 1 << 20), pack.Kept(fresh._chunk, 1 << 20)
    text = "plainly plainly, plainly."
    whole = tokenizer.whole.encode(text, add_special_tokens=False).ids
    assert fresh.ids(text) == struct.pack(f"<{len(whole)}I", *whole)
    assert set(fresh.words) == {",", "."}


def test_every_character_alone_and_beside_letters(tokenizer):
    for c in sorted(pack._PLAIN_SET):
        for text in (c, f"ab{c}", f"{c}ab", f"é{c}{c}", f"don{c}t", f"it'{c}", f"x'l{c}"):
            whole = tokenizer.whole.encode(text, add_special_tokens=False).ids
            assert tokenizer.ids(text) == struct.pack(f"<{len(whole)}I", *whole), repr(text)
    for text in ("a <| b", "a\x00b", "a\x1cb", "a\x85b", "a\xa0b", "İx", "ẞ", "a　b", "日本"):
        whole = tokenizer.whole.encode(text, add_special_tokens=False).ids
        assert tokenizer.ids(text) == struct.pack(f"<{len(whole)}I", *whole), repr(text)

import random
import unicodedata

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparkrec.llm import tokens
from sparkrec.llm.transducer import TokenCounter

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def counters():
    library = Tokenizer.from_file(PATH)
    return (lambda t: len(library.encode(t, add_special_tokens=False).ids)), TokenCounter(PATH), TokenCounter(PATH, chunk=3)


def test_equals_the_library_on_mixed_strings(counters):
    want, whole, chunked = counters
    rng = random.Random(3)
    parts = ["'", "s", "t", "re", " ", "\n", "1", "é", "ß", "Σ", "İ", "\x1c", " ", "!", "<|endoftext|>", "<|startoftext|>", "<|",
             "the", "ing", "漢", "é", "​", "　", "😀", "A", "ꟋX"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert whole.count(text) == chunked.count(text) == want(text), repr(text)


def test_equals_the_library_on_letters(counters):
    want, whole, _ = counters
    rng = random.Random(4)
    for _ in range(500):
        word = "".join(chr(rng.choice([rng.randint(97, 122), rng.randint(0xE0, 0xFF)])) for _ in range(rng.randint(1, 60)))
        assert whole.count(word) == want(word)
    for code in range(0, 0x3000):
        text = f"a{chr(code)}b{chr(code)}'{chr(code)}1"
        assert whole.count(text) == want(text), hex(code)


def test_forgetting_states_changes_nothing(counters):
    want, _, _ = counters
    small = TokenCounter(PATH)
    small.fragments.machine.limit, small.fragments.limit = 50, 10
    text = "compilation of deterministic transducers, annotating transitions " * 3
    assert small.count(text) == want(text) and unicodedata.is_normalized("NFC", text)


def test_rows(odd_docs, small_docs, no_docs, counters):
    want = counters[0]
    for docs in (odd_docs, small_docs):
        got = tokens.count_tokens(docs).collect()
        rows = docs.select("doc_id", "text").collect()
        key = repr
        assert sorted(map(key, map(tuple, got))) == sorted(
            key((r.doc_id, len((r.text or "").encode()), want(r.text or ""), want(r.text or "") > 2048)) for r in rows)
    assert tokens.count_tokens(no_docs).count() == 0

"""Token counts against the public library."""

import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from quotewright.llm.tokens import TextCounter, Vocabulary, token_counts  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None,
    "",
    " \n\t ",
    "a<|endoftext|>b<|startoftext|><|endoftext|>",
    "<|ENDOFTEXT|> <|endoftext|",
    "ΑΣ ΟΔΟΣ İstanbul ﬁ é 日本語 😀😀 \x1c\x85x it's WE'LL 's 123 ½",
    "\x1c\x1d a \x1e",
    "ab" * 30_000,
    "one two " * 1500,
    "one two " * 1500,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_every_row_counts_as_the_library(frame, library):
    docs = frame([(i if i else None, t, "en", "s") for i, t in enumerate(TEXTS)])
    rows = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, PATH).collect()}
    expected = set()
    for i, t in enumerate(TEXTS):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected.add((i or None, len((t or "").encode()), n, n > 2048))
    assert rows == expected and len(rows) == len(TEXTS)


def test_random_words(library):
    rng = random.Random(4)
    counter = TextCounter(Vocabulary(PATH))
    letters = "abcdefghij éüñß'’.,!-_$&1٣"
    texts = ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(3000)]
    assert [counter.count(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_empty_table(frame):
    assert token_counts(frame([(1, "a", None, None)]).limit(0), PATH).collect() == []

import random
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece

from quotewright.llm.pieces import Codec, Vocabulary, decode, encode, piece_digests

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def codec():
    return Codec(Vocabulary(PATH))


def texts(codec, n=4000, seed=3):
    r = random.Random(seed)
    pieces = list(codec.v.ids)
    for _ in range(n):
        kind = r.randrange(4)
        if kind == 0:
            yield "".join(r.choice(pieces).replace("▁", " ") for _ in range(r.randrange(12)))
        elif kind == 1:
            yield "".join(r.choice("aab  e\n tihe\t") for _ in range(r.randrange(40)))
        elif kind == 2:
            pool = (r.randrange(32, 127), r.randrange(160, 0x2000), r.randrange(0x4E00, 0x9000), 0x1F600, 0x2581, 32, 0)
            yield "".join(chr(r.choice(pool)) for _ in range(r.randrange(30)))
        else:
            yield "".join(r.choice(["<s>", "</s>", "<unk>", "<0x41>", "aaaa", "____", "======", "\r\n", "  "]) for _ in range(r.randrange(20)))


def test_ids_and_texts_are_the_librarys(library, codec):
    for text in texts(codec):
        ids = library.encode(text)
        assert codec.encode(text) == ids, text
        assert codec.decode(ids) == library.decode(ids)


def test_decodes_any_ids_as_the_library(library, codec):
    r = random.Random(5)
    for _ in range(4000):
        ids = [r.randrange(32000) if r.random() < 0.6 else r.randrange(260) for _ in range(r.randrange(9))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_every_prefix_has_its_last_token(library, codec):
    for word in ("▁international", "▁aaaaaaaaaaa", "▁▁▁▁▁x", "▁===-==__"):
        table = codec.last_tokens(word)
        for n in range(2, len(word) + 1):
            ids = library.encode(word[1:n].replace("▁", " "))
            assert codec.v.pieces[ids[-1]] == table[n]


def test_compatible_pairs_by_encoding(library, codec):
    r = random.Random(7)
    pieces = [p for p in codec.v.ids if "▁" not in p]
    for _ in range(3000):
        a, b = "▁" + r.choice(pieces), r.choice(pieces)
        if a not in codec.v.ids:
            continue
        both = [library.id_to_piece(i) for i in library.encode((a + b)[1:])]
        assert codec.compatible(a, b) == (both == [a, b]), (a, b)


def test_long_texts_without_blanks(library, codec):
    for text in ("ab" * 40_000, "a" * 50_000, " " * 30_000, "é" * 20_000 + "日本" * 9_000):
        assert codec.encode(text) == library.encode(text)


def test_whole_column(spark, frame, library):
    rows = [(1, "The cat\n\tsat", "en", "a"), (2, None, None, None), (3, "", "en", "a"), (None, "  \x1c", "en", "a"), (1, "The cat\n\tsat", "en", "a")]
    rows.append((4, "word " * 60_000 + "x" * 100_000, "en", "a"))
    found = sorted(map(tuple, piece_digests(frame(rows), PATH).collect()), key=str)
    want = []
    for i, text, *_ in rows:
        ids = library.encode(text or "")
        want.append((i, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(library.decode(ids).encode()).hexdigest()))
    assert found == sorted(want, key=str)
    assert piece_digests(frame([]), PATH).count() == 0


def test_round_trip_of_given_documents(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ids = encode(docs, PATH)
    back = {r.doc_id: r.text for r in decode(ids, PATH).collect()}
    for r in docs.collect():
        assert back[r.doc_id] == library.decode(library.encode(r.text or ""))
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert sorted(map(tuple, decode(nothing, PATH).collect())) == [(1, None), (2, "")]


def test_other_models_are_refused(tmp_path):
    with open(PATH, "rb") as f:
        data = f.read()
    unigram = bytes([0x12, 2, 0x18, 1])  # trainer settings of another kind; the first count
    (tmp_path / "other.model").write_bytes(unigram + data)
    with pytest.raises(ValueError):
        Vocabulary(str(tmp_path / "other.model"))

"""SentencePiece encoding and decoding by a table of every prefix's last token.

The vocabulary is of the merge type: starting from characters, the adjacent pair whose
joint piece has the best score merges first, leftmost among equals. Whether merging two
tokens' characters would cross the border between them depends on those two alone, as
merges on either side come in the same order whatever stands around them. So a sequence
of tokens is the encoding of its text if and only if every adjacent pair is compatible,
and each prefix of a text has exactly one last token: of the tokens that an automaton finds
ending there, the one compatible with the last token of the prefix before it. The ids are
read off that table backwards. One step a character and match; a text of n characters
without any border takes O(n).

The vocabulary file is read on the driver by path and broadcast (some MB, whatever the
data). Characters in no piece, which nothing can cross, are encoded as their bytes.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator
from hashlib import sha256
from math import inf

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewright.llm.arrow import map_batches, narrow, parts, with_columns

BLANK = "▁"
# fixed values of the file format: kinds of pieces, the kind of model
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_MERGES = 2
_LONGEST, _MOST = 64, 300_000


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = number()
        size = {0: 0, 1: 8, 5: 4}.get(key & 7)
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = number() if size is None else size
        yield key >> 3, message[at : at + size]
        at += size


class Vocabulary:
    """Pieces, scores and kinds of a SentencePiece file whose model merges pairs and whose
    normaliser changes nothing but blanks. Others are refused."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            top = list(_fields(f.read()))
        trainer = dict(_fields(next(v for k, v in top if k == 2)))
        normalizer = dict(_fields(next((v for k, v in top if k == 3), b"")))
        kept = normalizer.get(4, 1) == 0 and normalizer.get(5, 1) == 1 and not normalizer.get(2)
        if trainer.get(3) != _MERGES or not kept or trainer.get(24, 0):
            raise ValueError("a merge-type model with an identity normaliser that keeps blanks is needed")
        self.prefix = BLANK if normalizer.get(3, 1) else ""
        self.unknown_text = trainer.get(44, b" \xe2\x81\x87 ").decode()
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        self.rank: dict[str, float] = {}  # of the normal pieces: the lowest merges first
        self.ids: dict[str, int] = {}
        self.byte_ids: dict[int, int] = {}
        for i, piece in enumerate(v for k, v in top if k == 1):
            entry = dict(_fields(piece))
            text, kind = entry[1].decode(), entry.get(3, _NORMAL)
            self.pieces.append(text)
            self.kinds.append(kind)
            if kind == _NORMAL:
                self.rank[text] = -struct.unpack("<f", entry.get(2, bytes(4)))[0]
                self.ids[text] = i
            elif kind == _BYTE:
                self.byte_ids[int(text[3:5], 16)] = i
            elif kind not in (_UNKNOWN, _CONTROL):
                raise ValueError(f"kind {kind} of piece {i} is not known here")
        self.unknown = self.kinds.index(_UNKNOWN)


class Codec:
    """Ids of texts, and texts of ids."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        known = set("".join(vocabulary.ids)) | {BLANK}
        self._automaton = ahocorasick.Automaton()
        for token in known | set(vocabulary.ids):
            self._automaton.add_word(token, token)
        self._automaton.make_automaton()
        one = "".join(map(re.escape, sorted(known - {BLANK})))
        crossing = re.compile(f"[^{BLANK}]{BLANK}")
        # what no piece holds parts a text: a blank after another character, a strange character
        inside = f"[{one}{BLANK}]+" if any(map(crossing.search, vocabulary.ids)) else f"{BLANK}*[{one}]+|{BLANK}+"
        self.words = re.compile(f"{inside}|[^{one}{BLANK}]", re.DOTALL).findall
        # of each token its ids joined by commas, and the text they decode to
        self._joined = {t: ",".join(map(str, self._token_ids(t))).encode() for t in known | set(vocabulary.ids)}
        self._shown = {t: self._surfaces(self._token_ids(t)) for t in self._joined}
        self._histories: dict[str, tuple | None] = {}
        self._pairs: dict[tuple[str, str], bool] = {}
        self._met: dict[str, tuple[int, bytes, bytes]] = {}

    def history(self, token: str) -> tuple[list[float], list[str], list[str]] | None:
        """The merges that make a token of its characters: the rank of each, and after it the
        last and the first symbol. None if they end in several tokens."""
        if token not in self._histories:
            symbols, ranks, lasts, firsts = list(token), [], [token[-1]], [token[0]]
            while len(symbols) > 1:
                rank, at = min((self.v.rank.get(a + b, inf), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])))
                if rank == inf:
                    break
                symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
                ranks.append(rank)
                lasts.append(symbols[-1])
                firsts.append(symbols[0])
            self._histories[token] = (ranks + [inf], lasts, firsts) if len(symbols) == 1 else None
        return self._histories[token]

    def compatible(self, a: str, b: str) -> bool:
        """Whether the text of two tokens is encoded as these two: their merges side by
        side, and at no time a better one across the border."""
        key = (a, b)
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= _MOST:
                self._pairs.clear()
            known = self._pairs[key] = self._compatible(self.history(a), self.history(b))
        return known

    def _compatible(self, a: tuple | None, b: tuple | None) -> bool:
        if a is None or b is None:
            return False
        (left_ranks, lasts, _), (right_ranks, _, firsts) = a, b
        i = j = 0
        while True:
            left, right = left_ranks[i], right_ranks[j]
            across = self.v.rank.get(lasts[i] + firsts[j])
            # of equal ranks the leftmost merges: the left token's, the border's, the right token's
            if across is not None and across < left and across <= right:
                return False
            if left == right == inf:
                return True
            if left <= right:
                i += 1
            else:
                j += 1

    def last_tokens(self, word: str) -> list[str]:
        """The last token of every prefix of a word of known characters; "" for the empty one."""
        table = [""] * (len(word) + 1)
        known = self._pairs.get
        for at, token in self._automaton.iter(word):
            if table[at + 1]:
                continue
            start = at + 1 - len(token)
            if start:
                fits = known((table[start], token))
                if fits is None:
                    fits = self.compatible(table[start], token)
            else:
                fits = self.history(token) is not None
            if fits:
                table[at + 1] = token
        return table

    def tokens(self, word: str) -> list[str]:
        """A word's tokens, read off the table backwards; a character in no piece is one."""
        table, at, out = self.last_tokens(word), len(word), []
        if not table[at]:
            return [word]
        while at:
            token = table[at]
            out.append(token)
            at -= len(token)
        out.reverse()
        return out

    def _token_ids(self, token: str) -> list[int]:
        return [self.v.ids[token]] if token in self.v.ids else self._strange(token)

    def _strange(self, character: str) -> list[int]:
        if not self.v.byte_ids:
            return [self.v.unknown]
        return [self.v.byte_ids[b] for b in character.encode("utf-8")]

    def _plain(self, text: str) -> str:
        return self.v.prefix + text.replace(" ", BLANK) if text else ""

    def encode(self, text: str) -> list[int]:
        return [i for word in self.words(self._plain(text)) for t in self.tokens(word) for i in self._token_ids(t)]

    def _surfaces(self, ids: Iterable[int]) -> bytes:
        """Blanks for their mark; bytes as they are, not yet checked."""
        out = []
        for i in ids:
            kind = self.v.kinds[i]
            if kind == _BYTE:
                out.append(bytes([int(self.v.pieces[i][3:5], 16)]))
            elif kind != _CONTROL:
                out.append((self.v.unknown_text if kind == _UNKNOWN else self.v.pieces[i].replace(BLANK, " ")).encode())
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text: without the blank that encoding puts before it, one replacement
        character for each byte that is part of no character."""
        shown = [i for i in ids if self.v.kinds[i] != _CONTROL]
        first = self.v.pieces[shown[0]] if shown and self.v.kinds[shown[0]] == _NORMAL else ""
        raw = self._surfaces(ids)[1 if self.v.prefix and first.startswith(BLANK) else 0 :]
        out, at = [], 0
        while at < len(raw):
            try:
                out.append(raw[at:].decode())
                break
            except UnicodeDecodeError as e:
                out.append(raw[at : at + e.start].decode() + "�" * (e.end - e.start))
                at += e.end
        return "".join(out)

    def _word(self, word: str) -> tuple[int, bytes, bytes]:
        """Number of ids, the ids joined by commas and their text; kept for short words, of
        which a bounded number is remembered."""
        found = self._met.get(word)
        if found is None:
            tokens = self.tokens(word)
            if tokens[0] in self._joined:
                ids, text = b",".join([self._joined[t] for t in tokens]), b"".join([self._shown[t] for t in tokens])
            else:
                strange = self._strange(word)
                ids, text = ",".join(map(str, strange)).encode(), self._surfaces(strange)
            found = (ids.count(b",") + 1, ids, text)
            if len(word) <= _LONGEST:
                if len(self._met) >= _MOST:
                    self._met.clear()
                self._met[word] = found
        return found

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids and the SHA-256 of the ids and of the decoded text."""
        words = list(map(self._word, self.words(self._plain(text or ""))))
        raw = b"".join(w[2] for w in words)
        # every word is whole characters, and the first begins with the blank put before it
        return (
            sum(w[0] for w in words),
            sha256(b",".join(w[1] for w in words)).hexdigest(),
            sha256(raw[len(self.v.prefix) :]).hexdigest(),
        )


_CODECS: dict[int, Codec] = {}


def _codec(vocabulary) -> Codec:
    """One a worker process, so that what it remembers serves all its tasks."""
    key = id(vocabulary.value)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(vocabulary.value)
    return _CODECS[key]


def _mapped(docs: DataFrame, path: str, column: str, schema: str, work) -> DataFrame:
    """All other columns as they are, and the columns that ``work`` makes of ``column``."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))
    kept = [c for c in docs.columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for batch in parts(batches, column):
            yield with_columns(batch, kept, **work(codec, batch.column(column)))

    fields = docs.drop(column).schema
    return map_batches(docs, run, type(fields).fromDDL(", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [schema])))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int) of every row. NULL and empty texts have no ids."""
    rows = narrow(docs, doc_id=id_col, text=text_col)
    return _mapped(rows, path, "text", "ids array<int>", lambda c, texts: {
        "ids": pa.array([c.encode(t.as_py() or "") for t in texts], pa.list_(pa.int32()))
    })


def decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text of every row of ids. NULL gives NULL, no ids an empty text."""
    rows = narrow(rows, doc_id=id_col, ids=ids_col)
    return _mapped(rows, path, "ids", "text string", lambda c, lists: {
        "text": pa.array([None if x.as_py() is None else c.decode(x.as_py()) for x in lists], pa.string())
    })


def piece_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, in one narrow pass.

    NULL and empty texts have no ids; NULL ids of rows stay; repeated rows are encoded each;
    other columns, whatever their names, are not read; an empty table gives no rows.
    ``path`` names the vocabulary file on the driver. Memory: one slice of a batch, at most
    300,000 words of up to 64 characters and as many pairs of tokens a worker.
    """

    def work(codec: Codec, texts: pa.Array) -> dict[str, pa.Array]:
        found = [codec.digests(t.as_py()) for t in texts]
        return {
            "n_tokens": pa.array([f[0] for f in found], pa.int64()),
            "ids_sha256": pa.array([f[1] for f in found], pa.string()),
            "decoded_sha256": pa.array([f[2] for f in found], pa.string()),
        }

    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    return _mapped(rows, path, "text", "n_tokens bigint, ids_sha256 string, decoded_sha256 string", work)

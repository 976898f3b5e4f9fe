"""Token counts by byte-pair merging over a heap and a linked list.

The vocabulary file is given by path and read on the driver; its merges (as many as the
file has, about 2 MB here) go to the executors as a broadcast whose size does not depend
on the data.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewright.llm.arrow import WordCache, map_batches, narrow, parts, with_columns


# str.split also splits at these four, which are not white space to the vocabulary
_SEPARATORS = re.compile("[\x1c-\x1f]")
_BLANK = regex.compile(r"\p{White_Space}+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 bytes stand for
    themselves, the others for the letters from U+0100 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Vocabulary:
    """What a word-end BPE file says: merges, word-end mark, special strings, pattern."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids: dict[str, int] = spec["model"]["vocab"]
        pairs = [tuple(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        # a pair of symbols is one number; the rank of its merge, and the symbol it makes
        self.ranks = {ids[a] << 32 | ids[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.made = [ids[a + b] for a, b in pairs]
        suffix = spec["model"].get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.inner = [ids.get(c) for c in letters]
        self.final = [ids.get(c + suffix) for c in letters]
        self.special: list[str] = [t["content"] for t in spec["added_tokens"]]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # the file's white space is the Unicode property, without the four separators below U+0020
        self.pattern: str = split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")


class Merger:
    """Counts the tokens of a word: the initial symbols less the merges made.

    A heap holds the adjacent pairs that the vocabulary merges, lowest rank first and
    leftmost among equals. Symbols form a doubly linked list; popping a pair links its
    neighbours and pushes at most two new pairs. Pairs whose symbols have changed since
    they were pushed are skipped. O(n log n) for n symbols; no identifiers are made.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.ranks, self.made = vocabulary.ranks, vocabulary.made
        self.inner, self.final = vocabulary.inner, vocabulary.final

    def count(self, word: str) -> int:
        code = word.encode("utf-8", "surrogatepass")
        inner = self.inner
        symbols = [inner[b] for b in code]
        symbols[-1] = self.final[code[-1]]
        if None in symbols:  # no unknown token: what the vocabulary lacks gives none
            symbols = [s for s in symbols if s is not None]
        n = len(symbols)
        rank_of = self.ranks.get
        # heap entries: the rank above, the place below, so that ties go leftmost first
        heap = []
        for i in range(n - 1):
            rank = rank_of(symbols[i] << 32 | symbols[i + 1])
            if rank is not None:
                heap.append(rank << 32 | i)
        if not heap:
            return n
        heapify(heap)
        made = self.made
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        merges = 0
        while heap:
            item = heappop(heap)
            rank, i = item >> 32, item & 0xFFFFFFFF
            j = after[i]
            left = symbols[i]
            if left < 0 or j >= n or rank_of(left << 32 | symbols[j]) != rank:
                continue
            merges += 1
            symbols[i] = left = made[rank]
            symbols[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = rank_of(left << 32 | symbols[k])
                if rank is not None:
                    heappush(heap, rank << 32 | i)
            h = before[i]
            if h >= 0:
                rank = rank_of(symbols[h] << 32 | left)
                if rank is not None:
                    heappush(heap, rank << 32 | h)
        return n - merges


class TextCounter:
    """Tokens of whole texts; remembers the counts of words met (a bounded number)."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        words = WordCache(Merger(vocabulary).count)
        pattern = regex.compile(vocabulary.pattern)
        self.counts = WordCache(lambda piece: sum(words[w] for w in pattern.findall(piece)))
        special = [regex.escape(s) for s in vocabulary.special]
        self.special = regex.compile("|".join(special)) if special else None

    def _plain(self, text: str) -> int:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower case letter by letter
        text = text.lower()
        # no word of the pattern holds white space, so pieces between it count apart
        pieces = _BLANK.split(text) if _SEPARATORS.search(text) else text.split()
        return sum(map(self.counts.__getitem__, pieces))

    def count(self, text: str | None) -> int:
        """Tokens of a text. NULL is empty; special strings are one token each and part
        the text around them."""
        if not text:
            return 0
        if self.special is None:
            return self._plain(text)
        pieces = self.special.split(text)
        return len(pieces) - 1 + sum(map(self._plain, pieces))


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row, in one narrow pass.

    NULL and empty texts have 0 bytes and 0 tokens; NULL ids stay; repeated rows are
    counted each; other columns are not read. ``path`` names the vocabulary file on the
    driver. Memory: one slice of a batch and at most 400,000 word counts a worker.
    """
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(Vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in parts(batches, "text"):
            counts = [counter.count(t.as_py()) for t in batch.column("text")]
            yield with_columns(batch, ["doc_id", "n_bytes"], n_tokens=pa.array(counts, pa.int64()))

    rows = narrow(docs, doc_id=id_col, text=text_col)
    rows = rows.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    counted = map_batches(rows, run, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


_COUNTERS: dict[int, TextCounter] = {}


def _counter(vocabulary) -> TextCounter:
    """One counter a worker process, so that the word counts serve all its tasks."""
    key = id(vocabulary.value)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = TextCounter(vocabulary.value)
    return _COUNTERS[key]

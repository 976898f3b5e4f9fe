"""Personal data: weak supervision over base rules.

Four base rules find e-mail addresses, IP addresses, card numbers and phone numbers; what
they find stays. A broader search proposes further candidates. Labelers (regular
expressions, gazetteers, context) vote on every candidate, base spans included: personal,
not, or no vote. Expectation-maximisation over the votes estimates how reliable each
labeler is and how likely each candidate is personal; a logistic classifier is trained on
these probabilities, from the votes and the shape of the span, and decides.

A document's candidates are found in one narrow pass over whole texts and kept; what
reaches the driver is one row for each different pattern of votes and shape, whatever the
number of documents, with its count over all of them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewright.llm.arrow import map_batches, narrow, parts, with_columns
from quotewright.session import keep

Span = tuple[str, int, int]
BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "iban", "name"]

# ---- base rules. Written so that a failed attempt is never repeated from inside itself:
# a run of digits or of local-part letters is entered at its start only, which finds the
# same leftmost matches in linear time.
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d *= 1 + i % 2
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    end = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL_SIGNS:
            start -= 1
        if start < m.start():
            yield "email", start, m.end()
            end = m.end()


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """The spans of the base rules by start, then kind."""
    out: list[Span] = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_byte, m[0].split(".")))]
        for m in _CARD.finditer(text):
            d = digits_of(m[0])
            if 12 <= len(d) <= 19 and luhn(d):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return sorted(out, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# ---- broader candidates
_NUMBER = re.compile(r"(?<![A-Za-z0-9])\+?\(?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,18}(?![A-Za-z0-9])")
_SPELLED = re.compile(
    r"[A-Za-z0-9._+-]{1,64}\x20?(?:@|\(at\)|\[at\]|\{at\})\x20?[A-Za-z0-9-]{1,63}"
    r"(?:\x20?(?:\.|\(dot\)|\[dot\]|\{dot\})\x20?[A-Za-z0-9-]{2,24}){1,4}"
)
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_TITLES = ["Mr", "Mrs", "Ms", "Dr", "Herr", "Frau", "Sr", "Sra", "Mme", "Monsieur", "Madame", "Señor", "Señora"]
_NAME = re.compile(rf"\b(?:{'|'.join(_TITLES)})\.?\x20((?:[A-Z]\w+)(?:\x20[A-Z]\w+)?)")


def candidates(text: str, base: list[Span]) -> list[Span]:
    """Base spans, and what the broad patterns find beside them, by start."""
    found: list[Span] = []
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            kind = "phone" if len(digits_of(m[0])) < 12 or m[0][0] in "+(" else "card"
            found.append((kind, *m.span()))
        found += [("iban", *m.span()) for m in _IBAN.finditer(text)]
    if "@" in text or "at)" in text or "at]" in text or "at}" in text:
        found += [("email", *m.span()) for m in _SPELLED.finditer(text)]
    if any(t in text for t in _TITLES):
        found += [("name", *m.span(1)) for m in _NAME.finditer(text)]
    out, end = list(base), 0
    taken = sorted((a, b) for _, a, b in base)
    at = 0
    for span in sorted(found, key=_order):
        _, a, b = span
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if a >= end and not any(x < b and a < y for x, y in taken[max(0, at - 4) : at + 4]):
            out.append(span)
            end = b
    return sorted(out, key=_order)


# ---- labelers: 1 personal, 0 not, None no vote
# fixed values: calling codes, issuer prefixes, top-level domains, given names
CALLING = ("1", "33", "34", "39", "41", "43", "44", "49", "351", "352", "353", "52", "54", "55", "57", "61", "81", "86", "91")
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65")
DOMAINS = frozenset("com org net edu gov io co info biz de fr es uk us eu at ch it nl ca mx ar".split())
NAMES = frozenset("james john robert mary anna maria michael thomas peter paul marie jean pierre hans karl jose juan carlos luis ana".split())
_FOR = re.compile(
    r"\b(tel|telephone|phone|call|fax|mobile|cell|whatsapp|telefon|téléphone|teléfono|card|visa|mastercard|karte|carte|tarjeta"
    r"|e-?mail|mail|contact|kontakt|contacto|ip|host|iban|konto|account|compte|cuenta|name|dear)\b"
)
_AGAINST = re.compile(r"\b(version|licen[sc]e|isbn|issn|doi|page|pages|order|invoice|sha|md5|hash|token|password|key|commit|build|error|code)\b|=\s*\"?$")


def _by_rule(kind: str, s: str) -> int | None:
    if kind == "card":
        d = digits_of(s)
        return int(12 <= len(d) <= 19 and luhn(d))
    if kind == "phone":
        return 1 if s[0] == "+" and 9 <= len(digits_of(s)) <= 15 else None
    if kind == "iban":
        s = s.replace(" ", "")
        return int(int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1)
    if kind in ("email", "ip"):
        return 1 if " " not in s and "(" not in s and "[" not in s and "{" not in s else None
    return None


def _by_shape(kind: str, s: str) -> int | None:
    d = digits_of(s)
    if d and len(set(d)) == 1:
        return 0
    if kind == "phone":
        return int(bool(re.fullmatch(r"(?:\+?[0-9]{1,3}[\x20.-])?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,4}", s)))
    if kind == "card":
        return 1 if re.fullmatch(r"[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{15,16}", s) else None
    return None


def _by_list(kind: str, s: str) -> int | None:
    if kind == "phone" and s[0] == "+":
        return int(digits_of(s).startswith(CALLING))
    if kind == "card":
        return int(s.startswith(ISSUERS))
    if kind == "email":
        return int(re.split(r"[^A-Za-z0-9-]+", s.rstrip(")]}"))[-1].lower() in DOMAINS)
    if kind == "ip":
        return int(s.split(".")[0] not in ("0", "255"))
    if kind == "name":
        return 1 if s.split()[0].lower() in NAMES else None
    return None


def _by_edges(text: str, a: int, b: int) -> int:
    """Not glued to letters, digits or signs of code."""
    return int(not (text[a - 1 : a].isalnum() or text[a - 1 : a] in tuple("=\"'_/#")) and not (text[b : b + 1].isalnum() or text[b : b + 1] in tuple("\"'_=/")))


LABELERS = ["rule", "shape", "list", "context for", "context against", "edges"]


def votes(text: str, span: Span) -> list[int | None]:
    kind, a, b = span
    s, left = text[a:b], text[max(0, a - 32) : a].lower()
    return [
        _by_rule(kind, s),
        _by_shape(kind, s),
        _by_list(kind, s),
        1 if _FOR.search(left) else None,
        0 if _AGAINST.search(left) else None,
        _by_edges(text, a, b) if a else _by_edges(" " + text[: b + 1], 1, b + 1),
    ]


def code(vote: list[int | None]) -> int:
    """Votes as a number in base 3: 0 no vote, 1 not, 2 personal."""
    return sum((0 if v is None else v + 1) * 3**i for i, v in enumerate(vote))


def shape(s: str) -> int:
    """Six bits: plus, brackets, separators, few, some or many digits."""
    n = len(digits_of(s))
    bits = ["+" in s, "(" in s, any(c in s for c in " -./"), n < 8, 8 <= n < 12, n >= 12]
    return sum(1 << i for i, x in enumerate(bits) if x)


# ---- the aggregation


def em(vote: np.ndarray, count: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each pattern to be personal, and P(vote | class) by labeler: shape
    (labelers, 2 classes, 3 votes). Starts from the majority; one vote of each sort is
    added, so no labeler is ever certain."""
    ayes, noes = (vote == 2).sum(axis=1), (vote == 1).sum(axis=1)
    p = (ayes + 0.5) / (ayes + noes + 1)
    onehot = vote[:, :, None] == np.arange(3)
    for _ in range(rounds):
        weight = np.stack([count * (1 - p), count * p])  # class, pattern
        table = np.einsum("cp,plv->lcv", weight, onehot) + 1.0
        table /= table.sum(axis=2, keepdims=True)
        prior = (weight.sum(axis=1) + 1) / (weight.sum() + 2)
        log = np.log(prior)[:, None] + np.einsum("plv,lcv->cp", onehot, np.log(table))
        p = 1 / (1 + np.exp(np.clip(log[0] - log[1], -30, 30)))
    return p, table


@dataclass
class SpanModel:
    """Weights of the final classifier, and the labelers' reliabilities."""

    weights: np.ndarray
    reliability: np.ndarray

    def accepts(self, kind: str, vote: int, shape_bits: int) -> bool:
        return float(features([KINDS.index(kind)], [vote], [shape_bits]) @ self.weights) > 0


def features(kind, vote, shape_bits) -> np.ndarray:
    kind, vote, bits = (np.asarray(x) for x in (kind, vote, shape_bits))
    v = vote[:, None] // 3 ** np.arange(len(LABELERS)) % 3
    columns = [np.ones((len(kind), 1)), kind[:, None] == np.arange(len(KINDS)), v == 2, v == 1, bits[:, None] >> np.arange(6) & 1]
    return np.concatenate([np.asarray(c, float) for c in columns], axis=1)


def fit(patterns: list[tuple[str, int, int, int]], rounds: int = 200) -> SpanModel | None:
    """From (kind, votes, shape, count) of every pattern; None without any."""
    if not patterns:
        return None
    kind = np.array([KINDS.index(p[0]) for p in patterns])
    vote, bits, count = (np.array([p[i] for p in patterns], float if i == 3 else np.int64) for i in (1, 2, 3))
    p, table = em(vote[:, None] // 3 ** np.arange(len(LABELERS)) % 3, count)
    x = features(kind, vote, bits)
    w = np.zeros(x.shape[1])
    share = count / count.sum()
    for _ in range(rounds):  # Newton's method on the soft labels, slightly regularised
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (share * (q - p)) + 1e-4 * w
        h = (x.T * (share * np.maximum(q * (1 - q), 1e-6))) @ x + 1e-4 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return SpanModel(w, table)


_FOUND = "kind string, start int, end int, vote int, shape int, base boolean"


def scan(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id and all candidates of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("vote", pa.int32()), ("shape", pa.int32()), ("base", pa.bool_())]))
        for batch in parts(batches, "text"):
            found = []
            for t in batch.column("text"):
                text = t.as_py() or ""
                base = base_spans(text)
                own = set(base)
                found.append([(s[0], s[1], s[2], code(votes(text, s)), shape(text[s[1] : s[2]]), s in own) for s in candidates(text, base)])
            yield with_columns(batch, ["doc_id"], found=pa.array(found, fields))

    rows = narrow(docs, doc_id=id_col, text=text_col)
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL(f"found array<struct<{_FOUND.replace(' ', ':').replace(',:', ',')}>>")])
    return map_batches(rows, run, schema)


def personal_data(docs: DataFrame, **columns: str) -> tuple[DataFrame, SpanModel | None]:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row, and the model.

    Counts and digest are those of the base spans; ``spans`` adds the candidates that the
    classifier accepts, none of which overlaps a base span. Spans are kind:start:end in
    code points, by start, then kind, joined by commas. NULL and empty texts have none
    (the digest is that of the empty string); repeated rows and NULL ids stay; without
    any candidate in the table there is no model, and nothing to decide.
    """
    found = keep(scan(docs, **columns))
    each = found.select(F.explode("found").alias("x")).select("x.kind", "x.vote", "x.shape")
    patterns = each.groupBy("kind", "vote", "shape").count().collect()  # bounded by the patterns, not the rows
    model = fit(sorted((r[0], r[1], r[2], r[3]) for r in patterns))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, int, int], bool] = {}
        for batch in parts(batches, "found", 1024):
            counts: list[list[int]] = [[] for _ in BASE]
            digests, spans = [], []
            for row in batch.column("found").to_pylist():
                base = [(x["kind"], x["start"], x["end"]) for x in row if x["base"]]
                more = []
                for x in row:
                    key = (x["kind"], x["vote"], x["shape"])
                    if not x["base"]:
                        if key not in known:
                            known[key] = shared.value.accepts(*key)
                        if known[key]:
                            more.append((x["kind"], x["start"], x["end"]))
                for k, c in zip(BASE, counts):
                    c.append(sum(s[0] == k for s in base))
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                spans.append(written(sorted(base + more, key=_order)))
            new = {f"n_{k}": pa.array(c, pa.int64()) for k, c in zip(BASE, counts)}
            yield with_columns(batch, ["doc_id"], **new, base_sha256=pa.array(digests), spans=pa.array(spans, pa.string()))

    fields = ", ".join(f"n_{k} bigint" for k in BASE) + ", base_sha256 string, spans string"
    schema = T.StructType([found.schema["doc_id"], *T.StructType.fromDDL(fields)])
    return map_batches(found, run, schema), model

"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, digits, plus signs and dots before
digits, scheme separators and identifier cues. From each, a small deterministic
parser expands to both sides and validates what it finds. Spans are in code points, end
exclusive; those of one kind do not overlap.

* ``email, ip, card, phone``: the base kinds, as leftmost non-overlapping matches of their
  patterns would give them (``tests/llm`` compares them with these patterns)
* ``login``: ``user:password@`` behind a scheme separator
* ``iban``: behind a cue, with valid check digits
* ``account``: 8 to 17 digits behind a cue for an account

Null and empty texts have no spans. Rows are independent: repeated rows, ties and null ids
need no care. Only ``doc_id`` and the text are read for the report.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .storage import give_back
from .words import runs

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "login", "iban", "account")

_DIGITS = frozenset("0123456789")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LABEL = _DIGITS | _LETTERS | {"-"}
_LOCAL = _DIGITS | _LETTERS | frozenset("._%+-")
_PHONE = _DIGITS | frozenset(" ().-")
_IBAN_CUES = ("IBAN", "Iban", "iban")
_ACCOUNT_CUES = ("account", "Account", "ACCOUNT", "acct", "Acct", "Konto", "konto", "cuenta", "compte")
_LINK = frozenset(" \t:#.=") | _LETTERS
#: At most so many characters stand between a cue and its number.
CUE_REACH = 16

Span = tuple[str, int, int]


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    anchors = {"@": "email", "://": "login"}
    anchors |= {d: "card" for d in "0123456789"}
    anchors |= {f".{d}": "ip" for d in "0123456789"} | {f"+{d}": "phone" for d in "0123456789"}
    anchors |= dict.fromkeys(_IBAN_CUES, "iban") | dict.fromkeys(_ACCOUNT_CUES, "account")
    for word, kind in anchors.items():
        automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def _run(text: str, at: int, allowed: frozenset) -> int:
    """The end of the run of allowed characters from ``at`` on."""
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    begin = at
    while begin > floor and text[begin - 1] in _LOCAL:
        begin -= 1
    end = _run(text, at + 1, _LABEL)
    if begin == at or end == at + 1:
        return None
    dots = 0
    while text[end : end + 1] == "." and (further := _run(text, end + 1, _LABEL)) > end + 1:
        end, dots = further, dots + 1
    return (begin, end) if dots else None


def _numbers(text: str, dot: int) -> list[tuple[int, int]]:
    """The dotted numbers of the chain around a dot that has digits on both sides."""
    begin = dot
    while begin and text[begin - 1] in _DIGITS:
        begin -= 1
    out = [(begin, dot)]
    while text[dot : dot + 1] == "." and (end := _run(text, dot + 1, _DIGITS)) > dot + 1:
        out.append((dot + 1, end))
        dot = end
    return out


def _small(text: str, begin: int, end: int) -> bool:
    """Whether a decimal number is at most 255, however many digits it has."""
    number = text[begin:end].lstrip("0")
    return len(number) <= 3 and int(number or "0") <= 255


def _digit_groups(text: str, begin: int) -> int:
    """The end of digits with at most one space or hyphen between two of them."""
    end = begin + 1
    while True:
        if text[end : end + 1] in _DIGITS:
            end += 1
        elif text[end : end + 1] in ("-", " ") and text[end + 1 : end + 2] in _DIGITS:
            end += 2
        else:
            return end


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _phone(text: str, plus: int) -> tuple[int, int] | None:
    end = _run(text, plus + 2, _PHONE)
    while text[end - 1] not in _DIGITS:
        end -= 1
    return (plus, end) if end >= plus + 4 else None


def _login(text: str, after: int) -> tuple[int, int] | None:
    end = after
    while end < len(text) and text[end] > " " and text[end] not in "/?#@":
        end += 1
    inside = text[after:end]
    return (after, end) if text[end : end + 1] == "@" and ":" in inside[1:-1] else None


def _behind_cue(text: str, after: int) -> int:
    """Where the number named by a cue may begin."""
    at, stop = after, min(len(text), after + CUE_REACH)
    while at < stop and text[at] in _LINK and not (
        text[at : at + 2].isascii() and text[at : at + 2].isupper() and text[at + 2 : at + 3] in _DIGITS
    ):
        at += 1
    return at


def _iban(text: str, at: int) -> tuple[int, int] | None:
    end, plain = at, ""
    while end < len(text) and len(plain) < 34:
        c = text[end]
        if c in _DIGITS or (c in _LETTERS and c.isupper()):
            plain += c
        elif c != " " or not plain:
            break
        end += 1
        valid = len(plain) >= 15 and plain[:2].isalpha() and plain[2:4].isdigit()
        if valid and not text[end : end + 1].isalnum() and text[end - 1] != " ":
            if int("".join(str(int(x, 36)) for x in plain[4:] + plain[:4])) % 97 == 1:
                return at, end
    return None


def find_spans(text: str) -> list[Span]:
    """All spans by kind, then start."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    floor = dict.fromkeys(KINDS, 0)
    for last, (kind, size) in _automaton().iter(text):
        at = last - size + 1
        if at < floor[kind]:
            continue
        if kind == "card":
            end = floor["card"] = _digit_groups(text, at)
            if end - at >= 16:
                digits = text[at:end].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found["card"].append((at, end))
        elif kind == "ip":
            if at and text[at - 1] in _DIGITS:
                chain = _numbers(text, at)
                floor["ip"] = chain[-1][1]
                for i in range(0, len(chain) - 3, 4):
                    if all(_small(text, *part) for part in chain[i : i + 4]):
                        found["ip"].append((chain[i][0], chain[i + 3][1]))
        elif kind == "email":
            span = _email(text, at, floor["email"])
            if span:
                floor["email"] = span[1]
                found["email"].append(span)
        elif kind == "phone":
            span = _phone(text, at)
            if span and 8 <= sum(c in _DIGITS for c in text[span[0] : span[1]]) <= 15:
                found["phone"].append(span)
        elif kind == "login":
            span = _login(text, last + 1)
            if span:
                found["login"].append(span)
        else:
            begin = _behind_cue(text, last + 1)
            span = _iban(text, begin)
            if span is None and kind == "account":
                end = _run(text, begin, _DIGITS)
                if 8 <= end - begin <= 17 and not text[end : end + 1].isalnum():
                    span = begin, end
            elif span:
                kind = "iban"
            if span and span[0] >= floor[kind]:
                floor[kind] = span[1]
                found[kind].append(span)
    return [(kind, *span) for kind in KINDS for span in found[kind]]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for kind, begin, end in spans)


def report(text: str | None) -> tuple:
    """Counts by base kind, digest of the base spans, all spans."""
    spans = find_spans(text or "")
    base = [s for s in spans if s[0] in BASE_KINDS]
    counts = [sum(s[0] == kind for s in base) for kind in BASE_KINDS]
    return *counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)


def redacted(text: str | None) -> str | None:
    """The text with each stretch of personal data replaced by its kind in brackets."""
    spans = sorted(find_spans(text or ""), key=lambda s: (s[1], -s[2]))
    if not spans:
        return text
    out, at = [], 0
    for kind, begin, end in spans:
        if begin >= at:
            out += text[at:begin], f"[{kind}]"
        at = max(at, end)
    return "".join(out) + text[at:]


COUNTS = tuple(f"n_{kind}" for kind in BASE_KINDS)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """A row for each document: counts, digest and spans."""
    names = ["doc_id", *COUNTS, "base_sha256", "spans"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in runs(batch.column(1)):
                part = batch.slice(low, high - low)
                columns = list(zip(*map(report, part.column(1).to_pylist()), strict=True))
                arrays = [pa.array(c, pa.int64()) for c in columns[:4]]
                arrays += [pa.array(c, pa.string()) for c in columns[4:]]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], names=names)

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
    schema += ", ".join(f"{c} long" for c in COUNTS) + ", base_sha256 string, spans string"
    return docs.select("doc_id", "text").mapInArrow(work, schema)


def redact(docs: DataFrame, text: str = "text", size: str = "n_chars") -> DataFrame:
    """All rows and columns, with personal data replaced; ``size``, if there, follows."""
    at = docs.columns.index(text)
    size_at = docs.columns.index(size) if size in docs.columns else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in runs(batch.column(at)):
                part = batch.slice(low, high - low)
                before = part.column(at).to_pylist()
                after = [redacted(t) for t in before]
                part = part.set_column(at, part.schema.field(at), pa.array(after, pa.string()))
                if size_at is not None:
                    old = part.column(size_at).to_pylist()
                    new = [o if a == b else len(a) for o, a, b in zip(old, after, before, strict=True)]
                    field = part.schema.field(size_at)
                    part = part.set_column(size_at, field, pa.array(new, field.type))
                yield part
        give_back()

    return docs.mapInArrow(work, docs.schema)

"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton over a text finds anchors: at-signs, schemes,
plus signs, digits and identifier cues.  At each anchor a deterministic local parser
grows the candidate to its bounds and validates it.  Nothing else of the text is looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import per_text, unused
from larkspur.llm.spans import SPANS_ARROW, SPANS_SQL, Span, ordered, spans_array

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "login", "iban", "account")

#: Words that announce an account number.
CUES = ("account", "acct", "iban", "ssn", "passport")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOGIN = re.compile(r"://[A-Za-z0-9._%+-]+:[^\s/:@]+@")
_IBAN = re.compile(r"[\x20:#=]*([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})")
_ACCOUNT = re.compile(r"(?:\x20?(?:no|nr|number|id)\.?)?\x20*[:#=]\x20*([A-Z]{0,2}[0-9][0-9-]{4,18}[0-9])", re.I | re.A)


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    for anchor, name in (("@", "at"), ("+", "plus"), ("://", "scheme")):
        found.add_word(anchor, (name, len(anchor)))
    for cue in CUES:
        for form in (cue, cue.capitalize(), cue.upper()):
            found.add_word(form, ("iban" if cue == "iban" else "account", len(form)))
    found.make_automaton()
    return found


def _octet(digits: str) -> bool:
    """Whether a run of digits, of any length, is at most 255."""
    digits = digits.lstrip("0")
    return len(digits) < 4 and int(digits or "0") <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    """The check digits of ISO 13616: the rearranged number is 1 modulo 97."""
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def find(text: str) -> list[Span]:
    """All spans of a text, by start, then by the order of ``KINDS``.

    The base kinds are the leftmost non-overlapping matches of their patterns: a
    candidate begins where its kind's last one ended or later, and one that fails its
    validation still takes up its characters.
    """
    out: list[Span] = []
    end = dict.fromkeys(KINDS, 0)
    for last, (anchor, width) in _automaton().iter(text):
        at = last - width + 1
        if anchor == "digit":
            if at and text[at - 1] in "0123456789":
                continue
            if at >= end["ip"] and (m := _IP.match(text, at)):
                end["ip"] = m.end()
                if all(_octet(p) for p in m.groups()):
                    out.append(("ip", at, m.end()))
            if at >= end["card"] and (m := _CARD.match(text, at)):
                end["card"] = m.end()
                if 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                    out.append(("card", at, m.end()))
        elif anchor == "at":
            start, bound = at, end["email"]
            while start > bound and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                end["email"] = m.end()
                out.append(("email", start, m.end()))
        elif anchor == "plus":
            if at >= end["phone"] and (m := _PHONE.match(text, at)):
                end["phone"] = m.end()
                if 10 <= len(_digits(m[0])) <= 15:
                    out.append(("phone", at, m.end()))
        elif anchor == "scheme":
            if m := _LOGIN.match(text, at):
                out.append(("login", at + 3, m.end() - 1))
        elif anchor == "iban":
            if m := _IBAN.match(text, last + 1):
                # The shortest form is 15 characters; the next word may follow a space.
                whole = m[1]
                while len(whole) >= 15 and not iban_valid(whole.replace(" ", "")):
                    whole = whole[:-1].rstrip()
                if len(whole.replace(" ", "")) >= 15:
                    out.append(("iban", m.start(1), m.start(1) + len(whole)))
        elif (not at or not text[at - 1].isalnum()) and (m := _ACCOUNT.match(text, last + 1)):
            out.append(("account", m.start(1), m.end(1)))
    return ordered(out, KINDS)


def spans_of(docs: DataFrame, *, keys: tuple[str, ...] = ("doc_id",), text_column: str = "text") -> DataFrame:
    """The ``keys`` and ``spans`` of every row; no shuffle.

    Null text counts as empty and has no spans; rows that repeat or have null keys each
    get a row; an empty table gives an empty result; other columns are not read.
    """
    text = unused("text", keys)
    return _apply(docs.select(*keys, F.coalesce(text_column, F.lit("")).alias(text)), keys, text, lambda texts: [("spans", spans_array([find(t) for t in texts]).cast(SPANS_ARROW))], f"spans {SPANS_SQL}")


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with each span as ``[KIND]``; of spans that overlap, the first names all."""
    out, at = [], 0
    merged: list[list] = []
    for kind, start, end in spans:
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(end, merged[-1][2])
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, *, text_column: str = "text") -> DataFrame:
    """``docs`` with personal data in the text masked; null text stays null, all rows and columns stay."""
    others = tuple(c for c in docs.columns if c != text_column)

    def values(texts: list[str | None]) -> list:
        return [(text_column, pa.array([t if t is None or not (s := find(t)) else masked(t, s) for t in texts], pa.string()))]

    return _apply(docs, others, text_column, values, f"`{text_column}` string").select(*(F.col(f"`{c}`") for c in docs.columns))


def _apply(docs: DataFrame, keys: tuple[str, ...], text: str, values, schema: str) -> DataFrame:
    kinds = dict(docs.dtypes)

    def function(part: pa.RecordBatch) -> pa.RecordBatch:
        new = values(part.column(text).to_pylist())
        return pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), *(v for _, v in new)], names=[*keys, *(n for n, _ in new)])

    head = "".join(f"`{k}` {kinds[k]}, " for k in keys)
    run = per_text(function, text)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(it)

    return docs.mapInArrow(batches, head + schema)

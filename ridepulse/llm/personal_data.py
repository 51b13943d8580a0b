"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, scheme marks, pairs
of digits (with what may stand between them), plus signs before a digit,
colons beside hex digits, and cue words. Around each anchor a small
deterministic parser looks for the boundaries of one kind and validates what
lies between them. Nothing is searched for apart from anchors, and every
parser moves on from where its kind ended before, so a text costs time in
proportion to its length.

Base kinds, leftmost and non-overlapping per kind, those that fail dropped
without another try:

* ``email``  ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ``ip``     four runs of digits joined by dots, each at most 255
* ``card``   digits with at most one blank or hyphen between two, 16 to 19 of them, Luhn
* ``phone``  ``\\+[0-9][\\x20().0-9-]+[0-9]``, 8 to 15 digits

Added kinds (they may overlap base spans, which stay as they are):

* ``account``  what follows a cue for an account number, passport, social security or tax number
* ``iban``     what follows the cue IBAN, length 15 to 34, remainder 1 modulo 97
* ``intl_email``  addresses with letters beyond ASCII that ``email`` misses or cuts
* ``ipv6``     IPv6 addresses
* ``login``    user and password in ``scheme://user:password@host``

Positions are code points, ends exclusive. A null text is the empty text and
has no span; every row of the table gives one row, repeated ids included.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridepulse.llm.common import slices

# Kinds in the order in which spans are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("account", "iban", "intl_email", "ipv6", "login")
# Cue words, each a word of its own in the text (any case).
ACCOUNT_CUES = (
    "account", "acct", "passport", "ssn", "social security", "tax id", "konto", "kontonummer", "cuenta", "compte",
)
IBAN_CUE = "iban"

Span = tuple[int, int]
_DIGITS = "0123456789"
_DIGIT = re.compile(r"[0-9]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_INTL_LOCAL = re.compile(r"[\w.%+-]")
_INTL_DOMAIN = re.compile(r"[^\W_](?:[\w-]*[^\W_])?(?:\.[^\W_](?:[\w-]*[^\W_])?)+")
_HEX = re.compile(r"[0-9A-Fa-f:.]")
_LOGIN = re.compile(r"[^\s/?#@:]+:[^\s/?#@]+(?=@)")
_AFTER_CUE = re.compile(r"(?:[ \t]{0,2}(?:number|nummer|no\.?|nr\.?|id|is|#|:|=)){0,4}[ \t]{0,2}", re.I)
_ACCOUNT = re.compile(r"[A-Za-z]{0,3}[0-9](?:[ .-]?[0-9]){4,19}(?![\w])")
_IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30}(?![A-Za-z0-9])")


def _luhn(digits: str) -> bool:
    twice = (int(d) * 2 for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in twice)) % 10 == 0


def _run_before(text: str, end: int, least: int, char: re.Pattern) -> int:
    """Where the run of ``char`` that ends at ``end`` begins, not before ``least``."""
    at = end
    while at > least and char.match(text, at - 1):
        at -= 1
    return at


class Finder:
    """The spans of one text by kind; ``done`` is where each kind's last stretch ended."""

    def __init__(self, text: str):
        self.text = text
        self.done = dict.fromkeys((*BASE_KINDS, *ADDED_KINDS), 0)
        self.spans: dict[str, list[Span]] = {k: [] for k in self.done}

    def _add(self, kind: str, start: int, end: int, valid: bool = True) -> None:
        self.done[kind] = end
        if valid:
            self.spans[kind].append((start, end))

    def at_sign(self, at: int) -> None:
        start = _run_before(self.text, at, self.done["email"], _LOCAL)
        host = _DOMAIN.match(self.text, at + 1) if start < at else None
        if host:
            self._add("email", start, host.end())
        start = _run_before(self.text, at, self.done["intl_email"], _INTL_LOCAL)
        host = _INTL_DOMAIN.match(self.text, at + 1) if start < at else None
        if host and not self.text[start : host.end()].isascii():
            self._add("intl_email", start, host.end())

    def dotted(self, at: int) -> None:
        """A digit, a dot, a digit: the whole chain of runs, four at a time."""
        if at < self.done["ip"]:
            return
        start = _run_before(self.text, at + 1, self.done["ip"], _DIGIT)
        chain = _DOTTED.match(self.text, start)
        runs = chain.group().split(".")
        for i in range(0, len(runs) - 3, 4):
            end = start + sum(map(len, runs[i : i + 4])) + 3
            parts = [x.lstrip("0") or "0" for x in runs[i : i + 4]]
            self._add("ip", start, end, all(len(x) <= 3 and int(x) <= 255 for x in parts))
            start = end + 1
        self.done["ip"] = chain.end()

    def digits(self, at: int) -> None:
        if at < self.done["card"]:
            return
        found = _CARD.match(self.text, at)
        number = [c for c in found.group() if c in _DIGITS] if found.end() - at <= 64 else []
        self._add("card", at, found.end(), 16 <= len(number) <= 19 and _luhn("".join(number)))

    def plus(self, at: int) -> None:
        found = _PHONE.match(self.text, at)
        if found:
            self._add("phone", at, found.end(), 8 <= sum(c in _DIGITS for c in found.group()) <= 15)

    def colon(self, at: int) -> None:
        if at < self.done["ipv6"]:
            return
        start = _run_before(self.text, at, self.done["ipv6"], _HEX)
        end = at
        while end < len(self.text) and _HEX.match(self.text, end):
            end += 1
        self.done["ipv6"] = end
        alone = not (self.text[start - 1 : start].isalnum() or self.text[end : end + 1].isalnum())
        while end > start and self.text[end - 1] in ".:" and self.text[end - 2 : end] != "::":
            end -= 1
        if alone and 2 < end - start <= 45:
            try:
                ipaddress.IPv6Address(self.text[start:end])
            except ValueError:
                return
            self.spans["ipv6"].append((start, end))

    def scheme(self, at: int) -> None:
        found = _LOGIN.match(self.text, at + 3)
        if found and found.start() >= self.done["login"]:
            self._add("login", found.start(), found.end())

    def cue(self, at: int, cue: str) -> None:
        end = at + len(cue)
        if self.text[at - 1 : at].isalnum() or self.text[end : end + 1].isalpha():
            return
        start = _AFTER_CUE.match(self.text, end).end()
        if cue == IBAN_CUE:
            found = _IBAN.match(self.text, start)
            if found and start >= self.done["iban"]:
                code = found.group().replace(" ", "").upper()
                moved = "".join(str(int(c, 36)) for c in code[4:] + code[:4])
                if 15 <= len(code) <= 34 and int(moved) % 97 == 1:
                    self._add("iban", start, found.end())
        else:
            found = _ACCOUNT.match(self.text, start)
            if found and start > end and start >= self.done["account"]:
                self._add("account", start, found.end())


_AUTOMATON: list[ahocorasick.Automaton] = []


def _automaton() -> ahocorasick.Automaton:
    """Anchors -> (parser, length of the anchor, where in it the parser begins); built once per worker."""
    if not _AUTOMATON:
        made = ahocorasick.Automaton()
        anchors = {"@": ("at_sign", 0), "://": ("scheme", 0), "::": ("colon", 0)}
        for a in _DIGITS:
            anchors["+" + a] = ("plus", 0)
            anchors |= {a + sep + b: ("digits", 0) for sep in ("", " ", "-") for b in _DIGITS}
            anchors |= {f"{a}.{b}": ("dotted", 0) for b in _DIGITS}
        for x in "0123456789abcdef":
            anchors[x + ":"] = ("colon", 1)
        for cue in (*ACCOUNT_CUES, IBAN_CUE):
            anchors[cue] = ("cue", 0)
        for anchor, (parser, offset) in anchors.items():
            made.add_word(anchor, (parser, len(anchor), offset, anchor))
        made.make_automaton()
        _AUTOMATON.append(made)
    return _AUTOMATON[0]


# Anchors are matched without regard to case; only letters whose lower case is one letter change place-true.
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def find(text: str) -> dict[str, list[Span]]:
    """Spans by kind, ascending."""
    finder = Finder(text)
    for last, (parser, length, offset, anchor) in _automaton().iter(text.translate(_LOWER)):
        at = last - length + 1 + offset
        if parser == "cue":
            finder.cue(at, anchor)
        else:
            getattr(finder, parser)(at)
    return finder.spans


def joined(spans: dict[str, list[Span]], kinds: tuple[str, ...]) -> str:
    """kind:start:end of all spans, by kind as listed, then by start."""
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans[k])


SPANS_SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = [find(t) if t else dict.fromkeys((*BASE_KINDS, *ADDED_KINDS), ()) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *(pa.array([len(f[k]) for f in found], pa.int64()) for k in BASE_KINDS),
                pa.array([hashlib.sha256(joined(f, BASE_KINDS).encode()).hexdigest() for f in found], pa.string()),
                pa.array([joined(f, (*BASE_KINDS, *ADDED_KINDS)) for f in found], pa.string()),
            ],
            ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"],
        )


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts and spans of personal data; no shuffle."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _scan, SPANS_SCHEMA
    )


def masked(text: str, mask: str = "\u2588") -> str:
    """``text`` with every character of every span replaced by ``mask``."""
    out = list(text)
    for spans in find(text).values():
        for a, b in spans:
            out[a:b] = mask * (b - a)
    return "".join(out)


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` masked, place-true; the other columns stay as they are."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [None if t is None else masked(t) for t in batch.column("text").to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))

    return docs.mapInArrow(run, schema)

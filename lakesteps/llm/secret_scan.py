"""Secrets in text: fixed patterns, and literals judged by the names they are assigned to.

Source and configuration syntax is lexed into assignments of a name to literals or other names.
Constants are followed through names, string pieces joined by + or side by side count as one
value, and a literal is reported when the name that receives it and its own shape score enough.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from math import log2

from pyspark.sql import DataFrame, functions as F

from lakesteps.llm.common import free_name, per_text, text_or_empty

#: Fixed patterns of the base kinds.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_HINTS = ("passw", "secret", "token", "api_key", "apikey")
KINDS = ("assign", "access", "hex", "literal")

NAME_SCORES = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "secret": 1.0,
    "token": 1.0, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "auth": 0.7, "bearer": 0.8,
    "authorization": 0.8, "pass": 0.8, "pin": 0.7,
}
KEY_OWNERS = frozenset("api access private secret signing encryption master account storage shared auth".split())
#: A lower-case text without any of these has no name that scores (owners score with a key only).
NAME_HINTS = tuple(n for n in (*NAME_SCORES, "key") if not any(m in n for m in (*NAME_SCORES, "key") if m != n))
HARMLESS = frozenset(
    "hash file path url uri name length len size count type id policy hint field label prompt regex "
    "pattern expiry ttl limit public endpoint header param column title".split())
PLACEHOLDER = re.compile(
    r"^(?:\$\{.*\}|\{\{.*\}\}|<.*>|%\w+%|[xX*.#-]+|.*(?:changeme|example|placeholder|your[_-]|dummy|todo).*"
    r"|none|null|true|false|undefined)$", re.I)
#: Names score above 2/3 so that each can reach this with a value of full score.
LEAST = 0.8

_QUOTED = r"\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'|`(?:[^`\\\n]|\\.)*`"
#: Word before the value in a header; not a part of the secret.
_SCHEME = r"(?i:bearer|basic)[ \t]+"
_NAME = r"[A-Za-z_$][\w$]*(?:[.-][A-Za-z_$][\w$]*)*"
ASSIGNMENT = re.compile(
    rf"(?<![\w$.-])(?P<quote>[\"'`]?)(?P<name>{_NAME})(?P=quote)[ \t]*+(?::=|=>|=(?!=)|:(?![:/]))[ \t]*+"
    rf"(?P<value>(?:{_QUOTED})(?:[ \t]*+(?:{_QUOTED}|\+[ \t]*+(?:{_QUOTED}|{_NAME})))*"
    rf"|{_NAME}(?:[ \t]*+\+[ \t]*+(?:{_QUOTED}|{_NAME}))+|(?:{_SCHEME})?[^\s\"'`,;()\[\]{{}}<>|]+)", re.A)
#: A name and its literal as two attributes of an element, or as two values of a call or list.
PAIR = re.compile(
    rf"\b(?:key|name|id)[ \t]*+=[ \t]*+(?P<key>{_QUOTED})\s++value[ \t]*+=[ \t]*+(?P<value>{_QUOTED})"
    rf"|[(\[{{][ \t]*+(?P<first>{_QUOTED})[ \t]*+,[ \t]*+(?P<second>{_QUOTED})[ \t]*+(?=[)\]}},])", re.A)
#: A value that is itself assigned to: a = b = "..."
CHAINED = re.compile(rf"{_NAME}(?:[ \t]++=[ \t]++(?!=)|[ \t]*+=[ \t]*+(?=[\"'`]))", re.A)
SCHEME = re.compile(_SCHEME)
PIECE = re.compile(rf"(?P<text>{_QUOTED})|(?P<name>{_NAME})", re.A)
WORD_IN_NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def name_score(name: str) -> float:
    """How likely a value of this name is secret, from 0 to 1."""
    words = [w.lower() for w in WORD_IN_NAME.findall(name)]
    score = max((NAME_SCORES.get(w, 0.0) for w in words), default=0.0)
    for owner, key in zip(words, words[1:]):
        if key in ("key", "keys") and owner in KEY_OWNERS:
            score = max(score, 1.0)
    return score * (0.4 if words and words[-1] in HARMLESS else 1.0)


def literal_score(value: str, bare: bool) -> float:
    """How much a literal looks like a secret, from 0 to 1; bare ones need a digit."""
    if len(value) < 8 or " " in value or PLACEHOLDER.match(value):
        return 0.0
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^\w]"))
    if kinds < 2 or bare and not re.search("[0-9]", value):
        return 0.0
    n = len(value)
    entropy = -sum(c / n * log2(c / n) for c in Counter(value).values())
    return min(1.0, entropy / 3.0)


def literals(text: str) -> list[tuple[int, int]]:
    """Spans (code points, end exclusive) of literals that reach sensitive names, without quotes."""
    known: dict[str, list[tuple[int, int, bool]]] = {}
    found: set[tuple[int, int]] = set()

    def judge(name: str, pieces: list[tuple[int, int, bool]]) -> None:
        score = name_score(name)
        if score:
            whole = "".join(text[s:e] for s, e, _ in pieces)
            shape = literal_score(whole, any(b for *_, b in pieces))
            if shape and 0.6 * score + 0.4 * shape >= LEAST:
                found.update((s, e) for s, e, _ in pieces if e > s)

    place, waiting = 0, []
    while m := ASSIGNMENT.search(text, place):
        place, at, value = m.end(), m.start("value"), m["value"]
        if CHAINED.match(text, at):
            waiting.append(m["name"])
            place = at
            continue
        pieces: list[tuple[int, int, bool]] = []
        if value[0] in "\"'`" or "+" in value and PIECE.match(value):
            for p in PIECE.finditer(value):
                if p["text"]:
                    start, end = at + p.start() + 1, at + p.end() - 1
                    scheme = not pieces and SCHEME.match(text, start, end)
                    pieces.append((scheme.end() if scheme else start, end, False))
                else:
                    pieces += known.get(p["name"], [])
        else:
            scheme = SCHEME.match(value)
            skip = scheme.end() if scheme else 0
            bare = value[skip:].rstrip(".:")
            if value[skip:] in known:
                pieces = known[value[skip:]]
            else:  # after a scheme a value is a literal, unless it looks like a word
                pieces = [(at + skip, at + skip + len(bare), not (scheme and re.search("[^a-z]", bare[1:])))]
        for name in (m["name"], *waiting):
            known[name] = pieces
            judge(name, pieces)
        waiting = []
    for m in PAIR.finditer(text):
        name, value = ("key", "value") if m["key"] else ("first", "second")
        judge(m[name][1:-1], [(m.start(value) + 1, m.end(value) - 1, True)])
    return sorted(found)


def scan(text: str) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]:
    """Base spans and all spans as (start, kind, end), by start, then kind as listed."""
    base = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base.sort()
    spans = base
    if ("=" in text or ":" in text or "," in text) and any(h in low for h in NAME_HINTS):
        more = [(s, 3, e) for s, e in literals(text) if not any(a <= s and e <= b for a, _, b in base)]
        spans = sorted(base + more)
    named = lambda rows: [(s, KINDS[k], e) for s, k, e in rows]
    return named(base), named(spans)


def listed(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def _rows(texts: list[str]) -> list[tuple]:
    out = []
    for text in texts:
        base, spans = scan(text)
        n = Counter(kind for _, kind, _ in base)
        out.append((n["assign"], n["access"], n["hex"],
                    hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
    return out


def find_secrets(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_assign, n_access, n_hex, base_sha256, spans.

    A null text counts as empty: no spans, the digest of the empty string. Repeated rows get the
    same answer each; other columns are ignored. Nothing is shuffled.
    """
    source = free_name(docs, "__text")
    rows = docs.select(F.col(f"`{id}`"), text_or_empty(text).alias(source))
    return per_text(rows, _rows, "n_assign long, n_access long, n_hex long, base_sha256 string, "
                    "spans string", source)

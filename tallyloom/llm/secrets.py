"""Secrets in texts: fixed patterns, and strings whose sliding-window entropy is too high for words.

Three pattern kinds come first (``assign``, ``access``, ``hex``).  Then what they
leave of runs of 20 or more token characters are candidates: within one, every
stretch of one character class is read with a window, the counts of the window's
characters are kept up to date as it moves by one, and with them its Shannon
entropy.  Windows over the class's threshold, which is higher for letters with
few digits or none, join to ``entropy`` spans.  Candidates on the allow-list
(UUIDs, dates, runs of the alphabet or of one pattern, paths, plain words) are
suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import inf, log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import column, frugal

KINDS = ("assign", "access", "hex", "entropy")

# The base patterns and the least length of what they must have found.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the same maximal runs as [0-9a-f]+ of 24 and more
LEAST_VALUE, LEAST_ACCESS = 6, 20

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LEAST_REST, WIDEST = 12, 24


@dataclass(frozen=True)
class CharClass:
    """Stretches of ``chars`` read with ``window`` characters; flagged from ``bits`` of entropy on."""

    chars: re.Pattern
    window: int
    bits: float
    digits: int  # a window with fewer of them needs ``letter_bits``
    letter_bits: float = inf
    one_case_bits: float = inf  # in place of letter_bits where all letters are small or all are capital


CLASSES = (
    CharClass(re.compile(r"[0-9A-Fa-f]+"), 20, 2.9, 4, 3.1, 2.9),
    CharClass(re.compile(r"[A-Za-z0-9]+"), 20, 3.7, 2, 3.75, 3.6),
    CharClass(re.compile(r"[A-Za-z0-9+/_=-]+"), 24, 4.0, 3, 4.1, 4.1),
)
ALLOWED = (
    re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"),  # UUID
    re.compile(r"[0-9_=+/-]*(T[0-9]+)?Z?[0-9_=+/-]*"),  # numbers, dates, time stamps, rules
    re.compile(r"(.{1,8}?)\1+.{0,8}"),  # one pattern again and again
)
RUNS = "0123456789abcdefghijklmnopqrstuvwxyz" * 2
_separators = re.compile(r"[-_/=+]+")
_named = re.compile(r"[0-9]{1,8}|[A-Za-z]+[0-9]{0,4}")
_parts = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_weight = [0.0] + [n * log2(n) for n in range(1, 65)]


def plain_words(text: str) -> bool:
    """Words, paths and names: no word of ``CANDIDATE``'s length, and capitals only where a word begins."""
    words = [w for w in _separators.split(text) if w]
    if not all(_named.fullmatch(w) for w in words):
        return False
    parts = _parts.findall(text)
    if any(len(p) >= 20 for p in parts):
        return False
    return len(parts) <= sum(w[0].isalpha() for w in words) or sum(map(len, parts)) >= 4 * len(parts)


def allowed(text: str, patterns: tuple = ALLOWED) -> bool:
    return plain_words(text) or any(p.fullmatch(text) for p in patterns) or text.lower() in RUNS or text.lower() in RUNS[::-1]


def high_entropy(text: str, kind: CharClass) -> list[tuple[int, int]]:
    """Joined windows of ``text`` (of one class) that reach the class's entropy."""
    w = kind.window
    counts: dict[str, int] = {}
    total, digits, letters, capitals, spans = 0.0, 0, 0, 0, []
    for i, c in enumerate(text):
        n = counts.get(c, 0)
        total += _weight[n + 1] - _weight[n]  # sum of n log n over the window
        counts[c] = n + 1
        digits += c.isdigit()
        letters += c.isalpha()
        capitals += c.isupper()
        if i >= w:
            old = text[i - w]
            n = counts[old]
            total += _weight[n - 1] - _weight[n]
            counts[old] = n - 1
            digits -= old.isdigit()
            letters -= old.isalpha()
            capitals -= old.isupper()
        bits = (kind.bits if digits >= kind.digits else kind.letter_bits if 0 < capitals < letters else kind.one_case_bits)
        if i >= w - 1 and letters >= 2 and log2(w) - total / w >= bits:
            start = i - w + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the pattern kinds, leftmost and not overlapping within a kind."""
    found = []
    low = text.lower()
    if any(word in low for word in ("passw", "secret", "token", "api")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _covered(base: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that the spans of ``base`` (by start) cover together."""
    starts: list[int] = []
    ends: list[int] = []
    for s, _, e in base:
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def _rests(start: int, end: int, starts: list[int], ends: list[int]) -> Iterator[tuple[int, int]]:
    """The parts of a stretch outside the covered ones; only those that touch it are looked at."""
    for k in range(bisect_right(ends, start), len(starts)):
        if starts[k] >= end:
            break
        if starts[k] > start:
            yield start, starts[k]
        start = ends[k]
    if start < end:
        yield start, end


def entropy_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of high entropy outside the spans of ``base``; what the classes find in a candidate is joined.

    A rest of ``LEAST_REST`` or more characters beside a base span is read with as many of its neighbours as a window
    needs.
    """
    found = []
    starts, ends = _covered(base)
    for m in CANDIDATE.finditer(text):
        for first, last in _rests(m.start(), m.end(), starts, ends):
            if last - first < LEAST_REST:
                continue
            at = first if last - first >= WIDEST else max(m.start(), min(first, m.end() - WIDEST, first - (WIDEST - last + first) // 2))
            word = text[at:last if last - first >= WIDEST else min(m.end(), max(last, at + WIDEST))]
            if allowed(word) or allowed(text[first:last]):
                continue
            spans = sorted((at + run.start() + s, at + run.start() + e) for kind in CLASSES
                           for run in kind.chars.finditer(word) if run.end() - run.start() >= kind.window
                           and not allowed(run.group()) for s, e in high_entropy(run.group(), kind))
            joined: list[tuple[int, int]] = []
            for s, e in spans:
                s, e = max(s, first), min(e, last)
                if joined and s <= joined[-1][1]:
                    joined[-1] = (joined[-1][0], max(e, joined[-1][1]))
                elif s < e:
                    joined.append((s, e))
            found += [(s, 3, e) for s, e in joined]
    return found


def secret_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, by start and then by kind as listed in KINDS."""
    base = base_spans(text or "")
    return [(KINDS[k], s, e) for s, k, e in sorted(base + entropy_spans(text or "", base))]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end>>) of every row; a null text counts as empty."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    out = pa.schema([("id", pa.int64()), ("spans", pa.list_(span))])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in secret_spans(t)] for t in column(part, "text")]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(span))], schema=out)

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(frugal(run), "id long, spans array<struct<kind:string,start:long,end:long>>"))

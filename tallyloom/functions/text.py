"""Text helpers: take-before-mark, split/nth, hierarchy prefixes, decode, regex."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def text_before(col, mark: str) -> Column:
    """Text before the first ``mark``; the whole text when the mark is absent."""
    return F.substring_index(_c(col), mark, 1)


def text_after(col, mark: str) -> Column:
    """Text after the first ``mark``; NULL when the mark is absent."""
    c = _c(col)
    pos = F.instr(c, mark)
    return F.when(pos > 0, c.substr(pos + F.lit(len(mark)), F.length(c)))


def split_nth(col, sep: str, n: int) -> Column:
    """0-based n-th piece of a split; NULL when out of range (never raises)."""
    return F.get(F.split(_c(col), _regex_quote(sep)), n)


def split_count(col, sep: str) -> Column:
    """Number of pieces after splitting on a literal separator."""
    return F.size(F.split(_c(col), _regex_quote(sep)))


def _regex_quote(s: str) -> str:
    special = set(".^$*+?()[]{}|\\")
    return "".join("\\" + ch if ch in special else ch for ch in s)


def regex_or_null(col, pattern: str, group: int = 1) -> Column:
    """First regex match (group), NULL when nothing matches."""
    return F.nullif(F.regexp_extract(_c(col), pattern, group), F.lit(""))


def decode(col, mapping: Mapping, default=None) -> Column:
    """Code -> label through a literal mapping (a CASE chain, stays in codegen)."""
    c = _c(col)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def size_label(bytes_col) -> Column:
    """Human-readable size: ``<n> KB`` below 1 MiB, ``<n> MB`` below 1 GiB, else GB.

    The rounded number is cast to bigint before printing (``12`` not ``12.0``).
    """
    b = _c(bytes_col).cast("double")
    kib = 1024.0
    mib = kib * kib

    def fmt(v, unit):
        return F.concat(F.round(v, 0).cast("bigint").cast("string"), F.lit(" " + unit))

    return (
        F.when(b < mib, fmt(b / kib, "KB"))
        .when(b < mib * kib, fmt(b / kib / kib, "MB"))
        .otherwise(fmt(b / kib / kib / kib, "GB"))
    )


def one_line(col) -> Column:
    """Line breaks replaced by single spaces (free-text columns bound for flat files)."""
    return F.regexp_replace(_c(col), r"[\r\n]+", " ")


def dots_to_spaces(col) -> Column:
    """``first.last`` user names to ``first last``."""
    return F.regexp_replace(_c(col), r"\.", " ")


def right(col, n: int) -> Column:
    """Last ``n`` characters (``RIGHT``), e.g. a two-digit year."""
    return F.right(_c(col), F.lit(n))

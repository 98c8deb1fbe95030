"""Key conventions: hash surrogate keys, composite keys, unknown member, date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text whose hash stands for "unknown member" in every dimension.
UNKNOWN_MEMBER_TEXT = "INDETERMINADO"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def hash_key(col) -> Column:
    """SHA-256 hex of the value's text form (surrogate key of one business key)."""
    return F.sha2(_c(col).cast("string"), 256)


def composite_key(*cols, sep: str | None = "|") -> Column:
    """SHA-256 hex over several parts.

    ``sep=None`` concatenates without a separator (the legacy form, where
    ``('ab','c')`` and ``('a','bc')`` collide); the default keeps parts apart.
    Any NULL part makes the key NULL, as with plain concatenation.
    """
    parts = [_c(c).cast("string") for c in cols]
    if sep is None:
        text = F.concat(*parts)
    else:
        text = parts[0]
        for p in parts[1:]:
            text = F.concat(text, F.lit(sep), p)
    return F.sha2(text, 256)


def unknown_member_key() -> Column:
    """Surrogate key of the unknown member."""
    return F.sha2(F.lit(UNKNOWN_MEMBER_TEXT), 256)


def with_unknown(sk) -> Column:
    """Replace a missing surrogate key by the unknown-member key."""
    return F.coalesce(_c(sk), unknown_member_key())


def date_key(col) -> Column:
    """``yyyymmdd`` integer key of a date/timestamp column."""
    return F.date_format(_c(col), "yyyyMMdd").cast("int")

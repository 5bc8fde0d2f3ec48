"""Scalar column expressions shared by the operators.

Everything here returns a `Column` made of built-in functions, so it stays
inside whole-stage codegen; nothing is a Python UDF.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_", "classify", "distinct_count", "pattern_class", "url_host", "host_pattern_class", "season_year", "safe_ratio", "slot",
    "activity_word", "word_bits", "stable_bucket", "attrs_struct", "ts_parse",
    "domain_match", "DEFAULT_REFERRER_PATTERNS", "LAST7_MASK", "PREV7_MASK", "WORD_MASK",
]

# Masks over the 32-day activity word, bit 31 = the as-of day.
WORD_MASK = 0xFFFFFFFF
LAST7_MASK = 0xFE000000   # days 0..6 back
PREV7_MASK = 0x01FC0000   # days 7..13 back

# Referrer patterns, first match wins; unmatched keep the raw value.
DEFAULT_REFERRER_PATTERNS: tuple[tuple[str, str], ...] = (
    ("%linkedin%", "Linkedin"),
    ("%t.co%", "Twitter"),
    ("%google%", "Google"),
    ("%lnkd%", "Linkedin"),
)


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def classify(value, thresholds: Sequence[tuple[float, str]], default: str) -> Column:
    """First threshold strictly exceeded wins (thresholds descending)."""
    v = col_(value)
    expr = None
    for bound, label in thresholds:
        expr = F.when(v > F.lit(bound), F.lit(label)) if expr is None else expr.when(v > F.lit(bound), F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def pattern_class(value, patterns: Sequence[tuple[str, str]] = DEFAULT_REFERRER_PATTERNS,
                  default=None) -> Column:
    """LIKE patterns in order, first match wins; default is the value itself."""
    v = col_(value)
    expr = None
    for pat, label in patterns:
        cond = v.like(pat)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    fallback = v if default is None else F.lit(default)
    return fallback if expr is None else expr.otherwise(fallback)


def url_host(url) -> Column:
    """H3: host part of a URL ('https://a.b/c' -> 'a.b') by split and item."""
    return F.lower(F.split(col_(url), "/").getItem(2))


def host_pattern_class(url, patterns: Sequence[tuple[str, str]], default=None) -> Column:
    """Like `pattern_class`, but each pattern's text ('%t.co%' -> 't.co') must
    be whole dot-separated labels of the URL's host, so 't.co' matches 't.co'
    and 'x.t.co' but not 'microsoft.com'. Unmatched rows keep the URL."""
    host = url_host(url)
    expr = None
    for pat, label in patterns:
        token = pat.strip("%")
        cond = host.rlike(r"(^|\.)" + re.escape(token) + r"(\.|$)")
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    fallback = col_(url) if default is None else F.lit(default)
    return fallback if expr is None else expr.otherwise(fallback)


def distinct_count(c, approx: bool = False, rsd: float = 0.01) -> Column:
    """Exact distinct count, or HyperLogLog++ with relative error `rsd`
    (fixed-size state per group: no per-group set of values)."""
    return F.approx_count_distinct(col_(c), rsd) if approx else F.count_distinct(col_(c))


def season_year(date, start_month: int = 10) -> Column:
    """H5: season label; a season starting in `start_month` belongs to that year."""
    d = col_(date)
    return F.when(F.month(d) >= start_month, F.year(d)).otherwise(F.year(d) - 1).cast("int")


def safe_ratio(num, den) -> Column:
    """Num / den as double, NULL when den is 0 or NULL (ANSI-safe)."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def slot(arr, i: int) -> Column:
    """0-based array element, NULL when out of range (ANSI-safe `get`)."""
    return F.get(col_(arr), F.lit(i))


def activity_word(dates: str, as_of) -> Column:
    """32-bit activity word over an array-of-dates column.

    Bit 31 is the as-of day, bit 0 is 31 days back; dates outside 0..31 days
    back are ignored, duplicates count once. A fold over the (small, bounded)
    per-row array replaces the reference's cross join with a date series.
    `as_of` is a date / ISO string (a run parameter) or a column name.
    """
    if isinstance(as_of, datetime.datetime):
        as_of = as_of.date()
    if isinstance(as_of, (datetime.date, str)) and _is_iso(str(as_of)):
        a = f"DATE'{as_of}'"
    else:
        a = f"`{as_of}`"
    return F.expr(
        f"aggregate(array_distinct(`{dates}`), 0L, (acc, x) -> acc + "
        f"IF(datediff({a}, x) BETWEEN 0 AND 31, shiftleft(1L, 31 - datediff({a}, x)), 0L))")


def _is_iso(s: str) -> bool:
    return re.fullmatch(r"\d{4}-\d{2}-\d{2}", s) is not None


def word_bits(word, mask: int = WORD_MASK) -> Column:
    """Number of active days selected by `mask`."""
    return F.bit_count(col_(word).bitwiseAND(F.lit(mask).cast("long"))).cast("int")


def stable_bucket(id_col, salt: str, modulus: int = 10000) -> Column:
    """Deterministic bucket of an id, independent per experiment name: the first 32 bits of
    md5(salt:id), so any engine can assign the same bucket."""
    digest = F.md5(F.concat(F.lit(salt + ":"), col_(id_col).cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(modulus))


def attrs_struct(attrs: Sequence[str]) -> Column:
    """Struct of tracked attributes, compared null-safely as one value."""
    return F.struct(*[F.col(a) for a in attrs])


def ts_parse(value, pattern: str = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'") -> Column:
    """H8: parse with a pattern, NULL (not an error) on malformed input."""
    return F.try_to_timestamp(col_(value), F.lit(pattern))


def domain_match(host, domain: str) -> Column:
    """H2: host equals the domain or is one of its subdomains."""
    h = F.lower(col_(host))
    d = domain.lower()
    return (h == F.lit(d)) | h.endswith("." + d)

"""Column builders. All of them stay inside Catalyst expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Python's str.strip/str.split see it. The same class is valid in
# Java regular expressions and in RE2.
WHITESPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"

# Decimal literals accepted as a number; hexadecimal and type suffixes are not.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INFINITE = r"^(?i)[+-]?inf(inity)?$"


# The same class as single characters, for ``trim``.
WHITESPACE_CHARS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip_ws(c: Column) -> Column:
    """Strip every kind of whitespace (plain SQL ``trim`` removes U+0020 only)."""
    return F.trim(c, F.lit(WHITESPACE_CHARS))


def parse_number(text: Column) -> Column:
    """Number held by an already stripped text, else null; never raises."""
    return F.when(text.rlike(NUMBER), text.try_cast("double")).when(
        text.rlike(INFINITE),
        F.when(text.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))),
    )


def clamp_negative(c: Column, to: str) -> Column:
    """Negatives become 0 and nulls stay null; values that do not cast become null."""
    number = c.try_cast(to)
    return F.when(number < 0, F.lit(0).cast(to)).otherwise(number)


def cut(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(edges[i], edges[i+1]]``; outside all bins -> null."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    inside = (c > F.lit(edges[0])) & (c <= F.lit(edges[-1]))
    out = F.when(~inside | c.isNull(), F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        out = out.when(c <= F.lit(upper), F.lit(label))
    return out


def ratio(a: Column, b: Column) -> Column:
    """``a / b`` as double, null where ``b`` is zero or missing."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def finite_or_null(c: Column) -> Column:
    bad = F.isnan(c) | c.isin(float("inf"), float("-inf"))
    return F.when(~bad, c)


def risk_level(p: Column) -> Column:
    return F.when(p >= 0.7, "High").when(p >= 0.4, "Medium").when(p.isNotNull(), "Low")


def fixed(c: Column, digits: int = 0, grouped: bool = False) -> Column:
    """Fixed-point text as Python's ``f`` format: the double's exact value is rounded, exact halves to even; null stays null.

    ``format_string`` would round the shortest decimal text half up and write a null as text. From about 1e15 on digits
    that the shortest decimal text does not have are zeros.
    """
    number = c.cast("double")
    shown = F.call_function("format_number", number, F.lit(("#,##0" if grouped else "0") + ("." + "0" * digits if digits else "")))
    infinite = F.when(number > 0, "inf").otherwise("-inf")
    return F.when(F.isnan(number), "nan").when(F.abs(number) == float("inf"), infinite).otherwise(shown)


def as_percent(c: Column, digits: int = 1) -> Column:
    return F.concat(fixed(c.cast("double") * 100.0, digits), F.lit("%"))


def format_money(c: Column, symbol: str = "₹") -> Column:
    return F.concat(F.lit(symbol), fixed(c, grouped=True))

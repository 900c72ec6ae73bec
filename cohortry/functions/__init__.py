from cohortry.functions.scalars import (
    as_percent,
    clamp_negative,
    cut,
    finite_or_null,
    fixed,
    format_money,
    parse_number,
    ratio,
    risk_level,
    strip_ws,
)
from cohortry.functions.tails import chi2_sf, f_sf, normal_two_sided, normal_upper, t_two_sided
from cohortry.functions.tokens import ngram_terms, split_words

__all__ = [
    "as_percent",
    "chi2_sf",
    "clamp_negative",
    "cut",
    "f_sf",
    "fixed",
    "finite_or_null",
    "format_money",
    "ngram_terms",
    "normal_two_sided",
    "normal_upper",
    "parse_number",
    "ratio",
    "risk_level",
    "split_words",
    "strip_ws",
    "t_two_sided",
]

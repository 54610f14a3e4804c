"""Text expressions: white space, folding and tokens as Unicode defines them, inside code generation.

Java's `trim` and ASCII classes miss signs that Unicode calls white space, letters and digits, so the classes are
spelled out. `fold` is exact for all but the rare letters whose full case folding is neither their lower case nor
"ss"; `exact_fold` is the slow, exact form.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Unicode calls white space.
SPACES = r"\s\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: A letter, digit or underscore.
WORD_SIGN = r"[\p{L}\p{N}_]"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{SPACES}]+|[{SPACES}]+$", "")


def is_blank(c: Column) -> Column:
    """True for null and for texts of white space alone."""
    return ~F.coalesce(F.regexp_like(c, F.lit(f"[^{SPACES}]")), F.lit(False))


def blank_to_null(c: Column) -> Column:
    """Null for a text of white space alone; any other text stays as it is."""
    return F.when(~is_blank(c), c)


def fold(c: Column) -> Column:
    return F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit("ß"), F.lit("ss"))


def exact_fold(c: Column) -> Column:
    """Full case folding by an Arrow UDF."""
    @F.pandas_udf("string")
    def folded(s: pd.Series) -> pd.Series:
        return s.fillna("").str.casefold()

    return folded(c)


def pieces(c: Column) -> Column:
    """What stands between white space; no empty pieces."""
    return F.filter(F.split(c, f"[{SPACES}]+"), lambda t: t != "")


def squeeze(c: Column) -> Column:
    """One blank for each run of white space, none at the ends."""
    return F.array_join(pieces(c), " ")


def word_tokens(c: Column) -> Column:
    """Distinct runs of letters, digits and underscores."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(f"({WORD_SIGN}+)"), 1))


def number_tokens(c: Column) -> Column:
    """Distinct digits with at most one a to z after them, standing alone."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(rf"(?<!{WORD_SIGN})(\p{{Nd}}+[a-z]?)(?!{WORD_SIGN})"), 1))


def has_digit(c: Column) -> Column:
    return F.coalesce(F.regexp_like(c, F.lit(r"\p{Nd}")), F.lit(False))

"""String expressions of the reports; all built-in, all inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def icontains(col: Column, text: str) -> Column:
    """Case-insensitive `contains`; `text` may hold further wildcards."""
    return col.ilike(f"%{text}%")


def key_after(col: Column, marker: str = "Key") -> Column:
    """What follows the first `marker`, without surrounding blanks and brackets; '' if none."""
    return F.btrim(F.split_part(col, F.lit(marker), F.lit(2)), F.lit(" []"))


def short_pair_name(col: Column) -> Column:
    """First five characters, ' & ', and five characters from two places past the '&'."""
    tail = F.substr(col, F.position(F.lit("&"), col) + F.lit(2), F.lit(5))
    return F.concat(F.left(col, F.lit(5)), F.lit(" & "), tail)

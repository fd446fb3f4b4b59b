"""Text folds without Python: translate for composed letters, a pattern for loose marks."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache
def _composed() -> tuple[str, str]:
    """Letters of the Latin blocks that decompose into a base letter and marks, and those base letters."""
    source, target = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = "".join(c for c in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(c) != "Mn")
        if base != chr(code) and len(base) == 1:
            source.append(chr(code))
            target.append(base)
    return "".join(source), "".join(target)


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapsed(text: Column) -> Column:
    """Runs of any white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def strip_marks(text: Column, d_stroke: bool = True) -> Column:
    """Without accents; ``d_stroke``: also đ to d. Texts of ASCII alone have none and skip the long tables."""
    source, target = _composed()
    if d_stroke:
        source, target = source + "đĐ", target + "dD"
    return F.when(F.octet_length(text) > F.length(text), F.regexp_replace(F.translate(text, source, target), r"\p{Mn}+", "")).otherwise(text)


def folded(text: Column) -> Column:
    """Lower case, trimmed, without accents."""
    return strip_marks(trimmed(F.lower(text)))


def identity_text(text: Column) -> Column:
    """``folded``, and all but letters and digits of ASCII become single spaces."""
    return F.trim(F.regexp_replace(folded(F.coalesce(text, F.lit(""))), r"[^a-z0-9]+", " "))


def taxonomy_text(text: Column) -> Column:
    """Folded and collapsed."""
    return collapsed(strip_marks(F.lower(F.coalesce(text, F.lit("")))))


def category_text(text: Column) -> Column:
    """Lower case and collapsed, accents kept."""
    return collapsed(F.lower(text))


def first_non_empty(*values: Column) -> Column:
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])

"""Finding and masking personal data in free text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import PATTERNS, col_of


def scan(df: DataFrame, text: str, kinds=("ssn", "email", "phone")) -> DataFrame:
    """Number of matches of each kind in the whole text, as ``n_<kind>``."""
    return df.withColumns({f"n_{k}": F.regexp_count(text, F.lit(PATTERNS[k])) for k in kinds})


def mask_text(text: Column | str, kinds=("ssn", "email", "phone")) -> Column:
    out = col_of(text)
    for kind in kinds:
        out = F.regexp_replace(out, PATTERNS[kind], f"[{kind.upper()}]")
    return out

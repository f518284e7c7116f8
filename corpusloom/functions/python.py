"""Folding of accents. Titles are folded in the JVM; only the general fold needs Python, Arrow-batched."""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T


@F.pandas_udf(T.StringType())
def fold_accents(s: pd.Series) -> pd.Series:
    """Canonical decomposition without combining marks (FN11)."""
    return s.map(lambda t: None if t is None else "".join(ch for ch in unicodedata.normalize("NFD", t) if unicodedata.category(ch) != "Mn"))


@functools.cache
def folding() -> tuple[str, str]:
    """Every character whose canonical decomposition is one ASCII letter or digit with marks, and that letter or digit."""
    pairs = []
    for code in range(128, 0x30000):
        if 0xD800 <= code < 0xE000:
            continue
        base = [ch for ch in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(ch) != "Mn"]
        if len(base) == 1 and base[0].isascii() and base[0].isalnum():
            pairs.append((chr(code), base[0]))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def folded_title(c: Column | str) -> Column:
    """Accents folded, letters and digits only, lower case; null is empty (FN11). A mark by itself goes with all else that is
    no letter or digit, so a character table in the JVM says the same as the decomposition."""
    marked, plain = folding()
    return F.coalesce(F.regexp_replace(F.lower(F.translate(c, marked, plain)), "[^a-z0-9]+", ""), F.lit(""))

"""Matching of registry fragments against URLs and paths."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

MOST_LITERALS = 65_536
MOST_BYTES = 32_000_000
FEW = 16
HEAD = 24
#: The automaton of this worker, kept from task to task, by a digest of its fragments.
_KEPT: dict[str, Fragments] = {}


def needles(entries: DataFrame, entry: str = "entry") -> DataFrame:
    """Fragments without leading dollar signs; blank ones match nothing (FN29)."""
    return entries.select(entry, F.ltrim(F.col(entry), F.lit("$")).alias("needle")).where("needle <> ''")


class Fragments:
    """Many fragments as one automaton over their first characters; a hit is verified by the whole fragment, so the automaton
    stays small however long the fragments are."""

    def __init__(self, fragments: list[str]):
        heads: dict[str, list[str]] = {}
        for f in fragments:
            heads.setdefault(f[:HEAD], []).append(f)
        self.found = ahocorasick.Automaton()
        for head, whole in heads.items():
            self.found.add_word(head, (len(head), whole))
        self.found.make_automaton()

    def within(self, text: str) -> Iterator[str]:
        for end, (size, whole) in self.found.iter(text):
            for f in whole:
                if text.startswith(f, end - size + 1):
                    yield f

    @staticmethod
    def kept(name: str, fragments: list[str]) -> Fragments:
        if name not in _KEPT:
            _KEPT.clear()
            _KEPT[name] = Fragments(fragments)
        return _KEPT[name]


def _sent(df: DataFrame, fragments: list[str]):
    """(name of the fragments, broadcast of the fragments): at most ``MOST_LITERALS`` and ``MOST_BYTES``, once an executor."""
    name = hashlib.sha256("\n".join(fragments).encode()).hexdigest()
    return name, df.sparkSession.sparkContext.broadcast(fragments)


def _any(df: DataFrame, fragments: list[str], text: Column) -> Column:
    """Is any fragment in the text? Few are tested as literals in the JVM. Of many, one automaton scans each text once, whatever
    their number, in Arrow batches: testing each fragment by itself would read every text as often as there are fragments."""
    if len(fragments) <= FEW:
        out = F.lit(False)
        for f in fragments:
            out = out | F.coalesce(F.contains(text, F.lit(f)), F.lit(False))
        return out
    name, shared = _sent(df, fragments)

    @F.pandas_udf(T.BooleanType())
    def scan(texts: pd.Series) -> pd.Series:
        own = Fragments.kept(name, shared.value)
        return pd.Series([t is not None and next(own.within(t), None) is not None for t in texts], dtype=bool)

    return scan(text)


def _fragments(entries: DataFrame, entry: str) -> list[str]:
    """The distinct fragments, counted and measured before they are collected."""
    some = needles(entries, entry).select("needle").distinct()
    size = some.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("needle")), F.lit(0)).alias("b")).first()
    if size["n"] > MOST_LITERALS or size["b"] > MOST_BYTES:
        raise ValueError(f"a registry of {size['n']} fragments and {size['b']} bytes; {MOST_LITERALS} and {MOST_BYTES} are sent to the executors at most: match it in parts")
    return sorted(r["needle"] for r in some.collect())


def flagged(df: DataFrame, entries: DataFrame, haystacks: list[Column | str], entry: str = "entry", name: str = "affiliated") -> DataFrame:
    """Is any fragment part of any haystack (FI1, JN5)? One scan without a join or shuffle; the fragments are counted first, and
    more than 65,536 of them or 32 MB are refused rather than collected."""
    found = _fragments(entries, entry)
    test = F.lit(False)
    for h in haystacks if found else []:
        test = test | _any(df, found, F.col(h) if isinstance(h, str) else h)
    return df.withColumn(name, test)


def suffix_flagged(df: DataFrame, entries: DataFrame, columns: list[str], entry: str = "entry", name: str = "affiliated") -> DataFrame:
    """Flag rows one of whose URLs ends in a fragment of whole segments, so ``1.pdf`` isn't found in ``Vol11.pdf`` (FI2, UP3). A fragment with n slashes is joined by equality with the last
    n + 1 segments; only the numbers of slashes that occur are collected, and each costs a join."""
    keys = entries.select(F.col(entry).alias("_key")).where("_key <> ''").distinct()
    slashes = F.length("_key") - F.length(F.replace(F.col("_key"), F.lit("/")))
    depths = {r["n"] for r in keys.where("instr(_key, '/') > 0").select(slashes.alias("n")).distinct().collect()}
    hit = None
    out = df
    used = []
    for n in sorted({0} | depths):
        for c in columns:
            k = f"_k{len(used)}"
            mark = keys.where(slashes == n).select(F.col("_key").alias(k))
            out = out.join(mark, F.substring_index(F.col(c), "/", -(n + 1)) == F.col(k), "left")
            hit = F.col(k).isNotNull() if hit is None else hit | F.col(k).isNotNull()
            used.append(k)
    return out.withColumn(name, hit).drop(*used)


def unmatched_entries(entries: DataFrame, df: DataFrame, haystack: str, entry: str = "entry") -> DataFrame:
    """Fragments that no haystack holds (JN12). Each partition reports those it has seen, once each, and what nobody reports is
    unmatched; no pair of row and fragment is built."""
    found = _fragments(entries, entry)
    keyed = entries.select(entry, F.ltrim(F.col(entry), F.lit("$")).alias("needle"))
    if not found:
        return keyed.select(entry)

    name, shared = _sent(df, found)

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, seen = Fragments.kept(name, shared.value), set()
        for f in frames:
            for t in f["hay"]:
                if t is not None:
                    seen.update(own.within(t))
        yield pd.DataFrame({"needle": sorted(seen)}, dtype="object")

    seen = df.select(F.col(haystack).alias("hay")).mapInPandas(scan, "needle string").distinct()
    return keyed.join(seen, "needle", "left_anti").select(entry)

"""Language identification by rank-order n-gram profiles (operator 1)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from corpusloom.llm.arrow import rows_of
from corpusloom.llm.common import crc_of_id, load

TOP = 300
PER_LANGUAGE = 1500
MOST_LANGUAGES = 2000
PIECE = 1 << 20
EDGE = 1
_TABLE: list[np.ndarray] = []


def _letters(points: np.ndarray) -> np.ndarray:
    """Lower-cased code points of letters, 0 for all else."""
    if not _TABLE:
        low = np.zeros(1 << 16, np.int64)
        for c in range(1 << 16):
            if chr(c).isalpha():
                low[c] = ord(chr(c).lower()[0])
        _TABLE.append(low)
    out = _TABLE[0][np.minimum(points, (1 << 16) - 1)]
    far = np.flatnonzero(points >= 1 << 16)
    for i in far.tolist():
        c = chr(points[i])
        out[i] = ord(c.lower()[0]) if c.isalpha() else 0
    return out


def grams(offsets: np.ndarray, data: np.ndarray) -> list[np.ndarray]:
    """For each text the codes of all its 1- to 3-grams with repeats: letters in lower case, words with an edge on both sides."""
    n = len(offsets) - 1
    text = data.tobytes()
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    raw = text.decode("utf-8", "replace")
    if len(raw) != starts[-1]:  # not UTF-8: text by text
        parts = [text[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
        raw, starts = "".join(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    points = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)
    a = np.zeros(len(points) + n + 1, np.int64)
    row = np.repeat(np.arange(n), np.diff(starts))
    a[np.arange(len(points)) + row + 1] = _letters(points)
    owner = np.full(len(a), -1, np.int64)
    owner[np.arange(len(points)) + row + 1] = row
    keep = a != 0
    keep[1:] |= a[:-1] != 0
    keep[0] = True
    a, owner = a[keep], owner[keep]
    letter = a != 0
    owner = np.where(letter, owner, -1)
    a = np.where(letter, a, EDGE)
    two = (a[:-1] << 21) | a[1:]
    three = (a[:-2] << 42) | (a[1:-1] << 21) | a[2:]
    middle = owner[1:-1] >= 0
    codes = (a[letter], two, three[middle])
    rows = (owner[letter], np.maximum(owner[:-1], owner[1:]), owner[1:-1][middle])
    cuts = [np.searchsorted(r, np.arange(n + 1)) for r in rows]
    return [np.concatenate([c[k[i] : k[i + 1]] for c, k in zip(codes, cuts)]) for i in range(n)]


def ranked(codes: np.ndarray, top: int) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    return _top(*_counted(codes), top)


def _top(found: np.ndarray, count: np.ndarray, top: int) -> np.ndarray:
    order = np.lexsort((found, -count)) if len(found) <= 4 * top else _leading(found, count, top)
    return found[order[:top]]


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(codes)
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.diff(np.append(first, len(codes)))


def _leading(found: np.ndarray, count: np.ndarray, top: int) -> np.ndarray:
    least = np.partition(count, len(count) - top)[len(count) - top]
    some = np.flatnonzero(count >= least)
    return some[np.lexsort((found[some], -count[some]))]


def _around(data: np.ndarray, at: int) -> tuple[int, int]:
    """Where the three characters before and after a place between characters begin and end."""
    left = right = at
    for _ in range(3):
        left = max(left - 1, 0)
        while left > 0 and data[left] & 0xC0 == 0x80:
            left -= 1
        right = min(right + 1, len(data))
        while right < len(data) and data[right] & 0xC0 == 0x80:
            right += 1
    return left, right


def _one(data: np.ndarray) -> np.ndarray:
    return grams(np.array([0, len(data)], np.int64), data)[0]


def counts_of_long(data: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of one long text and their counts, piece by piece. A piece ends where an ASCII character that is no letter stands, if
    there is one within another half of it: no n-gram reaches across. Else it ends after any character, and the n-grams
    of the three characters on both sides, together less apart, set right what the cut has changed. So the counts are
    those of the whole, whatever the script."""
    found, count, at = np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def add(codes: np.ndarray, sign: int) -> None:
        nonlocal found, count
        f, n = _counted(codes)
        both, place = np.unique(np.concatenate([found, f]), return_inverse=True)
        found, count = both, np.bincount(place, np.concatenate([count, sign * n]), len(both)).astype(np.int64)

    while at < len(data):
        end = min(at + piece, len(data))
        near = data[end : end + piece // 2]
        gap = np.flatnonzero((near < 65) | ((near > 90) & (near < 97)) | ((near > 122) & (near < 128)))
        if end < len(data) and len(gap):
            end += int(gap[0]) + 1
        else:
            while end < len(data) and data[end] & 0xC0 == 0x80:
                end += 1
        add(_one(data[at:end]), 1)
        if end < len(data):
            left, right = _around(data, end)
            add(_one(data[left:right]), 1)
            add(_one(data[left:end]), -1)
            add(_one(data[end:right]), -1)
        at = end
    return found[count > 0], count[count > 0]


def _counts(lang: str, found: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int64()), pa.array(count, pa.int64())], ["lang", "code", "n"])


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams of each language with their counts, given out whenever a few million have been gathered."""
    for batch in batches:
        by: dict[str, list[np.ndarray]] = {}
        held = 0
        for part, off, data in rows_of(batch, PIECE):
            langs = part.column(part.schema.get_field_index("lang")).to_pylist()
            if len(data) > 2 * PIECE:  # one long text
                yield _counts(langs[0], *counts_of_long(data))
                continue
            for lang, codes in zip(langs, grams(off, data)):
                by.setdefault(lang, []).append(codes)
                held += len(codes)
            if held > 4 * PIECE:
                yield from (_counts(k, *_counted(np.concatenate(c))) for k, c in by.items())
                by, held = {}, 0
        yield from (_counts(k, *_counted(np.concatenate(c))) for k, c in by.items())


class Profiles:
    """Ranks of the most frequent n-grams of each language, as one table over all codes in any profile."""

    def __init__(self, ranks: dict[str, list[int]], top: int = TOP):
        self.top, self.languages = top, sorted(ranks)
        self.codes = np.array(sorted({c for r in ranks.values() for c in r}), np.int64)
        self.rank = np.full((len(self.languages), len(self.codes) + 1), -1, np.int64)
        for k, lang in enumerate(self.languages):
            self.rank[k, np.searchsorted(self.codes, np.array(ranks[lang], np.int64))] = np.arange(len(ranks[lang]))

    def judge(self, codes: np.ndarray) -> tuple[str, float]:
        """The language of least out-of-place distance and 1 - distance / largest distance, from all n-grams of a text."""
        return self.judge_counts(*_counted(codes))

    def judge_counts(self, found: np.ndarray, count: np.ndarray) -> tuple[str, float]:
        if not len(found) or not self.languages:
            return "und", 0.0
        mine = _top(found, count, self.top)
        at = np.searchsorted(self.codes, mine)
        at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != mine)] = len(self.codes)
        theirs = self.rank[:, at]
        far = np.where(theirs < 0, self.top, np.abs(theirs - np.arange(len(mine)))).sum(axis=1)
        best = int(far.argmin())
        return self.languages[best], float(max(0.0, 1 - far[best] / (self.top * len(mine))))


def fit(labelled: DataFrame, top: int = TOP, per_language: int = PER_LANGUAGE, most_languages: int = MOST_LANGUAGES) -> Profiles:
    """Profiles from ``labelled(text, lang)``: about ``per_language`` different texts a language (all, where it has fewer), chosen by a
    hash of the text among its different texts, so copies neither crowd a sample nor leave a language out.

    Rows with a null text or language teach nothing; without others nothing is learned. Profiles are broadcast, so more than
    ``most_languages`` languages are refused with an error, never cut.
    """
    labelled = labelled.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("text").alias("h"))
    have = labelled.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).limit(most_languages + 1).collect()
    if len(have) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    if not have:
        return Profiles({}, top)
    odds = labelled.sparkSession.createDataFrame([(r["lang"], min(1 << 30, (per_language << 30) // max(r["n"], 1))) for r in have], "lang string, odds long")
    some = labelled.join(F.broadcast(odds), "lang").where(F.pmod(F.xxhash64("h", F.lit(5)), F.lit(1 << 30)) < F.col("odds"))  # a row for each language
    once = some.groupBy("lang", "h").agg(F.first("text").alias("text"))
    counts = once.select("text", "lang").mapInArrow(_counting, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "code"))
    rows = counts.withColumn("place", place).where(F.col("place") <= top).orderBy("lang", "place").collect()  # most_languages x top at most
    ranks: dict[str, list[int]] = {}
    for r in rows:
        ranks.setdefault(r["lang"], []).append(r["code"])
    return Profiles(ranks, top)


def _judging(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = shared.value
        for batch in batches:
            for part, off, data in rows_of(batch, PIECE):
                said = [profiles.judge_counts(*counts_of_long(data))] if len(data) > 2 * PIECE else [profiles.judge(codes) for codes in grams(off, data)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([x for x, _ in said], pa.string()), pa.array([y for _, y in said], pa.float64())], [*part.schema.names, "lang_pred", "score"])

    return run


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``docs`` with lang_pred and score from the whole text: no shuffle, one pass.

    ``und`` and 0 where the text is null or has no letters, or where nothing could be learned. Columns lang_pred and
    score of ``docs`` are replaced, others stay; repeated rows keep a result each; ties go to the first language by code point.
    An empty table gives an empty one. Texts of more than 2 MB are counted in pieces of 1 MB.
    """
    docs = docs.drop("lang_pred", "score")
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(_judging(docs.sparkSession.sparkContext.broadcast(profiles)), f"{shape}, lang_pred string, score double")


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; learned from rows that aren't held out."""
    docs = load(spark, sf_dir, "documents")
    held = F.pmod(crc_of_id(), F.lit(4)) == 2
    profiles = fit(docs.where(~held).select("text", "lang"))
    return identify(docs.select("doc_id", held.alias("held_out"), "text"), profiles).select("doc_id", "held_out", "lang_pred", "score")

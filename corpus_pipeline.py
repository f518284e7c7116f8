"""From ``documents`` to balanced shards: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import decontamination, language_id, mixing, sharding, simhash
from corpusloom.llm.common import freed, load, mark, set_aside, stored


#: A text whose n-grams lie further than this from every profile is in none of the languages. The lowest score of any
#: document of the test tables is 0.36, that of text in another script 0.
LEAST_SCORE = 0.1


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID learns from the rows that name a language and rejects documents in no known language: null texts, texts
    without a letter, and texts unlike all profiles. Profiles come from ``docs`` itself; the language that a row names isn't compared
    with the prediction. Null ids and sources and repeated rows stay as they are, columns of any name too; where no row names
    a language, nothing is known and all rows go. Empty in, empty out."""
    docs, names = set_aside(docs, "lang_pred", "score")
    said = language_id.identify(docs, language_id.fit(docs.select("text", "lang")))
    return said.where((said.lang_pred != "und") & (said.score >= LEAST_SCORE)).select(*names)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup keeps the document with the smallest doc_id of each group; a null doc_id only where all of a group are
    null. Of rows alike in doc_id and text one stays, of an id that repeats with texts of different groups one for each
    group. Null texts and texts without words are one group. Other columns stay, whatever their names. Empty in, empty out."""
    return simhash.deduplicated(docs)


def no_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decontamination drops each document in which a window of 10 words of a benchmark text occurs (a whole test text, if it has
    fewer). Null and wordless texts have no windows and stay; repeated rows go or stay together; a test text without an id counts.
    Other columns stay, whatever their names. Empty in, empty out."""
    docs, names = set_aside(docs, "n_words", "spans", "items", "_row")
    return decontamination.hits(docs, load(spark, sf_dir, "benchmark"), keep_text=True).where("size(spans) = 0").select(*names)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing copies each document as often as its source's target asks: none, once, or up to three times. A null source is a source
    of its own; a text that is null or has no words weighs nothing, and is kept as often as the whole part of its source's
    ratio says; rows alike in id, source and text share their number of copies. All columns stay. Empty in, empty out."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sharding gives each row of the mix, with all its columns, one of 40 shards of near equal bytes and its slot there. Copies of a
    row are rows of their own; null ids come first; a null text counts 16 bytes. Empty in, empty out."""
    return sharding.sharded(docs, 40)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language), ("simhash_dedup", one_of_each), ("decontamination", no_leaks), ("mixing", mix), ("sharding", shard)]

#: SQL can't express the profiles, the fingerprints of all shingles or the random pairing; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = load(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        since = mark() - (1 if k else 0)
        docs = stored(stage(spark, docs, sf_dir), name)
        freed(since, but=1)  # what the stage has read and made on its way
    return STAGES[-1][1](spark, docs, sf_dir)

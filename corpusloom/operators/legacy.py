"""Corrections, imports and triage of catalogue tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusloom.functions.python import folded_title
from corpusloom.functions.text import clean, filled, ordered_patch, path_name, py_strip, stem, title_case, url_basename
from corpusloom.operators.identity import keep_filled
from corpusloom.operators.registry import suffix_flagged
from corpusloom.schemas import CLASSIFIED_COLUMNS, INDEX_COLUMNS
from corpusloom.settings import Settings


@dataclass(frozen=True)
class JournalRule:
    wrong: str
    url_part: str
    right: str


def patched(df: DataFrame, journals: list[JournalRule], authors: list[tuple[str, str]], entries: DataFrame | None = None) -> DataFrame:
    """Journal rules in order (each sees the journals that the ones before have set), author rules, flags by file name (UP1-UP3)."""
    journal = F.col("journal")
    for r in journals:
        journal = F.when((journal == r.wrong) & F.coalesce(F.contains("url", F.lit(r.url_part)), F.lit(False)), F.lit(r.right)).otherwise(journal)
    author = ordered_patch(F.col("author"), [(F.coalesce(F.contains("url", F.lit(part)), F.lit(False)), who) for part, who in authors])
    out = df.withColumn("journal", journal).withColumn("author", author)
    if entries is not None:
        old = F.coalesce(F.col("affiliated").cast("boolean"), F.lit(False)) if "affiliated" in df.columns else F.lit(False)
        out = suffix_flagged(out.withColumn("_old", old).drop("affiliated"), entries, [c for c in ("url", "mirror_url") if c in df.columns], name="_hit")
        out = out.withColumn("affiliated", F.col("_old") | F.col("_hit")).drop("_old", "_hit")
    return out


def patch_counts(df: DataFrame, journals: list[JournalRule], authors: list[tuple[str, str]]) -> DataFrame:
    """Rows that each rule changes, one scan; a row may count for several (AG16)."""
    journal, sums = F.col("journal"), []
    for i, r in enumerate(journals):
        hit = (journal == r.wrong) & F.coalesce(F.contains("url", F.lit(r.url_part)), F.lit(False))
        sums.append(F.count_if(hit).alias(f"journal_{i}"))
        journal = F.when(hit, F.lit(r.right)).otherwise(journal)
    sums += [F.count_if(F.coalesce(F.contains("url", F.lit(part)), F.lit(False))).alias(f"author_{i}") for i, (part, _) in enumerate(authors)]
    return df.agg(*sums)


def flag_mirrored(df: DataFrame, token: str) -> DataFrame:
    """Flag rows whose mirror URL names the institution (UP4)."""
    return df.withColumn("affiliated", F.when(F.contains(F.coalesce("mirror_url", F.lit("")), F.lit(token)), "true").otherwise(F.col("affiliated")))


def object_key(url: Column, mirror: Column, buckets: tuple[str, str] = ("main", "other")) -> Column:
    """Key of the stored copy: by the URL in the first bucket, else by the mirror in the second, else empty (PR20)."""
    u, m = clean(url), clean(mirror)
    return F.when(u != "", F.concat(F.lit(f"{buckets[0]}/"), path_name(u))).when(m != "", F.concat(F.lit(f"{buckets[1]}/"), path_name(m))).otherwise("")


def migrated(df: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Ten columns to fourteen (PR21)."""
    s = settings or Settings()
    have = [F.col(c) if c in df.columns else F.lit("").alias(c) for c in CLASSIFIED_COLUMNS if c != "affiliated"]
    flag = F.when(F.lower(clean("affiliated")) == "true", "true").otherwise("false") if "affiliated" in df.columns else F.lit("false")
    return df.select(*have, flag.alias("affiliated"), F.lit("pdf").alias("entry_type"), F.lit(s.portal_label).alias("source"), object_key(F.col("url"), F.col("mirror_url"), s.buckets).alias("object_key"), F.lit("false").alias("object_synced")).select(*INDEX_COLUMNS)


def migration_counts(index: DataFrame) -> DataFrame:
    flag = F.col("affiliated") == "true"
    return index.agg(F.count("*").alias("rows"), F.count_if(flag).alias("flagged"), F.count_if(flag & (clean("url") == "")).alias("flagged_without_url"), F.count_if(F.col("object_key") == "").alias("keyless"))  # AG17


# ---- portal metadata


def issue_id(option: Column, code: str = "jrnl") -> Column:
    """``code_YYYY_VV_II`` from an option like "Year 1999, Volume 34, Issue 2 and 3" (PR24)."""
    part = F.split(option, r"[\s,]+")
    at = lambda i: F.try_element_at(part, F.lit(i))
    number = at(6).try_cast("int")
    issue = F.when(number.isNotNull() & (F.size(part) == 6), F.format_string("%02d", number)).otherwise(F.concat(F.lit("0"), at(6)))
    joined = F.concat(F.format_string("%4d_%02d_", at(2).try_cast("int"), at(4).try_cast("int")), issue)
    for word in ("and", "to", "&"):
        joined = F.replace(joined, F.lit(word), F.lit("-"))
    return F.concat(F.lit(f"{code}_"), joined)


def repaired_url(url: Column, settings: Settings | None = None) -> Column:
    """Give stored files their session segment where it is missing, pad the short volume, end in .pdf (FI22, PR23)."""
    s = settings or Settings()
    bad = F.contains(url, F.lit(s.stored_segment)) & ~F.contains(url, F.lit(s.session_mark))
    fixed = F.replace(F.replace(url, F.lit(f"/{s.stored_segment}"), F.lit(f"{s.session_segment}/{s.stored_segment}")), F.lit(s.short_volume[0]), F.lit(s.short_volume[1]))
    out = F.when(bad, fixed).otherwise(url)
    return F.when(F.lower(out).endswith(".pdf"), out).otherwise(F.concat(out, F.lit(".pdf")))


def with_sizes(df: DataFrame, former: DataFrame, probed: DataFrame | None = None) -> DataFrame:
    """Sizes of an earlier version by URL, else those that were probed (JN13, SC26, UP6)."""
    old = former.groupBy("url").agg(F.first("size_in_kb").alias("_old")) if "ordinal" not in former.columns else former.groupBy("url").agg(F.min_by("size_in_kb", "ordinal").alias("_old"))
    out = df.drop("size_in_kb").join(old, "url", "left")
    if probed is not None:
        out = out.join(probed.select("url", F.expr("bytes div 1024").cast("string").alias("_new")), "url", "left").withColumn("_old", F.coalesce("_old", "_new")).drop("_new")
    return out.withColumnRenamed("_old", "size_in_kb")


def to_download(df: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct URLs whose lower-cased last segment isn't in the index of names (FI24)."""
    return df.select("url").distinct().withColumn("name", F.lower(F.substring_index("url", "/", -1))).join(known, "name", "left_anti")


def target_issues(df: DataFrame, wanted: list[list[str]], column: str = "option") -> DataFrame:
    """Options that hold all words of any wanted issue; all options where none does (FI23)."""
    if not wanted:
        return df
    hit = F.lit(False)
    for words in wanted:
        one = F.lit(True)
        for w in words:
            one = one & F.contains(F.lower(column), F.lit(w.lower()))
        hit = hit | one
    some = df.where(hit)
    return df if some.isEmpty() else some


# ---- classification


#: Titles that are no papers.
NOISE_TITLES = ("contents", "news", "announcements", "book review", "reviews", "volume contents", "office bearers", "title page")


def is_noise(title: Column) -> Column:
    return F.coalesce(F.lower(title).rlike("|".join(NOISE_TITLES)), F.lit(False))  # FI17


def classification_queue(source: DataFrame, classified: DataFrame) -> DataFrame:
    """Rows not yet classified, with heuristic labels for noise titles and null labels for the rest (JN15, FI17-FI19, WN2)."""
    rows = keep_filled(source.withColumn("paper", py_strip("paper")), "url", ["ordinal"])
    done = classified.where("subject is not null and category is not null").select(F.col("journal").alias("_j"), py_strip("paper").alias("_p")).distinct()
    left = rows.join(done, rows.journal.eqNullSafe(done._j) & rows.paper.eqNullSafe(done._p), "left_anti")
    noise = is_noise(F.col("paper"))
    return left.withColumn("subject", F.when(noise, "General")).withColumn("category", F.when(noise, "Other")).withColumn("reasoning", F.when(noise, "Heuristic: no paper"))


def classified_by(queue: DataFrame, classify, columns: str = "journal string, paper string, subject string, category string, reasoning string") -> DataFrame:
    """Run an injected classifier over batches: ``classify`` takes and returns an iterator of frames (SC28)."""
    return queue.where("subject is null").mapInPandas(classify, columns)


def stub_classifier(frames):
    """The default: every paper is General and Other."""
    for f in frames:
        yield f[["journal", "paper"]].assign(subject="General", category="Other", reasoning="default")


def merged_classes(classes: DataFrame, source: DataFrame) -> DataFrame:
    """All source rows with the latest class of their journal and paper; null keys meet null keys (JN14, WN3)."""
    last = classes.groupBy("journal", "paper").agg(F.max_by(F.struct("subject", "category"), "ordinal").alias("c")).select(F.col("journal").alias("_j"), F.col("paper").alias("_p"), "c.subject", "c.category")
    return source.join(last, source.journal.eqNullSafe(last._j) & source.paper.eqNullSafe(last._p), "left").drop("_j", "_p")


# ---- file triage


SKIPPED = ("index.html", "index.md")


def metadata_of_name(name: Column, settings: Settings | None = None) -> Column:
    """(journal, title, author) from a file name: the first of the settings' name rules that fits, else journal Other (PR22).

    A rule is (test, token, journal, form): test ``prefix`` or ``contains``; form ``third`` (the part after the second underscore,
    title-cased, or the stem), ``spaces`` (underscores to spaces), ``cased`` (that in title case), ``tail`` (the token taken out,
    hyphens to spaces, title case)."""
    s = settings or Settings()
    base = stem(name)
    spaced = F.replace(base, F.lit("_"), F.lit(" "))
    third = F.try_element_at(F.split(base, "_", 3), F.lit(3))
    row = lambda journal, title: F.struct(F.lit(journal).alias("journal"), title.alias("title"), F.lit(s.main_author).alias("author"))
    out = row("Other", title_case(F.replace(spaced, F.lit("-"), F.lit(" "))))
    for test, token, journal, form in reversed(s.name_rules):
        fits = F.startswith(base, F.lit(token)) if test == "prefix" else F.contains(F.lower(base), F.lit(token))
        title = {
            "third": F.when(third.isNotNull(), title_case(F.replace(third, F.lit("_"), F.lit(" ")))).otherwise(base), "spaces": spaced, "cased": title_case(spaced),
            "tail": title_case(F.replace(F.replace(base, F.lit(token), F.lit("")), F.lit("-"), F.lit(" ")))}[form]
        out = F.when(fits, row(journal, title)).otherwise(out)
    return out


def triage(files: DataFrame, stored: DataFrame, index: DataFrame, skipped: tuple[str, ...] = SKIPPED) -> DataFrame:
    """Status of each file: skip list, dollar prefix, no PDF, stored, referenced or new, in this order (FI21, JN21, ST6)."""
    have = stored.select("name").distinct().withColumn("_stored", F.lit(True))
    used = index.select(F.explode(F.array(clean("mirror_url"), clean("url"))).alias("u")).where("u <> ''").select(path_name("u").alias("name")).distinct().withColumn("_used", F.lit(True))
    out = files.join(have, "name", "left").join(used, "name", "left")
    status = (F.when(F.col("name").isin(*skipped), "skip list").when(F.startswith("name", F.lit("$")), "dollar prefix").when(~F.lower("name").endswith(".pdf"), "no pdf")
              .when(F.col("_stored"), "stored").when(F.col("_used"), "referenced").otherwise("new"))
    return out.withColumn("status", status).drop("_stored", "_used")


def ingested(triaged: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Index rows for new files (ST7, FN27)."""
    s = settings or Settings()
    m = triaged.where("status = 'new'").withColumn("m", metadata_of_name(F.col("name"), s))
    blank = F.lit("")
    return m.select(F.col("m.journal").alias("journal"), F.col("m.title").alias("paper"), blank.alias("subject"), F.lit(s.ingest_category).alias("category"), F.col("m.author").alias("author"), blank.alias("url"), F.expr("bytes div 1024").cast("string").alias("size_in_kb"), blank.alias("year"),
                    F.concat(F.lit(s.mirror_prefix), "name").alias("mirror_url"), F.lit("true").alias("affiliated"), F.lit("pdf").alias("entry_type"), F.lit("ingest").alias("source"), F.concat(F.lit(f"{s.buckets[1]}/"), "name").alias("object_key"), F.lit("false").alias("object_synced"))


def deduplicated_files(df: DataFrame, host: str) -> DataFrame:
    """One row a file name, rows of ``host`` first; rows without a name stay; the old order returns by ordinal (WN4, SO13)."""
    name = F.substring_index(F.substring_index(F.substring_index(F.coalesce("url", F.lit("")), "/", -1), "?", 1), "#", 1)
    marked = df.withColumn("_name", name).withColumn("_own", F.contains(F.coalesce("url", F.lit("")), F.lit(host)).cast("int"))
    return keep_filled(marked, "_name", [F.desc("_own"), F.col("ordinal")]).drop("_name", "_own")


# ---- import of listings


def import_links(incoming: DataFrame, table: DataFrame, settings: Settings | None = None) -> tuple[DataFrame, DataFrame]:
    """Link listed mirrors to rows of one table, and say what is new (JN18, JN19, UP5, PR27, FI25, ST4).

    ``incoming``: ordinal, part (1 or 2, in reading order), title, url, year, journal, author, size. ``table``: ordinal, paper, url,
    year, mirror_url and more. Each incoming row resolves its target from columns that the import doesn't change: rows of equal
    folded title, of its year if there are any, else without a year, else any; the first by ordinal. Of the incoming rows with
    one target, the first gets the slot if it is blank; the others, and rows without a target, are new entries.
    Returns (table with mirrors filled, new entries).
    """
    s = settings or Settings()
    url = F.when(F.startswith("url", F.lit("../assets/")), F.replace("url", F.lit("../assets/"), F.lit(s.mirror_base))).otherwise(F.col("url"))
    rows = incoming.withColumn("url", url).where("url is not null")
    # the second listing skips what the first or an earlier row of its own has listed; the first adds but never skips
    seen = F.row_number().over(W.partitionBy("url").orderBy("part", "ordinal"))
    rows = rows.withColumn("_seen", seen).where("part = 1 or _seen = 1").drop("_seen")
    rows = rows.join(table.select("url").where("url is not null").distinct(), "url", "left_anti")
    rows = rows.withColumn("_title", folded_title("title"))
    there = table.select(F.col("ordinal").alias("target"), folded_title("paper").alias("_title"), F.substring_index(F.coalesce("year", F.lit("")), ".", 1).alias("_year"), (F.coalesce("mirror_url", F.lit("")) == "").alias("_blank"))
    mirrored = F.contains("url", F.lit(s.mirror_token))
    met = rows.where(mirrored).join(there, "_title")
    rank = F.when((F.col("year") != "") & (F.col("_year") == F.col("year")), 0).when(F.col("_year") == "", 1).otherwise(2)
    best = met.groupBy("part", "ordinal").agg(F.min_by(F.struct("target", "_blank", "url"), F.struct(rank, "target")).alias("t")).select("part", "ordinal", "t.target", F.col("t._blank").alias("_blank"), F.col("t.url").alias("_url"))
    first = F.row_number().over(W.partitionBy("target").orderBy("part", "ordinal"))
    linked = best.where("_blank").withColumn("_n", first).where("_n = 1")
    fill = linked.select(F.col("target").alias("ordinal"), "_url")
    done = table.join(fill, "ordinal", "left").withColumn("mirror_url", F.coalesce(filled("mirror_url"), "_url", F.lit(""))).drop("_url")
    new = rows.join(linked.select("part", "ordinal"), ["part", "ordinal"], "left_anti")
    new = new.select("part", "ordinal", "journal", F.col("title").alias("paper"), "author", "url", F.when(mirrored, F.col("url")).otherwise("").alias("mirror_url"), F.when(F.col("part") == 1, F.lit("0")).otherwise(F.col("size")).alias("size_in_kb"), "year")
    return done, new


def named_by_url(df: DataFrame) -> DataFrame:
    return df.withColumn("name", url_basename("url"))


def classified_with_cache(queue: DataFrame, classify, folder: str, columns: str = "journal string, paper string, subject string, category string, reasoning string") -> DataFrame:
    """As ``classified_by``, but classes are kept in a folder by a hash of journal and paper: only rows that it lacks are classified,
    and their classes are appended before the result is read (SC27)."""
    from corpusloom.sources.readers import exists

    spark = queue.sparkSession
    key = F.xxhash64("journal", "paper")
    wanted = queue.where("subject is null").withColumn("cache_key", key)
    todo = wanted
    if exists(spark, folder):
        todo = wanted.join(spark.read.parquet(folder).select("cache_key").distinct(), "cache_key", "left_anti")
    todo.drop("cache_key").mapInPandas(classify, columns).withColumn("cache_key", key).write.mode("append").parquet(folder)
    kept = spark.read.parquet(folder)
    return kept.join(wanted.select("cache_key").distinct(), "cache_key", "left_semi").dropDuplicates(["cache_key"]).drop("cache_key")


def report_rows(df: DataFrame, journal_name: str, journal_code: str) -> DataFrame:
    """Cells of the printed report: number, short journal, subject, category, linked paper, author, whole size (PR38, WN8)."""
    bar = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("-"))
    size = F.coalesce(F.floor(F.col("size_in_kb").try_cast("double")).cast("bigint").cast("string"), F.lit(""))
    link = F.concat(F.lit("["), bar(F.col("paper")), F.lit("]("), F.replace(F.coalesce("url", F.lit("")), F.lit(" "), F.lit("%20")), F.lit(")"))
    place = F.row_number().over(W.orderBy("journal", "paper"))
    return df.select(place.alias("row_number"), bar(F.replace("journal", F.lit(journal_name), F.lit(journal_code))).alias("journal"), bar(F.col("subject")).alias("subject"), bar(F.col("category")).alias("category"), link.alias("paper"), bar(F.col("author")).alias("author"), size.alias("size"))

"""Faceted free-text and pattern search with stable orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.text import decade, first_filled, highlight, issue_number, js_int, percent_encode, safe_category, safe_subject, valid_pattern
from corpusloom.settings import Settings
from corpusloom.sources.readers import SearchRequest


def content(settings: Settings | None = None, title="title", author="author", subject="subject", year="year", journal="journal", affiliated="affiliated", mirror="mirror_url") -> Column:
    """What a search looks through: five fields and key words for affiliated or mirrored rows (PR28)."""
    s = settings or Settings()
    words = F.when(F.col(affiliated), s.affiliated_keywords).when(F.coalesce(F.col(mirror), F.lit("")) != "", s.mirror_keywords).otherwise("")
    return F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (title, author, subject, year, journal)], words)


def has_all_words(text: Column, term: str) -> Column:
    """Every word of the term is in the text, whatever the case (FI13)."""
    low, out = F.lower(text), F.lit(True)
    for w in term.lower().split():
        out = out & F.contains(low, F.lit(w))
    return out


def matches(text: Column, pattern: str) -> Column:
    """A pattern anywhere, whatever the case; one that isn't valid matches nothing (FI14)."""
    return text.rlike(f"(?i){pattern}") if valid_pattern(pattern) else F.lit(False)


def one_of(value: Column, chosen: list[str]) -> Column:
    """In the chosen set; no choice passes all (FI15)."""
    return value.isin(*chosen) if chosen else F.lit(True)


def filtered(df: DataFrame, request: SearchRequest, settings: Settings | None = None) -> DataFrame:
    """All filters as one conjunction, so they reach the scan together (FI13-FI16)."""
    keep = F.lit(True)
    if request.search:
        text = content(settings)
        keep = keep & (matches(text, request.search) if request.regex else has_all_words(text, request.search))
    keep = keep & one_of(safe_category("category"), request.categories) & one_of(safe_subject("subject"), request.subjects) & one_of(decade("year"), request.decades)
    if request.affiliated_only:
        keep = keep & F.coalesce(F.col("affiliated"), F.lit(False))
    return df.where(keep)


def order(request: SearchRequest, tie: list[str]) -> list[Column]:
    """Sort columns of a request; ``tie`` is the source order, for JavaScript sorts are stable (SO4-SO8)."""
    year = F.coalesce(js_int("year"), F.lit(0))
    issue = issue_number("journal")
    last = [F.col(t) for t in tie]
    if request.sort == "newest":
        return [year.desc(), issue.desc(), *last]
    if request.sort == "oldest":
        return [year.asc(), issue.asc(), *last]
    if request.sort == "title":
        return [F.expr("title collate UNICODE").asc(), *last]
    if request.sort == "size":
        return [F.coalesce(F.col("size"), F.lit(0)).asc(), *last]
    if request.sort == "relevance" and request.search:
        return [F.contains(F.lower("title"), F.lit(request.search.lower())).desc(), *last]
    return last


def search(df: DataFrame, request: SearchRequest, tie: list[str], settings: Settings | None = None) -> DataFrame:
    """The first rows of the result in order: a bounded heap in each task, no full sort (SO9, SK23)."""
    return filtered(df, request, settings).orderBy(*order(request, tie)).limit(request.limit)


def counts(df: DataFrame, request: SearchRequest, settings: Settings | None = None) -> DataFrame:
    """Number of results and of those beyond the limit (AG15)."""
    return filtered(df, request, settings).agg(F.count("*").alias("results")).withColumn("more", F.greatest(F.col("results") - request.limit, F.lit(0)).cast("bigint"))


def facet_values(df: DataFrame, category="category", subject="subject", year="year") -> DataFrame:
    """Distinct values of the three facets, one scan (AG14): facet, value. Years that don't parse and decade 0 are left out."""
    known = F.when(js_int(year).isNotNull() & (F.floor(js_int(year) / 10) != 0), decade(year))
    pairs = F.array(*[F.struct(F.lit(n).alias("facet"), v.alias("value")) for n, v in (("category", safe_category(category)), ("subject", safe_subject(subject)), ("decade", known))])
    return df.select(F.explode(pairs).alias("p")).select("p.facet", "p.value").where("value is not null").distinct()


def archive_link(key: Column, remote: Column, settings: Settings | None = None, bucket: str | None = None) -> Column:
    """Route to the stored copy: by key, else by the name in the remote URL (PR33)."""
    s = settings or Settings()
    name = F.substring_index(F.substring_index(remote, "/", -1), "?", 1)
    safe = "-_.!~*'()"
    by_name = F.when(name != "", F.concat(F.lit(s.archive_route), percent_encode(F.concat(F.lit(f"assets/{bucket or s.buckets[0]}/"), name), safe))).otherwise(first_filled(remote, F.lit("#")))
    return F.when(F.coalesce(key, F.lit("")) != "", F.concat(F.lit(s.archive_route), percent_encode(F.concat(F.lit("assets/"), key), safe))).otherwise(by_name)


def primary_link(entry_type: Column, mirror: Column, archive: Column, remote: Column) -> Column:
    """Links go to their URL; files to the mirror, else the archive, else the source; ``#`` at last (PR31)."""
    return F.when(entry_type == "link", first_filled(remote, F.lit("#"))).otherwise(first_filled(mirror, archive, remote, F.lit("#")))


def access_targets(entry_type: Column, primary: Column, mirror: Column, remote: Column, archive: Column) -> Column:
    """Candidate targets in order, blank ones left out, of equal addresses the first (PR32)."""
    one = lambda kind, href, active: F.struct(F.lit(kind).alias("kind"), href.alias("href"), active.alias("active"))
    file = F.array(one("read", primary, F.lit(True)), one("mirror", mirror, primary == mirror), one("source", remote, primary == remote), one("archive", archive, F.lit(False)))
    link = F.array(one("open", remote, primary == remote))
    some = F.filter(F.when(entry_type == "link", link).otherwise(file), lambda t: F.coalesce(t["href"], F.lit("")) != "")
    return F.aggregate(some, F.slice(some, 1, 0), lambda kept, t: F.when(F.exists(kept, lambda k: k["href"] == t["href"]), kept).otherwise(F.concat(kept, F.array(t))))


def rendered(df: DataFrame, request: SearchRequest) -> DataFrame:
    """Title and author with their matches marked."""
    return df.withColumn("title_html", highlight("title", request.search, request.regex)).withColumn("author_html", highlight("author", request.search, request.regex))


def remembered(history: DataFrame, user: list[str], most: int = 8) -> DataFrame:
    """Most recent searches of each user: of those alike but for case and with one mode the latest, newest first (WN10, FI26)."""
    from pyspark.sql import Window as W

    kept = history.where(F.length(F.trim("query")) >= 2)
    last = F.row_number().over(W.partitionBy(*user, F.lower(F.trim("query")), "use_regex").orderBy(F.desc("ts"), F.desc("query")))
    place = F.row_number().over(W.partitionBy(*user).orderBy(F.desc("ts"), "query", "use_regex"))
    return kept.withColumn("_n", last).where("_n = 1").withColumn("place", place).where(F.col("place") <= most).drop("_n")


def table_filter(df: DataFrame, columns: list[str], words: str, category: str | None = None) -> DataFrame:
    """Rows whose joined text holds a string and whose category holds another, whatever the case (FI27, FI28)."""
    out = df.where(F.contains(F.upper(F.concat_ws(" ", *columns)), F.lit(words.upper())))
    return out.where(F.contains(F.upper("category"), F.lit(category.upper()))) if category else out

"""Registered queries: every operator of the engine bound to the driver's tables, with the SQL that says the same.

Roles of the tables: ``pages.url`` are root URLs, ``documents`` canonical rows, ``labels`` enrichment, ``benchmark`` the fragment
registry, ``conversations`` assets by role (turn 0 primary, turn 1 mirror), ``orders`` dated rows, ``part`` searchable titles,
``customer`` and ``supplier`` two inventories, ``events.props`` raw JSON. All run over whole tables and whole texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.functions import text as X
from corpusloom.functions.python import folded_title
from corpusloom.operators import diff, identity, legacy, registry, search
from corpusloom.plans.audit import counts_by, issue, missing, severity_counts, union
from corpusloom.plans.projections import coverage, featured, source_label
from corpusloom.plans.registered import AFFILIATED, BARE, HOST, NORM, ORACLES, PAGE_NAME, PAGE_STEM, PAPERS, QUERIES, S, SLUG, SPACE, c, digest, query, t
from corpusloom.settings import Settings
from corpusloom.sources.readers import SearchRequest

def affiliated_docs(spark, d) -> DataFrame:
    return registry.flagged(t(spark, d, "documents"), t(spark, d, "benchmark").select(c("text").alias("entry")), ["text"])


# ---- M1: projection and text functions


@query(f"""select d.doc_id, d.source as journal, d.lang as category, coalesce(cast(l.quality as varchar), '') as subject,
  case when {AFFILIATED} then 'true' else 'false' end as affiliated, coalesce(cast(d.n_chars as varchar), '0') as size_in_kb, 'false' as object_synced
  from documents d left join labels l using (doc_id)""")
def q01_index_projection(spark, d):
    """Index export: enrichment by key, fragment flag, constants, sorted (JN4, JN5, PR10, PR11, SO1)."""
    rows = affiliated_docs(spark, d).join(t(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return rows.select("doc_id", c("source").alias("journal"), c("lang").alias("category"), F.coalesce(c("quality").cast("string"), F.lit("")).alias("subject"), F.when(c("affiliated"), "true").otherwise("false").alias("affiliated"), F.coalesce(c("n_chars").cast("string"), F.lit("0")).alias("size_in_kb"), F.lit("false").alias("object_synced")).orderBy("journal", "doc_id")


@query("""select p.conv_id || ':primary' as asset_id, p.text as primary_text, coalesce(m.text, '') as mirror_text, m.text is not null as has_mirror
  from conversations p left join conversations m on m.conv_id = p.conv_id and m.turn = 1 where p.turn = 0""")
def q02_primary_mirror_self_join(spark, d):
    """Primary asset with its mirror, the role inside the join's condition (JN1, JN2, FI11)."""
    a = t(spark, d, "conversations")
    mirror = a.where("turn = 1").select("conv_id", c("text").alias("_m"))
    return a.where("turn = 0").join(mirror, "conv_id", "left").select(F.concat(c("conv_id").cast("string"), F.lit(":primary")).alias("asset_id"), c("text").alias("primary_text"), F.coalesce("_m", F.lit("")).alias("mirror_text"), c("_m").isNotNull().alias("has_mirror"))


@query(f"select page_id, {HOST.format('url')} as host, {BARE.format('url')} as path, {PAGE_NAME} as basename, {PAGE_STEM} as stem from pages")
def q03_url_parts(spark, d):
    """Host, path, last segment and stem of URLs, nothing decoded (FN3-FN6)."""
    return t(spark, d, "pages").select("page_id", X.url_host("url").alias("host"), X.url_path("url").alias("path"), X.url_basename("url").alias("basename"), X.stem(X.url_basename("url")).alias("stem"))


@query(f"select 'part' as kind, p_partkey as id, {SLUG.format('p_name')} as slug from part union all select 'page', page_id, {SLUG.format('url')} from pages")
def q04_slugify(spark, d):
    """Slugs of titles and URLs (FN2)."""
    one = t(spark, d, "part").select(F.lit("part").alias("kind"), c("p_partkey").alias("id"), X.slug("p_name").alias("slug"))
    return one.unionByName(t(spark, d, "pages").select(F.lit("page").alias("kind"), c("page_id").alias("id"), X.slug("url").alias("slug")))


@query("""select event_id, event_type as raw_type, props as raw_props, coalesce(json_extract_string(props, '$.k'), '') as k, length(props)::int as n_raw from events""")
def q05_raw_json_roundtrip(spark, d):
    """Pack a row into JSON with nulls kept and take fields out again (PR7, PR8, FN20)."""
    raw = F.to_json(F.struct("event_type", "props"), {"ignoreNullFields": "false"})
    e = t(spark, d, "events").select("event_id", "props", raw.alias("raw"))
    return e.select("event_id", F.get_json_object("raw", "$.event_type").alias("raw_type"), F.get_json_object("raw", "$.props").alias("raw_props"), F.coalesce(F.get_json_object("props", "$.k"), F.lit("")).alias("k"), F.length(F.get_json_object("raw", "$.props")).alias("n_raw"))


@query(f"""select page_id, case when page_id % 3 = 0 then 'portal' when page_id % 3 = 1 then case when contains({HOST.format('url')}, 'example.com') then 'magazine' else 'curated_link' end else 'other_metadata' end as source from pages""")
def q06_source_label(spark, d):
    """Label by source type, links by host, unknown types as they are (PR9)."""
    kind = F.when(c("page_id") % 3 == 0, "portal_metadata").when(c("page_id") % 3 == 1, "curated_links_metadata").otherwise("other_metadata")
    return t(spark, d, "pages").select("page_id", source_label(kind, c("url"), Settings(link_host="example.com")).alias("source"))


# ---- M2: identity


@query(f"""with b as (select page_id, {PAGE_STEM} as base from pages), n as (select *, row_number() over (partition by base order by page_id) as k from b)
  select page_id, base, case when k = 1 then base else printf('%s-%02d', base, k) end as doc_id from n""")
def q07_doc_id_collision_suffix(spark, d):
    """Second and further rows of an id get a numbered suffix (WN1)."""
    return identity.suffixed(t(spark, d, "pages").select("page_id", X.stem(X.url_basename("url")).alias("base")), "base", ["page_id"])


@query("select doc_id, lang, source from (select *, row_number() over (partition by text order by doc_id) as k from documents) where k = 1")
def q08_keep_first(spark, d):
    """First row of equal texts (WN2)."""
    return identity.keep(t(spark, d, "documents").select("doc_id", "lang", "source", digest("text")), ["text"], ["doc_id"]).drop("text")


@query("select user_id, event_type, event_id, value from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as k from events) where k = 1")
def q09_keep_last(spark, d):
    """Last event of a user and type (WN3)."""
    return identity.keep_last(t(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"], ["event_id", "value"])


@query("select doc_id, lang, source from (select *, row_number() over (partition by text order by case when lang = 'en' then 1 else 0 end desc, doc_id) as k from documents) where k = 1")
def q10_keep_preferred(spark, d):
    """Of equal texts the preferred one, else the first (WN4, SO13)."""
    return identity.keep(t(spark, d, "documents").select("doc_id", "lang", "source", digest("text")), ["text"], [F.desc((c("lang") == "en").cast("int")), c("doc_id")]).drop("text")


@query("select doc_id, count(*) over (partition by text) > 1 as duplicated from documents")
def q11_duplicated_all_members(spark, d):
    """Every member of a group of equal texts (WN6)."""
    return identity.duplicated(t(spark, d, "documents").select("doc_id", digest("text")), ["text"]).drop("text")


@query("select doc_id, source, cast((row_number() over (partition by source order by doc_id) - 1) // 15 as bigint) as batch from documents")
def q12_batch_index(spark, d):
    """Batches of fifteen within a source (WN7)."""
    return identity.batched(t(spark, d, "documents").select("doc_id", "source"), "doc_id", 15, within=["source"])


@query("select conv_id, turn, row_number() over (partition by role, text order by conv_id, turn) > 1 as seen_before from conversations")
def q13_seen_before_flag(spark, d):
    """Has an equal pair come before? (WN5)"""
    return identity.seen_before(t(spark, d, "conversations").select("conv_id", "turn", "role", digest("text")), ["role", "text"], ["conv_id", "turn"]).select("conv_id", "turn", "seen_before")


# ---- M4: audit


TABLES = ("documents", "labels", "pages", "benchmark", "conversations", "events", "orders", "part")


@query(" union all ".join(f"select '{n}' as name, count(*) as n from {n}" for n in TABLES))
def q14_inventory_counts(spark, d):
    """Row counts of all relations, one metadata-only scan each (AG1)."""
    return union([t(spark, d, n).agg(F.lit(n).alias("name"), F.count("*").alias("n")) for n in TABLES])


@query("""select d.source, d.lang, count(*) as n, coalesce(count_if(l.toxic = 1), 0)::bigint as n_flagged, coalesce(count_if(l.quality = 1), 0)::bigint as n_good from documents d left join labels l using (doc_id) group by all""")
def q15_group_count_if(spark, d):
    """Counts and conditional counts by group (AG2, AG3)."""
    rows = t(spark, d, "documents").select("doc_id", "source", "lang").join(t(spark, d, "labels"), "doc_id", "left")
    return counts_by(rows, ["source", "lang"], n_flagged=c("toxic") == 1, n_good=c("quality") == 1)


FLOAT = r"'^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$'"


@query(f"""select 'documents' as name, count_if(coalesce(trim(text), '') = '')::bigint as blank_text, count_if(not regexp_matches(source, 'src1[0-9]'))::bigint as pattern_misses, count_if(not regexp_matches(lang || n_chars, {FLOAT}))::bigint as non_numeric from documents
  union all select 'part', count_if(coalesce(trim(p_name), '') = '')::bigint, count_if(not regexp_matches(p_brand, 'src1[0-9]'))::bigint, count_if(not regexp_matches(p_size::varchar, {FLOAT}))::bigint from part""")
def q16_rule_violation_counts(spark, d):
    """Violations of several rules in one aggregation a table (AG5, FI4-FI6)."""
    a = t(spark, d, "documents").agg(F.lit("documents").alias("name"), F.count_if(X.clean("text") == "").alias("blank_text"), F.count_if(~c("source").rlike("src1[0-9]")).alias("pattern_misses"), F.count_if(~X.is_float(F.concat("lang", c("n_chars").cast("string")))).alias("non_numeric"))
    b = t(spark, d, "part").agg(F.lit("part").alias("name"), F.count_if(X.clean("p_name") == "").alias("blank_text"), F.count_if(~c("p_brand").rlike("src1[0-9]")).alias("pattern_misses"), F.count_if(~X.is_float(c("p_size").cast("string"))).alias("non_numeric"))
    return a.unionByName(b)


ISSUES = f"""select 'error' as severity, 'URL path is no PDF' as message, page_id as id from pages where not ends_with(lower({BARE.format('url')}), '.pdf')
  union all select 'warning', 'source does not match', doc_id from documents where not regexp_matches(source, 'src1[0-9]')
  union all select 'info', 'short text', doc_id from documents where n_chars < 300
  union all select 'error', 'missing fields: ' || array_to_string(list_filter(['text', 'lang', 'source'], lambda f: case f when 'text' then coalesce(trim(text), '') when 'lang' then coalesce(trim(lang), '') else coalesce(trim(source), '') end = ''), ','), doc_id
    from documents where coalesce(trim(text), '') = '' or coalesce(trim(lang), '') = '' or coalesce(trim(source), '') = ''"""


def _issues(spark, d) -> DataFrame:
    docs, pages = t(spark, d, "documents"), t(spark, d, "pages")
    need = missing(["text", "lang", "source"])
    one = lambda df, severity, message, key: issue(df, severity, message, id=c(key))
    parts = [one(pages.where(~X.is_pdf_path("url")), "error", "URL path is no PDF", "page_id"), one(docs.where(~c("source").rlike("src1[0-9]")), "warning", "source does not match", "doc_id"), one(docs.where("n_chars < 300"), "info", "short text", "doc_id")]
    gaps = docs.where(F.size(need) > 0).select(F.lit("error").alias("severity"), F.concat(F.lit("missing fields: "), F.array_join(need, ",")).alias("message"), F.create_map(F.lit("id"), c("doc_id").cast("string")).alias("details"))
    return union([*parts, gaps])


@query(ISSUES)
def q17_issue_rows(spark, d):
    """Issues as rows: severity, message and key (CK3-CK6, FI3, FI5, FI6)."""
    return _issues(spark, d).select("severity", "message", c("details")["id"].cast("bigint").alias("id"))


@query(f"select severity, count(*) as n from ({ISSUES}) group by severity")
def q18_severity_counts(spark, d):
    """Issues by severity (AG4)."""
    return severity_counts(_issues(spark, d))


@query("select md5(text) as text_md5, count(distinct doc_id) as n, string_agg(doc_id::varchar, ',' order by doc_id) as members from documents group by text having count(distinct doc_id) > 1")
def q19_shared_key_groups(spark, d):
    """Keys of several documents with their members (AG6, CK12)."""
    rows = t(spark, d, "documents").select(F.md5("text").alias("text_md5"), "doc_id")
    return diff.shared_keys(rows, "text_md5", "doc_id").select("text_md5", "n", F.array_join(F.transform("members", lambda x: x.cast("string")), ",").alias("members"))


@query(rf"""with b as (select page_id, {PAGE_STEM} as base from pages), n as (select *, row_number() over (partition by base order by page_id) as k from b), i as (select page_id, case when k = 1 then base else printf('%s-%02d', base, k) end as doc_id from n)
  select page_id, doc_id from i where regexp_matches(doc_id, '-(0[2-9]|[1-9][0-9])$')""")
def q20_collision_suffix_check(spark, d):
    """Ids that look suffixed (CK13, FI10)."""
    return q07_doc_id_collision_suffix(spark, d).where(c("doc_id").rlike(r"-(0[2-9]|[1-9][0-9])$")).select("page_id", "doc_id")


@query(f"""select 'document' as kind, doc_id as id from documents d where exists (select 1 from labels l where l.doc_id = d.doc_id and l.quality = 1) and not {AFFILIATED}
  union all select 'entry', item_id from benchmark b where not exists (select 1 from documents d where contains(d.text, ltrim(b.text, '$')))""")
def q21_registry_unmatched(spark, d):
    """Labelled documents that no fragment matches, and fragments that match none (JN11, JN12, CK14)."""
    good = t(spark, d, "labels").where("quality = 1").select("doc_id")
    docs = affiliated_docs(spark, d).where(~c("affiliated")).join(good, "doc_id", "left_semi").select(F.lit("document").alias("kind"), c("doc_id").alias("id"))
    b = t(spark, d, "benchmark")
    entries = registry.unmatched_entries(b.select(c("text").alias("entry")), t(spark, d, "documents"), "text")
    return docs.unionByName(b.join(entries, b.text == entries.entry, "left_semi").select(F.lit("entry").alias("kind"), c("item_id").alias("id")))


@query("""select 'missing' as kind, doc_id as id from documents where doc_id not in (select doc_id from labels) union all select 'orphan', page_id from pages where not exists (select 1 from labels where doc_id = page_id) """)
def q22_missing_and_orphan(spark, d):
    """Rows without a file and files without a row, as anti joins (JN8, JN9, CK10, CK11)."""
    labels = t(spark, d, "labels").select(c("doc_id").alias("id"))
    a = t(spark, d, "documents").select(F.lit("missing").alias("kind"), c("doc_id").alias("id"))
    b = t(spark, d, "pages").select(F.lit("orphan").alias("kind"), c("page_id").alias("id"))
    return diff.absent(a.unionByName(b), labels, "id").select("kind", "id")


@query("""select 'missing' as side, page_id::varchar as id from (select page_id from pages except select doc_id from labels) union all select 'extra', doc_id::varchar from (select doc_id from labels except select page_id from pages)""")
def q23_keyed_difference(spark, d):
    """Keys of one version alone, both ways in one shuffle: pages against labels (ST1, ST2, AG10)."""
    old, new = t(spark, d, "pages").select(c("page_id").cast("string").alias("id")), t(spark, d, "labels").select(c("doc_id").cast("string").alias("id"))
    return diff.keyed_difference(old, new, ["id"]).select("side", "id")


@query("select count(*) as n, count(l.quality) as n_quality, count(l.toxic) as n_toxic, count_if(coalesce(trim(d.source), '') <> '')::bigint as n_source from documents d left join labels l using (doc_id)")
def q24_coverage_counts(spark, d):
    """Non-blank counts (AG8, AG17)."""
    rows = t(spark, d, "documents").select("doc_id", "source").join(t(spark, d, "labels"), "doc_id", "left")
    return coverage(rows.select(*[c(x).cast("string").alias(x) for x in ("quality", "toxic", "source")]), ["quality", "toxic", "source"])


# ---- M5: search


def _papers(spark, d) -> DataFrame:
    """Parts as search records: name, brand as category, type as subject, size in years from 1950."""
    p = t(spark, d, "part")
    return p.select(c("p_partkey").alias("id"), c("p_name").alias("title"), F.lit("").alias("author"), c("p_type").alias("subject"), c("p_brand").alias("category"), (F.lit(1950) + c("p_size")).cast("string").alias("year"), F.concat(F.lit("Issue-"), (c("p_partkey") % 7).cast("string")).alias("journal"), (c("p_partkey") % 5 == 0).alias("affiliated"), F.lit("").alias("mirror_url"), c("p_retailprice").alias("size"))


CONTENT = "lower(title || ' ' || '' || ' ' || subject || ' ' || year || ' ' || journal || ' ' || case when affiliated then 'affiliated mirror' else '' end)"


@query(f"with {PAPERS} select id, title from papers where contains({CONTENT}, '19') and contains({CONTENT}, 'affiliated') and contains({CONTENT}, 'e')")
def q25_search_and_terms(spark, d):
    """All words somewhere in the searched text, whatever the case (FI13, PR28)."""
    return search.filtered(_papers(spark, d), SearchRequest(search="19 AFFILIATED e")).select("id", "title")


@query(f"with {PAPERS} select id, title from papers where regexp_matches({CONTENT}, '(gear|bolt|ring)\\b.*issue-[2-4]')")
def q26_search_regex(spark, d):
    """A pattern anywhere, whatever the case (FI14)."""
    return search.filtered(_papers(spark, d), SearchRequest(search=r"(gear|bolt|ring)\b.*Issue-[2-4]", regex=True)).select("id", "title")


@query(f"with {PAPERS} select id, category, year from papers where category in ('Brand#11', 'Brand#12', 'Brand#1', 'Brand#2') and affiliated and floor(year::int / 10) * 10 in (1950, 1970)")
def q27_facet_filter(spark, d):
    """Or within a facet, and between facets and the flag (FI15, FI16)."""
    r = SearchRequest(categories=["Brand#11", "Brand#12", "Brand#1", "Brand#2"], decades=["1950s", "1970s"], affiliated_only=True)
    return search.filtered(_papers(spark, d), r).select("id", "category", "year")


@query(f"""with {PAPERS} select distinct 'category' as facet, category as value from papers union select 'subject', subject from papers union select 'decade', (floor(year::int / 10) * 10)::int || 's' from papers
  union select 'decade', (year(o_orderdate) // 10 * 10) || 's' from orders""")
def q28_facet_values(spark, d):
    """Distinct facet values from one scan (AG14, PR30)."""
    one = search.facet_values(_papers(spark, d))
    two = t(spark, d, "orders").select(F.lit("decade").alias("facet"), X.decade(F.year("o_orderdate").cast("string")).alias("value"))
    return one.unionByName(two).distinct()


@query("select o_orderkey as id, year(o_orderdate)::varchar as year, 'Issue-' || month(o_orderdate) as journal from orders order by year(o_orderdate) desc, month(o_orderdate) desc, o_orderkey limit 100")
def q29_sort_newest_top100(spark, d):
    """Newest first, the first hundred: a report's limit is the feature (SO4, SO9)."""
    rows = t(spark, d, "orders").select(c("o_orderkey").alias("id"), F.year("o_orderdate").cast("string").alias("year"), F.concat(F.lit("Issue-"), F.month("o_orderdate").cast("string")).alias("journal"))
    return rows.orderBy(*search.order(SearchRequest(sort="newest"), ["id"])).limit(100)


@query(f"with {PAPERS} select id, title from papers where contains({CONTENT}, 'e') order by contains(lower(title), 'e') desc, id limit 100")
def q30_sort_relevance_top100(spark, d):
    """Titles that hold the term first (SO8, SK23)."""
    return search.search(_papers(spark, d), SearchRequest(search="e", sort="relevance"), ["id"]).select("id", "title")


@query(r"""select p_partkey as id, regexp_replace(replace(replace(replace(p_name, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '(e|a\.b)', '<mark>\1</mark>', 'gi') as html from part""")
def q31_highlight(spark, d):
    """Escaped titles with matches marked (PR36, FN18, FN19)."""
    return t(spark, d, "part").select(c("p_partkey").alias("id"), X.highlight("p_name", "e a.b").alias("html"))


@query("""with a as (select conv_id, max(case when turn = 0 then text end) as remote, max(case when turn = 1 then text end) as mirror, max(case when turn = 2 then text end) as archive from conversations group by conv_id),
  p as (select *, case when conv_id % 4 = 0 then coalesce(nullif(remote, ''), '#') else coalesce(nullif(mirror, ''), nullif(archive, ''), nullif(remote, ''), '#') end as primary_link from a)
  select conv_id, md5(primary_link) as link_md5, case when conv_id % 4 = 0 then case when coalesce(remote, '') <> '' then 1 else 0 end
    else len(list_distinct(list_filter([primary_link, mirror, remote, archive], lambda h: coalesce(h, '') <> ''))) end::int as n_targets from p""")
def q32_access_target(spark, d):
    """Preferred link, and the number of distinct targets in order (PR31, PR32)."""
    a = t(spark, d, "conversations")
    pick = lambda k: F.max(F.when(c("turn") == k, c("text")))
    a = a.groupBy("conv_id").agg(pick(0).alias("remote"), pick(1).alias("mirror"), pick(2).alias("archive"))
    kind = F.when(c("conv_id") % 4 == 0, "link").otherwise("pdf")
    first = search.primary_link(kind, c("mirror"), c("archive"), c("remote"))
    return a.select("conv_id", F.md5(first).alias("link_md5"), F.size(search.access_targets(kind, first, c("mirror"), c("remote"), c("archive"))).alias("n_targets"))


# ---- M6: web and featured


@query(f"""select (1950 + d.n_chars % 70)::varchar as year, coalesce(nullif(d.lang, ''), 'General') as category, d.doc_id::varchar as title, '' as author, d.source, 'https://mirror.example.org/papers/' || d.doc_id as url, 'pdf' as entry_type, (1950 + d.n_chars % 70)::bigint as sort_year
  from documents d where {AFFILIATED}""")
def q33_featured_projection(spark, d):
    """Flagged records with a lasting link, renamed and ordered (FI12, PR18, PR19, SO3)."""
    rows = affiliated_docs(spark, d).select("affiliated", (F.lit(1950) + c("n_chars") % 70).cast("string").alias("year"), c("lang").alias("subject"), c("doc_id").cast("string").alias("title"), F.lit("").alias("author"), c("source").alias("journal"), F.lit("pdf").alias("entry_type"), F.concat(F.lit(S.mirror_prefix), c("doc_id").cast("string")).alias("mirror_url"), F.lit("").alias("remote_url"))
    return featured(rows, S)


@query(r"""select doc_id, case when floor(n_chars / 1024.0 * 10 + 0.5) % 10 = 0 then (floor(n_chars / 1024.0 * 10 + 0.5) / 10)::bigint::varchar else (floor(n_chars / 1024.0 * 10 + 0.5) / 10)::varchar end || ' MB' as size_text,
  coalesce(list_filter(string_split('J-' || (doc_id % 40) || '-' || (1960 + doc_id % 50) || '-Issue-1', '-'), lambda x: regexp_matches(x, '^[0-9]{4}$'))[1], '') as year from documents""")
def q34_size_text_and_year(spark, d):
    """Sizes with halves rounded up, years from journal labels (PR16, PR34)."""
    journal = F.concat(F.lit("J-"), (c("doc_id") % 40).cast("string"), F.lit("-"), (F.lit(1960) + c("doc_id") % 50).cast("string"), F.lit("-Issue-1"))
    return t(spark, d, "documents").select("doc_id", X.size_text("n_chars", F.lit("pdf")).alias("size_text"), F.coalesce(X.year_token(journal), F.lit("")).alias("year"))


@query("select row_number() over (order by r_name, n_name)::int as row_number, r_name, n_name, '| ' || replace(r_name, '|', '-') || ' | ' || replace(n_name, '|', '-') || ' |' as line from nation join region on n_regionkey = r_regionkey")
def q35_row_numbered_listing(spark, d):
    """A small final listing with row numbers and markdown lines (WN8, SK17, SK25, PR38)."""
    rows = t(spark, d, "nation").join(t(spark, d, "region"), c("n_regionkey") == c("r_regionkey")).select("r_name", "n_name")
    made = F.concat(F.lit("| "), F.replace("r_name", F.lit("|"), F.lit("-")), F.lit(" | "), F.replace("n_name", F.lit("|"), F.lit("-")), F.lit(" |"))
    return identity.numbered(rows.withColumn("line", made), ["r_name", "n_name"])


# ---- M7: legacy operators


@query("""with a as (select p_partkey as id, case when p_brand = 'Brand#1' and contains(p_name, 'a') then 'Brand#2' else p_brand end as j1, p_name, p_type from part)
  select id, case when j1 = 'Brand#2' and contains(p_name, 'e') then 'Brand#3' else j1 end as journal, case when contains(p_name, 'o') then 'Known' else p_type end as author from a""")
def q36_ordered_patch_rules(spark, d):
    """Rules in order, each on what the ones before have made (UP1, UP2)."""
    rows = t(spark, d, "part").select(c("p_partkey").alias("id"), c("p_brand").alias("journal"), c("p_type").alias("author"), c("p_name").alias("url"))
    return legacy.patched(rows, [legacy.JournalRule("Brand#1", "a", "Brand#2"), legacy.JournalRule("Brand#2", "e", "Brand#3")], [("o", "Known")]).select("id", "journal", "author")


@query("""select page_id, exists (select 1 from documents d where ends_with(url, '/' || d.doc_id || '.html') or url = d.doc_id || '.html') as affiliated from pages""")
def q37_suffix_registry_flag(spark, d):
    """URLs whose last segment is a registry fragment (FI2, UP3). The registry is a file name for each document."""
    entries = t(spark, d, "documents").select(F.concat(c("doc_id").cast("string"), F.lit(".html")).alias("entry"))
    return registry.suffix_flagged(t(spark, d, "pages").select("page_id", "url"), entries, ["url"]).select("page_id", "affiliated")


@query("""with p as (select coalesce(c_custkey, s_suppkey * 20) as name, case when s_suppkey is null then 'NEW' when c_custkey is null then 'ORPHAN' when c_nationkey % 5 = s_nationkey % 5 then 'CURRENT' else 'UPDATE' end as action
  from customer full join supplier on c_custkey = s_suppkey * 20) select action, count(*) as n, sum(name)::bigint as names from p group by action""")
def q38_sync_plan(spark, d):
    """Two inventories compared by name and size: all customers against all suppliers (JN20, AG18)."""
    a = t(spark, d, "customer").select(c("c_custkey").alias("name"), (c("c_nationkey") % 5).alias("bytes"))
    b = t(spark, d, "supplier").select((c("s_suppkey") * 20).alias("name"), (c("s_nationkey") % 5).alias("bytes"))
    return diff.inventory_diff(a, b, ["name"]).groupBy("action").agg(F.count("*").alias("n"), F.sum("name").alias("names"))


@query("""select doc_id, case when regexp_matches(lower(text), 'contents|news|announcements|book review|reviews|volume contents|office bearers|title page') then 'Other' end as category
  from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id and l.quality is not null and l.toxic is not null)""")
def q39_classify_queue(spark, d):
    """Unclassified rows, noise titles labelled by rule (JN15, FI17, FI18)."""
    done = t(spark, d, "labels").where("quality is not null and toxic is not null").select("doc_id")
    return t(spark, d, "documents").join(done, "doc_id", "left_anti").select("doc_id", F.when(legacy.is_noise(c("text")), "Other").alias("category"))


@query("""with s as (select doc_id, case when doc_id % 7 <> 0 then source end as journal, case when doc_id % 5 <> 0 then lang end as paper from documents),
  k as (select case when doc_id % 7 <> 0 then source end as journal, case when doc_id % 5 <> 0 then lang end as paper, arg_max(quality, doc_id) as quality from documents join labels using (doc_id) group by 1, 2)
  select doc_id, journal, paper, quality from s left join k on s.journal is not distinct from k.journal and s.paper is not distinct from k.paper""".replace("select doc_id, journal, paper, quality", "select doc_id, s.journal, s.paper, quality"))
def q40_right_merge_null_safe(spark, d):
    """All source rows with the last class of their key; null keys meet (JN14, WN3)."""
    docs = t(spark, d, "documents").select("doc_id", F.when(c("doc_id") % 7 != 0, c("source")).alias("journal"), F.when(c("doc_id") % 5 != 0, c("lang")).alias("paper"))
    classes = docs.join(t(spark, d, "labels"), "doc_id").select("journal", "paper", c("quality").alias("subject"), c("toxic").alias("category"), c("doc_id").alias("ordinal"))
    return legacy.merged_classes(classes, docs).select("doc_id", "journal", "paper", c("subject").alias("quality"))


@query(f"""with a as (select doc_id, source, {SPACE.format('text')} as title from documents where doc_id % 2 = 0), b as (select doc_id, source, {SPACE.format('text')} as title from documents where doc_id % 2 = 1),
  o as (select * from a where not exists (select 1 from b where b.source = a.source and b.title = a.title)), f as (select title, arg_min(source, doc_id) as moved_to from b group by title)
  select doc_id, source, moved_to, case when moved_to is null then 'missing' else 'moved' end as status from o left join f using (title)""")
def q41_moved_vs_missing(spark, d):
    """Rows that the other listing has under another journal, and those it lacks (JN16, JN17, FN12). The listings are even and odd ids."""
    rows = t(spark, d, "documents").select("doc_id", "source", digest(X.norm_space("text"), "title"), (c("doc_id") % 2).alias("listing"))
    return diff.moved_within(rows, "listing", "source", "title", "doc_id").drop("title")


@query(f"""with n as (select {NORM.format('text')} as k, source, lang from documents), g as (select k, count(*) as n from n where k <> '' group by k having count(distinct source) > 1),
  h as (select k, lang, count(*) as n from n where length(k) >= 15 group by k, lang having count(distinct source) > 1)
  select 'name' as kind, count(*) as groups, coalesce(sum(n - 1), 0)::bigint as removable from g union all select 'title', count(*), coalesce(sum(n - 1), 0)::bigint from h""")
def q42_cross_origin_overlap(spark, d):
    """Rows beyond the first of groups that span origins (AG11, AG12, FI20)."""
    norm = t(spark, d, "documents").select(X.norm_title("text").alias("t"), "source", "lang")
    rows = norm.select(digest("t", "k"), F.length("t").alias("size"), "source", "lang")
    return diff.overlap_counts(rows.where("size > 0"), "k", "lang", "source", c("size") >= 15)


# ---- further operators of the inventory


@query(f"select page_id, regexp_matches({SPACE.format(PAGE_STEM)}, '^(notes?$|reviews?$|news\\b|[0-9])') as by_pattern, length({PAGE_STEM}) > 12 as is_long, case when length(url) > 28 then left(url, 26) || '...' else url end as label, 'cat-' || regexp_replace({PAGE_NAME}, '[^a-zA-Z0-9]', '-', 'g') as css from pages")
def q43_labels_and_tokens(spark, d):
    """Truncated labels, class tokens, anchored title patterns (PR35, PR37, FI7)."""
    name = X.url_basename("url")
    return t(spark, d, "pages").select("page_id", X.norm_space(X.stem(name)).rlike(r"^(notes?$|reviews?$|news\b|[0-9])").alias("by_pattern"), (F.length(X.stem(name)) > 12).alias("is_long"), X.short_label("url").alias("label"), X.css_token(name).alias("css"))


@query("select o_orderkey as id, o_totalprice as size from orders order by o_totalprice, o_orderkey limit 100")
def q44_sort_size_top100(spark, d):
    """Smallest first (SO7)."""
    rows = t(spark, d, "orders").select(c("o_orderkey").alias("id"), c("o_totalprice").alias("size"))
    return rows.orderBy(*search.order(SearchRequest(sort="size"), ["id"])).limit(100)


@query(f"with {PAPERS} select id, title, year, journal from papers where contains({CONTENT}, 'a') order by year::int, regexp_extract(journal, 'Issue-([0-9]+)', 1)::int, id limit 100")
def q45_sort_oldest_top100(spark, d):
    """Oldest first, then issue (SO5, FN14, FN15)."""
    return search.search(_papers(spark, d), SearchRequest(search="a", sort="oldest"), ["id"]).select("id", "title", "year", "journal")


@query(f"with {PAPERS} select count(*) as results, greatest(count(*) - 100, 0)::bigint as more from papers where contains({CONTENT}, 'gear')")
def q46_result_counts(spark, d):
    """Results and how many are beyond the limit (AG15)."""
    return search.counts(_papers(spark, d), SearchRequest(search="gear"))


@query("""with k as (select user_id, lower(event_type) as q, (event_id % 2 = 0) as use_regex, ts, event_type as query, event_id, row_number() over (partition by user_id, lower(event_type), event_id % 2 = 0 order by ts desc, event_type desc) as k from events),
  m as (select user_id, query, use_regex, ts, row_number() over (partition by user_id order by ts desc, query, use_regex) as place from k where k = 1) select user_id, query, use_regex, ts, place::int as place from m where place <= 8""")
def q47_recent_searches(spark, d):
    """The eight latest distinct searches of each user (WN10, FI26)."""
    e = t(spark, d, "events").select("user_id", c("event_type").alias("query"), (c("event_id") % 2 == 0).alias("use_regex"), "ts")
    return search.remembered(e, ["user_id"]).select("user_id", "query", "use_regex", "ts", "place")


@query("""select severity, message, id, place::int as place from (select *, row_number() over (partition by severity, message order by id) as place from (""" + ISSUES + """)) where place <= 20""")
def q48_issue_samples(spark, d):
    """The first twenty issues of each kind (WN9, SO10)."""
    return identity.samples(q17_issue_rows(spark, d), ["severity", "message"], ["id"], 20, "place")


@query("""select doc_id, case when doc_id % 3 = 0 then 'main/' || regexp_extract(source || '/' || doc_id || '.pdf', '([^/]*)$', 1) when doc_id % 3 = 1 then 'other/' || doc_id || '.pdf' else '' end as object_key from documents""")
def q49_object_keys(spark, d):
    """Keys of stored copies from URL or mirror (PR20, FN7)."""
    url = F.when(c("doc_id") % 3 == 0, F.concat("source", F.lit("/"), c("doc_id").cast("string"), F.lit(".pdf")))
    mirror = F.when(c("doc_id") % 3 == 1, F.concat(F.lit("m/"), c("doc_id").cast("string"), F.lit(".pdf")))
    return t(spark, d, "documents").select("doc_id", legacy.object_key(url, mirror).alias("object_key"))


@query("""select doc_id, case when doc_id % 11 = 0 then 'skip list' when doc_id % 13 = 0 then 'dollar prefix' when doc_id % 5 = 0 then 'no pdf' when exists (select 1 from labels l where l.doc_id = d.doc_id) then 'stored'
  when exists (select 1 from pages p where p.page_id = d.doc_id) then 'referenced' else 'new' end as status from documents d""")
def q50_file_triage(spark, d):
    """Status of incoming files: the first rule that holds (FI21, JN21, ST6)."""
    name = F.when(c("doc_id") % 11 == 0, "index.html").when(c("doc_id") % 13 == 0, F.concat(F.lit("$"), c("doc_id").cast("string"), F.lit(".pdf"))).when(c("doc_id") % 5 == 0, F.concat(c("doc_id").cast("string"), F.lit(".txt"))).otherwise(F.concat(c("doc_id").cast("string"), F.lit(".pdf")))
    files = t(spark, d, "documents").select("doc_id", name.alias("name"))
    stored = t(spark, d, "labels").select(F.concat(c("doc_id").cast("string"), F.lit(".pdf")).alias("name"))
    index = t(spark, d, "pages").select(F.concat(F.lit("http://h/"), c("page_id").cast("string"), F.lit(".pdf")).alias("url"), F.lit("").alias("mirror_url"))
    return legacy.triage(files, stored, index).select("doc_id", "status")


@query("""select source, count(*) as n, string_agg(md5(text), ',' order by md5(text)) as titles from documents group by source""")
def q51_titles_by_group(spark, d):
    """Sorted titles of each group (AG13)."""
    rows = t(spark, d, "documents").select("source", F.md5("text").alias("title"))
    return diff.titles_by_group(rows, "source", "title").select("source", F.size("titles").cast("bigint").alias("n"), F.array_join("titles", ",").alias("titles"))


@query("""select d.doc_id, coalesce(l.quality, p_size)::varchar as size_in_kb from documents d left join labels l using (doc_id) left join part on p_partkey = d.doc_id""")
def q52_sizes_from_before(spark, d):
    """Former sizes by key from all labels, else probed ones from all parts (JN13, SC26, UP6)."""
    docs = t(spark, d, "documents").select("doc_id", c("doc_id").cast("string").alias("url"))
    former = t(spark, d, "labels").select(c("doc_id").cast("string").alias("url"), c("quality").cast("string").alias("size_in_kb"), c("doc_id").alias("ordinal"))
    probed = t(spark, d, "part").select(c("p_partkey").cast("string").alias("url"), (c("p_size") * 1024).alias("bytes"))
    return legacy.with_sizes(docs, former, probed).select("doc_id", "size_in_kb")


@query("""select p_partkey as id, case when p_size % 4 = 0 then '' when p_size % 4 = 1 then p_size || '' when p_size % 4 = 2 then 'title ' || p_size || '.0' else 'nan-like' end as cleaned from part""")
def q53_clean_number(spark, d):
    """nan and null to empty, a trailing .0 off numbers only (PR12)."""
    raw = F.when(c("p_size") % 4 == 0, "NaN").when(c("p_size") % 4 == 1, F.concat(c("p_size").cast("string"), F.lit(".0"))).when(c("p_size") % 4 == 2, F.concat(F.lit("title "), c("p_size").cast("string"), F.lit(".0"))).otherwise("nan-like")
    return t(spark, d, "part").select(c("p_partkey").alias("id"), X.clean_number(raw).alias("cleaned"))


@query("select c_custkey as id, 'true' as affiliated from customer union all select s_suppkey * 20, 'false' from supplier where s_suppkey * 20 not in (select c_custkey from customer)")
def q54_union_and_new_entries(spark, d):
    """Rows of one table and what another adds to them (JN19, ST3, ST4, ST7)."""
    a = t(spark, d, "customer").select(c("c_custkey").alias("id"), F.lit("true").alias("affiliated"))
    b = t(spark, d, "supplier").select((c("s_suppkey") * 20).alias("id"), F.lit("false").alias("affiliated"))
    return a.unionByName(diff.absent(b, a, "id"))


@query("select doc_id, md5(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]', '', 'g')) as folded_md5 from documents")
def q55_accent_fold(spark, d):
    """Titles without accents, letters and digits only (FN11); tests hold it against the Unicode tables, too."""
    return t(spark, d, "documents").select("doc_id", F.md5(folded_title("text")).alias("folded_md5"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return q01_index_projection(spark, d)


from corpusloom.plans import catalogue as _catalogue  # noqa: E402, F401  its queries register themselves

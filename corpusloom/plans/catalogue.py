"""Registered queries of the catalogue itself: canonical build, export, web records, audit, imports, files and listings, over roots
bound to the driver's tables (``bindings``). Each calls the library; the SQL beside it says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions import text as X
from corpusloom.operators import diff, identity, legacy, search, sidecars
from corpusloom.plans import audit, bindings as B, canonical, projections
from corpusloom.plans.registered import BASE, PAPERS, S, c, query, t
from corpusloom.sources import places, readers, sinks
from corpusloom.sources.readers import SearchRequest

# ---- canonical build and projections


@query(f"with {B.CANON} select * from documents_")
def q56_canonical_documents(spark, d):
    """Documents of three roots with ids, types, years and flags; key constraints hold (PR1-PR3, WN1, JN5, SK2, SK6, SK7, ST3, FN24)."""
    return B.tables(spark, d, check=True)["documents"]


@query(f"with {B.CANON} select * from sources_")
def q57_canonical_sources(spark, d):
    """Provenance with the raw row as JSON (PR7, SK3, FN20, FN23)."""
    return B.tables(spark, d)["document_sources"]


@query(f"with {B.CANON} select * from assets_")
def q58_canonical_assets(spark, d):
    """Primary and mirror assets with their stored copies (SC7, JN3, JN22, PR4-PR6, SK4, SK5)."""
    return B.tables(spark, d)["asset_refs"]


@query(f"with {B.CANON} select 'asset_refs' as name, count(*) as n from assets_ union all select 'documents', count(*) from documents_ union all select 'document_sources', count(*) from sources_ union all select 'registry_entries', count(*) from registry union all select 'mirror_entries', count(*) from mirrors union all select 'build_info', 3")
def q59_store_round_trip(spark, d):
    """All tables into a staged store whose constraints are checked before it takes its place, and counted from there (SK1, SK6-SK8, SC9, SK19)."""
    made = B.tables(spark, d)
    paths = sinks.store(made, places.scratch(spark, "store"), check=canonical.verify)
    folder = next(iter(paths.values())).rsplit("/", 1)[0]
    return audit.union([df.agg(F.lit(n).alias("name"), F.count("*").alias("n")) for n, df in sinks.open_store(spark, folder, list(made)).items()])


@query(f"with {B.INDEX} select * from index_")
def q60_index_export(spark, d):
    """The flat index with labels, enrichment, fallback, sizes and mirrors, in source order (JN1, JN2, JN4, FI11, PR8-PR11, SC10, SC11, SO1)."""
    return B.index(spark, d).orderBy("source_path", "source_row_id")


_NUM = "case when {0} is null or lower({0}) = 'nan' then '' when regexp_matches({0}, '^[+-]?[0-9]+[.]0$') then regexp_replace({0}, '[.]0$', '') else {0} end"
_FLOAT = r"'(?i)^[+-]?(([0-9]+(_[0-9]+)*)([.]([0-9]+(_[0-9]+)*)?)?(e[+-]?[0-9]+(_[0-9]+)*)?|[.][0-9]+(_[0-9]+)*(e[+-]?[0-9]+(_[0-9]+)*)?|inf(inity)?|nan)$'"
WEB = f"""{B.INDEX},
typed as (select source_path, source_row_id, {_NUM.format('journal')} as journal, {_NUM.format('paper')} as title, {_NUM.format('author')} as author, {_NUM.format('category')} as category, {_NUM.format('subject')} as subject, {_NUM.format('year')} as year0, url as remote_url, {_NUM.format('mirror_url')} as mirror0,
  coalesce(case when regexp_matches(trim(size_in_kb), {_FLOAT}) and lower(trim(size_in_kb)) <> 'nan' then try_cast(replace(trim(size_in_kb), '_', '') as double) end, 0.0) as size0, affiliated = 'true' as affiliated, entry_type, source, object_key from index_),
web_ as (select w.*, case when contains(remote_url, 'mirror.example.org') and mirror0 = '' then remote_url else mirror0 end as mirror_url,
  case when year0 <> '' then year0 else coalesce(list_filter(string_split(journal, '-'), lambda x: regexp_matches(x, '^[0-9]{{4}}$'))[1], '') end as year, i.bytes as key_bytes, n.bucket as name_bucket, regexp_extract(remote_url, '([^/]*)$', 1) as last_part
  from typed w left join inventory i on i.bucket || '/' || i.name = w.object_key left join (select name, min(bucket) as bucket from inventory group by name) n on n.name = regexp_extract(remote_url, '([^/]*)$', 1)),
records as (select source_path, source_row_id, journal, title, author, category, subject, year, remote_url, mirror_url, case when size0 <= 0 and key_bytes is not null then key_bytes / 1024 else size0 end as size, affiliated, entry_type, source, object_key,
  case when key_bytes is not null and object_key <> '' then 'assets/pdfs/' || object_key when name_bucket is not null then 'assets/pdfs/' || name_bucket || '/' || last_part end as local_path from web_)"""


def _web(spark, d) -> DataFrame:
    return projections.web_records(B.index(spark, d), B.bound(spark, d, B.ROOTS["inventory"]), S)


@query(f"with {WEB} select * from records")
def q61_web_records(spark, d):
    """Typed search records with sizes, years and local paths (PR12-PR17, FN16)."""
    return _web(spark, d)


_FEATURED = f"""{WEB}, linked as (select *, case when starts_with(mirror_url, 'https://mirror.example.org/papers/') then mirror_url when starts_with(remote_url, 'https://mirror.example.org/papers/') then remote_url when entry_type = 'link' then remote_url else coalesce(nullif(mirror_url, ''), remote_url) end as link from records where affiliated),
picked as (select year, coalesce(nullif(subject, ''), 'General') as category, title, author, journal as source, link as url, entry_type, coalesce(case when regexp_matches(trim(year), {_FLOAT}) then try_cast(replace(trim(year), '_', '') as double)::bigint end, 0) as sort_year from linked where link <> '')"""


@query(f"with {_FEATURED} select count(*) over () as row_count, row_number() over (order by sort_year desc, source, title, year, category, author, url, entry_type) - 1 as place, year, category, title, author, source, url, entry_type from picked")
def q62_featured_payload(spark, d):
    """The featured part as one payload in its order, and its rows with their places (FI12, PR18, PR19, SO3, AG20)."""
    out = projections.payload(projections.featured(_web(spark, d), S))
    return out.select("row_count", F.posexplode("rows").alias("place", "r")).select("row_count", c("place").cast("bigint").alias("place"), "r.*")


@query(f"""with {B.INDEX}, former as (select p_brand as journal, p_name as paper, 'https://files.example.org/p/part-' || p_partkey || '.pdf' as url, 'pdf' as entry_type, p_type as subject, case when p_size < 25 then '' else 'c' end as category from part),
  a as (select distinct journal, paper, url, entry_type from index_), b as (select distinct journal, paper, url, entry_type from former)
  select 'rows' as fact, (select count(*) from index_) as exported, (select count(*) from former) as former union all select 'subject', (select count(*) from index_ where trim(subject) <> ''), (select count(*) from former where trim(subject) <> '')
  union all select 'category', (select count(*) from index_ where trim(category) <> ''), (select count(*) from former where trim(category) <> '')
  union all select 'type link', (select count(*) from index_ where entry_type = 'link'), 0 union all select 'type pdf', (select count(*) from index_ where entry_type = 'pdf'), (select count(*) from former)
  union all select 'alone', (select count(*) from (select * from a except select * from b)), (select count(*) from (select * from b except select * from a))""")
def q63_index_comparison(spark, d):
    """Two index versions: rows, coverage, types and keys of one alone (CK16, AG8-AG10, ST1, SO10)."""
    p = t(spark, d, "part")
    former = p.select(c("p_brand").alias("journal"), c("p_name").alias("paper"), F.concat(F.lit("https://files.example.org/p/part-"), c("p_partkey").cast("string"), F.lit(".pdf")).alias("url"), F.lit("pdf").alias("entry_type"), c("p_type").alias("subject"), F.when(c("p_size") < 25, "").otherwise("c").alias("category"))
    r = projections.compare(B.index(spark, d), former)
    rows = [("rows", *r["rows"]), ("subject", *r["subject"]), ("category", *r["category"]), *[(f"type {k}", r["types"][0].get(k, 0), r["types"][1].get(k, 0)) for k in sorted({*r["types"][0], *r["types"][1]})], ("alone", r["n_extra"], r["n_missing"])]
    return spark.createDataFrame(rows, "fact string, exported long, former long")


@query(f"""with {B.INDEX}, r as (select regexp_replace(lower(paper), '[^a-z0-9]', '', 'g') as title, author, regexp_extract(regexp_replace(regexp_replace(url, '#.*$', ''), '[?].*$', ''), '([^/]*)$', 1) as name, source as origin from index_),
  names as (select name, count(*) > 1 as dup from r where name <> '' group by name), f as (select name, count(*) as n from r where name <> '' group by name having count(distinct origin) > 1),
  g as (select title, author, count(*) as n, count(distinct origin) as origins, coalesce(bool_and(case when r.name <> '' then coalesce(dup, false) end), true) as caught from r left join names using (name) where length(title) >= 15 group by title, author)
  select 'name' as kind, count(*) as groups, coalesce(sum(n - 1), 0)::bigint as removable from f union all select 'title', count(*), coalesce(sum(n - 1), 0)::bigint from g where origins > 1 and not caught""")
def q64_overlaps_of_the_index(spark, d):
    """Names and titles that several sources have, titles without those whose files are known copies (AG11, AG12, FI20, FN6, FN10)."""
    rows = B.index(spark, d).select(X.norm_title("paper").alias("title"), "author", X.file_name("url").alias("name"), c("source").alias("origin"))
    total = lambda kind, df: df.agg(F.lit(kind).alias("kind"), F.count("*").alias("groups"), F.coalesce(F.sum("removable"), F.lit(0)).alias("removable"))
    return total("name", diff.cross_origin(rows, "name", "origin")).unionByName(total("title", diff.title_overlaps(rows, "title", "author", "name", "origin")))


# ---- audit: each check as its issues and its counts


def _checked(spark, d, name: str) -> DataFrame:
    issues, summary = audit.CHECKS[name](B.context(spark, d))
    said = F.array_join(F.transform(F.array_sort(F.map_entries("details")), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))), ";")
    rows = issues.select(c("severity").alias("kind"), c("message").alias("name"), said.alias("said"))
    return rows.unionAll(summary.select(F.lit("count").alias("kind"), c("key").alias("name"), c("value").cast("string").alias("said")))


def _counts(**sums: str) -> str:
    return " union all ".join(f"select 'count' as kind, '{k}' as name, ({v})::bigint::varchar as said" for k, v in sums.items())


def _issues(severity: str, message: str, source: str, **details: str) -> str:
    said = " || ';' || ".join(f"'{k}=' || coalesce(({v})::varchar, '')" for k, v in sorted(details.items()))
    return f"select '{severity}' as kind, '{message}' as name, {said} as said from {source}"


def _counted(*issues: str) -> str:
    every = " union all ".join(issues)
    return f"with {B.CANON}, found as ({every}) select * from found union all select 'count', 'issue_count', count(*)::varchar from found"


@query(f"with {B.RAW} " + _counts(portal_rows="select count(*) from portal", curated_files_rows="select count(*) from curated_files", curated_links_rows="select count(*) from curated_links", mirrors_rows="select count(*) from mirrors", registry_rows="select count(*) from registry", files_main="select count(*) from inventory where bucket = 'main'", files_other="select count(*) from inventory where bucket = 'other'"))
def q65_audit_root_inventory(spark, d):
    """Headers in their order, and rows of each root (CK1, AG1, SC2)."""
    return _checked(spark, d, "root_inventory")


def _need(*names: str) -> str:
    return "list_filter([" + ", ".join(f"case when {n} = '' then '{n}' else '' end" for n in names) + "], lambda f: f <> '')"


def _stripped(table: str, *names: str) -> str:
    return f"select ordinal, {', '.join(f'''coalesce(trim({n}), '') as {n}''' for n in names)} from {table}"


_PROCEDURAL = "regexp_matches(paper, '(?i)^(notes?$|book reviews?$)')"
_VALID = f"""with {B.RAW}, p as ({_stripped('portal', 'journal', 'paper', 'url', 'size_in_kb', 'author')}), f as ({_stripped('curated_files', 'journal', 'paper', 'url', 'size_in_kb', 'year', 'author')}), l as ({_stripped('curated_links', 'journal', 'paper', 'url', 'year', 'author')}),
  m as ({_stripped('mirrors', 'source_url', 'mirror_url')}),
  pa as (select *, {BASE.format('url')} as filename from p where url <> '' and {BASE.format('url')} <> '' and {BASE.format('url')} not in (select name from inventory where bucket = 'main')),
  fa as (select *, {BASE.format('url')} as filename from f where url <> '' and {BASE.format('url')} <> '' and {BASE.format('url')} not in (select name from inventory where bucket = 'other')),
  mu as (select * from m where source_url <> '' and source_url not in (select url from p union all select url from f))"""
_BOTH = "source_url <> '' and mirror_url <> ''"
_NOPDF = lambda u: f"{u} <> '' and not {B.PDF_PATH.format(u)}"
_NOFLOAT = lambda u: f"{u} <> '' and not regexp_matches({u}, {_FLOAT})"
_PN, _FN = _need("journal", "paper", "url", "size_in_kb"), _need("journal", "paper", "url", "year")
_BLANK_AUTHOR = f"author = '' and not {_PROCEDURAL}"
_PAIR = {"row_number": "ordinal", "source_url": "source_url", "mirror_url": "mirror_url"}
_VALID_ISSUES = " union all ".join([
    _issues("error", "Portal row is missing required fields", f"p where len({_PN}) > 0", row_number="ordinal", missing_fields=f"array_to_string({_PN}, ',')", paper="paper"),
    _issues("error", "Portal row URL does not look like a PDF", f"p where {_NOPDF('url')}", row_number="ordinal", url="url"),
    _issues("warning", "Portal row size_in_kb is not numeric", f"p where {_NOFLOAT('size_in_kb')}", row_number="ordinal", size_in_kb="size_in_kb", paper="paper"),
    _issues("warning", "Portal row journal does not match the expected pattern", r"p where journal <> '' and not regexp_matches(journal, '(?i)JRNL\D\d+\D(\d{4})\D')", row_number="ordinal", journal="journal", paper="paper"),
    _issues("info", "Portal row has blank author outside the expected procedural patterns", f"p where {_BLANK_AUTHOR}", row_number="ordinal", paper="paper", journal="journal"),
    _issues("error", "Portal row URL basename is missing from the main asset root", "pa", row_number="ordinal", filename="filename", url="url"),
    _issues("error", "Curated file row is missing required fields", f"f where len({_FN}) > 0", row_number="ordinal", missing_fields=f"array_to_string({_FN}, ',')", paper="paper"),
    _issues("warning", "Curated file year is not numeric", f"f where {_NOFLOAT('year')}", row_number="ordinal", year="year", paper="paper"),
    _issues("error", "Curated file URL does not look like a PDF", f"f where {_NOPDF('url')}", row_number="ordinal", url="url"),
    _issues("error", "Curated file URL basename is missing from the other asset root", "fa", row_number="ordinal", filename="filename", url="url"),
    _issues("error", "Curated link row is missing required fields", f"l where len({_FN}) > 0", row_number="ordinal", missing_fields=f"array_to_string({_FN}, ',')", paper="paper"),
    _issues("warning", "Curated link year is not numeric", f"l where {_NOFLOAT('year')}", row_number="ordinal", year="year", paper="paper"),
    _issues("error", "Mirror row is missing source_url or mirror_url", f"m where not ({_BOTH})", **_PAIR),
    _issues("warning", "Mirror source_url does not look like a PDF", f"m where {_NOPDF('source_url')}", row_number="ordinal", source_url="source_url"),
    _issues("warning", "Mirror mirror_url does not look like a PDF", f"m where {_NOPDF('mirror_url')}", row_number="ordinal", mirror_url="mirror_url"),
    _issues("error", "Mirror row uses the same URL for source and mirror", f"m where {_BOTH} and source_url = mirror_url", row_number="ordinal", source_url="source_url"),
    _issues("warning", "Mirror source_url does not match any PDF-backed root input URL", "mu", **_PAIR)])
_VALID_COUNTS = _counts(
    registry_blank_entries="select count(*) from registry where trim(entry) = ''", registry_duplicate_entries="select count(*) from (select entry from registry group by entry having count(*) > 1)",
    portal_missing_required=f"select count(*) from p where len({_PN}) > 0", portal_non_pdf_url=f"select count(*) from p where {_NOPDF('url')}", portal_non_numeric_size=f"select count(*) from p where {_NOFLOAT('size_in_kb')}",
    portal_unexpected_blank_author=f"select count(*) from p where {_BLANK_AUTHOR}", portal_expected_authorless=f"select count(*) from p where author = '' and {_PROCEDURAL}", portal_unmatched_local_filename="select count(*) from pa",
    curated_files_missing_required=f"select count(*) from f where len({_FN}) > 0", curated_files_non_numeric_year=f"select count(*) from f where {_NOFLOAT('year')}", curated_files_blank_size_in_kb="select count(*) from f where size_in_kb = ''", curated_files_non_pdf_url=f"select count(*) from f where {_NOPDF('url')}", curated_files_unmatched_local_filename="select count(*) from fa",
    curated_links_missing_required=f"select count(*) from l where len({_FN}) > 0", curated_links_non_numeric_year=f"select count(*) from l where {_NOFLOAT('year')}",
    mirror_missing_required=f"select count(*) from m where not ({_BOTH})", mirror_non_pdf_url=f"select (select count(*) from m where {_NOPDF('source_url')}) + (select count(*) from m where {_NOPDF('mirror_url')})", mirror_same_source_and_target=f"select count(*) from m where {_BOTH} and source_url = mirror_url", mirror_source_unmatched="select count(*) from mu")


@query(f"{_VALID} {_VALID_ISSUES} union all {_VALID_COUNTS}")
def q66_audit_root_validation(spark, d):
    """All rules over the roots: required fields, PDF paths, numbers, patterns, stored names, authors, mirrors (CK2-CK6, FI3-FI9, AG5, AG7, JN7, JN10, ST5, WN5)."""
    return _checked(spark, d, "root_input_validation")


@query(f"""with {B.CANON} select 'count' as kind, 'documents' as name, count(*)::varchar as said from documents_ union all select 'count', 'document_sources', count(*)::varchar from sources_ union all select 'count', 'asset_refs', count(*)::varchar from assets_
  union all select 'count', 'documents_by_source.' || source_root, count(*)::varchar from documents_ group by source_root union all select 'count', 'documents_by_entry_type.' || entry_type, count(*)::varchar from documents_ group by entry_type""")
def q67_audit_canonical_inventory(spark, d):
    """Counts of the canonical tables, by source and type (CK7, AG1, AG2)."""
    return _checked(spark, d, "canonical_inventory")


_D_AUTHOR = "trim(coalesce(author_display, '')) = ''"
_D_EXPECTED = "source_root = 'portal' and regexp_matches(trim(title), '(?i)^(notes?$|book reviews?$)')"
_CORE = {"title": ("error", "trim(title) = ''"), "author_display": ("warning", f"{_D_AUTHOR} and not ({_D_EXPECTED})"), "journal_label": ("warning", "trim(journal_label) = ''"), "entry_type": ("error", "trim(entry_type) = ''")}


@query(f"with {B.CANON}, " + ", ".join(f"s_{k} as (select *, row_number() over (order by source_root, doc_id) as place from documents_ where {test})" for k, (_, test) in _CORE.items()) + " "
       + " union all ".join(_issues(severity, f"Missing core field `{k}`", f"s_{k} where place <= 20", doc_id="doc_id", source_root="source_root") for k, (severity, _) in _CORE.items())
       + " union all " + _counts(**{f"missing_{k}": f"select count(*) from documents_ where {test}" for k, (_, test) in _CORE.items()}, expected_authorless=f"select count(*) from documents_ where {_D_AUTHOR} and {_D_EXPECTED}", missing_year="select count(*) from documents_ where trim(year) = ''", year_derivable="select count(*) from documents_ where trim(year) = '' and starts_with(journal_label, 'JRNL-')"))
def q68_audit_core_fields(spark, d):
    """Missing core fields, the first twenty of each kind, and their counts (CK8, FI7, WN9)."""
    return _checked(spark, d, "core_field_quality")


@query(f"""with {B.CANON} select 'count' as kind, 'documents.' || source_root as name, count(*)::varchar as said from documents_ group by source_root union all select 'count', 'affiliated.' || source_root, count_if(affiliated)::varchar from documents_ group by source_root""")
def q69_audit_deferred_fields(spark, d):
    """Documents and flagged documents by source (CK9, AG2, AG3)."""
    return _checked(spark, d, "deferred_field_status")


@query(_counted(_issues("warning", "PDF asset has no local_rel_path", "assets_ where asset_role <> 'external_link' and coalesce(local_rel_path, '') = ''", doc_id="doc_id", remote_url="remote_url"),
                _issues("error", "Mapped PDF file is missing from shared asset root", "assets_ where asset_role <> 'external_link' and coalesce(local_rel_path, '') <> '' and local_rel_path not in (select bucket || '/' || name from inventory)", doc_id="doc_id", local_rel_path="local_rel_path", remote_url="remote_url")))
def q70_audit_missing_files(spark, d):
    """File assets without a stored copy (CK10, JN8)."""
    return _checked(spark, d, "missing_local_files")


_ENCODED = "replace(replace(replace(replace(replace(url_encode(name), '%27', ''''), '%28', '('), '%29', ')'), '%26', '&'), '%2C', ',')"


@query(_counted(_issues("warning", "Shared PDF has no canonical row", f"inventory where bucket || '/' || name not in (select local_rel_path from assets_ where coalesce(local_rel_path, '') <> '') and bucket || '/' || {_ENCODED} not in (select local_rel_path from assets_ where coalesce(local_rel_path, '') <> '')", local_rel_path="bucket || '/' || name")))
def q71_audit_orphan_files(spark, d):
    """Files that nothing maps, neither by name nor encoded (CK11, JN9, FN8)."""
    return _checked(spark, d, "orphan_files")


def _shared(k: str) -> str:
    return f"(select {k}, string_agg(distinct doc_id, ',' order by doc_id) as ids from assets_ where coalesce({k}, '') <> '' group by {k} having count(distinct doc_id) > 1)"


@query(_counted(_issues("warning", "Local asset path is assigned to multiple documents", _shared("local_rel_path"), local_rel_path="local_rel_path", doc_ids="ids"), _issues("warning", "Remote URL is assigned to multiple documents", _shared("remote_url"), remote_url="remote_url", doc_ids="ids")))
def q72_audit_duplicate_mappings(spark, d):
    """Paths and URLs of several documents (CK12, AG6)."""
    return _checked(spark, d, "duplicate_asset_mappings")


@query(_counted(_issues("info", "doc_id has observed collision suffix", "documents_ where regexp_matches(doc_id, '-(0[2-9]|[1-9][0-9])$')", doc_id="doc_id", title="title", source_root="source_root")))
def q73_audit_id_collisions(spark, d):
    """Ids that look suffixed (CK13, FI10)."""
    return _checked(spark, d, "doc_id_collisions")


_HAY = "(coalesce(remote_url, '') || chr(10) || coalesce(local_rel_path, ''))"


@query(_counted(_issues("warning", "Document is marked affiliated but has no registry match", f"(select a.*, title from assets_ a join documents_ using (doc_id) where affiliated and not exists (select 1 from registry where ltrim(entry, '$') <> '' and contains({_HAY}, ltrim(entry, '$'))))", doc_id="doc_id", title="title", local_rel_path="local_rel_path", remote_url="remote_url"),
                _issues("info", "Registry entry does not match any canonical asset", f"registry where not exists (select 1 from assets_ where contains({_HAY}, ltrim(entry, '$')))", registry_entry="entry")))
def q74_audit_registry(spark, d):
    """Flagged documents with an asset that no fragment matches, and fragments without an asset (CK14, JN6, JN11, JN12)."""
    return _checked(spark, d, "registry_mismatches")


def _no_asset(side: str, roles: str) -> str:
    return f"mirrors where coalesce(trim({side}), '') not in (select remote_url from assets_ where asset_role in ({roles}) and coalesce(remote_url, '') <> '')"


_SIDES = {"source_url": "coalesce(trim(source_url), '')", "mirror_url": "coalesce(trim(mirror_url), '')"}


@query(_counted(_issues("error", "Mirror registry source_url does not match any canonical primary asset", _no_asset("source_url", "'primary_pdf', 'external_link'"), **_SIDES), _issues("error", "Mirror registry mirror_url does not match any canonical mirror asset", _no_asset("mirror_url", "'mirror_pdf'"), **_SIDES)))
def q75_audit_mirrors(spark, d):
    """Mirror rows whose sides no asset has (CK15, JN10)."""
    return _checked(spark, d, "mirror_registry_mismatches")


_SOME = ("doc_id_collisions", "mirror_registry_mismatches")


@query(f"""with {B.CANON}, found as (select 'doc_id_collisions' as "check", 'info' as severity, doc_id as k from documents_ where regexp_matches(doc_id, '-(0[2-9]|[1-9][0-9])$')
  union all select 'mirror_registry_mismatches', 'error', source_url from {_no_asset("source_url", "'primary_pdf', 'external_link'")} union all select 'mirror_registry_mismatches', 'error', mirror_url from {_no_asset("mirror_url", "'mirror_pdf'")})
  select "check", severity, count(*) as n from found group by all""")
def q76_audit_issue_folder(spark, d):
    """All issues of chosen checks, in the order of their names, written by the executors as JSON lines and read back (SK11, AG4, AG19, SO2, SO14)."""
    ctx = B.context(spark, d)
    ctx = audit.AuditContext(ctx.roots, audit.scans(ctx)["documents"], ctx.sources, ctx.assets, ctx.settings)
    folder = sinks.audit_issues(audit.issues(ctx, [n for n in audit.check_names() if n in _SOME]), places.scratch(spark, "issues"))
    return spark.read.schema(f"{audit.ISSUE}, check string").json(folder).groupBy("check", "severity").agg(F.count("*").alias("n"))


# ---- files and listings


def _as_file(df: DataFrame, order: str, line: str = "line") -> str:
    """Lines as a folder of text parts in order, written by the executors."""
    folder = places.scratch(df.sparkSession, "lines")
    df.orderBy(order).select(line).write.text(folder)
    return folder


@query("select doc_id + 1 as ordinal, doc_id::varchar as doc_id, md5(text) as text_md5, nullif(source, '') as source, 5 as n_columns from (select row_number() over (order by doc_id) - 1 as doc_id, text, source from documents)")
def q77_tsv_round_trip(spark, d):
    """A delimited table with quotes and line ends inside its fields, written in ordered parts and read with ordinals, all as text (SC1-SC3, SC12, SC13, SC20, SK9, SK16, SK18)."""
    folder = places.scratch(spark, "tsv")
    rows = t(spark, d, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    sinks.table_folder(rows.orderBy("doc_id"), folder)
    one = readers.tsv(spark, folder, ordinal=True)
    return one.select("ordinal", "doc_id", F.md5("text").alias("text_md5"), "source", F.lit(len(readers.headers(spark, folder))).alias("n_columns"))


@query("select row_number() over (order by p_partkey) as ordinal, p_name as entry from part qualify p_partkey % 5 <> 0 and p_partkey % 7 <> 0")
def q78_registry_file(spark, d):
    """A registry file: stripped lines with their places, comments and blank lines left out (SC4, FN1, FN29)."""
    p = t(spark, d, "part")
    line = F.when(c("p_partkey") % 5 == 0, F.concat(F.lit(" # "), "p_name")).when(c("p_partkey") % 7 == 0, F.lit(" \t ")).otherwise(F.concat(F.lit("\t"), "p_name", F.lit("  ")))
    return readers.registry(spark, _as_file(p.select("p_partkey", line.alias("line")), "p_partkey")).select("ordinal", "entry")


@query(f"with {B.RAW} select trim(source_url) as source_url, arg_max(trim(mirror_url), ordinal) as mirror_url from mirrors where trim(source_url) <> '' and trim(mirror_url) <> '' group by 1")
def q79_mirror_file(spark, d):
    """A mirror file and its map, last filled row of a source first; a file that isn't there adds none (SC5, JN3)."""
    folder = places.scratch(spark, "mirrors")
    sinks.table_folder(B.bound(spark, d, B.ROOTS["mirrors"]).orderBy("ordinal").select("source_url", "mirror_url"), folder)
    return readers.mirror_map(readers.mirrors(spark, folder).unionByName(readers.mirrors(spark, folder + "-none")))


@query("""with v as (select 'n' || left(sha256(string_agg(n_name || chr(10), '' order by n_nationkey)), 8) as version from nation)
  select 'main' as bucket, n_name || '.pdf' as name, (length(n_name) + 1)::bigint as bytes, lower(n_name) || '.pdf' as known, version from nation, v""")
def q80_file_inventory(spark, d):
    """Stored files by bucket, name and size, the index of known names, and a file's version (SC6, SC8, SC17, SC18, FN22)."""
    rows = t(spark, d, "nation").select("n_nationkey", "n_name")
    root = places.scratch(spark, "files")
    for r in rows.toLocalIterator():  # the twenty-five files of this fixture
        sinks.written(spark, f"{root}/{r['n_name']}.pdf", [r["n_name"] + "\n"])
    listing = places.scratch(spark, "listing") + ".txt"
    sinks.written(spark, listing, (r["n_name"] + "\n" for r in rows.orderBy("n_nationkey").toLocalIterator()))
    found = readers.inventory(spark, {"main": root, "other": root + "-none"})
    known = readers.known_names(spark, [root, root + "-none"]).select(c("name").alias("known"))
    return found.join(known, F.lower("name") == c("known")).withColumn("version", F.lit("n" + readers.file_version(spark, listing)))


@query("select o_custkey::varchar as name, arg_max(o_orderkey, o_orderpriority || '/' || lpad(o_orderkey::varchar, 9, '0') || '/' || o_custkey)::bigint as bytes from orders group by 1")
def q81_remote_listing(spark, d):
    """Objects of a remote listing by their last segment, the last by full name (SC19)."""
    rows = t(spark, d, "orders").select(F.concat("o_orderpriority", F.lit("/"), F.lpad(c("o_orderkey").cast("string"), 9, "0"), F.lit("/"), c("o_custkey").cast("string")).alias("name"), c("o_orderkey").cast("long").alias("bytes"))
    return readers.remote_listing(rows.unionByName(rows.select(F.concat("name", F.lit("/")).alias("name"), "bytes")))


@query("select row_number() over (order by p_partkey) + 3 as ordinal, p_brand as journal, case when p_partkey % 2 = 0 then '[' || p_name || '](u' || p_partkey || ')' else p_name end as paper, p_name as title, 'u' || p_partkey as url, p_type as author from part qualify p_partkey % 9 <> 4")
def q82_markdown_listing(spark, d):
    """A listing in markdown whose columns are found by name, with the titles of links (SC15, PR26, FN30)."""
    p = t(spark, d, "part")
    paper = F.when(c("p_partkey") % 2 == 0, F.concat(F.lit("["), "p_name", F.lit("](u"), c("p_partkey").cast("string"), F.lit(")"))).otherwise(c("p_name"))
    line = F.when(c("p_partkey") % 9 == 4, F.lit("| too | short |")).otherwise(F.concat(F.lit("| "), c("p_partkey").cast("string"), F.lit(" | "), "p_brand", F.lit(" |  "), paper, F.lit("| "), "p_type", F.lit(" |")))
    head = spark.createDataFrame([(-3, "# A listing"), (-2, "| # | Journal | Paper | Author |"), (-1, "|---|---|---|---|")], "p_partkey long, line string")
    rows = readers.lines(spark, _as_file(head.unionByName(p.select(c("p_partkey").cast("long").alias("p_partkey"), line.alias("line"))), "p_partkey"))
    found = readers.named_listing(rows).withColumn("l", readers.linked(c("paper")))
    number = X.partition(F.substring("line", F.lit(3), F.lit(20)), " ")["head"]
    return found.select("ordinal", "journal", "paper", c("l.title").alias("title"), F.coalesce("l.url", F.concat(F.lit("u"), number)).alias("url"), "author")


@query("select n_nationkey + 4 as ordinal, n_nationkey::varchar as a, n_name as b, regexp_extract('J 12, ' || (1990 + n_nationkey) || ' b', '([0-9]{4})', 1) as year from nation")
def q83_marked_listing(spark, d):
    """Cells by place of the lines after a marker, up to the first line without a pipe, and years in them (SC16, FN9, FN13, FN30)."""
    n = t(spark, d, "nation").select(c("n_nationkey").cast("long").alias("k"), F.concat(F.lit("| "), c("n_nationkey").cast("string"), F.lit("|"), "n_name", F.lit(" | J 12, "), (c("n_nationkey") + 1990).cast("string"), F.lit(" b |")).alias("line"))
    more = spark.createDataFrame([(-3, "| before | this |"), (-2, "| # | Nation |"), (-1, "|--|--|"), (1 << 40, ""), (1 << 41, "| not | this |")], "k long, line string")
    rows = readers.marked_listing(readers.lines(spark, _as_file(n.unionByName(more), "k")), "| # | Nation |")
    return rows.select("ordinal", c("cells")[0].alias("a"), c("cells")[1].alias("b"), X.first_year(c("cells")[2]).alias("year"))


@query("select 'JRNL-No.-' || r_regionkey as journal, n_name as paper, 'By ' || n_nationkey as author, 'https://h.example.org/f/' || n_name || '%20' || n_nationkey || '.pdf' as url from nation join region on n_regionkey = r_regionkey")
def q84_html_listing(spark, d):
    """Entries of saved listing pages, one page a region: links, authors and journals; a page read twice adds nothing (SC14, PR23, PR25)."""
    entry = F.concat(F.lit('<div class="question col-xs-11"><a href="../f/'), "n_name", F.lit(" "), c("n_nationkey").cast("string"), F.lit('.pdf">'), "n_name", F.lit("</a></div><div>x</div><div>By "), c("n_nationkey").cast("string"), F.lit("</div>"))
    pages = t(spark, d, "nation").groupBy("n_regionkey").agg(F.array_join(F.sort_array(F.collect_list(entry)), " ").alias("e")).join(t(spark, d, "region"), c("n_regionkey") == c("r_regionkey"))
    html = F.concat(F.lit('<div class="col-xs-8"><table><tbody><tr><td>Journal of Record</td><td>No. '), c("r_regionkey").cast("string"), F.lit("</td></tr></tbody></table></div> "), "e")
    copies = pages.select(html.alias("value"), F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"), "r_regionkey")
    folder = places.scratch(spark, "pages")
    copies.repartition(1).write.partitionBy("copy", "r_regionkey").text(folder)
    return readers.html_listing(spark, folder, "https://h.example.org", "Journal of Record", "JRNL")


@query("select doc_id, journal, title, 'General' as subject, 'Other' as category from (select doc_id, source as journal, 'T' || doc_id as title from documents)")
def q85_classes_with_cache(spark, d):
    """Titles classified in batches by an injected classifier, kept in a folder by key, and read from there the second time (SC27, SC28)."""
    queue = t(spark, d, "documents").select(c("doc_id").alias("doc"), c("source").alias("journal"), F.concat(F.lit("T"), c("doc_id").cast("string")).alias("paper"), F.lit(None).cast("string").alias("subject"))
    folder = places.scratch(spark, "classes")
    for _ in range(2):
        kept = legacy.classified_with_cache(queue, legacy.stub_classifier, folder)
    return kept.select(F.substring("paper", F.lit(2), F.lit(20)).cast("bigint").alias("doc_id"), "journal", c("paper").alias("title"), "subject", "category")


@query("""with q as (select doc_id as ordinal, source as journal, case when doc_id % 6 = 0 then ' News of ' || doc_id when doc_id % 6 = 1 then 'Same title' else 'Study ' || doc_id end as paper, case when doc_id % 5 = 0 then null else 'u' || (doc_id % 97) end as url from documents),
  k as (select * from q where url is null union all select ordinal, journal, paper, url from (select *, row_number() over (partition by url order by ordinal) as n from q where url is not null) where n = 1),
  done as (select distinct source as journal, 'Study ' || l.doc_id as paper from labels l join documents using (doc_id))
  select ordinal, case when contains(lower(paper), 'news') then 'Other' end as category from k where not exists (select 1 from done where done.journal is not distinct from k.journal and done.paper = trim(k.paper))""")
def q86_classification_queue(spark, d):
    """Rows with a first URL or none that are not classified yet, noise titles labelled (FI17-FI19, JN15, WN2)."""
    docs = t(spark, d, "documents")
    k = c("doc_id")
    paper = F.when(k % 6 == 0, F.concat(F.lit(" News of "), k.cast("string"))).when(k % 6 == 1, "Same title").otherwise(F.concat(F.lit("Study "), k.cast("string")))
    source = docs.select(k.alias("ordinal"), c("source").alias("journal"), paper.alias("paper"), F.when(k % 5 != 0, F.concat(F.lit("u"), (k % 97).cast("string"))).alias("url"))
    done = docs.join(t(spark, d, "labels").select("doc_id"), "doc_id").select(c("source").alias("journal"), F.concat(F.lit("Study "), k.cast("string")).alias("paper"), F.lit("s").alias("subject"), F.lit("c").alias("category"))
    return legacy.classification_queue(source, done).select("ordinal", "category")


# ---- corrections, imports and triage


@query("""with f as (select doc_id, case doc_id % 6 when 0 then 'annals_' || doc_id || '_on_the-stars.pdf' when 1 then 'BULL_a_' || doc_id || '.pdf' when 2 then 'own-long-tale-' || doc_id || '.pdf' when 3 then 'the_gazette_' || doc_id || '.pdf' when 4 then 'plain-name_' || doc_id || '.pdf' else 'annals_x' || doc_id || '.pdf' end as name from documents)
  select doc_id, name, case doc_id % 6 when 0 then 'Annals' when 1 then 'Bulletin' when 2 then 'Other' when 3 then 'Gazette' when 4 then 'Other' else 'Annals' end as journal,
  case doc_id % 6 when 0 then 'On The-Stars' when 1 then 'BULL a ' || doc_id when 2 then 'Long Tale ' || doc_id when 3 then 'The Gazette ' || doc_id when 4 then 'Plain Name ' || doc_id else 'annals_x' || doc_id end as title, 'House Author' as author from f""")
def q87_names_of_files(spark, d):
    """Journal, title and author from file names by rule (PR22, FN4, FN26)."""
    k = c("doc_id").cast("string")
    name = F.element_at(F.array(F.concat(F.lit("annals_"), k, F.lit("_on_the-stars.pdf")), F.concat(F.lit("BULL_a_"), k, F.lit(".pdf")), F.concat(F.lit("own-long-tale-"), k, F.lit(".pdf")), F.concat(F.lit("the_gazette_"), k, F.lit(".pdf")), F.concat(F.lit("plain-name_"), k, F.lit(".pdf")), F.concat(F.lit("annals_x"), k, F.lit(".pdf"))), (c("doc_id") % 6 + 1).cast("int"))
    rows = t(spark, d, "documents").select("doc_id", name.alias("name"))
    return rows.withColumn("m", legacy.metadata_of_name(c("name"), S)).select("doc_id", "name", "m.journal", "m.title", "m.author")


@query("""with f as (select doc_id, n_chars * 10 as bytes from documents) select 'Other' as journal, 'Plain ' || doc_id as paper, 'Indic' as category, (bytes // 1024)::varchar as size_in_kb, 'https://mirror.example.org/papers/plain-' || doc_id || '.pdf' as mirror_url, 'other/plain-' || doc_id || '.pdf' as object_key, 'true' as affiliated
  from f where doc_id not in (select doc_id from labels) and doc_id not in (select page_id from pages)""")
def q88_ingested_files(spark, d):
    """Index rows for the files that triage finds new (FI21, JN21, ST6, ST7, FN7, FN27)."""
    name = lambda k: F.concat(F.lit("plain-"), c(k).cast("string"), F.lit(".pdf")).alias("name")
    files = t(spark, d, "documents").select(name("doc_id"), (c("n_chars") * 10).alias("bytes"))
    index = t(spark, d, "pages").select(F.concat(F.lit("http://h/plain-"), c("page_id").cast("string"), F.lit(".pdf")).alias("url"), F.lit(None).cast("string").alias("mirror_url"))
    return legacy.ingested(legacy.triage(files, t(spark, d, "labels").select(name("doc_id")), index), S).select("journal", "paper", "category", "size_in_kb", "mirror_url", "object_key", "affiliated")


@query(f"""with x as (select p_partkey as id, p_brand as journal, p_name as paper, case when p_partkey % 3 = 0 then '' else ' https://h/' || p_partkey || '.pdf?q' end as url, case when p_partkey % 4 = 0 then 'https://m/a/' || p_partkey || '.pdf' else '' end as mirror_url, case p_partkey % 5 when 0 then 'TRUE' when 1 then ' true' else 'no' end as affiliated from part)
  select journal, paper, trim(url) as url_, mirror_url, case when lower(trim(affiliated)) = 'true' then 'true' else 'false' end as affiliated, 'pdf' as entry_type, 'portal' as source, case when trim(url) <> '' then 'main/' || id || '.pdf?q' when mirror_url <> '' then 'other/' || id || '.pdf' else '' end as object_key, 'false' as object_synced, '' as subject from x""")
def q89_migrated_index(spark, d):
    """Ten columns to fourteen, with keys of the stored copies (PR20, PR21, FN7)."""
    return legacy.migrated(_old_index(spark, d), S).select("journal", "paper", X.clean("url").alias("url_"), "mirror_url", "affiliated", "entry_type", "source", "object_key", "object_synced", "subject")


def _old_index(spark, d) -> DataFrame:
    k = c("p_partkey")
    return t(spark, d, "part").select(c("p_brand").alias("journal"), c("p_name").alias("paper"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit(" https://h/"), k.cast("string"), F.lit(".pdf?q"))).alias("url"), F.when(k % 4 == 0, F.concat(F.lit("https://m/a/"), k.cast("string"), F.lit(".pdf"))).otherwise("").alias("mirror_url"), F.when(k % 5 == 0, "TRUE").when(k % 5 == 1, " true").otherwise("no").alias("affiliated"))


@query("""select count(*) as rows, count_if(p_partkey % 5 < 2)::bigint as flagged, count_if(p_partkey % 5 < 2 and p_partkey % 3 = 0)::bigint as flagged_without_url, count_if(p_partkey % 3 = 0 and p_partkey % 4 <> 0)::bigint as keyless from part""")
def q90_migration_counts(spark, d):
    """What a migration would do, counted in one scan (AG17)."""
    return legacy.migration_counts(legacy.migrated(_old_index(spark, d), S))


@query("""with a as (select p_name, p_brand, case when p_brand = 'Brand#1' and contains(p_name, 'a') then 'Brand#2' else p_brand end as j from part)
  select count_if(p_brand = 'Brand#1' and contains(p_name, 'a'))::bigint as journal_0, count_if(j = 'Brand#2' and contains(p_name, 'e'))::bigint as journal_1, count_if(contains(p_name, 'o'))::bigint as author_0, count_if(contains(p_name, 'g'))::bigint as author_1 from a""")
def q91_patch_counts(spark, d):
    """Rows that each correction changes; a row may count for several (AG16)."""
    rows = t(spark, d, "part").select(c("p_brand").alias("journal"), c("p_name").alias("url"))
    return legacy.patch_counts(rows, [legacy.JournalRule("Brand#1", "a", "Brand#2"), legacy.JournalRule("Brand#2", "e", "Brand#3")], [("o", "x"), ("g", "y")])


@query("""select page_id, case when contains(url, 'www.') then 'true' when page_id % 7 = 0 then null else 'false' end as affiliated from pages""")
def q92_flag_mirrored(spark, d):
    """Rows whose mirror names the institution are flagged; others keep their flag (UP4)."""
    rows = t(spark, d, "pages").select("page_id", c("url").alias("mirror_url"), F.when(c("page_id") % 7 != 0, "false").alias("affiliated"))
    return legacy.flag_mirrored(rows, "www.").drop("mirror_url")


@query("""with o as (select p_partkey, case when p_partkey % 3 = 0 then 'https://h/writereaddata/Vol9_' || p_partkey when p_partkey % 3 = 1 then 'https://h/(S(1))/writereaddata/' || p_partkey || '.PDF' else 'https://h/x/' || p_partkey || '.pdf' end as u from part)
  select p_partkey as id, case when p_partkey % 3 = 0 then 'https://h(S(session))/writereaddata/Vol09_' || p_partkey || '.pdf' else u end as url, printf('jrnl_%04d_%02d_', 1990 + p_partkey % 30, p_partkey % 50) || case when p_partkey % 4 = 0 then '03-4' else printf('%02d', p_partkey % 4) end as issue from o""")
def q93_portal_metadata(spark, d):
    """Repaired links and issue ids of options (FI22, PR23, PR24, FN24)."""
    k = c("p_partkey")
    url = F.when(k % 3 == 0, F.concat(F.lit("https://h/writereaddata/Vol9_"), k.cast("string"))).when(k % 3 == 1, F.concat(F.lit("https://h/(S(1))/writereaddata/"), k.cast("string"), F.lit(".PDF"))).otherwise(F.concat(F.lit("https://h/x/"), k.cast("string"), F.lit(".pdf")))
    option = F.concat(F.lit("Year "), (k % 30 + 1990).cast("string"), F.lit(", Volume "), (k % 50).cast("string"), F.lit(", Issue "), F.when(k % 4 == 0, "3&4").otherwise((k % 4).cast("string")))
    return t(spark, d, "part").select(k.alias("id"), legacy.repaired_url(url, S).alias("url"), legacy.issue_id(option).alias("issue"))


@query("""with o as (select p_partkey as id, 'Year ' || (1990 + p_partkey % 30) || ', Volume ' || (p_partkey % 50) as option from part),
  w as (select * from o where (contains(option, '1995') and contains(lower(option), 'volume 5')) or contains(option, '2003')) select 'wanted' as kind, id from w union all select 'all', id from o""")
def q94_target_issues(spark, d):
    """Options that hold all words of a wanted issue; all of them where none does (FI23)."""
    o = t(spark, d, "part").select(c("p_partkey").alias("id"), F.concat(F.lit("Year "), (c("p_partkey") % 30 + 1990).cast("string"), F.lit(", Volume "), (c("p_partkey") % 50).cast("string")).alias("option"))
    some, every = legacy.target_issues(o, [["1995", "VOLUME 5"], ["2003"]]), legacy.target_issues(o, [["never"]])
    return some.select(F.lit("wanted").alias("kind"), "id").unionByName(every.select(F.lit("all").alias("kind"), "id"))


@query("select distinct url, lower(regexp_extract(url, '([^/]*)$', 1)) as name from pages where lower(regexp_extract(url, '([^/]*)$', 1)) not in (select doc_id || '.html' from documents)")
def q95_to_download(spark, d):
    """Links whose last segment no stored file has (FI24, SC17)."""
    known = t(spark, d, "documents").select(F.concat(c("doc_id").cast("string"), F.lit(".html")).alias("name"))
    return legacy.to_download(t(spark, d, "pages"), known).select("url", "name")


_INCOMING = """i as (select doc_id + 1 as ordinal, case when doc_id % 2 = 0 then 1 else 2 end as part, case when doc_id % 3 = 0 then 'Études ' else 'Etudes ' end || (doc_id % 90) as title, case when doc_id % 17 = 0 then null when doc_id % 4 = 0 then 'https://mirror.example.org/assets/' || (doc_id % 150) || '.pdf' when doc_id % 4 = 1 then 'https://else.example.net/' || (doc_id % 150) else 'https://mirror.example.org/assets/x' || doc_id || '.pdf' end as url,
    case when doc_id % 5 = 0 then '' else (1990 + doc_id % 7)::varchar end as year, lang as journal, source as author from documents),
  w as (select page_id + 1 as ordinal, 'études ' || (page_id % 120) as paper, case when page_id % 2 = 0 then 'https://else.example.net/' || page_id else 'https://own.example.net/' || page_id end as url, case when page_id % 3 = 0 then '' else (1990 + page_id % 7) || '.0' end as year, case when page_id % 10 = 9 then 'have' else '' end as mirror_url from pages),
  s as (select * from (select *, row_number() over (partition by url order by part, ordinal) as n from i where url is not null) where part = 1 or n = 1),
  k as (select *, regexp_replace(lower(strip_accents(title)), '[^a-z0-9]', '', 'g') as t from s where url not in (select url from w)),
  m as (select k.part, k.ordinal, w.ordinal as target, w.mirror_url = '' as blank, k.url, row_number() over (partition by k.part, k.ordinal order by case when k.year <> '' and split_part(w.year, '.', 1) = k.year then 0 when split_part(w.year, '.', 1) = '' then 1 else 2 end, w.ordinal) as n
    from k join w on k.t = regexp_replace(lower(strip_accents(w.paper)), '[^a-z0-9]', '', 'g') where contains(k.url, 'mirror.example.org')),
  l as (select * from (select *, row_number() over (partition by target order by part, ordinal) as place from m where n = 1 and blank) where place = 1)"""


def _imported(spark, d) -> tuple[DataFrame, DataFrame]:
    k = c("doc_id")
    at = F.concat(F.lit("../assets/"), (k % 150).cast("string"), F.lit(".pdf"))
    url = F.when(k % 17 == 0, None).when(k % 4 == 0, at).when(k % 4 == 1, F.concat(F.lit("https://else.example.net/"), (k % 150).cast("string"))).otherwise(F.concat(F.lit("https://mirror.example.org/assets/x"), k.cast("string"), F.lit(".pdf")))
    inc = t(spark, d, "documents").select((k + 1).alias("ordinal"), F.when(k % 2 == 0, 1).otherwise(2).alias("part"), F.concat(F.when(k % 3 == 0, "Études ").otherwise("Etudes "), (k % 90).cast("string")).alias("title"), url.alias("url"), F.when(k % 5 == 0, "").otherwise((k % 7 + 1990).cast("string")).alias("year"), c("lang").alias("journal"), c("source").alias("author"), F.lit("9").alias("size"))
    g = c("page_id")
    table = t(spark, d, "pages").select((g + 1).alias("ordinal"), F.concat(F.lit("études "), (g % 120).cast("string")).alias("paper"), F.concat(F.when(g % 2 == 0, "https://else.example.net/").otherwise("https://own.example.net/"), g.cast("string")).alias("url"), F.when(g % 3 == 0, "").otherwise(F.concat((g % 7 + 1990).cast("string"), F.lit(".0"))).alias("year"), F.when(g % 10 == 9, "have").otherwise("").alias("mirror_url"))
    return legacy.import_links(inc, table, S)


@query(f"with {_INCOMING} select w.ordinal, coalesce(nullif(w.mirror_url, ''), l.url, '') as mirror_url from w left join l on l.target = w.ordinal")
def q96_import_fills_mirrors(spark, d):
    """Listed links fill the blank slot of the row that fits best by title and year; the first one gets it (JN18, UP5, PR27, FN11, FN17)."""
    return _imported(spark, d)[0].select("ordinal", "mirror_url")


@query(f"with {_INCOMING} select k.part, k.ordinal, title as paper, url, case when contains(url, 'mirror.example.org') then url else '' end as mirror_url, case when part = 1 then '0' else '9' end as size_in_kb from k where not exists (select 1 from l where l.part = k.part and l.ordinal = k.ordinal)")
def q97_import_new_entries(spark, d):
    """Listed links without a row to fill (JN19, FI25, ST4)."""
    return _imported(spark, d)[1].select("part", "ordinal", "paper", "url", "mirror_url", "size_in_kb")


@query(f"""with n as (select page_id as ordinal, url, regexp_extract(regexp_replace(regexp_replace(url, '#.*$', ''), '[?].*$', ''), '([^/]*)$', 1) as name from pages)
  select ordinal from (select *, row_number() over (partition by name order by contains(url, 'www.') desc, ordinal) as k from n) where trim(name) = '' or k = 1""")
def q98_files_without_copies(spark, d):
    """One row a file name, rows of a host first; rows without a name stay (WN4, SO13, FN6)."""
    return legacy.deduplicated_files(t(spark, d, "pages").select(c("page_id").alias("ordinal"), "url"), "www.").select("ordinal")


# ---- search and reports


@query("with r as (select p_partkey as id, p_name || ' ' || p_partkey as title from part) select id, title, row_number() over (order by title, id)::int as place from r")
def q99_titles_by_collation(spark, d):
    """Every title in collation order with its place (SO6)."""
    rows = t(spark, d, "part").select(c("p_partkey").alias("id"), F.concat("p_name", F.lit(" "), c("p_partkey").cast("string")).alias("title"))
    return identity.numbered(rows, search.order(SearchRequest(sort="title"), ["id"]), "place")


@query("""with n as (select page_id, url, split_part(regexp_extract(url, '([^/]*)$', 1), '?', 1) as name from pages)
  select page_id, case when page_id % 3 = 0 then '/archive?file=assets%2Fother%2Fp%20' || page_id || '.pdf' when name <> '' then '/archive?file=assets%2Fmain%2F' || replace(name, '#', '%23') else coalesce(nullif(url, ''), '#') end as href from n""")
def q100_archive_links(spark, d):
    """Routes to stored copies, by key or by name, percent-encoded (PR33, FN28)."""
    key = F.when(c("page_id") % 3 == 0, F.concat(F.lit("other/p "), c("page_id").cast("string"), F.lit(".pdf"))).otherwise("")
    return t(spark, d, "pages").select("page_id", search.archive_link(key, c("url"), S).alias("href"))


@query(f"with {PAPERS} select id from papers where contains(upper(title || ' ' || subject || ' ' || category), 'ECONOMY') and contains(upper(category), 'BRAND#2')")
def q101_table_filter(spark, d):
    """Rows of a report whose text and category hold the words (FI27, FI28)."""
    p = t(spark, d, "part").select(c("p_partkey").alias("id"), c("p_name").alias("title"), c("p_type").alias("subject"), c("p_brand").alias("category"))
    return search.table_filter(p, ["title", "subject", "category"], "economy", "brand#2").select("id")


@query("""select p_partkey as id, case when trim(p_brand) in ('', 'nan', 'NaN') or p_partkey % 3 = 0 then 'Uncategorized' else p_brand end as category, case when p_partkey % 4 < 2 then 'General' else p_type end as subject from part""")
def q102_facet_defaults(spark, d):
    """Facet values with their defaults (PR29)."""
    k = c("p_partkey")
    return t(spark, d, "part").select(k.alias("id"), X.safe_category(F.when(k % 3 != 0, c("p_brand")).otherwise("nan")).alias("category"), X.safe_subject(F.when(k % 4 == 0, "").when(k % 4 != 1, c("p_type"))).alias("subject"))


@query("""with f as (select user_id, list({'query': event_type, 'rx': event_id % 2 = 0, 'ts': event_id} order by event_id)[1:8] as s from events group by user_id)
  select user_id, len(s)::int as n, array_to_string(list_transform(s, lambda x: x.query || ':' || x.rx::varchar || ':' || x.ts::varchar), ',') as said from f""")
def q103_saved_searches(spark, d):
    """Saved searches of each user from JSON, checked and cut to eight (SC24, D18)."""
    e = t(spark, d, "events").groupBy("user_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda x: F.struct(x["event_type"].alias("query"), (x["event_id"] % 2 == 0).alias("useRegex"), x["event_id"].cast("double").alias("ts")))).alias("saved"))
    said = F.array_join(F.transform("recent", lambda x: F.concat_ws(":", x["query"], x["use_regex"].cast("string"), x["ts"].cast("bigint").cast("string"))), ",")
    return readers.recent_searches(e).select("user_id", F.size("recent").alias("n"), said.alias("said"))


@query("select 'true' as chosen, 'a b|X,Y|true|dark|true|' as request, 11 as n_checks, 'canonical_inventory' as first_check, 'root_inventory' as last_check, 'a,b' as fenced")
def q104_configuration(spark, d):
    """Places, requests and names that a driver reads from its settings (SC21, SC23, SO14, FN21)."""
    r = SearchRequest.from_query("?search=a+b&category=X,%20Y,&affiliated=1&theme=dark&embed=1")
    said = "|".join([r.search, ",".join(r.categories), str(r.affiliated_only).lower(), r.theme or "", str(r.embedded).lower(), ",".join(r.subjects)])
    names = audit.check_names()
    chosen = str(readers.asset_root([None, "/nowhere", d], ("region.parquet",)) == d).lower()
    row = spark.createDataFrame([(chosen, said, len(names), names[0], names[-1], "Here:\n```json\na,b\n```\nbye")], "chosen string, request string, n_checks int, first_check string, last_check string, f string")
    return row.withColumn("fenced", X.fenced_json("f")).drop("f")


@query(f"with {WEB} select title, remote_url, mirror_url, coalesce(local_path, '') as local_path, size, affiliated from records")
def q105_web_payload(spark, d):
    """Search records written as JSON lines and read as a payload (SC22, SK13)."""
    folder = places.scratch(spark, "payload")
    _web(spark, d).write.json(folder)
    return readers.web_payload(spark, folder).select("title", "remote_url", "mirror_url", F.coalesce("local_path", F.lit("")).alias("local_path"), "size", "affiliated")


@query("""select row_number() over (order by r_name, n_name)::int as row_number, 'JRNL ' || r_name as journal, '[' || replace(n_name, '|', '-') || '](h/' || n_nationkey || '%20x)' as paper, '' as subject, 'n-' || n_regionkey as category, n_name as author, (n_nationkey * 3)::varchar as size, '{"n_name":"' || n_name || '","none":null}' as note from nation join region on n_regionkey = r_regionkey""")
def q106_printed_report(spark, d):
    """Cells of the printed report, and review notes as JSON (PR38, WN8, SK17, SK24, SK26)."""
    rows = t(spark, d, "nation").join(t(spark, d, "region"), c("n_regionkey") == c("r_regionkey"))
    rows = rows.select(F.concat(F.lit("Journal of Record "), "r_name").alias("journal"), c("n_name").alias("paper"), F.lit(None).cast("string").alias("subject"), F.concat(F.lit("n|"), c("n_regionkey").cast("string")).alias("category"), F.concat(F.lit("h/"), c("n_nationkey").cast("string"), F.lit(" x")).alias("url"), F.concat((c("n_nationkey") * 3).cast("string"), F.lit(".7")).alias("size_in_kb"), c("n_name").alias("author"))
    notes = sinks.review_notes(t(spark, d, "nation").select("n_name", F.lit(None).cast("string").alias("none")), ["n_name", "none"])
    notes = notes.withColumn("author", F.get_json_object("note", "$.n_name"))
    return legacy.report_rows(rows, S.journal_name, S.journal_code).join(notes, "author")


@query("""with p as (select coalesce(c_custkey, s_suppkey * 20) as name, case when s_suppkey is null then 'NEW' when c_custkey is null then 'ORPHAN' when c_nationkey % 5 = s_nationkey % 5 then 'CURRENT' else 'UPDATE' end as action from customer full join supplier on c_custkey = s_suppkey * 20)
  select action, name, place::int as place, greatest(n - 10, 0)::bigint as more from (select *, row_number() over (partition by action order by name) as place, count(*) over (partition by action) as n from p) where place <= 10""")
def q107_plan_listing(spark, d):
    """The first ten names of each action and how many more there are (SO11, AG18)."""
    a = t(spark, d, "customer").select(c("c_custkey").alias("name"), (c("c_nationkey") % 5).alias("bytes"))
    b = t(spark, d, "supplier").select((c("s_suppkey") * 20).alias("name"), (c("s_nationkey") % 5).alias("bytes"))
    return diff.plan_listing(diff.inventory_diff(a, b, ["name"]), "name", 10).select("action", "name", "place", "more")


@query("""with a as (select p_partkey as id, p_brand as grp, p_name as title from part), b as (select s_suppkey as id, 'Brand#' || s_nationkey as grp, (select any_value(p_name) from part where p_partkey = s_suppkey) as title from supplier),
  o as (select * from a where not exists (select 1 from b where b.grp = a.grp and b.title = a.title)), f as (select title, arg_min(grp, id) as moved_to from b group by title),
  r as (select id, grp, title, moved_to, case when moved_to is null then 'missing' else 'moved' end as status from o left join f using (title)) select id, grp, title, moved_to, status from r""")
def q108_gap_listing(spark, d):
    """Moved and missing rows of one listing against another, in report order (JN16, JN17, SO12)."""
    a = t(spark, d, "part").select(c("p_partkey").alias("id"), c("p_brand").alias("grp"), c("p_name").alias("title"))
    names = a.select(c("id").alias("s_suppkey"), "title")
    b = t(spark, d, "supplier").join(names, "s_suppkey", "left").select(c("s_suppkey").alias("id"), F.concat(F.lit("Brand#"), c("s_nationkey").cast("string")).alias("grp"), "title")
    return diff.gap_listing(diff.moved_and_missing(a, b, "grp", "title", "id"), "grp", "title")


@query("select source, md5(text) as title from documents")
def q109_titles_in_order(spark, d):
    """Titles of all groups in order as rows, however large a group is (AG13)."""
    return diff.titles_in_order(t(spark, d, "documents").select("source", F.md5("text").alias("title")), "source", "title")


@query("select text_md5, n, doc_id from (select md5(text) as text_md5, doc_id, count(*) over (partition by text) as n from documents) where n > 1")
def q110_shared_members(spark, d):
    """Members of keys that several documents share, as rows (AG6)."""
    return diff.shared_members(t(spark, d, "documents").select(F.md5("text").alias("text_md5"), "doc_id"), "text_md5", "doc_id")



# ---- sidecars


@query("""with s as (select doc_id, text, greatest(ceil((length(text) - 1000) / 900.0), 0)::int + 1 as n from documents where length(text) > 0),
  x as (select doc_id, unnest(range(n)) as i, text from s), y as (select doc_id, i, substr(text, i * 900 + 1, 1000) as chunk from x)
  select doc_id || ':c1:' || printf('%05d', i) as chunk_id, doc_id, i::int as chunk_index, md5(chunk) as chunk_md5, (i * 900)::int as char_start, (i * 900 + length(chunk))::int as char_end, 'c1' as chunk_version from y""")
def q111_chunk_texts(spark, d):
    """Overlapping chunks of whole texts."""
    return sidecars.chunk_texts(t(spark, d, "documents")).select("chunk_id", "doc_id", "chunk_index", F.md5("chunk_text").alias("chunk_md5"), "char_start", "char_end", "chunk_version")


_POSTINGS = "p as (select doc_id, term, count(*) as tf from (select doc_id, unnest(regexp_extract_all(lower(strip_accents(text)), '[a-z0-9]+')) as term from documents) group by all)"


@query(f"with {_POSTINGS} select term, count(*) as df, sum(tf)::bigint as cf from p group by term")
def q112_term_statistics(spark, d):
    """Every term of all texts with its documents and occurrences, from the postings."""
    return sidecars.term_statistics(sidecars.term_index(t(spark, d, "documents"), "doc_id", "text"))


@query(f"with {_POSTINGS} select doc_id, sum(tf)::bigint as score from p where term in ('the', 'of') group by doc_id having count(*) = 2")
def q113_term_search(spark, d):
    """Documents that hold all words of a search, by the postings."""
    return sidecars.term_search(sidecars.term_index(t(spark, d, "documents"), "doc_id", "text"), ["The", "of"], "doc_id")


@query("""with o as (select doc_id, case when toxic = 1 then 'lang' when quality = 1 then 'source' else 'n_chars' end as field, case when toxic = 1 then 'xx' when quality = 1 then null else '7' end as v, case when doc_id % 4 = 0 then 'src1' end as only_source from labels),
  f as (select o.* from o join documents using (doc_id) where only_source is null or only_source = source)
  select d.doc_id, case when f.field = 'lang' then f.v else d.lang end as lang, case when f.field = 'source' then f.v else d.source end as source, case when f.field = 'n_chars' then f.v::bigint else d.n_chars end as n_chars from documents d left join f using (doc_id)""")
def q114_curated_overrides(spark, d):
    """Explicit overrides of fields, cast to their types, the latest of each field (an earlier one says otherwise here)."""
    l = t(spark, d, "labels")  # noqa: E741
    field = F.when(c("toxic") == 1, "lang").when(c("quality") == 1, "source").otherwise("n_chars")
    value = F.when(c("toxic") == 1, '"xx"').when(c("quality") == 1, "null").otherwise("7")
    one = lambda name, v, at: l.select(F.concat(F.lit(name), c("doc_id").cast("string")).alias("override_id"), "doc_id", F.lit("documents").alias("target_table"), field.alias("target_field"), v.alias("override_value_json"), F.when(c("doc_id") % 4 == 0, "src1").alias("applies_to_source_type"), F.lit(at).alias("created_at"))
    made = one("b", value, "2024-02-01").unionByName(one("a", F.lit("99"), "2024-01-01"))
    docs = t(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return sidecars.overridden(docs, made, "documents", source="source")


@query("""with a as (select doc_id as id, lang, source from documents), b as (select doc_id as id, case when quality = 1 then d.lang else 'zz' end as lang, source from labels join documents d using (doc_id) union all select page_id + 1000000, 'pp', 'web' from pages),
  s as (select coalesce(a.id, b.id) as id, case when a.id is null then 'added' when b.id is null then 'removed' when a.lang is distinct from b.lang or a.source is distinct from b.source then 'changed' end as state from a full join b on a.id = b.id)
  select id, state, case state when 'removed' then null else (select any_value(lang) from b where b.id = s.id) end as lang from s where state is not null""")
def q115_stale_rows(spark, d):
    """What a new version of a table adds, changes and removes by row fingerprints, and the derived rows built anew."""
    docs = t(spark, d, "documents").select(c("doc_id").alias("id"), "lang", "source")
    new = docs.join(t(spark, d, "labels").select(c("doc_id").alias("id"), "quality"), "id").select("id", F.when(c("quality") == 1, c("lang")).otherwise("zz").alias("lang"), "source")
    new = new.unionByName(t(spark, d, "pages").select((c("page_id") + 1000000).alias("id"), F.lit("pp").alias("lang"), F.lit("web").alias("source")))
    changes = sidecars.stale(sidecars.row_versions(docs, "id"), sidecars.row_versions(new, "id"), "id")
    after = sidecars.rebuilt(docs, new, changes, "id").select("id", "lang")
    return changes.join(after, "id", "left").select("id", "state", "lang")


@query(f"""with {B.CANON} select a.doc_id, remote_url from assets_ a join documents_ d using (doc_id) where affiliated and starts_with(remote_url, 'https://mirror.example.org/papers/') and {BASE.format('remote_url')} not in (select name from inventory where bucket = 'other')""")
def q116_flagged_without_copy(spark, d):
    """Flagged documents whose lasting link names no stored file."""
    made = B.tables(spark, d)
    return sidecars.flagged_without_copy(made["documents"], made["asset_refs"], B.bound(spark, d, B.ROOTS["inventory"]), S)

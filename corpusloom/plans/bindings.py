"""The driver's tables as roots of a catalogue: the same expressions make them in Spark and in the oracle's SQL.

``pages`` are portal rows, ``part`` curated files, ``supplier`` curated links, ``customer`` mirrors, ``benchmark`` the registry, and
``pages`` with ``part`` the stored files. Every row of each table becomes a row; blank, spaced, odd and repeated values are planted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.plans import canonical, projections
from corpusloom.plans.audit import AuditContext
from corpusloom.plans.canonical import Roots
from corpusloom.plans.registered import BARE, BASE, HOST, S, SLUG, STEM, t
from corpusloom.sources.readers import constant_lookup, last_by_key

VERSIONS = {"portal": "0a1b2c3d", "curated_files": "4e5f6071", "curated_links": "8293a4b5"}
PATHS = {"portal": "roots/portal.tsv", "curated_files": "roots/files.tsv", "curated_links": "roots/links.tsv"}
STAMP = "2024-01-01T00:00:00Z"
ROOTS = {
    "portal": """select page_id + 1 as ordinal,
  case when page_id % 19 = 7 then 'Odd' when page_id % 23 = 5 then '' else 'JRNL-' || (page_id % 40 + 1) || '-' || (1960 + page_id % 50) || '-Issue-' || (page_id % 4 + 1) end as journal,
  case page_id % 10 when 0 then 'Notes' when 1 then 'Book Reviews' when 2 then '' when 3 then '  Spaced "quoted" ' || page_id || ' ' when 4 then 'nan' else 'Paper of many words ' || page_id || '.0' end as paper,
  case when page_id % 13 = 0 then '' when page_id % 3 = 0 then 'https://portal.example.org/f/Vol' || cast(floor(page_id / 6) as bigint) || '.pdf' || case when page_id % 7 = 0 then '?v=1' else '' end else url end as url,
  case page_id % 8 when 0 then '' when 1 then '1.5d' when 2 then ' 12 ' when 3 then null when 4 then '1_000' else cast(page_id as string) end as size_in_kb,
  case page_id % 5 when 0 then '' when 1 then null else 'Author ' || (page_id % 17) end as author from {pages}""",
    "curated_files": """select p_partkey + 1 as ordinal, p_brand as journal, case when p_partkey % 31 = 0 then ' ' else p_name end as paper,
  case when p_partkey % 29 = 3 then '' when p_partkey % 37 = 1 then 'https://files.example.org/p/part-' || p_partkey || '.txt' when p_partkey % 41 = 5 then 'https://files.example.org/p/spaced%20part-' || p_partkey || '.pdf' else 'https://files.example.org/p/part-' || p_partkey || '.pdf' end as url,
  case when p_partkey % 6 = 0 then '' else cast(p_size as string) end as size_in_kb, case when p_partkey % 9 = 0 then 'unknown' when p_partkey % 9 = 1 then '' else (1950 + p_size) || '.0' end as year, p_type as author from {part}""",
    "curated_links": """select s_suppkey + 1 as ordinal, 'Mag ' || s_nationkey as journal, s_name as paper,
  case when s_suppkey % 11 = 4 then '' when s_suppkey % 5 = 0 then 'https://other.example.net/a/' || s_suppkey else 'https://magazine.example.com/ideas/' || s_suppkey end as url,
  case when s_suppkey % 4 = 0 then 'soon' else cast(2000 + s_nationkey as string) end as year, case when s_suppkey % 6 = 0 then null else 'Writer ' || s_nationkey end as author from {supplier}""",
    "mirrors": """select c_custkey + 1 as ordinal, case when c_custkey % 5 = 0 then 'https://portal.example.org/f/Vol' || c_custkey || '.pdf' else 'https://files.example.org/p/part-' || c_custkey || '.pdf' end as source_url,
  case when c_custkey % 17 = 2 then '' when c_custkey % 50 = 9 then 'https://files.example.org/p/part-' || c_custkey || '.pdf' when c_custkey % 11 = 3 then 'https://mirror.example.org/papers/' || c_custkey else 'https://mirror.example.org/papers/' || c_custkey || '.pdf' end as mirror_url from {customer}""",
    "registry": "select item_id as ordinal, case when item_id % 4 = 0 then '$Vol' || item_id || '.pdf' when item_id % 4 = 1 then 'part-' || item_id || '.pdf' else 'nobody-' || item_id end as entry from {benchmark}",
    "inventory": """select 'main' as bucket, case when page_id % 2 = 0 then 'Vol' || page_id || '.pdf' else 'lone ' || page_id || '.pdf' end as name, cast(page_id * 100 as bigint) as bytes from {pages}
  union all select 'other', case when p_partkey % 41 = 5 then 'spaced part-' || p_partkey || '.pdf' when p_partkey % 3 = 0 then 'gone-' || p_partkey || '.pdf' else 'part-' || p_partkey || '.pdf' end, cast(p_partkey * 10 as bigint) from {part}""",
}
ENRICHMENT = """select page_id as ordinal, case when page_id % 19 = 7 then 'Odd' when page_id % 23 = 5 then '' else 'JRNL-' || (page_id % 40 + 1) || '-' || (1960 + page_id % 50) || '-Issue-' || (page_id % 4 + 1) end as journal,
  case page_id % 10 when 0 then 'Notes' when 1 then 'Book Reviews' when 2 then '' when 3 then 'Spaced "quoted" ' || page_id when 4 then 'nan' else 'Paper of many words ' || page_id || '.0' end as paper, case when page_id % 13 = 0 then '' else url end as url, 'link' as entry_type,
  case when page_id % 2 = 0 then ' ' else 'Sub ' || (page_id % 6) end as subject, case when page_id % 3 = 0 then '' else 'Cat ' || (page_id % 4) end as category from {pages}"""
#: A constant second lookup, as settings hold one.
FALLBACK = (("Mag 1", "Supplier#000000001", "https://magazine.example.com/ideas/1", "link", "Fallback", "Known"), ("", "", "", "link", "None", "Blank"))
KEY = ["journal", "paper", "url", "entry_type"]


def bound(spark: SparkSession, d: str, sql: str) -> DataFrame:
    names = [n for n in ("pages", "part", "supplier", "customer", "benchmark") if "{" + n + "}" in sql]
    return spark.sql(sql, **{n: t(spark, d, n) for n in names})


def roots(spark: SparkSession, d: str) -> Roots:
    return Roots(*[bound(spark, d, ROOTS[n]).withColumn("ordinal", F.col("ordinal").cast("long")) for n in ("portal", "curated_files", "curated_links", "mirrors", "registry")], bound(spark, d, ROOTS["inventory"]), VERSIONS, PATHS)


def tables(spark: SparkSession, d: str, check: bool = False) -> dict[str, DataFrame]:
    return canonical.build(roots(spark, d), S, F.lit(STAMP), check)


def context(spark: SparkSession, d: str) -> AuditContext:
    made = tables(spark, d)
    return AuditContext(roots(spark, d), made["documents"], made["document_sources"], made["asset_refs"], S)


def index(spark: SparkSession, d: str) -> DataFrame:
    made = tables(spark, d)
    known = last_by_key(bound(spark, d, ENRICHMENT), KEY)
    return projections.index(made["documents"], made["document_sources"], made["asset_refs"], known, constant_lookup(spark, FALLBACK, KEY), S)


# ---- the same in SQL

_DUCK = {n: n for n in ("pages", "part", "supplier", "customer", "benchmark")}
RAW = ", ".join(f"{n} as ({sql.format(**_DUCK)})" for n, sql in ROOTS.items())
_CLEAN = "coalesce(trim({0}), '')"
_URL, _NAME = _CLEAN.format("url"), BASE.format(_CLEAN.format("url"))
_SUFFIXED = "case when k = 1 then base else printf('%s-%02d', base, k) end"


def _source(kind: str, table: str, base: str, kind_of: str, year: str, raw: str) -> str:
    return f"""select '{kind}' as kind, ordinal, {_URL} as remote_url, {kind_of} as entry_type, {_CLEAN.format('paper')} as title, {_CLEAN.format('author')} as author_display, {year} as year, {_CLEAN.format('journal')} as journal_label,
    {base} as base, to_json(struct_pack({raw}))::varchar as raw from {table}"""


_FIELDS = lambda *names: ", ".join(f"{n} := {n}" for n in names)
_PAPER_SLUG = SLUG.format(_CLEAN.format("paper"))
CANON = f"""{RAW},
based as ({_source('portal', 'portal', f"coalesce(nullif({STEM.format(_NAME)}, ''), printf('portal-row-%04d-%s', ordinal, {_PAPER_SLUG}))", f"case when ends_with(lower({_URL}), '.pdf') then 'pdf' else 'link' end", r"coalesce(regexp_extract(trim(journal), '(?i)JRNL\D\d+\D(\d{4})\D', 1), '')", _FIELDS('journal', 'paper', 'url', 'size_in_kb', 'author'))}
  union all {_source('curated_files', 'curated_files', f"case when {_NAME} <> '' then {STEM.format(_NAME)} else printf('curated-file-%04d-%s', ordinal, {_PAPER_SLUG}) end", "'pdf'", _CLEAN.format('year'), _FIELDS('journal', 'paper', 'url', 'size_in_kb', 'year', 'author'))}
  union all {_source('curated_links', 'curated_links', f"{SLUG.format(_CLEAN.format('journal'))} || '-' || case when {_NAME} <> '' then {SLUG.format(STEM.format(_NAME))} else {_PAPER_SLUG} end", "'link'", _CLEAN.format('year'), _FIELDS('journal', 'paper', 'url', 'year', 'author'))}),
numbered as (select *, row_number() over (partition by kind, base order by ordinal) as k, {BASE.format('remote_url')} as file_name from based),
stored as (select name, max(case when bucket = 'main' then 1 else 0 end) as in_main, max(case when bucket = 'other' then 1 else 0 end) as in_other from inventory group by name),
mirrored as (select trim(source_url) as source_url, arg_max(trim(mirror_url), ordinal) as mirror_url from mirrors where trim(source_url) <> '' and trim(mirror_url) <> '' group by 1),
placed as (select n.*, {_SUFFIXED} as doc_id, m.mirror_url, case when kind = 'portal' and in_main = 1 then 'main/' || file_name when kind = 'portal' and in_other = 1 then 'other/' || file_name when kind = 'curated_files' and in_other = 1 then 'other/' || file_name end as local_rel_path
  from numbered n left join stored s on s.name = n.file_name left join mirrored m on m.source_url = n.remote_url),
flagged as (select *, exists (select 1 from registry r where ltrim(r.entry, '$') <> '' and (contains(p.remote_url, ltrim(r.entry, '$')) or contains(coalesce(p.local_rel_path, ''), ltrim(r.entry, '$')))) as affiliated from placed p),
documents_ as (select doc_id, entry_type, title, author_display, year, journal_label, affiliated, kind as source_root from flagged),
sources_ as (select case kind when 'portal' then 'portal' when 'curated_files' then 'curated-files' else 'curated-links' end || printf(':%05d', ordinal) as source_row_id, doc_id, kind || '_metadata' as source_type,
  case kind {' '.join(f"when '{k}' then '{v}'" for k, v in PATHS.items())} end as source_path, case kind {' '.join(f"when '{k}' then '{v}'" for k, v in VERSIONS.items())} end as source_version, raw as raw_metadata_json, '{STAMP}' as ingested_at from flagged),
assets_ as (select doc_id || ':primary' as asset_id, doc_id, case when entry_type = 'pdf' then 'primary_pdf' else 'external_link' end as asset_role, local_rel_path, remote_url, local_rel_path as object_key, case when local_rel_path is null then 'remote_only' else 'present' end as availability_status from flagged
  union all select doc_id || ':mirror', doc_id, 'mirror_pdf', local_rel_path, mirror_url, local_rel_path, case when local_rel_path is null then 'remote_only' else 'present' end from flagged where mirror_url is not null and kind <> 'curated_links')"""
INDEX = f"""{CANON},
known as (select journal, paper, url, entry_type, arg_max(struct_pack(s := subject, c := category), ordinal) as e from ({ENRICHMENT.format(**_DUCK)}) group by all),
fallback as (select * from (values {', '.join(str(x) for x in FALLBACK)}) f(journal, paper, url, entry_type, subject, category)),
joined as (select d.journal_label as journal, d.title as paper, d.author_display as author, a.remote_url as url, d.year, coalesce(m.remote_url, '') as mirror_url, case when d.affiliated then 'true' else 'false' end as affiliated, d.entry_type, json_extract_string(s.raw_metadata_json, '$.size_in_kb') as size,
  case when s.source_type in ('portal_metadata', 'curated_files_metadata') then 'portal' when contains({HOST.format('a.remote_url')}, 'magazine.example.com') then 'magazine' else 'curated_link' end as source, coalesce(a.object_key, '') as object_key, s.source_path, s.source_row_id
  from documents_ d join sources_ s using (doc_id) join assets_ a on a.asset_id = d.doc_id || ':primary' left join assets_ m on m.doc_id = d.doc_id and m.asset_role = 'mirror_pdf'),
index_ as (select journal, paper, coalesce(case when good then k.e.s else f.subject end, '') as subject, coalesce(case when good then k.e.c else f.category end, '') as category, author, url, case when entry_type = 'link' and coalesce(trim(size), '') = '' then '0' else coalesce(size, '') end as size_in_kb,
  year, mirror_url, affiliated, entry_type, source, object_key, 'false' as object_synced, source_path, source_row_id
  from (select j.*, k.e, coalesce(trim(k.e.s), '') <> '' or coalesce(trim(k.e.c), '') <> '' as good from joined j left join known k using (journal, paper, url, entry_type)) k left join fallback f using (journal, paper, url, entry_type))"""
PDF_PATH = "ends_with(lower(" + BARE + "), '.pdf')"

"""Sinks: staged table stores, single text files in a fixed order, reports."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from itertools import chain
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.schemas import INDEX_COLUMNS


def store(tables: dict[str, DataFrame], folder: str, write: bool = True, check: Callable[[dict[str, DataFrame]], None] | None = None) -> dict[str, str]:
    """Write all tables into a staging folder, then put it in the place of the old store (SK1, SK8); ``write=False`` only says where (SK19).

    ``check`` (such as ``canonical.verify``) reads the staged tables, so nothing is computed twice; if it raises, the old store stays.
    """
    paths = {name: f"{folder}/{name}" for name in tables}
    if not write or not tables:
        return paths
    spark = next(iter(tables.values())).sparkSession
    jvm = spark.sparkContext._jvm
    place, staging = jvm.org.apache.hadoop.fs.Path(folder), jvm.org.apache.hadoop.fs.Path(folder.rstrip("/") + ".staging")
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(staging, True)
    for name, df in tables.items():
        df.write.parquet(f"{staging.toString()}/{name}")
    if check is not None:
        try:
            check(open_store(spark, staging.toString(), list(tables)))
        except Exception:
            fs.delete(staging, True)
            raise
    fs.delete(place, True)
    fs.rename(staging, place)
    return paths


def open_store(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}


def _field(v) -> str:
    s = "" if v is None else str(v)
    return '"' + s.replace('"', '""') + '"' if any(c in s for c in '\t\r\n"') else s


def written(spark: SparkSession, path: str, parts: Iterable[str]) -> str:
    """One text file on any file system that the session knows, streamed from the driver in pieces."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    held: list[str] = []
    size = 0
    try:
        for part in parts:
            held.append(part)
            size += len(part)
            if size > 1 << 20:
                out.write(bytearray("".join(held).encode("utf-8")))
                held, size = [], 0
        out.write(bytearray("".join(held).encode("utf-8")))
    finally:
        out.close()
    return path


def tsv(df: DataFrame, path: str, columns: list[str] | None = None, end: str = "\r\n") -> str:
    """One delimited file with a header, minimal quoting and rows in the frame's order, streamed through the driver (SK9, SK16, SK18)."""
    columns = columns or df.columns
    rows = ("\t".join(_field(v) for v in row) + end for row in df.select(*columns).toLocalIterator())
    return written(df.sparkSession, path, chain(["\t".join(map(_field, columns)) + end], rows))


def index_tsv(index: DataFrame, path: str) -> str:
    return tsv(index.orderBy("source_path", "source_row_id"), path, INDEX_COLUMNS)


def table_folder(df: DataFrame, path: str, **options) -> None:
    """The same at scale: a folder of delimited parts in sorted ranges, written by the executors."""
    df.write.mode("overwrite").options(**({"sep": "\t", "header": True, "escape": '"'} | options)).csv(path)


def script(payload, path: str, variable: str, event: str | None = None) -> str:
    """A JavaScript file that sets a variable, ASCII-escaped, and may announce it (SK13, SK14)."""
    text = f"{'window.' + variable if event else 'const ' + variable} = {json.dumps(payload, indent=2)};\n"
    if event:
        text += f"window.dispatchEvent(new CustomEvent('{event}', {{ detail: window.{variable} }}));\n"
    Path(path).write_text(text, encoding="utf-8")
    return path


def records(df: DataFrame, order: list) -> list[dict]:
    """Rows of a small final projection as plain records, in order."""
    return [r.asDict(recursive=True) for r in df.orderBy(*order).toLocalIterator()]


def audit_markdown(results: list[dict], severities: dict[str, int], path: str, most: int = 20) -> str:
    """The audit as a report with up to 20 issues a check (SK10)."""
    out = ["# Corpus input audit", "", "## Summary", f"- checks run: {len(results)}", f"- severity counts: {severities}", ""]
    for r in results:
        out += [f"## {r['name']}", *([f"- {k}: {v}" for k, v in r["summary"].items()] or ["- no summary"]), f"- issue_count: {r['issue_count']}", ""]
        if r["issues"]:
            out.append("### Sample issues")
            for i in r["issues"][:most]:
                said = ", ".join(f"{k}={v!r}" for k, v in (i["details"] or {}).items())
                out.append(f"- [{i['severity']}] {i['message']}" + (f" ({said})" if said else ""))
            out.append("")
    Path(path).write_text("\n".join(out), encoding="utf-8")
    return path


def audit_json(results: list[dict], severities: dict[str, int], path: str) -> str:
    """The same as JSON, other scripts kept, with every issue of every check (SK11): the issues are streamed from their frames in
    order, so the driver holds none of them."""
    from corpusloom.plans.audit import in_order

    dump = lambda x: json.dumps(x, ensure_ascii=False, indent=2)

    def parts() -> Iterable[str]:
        yield '{\n"selected_checks": ' + dump([r["name"] for r in results]) + ',\n"severity_counts": ' + dump(severities) + ',\n"results": ['
        for k, r in enumerate(results):
            yield ("," if k else "") + '\n{"name": ' + dump(r["name"]) + ', "summary": ' + dump(r["summary"]) + ', "issue_count": ' + dump(r["issue_count"]) + ', "issues": ['
            every = (x.asDict() for x in r["found"].orderBy(*in_order(r["found"])).toLocalIterator()) if "found" in r else iter(r["issues"])
            for i, x in enumerate(every):
                yield ("," if i else "") + "\n" + dump(x)
            yield "]}"
        yield "]}\n"

    with open(path, "w", encoding="utf-8") as out:
        out.writelines(parts())
    return path


def audit_issues(found: DataFrame, folder: str) -> str:
    """All issues as a folder of JSON lines, written by the executors, for audits of large stores (SK11)."""
    found.write.mode("overwrite").json(folder)
    return folder


def validation_markdown(report: dict, path: str) -> str:
    """The comparison of two index versions as a report (SK12)."""
    out = ["# Index validation", "", "## Row counts", f"- exported rows: {report['rows'][0]}", f"- former rows: {report['rows'][1]}", "", "## Headers", f"- exported header matches: {report['same_header']}", "",
           "## Entry types", f"- exported: {report['types'][0]}", f"- former: {report['types'][1]}", "", "## Coverage"]
    for name in ("subject", "category"):
        out += [f"- exported non-empty `{name}`: {report[name][0]}", f"- former non-empty `{name}`: {report[name][1]}"]
    out += ["", "## Keyed rows", f"- missing from export: {report['n_missing']}", f"- extra in export: {report['n_extra']}", ""]
    for title, rows in (("Missing from export", report["missing"]), ("Extra in export", report["extra"])):
        if rows:
            out += [f"### {title}", *[f"- {', '.join(f'{k}={v!r}' for k, v in r.items())}" for r in rows], ""]
    Path(path).write_text("\n".join(out), encoding="utf-8")
    return path


def markdown_rows(df: DataFrame, columns: list, order: list, name: str = "line") -> DataFrame:
    """Rows of a markdown table; pipes inside cells become hyphens (SK17, SK24, PR38)."""
    made = [F.replace(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")), F.lit("|"), F.lit("-")) for c in columns]
    return df.orderBy(*order).select(F.concat(F.lit("| "), F.concat_ws(" | ", *made), F.lit(" |")).alias(name))


def review_notes(df: DataFrame, columns: list[str], name: str = "note") -> DataFrame:
    """Each row as JSON, nulls kept (SK26)."""
    return df.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias(name))

"""Column expressions for text, URLs and numbers. All stay in the JVM; each names the semantics it has to match."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

_SPACE = r"[\s\x1c-\x1f]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """Unicode white space off both ends, as Python's strip (FN1)."""
    return F.regexp_replace(col(c), rf"(?U)^{_SPACE}+|{_SPACE}+$", "")


def clean(c: Column | str) -> Column:
    """Null, blank and white space are one: an empty text (FN1)."""
    return F.coalesce(py_strip(c), F.lit(""))


def filled(c: Column | str) -> Column:
    """Null where the text is empty."""
    return F.nullif(col(c), F.lit(""))


def first_filled(*cs: Column | str) -> Column:
    """The first text that isn't empty, else an empty one (PR1, PR31)."""
    return F.coalesce(*[filled(c) for c in cs], F.lit(""))


def slug(c: Column | str) -> Column:
    """Lower case, runs of other than a-z0-9 as one hyphen, none at the ends; ``untitled`` if nothing is left (FN2)."""
    return F.coalesce(filled(F.regexp_replace(F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", "-"), "^-|-$", "")), F.lit("untitled"))


def url_path(c: Column | str) -> Column:
    """Path of a URL without query, fragment and parameters of the last segment; lenient, nothing is decoded (FN3)."""
    bare = F.regexp_replace(F.regexp_replace(col(c), r"(?s)[?#].*$", ""), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/]*)?", "")
    return F.regexp_replace(bare, r";[^/]*$", "")


def url_basename(c: Column | str) -> Column:
    return F.regexp_extract(url_path(c), r"([^/]*)/*$", 1)


def url_host(c: Column | str) -> Column:
    """Network location in lower case (FN5)."""
    return F.lower(F.regexp_extract(col(c), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1))


def stem(c: Column | str) -> Column:
    """A name without its last extension; names that begin or end with the dot stay (FN4)."""
    return F.regexp_replace(col(c), r"(?<=.)\.[^.]+$", "")


def path_name(c: Column | str) -> Column:
    """Last segment of a path, query and all (FN7)."""
    return F.regexp_extract(col(c), r"([^/]*)/*$", 1)


def file_name(c: Column | str) -> Column:
    """After the last slash, up to ``?`` or ``#`` (FN6)."""
    return F.substring_index(F.substring_index(F.substring_index(col(c), "/", -1), "?", 1), "#", 1)


def norm_title(c: Column | str) -> Column:
    """Letters and digits only, in lower case (FN10)."""
    return F.regexp_replace(F.lower(col(c)), "[^a-z0-9]", "")


def norm_space(c: Column | str) -> Column:
    """Lower case, each run of white space one space (FN12)."""
    return F.regexp_replace(F.lower(py_strip(c)), rf"(?U){_SPACE}+", " ")


def is_pdf_url(c: Column | str) -> Column:
    """The whole text ends in .pdf (PR2)."""
    return F.lower(col(c)).endswith(".pdf")


def is_pdf_path(c: Column | str) -> Column:
    """The path ends in .pdf, whatever the query (FI3)."""
    return F.lower(url_path(c)).endswith(".pdf")


def is_float(c: Column | str) -> Column:
    """What Python's float() takes: underscores between digits, inf and nan, white space around (FI4)."""
    return F.regexp_like(py_strip(c), F.lit(r"(?i)^[+-]?(?:(?:\d+(?:_\d+)*)(?:\.(?:\d+(?:_\d+)*)?)?(?:e[+-]?\d+(?:_\d+)*)?|\.\d+(?:_\d+)*(?:e[+-]?\d+(?:_\d+)*)?|inf(?:inity)?|nan)$"))


def js_int(c: Column | str) -> Column:
    """Leading integer of a text, or null (FN15)."""
    return F.regexp_extract(col(c), r"^\s*([+-]?\d+)", 1).try_cast("bigint")


def py_int(c: Column | str) -> Column:
    """int(float(x)), 0 where that fails (FN16)."""
    return F.coalesce(F.when(is_float(c) & ~F.lower(py_strip(c)).rlike("inf|nan"), F.replace(py_strip(c), F.lit("_"), F.lit("")).try_cast("double")), F.lit(0.0)).cast("bigint")


def issue_number(c: Column | str) -> Column:
    return F.coalesce(F.regexp_extract(col(c), r"(?i)Issue-(\d+)", 1).try_cast("int"), F.lit(0))


def decade(c: Column | str) -> Column:
    """``1990s`` from a year as text; ``Unknown`` without a leading number (PR30)."""
    return F.coalesce(F.concat((F.floor(js_int(c) / 10) * 10).cast("bigint").cast("string"), F.lit("s")), F.lit("Unknown"))


def year_token(c: Column | str) -> Column:
    """The first part between hyphens that is four digits (PR16)."""
    return F.try_element_at(F.filter(F.split(col(c), "-"), lambda x: x.rlike(r"^\d{4}$")), F.lit(1))


def first_year(c: Column | str) -> Column:
    """The first four digits in a row, else an empty text (FN13)."""
    return F.regexp_extract(col(c), r"(\d{4})", 1)


def partition(c: Column | str, mark: str = "/") -> Column:
    """(head, tail) around the first mark; all is head where there is none (FN9)."""
    at = F.instr(col(c), mark)
    return F.struct(F.when(at > 0, F.left(col(c), at - 1)).otherwise(col(c)).alias("head"), F.when(at > 0, F.substring(col(c), at + len(mark), F.length(col(c)))).otherwise("").alias("tail"))


def clean_number(c: Column | str) -> Column:
    """Null and ``nan`` are empty; one trailing .0 goes, from texts that look like numbers (PR12)."""
    s = col(c)
    return F.when(s.isNull() | (F.lower(s) == "nan"), "").when(s.rlike(r"^[+-]?\d+\.0$"), F.regexp_replace(s, r"\.0$", "")).otherwise(s)


def safe_category(c: Column | str) -> Column:
    return F.when(F.coalesce(col(c), F.lit("")).isin("", "nan", "NaN"), "Uncategorized").otherwise(col(c))


def safe_subject(c: Column | str) -> Column:
    return F.when(F.coalesce(col(c), F.lit("")).isin("", "nan", "NaN"), "General").otherwise(col(c))


def percent_encode(c: Column | str, keep: str = "'()&,-._~") -> Column:
    """UTF-8 percent encoding that leaves letters, digits and ``keep`` (FN8, FN28)."""
    out = F.replace(F.url_encode(col(c)), F.lit("+"), F.lit("%20"))
    for ch in keep:
        code = f"%{ord(ch):02X}"
        if ch not in "-._":
            out = F.replace(out, F.lit(code), F.lit(ch))
    return out if "*" in keep else F.replace(out, F.lit("*"), F.lit("%2A"))


def escape_html(c: Column | str) -> Column:
    """&, < and > as references, & first (FN18)."""
    out = F.replace(col(c), F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def escape_attribute(c: Column | str) -> Column:
    return F.replace(escape_html(c), F.lit('"'), F.lit("&quot;"))


def any_word(term: str) -> str | None:
    """The words of a term as one pattern, their characters taken literally (FN19)."""
    words = [re.escape(w) for w in term.split()]
    return "|".join(words) if words else None


def highlight(c: Column | str, term: str, regex: bool = False) -> Column:
    """Escaped text with every match in <mark>; a pattern that isn't valid marks nothing (PR36)."""
    safe = escape_html(c)
    pattern = term if regex else any_word(term)
    if not pattern or regex and not valid_pattern(pattern):
        return safe if term else col(c)
    return F.regexp_replace(safe, f"(?i)({pattern})", "<mark>$1</mark>")


def valid_pattern(pattern: str) -> bool:
    try:
        re.compile(pattern)
    except re.error:
        return False
    return True


def size_text(size: Column | str, entry_type: Column | str) -> Column:
    """Megabytes to one place, halves up; blank for links (PR34)."""
    mb = F.floor(col(size) / 1024 * 10 + 0.5) / 10
    shown = F.when(mb == F.floor(mb), F.floor(mb).cast("string")).otherwise(mb.cast("string"))
    return F.when(col(entry_type) == "link", "").otherwise(F.concat(shown, F.lit(" MB")))


def short_label(c: Column | str, longest: int = 28) -> Column:
    return F.when(F.length(col(c)) > longest, F.concat(F.left(col(c), F.lit(longest - 2)), F.lit("..."))).otherwise(col(c))


def css_token(c: Column | str) -> Column:
    return F.concat(F.lit("cat-"), F.regexp_replace(col(c), "[^a-zA-Z0-9]", "-"))


def fingerprint8(content: Column | str) -> Column:
    """First 8 hex digits of SHA-256 (FN22)."""
    return F.substring(F.sha2(col(content), 256), 1, 8)


def fenced_json(c: Column | str) -> Column:
    """What stands in the first ``` fence (with or without a json mark), else the text itself (FN21)."""
    inner = F.regexp_extract(col(c), r"(?s)```(?:json)?\s*(.*?)\s*```", 1)
    return F.when(inner != "", inner).otherwise(py_strip(c))


def ordered_patch(c: Column, rules: list[tuple[Column, Column | str]]) -> Column:
    """Rules in order, each seeing what the ones before have made: (condition on the old rows, new value) (UP1)."""
    for condition, value in rules:
        c = F.when(condition, value if isinstance(value, Column) else F.lit(value)).otherwise(c)
    return c


def title_case(c: Column | str) -> Column:
    """Capital after every character that is no letter, as Python's title() for letters without special casing (FN26)."""
    return F.array_join(F.transform(F.regexp_extract_all(col(c), F.lit(r"(\p{L}+|\P{L}+)"), 1), lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substring(w, F.lit(2), F.lit(1 << 30))))), "")

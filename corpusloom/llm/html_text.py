"""Main text of HTML pages by site style trees (operator 5)."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.common import load, stored

#: Shares in a node's importance: half is what the merged tree says (of this, 0.7 presentation and 0.3 content), half the prior.
PRESENTATION = 0.7
LEAST = 0.5
LEAST_PAGES = 4
WHOLE = 0.95
MOST_HOSTS, MOST_CHARS, HOT_HOST = 20_000, 4_000_000, 10_000
DEEPEST, LONGEST_NAME, LONGEST_PATH = 512, 120, 600

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img nobr".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody")}
FENCE = frozenset("ul ol dl table article section div body main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that declare a branch to be no main text, and those that do unless they hold the only article or main part.
NOISE_TAGS = frozenset("nav footer aside button select dialog menu head object applet canvas audio video".split())
WEAK_TAGS = frozenset("form fieldset".split())
#: Names of classes, ids and roles that say the same. A name counts as a whole: all its parts between hyphens are such words or
#: words of place and form, so ``site-footer`` counts and ``no-sidebar``, ``has-footer`` and ``related-work`` don't.
NOISE_WORDS = frozenset("nav navbar navigation menu breadcrumb breadcrumbs sidebar aside complementary footer contentinfo masthead banner ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay dialog newsletter subscribe subscription signup login search share sharing social related recommended recommendations widget toolbar pagination pager skip".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond reply replies".split())
PLACE_WORDS = frozenset("site page main top bottom side left right global primary secondary inner outer sub bar box links link list area section container wrapper block buttons slot form posts articles post article entry items item header".split())
MAIN_ROLES = frozenset(("main", "article"))

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(script|style|noscript|template|textarea|title|iframe|svg|math|noembed|noframes|xmp)\b(?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+(?:>|\Z).*?(?:</\1\b[^>]*+(?:>|\Z)|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^\s>]++)))?")
_DIGITS = re.compile(r"\d+")
_HYPHEN = re.compile(r"[-_\d]+")
#: How strongly a branch is declared to be no main text.
NONE, HEADER, WEAK, STRONG = range(4)


class _Node:
    """An element: its name in the tree, what it declares, and, for the tree, its children as runs, its text and that in links."""

    __slots__ = ("chars", "children", "inside", "links", "low", "main", "name", "noise", "path", "prior", "said", "tag", "up")

    def __init__(self, tag: str, name: str, up, said: int, main: bool):
        self.tag, self.name, self.up, self.said, self.main = tag, name, up, said, main
        self.children, self.chars, self.links, self.prior, self.path, self.low = [], 0, 0, 0.5, "", False


def _said_by(name: str) -> int:
    """What one whole name of a class, id or role declares."""
    parts = [p for p in _HYPHEN.split(name) if p]
    if not all(p in NOISE_WORDS or p in COMMENT_WORDS or p in PLACE_WORDS for p in parts):
        return NONE
    if any(p in COMMENT_WORDS for p in parts):
        return STRONG
    if any(p in NOISE_WORDS for p in parts):
        return WEAK
    return HEADER if "header" in parts and not {"article", "post", "entry"} & set(parts) else NONE


def _open(tag: str, attributes: str, up: _Node) -> _Node:
    name, main = tag, tag in ("article", "main")
    said = STRONG if tag in NOISE_TAGS else WEAK if tag in WEAK_TAGS else HEADER if tag == "header" else NONE
    words = tag not in ("html", "body")
    if attributes and not attributes.isspace():
        for kind, *value in _ATTRIBUTE.findall(attributes):
            kind, value = kind.lower(), "".join(value).lower()
            if kind == "hidden" or kind == "aria-hidden" and value == "true" or kind == "style" and "display:none" in value.replace(" ", ""):
                said = STRONG if words else said
            elif kind in ("class", "id", "role"):
                if words:
                    said = max([said, *map(_said_by, value.split())])
                if kind == "role":
                    main = main or value in MAIN_ROLES
                elif kind == "class":
                    name += "." + ".".join(sorted(_DIGITS.sub("#", value).split()))
                else:
                    name += "#" + _DIGITS.sub("#", value)
    if len(name) > LONGEST_NAME:
        name = f"{tag}.~{xxhash.xxh64_hexdigest(name)}"
    return _Node(tag, name, up, said, main)


def parse(text: str) -> tuple[list[_Node], list[tuple[_Node, str, int]]]:
    """(elements in the order in which they open, blocks as (element, text, characters of it in links)). A block is the inline
    content between two ends of block elements. Time and memory are in proportion to the page: a tag without an end reaches to
    the end, elements deeper than 512 are part of the one above."""
    root = _Node("", "", None, NONE, False)
    nodes, stack, blocks, parts = [root], [root], [], []
    opened: dict[str, int] = {}
    lost: dict[str, int] = {}
    linked, in_link, at = 0, False, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            said = " ".join(html.unescape("".join(parts)).split())
            if said:
                blocks.append((stack[-1], said, min(linked, len(said))))
            parts.clear()
        linked = 0

    def close(to: int) -> None:
        for node in stack[to:]:
            opened[node.tag] -= 1
        del stack[to:]

    for m in _TOKEN.finditer(text):
        begin = m.start()
        if begin > at:
            parts.append(text[at:begin])
            if in_link:
                linked += begin - at
        at = m.end()
        tag = m[3]
        if not tag:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                in_link = not m[2]
            continue
        flush()
        if m[2]:
            if lost.get(tag):
                lost[tag] -= 1
            elif opened.get(tag):
                k = len(stack) - 1
                while stack[k].tag != tag:
                    k -= 1
                close(k)
            continue
        if tag in VOID:
            continue
        ends = CLOSES.get(tag, ())
        if opened.get("p") or any(map(opened.get, ends)):
            for k in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph, an item its neighbour
                if stack[k].tag == "p" or stack[k].tag in ends:
                    close(k)
                    continue
                if stack[k].tag in FENCE:
                    break
        if len(stack) > DEEPEST:
            lost[tag] = lost.get(tag, 0) + 1
            continue
        node = _open(tag, m[4] or "", stack[-1])
        above = stack[-1].children
        if above and above[-1][0] == node.name:
            above[-1][1] += 1
        else:
            above.append([node.name, 1])
        opened[tag] = opened.get(tag, 0) + 1
        stack.append(node)
        nodes.append(node)
    if at < len(text):
        parts.append(text[at:])
    flush()
    _settle(nodes, blocks)
    return nodes, blocks


def _inherit(nodes: list[_Node]) -> None:
    root = nodes[0]
    root.noise = root.inside = False
    for n in nodes[1:]:
        n.noise = n.up.noise or n.said >= WEAK or n.said == HEADER and not n.up.inside
        n.inside = (n.up.inside or n.main) and not n.noise


def _settle(nodes: list[_Node], blocks: list) -> None:
    """Give each element its prior and its path in the tree of its host.

    The prior is 0 for a branch declared as menu, footer, advert, form, comments and the like, and for what stands outside a
    declared article or main part where a page has one; 1 for such a part and what holds it; else 1/2, for headings 3/4. Where
    the only such part lies inside a branch that is noise by a name or as a form, that declaration doesn't hold. What is declared
    is part of the path, so declared and undeclared elements are different nodes.
    """
    _inherit(nodes)
    if not any(n.inside for n, _, _ in blocks) and any(n.main for n in nodes):
        for n in nodes:
            if n.main and n.said < STRONG:
                up = n.up
                while up is not None:
                    if up.said < STRONG:
                        up.said = NONE
                    up = up.up
        _inherit(nodes)
    has = any(n.inside for n, _, _ in blocks)
    nodes[0].path = "+" if has else ""
    for n in nodes[1:]:
        n.prior = 0.0 if n.noise else 1.0 if n.inside else 0.0 if has else 0.75 if n.tag in HEADINGS else 0.5
        path = f"{n.up.path}/{n.name}{'!' if n.noise and not n.up.noise else ''}"
        n.path = path if len(path) <= LONGEST_PATH else f"{path[:8]}~{xxhash.xxh64_hexdigest(path)}"
    for n in nodes:
        if n.inside and not n.up.inside:
            up = n.up
            while up is not None and up.prior < 1:
                up.prior = 1.0
                up = up.up


def facts(text: str) -> tuple[dict[str, list], list[tuple[str, int]]]:
    """Of one page: by path [path above, style, share of the page's text, prior], and (path, feature) pairs. The style of a node
    is the hash of the runs of its children (their numbers to the power of two), its text's length to the power of four and the
    quarter of it that is links. Its features are the hashes of its own blocks and, of each child, the hash of all that has."""
    digest = xxhash.xxh64_intdigest
    signed = lambda v: v - (1 << 64) if v >= 1 << 63 else v
    nodes, blocks = parse(text)
    found: dict[str, list] = {}
    features: dict[str, set] = {}
    for n, said, links in blocks:
        n.chars += len(said)
        n.links += links
        features.setdefault(n.path, set()).add(signed(digest(said)))
    for n in reversed(nodes[1:]):
        n.up.chars += n.chars
        n.up.links += n.links
    for n in nodes:
        f = found.setdefault(n.path, [n.up.path if n.up else None, [], 0, 0, n.prior])
        f[1].append(",".join(f"{name}*{count.bit_length()}" for name, count in n.children))
        f[2] += n.chars
        f[3] += n.links
        f[4] = min(f[4], n.prior)
    for path in reversed(found):
        own = features.get(path)
        if own and found[path][0] is not None:
            features.setdefault(found[path][0], set()).add(signed(digest(repr(sorted(own)))))
    whole = max(nodes[0].chars, 1)
    out = {p: [up, signed(digest(f"{';'.join(runs)}|{(chars.bit_length() + 1) // 2}|{4 * links // max(chars, 1)}")), chars / whole, prior] for p, (up, runs, chars, links, prior) in found.items()}
    return out, [(p, x) for p, xs in features.items() for x in sorted(xs)]


_NODE = pa.struct([("path", pa.string()), ("up", pa.string()), ("style", pa.int64()), ("share", pa.float64()), ("prior", pa.float64())])
_FEATURE = pa.struct([("path", pa.string()), ("feature", pa.int64())])


def _measuring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Facts of each page as hashes and numbers: no text leaves the worker."""
    for batch in batches:
        nodes, features, ends, cuts = [[], [], [], [], []], [[], []], [0], [0]
        for doc in batch.column(1):
            doc = doc.as_py()
            own, pairs = facts(doc) if doc else ({}, ())
            for p, f in own.items():
                for column, v in zip(nodes, (p, *f)):
                    column.append(v)
            for p, x in pairs:
                features[0].append(p)
                features[1].append(x)
            ends.append(len(nodes[0]))
            cuts.append(len(features[0]))
        node = pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(nodes, _NODE)], fields=list(_NODE))
        feature = pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(features, _FEATURE)], fields=list(_FEATURE))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), node), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), feature)], ["host", "nodes", "features"])


def kept_text(doc: str, low: frozenset) -> str:
    """The blocks of a page outside the branches of ``low``, in order."""
    nodes, blocks = parse(doc)
    for n in nodes:
        n.low = n.path in low or n.up is not None and n.up.low
    return "\n\n".join(said for n, said, _ in blocks if not n.low)


def _extracting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, low_at = batch.schema.get_field_index("html"), batch.schema.get_field_index("low")
        texts = []
        for doc, low in zip(batch.column(at), batch.column(low_at)):
            doc = doc.as_py()
            texts.append(kept_text(doc, frozenset(low.as_py() or ())) if doc else "")
        rest = [i for i in range(batch.num_columns) if i not in (at, low_at)]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in rest), pa.array(texts, pa.string())], [*(batch.schema.names[i] for i in rest), "text"])


def host_of(url: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def measured(pages: DataFrame) -> DataFrame:
    """host, nodes (path, path above, style, share, prior) and features (path, hash of a text) of each page."""
    return pages.select(host_of().alias("host"), "html").mapInArrow(_measuring, "host string, nodes array<struct<path:string,up:string,style:long,share:double,prior:double>>, features array<struct<path:string,feature:long>>")


def style_tree(rows: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """host, path, up, pages, prior, presentation, content and importance of each node of the merged trees of a host.

    Over the m pages that have a node, its presentation is the entropy of its styles to the base m, or its share of a page's
    text if that is more (1 - (1 - entropy) * (1 - share)); its content is 1 less the mean entropy of its features, each over
    the pages that have it, to the base m. So a strip of fixed form that always takes a small part of a page scores low even if its
    words vary, and one whose words repeat scores lower. Half of what the tree says is the node's own score (presentation and content, 0.7 to
    0.3), half that of the node above, unless that is nearly the whole page; a node on fewer than ``least_pages`` pages, or on
    fewer than half of the pages of the node above, says nothing (1/2). Importance is the mean of this and the prior.
    All is counted with map-side combine over (host, path, style or feature), so a large host is no group.
    """
    nodes = F.transform("nodes", lambda n: F.struct(n["path"].alias("path"), n["up"].alias("up"), F.lit(0).alias("kind"), n["style"].alias("value"), n["share"].alias("share"), n["prior"].alias("prior")))
    texts = F.transform("features", lambda f: F.struct(f["path"].alias("path"), F.lit(None).cast("string").alias("up"), F.lit(1).alias("kind"), f["feature"].alias("value"), F.lit(None).cast("double").alias("share"), F.lit(None).cast("double").alias("prior")))
    every = rows.select("host", F.explode(F.concat(nodes, texts)).alias("x")).select("host", "x.*")
    counts = every.groupBy("host", "path", "kind", "value").agg(F.count("*").alias("c"), F.max("up").alias("up"), F.sum("share").alias("share"), F.min("prior").alias("prior"))
    style, c = F.col("kind") == 0, F.col("c")
    t = counts.groupBy("host", "path").agg(F.max("up").alias("up"), F.sum(F.when(style, c)).alias("pages"), F.sum(F.when(style, c * F.log(c))).alias("clogc"), F.avg(F.when(~style, F.log(c))).alias("logc"), F.sum("share").alias("share"), F.min("prior").alias("prior"))
    several, base = F.col("pages") > 1, F.log("pages")
    share = F.col("share") / F.col("pages")
    entropy = F.greatest(F.lit(0.0), 1 - F.col("clogc") / (F.col("pages") * base))
    t = t.withColumn("share", share).withColumn("presentation", F.when(several, 1 - (1 - entropy) * (1 - F.col("share"))).otherwise(1.0)).withColumn("content", F.when(several & F.col("logc").isNotNull(), 1 - F.least(F.col("logc") / base, F.lit(1.0))).otherwise(1.0))
    t = t.withColumn("own", PRESENTATION * F.col("presentation") + (1 - PRESENTATION) * F.col("content"))
    above = t.select(F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("own").alias("_own"), F.col("share").alias("_share"), F.col("pages").alias("_pages"))
    met = t.join(above, (F.col("host") == F.col("_host")) & (F.col("up") == F.col("_path")), "left")
    context = F.when(F.col("_share") < WHOLE, F.col("_own")).otherwise(0.5)
    known = (F.col("pages") >= least_pages) & (2 * F.col("pages") >= F.coalesce("_pages", F.lit(0)))
    said = F.when(known, F.least((F.col("own") + context) / 2, F.lit(0.99))).otherwise(0.5)
    return met.select("host", "path", "up", "pages", "prior", "presentation", "content", ((said + F.col("prior")) / 2).alias("importance"))


def low_branches(rows: DataFrame, least: float = LEAST, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, low): of each host the paths of its branches of importance below ``least``, less those inside another one."""
    low = stored(style_tree(rows, least_pages).where(F.col("importance") < least).select("host", "path", "up"), "low")
    top = low.join(low.select("host", F.col("path").alias("up")), ["host", "up"], "left_anti")
    return top.groupBy(F.col("host").alias("_host")).agg(F.collect_set("path").alias("low"))


def extract(pages: DataFrame, least: float = LEAST, least_pages: int = LEAST_PAGES) -> DataFrame:
    """page_id, url, text and n_chars of each row of ``pages``.

    The pages of a host are merged into a style tree, and branches whose importance is below ``least`` are removed from each
    page; what a page declares by element, role, class or id is a prior inside the importance (``_settle``). Blocks keep page
    order, joined by an empty line. With ``least`` 0 nothing is removed.

    Null or empty html: empty text. A null or relative url: the pages of no host are one site. Repeated rows and ids keep a row
    each. An empty table gives an empty one. Very long and very deep pages take time and memory in proportion to their length.
    Unclosed and crossed elements are closed where the next block begins. Pages are parsed twice, once for the tree and once for
    their text, so no text is stored in between. Other columns aren't read. Few hosts are broadcast with their low branches; beyond
    20,000 hosts or 4 million characters pages meet them in a shuffle, the pages of a host of more than 10,000 in several tasks.
    """
    rows = stored(measured(pages), "measured")
    low = stored(low_branches(rows, least, least_pages), "branches")
    size = low.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.aggregate("low", F.lit(0), lambda a, x: a + F.length(x))), F.lit(0)).alias("chars")).first()
    pages = pages.select("page_id", "url", "html")
    if size["n"] <= MOST_HOSTS and size["chars"] <= MOST_CHARS:  # measured
        met = pages.join(F.broadcast(low), host_of() == F.col("_host"), "left")
    else:
        hot = rows.groupBy("host").agg(F.ceil(F.count("*") / HOT_HOST).cast("int").alias("_salts")).where("_salts > 1").withColumnRenamed("host", "_hot")  # a row for each 10,000 pages at most
        dealt = pages.join(hot, host_of() == F.col("_hot"), "left").withColumn("_salt", F.pmod(F.xxhash64("page_id", "url"), F.coalesce("_salts", F.lit(1))).cast("int"))
        spread = low.join(hot, F.col("_host") == F.col("_hot"), "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).select("_host", "_part", "low")
        met = dealt.join(spread, (host_of() == F.col("_host")) & (F.col("_salt") == F.col("_part")), "left")
    met = met.select("page_id", "url", "html", "low")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in met.schema.fields if f.name not in ("html", "low"))
    return met.mapInArrow(_extracting, f"{kept}, text string").withColumn("n_chars", F.length("text").cast("long"))


def op5_html(spark, sf_dir: str) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    return extract(load(spark, sf_dir, "pages"))

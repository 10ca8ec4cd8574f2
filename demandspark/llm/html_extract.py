"""Main text of web pages by site style trees.

The pages of a host are merged into one tree: a node is a path of elements
from the body (tag and first class or id), and it gathers over the pages the
sequences of its children (presentations) and the hashes of its text blocks
(contents). A content found on d of a node's m pages has the entropy
log d / log m; a node's content importance is 1 less the mean entropy of the
contents in its branch, its presentation importance the entropy of its
presentations. Text that is the same on every page has none, text that differs
has all.

The importance of a branch is (1 - w) times its measured importance plus w
times what its elements tell. With w = 0.3 measurement decides: branches of an
article or main element, and branches of pages without one, tell 1 and fall if
their host's pages agree on them; branches beside an article tell 0 and stay if
their host's pages differ in them. Only menus, footers, asides, forms, and
elements whose class, id or role names an advert, notice, comment and the like
tell 0 with w = 0.8 and always fall, as adverts and comments differ on every
page too. Branches under 0.5 are removed, with those below them, where none of
these has more. A measure over m of a host's pages is trusted by 1 - (2/3)^m, the
rest is left to what the elements tell (an article if there is one, else all):
up to three pages they decide alone, on four a branch falls if hardly anything
in it differs. They also do where the measure leaves a page without text. Class names and ids count
as whole tokens ("no-sidebar" is no sidebar). An article or main element inside
a wrapper that only its name, a form or a header makes noise is main text all
the same; inside menus, asides, related texts, hidden elements and the like it
is where the page has no other text, and inside comments and adverts it is not.

Only verdicts that measurement changes travel back to the pages, as two lists
of paths per host.

Blocks are the texts between block elements; references are decoded, white
space becomes one space, and blocks are joined by newlines in page order.

Defined cases: a null html is empty and gives an empty text; a null or odd url
belongs to the host ""; null ids and repeated rows are kept; broken markup is
read leniently (a quote opens a string only after "="; unclosed elements end with their parent, embedded ones such as
select or iframe also at the next block; only scripts, styles and comments run
to the end of the page); elements nested deeper than DEEP share the path of the
one above them, and are read all the same; formulas and drawings keep their text; an empty table
gives an empty result. Only id, url and html are read, so other names cannot clash.
"""

from __future__ import annotations

import functools
import html as entities
import re
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import map_rows, stash

TOLD, UNTOLD = 0.8, 0.3  # w of noise, and of all else
BELOW = 0.5
BESIDE = 2  # told of what stands beside an article
DOUBT = 2 / 3  # each page that has a branch leaves so much of the doubt in its measure
DEEP = 64  # paths end here; elements below belong to their path's last one
NAME = 40  # characters of a name in paths; longer ones are hashed
PRESENTED = 0.1  # weight of presentation in the measured importance

# HTML's element kinds.
RAW = {"script", "style"}
# Embedded kinds without text of their own; one that is not closed ends with its parent or at the next block.
EMBEDDED = {"textarea", "title", "noscript", "iframe", "noembed", "noframes", "template", "select"}
DRAWN = {"svg", "g", "path", "text", "tspan", "textpath", "defs", "symbol", "use", "circle", "ellipse", "line", "polygon", "polyline", "rect", "lineargradient", "radialgradient", "stop", "clippath", "mask", "image"}
FORMULA = {"math", "semantics", "mrow", "mi", "mn", "mo", "ms", "mtext", "mspace", "msup", "msub", "msubsup", "mfrac", "msqrt", "mroot", "mover", "munder", "munderover", "mmultiscripts", "mprescripts", "mstyle", "mpadded", "mphantom", "merror", "menclose", "mtable", "mtr", "mtd"}
UNSEEN = {"annotation", "desc"}  # source and description beside a formula or drawing
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "img", "wbr", "br", "input", "object"} | DRAWN | FORMULA | UNSEEN
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
LISTS = {"ul", "ol", "dl", "table", "body", "article", "main", "section", "div"}
NOISE = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "head", "datalist", "fieldset", "metadata", "annotation-xml"} | EMBEDDED
MAIN = {"article", "main"}
# Names are whole class tokens or ids: an area's name, with words beside it that only say where or what kind of box it is.
_PLACE = r"(?:site|page|main|global|top|bottom|upper|lower|left|right|side|primary|secondary|mobile|desktop|sticky|fixed|floating|first|last|box|bar|block|area|zone|slot|unit|container|wrapper|wrap|inner|outer|panel|group|row|col|column|module|component|list|items?|links?|buttons?|btns?|icons?|form|section|region|open|active|collapsed|\d+(?:x\d+)?)"
_ABOUT = r"(?:post|entry|article|blog|story|user|reader|google|dfp|gpt|native|text|display|email|facebook)"
_REMARK = r"(?:ads?|adverts?|advertisements?|advertising|adsense|sponsor(?:ed|s)?|promos?|promotions?|comments?|commentlist|repl(?:y|ies)|discussion|disqus|respond)"
_AREA = (
    r"(?:banners?|menus?|nav|navbar|navigation|breadcrumbs?|sidebars?|footers?|masthead|topbar|toolbar|cookies?|consent|gdpr|notices?|alerts?|popups?|modals?|overlay|newsletter|subscribe|subscription|signup|sign[_-]up"
    r"|login|search|share|sharing|social|widgets?|pagination|pager|tags|copyright|disclaimer|legal|hidden|visually[_-]hidden)")
_OTHERS = r"(?:related|recommended|recommendations)"
REMARKS = re.compile(rf"(?:(?:{_PLACE}|{_ABOUT})[_-]+)*{_REMARK}\d*(?:[_-]+(?:{_PLACE}|{_ABOUT}|{_REMARK}|{_AREA}|{_OTHERS}))*", re.I)
OTHERS = re.compile(rf"(?:(?:{_PLACE}|{_ABOUT})[_-]+)*{_OTHERS}\d*(?:[_-]+(?:{_PLACE}|{_AREA}|posts?|articles?|stories|content|reading))*", re.I)
AREAS = re.compile(rf"(?:(?:{_PLACE}|{_ABOUT})[_-]+)*{_AREA}\d*(?:[_-]+(?:{_PLACE}|{_REMARK}|{_AREA}|{_OTHERS}|posts?|articles?|stories))*|(?:(?:site|page|main|global|top)[_-]+)?header(?:[_-]+{_PLACE})*", re.I)
REPLIES = re.compile(r"(?:(?:post|entry|user|reader|article|blog)[_-]+)?(?:comments?|repl(?:y|ies))(?:[_-]+(?:list|items?|body|content|\d+))*", re.I)
SOFT = {"form", "fieldset", "header"}
# How surely an element is noise: SOFTLY is a wrapper that may hold an article, SURELY is not, REMARK is a comment or advert.
SOFTLY, SURELY, REMARK = 1, 2, 3
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar", "toolbar"}

# A quote opens a string only directly after "=".
_VALUE = r"(?:\"[^\"]*+\"|'[^']*+'|[^\s>]++)"
TAG = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([A-Za-z][^\s/>]*)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+{_VALUE}?+)?+)*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(rf"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+({_VALUE}))?+")


class Block(NamedTuple):
    path: str
    text: str
    noise: int
    main: bool


class Open(NamedTuple):
    tag: str
    path: str
    noise: int
    main: bool
    children: list
    loose: bool = False  # an embedded element without an end


def attributes_of(attributes: str) -> dict[str, str]:
    """Whole attribute names and their values; the first of equal names counts."""
    found: dict[str, str] = {}
    for key, value in ATTRIBUTE.findall(attributes):
        found.setdefault(key.lower(), value[1:].rstrip(value[0]) if value[:1] in ("'", '"') else value)
    return found


@functools.lru_cache(maxsize=10_000)
def named(tag: str, value: str) -> int:
    """What the class or id tells of noise."""
    if tag in ("body", "html"):
        return 0
    tokens = value.split()
    if tag in MAIN:
        return REMARK if any(REPLIES.fullmatch(t) for t in tokens) else 0
    return next((noise for noise, names in ((REMARK, REMARKS), (SURELY, OTHERS), (SOFTLY, AREAS)) if any(names.fullmatch(t) for t in tokens)), 0)


def told(tag: str, attributes: str, inside_main: bool) -> tuple[str, int, bool]:
    """Name of the element in paths, how surely it is noise, and whether it tells of main text."""
    noise, main, name = 0, tag in MAIN, ""
    if tag in NOISE or (tag == "header" and not inside_main):
        noise = SOFTLY if tag in SOFT else SURELY
    for key, value in attributes_of(attributes).items() if attributes else ():
        if key in ("class", "id"):
            name = name or re.sub(r"\d+", "", value.split()[0]) if value.split() else name
            noise = max(noise, named(tag, value))
        elif key == "role":
            noise, main = max(noise, SURELY if value.lower() in ROLES else 0), main or value.lower() in ("main", "article")
        elif key == "itemprop":
            main = main or value.lower() == "articlebody"
        elif key == "style":
            noise = max(noise, SURELY if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) else 0)
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            noise = max(noise, SURELY)
    label = f"{tag}.{name}" if name else tag
    return (label if len(label) <= NAME else f"{label[:NAME]}~{xxhash.xxh3_64_hexdigest(label)}"), noise, main


def ended(tag: str, page: str, at: int) -> bool:
    """Whether an embedded element that begins before ``at`` has an end tag before the next of its kind (templates nest, and aren't asked for here)."""
    first = re.compile(rf"<(/?){tag}\b", re.I).search(page, at)
    return bool(first and first[1])


def parsed(page: str) -> tuple[list[Block], list[tuple[str, tuple]]]:
    """The page's blocks in order, and each element's path with its children's names."""
    blocks: list[Block] = []
    nodes: list[tuple[str, list]] = []
    root = Open("", "", 0, False, [])
    stack, parts, at = [root], [], 0
    drawing = unseen = False
    templates = None  # where the last end of one is

    paths: dict[tuple[str, str], str] = {}
    depth = {"": 0}
    opened: Counter[str] = Counter()
    led = loose = 0  # open articles that aren't noise, open embedded elements without an end

    def below(path: str, name: str) -> str:
        """One string per path, whatever number of elements has it."""
        if depth[path] >= DEEP:
            return path
        found = paths.get((path, name))
        if found is None:
            found = paths[path, name] = f"{path}/{name}"
            depth[found] = depth[path] + 1
        return found

    def flush() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            if text:
                top = stack[-1]
                blocks.append(Block(top.path, text, top.noise, top.main))

    def close(until: int) -> None:
        nonlocal led, loose
        flush()
        for o in stack[until:]:
            opened[o.tag] -= 1
            led -= o.main and not o.noise
            loose -= o.loose
        del stack[until:]

    while True:
        found = TAG.search(page, at)
        if not unseen:
            parts.append(page[at:found.start()] if found else page[at:])
        if not found:
            break
        at = found.end()
        slash, tag, attributes = found.group(1, 2, 3) if found[2] else found.group(4, 5, 6)
        if not tag:
            continue  # a comment or declaration
        tag, unseen = tag.lower(), False
        if slash:
            drawing = drawing and tag != "svg"
            if opened[tag]:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            elif tag not in INLINE and not (drawing and tag == "title"):
                flush()
            continue
        if tag in RAW:
            flush()
            if not attributes.rstrip().endswith("/"):
                end = re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in ("br", "mtr", "mtd"):
            parts.append(" ")
            continue
        if tag in UNSEEN or (drawing and tag == "title"):
            unseen = not attributes.endswith("/")
            continue
        drawing = tag == "svg" or (drawing and tag in INLINE)
        name, noise, main = told(tag, attributes, stack[-1].main)
        if tag in VOID:
            if tag not in INLINE:
                flush()
            continue
        if tag in INLINE and not noise:
            continue
        flush()
        if tag not in INLINE:
            if loose and tag not in ("option", "optgroup"):
                close(next(k for k in range(1, len(stack)) if stack[k].loose))
            if tag == "body" and stack[-1].tag not in ("", "html") and not opened["body"]:
                close(1 + (stack[1].tag == "html"))  # ends an open head
            ending = opened["p"] or any(opened[t] for t in ENDS.get(tag, ()))
            for k in range(len(stack) - 1, 0, -1) if ending else ():
                if stack[k].tag == "p" or stack[k].tag in ENDS.get(tag, ()):
                    close(k)
                    if tag == "p" or tag not in ENDS:
                        break
                elif stack[k].tag in LISTS or tag not in ENDS:
                    break
        top = stack[-1]
        path = "" if tag == "html" else name if tag == "body" else below(top.path, name)
        depth.setdefault(path, 1)
        # an article stands out of a wrapper, but not out of comments or of what main text has around it
        above = 0 if main and top.noise == SOFTLY and not led else top.noise
        node = Open(tag, path, max(above, noise), (top.main or main) and not noise, [])
        top.children.append(name)
        nodes.append((node.path, node.children))
        if tag in EMBEDDED:
            if tag == "template" and templates is None:
                templates = max((f.start() for f in re.finditer(r"</template\b", page, re.I)), default=-1)
            node = node._replace(loose=templates < at if tag == "template" else not ended(tag, page, at))
        if not attributes.endswith("/") or (tag not in INLINE and tag not in EMBEDDED):
            stack.append(node)
            opened[tag] += 1
            led += node.main and not node.noise
            loose += node.loose
    flush()
    return blocks, [(path, tuple(children)) for path, children in nodes]


def main_text(blocks: list[Block], low: set[str], high: set[str] | frozenset[str] = frozenset()) -> str:
    """The blocks that stay; the host's branches ``low`` are removed by measurement, and ``high`` stay beside an article by it."""
    clean = [b for b in blocks if not b.noise] or [b for b in blocks if b.noise < REMARK and b.main]
    main = [b for b in clean if b.main]
    led = [b for b in clean if b.main or b.path in high] if main else clean
    falls: dict[str, bool] = {}
    for path in {b.path for b in led} if low else ():
        steps = path.split("/")
        falls[path] = any("/".join(steps[:k]) in low for k in range(1, len(steps) + 1))
    kept = [b for b in led if not falls.get(b.path)]
    return "\n".join(b.text for b in kept or main or clean)


def host(url: str | None) -> str:
    found = re.match(r"\s*[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


def style_tree(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, path, told (0, 1, or null where nothing or not the same is told), beside (an article, on some page), pages, content, presentation, measured, importance (beside an article: aside) of every branch."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = ([], [], [], [], [])
        for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            site = host(url)
            blocks, nodes = parsed(page or "")
            has_main = any(b.main and not b.noise for b in blocks)
            tells = {b.path: 0 if b.noise else 1 if b.main else BESIDE if has_main else None for b in blocks}
            seen = {(b.path, 0, xxhash.xxh3_64_intdigest(b.text)) for b in blocks}
            seen |= {(path, 1, xxhash.xxh3_64_intdigest(repr(children))) for path, children in nodes if path}
            seen |= {(path, 2, 0) for path in tells} | {(path, 2, 0) for path, _ in nodes if path}
            for path, kind, feature in seen:
                for column, value in zip(out, (site, path, kind, feature - (1 << 63), tells.get(path)), strict=True):
                    column.append(value)
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=["host", "path", "kind", "feature", "told"])

    seen = map_rows(pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html")), "host string, path string, kind int, feature long, told int", one)
    counts = seen.groupBy("host", "path", "kind", "feature").agg(F.count("*").alias("n"), F.min("told").alias("low"), F.max("told").alias("high"), F.max(F.col("told").isNull()).alias("untold"))
    own = counts.groupBy("host", "path").agg(
        F.max(F.when(F.col("kind") == 2, F.col("n"))).alias("pages"), F.sum(F.when(F.col("kind") == 0, F.lit(1))).alias("contents"), F.sum(F.when(F.col("kind") == 0, F.log("n"))).alias("spread"),
        F.sum(F.when(F.col("kind") == 1, F.col("n") * F.log("n"))).alias("shapes"), F.min("low").alias("low"), F.max("high").alias("high"), F.max(F.when(F.col("kind") == 0, F.col("untold"))).alias("untold"),
    )
    own = stash(own, "style-nodes")
    scale = F.log(F.greatest("pages", F.lit(2)))
    # a content counts for its node and all nodes above
    steps = F.split("path", "/")
    above = own.where("contents > 0").select("host", F.explode(F.transform(F.sequence(F.lit(1), F.size(steps)), lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/"))).alias("path"), "contents", (F.col("spread") / scale).alias("entropy"), "low", "high", "untold")
    branch = above.groupBy("host", "path").agg(F.sum("contents").alias("all"), F.sum("entropy").alias("entropy"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("untold").alias("untold"))
    tree = branch.join(own.select("host", "path", "pages", "shapes"), ["host", "path"])
    content = 1 - F.col("entropy") / F.col("all")
    presentation = F.coalesce((scale - F.col("shapes") / F.col("pages")) / scale, F.lit(0.0))
    tells = F.when(~F.col("untold") & (F.col("low") == F.col("high")) & (F.col("low") < BESIDE), F.col("low"))
    tree = tree.select("host", "path", tells.alias("told"), (F.col("high") == BESIDE).alias("beside"), "pages", content.alias("content"), presentation.alias("presentation"))
    tree = tree.withColumn("measured", (1 - PRESENTED) * F.col("content") + PRESENTED * F.col("presentation"))
    # the fewer pages, the nearer to what elements tell
    trust = (1 - UNTOLD) * (1 - F.pow(F.lit(DOUBT), "pages"))
    noise = F.col("told") == 0
    tree = tree.withColumn("importance", F.when(noise, (1 - TOLD) * F.col("measured")).otherwise(1 - trust * (1 - F.col("measured"))))
    return tree.withColumn("aside", F.when(noise.isNull() | ~noise, trust * F.col("measured")))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, url, text, n_chars`` of every page."""
    tree = style_tree(pages, url_col, html_col)
    tree = stash(tree.select("host", "path", "told", "beside", "importance", "aside"), "style-tree")
    # a branch falls if all of it is low
    steps = F.split("path", "/")
    up = tree.select("host", F.explode(F.transform(F.sequence(F.lit(1), F.size(steps)), lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/"))).alias("path"), "importance")
    low = up.groupBy("host", "path").agg(F.max("importance").alias("most")).where(F.col("most") < BELOW).join(tree.where("told is null or told = 1"), ["host", "path"]).select("host", "path", F.lit(True).alias("falls"))
    high = tree.where(F.col("beside") & (F.col("aside") >= BELOW)).select("host", "path", F.lit(False).alias("falls"))
    verdicts = low.union(high).groupBy("host").agg(*(F.collect_set(F.when(F.col("falls") == falls, F.col("path"))).alias(name) for name, falls in (("low", True), ("high", False))))
    verdicts = stash(verdicts, "style-verdicts")
    site = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^\s*[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), site.alias("host")).join(verdicts, "host", "left").drop("host")
    kind = dict(pages.dtypes)[id_col]

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True)
        found = [main_text(parsed(page or "")[0], set(low or ()), set(high or ())) for page, low, high in rows]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())], names=["id", "url", "text", "n_chars"])

    return map_rows(rows, f"id {kind}, url string, text string, n_chars long", one).select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")

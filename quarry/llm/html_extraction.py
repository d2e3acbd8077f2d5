"""HTML extraction by template deduction from equivalence classes.

A page is a sequence of tokens: tags with their marks and the path of elements
around them, and stretches of text. Over all pages of a host, tokens that occur
equally often on every page (equal occurrence vectors) form an equivalence
class; a class of some size that most pages have belongs to the host's
template. On a page, a class is valid if its tokens come in one order in each
of its repetitions and if it nests with the other classes; valid classes make
up the template, and what stands between their tokens are the slots.

The main text is what the slots of the main element hold: the innermost element
of the template that holds more than half of the host's slot text. Blocks of
the template's text are none of it, but for those that belong to text of the
page: blocks that also hold a slot's text, and headings of blocks that do. What
serves the site within the main element is told by structure and not by words:
by HTML's own elements for it, by articles within the article, by elements of
the template that hold links for the most part, and by marks that the template
also has outside the main element. Marks of articles decide only on hosts
without a template or without a main element, and on a page of which the
template would leave nothing; where a page has no such mark either, it is the
page's innermost element with more than half of its text. Only there, where a
page tells nothing about its host, usual names of comments and the like count.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import settle
from quarry.llm.url_filters import url_host
from quarry.operators.common import join_hot

#: A class belongs to a host's template if this share of the host's pages, and this many at least, have it.
SUPPORT, LEAST_PAGES, LEAST_TOKENS = 0.6, 3, 3
#: The main element holds more than this share of a host's text.
MAIN_SHARE = 0.5
#: Templates of up to this many bytes are broadcast; more are joined by host.
BROADCAST_BYTES = 32 << 20
#: A host of more pages than this has many.
HOT_PAGES = 10_000

# Fixed values of HTML: kinds of elements.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
SITE = {"nav", "footer", "aside", "form", "head", "title", "noscript", "template", "button", "select", "textarea", "iframe", "svg", "object", "dialog", "menu", "script", "style"}
#: Elements that hold others; the main element is one of them.
CONTAINERS = {"html", "body", "div", "main", "article", "section", "center", "table", "tbody", "tr", "td"}
#: Lists, which serve the site where they hold links.
LISTS = {"ul", "ol", "dl"}
#: Elements that head the blocks behind them.
HEADS = {"h1", "h2", "h3", "h4", "h5", "h6", "dt", "th", "caption", "figcaption", "legend", "summary"}
#: Whole classes, ids and roles of elements that serve the site, where only a page's own marks decide.
SITE_NAMES = {"ad", "ads", "advertisement", "banner", "breadcrumbs", "comments", "complementary", "contentinfo", "cookies", "disqus_thread", "footer", "menu", "navigation", "newsletter", "respond", "search", "sidebar"}

_token = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|</?[a-z](?:\"[^\"]*\"|'[^']*'|[^'\">])*>|[^<]+|<", re.I | re.S)
_tag = re.compile(r"<(/?)([a-z][^\s/>]*)", re.I)
_mark = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_split = re.compile(r"[^a-z0-9]+")


class Token:
    """kind: text, open, close or other; path: a hash of the open elements' names; site: within an element that
    serves the site; main: within an article; within: in the main element; link: within a link; head: of a text, its
    element heads others; named: in an element of SITE_NAMES; mass: characters of text in an element that serve no site; links: those of them in links;
    end: place behind an element's last token; depth: of an element that may be the main one, else -1."""

    __slots__ = ("kind", "text", "name", "path", "site", "main", "within", "link", "head", "named", "mass", "links", "end", "depth", "_key")

    def __init__(self, kind, text, name, path, site, main, within=False, depth=-1):
        self.kind, self.text, self.name, self.path, self.site, self.main, self.within, self.depth = kind, text, name, path, site, main, within, depth
        self.mass, self.links, self.end, self.link, self.head, self.named, self._key = 0, 0, 0, False, False, False, None

    def key(self) -> int:
        """Signed 64 bits of what the token is and where it stands."""
        if self._key is None:
            what = " ".join(self.text.split()) if self.kind == "text" else self.name
            self._key = xxhash.xxh3_64_intdigest(f"{self.kind}\0{self.path}\0{what}") - (1 << 63)
        return self._key


def tokens(page: str, main: int | None = None) -> list[Token]:
    """The page's tokens. Elements that aren't closed end with the element around them; inline elements open nothing.
    `main` is the key of the main element's tag."""
    out: list[Token] = []
    # Name, path of what it holds, serves the site, mark of the article, in the main element, its tag, text and text of links before it.
    stack: list[tuple[str, int, bool, str, bool, Token, int, int]] = [("", 0, False, "", False, Token("open", "", "", 0, False, ""), 0, 0)]
    opened: dict[str, int] = defaultdict(int)
    mass = links = 0
    anchor = 0  # number of elements around the open link, if any
    named = 0  # number of elements around the open element of SITE_NAMES, if any

    def close(at: int) -> None:
        nonlocal anchor, named
        for name, _, _, _, _, tag, before, linked in stack[at:]:
            tag.mass, tag.links, tag.end = mass - before, links - linked, len(out)
            opened[name] -= 1
        del stack[at:]
        # A link that isn't closed ends with the element around it.
        anchor = 0 if at < anchor else anchor
        named = 0 if at <= named else named

    for m in _token.finditer(page):
        s = m.group()
        tag = _tag.match(s)
        if m.group(1) or s[:2] in ("<!", "<?") and s[:9] != "<![CDATA[":
            out.append(Token("other", "", s[:2] + (m.group(1) or "").lower(), 0, True, ""))
            continue
        _, path, in_site, mark, within, *_ = stack[-1]
        if not tag:
            # A section of characters is text without references.
            t = Token("text", entities.escape(s[9:-3], quote=False) if s[:9] == "<![CDATA[" else s, "", path, in_site, mark, within)
            t.link, t.head, t.named = anchor > 0, stack[-1][0] in HEADS, named > 0
            out.append(t)
            size = 0 if in_site else len(s.strip())
            mass += size
            links += size if anchor else 0
            continue
        name = tag.group(2).lower()
        if name == "a":
            anchor = 0 if tag.group(1) else len(stack)
        if tag.group(1):
            if name in INLINE or name in VOID:
                out.append(Token("other", " " if name == "br" else "", name, 0, False, ""))
                continue
            if opened[name]:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name))
            out.append(Token("close", "", name, stack[-1][1], False, ""))
            continue
        if name in INLINE or name == "br":
            out.append(Token("other", " " if name == "br" else "", name, 0, False, ""))
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack[-1][0] == name or stack[-1][0] == "p":
            close(len(stack) - 1)
        marks = " ".join(x.strip("\"'") for x in _mark.findall(s)).lower()
        words = set(_split.split(marks)) - {""}
        _, path, in_site, mark, within, *_ = stack[-1]
        t = Token("open", "", ".".join([name, *sorted(words)]), path, False, "", within, depth=len(stack) if name in CONTAINERS else -1)
        out.append(t)
        if name not in VOID and not s.endswith("/>"):
            # An article within an article is a reader's comment, a header outside of one is the site's.
            site = in_site or name in SITE or name == "header" and mark != "article" or name == "article" and mark == "article"
            mark = "article" if mark == "article" or name == "article" else mark or ("main" if name == "main" or "main" in words else "")
            stack.append((name, xxhash.xxh3_64_intdigest(f"{path}/{name}"), site, mark, within or main is not None and t.key() == main, t, mass, links))
            opened[name] += 1
            if not named and (name in CONTAINERS or name in LISTS) and not SITE_NAMES.isdisjoint(marks.split()):
                named = len(stack) - 1
    close(1)
    return out


def counts(page: str) -> dict[int, list[int]]:
    """For each token of a page: how often it occurs, the text in it, and its depth if it may be the main element."""
    found: dict[int, list[int]] = {}
    for t in tokens(page):
        if t.kind in ("open", "close") or t.kind == "text" and t.text.strip():
            x = found.setdefault(t.key(), [0, 0, t.depth])
            x[0] += 1
            x[1] += t.mass
    return found


def valid_classes(page: list[Token], classes: dict[int, int]) -> set[int]:
    """The template's classes (class of each token key) that are valid on a page:
    each repetition has its tokens in the same order, and any two classes nest.
    Of two that don't, the one of fewer repetitions stands."""
    places: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for i, t in enumerate(page):
        if t.kind in ("open", "close", "text"):
            c = classes.get(k := t.key())
            if c is not None:
                places[c].append((i, k))
    spans: dict[int, list[tuple[int, int]]] = {}
    for c, seen in places.items():
        size = len({k for _, k in seen})
        order = [k for _, k in seen]
        if len(order) % size == 0 and order == order[:size] * (len(order) // size):
            spans[c] = [(seen[i][0], seen[i + size - 1][0]) for i in range(0, len(seen), size)]
    kept: list[tuple[int, list[tuple[int, int]]]] = []
    for c, own in sorted(spans.items(), key=lambda x: (len(x[1]), -len(places[x[0]]), x[0])):
        if not any(_cross(own, other) for _, other in kept):
            kept.append((c, own))
    return {c for c, _ in kept}


def _cross(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> bool:
    """Whether a span of one list overlaps one of the other without holding it."""
    i = j = 0
    while i < len(a) and j < len(b):
        (x, y), (u, v) = a[i], b[j]
        if x < u < y < v or u < x < v < y:
            return True
        if y < v:
            i += 1
        else:
            j += 1
    return False


def slots(page: list[Token], fixed: set[int]) -> list[list[Token]]:
    """What stands between the template's tokens: the texts of each slot that has any."""
    out: list[list[Token]] = [[]]
    for t in page:
        if t.kind in ("open", "close", "text") and t.key() in fixed:
            out.append([])
        elif t.kind == "text" and t.text.strip():
            out[-1].append(t)
    return [x for x in out if x]


def _chosen(found: list[list[Token]]) -> set[Token]:
    """The texts of the slots that hold the main text. A slot is in an article if most of its text is."""
    own = [[t for t in x if not t.site] for x in found]
    weight = lambda texts: sum(len(t.text) for t in texts)
    marked = [2 * weight(t for t in x if t.main) > weight(x) for x in own]
    within = sum(weight(x) for x, m in zip(own, marked) if m)
    alone = 2 * within >= sum(map(weight, own)) > 0
    return {t for x, m in zip(own, marked) if m or not alone for t in x}


def _marked(page: list[Token]) -> tuple[str, set[Token]]:
    """The mark that a page has text in, if any, and the texts that the marks choose; without one, those of the innermost element with over half of the text."""
    own = [t for t in page if t.kind == "text" and not t.site and not t.named]
    level = next((m for m in ("article", "main") if any(t.main == m and t.text.strip() for t in own)), "")
    if level:
        return level, {t for t in own if t.main == level}
    total = sum(len(t.text.strip()) for t in own)
    large = [(t.depth, -i) for i, t in enumerate(page) if t.depth >= 0 and t.mass > MAIN_SHARE * total]
    if large:
        at = -max(large)[1]
        own = [t for t in page[at : page[at].end] if t.kind == "text" and not t.site and not t.named]
    return level, set(own)


def _of_the_site(page: list[Token], fixed: set[int]) -> set[Token]:
    """Texts in the main element that serve the site: in elements of the template that are links for the most part,
    or that have the marks of an element of the template outside. What is more than half of the main element's text serves no site."""
    tags = [(i, t) for i, t in enumerate(page) if t.kind == "open" and t.end > i and t.key() in fixed]
    first = next((i for i, t in enumerate(page) if t.within), 0)
    # An element around the main one is no other element.
    outside = {t.name for i, t in tags if not t.within and "." in t.name and not (i < first < t.end)}
    inside: dict[str, set[Token]] = defaultdict(set)
    for i, t in tags:
        kind = t.name.split(".")[0]
        if t.within and (kind in CONTAINERS or kind in LISTS) and (2 * t.links > t.mass or t.name in outside):
            inside[t.name].update(x for x in page[i : t.end] if x.kind == "text")
    weight = lambda texts: sum(len(x.text.strip()) for x in texts if not x.site)
    total = weight(t for t in page if t.kind == "text" and t.within)
    return {x for texts in inside.values() if 2 * weight(texts) <= total for x in texts}


def _blocks(page: list[Token]) -> list[list[Token]]:
    """Texts and inline tags between the tags of blocks."""
    out: list[list[Token]] = [[]]
    for t in page:
        if t.kind in ("open", "close"):
            out.append([])
        else:
            out[-1].append(t)
    return [b for b in out if b]


def _with_own_labels(blocks: list[list[Token]], chosen: set[Token], around: set[Token], heads: bool) -> set[Token]:
    """The chosen texts, and those of the template `around` them that belong to them: in one block with them, or with `heads` in headings that the chosen follow."""
    out, follows = set(chosen), False
    for b in reversed(blocks):
        texts = [t for t in b if t.kind == "text" and t.text.strip()]
        if not texts:
            continue
        if any(t in chosen for t in texts) or follows and heads and all(t.head and t in around for t in texts):
            out.update(t for t in texts if t in around)
            follows = True
        else:
            follows = False
    return out


def extract(page: str, classes: dict[int, int] | None = None, main: int | None = None) -> str:
    """The main text of a page, given the classes of its host's template and the key of its main element."""
    seq = tokens(page, main)
    blocks = _blocks(seq)
    valid = valid_classes(seq, classes) if classes else set()
    if valid:
        fixed = {k for k, c in classes.items() if c in valid}
        found = slots(seq, fixed)
        if main is not None and classes.get(main) in valid:
            site = _of_the_site(seq, fixed)
            around, heads = {t for t in seq if t.kind == "text" and t.within and not t.site and t not in site}, True
            chosen = {t for x in found for t in x if t in around}
        else:
            chosen = _chosen(found)
            level = {t.main for t in chosen}
            heads = "" not in level  # headings outside of a known article may be the site's
            around = {t for t in seq if t.kind == "text" and not t.site and t.main in level}
        chosen = _with_own_labels(blocks, chosen, around, heads)
    if not valid or not chosen:
        level, texts = _marked(seq)
        if level or not valid:
            chosen = texts
    lines = []
    for b in blocks:
        parts = (entities.unescape(t.text) if t.kind == "text" and (t in chosen or not t.site and t.text.isspace()) else t.text if t.kind == "other" else "" for t in b)
        lines.append(" ".join("".join(parts).split()))
    return "\n".join(x for x in lines if x)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 1000):
            part = b.slice(at, 1000)
            host, row, token, told = [], [], [], []
            for h, r, page in zip(*(part.column(i).to_pylist() for i in range(3))):
                found = counts(page)
                host += [h] * len(found)
                row += [r] * len(found)
                token += found
                told += found.values()
            n, mass, depth = zip(*told) if told else ((), (), ())
            columns = {"host": host, "row": row, "token": token, "n": n, "mass": mass, "depth": depth}
            yield pa.RecordBatch.from_pydict(columns, schema=pa.schema([(c, pa.string() if c == "host" else pa.int64()) for c in columns]))


def templates(pages: DataFrame) -> DataFrame:
    """(host, template, main): for each host its classes of tokens and the key of its main element, from all of `pages` (host, row, html); row is a hash of html.

    The occurrence vector of a token is folded into the exclusive or of a hash
    of each page with the token's count on it, so that a vector is a sum that
    each task begins, however many pages a host has. Copies of a page count
    once: what only copies share is no template. Only they are shuffled.
    """
    rows = pages.groupBy("host", "row").agg(F.count("*").alias("copies"))
    copied = settle(rows.where("copies > 1").select("host", "row", F.lit(True).alias("copied")))
    if copied.count() * 64 <= BROADCAST_BYTES:
        copied = F.broadcast(copied)
    told = pages.join(copied, ["host", "row"], "left").select("host", "row", "html", "copied")
    once = told.where("copied").groupBy("host", "row").agg(F.first("html").alias("html"))
    once = told.where("copied is null").select("host", "row", "html").unionByName(once)
    seen = once.mapInArrow(_count, "host string, row long, token long, n long, mass long, depth long")
    vectors = seen.groupBy("host", "token").agg(F.count("*").alias("pages"), F.bit_xor(F.xxhash64("row", "n")).alias("vector"), F.sum("mass").alias("mass"), F.max("depth").alias("depth"))
    hosts = rows.groupBy("host").agg(F.count("*").alias("of"))
    most = vectors.where(F.col("pages") >= LEAST_PAGES).join(hosts, "host").where(F.col("pages") >= SUPPORT * F.col("of"))
    element = F.when((F.col("depth") >= 0) & (F.col("mass") > 0), F.struct("depth", "mass", "token"))
    classes = most.groupBy("host", "vector").agg(F.collect_list("token").alias("tokens"), F.collect_list(element).alias("elements")).where(F.size("tokens") >= LEAST_TOKENS)
    found = classes.groupBy("host").agg(F.collect_list(F.struct("vector", "tokens")).alias("template"), F.flatten(F.collect_list("elements")).alias("elements"))
    # Elements that hold more than half of all text hold one another: the deepest is the main one.
    total = F.array_max(F.transform("elements", lambda e: e["mass"]))
    large = F.filter("elements", lambda e: e["mass"] > MAIN_SHARE * total)
    return found.select("host", "template", F.array_max(large)["token"].alias("main"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) of every row of `pages`; the text is empty if there is none.

    Blocks stand in page order, one a line; within a block white space is one
    blank and character references are decoded. Null html counts as empty, a
    null url has the empty host. Null ids and repeated rows stay rows of their
    own. Hosts of fewer pages than a template needs have none; their pages are
    read by their own marks.
    """
    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), url_host(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    deduced = settle(templates(source.select("host", F.xxhash64("html").alias("row"), "html")))
    size = deduced.agg(F.sum(F.aggregate("template", F.lit(0), lambda a, c: a + 16 + 8 * F.size(c["tokens"])))).first()[0] or 0
    # Beyond that, hosts of many pages (there are few of them) still get theirs by broadcast, so that no task has all pages of one.
    joined = source.join(F.broadcast(deduced), "host", "left") if size <= BROADCAST_BYTES else join_hot(source, deduced, ["host"], HOT_PAGES)
    kind = pages.schema[id_col].dataType.simpleString()
    out = joined.select("id", "url", "html", "template", "main").mapInArrow(_extract, f"id {kind}, url string, text string")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 500):
            part = b.slice(at, 500)
            text = []
            for page, template, main in zip(*(part.column(i).to_pylist() for i in (2, 3, 4))):
                classes = {t: c["vector"] for c in template or () for t in c["tokens"]}
                text.append(extract(page, classes, main))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string())], ["id", "url", "text"])

"""Wikitext and HTML to a tree of nodes, and the tree to sections of text.

The grammar is a documented subset: headings, bold and italic quotes, internal
and external links, lists, tables, references, comments, nowiki and HTML tags.
Nodes have a class; rules say for each class whether its node is kept (with
marks around it), removed (its text stays), purged or replaced by a mark.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# The node classes and what each rule set does with them.
PURGED = "Source Reference ReferenceList Gallery ImageMap RubyParantheses Caption Table Row Cell TimeLine Comment CategoryLink LangLink".split()
KEPT_INLINE = "Teletyped Strike Ruby RubyBase RubyText Deleted Inserted Abbreviation Italic Bold Strong Underline Overline Sub Sup Small Big Cite Var URL ArticleLink InterwikiLink NamedURL Emphasized".split()
KEPT_BLOCK = "Section HorizontalRule Index Div DefinitionList Item ItemList DefinitionTerm DefinitionDescription Heading Blockquote Preformatted Poem Paragraph".split()
NO_CLOSE = {"BreakingReturn", "HorizontalRule"}

CLASSIFY = {c: ("keep", None, None) for c in (*KEPT_INLINE, *KEPT_BLOCK, "BreakingReturn")} | {c: ("purge", "", "") for c in (*PURGED, "NameSpaceLink")}
CLASSIFY |= {c: ("replace", None, None) for c in ("Code", "Math", "ImageLink", "Hieroglyphs")} | {c: ("remove", "", "") for c in ("Center", "Span", "Font")}
CLASSIFY |= {"Article": ("keep", "<h1>", "</h1>"), "Paragraph": ("keep", "<p>", "</p>")}

SEGMENT = {c: ("remove", "", "") for c in (*KEPT_INLINE, *KEPT_BLOCK, "Article", "Code", "Center", "Span", "Font", "Math", "NameSpaceLink")} | {c: ("purge", "", "") for c in (*PURGED, "BreakingReturn", "ImageLink", "Hieroglyphs")}

_MARKS = {
    "Strike": "-", "Deleted": "-", "Overline": "-", "Inserted": "_", "Underline": "_", "Teletyped": "τ", "Abbreviation": "µ", "Item": "#", "ItemList": "•",
    "DefinitionTerm": ":", "DefinitionDescription": "⇥", "Italic": "/", "Emphasized": "/", "Bold": "∗", "Strong": "∗", "Blockquote": '"', "Sub": ",", "Sup": "^",
    "Small": "↓", "Big": "↑", "Cite": "<", "Var": "◊", "Preformatted": "π", "Poem": "π", "URL": ">", "ArticleLink": ">", "InterwikiLink": ">", "NamedURL": ">", "Heading": "=", "Section": "=",
}
MARK = {c: ("keep", f"⌊{m}", f"{m}⌋") for c, m in _MARKS.items()} | {c: ("purge", "", "") for c in (*PURGED, "BreakingReturn", "HorizontalRule", "Index", "RubyText", "Hieroglyphs", "NameSpaceLink")}
MARK |= {c: ("remove", "", "") for c in ("Center", "Span", "Font", "Ruby", "RubyBase", "DefinitionList")}
MARK |= {"Article": ("keep", "<___⌊δ", "δ⌋___>"), "Code": ("keep", "<___⌊◊", "◊⌋___>"), "Math": ("keep", "<___⌊×", "×⌋___>"), "Div": ("keep", "<______>", "___NL___"), "Paragraph": ("keep", "<______>", "___NL___"), "ImageLink": ("replace", "⌊✎⌋", "")}
#: Attributes that a node's end mark names, after a separator.
PARAMETERS = {"Section": "level", "Abbreviation": "title"}
RULES = {"classify": CLASSIFY, "segment": SEGMENT, "mark": MARK}

TAGS = {
    "p": "Paragraph", "div": "Div", "br": "BreakingReturn", "hr": "HorizontalRule", "b": "Bold", "strong": "Strong", "i": "Italic", "em": "Emphasized", "u": "Underline", "s": "Strike", "strike": "Strike",
    "del": "Deleted", "ins": "Inserted", "sub": "Sub", "sup": "Sup", "small": "Small", "big": "Big", "cite": "Cite", "var": "Var", "tt": "Teletyped", "code": "Code", "pre": "Preformatted", "poem": "Poem", "math": "Math",
    "ref": "Reference", "references": "ReferenceList", "gallery": "Gallery", "source": "Source", "timeline": "TimeLine", "imagemap": "ImageMap", "hiero": "Hieroglyphs", "blockquote": "Blockquote", "center": "Center", "span": "Span",
    "font": "Font", "abbr": "Abbreviation", "ruby": "Ruby", "rb": "RubyBase", "rt": "RubyText", "rp": "RubyParantheses", "ul": "ItemList", "ol": "ItemList", "li": "Item", "dl": "DefinitionList", "dt": "DefinitionTerm", "dd": "DefinitionDescription",
    "table": "Table", "tr": "Row", "td": "Cell", "th": "Cell", "caption": "Caption", "a": "NamedURL", "article": "Div",
}
BLOCK = {"Article", "Section", "Paragraph", "Div", "HorizontalRule", "Blockquote", "Center", "Preformatted", "Poem", "ItemList", "Item", "DefinitionList", "DefinitionTerm", "DefinitionDescription", "Table", "Row", "Cell", "Caption", "Gallery", "Source", "TimeLine", "ReferenceList", "ImageMap"}
RAW = {"math", "source", "timeline", "nowiki", "hiero", "imagemap", "gallery"}
HIDDEN = {"script", "style", "head", "nav", "footer", "title"}

_comment = re.compile(r"<!--.*?(?:-->|\Z)|<![A-Za-z][^>]*>", re.S)
_tag = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>")
_heading = re.compile(r"^(={1,6})\s*(.*?)\s*\1\s*$")
_html_heading = re.compile(r"<h([1-6])\b[^>]*>(.*?)</h\1\s*>", re.I | re.S)
_inline = re.compile(r"'{2,5}|\[\[|\]\]|\[(?=https?://|ftp://|mailto:)|\]|https?://[^\s<>\[\]\"']+|<")
_link_signs = re.compile(r"\[\[|\]\]")
_list = re.compile(r"^([*#:;]+)\s*(.*)$")


@dataclass
class Node:
    cls: str
    text: str = ""
    children: list[Node] = field(default_factory=list)
    attributes: dict[str, str] = field(default_factory=dict)
    tag: str = ""

    def walk(self):
        """This node and all below it in pre-order."""
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack += n.children[::-1]


def parse(title: str, markup: str) -> Node:
    """The tree of an article: the article's node, paragraphs and lists, and nested sections by level."""
    markup = _comment.sub("", markup)
    for name in HIDDEN:
        markup = re.sub(rf"<{name}\b[^>]*>.*?(?:</{name}\s*>|\Z)", "", markup, flags=re.I | re.S)
    markup = _html_heading.sub(lambda m: f"\n{'=' * int(m.group(1))} {' '.join(m.group(2).split())} {'=' * int(m.group(1))}\n", markup)
    root = Node("Article", attributes={"level": "1"}, text=title)
    open_sections = [(1, root)]
    buffer: list[str] = []
    lines = markup.split("\n")

    def flush() -> None:
        _blocks("\n".join(buffer), open_sections[-1][1])
        buffer.clear()

    for line in lines:
        m = _heading.match(line)
        if not m:
            buffer.append(line)
            continue
        flush()
        level = max(2, len(m.group(1)))
        while len(open_sections) > 1 and open_sections[-1][0] >= level:
            open_sections.pop()
        head = Node("Heading")
        _inlines(m.group(2), head)
        section = Node("Section", attributes={"level": str(level)}, children=[head])
        open_sections[-1][1].children.append(section)
        open_sections.append((level, section))
    flush()
    return root


def _blocks(text: str, parent: Node) -> None:
    """Paragraphs, lists and tables of a stretch without headings."""
    lines, at, plain = text.split("\n"), 0, []
    while at < len(lines):
        if lines[at].lstrip(" \t:").startswith("{|"):
            _paragraphs("\n".join(plain), parent)
            plain = []
            node, at = _table(lines, at)
            parent.children.append(node)
        else:
            plain.append(lines[at])
            at += 1
    _paragraphs("\n".join(plain), parent)


def _table(lines: list[str], at: int) -> tuple[Node, int]:
    """The table that begins at a line, and the line behind it; one that isn't closed ends with the text.

    `|-` begins a row, `|+` the caption, `|` and `!` cells, with `||` and `!!`
    between cells of a line; what stands before a single bar in a cell are its
    attributes. Lines without a mark go on with the cell. Tables nest.
    """
    table, row, cell = Node("Table"), None, None
    body: list[str] = []

    def close() -> None:
        if cell is not None and body:
            _blocks("\n".join(body), cell)
        body.clear()

    at += 1
    while at < len(lines):
        line = lines[at].strip()
        if line.startswith("{|") and cell is not None:
            close()
            node, at = _table(lines, at)
            cell.children.append(node)
            continue
        at += 1
        if line.startswith("|}"):
            break
        if line.startswith(("|-", "|+")):
            close()
            row = Node("Row" if line[1] == "-" else "Caption")
            table.children.append(row)
            cell = row if line[1] == "+" else None
            if cell is not None:
                body.append(_content(line[2:]))
        elif line[:1] in ("|", "!") and line:
            close()
            if row is None or row.cls == "Caption":
                row = Node("Row")
                table.children.append(row)
            for part in re.split(r"\|\||!!" if line[0] == "!" else r"\|\|", line[1:]):
                close()
                cell = Node("Cell", tag="th" if line[0] == "!" else "td")
                row.children.append(cell)
                body.append(_content(part))
        else:
            body.append(lines[at - 1])
    close()
    return table, at


def _content(cell: str) -> str:
    """A cell without its attributes: they end at a single bar outside links."""
    head, bar, rest = cell.partition("|")
    return (rest if bar and "[[" not in head and "{{" not in head else cell).strip()


def _paragraphs(text: str, parent: Node) -> None:
    """Paragraphs and lists."""
    for part in re.split(r"\n[ \t]*\n|(?=\n[*#:;])", text):
        items, rest = [], []
        for line in part.split("\n"):
            m = _list.match(line)
            (items if m else rest).append(m or line)
        body = "\n".join(rest).strip()
        if body:
            if re.match(r"<(p|div|blockquote|ul|ol|dl|table|center|pre|article)\b", body, re.I):
                _inlines(body, parent)
            else:
                node = Node("Paragraph")
                _inlines(body, node)
                parent.children.append(node)
        for m in items:
            _item(m.group(1), m.group(2), parent)


def _item(marks: str, text: str, parent: Node) -> None:
    """An item of a list: each mark but the last leads into the last item of the list around it."""
    for mark in marks[:-1]:
        if mark in "*#":
            if not (parent.children and parent.children[-1].cls == "ItemList"):
                parent.children.append(Node("ItemList"))
            parent = parent.children[-1]
            if not parent.children:
                parent.children.append(Node("Item"))
            parent = parent.children[-1]
        elif parent.children and parent.children[-1].cls in ("DefinitionTerm", "DefinitionDescription"):
            parent = parent.children[-1]
        else:
            parent.children.append(Node("DefinitionDescription"))
            parent = parent.children[-1]
    if marks[-1] in "*#":
        if not (parent.children and parent.children[-1].cls == "ItemList"):
            parent.children.append(Node("ItemList"))
        item = Node("Item")
        parent.children[-1].children.append(item)
    else:
        item = Node("DefinitionTerm" if marks[-1] == ";" else "DefinitionDescription")
        parent.children.append(item)
    _inlines(text, item)


def _link(target: str, label: str | None) -> Node:
    space = target.split(":", 1)[0].strip().lower() if ":" in target else ""
    if space in ("file", "image", "datei", "bild"):
        return Node("ImageLink", children=[Node("Text", label or target)], attributes={"target": target})
    if space in ("category", "kategorie"):
        return Node("CategoryLink", attributes={"target": target})
    if re.fullmatch(r"[a-z]{2,3}", space):
        return Node("LangLink", attributes={"target": target})
    node = Node("NameSpaceLink" if space in ("user", "talk", "template", "help", "portal", "project") else "ArticleLink", attributes={"target": target})
    _inlines(label if label is not None else target, node)
    return node


def _inlines(text: str, parent: Node) -> None:
    """Links, quotes and tags. What isn't closed ends with its surroundings."""
    stack = [parent]
    closings: dict[int, int] | None = None

    def say(s: str) -> None:
        if s:
            stack[-1].children.append(Node("Text", s))

    def toggle(cls: str) -> None:
        if stack[-1].cls == cls and stack[-1].tag == "'":
            stack.pop()
        else:
            node = Node(cls, tag="'")
            stack[-1].children.append(node)
            stack.append(node)

    at = 0
    while at < len(text):
        m = _inline.search(text, at)
        if not m:
            say(text[at:])
            break
        say(text[at : m.start()])
        s, at = m.group(), m.end()
        if s[0] == "'":
            for cls in {2: ("Italic",), 3: ("Bold",), 4: ("Bold",), 5: ("Bold", "Italic")}[len(s)]:
                toggle(cls)
        elif s == "[[":
            closings = _closings(text) if closings is None else closings
            end = closings.get(at, -2)
            end = _closing(text, at) if end < -1 else end
            if end < 0:
                say(s)
                continue
            target, bar, label = text[at:end].partition("|")
            stack[-1].children.append(_link(target.strip(), label.rpartition("|")[2] if bar else None))
            at = end + 2
        elif s == "[":
            end = text.find("]", at)
            if end < 0:
                say(s)
                continue
            url, _, label = text[at:end].partition(" ")
            node = Node("NamedURL" if label else "URL", attributes={"target": url})
            _inlines(label, node) if label else node.children.append(Node("Text", url))
            stack[-1].children.append(node)
            at = end + 1
        elif s == "<":
            tag = _tag.match(text, m.start())
            if not tag:
                say(s)
                continue
            at = tag.end()
            name = tag.group(2).lower()
            if tag.group(1):
                where = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == name), None)
                if where:
                    del stack[where:]
                continue
            cls = TAGS.get(name)
            closed = tag.group(3).endswith("/") or name in ("br", "hr")
            attributes = {k.lower(): v.strip("\"'") for k, v in re.findall(r"([\w-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", tag.group(3))}
            if name in RAW and not closed:
                end = re.compile(rf"</{name}\s*>", re.I).search(text, at)
                body = text[at : end.start() if end else len(text)]
                at = end.end() if end else len(text)
                if name == "nowiki":
                    say(body)
                else:
                    stack[-1].children.append(Node(cls, children=[Node("Text", body)], attributes=attributes, tag=name))
                continue
            if cls is None:
                continue
            if name in ("p", "li", "dt", "dd", "tr", "td", "th"):
                where = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == name), None)
                if where:
                    del stack[where:]
            node = Node(cls, attributes=attributes, tag=name)
            stack[-1].children.append(node)
            if not closed:
                stack.append(node)
        elif s.startswith("http"):
            stack[-1].children.append(Node("URL", children=[Node("Text", s)], attributes={"target": s}))
        else:
            say(s)


def _closings(text: str) -> dict[int, int]:
    """For the content of each `[[`, where the `]]` stands that closes it; -1 if none does. In one pass."""
    found: dict[int, int] = {}
    stack: list[int] = []
    for m in _link_signs.finditer(text):
        if m.group() == "[[":
            stack.append(m.end())
            found[m.end()] = -1
        elif stack:
            found[stack.pop()] = m.start()
    return found


def _closing(text: str, at: int) -> int:
    """The `]]` that closes a link, with links inside."""
    depth = 1
    for m in _link_signs.finditer(text, at):
        depth += 1 if m.group() == "[[" else -1
        if depth == 0:
            return m.start()
    return -1


@dataclass(frozen=True)
class Rule:
    """What becomes of a class of nodes: keep, remove, purge or replace; marks around it; attributes that the end mark names behind a separator."""

    action: str
    start: str = ""
    end: str = ""
    separator: str = ""
    parameters: tuple[str, ...] = ()


def rules_of(rows) -> dict[str, Rule]:
    """Rules by lower-case name from rows (name, action, start, end, separator, parameters), as `read_node_rules` gives them."""
    found = {r["name"].lower(): Rule(r["action"], r["start"] or "", r["end"] or "", r["separator"] or "", tuple(r["parameters"] or ())) for r in rows}
    return {"node": Rule("remove"), "text": Rule("remove")} | found


class Renderer:
    """Text of nodes by a rule set, `classify`, `segment` or `mark`, or by rules of one's own in the manner of one of these."""

    def __init__(self, mode: str = "classify", rules: dict[str, Rule] | None = None, extra_newlines: bool = False):
        self.mode, self.own, self.rules, self.extra = mode, rules, RULES[mode], extra_newlines

    def rule(self, n: Node) -> tuple[str, str, str]:
        if n.cls == "ImageLink" and n.attributes.get("block"):
            return "purge", "", ""
        if self.own is not None:
            # By class, else by tag; a node without a rule is kept without marks.
            r = self.own.get(n.cls.lower()) or self.own.get(n.tag.lower()) or Rule("keep")
            return r.action, r.start, r.end
        action, start, end = self.rules.get(n.cls, ("keep", "", ""))
        name = n.tag if n.tag and n.tag != "'" else n.cls
        if start is None:
            start = f"<{name}>" if action == "keep" else f"<{name} />"
            end = f"</{name}>" if action == "keep" else ""
        return action, start, end or ""

    def parameters(self, n: Node) -> str:
        """A separator and the values of the attributes that the rule names; missing ones are left out."""
        if self.own is not None:
            r = self.own.get(n.cls.lower()) or self.own.get(n.tag.lower()) or Rule("keep")
            values = [n.attributes[p] for p in r.parameters if n.attributes.get(p)]
            return "".join(r.separator + v for v in values)
        value = n.attributes.get(PARAMETERS.get(n.cls, ""), None) if self.mode == "mark" else None
        return f"¦{value}" if value else ""

    def render(self, n: Node) -> str:
        return self._classified(n) if self.mode == "classify" else self._plain(n)

    def _classified(self, n: Node) -> str:
        """Text for classifiers: purged nodes leave nothing, kept ones their text without white space around it."""
        if n.cls == "Text":
            return n.text
        action, start, end = self.rule(n)
        if action == "purge":
            return ""
        if action == "replace":
            out = start
        elif action == "keep" and n.cls in NO_CLOSE:
            return start.replace(">", " />") + "\n" if self.own is None else start + "\n"
        else:
            out = "".join([self.render(c) for c in n.children])
            if action == "keep":
                out = out.strip()
                out = start + out + end if out else ""
        return out + "\n" if out and n.cls in BLOCK else out

    def _plain(self, n: Node) -> str:
        if n.cls == "Text":
            return n.text
        action, start, end = self.rule(n)
        inner = "".join([self.render(c) for c in n.children])
        block = n.cls in BLOCK
        if action == "purge":
            return "\n" if self.extra and block else " "
        if action == "replace":
            out = start
        elif action == "keep":
            out = start if n.cls in NO_CLOSE else start + inner + self.parameters(n) + end if inner.strip() else ""
        else:
            out = inner
        if out and block:
            out = ("\n" if self.extra else "") + out + "\n"
        return out

    def heading(self, n: Node) -> str:
        """The heading of a section or article, on one line."""
        title = self.title(n)
        if self.mode == "classify":
            level = n.attributes["level"]
            return f"<h{level}>{title}</h{level}>"
        _, start, end = self.rule(n)
        return (start + title + (self.parameters(n) if n.cls == "Section" else "") + end).replace("\n", "")

    def title(self, n: Node) -> str:
        return n.text if n.cls == "Article" else "".join([self.render(c) for c in n.children[0].children]).strip()


def sections(title: str, markup: str, mode: str = "classify", rules: dict[str, Rule] | None = None) -> list[dict]:
    """(sec_idx, level, title, heading, content, n_par) of an article in order; sections stand on their own."""
    root, r = parse(title, markup), Renderer(mode, rules)
    out: list[dict] = []

    def visit(n: Node) -> None:
        own = [c for c in (n.children if n.cls == "Article" else n.children[1:]) if c.cls != "Section"]
        n_par = sum(1 for c in own for x in c.walk() if x.cls == "Paragraph" and r.rule(x)[0] != "purge" and r.render(x).strip())
        out.append({"sec_idx": len(out), "level": int(n.attributes["level"]), "title": r.title(n), "heading": r.heading(n), "content": "".join(map(r.render, own)).strip(), "n_par": n_par})
        for c in n.children:
            if c.cls == "Section":
                visit(c)

    visit(root)
    return out


def nodes(title: str, markup: str) -> list[dict]:
    """The tree in pre-order: (node_id, parent_id, depth, cls, tag, is_block, text)."""
    out: list[dict] = []

    def visit(n: Node, parent: int, depth: int) -> None:
        k = len(out)
        out.append({"node_id": k, "parent_id": parent, "depth": depth, "cls": n.cls, "tag": n.tag, "is_block": n.cls in BLOCK, "text": n.text})
        for c in n.children:
            visit(c, k, depth + 1)

    visit(parse(title, markup), -1, 0)
    return out

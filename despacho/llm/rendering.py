"""Visible text of HTML pages, laid out in lines.

A tree builder adds the tags that authors leave out; a walk over the tree
drops what a browser wouldn't show and lays out the rest: blocks on lines of their
own, a blank line where a block has margins, markers and indents for lists, table
cells in aligned columns, and preformatted text as it is.

Not shown: head, scripts, styles, templates, fallbacks for scripts and media,
``hidden`` elements, ``display:none`` and ``visibility:hidden`` of style attributes
(but what is visible again inside the latter), closed details but their summary,
closed dialogs, all but the selected option of a menu, and of formulas and drawings
what only describes or defines (no ``use`` is followed). Defined cases: a
null page has a null text, an empty one an empty text; a tag that isn't closed
ends with the page; columns pad to 60 characters at most (longer cells are whole);
tables nested deeper than 20 levels run on without columns, as each level lays out
the lines of those inside once more; an empty table gives no rows.

Time and text grow in proportion to the page. For that, indents of lists and quotes end
at 120 characters, cells beyond the thousandth column of a table share one, and a table
whose padding would be far more than its text and cells has none. No text is lost to it.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from despacho.llm.arrow import with_columns

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = frozenset(
    "script style template title noscript noembed noframes iframe object audio video canvas datalist progress meter rp".split()
)
# Elements of drawings and formulas go by names of their own, which no tag of HTML can have.
UNSEEN |= {f"svg {x}" for x in "title desc metadata defs symbol clippath mask marker pattern style script".split()}
UNSEEN |= {f"math {x}" for x in "annotation annotation-xml mphantom".split()}
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote figure table hr fieldset menu dir plaintext".split())
BLOCK = SPACED | frozenset(
    "html body address article aside center details dialog dd div dt fieldset figcaption footer form header hgroup legend li main"
    " nav optgroup search section summary caption thead tbody tfoot tr".split()
)
ENDS_P = BLOCK - {"html", "body", "caption", "thead", "tbody", "tfoot", "tr", "legend", "optgroup"}
CELLS, SECTIONS = frozenset(["td", "th"]), frozenset(["thead", "tbody", "tfoot"])
LISTS = frozenset(["ul", "ol", "menu", "dir"])
OF_TABLE = SECTIONS | {"tr", "caption", "colgroup"} | CELLS
# What a start tag ends if it is open, and the elements beyond which it is not looked for.
ENDED_BY = {
    "li": (frozenset(["li"]), LISTS),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist", "optgroup"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "td": (CELLS | {"caption", "colgroup"}, frozenset(["tr", "table"])),
    "th": (CELLS | {"caption", "colgroup"}, frozenset(["tr", "table"])),
    "tr": (OF_TABLE - SECTIONS, SECTIONS | {"table"}),
    "thead": (OF_TABLE, frozenset(["table"])),
    "tbody": (OF_TABLE, frozenset(["table"])),
    "tfoot": (OF_TABLE, frozenset(["table"])),
    "caption": (OF_TABLE, frozenset(["table"])),
    "colgroup": (OF_TABLE, frozenset(["table"])),
    "col": (OF_TABLE - {"colgroup"}, frozenset(["table"])),
}
# Some of them hold HTML; elsewhere in them these tags end the drawing or formula.
HOLDS_HTML = {f"svg {x}" for x in ("foreignobject", "desc", "title")} | {f"math {x}" for x in "mi mo mn ms mtext".split()}
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre"
    " ruby s small span strong strike sub sup table tt u ul var".split()
)
SCOPE = frozenset(["table", "td", "th", "caption", "button", "object", "html"]) | HOLDS_HTML
PAST_SCOPE = SCOPE | SECTIONS | {"tr"}  # end tags that reach beyond it
MOST_COLUMNS, MOST_ROWS = 1000, 65534  # of one cell, as HTML has it
PAD, GAP, DEEPEST = 60, "  ", 20
MOST_INDENT = 120
PADDING = 20  # characters of padding for one of text, at most

BLANKS = " \t\n\r\f"
SPACE = re.compile(rf"[{BLANKS}]+")
# A quote opens a value only directly behind "=" and blanks; anywhere else it is a character like others.
NAME, VALUE = rf"=?[^{BLANKS}/>=]*+", rf"\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^{BLANKS}>\"'][^{BLANKS}>]*)"
ATTRIBUTE = re.compile(rf"(?!(?:[{BLANKS}/>]|\Z))({NAME})(?:[{BLANKS}]*=[{BLANKS}]*(?:{VALUE})?)?+")
TAG = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>?"
    rf"|<(?P<end>/?)(?P<name>[a-zA-Z][^{BLANKS}/>]*)(?P<attributes>(?:[{BLANKS}/]++|{ATTRIBUTE.pattern})*+)(?:>|\Z)",
    re.S,
)
STYLE_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
STRING = r"\"(?:[^\"\\]|\\.)*+(?:\"|\Z)|'(?:[^'\\]|\\.)*+(?:'|\Z)"
DECLARATION = re.compile(rf"(?:[^;\"'(]|{STRING}|\((?:[^)\"']|{STRING})*+(?:\)|\Z))++", re.S)
EVERYWHERE = frozenset("inherit initial unset revert revert-layer".split())
# Browsers pass over a declaration whose value they don't know.
KNOWN = {
    "visibility": frozenset(["visible", "hidden", "collapse"]) | EVERYWHERE,
    "display": EVERYWHERE
    | frozenset(
        "none contents block inline run-in flow flow-root table flex grid ruby math list-item inline-block inline-table inline-flex"
        " inline-grid table-row-group table-header-group table-footer-group table-row table-cell table-column-group table-column"
        " table-caption ruby-base ruby-text -webkit-box -webkit-inline-box -webkit-flex -webkit-inline-flex".split()
    ),
}


def declared(style: str) -> dict[str, str]:
    """The display and visibility that a style attribute sets: of each the last declaration, important ones first."""
    found: dict[str, str] = {}
    binding = set()
    for declaration in DECLARATION.findall(STYLE_COMMENT.sub(" ", style)):
        name, _, value = declaration.partition(":")
        name = name.strip().lower()
        if name not in KNOWN:
            continue
        value, mark, word = value.strip().lower().partition("!")
        important = word.strip() == "important"
        if mark and not important or not value.split() or not KNOWN[name].issuperset(value.split()):
            continue
        if important or name not in binding:
            found[name] = value.strip()
        if important:
            binding.add(name)
    return found


class Node:
    __slots__ = ("tag", "attributes", "children", "display", "visibility", "marked")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []
        self.marked = True  # whether a list item's marker is shown
        self.styled()

    def styled(self) -> None:
        found = declared(self.attributes["style"]) if "style" in self.attributes else {}
        self.display, self.visibility = found.get("display"), found.get("visibility")


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        value = next((v for v in m.groups()[1:] if v is not None), "")
        found.setdefault(m[1].lower(), unescape(value) if "&" in value else value)
    return found


def _empty(attributes: str) -> bool:
    """Whether the tag ends in a slash that is no part of a value."""
    last = None
    for last in ATTRIBUTE.finditer(attributes):
        pass
    return attributes.endswith("/") and not (last and last.end() == len(attributes))


def build(html: str) -> Node:
    """The page as a tree; start tags end what they imply, end tags what is open inside.

    Nothing that may stand in a head is shown and all else ends it, so a head has
    no node of its own; there is always one body. Elements of drawings and formulas
    are named ``svg ...`` and ``math ...``.
    """
    root, body = Node("html", {}), Node("body", {})
    root.children.append(body)
    open_ = [root, body]
    # Where elements of a name are open, so that none is looked for step by step; and those of HTML.
    places: defaultdict[str, list[int]] = defaultdict(list)
    of_html = [0, 1]

    def push(node: Node) -> None:
        places[node.tag].append(len(open_))
        if " " not in node.tag:
            of_html.append(len(open_))
        open_.append(node)

    def cut(i: int) -> None:
        for node in open_[i:]:
            places[node.tag].pop()
        del open_[i:]
        while of_html[-1] >= i:
            of_html.pop()

    def last(tags: Iterable[str]) -> int:
        """The innermost open element of these names; 0 if there is none."""
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def close(tags: frozenset, until: frozenset) -> None:
        # On outwards: a row ends its cell, and a section its row.
        while (i := last(tags)) and i > last(until):
            cut(i)

    def end_columns() -> None:
        # A group of columns holds nothing but columns; whatever else comes ends it.
        if open_[-1].tag == "colgroup":
            cut(len(open_) - 1)

    def add(text: str) -> None:
        if text.strip(BLANKS):
            end_columns()
        if text:
            open_[-1].children.append(unescape(text) if "&" in text else text)

    def foreign() -> str:
        """What names begin with where the next tag stands: nothing, or that of a drawing or formula."""
        tag = open_[-1].tag
        return tag[: tag.find(" ") + 1] if tag not in HOLDS_HTML else ""

    def end_foreign(name: str) -> bool:
        """End the open element of a drawing or formula that has this name."""
        i = last((f"svg {name}", f"math {name}"))
        if i > of_html[-1]:
            cut(i)
            return True
        return False

    at = 0
    while at < len(html):
        m = TAG.search(html, at)
        if not m:
            add(html[at:])
            break
        add(html[at : m.start()])
        at = m.end()
        name = m["name"]
        if not name:
            if m[0].startswith("<![CDATA[") and foreign():
                end = html.find("]]>", m.start())
                open_[-1].children.append(html[m.start() + 9 : end if end >= 0 else len(html)])
                at = end + 3 if end >= 0 else len(html)
            continue
        name = name.lower()
        if m["end"]:
            if " " in open_[-1].tag and end_foreign(name):
                continue
            i = last((name,))
            if i and (name in PAST_SCOPE or i > last(SCOPE)):
                cut(i)
            continue
        attributes = _attributes(m["attributes"]) if m["attributes"].strip("/ \n") else {}
        space = foreign()
        if space and (name in ENDS_FOREIGN or name == "font" and not attributes.keys().isdisjoint(("color", "face", "size"))):
            while foreign():
                cut(len(open_) - 1)
            space = ""
        if space or name in ("svg", "math"):
            end_columns()
            node = Node((space or name + " ") + name, attributes)
            open_[-1].children.append(node)
            if not _empty(m["attributes"]):
                push(node)
            continue
        if name in ("html", "head", "body"):
            if name != "head" and not places.get("template"):
                whole = root if name == "html" else body
                whole.attributes = attributes | whole.attributes
                whole.styled()
            continue
        if name not in ("col", "template"):
            end_columns()
        if name in ENDS_P:
            close(frozenset(["p"]), SCOPE)
        if name in ENDED_BY:
            close(*ENDED_BY[name])
        node = Node(name, attributes)
        open_[-1].children.append(node)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, at)
            stop = end.start() if end else len(html)
            node.children.append(unescape(html[at:stop]) if name in ("textarea", "title") else html[at:stop])
            closing = html.find(">", stop)
            at = closing + 1 if end and closing >= 0 else len(html)
        elif name == "plaintext":
            node.children.append(html[at:])
            at = len(html)
        elif name not in VOID and not m[0].endswith("/>") or name in BLOCK:
            push(node)
    return root


def shown(node: Node) -> bool:
    """Whether an element has a place in the layout; a display of its own overrules what ``hidden`` and ``dialog`` imply."""
    a = node.attributes
    if node.tag in UNSEEN or node.display == "none" or a.get("hidden", "").strip().lower() == "until-found":
        return False
    if node.tag == "input" and a.get("type", "").lower() == "hidden":
        return False
    return node.display is not None or not ("hidden" in a or node.tag == "dialog" and "open" not in a)


def _visible(node: Node, inherited: bool) -> bool:
    if node.visibility in (None, "inherit", "unset", "revert", "revert-layer"):
        return inherited
    return node.visibility in ("visible", "initial")


def remove_invisible(root: Node) -> None:
    """Take out what ``visibility`` hides, but not what is visible again inside; cells and list items keep their place."""
    order, work = [], [(root, True)]
    while work:
        node, inherited = work.pop()
        visible = _visible(node, inherited)
        order.append((node, visible))
        work += [(x, visible) for x in node.children if isinstance(x, Node)]
    empty = set()
    for node, visible in reversed(order):
        if node.visibility == "collapse" and node.tag in SECTIONS | {"tr"}:
            empty.add(node)
        children = [x for x in node.children if x not in empty] if empty else node.children
        if not visible:
            node.marked = False
            children = [x for x in children if isinstance(x, Node)]
            if not children and node.tag not in CELLS | {"li"}:
                empty.add(node)
        node.children = children


class Lines:
    """Lines of text under way: inline text runs on, blocks begin a line, margins meet in one blank line."""

    def __init__(self):
        self.done: list[str] = []
        self.line: list[str] = []
        self.ends_in_space = True
        self.blank = False
        self.indent, self.marker = "", ""

    def text(self, text: str) -> None:
        text = SPACE.sub(" ", text)
        if self.ends_in_space:
            text = text.lstrip(" ")
        if text:
            self._begin()
            self.line.append(text)
            self.ends_in_space = text.endswith(" ")

    def _begin(self) -> None:
        if not self.line:
            if self.blank and self.done:
                self.done.append("")
            self.blank = False
            self.line.append(self.indent[: len(self.indent) - len(self.marker)] + self.marker)
            self.marker = ""

    def end_line(self, kept: bool = False) -> None:
        """End the line if it has begun; with ``kept`` an empty line counts as well."""
        if kept:
            self._begin()
        if self.line:
            self.done.append("".join(self.line).rstrip(" "))
        self.line, self.ends_in_space = [], True

    def margin(self) -> None:
        self.end_line()
        self.blank = True

    def preformatted(self, text: str) -> None:
        first, *others = text.replace("\r\n", "\n").split("\n")
        self._put(first)
        for line in others:
            self.end_line(kept=True)
            self._put(line)

    def _put(self, text: str) -> None:
        if text:
            self._begin()
            self.line.append(text)
            self.ends_in_space = False


def _number(text: str | None, otherwise: int) -> int:
    text = (text or "").strip()
    return int(text) if re.fullmatch(r"[+-]?[0-9]{1,9}", text) else otherwise


ROMAN = [(1000, "M"), (900, "CM"), (500, "D"), (400, "CD"), (100, "C"), (90, "XC"), (50, "L"), (40, "XL"), (10, "X"), (9, "IX")]
ROMAN += [(5, "V"), (4, "IV"), (1, "I")]


def numeral(number: int, style: str) -> str:
    """A list item's number in the type of its list; numbers that a type can't show are decimal."""
    shown_as = ""
    if style in ("a", "A") and number > 0:
        while number:
            number, letter = divmod(number - 1, 26)
            shown_as = chr(65 + letter) + shown_as
    elif style in ("i", "I") and 0 < number < 4000:
        for value, letters in ROMAN:
            shown_as += letters * (number // value)
            number %= value
    else:
        return str(number)
    return shown_as.lower() if style.islower() else shown_as


def _span(cell: Node, name: str, most: int) -> int:
    value = cell.attributes.get(name, "1").strip()
    return min(max(int(value), 1), most) if value.isascii() and value.isdigit() and len(value) < 9 else 1


def _table_parts(table: Node) -> tuple[list[Node], list[list[Node]]]:
    """What stands outside of rows, and the cells of each row; head first, foot last."""
    outside, parts = [], {"thead": [], "tbody": [], "tfoot": []}

    def rows_of(children: list, rows: list) -> None:
        for child in children:
            if isinstance(child, str):
                if child.strip():
                    outside.append(child)
            elif not shown(child):
                continue
            elif child.tag == "tr":
                cells = []
                for x in child.children:
                    if isinstance(x, Node) and x.tag in CELLS:
                        if shown(x):
                            cells.append(x)
                    elif isinstance(x, Node) or x.strip():
                        outside.append(x)
                rows.append(cells)
            elif child.tag in CELLS:
                rows.append([child])
            elif child.tag not in ("colgroup", "col"):
                outside.append(child)

    for child in table.children:
        if isinstance(child, Node) and child.tag in SECTIONS:
            if shown(child):
                rows_of(child.children, parts[child.tag])
        else:
            rows_of([child], parts["tbody"])
    return outside, parts["thead"] + parts["tbody"] + parts["tfoot"]


def _table(rows: list[list[Node]], depth: int) -> list[str]:
    """The rows with every column as wide as its widest single cell."""
    placed: list[list[tuple[int, int, list[str]]]] = []
    free = [0] * MOST_COLUMNS  # the row from which on no cell above holds a column
    for number, cells in enumerate(rows):
        row, column = [], 0
        for cell in cells:
            while column < MOST_COLUMNS and free[column] > number:
                column += 1
            wide = min(_span(cell, "colspan", MOST_COLUMNS), max(MOST_COLUMNS - column, 1))
            high = _span(cell, "rowspan", MOST_ROWS)
            row.append((column, wide, render(cell, depth + 1)))
            if high > 1:
                free[column : column + wide] = [number + high] * min(wide, MOST_COLUMNS - column)
            column = min(column + wide, MOST_COLUMNS)
        placed.append(row)
    widths: dict[int, int] = {}
    for row in placed:
        for column, wide, lines in row:
            if wide == 1:
                widths[column] = max(widths.get(column, 0), *(min(len(x), PAD) for x in lines or [""]))
    lefts, left = {}, 0
    for column in range(max((c + w for row in placed for c, w, _ in row), default=0)):
        lefts[column] = left
        left += widths[column] + len(GAP) if widths.get(column) else 0
    padding = most = 0
    for row in placed:
        for column, _, lines in row:
            most += 10 + sum(len(x) - x.count(" ") for x in lines)
        padding += max((len(lines) for _, _, lines in row), default=0) * max((lefts[c] for c, _, _ in row), default=0)
    if padding > most * max(PADDING // (depth + 1), 1):
        lefts = dict.fromkeys(lefts, 0)
    result = []
    for row in placed:
        for i in range(max((len(lines) for _, _, lines in row), default=0)):
            line = ""
            for column, _, lines in row:
                if i < len(lines) and lines[i]:
                    line = (line + GAP if line and len(line) + len(GAP) > lefts[column] else line.ljust(lefts[column])) + lines[i]
            result.append(line)
    return result


def render(top: Node, depth: int = 0) -> list[str]:
    """The lines of an element's content."""
    out = Lines()
    lists: list[list] = []  # [ordered, number, step, type]
    preformatted: list[bool] = []
    work: list = [("into", top.children)]
    while work:
        step, item = work.pop()
        if step == "into":
            work += [("visit", child) for child in reversed(item)]
        elif step == "run":
            item()
        elif isinstance(item, str):
            out.preformatted(item) if preformatted else out.text(item)
        elif shown(item):
            tag, a = item.tag, item.attributes
            inside = item.children
            edge = out.margin if tag in SPACED and not (tag in LISTS and lists) else out.end_line
            if tag == "br":
                out.end_line(kept=True)
                continue
            if tag == "input":
                if a.get("type", "text").lower() not in ("checkbox", "radio", "file", "password", "image", "color", "range"):
                    out.text(" " + a.get("value", "") + " ")
                continue
            if tag == "select":
                options, labelled, look = [], [], list(reversed(inside))
                while look:
                    x = look.pop()
                    if isinstance(x, Node) and x.tag == "option":
                        options.append(x)
                        labelled.append(x)
                    elif isinstance(x, Node):
                        look += reversed(x.children)
                        labelled += [x.attributes["label"]] if x.tag == "optgroup" and "label" in x.attributes and shown(x) else []
                if "multiple" not in a and _span(item, "size", MOST_ROWS) == 1:
                    # A menu shows one option, a list all of them.
                    inside = [x for x in options if "selected" in x.attributes] or options[:1]
                else:
                    inside = labelled
                work.append(("into", [" ", *[y for x in inside for y in (x, " ")]]))
                continue
            if tag == "details" and "open" not in a:
                inside = [x for x in inside if isinstance(x, Node) and x.tag == "summary"][:1]
            if tag == "table":
                outside, rows = _table_parts(item)
                out.margin()
                if depth >= DEEPEST:
                    rows = [[cell] for cells in rows for cell in cells]
                    work += [("run", out.margin), *(("into", [*c[0].children, " "]) for c in reversed(rows)), ("into", outside)]
                    continue

                def lay_out(rows=rows):
                    out.end_line()
                    for line in _table(rows, depth):
                        out._put(line)
                        out.end_line(kept=True)
                    out.margin()

                work += [("run", lay_out), ("into", outside)]
                continue
            if tag in BLOCK:
                edge()
                work.append(("run", edge))
            if tag in LISTS:
                step = -1 if tag == "ol" and "reversed" in a else 1
                first = 1 if step > 0 else sum(isinstance(x, Node) and x.tag == "li" and shown(x) for x in inside)
                lists.append([tag == "ol", _number(a.get("start"), first), step, a.get("type", "1").strip()])
                work.append(("run", lists.pop))
            elif tag == "li":
                marker = "- "
                if lists and lists[-1][0]:
                    _, number, step, style = lists[-1]
                    number = _number(a.get("value"), number)
                    marker = f"{numeral(number, a.get('type', style).strip())}. "
                    lists[-1][1] = number + step
                if not item.marked:
                    marker = " " * len(marker)
                work.append(("run", lambda before=(out.indent, out.marker): _leave(out, *before)))
                out.indent, out.marker = (out.indent + " " * len(marker))[: max(MOST_INDENT, len(marker))], marker
            elif tag in ("dd", "blockquote"):
                work.append(("run", lambda before=(out.indent, out.marker): _leave(out, *before)))
                out.indent = (out.indent + ("    " if tag == "dd" else "  "))[:MOST_INDENT]
            elif tag in ("pre", "textarea", "xmp", "plaintext"):
                preformatted.append(True)
                work.append(("run", preformatted.pop))
                if inside and isinstance(inside[0], str) and inside[0].startswith("\n"):
                    inside = [inside[0][1:], *inside[1:]]
            elif tag == "svg text":
                inside = [" ", *inside, " "]
            work.append(("into", inside))
    out.end_line()
    return out.done


def _leave(out: Lines, indent: str, marker: str) -> None:
    out.end_line()
    out.indent, out.marker = indent, ""


def visible_text(html: str) -> str:
    page = build(html)
    if "visibility" in html.lower():
        remove_invisible(page)
    return "\n".join(render(page)) if shown(page) else ""


def with_visible_text(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """The pages with their visible text; a column of that name gives way."""

    def run(texts):
        return [pa.array([None if t is None else visible_text(t.decode()) for t in texts], pa.string())]

    return with_columns(pages, html, f"`{into}` string", run)


def page_texts(pages: DataFrame) -> DataFrame:
    rows = with_visible_text(pages.select("page_id", "html")).drop("html")
    return rows.select("page_id", "text", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("n_chars"))

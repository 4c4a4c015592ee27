"""First (or n-th) HTML table of a page -> positional rows of cell texts.

One page is one input row, so pages are parsed in parallel across tasks; a
page is parsed by the standard-library HTML parser inside a Python UDTF and
only the narrow ``(row_index, cells)`` rows leave the Python worker.

Row numbering follows a spreadsheet reader's frame: header rows (``<thead>``,
or leading rows made only of ``<th>``) are numbered -n..-1, body and footer
rows 0, 1, 2, ... in document order, skipping blank rows (no cell, or one
empty cell). ``rowspan``/``colspan`` cells are copied
into every grid slot they cover. Elements styled ``display:none`` are left out
with all they contain. Cell text has entities resolved and
whitespace runs collapsed to one blank. Tables nested inside a cell only
contribute their text to that cell.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

# Grid slots of one table beyond which its spans are taken for damage: an error, never a cut.
MAX_SLOTS = 5_000_000
# Elements without an end tag: they cannot hold the subtree of a hidden one.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_HIDDEN = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:!\s*important\s*)?(?:;|$)", re.IGNORECASE)
_SPACE = re.compile(r"\s+")
_SECTIONS = frozenset(("thead", "tbody", "tfoot"))
_STRUCTURE = _SECTIONS | {"tr", "td", "th"}
#: Elements that end tags of other elements inside them do not reach beyond.
_SCOPES = frozenset(("table", "td", "th", "caption"))
#: Start tags that end an open paragraph, and those that end an open element of their own kind.
_ENDS_P = frozenset(
    "address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr main menu nav ol p pre section summary table ul li dd dt".split()
)
_SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "optgroup")),
    "optgroup": (("option", "optgroup"), ("select",)),
}


class _Done(Exception):
    pass


def _span(value: str | None) -> int:
    """0 and junk count as 1."""
    m = re.match(r"\s*(\d+)", value or "")
    return max(int(m.group(1)), 1) if m else 1


class _TableReader(HTMLParser):
    """Collects raw rows ``(section, [(text, is_th, rowspan, colspan)])``."""

    def __init__(self, table_no: int):
        super().__init__(convert_charrefs=True)
        self.wanted = table_no
        self.top_tables = -1
        self.depth = 0
        self.inside = False
        self.section = "body"
        self.rows: list[tuple[str, list]] = []
        self.row: list | None = None
        self.cell: list | None = None
        self.open: list[str] = []  # elements without their end tag so far, from the outermost inwards
        # the page, then each open element of _SCOPES: its tag, and the elements open directly in it
        self.scopes: list[tuple[str, Counter]] = [("", Counter())]
        self.tables = 0  # open tables, hidden ones included
        self.hidden: int | None = None  # place in ``open`` of the outermost hidden element

    # -- open elements: where a ``display:none`` subtree ends ---------------
    def _push(self, tag):
        self.open.append(tag)
        self.scopes[-1][1][tag] += 1
        if tag in _SCOPES:
            self.scopes.append((tag, Counter()))
            self.tables += tag == "table"

    def _pop(self):
        tag = self.open.pop()
        if tag in _SCOPES:
            self.scopes.pop()
            self.tables -= tag == "table"
        self.scopes[-1][1][tag] -= 1
        if self.hidden is not None and self.hidden >= len(self.open):
            self.hidden = None

    def _pop_above(self, *tags):
        """End all that is open inside the innermost of ``tags``."""
        while self.open[-1] not in tags:
            self._pop()

    def _hide(self, tag, attrs) -> bool:
        """Whether the element lies in (or begins) a ``display:none`` subtree. Its start
        tag first ends what it closes by implication: a cell, row or section ends all
        that is open at the depth of its table, whatever lacks its end tag there."""
        held = self.scopes[-1][1]
        if tag in _STRUCTURE:
            if not self.tables:
                return self.hidden is not None
            self._pop_above("table", *(() if tag in _SECTIONS else _SECTIONS if tag == "tr" else (*_SECTIONS, "tr")))
        elif tag in _ENDS_P and held["p"] > 0:
            self._pop_above("p")
            self._pop()
        ends, within = _SIBLINGS.get(tag, ((), ()))
        while any(held[t] > 0 for t in ends):
            nearest = next(t for t in reversed(self.open) if t in ends or t in within)
            if nearest in within:
                break
            self._pop_above(nearest)
            self._pop()
        begins = self.hidden is None and _HIDDEN.search(dict(attrs).get("style") or "") is not None
        if tag not in _VOID:
            if begins:
                self.hidden = len(self.open)
            self._push(tag)
        return begins or self.hidden is not None

    def _close(self, tag) -> bool:
        """End the element with all left open inside it; whether it was visible."""
        scope, held = self.scopes[-1]
        if tag in ("td", "th"):
            found = scope if scope in ("td", "th") else None
        elif tag in _STRUCTURE or tag == "table":
            if not self.tables:
                return self.hidden is None
            self._pop_above("table", *(() if tag == "table" else _SECTIONS if tag in _SECTIONS else (*_SECTIONS, "tr")))
            found = tag if self.open[-1] == tag else None
        else:
            found = tag if held[tag] > 0 or tag == scope else None
        if found:
            self._pop_above(found)
        seen = self.hidden is None
        if found:
            self._pop()
        return seen

    # -- structure ---------------------------------------------------------
    def _end_cell(self):
        if self.cell is not None:
            parts, is_th, rs, cs = self.cell
            text = _SPACE.sub(" ", "".join(parts)).strip()
            self.row.append((text, is_th, rs, cs))
            self.cell = None

    def _end_row(self):
        self._end_cell()
        if self.row is not None:
            self.rows.append((self.section, self.row))
            self.row = None

    def handle_starttag(self, tag, attrs):
        if self._hide(tag, attrs):
            if self.hidden == len(self.open) - 1 and self.inside and self.depth == 1:  # what it closes, though unseen itself
                if tag in ("td", "th"):
                    self._end_cell()
                elif tag in ("tr", "thead", "tbody", "tfoot"):
                    self._end_row()
            return
        if tag == "table":
            self.depth += 1
            if self.depth == 1:
                self.top_tables += 1
                self.inside = self.top_tables == self.wanted
            return
        if not self.inside or self.depth != 1:
            return
        if tag in ("thead", "tbody", "tfoot"):
            self._end_row()
            self.section = {"thead": "head", "tbody": "body", "tfoot": "foot"}[tag]
        elif tag == "tr":
            self._end_row()
            self.row = []
        elif tag in ("td", "th"):
            self._end_cell()
            if self.row is None:
                self.row = []
            a = dict(attrs)
            self.cell = [[], tag == "th", _span(a.get("rowspan")), _span(a.get("colspan"))]

    def handle_endtag(self, tag):
        if not self._close(tag):
            return
        if tag == "table" and self.depth > 0:
            self.depth -= 1
            if self.depth == 0 and self.inside:
                self._end_row()
                raise _Done
            return
        if not self.inside or self.depth != 1:
            return
        if tag in ("td", "th"):
            self._end_cell()
        elif tag == "tr":
            self._end_row()
        elif tag in ("thead", "tbody", "tfoot"):
            self._end_row()
            self.section = "body"

    def handle_data(self, data):
        if self.inside and self.cell is not None and self.hidden is None:
            self.cell[0].append(data)


def _fill_grid(rows: list[list[tuple]]) -> list[list[str]]:
    """The HTML table model: every cell takes the first free slot of its row
    and fills ``rowspan`` x ``colspan`` slots, each with its text.

    ``below[r]`` maps columns of a later row to texts that reach down to it. A
    cell that would run into such a slot leaves it where it is in the order of
    the row: no text is dropped, a malformed row grows longer instead.
    """
    grid: list[list[str]] = []
    below: dict[int, list[tuple[int, str]]] = {}
    slots = r = 0
    while r < len(rows) or below:
        reaching = sorted(below.pop(r, []), key=lambda x: x[0])
        cells = rows[r] if r < len(rows) else []
        line: list[str] = []
        at = 0
        for text, _, rs, cs in cells:
            while at < len(reaching) and reaching[at][0] <= len(line):
                line.append(reaching[at][1])
                at += 1
            slots += rs * cs
            if slots > MAX_SLOTS:
                raise ValueError(f"the spans of one table fill more than {MAX_SLOTS} slots")
            first = len(line)
            line.extend([text] * cs)
            for down in range(r + 1, r + rs):
                below.setdefault(down, []).extend((first + i, text) for i in range(cs))
        line.extend(text for _, text in reaching[at:])
        grid.append(line)
        r += 1
    return grid


def _blank(cells: list[str]) -> bool:
    """A row a delimited-text reader skips as a blank line."""
    return len(cells) == 0 or (len(cells) == 1 and not cells[0].strip())


def table_rows(html: str | None, table_no: int = 0) -> list[tuple[int, list[str]]]:
    """``(row_index, cells)`` of the ``table_no``-th top-level table.

    Sections are laid out separately (spans do not cross from header to
    body or footer). Header rows are numbered -n..-1; body rows, then
    footer rows, 0, 1, 2, ...; body and footer rows with no cell or a single
    blank cell are skipped, as a reader skips blank lines.
    """
    if not html:
        return []
    reader = _TableReader(table_no)
    try:
        reader.feed(html)
        reader.close()
    except _Done:
        pass
    else:
        reader._end_row()
    raw = reader.rows
    head = [cells for section, cells in raw if section == "head"]
    body = [cells for section, cells in raw if section == "body"]
    foot = [cells for section, cells in raw if section == "foot"]
    if not head:  # no <thead>: leading all-<th> body rows are the header
        while body and all(is_th for _, is_th, _, _ in body[0]):
            head.append(body.pop(0))
    try:
        header = _fill_grid(head)
        data = [r for r in _fill_grid(body) + _fill_grid(foot) if not _blank(r)]
    except ValueError as exc:
        raise ValueError(f"{exc}; page begins with {html[:120]!r}") from None
    return [(i - len(header), cells) for i, cells in enumerate(header)] + list(enumerate(data))


@udtf(returnType="row_index int, cells array<string>", useArrow=True)
class HtmlTable:
    """SQL: ``SELECT ... FROM pages, LATERAL html_table(html, 0)``."""

    def eval(self, html: str, table_no: int = 0):
        yield from table_rows(html, 0 if table_no is None else int(table_no))


def html_table(pages: DataFrame, html_col: str = "html", table_no: int = 0) -> DataFrame:
    """Each page row -> its table rows; page columns (minus the HTML) kept."""
    out = pages.lateralJoin(HtmlTable(F.col(html_col).outer(), F.lit(table_no)))
    return out.drop(html_col)


def register(spark) -> None:
    spark.udtf.register("html_table", HtmlTable)


def decode_page(content, encoding: str = "auto"):
    """Page bytes -> text. ``auto``: valid UTF-8 is taken as is, anything
    else is read as ISO-8859-1 (pages saved by spreadsheet tools)."""
    c = F.col(content) if isinstance(content, str) else content
    if encoding != "auto":
        return F.decode(c, encoding)
    raw = c.cast("string")
    return F.when(F.is_valid_utf8(raw), raw).otherwise(F.decode(c, "ISO-8859-1"))


def read_pages(
    spark,
    path: str,
    encoding: str = "auto",
    glob: str = "*.htm*",
) -> DataFrame:
    """A folder of saved report pages -> ``(disease, year, path, html)``.

    Disease and year come from the path below ``path``, never from the folders
    above it: the disease name (``chikung`` stands for chikungunya) and the 20xx
    that follows it (``dengue/2021/dengue21_mes.htm`` or ``dengue_2021.htm`` ->
    dengue, 2021). Pages without a layout for their (disease, year), those
    without a label included, are listed by ``plans.layouts.pages_without_layout``.

    ``encoding``: the pages' byte encoding, or ``auto`` (see
    :func:`decode_page`); text saved already damaged is fixed by the repair
    map.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    p = F.col("path")
    # the folder's own name may be a link or lack its scheme: cut at its last part
    base = "/" + path.rstrip("/").rsplit("/", 1)[-1] + "/"
    if any(c in base for c in "*?{["):
        raise ValueError("read_pages takes one folder, not a pattern")
    root = F.lit(re.sub(r"^[a-z0-9+.-]+:/*", "/", path.rstrip("/"), flags=re.I) + "/")
    plain = F.regexp_replace(p, r"^(?i)[a-z0-9+.-]+:/*", "/")
    below = F.when(plain.startswith(root), F.substr(plain, F.length(root) + 1)).otherwise(F.substring_index(p, base, -1))
    name = F.lower(F.regexp_extract(below, r"(?i)(dengue|chikung(?:unya)?|zika)", 1))
    return files.select(
        F.when(name == "chikung", "chikungunya").otherwise(name).alias("disease"),
        F.regexp_extract(below, r"(?i)(?:dengue|chikung(?:unya)?|zika)\D*(20\d\d)", 1).try_cast("int").alias("year"),
        p,
        decode_page("content", encoding).alias("html"),
    )

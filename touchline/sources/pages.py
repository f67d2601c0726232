"""Stored web pages: links and tables."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.names import link_id, link_name

ANCHOR = r"(?i)<a\s[^>]*>"
HREF = r"""(?i)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
# Character references that occur in links.
REFERENCES = {"&quot;": '"', "&#39;": "'", "&lt;": "<", "&gt;": ">", "&amp;": "&"}


def _unescape(text: Column) -> Column:
    for reference, character in REFERENCES.items():
        text = F.replace(text, F.lit(reference), F.lit(character))
    return text


def page_links(pages: DataFrame, marker: str | None = None, html: str = "html", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Every anchor's target in page order as (.., position, href), those holding ``marker`` if given."""
    anchors = pages.select(*keep, F.posexplode(F.regexp_extract_all(html, F.lit(ANCHOR), 0)).alias("position", "_tag"))
    quoted = [F.regexp_extract("_tag", HREF, group) for group in (1, 2, 3)]
    links = anchors.where(F.col("_tag").rlike(HREF)).withColumn("href", _unescape(F.concat(*quoted))).drop("_tag")
    return links if marker is None else links.where(F.contains("href", F.lit(marker)))


def ids_from_links(links: DataFrame, href: str = "href") -> DataFrame:
    """Distinct (name, id) of the links with exactly five path parts."""
    found = links.select(link_name(F.col(href)).alias("name"), link_id(F.col(href)).alias("id"))
    return found.where(F.col("id").isNotNull()).distinct()


TABLE = re.compile(r"<table\b", re.IGNORECASE)
# Text, end tags, and start tags whose attributes are plain: what any HTML parser reads alike.
PLAIN = re.compile(
    r"""([^<]+)|</([a-zA-Z][a-zA-Z0-9]*)[ \t\n\r\f]*>"""
    r"""|<([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n\r\f]+[a-zA-Z][a-zA-Z0-9_-]*"""
    r"""(?:=(?:"[^"<>]*"|'[^'<>]*'|[a-zA-Z0-9_.%#-]+(?=[ \t\n\r\f>])))?)*)[ \t\n\r\f]*(/?)>"""
)
ATTRIBUTE = re.compile(r"""([a-zA-Z][a-zA-Z0-9_-]*)(?:=("[^"]*"|'[^']*'|[^ \t\n\r\f]+))?""")
# Elements whose content is not markup.
RAW_TEXT = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "noscript", "xmp", "plaintext"}


class _Table(HTMLParser):
    """Cells of the first table with a given id, spans over columns and rows written out.

    Header rows are those of ``thead`` and, before the first row of data, those
    of ``th`` cells only. Cells that reach below a ``thead`` end with it.
    """

    def __init__(self, table_id: str):
        super().__init__(convert_charrefs=True)
        self.table_id = table_id
        self.depth = 0
        self.done = False
        self.rows: list[tuple[bool, list[str]]] = []
        self.in_head = False
        self.row: list[tuple[str, int, int]] | None = None
        self.header_row = True
        self.cell: list[str] | None = None
        self.spans = (1, 1)
        # Cells that reach into later rows, by column: text and how many rows are left.
        self.hanging: dict[int, tuple[str, int]] = {}

    def feed_plain(self, html: str) -> bool:
        """Reads up to the end of the wanted table; False, with nothing to rely on, where the markup is not plain.

        The same handlers see the same tags and texts as with ``feed``, at a fraction of its time.
        """
        at = 0
        for found in PLAIN.finditer(html):
            if found.start() != at:
                return False
            at = found.end()
            text, end, start, attributes, closed = found.groups()
            if text is not None:
                if self.cell is not None:
                    self.handle_data(unescape(text))
            elif end is not None:
                self.handle_endtag(end.lower())
                if self.done:
                    return True
            else:
                tag, attrs = start.lower(), []
                if tag in RAW_TEXT:
                    return False
                if attributes and tag in ("table", "td", "th"):
                    if "&" in attributes:
                        return False
                    attrs = [(k.lower(), (v[1:-1] if v[0] in "\"'" else v) if v else None) for k, v in ATTRIBUTE.findall(attributes)]
                self.handle_starttag(tag, attrs)
                if closed:
                    self.handle_endtag(tag)
        return at == len(html)

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            if self.depth or (not self.done and dict(attrs).get("id") == self.table_id):
                self.depth += 1
            return
        if self.depth != 1:
            return
        if tag == "thead":
            self.in_head, self.hanging = True, {}
        elif tag == "tr":
            self._end_row()
            self.row, self.header_row = [], True
        elif tag in ("td", "th") and self.row is not None:
            self._end_cell()
            named = dict(attrs)
            self.cell = []
            self.spans = tuple(_span(named.get(name)) for name in ("colspan", "rowspan"))
            self.header_row = self.header_row and tag == "th"

    def handle_endtag(self, tag):
        if tag == "table" and self.depth:
            if self.depth == 1:
                self._end_row()
                self.done = True
            self.depth -= 1
        elif self.depth == 1:
            if tag in ("td", "th"):
                self._end_cell()
            elif tag == "tr":
                self._end_row()
            elif tag == "thead":
                self._end_row()
                self.in_head, self.hanging = False, {}

    def handle_data(self, data):
        if self.depth and self.cell is not None:
            self.cell.append(data)

    def _end_cell(self):
        if self.cell is not None:
            self.row.append((" ".join("".join(self.cell).split()), *self.spans))
            self.cell = None

    def _end_row(self):
        if self.row is None:
            return
        self._end_cell()
        cells: list[str] = []
        later: dict[int, tuple[str, int]] = {}
        own = iter(self.row)
        while True:
            if (hung := self.hanging.pop(len(cells), None)) is not None:
                text, columns, rows = hung[0], 1, hung[1]
            elif (cell := next(own, None)) is not None:
                text, columns, rows = cell
            elif self.hanging:
                # Beyond this row's own cells only hanging ones are left.
                text, columns, rows = "", min(self.hanging) - len(cells), 1
            else:
                break
            for _ in range(columns):
                if rows > 1:
                    later[len(cells)] = (text, rows - 1)
                cells.append(text)
        self.hanging = later
        if cells:
            before_data = all(is_header for is_header, _ in self.rows)
            self.rows.append((self.in_head or (self.header_row and bool(self.row) and before_data), cells))
        self.row = None


def _span(value: str | None) -> int:
    return max(int(value), 1) if value and value.strip().isdigit() else 1


def _flat_names(header: list[list[str]]) -> list[str]:
    """One name per column: the levels joined by a blank, blank upper levels left out."""
    width = max(map(len, header))
    padded = [row + [""] * (width - len(row)) for row in header]
    return [" ".join(part for part in column if part).strip() for column in zip(*padded)]


def column_name(header: str) -> str:
    """Header text as a column name: ``A B`` becomes ``A_B``."""
    return header.replace("%", "_percent").replace("-", "_").replace(" ", "_")


def read_table(html: str, table_id: str) -> list[dict[str, str]]:
    """Rows of one page's table as ``{column: text}``; no rows when the page lacks it."""
    start = TABLE.search(html)
    if start is None or table_id not in html:
        return []
    parser = _Table(table_id)
    if not parser.feed_plain(html[start.start() :]):
        parser = _Table(table_id)
        parser.feed(html[start.start() :])
        parser.close()
    header = [cells for is_header, cells in parser.rows if is_header]
    if not header:
        return []
    names = [column_name(n) for n in _flat_names(header)]
    return [dict(zip(names, cells)) for is_header, cells in parser.rows if not is_header]


def page_tables(
    pages: DataFrame, table_id: str, columns: list[str], html: str = "html", keep: tuple[str, ...] = ("page_id",)
) -> DataFrame:
    """Rows of the table with ``table_id`` in every page, wanted columns as text, empty cells NULL.

    Spark has no HTML reader, so pages are parsed in Arrow batches; pages without the id are not sent there.
    """
    kept = [f for f in pages.schema.fields if f.name in keep]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["`row` int"] + [f"`{c}` string" for c in columns])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for *values, page in batch.itertuples(index=False, name=None):
                if page is None:
                    continue
                for number, cells in enumerate(read_table(page, table_id)):
                    out.append([*values, number, *[cells.get(c) or None for c in columns]])
            yield pd.DataFrame(out, columns=[k.name for k in kept] + ["row"] + columns)

    holding = pages.where(F.contains(html, F.lit(table_id)))
    return holding.select(*[f.name for f in kept], html).mapInPandas(parse, schema)


def competition_rows(tables: DataFrame, competition: str, name: Column, column: str = "Comp") -> DataFrame:
    """Rows of one competition, tagged with the person's name."""
    return tables.where(F.col(column) == competition).withColumn("name", name)

"""R3: the first ``<table>`` of each HTML page, as long-form cells.

Input is a pages dataset ``(page_id, html)``; output one row per cell
``(page_id, row_no, col_no, header, cell)``.  Spark has no HTML parser, so the
parse is a Python UDTF (Arrow batches in and out) called through a lateral
join: pages stay where the scan put them, each task parses its own pages, and
nothing passes through the driver.  A cheap JVM-side test drops pages that
cannot hold a table before any row reaches Python.

Table rules (those of the usual read-the-first-HTML-table call):
  * first table in document order with text in a cell (an empty one is passed
    over); end tags that HTML lets out are supplied; a table nested in a cell only adds text;
  * header = the ``<thead>`` rows, otherwise the leading rows made only of
    ``<th>``; ``<tfoot>`` rows follow the body;
  * ``colspan``/``rowspan`` copy the text into every covered slot;
  * elements styled ``display:none`` are left out;
  * cell text is stripped with whitespace runs collapsed; '' becomes null;
    short rows are padded with null cells to the table width; a row with no
    cells at all is dropped;
  * ``header`` is the header rows' texts for that column joined by " / "
    (null when the table has no header text there).
Cells stay text; callers cast.  A page without a table yields no rows.
"""

from __future__ import annotations

import re
import sys
from html.parser import HTMLParser

from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import udtf

# The parser runs in Python workers.  Pickling this module's code by value
# ships it with the task, so workers need no copy of this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
         "param", "source", "track", "wbr"}
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)
_WS = re.compile(r"\s+")


_SECTIONS = ("thead", "tbody", "tfoot")
_MAX_ROWSPAN, _MAX_COLSPAN = 65534, 1000      # limits of the HTML table model
# start tag -> open elements it ends when their own end tag was left out
_ENDS = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "li": ("li",),
         "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), **{s: _SECTIONS for s in _SECTIONS}}
_ENDS_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3",
           "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
# where the search for an element to end stops
_FENCE = {"td": ("tr", "table"), "th": ("tr", "table"), "tr": ("table",), "li": ("ul", "ol", "table"),
          "dt": ("dl", "table"), "dd": ("dl", "table"), "option": ("select", "table"), **{s: ("table",) for s in _SECTIONS}}


class _FirstTable(HTMLParser):
    """Follows the open elements on a stack; collects the first table that has text in a cell."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = []         # open elements: (tag, hidden)
        self.level = 0          # tables among them
        self.done = False
        self._reset_table()

    def _reset_table(self):
        self.section, self.rows, self.row, self.cell = "tbody", [], None, None

    @staticmethod
    def _span(attrs, name, most):
        try:
            return min(max(1, int(dict(attrs).get(name) or 1)), most)
        except (TypeError, ValueError):
            return 1

    def _hidden(self):
        return bool(self.stack) and self.stack[-1][1]

    def _end_cell(self):
        if self.cell is not None:
            is_th, parts, rowspan, colspan = self.cell
            self.row.append((is_th, _WS.sub(" ", "".join(parts).strip()), rowspan, colspan))
        self.cell = None

    def _end_row(self):
        self._end_cell()
        if self.row is not None:
            self.rows.append((self.section, self.row))
        self.row = None

    def _pop(self):
        tag, _ = self.stack.pop()
        if self.level == 1:
            if tag in ("td", "th"):
                self._end_cell()
            elif tag == "tr":
                self._end_row()
            elif tag in _SECTIONS:
                self._end_row()
                self.section = "tbody"
            elif tag == "table":
                self._end_row()
                self.done = any(c[1] for _, row in self.rows for c in row)
                if not self.done:
                    self._reset_table()
        if tag == "table":
            self.level -= 1

    def _end_open(self, tags, fence):
        """Ends the nearest open element of ``tags`` this side of ``fence``, and all within it."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in tags:
                while len(self.stack) > i and not self.done:
                    self._pop()
                return
            if self.stack[i][0] in fence:
                return

    def handle_starttag(self, tag, attrs):
        if self.done:
            return
        if tag in _ENDS:
            self._end_open(_ENDS[tag], _FENCE[tag])
        elif tag in _ENDS_P:
            self._end_open(("p",), ("td", "th", "table", "button"))
        if tag in _VOID:
            return
        hidden = self._hidden() or bool(_HIDDEN.search(dict(attrs).get("style") or ""))
        self.stack.append((tag, hidden))
        if tag == "table":
            self.level += 1
        elif self.level == 1 and not hidden:
            if tag in _SECTIONS:
                self._end_row()
                self.section = tag
            elif tag == "tr":
                self._end_row()
                self.row = []
            elif tag in ("td", "th"):
                self._end_cell()
                self.row = [] if self.row is None else self.row
                self.cell = [tag == "th", [], self._span(attrs, "rowspan", _MAX_ROWSPAN),
                             self._span(attrs, "colspan", _MAX_COLSPAN)]

    def handle_endtag(self, tag):
        if not self.done and tag not in _VOID:
            self._end_open((tag,), () if tag == "table" else ("table",))

    def handle_data(self, data):
        if not self.done and self.cell is not None and not self._hidden():
            self.cell[1].append(data)

    def close(self):
        super().close()
        while self.stack and not self.done:      # whatever is open ends with the page
            self._pop()


def _runs(rows, extra: bool = True):
    """Rows of (is_th, text, rowspan, colspan) as the table model lays them out, one by one: each cell goes to the first free
    slot of its row and fills its rectangle.  A row is a list of runs (first slot, slot after the last, text).

    What is held is one entry for each run of slots that cells of earlier rows still reach into, with the rows those end at;
    of several cells over one slot the earliest shows until its rows end.  ``extra`` also gives the rows
    that only spans reach.
    """
    open_runs, rows, n = [], iter(rows), 0                  # [first, stop, [(row after the last, text), ...]]
    while True:
        row = next(rows, None)
        open_runs = [[first, stop, live] for first, stop, cells in open_runs if (live := [c for c in cells if c[0] > n])]
        if row is None and not (extra and open_runs):
            return
        at = 0                                              # runs before this one are taken without a gap
        col = 0
        for _, text, rowspan, colspan in row or ():
            while at < len(open_runs) and open_runs[at][0] <= col:
                col = max(col, open_runs[at][1])
                at += 1
            stop, end, i = col + colspan, n + rowspan, at
            first = col
            while first < stop:
                if i == len(open_runs) or open_runs[i][0] >= stop:       # free to the end
                    open_runs.insert(i, [first, stop, [(end, text)]])
                    first = stop
                elif open_runs[i][0] > first:                            # free up to the next run
                    open_runs.insert(i, [first, open_runs[i][0], [(end, text)]])
                    first = open_runs[i][1]
                else:                                                    # taken: shows once what is there ends
                    run = open_runs[i]
                    if run[1] > stop:
                        open_runs.insert(i + 1, [stop, run[1], list(run[2])])
                        run[1] = stop
                    if end > run[2][-1][0]:
                        run[2].append((end, text))
                    first = run[1]
                i += 1
        yield [(first, stop, cells[0][1]) for first, stop, cells in open_runs]
        n += 1


def _header_runs(head) -> list[tuple[int, int, tuple]]:
    """(first slot, slot after the last, texts from top to bottom): equal texts that follow each other count once."""
    out, last = [], None
    for row in _runs(head):
        if row == last:                                     # only spans from above: nothing new
            continue
        last = row
        edges = sorted({e for first, stop, _ in (*out, *row) for e in (first, stop)})
        merged, i, j = [], 0, 0
        for first, stop in zip(edges, edges[1:]):
            while i < len(out) and out[i][1] <= first:
                i += 1
            while j < len(row) and row[j][1] <= first:
                j += 1
            parts = out[i][2] if i < len(out) and out[i][0] <= first else ()
            text = row[j][2] if j < len(row) and row[j][0] <= first else ""
            merged.append((first, stop, parts if not text or parts[-1:] == (text,) else (*parts, text)))
        out = merged
    return out


def _slots(runs, width: int):
    """The texts of ``width`` slots, null where no run is."""
    at = 0
    for first, stop, text in runs:
        yield from (None for _ in range(at, first))
        yield from (text for _ in range(first, stop))
        at = stop
    yield from (None for _ in range(at, width))


def iterate_first_table(html: str | None):
    """``(row_no, col_no, header, cell)`` tuples of the page's first table, one by one: what is held grows with the
    page, not with the slots its spans cover."""
    if not html or "<table" not in html.lower():
        return
    p = _FirstTable()
    p.feed(html)
    p.close()
    if not p.done:
        return
    head = [r for s, r in p.rows if s == "thead"]
    body = [r for s, r in p.rows if s == "tbody"]
    foot = [r for s, r in p.rows if s == "tfoot"]
    if not head:
        ths = 0
        while ths < len(body) and body[ths] and all(c[0] for c in body[ths]):
            ths += 1
        head, body = body[:ths], body[ths:]
    # rows that only spans reach are no wider than those above
    width = max((row[-1][1] for part in (head, body, foot) for row in _runs(part, extra=False) if row), default=0)
    headers = [(first, stop, " / ".join(parts) or None) for first, stop, parts in _header_runs(head)]
    row_no = 0
    for part in (body, foot):
        for row in _runs(part):
            if row:                                         # a row without cells is blank
                for c, (header, text) in enumerate(zip(_slots(headers, width), _slots(row, width))):
                    yield row_no, c, header, text or None
                row_no += 1


def first_table_cells(html: str | None) -> list[tuple]:
    return list(iterate_first_table(html))


@udtf(returnType="row_no int, col_no int, header string, cell string", useArrow=True)
class FirstHtmlTable:
    def eval(self, html: str | None):
        yield from iterate_first_table(html)


def html_first_table(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``(page_id, row_no, col_no, header, cell)`` for the first table of every page."""
    candidates = pages.select(id_col, html_col).filter(F.lower(F.col(html_col)).contains("<table"))
    cells = candidates.lateralJoin(FirstHtmlTable(F.col(html_col).outer()))
    return cells.select(id_col, "row_no", "col_no", "header", "cell")


def cells_to_wide(cells: DataFrame, headers: list[str], id_col: str = "page_id") -> DataFrame:
    """Long-form cells -> one row per (page, table row), one column per table column.

    ``headers`` names the columns in order; column i holds the cells at place i, so columns with
    equal or no headers stay apart.  Equal names get a number (``name``, ``name_2``), an empty one is
    called ``column_<place>``.  Every group holds one table row's cells.  Cells beyond the last named
    column are kept in ``more``, joined by " | " in order of place (null where there are none).
    """
    names: list[str] = []
    for i, h in enumerate(headers):
        name, n = h or f"column_{i}", 2
        while name in names:
            name, n = f"{h or 'column'}_{n}", n + 1
        names.append(name)
    place = [F.max(F.when(F.col("col_no") == i, F.col("cell"))).alias(n) for i, n in enumerate(names)]
    more = F.sort_array(F.collect_list(F.when(F.col("col_no") >= len(names), F.struct("col_no", "cell"))))["cell"]
    text = F.when(F.size(more) > 0, F.array_join(more, " | ", ""))
    return cells.groupBy(id_col, "row_no").agg(*place, text.alias("more"))


def _numbered(headers):
    """(header, how many of the same came before) of an array of headers in order of place."""
    return F.transform(headers, lambda h, i: F.struct(
        F.coalesce(h, F.lit("")).alias("header"), F.size(F.filter(F.slice(headers, 1, i), lambda x: x.eqNullSafe(h))).alias("nth")))


def discover_columns(cells: DataFrame, id_col: str = "page_id", max_columns: int = 1000) -> list[tuple[str, int]]:
    """The columns that the tables themselves name, in order of place: (header, how many of the same come before it).

    One pass over the header of every page (its first row carries all of it).  Equal headers of different pages
    are one column, whatever their place; equal headers of one page are as many columns; a place without a header is the
    column ''.  Of more than ``max_columns`` those of most pages are named; the cells of the others are not lost (``more``).
    At most that many names come to the driver.
    """
    keys = [id_col] + (["DT"] if "DT" in cells.columns else [])
    page = cells.filter("row_no = 0").groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("col_no", "header")))["header"].alias("headers"))
    found = (page.select(F.posexplode(_numbered(F.col("headers"))).alias("place", "c")).groupBy("c.header", "c.nth")
             .agg(F.count("*").alias("pages"), F.min("place").alias("place")))
    rows = found.orderBy(F.desc("pages"), "place", "header", "nth").limit(max_columns).collect()
    return [(r["header"], r["nth"]) for r in sorted(rows, key=lambda r: (r["place"], r["header"], r["nth"]))]


def column_names(columns: list[tuple[str, int]], taken: list[str]) -> list[str]:
    """A name for each column: its header, with a number where that is taken (``name``, ``name_2``), ``column`` without one."""
    used, out = {t.lower() for t in taken}, []
    for header, _ in columns:
        name, n = header or "column", 2
        while name.lower() in used:
            name, n = f"{header or 'column'}_{n}", n + 1
        used.add(name.lower())
        out.append(name)
    return out


def cells_by_header(cells: DataFrame, columns: list[tuple[str, int]], id_col: str = "page_id") -> DataFrame:
    """Long-form cells -> one row per (page, table row), one column per discovered column.

    A cell goes to the column of its header, so pages whose columns stand in another order line up.  Cells of columns that
    are not among ``columns`` are kept in ``more``, joined by " | " in order of place (null where there are none).
    A column ``DT``, if there is one, is kept.
    """
    keys = [id_col, "row_no"] + (["DT"] if "DT" in cells.columns else [])
    row = cells.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("col_no", "header", "cell"))).alias("cells"))
    row = row.select(*keys, F.arrays_zip(_numbered(F.col("cells.header")).alias("c"), F.col("cells.cell").alias("cell")).alias("cells"))
    row = row.withColumn("by", F.map_from_entries(F.transform("cells", lambda x: F.struct(
        F.struct(x["c"]["header"].alias("header"), x["c"]["nth"].alias("nth")).alias("key"), x["cell"].alias("cell")))))
    names = column_names(columns, [*keys, "more"])
    known = F.array(*[F.struct(F.lit(h).alias("header"), F.lit(n).alias("nth")) for h, n in columns])
    rest = F.filter("cells", lambda x: ~F.array_contains(known, x["c"])) if columns else F.col("cells")
    more = F.when(F.size(rest) > 0, F.array_join(F.transform(rest, lambda x: x["cell"]), " | ", ""))
    key = [F.struct(F.lit(h).alias("header"), F.lit(n).alias("nth")) for h, n in columns]
    return row.select(id_col, "row_no", *[F.col("by")[k].alias(n) for k, n in zip(key, names)], more.alias("more"),
                      *keys[2:])


def pages_without_table(pages: DataFrame, cells: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Pages that yielded no cells (no table with text): ``(page_id, url)`` where present.

    An anti-join on the page id against the distinct ids of the cells (the
    distinct is a partial aggregate, so a page with a huge table is reduced
    map-side).  Pass the cells as read back from where they were written, so the
    parse does not run a second time.
    """
    keep = [c for c in (id_col, "url") if c in pages.columns]
    seen = cells.select(id_col).distinct()
    return pages.select(*keep).join(seen, id_col, "left_anti")

"""HTML to text and to table cells with the standard library's parser, in Arrow batches."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tags that break lines, and tags whose text is not shown.
BLOCKS = frozenset(
    (
        "p", "div", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "blockquote", "pre",
        "tr", "thead", "tbody", "tfoot", "caption", "center", "table", "br",
    )
)
SKIPPED = frozenset(("script", "style", "noscript"))
CELL = T.StructType([T.StructField("t", T.StringType()), T.StructField("rs", T.IntegerType()), T.StructField("cs", T.IntegerType()), T.StructField("h", T.BooleanType())])


def render(html: str | None) -> tuple[str, list]:
    """(text, tables): inline tags join, blocks break lines, cells of a row join with ` | `.

    tables: for each table its rows of (text, rowspan, colspan, header) cells.
    """
    import re
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.skip, self.tables, self.open = [], 0, [], []

        def handle_starttag(self, tag, attrs):
            if tag in SKIPPED:
                self.skip += 1
            elif tag == "table":
                self.open.append([])
                self.tables.append(self.open[-1])
            elif tag == "tr" and self.open:
                self.open[-1].append([])
            elif tag in ("td", "th") and self.open:
                if not self.open[-1]:
                    self.open[-1].append([])
                if self.open[-1][-1]:
                    self.out.append(" | ")
                span = dict(attrs)
                number = lambda name: int(span[name]) if (span.get(name) or "").isdigit() and int(span[name]) else 1
                self.open[-1][-1].append([len(self.out), number("rowspan"), number("colspan"), tag == "th"])
            if tag in BLOCKS:
                self.out.append("\n")

        def handle_startendtag(self, tag, attrs):
            if tag in BLOCKS:
                self.out.append("\n")

        def handle_endtag(self, tag):
            if tag in SKIPPED:
                self.skip = max(0, self.skip - 1)
            elif tag in ("td", "th") and self.open and self.open[-1] and self.open[-1][-1]:
                cell = self.open[-1][-1][-1]
                if isinstance(cell[0], int):
                    cell[0] = re.sub(r"\s+", " ", "".join(self.out[cell[0] :])).strip()
            elif tag == "table" and self.open:
                self.open.pop()
            if tag in BLOCKS:
                self.out.append("\n")

        def handle_data(self, data):
            if not self.skip:
                self.out.append(re.sub(r"[ \t\r\n\f]+", " ", data))

    reader = Reader()
    reader.feed(html or "")
    reader.close()
    lines = [re.sub(r"[ \t]+", " ", line).strip() for line in "".join(reader.out).split("\n")]
    cells = [[[(c[0] if isinstance(c[0], str) else "", *c[1:]) for c in row] for row in table] for table in reader.tables]
    return "\n".join(line for line in lines if line), cells


@F.pandas_udf(T.StringType())
def to_text(html):
    return html.map(lambda x: render(x)[0])


@F.pandas_udf(T.ArrayType(T.ArrayType(T.ArrayType(CELL))))
def to_tables(html):
    return html.map(lambda x: [[[{"t": t, "rs": rs, "cs": cs, "h": h} for t, rs, cs, h in row] for row in table] for table in render(x)[1]])

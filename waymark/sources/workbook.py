"""Workbooks of one sheet, written by tasks: the rows' markup is made where the rows are, and packed by one task.

A sheet has at most ROWS rows by its format, so one packed sheet has a bound. Its rows are numbered over range
partitions; each partition makes the markup of its rows; one task reads them in order, compresses them as a stream and
gives the file back in pieces of a MB, which go through the driver one at a time into the file system.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.operators.records import numbered

#: What a sheet holds at most, with its header; characters of a cell.
ROWS, COLUMNS, CELL = 1_048_576, 16_384, 32_767
PIECE = 1 << 20
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_KIND = "application/vnd.openxmlformats-officedocument.spreadsheetml"
HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'


def _parts(sheet: str) -> dict[str, str]:
    """The files around a sheet."""
    return {
        "[Content_Types].xml": f'{HEAD}<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{_KIND}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{_KIND}.worksheet+xml"/></Types>',
        "_rels/.rels": f'{HEAD}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'{HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets><sheet name="{escape(sheet, {chr(34): "&quot;"})}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'{HEAD}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_REL}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
    }


def letters(column: int) -> str:
    """A, B, ..., Z, AA, ... of a column counted from 0."""
    out = ""
    column += 1
    while column:
        column, at = divmod(column - 1, 26)
        out = chr(65 + at) + out
    return out


def _text(c: Column) -> Column:
    """Text as markup: without characters that XML does not have, cut to what a cell holds."""
    for bad, good in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(bad), F.lit(good))
    return c


def _clean(c: Column) -> Column:
    return F.substring(F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F￾￿]", ""), 1, CELL)


def cell(c: Column, kind: T.DataType, column: int, row: Column) -> Column:
    """Markup of one value; '' for null. Numbers and booleans stay what they are, all else is text, lists and structs as JSON."""
    at = F.concat(F.lit(f'<c r="{letters(column)}'), row.cast("string"), F.lit('"'))
    if isinstance(kind, T.BooleanType):
        shown = F.concat(at, F.lit(' t="b"><v>'), c.cast("int").cast("string"), F.lit("</v></c>"))
    elif isinstance(kind, T.NumericType):
        double = isinstance(kind, T.FloatType | T.DoubleType)
        known = ~F.isnan(c) & (F.abs(c) != float("inf")) if double else F.lit(True)
        text = F.concat(at, F.lit(' t="inlineStr"><is><t>'), c.cast("string"), F.lit("</t></is></c>"))
        shown = F.when(known, F.concat(at, F.lit("><v>"), c.cast("string"), F.lit("</v></c>"))).otherwise(text)
    else:
        value = F.to_json(c) if isinstance(kind, T.ArrayType | T.MapType | T.StructType) else c.cast("string")
        shown = F.concat(at, F.lit(' t="inlineStr"><is><t xml:space="preserve">'), _text(_clean(value)), F.lit("</t></is></c>"))
    return F.coalesce(shown, F.lit(""))


def write_workbook(df: DataFrame, path: str, order: list[Column] | None = None, sheet: str = "Sheet1") -> None:
    """Write a table as a workbook file, header first, in ``order`` (unique; by default in the order of the table's partitions).

    A table with more rows or columns than a sheet holds is an error, not a cut; texts longer than a cell holds are cut, as
    the format demands. A file that is there already is an error.
    """
    n = df.count()
    if n >= ROWS or len(df.columns) > COLUMNS:
        raise ValueError(f"{n} rows of {len(df.columns)} columns do not fit into a sheet")
    keyed = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)], *[o.alias(f"o{i}") for i, o in enumerate(order or [F.monotonically_increasing_id()])])
    rows = numbered(keyed, [F.col(c) for c in keyed.columns if c.startswith("o")], "row")
    number = F.col("row") + 1
    cells = [cell(F.col(f"c{i}"), f.dataType, i, number) for i, f in enumerate(df.schema)]
    markup = rows.select("row", F.concat(F.lit('<row r="'), number.cast("string"), F.lit('">'), *cells, F.lit("</row>")).alias("xml"))
    header = "".join(f'<c r="{letters(i)}1" t="inlineStr"><is><t xml:space="preserve">{escape(c)}</t></is></c>' for i, c in enumerate(df.columns))
    # The header is a row like others, so that there is one in any case.
    markup = markup.unionByName(df.sparkSession.range(1).select(F.lit(0).cast("long").alias("row"), F.lit(f'<row r="1">{header}</row>').alias("xml")))
    parts = _parts(sheet)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The file in pieces; nothing but a piece is held."""
        out = _Pieces()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as file:
            for name, text in parts.items():
                file.writestr(name, text)
            with file.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as stream:
                stream.write(f'{HEAD}<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
                for batch in batches:
                    for xml in batch.column(0).to_pylist():
                        stream.write(xml.encode())
                    yield from out.taken(PIECE)
                stream.write(b"</sheetData></worksheet>")
        yield from out.taken(1)

    pieces = markup.repartition(1).sortWithinPartitions("row").select("xml").mapInArrow(packed, "piece binary")
    spark: SparkSession = df.sparkSession
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    file = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place, False)
    for r in pieces.toLocalIterator():
        file.write(r["piece"])
    file.close()


def sheet_markup(content: Column) -> Column:
    """The markup of the first sheet of a workbook's bytes."""

    def run(files: pa.Array) -> pa.Array:
        out = []
        for data in files.to_pylist():
            with zipfile.ZipFile(io.BytesIO(data)) as file:
                out.append(file.read("xl/worksheets/sheet1.xml").decode())
        return pa.array(out, pa.string())

    return F.arrow_udf(run, "string")(content)


class _Pieces(io.RawIOBase):
    """A file that is only written on, and whose beginning can be taken away."""

    def __init__(self):
        self.held, self.size = bytearray(), 0

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.held += data
        self.size += len(data)
        return len(data)

    def tell(self) -> int:
        return self.size

    def taken(self, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.held) >= least:
            piece, self.held = bytes(self.held), bytearray()
            yield pa.RecordBatch.from_pydict({"piece": [piece[i : i + PIECE] for i in range(0, len(piece), PIECE)]})

"""Spark data source for tables that start some rows below the top of a sheet.

Reads CSV exports and ``.xlsx`` workbooks, keeps only the named columns, leaves every field
as text, and adds ``_row`` (grows with the position in the file), ``_source`` (file) and
``_sheet``. CSV files are cut into byte ranges that load in parallel; a workbook gives one
partition per sheet, whose size the format itself limits to 1,048,576 rows.
"""

from __future__ import annotations

import fnmatch
import json
import posixpath
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.csv as pacsv
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "offset_sheet"
XLSX_BATCH_ROWS = 20_000
#: What a task holds of its range of a CSV export at a time; only memory depends on it.
BLOCK_BYTES = 1 << 20
SHEET_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL_NS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"file:/(?!/)", path):
        path = "file://" + path[len("file:"):]
    if "://" in path:
        return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))
    return pafs.LocalFileSystem(), path


def list_files(paths: list[str]) -> list[tuple[str, int]]:
    """(path, size) of the files named directly, by folder or by a pattern on the last part."""
    found = []
    for path in paths:
        fs, inner = open_fs(path)
        prefix = path[: len(path) - len(inner)]
        if any(ch in inner for ch in "*?["):
            inner, pattern = posixpath.split(inner)
        else:
            pattern = "*"
        info = fs.get_file_info(inner)
        if info.type == pafs.FileType.File:
            entries = [info]
        elif info.type == pafs.FileType.Directory:
            entries = [
                e
                for e in fs.get_file_info(pafs.FileSelector(inner))
                if e.type == pafs.FileType.File
                and not e.base_name.startswith(("_", "."))
                and fnmatch.fnmatch(e.base_name, pattern)
            ]
        else:
            entries = []
        if not entries and pattern != "*" or info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(path)
        found += [(prefix + e.path, e.size) for e in sorted(entries, key=lambda e: e.path)]
    return found


def _check_lines(data: bytes, path: str) -> None:
    """Every line holds an even number of quotes, so none ends within a field.

    The first line of a record with a line break in a field never does; the check finds it in
    whichever range it starts, so the outcome is the same however the file is cut.
    """
    text = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(text == 34)
    ends = np.append(np.flatnonzero(text == 10), len(text))
    if (np.searchsorted(quotes, ends) % 2).any():
        raise ValueError(f"{path}: a line ends within quotes; read it with multiline='true'")


class Part(InputPartition):
    def __init__(self, path: str, start: int, end: int, sheet: str | None):
        super().__init__((path, start, end, sheet))
        self.path, self.start, self.end, self.sheet = path, start, end, sheet


class OffsetSheetSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema):
        return OffsetSheetReader(dict(self.options), schema.fieldNames())


class OffsetSheetReader(DataSourceReader):
    def __init__(self, options: dict, names: list[str]):
        self.paths = json.loads(options["paths"])
        self.sheets = json.loads(options.get("sheets", "null"))
        self.skip = int(options.get("skiprows", "0"))
        self.separator = options.get("sep", ",")
        # the sheet a CSV export holds: what the pattern's group finds in the file's name
        self.sheet_pattern = re.compile(options.get("sheetpattern", r"^(.*)$"))
        self.multiline = options.get("multiline", "false") == "true"
        self.split_bytes = int(options.get("splitbytes", str(64 << 20)))
        self.names = [n for n in names if n not in ("_row", "_source", "_sheet")]
        self.schema = pa.schema(
            [(n, pa.int64() if n == "_row" else pa.string()) for n in names]
        )

    def partitions(self):
        parts, exported, workbooks = [], set(), False
        for path, size in list_files(self.paths):
            if path.lower().endswith(".xlsx"):
                sheets, workbooks = self.sheets or [None], True
                parts += [Part(path, 0, size, sheet) for sheet in sheets]
            elif path.lower().endswith(".xls"):
                raise ValueError(f"{path}: export binary .xls files to .xlsx, CSV or Parquet")
            else:
                sheet = self._exported_sheet(path)
                if self.sheets is not None and sheet not in self.sheets:
                    continue
                exported.add(sheet)
                step = max(size, 1) if self.multiline else self.split_bytes
                starts = range(0, size, step)
                parts += [Part(path, s, min(s + step, size), sheet) for s in starts]
        missing = sorted(set(self.sheets or []) - exported)
        if missing and not workbooks:
            raise ValueError(f"{self.paths} has no sheet {missing[0]}")
        return parts or [Part("", 0, 0, None)]

    def _exported_sheet(self, path: str) -> str | None:
        """The sheet of a CSV export where sheets are asked for by name."""
        if self.sheets is None:
            return None
        found = self.sheet_pattern.search(posixpath.splitext(posixpath.basename(path))[0])
        return found[1] if found else None

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        blocks = self._workbook(part) if part.path.lower().endswith(".xlsx") else self._csv(part)
        for first_row, columns in blocks:
            count = len(next(iter(columns.values())))
            extra = {
                "_row": pa.array(np.arange(first_row, first_row + count, dtype=np.int64)),
                "_source": pa.repeat(pa.scalar(part.path, pa.string()), count),
                "_sheet": pa.repeat(pa.scalar(part.sheet, pa.string()), count),
            }
            data = {**columns, **extra}
            yield pa.RecordBatch.from_arrays(
                [data[f.name] for f in self.schema], schema=self.schema
            )

    def _check(self, header: list[str], path: str) -> None:
        missing = [n for n in self.names if n not in header]
        if missing:
            raise ValueError(f"{path} lacks the columns {missing}")

    # --- CSV ---------------------------------------------------------------------------
    def _header(self, f, path: str) -> tuple[int, list[str]]:
        """Byte position of the first data row and the column names."""
        lines = []
        for _ in range(self.skip):
            _read_line(f)
        while True:
            line = _read_line(f)
            lines.append(line)
            # a quoted name may hold line breaks
            if not line or b"".join(lines).count(b'"') % 2 == 0:
                break
        text = b"".join(lines).removeprefix(b"\xef\xbb\xbf")
        table = pacsv.read_csv(
            pa.BufferReader(text),
            parse_options=pacsv.ParseOptions(
                delimiter=self.separator, newlines_in_values=True
            ),
        )
        self._check(table.column_names, path)
        return f.tell(), table.column_names

    def _csv(self, part: Part):
        fs, inner = open_fs(part.path)
        with fs.open_input_file(inner) as f:
            first, header = self._header(f, part.path)
            start = max(part.start, first)
            if start > first:
                # the row that runs over the border belongs to the range it starts in
                f.seek(start - 1)
                start += len(_read_line(f)) - 1
            if start >= part.end:
                return
            f.seek(part.end - 1)
            end = part.end - 1 + len(_read_line(f))
            f.seek(start)
            # a row takes at least one byte, so the start of the range plus the number of the
            # row in it grows along the whole file without counting the rows of other ranges
            row = start
            for block in _blocks(f, start, end, end - start if self.multiline else BLOCK_BYTES):
                if not self.multiline:
                    _check_lines(block, part.path)
                for batch in self._parsed(block, header):
                    yield row, {n: batch.column(n) for n in self.names}
                    row += batch.num_rows

    def _parsed(self, data: bytes, header: list[str]) -> Iterator[pa.RecordBatch]:
        if not data.strip():
            return
        batches = pacsv.open_csv(
            pa.BufferReader(data),
            # within a block all on this thread, nothing is read ahead
            read_options=pacsv.ReadOptions(column_names=header, block_size=8 << 20, use_threads=False),
            parse_options=pacsv.ParseOptions(
                delimiter=self.separator, newlines_in_values=self.multiline
            ),
            convert_options=pacsv.ConvertOptions(
                include_columns=self.names,
                column_types={n: pa.string() for n in self.names},
                strings_can_be_null=False,
            ),
        )
        yield from (batch for batch in batches if batch.num_rows)

    # --- workbooks ---------------------------------------------------------------------
    def _workbook(self, part: Part):
        fs, inner = open_fs(part.path)
        with fs.open_input_file(inner) as f, zipfile.ZipFile(f) as book:
            shared = _shared_strings(book)
            position: dict[str, int] = {}
            block: list[dict[int, str]] = []
            first = 0
            with book.open(_sheet_entry(book, part)) as sheet:
                for row, cells in _rows(sheet, shared):
                    if row <= self.skip:
                        continue
                    if not position:
                        self._check(list(cells.values()), part.path)
                        position = {v: k for k, v in reversed(cells.items())}
                        first = row + 1
                        continue
                    # rows left out of the file are rows without values
                    block += [{}] * (row - first - len(block)) + [cells]
                    if len(block) >= XLSX_BATCH_ROWS:
                        yield first, self._columns(block, position)
                        first, block = first + len(block), []
            if block:
                yield first, self._columns(block, position)

    def _columns(self, block, position):
        return {
            n: pa.array([cells.get(position[n]) for cells in block], pa.string())
            for n in self.names
        }


def _read_line(f) -> bytes:
    """Bytes up to and including the next line break; keeps the position exact."""
    begin, pieces = f.tell(), []
    while chunk := f.read(1 << 16):
        cut = chunk.find(b"\n")
        if cut >= 0:
            pieces.append(chunk[: cut + 1])
            break
        pieces.append(chunk)
    line = b"".join(pieces)
    f.seek(begin + len(line))
    return line


def _blocks(f, start: int, end: int, size: int) -> Iterator[bytes]:
    """The bytes from ``start`` to ``end``, the end of a line, in pieces of about ``size`` that end with a line too."""
    while start < end:
        f.seek(start)
        block = f.read(min(size, end - start))
        if start + len(block) < end:
            block += _read_line(f)
        if not block:
            return
        start += len(block)
        yield block


def _text(element) -> str:
    return "".join(t.text or "" for t in element.iter(SHEET_NS + "t"))


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    with book.open("xl/sharedStrings.xml") as f:
        return [_text(item) for item in ET.parse(f).getroot().iter(SHEET_NS + "si")]


def _sheet_entry(book: zipfile.ZipFile, part: Part) -> str:
    with book.open("xl/workbook.xml") as f:
        sheets = list(ET.parse(f).getroot().iter(SHEET_NS + "sheet"))
    wanted = [s for s in sheets if part.sheet is None or s.get("name") == part.sheet]
    if not wanted:
        raise ValueError(f"{part.path} has no sheet {part.sheet}")
    with book.open("xl/_rels/workbook.xml.rels") as f:
        targets = {r.get("Id"): r.get("Target") for r in ET.parse(f).getroot()}
    target = targets[wanted[0].get(REL_NS + "id")]
    return target.lstrip("/") if target.startswith("/") else "xl/" + target


def _rows(sheet, shared: list[str]) -> Iterator[tuple[int, dict[int, str]]]:
    """(row number, {column number: text}) for each row of the sheet, in order."""
    number = 0
    for _, row in ET.iterparse(sheet):
        if row.tag != SHEET_NS + "row":
            continue
        number = int(row.get("r") or number + 1)
        cells, column = {}, 0
        for cell in row.iter(SHEET_NS + "c"):
            letters = re.match(r"[A-Z]+", cell.get("r") or "")
            if letters:
                column = 0
                for letter in letters.group():
                    column = column * 26 + ord(letter) - 64
            else:
                column += 1
            value = cell.find(SHEET_NS + "v")
            kind = cell.get("t")
            if kind == "inlineStr":
                cells[column] = _text(cell)
            elif value is not None and value.text is not None:
                text = value.text
                cells[column] = shared[int(text)] if kind == "s" else text
        yield number, cells
        row.clear()


def register(spark) -> None:
    # workers need no copy of this package
    import edupanel.sources.sheets as module

    cloudpickle.register_pickle_by_value(module)
    spark.dataSource.register(OffsetSheetSource)

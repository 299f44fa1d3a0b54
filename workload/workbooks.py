"""Writes .xlsx files, so that the workbook scan has something to read."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame

from edupanel.sources import sheets

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"
ROWS_PER_WORKBOOK = 100_000


def _letters(n: int) -> str:
    text = ""
    while n:
        n, rest = divmod(n - 1, 26)
        text = chr(65 + rest) + text
    return text


def _sheet(rows: Sequence[Sequence], shared: dict[str, int]) -> str:
    lines = []
    for r, row in enumerate(rows, 1):
        cells = []
        for c, value in enumerate(row, 1):
            place = f'<c r="{_letters(c)}{r}"'
            if isinstance(value, str):
                number = shared.setdefault(value, len(shared))
                cells.append(f'{place} t="s"><v>{number}</v></c>')
            elif value is not None:
                cells.append(f"{place}><v>{value}</v></c>")
        if cells:
            lines.append(f'<row r="{r}">{"".join(cells)}</row>')
    return f'<worksheet xmlns="{MAIN}"><sheetData>{"".join(lines)}</sheetData></worksheet>'


def write(target, content: Mapping[str, Sequence[Sequence]]) -> None:
    """``content``: rows by sheet name; None is an absent cell, a row of them an absent row."""
    shared: dict[str, int] = {}
    numbered = list(enumerate(content.items(), 1))
    names = "".join(
        f'<sheet name="{escape(name)}" sheetId="{i}" r:id="rId{i}"/>' for i, (name, _) in numbered
    )
    links = "".join(
        f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i, _ in numbered
    )
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{MAIN}" xmlns:r="{OFFICE}"><sheets>{names}</sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{PACKAGE}">{links}</Relationships>',
        )
        for i, (_, rows) in numbered:
            book.writestr(f"xl/worksheets/sheet{i}.xml", _sheet(rows, shared))
        items = "".join(f"<si><t>{escape(text)}</t></si>" for text in shared)
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{items}</sst>')


def write_all(df: DataFrame, path: str, sheet_names: Sequence[str], notes: int) -> None:
    """Each task writes its rows as workbooks, a row on the sheet its ``_sheet`` names.

    Workbooks have all sheets and a bounded number of rows; the file name depends on the
    partition only, so a task that runs again replaces what it wrote.
    """
    import workload.workbooks as module

    cloudpickle.register_pickle_by_value(module)
    cloudpickle.register_pickle_by_value(sheets)
    columns = [c for c in df.columns if c != "_sheet"]
    top = [[f"note {n}"] for n in range(notes)] + [columns]

    def save(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, count = TaskContext.get().partitionId(), 0
        for frame in frames:
            for start in range(0, len(frame), ROWS_PER_WORKBOOK):
                rows = frame.iloc[start : start + ROWS_PER_WORKBOOK]
                by_sheet = {
                    name: top + rows.loc[rows["_sheet"] == name, columns].values.tolist()
                    for name in sheet_names
                }
                buffer = io.BytesIO()
                write(buffer, by_sheet)
                name = f"{path}/part-{part:05d}-{count:05d}.xlsx"
                fs, inner = sheets.open_fs(name)
                fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                with fs.open_output_stream(inner) as out:
                    out.write(buffer.getvalue())
                count += 1
                yield pd.DataFrame({"file": [name]})

    df.mapInPandas(save, "file string").write.format("noop").mode("overwrite").save()

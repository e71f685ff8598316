"""Workbooks as tables, whole and damaged, and templates with mode blocks."""

import io
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from curata.functions import text
from curata.sources import readers


def book(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, content in parts.items():
            z.writestr(name, content)
    return out.getvalue()


def sheet(rows):
    cell = lambda v: f'<c t="s"><v>{v}</v></c>' if isinstance(v, int) else f'<c t="inlineStr"><is><t xml:space="preserve">{v}</t></is></c>' if v is not None else "<c/>"
    return "<worksheet><sheetData>" + "".join(f"<row>{''.join(map(cell, r))}</row>" for r in rows) + "</sheetData></worksheet>"


STRINGS = "<sst><si><t>Title</t></si><si><t>a </t></si></sst>"
WORKBOOK = '<workbook xmlns:r="x"><bookViews><workbookView activeTab="1"/></bookViews><sheets><sheet name="n" r:id="r2"/><sheet name="m" r:id="r1"/></sheets></workbook>'
RELATIONS = '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="/xl/worksheets/sheet2.xml"/></Relationships>'
GOOD = {"xl/sharedStrings.xml": STRINGS, "xl/worksheets/sheet1.xml": sheet([[0, "n", "n", None], [1, "1", " 2 ", "no header"], [" ", None, ""], [None, None, "3"]]), "xl/worksheets/sheet2.xml": sheet([["other"], ["x"]])}


def rows(spark, files):
    frame = spark.createDataFrame([(f"{i}", f) for i, f in enumerate(files)], "path string, content binary")
    return {(r.path, r.row): r.cells for r in readers.workbook_rows(frame).collect()}, readers.workbook_cells(frame).count()


def test_a_sheet_as_a_table(spark):
    found, _ = rows(spark, [book(GOOD), book(GOOD | {"xl/workbook.xml": WORKBOOK, "xl/_rels/workbook.xml.rels": RELATIONS}), book(GOOD | {"xl/workbook.xml": WORKBOOK.replace('activeTab="1"', ""), "xl/_rels/workbook.xml.rels": RELATIONS})])
    table = {1: {"Title": "a", "n": "2"}, 3: {"Title": "", "n": "3"}}
    assert found == {("0", k): v for k, v in table.items()} | {("1", k): v for k, v in table.items()} | {("2", 1): {"other": "x"}}


def test_damaged_books_give_what_is_before_the_damage(spark):
    whole = book(GOOD)
    broken = [
        book(GOOD | {"xl/worksheets/sheet1.xml": sheet([[0], [1], [99]])}), book(GOOD | {"xl/worksheets/sheet1.xml": sheet([[0], [1]]).replace("<v>1<", "<v>x<")}), book(GOOD | {"xl/worksheets/sheet1.xml": sheet([[0], [1]])[:-20]}), whole[: len(whole) // 2],
        whole.replace(b"<v>1</v>", b"<v>9</v>"), b"", b"no book", book({}), book(GOOD | {"xl/workbook.xml": "<broken", "xl/_rels/workbook.xml.rels": RELATIONS}), book(GOOD | {"xl/worksheets/sheet1.xml": '<worksheet><row r="x"/></worksheet>'}),
    ]
    found, n = rows(spark, [*broken, whole])
    assert found[("0", 1)] == {"Title": "a"} and ("1", 1) not in found and found[("10", 1)]["Title"] == "a" and n > 8


def plain(template, tags):
    out, active = [], None
    for line in template.splitlines(keepends=True):
        if m := re.match(text.MODE_OPEN, line):
            if active is not None:
                return None, f"mode:{m[1]} opens inside mode:{active}"
            active = m[1]
        elif re.match(text.MODE_CLOSE, line):
            if active is None:
                return None, "a block closes that is not open"
            active = None
        elif active is None or active in tags:
            out.append(line)
    if active is not None:
        return None, f"mode:{active} is not closed"
    whole = "".join(out)
    return (re.sub(r",([ \t]*\n[ \t]*\})", r"\1", whole) if "core" in tags else whole), None


@pytest.mark.parametrize("tags", [["full"], ["core"], ["core", "full"], []])
def test_mode_blocks(spark, tags):
    o, c = "  <!-- mode:full -->\n", "<!--/mode-->  \n"
    cases = ["", "a", "a\nb\n", f"a\n{o}b\n{c}d", f"{o}b\n{c}{o.replace('full', 'core')}{{x,\n }}\n{c}", f"{o}{o}{c}", f"{c}a", f"a\n{o}b", f"{o}a\n{c}{c}", "<!-- mode:Full -->\na\n", "{1,\n}", f"x {o}y\n", "{a,  \n\t},\n]"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string").withColumn("x", text.mode_blocks(F.col("t"), tags))
    assert {r.i: tuple(r.x) for r in frame.collect()} == {i: plain(t, tags) for i, t in enumerate(cases)}

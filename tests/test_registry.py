import csv
import io
import zipfile
from xml.sax.saxutils import escape

import pytest

from rosterlens.sources import registry

_NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def zipped(path, **members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for name, data in members.items():
            out.writestr(name.replace("__", "."), data)
    return f"file://{path}"


def table(header, *rows):
    out = io.StringIO()
    csv.writer(out).writerows([header, *rows])
    return out.getvalue()


def workbook(rows, inline=False):
    """A sheet whose texts are shared, or inline; empty cells are left out."""
    texts, lines = [], []
    for r, row in enumerate(rows):
        cells = []
        for c, value in enumerate(row):
            if value is None:
                continue
            at = f"{chr(65 + c)}{r + 1}"
            if inline:
                cells.append(f'<c r="{at}" t="inlineStr"><is><t>{escape(value)}</t></is></c>')
            elif value.isdigit():
                cells.append(f'<c r="{at}"><v>{value}</v></c>')
            else:
                cells.append(f'<c r="{at}" t="s"><v>{len(texts)}</v></c>')
                texts.append(value)
        lines.append(f'<row r="{r + 1}">{"".join(cells)}</row>')
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        book.writestr("xl/worksheets/sheet1.xml", f"<worksheet {_NS}><sheetData>{''.join(lines)}</sheetData></worksheet>")
        if not inline:
            book.writestr("xl/sharedStrings.xml", f"<sst {_NS}>{''.join(f'<si><t>{escape(t)}</t></si>' for t in texts)}</sst>")
    return out.getvalue()


@pytest.mark.parametrize("part_bytes", [registry.PART_BYTES, 200])
def test_nppes(spark, tmp_path, part_bytes, monkeypatch):
    monkeypatch.setattr(registry.unpack_csv, "__defaults__", (part_bytes,))
    header = [*registry.NPPES, "Other", *(x.format(i) for i in range(1, 16) for x in (registry.TAXONOMY, registry.SWITCH))]

    def person(npi, name, pairs):
        own = {"NPI": npi, "Entity Type Code": "1", "Provider Last Name (Legal Name)": name}
        own |= {x.format(i + 1): v for i, pair in enumerate(pairs) for x, v in zip((registry.TAXONOMY, registry.SWITCH), pair, strict=True)}
        return [own.get(c, "") for c in header]

    rows = [person(str(1000000000 + i), f'two\nlines, "quoted" {i}', [("A", "N"), ("", "Y"), ("B", "Y")] if i % 2 else []) for i in range(40)]
    uri = zipped(tmp_path / "n.zip", npidata_pfile_1_fileheader__csv="x\n", npidata_pfile_1__csv=table(header, *rows, ["short"]))
    got = {r.npi: r for r in registry.nppes(spark, uri).collect()}
    assert len(got) == 40 and got["1000000003"].last_name == 'two\nlines, "quoted" 3'
    assert (got["1000000001"].taxonomy_primary, got["1000000001"].taxonomies) == ("B", "A|B")
    assert (got["1000000002"].taxonomy_primary, got["1000000002"].taxonomies, got["1000000002"].org_name) == (None, None, None)
    with pytest.raises(ValueError, match="Last Update Date"):
        registry.nppes(spark, zipped(tmp_path / "m.zip", npidata_pfile_1__csv=table([c for c in header if c != "Last Update Date"], [""] * (len(header) - 1))))


def test_plan_files(spark, tmp_path):
    uri = zipped(tmp_path / "s.zip", a__csv="﻿" + table([*registry.SERVICE_AREA, "More"], ["2026", "AL", "10000", "S1", "Area", "Yes", "", "", "", "Individual", "x"], ["2026", "AL"]))
    assert [tuple(r) for r in registry.plan_file(spark, uri, registry.SERVICE_AREA).collect()] == [("2026", "AL", "10000", "S1", "Area", "Yes", None, None, None, "Individual")]


@pytest.mark.parametrize("inline", [False, True])
def test_workbooks(spark, tmp_path, inline):
    gone = workbook([["Report"], ["NPI", "NPI Deactivation Date"], ["1000000004", "01/15/2020"], ["total", "1"], [None, None], [" 1000000012 ", None]], inline)
    assert [tuple(r) for r in registry.deactivations(spark, zipped(tmp_path / "d.zip", d__xlsx=gone)).orderBy("npi").collect()] == [("1000000004", "01/15/2020"), ("1000000012", None)]
    header = ["State Code", "FIPS County Code", "County Name", "Metal Level", "Issuer Name", "Plan ID (Standard Component)", "Plan Marketing Name", "Plan Type"]
    sold = workbook([["QHP"], header, ["AL", "1001", "Autauga", "Gold", "Issuer", "10000AL0000001", "Plan", "HMO"], ["AL", "1001", "Autauga", "Gold", "Issuer", "short", "Plan", "HMO"]], inline)
    assert [r.asDict() for r in registry.landscape(spark, zipped(tmp_path / "l.zip", l__xlsx=sold)).collect()] == [{"state": "AL", "county_name": "Autauga", "fips": "1001", "issuer_name": "Issuer", "plan_id": "10000AL0000001", "metal_level": "Gold", "plan_marketing_name": "Plan", "plan_type": "HMO"}]
    with pytest.raises(ValueError, match="header"):
        registry.landscape(spark, zipped(tmp_path / "e.zip", l__xlsx=workbook([["x"]], inline)))

from __future__ import annotations

import datetime as dt
import io
import zipfile
from decimal import Decimal

import pytest

from saleslake.queries.workbooks import _uri, workbook_bytes, write_workbooks
from saleslake.schemas import CUSTOMER_FILE_SCHEMA, SOURCES, SourceSpec, struct
from saleslake.schemas import DATE, INT, MONEY, STRING
from saleslake.sources import read_source
from saleslake.sources.files import read_records, source_for


def test_csv_is_text_named_by_its_header(spark, tmp_path):
    path = tmp_path / "Product.csv"
    path.write_text('Product ID,Price per product\nSEA-TK-73310052,12.50\nX,"1,000"\n')
    df = read_source(spark, "Product.csv", str(path))
    assert df.dtypes == [("Product ID", "string"), ("Price per product", "string")]
    assert [tuple(r) for r in df.collect()] == [("SEA-TK-73310052", "12.50"), ("X", "1,000")]


def test_csv_with_schema_checks_the_header(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("b,a\n1,2\n")
    good = SourceSpec("p.csv", "csv", "t", struct(b=INT, a=INT))
    assert tuple(read_source(spark, good, str(path)).first()) == (1, 2)
    swapped = SourceSpec("p.csv", "csv", "t", struct(a=INT, b=INT))
    with pytest.raises(Exception, match="header"):
        read_source(spark, swapped, str(path)).collect()


def test_csv_folder_is_read_by_column_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Product ID,Category\nP1,C1\n")
    (tmp_path / "b.csv").write_text("Product ID,Category\nP2,C2\n")
    rows = read_source(spark, "Product.csv", str(tmp_path)).collect()
    assert sorted(map(tuple, rows)) == [("P1", "C1"), ("P2", "C2")]
    (tmp_path / "b.csv").write_text('Category,Product ID\n"C,2",P2\n')
    (tmp_path / "c.csv").write_text("Category,Product ID\nC3,P3\n")
    found = read_source(spark, "Product.csv", str(tmp_path))
    rows = [(row["Product ID"], row["Category"]) for row in found.collect()]
    assert sorted(rows) == [("P1", "C1"), ("P2", "C,2"), ("P3", "C3")]
    typed = SourceSpec("p.csv", "csv", "t", struct(**{"Product ID": STRING, "Category": STRING}))
    found = read_source(spark, typed, str(tmp_path))
    assert found.columns == ["Product ID", "Category"] and sorted(map(tuple, found.collect())) == sorted(rows)
    (tmp_path / "c.csv").write_text("Category,Other\nC3,P3\n")
    with pytest.raises(ValueError, match="are not those of the other files"):
        read_source(spark, "Product.csv", str(tmp_path))


def test_broken_records_come_apart(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1, "b": "x"}\n{"a": 2\nnothing\n{"a": "y", "b": "z"}\n')
    spec = SourceSpec("a.json", "json", "t", struct(a=INT, b=STRING))
    good, broken = read_records(spark, spec, str(tmp_path / "a.json"))
    assert [tuple(row) for row in good.collect()] == [(1, "x")]
    assert sorted(map(tuple, broken.collect())) == sorted(
        (text, "a.json") for text in ('{"a": 2', "nothing", '{"a": "y", "b": "z"}')
    )
    (tmp_path / "b.csv").write_text("a,b\n1,x\ny,z\n2,u,v\n")
    spec = SourceSpec("b.csv", "csv", "t", struct(a=INT, b=STRING))
    good, broken = read_records(spark, spec, str(tmp_path / "b.csv"))
    assert [tuple(row) for row in good.collect()] == [(1, "x")]
    assert sorted(row[0] for row in broken.collect()) == ["2,u,v", "y,z"]
    with pytest.raises(FileNotFoundError):
        read_records(spark, spec, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError, match="not read by records"):
        read_records(spark, "Product.csv", str(tmp_path))


def test_csv_without_header(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("1,2\n")
    spec = SourceSpec("p.csv", "csv", "t", struct(a=INT, b=STRING), header=False)
    assert tuple(read_source(spark, spec, str(path)).first()) == (1, "2")


def test_json_types(spark, tmp_path):
    path = tmp_path / "Order.json"
    path.write_text(
        '{"Row ID": 1, "Order ID": "a", "Price": 60.125, "Profit": -6.4449, "Other": 1}\n'
        '{"Row ID": 2, "Order ID": "b", "Price": 123456789012.0, "Discount": 0.3}\n'
    )
    one, two = read_source(spark, "Order.json", str(path)).orderBy("Row ID").collect()
    assert (one["Price"], one["Profit"]) == (Decimal("60.13"), Decimal("-6.44"))
    assert "Other" not in one.asDict()
    assert (two["Price"], two["Discount"]) == (None, Decimal("0.30"))


def test_json_array_file(spark, tmp_path):
    path = tmp_path / "o.json"
    path.write_text('[\n{"a": 1},\n{"a": 2}\n]\n')
    spec = SourceSpec("o.json", "json", "t", struct(a=INT), multi_line=True)
    assert sorted(r.a for r in read_source(spark, spec, str(path)).collect()) == [1, 2]


@pytest.mark.parametrize("name", ["Product1.csv", "Order1.json", "Customer1.xlsx"])
def test_missing_file(spark, tmp_path, name):
    with pytest.raises(FileNotFoundError, match=name):
        read_source(spark, name, str(tmp_path / name))


def test_unsupported_format(spark, tmp_path):
    with pytest.raises(ValueError, match="avro"):
        read_source(spark, "Order.avro", str(tmp_path))
    with pytest.raises(ValueError, match="avro"):
        read_source(spark, SourceSpec("x", "avro", "t"), str(tmp_path))


@pytest.mark.parametrize("kind", ["json", "xlsx"])
def test_schema_or_a_workbook_is_required(spark, tmp_path, kind):
    with pytest.raises(ValueError, match="schema"):
        read_source(spark, SourceSpec("x", kind, "t"), str(tmp_path))


def test_registry():
    assert source_for("Order.json") is SOURCES["Order.json"]
    other = source_for("Order_2017.json")
    assert (other.name, other.schema) == ("Order_2017.json", SOURCES["Order.json"].schema)


def _workbook(path, sheet: str, strings: str = "", styles: str = "", book_pr: str = "") -> None:
    """A workbook as spreadsheet programs write it: sheet order by relationship."""
    out = io.BytesIO()
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(out, "w") as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook {main} {rel}>{book_pr}<sheets><sheet name="Data" sheetId="7" r:id="rId9"/>'
            '<sheet name="Notes" sheetId="1" r:id="rId1"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/>'
            '<Relationship Id="rId9" Target="/xl/worksheets/sheet2.xml"/></Relationships>',
        )
        book.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData/></worksheet>")
        book.writestr(
            "xl/worksheets/sheet2.xml",
            f"<worksheet {main}><sheetData>{sheet}</sheetData></worksheet>",
        )
        if strings:
            book.writestr("xl/sharedStrings.xml", f"<sst {main}>{strings}</sst>")
        if styles:
            book.writestr("xl/styles.xml", f"<styleSheet {main}>{styles}</styleSheet>")
    path.write_bytes(out.getvalue())


@pytest.mark.parametrize(
    ("book_pr", "days"),
    [("", [dt.date(2016, 10, 31), dt.date(1900, 1, 1), dt.date(1900, 3, 1)]),
     ('<workbookPr date1904="1"/>', [dt.date(2020, 11, 1), dt.date(1904, 1, 2),
                                     dt.date(1904, 3, 2)])],
)
def test_xlsx_dates(spark, tmp_path, book_pr, days):
    cells = "".join(
        f'<row><c r="A{at}" s="{style}"><v>{number}</v></c><c r="B{at}" s="0"><v>{number}</v></c>'
        "</row>" for at, style, number in ((2, 1, 42674), (3, 2, 1), (4, 3, 61))
    )
    _workbook(
        tmp_path / "d.Xlsx",
        '<row><c r="A1" t="str"><v>Day</v></c><c r="B1" t="str"><v>N</v></c></row>' + cells,
        styles='<numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm"/>'
        '<numFmt numFmtId="165" formatCode="[Red]0.0&quot;days&quot;"/></numFmts>'
        '<cellXfs><xf numFmtId="165"/><xf numFmtId="14"/><xf numFmtId="164"/>'
        '<xf numFmtId="22"/></cellXfs>',
        book_pr=book_pr,
    )
    spec = SourceSpec("d.xlsx", "xlsx", "t", struct(day=DATE, n=INT))
    for path in (tmp_path, tmp_path / "d.Xlsx"):
        rows = read_source(spark, spec, str(path)).collect()
        assert [tuple(r) for r in rows] == list(zip(days, (42674, 1, 61), strict=True))


def test_xlsx_of_any_name_and_without_known_columns(spark, tmp_path):
    for name in ("a.xlsm", "b.XLSX", "noname"):
        (tmp_path / name).write_bytes(workbook_bytes(["n"], [(1,)]))
    spec = SourceSpec("a.xlsx", "xlsx", "t", struct(n=INT))
    assert read_source(spark, spec, str(tmp_path)).count() == 2
    assert read_source(spark, spec, str(tmp_path / "noname")).collect() == [(1,)]
    other = SourceSpec("a.xlsx", "xlsx", "t", struct(m=INT))
    with pytest.raises(Exception, match="no header cell"):
        read_source(spark, other, str(tmp_path)).collect()


def test_xlsx_cells(spark, tmp_path):
    _workbook(
        tmp_path / "Customer.xlsx",
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c>'
        '<c r="C1" t="inlineStr"><is><t>Phone</t></is></c>'
        '<c r="AA1" t="s"><v>3</v></c></row>'
        '<row r="2"><c r="A2" t="s"><v>2</v></c><c r="B2"><v>12345</v></c>'
        '<c r="C2" t="e"><v>#ERROR!</v></c><c r="AA2" t="b"><v>1</v></c></row>'
        '<row r="3"/>'
        '<row r="4"><c r="B4" t="str"><f>1+1</f><v>2</v></c><c r="C4"><v>1.23456789E9</v></c>'
        '<c r="AA4" t="b"><v>0</v></c></row>',
        "<si><t>Customer ID</t></si><si><t>Postal Code</t></si>"
        "<si><r><t>QX-</t></r><r><rPr/><t>40417</t></r><rPh><t>no</t></rPh></si>"
        "<si><t> region </t></si>",
    )
    df = read_source(spark, "Customer.xlsx", str(tmp_path / "Customer.xlsx"))
    assert df.schema == CUSTOMER_FILE_SCHEMA
    rows = df.select("Customer ID", "Postal Code", "Phone", "Region", "City").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [
            ("QX-40417", "12345", "#ERROR!", "true", None),
            (None, "2", "1234567890", "false", None),
        ],
        key=str,
    )


def test_xlsx_types_folder_and_positions(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook_bytes(["n", "price"], [(1, "2.50"), ("x", None)]))
    (tmp_path / "b.xlsx").write_bytes(workbook_bytes(["Price", "N"], [("3", 7)]))
    (tmp_path / "ignored.txt").write_text("no workbook")
    spec = SourceSpec("books.xlsx", "xlsx", "t", struct(n=INT, price=MONEY))
    rows = {tuple(r) for r in read_source(spark, spec, str(tmp_path)).collect()}
    assert rows == {(1, Decimal("2.50")), (None, None), (7, Decimal("3.00"))}
    bare = SourceSpec("a.xlsx", "xlsx", "t", struct(first=STRING, second=STRING), header=False)
    rows = [tuple(r) for r in read_source(spark, bare, str(tmp_path / "a.xlsx")).collect()]
    assert rows == [("n", "price"), ("1", "2.50"), ("x", None)]


def test_xlsx_longer_than_a_batch(spark, tmp_path):
    rows = [(i, f"<{i}&>") for i in range(25_001)]
    (tmp_path / "a.xlsx").write_bytes(workbook_bytes(["n", "s"], rows))
    spec = SourceSpec("a.xlsx", "xlsx", "t", struct(n=INT, s=STRING))
    got = read_source(spark, spec, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == rows


def test_xlsx_without_rows(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook_bytes(["n"], []))
    spec = SourceSpec("a.xlsx", "xlsx", "t", struct(n=INT))
    assert read_source(spark, spec, str(tmp_path)).collect() == []


def test_workbooks_written_by_tasks_read_back(spark, tmp_path):
    df = spark.range(1000, numPartitions=3).selectExpr("id AS n", "concat('é ', id) AS s")
    write_workbooks(df, str(tmp_path / "books"))
    assert len(list((tmp_path / "books").glob("*.xlsx"))) == 3
    spec = SourceSpec("b.xlsx", "xlsx", "t", struct(n=INT, s=STRING))
    got = read_source(spark, spec, str(tmp_path / "books"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))


def test_workbooks_go_to_the_default_file_system(spark, tmp_path):
    assert _uri(spark, str(tmp_path)) == _uri(spark, f"file:{tmp_path}") == f"file://{tmp_path}"
    setting, conf = "fs.defaultFS", spark._jsc.hadoopConfiguration()
    before = conf.get(setting)
    conf.set(setting, "viewfs://cluster")
    conf.set("fs.viewfs.mounttable.cluster.linkFallback", "file:///")
    try:
        assert _uri(spark, str(tmp_path)).startswith("viewfs://cluster")
    finally:
        conf.set(setting, before)


def _inferred(spark, path, header=True):
    return read_source(spark, SourceSpec("a.xlsx", "xlsx", "t", header=header), str(path))


def test_xlsx_types_come_from_the_cells_of_all_workbooks(spark, tmp_path):
    day, moment = dt.date(2020, 2, 29), dt.datetime(2021, 3, 4, 5, 6, 7)
    (tmp_path / "a.xlsx").write_bytes(workbook_bytes(
        ["Big No", "price", "when", "day", "ok", "mix", "none", "digits"],
        [(1, 2, day, day, True, 1, None, "7"), (2**62, None, None, None, None, None, None, None)],
    ))
    (tmp_path / "b.xlsx").write_bytes(workbook_bytes(
        ["extra", "When", "PRICE", "mix", "big_no"],
        [("x", moment, 2.5, day, -5), (None, None, 1e17, "y", None)],
    ))
    found = _inferred(spark, tmp_path)
    assert found.dtypes == [
        ("Big No", "bigint"), ("price", "double"), ("when", "timestamp"), ("day", "date"),
        ("ok", "boolean"), ("mix", "string"), ("none", "string"), ("digits", "string"),
        ("extra", "string"),
    ]
    rows = found.select("Big No", "price", "when", "day", "ok", "mix", "digits", "extra").collect()
    midnight = dt.datetime(2020, 2, 29)
    assert sorted(map(tuple, rows), key=str) == sorted([
        (1, 2.0, midnight, day, True, "1", "7", None),
        (2**62, None, None, None, None, None, None, None),
        (-5, 2.5, moment, None, None, "2020-02-29", None, "x"),
        (None, 1e17, None, None, None, "y", None, None),
    ], key=str)


def test_xlsx_types_do_not_depend_on_the_parts_of_a_scan(spark, tmp_path, conf):
    kinds = [1, 2.5, True, dt.date(2020, 1, 1), "t", None]
    for at, first in enumerate(kinds):
        rows = [(first, second) for second in kinds[: at + 1]]
        (tmp_path / f"{at}.xlsx").write_bytes(workbook_bytes(["a", f"b{at}"], rows))
    expected = [("a", "string"), ("b0", "bigint"), ("b1", "double"), ("b2", "string"),
                ("b3", "string"), ("b4", "string"), ("b5", "string")]
    assert _inferred(spark, tmp_path).dtypes == expected
    conf(spark__sql__files__maxPartitionBytes="1")
    assert _inferred(spark, tmp_path).dtypes == expected


def test_xlsx_without_schema_or_header_errors_and_gaps(spark, tmp_path):
    _workbook(
        tmp_path / "e.xlsx",
        '<row r="1"><c r="A1" t="str"><v>n</v></c></row>'
        '<row r="2"><c r="A2"><v>4</v></c><c r="C2"><v>9.223372036854775808E18</v></c></row>'
        '<row r="3"><c r="A3" t="e"><v>#DIV/0!</v></c><c r="D3" t="e"><v>#N/A</v></c></row>',
    )
    found = _inferred(spark, tmp_path / "e.xlsx")
    assert found.dtypes == [("n", "bigint"), ("_c2", "double")]
    assert [tuple(row) for row in found.collect()] == [(4, float(2**63)), (None, None)]
    bare = _inferred(spark, tmp_path / "e.xlsx", header=False)
    assert bare.dtypes == [("_c0", "string"), ("_c1", "string"), ("_c2", "double"), ("_c3", "string")]
    assert bare.count() == 3

    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError, match="no workbook"):
        _inferred(spark, tmp_path / "empty")
    (tmp_path / "empty" / "h.xlsx").write_bytes(workbook_bytes(["a", "B"], []))
    assert _inferred(spark, tmp_path / "empty").dtypes == [("a", "string"), ("B", "string")]
    (tmp_path / "twice.xlsx").write_bytes(workbook_bytes(["a b", "A_B"], [(1, 2)]))
    with pytest.raises(Exception, match="mean the same"):
        _inferred(spark, tmp_path / "twice.xlsx")

"""File sources and sinks on small hand-made files (FIXTURES part B)."""

import os
import random

import pytest
from pyspark.sql import functions as F

from orderdesk.sources import files as FS
from orderdesk.sources import sinks


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


CONF_CSV = ("Product,Description,Ordered,B/O'd,To Ship,Price,Expected Date\n"
            "AB000001,Tree,5,0,5,1.5,2024-01-10\n"
            ",No product,1,0,1,2.0,2024-01-11\n"
            "AB000002,Star,7,2,5,3.25,\n")


def test_confirmation_csv_drops_null_product(spark, tmp_path):
    d = tmp_path / "FL4494"
    _write(str(d / "order_confirmation_p1194944.csv"), CONF_CSV)
    _write(str(d / "Order_Confirmation_P1194945.csv"), CONF_CSV)
    _write(str(d / "notes.csv"), "x\n1\n")
    df = FS.read_confirmations(spark, str(d), glob=FS.CONFIRMATION_GLOB)
    assert df.count() == 4
    assert sorted(r[0] for r in df.select("Product").distinct().collect()) == ["AB000001", "AB000002"]
    assert df.where(F.col("Product") == "AB000002").select("Ordered").first()[0] == 7


def test_missing_confirmation_files(spark, tmp_path):
    d = tmp_path / "c"
    _write(str(d / "Order_Confirmation_P1194944.csv"), CONF_CSV)
    expected = spark.createDataFrame([("P1194944",), ("P1194945",)], "po string")
    assert [r[0] for r in FS.missing_files(spark, str(d), expected).collect()] == ["P1194945"]


def test_customer_csv_selects_columns(spark, tmp_path):
    p = tmp_path / "customer_order.csv"
    _write(str(p), "Product,Qty,Unit Cost,Ext Cost,Note\nAB1,6,1.5,9.0,x\nAB2,2,2.0,4.0,y\n")
    df = FS.read_customer_csv(spark, str(p))
    assert df.columns == ["Product", "Qty", "Unit Cost", "Ext Cost"]
    assert [tuple(r) for r in df.orderBy("Product").collect()] == [("AB1", 6, 1.5, 9.0), ("AB2", 2, 2.0, 4.0)]


XML = """<?xml version="1.0"?>
<Workbook xmlns="urn:schemas-microsoft-com:office:spreadsheet" xmlns:ss="urn:schemas-microsoft-com:office:spreadsheet">
<Worksheet ss:Name="Sheet1"><Table>
<Row><Cell><Data ss:Type="String">Product</Data></Cell><Cell><Data ss:Type="String">Description</Data></Cell><Cell><Data ss:Type="String">Ordered</Data></Cell><Cell><Data ss:Type="String">B/O'd</Data></Cell><Cell><Data ss:Type="String">To Ship</Data></Cell><Cell><Data ss:Type="String">Price</Data></Cell><Cell><Data ss:Type="String">Expected Date</Data></Cell></Row>
<Row><Cell><Data ss:Type="String">AB000001</Data></Cell><Cell><Data ss:Type="String">Tree</Data></Cell><Cell><Data ss:Type="Number">5</Data></Cell><Cell/><Cell><Data ss:Type="Number">5</Data></Cell><Cell><Data ss:Type="Number">1.5</Data></Cell><Cell><Data ss:Type="String">2024-01-10</Data></Cell></Row>
<Row><Cell/><Cell><Data ss:Type="String">Freight</Data></Cell><Cell><Data ss:Type="Number">1</Data></Cell><Cell><Data ss:Type="Number">0</Data></Cell><Cell><Data ss:Type="Number">1</Data></Cell><Cell><Data ss:Type="Number">9</Data></Cell><Cell><Data ss:Type="String">x</Data></Cell></Row>
</Table></Worksheet></Workbook>
"""


def test_spreadsheet_xml(spark, tmp_path):
    p = tmp_path / "Order_Confirmation_P1.xml"
    _write(str(p), XML)
    rows = FS.read_spreadsheet_xml(spark, str(p)).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["Product"], r["Description"], r["Ordered"], r["B/O'd"], r["To Ship"], r["Expected Date"]) == \
        ("AB000001", "Tree", "5", None, "5", "2024-01-10")


def test_template_sheets(spark, tmp_path):
    lead = "".join(f"junk {i}\n" for i in range(15))
    _write(str(tmp_path / "fl" / "sheet_FL4494.csv"),
           lead + "SKU Number  Description,Vendor Part No.,Qty Ord/ Pcs,Unit Retail,Extended Cost\n"
           "Tree 412000000077 green,AB000077,12,9.99,30.00\n,,,,\n")
    df = FS.read_template_sheet(spark, str(tmp_path / "fl"), "FL4494",
                                ["Description", "Product", "Qty", "Retail", "Ext Cost"])
    r = df.first()
    assert df.count() == 1 and r["Product"] == "AB000077" and r["UPC"] == "412000000077" and r["Qty"] == "12"
    _write(str(tmp_path / "sr" / "sheet_SALEREP.csv"),
           "Product,Qty,Completed\nA1,1,1\nA2,2,0\nA3,3,\n")
    sr = FS.read_template_sheet(spark, str(tmp_path / "sr"), "SALEREP", ["Product", "Qty", "Completed"])
    assert sorted(r[0] for r in sr.select("Product").collect()) == ["A2", "A3"]


def test_quote_sheets_header_rules_and_vendor(spark, tmp_path):
    d = tmp_path / "quotes"
    lead = "title\nrate\n\n"
    _write(str(d / "KX 2025 PRICING T00012.csv"), lead + "Item#,2025 Price,MIN QTY\nAB1,\"$1,234.50\",6\nAB2,2.00,0\n")
    _write(str(d / "KX 2025 PRICING H00003.csv"), lead + "ITEM,Cost 2025,MIN\nAB3,3.10,12\n")
    rows = {r["PRODCT"]: r for r in FS.read_quote_sheets(spark, str(d), 2025).collect()}
    assert set(rows) == {"AB1", "AB2", "AB3"}
    assert rows["AB1"]["SUPPLR"] == "T00012" and float(rows["AB1"]["NEW_COST"]) == 1234.5
    assert rows["AB3"]["SUPPLR"] == "H00003" and rows["AB3"]["MOQ"] == 12


def test_office_sheet(spark, tmp_path):
    text = ("EXCHANGE RATE,,,,\nMARKER PRICE LIST,,,,\nITEM,2024 PRICE,2025 PRICE,DIMENSIONS (INCHES),IN/OUT/   PACK PCS,EMPTY,2024 PURCH\n"
            "AB1,2.00,2.20,10  X 12 CTN  3,6,,100\nAB2,4.00,4.00,5 X 5,12,,\n")
    _write(str(tmp_path / "o" / "office sheet T00001.csv"), text)
    df = FS.office_sheet(spark, str(tmp_path / "o"), "MARKER")
    rows = {r["ITEM"]: r for r in df.collect()}
    assert df.columns[4:] == ["ITEM", "Photo", "2024 COST", "2025 COST", "DIMENSIONS (INCHES)", "% Change", "PURCH"]
    assert abs(rows["AB1"]["% Change"] - 0.1) < 1e-9 and rows["AB2"]["% Change"] == 0.0
    assert rows["AB1"]["DIMENSIONS (INCHES)"] == "10 X 12 \nCTN 3"
    assert rows["AB1"]["SUPPLR"] == "T00001" and rows["AB1"]["PURCH"] == "100"


def test_landed_report(spark, tmp_path):
    text = ("report title,,\nNAME,PRODCT,COST\nAB000001 x,,1\n,AB000002 y,2\n,PRODCT,\n,OV0001,3\n,ZZ9,4\n")
    _write(str(tmp_path / "r" / "landed.csv"), text)
    cat = spark.createDataFrame([("T1", "AB000001"), ("T2", "AB000002"), ("T3", "AB000003")],
                                "SUPPLR string, PRODCT string")
    got = sorted(tuple(r) for r in FS.landed_report(spark, str(tmp_path / "r"), cat).collect())
    assert got == [("T1", "AB000001"), ("T2", "AB000002")]


def test_route_documents(spark):
    files = spark.createDataFrame([("/so/FL4494/Order_Confirmation_P1.xml",), ("/so/NV0356/PO_123.pdf",),
                                   ("/so/X/xerox scan 1.xlsx",), ("/so/X/readme.txt",), ("/so/X/misc.csv",)],
                                  "path string")
    got = {r["path"]: (r["customer_id"], r["role"], r["reader"]) for r in FS.route_documents(files).collect()}
    assert got["/so/FL4494/Order_Confirmation_P1.xml"] == ("FL4494", "confirmation", "xml")
    assert got["/so/NV0356/PO_123.pdf"] == ("NV0356", "customer_order", "extracted")
    assert got["/so/X/xerox scan 1.xlsx"][1] == "memo"
    assert got["/so/X/readme.txt"][1] == "reject" and got["/so/X/misc.csv"][1] == "reject"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("T1", "B", 1), ("T1", "A", 2), ("H2", "C", 3)], "SUPPLR string, PRODCT string, n int")
    sinks.write_per_vendor(df, str(tmp_path / "per"), order=["PRODCT"])
    assert sorted(d for d in os.listdir(tmp_path / "per") if d.startswith("SUPPLR=")) == ["SUPPLR=H2", "SUPPLR=T1"]
    back = spark.read.option("header", True).csv(str(tmp_path / "per" / "SUPPLR=T1"))
    assert [r[0] for r in back.collect()] == ["A", "B"]
    sinks.write_csv(df, str(tmp_path / "csv"), order=["n"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 3
    df.createOrReplaceTempView("t_small")
    spark.range(40).withColumn("PRODCT", F.lit("x")).createOrReplaceTempView("t_big")
    got = sinks.triage_tables(spark, ["t_small", "t_big"], str(tmp_path / "tri"))
    assert got == [("t_small", "skip"), ("t_big", "t_big_prod")]


def test_replace_table(spark):
    df = spark.createDataFrame([("T1", "a@x")], "SUPPLR string, EMAIL string")
    sinks.replace_table(df, "supplier_emails")
    sinks.replace_table(df.union(df), "supplier_emails")
    assert spark.table("supplier_emails").count() == 2


def test_first_rows(spark):
    df = spark.range(100).selectExpr("id", "100 - id as k")
    assert [r["k"] for r in sinks.first_rows(df, ["k"], 5).collect()] == [1, 2, 3, 4, 5]


def _cells(spark, path, **options):
    rows = FS.split_cells(FS.read_lines(spark, str(path), **options)).collect()
    return {(r["line_no"], i): v for r in rows for i, v in enumerate(r["cells"]) if v}


def test_wide_sheet_keeps_every_column(spark, tmp_path):
    names = [f"H{i}" for i in range(60)]
    _write(str(tmp_path / "w" / "wide.csv"), ",".join(names) + "\n" + ",".join(str(i) for i in range(60)) + "\n")
    row = FS.table_after_header(FS.split_cells(FS.read_lines(spark, str(tmp_path / "w"))), 0, names).first()
    assert [row[n] for n in names] == [str(i) for i in range(60)]


def test_very_wide_record(spark, tmp_path):
    _write(str(tmp_path / "v" / "x.csv"), "," * 16383 + '"last, one"')
    assert _cells(spark, tmp_path / "v") == {(0, 16383): "last, one"}


def test_quoted_cells(spark, tmp_path):
    text = ('\ufeffa,"b ""x"", c","two\r\nlines"\r\n'
            ',5" wide,"open\n'
            '\n'
            '"",z\n')
    with open(tmp_path / "q.csv", "w", newline="") as f:
        f.write(text)
    # nothing closes the quote before 'open' ('""' is a doubled one): it is plain text
    assert _cells(spark, tmp_path / "q.csv") == {(0, 0): "a", (0, 1): 'b "x", c', (0, 2): "two\r\nlines", (1, 1): '5" wide',
                                                 (1, 2): '"open', (3, 1): "z"}


@pytest.fixture
def small_pieces(spark):
    """Files are cut into pieces of a few hundred bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_one_file_in_many_tasks(spark, tmp_path, small_pieces):
    lines = [f"p{i},{i * 7}," + "x" * (i % 40) for i in range(400)]
    _write(str(tmp_path / "big" / "order_confirmation_p1.csv"), "Product,Ordered,Note\n" + "\n".join(lines) + "\n")
    _write(str(tmp_path / "big" / "order_confirmation_p2.csv"), "Ordered,Product\n3,q1\n")
    assert FS._pieces(spark, str(tmp_path / "big"), None, False, "\n").rdd.getNumPartitions() > 20
    df = FS.read_confirmations(spark, str(tmp_path / "big"), extra=["Note"])
    got = sorted((r.file_name, r.row_no, r.Product, r.Ordered, r.Note) for r in df.collect())
    assert got == sorted([("order_confirmation_p1.csv", i + 1, f"p{i}", i * 7, "x" * (i % 40) or None) for i in range(400)]
                         + [("order_confirmation_p2.csv", 1, "q1", 3, None)])


def _python_cells(text):
    """Records by one pass over the characters; a quote that is never closed is plain."""
    import re
    cell = re.compile(r'"[^"]*+(?:""[^"]*+)*+"[^,\n]*+|[^,\n]*+')
    out, line, column, at = {}, 0, 0, 0
    while at < len(text):
        m = cell.match(text, at)
        v = m.group()
        q = re.match(r'(?s)("[^"]*+(?:""[^"]*+)*+")(.*)$', v)
        v = q.group(1)[1:-1].replace('""', '"') + q.group(2) if q else v
        if v:
            out[line, column] = v
        at = m.end()
        if at < len(text) and text[at] == "\n":
            line, column = line + 1, 0
        else:
            column += 1
        at += 1
    return out


def test_line_breaks_in_cells_across_pieces(spark, tmp_path, small_pieces):
    rng = random.Random(4)
    pool = ['a', '"q"', '"x\ny"', '"l,1\n\n""2"" "', '5" pipe', 'b c', '', '""', '"tail"x', '"' + "long\n" * 90 + '"', "z" * 50]
    for k in range(6):
        rows = [",".join(rng.choice(pool) for _ in range(rng.randrange(1, 5))) for _ in range(60)]
        text = "\n".join(rows) + ("" if k % 2 else '\n,"never,closed\n1,2\n\n3' if k % 4 else "\n")
        _write(str(tmp_path / f"{k}.csv"), text)
        assert _cells(spark, tmp_path / f"{k}.csv") == _python_cells(text), k


def test_spreadsheet_in_many_tasks(spark, tmp_path, small_pieces):
    cell = "<Cell><Data ss:Type=\"String\">{}</Data></Cell>"
    head = "".join(cell.format(c) for c in ("Description", "Product", "Ordered"))
    body = "".join(f"<Row ss:Height=\"9\">\n{cell.format('d & e'.replace('&', '&amp;'))}<Cell/>{cell.format(i)}</Row>" if i % 5 == 0 else
                   f"<Row/><Row>{cell.format(f'd{i}')}{cell.format(f'P{i}')}{cell.format(i)}</Row>\n" for i in range(200))
    tail = f"</Table></Worksheet><Worksheet><Table><Row>{cell.format('other') * 3}</Row></Table></Worksheet></Workbook>"
    _write(str(tmp_path / "x" / "c.xml"), XML[:XML.index("<Row>")] + f"<Row>{head}</Row>" + body + tail)
    rows = FS.read_xml_rows(spark, str(tmp_path / "x")).collect()
    assert [r.cells for r in sorted(rows, key=lambda r: r.line_no)] == [["Description", "Product", "Ordered"]] + [
        ["d & e", None, str(i)] if i % 5 == 0 else [f"d{i}", f"P{i}", str(i)] for i in range(200)]
    got = FS.read_spreadsheet_xml(spark, str(tmp_path / "x")).collect()
    assert sorted((r.Product, r.Ordered) for r in got) == sorted((f"P{i}", str(i)) for i in range(200) if i % 5)


def test_office_rows_do_not_depend_on_headers(spark, tmp_path):
    _write(str(tmp_path / "o" / "a T1.csv"), "MARKER\nITEM,2025 PRICE,2025 NOTE,ITEM\nA1,2,n,\n,3,,B9\n,,,\n")
    _write(str(tmp_path / "o" / "b T2.csv"), "x\nMARKER\nCODE,2024 PRICE,2025 PRICE\nC1,2,3\n")
    rows = FS.office_rows(spark, str(tmp_path / "o"), "MARKER")
    got = sorted((r.SUPPLR, r.line_no, r.CELLS, r.CHANGE) for r in rows.collect())
    assert got == [("T1", 2, {"ITEM": "A1", "2025 COST": "2", "2025 NOTE": "n"}, None), ("T1", 3, {"ITEM": "B9", "2025 COST": "3"}, None),
                   ("T2", 3, {"CODE": "C1", "2024 COST": "2", "2025 COST": "3"}, 0.5)]


def test_csv_columns_by_each_files_header(spark, tmp_path):
    d = tmp_path / "mixed"
    _write(str(d / "order_confirmation_p1.csv"), CONF_CSV)
    _write(str(d / "order_confirmation_p2.csv"),
           "Description,Product,Price,Ordered,B/O'd,To Ship,Expected Date,Note\nStar,AB000009,3.5,4,1,3,2024-02-01,hi\n")
    rows = {r["Product"]: r for r in FS.read_confirmations(spark, str(d), extra=["Note"]).collect()}
    assert set(rows) == {"AB000001", "AB000002", "AB000009"}
    assert (rows["AB000009"]["Description"], rows["AB000009"]["Price"], rows["AB000009"]["Note"]) == ("Star", 3.5, "hi")
    c = tmp_path / "cust"
    _write(str(c / "a.csv"), "Product,Qty,Unit Cost,Ext Cost\nAB1,6,1.5,9.0\n")
    _write(str(c / "b.csv"), "Qty,Product,Ext Cost,Unit Cost\n2,AB2,4.0,2.0\n")
    got = sorted(tuple(r) for r in FS.read_customer_csv(spark, str(c)).collect())
    assert got == [("AB1", 6, 1.5, 9.0), ("AB2", 2, 2.0, 4.0)]


def test_read_orders_unites_all_documents(spark, tmp_path):
    root = tmp_path / "so"
    _write(str(root / "X1" / "Order_Confirmation_P1.csv"), "Ordered,Product,Price\n3,AB1,2.50\n1,,9\n")
    _write(str(root / "X1" / "Order_Confirmation_P2.xml"), XML)
    _write(str(root / "PA6502" / "PO 7.csv"), "Item,Qty,Unit Price,Total\nCD2,4,\"$1,000.50\",4002\n")
    _write(str(root / "CL7158" / "po 8.CSV"), "junk\n" * 23 + "QTY,STYLE #,Unit Total,Total Cost\n2,EF3,1.5,3\n")
    _write(str(root / "X1" / "misc.csv"), "Product,Qty\nZZ,1\n")
    rows = spark.createDataFrame([(5, 1, "GH4", "2", "$1.00", "$2.00")],
                                 "doc_id bigint, row_no int, `ITEM NO.` string, QTY string, `Unit Price` string, SubTotal string")
    lines, rejects = FS.read_orders(spark, str(root), {"FL2658": rows})
    got = sorted((r["customer_id"], r["role"], r["Product"], r["Qty"], r["Unit Cost"], r["Ext Cost"]) for r in lines.collect())
    assert got == [("CL7158", "customer_order", "EF3", 2.0, 1.5, 3.0), ("FL2658", "customer_order", "GH4", 2.0, 1.0, 2.0),
                   ("PA6502", "customer_order", "CD2", 4.0, 1000.5, 4002.0), ("X1", "confirmation", "AB000001", 5.0, 1.5, None),
                   ("X1", "confirmation", "AB1", 3.0, 2.5, None)]
    assert [r["path"].rsplit("/", 1)[1] for r in rejects.collect()] == ["misc.csv"]

"""Order-document templates on small extracted tables (FIXTURES part B)."""

from orderdesk.operators import templates as T


def test_fl2658(spark):
    df = spark.createDataFrame([(1, 1, "AB1", "2", "$1,234.50", "$2,469.00"), (1, 2, None, "1", "$1.00", "$1"),
                                (1, 3, "AB2", "x", None, "$5")],
                               "doc_id bigint, row_no int, `ITEM NO.` string, QTY string, `Unit Price` string, SubTotal string")
    got = [tuple(r) for r in T.fl2658(df).collect()]
    assert got == [(1, 1, "AB1", 2.0, 1234.5, 2469.0)]


def test_pa1683(spark):
    df = spark.createDataFrame([(1, 1, "x", "S-1", "3", "$2.50", "$7.50"), (1, 2, "y", "S-2", None, "$1", "$1"),
                                (1, 3, "z", "S-3", "1", "bad", "$1,000.00")],
                               "doc_id bigint, row_no int, DESC string, `SUPPLIER #` string, QTY string, "
                               "`PRICE/UN` string, AMOUNT string")
    got = [tuple(r) for r in T.pa1683(df).orderBy("row_no").collect()]
    assert got == [(1, 1, "S-1", "3", 2.5, 7.5), (1, 3, "S-3", "1", None, 1000.0)]


def test_az1239_finds_item_column(spark):
    df = spark.createDataFrame([(1, 1, "Tree lights", "AB12C", "12EaOnly", "1,234.5", "14814.0", None),
                                (1, 2, "Star", "CD34E", "6", "2.0", "12.0", None),
                                (1, 3, "Note 1.5", None, "1", "1", "1", None)],
                               "doc_id bigint, row_no int, c0 string, c1 string, c2 string, c3 string, c4 string, c5 string")
    got = [tuple(r) for r in T.az1239(df).orderBy("row_no").collect()]
    assert got == [(1, 1, "AB12C", 12.0, 1234.5, 14814.0), (1, 2, "CD34E", 6.0, 2.0, 12.0)]


def test_nv0356(spark):
    cols = ("doc_id bigint, row_no int, `Style description / Vendor style` string, `Ordered qty` string, "
            "`Unit cost` string, `Extended cost` string, `Unit retail` string, c9 string")
    df = spark.createDataFrame([(1, 1, None, None, None, None, None, "UPC"),
                                (1, 2, "AB12", "EA 6", "$1.50", "$9.00", "3.99", "412000000001"),
                                (1, 3, None, None, None, None, None, "412000000002"),
                                (1, 4, "Total: n/a", "x", None, None, None, None)], cols)
    got = [(r["row_no"], r["Product"], r["Qty"], r["Ext Cost"], r["UPC"]) for r in T.nv0356(df).orderBy("row_no").collect()]
    assert got == [(2, "AB12", 6.0, 9.0, "412000000001"), (3, "AB12", 6.0, 9.0, "412000000002")]


def test_first_row_names_each_tables_columns(spark):
    df = spark.createDataFrame([(1, 1, 1, "UPC", "TEXT", None), (1, 1, 2, "4120", "Tree", "x"), (1, 1, 3, None, None, None),
                                (1, 2, 5, "TEXT", "TEXT", "UPC"), (1, 2, 6, None, "Star", "9"), (2, 1, 1, "A", "B", "C")],
                               "doc_id bigint, page_no int, row_no int, c0 string, c1 string, c2 string")
    got = T.named_by_first_row(df)
    assert got.columns == ["doc_id", "page_no", "row_no", "CELLS"]
    assert sorted((r.doc_id, r.page_no, r.row_no, r.CELLS) for r in got.collect()) == [
        (1, 1, 2, {"UPC": "4120", "TEXT": "Tree", "c2": "x"}), (1, 1, 3, {}), (1, 2, 6, {"TEXT": "Star", "UPC": "9"})]


def test_fl2658_and_pa1683_per_document_and_page(spark):
    cols = "doc_id bigint, page_no int, row_no int, `ITEM NO.` string, QTY string, `Unit Price` string, SubTotal string"
    df = spark.createDataFrame([(1, 1, 1, "A1", "2", "$1,000.5", "$9"), (1, 1, 2, None, "2", "1", "1"), (1, 2, 1, "B2", "3", "2", "6"),
                                (2, 1, 1, "C3", "4", "5", None), (None, None, 1, "D4", "1", "2", "3")], cols)
    got = T.fl2658(df)
    assert got.columns == ["doc_id", "page_no", "row_no", "Product", "Qty", "Unit Cost", "Ext Cost"]
    assert sorted((str(r.doc_id), r.page_no, r.row_no, r.Product, r.Qty, r["Unit Cost"]) for r in got.collect()) == [
        ("1", 1, 1, "A1", 2.0, 1000.5), ("1", 2, 1, "B2", 3.0, 2.0), ("None", None, 1, "D4", 1.0, 2.0)]
    three = df.drop("SubTotal")
    assert T.fl2658(three).count() == 0 and T.fl2658(three.drop("page_no")).count() == 0
    pa = spark.createDataFrame([(1, 1, 1, "x", "A1", "2", "$1.5", "$3"), (1, 2, 1, "x", "B1", "2", "n/a", "$1,000"), (1, 2, 2, "x", "B2", None, "1", "1")],
                               "doc_id bigint, page_no int, row_no int, TEXT string, `SUPPLIER #` string, QTY string, `PRICE/UN` string, AMOUNT string")
    assert sorted((r.page_no, r.row_no, r.Product, r["Unit Cost"], r["Ext Cost"]) for r in T.pa1683(pa).collect()) == [
        (1, 1, "A1", 1.5, 3.0), (2, 1, "B1", None, 1000.0)]


def test_rename_by_position_checks_count(spark):
    df = spark.createDataFrame([(1, 1, "a", "b")], "doc_id bigint, row_no int, x string, y string")
    assert T.rename_by_position(df, ["P", "Q"]).columns == ["doc_id", "row_no", "P", "Q"]
    try:
        T.rename_by_position(df, ["P"])
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_az1239_chooses_columns_per_document_and_page(spark):
    df = spark.createDataFrame([(1, 1, 1, "Tree lights", "AB12C", "12EaOnly", "1,234.5", "14814.0"),
                                (1, 2, 1, "CD34E", "Star", "6", "2.0", "12.0"),
                                (2, 1, 1, "12", "x", "1.5", "18.0", "EF56G"),
                                (3, 1, 1, "no item", "1", "2", "3", None),
                                (None, None, 1, "GH78", "n", "2", "3", "6")],
                               "doc_id bigint, page_no int, row_no int, c0 string, c1 string, c2 string, c3 string, c4 string")
    got = {(r["doc_id"], r["page_no"]): (r["Product"], r["Qty"], r["Unit Cost"], r["Ext Cost"]) for r in T.az1239(df).collect()}
    assert got == {(1, 1): ("AB12C", 12.0, 1234.5, 14814.0), (1, 2): ("CD34E", 6.0, 2.0, 12.0),
                   (2, 1): ("EF56G", 12.0, 1.5, 18.0), (None, None): ("GH78", 2.0, 3.0, 6.0)}


def test_nv0356_upc_column_and_fill_per_page(spark):
    cols = ("doc_id bigint, page_no int, row_no int, `Style description / Vendor style` string, `Ordered qty` string, "
            "`Unit cost` string, `Extended cost` string, `Unit retail` string, c8 string, c9 string")
    df = spark.createDataFrame([(1, 1, 1, None, None, None, None, None, "a", "UPC"),
                                (1, 1, 2, "AB12", "6", "$1.50", "$9.00", "3.99", "b", "4120"),
                                (2, 1, 1, None, None, None, None, None, "UPC", "z"),
                                (2, 1, 2, "CD34", "2", "$1.00", "$2.00", "3.99", "4121", "y"),
                                (2, 2, 1, None, "5", None, None, None, "UPC", None),
                                (2, 2, 2, "EF56", None, "$3.00", None, None, None, None)], cols)
    got = [(r["doc_id"], r["page_no"], r["Product"], r["Qty"], r["Ext Cost"], r["UPC"])
           for r in T.nv0356(df).orderBy("doc_id", "page_no", "row_no").collect()]
    assert got == [(1, 1, "AB12", 6.0, 9.0, "4120"), (2, 1, "CD34", 2.0, 2.0, "4121"), (2, 2, "EF56", 5.0, None, "UPC")]


def test_ma0603_retail_per_page(spark):
    df = spark.createDataFrame([(1, 2, 1, "4120", "Tree", "UNIT RETAIL", None), (1, 2, 2, None, None, "x", None),
                                (1, 2, 3, "4121", "Star", "9.99", "7"),
                                (1, 3, 1, "4122", "Owl", None, "UNIT RETAIL"), (1, 3, 2, None, None, "q", "x"),
                                (1, 3, 3, "4123", "Fox", "1", "5.55")],
                               "doc_id bigint, page_no int, row_no int, `UPC-A/EAN` string, `DESCRIPTION X` string, c string, d string")
    got = [(r["page_no"], r["DESCRIPTION"], r["Retail"]) for r in T.ma0603_retail(df).orderBy("page_no", "row_no").collect()]
    assert got == [(2, "Tree", "9.99"), (2, "Star", None), (3, "Owl", "5.55"), (3, "Fox", None)]


def test_fl4494_headers_per_table(spark):
    cols = "doc_id bigint, row_no int, SKU string, `Unit` string, `Unit.1` string, `Ord/` string, `Extended` string"
    rows = []
    for doc, third, fourth in ((1, "Retail", "Cost"), (2, "Cost", "Retail")):
        rows += [(doc, 1, "Description", third, fourth, "Pcs", "Cost"),
                 (doc, 2, "Tree lights A-B12", "9.99", "2.50", "4", "10.00"),
                 (doc, 3, "UPC 412345678901", None, None, None, None),
                 (doc, 4, None, None, None, None, None)]
    rows += [(3, 1, "Other", "Retail", "Cost", "Pcs", "Cost"), (3, 2, "X AB1", "1", "1", "1", "1")]
    got = {r["doc_id"]: r for r in T.fl4494(spark.createDataFrame(rows, cols)).collect()}
    assert set(got) == {1, 2}
    assert (got[1]["Product"], got[1]["UPC"], got[1]["Qty"], got[1]["Ext Cost"]) == ("AB12", "412345678901", 4.0, 10.0)
    assert (got[1]["Unit Cost"], got[1]["Unit Retail"]) == (2.5, "9.99")
    assert (got[2]["Unit Cost"], got[2]["Unit Retail"]) == (9.99, "2.50")


def test_ma0603_all_pages(spark):
    cols = ("doc_id bigint, page_no int, row_no int, `Style description / Vendor style` string, `Ordered qty` string, "
            "`Unit cost` string, `Extended cost` string, `UPC-A/EAN` string, `DESCRIPTION OF GOODS` string")
    rows = []
    for doc in (1, 2):
        rows += [(doc, 1, 1, "UPC-A/EAN", "Product", "Qty", "Unit Cost", "Ext Cost", "DESCRIPTION"),
                 (doc, 1, 2, "4120", f"AB{doc}", "EA 2", "$1.5", "$3.0", "Tree"),
                 (doc, 1, 3, "4121", None, None, None, None, "n"),
                 (doc, 2, 1, "CD9", "EA 6", "2.0", "12.0", "4122", "UNIT RETAIL"),
                 (doc, 2, 2, "not a style", "x", None, None, None, "n"),
                 (doc, 2, 3, "EF1", "1", "1", "1", "4123", "7.99"),
                 (doc, 3, 1, None, None, None, None, "4124", "Star"),
                 (doc, 3, 2, None, None, None, None, None, "UNIT RETAIL")]
    out = T.ma0603(spark.createDataFrame(rows, cols)).collect()
    got = {(r["doc_id"], r["page_no"], r["row_no"]): (r["Product"], r["Qty"], r["UPC"], r["DESCRIPTION"], r["Retail"]) for r in out}
    want = {}
    for doc in (1, 2):
        want |= {(doc, 1, 2): (f"AB{doc}", 2.0, "4120", "Tree", None), (doc, 1, 3): (f"AB{doc}", 2.0, "4121", "n", None),
                 (doc, 2, 1): ("CD9", 6.0, "4122", "UNIT RETAIL", "7.99"), (doc, 2, 3): ("EF1", 1.0, "4123", "7.99", None),
                 (doc, 3, 1): (None, None, "4124", "Star", None)}
    assert got == want

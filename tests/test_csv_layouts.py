import datetime as dt
import os
from decimal import Decimal

import pytest

from salesmart.sources.csv_layouts import combine_as_text, combine_layouts, explain_types, header_inventory, layouts, split_header


def write(folder, name, text, encoding="utf-8"):
    with open(os.path.join(folder, name), "w", encoding=encoding, newline="") as f:
        f.write(text)


@pytest.fixture
def folder(tmp_path):
    d = str(tmp_path)
    write(d, "1.csv", "Item Id,Name,Price\n1,lamp,2.50\n2,desk,10\n")
    write(d, "2.csv", "Price,item id,Brand\t\n7,3,acme\n,4,\n", "utf-8-sig")
    write(d, "3.csv", "Item Id,Name,Price\r\n5,\"rug, red\",0.125\r\n")
    write(d, "4.csv", "Brand,Sold On\nzeta,2024-01-31\n")
    write(d, "empty.csv", "")
    write(d, "header_only.csv", "Item Id,Colour\n")
    write(d, "other.txt", "not,a,part\n1,2,3\n")
    return d


def test_inventory_and_layouts(spark, folder):
    assert {os.path.basename(r.file) for r in header_inventory(spark, folder).collect()} == {"1.csv", "2.csv", "3.csv", "4.csv", "header_only.csv"}
    found = layouts(spark, folder)
    assert [(lay.names, len(lay.files)) for lay in found] == [
        (("Item_Id", "Name", "Price"), 2), (("Price", "item_id", "Brand"), 1), (("Brand", "Sold_On"), 1), (("Item_Id", "Colour"), 1)
    ]


def test_no_row_is_lost_and_types_fit(spark, folder):
    df = combine_layouts(spark, folder)
    assert df.columns == ["Item_Id", "Name", "Price", "Brand", "Sold_On", "Colour", "source_file"]
    assert dict(df.dtypes) == {
        "Item_Id": "int", "Name": "string", "Price": "decimal(38,10)", "Brand": "string", "Sold_On": "date", "Colour": "string", "source_file": "string"
    }
    rows = sorted(map(tuple, df.collect()), key=lambda r: (r[0] is None, r[0]))
    assert rows == [
        (1, "lamp", Decimal("2.5"), None, None, None, "1.csv"),
        (2, "desk", Decimal("10"), None, None, None, "1.csv"),
        (3, None, Decimal("7"), "acme", None, None, "2.csv"),
        (4, None, None, None, None, None, "2.csv"),
        (5, "rug, red", Decimal("0.125"), None, None, None, "3.csv"),
        (None, None, None, "zeta", dt.date(2024, 1, 31), None, "4.csv"),
    ]


@pytest.mark.parametrize(
    "values, want",
    [
        (["1", "-2", "+3"], "int"),
        (["1", "3000000000"], "bigint"),
        (["1", "99999999999999999999"], "decimal(38,10)"),
        (["1", "0.5"], "decimal(38,10)"),
        (["0", "00123"], "string"),
        (["1e3", "0.5"], "double"),
        (["0.12345678901"], "double"),
        (["NaN", "1.5"], "string"),
        (["true", "FALSE"], "boolean"),
        (["t", "f"], "string"),
        (["2024-01-31", "2024-2-1"], "date"),
        (["2024-01-31", "2024-01-31 10:00:00"], "timestamp_ntz"),
        (["2024-01-31", "2024-02-30"], "string"),
        (["2024", "2023"], "int"),
        (["1", "x"], "string"),
        ([None, None], "string"),
        ([None, "7"], "int"),
    ],
)
def test_promotion(spark, values, want):
    rows = explain_types(spark.createDataFrame([(v,) for v in values], "v string")).collect()
    assert [(r.column_name, r.data_type) for r in rows] == [("v", want)]
    assert rows[0].n_values == sum(v is not None for v in values)


def test_the_choice_is_explained(spark, folder):
    price = {r.column_name: r for r in explain_types(combine_as_text(spark, folder)).collect()}["Price"]
    assert price.n_values == 4 and price.fits["int"] == 2 and price.fits["decimal(38,10)"] == 4


@pytest.mark.parametrize("header", ["a,b,A", "a,,b", "a,source_file"])
def test_bad_headers_fail(header):
    with pytest.raises(ValueError):
        split_header(header)


def test_quoted_header():
    assert split_header('﻿"Sub, Category ",State\t\t\r') == ("Sub,_Category", "State")


def test_a_folder_without_headers_fails(spark, tmp_path):
    write(str(tmp_path), "1.csv", "")
    with pytest.raises(ValueError):
        combine_layouts(spark, str(tmp_path))


def test_a_large_part_has_one_header(spark, tmp_path):
    """Splits that do not begin a file give no header."""
    d = str(tmp_path)
    write(d, "1.csv", "id,v\n" + "".join(f"{k},{'x' * 50}\n" for k in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        assert [r.header for r in header_inventory(spark, d).collect()] == ["id,v"]
        df = combine_layouts(spark, d)
        assert df.count() == 20_000 and dict(df.dtypes)["id"] == "int"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)

"""Results worked out by hand on the small mart."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from salesmart.functions.measures import line_amount, with_sales_measures
from salesmart.operators import changelog
from salesmart.operators.changelog import Versions, delete_rows, update_rows
from salesmart.operators.joins import Dim, full_join_ordered, join_on, orphan_facts, star_join, unmatched_dims
from salesmart.operators.rollups import sum_by, totals_with_dimension
from tests.small_mart import AMOUNTS, members, sales, tickets


def amount():
    return line_amount(qty="Qty", price="UnitPrice", discount="DiscountPct", rate_unit="percent")


def test_line_amounts(spark):
    rows = sales(spark).select("SalesId", amount().alias("LineAmount"))
    assert {r.SalesId: str(r.LineAmount) for r in rows.collect()} == AMOUNTS
    assert rows.schema["LineAmount"].dataType.simpleString() == "decimal(18,2)"


def test_measures_are_rounded_once_at_the_end(spark):
    """Three lines of 1.25 x 0.33: 1.2375, not three times 0.41; rates of 1.5 % of 0.33."""
    lines = spark.createDataFrame([(D("1.25"), D("0.33"), D("0.33"), D("1.50"))] * 3, "q decimal(18,2), c decimal(18,2), a decimal(18,2), r decimal(5,2)")
    m = with_sales_measures(lines, "q", "c", "a", "r", rate_unit="percent")
    total = m.agg(F.sum("COGS").cast("decimal(38,2)").alias("cogs"), F.sum("Discount").alias("d")).first()
    assert total.cogs == D("1.24") and total.d == D("0.014850")
    part = with_sales_measures(lines, "q", "c", "a", F.lit("0.05"), rate_unit="fraction")
    assert part.agg(F.sum("Discount").alias("d")).first().d == D("0.0495")
    assert part.select("GrossMargin").first()[0] == D("-0.0825")


@pytest.mark.parametrize("how,count", [("inner", 6), ("left", 9), ("right", 8), ("full", 11)])
def test_join_row_counts(spark, how, count):
    assert join_on(sales(spark), members(spark), "CustomerId", how).count() == count


def test_full_join_keeps_both_keys_and_orders_dims_without_facts_last(spark):
    out = full_join_ordered(
        sales(spark).where("CustomerId IS NOT NULL"), members(spark), "CustomerId", "CustomerId", "SalesId", ["Product"], ["Name"],
        "FactCustomerId", "DimCustomerId",
    ).collect()
    assert [(r.SalesId, r.FactCustomerId, r.DimCustomerId) for r in out] == [
        (1, 1, 1), (4, 1, 1), (2, 2, 2), (5, 3, 3), (6, 5, 5), (7, 5, 5), (3, 70, None), (8, 71, None), (None, None, 4), (None, None, 6),
    ]


def test_orphans_and_unsold(spark):
    orphans = orphan_facts(sales(spark), members(spark), "CustomerId")
    assert sorted(r.SalesId for r in orphans.collect()) == [3, 8, 9]  # a null key is an orphan too
    assert orphans.columns == sales(spark).columns
    unsold = unmatched_dims(members(spark), sales(spark), "CustomerId")
    assert sorted(r.CustomerId for r in unsold.collect()) == [4, 6]


def test_where_filter(spark):
    out = sales(spark).filter((F.col("SalesDate") > F.lit("2023-05-03").cast("date")) & (F.col("Product") == "rug"))
    assert sorted(r.SalesId for r in out.collect()) == [4, 7, 9]


def _totals(spark, unknown=None):
    facts = sales(spark).withColumn("LineAmount", amount())
    return totals_with_dimension(
        facts, "CustomerId", "LineAmount", members(spark), "CustomerId", {"Name": "Name"}, unknown=unknown
    )


def test_totals_per_customer(spark):
    rows = _totals(spark).collect()
    assert {r.CustomerId: (r.Name, str(r.TotalSales)) for r in rows} == {
        1: ("Alder Works", "299.97"), 2: ("Birch & Co", "310.50"), 3: ("Cedar Lane", "589.95"), 5: ("Elm Street", "279.99"),
        70: (None, "50.00"), 71: (None, "155.25"), None: (None, "10.00"),
    }


def test_having_and_unknown_names(spark):
    out = _totals(spark, unknown={"Name": "(nobody)"}).filter(F.col("TotalSales") > 150)
    assert {r.CustomerId: r.Name for r in out.collect()} == {1: "Alder Works", 2: "Birch & Co", 3: "Cedar Lane", 5: "Elm Street", 71: "(nobody)"}


def _by_state(spark, later=False):
    facts = sales(spark, later).withColumn("LineAmount", amount())
    joined = facts.join(members(spark), "CustomerId", "inner")
    return {r.State: str(r.TotalSales) for r in sum_by(joined, ["State"], {"TotalSales": "LineAmount"}).collect()}


def test_by_state_before_and_after_an_insert(spark):
    assert _by_state(spark) == {"North": "610.47", "South": "589.95", "East": "279.99"}
    assert _by_state(spark, later=True) == {"North": "634.47", "South": "589.95", "East": "279.99"}


def test_update_right_sides_see_old_values(spark):
    updated = update_rows(
        tickets(spark),
        "sold_on BETWEEN DATE'2023-05-01' AND DATE'2023-05-03'",
        {"cut": "20.0", "paid": "seats * price * (1 - 20.0/100.0)", "price": "price + seats"},
    )
    got = {r.ticket: (r.price, r.paid) for r in updated.collect()}
    assert got["A"] == (14.5, pytest.approx(20.0)) and got["B"] == (13.0, pytest.approx(32.0)) and got["C"] == (41.0, pytest.approx(32.0))
    assert got["D"] == (10.0, 60.0) and got["E"] == (20.0, 57.0)  # a null date is not hit
    assert updated.schema == tickets(spark).schema


def test_delete_and_restore(spark):
    kept = delete_rows(tickets(spark), "seats <= 2")
    assert sorted(r.ticket for r in kept.collect()) == ["B", "D", "E"]
    t = [dt.datetime(2023, 6, d) for d in (1, 2, 3)]
    versions = Versions((t[0], t[1]))
    log = changelog.initial_log(tickets(spark), t[0]).unionByName(changelog.delete_log(tickets(spark), "seats <= 2", 1, t[1]))
    assert changelog.as_of(log, ["ticket"], versions).count() == 3
    log = log.unionByName(changelog.restore_rows(log, ["ticket"], versions, 0, t[2]))
    versions = versions.then(t[2])
    assert changelog.as_of(log, ["ticket"], versions).count() == 5
    assert [(r.version, r.num_inserted, r.num_deleted) for r in changelog.change_counts(log).collect()] == [(0, 5, 0), (1, 0, 2), (2, 2, 0)]


def test_star_join_case_clash_and_superseded_columns(spark):
    """``ItemID`` and ``ItemId`` differ in case only, which Spark takes for one name; ``drop`` gives way to geography."""
    lines = spark.createDataFrame([(1, 10, 100, 2), (2, 11, 101, 1)], "SaleId int, CustomerId int, ItemID int, Qty int")
    customer = spark.createDataFrame([(10, 1, "X", "Y"), (11, 2, "X", "Y")], "CustomerId int, CityId int, City string, State string")
    geo = spark.createDataFrame([(1, "Quill", "North"), (2, "Tarn", "East")], "CityId int, City string, State string")
    item = spark.createDataFrame([(100, "B1", "C1"), (101, "B2", "C2")], "ItemId int, Brand string, Category string")
    out = star_join(
        lines,
        [Dim(customer, "CustomerId"), Dim(geo, "CityId", drop=("City", "State")), Dim(item, "ItemID", "ItemId")],
    )
    assert sorted(out.columns) == sorted(["SaleId", "CustomerId", "ItemID", "Qty", "CityId", "City", "State", "Brand", "Category"])
    assert {r.SaleId: (r.City, r.Brand) for r in out.select("SaleId", "City", "Brand").collect()} == {1: ("Quill", "B1"), 2: ("Tarn", "B2")}

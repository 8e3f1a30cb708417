"""The sales mart over the driver tables.

Mapping (SURVEY 7.3): Sales = ``lineitem`` (Qty ``l_quantity``, sold amount
``l_extendedprice``, discount ``l_discount`` as a fraction, date
``l_shipdate``, item ``l_partkey``); Customer via ``orders``; Geography =
``nation`` / ``region``; Item = ``part`` (Brand ``p_brand``, Category
``p_type``, unit cost stand-in ``p_retailprice``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.measures import EXACT_TOTAL, MONEY, TOTAL, discount_amount, line_amount, money
from salesmart.operators.rollups import roll_up, sum_by
from salesmart.sources.tables import read_table


class Mart:
    """Lazy handles on the landed tables plus the shared derived frames."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def t(self, name: str) -> DataFrame:
        return read_table(self.spark, self.root, name)

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.t("lineitem")

    @cached_property
    def orders(self) -> DataFrame:
        return self.t("orders")

    @cached_property
    def customer(self) -> DataFrame:
        return self.t("customer")

    @cached_property
    def part(self) -> DataFrame:
        return self.t("part")

    @cached_property
    def nation(self) -> DataFrame:
        return self.t("nation")

    @cached_property
    def region(self) -> DataFrame:
        return self.t("region")

    @cached_property
    def supplier(self) -> DataFrame:
        return self.t("supplier")

    @cached_property
    def events(self) -> DataFrame:
        return self.t("events")

    # -- derived frames -------------------------------------------------
    def line_amounts(self) -> DataFrame:
        """Net line amount per lineitem row (TSQL line total)."""
        return self.lineitem.select(
            "l_orderkey",
            "l_partkey",
            line_amount("l_extendedprice", "l_discount").alias("LineAmount"),
        )

    def order_totals(self) -> DataFrame:
        """One row per order with its net amount (aggregated before any join)."""
        return sum_by(self.line_amounts(), ["l_orderkey"], {"TotalSales": "LineAmount"})

    def customer_totals(self) -> DataFrame:
        """One row per ordering customer key (``o_custkey``)."""
        return roll_up(self.order_totals(), "l_orderkey", self.orders, "o_orderkey", "o_custkey", ["TotalSales"])

    def nation_totals(self) -> DataFrame:
        """One row per nation key of the ordering customer."""
        return roll_up(
            self.customer_totals(), "o_custkey", self.customer, "c_custkey", "c_nationkey", ["TotalSales"]
        )

    def sales_by_nation(self) -> DataFrame:
        """Flagship: line amount summed by the customer's nation, largest first.

        lineitem -> sum by order -> orders -> sum by customer -> customer ->
        sum by nation -> nation.  Three shuffles, each on
        already reduced data after the first partial aggregate.
        """
        nation = self.nation.select("n_nationkey", "n_name")
        return (
            self.nation_totals()
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("n_name").alias("State"), "TotalSales")
            .orderBy(F.col("TotalSales").desc(), F.col("State"))
        )


def part_totals(m: Mart) -> DataFrame:
    """Per part key: Gross, Discount, quantity sum and line count, aggregated
    on the lineitem side before the join to ``part``."""
    return m.lineitem.groupBy("l_partkey").agg(
        F.sum(money("l_extendedprice")).cast(TOTAL).alias("Gross"),
        F.sum(discount_amount("l_extendedprice", "l_discount")).cast(EXACT_TOTAL).alias("Discount"),
        F.sum(money("l_quantity")).cast(TOTAL).alias("Qty"),
        F.sum("l_quantity").alias("QtyD"),
        F.count(F.lit(1)).alias("Lines"),
    )


def part_measures(m: Mart) -> DataFrame:
    """Per part: the totals above plus COGS = Qty * unit cost and the item attributes.

    COGS per line is Qty*Cost with one cost per part, so the exact decimal sum
    over a part's lines equals Cost * (sum of Qty); both stay unrounded.
    """
    part = m.part.select("p_partkey", "p_brand", "p_type", "p_retailprice")
    return part_totals(m).join(part, F.col("l_partkey") == F.col("p_partkey")).withColumn(
        "COGS", (F.col("Qty") * F.col("p_retailprice").cast(MONEY)).cast(EXACT_TOTAL)
    )

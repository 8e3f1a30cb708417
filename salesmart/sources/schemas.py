"""Declared schemas of the source's tables, as StructType constants.

Fixed values: column names, types and nullability as declared by the source
(``varchar(n)`` / ``nvarchar(n)`` become string; ``uniqueidentifier`` becomes
a string holding a hash key; ``datetime2`` becomes timestamp_ntz).
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I = T.StringType(), T.IntegerType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


DIM_CUSTOMER = T.StructType(
    [
        _f("CustomerId", _I, False),
        _f("Name", _S, False),
        _f("City", _S, False),
        _f("State", _S, False),
        _f("Segment", _S, False),
    ]
)

FACT_SALES = T.StructType(
    [
        _f("SalesId", _I, False),
        _f("CustomerId", _I, True),
        _f("SalesDate", T.DateType(), False),
        _f("Product", _S, False),
        _f("Qty", _I, False),
        _f("UnitPrice", T.DecimalType(18, 2), False),
        _f("DiscountPct", T.DecimalType(5, 2), False),
    ]
)

SALES = T.StructType(
    [
        _f("order_id", _S),
        _f("order_date", T.DateType()),
        _f("customer_id", _S),
        _f("product_id", _S),
        _f("qty", _I),
        _f("unit_price", T.DoubleType()),
        _f("discount_percent", T.DoubleType()),
        _f("gross_sales", T.DoubleType()),
    ]
)

DIM_ITEM = T.StructType(
    [
        _f("Item_SurrogateKey", _S, False),
        _f("Item_Id", _I, False),
        _f("Name", _S, False),
        _f("Brand_Id", _I, False),
        _f("Category_Id", _I, False),
        _f("Sub_Category_Id", _I, False),
        _f("Brand", _S, False),
        _f("Category", _S, False),
        _f("Sub_Category", _S, False),
        _f("Valid_Start_Date", T.TimestampNTZType(), False),
        _f("Valid_End_Date", T.TimestampNTZType(), True),
    ]
)

SALES_FACT = T.StructType(
    [
        _f("Order_No", _I, False),
        _f("Item_ID", _I, False),
        _f("Sales_Date", T.TimestampNTZType(), False),
        _f("Customer_Id", _I, False),
        _f("City_Id", _I, False),
        _f("Qty", T.DecimalType(18, 10), False),
        _f("Price", T.DecimalType(18, 10), False),
        _f("COGS", T.DecimalType(18, 10), False),
        _f("Discount_Percent", T.DecimalType(18, 10), False),
        _f("Item_SurrogateKey", _S, True),
    ]
)

TABLES = {
    "dim_customer": DIM_CUSTOMER,
    "fact_sales": FACT_SALES,
    "sales": SALES,
    "dim_item": DIM_ITEM,
    "sales_fact": SALES_FACT,
}

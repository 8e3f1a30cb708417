"""A small invented mart whose results can be worked out by hand (test fixtures only).

Members 1 to 6 of the dimension; member 4 has no sale, member 6 has none either.
Sales 3 and 8 name members that are not in the dimension (70, 71), sale 9 names none.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

MEMBERS_SCHEMA = "CustomerId int, Name string, City string, State string, Segment string"
MEMBERS = [
    (1, "Alder Works", "Quill", "North", "Trade"),
    (2, "Birch & Co", "Ferrow", "North", "Home"),
    (3, "Cedar Lane", "Marsk", "South", "Home"),
    (4, "Dogwood Ltd", "Marsk", "South", "Trade"),
    (5, "Elm Street", "Tarn", "East", "Home"),
    (6, "Fir Supply", "Tarn", "East", "Trade"),
]

SALES_SCHEMA = "SalesId int, CustomerId int, SalesDate date, Product string, Qty int, UnitPrice decimal(18,2), DiscountPct decimal(5,2)"


def _day(n):
    return dt.date(2023, 5, n)


SALES = [
    (1, 1, _day(2), "lamp", 4, D("25.00"), D("10.00")),  # 90.00
    (2, 2, _day(2), "desk", 1, D("310.50"), D("0.00")),  # 310.50
    (3, 70, _day(3), "lamp", 2, D("25.00"), D("0.00")),  # 50.00
    (4, 1, _day(4), "rug", 3, D("79.99"), D("12.50")),  # 239.97 * 0.875 = 209.97375 -> 209.97
    (5, 3, _day(5), "desk", 2, D("310.50"), D("5.00")),  # 589.95
    (6, 5, _day(5), "lamp", 10, D("25.00"), D("20.00")),  # 200.00
    (7, 5, _day(6), "rug", 1, D("79.99"), D("0.00")),  # 79.99
    (8, 71, _day(7), "desk", 1, D("310.50"), D("50.00")),  # 155.25
    (9, None, _day(8), "rug", 1, D("10.00"), D("0.00")),  # 10.00
]
AMOUNTS = {1: "90.00", 2: "310.50", 3: "50.00", 4: "209.97", 5: "589.95", 6: "200.00", 7: "79.99", 8: "155.25", 9: "10.00"}
LATER_SALE = (10, 2, _day(9), "lamp", 1, D("25.00"), D("4.00"))  # 24.00

TICKETS_SCHEMA = "ticket string, sold_on date, seats int, price double, cut double, paid double"
TICKETS = [
    ("A", _day(1), 2, 12.5, 0.0, 25.0),
    ("B", _day(2), 5, 8.0, 10.0, 36.0),
    ("C", _day(3), 1, 40.0, 25.0, 30.0),
    ("D", _day(4), 6, 10.0, 0.0, 60.0),
    ("E", None, 3, 20.0, 5.0, 57.0),
]


def members(spark):
    return spark.createDataFrame(MEMBERS, MEMBERS_SCHEMA)


def sales(spark, later=False):
    return spark.createDataFrame(SALES + ([LATER_SALE] if later else []), SALES_SCHEMA)


def tickets(spark):
    return spark.createDataFrame(TICKETS, TICKETS_SCHEMA)

"""Hand-made CRM fixture (invented names) with the edge rows the analyses
must handle:

* product spelled wrong (``AlphaPlus``), product NULL, product unknown
* account NULL on a won deal; account unknown (``Zeta Corp``)
* account with NULL office_location (``Dune LLC``)
* agent missing from teams (``Ghost Agent``)
* open deals (no close date / value); a lost deal with value 0
* two won deals of one agent on one day that cross a threshold together
* two products of one agent in one month; the same product in two months,
  with a month without deals in between
* a month of revenue 0 followed by another month (growth NULL)
* the same calendar month in two years
* two agents with equal revenue; six agents with revenue (6 mod 4 = 2)
* a home region with exactly one account (stdev NULL)
* averages of days that are not whole
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from salescope.sources.crm import (
    ACCOUNTS_SCHEMA,
    PRODUCTS_SCHEMA,
    SALES_SCHEMA,
    TEAMS_SCHEMA,
    model_from_frames,
)

D = dt.date

TEAMS = [
    ("Avery Stone", "Mgr One", "East"),
    ("Blake Reed", "Mgr One", "East"),
    ("Casey Hart", "Mgr Two", "West"),
    ("Drew Lane", "Mgr Two", "West"),
    ("Ellis Ford", "Mgr Three", "North"),
    ("Finley Moss", "Mgr Three", "North"),
]

PRODUCTS = [
    ("Alpha Basic", "Alpha", 100),
    ("Alpha Plus", "Alpha", 500),
    ("Beta One", "Beta", 1000),
]

ACCOUNTS = [
    ("Acorn Ltd", "retail", 2001, Decimal("10.50"), 100, "Homeland", None),
    ("Birch Co", "retail", 1999, Decimal("20.25"), 200, "Farland", "Acorn Ltd"),
    ("Cedar Inc", "tech", 2010, Decimal("5.00"), 50, "Farland", None),
    ("Dune LLC", "tech", 2015, Decimal("7.75"), 70, None, None),
    ("Elm Group", "finance", 1990, Decimal("100.00"), 1000, "Otherland", None),
]

SALES = [
    ("o1", "Avery Stone", "Alpha Basic", "Acorn Ltd", "Won", D(2023, 1, 2), D(2023, 1, 10), 100),
    ("o2", "Avery Stone", "Alpha Plus", "Acorn Ltd", "Won", D(2023, 1, 5), D(2023, 1, 20), 300),
    ("o3", "Avery Stone", "Alpha Basic", "Birch Co", "Won", D(2023, 3, 1), D(2023, 3, 15), 200),
    ("o4", "Avery Stone", "Beta One", "Cedar Inc", "Lost", D(2023, 2, 1), D(2023, 2, 11), 0),
    ("o5", "Blake Reed", "Beta One", "Cedar Inc", "Won", D(2023, 1, 3), D(2023, 1, 10), 400),
    ("o6", "Blake Reed", "Beta One", "Cedar Inc", "Won", D(2023, 1, 4), D(2023, 1, 10), 400),
    ("o7", "Blake Reed", "Alpha Plus", "Elm Group", "Won", D(2024, 1, 15), D(2024, 1, 20), 150),
    ("o8", "Casey Hart", "Alpha Basic", None, "Won", D(2023, 2, 1), D(2023, 2, 3), 50),
    ("o9", "Casey Hart", "AlphaPlus", "Dune LLC", "Won", D(2023, 2, 5), D(2023, 2, 8), 250),
    ("o10", "Casey Hart", None, "Dune LLC", "Engaging", D(2023, 3, 1), None, None),
    ("o11", "Drew Lane", "Unknown Gadget", "Zeta Corp", "Lost", D(2023, 4, 1), D(2023, 4, 9), 0),
    ("o12", "Ghost Agent", "Beta One", "Acorn Ltd", "Won", D(2023, 5, 1), D(2023, 5, 4), 1001),
    ("o13", "Drew Lane", "Alpha Basic", "Elm Group", "Won", D(2023, 6, 1), D(2023, 6, 2), 101),
    ("o14", "Ellis Ford", "Alpha Basic", "Cedar Inc", "Won", D(2023, 6, 1), D(2023, 6, 3), 101),
    ("o15", "Finley Moss", "Alpha Basic", "Cedar Inc", "Prospecting", None, None, None),
    ("o16", "Ellis Ford", "Beta One", "Cedar Inc", "Won", D(2023, 5, 1), D(2023, 5, 2), 0),
]

REPAIR = {"AlphaPlus": "Alpha Plus"}


def frames(spark):
    return (
        spark.createDataFrame(SALES, SALES_SCHEMA),
        spark.createDataFrame(TEAMS, TEAMS_SCHEMA),
        spark.createDataFrame(PRODUCTS, PRODUCTS_SCHEMA),
        spark.createDataFrame(ACCOUNTS, ACCOUNTS_SCHEMA),
    )


def build_model(spark, repaired: bool = True):
    """The fixture as a model; ``repaired`` applies the product repair first."""
    from salescope.operators.quality import repair_values

    sales, teams, products, accounts = frames(spark)
    if repaired:
        sales = repair_values(sales, "product", REPAIR)
    return model_from_frames(sales, teams, products, accounts)

from __future__ import annotations

import datetime as dt
import decimal

import pytest

from tariffmart.schemas import SCHEMAS
from tariffmart.session import local_session

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 2, 1)


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=4, partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def d(text: str | None) -> dt.date | None:
    return None if text is None else dt.date.fromisoformat(text)


def n(value) -> decimal.Decimal | None:
    return None if value is None else decimal.Decimal(str(value))


@pytest.fixture(scope="session")
def frames(spark):
    """Builders of small typed tables."""

    class Frames:
        def prices(self, *rows):
            """(id, sku, price, start, end[, created_at]) on one region and channel."""
            data = [
                (i, sku, "NE", "ONLINE", n(price), "USD", d(start), d(end), "SYS", rest[0] if rest else T0)
                for i, sku, price, start, end, *rest in rows
            ]
            return spark.createDataFrame(data, SCHEMAS["fact_price_history"])

        def staged_prices(self, *rows):
            """(sku, price, start, end[, currency[, region]])"""
            data = []
            for sku, price, start, end, *rest in rows:
                currency = rest[0] if rest else "USD"
                region = rest[1] if len(rest) > 1 else "NE"
                data.append((sku, region, "ONLINE", n(price), currency, d(start), d(end), "SYS", T0))
            return spark.createDataFrame(data, SCHEMAS["stg_price_history"])

        def discounts(self, *rows):
            """(id, sku, type, value, start, end)"""
            data = [(i, sku, "NE", "ONLINE", kind, n(value), d(start), d(end), T0) for i, sku, kind, value, start, end in rows]
            return spark.createDataFrame(data, SCHEMAS["fact_discount_events"])

        def staged_discounts(self, *rows):
            """(sku, type, value, start, end)"""
            data = [(sku, "NE", "ONLINE", kind, n(value), d(start), d(end), T0) for sku, kind, value, start, end in rows]
            return spark.createDataFrame(data, SCHEMAS["stg_discount_events"])

        def sales(self, *rows):
            """(id, day, sku, qty, net)"""
            data = [(i, d(day), sku, "NE", "ONLINE", qty, n(net), T0) for i, day, sku, qty, net in rows]
            return spark.createDataFrame(data, SCHEMAS["fact_sales"])

        def staged_sales(self, *rows):
            """(day, sku, qty, net[, region])"""
            data = [
                (d(day), sku, rest[0] if rest else "NE", "ONLINE", qty, n(net), "f.csv", T0) for day, sku, qty, net, *rest in rows
            ]
            return spark.createDataFrame(data, SCHEMAS["stg_sales"])

        def dims(self, skus=("A", "B", "C"), inactive=()):
            return {
                "dim_product": spark.createDataFrame(
                    [(s, s, "cat", "brand", s not in inactive, T0) for s in skus], SCHEMAS["dim_product"]
                ),
                "dim_region": spark.createDataFrame([("NE", "Northeast"), ("SE", "Southeast")], SCHEMAS["dim_region"]),
                "dim_channel": spark.createDataFrame([("ONLINE", "Online Store")], SCHEMAS["dim_channel"]),
            }

        def staging(self, sales=(), prices=(), discounts=()):
            return {
                "stg_sales": self.staged_sales(*sales),
                "stg_price_history": self.staged_prices(*prices),
                "stg_discount_events": self.staged_discounts(*discounts),
            }

    return Frames()

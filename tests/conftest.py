import os
import sys
import tempfile
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from retailpulse.session import build_session  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "retailpulse-tests",
        master="local[4]",
        shuffle_partitions=4,
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__driver__bindAddress="127.0.0.1",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="warehouse-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


T0 = datetime(2024, 3, 1, 12, 0)


def at(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


def money(x) -> Decimal:
    return Decimal(str(x))


def rows(df, *columns):
    columns = columns or df.columns
    return sorted([tuple(r[c] for c in columns) for r in df.collect()], key=repr)


SALES_DDL = (
    "window_start timestamp, window_end timestamp, revenue decimal(14,2), order_count bigint, "
    "item_count bigint, avg_order_value decimal(10,2)"
)


def sales_frame(spark, points):
    """Minute metrics from (minute, revenue, orders)."""
    data = [
        (at(m), at(m + 1), money(r), n, n, money(round(r / n, 2))) for m, r, n in points
    ]
    return spark.createDataFrame(data, SALES_DDL)


PRODUCT_DDL = (
    "product_id int, name string, category string, price decimal(10,2), stock_quantity int, reorder_threshold int"
)


def product_frame(spark, stock):
    """Products from (id, stock, threshold)."""
    data = [(i, f"p{i}", "c", money("1.00"), s, t) for i, s, t in stock]
    return spark.createDataFrame(data, PRODUCT_DDL)

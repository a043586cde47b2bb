"""Hand-made e-commerce tables with the boundary cases of the feature
contract (cutoff C = 2026-01-01, C + 90 days = 2026-04-01)."""

import datetime as dt
from decimal import Decimal

from pitstop.sources import schemas as S

C = dt.date(2026, 1, 1)


def ts(s):
    return dt.datetime.fromisoformat(s)


def edge_tables(spark):
    customers = spark.createDataFrame([
        (1, "a", "b", "1@x", dt.date(2025, 1, 1), "DE", True),
        (2, "a", "b", "2@x", dt.date(2025, 1, 1), "DE", True),
        (3, "a", "b", "3@x", dt.date(2025, 1, 1), "FR", None),
        (4, "a", "b", "4@x", dt.date(2025, 1, 1), "FR", False),
        (5, "a", "b", "5@x", dt.date(2025, 1, 1), "US", True),
        (6, "a", "b", "6@x", dt.date(2025, 1, 1), "US", True),
        (7, "a", "b", "7@x", None, "US", True),
        (8, "a", "b", "8@x", dt.date(2024, 6, 1), None, True),
        (9, "a", "b", "9@x", dt.date(2024, 6, 1), "DE", True),
        (10, "a", "b", "10@x", dt.date(2026, 2, 1), "DE", True),
    ], S.CUSTOMERS)
    orders = spark.createDataFrame([
        (101, 1, ts("2026-01-01 00:00:00"), "completed", Decimal("10.00")),
        (102, 2, ts("2026-01-01 00:00:01"), "completed", Decimal("20.00")),
        (103, 3, ts("2026-04-01 00:00:00"), "completed", Decimal("30.00")),
        (104, 4, ts("2026-04-01 00:00:01"), "completed", Decimal("40.00")),
        (105, 5, ts("2026-01-11 00:00:00"), "pending", Decimal("50.00")),
        (106, 6, None, "completed", Decimal("60.00")),
        (108, 8, ts("2025-12-01 10:00:00"), "cancelled", Decimal("10.00")),
        (109, 9, ts("2025-11-30 23:59:59"), "completed", Decimal("5.50")),
    ], S.ORDERS)
    items = spark.createDataFrame([
        (1, 101, 7, 1, Decimal("10.00")),
        (2, 102, 7, 1, Decimal("20.00")),
        (3, 108, 3, 1, Decimal("5.00")),
        (4, 108, 3, 1, Decimal("5.00")),     # duplicate (order, product) row
    ], S.ORDER_ITEMS)
    return customers, orders, items


EXPECTED = {
    # customer: (order_count, total_spend, distinct_products, recency, tenure, next90, churned)
    1: (1, 10.0, 1, 0, 365, 0, 1),
    2: (0, 0.0, 0, 9999, 365, 1, 0),
    3: (0, 0.0, 0, 9999, 365, 1, 0),
    4: (0, 0.0, 0, 9999, 365, 0, 1),
    5: (0, 0.0, 0, 9999, 365, 0, 1),
    6: (0, 0.0, 0, 9999, 365, 0, 1),
    7: (0, 0.0, 0, 9999, None, 0, 1),
    8: (1, 10.0, 1, 31, 579, 0, 1),
    9: (1, 5.5, 0, 32, 579, 0, 1),
    10: (0, 0.0, 0, 9999, -31, 0, 1),
}

"""Explicit schemas of the event payload and of the eight retail tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

MONEY = DecimalType(12, 2)
PRICE = DecimalType(10, 2)
MINUTE_REVENUE = DecimalType(14, 2)
ALERT_VALUE = DecimalType(14, 4)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


ORDER_LINE = _struct(
    product_id=IntegerType(),
    product_name=StringType(),
    category=StringType(),
    quantity=IntegerType(),
    unit_price=PRICE,
    line_total=MONEY,
)

ORDER_EVENT = _struct(
    order_id=StringType(),
    customer_id=StringType(),
    order_timestamp=TimestampType(),
    total_amount=MONEY,
    item_count=IntegerType(),
    status=StringType(),
    items=ArrayType(ORDER_LINE),
)

# An event missing one of these cannot be stored and goes to quarantine.
REQUIRED_ORDER_FIELDS = (
    "order_id",
    "customer_id",
    "order_timestamp",
    "total_amount",
    "item_count",
)

PRODUCTS = _struct(
    product_id=IntegerType(),
    name=StringType(),
    category=StringType(),
    price=PRICE,
    stock_quantity=IntegerType(),
    reorder_threshold=IntegerType(),
    popularity_weight=DecimalType(5, 2),
    source=StringType(),
    image_url=StringType(),
    description=StringType(),
    rating_rate=DecimalType(3, 2),
    rating_count=IntegerType(),
    created_at=TimestampType(),
    updated_at=TimestampType(),
)

ORDERS = _struct(
    order_id=StringType(),
    customer_id=StringType(),
    order_timestamp=TimestampType(),
    total_amount=MONEY,
    item_count=IntegerType(),
    status=StringType(),
    inserted_at=TimestampType(),
)

ORDER_ITEMS = _struct(
    order_id=StringType(),
    product_id=IntegerType(),
    quantity=IntegerType(),
    unit_price=PRICE,
    line_total=MONEY,
)

INVENTORY_LOG = _struct(
    product_id=IntegerType(),
    change_type=StringType(),
    quantity_change=LongType(),
    stock_after=IntegerType(),
    event_timestamp=TimestampType(),
)

SALES_METRICS = _struct(
    window_start=TimestampType(),
    window_end=TimestampType(),
    revenue=MINUTE_REVENUE,
    order_count=LongType(),
    item_count=LongType(),
    avg_order_value=PRICE,
)

PRODUCT_SALES_METRICS = _struct(
    window_start=TimestampType(),
    window_end=TimestampType(),
    product_id=IntegerType(),
    units_sold=LongType(),
    revenue=MONEY,
)

MINUTE_SKETCHES = _struct(window_start=TimestampType(), window_end=TimestampType(), orders=BinaryType(), lags=BinaryType())

# What a producer says of an alert.
ALERT = _struct(
    alert_type=StringType(),
    severity=StringType(),
    entity_type=StringType(),
    entity_id=StringType(),
    message=StringType(),
    detected_value=ALERT_VALUE,
    expected_low=ALERT_VALUE,
    expected_high=ALERT_VALUE,
    detected_at=TimestampType(),
    resolved=BooleanType(),
)

ALERTS = StructType([StructField("alert_id", LongType()), *ALERT.fields])

RESOLUTIONS = _struct(alert_id=LongType(), resolved_at=TimestampType())

KPI_THRESHOLDS = _struct(
    metric_name=StringType(),
    description=StringType(),
    warning_threshold=ALERT_VALUE,
    critical_threshold=ALERT_VALUE,
    comparison_operator=StringType(),
    window_minutes=IntegerType(),
    enabled=BooleanType(),
)

TABLES = {
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "inventory_log": INVENTORY_LOG,
    "sales_metrics": SALES_METRICS,
    "product_sales_metrics": PRODUCT_SALES_METRICS,
    "alerts": ALERTS,
    "kpi_thresholds": KPI_THRESHOLDS,
}

# The five rules a new installation starts with.
SEED_RULES = [
    ("revenue_per_5min", "Total revenue in last 5 minutes", "200.00", "50.00", "<", 5),
    ("orders_per_5min", "Order count in last 5 minutes", "10.00", "2.00", "<", 5),
    ("low_stock_count", "Products at/below reorder point", "5.00", "15.00", ">", 1),
    ("avg_order_value", "Rolling average order value (5m)", "30.00", "10.00", "<", 5),
    ("revenue_drop_pct", "Revenue % drop vs prior 5m window", "30.00", "60.00", ">", 5),
]

PRODUCT_DOCUMENT = _struct(
    id=IntegerType(),
    title=StringType(),
    price=DoubleType(),
    category=StringType(),
    description=StringType(),
    image=StringType(),
    rating=_struct(rate=DoubleType(), count=IntegerType()),
)

CART_DOCUMENT = _struct(
    id=IntegerType(),
    products=ArrayType(_struct(productId=IntegerType(), quantity=IntegerType())),
)

"""Canonical table layouts."""

from __future__ import annotations

from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructField, StructType


def _layout(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


_TEXT, _DATE, _REAL, _INT = StringType(), DateType(), DoubleType(), IntegerType()

SALES_LINES = _layout(
    company=_TEXT, invoice_no=_TEXT, invoice_date=_DATE, customer=_TEXT, sales_rep=_TEXT,
    item_id=_TEXT, qty=_REAL, unit_price=_REAL, discount=_REAL, net_amount=_REAL,
    tax_amount=_REAL, gross_amount=_REAL, site=_TEXT,
)
PURCHASE_LINES = _layout(
    company=_TEXT, site=_TEXT, invoice_date=_DATE, supplier=_TEXT, currency=_TEXT,
    status=_TEXT, item_id=_TEXT, qty=_REAL, unit_price=_REAL, net_amount=_REAL,
)
DAILY_PURCHASES = _layout(
    invoice_date=_DATE, supplier=_TEXT, item_id=_TEXT, qty=_REAL, last_price=_REAL,
)
CALENDAR_EVENTS = _layout(name=_TEXT, start_date=_DATE, end_date=_DATE)
FORECAST_DETAIL = _layout(
    item_id=_TEXT, year=_INT, month=_INT, qty_forecast=_REAL, revenue_forecast=_REAL,
)

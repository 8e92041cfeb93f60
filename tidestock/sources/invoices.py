"""Sales and purchase invoice lines."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestock.schemas import SALES_LINES


def discount_total(columns: Sequence[str]) -> Column:
    """Sum of the discount columns; one NULL makes the total NULL."""
    return reduce(add, [F.col(c) for c in columns])


def sales_lines(details: DataFrame, discount_columns: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """The 13 canonical columns from invoice detail rows with split discounts.

    No ordering is applied: the next step is an aggregate, where order has no meaning.
    """
    wide = details.withColumn("discount", discount_total(discount_columns))
    return wide.select(*SALES_LINES.names, *extra)


def purchase_lines(header: DataFrame, detail: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Purchase header joined to its lines on invoice number and company."""
    joined = header.join(detail, ["invoice_no", "company"], "inner")
    return joined.select(
        "company", "site", "invoice_date", "supplier", "currency", "status",
        "item_id", "qty", "unit_price", "net_amount", *extra,
    )

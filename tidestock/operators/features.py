"""Calendar, mean, lag, event and scaled features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidestock.functions.dates import calendar_fields, cycle
from tidestock.functions.numeric import divide_or
from tidestock.operators.encoding import label_encode
from tidestock.operators.outliers import masked_cap
from tidestock.operators.windows import chunked_lags, group_means, past_means
from tidestock.session import staged_lean

# Model inputs and target.
FEATURES = [
    "day", "year", "weekday", "item_id", "qty_mean_item", "qty_mean_item_month",
    "qty_lag_1", "month", "qty_lag_7", "quarter",
]
TARGET = "qty"
LAGS = {"qty_lag_1": 1, "qty_lag_7": 7}
EVENT_FEATURES = [
    "qty", "discount_pct", "is_fast", "is_feast_1", "is_feast_2", "is_summer",
    "month_sin", "month_cos", "weekday_sin", "weekday_cos",
]


def date_features(df: DataFrame, date: str = "invoice_date") -> DataFrame:
    return df.withColumns(calendar_fields(F.col(date)))


def mean_features(df: DataFrame, leak_free: bool = False) -> DataFrame:
    """Item mean and item-by-calendar-month mean, over all rows of the table.

    With ``leak_free`` only rows before each one count, in (date, site) order, so that neither its own
    quantity nor the future is in its inputs; null where there are none.
    """
    names = "item_id", "month", "qty", "qty_mean_item", "qty_mean_item_month"
    if leak_free:
        return past_means(df, *names, ["invoice_date", "site"], F.trunc("invoice_date", "month"))
    return group_means(df, *names)


def lag_features(df: DataFrame) -> DataFrame:
    """Quantity of the previous and the 7th previous row of the item, in (date, site) order.

    Lags count rows, not calendar days. The site makes the order total within a day.
    """
    month = F.trunc("invoice_date", "month")
    return chunked_lags(df, ["item_id"], ["invoice_date", "site"], "qty", LAGS, month)


def encode_labels(df: DataFrame) -> DataFrame:
    codes = {"site": "site_code", "item_id": "item_code", "invoice_date": "date_code"}
    return label_encode(df, codes)


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows without NULL in any column, or in the given ones."""
    return df.dropna("any", subset=list(subset) if subset else None)


def feature_table(daily: DataFrame, leak_free: bool = False) -> DataFrame:
    """Calendar, label codes, means and lags; rows with any NULL are dropped.

    With ``leak_free``, means are those of earlier rows; an item's first row in a calendar month takes the
    mean of all its earlier rows. ``daily`` is read by several branches: pass a staged table.

    Means and lags are made and written first, as they shuffle all rows: so these are narrow, and the shuffle
    files of one step go before the next one's come. Calendar and codes are attached to the rows that have both.
    """
    dated = date_features(daily)
    means = mean_features(dated.select(*daily.columns, *({"month"} - set(daily.columns))), leak_free)
    if leak_free:
        means = means.withColumn("qty_mean_item_month", F.coalesce("qty_mean_item_month", "qty_mean_item"))
    lagged = staged_lean(lag_features(staged_lean(means, "means")), "lags")
    coded = encode_labels(date_features(lagged))
    made = ["qty_mean_item", "qty_mean_item_month", *LAGS]
    ordered = [c for c in coded.columns if c not in (*dated.columns, *made)]
    return drop_incomplete(coded.select(*dated.columns, *ordered, *made))


def available_features(df: DataFrame, wanted: Sequence[str] = tuple(FEATURES)) -> list[str]:
    return [c for c in wanted if c in df.columns]


def select_features(df: DataFrame, target: str = TARGET) -> DataFrame:
    """The configured features that exist, and the target."""
    return df.select(*available_features(df), target)


def gap_fill_daily(
    series: DataFrame, by: Sequence[str] = (), measures: Sequence[str] = ("qty",), date: str = "invoice_date"
) -> DataFrame:
    """One row per day from the first to the last day of each series; absent days count 0.

    A series holds a row per day at most (where there are more, all stay). Each row is followed by the empty
    days up to the next one, so only the given rows are shuffled, never the days.
    """
    if not by:
        spans = series.agg(F.min(date).alias("_first"), F.max(date).alias("_last"))
        days = spans.where(F.col("_first").isNotNull()).select(
            F.explode(F.sequence("_first", "_last", F.expr("interval 1 day"))).alias(date)
        )
        filled = days.join(series, date, "left")
        return filled.select(date, *[F.coalesce(F.col(m), F.lit(0.0)).alias(m) for m in measures])
    following = F.lead(date).over(Window.partitionBy(*by).orderBy(date))
    until = F.greatest(F.col(date), F.date_sub(following, 1))  # its own day if the next row has it too, or there is none
    rows = series.where(F.col(date).isNotNull()).select(*by, date, *measures, until.alias("_until"))
    days = rows.select(
        *by, *measures, F.posexplode(F.sequence(F.col(date), F.col("_until"), F.expr("interval 1 day"))).alias("_place", date)
    )
    first = F.col("_place") == 0
    return days.select(*by, date, *[F.coalesce(F.when(first, F.col(m)), F.lit(0.0)).alias(m) for m in measures])


def event_days(events: DataFrame) -> DataFrame:
    """Distinct (name, day) pairs covered by inclusive spans; overlaps count once."""
    day = F.explode(F.sequence("start_date", "end_date", F.expr("interval 1 day")))
    return events.select("name", day.alias("_day")).distinct()


def event_flags(df: DataFrame, events: DataFrame, names: Sequence[str], date: str = "invoice_date") -> DataFrame:
    """Add a 0/1 column ``is_<name>`` per event.

    Spans are expanded to days and joined by equality, so no range comparison of every date
    with every span takes place; the expanded calendar has one row per covered day.
    """
    flags = [F.max((F.col("name") == n).cast("int")).alias(f"is_{n}") for n in names]
    calendar = event_days(events).groupBy("_day").agg(*flags)
    joined = df.join(calendar, F.col(date) == F.col("_day"), "left").drop("_day")
    return joined.withColumns({f"is_{n}": F.coalesce(f"is_{n}", F.lit(0)) for n in names})


def cyclic_features(df: DataFrame, date: str = "invoice_date") -> DataFrame:
    month_sin, month_cos = cycle(F.month(date), 12)
    weekday_sin, weekday_cos = cycle(F.weekday(date), 7)
    return df.withColumns({
        "month_sin": month_sin, "month_cos": month_cos,
        "weekday_sin": weekday_sin, "weekday_cos": weekday_cos,
    })


def discount_pct(discount: Column, net: Column) -> Column:
    """Discount as a share of the price before discount, in percent; 0 when that price is 0."""
    before = net + F.abs(discount)
    return divide_or(F.abs(discount) * 100.0, before, 0.0)


def event_feature_table(day_totals: DataFrame, events: DataFrame, names: Sequence[str], normal: Column) -> DataFrame:
    """Gap-free daily series with event flags, cyclic calendar and discount share.

    ``day_totals`` has qty, discount and net_amount per day; ``normal`` marks the days whose
    quantity is capped at the 99th percentile of such days.
    """
    filled = gap_fill_daily(day_totals, measures=["qty", "discount", "net_amount"])
    flagged = event_flags(filled, events, names)
    timed = cyclic_features(flagged)
    share = timed.withColumn("discount_pct", discount_pct(F.col("discount"), F.col("net_amount")))
    return masked_cap(share, normal)

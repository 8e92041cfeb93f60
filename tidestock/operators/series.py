"""Time-series operators over many daily series at once.

A series is all rows with one ``series_id`` after summing per day, so a series never holds
more rows than the calendar has days, however many raw rows the item has. Each series is packed
into one row of arrays; Spark aggregates, shuffles and spreads these rows and a task fits a batch
of them in numpy (:mod:`arma`, :mod:`seasonal`, :mod:`unitroot`).

Every method fits series of any length: short ones are held near their mean by penalties and by
autocovariances that fade with the number of days. A series without variation has nothing to fit
(``fitted`` is false) and is continued as it is. All recursions are stable: the weights of a
recursion are shrunk until its effect fades, so no value has to be clipped but for the floor 0.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidestock.operators import arma
from tidestock.operators.arma import fading
from tidestock.operators.metrics import regression_metrics
from tidestock.operators.seasonal import TrendsTimesSeasons
from tidestock.operators.unitroot import SIGNIFICANT, augmented_dickey_fuller_many

# Window, horizons and the critical value of the plain unit-root statistic.
DICKEY_FULLER_5PCT = -2.86
INTERVAL_80 = 1.2816
WINDOW = 30
N_TEST = 30
DAYS_PER_MONTH = 30
RIDGE = 1e-3
#: Changes from which the regression behind the unit-root statistic has a residual variance.
MIN_UNIT_ROOT = 3
#: Series that a task fits together, and numbers of one matrix of theirs.
BATCH, POINTS, CELLS = 1024, 1 << 15, 1 << 20


def as_series(daily: DataFrame, by: str | None = "item_id") -> DataFrame:
    """(series_id, invoice_date, qty), one row per series and day; ``by=None`` makes one total series."""
    series = F.lit("TOTAL") if by is None else F.col(by)
    rows = daily.select(series.alias("series_id"), "invoice_date", "qty").dropna(
        subset=["series_id", "invoice_date"]
    )
    return rows.groupBy("series_id", "invoice_date").agg(F.coalesce(F.sum("qty"), F.lit(0.0)).alias("qty"))


def stationarity(series: DataFrame) -> DataFrame:
    """Dickey-Fuller t-statistic of every gap-filled series and the differencing order.

    The regression of the daily change on the previous value needs only sums. Empty days enter
    them in closed form, so there is no row per empty day; all products are taken of values less
    the series mean, so large levels cost no digits.
    """
    whole = Window.partitionBy("series_id")
    ordered = whole.orderBy("invoice_date")
    days = F.datediff(F.max("invoice_date").over(whole), F.min("invoice_date").over(whole)) + 1
    rows = series.withColumn("mean", F.sum("qty").over(whole) / days).withColumn("z", F.col("qty") - F.col("mean"))
    gap = F.datediff("invoice_date", F.lag("invoice_date").over(ordered))
    before, empty = F.lag("z").over(ordered), -F.col("mean")
    # products of neighbouring days: two days with rows, or the empty ones between them
    product = F.when(gap == 1, F.col("z") * before).otherwise(
        before * empty + empty * F.col("z") + (gap - 2) * empty * empty
    )
    sums = rows.withColumns({"gap": gap, "product": product}).groupBy("series_id").agg(
        (F.datediff(F.max("invoice_date"), F.min("invoice_date"))).cast("double").alias("n"),
        F.count("*").alias("rows"), F.first("mean").alias("mean"),
        F.sum("z").alias("s"), F.sum(F.col("z") * F.col("z")).alias("ss"), F.sum("product").alias("cross"),
        F.min_by("z", "invoice_date").alias("first"), F.max_by("z", "invoice_date").alias("last"),
    )
    n, none = F.col("n"), F.col("n") + 1 - F.col("rows")
    s, ss = F.col("s") - none * F.col("mean"), F.col("ss") + none * F.col("mean") * F.col("mean")
    cross = F.coalesce("cross", F.lit(0.0))
    sx, sy = s - F.col("last"), s - F.col("first")
    sxx_raw = ss - F.col("last") * F.col("last")
    syy_raw = ss - F.col("first") * F.col("first")
    change = sy - sx
    sxx = sxx_raw - F.try_divide(sx * sx, n)
    sxy = (cross - sxx_raw) - F.try_divide(sx * change, n)
    syy = (syy_raw - 2.0 * cross + sxx_raw) - F.try_divide(change * change, n)
    slope = F.try_divide(sxy, sxx)
    variance = F.try_divide(syy - slope * sxy, n - 2.0)
    statistic = F.try_divide(slope, F.sqrt(F.try_divide(variance, sxx)))
    tiny = 1e-12 * F.greatest(ss, F.lit(1e-300))  # a perfect fit leaves only rounding
    enough = (n >= MIN_UNIT_ROOT) & (sxx > tiny) & (variance > tiny)
    return sums.select(
        "series_id", n.cast("int").alias("n_changes"), F.when(enough, statistic).alias("t_stat")
    ).withColumn("d", F.when(F.col("t_stat").isNotNull(), F.when(F.col("t_stat") < DICKEY_FULLER_5PCT, 0).otherwise(1)))


def augmented_stationarity(series: DataFrame, lags: int | None = None, choose: bool = True) -> DataFrame:
    """Augmented Dickey-Fuller test of every gap-filled series: changes used, lagged changes, statistic,
    p-value and differencing order.

    ``lags`` bounds the lagged changes (by default it grows with the fourth root of the number of days);
    ``choose`` takes the number with the least information criterion, else all of them are used.
    A series that is too short or without variation has no statistic.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, rows in _batches(batches):
            tested = augmented_dickey_fuller_many([(days, qty) for days, qty, _ in rows], lags, choose)
            n, used, statistic, p = zip(*[found or (None,) * 4 for found in tested])
            order = [None if v is None else int(v >= SIGNIFICANT) for v in p]
            columns = [(n, pa.int32()), (used, pa.int32()), (statistic, pa.float64()), (p, pa.float64()), (order, pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [names, *(pa.array(v, kind) for v, kind in columns)],
                names=["series_id", "n_changes", "lags", "t_stat", "p_value", "d"],
            )

    return packed_series(series).mapInArrow(run, "series_id string, n_changes int, lags int, t_stat double, p_value double, d int")


def future_days(series: DataFrame, days: int) -> DataFrame:
    """The next ``days`` calendar days of every series."""
    last = series.groupBy("series_id").agg(F.max("invoice_date").alias("_last"))
    ahead = F.explode(F.sequence(F.lit(1), F.lit(days)))
    return last.select("series_id", "_last", ahead.alias("step")).select(
        "series_id", "step", F.date_add("_last", F.col("step")).alias("forecast_date")
    )


# --- numpy helpers for one series ---------------------------------------------------------


def dense(days: np.ndarray, qty: np.ndarray, until: int) -> np.ndarray:
    """Daily values from the first day to ``until`` with 0 on empty days."""
    filled = np.zeros(until - days[0] + 1)
    filled[days - days[0]] = qty
    return filled


def lag_fits(y: np.ndarray, width: int, penalty: np.ndarray) -> np.ndarray:
    """Ridge regression of every day on the ``width`` days before it, 0 before the first; a row for each series.

    The rows of ``y`` end together and begin with ``width`` zeros at least. Moving both lags of a product by a day
    drops its last term, so all products follow from those with the newest lag.
    """
    days = y.shape[1]
    apart = np.stack([np.einsum("st,st->s", y[:, :days - k], y[:, k:]) for k in range(width + 1)], axis=1)
    last = y[:, ::-1]
    gram = np.zeros((len(y), width, width))
    gram[:, 0] = gram[:, :, 0] = apart[:, :width] - last[:, :1] * last[:, :width]
    for k in range(1, width):
        gram[:, k, 1:] = gram[:, k - 1, :-1] - last[:, k:k + 1] * last[:, 1:width]
    return np.linalg.solve(gram + penalty[:, None, None] * np.eye(width), apart[:, 1:, None])[:, :, 0]


# --- forecasts ------------------------------------------------------------------------------

FORECAST = "series_id string, step int, forecast_date date, qty_forecast double, fitted boolean"


Series = list[tuple[np.ndarray, np.ndarray, int]]
Fitted = tuple[np.ndarray, np.ndarray, list[np.ndarray]]


def packed_series(series: DataFrame) -> DataFrame:
    """(series_id, days, qty, until): one row for each series, days as ascending numbers.

    The last known day is the last row's, unless a column ``until`` names a later one. Fitting is heavy for
    few bytes, so the partition count is fixed: sized by bytes, a few tasks would get all series.
    """
    number = lambda c: F.datediff(c, F.lit("1970-01-01"))
    until = F.max(number("until")) if "until" in series.columns else F.max(number("invoice_date"))
    rows = F.array_sort(F.collect_list(F.struct(number("invoice_date").alias("day"), "qty")))
    packed = series.groupBy("series_id").agg(rows.alias("rows"), until.alias("until"))
    partitions = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return packed.select("series_id", F.col("rows.day").alias("days"), F.col("rows.qty").alias("qty"), "until").repartition(
        partitions, F.xxhash64("series_id")  # another key than the grouping's, whose exchange may be merged into few partitions
    )


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Series]]:
    """Names and values of some series at a time."""
    for whole in batches:
        for start in range(0, whole.num_rows, BATCH):
            part = whole.slice(start, BATCH)
            names, days, qty, until = (part.column(c) for c in ("series_id", "days", "qty", "until"))
            ends = np.cumsum(pc.list_value_length(days).to_numpy())[:-1]
            parts = (np.split(c.flatten().to_numpy(zero_copy_only=False).astype(kind), ends) for c, kind in ((days, np.int64), (qty, float)))
            yield names, list(zip(*parts, until.to_pylist()))


def _by_series(series: DataFrame, steps: int, fit: Callable[[Series], Fitted], extra: dict[str, str]) -> DataFrame:
    """Forecast rows of every series from ``fit`` of a batch.

    ``fit`` returns the paths, whether there was anything to fit, and the ``extra`` values, for each
    series or for each of its steps.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = np.arange(1, steps + 1, dtype=np.int32)
        for names, rows in _batches(batches):
            paths, fitted, values = fit(rows)
            n = len(rows)
            dates = (np.array([last for _, _, last in rows], np.int32)[:, None] + step).ravel()
            columns = [
                names.take(pa.array(np.repeat(np.arange(n), steps))), pa.array(np.tile(step, n)), pa.array(dates).cast(pa.date32()),
                pa.array(np.maximum(paths, 0.0).ravel(), from_pandas=True), pa.array(np.repeat(fitted, steps)),
            ]
            for value in values:
                columns.append(pa.array(np.repeat(value, steps) if value.ndim == 1 else value.ravel(), from_pandas=True))
            yield pa.RecordBatch.from_arrays(columns, names=["series_id", "step", "forecast_date", "qty_forecast", "fitted", *extra])

    schema = ", ".join([FORECAST, *[f"{name} {kind}" for name, kind in extra.items()]])
    return packed_series(series).mapInArrow(run, schema)


def _flat(rows: Series, steps: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Gap-filled values of every series, paths that go on with the last one, and which series vary."""
    filled = [dense(*row) for row in rows]
    paths = np.repeat([v[-1] for v in filled], steps).reshape(len(rows), steps)
    return filled, paths, np.array([np.ptp(v) > 0 for v in filled])


def _aligned(values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Series as rows of a matrix that end together, zeros in front, and their lengths."""
    length = np.array([len(v) for v in values])
    out = np.zeros((len(values), length.max()))
    for row, v in zip(out, values):
        row[len(row) - len(v):] = v
    return out, length


def _alike(own: np.ndarray, sizes: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Groups of series of similar size that take at most ``most`` numbers as a matrix, a series at least."""
    own = own[np.argsort(sizes[own], kind="stable")]
    start = 0
    while start < len(own):
        places = np.arange(1, len(own) - start + 1) * sizes[own[start:]]
        stop = start + max(int(np.searchsorted(places, most, side="right")), 1)
        yield own[start:stop]
        start = stop


def differencing(rows: Series) -> np.ndarray:
    """1 unless the augmented Dickey-Fuller test up to the last known day rejects a unit root, for each series."""
    whole = [
        (days, qty) if days[-1] >= until else (np.append(days, until), np.append(qty, 0.0)) for days, qty, until in rows
    ]
    return np.array([int(found is not None and found[3] >= SIGNIFICANT) for found in augmented_dickey_fuller_many(whole)])


def arima_forecast(series: DataFrame, steps: int) -> DataFrame:
    """ARIMA(5, d, 2) on gap-filled series, d by the augmented Dickey-Fuller test; floor 0, AIC per series."""
    def fit(rows: Series) -> Fitted:
        filled, paths, varies = _flat(rows, steps)
        d, aic = np.zeros(len(rows), np.int32), np.full(len(rows), np.nan)
        if varies.any():
            d[varies] = differencing([rows[k] for k in np.flatnonzero(varies)])
        for own in _alike(np.flatnonzero(varies), np.array([len(v) for v in filled]), CELLS):
            worked = [np.diff(filled[k]) if d[k] else filled[k] - filled[k].mean() for k in own]
            ahead, aic[own] = arma.paths(*_aligned(worked), steps)
            for k, path in zip(own.tolist(), ahead):
                paths[k] = filled[k][-1] + np.cumsum(path) if d[k] else path + filled[k].mean()
        return paths, varies, [d, aic]

    return _by_series(series, steps, fit, {"d": "int", "aic": "double"})


def seasonal_trend_forecast(series: DataFrame, steps: int) -> DataFrame:
    """Trend times yearly and weekly seasonality on days with rows, with an 80 % band; floor 0.

    The trend's unit is the longer of the history and the horizon, so that the penalty holds the slope of
    short histories.
    """
    def fit(rows: Series) -> Fitted:
        y = [np.maximum(qty, 0.0) for _, qty, _ in rows]
        paths, spread = np.repeat([v[-1] for v in y], steps).reshape(len(rows), steps), np.zeros(len(rows))
        varies = np.array([np.ptp(v) > 0 for v in y])
        for own in _alike(np.flatnonzero(varies), np.array([len(v) for v in y]), POINTS):
            days, _, until = zip(*[rows[k] for k in own])
            units = np.array([max(d[-1] - d[0], steps) for d in days])
            model = TrendsTimesSeasons(days, [y[k] for k in own], units)
            paths[own], spread[own] = model.at(np.array(until)[:, None] + np.arange(1, steps + 1)), model.spread
        band = INTERVAL_80 * spread[:, None]
        return paths, varies, [paths - band, np.maximum(paths, 0.0) + band]

    return _by_series(series, steps, fit, {"qty_lower": "double", "qty_upper": "double"})


def recursive_lag_forecast(series: DataFrame, steps: int, window: int = WINDOW) -> DataFrame:
    """Linear model on the last ``window`` days around the mean, each prediction feeding the next; floor 0."""
    def fit(rows: Series) -> Fitted:
        filled, paths, varies = _flat(rows, steps)
        sizes = np.array([len(v) for v in filled])
        for own in _alike(np.flatnonzero(varies), sizes + window, CELLS):
            values = [filled[k] for k in own]
            mean = np.array([v.mean() for v in values])[:, None]
            spread = np.array([np.ptp(v) for v in values])[:, None]
            scaled = [np.append(np.zeros(window), (v - m) / s) for v, m, s in zip(values, mean[:, 0], spread[:, 0])]
            matrix, _ = _aligned(scaled)
            weights = fading(lag_fits(matrix, window, RIDGE * sizes[own]))
            out = np.zeros((len(own), window + steps))
            out[:, :window] = matrix[:, -window:]
            for t in range(steps):
                out[:, window + t] = (weights * out[:, t:t + window][:, ::-1]).sum(axis=1)
            paths[own] = out[:, window:] * spread + mean
        return paths, varies, []

    return _by_series(series, steps, fit, {})


# --- back-tests -------------------------------------------------------------------------


def _last_day(series: DataFrame) -> DataFrame:
    return series.groupBy("series_id").agg(F.max("invoice_date").alias("_last"))


def _value_on(series: DataFrame, day: str, name: str) -> DataFrame:
    return series.select("series_id", F.col("invoice_date").alias(day), F.col("qty").alias(name))


def _zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0.0))


def naive_backtest(series: DataFrame, n_test: int = N_TEST, period: int = 7) -> DataFrame:
    """Metrics per series of repeating the last ``period`` training days over the last ``n_test`` days.

    Only the test days are laid out, and both values are fetched by key; empty days count 0, and
    so do days before the first one.
    """
    spans = _last_day(series)
    step = F.explode(F.sequence(F.lit(0), F.lit(n_test - 1)))
    days = spans.select("series_id", "_last", step.alias("_step")).select(
        "series_id",
        F.date_add("_last", F.col("_step") - F.lit(n_test - 1)).alias("_day"),
        F.date_add("_last", F.col("_step") % period - F.lit(n_test + period - 1)).alias("_source"),
    )
    rows = (
        days.join(_value_on(series, "_day", "_actual"), ["series_id", "_day"], "left")
        .join(_value_on(series, "_source", "_repeat"), ["series_id", "_source"], "left")
        .select("series_id", _zero("_actual").alias("actual"), _zero("_repeat").alias("prediction"))
    )
    return regression_metrics(rows, ["series_id"])


def model_backtest(series: DataFrame, forecast: Callable[[DataFrame, int], DataFrame], n_test: int = N_TEST) -> DataFrame:
    """Metrics per series of a forecaster fitted without the last ``n_test`` days, compared by date.

    The test days of a series and its path travel as one row each and are laid out after they have met.

    The training part ends exactly ``n_test`` days before the last day, sold or not; a series
    that starts later has nothing to train on and is forecast as 0.
    """
    last = F.max("invoice_date").over(Window.partitionBy("series_id"))
    known = series.withColumn("until", F.date_sub(last, n_test))
    by_day = lambda day, value: F.map_from_entries(F.collect_list(F.when(F.col(day).isNotNull(), F.struct(day, value))))
    tested = known.withColumn("_day", F.when(F.col("invoice_date") > F.col("until"), F.col("invoice_date")))
    actual = tested.groupBy("series_id").agg(F.max("until").alias("_until"), by_day("_day", "qty").alias("_actual"))
    ahead = forecast(known.where(F.col("invoice_date") <= F.col("until")), n_test)
    paths = ahead.groupBy("series_id").agg(by_day("forecast_date", "qty_forecast").alias("_path"))
    days = F.explode(F.sequence(F.date_add("_until", 1), F.date_add("_until", n_test), F.expr("interval 1 day")))
    rows = actual.join(paths, "series_id", "left").select("series_id", "_actual", "_path", days.alias("_day")).select(
        "series_id", F.coalesce(F.col("_actual")[F.col("_day")], F.lit(0.0)).alias("actual"),
        F.coalesce(F.col("_path")[F.col("_day")], F.lit(0.0)).alias("prediction"),
    )
    return regression_metrics(rows, ["series_id"])


# Task functions travel inside the job, so workers need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

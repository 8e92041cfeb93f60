"""Synthetic rows derived from a feature table, with hash-derived randomness.

Draws are made without replacement in hash order, so a set never has more rows than its
pool. A hash threshold keeps a small multiple of the wanted rows before they are ordered, so no
task merges a full set from every partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidestock.functions.dates import calendar_fields
from tidestock.functions.hashing import gaussian, row_key, uniform
from tidestock.functions.numeric import floor_zero, one_row
from tidestock.functions.quantiles import exact_quantiles
from tidestock.operators.encoding import label_encode
from tidestock.operators.features import drop_incomplete
from tidestock.operators.windows import adjacent_rows
from tidestock.session import staged_lean

# Mixed columns, noise share and set sizes.
NUMERIC = ["qty", "qty_mean_item", "qty_mean_item_month", "qty_lag_1", "qty_lag_7"]
NOISE_FACTOR = 0.02
SLACK, SPARE = 4, 200
#: Repeated hashes that are sent to all tasks.
MOST_ALIKE = 100_000
ROW_KEY = ("item_id", "invoice_date", "site")
NOT_NULL = ["qty_lag_1", "qty_lag_7", "qty_mean_item"]


@dataclass(frozen=True)
class Sizes:
    """Rows of the drawn sets and the share of noise."""

    interpolated: int = 300
    jittered: int = 300
    rare: int = 200
    noise_factor: float = NOISE_FACTOR


def _likely(df: DataFrame, draw: Column, n: int, fit: Column | None = None) -> DataFrame:
    """Rows that can be among the ``n`` smallest draws: about ``SLACK * n + SPARE``, whatever the table size.

    Where not all rows may be drawn, the aggregate ``fit`` counts those that may.
    """
    rows = one_row(df.agg((F.count("*") if fit is None else fit).alias("n")))["n"]
    return df.where(draw * rows < SLACK * n + SPARE)


def _recalendar(date: Column) -> dict[str, Column]:
    """Calendar fields of a moved row; the day number is kept from the source row."""
    fields = calendar_fields(date)
    del fields["day"]
    return fields


def _numeric_of(df: DataFrame) -> list[str]:
    return [c for c in NUMERIC if c in df.columns]


def gaussian_noise(df: DataFrame, factor: float = NOISE_FACTOR, key: Sequence[str] = ROW_KEY) -> DataFrame:
    """A copy of every row with normal noise of ``factor`` deviations per numeric column, floor 0."""
    columns = _numeric_of(df)
    spread = one_row(df.agg(*[F.stddev_samp(c).alias(c) for c in columns]))
    noisy = {
        c: floor_zero(F.col(c) + F.lit(factor) * spread[c] * gaussian(row_key(key), "noise-" + c))
        for c in columns
    }
    return df.withColumns(noisy).withColumn("source", F.lit("gaussian_noise"))


def interpolate_rows(df: DataFrame, n: int = Sizes.interpolated, key: Sequence[str] = ROW_KEY) -> DataFrame:
    """Points between neighbouring rows of an item, mixed with a weight in [0.2, 0.8).

    Only the items of likely rows are paired. The last row of an item has no neighbour, so the
    threshold is set by the number of rows less that of items.
    """
    columns = _numeric_of(df)
    draw = uniform(row_key(key), "interpolate-pick")
    pairs = F.count("*") - F.count_distinct("item_id")
    items = _likely(df, draw, n, pairs).select("item_id").distinct()
    pairs = adjacent_rows(df.join(items, "item_id", "left_semi"), [*columns, "invoice_date"])
    drawn = pairs.orderBy(draw, *key).limit(n)
    weight = F.lit(0.2) + F.lit(0.6) * uniform(row_key(key), "interpolate-weight")
    following = F.col("next_row")
    days = F.datediff(following["invoice_date"], "invoice_date")
    moved = drawn.withColumn("_weight", weight).withColumns({
        **{c: F.col("_weight") * F.col(c) + (1.0 - F.col("_weight")) * following[c] for c in columns},
        "invoice_date": F.date_add("invoice_date", F.floor(F.col("_weight") * days).cast("int")),
    })
    dated = moved.withColumns(_recalendar(F.col("invoice_date")))
    return dated.select(*df.columns).withColumn("source", F.lit("interpolation"))


def seasonal_jitter(df: DataFrame, n: int = Sizes.jittered, key: Sequence[str] = ROW_KEY) -> DataFrame:
    """Rows moved by -30 to 29 days with the quantity scaled by 0.95 to 1.05."""
    identity = row_key(key)
    draw = uniform(identity, "jitter-pick")
    drawn = _likely(df, draw, n).orderBy(draw, *key).limit(n)
    shift = F.floor(uniform(identity, "jitter-shift") * 60).cast("int") - 30
    scale = F.lit(0.95) + F.lit(0.10) * uniform(identity, "jitter-scale")
    moved = drawn.withColumns({
        "qty": floor_zero(F.col("qty") * scale),
        "invoice_date": F.date_add("invoice_date", shift),
    })
    fields = _recalendar(F.col("invoice_date"))
    if "date_code" in df.columns:
        fields["date_code"] = F.unix_date("invoice_date").cast("bigint") * 86400
    return moved.withColumns(fields).withColumn("source", F.lit("seasonal_jitter"))


def rare_mix(df: DataFrame, n: int = Sizes.rare, key: Sequence[str] = ROW_KEY) -> DataFrame:
    """Mixtures of two rows from the lowest and highest tenth, weight in [0.3, 0.7).

    Two hash orders of the pool are paired by rank; ranks run over the ``n`` drawn rows only.
    """
    columns = _numeric_of(df)
    tenth = one_row(exact_quantiles(df, "qty", {"low": 0.10, "high": 0.90}))
    pool = df.where((F.col("qty") <= tenth["low"]) | (F.col("qty") >= tenth["high"]))

    def draw(side: str) -> DataFrame:
        order = [uniform(row_key(key), f"rare-{side}"), *[F.col(k) for k in key]]
        picked = _likely(pool, order[0], n).orderBy(*order).limit(n)
        return picked.withColumn("_rank", F.row_number().over(Window.orderBy(*order)))

    other = draw("second").select("_rank", *[F.col(c).alias(f"_other_{c}") for c in columns])
    mixed = draw("first").join(other, "_rank").withColumn(
        "_weight", F.lit(0.3) + F.lit(0.4) * uniform(row_key(key), "rare-weight")
    )
    values = {
        c: floor_zero(F.col("_weight") * F.col(c) + (1.0 - F.col("_weight")) * F.col(f"_other_{c}"))
        for c in columns
    }
    enough = one_row(pool.limit(2).agg(F.count("*").alias("n")))["n"] >= 2
    rows = mixed.withColumns(values).where(enough)
    return rows.select(*df.columns).withColumn("source", F.lit("rare_mix"))


def union_augmented(df: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """Original rows and the four generated sets, aligned by column name."""
    parts = [
        gaussian_noise(df, sizes.noise_factor), interpolate_rows(df, sizes.interpolated),
        seasonal_jitter(df, sizes.jittered), rare_mix(df, sizes.rare),
    ]
    united = df.withColumn("source", F.lit("original"))
    for part in parts:
        united = united.unionByName(part, allowMissingColumns=True)
    return united


def dedupe_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def dedupe_wide(df: DataFrame, first: Sequence[str], among: DataFrame | None = None) -> DataFrame:
    """:func:`dedupe_rows` of wide rows of which few are repeated.

    Equal rows have equal hashes of the columns ``first``. So the hashes alone are shuffled, and only rows
    whose hash comes again are compared as a whole. Where that is too many rows, all are. ``among`` may be a
    table that holds all rows of ``df`` and is cheaper to read.
    """
    alike = F.xxhash64(*first)
    again = staged_lean((df if among is None else among).groupBy(alike.alias("_alike")).agg(F.count("*").alias("_n")).where("_n > 1").select("_alike"), "alike")
    many = again.limit(MOST_ALIKE + 1).count()
    if many > MOST_ALIKE:
        return dedupe_rows(df)
    if not many:
        return df
    keyed, again = df.withColumn("_alike", alike), F.broadcast(again)
    repeated = dedupe_rows(keyed.join(again, "_alike", "left_semi"))
    return keyed.join(again, "_alike", "left_anti").unionByName(repeated).drop("_alike")


def augmented_table(df: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """Union, new label codes, NULL rows and exact duplicates removed.

    The union has the labels of ``df`` and no others, and made rows keep those of their source row. So the
    codes are attached to ``df`` alone, before it feeds the five sets, and the union is neither written nor
    shuffled.
    """
    codes = {"site": "site_code", "item_id": "item_code"}
    coded = staged_lean(label_encode(df.drop(*codes.values()), codes), "coded")
    united = union_augmented(coded, sizes)
    ordered = united.select(*[c for c in united.columns if c not in codes.values()], *codes.values())
    # the made numbers take most of the time: hashes do without them, as equal rows are equal in the others, too,
    # and they come out of a generator of one row, so that the filter on them doesn't make them again
    plain = [c for c in ordered.columns if c not in NUMERIC]
    made = ordered.select(*plain, F.inline(F.array(F.struct(*_numeric_of(ordered))))).select(*ordered.columns)
    return dedupe_wide(drop_incomplete(made, NOT_NULL), plain, ordered)

"""Projections on click columns."""

from __future__ import annotations

import math
import re
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmill import schema as S


def header_name(raw: str) -> str:
    """Snake-case form of a raw CSV header."""
    return re.sub(r"[ ()/]+", "_", raw).strip("_").lower()


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[header_name(c) for c in df.columns])


def with_click_date(df: DataFrame, out: str = "click_date") -> DataFrame:
    """Fold year, month and day columns to one date."""
    return df.withColumn(out, F.make_date("year", "month", "day")).drop("year", "month", "day")


def region_label(country: Column) -> Column:
    return (
        F.when(country.isin(S.POLAND), S.REGIONS[0])
        .when(country.isin(S.OTHER_EU), S.REGIONS[1])
        .when(country.isin(S.EUROPE_NON_EU), S.REGIONS[2])
        .when(country.isin(S.OUTSIDE_EUROPE), S.REGIONS[3])
        .otherwise(S.REGIONS[4])
    )


def region_code(country: Column) -> Column:
    """Position of the region label in the fixed region list."""
    return (F.array_position(F.lit(S.REGIONS), region_label(country)) - 1).cast("int")


def code_name(code: Column, names: dict[int, str], default: str | None = None) -> Column:
    """Name of a code from a fixed table; ``default`` (or null) for an unknown code."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(names.items())])
    return F.coalesce(F.try_element_at(table, code), F.lit(default))


def product_letter(item: Column) -> Column:
    return F.substring(item, 1, 1)


def product_number(item: Column) -> Column:
    return F.substring(item, 2, 3)


def code_text(value: Column) -> Column:
    """Code as clean text: blanks trimmed and a trailing ``.0`` dropped."""
    return F.regexp_replace(F.trim(value.cast("string")), r"\.0$", "")


def above_average(price_2: Column) -> Column:
    """The raw flag codes yes as 1 and no as 2."""
    return price_2 == 1


def rule_text(left: Column, right: Column) -> Column:
    return F.concat_ws(" → ", left, right)


def clip_upper(value: Column, limit: int) -> Column:
    return F.least(value, F.lit(limit))


def weekday(date: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(date) - 1


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a value on a circle of ``period`` steps."""
    angle = value / F.lit(float(period)) * F.lit(2 * math.pi)
    return F.sin(angle), F.cos(angle)


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Scale to 0..1; the middle of the range when it has no width."""
    return F.coalesce(F.try_divide(value - low, high - low), F.lit(0.5))


def day_name(date: Column) -> Column:
    return F.date_format(date, "EEEE")

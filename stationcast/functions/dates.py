"""Calendar builders: the three feature windows, their offsets into a series, model dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import Params

# Window names in the order their values are concatenated into the 90 history features.
WINDOWS = ("pre", "his", "his_pre")


def window_bounds(pre_end: Column, p: Params) -> dict[str, tuple[Column, Column]]:
    """Half-open day ranges ``[from, to)`` of the three windows that end at ``pre_end`` (exclusive).

    ``pre``: the last ``window_len`` days; ``his``: the ``window_len`` days from one cycle ago;
    ``his_pre``: the ``window_len`` days before ``his``.
    """
    wl, cy = p.window_len, p.cycle_len
    return {
        "pre": (F.date_sub(pre_end, wl), pre_end),
        "his": (F.date_sub(pre_end, cy), F.date_sub(pre_end, cy - wl)),
        "his_pre": (F.date_sub(pre_end, cy + wl), F.date_sub(pre_end, cy)),
    }


def model_date_for_training(as_of: dt.date) -> dt.date:
    """Models trained on ``as_of`` are filed under the Sunday that ends its week."""
    return as_of + dt.timedelta(days=6 - as_of.weekday())


def model_date_for_forecast(as_of: dt.date) -> dt.date:
    """The forecast job on ``as_of`` reads the models filed under last week's Sunday."""
    return model_date_for_training(as_of - dt.timedelta(days=7))


def training_day(as_of: Column) -> Column:
    """``model_date_for_training`` of a column of run days."""
    return F.next_day(F.date_sub(as_of, 1), "SUN")


def forecast_day(as_of: Column) -> Column:
    """``model_date_for_forecast`` of a column of run days."""
    return training_day(F.date_sub(as_of, 7))


def next_monday(day: dt.date) -> dt.date:
    """First Monday strictly after ``day``."""
    return day + dt.timedelta(days=7 - day.weekday())

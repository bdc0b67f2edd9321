"""Job parameters: the as-of day, the fixed constants of the method and the fidelity flags.

Every date in the engine is derived from ``as_of`` (the day the forecast job runs, ``T``); nothing reads the
wall clock, so a run is reproducible.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class GbtParams:
    """Settings of the boosted trees, one model per horizon (``operators.boosting``)."""

    # Fixed values of the method (they must equal the published job's).
    max_iter: int = 1000
    max_depth: int = 15
    step_size: float = 0.1
    subsampling_rate: float = 0.7       # rows of a tree
    feature_fraction: float = 0.8       # features of a tree
    min_instances_per_node: int = 2
    min_split_loss: float = 1.1         # a split has to gain so much
    # What the published job's booster takes where nothing is set.
    l2: float = 1.0
    base_score: float = 0.5
    # Our own.
    max_bins: int = 256                 # quantile bins of a feature, 256 at most (a byte)
    chunk_rounds: int = 250             # rounds between two written states
    group_rows: int = 500_000           # a node with up to so many rows is finished in one task (below 1 kB a row); any value: the same trees
    seed: int = 7


@dataclass(frozen=True)
class Params:
    as_of: dt.date
    # Fixed values of the method (they must equal the published job for equal results).
    stable_days: int = 7          # gap between the end of the feature history and the first label day
    fr_len: int = 35              # forecast horizons, one model each
    window_len: int = 30          # length of each of the three history windows
    iter_count: int = 28          # label days per horizon in the training set
    cycle_len: int = 365          # year-ago offset of the seasonal windows
    stale_days: int = 90          # a series missing more than this many recent days is stale
    recent_days: int = 60         # trailing window of the class ratio and of the report
    cap_days: int = 35            # trailing window of the allocation cap
    cap_factor: float = 2.0       # an allocated forecast above cap_factor x trailing sum is flattened
    fc_report_days: int = 28      # forecast days shown in the report before the rest-of-week part
    # Base class: the forecast is modelled for it and allocated to every other class.
    base_deliver: str = "Self"
    base_ord: str = "Normal"
    # Partition names of the published source table.
    # Where the forecast job reads series; the training job reads another source (see SURVEY Q9).
    forecast_source: str = "station_ords_sta_dt"
    train_source: str = "station_ords_create_dt"
    date_type: str = "day"
    # Fidelity flags.
    align_city_by_date: bool = True     # Q2: False indexes the city series with the station's own offsets
    ratio_one_is_zero: bool = False     # Q4: True also zeroes a genuine ratio of exactly 1.0
    train_fresh_dedupe: bool = False    # Q8: the training job reads series without freshness or dedupe
    fallback_scale: str = "volume"      # Q3: "crossmean" divides by the mean pairwise ratio (A7) instead
    gbt: GbtParams = field(default_factory=GbtParams)

    def __post_init__(self):
        if self.fallback_scale not in ("volume", "crossmean"):
            raise ValueError(f"fallback_scale must be 'volume' or 'crossmean', not {self.fallback_scale!r}")
        for name in ("fr_len", "window_len", "iter_count", "cycle_len", "recent_days", "cap_days"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")

    # ---- derived days -------------------------------------------------------------------------
    @property
    def yesterday(self) -> dt.date:
        return self.as_of - dt.timedelta(days=1)

    @property
    def first_label_day(self) -> dt.date:
        """``T - (28 + 7)``: the first label day of the training set."""
        return self.as_of - dt.timedelta(days=self.iter_count + self.stable_days)

    @property
    def new_station_threshold(self) -> dt.date:
        """A station that starts after this day is young: its windows come from the city series."""
        return self.first_label_day - dt.timedelta(days=self.cycle_len + self.window_len)

    @property
    def forecast_pre_end(self) -> dt.date:
        """End (exclusive) of the recent feature window when forecasting: ``T - 8``."""
        return self.as_of - dt.timedelta(days=1 + self.stable_days)

    @property
    def rest_of_week(self) -> int:
        """Forecast days from ``T`` to the end of its week (Monday = 7, Sunday = 1)."""
        return 7 - self.as_of.weekday()

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

"""stationcast: daily demand forecasting per station and order class, as Spark DataFrame / Spark ML jobs."""

from .params import GbtParams, Params  # noqa: F401

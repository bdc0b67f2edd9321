"""The registered model queries train what the method trains (M3)."""

from __future__ import annotations

import pytest

from stationcast.params import GbtParams
from stationcast.plans import queries as q


class Trained(Exception):
    """Stops a query when its training job starts."""


@pytest.mark.parametrize("name", ["m4_forecast", "m4_backtest", "r7_report_text"])
def test_model_queries_train_at_the_methods_settings(spark, monkeypatch, name):
    seen = []

    def stop(spark, series, ref, p, *args, **options):
        seen.append(p.gbt)
        raise Trained

    monkeypatch.setattr(q._tj, "run", stop)
    with pytest.raises(Trained):
        q.REGISTRY[name](spark, "/root/testdata/sf0.001")
    assert seen == [GbtParams()] and (seen[0].max_iter, seen[0].max_depth) == (1000, 15)

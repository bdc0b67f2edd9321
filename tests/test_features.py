"""The three feature paths by station age (FIXTURES section 2)."""

from __future__ import annotations

from conftest import days, make_ref, make_series, series_row

from stationcast.operators import features


def _wave(n, seed=0):
    # varied positive values so every window has strict inliers
    return [1 + ((i * 7 + seed) % 5) for i in range(n)]


def _run(spark, p, rows, ref_rows, measured=False):
    s = make_series(spark, rows)
    ref = make_ref(spark, ref_rows)
    out = features.forecast_features(s, ref, p, measured=measured).collect()
    return {r.sta_num: r for r in out}


def test_age_bands(spark, p):
    ref = [("1", "100", _wave(500, 3), days(500))]
    rows = []
    for sta, age in (("430", 430), ("429", 429), ("403", 403), ("402", 402)):
        n = age - 1   # history up to yesterday
        rows.append(series_row(sta=sta, start=days(age), qty=_wave(n)))
    got = _run(spark, p, rows, ref, measured=True)
    assert {k: v.path for k, v in got.items()} == {"430": "own", "429": "city", "403": "city", "402": "fallback"}
    assert all(len(v.hist) == 90 for v in got.values())


def test_city_path_aligns_by_date(spark, p):
    ref_qty = list(range(1, 501))           # value = 1 + index, i.e. identifies the calendar day
    ref = [("1", "100", ref_qty, days(500))]
    got = _run(spark, p, [series_row(sta="9", start=days(420), qty=[1] * 419)], ref)
    # the recent window [T-38, T-8) of the city series starts at index 500-38 = 462; its 16th day (index 477,
    # value 478) is an inlier of the ramp, so it passes through the cleaning unchanged
    assert got["9"].path == "city"
    assert got["9"].hist[15] == 478.0
    legacy = features.forecast_features(make_series(spark, [series_row(sta="9", start=days(420), qty=[1] * 419)]),
                                        make_ref(spark, ref), p.with_(align_city_by_date=False),
                                        measured=False).first()
    assert legacy.hist[15] == 398.0       # own offset 420-38 = 382 into the city series (as published)


def test_fallback_needs_30_own_days(spark, p):
    ref = [("1", "100", _wave(500), days(500))]
    # start T-37: own recent window [T-38, T-8) has 29 days -> dropped; start T-38: 30 days -> kept
    rows = [series_row(sta="29", start=days(37), qty=_wave(36)), series_row(sta="30", start=days(38), qty=_wave(37))]
    got = _run(spark, p, rows, ref)
    assert "29" not in got and got["30"].path == "fallback"


def test_fallback_with_zero_reference_volume(spark, p):
    ref = [("1", "100", [0] * 500, days(500))]
    got = _run(spark, p, [series_row(sta="5", start=days(200), qty=_wave(199))], ref)
    assert got["5"].path == "fallback"
    assert got["5"].hist[30:] == [1.0] * 60


def test_fallback_rescales_reference(spark, p):
    ref_qty = [2] * 500
    got = _run(spark, p, [series_row(sta="5", start=days(200), qty=[4] * 199)], [("1", "100", ref_qty, days(500))])
    # divisor = sum(ref year-ago-pre) / sum(own recent) = 60 / 120 = 0.5 -> reference values 2 / 0.5 = 4
    assert got["5"].hist == [4.0] * 90


def test_constant_window_falls_back(spark, p):
    got = _run(spark, p, [series_row(sta="7", start=days(500), qty=[3] * 499)], [("1", "100", _wave(500), days(500))])
    assert got["7"].path == "fallback"


def test_city_without_reference(spark, p):
    got = _run(spark, p, [series_row(sta="8", start=days(420), qty=_wave(419), city="77")],
               [("1", "100", _wave(500), days(500))])
    assert got == {}


def test_feature_vector(spark, p):
    got = features.with_feature_vector(
        features.forecast_features(make_series(spark, [series_row(sta="4", start=days(500), qty=_wave(499),
                                                                  province_id="2.0", county_id="7")]),
                                   make_ref(spark, [("1", "100", _wave(500), days(500))]), p, measured=False)).first()
    assert got.features.size == 93 and list(got.features.toArray()[-3:]) == [2.0, 1.0, 7.0]


def test_fallback_crossmean_option(spark, p):
    ref = [("1", "100", [2] * 500, days(500))]
    rows = [series_row(sta="5", start=days(200), qty=[4] * 199)]
    got = features.forecast_features(make_series(spark, rows), make_ref(spark, ref),
                                     p.with_(fallback_scale="crossmean"), measured=False).first()
    # mean pairwise ratio 2/4 = 0.5 -> reference values 2 / 0.5 = 4
    assert got.path == "fallback" and got.hist == [4.0] * 90

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from marketlake.operators import bars, features

T0 = dt.datetime(2026, 5, 9)


def ramp(n=300, holes=(), scale_from=None):
    rows = []
    for i in range(n):
        c = 100 + 0.1 * i
        c *= 2 if scale_from is not None and i >= scale_from else 1
        w = 2 if scale_from is not None and i >= scale_from else 1
        row = None if i in holes else (c, c + w, c - w, c, 1.0, c)
        rows.append(("A", T0 + dt.timedelta(minutes=i), *(row or (None,) * 6)))
    return rows


SCHEMA = "symbol string, open_time timestamp_ntz, open double, high double, low double, close double, volume double, quote_volume double"


def run(spark, rows, block="day"):
    return features.features(spark.createDataFrame(rows, SCHEMA), block=block).orderBy("symbol", "open_time").toPandas()


OUT = ["return_1", "atr_14", "rsi_14", "ema_20", "ema_50", "ema_200", "volatility_30", "volatility_60", "zscore_20", "trend_20_50_bps", "vwap_utc_day"]


def test_the_future_does_not_change_the_past(spark):
    a, b = run(spark, ramp()), run(spark, ramp(scale_from=250))
    pd.testing.assert_frame_equal(a.iloc[:250][OUT], b.iloc[:250][OUT])


def test_a_gap_starts_everything_afresh(spark):
    f = run(spark, ramp(holes={150}))
    assert pd.isna(f.return_1[151]) and pd.isna(f.ema_20[169]) and not pd.isna(f.ema_20[170])
    assert not pd.isna(f.vwap_utc_day[149]) and f.vwap_utc_day[150:].isna().all()
    assert (f.bar_available_at - f.open_time == pd.Timedelta(minutes=1)).all()


@pytest.mark.parametrize("block", ["hour", "day"])
def test_against_pandas(spark, block):
    rng = np.random.default_rng(5)
    rows = []
    for s in ("A", "B"):
        c = 100 + np.cumsum(rng.normal(0, 1, 500))
        for i, x in enumerate(c):
            ok = rng.random() > 0.01
            rows.append((s, T0 + dt.timedelta(minutes=7 * i), *((x, x + 1.0, x - 1.5, float(x), 2.0, 2 * x) if ok else (None,) * 6)))
    got = run(spark, [(a, b, *(None if v is None else float(v) for v in r)) for a, b, *r in rows], block)
    for _, g in got.groupby("symbol"):
        valid = g.close.notna()
        for _, s in g[valid].groupby((~valid).cumsum()[valid]):
            prev = s.close.shift(1)
            tr = pd.concat([s.high - s.low, (s.high - prev).abs(), (s.low - prev).abs()], axis=1).max(axis=1)
            d = s.close.diff()
            up, down = (x.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean() for x in (d.clip(lower=0), -d.clip(upper=0)))
            want = {"ema_20": s.close.ewm(span=20, adjust=False, min_periods=20).mean(), "atr_14": tr.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean(), "rsi_14": 100 - 100 / (1 + up / down)}
            want |= {"volatility_30": np.log(s.close).diff().rolling(30).std(), "zscore_20": (s.close - s.close.rolling(20).mean()) / s.close.rolling(20).std()}
            for k, v in want.items():
                np.testing.assert_allclose(s[k].to_numpy(float), v.to_numpy(float), rtol=1e-9, atol=1e-9)


def test_flat_and_rising_closes(spark):
    flat = [("A", T0 + dt.timedelta(minutes=i), *(5.0,) * 4, 0.0, 0.0) for i in range(40)]
    rise = [("B", T0 + dt.timedelta(minutes=i), *(5.0 + i,) * 4, 1.0, 5.0 + i) for i in range(40)]
    f = run(spark, flat + rise).set_index(["symbol", "open_time"])
    assert f.loc["A"].rsi_14.iloc[-1] == 50 and f.loc["A"].volatility_30.iloc[-1] == 0 and pd.isna(f.loc["A"].zscore_20.iloc[-1]) and f.loc["A"].vwap_utc_day.isna().all()
    assert f.loc["B"].rsi_14.iloc[-1] == 100


def test_only_complete_bars(spark):
    rows = [(*r, 1, 0.0, 0.0) for r in ramp(30, holes={7})]
    df = spark.createDataFrame(rows, SCHEMA + ", count long, taker_buy_volume double, taker_buy_quote_volume double")
    b = bars.resample(df, "5 minutes", 5).orderBy("open_time").collect()
    assert [x.open_time.minute for x in b] == [0, 10, 15, 20, 25] and b[0].close == pytest.approx(100.4) and b[0].volume == 5
    with pytest.raises(ValueError):
        bars.assert_unique(df.union(df), ["symbol", "open_time"])

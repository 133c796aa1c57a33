"""Rolling price features over an ordered series.

pandas ``rolling(n).f().shift(1)`` is the frame ``rowsBetween(-n, -1)`` guarded so a
value appears only when all ``n`` prior rows are present.  All features of one stage
share one ``Window`` spec, so Spark sorts once.

Scale note: the input here is a *daily* series (one row per date and, optionally,
per symbol), bounded by the calendar rather than by the raw data.  Series are
independent, so pass ``partition_by`` (e.g. a symbol column) and each one is
shuffled to its own task; the raw rows are reduced by a partial aggregation
before they get here (see ``quarry.sources.fixtures.prices``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Window lengths in trading days and the names the features carry.
WINDOWS = (5, 21, 252)
WINDOW_NAMES = (5, 30, 365)
ROLLED = (("avg_price", "close", "avg"), ("avg_volume", "volume", "avg"),
          ("std_price", "close", "std"), ("std_volume", "volume", "std"))


def _fn(kind: str):
    return F.avg if kind == "avg" else F.stddev_samp


def rolling_prior(col: Column | str, n: int, window: Window, kind: str = "avg") -> Column:
    """f over the ``n`` rows before the current one; null unless all ``n`` are non-null."""
    frame = window.rowsBetween(-n, -1)
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.count(c).over(frame) == n, _fn(kind)(c).over(frame))


def ratio(a: str, b: str) -> Column:
    return F.try_divide(F.col(a), F.col(b))


def feature_names() -> list[str]:
    names = ["open", "open_1", "close_1", "high_1", "low_1", "volume_1"]
    for label, _, _ in ROLLED:
        a, b, c = (f"{label}_{k}" for k in WINDOW_NAMES)
        names += [a, b, c, f"ratio_{label}_5_30", f"ratio_{label}_5_365", f"ratio_{label}_30_365"]
    names += ["return_1"] + [f"return_{k}" for k in WINDOW_NAMES]
    names += [f"moving_avg_{k}" for k in WINDOW_NAMES]
    return names


def price_features(df: DataFrame, date_col: str = "date", partition_by: Sequence[str] = (),
                   corrected_return: bool = False, dropna: bool = True) -> DataFrame:
    """The 37 features plus ``close``; rows with any missing feature dropped.

    ``df`` needs ``open, close, high, low, volume`` and the order column.
    ``return_1`` keeps the reference's formula (close[t]-close[t-1])/close[t-2]
    unless ``corrected_return``.
    """
    keys = list(partition_by)
    w = Window.partitionBy(*keys).orderBy(date_col)
    lag = lambda c, k: F.lag(c, k).over(w)

    # stage 1: W1-W6 — one sort, one Window operator
    cols: dict[str, Column] = {
        "open": F.col("open"), "open_1": lag("open", 1), "close_1": lag("close", 1),
        "high_1": lag("high", 1), "low_1": lag("low", 1), "volume_1": lag("volume", 1),
    }
    for label, src, kind in ROLLED:
        for n, k in zip(WINDOWS, WINDOW_NAMES):
            cols[f"{label}_{k}"] = rolling_prior(src, n, w, kind)
    if corrected_return:
        cols["return_1"] = F.try_divide(lag("close", 1) - lag("close", 2), lag("close", 2))
    else:
        cols["return_1"] = F.try_divide(F.col("close") - lag("close", 1), lag("close", 2))
    for n, k in zip(WINDOWS, WINDOW_NAMES):
        cols[f"return_{k}"] = F.try_divide(lag("close", 1) - lag("close", 1 + n), lag("close", 1 + n))
    stage1 = df.select(*keys, date_col, "close", *[c.alias(n) for n, c in cols.items()])

    # stage 2: ratios (row-local) and W7, the lagged moving average of return_1
    more: dict[str, Column] = {}
    for label, _, _ in ROLLED:
        a, b, c = (f"{label}_{k}" for k in WINDOW_NAMES)
        more[f"ratio_{label}_5_30"] = ratio(a, b)
        more[f"ratio_{label}_5_365"] = ratio(a, c)
        more[f"ratio_{label}_30_365"] = ratio(b, c)
    for n, k in zip(WINDOWS, WINDOW_NAMES):
        more[f"moving_avg_{k}"] = rolling_prior("return_1", n, w, "avg")
    out = stage1.withColumns(more).select(*keys, date_col, *feature_names(), "close")
    return out.na.drop("any", subset=feature_names() + ["close"]) if dropna else out


def lag_features(df: DataFrame, cols: Sequence[str], order_col: str, k: int = 1,
                 partition_by: Sequence[str] = ()) -> DataFrame:
    """W1 on its own: previous-row values."""
    w = Window.partitionBy(*partition_by).orderBy(order_col)
    return df.withColumns({f"{c}_{k}": F.lag(c, k).over(w) for c in cols})


def price_features_sql(prices_cte: str = "prices", date_col: str = "date") -> str:
    """DuckDB twin of ``price_features`` (used by the oracle)."""
    w = f"(ORDER BY {date_col} ROWS BETWEEN {{n}} PRECEDING AND 1 PRECEDING)"
    lag = lambda c, k: f"lag({c}, {k}) OVER (ORDER BY {date_col})"
    roll = lambda src, n, kind: (
        f"CASE WHEN count({src}) OVER {w.format(n=n)} = {n} THEN "
        f"{'avg' if kind == 'avg' else 'stddev_samp'}({src}) OVER {w.format(n=n)} END")
    s1 = [f"{date_col}", "close", "open", f"{lag('open', 1)} AS open_1", f"{lag('close', 1)} AS close_1",
          f"{lag('high', 1)} AS high_1", f"{lag('low', 1)} AS low_1", f"{lag('volume', 1)} AS volume_1"]
    for label, src, kind in ROLLED:
        for n, k in zip(WINDOWS, WINDOW_NAMES):
            s1.append(f"{roll(src, n, kind)} AS {label}_{k}")
    s1.append(f"(close - {lag('close', 1)}) / NULLIF({lag('close', 2)}, 0) AS return_1")
    for n, k in zip(WINDOWS, WINDOW_NAMES):
        s1.append(f"({lag('close', 1)} - {lag('close', 1 + n)}) / NULLIF({lag('close', 1 + n)}, 0) AS return_{k}")
    s2 = ["*"]
    for label, _, _ in ROLLED:
        a, b, c = (f"{label}_{k}" for k in WINDOW_NAMES)
        s2 += [f"{a} / NULLIF({b}, 0) AS ratio_{label}_5_30", f"{a} / NULLIF({c}, 0) AS ratio_{label}_5_365",
               f"{b} / NULLIF({c}, 0) AS ratio_{label}_30_365"]
    for n, k in zip(WINDOWS, WINDOW_NAMES):
        s2.append(f"{roll('return_1', n, 'avg')} AS moving_avg_{k}")
    names = feature_names() + ["close"]
    return (f"SELECT {date_col}, {', '.join(names)} FROM (SELECT {', '.join(s2)} FROM "
            f"(SELECT {', '.join(s1)} FROM {prices_cte}) s1) s2 WHERE "
            + " AND ".join(f"{n} IS NOT NULL" for n in names))

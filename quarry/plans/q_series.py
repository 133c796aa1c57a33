"""Registered queries: rolling price features."""

from __future__ import annotations


from quarry.operators import series
from quarry.plans.catalog import register, rounded, sql_rounded
from quarry.sources import fixtures as fx



def _decimals(name: str) -> int:
    # Unit-free ratios/returns: 6 decimals.  Averages of 2-decimal prices over 252 rows
    # have at most 4 decimal digits, so rounding them at 4 can never meet an exact
    # tie (where the two engines' summation orders could differ by one ulp).
    if name.startswith(("ratio", "return", "moving")):
        return 6
    return 4 if name.startswith("avg_") else 2


PRICE_SPEC = {n: _decimals(n) for n in series.feature_names() + ["close"]}


@register("w8_price_features",
          sql_rounded(fx.with_sql(["prices"], series.price_features_sql()), PRICE_SPEC))
def w8_price_features(spark, sf_dir):
    return rounded(series.price_features(fx.prices(spark, sf_dir)), PRICE_SPEC)


@register("w1_prev_day_values", fx.with_sql(["prices"], """
SELECT date, open, lag(open, 1) OVER w AS open_1, lag(close, 1) OVER w AS close_1,
       lag(high, 1) OVER w AS high_1, lag(low, 1) OVER w AS low_1, lag(volume, 1) OVER w AS volume_1
FROM prices WINDOW w AS (ORDER BY date)"""))
def w1_prev_day_values(spark, sf_dir):
    p = fx.prices(spark, sf_dir)
    out = series.lag_features(p, ["open", "close", "high", "low", "volume"], "date")
    return out.select("date", "open", "open_1", "close_1", "high_1", "low_1", "volume_1")


@register("s_daily_prices", fx.with_sql(["prices"], "SELECT * FROM prices"))
def s_daily_prices(spark, sf_dir):
    return fx.prices(spark, sf_dir)

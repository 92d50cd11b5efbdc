"""Indicators, fills, clipping and status expressions.

FN8-FN10, FN12-FN20 of the operator inventory; all built-in Column
expressions, no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonecast.config import ALERT_MESSAGE, STATUS_AMBER, STATUS_GREEN, STATUS_RED, Config


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rainy_flag(weather: Column | str, cfg: Config) -> Column:
    """FN8: 1 when the weather label is the rainy one, else 0."""
    return F.coalesce((_c(weather) == F.lit(cfg.rainy_label)).cast("int"), F.lit(0))


def peak_hour_flag(hour: Column | str, cfg: Config) -> Column:
    """FN9: 1 when the hour is a peak hour."""
    return _c(hour).isin(list(cfg.peak_hours)).cast("int")


def zone_code(zone: Column | str, cfg: Config) -> Column:
    """FN10: zone label -> ordinal code (unknown -> NULL).

    The zone list is configuration (bounded), so an inline map literal is
    cheaper than a join and stays in codegen.
    """
    pairs = []
    for z, i in cfg.zone_codes.items():
        pairs += [F.lit(z), F.lit(i)]
    return F.try_element_at(F.create_map(*pairs), _c(zone)).cast("int")


def fill_zero(c: Column | str) -> Column:
    """FN12: missing count -> 0."""
    return F.coalesce(_c(c), F.lit(0))


def fill_chain(*cs: Column | str) -> Column:
    """FN13: own value, then a coarser value, then a constant."""
    return F.coalesce(*[_c(c) for c in cs])


def std_or_zero(c: Column | str) -> Column:
    """FN14: rolling std NULL -> 0.0."""
    return F.coalesce(_c(c), F.lit(0.0))


def clip_at_zero(c: Column | str) -> Column:
    """FN15: negative forecasts become 0. NaN becomes 0 too, as Python's
    max(0.0, nan) does; Spark's greatest would keep NaN, which then compares
    above every threshold (T34)."""
    x = _c(c).cast("double")
    return F.when(F.isnan(x) | (x < 0), F.lit(0.0)).otherwise(x)


def round2(c: Column | str) -> Column:
    """FN16: two decimals, Spark's HALF_UP rounding."""
    return F.round(_c(c), 2)


def demand_status(pred: Column | str, avg: Column | str, cfg: Config) -> Column:
    """FN17: three-tier status against the (defaulted) 7-day average."""
    a = F.coalesce(_c(avg), F.lit(cfg.fallback_avg))
    p = _c(pred)
    return (F.when(p > a * cfg.high_demand_factor, F.lit(STATUS_RED))
            .when(p > a * cfg.amber_factor, F.lit(STATUS_AMBER))
            .otherwise(F.lit(STATUS_GREEN)))


def fixed_decimals(c: Column | str, digits: int) -> Column:
    """Python's '%.Nf': rounds the exact binary value half-to-even.

    ``format_number`` (DecimalFormat, HALF_EVEN on the exact double) gives
    the same digits, ``format_string`` does not (it rounds the shortest
    decimal form half-up, T18); the grouping commas are removed.
    """
    return F.translate(F.format_number(_c(c), digits), ",", "")


def one_decimal(c: Column | str) -> Column:
    return fixed_decimals(c, 1)


def alert_message(pred: Column | str, avg: Column | str) -> Column:
    """FN18: alert text; a zero average gives 'n/a' instead of failing."""
    ratio = F.try_divide(_c(pred), _c(avg))
    return F.format_string(
        ALERT_MESSAGE.replace("{}", "%s"),
        one_decimal(pred),
        F.coalesce(one_decimal(ratio), F.lit("n/a")),
        one_decimal(avg),
    )


def baseline_or_default(c: Column | str, cfg: Config) -> Column:
    """FN19."""
    return F.coalesce(_c(c), F.lit(cfg.fallback_baseline_mape))


def metric_delta(model: Column | str, baseline: Column | str) -> Column:
    """FN20: model metric minus baseline metric."""
    return _c(model) - _c(baseline)

"""Column -> Column expressions.

Everything here is a built-in Catalyst expression, so it stays inside
whole-stage codegen; no Python runs per row. Spark runs with ANSI mode on, so
lenient parsing uses the ``try_*`` forms.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from delaylake.functions import constants as K

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def delay_label(c: ColumnOrName = "Arr_Delay", threshold: int = K.DELAY_THRESHOLD_MIN) -> Column:
    """1 when the delay exceeds the threshold, else 0; null counts as not delayed."""
    return F.when(_c(c) > threshold, F.lit(1)).otherwise(F.lit(0))


def clip(c: ColumnOrName, lo=None, hi=None) -> Column:
    """Bound to [lo, hi]; null stays null (``least``/``greatest`` alone would
    turn a null into the bound)."""
    x = _c(c)
    out = x
    if lo is not None:
        out = F.greatest(out, lo if isinstance(lo, Column) else F.lit(lo))
    if hi is not None:
        out = F.least(out, hi if isinstance(hi, Column) else F.lit(hi))
    return F.when(x.isNull(), F.lit(None)).otherwise(out)


def to_date_lenient(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Text to date; anything unparseable becomes null instead of failing."""
    x = _c(c)
    if fmt is None:
        return F.try_to_date(x.cast("string"))
    return F.try_to_date(x.cast("string"), fmt)


def to_number_lenient(c: ColumnOrName, dtype: str = "double") -> Column:
    """Text to number; text that is not a number becomes null."""
    return _c(c).cast("string").try_cast(dtype)


def temp_band(c: ColumnOrName, width: int = 2) -> Column:
    """Temperature band: round-half-even(t / width) * width, as an int."""
    return (F.bround(_c(c) / width, 0) * width).cast("int")


def rain_band(c: ColumnOrName, width: int = 2) -> Column:
    """Precipitation band: floor(p / width) * width, as an int."""
    return (F.floor(_c(c) / width) * width).cast("int")


def risk_level(p: ColumnOrName, lo: float = K.RISK_MEDIUM, hi: float = K.RISK_HIGH) -> Column:
    x = _c(p)
    return (F.when(x >= hi, F.lit("high"))
             .when(x >= lo, F.lit("medium"))
             .when(x.isNotNull(), F.lit("low")))


def risk_bracket(p: ColumnOrName, lo: float = K.RISK_MEDIUM, hi: float = K.RISK_HIGH) -> Column:
    """struct(risk, label, verdict) from a delay probability; null p gives nulls."""
    x = _c(p)

    def pick(i: int) -> Column:
        return (F.when(x >= hi, F.lit(K.RISK_TEXT["high"][i]))
                 .when(x >= lo, F.lit(K.RISK_TEXT["medium"][i]))
                 .when(x.isNotNull(), F.lit(K.RISK_TEXT["low"][i])))

    return F.struct(pick(0).alias("risk"), pick(1).alias("label"), pick(2).alias("verdict"))


def confidence_threshold(p: ColumnOrName, t: float = K.CONFIDENCE_THRESHOLD) -> Column:
    """Label 1 when the probability is strictly above ``t``."""
    return (_c(p) > t).cast("int")


def percent(p: ColumnOrName) -> Column:
    """round(100 p, 1) with half-even ties, as Python's ``round`` does."""
    return F.bround(_c(p) * 100, 1)


def percent_fields(p: ColumnOrName) -> tuple[Column, Column]:
    """(delay percent, on-time percent)."""
    x = _c(p)
    return percent(x), percent(1 - x)


def weekend_flag(iso_dow: ColumnOrName) -> Column:
    """ISO day 6 or 7 -> 1, else 0 (a missing day counts as a weekday)."""
    return F.coalesce(_c(iso_dow).isin(6, 7), F.lit(False)).cast("int")


def delay_level(avg: ColumnOrName, cut: float = K.DELAY_LEVEL_CUT) -> Column:
    """Heatmap cell text (rule inferred from the shipped table)."""
    x = _c(avg)
    return F.when(x < cut, F.lit("Low")).when(x.isNotNull(), F.lit("Medium"))


def bubble_size(c: ColumnOrName) -> Column:
    return K.BUBBLE_BASE + F.greatest(_c(c), F.lit(0.0)) * K.BUBBLE_SCALE


def normalise_code(c: ColumnOrName) -> Column:
    return F.upper(F.trim(_c(c)))


def route_label(dep: ColumnOrName, arr: ColumnOrName) -> Column:
    return F.concat_ws(" → ", _c(dep), _c(arr))


def route_code(dep_code: ColumnOrName, arr_code: ColumnOrName) -> Column:
    return _c(dep_code) * 1000 + _c(arr_code)


def airline_display(c: ColumnOrName, mapping: dict[str, str] | None = None) -> Column:
    """Key -> display text through a literal map; unmapped keys pass through.

    The map is a literal inside the expression, so no join and no shuffle.
    """
    mapping = K.AIRLINE_DISPLAY if mapping is None else mapping
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    x = _c(c)
    return F.coalesce(F.try_element_at(m, x), x)


def iso_dow(date: ColumnOrName) -> Column:
    """ISO day of week, Monday = 1 ... Sunday = 7."""
    return F.weekday(_c(date)) + 1


def md5_bucket(key: Column, buckets: int = 10000) -> Column:
    """Stable bucket in [0, buckets) from the first 32 bits of md5(key).

    Does not depend on partitioning or task order, so a sample or split picks
    the same rows on any cluster size; DuckDB computes the same value.
    """
    h = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return (h % buckets).cast("int")


def hash_key(cols: list[str], seed: int = K.SEED) -> Column:
    """Text key ``c1|c2|...|seed`` for :func:`md5_bucket`."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols],
                       F.lit(str(seed)))

"""Column functions: parsing, hours, shifts, keys."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: accepted text forms ----------------------------------------------------
NUMBER_FORM = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
TIMESTAMP_FORM = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2})?$"
# -------------------------------------------------------------------------------------------


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    return F.coalesce(F.trim(col(c)) == "", F.lit(True))


def parse_decimal(c: Column | str) -> Column:
    """Decimal-comma text to double; anything else, NaN and infinity included, gives null."""
    text = F.replace(F.trim(col(c)), F.lit(","), F.lit("."))
    number = F.when(text.rlike(NUMBER_FORM), text.try_cast("double"))
    return F.when(F.abs(number) < float("inf"), number)


def parse_hour(c: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm[:ss]`` text to the naive timestamp of its hour; null when invalid."""
    text = F.trim(col(c))
    return trunc_hour(F.when(text.rlike(TIMESTAMP_FORM), text.try_cast("timestamp_ntz")))


def trunc_hour(c: Column | str) -> Column:
    return F.date_trunc("hour", col(c)).cast("timestamp_ntz")


def epoch_hour(c: Column | str) -> Column:
    """Hours since 1970 as a long, the integer time axis of every lag and range frame."""
    return F.floor(F.unix_seconds(col(c).cast("timestamp")) / 3600)


def hour_from_epoch(c: Column | str) -> Column:
    return F.timestamp_seconds(col(c) * 3600).cast("timestamp_ntz")


def hour_key(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyyMMddHH").cast("int")


def shift_of(c: Column | str, start: int = 6) -> Column:
    """A, B or C: three shifts of eight hours, the first from ``start``."""
    nth = F.floor(F.pmod(F.hour(col(c)) - F.lit(start), F.lit(24)) / 8)
    return F.when(nth == 0, "A").when(nth == 1, "B").otherwise("C")


def shift_date(c: Column | str, start: int = 6) -> Column:
    """Date on which the shift began; the shift over midnight belongs to the day before."""
    return F.to_date(col(c) - F.expr(f"INTERVAL {int(start)} HOURS"))


def in_range(c: Column | str, low: float | None, high: float | None) -> Column:
    """True for values inside the limits and for nulls; a null limit is open."""
    test = F.lit(True)
    if low is not None:
        test = test & (col(c) >= F.lit(float(low)))
    if high is not None:
        test = test & (col(c) <= F.lit(float(high)))
    return F.coalesce(test, F.lit(True))


def exact_mean(c: Column | str, scale: int = 10) -> Column:
    """Mean by a decimal sum, so that it does not depend on the order of rows."""
    total = F.sum(col(c).cast(f"decimal({18 + scale},{scale})"))
    return F.try_divide(total.cast("double"), F.count(col(c)))


def off_spec(c: Column | str, threshold: Column | float) -> Column:
    limit = F.lit(threshold) if isinstance(threshold, (int, float)) else threshold
    return col(c) > limit


def split_label(c: Column | str, split) -> Column:
    """train / val / test by date; end dates are inclusive."""

    def within(first: str, last: str) -> Column:
        start = F.lit(first).cast("date").cast("timestamp_ntz")
        stop = F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz")
        return (col(c) >= start) & (col(c) < stop)

    return (
        F.when(within(split.train_start, split.train_end), "train")
        .when(within(split.val_start, split.val_end), "val")
        .when(within(split.test_start, split.test_end), "test")
    )


def features_hash(columns: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(columns)).encode()).hexdigest()


def hash_unit(*parts: Column) -> Column:
    """Number in [0, 1) that depends only on the parts, so repeated runs give the same noise."""
    return F.pmod(F.xxhash64(*parts), F.lit(1_000_003)) / F.lit(1_000_003.0)

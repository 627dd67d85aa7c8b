"""Column expressions that turn raw staging text into typed values.

Everything here is a built-in Spark expression, so it stays inside whole-stage
code generation and never starts a Python worker.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three spellings a birth date may arrive in.
DASHED_YMD = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
SLASHED_YMD = r"^[0-9]{4}/[0-9]{2}/[0-9]{2}$"
SLASHED_DMY = r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"

MONEY = "decimal(38,5)"


def parse_birth_date(text: Column) -> Column:
    """Date from one of three spellings; NULL for any other text or an impossible day.

    Each spelling is rearranged to ISO text first, so a single ``try_cast`` does
    the parsing. That cast reports failure without raising, unlike a formatter
    based parse, which builds an exception for every bad row.
    """
    iso = (
        F.when(text.rlike(DASHED_YMD), text)
        .when(text.rlike(SLASHED_YMD), F.translate(text, "/", "-"))
        .when(
            text.rlike(SLASHED_DMY),
            F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2)),
        )
    )
    return iso.try_cast("date")


def parse_price(text: Column) -> Column:
    """``350.000.000`` -> 350000000.00000. Every dot counts as a thousands mark."""
    return F.replace(text, F.lit("."), F.lit("")).cast(MONEY)


def to_millis(moment: Column) -> Column:
    """Zone-less timestamp rounded half up to whole milliseconds.

    Works on TIMESTAMP_NTZ throughout, so the session time zone (and its
    daylight saving gaps) cannot shift the value.
    """
    ts = moment.cast("timestamp_ntz")
    seconds = F.extract(F.lit("SECOND"), ts)
    return ts + F.make_dt_interval(secs=F.round(seconds, 3) - seconds)


def moment(value: datetime) -> Column:
    """A constant zone-less timestamp.

    Passed on as text: Spark would read a bare ``datetime`` literal in the time zone of
    the machine that runs the driver.
    """
    return F.lit(value.replace(tzinfo=None).isoformat(" ")).cast("timestamp_ntz")

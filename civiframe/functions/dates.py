"""Calendar and time expressions. Local wall-clock values are TIMESTAMP_NTZ, so
they do not depend on the session time zone; instants are TIMESTAMP."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "Europe/Paris"


def week_of_month(day: Column) -> Column:
    """Days 1-7 -> ``01`` ... 29-35 -> ``05``, anything else ``-1``."""
    week = F.floor((day - 1) / 7) + 1
    return F.when(day.between(1, 35), F.lpad(week.cast("string"), 2, "0")).otherwise("-1")


def week_of_month_text(day: int) -> str:
    return f"{(day - 1) // 7 + 1:02d}" if 1 <= day <= 35 else "-1"


def local_timestamp(iso_text: Column) -> Column:
    """Wall-clock part of an ISO text; the zone offset is cut off. Text of another shape
    gives null."""
    head = F.substring(iso_text, 1, 19)
    shape = F.translate(head, "0123456789", "9999999999") == "9999-99-99T99:99:99"
    return F.when(shape, head.try_cast("timestamp_ntz"))


def iso_to_standard_text(iso_text: Column) -> Column:
    return F.date_format(local_timestamp(iso_text), "yyyy-MM-dd HH:mm:ss")


def floor_minutes(ts: Column, minutes: int) -> Column:
    """Start of the running ``minutes`` slot of the hour, seconds zeroed."""
    past = F.make_dt_interval(
        mins=F.minute(ts) % minutes, secs=F.date_part(F.lit("SECOND"), ts)
    )
    return ts - past


def _compact_text(day: Column, time: Column) -> Column:
    """``yyyyMMdd`` and ``HHmmss`` whose leading zeros may be missing."""
    time = time.cast("string")
    padded = F.when(F.length(time) < 6, F.lpad(time, 6, "0")).otherwise(F.substring(time, 1, 6))
    return F.concat(F.substring(day.cast("string"), 1, 8), padded)


def compact_local(day: Column, time: Column) -> Column:
    """Wall-clock timestamp; malformed text gives null."""
    text = _compact_text(day, time)
    spread = F.regexp_replace(
        text, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:$6"
    )
    return F.when(text.rlike(r"^\d{14}$"), spread.try_cast("timestamp_ntz"))


def compact_instant(day: Column, time: Column, zone: str = LOCAL_ZONE) -> Column:
    """Instant of a local date and time (a skipped hour moves forward, a repeated
    hour takes the earlier offset)."""
    text = F.concat(_compact_text(day, time), F.lit(f" {zone}"))
    return F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss VV"))


def us_date(text: Column) -> Column:
    """``M/d/yy`` or ``M/d/yyyy`` -> ``yyyy-MM-dd 00:00:00``; other text unchanged."""
    parts = F.split(text, "/")
    month, day, year = (F.get(parts, i) for i in range(3))
    full_year = F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year)

    def two_digits(part: Column) -> Column:
        return F.when(F.length(part) == 1, F.concat(F.lit("0"), part)).otherwise(part)

    rebuilt = F.concat(
        F.concat_ws("-", full_year, two_digits(month), two_digits(day)), F.lit(" 00:00:00")
    )
    return F.when(F.size(parts) >= 3, rebuilt).otherwise(text)


def month_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def days_between(start: Column, end: Column) -> Column:
    """Array of the days in ``[start, end)``; null when the range is empty."""
    return F.when(end > start, F.sequence(start, F.date_sub(end, 1)))


def back_dated_text(iso_text: Column, position: Column, step_seconds: Column) -> Column:
    """ISO text moved back by ``position`` steps, keeping its own zone offset."""
    moved = local_timestamp(iso_text) - F.make_dt_interval(secs=position * step_seconds)
    return F.concat(
        F.date_format(moved, "yyyy-MM-dd'T'HH:mm:ss"), F.substring(iso_text, 20, 6)
    )

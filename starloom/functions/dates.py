from __future__ import annotations

from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, functions as F

# Fixed value: the time zone that decides which day a batch belongs to.
BATCH_TIME_ZONE = "America/Buenos_Aires"


def resolve_process_date(
    override: str | None = None, tz: str = BATCH_TIME_ZONE, now: datetime | None = None
) -> str:
    """The batch date as ``yyyy-MM-dd``: the override if there is one, else today in ``tz``."""
    if override is not None:
        return override
    now = now or datetime.now(timezone.utc)
    return now.astimezone(ZoneInfo(tz)).strftime("%Y-%m-%d")


def local_date(utc_wall_time: Column, tz: str = BATCH_TIME_ZONE) -> Column:
    """The day in ``tz``, as ``yyyy-MM-dd``, of a zone-less timestamp that holds UTC."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall_time.cast("timestamp_ntz"))
    return local.cast("date").cast("string")


def slash_timestamp(ts: Column) -> Column:
    """A timestamp as text with ``/`` between the date parts."""
    return F.replace(ts.cast("string"), F.lit("-"), F.lit("/"))

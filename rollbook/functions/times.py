"""ISO times kept as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECOND = "yyyy-MM-dd'T'HH:mm:ss"


def iso_second(column: Column) -> Column:
    """Text time (any usual ISO spelling, UTC) as a zone-less timestamp cut to the second.

    NULL, blank and unreadable texts give NULL.
    """
    return F.date_trunc("second", F.trim(column).try_cast("timestamp_ntz")).cast("timestamp_ntz")


def iso_text(column: Column) -> Column:
    """Timestamp as ``yyyy-MM-ddTHH:mm:ss``, NULL stays NULL."""
    return F.date_format(column, ISO_SECOND)


def run_start(run_id: Column) -> Column:
    """Start of a run from its id ``YYYYMMDDTHHMMSS``; NULL if it is none."""
    parts = F.regexp_replace(
        F.trim(run_id), r"^(\d{4})(\d\d)(\d\d)T(\d\d)(\d\d)(\d\d)$", "$1-$2-$3T$4:$5:$6"
    )
    return parts.try_cast("timestamp_ntz")

"""Change time as text -> a timestamp plus a sequence number.

Three spellings occur in one feed.  They are told apart by shape, not length:

* ``digits.digits``  nanoseconds since the epoch and a logical counter
* ``digits``         milliseconds since the epoch
* anything else      ISO-8601 text
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shapes of the two numeric spellings.
HYBRID_CLOCK = r"^-?\d+\.\d+$"
EPOCH_MILLIS = r"^-?\d+$"

# Milliseconds of the years 1 to 9999; numbers beyond are no times.
LAST_SEQ = (1 << 63) - 1  # a counter that does not fit comes last
FIRST_MILLI, LAST_MILLI = -62_135_596_800_000, 253_402_300_799_999


def _nanos(text: Column) -> Column:
    return F.substring_index(text, ".", 1).try_cast("bigint")


def event_time(text: Column) -> Column:
    """TIMESTAMP (microseconds) of a change time, NULL when unreadable."""
    nanos = _nanos(text)
    nanos = F.when(nanos > -LAST_SEQ + 1000, nanos)
    micros = F.call_function("div", nanos - F.pmod(nanos, F.lit(1000)), F.lit(1000))
    millis = text.try_cast("bigint")
    millis = F.when(millis.between(FIRST_MILLI, LAST_MILLI), millis)
    return (
        F.when(text.rlike(HYBRID_CLOCK), F.timestamp_micros(micros))
        .when(text.rlike(EPOCH_MILLIS), F.timestamp_millis(millis))
        .otherwise(text.try_cast("timestamp"))
    )


def event_seq(text: Column) -> Column:
    """Order of changes inside one microsecond; 0 unless the text carries a counter."""
    remainder = F.pmod(_nanos(text), F.lit(1000))
    counter = F.substring_index(text, ".", -1).try_cast("bigint")
    return F.when(text.rlike(HYBRID_CLOCK), F.coalesce(F.try_add(remainder * F.lit(10_000_000_000), counter), F.lit(LAST_SEQ))).otherwise(
        F.lit(0).cast("bigint")
    )


def parse_event_time(df, text_col: str = "cdc_timestamp"):
    """Add ``cdc_ts`` and ``cdc_seq`` derived from the change-time text."""
    return df.withColumns({"cdc_ts": event_time(F.col(text_col)), "cdc_seq": event_seq(F.col(text_col))})

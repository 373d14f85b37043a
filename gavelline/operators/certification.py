"""Certification licences: clean a delivered list and append it to the history."""

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelline.functions.dates import parse_date


def licence_header_clean(df: DataFrame) -> DataFrame:
    """Column names without brackets and outer blanks."""
    return df.toDF(*[c.strip("[]").strip() for c in df.columns])


def licence_dates(df: DataFrame) -> DataFrame:
    """Start and end of a licence as dates; texts that are no date, bare numbers among them, become null."""
    dates = [c for c in ("start_date_license", "end_date_license") if c in df.columns]
    return df.withColumns({c: parse_date(F.col(c).cast("string")) for c in dates})


def batch_append_history(df: DataFrame, when: datetime | None = None, batch: str | None = None) -> DataFrame:
    """The whole list stamped with one time and one batch id; rows of earlier batches are not looked at."""
    when = when or datetime.now(timezone.utc)
    return df.withColumns({
        "ingestion_timestamp": F.lit(when.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"),
        "batch_id": F.lit(batch or str(uuid.uuid4())),
    })

"""Certification history: every delivered list is appended with its time and batch."""

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelline.operators.certification import batch_append_history, licence_dates, licence_header_clean
from gavelline.sources.store import SCHEMAS, finish_batch, read_store, write_batch


def append_certifications(licences: DataFrame, root: str, when: datetime | None = None, batch: str | None = None) -> None:
    """Append a delivered list to the history; a batch that is written again replaces itself."""
    batch = batch or str(uuid.uuid4())
    stamped = batch_append_history(licence_dates(licence_header_clean(licences)), when or datetime.now(timezone.utc), batch)
    fields = [c.split() for c in SCHEMAS["certification_history"].split(", ")]
    rows = stamped.select(*[(F.col(n) if n in stamped.columns else F.lit(None)).cast(t).alias(n) for n, t in fields])
    write_batch(rows, root, "certification_history", batch, by=None)
    finish_batch(licences.sparkSession, root, batch)


def certification_history(spark: SparkSession, root: str) -> DataFrame:
    """All deliveries so far."""
    return read_store(spark, root, "certification_history")

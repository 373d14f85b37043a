"""Report registry: submitted reports and their result rows, each report link once."""

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelline.operators.catalogue import registry_children, registry_insert
from gavelline.session import cut
from gavelline.sources.store import SCHEMAS, finish_batch, read_store, write_batch


def register_reports(
    submissions: DataFrame, results: DataFrame, root: str, when: datetime | None = None, batch: str | None = None
) -> None:
    """Store the reports whose link is new, and their result rows; a batch that is written again replaces itself."""
    batch, when = batch or uuid.uuid4().hex, when or datetime.now(timezone.utc)
    stamp = F.lit(when.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    known = read_store(submissions.sparkSession, root, "reports", without=batch)
    added = cut(registry_insert(submissions, known).withColumn("scraped_at", stamp))
    for name, rows in (("results", registry_children(results, added)), ("reports", added)):
        write_batch(rows.select(*[c.split()[0] for c in SCHEMAS[name].split(", ")]), root, name, batch, by=None)
    finish_batch(submissions.sparkSession, root, batch)

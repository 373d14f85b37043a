"""Documents as files under names of their own."""

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame


def write_documents(docs: DataFrame, folder: str) -> int:
    """Write each (filename, body) row as the file `folder`/`filename`; returns the number of files.

    Tasks write to a folder of the run, whose output counts only when all have finished.  Then every file is renamed to its place,
    where it replaces an older one.  A run that fails before leaves nothing, one that is stopped between renames leaves whole files
    only and is repaired by running again.  The driver handles names, one per document, never bodies.
    """
    spark = docs.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    target = path(folder)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    staging = path(f"{folder.rstrip('/')}-{uuid.uuid4().hex}")
    try:
        # all rows of a name are one task's, so there is one file per name
        docs.select("filename", "body").repartition("filename").write.partitionBy("filename").text(staging.toString())
        fs.mkdirs(target)
        n = 0
        for place in fs.listStatus(staging):
            key, _, name = place.getPath().getName().partition("=")
            if key != "filename":
                continue
            part = next(f.getPath() for f in fs.listStatus(place.getPath()) if f.getPath().getName().startswith("part-"))
            final = path(target, unquote(name))
            fs.delete(final, False)
            if not fs.rename(part, final):
                raise OSError(f"could not move {part} to {final}")
            n += 1
        return n
    finally:
        fs.delete(staging, True)

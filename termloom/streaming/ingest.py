"""Repeated indexing of a growing folder, as a stream of files.

The operators are the batch ones: each micro-batch of new files is written to the
index in APPEND fashion, added or replaced by path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from termloom.functions.names import file_name, has_extension
from termloom.plans.index import CREATE_OR_APPEND, TextIndex
from termloom.session import materialize
from termloom.sources.files import file_documents

_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_files(
    spark: SparkSession, root: str, extensions=(), top: int = 0, bottom: int = 0, per_batch: int | None = None
) -> DataFrame:
    """The documents of files below ``root``, as they arrive."""
    reader = spark.readStream.format("binaryFile").schema(_FILE).option("recursiveFileLookup", True)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    files = reader.load(root)
    wanted = has_extension(file_name(F.col("path")), extensions)
    if wanted is not None:
        files = files.filter(wanted)
    return file_documents(files, (), top, bottom)


def start_indexing(
    docs: DataFrame, folder: str, checkpoint: str, update: bool = True
) -> StreamingQuery:
    """Write every document of the stream to the index in ``folder``, then stop.

    With ``update`` a batch that is run again after a failure replaces its own rows,
    so each file counts once; without it a repeated batch would be added again.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        # The batch is read from its files once; all that follows reads the table.
        batch = materialize(batch, "arrived")
        if not batch.isEmpty():
            TextIndex.write(batch, folder, CREATE_OR_APPEND, update, order="modified")

    return (
        docs.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
    )

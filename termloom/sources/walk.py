"""A corpus of files by a listing and a reader of its own, which keep every file.

Spark's file sources leave out empty files and names that begin with ``.`` or ``_``, and open a file whole.
Here folders are listed by tasks, level by level, into a table of files; the files are then dealt evenly
by that table and read in tasks. If only lines are wanted, blocks are read from the two ends of a
file until they hold these lines, so a file of any size costs what its lines cost.

Stores are those that Arrow's file systems open from a URI (local or mounted folders, S3, GCS, HDFS).
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from termloom.functions.content import bottom_lines, whole_content
from termloom.functions.names import file_name, has_extension
from termloom.functions.stamps import iso_stamp, minute_stamp, utc
from termloom.operators.documents import number_documents
from termloom.session import materialize

LISTED = "path string, is_file boolean, length bigint, modificationTime timestamp"
BLOCK = 1 << 16  # bytes read at once from an end of a file; the next block is twice as large
TASK_BYTES = 64 << 20  # of files that one task reads
_BATCH_BYTES = 32 << 20  # contents that leave a task at once
_LINE_END = re.compile(rb"\r\n|\r|\n")


def _store(path: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of a path, the path in it, and what to put before a path to name it in full."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path, ""
    if path.startswith("file:"):  # taken as it is written: names may hold % and +
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/"), "file:"
    store, inside = fs.FileSystem.from_uri(path)
    return store, inside, path[: len(path) - len(inside)] if path.endswith(inside) else path.split("://")[0] + "://"


def _entries(path: str) -> Iterator[tuple]:
    """A file itself, or what a folder holds; nothing for what cannot be listed."""
    try:
        store, inside, prefix = _store(path)
        own = store.get_file_info([inside])[0]
        found = [own] if own.type == fs.FileType.File else store.get_file_info(fs.FileSelector(inside))
    except OSError:
        return
    for info in found:
        if info.type in (fs.FileType.File, fs.FileType.Directory):
            yield prefix + info.path, info.type == fs.FileType.File, info.size, info.mtime


def has_entries(path: str) -> bool:
    """True for a file, and for a folder that holds something."""
    return next(_entries(path), None) is not None


def _list_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            rows = list(_entries(path))
            for at in range(0, len(rows), 10_000):
                columns = list(zip(*rows[at : at + 10_000]))
                types = (pa.string(), pa.bool_(), pa.int64(), pa.timestamp("us", "UTC"))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], ["path", "is_file", "length", "modificationTime"])


def walk(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    """(path, length, modificationTime) of every file below the roots, a root being a folder or a file.

    Each level of folders is one job whose tasks list some folders each, so neither a task nor the driver
    holds the listing of the tree. Folders and files that cannot be listed are left out, links are followed.
    A file below two of the roots comes twice.
    """
    folders = spark.createDataFrame([(r,) for r in roots], "path string")
    tasks = max(1, spark.sparkContext.defaultParallelism)
    found = None
    while True:
        level = materialize(folders.repartition(tasks).mapInArrow(_list_batches, LISTED), "listing")
        files = level.filter("is_file").drop("is_file")
        found = files if found is None else found.unionByName(files)
        folders = level.filter("NOT is_file").select("path")
        if folders.isEmpty():
            return found


# --- reading ---------------------------------------------------------------------------------


def head_lines(source, size: int, n: int, block: int = BLOCK) -> bytes:
    """The first ``n`` lines of a file with their ends, from blocks read from its start."""
    data, places = b"", []
    while True:
        more = source.read(block) if len(data) < size else b""
        data += more
        ended = not more or len(data) >= size
        # A carriage return that ends the bytes read so far may be half of an end.
        places = [m.end() for m in _LINE_END.finditer(data) if ended or m.end() < len(data)]
        if len(places) >= n:
            return data[: places[n - 1]] if n > 0 else b""
        if ended:
            return data
        block *= 2


def tail_lines(source, begin: int, size: int, n: int, block: int = BLOCK) -> bytes:
    """The last ``n`` lines after the place ``begin``, from blocks read backwards from the end."""
    if n <= 0:
        return b""
    at, data = size, b""
    while at > begin:
        low = max(begin, at - block)
        source.seek(low)
        data = source.read(at - low) + data
        at, block = low, block * 2
        # The end of the last line begins no line.
        starts = [m.end() for m in _LINE_END.finditer(data) if m.end() < len(data)]
        if len(starts) >= n and (at == begin or starts[-n] > 0):
            return data[starts[-n] :]
    return data


def _read_batches(top: int, bottom: int, block: int):
    """Bytes of files: all, or the lines at the start (head) and at the end (tail)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ready(kept: list) -> pa.RecordBatch:
            rows = rows_of.take(pa.array([k for k, _, _ in kept], pa.int64()))
            ends = [pa.array([x[j] for x in kept], pa.binary()) for j in (1, 2)]
            return pa.record_batch([*rows.columns, *ends], [*rows.schema.names, "head", "tail"])

        for rows_of in batches:
            kept, held = [], 0
            columns = (rows_of.column(c).to_pylist() for c in ("path", "length"))
            for k, (path, size) in enumerate(zip(*columns)):
                try:
                    store, inside, _ = _store(path)
                    with store.open_input_file(inside) as source:
                        if top == 0 and bottom == 0:
                            ends = source.read(), b""
                        else:
                            head = head_lines(source, size, max(top, 0), block) if top else b""
                            ends = head, tail_lines(source, len(head), size, max(bottom, 0), block)
                except OSError:
                    continue
                kept.append((k, *ends))
                held += len(ends[0]) + len(ends[1])
                if held >= _BATCH_BYTES:
                    yield ready(kept)
                    kept, held = [], 0
            if kept:
                yield ready(kept)

    return run


def _schema(rows: DataFrame) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in rows.dtypes) + ", head binary, tail binary"


def read_files(listing: DataFrame, top: int = 0, bottom: int = 0, block: int = BLOCK) -> DataFrame:
    """The files of a listing as documents, with the columns of ``scan_files``; further columns are kept.

    The listing is dealt into tasks of about TASK_BYTES. Files that cannot be read are left out.
    ``length`` is the size that was listed: what is appended meanwhile is not read as lines.
    """
    total = listing.agg(F.sum("length")).first()[0] or 0
    least = listing.sparkSession.sparkContext.defaultParallelism
    dealt = listing.repartition(max(least, -(-total // TASK_BYTES)))
    found = dealt.mapInArrow(_read_batches(top, bottom, block), _schema(listing))
    text = lambda c: F.make_valid_utf8(F.col(c).cast("string"))
    changed = utc(F.col("modificationTime"))
    contents = whole_content(text("head"))
    if bottom != 0:
        contents = F.concat(contents, bottom_lines(text("tail"), max(bottom, 0)))
    kept = [c for c in listing.columns if c not in ("path", "length", "modificationTime")]
    return found.select(
        *kept,
        "path",
        contents.alias("contents"),
        F.col("length").cast("double").alias("sizeKb"),
        iso_stamp(changed).alias("lastModifiedTime"),
        minute_stamp(changed).alias("lastModifiedTimeLucene"),
        F.col("modificationTime").alias("modified"),
    )


def scan_all(
    spark: SparkSession,
    roots: Sequence[str],
    extensions: Sequence[str] = (),
    top: int = 0,
    bottom: int = 0,
    first_id: int | None = None,
) -> DataFrame:
    """Every file below the roots as a document: as ``scan_files``, with empty files and all names.

    The extension test is on listed names, so other files are not opened. With ``first_id`` documents
    are numbered from there in the order of their paths; the numbers go to the listing, before anything is read,
    and a file that then cannot be read leaves a gap.
    """
    files = walk(spark, roots)
    wanted = has_extension(file_name(F.col("path")), extensions)
    if wanted is not None:
        files = files.filter(wanted)
    if first_id is not None:
        ordered = files.repartitionByRange("path").sortWithinPartitions("path")
        files = number_documents(ordered, first_id)
    return read_files(files, top, bottom)


# --- writing ---------------------------------------------------------------------------------


def _write_batches(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = set()
        for batch in batches:
            done = 0
            for path, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, inside, _ = _store(f"{root.rstrip('/')}/{path.lstrip('/')}")
                folder = inside.rpartition("/")[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(inside, compression=None) as out:  # not by the name's extension
                    out.write((text or "").encode())
                done += 1
            yield pa.record_batch({"files": pa.array([done], pa.int64())})

    return run


def write_files(rows: DataFrame, root: str) -> int:
    """Write (path, text) rows as one file each below ``root``; returns how many. A null text gives an empty file.

    A task that runs again writes the same files again. Paths are distinct.
    """
    written = rows.select("path", "text").mapInArrow(_write_batches(root), "files bigint")
    return written.agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]

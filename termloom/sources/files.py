"""A corpus of text files below one or more roots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from termloom.functions.content import select_content
from termloom.functions.names import file_name, has_extension
from termloom.functions.stamps import iso_stamp, minute_stamp, utc
from termloom.operators.documents import number_scan


def listed_name() -> Column:
    """The file name known from listing the folder; Spark gives it in URL form."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def file_documents(files: DataFrame, key: Sequence[str] = (), top: int = 0, bottom: int = 0) -> DataFrame:
    """Rows of the binaryFile source as documents."""
    changed = utc(F.col("modificationTime"))
    # A column of its own: the content expression refers to the text several times.
    decoded = files.withColumn("_text", F.make_valid_utf8(F.col("content").cast("string")))
    return decoded.select(
        *key,
        F.col("path"),
        select_content(F.col("_text"), top, bottom).alias("contents"),
        F.col("length").cast("double").alias("sizeKb"),
        iso_stamp(changed).alias("lastModifiedTime"),
        minute_stamp(changed).alias("lastModifiedTimeLucene"),
        F.col("modificationTime").alias("modified"),
    )


def qualified(spark: SparkSession, root: str) -> Column:
    """``path`` in the form in which a scan of ``root`` gives it: with scheme, and one slash where
    there is no authority."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    uri = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri()
    prefix = f"{uri.getScheme()}:" + (f"//{uri.getAuthority()}" if uri.getAuthority() else "")
    plain = F.startswith(F.col("path"), F.lit("/"))
    named = F.when(plain, F.concat(F.lit(prefix), "path")).otherwise(F.col("path"))
    return F.regexp_replace(named, "^([A-Za-z][A-Za-z0-9+.-]*):///+", "$1:/")


def unlisted(manifest: DataFrame, listed: DataFrame, root: str, extensions: Sequence[str]) -> DataFrame:
    """Documents for the empty files of a manifest that a listing (path) lacks.

    Only paths are joined. A file that the listing has but that cannot be read stays out.
    """
    rows = manifest.withColumn("path", qualified(manifest.sparkSession, root))
    if "length" in manifest.columns:
        rows = rows.filter(F.col("length") == 0)
    wanted = has_extension(file_name(F.col("path")), extensions)
    if wanted is not None:
        rows = rows.filter(wanted)
    if "modificationTime" not in manifest.columns:
        rows = rows.withColumn("modificationTime", F.lit(None).cast("timestamp"))
    rows = rows.select("path", "modificationTime").distinct().join(listed.select("path"), "path", "left_anti")
    empty = rows.withColumn("content", F.lit(b"")).withColumn("length", F.lit(0).cast("bigint"))
    return file_documents(empty)


def scan_files(
    spark: SparkSession,
    roots: Sequence[str],
    extensions: Sequence[str] = (),
    top: int = 0,
    bottom: int = 0,
    manifest: DataFrame | None = None,
    first_id: int | None = None,
) -> DataFrame:
    """One row per file: path, contents, sizeKb (bytes) and the time it was changed.

    A root is a folder, read with all folders below it, or a single file. The
    extension test uses the file name only, so other files are never opened.
    Files that cannot be read are left out.

    Spark's file sources give no row for an empty file or a name that starts with
    ``.`` or ``_``. A ``manifest`` (path[, length, modificationTime]) of expected files
    adds those that the scan does not list, with empty contents; with ``length`` only
    files of no length. Its paths may lack the scheme, and the extension test applies.
    All files of the scan stay, listed or not. With ``first_id`` the files found by the
    scan are numbered from there as doc_id; that excludes a manifest.
    """
    if manifest is not None and first_id is not None:
        raise ValueError("only the files of the scan itself can be numbered by it")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("ignoreCorruptFiles", True)
        .option("ignoreMissingFiles", True)
        .load(list(roots))
    )
    wanted = has_extension(listed_name(), extensions)
    if wanted is not None:
        files = files.filter(wanted)
    key = []
    if first_id is not None:
        files = number_scan(files, first_id)
        key = ["doc_id"]
    docs = file_documents(files, key, top, bottom)
    if manifest is not None:
        docs = docs.unionByName(unlisted(manifest, files, roots[0], extensions))
    return docs

"""A stored corpus: Parquet tables of documents with their vectors, and of their frequencies.

A document's fields and its term vector are one row, so adding documents is one
append, and no join is needed to bring a document and its terms together. Rows of a batch are in
doc_id order, so a read by doc_id skips row groups.

A version is a folder with ``docs``, ``doc_freq`` and ``field_sums``, each with a folder per batch. CREATE starts a
new version; all else adds a batch. Readers take the newest version whose first batch Spark has marked
complete, and of it the complete batches only. A batch that replaces documents comes with the list of
their paths (``replaced``): readers leave out rows of earlier batches with these paths, and its
frequencies hold, with a minus, those of the rows replaced. So an update writes in proportion to itself.
The frequencies of a batch, and the sums of its fields, are counted from its stored vectors; a reader
sums them over batches, and reports ask them, not the corpus.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from termloom.operators import best_terms as best
from termloom.operators import clusters
from termloom.operators import fields as stats
from termloom.operators import similar_terms as similar
from termloom.operators import term_documents as shared
from termloom.operators import term_vectors as terms
from termloom.operators.documents import last_per_key, number_documents
from termloom.session import materialize
from termloom.sizes import broadcast_if_small, dealt_tasks

CREATE, APPEND, CREATE_OR_APPEND = "CREATE", "APPEND", "CREATE_OR_APPEND"
OPEN_MODES = (CREATE, APPEND, CREATE_OR_APPEND)

# In a document's order of fields. sizeKb is kept as a number only: it is neither
# listed nor counted among the fields with terms.
STORED_FIELDS = ("path", terms.CONTENTS, "lastModifiedTime", "lastModifiedTimeLucene")
NOT_FIELDS = ("doc_id", "sizeKb", "modified", "n_tokens", "n_terms", "terms", "freqs", "positions")


def _complete(spark: SparkSession, pattern: str, above: int) -> list[str]:
    """Names of the folders ``above`` levels over the completion marks of a pattern, in order."""
    return _named(spark, f"{pattern}/_SUCCESS", above)


def _named(spark: SparkSession, pattern: str, above: int = 0) -> list[str]:
    """Names of the folders ``above`` levels over what fits a pattern, in order."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = []
    for mark in fs.globStatus(root) or []:
        path = mark.getPath()
        for _ in range(above):
            path = path.getParent()
        names.append(path.getName())
    return sorted(names)


def _versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete versions in a folder, oldest first."""
    return [int(n[1:]) for n in _complete(spark, f"{folder.rstrip('/')}/v*/docs/batch=000000", 3)]


def _next_version(spark: SparkSession, folder: str) -> int:
    """A number that no version has, complete or not."""
    return max([int(n[1:]) for n in _named(spark, f"{folder.rstrip('/')}/v*")], default=0) + 1


def _version_path(folder: str, version: int, table: str = "docs") -> str:
    return f"{folder.rstrip('/')}/v{version:06d}/{table}"


def _store(rows: DataFrame, path: str) -> None:
    """Write a table where there is none: of two writers of one batch the second fails, and nothing is lost."""
    try:
        rows.write.mode("errorifexists").parquet(path)
    except AnalysisException as found:
        if "PATH_ALREADY_EXISTS" not in str(found):
            raise
        raise FileExistsError(f"another writer has begun {path}") from found


def _fields_of(columns: Sequence[str]) -> list[str]:
    known = [f for f in STORED_FIELDS if f in columns]
    return known + [c for c in columns if c not in known and c not in NOT_FIELDS]


class TextIndex:
    """The stored corpus in ``folder`` at its newest version."""

    def __init__(self, spark: SparkSession, folder: str):
        found = _versions(spark, folder)
        if not found:
            raise FileNotFoundError(f"no index in {folder}")
        self.spark, self.folder, self.version = spark, folder, found[-1]

    @classmethod
    def write(
        cls,
        docs: DataFrame,
        folder: str,
        mode: str = CREATE_OR_APPEND,
        update: bool = False,
        order: str | None = None,
    ) -> "TextIndex":
        """Analyse ``docs`` and store them.

        CREATE starts anew, APPEND needs an index, CREATE_OR_APPEND takes either.
        ``update`` replaces documents of the same path, the last by ``order``;
        otherwise documents are added. Rows without a doc_id get the next numbers;
        ``scan_files`` can number its rows itself, which saves writing them twice.
        """
        if mode not in OPEN_MODES:
            raise ValueError(f"mode must be one of {OPEN_MODES}, not {mode!r}")
        spark = docs.sparkSession
        found = _versions(spark, folder)
        if mode == APPEND and not found:
            raise FileNotFoundError(f"no index in {folder} to append to")
        if mode == CREATE and update:
            warnings.warn("update has no effect in CREATE mode; documents are added")
        fresh = mode == CREATE or not found
        stored = None if fresh else cls(spark, folder)
        if "doc_id" in docs.columns:
            # A number of tasks of its own: adaptive execution would join them to about one per core, in two waves.
            docs = docs.repartitionByRange(dealt_tasks(docs), "doc_id").sortWithinPartitions("doc_id")
        else:
            docs = number_documents(docs, 0 if fresh else stored.next_doc_id())
        if fresh:
            path = _version_path(folder, _next_version(spark, folder))
            _store(terms.with_vectors(docs), f"{path}/batch=000000")
            stored = cls(spark, folder)
            stored._write_freqs()
            stored._write_sums()
            return stored
        keys = None
        if update:
            # One table gives both the rows and the keys that they replace.
            docs = last_per_key(materialize(docs, "arrived"), "path", order)
            keys = docs.select("path").filter("path IS NOT NULL").distinct()
        stored._add_batch(terms.with_vectors(docs), keys)
        return stored

    def _path(self, table: str, batch: str = "") -> str:
        return f"{_version_path(self.folder, self.version, table)}/{batch}".rstrip("/")

    def _add_batch(
        self,
        rows: DataFrame,
        keys: DataFrame | None = None,
        freqs: DataFrame | None = None,
        sums: DataFrame | None = None,
    ) -> None:
        """Store rows with vectors as a further batch. The list of paths that they replace comes first, so that
        it is there when the mark of the rows completes the batch."""
        used = [_named(self.spark, self._path(t, "batch=*")) for t in ("docs", "replaced")]
        batch = f"batch={max(int(n[len('batch='):]) for names in used for n in names) + 1:06d}"
        if keys is not None:
            _store(keys, self._path("replaced", batch))
        _store(rows, self._path("docs", batch))
        self._write_freqs(freqs)
        self._write_sums(sums)

    def _write_freqs(self, freqs: DataFrame | None = None) -> None:
        """The frequencies of the newest batch, counted from it if they are not given."""
        names = self._batches("docs")
        freqs = self._batch_freqs(names) if freqs is None else freqs
        ordered = freqs.repartitionByRange("field", "term").sortWithinPartitions("field", "term")
        _store(ordered, self._path("doc_freq", names[-1]))

    def _write_sums(self, sums: DataFrame | None = None) -> None:
        """The field sums of the newest batch, a few rows, counted from it if they are not given."""
        names = self._batches("docs")
        sums = self._batch_sums(names) if sums is None else sums
        _store(sums.coalesce(1), self._path("field_sums", names[-1]))

    def _replaced_by(self, names: list[str]) -> DataFrame | None:
        """Rows of earlier batches that the last of these replaces; None if it is no update."""
        if names[-1] not in self._batches("replaced"):
            return None
        keys = self.spark.read.parquet(self._path("replaced", names[-1]))
        return self._live(names[:-1]).join(broadcast_if_small(keys), "path", "left_semi")

    def _batch_sums(self, names: list[str]) -> DataFrame:
        """Field sums of the last of these batches, less those of the rows that it replaces."""
        rows = self.spark.read.parquet(self._path("docs", names[-1]))
        sums = stats.field_sums(rows, _fields_of(rows.columns))
        old = self._replaced_by(names)
        if old is None:
            return sums
        less = stats.field_sums(old, _fields_of(old.columns))
        return stats.add_sums(sums.unionByName(less.select("field", *((-F.col(c)).alias(c) for c in stats.SUMS))))

    def _batch_freqs(self, names: list[str]) -> DataFrame:
        """(field, term, df) of the last of these batches, less those of the rows that it replaces."""
        rows = self.spark.read.parquet(self._path("docs", names[-1]))
        freqs = terms.doc_freq(rows, _fields_of(rows.columns))
        old = self._replaced_by(names)
        if old is None:
            return freqs
        less = terms.doc_freq(old, _fields_of(old.columns)).withColumn("df", -F.col("df"))
        both = freqs.unionByName(less).groupBy("field", "term").agg(F.sum("df").alias("df"))
        return both.filter(F.col("df") != 0)

    @classmethod
    def merge(cls, spark: SparkSession, sources: Sequence[str], folder: str) -> "TextIndex":
        """Add the indexes in the folders ``sources`` to the one in ``folder``, or start it with them.

        Vectors and frequencies are taken as stored: no text is analysed again. Documents of a source keep their
        order and get numbers after those before; a path met twice stays twice.
        """
        found = _versions(spark, folder)
        target = cls(spark, folder) if found else None
        start = target.next_doc_id() if target else 0
        rows, freqs, sums = [], [], []
        for source in sources:
            index = cls(spark, source)
            rows.append(index.table.withColumn("doc_id", F.col("doc_id") + F.lit(start)))
            freqs.append(index.doc_freq().select("field", "term", "df"))
            sums.append(index.field_sums())
            start += index.next_doc_id()
        every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
        summed = reduce(DataFrame.unionByName, freqs).groupBy("field", "term").agg(F.sum("df").alias("df"))
        added = stats.add_sums(reduce(DataFrame.unionByName, sums))
        if target is None:
            _store(every, f"{_version_path(folder, _next_version(spark, folder))}/batch=000000")
            target = cls(spark, folder)
            target._write_freqs(summed)
            target._write_sums(added)
        else:
            target._add_batch(every, freqs=summed, sums=added)
        return target

    def _batches(self, table: str) -> list[str]:
        return _complete(self.spark, self._path(table, "batch=*"), 1)

    def vacuum(self, keep: int = 1) -> list[int]:
        """Delete all but the newest ``keep`` versions; returns the numbers of those deleted.

        Only when nobody reads the old ones any more.
        """
        old = _versions(self.spark, self.folder)[: -max(keep, 1)]
        jvm = self.spark.sparkContext._jvm
        for version in old:
            path = jvm.org.apache.hadoop.fs.Path(_version_path(self.folder, version)).getParent()
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        return old

    def next_doc_id(self) -> int:
        """The number after the highest in use."""
        return self.table.agg(F.coalesce(F.max("doc_id"), F.lit(-1)) + 1).first()[0]

    def _live(self, names: Sequence[str]) -> DataFrame:
        """Rows of these batches that no later one of them replaces."""
        read = self.spark.read.option("mergeSchema", True)
        rows = read.option("basePath", self._path("docs")).parquet(*(self._path("docs", n) for n in names))
        later = [n for n in self._batches("replaced") if n in names]
        if later:
            lists = self.spark.read.option("basePath", self._path("replaced"))
            keys = lists.parquet(*(self._path("replaced", n) for n in later))
            keys = keys.groupBy(F.col("path").alias("again")).agg(F.max("batch").alias("until"))
            gone = (F.col("path") == F.col("again")) & (F.col("batch") < F.col("until"))
            rows = rows.join(broadcast_if_small(keys), gone, "left_anti")
        return rows.drop("batch")

    @property
    def table(self) -> DataFrame:
        """All documents; a field that a batch lacks is null in its rows."""
        return self._live(self._batches("docs"))

    @property
    def fields(self) -> list[str]:
        """Stored fields in document order: the known ones, then any others kept."""
        return _fields_of(self.table.columns)

    def field_sums(self) -> DataFrame:
        """Mergeable sums of every field, of all documents under ``stats.ALL_DOCS``, summed over batches."""
        names = self._batches("docs")
        counted = set(self._batches("field_sums"))
        stored = [self._path("field_sums", n) for n in names if n in counted]
        parts = [self.spark.read.parquet(*stored).select("field", *stats.SUMS)] if stored else []
        # A writer may have stopped between the tables.
        parts += [self._batch_sums(names[: k + 1]) for k, n in enumerate(names) if n not in counted]
        return stats.add_sums(reduce(DataFrame.unionByName, parts))

    def corpus_size(self) -> DataFrame:
        return stats.size_of_sums(self.field_sums())

    def list_fields(self) -> DataFrame:
        return stats.list_fields(self.table, self.fields)

    def write_field_list(self, output: str) -> None:
        stats.write_field_list(self.list_fields(), self.folder, output)

    def field_stats(self, field: str | None = None) -> DataFrame:
        """Statistics of one field, or of every stored field, from the stored sums: no document is read."""
        return stats.stats_of_sums(self.field_sums(), self.fields if field is None else [field])

    def term_vectors(self, field: str = terms.CONTENTS) -> DataFrame:
        return terms.term_vectors(self.table, field, positions=True)

    def doc_freq(self, fields: Sequence[str] | None = None) -> DataFrame:
        """(field, term, df) as stored, summed over batches."""
        names = self._batches("docs")
        counted = set(self._batches("doc_freq"))
        stored = [self._path("doc_freq", n) for n in names if n in counted]
        parts = [self.spark.read.parquet(*stored).select("field", "term", "df")] if stored else []
        # A writer may have stopped between the two tables.
        parts += [self._batch_freqs(names[: k + 1]) for k, n in enumerate(names) if n not in counted]
        freqs = reduce(DataFrame.unionByName, parts)
        if fields is not None:
            freqs = freqs.filter(F.col("field").isin(*fields))
        if len(names) > 1:
            freqs = freqs.groupBy("field", "term").agg(F.sum("df").alias("df")).filter(F.col("df") > 0)
        return freqs

    def vocabulary(self, field: str = terms.CONTENTS) -> DataFrame:
        rows = self.doc_freq([field]).select("term")
        return rows if field in terms.VECTOR_FIELDS else rows.limit(0)

    def best_terms(
        self,
        doc_id: int,
        field: str = terms.CONTENTS,
        order: str = "tfxidf",
        top: int = 0,
        idf_mode: str = "default",
    ) -> DataFrame:
        weights = best.weights_by_freqs(self.table, self.doc_freq([field]), doc_id, field, idf_mode)
        return best.best_terms(weights, order, top)

    def term_weights(self, idf_mode: str = "default") -> DataFrame:
        return best.term_weights(self.table, self.doc_freq([terms.CONTENTS]), idf_mode)

    def best_terms_all(self, order: str = "tfxidf", top: int = 10, idf_mode: str = "default") -> DataFrame:
        weights = best.leading_weights(self.table, self.doc_freq([terms.CONTENTS]), order, top, idf_mode)
        return best.best_terms_all(weights, order, top)

    def similar_terms(self, term: str, top: int, field: str = terms.CONTENTS) -> DataFrame:
        return similar.similar_terms(self.vocabulary(field), term, top)

    def similar_terms_batch(self, queries: DataFrame, top: int, field: str = terms.CONTENTS) -> DataFrame:
        return similar.similar_terms_batch(self.vocabulary(field), queries, top)

    def term_doc_vectors(self, rep: str = "tfxidf", idf_mode: str = "default") -> DataFrame:
        return shared.term_doc_vectors(self.table, self.doc_freq([terms.CONTENTS]), rep, idf_mode)

    def similar_by_documents(
        self, queries: DataFrame, top: int, rep: str = "tfxidf", idf_mode: str = "default"
    ) -> DataFrame:
        return shared.similar_by_documents(self.table, self.doc_freq([terms.CONTENTS]), queries, top, rep, idf_mode)

    def term_kmeans(self, k: int, rep: str = "tfxidf", idf_mode: str = "default", **choices) -> DataFrame:
        return clusters.term_kmeans(self.term_doc_vectors(rep, idf_mode), k, **choices)

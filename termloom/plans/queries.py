"""The registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from termloom.functions import stamps
from termloom.functions.names import extension
from termloom.operators import best_terms as best
from termloom.operators import documents as upkeep
from termloom.operators import fields as stats
from termloom.operators import similar_terms as similar
from termloom.operators import term_vectors as terms
from termloom.plans.index import APPEND, CREATE, TextIndex
from termloom.session import new_folder
from termloom.sources.tables import read_table, table_corpus
from termloom.sources.walk import has_entries, scan_all, write_files

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries; the SQL uses the same.
EXTENSIONS = (".txt", ".c")
TOP_LINES, BOTTOM_LINES = 3, 2
TOP_OF_DOCUMENT, TOP_OF_EACH, TOP_SIMILAR = 25, 5, 20
QUERY_TERMS = 300  # the terms of most documents, as query words
CLUSTERS = 20
QUERY_WORD = "weather"
KEYWORDS = ("path", "lang", "source")
FIELDS = ("path", terms.CONTENTS, "lang", "source")


def _file(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def document_path() -> Column:
    """A path for a document: /corpus/<lang>/<source>/<doc_id>, extension by language."""
    suffix = (
        F.when(F.col("lang") == "en", ".txt")
        .when(F.col("lang") == "de", ".c")
        .when(F.col("lang") == "fr", ".tar.gz")
        .otherwise("")
    )
    return F.concat(F.lit("/corpus/"), "lang", F.lit("/"), "source", F.lit("/"), "doc_id", suffix)


# Indexes of this session, by application and tables: a report asks the index that is there.
_indexes: dict[tuple[str, str], str] = {}


def stored_index(spark: SparkSession, sf_dir: str) -> TextIndex:
    """The index of the documents, written when first asked for."""
    key = spark.sparkContext.applicationId, sf_dir
    if key in _indexes:
        try:
            return TextIndex(spark, _indexes[key])
        except FileNotFoundError:  # its folder was cleaned up
            del _indexes[key]
    folder = new_folder(spark, "index")
    index = TextIndex.write(corpus(spark, sf_dir), folder, CREATE)
    _indexes[key] = folder
    return index


def corpus(spark: SparkSession, sf_dir: str, **choices) -> DataFrame:
    """The documents, ready for the analysis of their texts."""
    rows = read_table(spark, _file(sf_dir, "documents"), ("doc_id", "text", "lang", "source"), "doc_id")
    return table_corpus(rows, document_path(), keep=("lang", "source"), **choices)


def talk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as documents without a number of their own."""
    rows = read_table(spark, _file(sf_dir, "conversations"), ("conv_id", "turn", "text"))
    path = F.concat(F.lit("/talk/"), "conv_id", F.lit("/"), "turn", F.lit(".txt"))
    return table_corpus(rows, path, doc_id=None)


def web(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, _file(sf_dir, "pages"), ("url", "html"))
    return table_corpus(rows, F.col("url"), text="html", doc_id=None)


def delivery(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """An existing document table, and a batch: all conversation turns, and new texts for the
    documents that have a label, two of them for toxic ones. ``version`` tells which is later."""
    existing = _plain_corpus(spark, sf_dir).drop("doc_id", "sizeKb")
    labels = spark.read.parquet(_file(sf_dir, "labels"))
    rows = spark.read.parquet(_file(sf_dir, "documents"))
    batches = []
    for version, some in ((2, labels), (3, labels.filter("toxic = 1"))):
        again = rows.join(some.select("doc_id"), "doc_id", "left_semi")
        again = again.withColumn("text", F.concat("text", F.lit(f" v{version}")))
        new = table_corpus(again, document_path(), keep=("lang", "source")).drop("doc_id", "sizeKb")
        batches.append(new.withColumn("version", F.lit(version)))
    turns = talk(spark, sf_dir).select("path", "contents").withColumn("version", F.lit(2))
    return existing, upkeep.merge_partials([*batches, turns])


def richest_document(table: DataFrame) -> int:
    """The doc_id of the document with the most terms, for one-document reports."""
    return table.select("doc_id", "n_terms").orderBy(F.desc("n_terms"), "doc_id").first()["doc_id"]


def _content(**choices) -> Query:
    return lambda spark, sf_dir: _plain_corpus(spark, sf_dir, **choices).select("doc_id", "contents")


def _plain_corpus(spark: SparkSession, sf_dir: str, **choices) -> DataFrame:
    """The documents as scanned, for queries that do not analyse texts."""
    rows = spark.read.parquet(_file(sf_dir, "documents"))
    return table_corpus(rows, document_path(), keep=("lang", "source"), **choices)


# Folders of documents as files, as for the indexes above.
_folders: dict[tuple[str, str], str] = {}


def written_corpus(spark: SparkSession, sf_dir: str) -> str:
    """A folder in the shared place with a file for each document, at its path; written when first asked for."""
    key = spark.sparkContext.applicationId, sf_dir
    if key in _folders and has_entries(_folders[key]):
        return _folders[key]
    rows = read_table(spark, _file(sf_dir, "documents"), ("doc_id", "text", "lang", "source"), "doc_id")
    folder = new_folder(spark, "files")
    write_files(rows.select(document_path().alias("path"), "text"), folder)
    _folders[key] = folder
    return folder


def _scanned(spark: SparkSession, sf_dir: str, **choices) -> DataFrame:
    folder = written_corpus(spark, sf_dir)
    rows = scan_all(spark, [f"{folder}/corpus"], **choices)
    return rows.withColumn("path", F.concat(F.lit("/corpus/"), F.substring_index("path", "/corpus/", -1)))


def corpus_scan(spark, sf_dir):
    """The documents as files, listed and read by tasks."""
    return _scanned(spark, sf_dir).select("path", "contents", "sizeKb")


def scan_lines(spark, sf_dir):
    """The first and last lines of the documents as files, of which only these lines are read."""
    return _scanned(spark, sf_dir, top=TOP_LINES, bottom=BOTTOM_LINES).select("path", "contents")


def file_extension(spark, sf_dir):
    paths = _plain_corpus(spark, sf_dir).select("path")
    urls = spark.read.parquet(_file(sf_dir, "pages")).select(F.col("url").alias("path"))
    return paths.unionByName(urls).select("path", extension(F.col("path")).alias("ext"))


def extension_filter(spark, sf_dir):
    return _plain_corpus(spark, sf_dir, extensions=EXTENSIONS).select("path", "sizeKb")


def file_size(spark, sf_dir):
    return _plain_corpus(spark, sf_dir).select("doc_id", "sizeKb")


def _event_stamp(stamp: Callable[[Column], Column]) -> Query:
    def query(spark, sf_dir):
        events = spark.read.parquet(_file(sf_dir, "events"))
        return events.select("event_id", stamp(F.col("ts").cast("timestamp_ntz")).alias("stamp"))

    return query


def tokenize(spark, sf_dir):
    return terms.tokenize(corpus(spark, sf_dir))


def _positions_as_text() -> Column:
    return F.array_join(F.col("positions").cast("array<string>"), " ").alias("positions")


def term_vectors(spark, sf_dir):
    rows = terms.term_vectors(terms.with_vectors(corpus(spark, sf_dir)), positions=True)
    return rows.select("field", "doc_id", "term", "freq", _positions_as_text())


def keyword_terms(spark, sf_dir):
    return terms.keyword_terms(_plain_corpus(spark, sf_dir), KEYWORDS)


def vocabulary(spark, sf_dir):
    return terms.vocabulary(corpus(spark, sf_dir))


def doc_freq(spark, sf_dir):
    return terms.doc_freq(corpus(spark, sf_dir), FIELDS)


def add_documents(spark, sf_dir):
    return upkeep.add_documents(*delivery(spark, sf_dir)).drop("version")


def upsert_documents(spark, sf_dir):
    return upkeep.upsert_documents(*delivery(spark, sf_dir), order="version").drop("version")


def _with_vector_text(table: DataFrame) -> DataFrame:
    """Documents of an index with all their fields, and their vectors as "term:freq ..."."""
    cells = F.transform(F.arrays_zip("terms", "freqs"), lambda t: F.concat(t["terms"], F.lit(":"), t["freqs"]))
    kept = [c for c in ("lang", "source") if c in table.columns]
    return table.select(
        "path", "contents", "sizeKb", "n_tokens", "n_terms", *kept, F.array_join(cells, " ").alias("vector")
    )


def write_mode_create(spark, sf_dir):
    """An index of the conversations, started anew with the documents."""
    folder = new_folder(spark, "index")
    TextIndex.write(talk(spark, sf_dir), folder, CREATE)
    index = TextIndex.write(corpus(spark, sf_dir), folder, CREATE)
    return _with_vector_text(index.table)


def write_mode_append(spark, sf_dir):
    """An index of the documents, to which the conversations are added."""
    folder = new_folder(spark, "index")
    TextIndex.write(corpus(spark, sf_dir), folder, CREATE)
    index = TextIndex.write(talk(spark, sf_dir), folder, APPEND)
    return _with_vector_text(index.table)


def merge_partials(spark, sf_dir):
    parts = [corpus(spark, sf_dir), talk(spark, sf_dir), web(spark, sf_dir)]
    merged = upkeep.merge_partials([terms.with_counts(p) for p in parts])
    return merged.select("path", "sizeKb", "n_tokens", "n_terms", "lang", "source")


def merge_indexes(spark, sf_dir):
    """Stored indexes of documents, conversations and pages in one; their texts are analysed once, each in its own."""
    folders = []
    for part in (corpus(spark, sf_dir), talk(spark, sf_dir), web(spark, sf_dir)):
        folders.append(new_folder(spark, "index"))
        TextIndex.write(part, folders[-1], CREATE)
    index = TextIndex.merge(spark, folders, new_folder(spark, "index"))
    return index.table.select("path", "sizeKb", "n_tokens", "n_terms", "lang", "source")


def list_fields(spark, sf_dir):
    return stored_index(spark, sf_dir).list_fields()


def field_stats(spark, sf_dir):
    return stats.field_stats(terms.with_counts(corpus(spark, sf_dir)), [terms.CONTENTS])


def field_stats_all(spark, sf_dir):
    return stored_index(spark, sf_dir).field_stats()


def corpus_size(spark, sf_dir):
    return stats.corpus_size(spark.read.parquet(_file(sf_dir, "documents")))


def doc_terms(spark, sf_dir):
    """The vector of the richest document: only that text is analysed with positions."""
    docs = corpus(spark, sf_dir)
    own = docs.filter(F.col("doc_id") == richest_document(terms.with_counts(docs)))
    rows = best.doc_terms(terms.with_vectors(own), richest_document(terms.with_counts(own)), positions=True)
    return rows.select("doc_id", "term", "freq", _positions_as_text())


def _best_terms(order: str) -> Query:
    def query(spark, sf_dir):
        index = stored_index(spark, sf_dir)
        return index.best_terms(richest_document(index.table), order=order, top=TOP_OF_DOCUMENT)

    return query


def term_weights(spark, sf_dir):
    return stored_index(spark, sf_dir).term_weights()


def _best_of_all(order: str) -> Query:
    return lambda spark, sf_dir: stored_index(spark, sf_dir).best_terms_all(order, TOP_OF_EACH)


best_terms_all_docs = _best_of_all("tfxidf")


def stored_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The terms of the stored index; no text is analysed for them."""
    return stored_index(spark, sf_dir).vocabulary()


def char_vectors(spark, sf_dir):
    return similar.char_vectors(stored_vocabulary(spark, sf_dir))


def char_norms(spark, sf_dir):
    return similar.char_norms(stored_vocabulary(spark, sf_dir))


def char_cosine(spark, sf_dir):
    return similar.char_cosine(stored_vocabulary(spark, sf_dir), QUERY_WORD)


def similar_terms(spark, sf_dir):
    return stored_index(spark, sf_dir).similar_terms(QUERY_WORD, TOP_SIMILAR)


def term_clusters_as_is(spark, sf_dir):
    return similar.term_clusters(stored_vocabulary(spark, sf_dir), QUERY_WORD, TOP_SIMILAR)


def similar_terms_batch(spark, sf_dir):
    """Query words: the terms of most documents, and all event types."""
    index = stored_index(spark, sf_dir)
    events = spark.read.parquet(_file(sf_dir, "events"))
    words = frequent_terms(index).unionByName(events.select(F.col("event_type").alias("q"))).distinct()
    return index.similar_terms_batch(words, TOP_SIMILAR)


def _term_doc_vectors(rep: str) -> Query:
    return lambda spark, sf_dir: stored_index(spark, sf_dir).term_doc_vectors(rep)


def frequent_terms(index: TextIndex) -> DataFrame:
    """Query words (q): the terms that most documents hold."""
    freqs = index.doc_freq([terms.CONTENTS])
    return freqs.orderBy(F.desc("df"), "term").limit(QUERY_TERMS).select(F.col("term").alias("q"))


def _similar_by_documents(rep: str) -> Query:
    def query(spark, sf_dir):
        index = stored_index(spark, sf_dir)
        return index.similar_by_documents(frequent_terms(index), TOP_SIMILAR, rep)

    return query


def term_kmeans(spark, sf_dir):
    return stored_index(spark, sf_dir).term_kmeans(CLUSTERS)


QUERIES: dict[str, Query] = {
    "corpus_scan": corpus_scan,
    "scan_lines": scan_lines,
    "file_extension": file_extension,
    "extension_filter": extension_filter,
    "whole_content": _content(),
    "top_lines": _content(top=TOP_LINES),
    "bottom_lines": _content(bottom=BOTTOM_LINES),
    "top_bottom_lines": _content(top=TOP_LINES, bottom=BOTTOM_LINES),
    "file_size": file_size,
    "minute_stamp": _event_stamp(stamps.minute_stamp),
    "iso_stamp": _event_stamp(stamps.iso_stamp),
    "tokenize": tokenize,
    "term_vectors": term_vectors,
    "keyword_terms": keyword_terms,
    "vocabulary": vocabulary,
    "doc_freq": doc_freq,
    "add_documents": add_documents,
    "upsert_documents": upsert_documents,
    "write_mode_create": write_mode_create,
    "write_mode_append": write_mode_append,
    "merge_partials": merge_partials,
    "merge_indexes": merge_indexes,
    "list_fields": list_fields,
    "field_stats": field_stats,
    "field_stats_all": field_stats_all,
    "corpus_size": corpus_size,
    "doc_terms": doc_terms,
    "term_weights": term_weights,
    "best_terms_tf": _best_terms("tf"),
    "best_terms_df": _best_terms("df"),
    "best_terms_tfidf": _best_terms("tfxidf"),
    "best_terms_all_docs": best_terms_all_docs,
    "best_terms_all_docs_tf": _best_of_all("tf"),
    "best_terms_all_docs_df": _best_of_all("df"),
    "char_vectors": char_vectors,
    "char_norms": char_norms,
    "char_cosine": char_cosine,
    "similar_terms": similar_terms,
    "term_clusters_as_is": term_clusters_as_is,
    "similar_terms_batch": similar_terms_batch,
    "term_doc_vectors_bin": _term_doc_vectors("bin"),
    "term_doc_vectors_tf": _term_doc_vectors("tf"),
    "term_doc_vectors_tfxidf": _term_doc_vectors("tfxidf"),
    "similar_by_documents": _similar_by_documents("tfxidf"),
    "similar_by_documents_bin": _similar_by_documents("bin"),
    "similar_by_documents_tf": _similar_by_documents("tf"),
    "term_kmeans": term_kmeans,
}

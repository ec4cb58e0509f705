"""Files, the stored index and the stream of files."""

import datetime
import glob
import os
import warnings

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from termloom import TextIndex
from termloom.operators import term_vectors as terms
from termloom.plans import index as index_module
from termloom.plans.index import APPEND, CREATE, CREATE_OR_APPEND
from termloom.sources.files import scan_files
from termloom.streaming.ingest import arriving_files, start_indexing


@pytest.fixture
def tree(tmp_path):
    def put(name, data):
        path = tmp_path / "docs" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
        os.utime(path, (1577934270.5, 1577934270.5))
        return str(path)

    put("a.txt", b"Hello world\r\nhello")
    put("deep/er/b.tar.gz", b"plain text")
    put("deep/my file.txt", "naïve".encode())
    put("noext", b"none\n")
    put("odd/p%41+b c.x+ #y", b"odd")
    put("C.TXT", b"upper")
    put("bad.txt", b"ok \xff\xfe end")
    put("empty.txt", b"")
    put(".hidden", b"hidden")
    put("_x", b"hidden")
    single = tmp_path / "single.c"
    single.write_bytes(b"int x;\n")
    return str(tmp_path / "docs"), str(single), put


def by_name(df):
    return {os.path.basename(r.path): r for r in df.collect()}


def files_read(df):
    """The number of files the scan of an executed plan opened."""
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().nonEmpty():
        plan = plan.children().head()
    return plan.metrics().get("numFiles").get().value()


def test_scan_takes_folders_and_single_files(spark, tree):
    root, single, _ = tree
    found = by_name(scan_files(spark, [root, single]))
    assert set(found) == {"a.txt", "b.tar.gz", "my file.txt", "noext", "C.TXT", "bad.txt", "p%41+b c.x+ #y", "single.c"}
    a = found["a.txt"]
    assert a.contents == "Hello world\nhello\n"
    assert a.sizeKb == 18.0
    assert a.lastModifiedTime == "2020-01-02T03:04:30.5Z"
    assert a.lastModifiedTimeLucene == "202001020304"
    assert found["bad.txt"].contents == "ok �� end\n"


def test_scan_filters_before_opening(spark, tree):
    root, single, _ = tree
    found = scan_files(spark, [root, single], [".txt", ".c"])
    assert set(by_name(found)) == {"a.txt", "my file.txt", "bad.txt", "single.c"}
    assert files_read(found) == 4
    assert set(by_name(scan_files(spark, [root], [".tar.gz"]))) == {"b.tar.gz"}
    assert set(by_name(scan_files(spark, [root], [".x+ #y"]))) == {"p%41+b c.x+ #y"}
    assert by_name(scan_files(spark, [root], [".txt"], top=1))["a.txt"].contents == "Hello world\n"


def test_scan_numbers_its_files(spark, tree):
    root, single, _ = tree
    found = scan_files(spark, [root, single], first_id=10)
    assert sorted(r.doc_id for r in found.collect()) == list(range(10, 18))
    assert set(by_name(found)) == set(by_name(scan_files(spark, [root, single])))


def test_manifest_adds_only_what_the_scan_lacks(spark, tree):
    root, _, put = tree
    seen = by_name(scan_files(spark, [root]))
    plain = lambda name: f"{root}/{name}"
    # One listed file, given with and without its scheme; an empty file; a hidden one; one of another kind.
    rows = [(seen["a.txt"].path,), (plain("a.txt"),), (plain("empty.txt"),), (plain(".hidden.txt"),), (plain("other.c"),)]
    manifest = spark.createDataFrame(rows, "path string")
    found = by_name(scan_files(spark, [root], manifest=manifest))
    assert set(found) == set(seen) | {"empty.txt", ".hidden.txt", "other.c"}
    assert found["empty.txt"].contents == "" and found["empty.txt"].sizeKb == 0.0
    assert all(tuple(found[n]) == tuple(seen[n]) for n in seen)
    assert found["empty.txt"].path == seen["a.txt"].path.replace("a.txt", "empty.txt")
    some = by_name(scan_files(spark, [root], extensions=[".txt"], manifest=manifest))
    assert "other.c" not in some and "empty.txt" in some


def test_manifest_with_lengths_and_times(spark, tree):
    root, _, _ = tree
    seen = by_name(scan_files(spark, [root]))
    stamp = datetime.datetime(2020, 1, 2, 3, 4, 30)
    rows = [(f"{root}/empty.txt", 0, stamp), (f"{root}/unreadable.txt", 5, stamp)]
    manifest = spark.createDataFrame(rows, "path string, length bigint, modificationTime timestamp")
    found = by_name(scan_files(spark, [root], manifest=manifest))
    assert set(found) == set(seen) | {"empty.txt"}
    assert found["empty.txt"].lastModifiedTimeLucene is not None


def test_appended_fields_are_kept(spark, tmp_path):
    plain = spark.createDataFrame([("/a", "one two"), ("/b", "two")], "path string, contents string")
    more = spark.createDataFrame([("/c", "three two", "en")], "path string, contents string, lang string")
    for k, parts in enumerate(([plain, more], [more, plain])):
        folder = str(tmp_path / f"index{k}")
        TextIndex.write(parts[0], folder)
        index = TextIndex.write(parts[1], folder, APPEND)
        assert {(r.path, r.lang) for r in index.table.collect()} == {("/a", None), ("/b", None), ("/c", "en")}
        assert "lang" in index.fields
        freqs = {(r.field, r.term): r.df for r in index.doc_freq().collect()}
        assert freqs["contents", "two"] == 3 and freqs["lang", "en"] == 1
        # Replacing keeps them too.
        index = TextIndex.write(plain.filter("path = '/a'"), folder, update=True)
        assert {(r.path, r.lang) for r in index.table.collect()} == {("/a", None), ("/b", None), ("/c", "en")}
        assert index.doc_freq(["contents"]).filter("term = 'two'").first()["df"] == 3


def test_later_times_win_whatever_their_text(spark, tmp_path):
    """...:30.12 is later than ...:30, although its text sorts first."""
    rows = [("/a", "old", "2020-01-01 00:00:30"), ("/a", "new", "2020-01-01 00:00:30.12"), ("/b", "b", None)]
    batch = spark.createDataFrame(rows, "path string, contents string, t string").withColumn("modified", F.col("t").cast("timestamp"))
    folder = str(tmp_path / "index")
    TextIndex.write(batch.limit(0).drop("t"), folder)
    index = TextIndex.write(batch.drop("t"), folder, update=True, order="modified")
    assert {r.path: r.contents for r in index.table.collect()} == {"/a": "new", "/b": "b"}


def contents_freqs(index):
    return {r.term: r.df for r in index.doc_freq(["contents"]).collect()}


def test_updates_write_only_themselves(spark, tmp_path):
    folder = str(tmp_path / "index")
    first = spark.createDataFrame([(f"/{k}", f"word common old{k % 3}") for k in range(200)], "path string, contents string")
    index = TextIndex.write(first, folder)
    new = spark.createDataFrame([("/1", "word fresh"), ("/2", "word"), ("/x", "more common"), ("/2", "later word")], "path string, contents string")
    index = TextIndex.write(new.coalesce(1), folder, update=True)
    assert index.version == 1
    written = spark.read.parquet(f"{folder}/v000001/docs/batch=000001")
    assert written.count() == 3
    rows = {r.path: r.contents for r in index.table.collect()}
    assert len(rows) == 201 == index.table.count() and rows["/2"] == "later word" and rows["/1"] == "word fresh"
    again = spark.createDataFrame([("/1", "last"), ("/x", "common")], "path string, contents string")
    index = TextIndex.write(again, folder, update=True)
    fresh = TextIndex.write(index.table.select("path", "contents"), str(tmp_path / "fresh"))
    assert contents_freqs(index) == contents_freqs(fresh)
    assert "fresh" not in contents_freqs(index) and "more" not in contents_freqs(index)
    assert {r.term for r in index.vocabulary().collect()} == set(contents_freqs(index))
    assert index.corpus_size().first()[0] == 201 and index.best_terms_all("tf", 1).count() == 201
    assert index.field_stats().collect() == fresh.field_stats().collect()
    # A writer that stopped before the frequencies or sums: they are counted from the rows.
    for table in ("doc_freq", "field_sums"):
        (tmp_path / f"index/v000001/{table}/batch=000002/_SUCCESS").unlink()
    assert contents_freqs(TextIndex(spark, folder)) == contents_freqs(fresh)
    assert TextIndex(spark, folder).field_stats().collect() == fresh.field_stats().collect()


def test_statistics_of_an_index_read_no_document(spark, tmp_path):
    docs = spark.createDataFrame(
        [("/a", "one two two", "en"), ("/b", None, None), ("/c", "", "de")], "path string, contents string, `la.ng` string"
    )
    TextIndex.write(docs, str(tmp_path / "index"))
    index = TextIndex.write(docs.withColumn("path", F.lit("/d")).limit(1), str(tmp_path / "index"), APPEND)
    found = [tuple(r) for r in index.field_stats().collect()]
    assert found == [("path", 4, 4, 4, 4), ("contents", 4, 2, 6, 4), ("la.ng", 4, 3, 3, 3)]
    assert [tuple(r) for r in index.field_stats("la.ng").collect()] == found[2:] and index.field_stats("no").collect() == []
    for report in (index.field_stats(), index.field_stats("contents"), index.corpus_size()):
        assert all("/field_sums/" in f for f in report.inputFiles())
    assert index.corpus_size().collect() == [(4,)]


def test_unfinished_batches_are_not_read(spark, tmp_path):
    folder = str(tmp_path / "index")
    docs = spark.createDataFrame([("/a", "one")], "path string, contents string")
    TextIndex.write(docs, folder)
    TextIndex.write(docs.withColumn("path", F.lit("/b")), folder, APPEND)
    (tmp_path / "index/v000001/docs/batch=000001/_SUCCESS").unlink()
    index = TextIndex(spark, folder)
    assert [r.path for r in index.table.collect()] == ["/a"] and contents_freqs(index) == {"one": 1}
    # The next writer takes another number; a second writer of one batch gets an error.
    index = TextIndex.write(docs.withColumn("path", F.lit("/c")), folder, APPEND)
    assert sorted(r.path for r in index.table.collect()) == ["/a", "/c"]
    with pytest.raises(FileExistsError):
        index_module._store(docs, f"{folder}/v000001/docs/batch=000002")


def test_merge_of_stored_indexes(spark, tmp_path, monkeypatch):
    texts = [["one two two", "two"], ["three", "one", ""], ["two four"]]
    folders = []
    for k, some in enumerate(texts):
        docs = spark.createDataFrame([(f"/{k}/{i}", t, "en") for i, t in enumerate(some)], "path string, contents string, lang string")
        folders.append(str(tmp_path / f"part{k}"))
        TextIndex.write(docs.drop("lang") if k == 1 else docs, folders[-1])
    monkeypatch.setattr(terms, "with_vectors", None)  # nothing is analysed again
    index = TextIndex.merge(spark, folders[:2], str(tmp_path / "whole"))
    index = TextIndex.merge(spark, folders[2:], str(tmp_path / "whole"))
    monkeypatch.undo()
    rows = index.table.orderBy("doc_id").collect()
    assert [r.contents.strip() for r in rows] == sum(texts, []) and [r.doc_id for r in rows] == list(range(6))
    fresh = TextIndex.write(index.table.select("path", "contents", "lang"), str(tmp_path / "fresh"))
    assert sorted(index.doc_freq().collect()) == sorted(fresh.doc_freq().collect())
    assert sorted(map(tuple, index.field_stats().collect())) == sorted(map(tuple, fresh.field_stats().collect()))


def test_vacuum_leaves_the_newest(spark, tmp_path):
    docs = spark.createDataFrame([("/a", "one")], "path string, contents string")
    folder = str(tmp_path / "index")
    for _ in range(3):
        index = TextIndex.write(docs, folder, CREATE)
    assert index.vacuum() == [1, 2]
    assert TextIndex(spark, folder).version == 3 and index.vacuum() == []


def test_one_document_is_read_without_the_rest(spark, tmp_path):
    """Rows are stored by doc_id, and reports read neither other vectors nor the corpus."""
    docs = spark.range(2000).selectExpr("1999 - id AS doc_id", "concat('/', id) AS path", "concat('word', id) AS contents")
    # So little would be one file.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = TextIndex.write(docs, str(tmp_path / "index"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{tmp_path}/index/v000001/docs/*/*.parquet")]
    bounds = []
    for meta in files:
        for g in range(meta.num_row_groups):
            column = next(meta.row_group(g).column(c) for c in range(meta.num_columns) if meta.row_group(g).column(c).path_in_schema == "doc_id")
            bounds.append((column.statistics.min, column.statistics.max))
    assert len(bounds) > 1 and sum(a <= 700 <= b for a, b in bounds) == 1
    report = index.best_terms(700, top=5)
    plan = report._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "terms#" in line]
    assert scans and all("EqualTo(doc_id,700)" in line for line in scans)
    assert [r.term for r in report.collect()] == ["word1299"]


def test_index_modes(spark, tree, tmp_path):
    root, single, put = tree
    folder = str(tmp_path / "index")
    with pytest.raises(FileNotFoundError):
        TextIndex(spark, folder)
    with pytest.raises(FileNotFoundError):
        TextIndex.write(scan_files(spark, [root]), folder, APPEND)
    with pytest.raises(ValueError):
        TextIndex.write(scan_files(spark, [root]), folder, "APPEND_OR_CREATE")
    index = TextIndex.write(scan_files(spark, [root]), folder)
    assert index.table.count() == 7
    assert sorted(r.doc_id for r in index.table.collect()) == list(range(7))
    again = TextIndex.write(scan_files(spark, [root]), folder, APPEND)
    assert again.table.count() == 14
    assert sorted(r.doc_id for r in again.table.collect()) == list(range(14))
    put("a.txt", b"changed text")
    updated = TextIndex.write(scan_files(spark, [root, single]), folder, CREATE_OR_APPEND, update=True)
    assert updated.table.count() == 8
    assert by_name(updated.table)["a.txt"].contents == "changed text\n"
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        assert updated.next_doc_id() == 22
        anew = TextIndex.write(scan_files(spark, [single]), folder, CREATE, update=True)
    assert any("CREATE" in str(w.message) for w in caught)
    assert anew.table.count() == 1
    # Another reader of the folder sees the newest version.
    assert TextIndex(spark, folder).table.count() == 1


def test_index_reports(spark, tree, tmp_path):
    root, single, _ = tree
    index = TextIndex.write(scan_files(spark, [root, single]), str(tmp_path / "index"))
    assert index.fields == ["path", "contents", "lastModifiedTime", "lastModifiedTimeLucene"]
    assert [r.field for r in index.list_fields().orderBy("ord").collect()] == index.fields
    assert {r.field: tuple(r)[1:] for r in index.field_stats().collect()}["contents"] == (8, 8, 13, 12)
    assert index.field_stats("sizeKb").count() == 0
    assert index.field_stats("path").first()["docCount"] == 8
    assert index.corpus_size().first()["n_docs"] == 8
    doc = by_name(index.table)["a.txt"].doc_id
    assert [r.term for r in index.best_terms(doc, order="tf", top=5).collect()] == ["hello", "world"]
    assert index.best_terms(doc).count() == 0
    assert index.best_terms(doc, field="path", top=5).count() == 0
    assert index.best_terms(10_000, top=5).count() == 0
    assert index.best_terms_all("tf", 1).count() == 8
    assert index.similar_terms("hello", 1).first()["term"] == "hello"
    assert index.similar_terms("hello", 1, field="path").count() == 0
    queries = spark.createDataFrame([("hello",), ("int",)], "q string")
    assert {(r.q, r.term) for r in index.similar_terms_batch(queries, 1).collect()} == {("hello", "hello"), ("int", "int")}
    assert index.doc_freq(["contents"]).filter("term = 'hello'").first()["df"] == 1
    assert index.vocabulary().count() == 12
    out = str(tmp_path / "fields")
    index.write_field_list(out)
    lines = [r.value for r in spark.read.text(out).collect()]
    assert lines == [f"- Fields avaliable in Index: {index.folder}", ""] + index.fields


def test_stream_of_files(spark, tree, tmp_path):
    root, _, put = tree
    folder, checkpoint = str(tmp_path / "index"), str(tmp_path / "checkpoint")

    def run():
        start_indexing(arriving_files(spark, root, [".txt"], per_batch=1), folder, checkpoint).awaitTermination()
        return by_name(TextIndex(spark, folder).table)

    assert set(run()) == {"a.txt", "my file.txt", "bad.txt"}
    put("new.txt", b"later")
    found = run()
    assert set(found) == {"a.txt", "my file.txt", "bad.txt", "new.txt"}
    assert len({r.doc_id for r in found.values()}) == 4


def test_a_large_row_group_is_dealt_over_tasks(spark, tmp_path, monkeypatch):
    """A large table of one row group is analysed by several tasks; one of many files is left as it is."""
    from termloom import sizes

    rows = spark.range(4000).selectExpr("id AS doc_id", "repeat(sha2(string(id), 256), 4) AS text")
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    rows.repartition(40).write.parquet(str(tmp_path / "many"))
    share = lambda df: sizes.fullest_share(df)
    one = spark.read.parquet(str(tmp_path / "one"))
    many = spark.read.parquet(str(tmp_path / "many"))
    monkeypatch.setattr(sizes, "SPREAD_BYTES_PER_CORE", 16 << 10)
    assert share(one) == 1 and share(sizes.spread(one, "doc_id")) < 0.2
    assert sorted(sizes.spread(one, "doc_id").collect()) == sorted(one.collect())
    assert sizes.estimated_bytes(one) > 8 * sizes.SPREAD_BYTES_PER_CORE
    monkeypatch.setattr(sizes, "SPREAD_BYTES_PER_CORE", sizes.estimated_bytes(many) // 9)
    assert share(many) < 0.2
    assert "Repartition" not in sizes.spread(many, "doc_id")._jdf.queryExecution().logical().toString()
    assert sizes.fullest_share(rows.limit(0)) == 0

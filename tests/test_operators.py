"""Operators on small frames: goldens, properties, and brute force in plain Python."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from termloom.operators import best_terms as best
from termloom.operators import documents as upkeep
from termloom.operators import fields as stats
from termloom.operators import similar_terms as similar
from termloom.operators import term_vectors as terms
from termloom.session import drop_tables, materialize, shared_dir

WORDS = ["ab", "ba", "abc", "cab", "x", "yy", "casa", "saca", "straße", "été", "the", "of", "and"]


def texts(seed, n, hot="the"):
    rng = random.Random(seed)
    return [" ".join([hot] * rng.randint(0, 4) + rng.choices(WORDS, k=rng.randint(0, 12))) for _ in range(n)]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_tokenize_and_vectors(docs):
    frame = docs(["b a b", "", "A.", "c b"])
    assert rows(terms.tokenize(frame)) == [
        (0, 0, "b"), (0, 1, "a"), (0, 2, "b"), (2, 0, "a"), (3, 0, "c"), (3, 1, "b"),
    ]
    full = terms.with_vectors(frame)
    assert rows(terms.term_vectors(full, positions=True)) == [
        ("contents", 0, "a", 1, [1]),
        ("contents", 0, "b", 2, [0, 2]),
        ("contents", 2, "a", 1, [0]),
        ("contents", 3, "b", 1, [1]),
        ("contents", 3, "c", 1, [0]),
    ]
    lean = terms.term_vectors(terms.with_vectors(frame, positions=False))
    assert rows(lean) == [r[:4] for r in rows(terms.term_vectors(full, positions=True))]
    assert rows(terms.term_vectors(full, "path")) == []
    assert rows(terms.vocabulary(frame)) == rows(terms.vocabulary(full)) == [("a",), ("b",), ("c",)]
    assert rows(terms.vocabulary(full, "path")) == []
    counted = rows(terms.with_counts(frame).select("doc_id", "n_tokens", "n_terms"))
    assert counted == rows(full.select("doc_id", "n_tokens", "n_terms"))
    assert counted == [(0, 3, 2), (1, 0, 0), (2, 1, 1), (3, 2, 2)]


def test_null_contents_have_no_terms(spark):
    frame = spark.createDataFrame([(0, None), (1, "a")], "doc_id bigint, contents string")
    full = terms.with_vectors(frame)
    assert rows(full.select("doc_id", "n_tokens", "n_terms")) == [(0, 0, 0), (1, 1, 1)]
    assert rows(terms.with_counts(frame).select("doc_id", "n_tokens", "n_terms")) == [(0, 0, 0), (1, 1, 1)]
    assert rows(terms.vocabulary(frame)) == [("a",)]


def test_long_terms_are_cut(docs):
    full = terms.with_vectors(docs(["y" * 600 + " z"]))
    assert rows(terms.term_vectors(full, positions=True).select("term", "freq", "positions")) == [
        ("y" * 90, 1, [2]), ("y" * 255, 2, [0, 1]), ("z", 1, [3]),
    ]


def test_keyword_terms_and_doc_freq(docs, spark):
    frame = docs(["a b", "a"]).withColumn("lang", F.when(F.col("doc_id") == 0, "en"))
    assert rows(terms.keyword_terms(frame, ["path", "lang"])) == [
        ("lang", 0, "en", 1), ("path", 0, "/d/0.txt", 1), ("path", 1, "/d/1.txt", 1),
    ]
    assert rows(terms.doc_freq(frame, ["contents", "lang"])) == [
        ("contents", "a", 2), ("contents", "b", 1), ("lang", "en", 1),
    ]
    only = spark.createDataFrame([("b",)], "term string")
    assert rows(terms.doc_freq(frame, only=only)) == [("contents", "b", 1)]


def test_field_stats(docs):
    frame = docs(["a b a", "", "c"]).withColumn("lang", F.when(F.col("doc_id") > 0, "en"))
    counted = terms.with_counts(frame).withColumn("none", F.lit(None).cast("string"))
    assert rows(stats.field_stats(counted, ["contents", "lang", "none"])) == [
        ("contents", 3, 2, 4, 3), ("lang", 3, 2, 2, 2),
    ]
    assert rows(stats.field_stats(counted.limit(0), ["contents", "lang"])) == []
    assert rows(stats.corpus_size(frame)) == [(3,)]


def test_field_list_in_order_of_first_document(docs, tmp_path):
    frame = (
        docs(["a", "b", "c"])
        .withColumn("late", F.when(F.col("doc_id") == 2, "x"))
        .withColumn("soon", F.when(F.col("doc_id") >= 1, "x"))
        .withColumn("never", F.lit(None).cast("string"))
    )
    listed = stats.list_fields(frame, ["late", "path", "never", "soon", "contents"])
    assert rows(listed) == [(1, "path"), (2, "contents"), (3, "soon"), (4, "late")]
    out = str(tmp_path / "fields")
    stats.write_field_list(listed, "index", out)
    lines = [r.value for r in frame.sparkSession.read.text(out).collect()]
    assert lines == ["- Fields avaliable in Index: index", "", "path", "contents", "soon", "late"]


def test_intermediate_tables(spark):
    made = materialize(spark.range(10), "ten")
    assert made.count() == 10
    assert made.inputFiles()[0].split(":", 1)[1].replace("//", "").startswith(shared_dir(spark).split(":", 1)[-1])
    drop_tables(spark)
    with pytest.raises(Exception):
        made.agg(F.sum("id")).collect()


def test_add_and_upsert(spark):
    old = spark.createDataFrame([("p", "1"), ("q", "1"), ("p", "0")], "path string, contents string")
    new = spark.createDataFrame([("p", "2"), ("r", "2")], "path string, contents string")
    assert len(rows(upkeep.add_documents(upkeep.add_documents(old, new), new))) == 7
    once = upkeep.upsert_documents(old, new)
    assert rows(once) == [("p", "2"), ("q", "1"), ("r", "2")]
    assert rows(upkeep.upsert_documents(once, new)) == rows(once)
    assert rows(upkeep.upsert_documents(old, new, max_broadcast=1)) == rows(once)


def test_upsert_keeps_the_last_of_a_hot_path(spark):
    old = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), "id")).alias("path"),
        F.lit("old").alias("contents"),
    )
    new = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), "id")).alias("path"),
        F.col("id").cast("string").alias("contents"),
        F.col("id").alias("seq"),
    )
    for limit in (1, 1000):
        out = upkeep.upsert_documents(old, new, order="seq", max_broadcast=limit)
        assert [r.contents for r in out.filter("path = 'hot'").collect()] == ["297"]  # the last multiple of 3
        assert out.count() == 200 + 200 + 1


def test_merge_keeps_repeated_paths(spark):
    a = spark.createDataFrame([("p",)], "path string")
    assert rows(upkeep.merge_partials([a, a, a])) == [("p",)] * 3


def test_number_documents(spark):
    frame = spark.range(1000, numPartitions=7).select(F.concat(F.lit("p"), "id").alias("path")).filter("path not like 'p3%'")
    numbered = upkeep.number_documents(frame, 5)
    ids = [r.doc_id for r in numbered.collect()]
    assert sorted(ids) == list(range(5, 5 + frame.count()))
    assert sorted(r.doc_id for r in upkeep.number_scan(frame).collect()) == list(range(frame.count()))
    assert dict(numbered.dtypes)["doc_id"] == "bigint"


def brute_weights(all_texts):
    bags = [Counter(t.split()) for t in all_texts]
    df = Counter(w for b in bags for w in b)
    import numpy as np

    out = {}
    for i, bag in enumerate(bags):
        for w, c in bag.items():
            tf = float(np.float32(math.sqrt(c)))
            idf = float(np.float32(math.log((df[w] + 1) / (len(bags) + 1)) + 1.0))
            out[i, w] = (tf, df[w], idf, tf * idf)
    return out


@pytest.mark.parametrize("limit", [1_000_000, 12, 4, 1])
def test_term_weights_against_brute_force(docs, limit):
    """Small limits send common terms by broadcast and the others by shuffle."""
    sample = texts(1, 60)
    full = terms.with_vectors(docs(sample), positions=False)
    found = best.term_weights(full, terms.doc_freq(full), max_broadcast=limit)
    expected = sorted((d, w) + v for (d, w), v in brute_weights(sample).items())
    assert rows(found) == expected
    if limit < 12:
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Union" in plan and "LeftAnti" in plan


@pytest.mark.parametrize("order", ["tf", "df", "tfxidf"])
def test_best_terms_follow_three_stable_sorts(docs, order):
    sample = texts(2, 40)
    weights = brute_weights(sample)
    column = {"tf": 0, "df": 1, "tfxidf": 3}

    def stable(doc):
        ranked = sorted(w for d, w in weights if d == doc)
        for name in ("tf", "df", "tfxidf"):
            ranked.sort(key=lambda w: -weights[doc, w][column[name]])
            if name == order:
                return ranked

    frame = docs(sample)
    full = terms.with_vectors(frame)
    for doc in (0, 7):
        one = best.document_weights(full, frame, doc)
        assert [r.term for r in best.best_terms(one, order, 5).collect()] == stable(doc)[:5]
    everything = best.best_terms_all(best.term_weights(full, terms.doc_freq(full)), order, 3)
    by_doc = defaultdict(dict)
    for r in everything.collect():
        by_doc[r.doc_id][r["rank"]] = r.term
    for doc in range(len(sample)):
        expected = stable(doc)[:3]
        assert [by_doc[doc][i + 1] for i in range(len(expected))] == expected
        assert len(by_doc[doc]) == len(expected)


@pytest.mark.parametrize("limit", [12, 1])
@pytest.mark.parametrize("mode", ["default", "classic"])
@pytest.mark.parametrize("order", ["tf", "df", "tfxidf"])
def test_leading_weights_give_the_same_best_terms(docs, monkeypatch, order, mode, limit):
    """Whatever a floor drops is among no document's best terms; levels of one, two and three terms."""
    monkeypatch.setattr(best, "HEAD_TERMS", 6)
    monkeypatch.setattr(best, "HEAD_LEVELS", 3)
    full = terms.with_vectors(docs([*texts(4, 40), "", "once", *texts(4, 3)]), positions=False).cache()
    freqs = terms.doc_freq(full).cache()
    for top in (3, 100, 0):
        expected = best.best_terms_all(best.term_weights(full, freqs, mode), order, top)
        found = best.best_terms_all(best.leading_weights(full, freqs, order, top, mode, limit), order, top)
        assert rows(found) == rows(expected)


def test_few_rare_terms_could_lead(spark, sf_dir):
    """By df and tfxidf, most rows of rare terms stay in their documents."""
    texts_of_all = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "text AS contents")
    full = terms.with_vectors(texts_of_all, positions=False).cache()
    freqs = terms.doc_freq(full).cache()
    common, rare, rare_df = best._split(best._of_contents(freqs), 4000)
    names = F.broadcast(rare.select("term"))
    total = terms.term_vectors(full).join(names, "term").count()
    levels = best.frequent_levels(freqs)
    moved = {
        order: best.could_lead(full, levels, rare_df, order, 5).join(names, "term").count() for order in ("df", "tfxidf")
    }
    assert total > 1000
    assert moved["df"] * 50 < total and moved["tfxidf"] * 5 < total
    full.unpersist(), freqs.unpersist()


def test_top_is_clipped(docs):
    frame = docs(["a b c", "z"])
    one = best.document_weights(terms.with_vectors(frame), frame, 0)
    assert [best.best_terms(one, "tf", k).count() for k in (9, 3, 0, -1)] == [3, 3, 0, 0]
    everything = best.term_weights(terms.with_vectors(frame), terms.doc_freq(frame))
    assert best.best_terms_all(everything, "tf", 0).count() == 0
    assert best.document_weights(terms.with_vectors(frame), frame, 0, "path").count() == 0
    with pytest.raises(ValueError):
        best.best_terms(one, "idf", 1)


def brute_cosine(a, b):
    x, y = Counter(a), Counter(b)
    length = math.sqrt(sum(c * c for c in x.values())) * math.sqrt(sum(c * c for c in y.values()))
    return sum(c * y[k] for k, c in x.items()) / length if length else 0.0


def vocabulary_of(spark, words):
    return spark.createDataFrame([(w,) for w in words], "term string")


def test_char_vectors_and_norms(spark):
    words = vocabulary_of(spark, ["abb", "", "é"])
    assert rows(similar.char_vectors(words)) == [("abb", "a", 1), ("abb", "b", 2), ("é", "é", 1)]
    assert rows(similar.char_norms(words)) == [("", 0.0), ("abb", math.sqrt(5)), ("é", 1.0)]


@pytest.mark.parametrize(
    "query, term, expected",
    [
        ("ab", "cd", 0.0),
        ("casa", "saca", 1.0000000000000002),
        ("", "any", 0.0),
        ("A", "a", 0.0),
        ("😀", "😁", 1 / (math.sqrt(2) * math.sqrt(2))),
        ("weather", "weather", 9 / (3.0 * 3.0)),
    ],
)
def test_cosine_goldens(spark, query, term, expected):
    words = vocabulary_of(spark, [term])
    assert similar.char_cosine(words, query).first()["sim"] == pytest.approx(expected, abs=0)


def test_similar_terms_against_brute_force(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(200)} | {"zz", "q"})
    frame = vocabulary_of(spark, words)
    queries = ["abc", "aab", "zq", "é", "", "nothing like it", "#"]
    expected = {
        q: sorted(((w, brute_cosine(q, w)) for w in words), key=lambda p: (-p[1], p[0])) for q in queries
    }
    for q in queries[:3] + [""]:
        found = [tuple(r) for r in similar.similar_terms(frame, q, 15).collect()]
        assert found == expected[q][:15]
        assert rows(similar.term_clusters(frame, q, 15, rep="tf", k=3)) == sorted(found)
    table = spark.createDataFrame([(q,) for q in queries], "q string")
    for top, part in ((15, 100), (15, 2), (500, 100), (1, 3), (similar.TASK_LIMIT + 1, 100)):
        batch = similar.similar_terms_batch(frame, table, top, query_rows=part)
        by_query = defaultdict(list)
        for r in sorted(batch.collect(), key=lambda r: (r.q, r["rank"])):
            by_query[r.q].append((r.term, r.sim))
        assert by_query == {q: expected[q][:top] for q in queries}
    assert similar.similar_terms_batch(frame, table, 0).count() == 0


def test_two_rounds_lose_no_similar_term(spark):
    """Many words of uneven letters, so that most queries end before the last round."""
    rng = random.Random(8)
    letters, uneven = "etaoinshrdlucmfwypvbgkqjxz", [1 / (i + 1) for i in range(26)]
    make = lambda longest: "".join(rng.choices(letters, uneven, k=rng.randint(1, longest)))
    words = sorted({make(9) for _ in range(3000)})
    queries = sorted({make(12) for _ in range(60)} | {"zzz", "zq", "eeee", "a", "€", "€e"})
    table = spark.createDataFrame([(q,) for q in queries], "q string")
    for top in (1, 5, 40):
        found = defaultdict(list)
        batch = similar.similar_terms_batch(vocabulary_of(spark, words), table, top)
        for r in sorted(batch.collect(), key=lambda r: (r.q, r["rank"])):
            found[r.q].append((r.term, r.sim))
        for q in queries:
            scores = sorted(((w, brute_cosine(q, w)) for w in words), key=lambda p: (-p[1], p[0]))
            assert found[q] == scores[:top], q


def test_few_pairs_are_scored(spark, sf_dir, monkeypatch):
    """Hundreds of words of the vocabulary against all of it: the rounds score a twentieth of the pairs at most."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "text AS contents")
    words = similar.materialize(terms.vocabulary(docs), "vocabulary")
    queries = words.orderBy(F.xxhash64("term")).limit(300).select(F.col("term").alias("q"))
    scored, plain = [], similar._scored
    monkeypatch.setattr(similar, "_scored", lambda *a: scored.append(plain(*a)) or scored[-1])
    similar.similar_terms_batch(words, queries, 20).collect()
    assert 0 < sum(df.count() for df in scored) < 0.05 * 300 * words.count()


def test_few_queries_meet_the_words_in_their_tasks(spark, monkeypatch):
    """No row is formed for a character or for a pair below the floor, and blocks and ties lose nothing."""
    monkeypatch.setattr(similar, "BLOCK_WORDS", 3, raising=False)
    words = ["", "a", "ab", "ba", "bab", "abc", "cab", "bca", "x", "xy", "\U0001f600", "\U0001f601a", "a\U0001f600", "é", "éa", "aaaa", "zz"]
    frame = vocabulary_of(spark, words).union(spark.sql("SELECT CAST(NULL AS STRING)")).repartition(2)
    queries = ["ab", "abc", "\U0001f600", "é", "q", "", "xyz"]
    table = spark.createDataFrame([(q,) for q in [*queries, None]], "q string")
    units = lambda w: memoryview(w.encode("utf-16-le")).cast("H").tolist()
    ranked, plain = [], similar._first_ranks
    monkeypatch.setattr(similar, "_first_ranks", lambda df, top: ranked.append(df) or plain(df, top))
    found = defaultdict(list)
    for r in sorted(similar.similar_terms_batch(frame, table, 3).filter("sim > 0").collect(), key=lambda r: (r.q or "", r["rank"])):
        found[r.q].append((r.term, r.sim))
    for q in queries:
        scores = sorted(((w, brute_cosine(units(q), units(w))) for w in words), key=lambda p: (-p[1], p[0]))
        assert found[q] == [p for p in scores if p[1] > 0][:3], q
    assert None not in found
    plan = ranked[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan


def test_cosine_properties(spark):
    words = vocabulary_of(spark, ["abc", "bca", "aabbcc", "xyz", "ab"])
    for q in ("abc", "ab"):
        for r in similar.char_cosine(words, q).collect():
            assert 0 <= r.sim <= 1 + 1e-9
            back = similar.char_cosine(vocabulary_of(spark, [q]), r.term).first()["sim"]
            assert back == r.sim

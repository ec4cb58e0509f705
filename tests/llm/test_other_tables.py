"""URL filter, exact search, components, and the registered queries and pipeline."""

import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from termloom.llm import topk, urls
from termloom.llm.components import components
from termloom.llm.queries import LLM_ORACLE, LLM_QUERIES

PAGES = "page_id bigint, url string, host string, score string"


def parts(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = found.groups() if found else ("", "")
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule(host, path):
    best = ""
    for r, _ in urls.RULES:
        name, _, rest = r.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and len(r) > len(best):
            best = r
    return best or None


@pytest.fixture(scope="module")
def pages():
    rnd = random.Random(3)
    rows = [
        (1, None), (2, ""), (3, "no scheme.org/x"), (4, "http://ORG/x"), (5, "https://org"), (6, "x://a.example.org/en/12?q#f"),
        (7, "x://a.example.org/es/"), (8, "x://badexample.org/es/"), (9, "x://com/de/1"), (10, "x://A.COM/fr/1#/de/"),
        (11, "x://b.com?/fr/"), (12, "a://b://c.org/d"), (None, "x://q.org/ü\n"), (13, "x://org:80/"), (13, "x://org:80/"),
    ]
    good, bad = ["garden", "recipes", "history"], ["win-cash", "xxx", "casino"]
    for k in range(300):
        rows.append((100 + k, f"http://{rnd.choice(good)}{k % 7}.org/page/{k}"))
        rows.append((500 + k, f"http://{rnd.choice(bad)}{k % 7}.com/de/{k}"))
    rows += [(1000, "http://history3.net/page/7"), (1001, "http://win-cash5.net/de/9")]
    return rows


def test_url_filter(spark, pages):
    df = spark.createDataFrame([(*p, "x", "x") for p in pages], PAGES)
    rows = urls.judge(df).collect()
    verdicts = dict(urls.RULES)
    expected = Counter((i, *parts(u), rule(*parts(u))) for i, u in pages)
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in rows) == expected
    assert all(r.verdict == verdicts[r.rule] for r in rows if r.rule)
    by_id = {r.page_id: r for r in rows}
    assert by_id[1000].verdict == "allow" and by_id[1001].verdict == "block"
    assert by_id[1000].score > 0 > by_id[1001].score
    assert urls.judge(df.limit(0)).collect() == []
    undecided = urls.judge(df.filter("page_id in (1, 2, 1000)")).collect()
    assert all(r.verdict == "allow" and r.score == 0 for r in undecided)


def log_ratio(texts, good, bad):
    """The models' ratio for texts, counted in plain Python."""
    n = urls.SYMBOLS
    fold = lambda u: "^^" + re.sub(r"[^0a-z/.\-_?=&#:%]", "*", re.sub("[0-9]", "0", u.lower()))

    def model(learned):
        seen = [Counter(), Counter(), Counter()]
        for u in learned:
            t = fold(u)
            for k in range(2, len(t)):
                for order in range(3):
                    seen[order][t[k - order : k], t[k]] += 1
        after = [defaultdict(list) for _ in range(3)]
        for order in range(3):
            for (context, _), c in seen[order].items():
                after[order][context].append(c)

        def p(context, char):
            value = 1 / n
            for order in range(3):
                own = context[2 - order :]
                total, types = sum(after[order][own]), len(after[order][own])
                if total + types:
                    value = (seen[order][own, char] + types * value) / (total + types)
            return value

        return p

    a, b = model(good), model(bad)
    out = []
    for u in texts:
        t = fold(u)
        out.append(np.mean([np.log(a(t[k - 2 : k], t[k]) / b(t[k - 2 : k], t[k])) for k in range(2, len(t))]))
    return out


def test_character_models(spark):
    good, bad = ["http://sea.org/a", "http://sun.org/bc"], ["http://spam.com/de/x"]
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(u, v) for us, v in ((good, "allow"), (bad, "block")) for u in us], "url string, v string")
    codes = df.select("v", F.explode(urls._codes(urls._folded())).alias("code"))
    count = lambda v: F.count(F.when(F.col("v") == v, 1))
    grams = codes.groupBy("code").agg(count("allow").alias("n_allow"), count("block").alias("n_block"))
    ratios = urls._laid_out(urls.model(grams))
    scored = df.select("url", urls._score(urls._codes(urls._folded()), ratios).alias("s")).collect()
    expected = dict(zip(good + bad, log_ratio(good + bad, good, bad)))
    assert all(abs(r.s - expected[r.url]) < 2e-6 for r in scored)


def whole(x):
    """floor(256 * x) within 64 bits."""
    return min(max(math.floor(256 * Fraction(x)), -(2**63)), 2**63 - 1)


def best_of(rows, top=5):
    """Brute force over (vec_id, vector) rows."""
    good = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    usable = [(i, [whole(float(np.float32(x))) for x in v]) for i, v in rows if i is not None and good(v)]
    expected = Counter()
    for k, (i, v) in enumerate(usable):
        if i % 50 == 0:
            others = [(j, w) for m, (j, w) in enumerate(usable) if m != k and len(w) == len(v)]
            scores = [(j, min(max(sum(map(int.__mul__, v, w)), -(2**63)), 2**63 - 1)) for j, w in others]
            scores.sort(key=lambda s: (-s[1], s[0]))
            expected.update((i, r + 1, j, n) for r, (j, n) in enumerate(scores[:top]))
    return expected


@pytest.mark.parametrize("query_bytes", [topk.QUERY_BYTES, 0])
def test_top_k(spark, monkeypatch, query_bytes):
    monkeypatch.setattr(topk, "QUERY_BYTES", query_bytes)
    for name, n in (("BLOCK_ROWS", 16), ("QUERY_ROWS", 2), ("GROUP_SLOTS", 2), ("GROUP_BLOCKS", 3)):
        monkeypatch.setattr(topk, name, n)
    rng = np.random.default_rng(0)
    rows = [(int(k), rng.normal(0, 0.2, 16).tolist()) for k in range(0, 400)]
    rows += [(450, None), (500, [float("nan")] * 16), (550, [0.1] * 15 + [None]), (600, [0.1] * 8), (None, [0.1] * 16)]
    rows += [(650, rows[3][1]), (651, rows[3][1]), (700, [float("inf")] + [0.0] * 15), (750, []), (800, [0.0] * 16), (800, [0.0] * 16)]
    rows += [(850, [0.5, 0.25, 1.0]), (851, [0.5, -0.25, 1.0]), (900, [2.0]), (901, [-1.0]), (902, [3.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<float>, rank string, block int")
    assert Counter(map(tuple, topk.top_k(df).collect())) == best_of(rows)
    assert topk.top_k(df.limit(0)).collect() == []


def test_top_k_of_huge_components(spark):
    values = [1e20, -1e20, 1e15, -3e12, 7.5, 0.0, 3e38]
    rng = np.random.default_rng(4)
    rows = [(k * 10, rng.choice(values, 4).tolist()) for k in range(60)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert Counter(map(tuple, topk.top_k(df).collect())) == best_of(rows)


def test_bounds_drop_rows():
    """Vectors in clusters: nearly all pairs are out before any exact score, and floors go on to the next block."""
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 100, (20, 64))
    rows = np.floor(centres[rng.integers(0, 20, 4000)] + rng.normal(0, 5, (4000, 64))).astype(np.int64)
    queries, own, floors = rows[:50], np.arange(50), np.full(50, -np.inf)
    left = []
    for half, at in ((rows[:2000], own), (rows[2000:], np.full(50, -1))):
        topk._search(queries, half, np.arange(2000), at, 5, floors, left)
    assert sorted(left[:4], reverse=True) == left[:4]
    assert left[3] < 0.1 * 50 * 2000 and left[7] <= left[3]
    scores = queries @ rows.T
    scores[own, own] = np.iinfo(np.int64).min
    assert (floors <= np.sort(scores, axis=1)[:, -5]).all()
    assert [topk.levels_of(w) for w in (0, 1, 2, 3, 4, 16, 64, 6)] == [[], [], [1], [1], [1, 2], [1, 4, 8], [1, 4, 16, 32], [1, 3]]


def test_bounds_hold():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-256, 256, (50, 64)), rng.integers(-256, 256, (50, 64))
    for n in topk.levels_of(64):
        (ma, da), (mb, db) = topk.statistics(a, n), topk.statistics(b, n)
        far = ((ma - mb) ** 2 + (da - db) ** 2).sum(axis=1) * (64 // n)
        assert (far <= ((a - b) ** 2).sum(axis=1) + 1e-6).all()


def test_components(spark):
    rnd = random.Random(6)
    links = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 150)] + [(rnd.randint(200, 260), rnd.randint(200, 260)) for _ in range(40)]
    links += [(7, 7), (1, 0)]
    root = {n: n for p in links for n in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {n: find(n) for p in links if p[0] != p[1] for n in p}


def test_registered():
    assert set(LLM_QUERIES) <= set(entry.queries())
    numbers = {int(m[1]) for m in (re.match(r"op(\d+)_", q) for q in LLM_QUERIES) if m}
    assert numbers == set(range(1, 14)) and "pipeline" in LLM_QUERIES


@pytest.mark.parametrize("name", list(LLM_ORACLE))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = LLM_QUERIES[name](spark, sf_dir)
    found = Counter(map(tuple, df.collect()))
    cursor = duck.execute(LLM_ORACLE[name])
    order = [[d[0] for d in cursor.description].index(c) for c in df.columns]
    assert found == Counter(tuple(r[k] for k in order) for r in cursor.fetchall())


def test_pipeline_stages(spark, sf_dir):
    """Each stage keeps rows of its input with the columns of documents; the last packs all of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, before, sf_dir).collect(), docs.schema)
        assert after.columns == columns, name
        assert after.select("doc_id").subtract(before.select("doc_id")).isEmpty()
        assert 0 < after.count() <= before.count()
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, sf_dir)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in before.collect()}
    whole = Counter(map(tuple, corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "ids_crc32").collect()))
    assert whole == Counter(map(tuple, pieces.select("doc_id", "piece", "ids_crc32").collect()))

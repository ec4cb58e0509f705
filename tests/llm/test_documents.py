"""Operators on documents against brute force, on texts with every awkward case."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from termloom.llm import classify, decontaminate, lm, minhash, packing, quality, suffix, token_counts, toxicity
from termloom.llm.tokens import PieceEncoder

SCHEMA = (
    "doc_id bigint, text string, n_tokens string, bucket string, key int, row string, uid string, score string, "
    "offset string, id string"
)
EMPTY = "doc_id bigint, text string"
LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(4)
    words = ["alpha", "beta", "Gamma", "delta,", "ñandú", "e.", "zeta!", "x1", "the", "of"]
    prose = lambda n: " ".join(rnd.choice(words) + rnd.choice(["", "", "s", "ed"]) for _ in range(n))
    passage = prose(30)
    long = prose(9000)
    near = prose(200).split()
    changed = [*near[:50], "other", *near[51:]]
    rows = [
        (0, long), (1, None), (2, ""), (3, " \n\t "), (4, "!!! ???"), (5, passage), (6, prose(40) + " " + passage),
        (7, passage + " " + prose(5)), (8, " ".join(near)), (9, " ".join(changed)), (10, " ".join(near)),
        (11, "one two"), (12, "one two"), (12, "one two"), (None, "null id of the first"), (None, None), (13, "a" * 700),
        (14, "b" + "a" * 300), (15, "don't <|endoftext|> İstanbul é 日本語 　 a\x1cb ǅ"), (16, "日本" * 60),
        (17, "x" + "日本" * 60), (-5, prose(60)), (18, prose(5) + " " + long[:400]), (19, passage), (19, "other text"),
    ]
    return rows


@pytest.fixture(scope="module")
def documents(spark, texts):
    return spark.createDataFrame([(*t, *["x"] * 2, 1, *["x"] * 5) for t in texts], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], EMPTY)


def raw(text):
    return (text or "").encode()


def encoded(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_token_counts(documents, texts, empty):
    rows = token_counts.tokens_of(token_counts.prefix_counts(documents)).collect()
    found = Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in rows)
    assert found == Counter((i, len(raw(t)), len(encoded(t))) for i, t in texts)
    assert token_counts.prefix_counts(empty).collect() == []


def test_prefixes_answer_without_encoding_again(documents, texts):
    encoder = PieceEncoder()
    text = dict(texts)[15]
    (row,) = token_counts.prefix_counts(documents.filter("doc_id = 15")).collect()
    counts = row.prefix_bytes, row.prefix_tokens
    for at in range(len(text) + 1):
        cut = text[:at]
        assert token_counts.tokens_at(counts, raw(text), len(raw(cut)), encoder) == len(encoded(cut))
    for budget in range(len(encoded(text)) + 2):
        best = max(len(raw(text[:k])) for k in range(len(text) + 1) if len(encoded(text[:k])) <= budget)
        assert token_counts.longest_prefix(counts, raw(text), budget, encoder) == best


def test_truncate(documents, texts):
    some = documents.filter("doc_id in (0, 2, 15)")
    found = {r.doc_id: r.text for r in token_counts.truncate(some, 10).collect()}
    assert found[2] == "" and len(encoded(found[0])) == 10 and dict(texts)[0].startswith(found[0])


def test_whole_texts_give_the_ids_of_the_tokenizer(texts):
    every = [raw(t) for _, t in texts]
    got = PieceEncoder().text_ids(every)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [encoded(t.decode()) for t in every]


def test_words_of_letters_pass_by_the_normalizer_and_pattern(monkeypatch):
    every = ["It's the Élan of ÀÿßØ, they'll say 'sé'd", "naïve naïve façade's", "it the élan", "", "x" * 300 + " é" * 9]
    encoder, whole = PieceEncoder(), []
    plain = encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda texts: (whole.extend(texts), plain(texts))[1])
    for _ in range(2):  # the second time from the cache
        got = encoder.text_ids([raw(t) for t in every])
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [encoded(t) for t in every]
    assert whole and not any(c.isalpha() for t in whole if t[0] != "'" for c in t)


def test_packing(documents, texts, empty):
    rows = packing.pack(documents).collect()
    pieces, filled = Counter(), defaultdict(list)
    for i, t in texts:
        ids = np.array([*encoded(t), 1], "<u4")
        for k, start in enumerate(range(0, len(ids), 4096)):
            some = ids[start : start + 4096]
            pieces[i, k, start, len(some), zlib.crc32(some.tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in rows) == pieces
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for places in filled.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    assert packing.pack(empty).collect() == []


def test_pieces_carry_their_ids(documents):
    for r in packing.pieces(documents, with_ids=True).collect():
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32


@pytest.mark.parametrize("seed", range(8))
def test_packing_plans(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 64, 4096])
    counts = Counter(rnd.randint(1, capacity) for _ in range(rnd.randint(1, 2000)))
    ranks, filled, large = Counter(), defaultdict(list), Counter()
    for length, rank, many, first, offset in packing.plan_runs(counts, capacity):
        for k in range(many):
            ranks[length, rank + k] += 1
            filled[first + k].append((offset, length))
            large[first + k] += 3 * length > capacity
    assert ranks == Counter({(n, k): 1 for n, c in counts.items() for k in range(c)})
    assert all(sum(n for _, n in f) <= capacity for f in filled.values()) and max(large.values()) <= 2
    lower = -(-sum(n * c for n, c in counts.items()) // capacity)
    halves = sum(c for n, c in counts.items() if 2 * n > capacity)
    assert len(filled) <= max(lower, halves) * 1.25 + 1


def test_words_of_one_character_kind():
    text = "A-b_c Ñ9,é x\x7fy"
    assert decontaminate.test_words(text) == regex.findall(
        rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", raw(text.replace("A", "a"))
    )


def hits(text, items):
    words, hit, found = decontaminate.test_words(text), set(), set()
    for name, item in items:
        for window in decontaminate.windows(decontaminate.test_words(item)):
            for k in range(len(words) - len(window) + 1):
                if words[k : k + len(window)] == window:
                    hit.update(range(k, k + len(window)))
                    found.add(name)
    names = sorted(str(n) for n in found if n is not None)
    digest = hashlib.sha256(",".join(names).encode()).hexdigest()
    return len(words), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("block_words", [500_000, 5])
def test_decontamination(spark, documents, texts, empty, monkeypatch, block_words):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    items = [(1, dict(texts)[5]), (2, "one TWO"), (10, "two"), (3, None), (4, " "), (None, "alpha"), (5, dict(texts)[5])]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, doc_id string")
    rows = decontaminate.contamination(documents, benchmark).collect()
    assert Counter(map(tuple, rows)) == Counter((i, *hits(t, items)) for i, t in texts)
    assert decontaminate.contamination(empty, benchmark).collect() == []
    nothing = decontaminate.contamination(documents, benchmark.limit(0)).collect()
    assert Counter(map(tuple, nothing)) == Counter((i, *hits(t, [])) for i, t in texts)
    kept = decontaminate.keep_clean(documents, benchmark)
    assert kept.columns == documents.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        (i, t) for i, t in texts if not hits(t, items)[-1]
    )


def test_items_of_one_id_are_dealt_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 100)
    rows = [(None, f"word{k} " * 20) for k in range(60)] + [(7, "same text " * 10)] * 500 + [(8, None), (8, "")]
    blocks = list(decontaminate._blocks(spark.createDataFrame(rows, "item_id bigint, text string")))
    assert Counter(i for b in blocks for i in b) == Counter(set(rows[:61]))
    assert max(map(len, blocks)) <= 15 and len(blocks) > 10


def test_rows_that_repeat_spread_over_salts(spark):
    docs = spark.createDataFrame([(None, None)] * 4000, "doc_id bigint, text string").repartition(3)
    pieces = packing.pieces(docs)
    assert pieces.select("spread").distinct().count() > 3900
    rows = packing.pack(docs).collect()
    assert len(rows) == 4000 and len({(r.sequence_id, r.offset) for r in rows}) == 4000


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a x x b"), (2, "b a"), (3, "a x x x b"), (4, "a"), (5, "c b. A")], EMPTY)
    index = decontaminate.build_index(docs, {b"a": 0, b"b": 1})
    found = decontaminate.proximity_matches(index, [0, 1], within=4).collect()
    assert sorted(r.doc_id for r in found) == [1, 2, 5]


def repeats(texts, span=100):
    """By (id, text): bytes, removed, runs, digest of the rest."""
    order = sorted({(suffix._FIRST if i is None else i, raw(t)) for i, t in texts})
    first = {}
    for i, t in order:
        for k in range(len(t) - span + 1):
            place = first.setdefault(t[k : k + span], (i, k))
            first[t[k : k + span]] = min(place, (i, k))
    out = {}
    for i, t in order:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - span + 1):
            if first[t[k : k + span]] < (i, k):
                gone[k : k + span] = True
        left = bytes(b for b, g in zip(t, gone) if not g)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[i, t] = (len(t), int(gone.sum()), runs, hashlib.sha256(left).hexdigest())
    return out


@pytest.mark.parametrize("chunk_bytes", [4 << 20, 1000])
def test_suffix_dedup(documents, texts, empty, monkeypatch, chunk_bytes):
    from termloom.llm import exchange

    monkeypatch.setattr(exchange, "CHUNK_BYTES", chunk_bytes)
    expected = repeats(texts)
    rows = suffix.repeated_bytes(documents).collect()
    assert Counter(map(tuple, rows)) == Counter(
        (i, *expected[suffix._FIRST if i is None else i, raw(t)]) for i, t in texts
    )
    assert suffix.repeated_bytes(empty).collect() == []


@pytest.mark.parametrize("many", [0, 1, 3])
def test_strings_of_frequent_anchors_are_dealt_one_by_one(documents, texts, many):
    expected = repeats(texts)
    rows = suffix.remove_repeats(documents, ["doc_id"], many=many)
    rows = rows.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert Counter(map(tuple, rows)) == Counter(
        (i, *expected[suffix._FIRST if i is None else i, raw(t)]) for i, t in texts
    )


def test_a_passage_of_a_third_of_all_documents_spreads(spark):
    rnd = random.Random(6)
    prose = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = prose(250)
    texts = [(k, prose(150) + (passage if k % 3 == 0 else "") + prose(150)) for k in range(900)]
    docs = spark.createDataFrame(texts, EMPTY)
    keyed = docs.selectExpr("doc_id id", "xxhash64(text) hash", "text", "struct(doc_id) row")

    def largest(many):
        sent = suffix._sent(keyed, 64, 100, many)
        return sorted(r.n for r in sent.groupBy("bucket").agg(F.sum(F.length("payload")).alias("n")).collect())

    alone, spread = largest(1 << 30), largest(40)
    assert alone[-1] > 20 * np.median(alone)  # all contexts of the anchors at the ends
    assert spread[-1] < 4 * np.median(spread)
    expected = repeats(texts)
    rows = suffix.remove_repeats(docs, ["doc_id"], many=40).collect()
    assert {(r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == {
        (i, *expected[i, raw(t)]) for i, t in texts
    }


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(suffix, "_BLOCK", 300)
    rnd = random.Random(1)
    text = "".join(rnd.choice("abcd") for _ in range(3000))
    texts = [(1, text), (2, text[500:1700]), (3, "zz" + text[1000:2900])]
    rows = suffix.repeated_bytes(spark.createDataFrame(texts, EMPTY)).collect()
    expected = repeats(texts)
    assert {tuple(r) for r in rows} == {(i, *expected[i, raw(t)]) for i, t in texts}


@pytest.mark.parametrize("seed", range(5))
def test_suffixes_sort_within_groups(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(97, 99, 300).astype(np.uint8)
    begin, size = rng.integers(0, 200, 120), rng.integers(0, 100, 120)
    group = np.sort(rng.integers(0, 4, 120))
    order, common = suffix.sort_suffixes(text, begin, size, group)
    own = [(g, bytes(text[b : b + s])) for g, b, s in zip(group, begin, size)]
    assert [own[k] for k in order] == sorted(own)
    for k in range(1, 120):
        (g, a), (h, b) = own[order[k - 1]], own[order[k]]
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert common[k] == (same if g == h else -1)


def test_hash_collisions_are_seen():
    text = np.frombuffer(b"abcabd", np.uint8)
    assert suffix._verified(text, np.array([0, 3]), np.array([-1, 2]))
    assert not suffix._verified(text, np.array([0, 3]), np.array([-1, 3]))


def classes(texts):
    """The class of each row, as the set of rows, by comparing all pairs."""
    vectors, df = [], Counter()
    for _, t in texts:
        words = decontaminate.test_words(t)
        runs = Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()
        vectors.append(runs)
        df.update(runs.keys())
    n = len(texts)
    weigh = lambda v: {x: c * (1 + math.log((n + 1) / (df[x] + 1)) / math.log(n + 1)) for x, c in v.items()}
    weights = [weigh(v) for v in vectors]
    root = list(range(n))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(range(n), 2):
        x, y = weights[a], weights[b]
        both = sum(min(x[k], y[k]) for k in x.keys() & y.keys())
        whole = sum(x.values()) + sum(y.values()) - both
        if (whole and both / whole >= 0.8) or (not whole and raw(texts[a][1]) == raw(texts[b][1])):
            root[find(a)] = find(b)
    out = defaultdict(list)
    for k in range(n):
        out[find(k)].append(texts[k])
    return out.values()


@pytest.mark.parametrize("chunk_docs", [4096, 3])
def test_near_duplicates(documents, texts, empty, monkeypatch, chunk_docs):
    from termloom.llm import exchange

    monkeypatch.setattr(exchange, "CHUNK_DOCS", chunk_docs)
    rows = minhash.near_duplicates(documents).collect()
    expected = Counter()
    for group in classes(texts):
        ids = [i for i, _ in group if i is not None]
        expected.update((i, min(ids) if ids else None) for i, _ in group)
    assert Counter((r.doc_id, r.class_id) for r in rows) == expected
    assert len({r.class_uid for r in rows}) == len(classes(texts))
    assert minhash.near_duplicates(empty).collect() == []


def test_one_of_each_class_stays(spark):
    near = [f"w{k}" for k in range(100)]
    texts = [(3, " ".join(near)), (1, " ".join(near[:99])), (2, "quite another text with words"), (4, None)]
    kept = minhash.keep_one_of_each(spark.createDataFrame(texts, EMPTY)).collect()
    assert sorted(r.doc_id for r in kept) == [1, 2, 4]


def test_one_of_rows_that_repeat_stays(spark):
    near = [f"w{k}" for k in range(100)]
    one, two = " ".join(near), " ".join(near[:99])
    texts = [(3, one, "b"), (1, two, "c"), (1, two, "a"), (1, two, "a"), (3, one, "b"), (2, "quite another text", "x")]
    texts += [(5, "on its own, often", "y")] * 300 + [(None, None, "z"), (None, "", "w"), (6, "alone", None)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string")
    kept = minhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    rows = Counter((r.doc_id, r.text or "", r.lang) for r in kept.collect())
    assert rows == Counter(
        [(1, two, "a"), (2, "quite another text", "x"), (5, "on its own, often", "y"), (None, "", "w"), (6, "alone", None)]
    )


def test_groups_with_few_links_are_compared_to_the_end(spark):
    """A chain: neighbours are alike, the ends are not; and many texts that only share half."""
    words = [f"w{k}" for k in range(400)]
    chain = [(k, " ".join(words[8 * k : 8 * k + 200])) for k in range(20)]
    half = [(100 + k, " ".join(f"c{j}" for j in range(100)) + " " + " ".join(f"u{k}x{j}" for j in range(60))) for k in range(30)]
    rows = minhash.near_duplicates(spark.createDataFrame(chain + half, EMPTY)).collect()
    found = {r.doc_id: r.class_id for r in rows}
    assert {found[k] for k in range(20)} == {0}
    assert all(found[100 + k] == 100 + k for k in range(30))


def test_samples_agree_as_often_as_vectors_are_alike():
    rng = np.random.default_rng(0)
    a = rng.integers(1, 1 << 62, 400).astype(np.uint64)
    weights = rng.uniform(1, 2, 400)
    found = []
    for k in range(40):
        shift = np.uint64(k << 40)
        x = minhash.samples(a[:350] + shift, weights[:350])
        y = minhash.samples(a[50:] + shift, weights[50:])
        found.append((x == y).mean())
    alike = weights[50:350].sum() / weights.sum()
    assert abs(np.mean(found) - alike) < 0.03


def test_language_model(documents, texts, empty, monkeypatch):
    monkeypatch.setattr(lm, "LEARNED_IDS", 500)
    split = lambda t: [*raw(t).lower().split(), lm.END]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    counts = Counter(w for i, t in texts if not held(i) for w in split(t))
    n, v = sum(counts.values()), len(counts)
    expected = Counter()
    for i, t in texts:
        words = split(t)
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        expected[i, held(i), len(words), sum(counts[w] > 0 for w in words), n, round(base, 6)] += 1
    rows = lm.score_texts(documents).collect()
    assert Counter((*tuple(r)[:5], round(r.base_score, 6)) for r in rows) == expected
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    assert lm.score_texts(empty).collect() == []


def test_language_model_learns_from_all_texts_to_their_ends(spark):
    """Of all texts but those of the first sample, and of places after LEARNED_IDS of a long text."""
    from termloom.llm import exchange
    from termloom.llm.tables import held_out

    known = np.random.default_rng(1).permutation([w for w in "one two three four five six seven eight".split()] * 2000)
    docs = spark.createDataFrame([(k, "red green blue") for k in range(1, 1500)] + [(5000, " ".join(known) + " violet")], EMPTY)
    rows = docs.select("doc_id", held_out("doc_id", lm.FOLDS).alias("held"), "text")
    notes = exchange.ask(rows, lm._questions(4), 4).filter(F.col("kind") == exchange.NOTE).select("chunk", "payload")
    windows = [w for r in notes.collect() for w in lm._training_windows(r.payload)]
    held = sum(zlib.crc32(str(k).encode()) % 10 == 0 for k in [*range(1, 1500), 5000])
    coder = lm.WordIds()
    ids = [sum(coder(lm.text_words(raw(t))), []) for i, t in docs.collect() if zlib.crc32(str(i).encode()) % 10]
    assert max(map(len, ids)) > lm.LEARNED_IDS and len(ids) == 1500 - held
    assert Counter(i for w in windows for i in w.tolist()) == Counter(i for x in ids for i in x)
    assert max(map(len, windows)) <= lm.LEARNED_IDS
    counts = np.bincount([i for x in ids for i in x], minlength=lm.IDS)
    model = lm.train([], counts)
    learned = lm.learn_corpus(notes, model)
    moved = np.flatnonzero((learned["p"]["e"] != model["p"]["e"]).any(axis=1))
    assert set(moved) == set(np.flatnonzero(counts))  # every id of the corpus, and no other
    flat = np.array(ids[0])
    score = lambda m: lm.id_log_probs(m, flat, np.array([len(flat)])).sum()
    assert score(learned) > score(model)
    again = lm.learn_corpus(notes, model)
    assert all(np.array_equal(learned["p"][k], again["p"][k]) for k in model["p"])


def test_language_model_reads_few_notes_at_once(spark, monkeypatch):
    """A row of notes is as large as a chunk: a worker gets some megabytes of them, not all of a task."""
    from termloom.llm import exchange

    docs = spark.createDataFrame([(1, False, " ".join(f"word{i}" for i in range(2000)))], "doc_id bigint, held boolean, text string")
    one = exchange.ask(docs, lm._questions(4), 4).filter(F.col("kind") == exchange.NOTE).first().payload
    notes = spark.createDataFrame([(k, one) for k in range(40)], "chunk bigint, payload binary").coalesce(1)
    monkeypatch.setattr(lm, "_NOTE_BYTES", 2 * len(one), raising=False)
    plain = lm._round_batches

    def watched(*given):
        run = plain(*given)

        def told(batches):
            for batch in batches:
                assert batch.num_rows <= 3
                yield from run(iter([batch]))

        return told

    monkeypatch.setattr(lm, "_round_batches", watched)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    lm.learn_corpus(notes, lm.train([], np.ones(lm.IDS)))
    assert spark.conf.get(name) == before


def test_language_model_codes_words_many_at_once(monkeypatch):
    """With the ids that each has alone, also next to words that hold white space beyond ASCII."""
    plain = [f"word{i}" for i in range(3000)] + ["it's", "''", "1,000.5", "---", "\u00e9t\u00e9", "\u4e2d\u6587", "x" * 900]
    odd = ["a\u00a0b", "\u3000", "\u2009'", "\x1cq", "\x85", "\u00a0\u00a0z"]
    words = [w.encode() for w in [*plain, *odd, *plain[:300]]]
    alone = lm.WordIds()(words)
    coder = lm.WordIds()
    sizes, ids = coder.flat(words)
    assert sizes.tolist() == list(map(len, alone))
    assert ids.tolist() == [i for x in alone for i in x]
    assert len(coder.known) < 600  # only those that stand near the odd ones
    assert [x.tolist() for x in coder.flat([])] == [[], []]


def test_language_model_numbers_words_of_all_texts_at_once(monkeypatch):
    texts = [raw(t) for t in ["One two  ONE\tthree ", "", " \n", "two\u00a0x \u00c9 two", "three\x0b\x0cone"]]
    rows = np.cumsum([0, *map(len, texts)])
    found = [lm.text_words(t) for t in texts]
    monkeypatch.setattr(lm, "text_words", None)  # no loop over texts
    words, flat, lengths = lm.numbered_words(np.frombuffer(b"".join(texts), np.uint8), rows)
    assert [words[k] for k in flat] == sum(found, [])
    assert lengths.tolist() == list(map(len, found))
    assert len(set(words)) == len(words) and words[-1] == lm.END


def test_language_model_keeps_memory_between_steps(monkeypatch):
    """The workers give memory back above a small limit; a step would fetch all of its memory anew."""
    limits = []
    monkeypatch.setattr(lm.ctypes, "CDLL", lambda _: SimpleNamespace(mallopt=lambda what, limit: limits.append((what, limit))))
    monkeypatch.setenv("MALLOC_TRIM_THRESHOLD_", "1000")
    with lm._kept_memory():
        assert limits == [(-1, lm._KEPT_BYTES)]
    assert limits[1:] == [(-1, 1000)]
    monkeypatch.delenv("MALLOC_TRIM_THRESHOLD_")
    with lm._kept_memory():
        assert len(limits) == 2


def test_language_model_is_causal_and_sums_to_one():
    counts = np.ones(lm.IDS)
    model = lm.train([[5, 6, 7, 5, 6, 7, lm.END_ID]] * 20, counts, epochs=2)
    ids = np.array([5, 6, 7, 8, 9, lm.END_ID] * 9)
    other = ids.copy()
    other[30:] = 11
    one = lambda x: lm.id_log_probs(model, x, np.array([len(x)]))
    assert np.allclose(one(ids)[:30], one(other)[:30], atol=1e-5)
    two = lm.id_log_probs(model, np.concatenate([other, ids]), np.array([len(other), len(ids)]))
    assert np.allclose(two[len(other) :], one(ids), atol=1e-4)  # whatever stands before a text
    every = [float(np.exp(one(np.array([5, k]))[1])) for k in range(0, lm.IDS, 40)]
    assert 0 < sum(every) < 1
    slots = np.exp(model["share"])
    total = np.bincount(model["group"] * lm.SLOTS + model["slot"], slots)
    assert np.allclose(total, 1, atol=1e-3)


def test_language_model_takes_exponentials_of_all_groups_at_once(monkeypatch):
    p = lm._initial()
    x, first, target, places = lm.inputs([list(range(3000)), [9, 10], [lm.END_ID]])
    real = np.zeros(len(x), bool)
    real[places] = True
    group, slot = target % (lm.GROUPS - 1), target % lm.SLOTS  # one group without ids
    t = lm._forward(p, x, first)
    plain = []
    for i, (k, j) in enumerate(zip(group.tolist(), slot.tolist())):
        logits = t["z"][i] @ p["m"][k] + p["mb"][k]
        plain.append(t["y"][i, k] - np.log(np.exp(t["y"][i]).sum()) + logits[j] - np.log(np.exp(logits).sum()))
    calls, exp = [], np.exp
    monkeypatch.setattr(np, "exp", lambda *a, **k: (calls.append(1), exp(*a, **k))[1])
    assert np.abs(lm.slot_log_probs(p, x, first, group, slot) - plain).max() < 1e-4
    g = lm._gradients(p, x, first, group, slot, real)
    assert not g["m"][lm.GROUPS - 1].any() and all(g["m"][k].any() for k in range(lm.GROUPS - 1))
    assert len(calls) == 6  # attention, groups and slots, forward and for the gradients


def test_language_model_gradients():
    p = {k: v.astype(np.float64) for k, v in lm._initial().items()}
    x, first, target, places = lm.inputs([[5, 6, 7] * 9, [9, 10]])
    real = np.zeros(len(x), bool)
    real[places] = True
    group, slot = target % lm.GROUPS, target % lm.SLOTS
    loss = lambda: -lm.slot_log_probs(p, x, first, group, slot)[places].mean()
    g = lm._gradients(p, x, first, group, slot, real)
    for name, at in [("q", (1, 2)), ("k", (3, 4)), ("v", (0, 1)), ("o", (2, 2)), ("u", (1, 5)), ("w", (4, 3)), ("at", (3, 17)), ("m", (5, 2, 5))]:
        before = p[name][at]
        p[name][at] = before + 1e-5
        up = loss()
        p[name][at] = before - 1e-5
        down = loss()
        p[name][at] = before
        assert abs((up - down) / 2e-5 - g[name][at]) < 1e-6


@pytest.fixture(scope="module")
def judged(spark):
    rnd = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        words = [rnd.choice(["the", "sun", "Sea", "of", "stone", "runs"]) + rnd.choice(["", "s"]) for _ in range(40)]
        bad, toxic = i % 3 == 0, i % 5 == 1
        if bad:
            words = [w + "$$$" for w in words]
        if toxic:
            for _ in range(4):
                words[rnd.randrange(40)] = rnd.choice(["moron", "scum"])
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(not bad), int(toxic)))
    rows += [(None, None, "x"), (700, "", "x"), (701, "!?" * 5, "x"), (5, rows[5][1], "x")]
    labels += [(None, 1, 1), (9999, None, None), (3, None, 0), (3, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, label string")
    return docs, spark.createDataFrame(labels, LABELS), {i: (q, t) for i, q, t in labels}


@pytest.mark.parametrize("score, label", [(quality.score_quality, 0), (toxicity.score_toxicity, 1)])
def test_classifiers(judged, empty, score, label):
    docs, labels, known = judged
    rows = score(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in [*range(600), 700, 701] if zlib.crc32(str(i).encode()) % 5 == 0}
    right = [r.predicted == known[r.doc_id][label] for r in held if r.doc_id in known]
    assert len(right) > 80 and np.mean(right) > 0.95
    assert score(empty, labels).collect() == []
    assert len({r.score for r in score(docs, labels.limit(0)).collect()}) == 1


def test_training_samples_are_bounded(spark, monkeypatch):
    ids = [k for k in range(40) if zlib.crc32(str(k).encode()) % classify.FOLDS]
    texts = [(i, "x" * 10) for i in ids] + [(ids[0], "y" * 10)] * 300 + [(ids[0], None), (ids[1], "z" * 99), (None, "n")]
    docs = spark.createDataFrame([(*t, 1) for t in texts], "doc_id bigint, text string, label int")
    labels = spark.createDataFrame([(i, i % 2) for i in ids] + [(ids[0], 1), (None, 1), (2**40, 1)], "doc_id bigint, quality int")
    found = classify.training_rows(docs, labels, "quality").collect()
    assert sorted((r.text, r.label) for r in found) == sorted(("x" * 10, 1 if i == ids[0] else i % 2) for i in ids)
    assert classify.training_rows(docs, labels, "quality", 5).count() == 5
    monkeypatch.setattr(classify, "SAMPLE_BYTES", 75)
    assert classify.training_rows(docs, labels, "quality").count() == 7
    monkeypatch.setattr(classify, "TEXT_BYTES", 9)
    assert classify.training_rows(docs, labels, "quality").collect() == []


def test_good_documents_keep_their_columns(judged):
    docs, labels, known = judged
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert all((i in ids) == (i % 3 != 0) for i in range(600))


def test_disguised_words_count():
    lexicon = np.sort(toxicity.hash_words(["moron"]))
    texts = [b"you m0ron there", b"a moron", b"plain text", b"YOU are moron!!!"]
    x = toxicity._features(texts, lexicon, np.ones(1))
    at = toxicity.FEATURES.index
    assert x[0, at("disguised")] > 0 and x[0, at("lexicon")] == 0
    assert x[1, at("lexicon")] > 0 and x[1, at("near_second")] == 0 and x[3, at("near_second")] > 0
    assert not x[2, [at("lexicon"), at("disguised")]].any()


def test_isotonic_values_do_not_fall():
    at, value = toxicity.isotonic(np.array([1.0, 2, 3, 4, 5]), np.array([0.0, 1, 0, 1, 1]))
    assert list(value) == sorted(value) and len(at) == len(value)
    assert np.interp(2.5, at, value) == 0.5


def test_stages_keep_columns_of_any_name(spark):
    """Filters give back every column as it came, also those that have the names of their own columns."""
    from termloom.llm import decontaminate, minhash, quality

    kind = "doc_id bigint, text string, _row string, _text string, row string, key string, score string, _n string, `a.b` string"
    item = " ".join(f"bench{k}" for k in range(20))
    texts = ["a clean text of its own " * 3, None, "", item, "the same words come twice here " * 4, "the same words come twice here " * 4]
    rows = [(None if k == 1 else k, t, f"r{k}", f"t{k}", f"w{k}", f"k{k}", f"s{k}", f"n{k}", f"ab{k}") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, kind)
    benchmark = spark.createDataFrame([("i", item)], "item_id string, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    good = quality.keep_good(docs, labels)  # without labels every score is 0.5
    clean = decontaminate.keep_clean(docs, benchmark)
    one = minhash.keep_one_of_each(docs.unionByName(docs.limit(1)))
    assert good.columns == clean.columns == one.columns == docs.columns
    assert sorted(map(tuple, good.collect()), key=repr) == sorted(rows, key=repr)
    assert sorted(map(tuple, clean.collect()), key=repr) == sorted([r for r in rows if r[1] != item], key=repr)
    kept = [tuple(r) for r in one.collect()]
    # A null and an empty text are one class, of which the null id comes first, and so are the two equal texts.
    assert set(kept) <= set(rows) and sorted(r[2] for r in kept) == ["r0", "r1", "r3", "r4"]


def test_truncation_keeps_every_row(spark):
    from termloom.llm import token_counts

    rows = [(None, "one two three"), (1, "four five six"), (1, "four five six"), (1, "seven"), (2, None), (3, ""), (None, None)]
    found = token_counts.truncate(spark.createDataFrame(rows, "doc_id bigint, text string"), 2).collect()
    expected = [(None, "one two"), (1, "four five"), (1, "four five"), (1, "seven"), (2, ""), (3, ""), (None, "")]
    assert sorted(((r.doc_id, r.text.strip()) for r in found), key=repr) == sorted(expected, key=repr)


def test_quality_model_equals_plain_updates():
    """Follow the regularised leader coordinate by coordinate, in plain Python."""
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice(["Sun", "sea", "of", "$$", "x1", "é"]) for _ in range(rnd.randint(0, 30))).encode() for _ in range(70)]
    labels = [int(b"$$" not in t) for t in texts]
    alone = lambda t: quality.features(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0]

    def vector(text):
        found = alone(text)
        counts = Counter(found[found >= 0].tolist())
        return {i: c * quality._SCALE / max(1, len(found)) for i, c in counts.items()} | {1 << quality.BITS: 1.0}

    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= quality._L1:
            return 0.0
        return -(z[i] - math.copysign(quality._L1, z[i])) / ((quality._BETA + math.sqrt(n[i])) / quality._ALPHA + quality._L2)

    sigmoid = lambda x: 1 / (1 + math.exp(-sum(weight(i) * v for i, v in x.items())))
    vectors = [vector(t) for t in texts]
    order = np.random.default_rng(7).permutation(len(texts)).tolist()
    for doc in order * quality.EPOCHS:
        x = vectors[doc]
        error = sigmoid(x) - labels[doc]
        for i, before in {i: weight(i) for i in x}.items():
            g = error * x[i]
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality._ALPHA * before
            n[i] += g * g
    model = quality.fit(texts, labels)
    assert set(np.flatnonzero(model)) == {i for i in z if weight(i)}
    assert all(abs(model[i] - weight(i)) < 1e-6 for i in z)
    ends = np.cumsum([0] + [len(t) for t in texts])
    found = quality.scores(np.frombuffer(b"".join(texts), np.uint8), ends, model)
    assert np.allclose(found, [sigmoid(x) for x in vectors], atol=1e-5)


def test_boosted_trees_equal_plain_ones(monkeypatch):
    """The best cut of each node by trying all of them, rows by rows."""
    monkeypatch.setattr(toxicity, "TREES", 6)
    rng = np.random.default_rng(3)
    x = rng.random((150, 3))
    y = ((x[:, 0] > 0.4) ^ (x[:, 1] > 0.7) ^ (rng.random(150) < 0.1)).astype(float)
    edges = [np.linspace(0.1, 0.9, 9), np.linspace(0.05, 0.95, 7), np.array([])]
    raw = np.zeros(len(y))
    for _ in range(toxicity.TREES):
        p = 1 / (1 + np.exp(-raw))
        value = lambda rows: (y - p)[rows].sum() / ((p * (1 - p))[rows].sum() + 1)  # noqa: E731, B023
        part = lambda rows: (y - p)[rows].sum() * value(rows)  # noqa: E731, B023
        heavy = lambda rows: (p * (1 - p))[rows].sum() >= 0.5  # noqa: E731, B023

        def split(rows, depth):
            cuts = []
            if depth < toxicity.DEPTH and len(rows) >= 20:
                for k, e in enumerate(edges):
                    for cut in e:
                        left, right = rows[x[rows, k] <= cut], rows[x[rows, k] > cut]
                        if heavy(left) and heavy(right):
                            cuts.append((part(left) + part(right) - part(rows), k, cut))  # noqa: B023
            gain, k, cut = max(cuts, default=(0, 0, 0))
            if gain <= 1e-6:
                return [(rows, value(rows))]  # noqa: B023
            return split(rows[x[rows, k] <= cut], depth + 1) + split(rows[x[rows, k] > cut], depth + 1)

        for rows, v in split(np.arange(len(y)), 0):
            raw[rows] += toxicity.RATE * v
    assert np.allclose(toxicity.boosted(x, toxicity.grow(x, y, edges)), raw, atol=1e-9)


def test_near_duplicates_of_the_corpus_are_found(spark, sf_dir):
    """Recall and precision on whole documents, against all pairs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    pairs = lambda group: combinations(sorted(group), 2)
    expected = {p for group in classes([tuple(r) for r in docs.collect()]) for p in pairs(i for i, _ in group)}
    members = defaultdict(list)
    for r in minhash.near_duplicates(docs).collect():
        members[r.class_uid].append(r.doc_id)
    found = {p for group in members.values() for p in pairs(group)}
    assert expected and found <= expected
    assert len(found) >= 0.95 * len(expected)


def test_pipeline_stages_on_awkward_rows(spark, sf_dir):
    """Nulls, empty texts, rows that repeat and empty tables, each stage on what the one before kept."""
    import corpus_pipeline

    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    prose = " ".join(f"word{k}" for k in range(80))
    texts = [(1, prose), (1, prose), (2, prose + " end"), (3, None), (4, ""), (None, "some other words"), (None, None), (5, "x" * 3000)]
    rows = [(i, t, None, "s", None if t is None else len(t)) for i, t in texts]
    docs, nothing = spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, sf_dir)
        assert stage(spark, nothing, sf_dir).collect() == []
        if name == "packing":
            pieces = Counter(r.doc_id for r in out.collect() if r.piece == 0)
            assert pieces == Counter(i for i, _ in before)
            break
        assert out.columns == docs.columns
        after = [(r.doc_id, r.text) for r in out.collect()]
        if name == "near_duplicates":
            assert len(after) == len(classes(before))
        else:
            assert Counter(i for i, _ in after) == Counter(i for i, _ in before)
        docs = spark.createDataFrame(out.collect(), schema)

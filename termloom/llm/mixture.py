"""A mix of sources to target weights, by thresholds on hashes; DataFrame functions only.

Every document gets a hash of its id and text. A source takes its documents as often as its target
holds the whole source, and once more those whose hash lies below a threshold. The threshold comes
from histograms: sizes are summed by source and hash bucket, the bucket in which the running sum
passes the budget is cut into finer buckets, and so on until that bucket holds one document; nothing
is sorted, and what moves is a few thousand sums per source. Rows with one hash, which are rows that
repeat, are told apart by a number of their own in the same way.

The document at the threshold may be larger than what is left of the budget. The rest is then offered
to later documents that fit into it, by a further threshold for those; thresholds are nested: a later
one holds for smaller documents only and lies higher. FILLS such rounds follow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from termloom.session import materialize
from termloom.sizes import fits_broadcast

WEIGHTS = (5, 2, 1)  # of the sources by code point, repeating
MOST = 3  # a target is at most so many times its source
FILLS = 3
BITS = 12  # of a histogram: 4,096 buckets for each source
HASH_BITS = 60
_LEVELS = HASH_BITS // BITS  # histograms on the hash, then as many and one more on row numbers
_UID_TOP = 60
_SALTS = 64
_SPACE = " \t\n\x0b\x0c\r"
_END = (1 << 62) - 1


def word_count(text: Column) -> Column:
    """Number of runs without white space; 0 for null. Each run shrinks to one sign, so no array is built."""
    marks = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.translate(marks, _SPACE, "")).cast("bigint")


def place_hash(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of an MD5 of id and text: the same in every run, and in SQL."""
    own = F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), own)
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def _ranked(sizes: DataFrame) -> DataFrame:
    """key, size of the source, and its place in the order of keys from 0, counted in ranges of keys."""
    dealt = sizes.repartitionByRange("key").withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "sources")
    counts = dealt.groupBy("part").agg(F.count("*").alias("n"))  # one row per range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("part").orderBy("key")) - 1
    placed = dealt.withColumn("own", own).join(F.broadcast(starts), "part")
    return placed.select("key", "source_size", (F.col("start") + F.col("own")).alias("place"))


def _level(sources: DataFrame, most: int) -> float:
    """What a weight of 1 is worth: the level at which targets of weight times level, stopped at ``most``
    times their source, come to all sizes. Sources that stop are found in rounds of one sum each."""
    cap = F.col("source_size") * most
    total = sources.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    level = -1.0
    while True:
        stops = cap <= F.lit(level) * F.col("weight")
        found = sources.agg(
            F.coalesce(F.sum(F.when(stops, cap)), F.lit(0)).alias("stopped"),
            F.coalesce(F.sum(F.when(~stops, F.col("weight"))), F.lit(0)).alias("weights"),
        ).first()
        if not found["weights"]:
            return max(level, 0.0)
        new = float(total - found["stopped"]) / float(found["weights"])
        if new <= level:
            return level
        level = new


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """key, source_size, target, passes, left: how often the target holds the whole source, and the rest."""
    every = F.array(*map(F.lit, weights))
    sources = _ranked(sizes).withColumn("weight", F.get(every, F.pmod(F.col("place"), F.lit(len(weights))).cast("int")))
    sources = materialize(sources, "weights")
    size, cap = F.col("source_size"), (F.col("source_size") * most).cast("double")
    told = sources.withColumn("target", F.least(cap, F.lit(_level(sources, most)) * F.col("weight")))
    passes = F.when(size > 0, F.least(F.lit(most), F.floor(F.col("target") / size))).otherwise(0).cast("bigint")
    told = told.withColumn("passes", passes)
    rest = F.greatest(F.col("target") - F.col("passes") * size, F.lit(0.0))
    left = F.when(F.col("passes") < most, rest).otherwise(0.0)
    return told.select("key", "source_size", "target", "passes", left.alias("left"))


def _meet(rows: DataFrame, table: DataFrame, small: bool) -> DataFrame:
    """Rows with what ``table`` has for their source: by broadcast if its size was counted as small, else
    dealt by source and salt, so that a source of very many rows goes to many tasks."""
    if small:
        return rows.join(F.broadcast(table), "key")
    salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return rows.withColumn("salt", F.pmod("h", F.lit(_SALTS)).cast("int")).join(salted, ["key", "salt"]).drop("salt")


def _below(h: str, uid: str) -> Column:
    return (F.col("h") < F.col(h)) | ((F.col("h") == F.col(h)) & (F.col("uid") < F.col(uid)))


def _cut(rows: DataFrame, wanted: DataFrame, small: bool) -> DataFrame:
    """For each source the first place (th, tu) at which the sizes of its candidates pass ``left``, and what
    is left there. ``wanted``: key, left, most (size of candidates), fh, fu (place from which they count)."""
    state = wanted.withColumns({"p": F.lit(0).cast("bigint"), "th": F.lit(0).cast("bigint")})
    done = []
    for level in range(2 * _LEVELS + 1):
        on_hash = level < _LEVELS
        own = F.col("h" if on_hash else "uid")
        shift = (HASH_BITS if on_hash else _UID_TOP + BITS) - BITS * (level + 1 if on_hash else level - _LEVELS + 1)
        met = _meet(rows, state.select("key", "most", "fh", "fu", "p", "th"), small)
        fits = (F.col("size") <= F.col("most")) & ~_below("fh", "fu")
        if level not in (0, _LEVELS):
            fits &= F.shiftright(own, shift + BITS) == F.col("p")
        if not on_hash:
            fits &= F.col("h") == F.col("th")
        sums = met.filter(fits).groupBy("key", F.shiftright(own, shift).alias("bucket"))
        sums = sums.agg(F.sum("size").alias("sum"), F.count("*").alias("n"))
        along = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        sums = sums.withColumn("cum", F.sum("sum").over(along))
        passed = _meet_small(sums, state).filter(F.col("cum") > F.col("left")).groupBy("key")
        first = passed.agg(F.min_by(F.struct("bucket", "n", (F.col("cum") - F.col("sum")).alias("before")), "bucket").alias("b"))
        found = materialize(state.join(first, "key", "left"), "boundaries")
        bucket, one = F.col("b.bucket"), F.col("b.n") == 1
        begin = F.shiftleft(bucket, shift)
        low = (begin, F.lit(0).cast("bigint")) if on_hash else (F.col("th"), begin)
        ended = found.filter(F.col("b").isNull() | one).select(
            "key",
            "most",
            F.when(F.col("b").isNull(), F.lit(_END)).otherwise(low[0]).alias("th"),
            F.when(F.col("b").isNull(), F.lit(0).cast("bigint")).otherwise(low[1]).alias("tu"),
            F.when(F.col("b").isNull(), F.lit(0.0)).otherwise(F.col("left") - F.col("b.before")).alias("left"),
        )
        done.append(ended)
        state = found.filter(F.col("b.n") > 1).select(
            "key", (F.col("left") - F.col("b.before")).alias("left"), "most", "fh", "fu",
            (bucket if level != _LEVELS - 1 else F.lit(0).cast("bigint")).alias("p"),
            (bucket if level == _LEVELS - 1 else F.col("th")).alias("th"),
        )
        if state.isEmpty():
            break
    out = done[0]
    for some in done[1:]:
        out = out.unionByName(some)
    return out


def _meet_small(sums: DataFrame, state: DataFrame) -> DataFrame:
    """Sums of buckets with the budgets of their sources: a few thousand rows per source at most."""
    return sums.join(state.select("key", "left"), "key")


def with_taken(
    docs: DataFrame, carry: Sequence[str] = ("doc_id",), weights: Sequence[int] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """row (a struct of the columns ``carry``), size, source_size, target, passes, again of every document.

    The mix takes a document ``passes`` times and once more if ``again`` is true: size * (passes + again)
    words. Targets of sources share all words by weight; none is above ``most`` times its source. Reruns
    and other partitionings agree: of rows with one id and text as many are taken, whichever they are.
    Null and blank texts have size 0 and take nothing up; a null source is a source, the last one; ids may be
    null and repeat; no rows give no rows. Besides ``carry`` only doc_id, text and source are read.
    """
    source = F.col("source").cast("string")
    key = F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))
    slim = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row"), key.alias("key"), word_count(F.col("text")).alias("size"),
        place_hash(F.col("doc_id"), F.col("text")).alias("h"), F.monotonically_increasing_id().alias("uid"),
    )
    slim = materialize(slim, "sizes")
    sources = materialize(targets(slim.groupBy("key").agg(F.sum("size").alias("source_size")), weights, most), "targets")
    small = fits_broadcast(sources)
    rows = slim.filter(F.col("size") > 0).select("key", "size", "h", "uid")
    zero = F.lit(0).cast("bigint")
    wanted = sources.select("key", "left", F.lit(_END).alias("most"), zero.alias("fh"), zero.alias("fu"))
    cuts = []
    for _ in range(FILLS + 1):
        wanted = wanted.filter(F.col("left") > 0)
        found = materialize(_cut(rows, wanted, small), "thresholds")
        cuts.append(found.select("key", "most", "th", "tu"))
        wanted = found.filter(F.col("left") >= 1).select(
            "key", "left", F.floor("left").alias("most"), F.col("th").alias("fh"), F.col("tu").alias("fu")
        )
    every = cuts[0]
    for some in cuts[1:]:
        every = every.unionByName(some)
    every = every.groupBy("key").agg(F.collect_list(F.struct("most", "th", "tu")).alias("cuts"))
    plan = sources.join(every, "key", "left").drop("left")
    h, uid, size = F.col("h"), F.col("uid"), F.col("size")
    again = F.exists(
        F.coalesce(F.col("cuts"), F.array().cast("array<struct<most:bigint,th:bigint,tu:bigint>>")),
        lambda x: (size <= x.most) & ((h < x.th) | ((h == x.th) & (uid < x.tu))),
    )
    met = _meet(slim, plan, small)
    return met.select("row", "size", "source_size", "target", "passes", (again & (size > 0)).alias("again"))


def taken(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document, as ``with_taken`` decides."""
    words = F.col("size") * (F.col("passes") + F.col("again").cast("bigint"))
    found = with_taken(docs, ("doc_id",), weights, most)
    return found.select("row.doc_id", "size", "source_size", "target", words.alias("taken"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken.

    Documents of no words are not in it. Nulls, repeats and empty tables as in ``with_taken``.
    """
    copies = F.col("passes") + F.col("again").cast("bigint")
    found = with_taken(docs, docs.columns, weights, most).withColumn("copies", copies)
    found = found.filter((F.col("copies") > 0) & (F.col("size") > 0))
    found = found.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"))
    return found.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))

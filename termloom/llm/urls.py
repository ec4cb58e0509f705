"""URL filter: rules by host and path, and for all other URLs a ratio of two character models.

URLs that a rule decides teach two variable-order Markov models, one for accepted and one for
rejected URLs. Each backs off from two characters of context to one to none with Witten-Bell
weights. A URL's score is its log-likelihood difference per character, and the threshold is the
one that errs least, both classes weighing the same, on rule-decided URLs kept from the models.

Characters are folded into an alphabet of fixed size, so a model has at most SYMBOLS ** 3
entries whatever the number of URLs; that is the bound of what scoring looks up. Only DataFrame
functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from termloom.session import materialize

# The folded alphabet: start mark, any other character, digits as one, the rest as themselves.
ALPHABET = "^*0abcdefghijklmnopqrstuvwxyz/.-_?=&#:%"
SYMBOLS = len(ALPHABET)
_PAST = "[^0a-z/.\\-_?=&#:%]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
KEPT_FOLDS = 5  # one in so many decided URLs sets the threshold
STEP = 1000  # scores are compared with thresholds in steps of 1 / STEP


def with_parts(pages: DataFrame) -> DataFrame:
    """page_id and url with host and path; both empty for null and for URLs without ``://``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return pages.select(
        "page_id",
        "url",
        F.translate(F.regexp_extract(url, parts, 1), UPPER, LOWER).alias("host"),
        F.regexp_extract(url, parts, 2).alias("path"),
    )


def _rule(rules) -> Column:
    """The longest fitting rule as a struct of its length, itself and its verdict; null if none fits."""
    fits = []
    for rule, verdict in rules:
        host, _, rest = rule.partition("/")
        own = (F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))
        found = F.struct(
            F.lit(len(rule)).alias("n"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")
        )
        fits.append(F.when(own & F.startswith(F.col("path"), F.lit("/" + rest)), found))
    return F.greatest(*fits) if len(fits) > 1 else fits[0]


def _folded() -> Column:
    text = F.translate(F.coalesce(F.col("url"), F.lit("")), UPPER, LOWER)
    text = F.regexp_replace(F.regexp_replace(text, "[0-9]", "0"), _PAST, "*")
    return F.concat(F.lit("^^"), text)


def _codes(text: Column) -> Column:
    """One number for each character with its two predecessors."""
    place = lambda at: F.instr(F.lit(ALPHABET), F.substring(text, at, F.lit(1))) - 1
    return F.when(
        F.length(text) > 2,
        F.transform(
            F.sequence(F.lit(1), F.length(text) - 2),
            lambda i: place(i) * SYMBOLS * SYMBOLS + place(i + 1) * SYMBOLS + place(i + 2),
        ),
    ).otherwise(F.array().cast("array<int>"))


def model(grams: DataFrame) -> DataFrame:
    """(code, ratio): log probability of each character in its context, accepted less rejected.

    ``grams`` has each code that any URL holds, with its counts n_allow and n_block.
    """
    n = float(SYMBOLS)
    rows = grams.withColumn("pair", F.pmod("code", F.lit(SYMBOLS * SYMBOLS))).withColumn(
        "one", F.pmod("code", F.lit(SYMBOLS))
    )
    rows = rows.withColumn("context", F.floor(F.col("code") / SYMBOLS)).withColumn(
        "before", F.floor(F.col("pair") / SYMBOLS)
    )
    for side in ("n_allow", "n_block"):
        ones = rows.groupBy("one").agg(F.sum(side).alias("c1"))
        total = ones.agg(F.sum("c1").alias("N"), F.sum((F.col("c1") > 0).cast("int")).alias("T"))
        ones = ones.select("one", "c1", total.select("N").scalar().alias("N"), total.select("T").scalar().alias("T"))
        ones = ones.select(
            "one",
            F.when(F.col("N") + F.col("T") > 0, (F.col("c1") + F.col("T") / n) / (F.col("N") + F.col("T")))
            .otherwise(1 / n)
            .alias("p1"),
        )
        pairs = rows.groupBy("pair", "before", "one").agg(F.sum(side).alias("c2"))
        near = pairs.groupBy("before").agg(F.sum("c2").alias("N2"), F.sum((F.col("c2") > 0).cast("int")).alias("T2"))
        pairs = pairs.join(near, "before").join(ones, "one")
        pairs = pairs.select("pair", _backed_off("c2", "N2", "T2", "p1").alias("p2"))
        far = rows.groupBy("context").agg(F.sum(side).alias("N3"), F.sum((F.col(side) > 0).cast("int")).alias("T3"))
        rows = rows.join(far, "context").join(pairs, "pair")
        rows = rows.withColumn(f"p_{side}", _backed_off(side, "N3", "T3", "p2")).drop("N3", "T3", "p2")
    return rows.select("code", (F.log("p_n_allow") - F.log("p_n_block")).alias("ratio"))


def _backed_off(count: str, total: str, types: str, lower: str) -> Column:
    weight = F.col(total) + F.col(types)
    return F.when(weight > 0, (F.col(count) + F.col(types) * F.col(lower)) / weight).otherwise(F.col(lower))


def _score(codes: Column, ratios: Column) -> Column:
    """Mean log ratio per character; 0 for no characters."""
    total = F.aggregate(codes, F.lit(0.0), lambda s, g: s + F.coalesce(F.get(ratios, g), F.lit(0.0)))
    return F.when(F.size(codes) > 0, total / F.size(codes)).otherwise(0.0)


def _threshold(scored: DataFrame) -> Column:
    """The step with the fewest errors as a scalar: accept scores at or above it. 0 if a class lacks."""
    steps = scored.groupBy(F.floor(F.col("score") * STEP).alias("step")).agg(
        F.count(F.when(F.col("verdict") == "allow", 1)).alias("good"),
        F.count(F.when(F.col("verdict") == "block", 1)).alias("bad"),
    )
    below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    all_steps = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # Scores are means of bounded log ratios, so steps are some thousands at most.
    errors = steps.select(
        "step",
        (
            F.coalesce(F.sum("good").over(below), F.lit(0)) / F.sum("good").over(all_steps)
            + (F.sum("bad").over(all_steps) - F.coalesce(F.sum("bad").over(below), F.lit(0)))
            / F.sum("bad").over(all_steps)
        ).alias("error"),
        F.sum("good").over(all_steps).alias("goods"),
        F.sum("bad").over(all_steps).alias("bads"),
    ).filter((F.col("goods") > 0) & (F.col("bads") > 0))
    best = errors.agg(F.min_by("step", F.struct("error", "step")).alias("step"))
    return F.coalesce(best.scalar(), F.lit(0)) / STEP


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every page.

    A rule decides where one fits: the longest. Other pages are allowed if their score reaches the
    threshold. A null or empty URL has score 0 and no rule. If no URL is decided by a rule, or only
    one way, the models say nothing definite and the threshold is 0. Rows that repeat are judged alike;
    null page ids stay null; no rows give no rows; only page_id and url are read.
    """
    rows = with_parts(pages).withColumn("found", _rule(rules))
    rows = rows.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("verdict"),
        _folded().alias("text"),
    )
    rows = rows.withColumn("kept", F.pmod(F.crc32(F.col("text").cast("binary")), F.lit(KEPT_FOLDS)) == 0)
    learned = lambda verdict: F.count(F.when((F.col("verdict") == verdict) & ~F.col("kept"), 1))
    grams = (
        rows.select("verdict", "kept", F.explode(_codes(F.col("text"))).alias("code"))
        .groupBy("code")
        .agg(learned("allow").alias("n_allow"), learned("block").alias("n_block"))
    )
    ratios = _laid_out(model(materialize(grams, "grams")))
    scored = rows.withColumn("score", _score(_codes(F.col("text")), ratios))
    decided = scored.filter(F.col("rule").isNotNull() & F.col("kept")).select("score", "verdict")
    passes = F.when(F.col("score") >= _threshold(decided), "allow").otherwise("block")
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce(F.col("verdict"), passes).alias("verdict"), "score"
    )


def _laid_out(entries: DataFrame) -> Column:
    """A constant array whose element at a code is its ratio, to six digits, 0 where no URL has the code.

    It has SYMBOLS ** 3 elements whatever the number of pages, so it can stand in the plan: each
    task looks ratios up without a join.
    """
    found = {r["code"]: f"{r['ratio']:.6f}" for r in entries.collect()}
    text = " ".join(found.get(code, "0") for code in range(SYMBOLS**3))
    return F.split(F.lit(text), " ").cast("array<double>")

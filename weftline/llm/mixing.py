"""Mixing to target weights with soft membership.

A Bernoulli naive Bayes classifier learns the domains of a labelled table from hashed word, word-ending and shape
features and gives every document a posterior over them.  Each document then gets a nonnegative rate such that the expected tokens of
each domain, posteriors times tokens times rate, match the targets: least squares by projected gradient, where a round
is one distributed sum per domain and the rates stay an expression of posteriors and the rounds' residuals.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, materialize, table, words

#: Domain of a row of labels, and the wanted shares of tokens.
DOMAIN = "CASE WHEN quality = 0 THEN 'low' WHEN quality = 1 AND toxic = 1 THEN 'toxic' WHEN quality = 1 AND toxic = 0 THEN 'clean' END"
TARGETS = {"clean": 0.96, "low": 0.03, "toxic": 0.01}
#: The domain whose documents should come out about so many times; the others follow from the shares.
ANCHOR, ANCHOR_RATE = "clean", 1.05
#: Feature buckets; standard deviations by which some domain's count must exceed chance for a bucket to be used (the
#: noise of hundreds of buckets would drown the few that matter), those from which a domain has a rate of its own there,
#: and the least log-ratio; documents added to counts.
BUCKETS, SIGMAS, OWN, CLEAR, PSEUDO = 1 << 18, 6.0, 3.0, 0.5, 1.0
ROUNDS, TOLERANCE = 25, 1e-6


def features(text: Column) -> Column:
    """Distinct buckets of a text: words, word endings of three characters, and length with share of distinct words."""
    bucket = lambda kind, x: F.pmod(F.xxhash64(F.lit(kind), x), F.lit(BUCKETS)).cast("int")

    def of(w: Column) -> Column:
        d = F.array_distinct(w)
        shape = F.concat_ws(",", F.floor(F.log2(F.size(w) + F.lit(1.0))).cast("string"), F.floor(F.size(F.array_distinct(w)) * 8 / F.greatest(F.size(w), F.lit(1))).cast("string"))
        return F.array_distinct(F.concat(F.array(bucket("s", shape)), let(d, lambda d: F.concat(F.transform(d, lambda x: bucket("w", x)), F.array_distinct(F.transform(d, lambda x: bucket("e", F.right(x, F.lit(3)))))))))

    return let(words(F.lower(F.coalesce(text, F.lit("")))), of)


def fit(featured: DataFrame, labels: DataFrame, domains: list[str]) -> tuple[list[float], dict[int, list[float]]]:
    """The log-odds of a text without any used feature, and for each used bucket what its presence adds, by domain.

    featured has doc_id and the buckets f; it is joined by merging at every size, so that plans don't change with it.
    Counts are over all labelled rows; only those of used buckets, at most BUCKETS, come to the driver.
    """
    from math import log

    known = labels.select("doc_id", F.expr(DOMAIN).alias("domain")).where("domain is not null").distinct()
    own = featured.select("doc_id", "f").join(known.hint("merge"), "doc_id").select("domain", F.explode(F.concat(F.array(F.lit(-1)), "f")).alias("b"))
    counts = own.groupBy("b").agg(*[F.count(F.when(F.col("domain") == d, 1)).cast("double").alias(f"n{i}") for i, d in enumerate(domains)])
    counts = materialize(counts, "counts")
    sizes = next(([r[f"n{i}"] for i in range(len(domains))] for r in counts.where("b = -1").collect()), [0.0] * len(domains))
    total = sum(sizes)
    prior = [log((s + 1) / (total + len(domains))) for s in sizes]
    if not total:
        return prior, {}
    tells = F.lit(False)
    whole = sum((F.col(f"n{i}") for i in range(len(domains))), F.lit(0.0))
    for i, s in enumerate(sizes):
        n, chance = F.col(f"n{i}"), whole * (s / total)
        tells = tells | ((n - chance >= SIGMAS * F.sqrt(chance + 1)) & (F.log((n + PSEUDO) / (chance + PSEUDO)) >= CLEAR))
    weights = {}
    for r in counts.where("b >= 0").where(tells).orderBy("b").collect():
        of = [r[f"n{i}"] for i in range(len(domains))]
        shared = (sum(of) + PSEUDO) / (total + 2 * PSEUDO)
        weights[r["b"]] = []
        for i, (n, s) in enumerate(zip(of, sizes, strict=True)):
            chance = s * sum(of) / total
            p = (n + PSEUDO * shared) / (s + PSEUDO) if abs(n - chance) >= OWN * (chance + 1) ** 0.5 else shared
            p = min(max(p, 1e-6), 1 - 1e-6)
            prior[i] += log(1 - p)
            weights[r["b"]].append(log(p / (1 - p)))
    return prior, weights


def posteriors(featured: DataFrame, prior: list[float], weights: dict[int, list[float]], domains: list[str]) -> DataFrame:
    """featured (f) with p_<domain>; the weights travel as constants of the plan: a place for each bucket,
    and a row of weights for each place."""
    places = ["0"] * BUCKETS
    for i, b in enumerate(sorted(weights)):
        places[b] = str(i + 1)
    place_of = F.from_json(F.lit(f"[{','.join(places)}]"), "array<int>")
    rows = F.from_json(F.lit(json.dumps([[0.0] * len(domains), *(weights[b] for b in sorted(weights))])), "array<array<double>>")
    start = F.array(*[F.lit(p) for p in prior])
    used = F.filter(F.transform("f", lambda b: F.get(place_of, b)), lambda i: i > 0)
    odds = F.aggregate(used, start, lambda a, i: F.zip_with(a, F.get(rows, i), lambda x, y: x + y))
    soft = let(odds, lambda o: F.transform(o, lambda x: F.exp(F.greatest(x - F.array_max(o), F.lit(-60.0)))))
    share = let(soft, lambda s: F.transform(s, lambda x: x / F.aggregate(s, F.lit(0.0), lambda a, y: a + y)))
    return featured.withColumn("_p", share).withColumns({f"p_{d}": F.get("_p", F.lit(i)) for i, d in enumerate(domains)}).drop("_p")


def rates(members: DataFrame, targets: dict[str, float] = TARGETS, anchor: str = ANCHOR, anchor_rate: float = ANCHOR_RATE) -> Column:
    """The rate of each row of members (n_tokens, p_<domain>) as an expression.

    Minimises the sum over domains of (expected - wanted)^2 / mass from rate 1; mass is a domain's expected tokens at
    rate 1, which makes steps of length 1 safe.  A domain without mass has no say.
    """
    domains = sorted(targets)
    sums = lambda r: [float(x or 0) for x in members.agg(*[F.sum(F.col("n_tokens") * F.col(f"p_{d}") * r).alias(d) for d in domains]).first()]
    mass = sums(F.lit(1.0))
    if not any(mass):
        return F.lit(1.0)
    at = domains.index(anchor)
    budget = anchor_rate * mass[at] / targets[anchor] if mass[at] else sum(mass)
    wanted = [targets[d] * budget for d in domains]
    rate, expected = F.lit(1.0), mass
    for _ in range(ROUNDS):
        step = [(e - w) / m if m else 0.0 for e, w, m in zip(expected, wanted, mass, strict=True)]
        if max(abs(s) * m for s, m in zip(step, mass, strict=True)) <= TOLERANCE * budget:
            break
        move = F.lit(0.0)
        for d, s in zip(domains, step, strict=True):
            move = move + F.col(f"p_{d}") * s
        rate = F.greatest(F.lit(0.0), rate - move)
        expected = sums(rate)
    return rate


def copies(doc_id: Column, rate: Column) -> Column:
    """How often a row is taken: the rate rounded up or down by a hash of the id, so that it is met in expectation."""
    u = F.pmod(F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + u).cast("int")


def mix_documents(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in keep (doc_id among them), n_tokens, p_<domain>, rate, n_copies for every row of docs.

    A null text has no words and gets the posterior of its shape; it adds no tokens.  Without labelled rows posteriors
    are even.  Rows that repeat an id or a text are rated alike.  Labels that are null or outside 0 and 1 teach nothing.
    An empty table gives no rows; other columns of docs are ignored.
    """
    domains = sorted(targets)
    keep = [c for c in keep if c not in ("f", "n_tokens")]
    featured = materialize(docs.select(*keep, F.size(words(F.col("text"))).cast("long").alias("n_tokens"), features(F.col("text")).alias("f")), "features")
    prior, weights = fit(featured, labels, domains)
    members = materialize(posteriors(featured, prior, weights, domains).select(*keep, "n_tokens", *(f"p_{d}" for d in domains)), "members")
    rate = rates(members, targets)
    return members.withColumn("rate", rate).withColumn("n_copies", copies(F.col("doc_id"), F.col("rate")))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors of every document and the rates that bring the domains' tokens to their targets."""
    return mix_documents(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))

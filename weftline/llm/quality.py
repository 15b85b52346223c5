"""Quality filtering by weak supervision.

Cheap rules look at each text and vote keep (1), reject (-1) or abstain (0).  Nobody labels anything: expectation
maximisation over the counts of vote patterns (at most 3 to the number of rules, whatever the corpus) estimates how
often each rule is right on good and on bad documents, and a document is kept if its posterior probability of being
good reaches one half.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, materialize, table, words

#: Rounds of expectation maximisation, and where it starts.
ROUNDS, PRIOR = 30, 0.9
#: Accuracy on good documents (keep votes) and on bad ones (reject votes): start, lowest, highest.  Rules are one-sided:
#: most bad documents pass most rules, so only the first can't fall below chance.
ON_GOOD, ON_BAD = (0.95, 0.6, 0.99), (0.5, 0.05, 0.97)
#: Pseudo-votes at the start values.
PSEUDO = 10.0
WINDOW = 8

#: Integer conditions over the statistics: a name, when the rule votes to reject, when it votes to keep.
RULES = [
    ("length", "n_words < 20", "n_words >= 40"),
    ("word_length", "10 * word_chars < 20 * n_words OR 10 * word_chars > 130 * n_words", "10 * word_chars >= 30 * n_words AND 10 * word_chars <= 100 * n_words"),
    ("symbols", "100 * n_symbols > 10 * n_words", "100 * n_symbols <= 3 * n_words"),
    ("lines", "100 * n_dup_lines > 50 * n_lines", "100 * n_dup_lines <= 5 * n_lines"),
    ("repeats", "100 * n_repeat_words > 30 * n_words", "100 * n_repeat_words <= 10 * n_words"),
    ("letters", "100 * n_letters < 80 * word_chars", "100 * n_letters >= 90 * word_chars"),
]
BASE_FAILED = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words"
VOTES = [f"CASE WHEN {no} THEN -1 WHEN {yes} THEN 1 ELSE 0 END" for _, no, yes in RULES]


def repeated_words(w: Column, n: int = WINDOW) -> Column:
    """How many words of the array w lie in a window of n words that occurs twice or more in it.

    Hashes of the windows show that almost all texts have none; the others compare the windows themselves.
    """
    starts = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - (n - 1))).otherwise(F.array().cast("array<int>"))
    keyed = F.array_sort(F.transform(starts, lambda i: F.struct(F.array_join(F.slice(w, i, n), " ").alias("k"), i.alias("p"))))
    key = lambda s, j: F.get(s, j)["k"]
    twice = let(keyed, lambda s: F.filter(F.transform(F.sequence(F.lit(0), F.size(s) - 1), lambda j: F.when((key(s, j) == key(s, j - 1)) | (key(s, j) == key(s, j + 1)), F.get(s, j)["p"])), lambda p: p.isNotNull()))
    covered = F.aggregate(
        F.array_sort(twice),
        F.struct(F.lit(0).cast("int").alias("n"), F.lit(0).cast("int").alias("end")),
        lambda a, p: F.struct((a["n"] + (p + n - F.greatest(p, a["end"]))).cast("int").alias("n"), (p + n).cast("int").alias("end")),
        lambda a: a["n"],
    )
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, n)))
    return F.when(let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h)), F.lit(0)).otherwise(covered).cast("long")


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the statistics of RULES as columns, from whole texts; a null text has no words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    w, found = _free("words", docs.columns), _free("lines", docs.columns)
    return (
        docs.withColumn(w, words(text))
        .withColumn(found, lines)
        .withColumns(
            {
                "n_words": F.size(w).cast("long"),
                "word_chars": F.aggregate(w, F.lit(0), lambda a, x: a + F.length(x)).cast("long"),
                "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
                "n_lines": F.size(found).cast("long"),
                "n_dup_lines": (F.size(found) - F.size(F.array_distinct(found))).cast("long"),
                "n_repeat_words": repeated_words(F.col(w)),
                "n_letters": F.length(F.regexp_replace(text, r"\P{L}+", "")).cast("long"),
            }
        )
        .drop(w, found)
    )


def _free(name: str, taken: list[str]) -> str:
    """A column name that is not taken yet."""
    taken = {x.lower() for x in taken}
    while name in taken:
        name += "_"
    return name


def estimate(patterns: DataFrame, votes: list[str]) -> tuple[float, list[float], list[float]]:
    """The share of good documents and each rule's accuracy on good and on bad ones, from counts of vote patterns (columns votes and n).

    The patterns are folded into one row and the rounds run there as one expression, in an order that doesn't
    depend on how the rows were spread.
    """
    pats = F.array_sort(F.collect_list(F.struct(F.array(*votes).alias("v"), F.col("n").cast("double").alias("n"))))
    start = F.struct(F.lit(PRIOR).alias("pi"), *(F.array(*[F.lit(x[0])] * len(votes)).alias(c) for c, x in (("a", ON_GOOD), ("b", ON_BAD))))

    def one_round(state: Column, pats: Column) -> Column:
        weight = F.zip_with(state["a"], state["b"], lambda a, b: F.struct(F.log(a / (1 - b)).alias("keep"), F.log((1 - a) / b).alias("reject")))
        said = lambda v, w: F.when(v > 0, w["keep"]).when(v < 0, w["reject"]).otherwise(0.0)
        odds = lambda p: F.log(state["pi"] / (1 - state["pi"])) + F.aggregate(F.zip_with(p["v"], weight, said), F.lit(0.0), lambda a, x: a + x)
        soft = F.transform(pats, lambda p: F.struct(p["v"].alias("v"), p["n"].alias("n"), (1 / (1 + F.exp(-odds(p)))).alias("q")))
        total = lambda s, f: F.aggregate(s, F.lit(0.0), lambda a, x: a + f(x))

        def accuracy(s: Column, j: int, good: bool) -> Column:
            first, low, high = ON_GOOD if good else ON_BAD
            v = lambda x: F.get(x["v"], F.lit(j))
            mass = lambda x: x["n"] * (x["q"] if good else 1 - x["q"])
            right = total(s, lambda x: F.when(v(x) > 0 if good else v(x) < 0, mass(x)).otherwise(0.0))
            cast = total(s, lambda x: F.when(v(x) != 0, mass(x)).otherwise(0.0))
            return F.least(F.lit(high), F.greatest(F.lit(low), (right + PSEUDO * first) / (cast + PSEUDO)))

        return let(
            soft,
            lambda s: F.struct(
                ((total(s, lambda x: x["n"] * x["q"]) + PSEUDO * PRIOR) / (total(s, lambda x: x["n"]) + PSEUDO)).alias("pi"),
                *(F.array(*[accuracy(s, j, good) for j in range(len(votes))]).alias(c) for c, good in (("a", True), ("b", False))),
            ),
        )

    folded = patterns.agg(pats.alias("pats")).select(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda state, _: one_round(state, F.col("pats"))).alias("em"))
    row = folded.first()["em"]  # one row of 2 * len(votes) + 1 numbers
    return row["pi"], list(row["a"]), list(row["b"])


def judge(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns in keep (all of docs if not given) with statistics, votes (vote_<rule>), posterior, base_failed, kept.

    Statistics are written to the shared folder once, so that texts are gone through once for estimating and judging.

    Null and empty texts have no words and so fail the base rule; a repeated row votes once per copy, as the counts say.
    Columns of docs that clash with the new ones are replaced.  An empty table gives no rows.
    """
    import math

    names = [f"vote_{name}" for name, _, _ in RULES]
    made = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters"]
    new = {x.lower() for x in (*made, *names, "posterior", "base_failed", "kept")}
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    docs = docs.select(*dict.fromkeys([*keep, text_col]))
    counted = materialize(text_statistics(docs, text_col).select(*keep, *made), "statistics")
    voted = counted.withColumns({c: F.expr(v) for c, v in zip(names, VOTES, strict=True)})
    pi, on_good, on_bad = estimate(voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")), names)
    odds = F.lit(math.log(pi / (1 - pi)))
    for c, a, b in zip(names, on_good, on_bad, strict=True):
        odds = odds + F.when(F.col(c) > 0, math.log(a / (1 - b))).when(F.col(c) < 0, math.log((1 - a) / b)).otherwise(0.0)
    failed = F.expr(BASE_FAILED)
    return voted.withColumn("posterior", 1 / (1 + F.exp(-odds))).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's word statistics, the base rule's verdict and that of the weakly supervised model."""
    judged = judge(table(spark, sf_dir, "documents", "doc_id", "text"), keep=["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_ODDS = " + ".join(["ln(pi / (1 - pi))", *(f"CASE WHEN v{j} > 0 THEN ln(a{j} / (1 - b{j})) WHEN v{j} < 0 THEN ln((1 - a{j}) / b{j}) ELSE 0 END" for j in range(len(RULES)))])
_Q = f"(1 / (1 + exp(-({_ODDS}))))"
_ACC = ", ".join(
    f"least({high}, greatest({low}, (sum(CASE WHEN v{j} {sign} 0 THEN n * {mass} ELSE 0 END) + {PSEUDO * first}) / (sum(CASE WHEN v{j} <> 0 THEN n * {mass} ELSE 0 END) + {PSEUDO})))"
    for (first, low, high), sign, mass in ((ON_GOOD, ">", "q"), (ON_BAD, "<", "(1 - q)"))
    for j in range(len(RULES))
)
OP2_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), win AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, k) AS c
  FROM (SELECT doc_id, unnest(range(1, len(w) - {WINDOW - 2})) AS p, unnest(list_transform(range(1, len(w) - {WINDOW - 2}), lambda i: array_to_string(w[i:i + {WINDOW - 1}], ' '))) AS k FROM w WHERE len(w) >= {WINDOW})
), rep AS (
  SELECT doc_id, CAST(count(DISTINCT q) AS BIGINT) AS r FROM (SELECT doc_id, unnest(range(p, p + {WINDOW})) AS q FROM win WHERE c > 1) GROUP BY doc_id
), s AS (
  SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(r, 0) AS n_repeat_words,
         CAST(length(regexp_replace(t, '\P{{L}}+', '', 'g')) AS BIGINT) AS n_letters
  FROM w LEFT JOIN rep USING (doc_id)
), v AS (
  SELECT *, {", ".join(f"{x} AS v{j}" for j, x in enumerate(VOTES))} FROM s
), pat AS (
  SELECT {", ".join(f"v{j}" for j in range(len(RULES)))}, CAST(count(*) AS DOUBLE) AS n FROM v GROUP BY ALL
), em AS (
  SELECT 0 AS i, CAST({PRIOR} AS DOUBLE) AS pi, {", ".join(f"CAST({x} AS DOUBLE) AS {c}{j}" for c, x in (("a", ON_GOOD[0]), ("b", ON_BAD[0])) for j in range(len(RULES)))}
  UNION ALL
  SELECT i + 1, (sum(n * q) + {PSEUDO * PRIOR}) / (sum(n) + {PSEUDO}), {_ACC}
  FROM (SELECT em.i, pat.*, {_Q} AS q FROM em, pat WHERE em.i < {ROUNDS}) GROUP BY i
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({BASE_FAILED}) AS base_failed,
       NOT ({BASE_FAILED}) AND {_Q} >= 0.5 AS kept
FROM v, (SELECT * FROM em WHERE i = {ROUNDS})
"""

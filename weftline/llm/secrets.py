"""Secret scanning over an incremental ledger of blobs.

A blob is a text under its SHA-256.  The ledger holds, per blob and rule version, the spans that were found.  A scan
takes every version of every path, keeps one row per blob, drops the (blob, rule version) pairs that the ledger knows,
scans what remains, and joins the ledger back to all paths.  So a text that many paths or many versions share is
scanned once, and a changed rule rescans blobs for that rule alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

#: Kind, rule version, pattern, the group whose length counts, and its least length; shorter matches are dropped after
#: matching, so they still use up their characters.  Keywords match in either case.
RULES = [
    ("assign", "assign-1", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", "access-1", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", "hex-1", r"[0-9a-f]+", 0, 32),
]
#: A cheaper pattern that finds the same matches once those that are too short are dropped: a run is maximal either way.
FASTER = {"access-1": r"AKIA[A-Z0-9]{12,}", "hex-1": r"[0-9a-f]{32,}"}
LEDGER = "blob string, rule_version string, kind string, spans array<struct<s:int,e:int>>"
_SPANS = "array<struct<s:int,e:int>>"


def spans_of(text: Column, version: str, pattern: str, group: int, least: int) -> Column:
    """Leftmost non-overlapping matches as code-point spans, end exclusive; the short ones are dropped."""
    pattern = FASTER.get(version, pattern)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    wide = F.transform(found, lambda m: F.struct(F.length(m).alias("n"), (F.length(F.regexp_extract(m, pattern, group)) >= least).alias("ok")))
    none = F.array().cast(_SPANS)
    placed = F.aggregate(
        F.zip_with(wide, gaps, lambda m, g: F.struct(m["n"].alias("n"), m["ok"].alias("ok"), g.alias("g"))),
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        # zip_with pads the matches, of which there is one less than of gaps
        lambda a, x: F.struct(
            (a["at"] + x["g"] + F.coalesce(x["n"], F.lit(0))).alias("at"),
            F.when(x["ok"], F.concat(a["out"], F.array(F.struct((a["at"] + x["g"]).alias("s"), (a["at"] + x["g"] + x["n"]).alias("e"))).cast(_SPANS))).otherwise(a["out"]).alias("out"),
        ),
        lambda a: a["out"],
    )
    return F.when(F.regexp_like(text, F.lit(pattern)), placed).otherwise(none)


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None, rules=RULES) -> DataFrame:
    """New ledger rows (blob, rule_version, kind, spans) for the blobs of versions (columns blob, text).

    A blob is scanned by the rules under which the ledger lacks it; a pair without findings gets a row too, so that it
    is not scanned again.
    """
    blobs = versions.groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is None:
        blobs = blobs.withColumn("seen", F.array().cast("array<string>"))
    else:
        known = ledger.groupBy("blob").agg(F.collect_set("rule_version").alias("seen"))  # at most one entry per rule
        blobs = blobs.join(known, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
    todo = [
        F.when(
            ~F.array_contains("seen", version),
            F.struct(F.lit(version).alias("rule_version"), F.lit(kind).alias("kind"), spans_of(F.col("text"), version, pattern, group, least).alias("spans")),
        )
        for kind, version, pattern, group, least in rules
    ]
    return blobs.select("blob", F.explode(F.filter(F.array(*todo), lambda x: x.isNotNull())).alias("f")).select("blob", "f.*")


def findings(ledger: DataFrame, rules=RULES) -> DataFrame:
    """One row per blob with findings: blob, and found as [(s, kind's place, e, kind)] in order, under the given rules."""
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r[0], i)])
    now = [r[1] for r in rules]
    return (
        ledger.where(F.col("rule_version").isin(now) & (F.size("spans") > 0))
        .groupBy("blob")
        .agg(F.flatten(F.collect_list(F.transform("spans", lambda x: F.struct(x["s"].alias("s"), order[F.col("kind")].alias("place"), x["e"].alias("e"), F.col("kind").alias("kind"))))).alias("found"))
        .select("blob", F.array_sort("found").alias("found"))
    )


def scan_documents(docs: DataFrame, ledger: DataFrame | None = None, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """docs with blob and found joined back to every row, and the new ledger rows (written to the shared folder).

    A null text is the empty text; rows that repeat a text share its findings; an empty table gives no rows.  Columns
    named blob or found are replaced, others pass through.
    """
    docs = docs.drop("blob", "found").withColumn("blob", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    new = materialize(scan_unseen(docs.select("blob", F.coalesce(F.col(text_col), F.lit("")).alias("text")), ledger), "ledger")
    full = new if ledger is None else new.unionByName(ledger)
    hits = materialize(findings(full), "findings")
    return docs.join(hits, "blob", "left").withColumn("found", F.coalesce("found", F.array().cast("array<struct<s:int,place:int,e:int,kind:string>>"))), new


def spans_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def redact(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """text with every span replaced by mark; spans that overlap become one mark."""
    done = F.aggregate(
        found,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, x: F.struct(
            F.when(x["s"] >= a["at"], F.concat(a["out"], F.substring(text, a["at"] + 1, x["s"] - a["at"]), F.lit(mark))).otherwise(a["out"]).alias("out"),
            F.greatest(a["at"], x["e"]).alias("at"),
        ),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))),
    )
    return F.when(F.size(found) > 0, done).otherwise(text)


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document, each distinct text scanned once."""
    scanned, _ = scan_documents(table(spark, sf_dir, "documents", "doc_id", "text"))
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long")
    joined = spans_text(F.col("found"))
    return scanned.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(joined, 256).alias("base_sha256"),
        joined.alias("spans"),
    )


def _sql_spans(place: int, kind: str, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''")
    return f"""
SELECT doc_id, {place} AS place, '{kind}' AS kind, CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s,
       length(m[i]) AS n, length(regexp_extract(m[i], '{p}', {group})) >= {least} AS ok
FROM (SELECT doc_id, m, g, unnest(range(1, len(m) + 1)) AS i FROM (
  SELECT doc_id, regexp_extract_all(t, '{p}') AS m, regexp_split_to_array(t, '{p}') AS g FROM d WHERE regexp_matches(t, '{p}')))"""


OP8_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents
), f AS ({" UNION ALL ".join(_sql_spans(i, k, p, g, n) for i, (k, _, p, g, n) in enumerate(RULES))}
), j AS (
  SELECT doc_id, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access, count(*) FILTER (place = 2) AS n_hex,
         string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, place) AS spans
  FROM f WHERE ok GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN j USING (doc_id)
"""

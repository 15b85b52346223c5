"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its words, its word pairs and its pairs around one word, whatever their
number.  Training runs over a bounded sample of labelled rows with per-coordinate rates; L1 keeps weights at zero until
there is evidence for them, so what the executors get is a short list of (bucket, weight).  Where one label is thinned
more than the other, its rows weigh so much more, so a score means the same at every size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import hash_words, mix, number, pieces
from .common import table

BUCKETS = 1 << 20
ALPHA, BETA, L1, L2 = 0.5, 1.0, 8.0, 0.1
EPOCHS = 4
#: Labelled rows to train on, at most about so many of each label (a hash of the id picks them), and their characters.
SAMPLE_PER_LABEL, SAMPLE_CHARS = 4_000, 60_000_000


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 marks rows that are held out."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5))


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text's place, bucket) of every n-gram and skip-gram, repeats included."""
    codes, distinct, off = number([t.lower() for t in texts])
    h = hash_words([w.strip(".,;:!?\"'()[]*#$%&-") or w for w in distinct])[codes] if len(codes) else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(texts)), np.diff(off))
    docs, keys = [doc], [mix(h ^ np.uint64(1))]
    for gap in (1, 2):
        same = doc[:-gap] == doc[gap:]
        docs.append(doc[:-gap][same])
        keys.append(mix(h[:-gap][same] * np.uint64(3) + h[gap:][same] * np.uint64(5) + np.uint64(gap)))
    return np.concatenate(docs), (np.concatenate(keys) % np.uint64(BUCKETS)).astype(np.int64)


@dataclass
class Model:
    """bias and the nonzero weights by bucket."""

    bias: float
    buckets: np.ndarray
    weights: np.ndarray

    def dense(self) -> np.ndarray:
        w = np.zeros(BUCKETS, np.float32)
        w[self.buckets] = self.weights
        return w

    def score(self, texts: list[str], dense: np.ndarray) -> np.ndarray:
        np.seterr(over="ignore")
        doc, bucket = features(texts)
        hit = dense[bucket] != 0
        key = np.unique(doc[hit] * BUCKETS + bucket[hit])
        z = self.bias + np.bincount(key // BUCKETS, weights=dense[key % BUCKETS], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(rows: list[tuple[str, int]], epochs: int = EPOCHS, weights: tuple[float, float] = (1.0, 1.0)) -> Model:
    """rows: (text, 0 or 1), in an order that the caller has fixed; weights: for how many rows a zero and a one stand.  Without rows of both labels: the share of ones."""
    np.seterr(over="ignore")
    ones = sum(y for _, y in rows)
    share = (ones + 0.5) / (len(rows) + 1) if rows else 0.0
    if ones in (0, len(rows)):
        return Model(float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))), np.zeros(0, np.int64), np.zeros(0, np.float32))
    sets = []
    for at in range(0, len(rows), 200):
        part = rows[at : at + 200]
        doc, bucket = features([t for t, _ in part])
        key = np.unique(doc * BUCKETS + bucket)
        cut = np.searchsorted(key, np.arange(len(part) + 1) * BUCKETS)
        sets += [(key[i:j] % BUCKETS).astype(np.int32) for i, j in zip(cut[:-1], cut[1:], strict=True)]
    z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)
    bz, bn = 0.0, 0.0
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            x, y = sets[i], rows[i][1]
            zx, nx = z[x], n[x]
            w = np.where(np.abs(zx) <= L1, 0.0, -(zx - np.sign(zx) * L1) / ((BETA + np.sqrt(nx)) / ALPHA + L2))
            bias = -bz / ((BETA + np.sqrt(bn)) / ALPHA)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -30, 30))) - y
            g *= weights[y]
            sigma = (np.sqrt(nx + g * g) - np.sqrt(nx)) / ALPHA
            z[x] += g - sigma * w
            n[x] += g * g
            bz += g - (np.sqrt(bn + g * g) - np.sqrt(bn)) / ALPHA * bias
            bn += g * g
    w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    at = np.nonzero(w)[0]
    return Model(float(-bz / ((BETA + np.sqrt(bn)) / ALPHA)), at, w[at].astype(np.float32))


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> tuple[list[tuple[str, int]], tuple[float, float]]:
    """Texts and labels of a bounded sample of labelled rows outside the held-out fold, in a fixed order, and the
    weights of zeros and of ones that undo their thinning; the label thinned less weighs 1."""
    known = labels.where(F.col(label).isin(0, 1) & (fold(F.col("doc_id")) != 0)).select("doc_id", F.col(label).cast("int").alias("y")).distinct()
    counts = {r["y"]: r["c"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("c")).collect()}  # two rows
    shares = tuple(min(1.0, SAMPLE_PER_LABEL / max(1, counts.get(y, 0))) for y in (0, 1))
    share = F.create_map(*[F.lit(x) for y in (0, 1) for x in (y, shares[y])])
    unit = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.where(unit < share[F.col("y")])  # about 2 * SAMPLE_PER_LABEL ids
    got = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text", "y")
    rows, size = [], 0
    for r in got.where(F.coalesce(F.length("text"), F.lit(0)) <= SAMPLE_CHARS // 4).toLocalIterator():
        if size + len(r["text"] or "") <= SAMPLE_CHARS:  # driver memory is bounded; a text too long is passed over
            size += len(r["text"] or "")
            rows.append((r["text"] or "", r["y"]))
    return rows, (max(shares) / shares[0], max(shares) / shares[1])


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row; a null text is an empty one and gets the bias alone."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        dense = m.dense()
        for batch, texts in pieces(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(m.score(texts, dense), pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id bigint, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    Null and empty texts get the score of a text without features; rows that repeat an id or a text are scored alike;
    labels other than 0 and 1 (null too) teach nothing; without labels of both kinds the score is the share of ones.
    Empty docs give no rows, and other columns are ignored.
    """
    rows, weights = training_rows(docs, labels)
    scored = score_documents(docs, train(rows, weights=weights))
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labels outside the held-out fold."""
    return classify(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))

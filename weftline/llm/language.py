"""Language of every word by a linear-chain conditional random field, and from that of every text.

Words carry affix, character n-gram and lexicon (whole word) features; transitions between languages are learnt from
training sequences that switch language between spans.  Forward-backward gives each word's posterior, and a text's
language is the one with the largest sum of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import chars, mix, number, pieces
from .common import table
from .toxicity import fold

BUCKETS = 1 << 17
#: Documents to learn from, at most about so many per language (a hash of the id picks them), and words of them in all.
SAMPLE_PER_LANGUAGE, SAMPLE_WORDS = 300, 400_000
#: Words of one language in a row, and such spans in a training sequence.
SPAN, SPANS = 25, 4
ROUNDS, RATE, L2 = 30, 0.3, 1e-4
UNKNOWN = "und"
PIECE = 8_000_000

_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def letters_of(distinct: list[str]) -> list[str]:
    """Each word in lower case with nothing but letters and marks, empty if it has no letter."""
    return [x if _LETTER.search(x) else "" for x in (_NOT_LETTERS.sub("", w).lower() for w in distinct)]


def word_features(distinct: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: buckets of 7 whole-word features (word, prefixes and suffixes of 1 to 3), and buckets of all its
    n-grams (2 and 3, with word ends) with their offsets."""
    flat, off = chars(["\x02" + w + "\x03" for w in distinct])
    c = flat.astype(np.uint64)
    n = np.diff(off)
    first, last = off[:-1], off[1:] - 1
    one = mix(c + np.uint64(0x9E3779B97F4A7C15))
    two = mix(one[:-1] * np.uint64(3) + one[1:])
    three = mix(two[:-1] * np.uint64(5) + one[2:])
    place = np.arange(len(c)) - np.repeat(first, n)
    whole = np.concatenate([[np.uint64(0)], np.cumsum(mix(one + (place.astype(np.uint64) << np.uint64(32))), dtype=np.uint64)])
    at = lambda x, i: x[np.minimum(i, len(x) - 1)]
    short = n - 2
    fixed = [mix((whole[off[1:]] - whole[off[:-1]]) ^ np.uint64(11))]
    for k, x in ((1, one), (2, two), (3, three)):
        fits = short >= k
        fixed.append(mix(np.where(fits, at(x, first + 1), 0).astype(np.uint64) ^ np.uint64(20 + k)))
        fixed.append(mix(np.where(fits, at(x, np.maximum(last - k, 0)), 0).astype(np.uint64) ^ np.uint64(30 + k)))
    grams = np.zeros((len(c), 2), np.uint64)
    grams[:-1, 0] = mix(two ^ np.uint64(2))
    grams[:-2, 1] = mix(three ^ np.uint64(3))
    inside = np.ones((len(c), 2), bool)  # no n-gram across two words
    inside[last, 0] = False
    inside[last, 1] = inside[last - 1, 1] = False
    count = np.add.reduceat(inside.sum(1), first) if len(first) else np.zeros(0, np.int64)
    return np.stack([(f % np.uint64(BUCKETS)).astype(np.int64) for f in fixed], 1), (grams[inside] % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([[0], np.cumsum(count)]).astype(np.int64)


def emissions(weights: np.ndarray, feats: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Score of each label for each distinct word: whole-word features and the mean of its n-grams' weights."""
    fixed, grams, off = feats
    e = np.zeros((len(fixed), weights.shape[1]), weights.dtype)
    for j in range(fixed.shape[1]):
        e += weights[fixed[:, j]]
    if len(grams):
        e += np.add.reduceat(weights[grams], off[:-1], axis=0) / np.diff(off)[:, None] * 2
    return e


def forward_backward(e: np.ndarray, lengths: np.ndarray, start: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Posteriors of sequences laid out by time: e holds, for t = 0, 1, ..., the scores of all sequences longer than t,
    longest sequence first.  Also the expected counts of transitions."""
    most = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(most), side="left")  # sequences longer than t
    at = np.concatenate([[0], np.cumsum(active)])
    p = np.exp(e - e.max(1, keepdims=True))
    a = np.empty_like(p)
    A, At = np.exp(trans), np.ascontiguousarray(np.exp(trans).T)
    x = np.exp(start) * p[: active[0]] if most else p[:0]
    for t in range(most):
        if t:
            x = (x[: active[t]] @ A) * p[at[t] : at[t + 1]]
        x /= x.sum(1, keepdims=True)
        a[at[t] : at[t + 1]] = x
    expected = np.zeros_like(A)
    b = np.ones((0, p.shape[1]), p.dtype)
    for t in range(most - 1, -1, -1):
        here = a[at[t] : at[t + 1]]
        beta = np.ones_like(here)
        if len(b):
            after = b * p[at[t + 1] : at[t + 2]]
            beta[: len(b)] = after @ At
            both = here[: len(b)] * beta[: len(b)]
            expected += A * ((here[: len(b)] / both.sum(1, keepdims=True)).T @ after)
        here *= beta
        here /= here.sum(1, keepdims=True)
        b = beta / beta.sum(1, keepdims=True)
    return a, expected


def by_time(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of the sequences (longest first), their lengths, and for each slot by time its place in codes and its sequence."""
    n = np.diff(offsets)
    order = np.argsort(-n, kind="stable")
    lengths = n[order]
    t = np.arange(len(codes)) - np.repeat(offsets[:-1], n)
    rank = np.empty(len(n), np.int64)
    rank[order] = np.arange(len(n))
    slot = np.lexsort((np.repeat(rank, n), t))
    return order, lengths, slot, np.repeat(np.arange(len(n)), n)[slot]


@dataclass
class Tagger:
    labels: list[str]
    weights: np.ndarray
    start: np.ndarray
    trans: np.ndarray

    def posteriors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the words' posteriors for each text and label, and the number of words with a letter."""
        np.seterr(over="ignore")
        codes, distinct, off = number(texts)
        clean = letters_of(distinct)
        ok = np.array([bool(w) for w in clean], bool)
        keep = ok[codes] if len(codes) else np.zeros(0, bool)
        counts = np.concatenate([[0], np.cumsum(keep)])
        off = counts[off]
        codes = codes[keep]
        total = np.zeros((len(texts), len(self.labels)))
        if len(codes):
            index = np.cumsum(ok) - 1
            e = emissions(self.weights, word_features([w for w in clean if w]))
            _, lengths, slot, who = by_time(codes, off)
            p, _ = forward_backward(e[index[codes[slot]]].astype(np.float64), lengths[lengths > 0], self.start, self.trans)
            for j in range(len(self.labels)):
                total[:, j] = np.bincount(who, weights=p[:, j], minlength=len(texts))
        return total, np.diff(off)


def train(rows: list[tuple[str, str]], rounds: int = ROUNDS) -> Tagger:
    """rows: (text, language) in a fixed order.  Spans of the texts are dealt at random into sequences that switch."""
    np.seterr(over="ignore")
    labels = sorted({y for _, y in rows})
    k = len(labels)
    start, trans = np.zeros(k), np.zeros((k, k))
    weights = np.zeros((BUCKETS, max(k, 1)), np.float32)
    codes, distinct, off = number([t for t, _ in rows])
    clean = letters_of(distinct)
    ok = np.array([bool(w) for w in clean], bool)
    spans = []
    for i, (_, y) in enumerate(rows):
        own = codes[off[i] : off[i + 1]]
        own = own[ok[own]] if len(own) else own
        spans += [(own[j : j + SPAN], labels.index(y)) for j in range(0, len(own), SPAN)]
    if k < 2 or not spans:
        return Tagger(labels, weights, start, trans)
    rng = np.random.default_rng(11)
    rng.shuffle(order := np.arange(len(spans)))
    parts, size = [spans[i] for i in order], 0
    for i, (s, _) in enumerate(parts):
        size += len(s)
        if size > SAMPLE_WORDS:
            parts = parts[:i]
            break
    index = np.cumsum(ok) - 1
    words = index[np.concatenate([s for s, _ in parts])]
    gold = np.concatenate([np.full(len(s), y) for s, y in parts])
    ends = np.cumsum([len(s) for s, _ in parts])
    seq = np.concatenate([[0], ends[SPANS - 1 :: SPANS], [] if len(parts) % SPANS == 0 else [ends[-1]]]).astype(np.int64)
    _, lengths, slot, _ = by_time(words, seq)
    words_t, gold_t = words[slot], gold[slot]
    firsts = gold[seq[:-1]]
    inner = np.setdiff1d(np.arange(1, len(gold)), seq)
    seen = np.zeros((k, k))
    np.add.at(seen, (gold[inner - 1], gold[inner]), 1)
    feats = word_features([w for w in clean if w])
    fixed, grams, goff = feats
    g2, gt, gs = np.full_like(weights, 1e-6), np.full((k, k), 1e-6), np.full(k, 1e-6)
    truth = np.eye(k)[gold_t]
    scale = 1000.0 / len(gold)
    for _ in range(rounds):
        p, expected = forward_backward(emissions(weights, feats)[words_t].astype(np.float64), lengths, start, trans)
        diff = truth - p
        per_word = np.stack([np.bincount(words_t, weights=diff[:, j], minlength=len(fixed)) for j in range(k)], 1) * scale
        shared = np.repeat(per_word / np.diff(goff)[:, None] * 2, np.diff(goff), axis=0)
        grad = np.empty_like(weights)
        for j in range(k):
            grad[:, j] = np.bincount(grams, weights=shared[:, j], minlength=BUCKETS) + sum(np.bincount(fixed[:, f], weights=per_word[:, j], minlength=BUCKETS) for f in range(fixed.shape[1]))
        grad -= L2 * weights
        g2 += grad * grad
        weights += RATE * grad / np.sqrt(g2)
        d = (seen - expected) * scale
        gt += d * d
        trans = trans + RATE * d / np.sqrt(gt)
        d = (np.bincount(firsts, minlength=k) - p[: int(np.sum(lengths > 0))].sum(0)) * scale
        gs += d * d
        start = start + RATE * d / np.sqrt(gs)
    return Tagger(labels, weights, start, trans)


def training_rows(docs: DataFrame) -> list[tuple[str, str]]:
    """Texts and languages of a bounded sample outside the held-out fold, in a fixed order.

    A text of over a quarter of the sample's characters, or one that no longer fits, isn't learnt from; others are.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != 0))
    counts = {r["lang"]: r["c"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("c")).collect()}  # one row a language
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for y, c in sorted(counts.items()) for x in (y, min(1.0, SAMPLE_PER_LANGUAGE / c))])
    unit = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.where(unit < share[F.col("lang")]).select("text", "lang", F.xxhash64("doc_id", "text").alias("h")).orderBy("h", "lang", "text")
    rows, size = [], 0
    room = 20 * SAMPLE_WORDS  # driver memory is bounded whatever the texts' lengths; one too long is passed over
    for r in chosen.where(F.length("text") <= room // 4).toLocalIterator():
        if size + len(r["text"]) <= room:
            size += len(r["text"])
            rows.append((r["text"], r["lang"]))
    return rows


def tag_documents(docs: DataFrame, model: Tagger) -> DataFrame:
    """doc_id, lang_pred, score, n_labelled for every row of docs; only the text is looked at."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        names = np.array([*m.labels, UNKNOWN], object)
        for batch, texts in pieces(batches, chars=PIECE):
            if m.labels:
                total, n = m.posteriors(texts)
                best = np.where(n > 0, total.argmax(1), len(m.labels))
                score = np.clip(total.max(1) / np.maximum(n, 1), 0, 1)
            else:
                best, score, n = np.zeros(len(texts), int), np.zeros(len(texts)), np.zeros(len(texts), int)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names[best], pa.string()), pa.array(score, pa.float64()), pa.array(n, pa.int64())],
                names=["doc_id", "lang_pred", "score", "n_labelled"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double, n_labelled bigint")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_labelled for every row of docs.

    A null text and one without letters are `und` with score 0.  A text is labelled from all its words, however long.
    Ties go to the language that sorts first.  Without any labelled row everything is `und`; an empty table gives no
    rows; repeated rows get equal results; other columns are ignored.
    """
    tagged = tag_documents(docs, train(training_rows(docs)))
    return tagged.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score", "n_labelled")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those outside the held-out fold."""
    return identify(table(spark, sf_dir, "documents", "doc_id", "text", "lang")).drop("n_labelled")

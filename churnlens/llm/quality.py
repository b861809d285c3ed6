"""Quality classifier by importance resampling.

The target text is what the labels call good and not toxic; the raw text is a
mixture of target, low-quality and toxic text.  Each is a generative model of
the hashed n-grams that a document holds: words, word pairs, and runs of one
word (three, and seven).  Frequencies are smoothed towards those of all
labelled text, and only n-grams whose count in some class lies ``z`` standard
errors from expectation tell classes apart.  A document's importance weight is
p(text | target) / p(text | raw); documents are drawn without replacement in
proportion to weight ** (1 / temperature) by Gumbel top-k.  k is the number of
documents whose weight reaches a cut.  ``z`` and the cut are those that tell
the classes apart best when each half of the labelled documents is scored by
the model of the other half.

The models are fitted on at most ``max_labels`` labelled documents (a
documented bound: those with the smallest hash of their id), equal texts once;
every document is scored.

Defined results: a null text counts as empty, and a text without n-grams has
weight 1 (log 0); labels that are null or name no document are unused, several
labels of one id count as the worst; without labels everything is kept; rows
without an id are scored alike; ties at the cut are settled by id, so repeated
rows stay or go together; an empty table gives an empty table; other columns
are passed on by ``keep`` unread.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import PAYLOAD, joined, key_kind, payloads, row_key, same_row, slices, stored, summed, words

BITS, CHUNKS = 20, 32
BUCKETS = 1 << BITS
TARGET, LOW, TOXIC = range(3)
#: Text read at a time: a step needs some thirty times its bytes, and an idle worker keeps what it has needed.
STEP_BYTES = 1 << 20
#: Standard errors that are tried, and pseudo-documents that draw a frequency to the common one.
Z, PRIOR = (3.0, 4.0, 6.0, 8.0), 2.0


def _hashes(known: list[str]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(w) for w in known), np.uint64, len(known))


def features(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and document of every distinct n-gram of each text; ``wanted``: the buckets that matter."""
    codes, n, known = words(texts)
    h = _hashes(known)[codes] if len(codes) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(n)), n)
    pair = owner[1:] == owner[:-1]
    two = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
    two = (two ^ (two >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    same = np.concatenate([[0], np.cumsum(pair & (codes[1:] == codes[:-1]))])
    found, own = [h, two[pair]], [owner, owner[1:][pair]]
    for run in (3, 7):
        at = np.flatnonzero(same[run - 1 :] - same[: max(0, len(same) - run + 1)] == run - 1)
        found.append(np.full(len(at), _hashes([f"run {run}"])[0]))
        own.append(owner[at] if len(codes) else at[:0])
    bucket = (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)
    owner = np.concatenate(own)
    if wanted is not None:
        matter = wanted[bucket]
        bucket, owner = bucket[matter], owner[matter]
    both = np.unique((owner << BITS) | bucket)
    return both & (BUCKETS - 1), both >> BITS


def label_sample(labels: DataFrame, max_labels: int = 20_000) -> dict[int, int]:
    """Class by document id, of at most ``max_labels`` documents."""
    one = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
    rows = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels).collect()
    return {r["doc_id"]: TOXIC if r["t"] else TARGET if r["q"] else LOW for r in rows}


class Model:
    """Log frequency ratios of the buckets that tell the classes apart, and the classes' shares."""

    def __init__(self, n: np.ndarray, docs: np.ndarray, z: float):
        expected = docs[:, None] * (n.sum(axis=0) / max(docs.sum(), 1))
        apart = np.abs(n - expected) >= z * np.sqrt(expected + 0.5)
        self.bucket = np.flatnonzero(apart.any(axis=0))
        n, expected = n[:, self.bucket], expected[:, self.bucket]
        self.ratio = np.where(apart[:, self.bucket], np.log((n + PRIOR) / (expected + PRIOR)), 0.0)
        self.share = (docs + 1.0) / (docs + 1.0).sum()
        self.cut = -math.inf

    def log_weights(self, texts: pa.Array) -> np.ndarray:
        """Log importance weight of each text."""
        wanted = np.zeros(BUCKETS, bool)
        wanted[self.bucket] = True
        place = np.zeros(BUCKETS, np.int64)
        place[self.bucket] = np.arange(len(self.bucket))
        bucket, owner = features(texts, wanted)
        each = np.stack([np.bincount(owner, self.ratio[k][place[bucket]], minlength=len(texts)) for k in range(3)])
        mixed = each + np.log(self.share)[:, None]
        top = mixed.max(axis=0)
        return each[TARGET] - top - np.log(np.exp(mixed - top).sum(axis=0))


def _best_cut(weight: np.ndarray, kind: np.ndarray) -> tuple[float, float]:
    """Worth of the best cut, and the cut: kept target counts double, then rejected low and toxic."""
    if not (kind == TARGET).any() or not (kind != TARGET).any():
        return -1.0, -math.inf
    tries = np.unique(np.concatenate([weight[kind == TARGET], [weight.min() - 1]]))
    tries = tries[:: max(1, len(tries) // 500)]
    kept = lambda k: 1 - np.searchsorted(np.sort(weight[kind == k]), tries) / max(1, (kind == k).sum())
    worth = 2 * kept(TARGET) - kept(LOW) - kept(TOXIC)
    return float(worth.max()), float(tries[worth.argmax()])


def fit(docs: DataFrame, labels: DataFrame, max_labels: int = 20_000) -> Model:
    spark = docs.sparkSession
    classes = label_sample(labels, max_labels)
    if not classes:
        return Model(np.zeros((3, BUCKETS)), np.zeros(3), 1.0)
    known = F.broadcast(spark.createDataFrame(list(classes.items()), "label_id long, kind int"))  # at most max_labels rows
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sample = docs.select(F.col("doc_id").cast("long").alias("label_id"), text.alias("text")).join(known, "label_id").select("kind", "text").distinct()
    sample = stored(sample.withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int")), "quality-sample")

    def count(batches):
        total, docs = np.zeros((6, BUCKETS), np.int64), np.zeros(6, np.int64)
        for b in slices(batches, "text", STEP_BYTES):
            bucket, owner = features(b.column("text"))
            kind = b.column("kind").to_numpy() + 3 * b.column("half").to_numpy()
            docs += np.bincount(kind, minlength=6)
            for k in range(6):
                total[k] += np.bincount(bucket[kind[owner] == k], minlength=BUCKETS)
        for k in range(6):
            yield from payloads(k, total[k], CHUNKS)
        yield from payloads(6, docs, 1)

    sums = summed(sample.mapInArrow(count, PAYLOAD), CHUNKS)
    n = np.stack([joined(sums, k, BUCKETS, CHUNKS) for k in range(6)]).astype(np.float32)
    own = joined(sums, 6, 6, 1).astype(np.float64)
    halves = [[Model(n[3 * half : 3 * half + 3], own[3 * half : 3 * half + 3], z) for half in (0, 1)] for z in Z]
    sent = spark.sparkContext.broadcast(halves)

    def other(batches):
        for b in slices(batches, "text", STEP_BYTES):
            half = b.column("half").to_numpy()
            weight = []
            for models in sent.value:
                w = np.empty(b.num_rows)
                for h in (0, 1):
                    if (half == h).any():
                        w[half == h] = models[1 - h].log_weights(b.column("text").filter(pa.array(half == h)))
                weight.append(w)
            yield pa.RecordBatch.from_arrays([b.column("kind"), pa.array(np.stack(weight, axis=1).tolist(), pa.list_(pa.float64()))], ["kind", "weights"])

    rows = sample.mapInArrow(other, "kind int, weights array<double>").collect()  # at most max_labels rows
    kind, weight = np.array([r["kind"] for r in rows], np.int64), np.array([r["weights"] for r in rows])
    tried = [_best_cut(weight[:, i], kind) for i in range(len(Z))] if rows else [(0.0, -math.inf)]
    best = max(range(len(tried)), key=lambda i: tried[i][0])
    model = Model(n[:3] + n[3:], own[:3] + own[3:], Z[best])
    model.cut = tried[best][1]
    return model


def score(docs: DataFrame, model: Model, temperature: float = 0.1, seed: int = 7) -> DataFrame:
    """``(doc_id, sign, log_weight, draw)``: ``draw`` is log weight / temperature plus Gumbel noise of the id.

    ``sign`` is a hash of the text: it tells apart documents that share an id.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in slices(batches, "text", STEP_BYTES):
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(sent.value.log_weights(b.column("text")))], ["id", "log_weight"])

    rows = docs.select(row_key("doc_id", "text").alias("id"), F.col("text").cast("string").alias("text")).mapInArrow(run, f"id {key_kind(docs, 'doc_id')}, log_weight double")
    uniform = (F.pmod(F.xxhash64("id.id", F.lit(seed)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return rows.select(F.col("id.id").alias("doc_id"), F.col("id.sign").alias("sign"), "log_weight", (F.col("log_weight") / F.lit(temperature) - F.log(-F.log(uniform))).alias("draw"))


def top_k_cut(scored: DataFrame, k: int, bins: int = 4096, last: int = 20_000) -> tuple[float, int | None] | None:
    """``(draw, doc_id)`` of the k-th row by ``draw`` downwards, then id; None if there are no more than k rows.

    Histograms narrow the range that holds the k-th row until at most ``last``
    rows or one value remain, so the driver sees only bin counts and those rows.
    """
    low, high, n = scored.agg(F.min("draw"), F.max("draw"), F.count("*")).first()
    if n <= k:
        return None
    left = k
    inside = scored.select("draw", "doc_id")
    while n > last and high > low:
        width = (high - low) / bins
        bin_of = F.least(F.floor((F.col("draw") - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
        counts = {r["b"]: (r["n"], r["low"], r["high"]) for r in inside.groupBy(bin_of.alias("b")).agg(F.count("*").alias("n"), F.min("draw").alias("low"), F.max("draw").alias("high")).collect()}
        for b in sorted(counts, reverse=True):
            n, low, high = counts[b]
            if n >= left:
                break
            left -= n
        inside = scored.select("draw", "doc_id").where(F.col("draw").between(low, high))
    row = inside.orderBy(F.desc("draw"), F.asc_nulls_first("doc_id")).limit(left).orderBy("draw", F.desc_nulls_last("doc_id")).limit(1).first() if n <= last else None
    if row is None:  # one value holds very many rows: the id settles it by its own order
        row = inside.orderBy(F.asc_nulls_first("doc_id")).offset(left - 1).limit(1).first()
    return row["draw"], row["doc_id"]


def importance_sample(docs: DataFrame, labels: DataFrame, max_labels: int = 20_000, temperature: float = 0.1, seed: int = 7) -> DataFrame:
    """``(doc_id, log_weight, draw)`` of the sampled documents."""
    model = fit(docs, labels, max_labels)
    scored = stored(score(docs, model, temperature, seed), "quality-scores")
    k = scored.where(F.col("log_weight") >= F.lit(model.cut)).count()
    if not k:
        return scored.limit(0)
    cut = top_k_cut(scored, k)
    if cut is None:
        return scored
    draw, doc = cut
    tie = F.lit(False) if doc is None else F.coalesce(F.col("doc_id") <= F.lit(doc), F.lit(True))
    return scored.where((F.col("draw") > F.lit(draw)) | ((F.col("draw") == F.lit(draw)) & (F.col("doc_id").isNull() | tie)))


def keep(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """The sampled documents with all their columns; a document is kept by its own text, whatever its id."""
    kept = importance_sample(docs, labels, **parameters).select(F.col("doc_id").alias("kept id"), F.col("sign").alias("kept sign")).distinct()
    return docs.join(kept, same_row("doc_id", "text", F.col("`kept id`"), F.col("`kept sign`")), "left_semi")

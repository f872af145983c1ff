"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

An n-gram of the characters (code points) of the lower-cased text is hashed to one of 2**20 buckets.
Document frequencies of the buckets in toxic and other documents give the
log-count ratio r of each; the most telling buckets become features, present
ones with value r. A logistic regression on them is the classifier, so a
document's logit is a sum over the different features it holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import held_out, staged, text_of
from twinledger.llm.learn import label_sample, labelled

SAMPLE = 8_000
THRESHOLD = 0.3
GRAMS = (4, 5, 6, 8)
BUCKET_BITS = 20
FEATURES = 16_384
LEAST_DOCUMENTS = 3
SMOOTHING = 1.0
RIDGE = 1e-3
STEPS = 150
#: Entries of the training matrix in work at once.
ENTRIES = 1 << 20
BLOCK = 1 << 20


def buckets(text: str) -> Iterator[np.ndarray]:
    """The buckets of all n-grams of a text between two spaces, in blocks that overlap by the longest n-gram.

    Upper and lower case are one in every script; control white space counts as a space.
    """
    lowered = f" {text.lower()} "
    for at in range(0, len(lowered), BLOCK):
        part = np.frombuffer(lowered[at: at + BLOCK + GRAMS[-1] - 1].encode("utf-32-le", "surrogatepass"), "<u4")
        part = np.where((part >= 9) & (part <= 13), np.uint32(32), part)
        h = np.zeros(len(part), np.uint32)
        for n in range(1, GRAMS[-1] + 1):
            if n > len(part):
                break
            h = h[: len(part) - n + 1] * np.uint32(0x01000193) + part[n - 1:] + np.uint32(1)
            if n in GRAMS:
                mixed = h ^ (h >> np.uint32(15))
                yield (mixed * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(32 - BUCKET_BITS)


def _held(text: str, index: np.ndarray) -> np.ndarray:
    """The different features of a text, in order; index: bucket -> feature or -1."""
    found = []
    for b in buckets(text):
        f = index[b]
        found.append(f[f >= 0])
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int32)


def ratios(rows: DataFrame, features: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and log-count ratios of the ``features`` most telling buckets of (doc_id, label, text)."""
    schema = pa.schema([("bucket", pa.int32()), ("plain", pa.int64()), ("toxic", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, 1 << BUCKET_BITS), np.int64)
        seen = np.zeros(1 << BUCKET_BITS, bool)
        for b in batches:
            for label, text in zip(b.column(1).to_pylist(), b.column(2)):
                for part in buckets(text.as_py()):
                    seen[part] = True
                n[label] += seen
                seen[:] = False
        at = np.flatnonzero(n.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[0, at]), pa.array(n[1, at])], schema=schema)

    counts = rows.mapInArrow(run, "bucket int, plain long, toxic long").groupBy("bucket").agg(F.sum("plain").alias("plain"), F.sum("toxic").alias("toxic"))
    counts = staged(counts, "grams")
    sums = counts.agg(F.coalesce(F.sum("plain"), F.lit(0)).alias("plain"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    size = float(1 << BUCKET_BITS)
    rate = [(F.col(c) + SMOOTHING) / F.lit(sums[c] + SMOOTHING * size) for c in ("toxic", "plain")]
    ratio = F.log(rate[0] / rate[1])
    telling = F.abs(ratio) * F.sqrt(F.least("toxic", F.lit(1e9)) + F.least("plain", F.lit(1e9)))
    best = counts.filter(F.col("plain") + F.col("toxic") >= LEAST_DOCUMENTS).select("bucket", ratio.alias("r"), telling.alias("t"))
    got = best.orderBy(F.desc("t"), "bucket").limit(features).collect()
    return np.array([x.bucket for x in got], np.int64), np.array([x.r for x in got])


def _share(logits: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logits, -60.0, 60.0)))


def fit(col: np.ndarray, ends: np.ndarray, y: np.ndarray, r: np.ndarray) -> tuple[float, np.ndarray]:
    """Intercept and weight of each feature (its ratio times its coefficient).

    ``col`` holds the features of all documents one after the other, ``ends`` where
    each document's end. The matrix is gone through in blocks of documents.
    """
    prior = (y.sum() + 0.5) / (len(y) + 1.0)
    bias, w = float(np.log(prior / (1 - prior))), np.zeros(len(r))
    if len(y) == 0 or y.min() == y.max() or not len(r):
        return bias, w
    starts = np.concatenate(([0], ends[:-1]))
    cuts = [0, *np.unique(np.searchsorted(ends, np.arange(ENTRIES, ends[-1] + ENTRIES, ENTRIES), "left") + 1).clip(max=len(y)).tolist(), len(y)]
    blocks = [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]
    first, second = np.zeros(len(r) + 1), np.zeros(len(r) + 1)  # Adam; the last entry is the intercept
    for t in range(1, STEPS + 1):
        g, weight = np.zeros(len(r) + 1), w * r
        for a, b in blocks:
            own = col[starts[a]: ends[b - 1]]
            row = np.repeat(np.arange(b - a), ends[a:b] - starts[a:b])
            d = (_share(bias + np.bincount(row, weight[own], b - a)) - y[a:b]) / len(y)
            g[:-1] += np.bincount(own, d[row], len(r))
            g[-1] += d.sum()
        g[:-1] = g[:-1] * r + RIDGE * w
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        step = 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-9) * min(1.0, 2 * (1 - t / (STEPS + 1)))
        w, bias = w - step[:-1], bias - float(step[-1])
    return bias, w * r


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, features: int = FEATURES, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The model from at most ``most`` labelled rows that are not held out; features of these rows reach the driver."""
    rows = staged(labelled(docs, label_sample(docs, labels, label_col, most, id_col), id_col, text_col), "labelled")
    telling, r = ratios(rows, features)
    index = np.full(1 << BUCKET_BITS, -1, np.int32)
    index[telling] = np.arange(len(telling))
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("held", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = pa.array([_held(t.as_py(), index) for t in b.column(2)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), held], schema=schema)

    got = rows.mapInArrow(run, "doc_id long, label int, held array<int>").orderBy(F.xxhash64("doc_id"), "doc_id", "label", "held").limit(most).toArrow()
    held = got.column("held").combine_chunks()
    ends = np.cumsum(held.value_lengths().to_numpy()) if got.num_rows else np.zeros(0, np.int64)
    bias, w = fit(held.flatten().to_numpy(), ends, got.column("label").to_numpy().astype(np.float64), r)
    return {"bias": bias, "buckets": telling, "weights": w}


def scorer(model: dict):
    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = np.full(1 << BUCKET_BITS, -1, np.int32)
        index[model["buckets"]] = np.arange(len(model["buckets"]))
        for part in texts:
            logits = np.array([model["bias"] + model["weights"][_held(t.as_py(), index)].sum() for t in part])
            yield pa.array(_share(logits), pa.float64())

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: doc_id, held_out, score (0 to 1), predicted (1 from ``threshold`` on).

    A null text is empty; a text shorter than an n-gram has the score of the
    intercept; equal texts have equal scores. Labels of held-out rows are never
    read. Without usable labels every score is 0.5. An empty table gives no rows; other
    columns are not read.
    """
    score = scorer(train(docs, labels, most, FEATURES, "toxic", id_col, text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), score(text_of(text_col)).alias("score"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

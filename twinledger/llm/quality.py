"""Quality classifier: a generalised additive model with pairwise interactions.

Boosting goes round the features in turn; each turn fits a shallow tree to the
gradient over one feature's bins and adds it to that feature's lookup table.
Then the pairs with the largest gain on what is left get tables of their own in
the same way. A score is the sum of one entry a table, by bins.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import held_out, text_of
from twinledger.llm.learn import label_sample, labelled

SAMPLE = 20_000
THRESHOLD = 0.7
BINS = 48
PAIR_BINS = 12
ROUNDS = 120
PAIR_ROUNDS = 40
PAIRS = 6
RATE = 0.15
RIDGE = 1.0

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_SPACE = b" \t\n\r\x0b\x0c"
_STOPS = b".,;:?!'\"()-"
_ODD = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in _STOPS)

FEATURES = (
    "bytes", "words", "word_length", "longest_word", "upper", "digits", "stops", "odd", "space", "beyond_ascii", "exclaimed",
    "bars", "distinct_words", "top_word", "repeated_bigrams", "lines", "line_length", "distinct_lines", "top_line", "capitalised", "ended",
)


def features(text: str) -> list[float]:
    """Numbers from the text alone, the same for equal texts; all 0 for an empty one."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, k = len(data), len(words)

    def share(chars: bytes) -> float:
        return (n - len(data.translate(None, chars))) / n

    counts = Counter(words)
    pairs = set(zip(words, words[1:]))
    lines = [x for x in data.split(b"\n") if x.strip()]
    by_line = Counter(lines)
    return [
        np.log1p(n), np.log1p(k), n / k, np.log1p(max(map(len, words))), share(_UPPER), share(_DIGIT), share(_STOPS), share(_ODD), share(_SPACE),
        1 - len(data.translate(None, bytes(range(128, 256)))) / n, data.count(b"!") / k, data.count(b"|") / k,
        len(counts) / k, max(counts.values()) / k, 1 - len(pairs) / max(1, k - 1) if k > 1 else 0.0,
        np.log1p(len(lines)), np.log1p(n / len(lines)), len(by_line) / len(lines), max(by_line.values()) / len(lines),
        sum(w[:1].isupper() for w in words) / k, sum(w[-1:] in (b".", b"?", b"!") for w in words) / k,
    ]


def _tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Leaf values over ordered bins of a tree of the given depth; g, h are sums by bin."""
    out = np.full(len(g), -g.sum() / (h.sum() + RIDGE))
    if depth == 0 or len(g) < 2:
        return out
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE)
    gain[(hl < 0.5) | (hr < 0.5)] = -1.0
    at = int(gain.argmax()) + 1
    if gain[at - 1] <= g.sum() ** 2 / (h.sum() + RIDGE) + 1e-9:
        return out
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """One cut on the first axis, then one on the second in each half; leaf values and gain."""
    best, values = -1.0, np.full(g.shape, -g.sum() / (h.sum() + RIDGE))
    for cut in range(1, g.shape[0]):
        halves, gain = [], 0.0
        for part in (slice(None, cut), slice(cut, None)):
            v = _tree(g[part].sum(0), h[part].sum(0), 1)
            gain += float((-2 * g[part].sum(0) * v - (h[part].sum(0)) * v**2).sum())
            halves.append(np.broadcast_to(v, g[part].shape))
        if gain > best:
            best, values = gain, np.concatenate(halves)
    return values, best


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """Lookup tables from features (rows, features) and labels 0/1; no row or one class gives a constant score."""
    prior = (y.sum() + 0.5) / (len(y) + 1.0)
    model: dict = {"intercept": float(np.log(prior / (1 - prior))), "edges": [], "tables": [], "pairs": []}
    if len(y) == 0 or y.min() == y.max():
        return model
    edges = [_edges(x[:, j], BINS) for j in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    f = np.full(len(y), model["intercept"])

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-f))
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for j, b in enumerate(bins):
            g, h = slopes()
            step = RATE * _tree(np.bincount(b, g, len(tables[j])), np.bincount(b, h, len(tables[j])), 2)
            tables[j] += step
            f += step[b]
    coarse = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    cells = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse)]
    g, h = slopes()

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        return np.bincount(cells[i] * shape[1] + cells[j], v, shape[0] * shape[1]).reshape(shape)

    gains = sorted(((_pair_tree(grid(i, j, g), grid(i, j, h))[1], i, j) for i, j in combinations(range(x.shape[1]), 2)), reverse=True)
    chosen = [(i, j) for _, i, j in gains[:PAIRS]]
    tables2 = [np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for i, j in chosen]
    for _ in range(PAIR_ROUNDS):
        for t, (i, j) in zip(tables2, chosen):
            g, h = slopes()
            step = RATE * _pair_tree(grid(i, j, g), grid(i, j, h))[0]
            t += step
            f += step[cells[i], cells[j]]
    model |= {"edges": edges, "tables": tables, "pairs": [(i, j, coarse[i], coarse[j], t) for t, (i, j) in zip(tables2, chosen)]}
    return model


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    f = np.full(len(x), model["intercept"])
    for j, (e, t) in enumerate(zip(model["edges"], model["tables"])):
        f += t[np.searchsorted(e, x[:, j], "right")]
    for i, j, ei, ej, t in model["pairs"]:
        f += t[np.searchsorted(ei, x[:, i], "right"), np.searchsorted(ej, x[:, j], "right")]
    return 1 / (1 + np.exp(-f))


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The model from at most ``most`` labelled rows that are not held out; only their numbers reach the driver."""
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("x", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array([features(t.as_py()) for t in b.column(2)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), x], schema=schema)

    rows = labelled(docs, label_sample(docs, labels, label_col, most, id_col), id_col, text_col).mapInArrow(run, "doc_id long, label int, x array<double>")
    got = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "label", "x").limit(most).collect()
    return fit(np.array([r.x for r in got]).reshape(len(got), len(FEATURES)), np.array([r.label for r in got], np.float64))


def scorer(model: dict):
    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in texts:
            x = np.array([features(t.as_py()) for t in part]).reshape(len(part), len(FEATURES))
            yield pa.array(predict(model, x))

    return score


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: doc_id, held_out, score (0 to 1), predicted (1 from ``threshold`` on).

    A null text is empty; equal texts have equal scores. Labels of held-out
    rows are never read. Without usable labels every score is 0.5. An empty table
    gives no rows; other columns are not read.
    """
    score = scorer(train(docs, labels, most, "quality", id_col, text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), score(text_of(text_col)).alias("score"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns."""
    score: Column = scorer(train(docs, labels, most, "quality", id_col, text_col))(text_of(text_col))
    return docs.filter(score >= threshold)

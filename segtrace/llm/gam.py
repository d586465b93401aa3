"""Quality classifier: a generalised additive model with pairwise interactions.

Features of every text are cut into bins; the model is one lookup table per feature plus two-dimensional
tables for a few pairs, learnt by cyclic boosting: in turn, each feature fits a shallow tree over its bins
to the present residuals and adds a small step of it to its table. A score is a sum of table entries,
looked up for whole batches of binned features at once.

The features of all texts are computed by Spark, one row at a time. The tables are learnt from at most
`max_rows` labelled rows (a documented bound, the only one: the tables have some thousand entries, so more rows would
hardly change them): all of them, or those with the smallest hashes of id, label and features. So what the driver
holds is bounded too, and reruns choose alike.

Defined cases: a null or empty text has all-zero features and a score like any other; rows whose label is
null or not 0 or 1 teach nothing; repeated label rows count each; without any labelled row every score
is `no_label_score`; null ids are scored as held out (they have no remainder); other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, own, saved
from .compression import SYMBOLS, repeated_words

FEATURES = (
    "log_words", "word_length", "longest_word", "symbols", "digits", "capitals", "not_ascii", "stops", "distinct", "top_word", "twin_words",
    "symbol_words", "line_words", "dup_lines", "repeats", "ratio", "short_words",
)


def text_features(raw: bytes, packer: zstandard.ZstdCompressor) -> list[float]:
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size, counts = len(raw), Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    share = lambda drop: (size - len(raw.translate(None, drop))) / size
    symbol_words = sum(c for w, c in counts.items() if len(w.translate(None, SYMBOLS)) < len(w))
    twins = sum(map(bytes.__eq__, words[1:], words))
    return [
        math.log1p(n), sum(map(len, words)) / n, math.log1p(max(map(len, counts))), share(SYMBOLS), share(b"0123456789"),
        share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), share(bytes(range(128, 256))), share(b".!?"), len(counts) / n, max(counts.values()) / n, twins / n,
        symbol_words / n, n / len(lines), 1 - len(set(lines)) / len(lines), repeated_words(words, 8) / n,
        len(packer.compress(raw)) / size, sum(c for w, c in counts.items() if len(w) < 3) / n,
    ]


def features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x array<double>) for every row of df."""
    rows = own(df, id=id_col, text=text_col)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            x = [text_features(raw or b"", packer) for raw in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["id", "x"])

    return rows.mapInArrow(measure, f"id {rows.schema['id'].dataType.simpleString()}, x array<double>")


@dataclass
class Model:
    """edges[j]: inner bin edges of feature j; tables[j]: a value per bin; pairs: (i, j, table over coarse bins)."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    intercept: float
    coarse: int = 8
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1).reshape(len(x), -1)

    def coarse_bins(self, bins: np.ndarray, j: int) -> np.ndarray:
        return bins[:, j] * self.coarse // (len(self.edges[j]) + 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        bins, total = self.bins(x), np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[bins[:, j]]
        for i, j, table in self.pairs:
            total += table[self.coarse_bins(bins, i), self.coarse_bins(bins, j)]
        return 1 / (1 + np.exp(-total))


def _tree(grad: np.ndarray, weight: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """A shallow tree over ordered bins: up to `leaves` runs of bins, each with its Newton step."""
    cg, cw = np.append(0, np.cumsum(grad)), np.append(0, np.cumsum(weight))
    value = lambda a, b: (cg[b] - cg[a]) ** 2 / (cw[b] - cw[a] + ridge)
    parts = [(0, len(grad))]
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for a, b in parts:
            if b - a > 1:
                cuts = np.arange(a + 1, b)
                gain = value(a, cuts) + value(cuts, b) - value(a, b)
                if (k := int(gain.argmax())) is not None and gain[k] > best[0]:
                    best = (gain[k], (a, b), int(cuts[k]))
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(grad))
    for a, b in parts:
        out[a:b] = (cg[b] - cg[a]) / (cw[b] - cw[a] + ridge)
    return out


def _tree2(grad: np.ndarray, weight: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Best tree of depth two over a grid: a cut on each axis, four leaves; its gain and its values."""
    cg, cw = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (grad, weight))
    best, out = 0.0, np.zeros_like(grad)
    for r in range(1, len(grad)):
        for c in range(1, len(grad)):
            leaves = []
            for rows in ((0, r), (r, len(grad))):
                for cols in ((0, c), (c, len(grad))):
                    g, w = (x[rows[1], cols[1]] - x[rows[0], cols[1]] - x[rows[1], cols[0]] + x[rows[0], cols[0]] for x in (cg, cw))
                    leaves.append((rows, cols, g, w))
            gain = sum(g * g / (w + ridge) for *_, g, w in leaves)
            if gain > best:
                best, out = gain, np.zeros_like(grad)
                for rows, cols, g, w in leaves:
                    out[rows[0] : rows[1], cols[0] : cols[1]] = g / (w + ridge)
    return best, out


def fit(x: np.ndarray, y: np.ndarray, n_bins: int = 64, rounds: int = 150, rate: float = 0.1, leaves: int = 3, n_pairs: int = 4, pair_rounds: int = 40, ridge: float = 1.0) -> Model:
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, n_bins + 1)[1:-1])) for j in range(x.shape[1])]
    base = min(max(y.mean(), 1e-3), 1 - 1e-3)
    model = Model(edges, [np.zeros(len(e) + 1) for e in edges], math.log(base / (1 - base)))
    bins, total = model.bins(x), np.full(len(y), model.intercept)

    def residual() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            grad, weight = (np.bincount(bins[:, j], v, len(table)) for v in residual())
            step = rate * _tree(grad, weight, leaves, ridge)
            table += step
            total += step[bins[:, j]]
    size = model.coarse
    coarse = [model.coarse_bins(bins, j) for j in range(len(edges))]
    grid = lambda i, j: [np.bincount(coarse[i] * size + coarse[j], v, size * size).reshape(size, size) for v in residual()]
    gains = sorted(((_tree2(*grid(i, j), ridge)[0], i, j) for i in range(len(edges)) for j in range(i)), reverse=True)[:n_pairs]
    model.pairs = [(i, j, np.zeros((size, size))) for _, i, j in gains]
    for _ in range(pair_rounds):
        for i, j, table in model.pairs:
            step = rate * _tree2(*grid(i, j), ridge)[1]
            table += step
            total += step[coarse[i], coarse[j]]
    return model


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fold: int = 5, threshold: float = 0.3, max_rows: int = 100_000, no_label_score: float = 0.5) -> DataFrame:
    """Per row of docs: id, held_out (crc32 of the id as text divisible by fold), score and predicted."""
    known = saved(features(docs, id_col, text_col), "features")
    taught = own(labels, id=id_col, label=label_col).filter(F.col("label").isin(0, 1) & (crc_mod("id", fold) != 0))
    sample = known.join(taught.withColumnRenamed("id", "of"), F.col("id") == F.col("of")).select("id", "x", F.col("label").cast("int").alias("label"))
    sample = saved(sample.withColumn("draw", F.xxhash64("id", "label", "x")), "taught")
    if (n := sample.count()) > max_rows:
        # Few more than max_rows come to the sort; were they ever fewer, it would only get fewer rows.
        some = sample.filter(F.pmod("draw", F.lit(1 << 30)) < int(min(1.0, 1.1 * max_rows / n + 1000 / n) * (1 << 30)))
        sample = some.orderBy("draw", "id", "label").limit(max_rows)
    data = sample.toArrow().to_pandas().sort_values(["id", "label", "draw"], kind="stable")
    model = fit(np.array(data["x"].tolist()), data["label"].to_numpy(float)) if len(data) else None
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(1).flatten()).reshape(len(batch), -1) if len(batch) else np.zeros((0, len(FEATURES)))
            score = shared.value.score(x) if shared.value is not None else np.full(len(batch), no_label_score)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["id", "score"])

    scored = known.mapInArrow(look_up, f"id {known.schema['id'].dataType.simpleString()}, score double")
    held = F.coalesce(crc_mod("id", fold) == 0, F.lit(True))
    return scored.select(F.col("id").alias(id_col), held.alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"))

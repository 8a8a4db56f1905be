"""Document quality by gated-attention multiple-instance learning over passages."""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.arrow import with_columns

PASSAGE_WORDS = 100
# Labelled rows the classifier is fitted on, in the order of a hash of their ids.
TRAIN_ROWS = 6_000
SIGNS = ".,!?$%&*#|-:;\"'()"
SHORT_BUCKETS = 32
N_FEATURES = 11 + len(SIGNS) + SHORT_BUCKETS
HIDDEN, STEPS, BATCH, RATE = 16, 600, 256, 0.01


def passage_features(words: list[str]) -> list[float]:
    """Shape of one passage: lengths, repetition, case, signs, and short words by hash bucket."""
    n, text = len(words), " ".join(words)
    size = max(len(text) - n + 1, 1)
    counts = Counter(words)
    ascii_part = len(text.encode("ascii", "ignore"))
    upper = sum(map(str.isupper, words))
    row = [np.log1p(n) / 5, size / n / 10, max(map(len, words)) / 30, len(counts) / n,
           max(counts.values()) / n, upper / n, sum(map(str.istitle, words)) / n,
           sum(map(str.isalpha, words)) / n, sum(map(str.isdigit, words)) / n,
           1 - ascii_part / len(text), sum(c for c in counts.values() if c > 1) / n]
    row += [min(text.count(s) / n, 2.0) for s in SIGNS]
    short = [0.0] * SHORT_BUCKETS
    for word, count in counts.items():
        if len(word) <= 3:
            short[zlib.crc32(word.lower().encode()) % SHORT_BUCKETS] += count / n
    return row + short


def passages(text: str | None) -> np.ndarray:
    """A row per passage of PASSAGE_WORDS words of the whole text; a blank text is one row of 0."""
    words = text.split() if text else []
    if not words:
        return np.zeros((1, N_FEATURES))
    return np.array([passage_features(words[k:k + PASSAGE_WORDS])
                     for k in range(0, len(words), PASSAGE_WORDS)])


@dataclass
class Attention:
    """Passage encoder, gated attention and classifier; ``parts`` are the learnt arrays."""

    mean: np.ndarray
    scale: np.ndarray
    parts: dict[str, np.ndarray]

    def forward(self, rows: np.ndarray, begins: np.ndarray) -> dict[str, np.ndarray]:
        """All intermediate values for documents whose passages begin at ``begins``."""
        p, sizes = self.parts, np.diff(np.append(begins, len(rows)))
        x = np.clip((rows - self.mean) / self.scale, -5, 5)
        h = np.tanh(x @ p["encode"] + p["encode0"])
        v, u = np.tanh(h @ p["value"]), 1 / (1 + np.exp(-(h @ p["gate"])))
        e = (v * u) @ p["weigh"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, begins), sizes))
        a = e / np.repeat(np.add.reduceat(e, begins), sizes)
        z = np.add.reduceat(a[:, None] * h, begins)
        return {"x": x, "h": h, "v": v, "u": u, "a": a, "z": z, "sizes": sizes,
                "score": 1 / (1 + np.exp(-np.clip(z @ p["out"] + p["out0"], -30, 30)))}

    def gradients(self, rows, begins, labels) -> dict[str, np.ndarray]:
        p, f = self.parts, self.forward(rows, begins)
        d = (f["score"] - labels) / len(labels)
        dz = np.repeat(d[:, None] * p["out"], f["sizes"], axis=0)
        da = (dz * f["h"]).sum(axis=1)
        de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, begins), f["sizes"]))
        dv = de[:, None] * p["weigh"] * f["u"] * (1 - f["v"] ** 2)
        du = de[:, None] * p["weigh"] * f["v"] * f["u"] * (1 - f["u"])
        dh = (f["a"][:, None] * dz + dv @ p["value"].T + du @ p["gate"].T) * (1 - f["h"] ** 2)
        return {"encode": f["x"].T @ dh, "encode0": dh.sum(axis=0), "value": f["h"].T @ dv,
                "gate": f["h"].T @ du, "weigh": (f["v"] * f["u"]).T @ de, "out": f["z"].T @ d,
                "out0": np.array([d.sum()])}

    def score(self, text: str | None) -> float:
        return float(self.forward(passages(text), np.array([0]))["score"][0])


def learnable(id_col: str = "doc_id", folds: int = 4, held_out: int = 2) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds != held_out


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Attention:
    """Minimise the log loss of document labels with Adam on mini-batches."""
    rng, every = np.random.default_rng(seed), np.concatenate(bags)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    model = Attention(every.mean(axis=0), every.std(axis=0) + 1e-3, {
        "encode": draw(N_FEATURES, HIDDEN), "encode0": np.zeros(HIDDEN),
        "value": draw(HIDDEN, HIDDEN), "gate": draw(HIDDEN, HIDDEN), "weigh": draw(HIDDEN),
        "out": draw(HIDDEN), "out0": np.zeros(1)})
    first = {k: np.zeros_like(v) for k, v in model.parts.items()}
    second = {k: np.zeros_like(v) for k, v in model.parts.items()}
    for step in range(1, STEPS + 1):
        chosen = rng.integers(0, len(bags), min(BATCH, len(bags)))
        sizes = np.array([len(bags[k]) for k in chosen])
        found = model.gradients(np.concatenate([bags[k] for k in chosen]),
                                np.cumsum(sizes) - sizes, labels[chosen])
        for k, g in found.items():
            g = g + 1e-4 * model.parts[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            model.parts[k] -= RATE * (first[k] / (1 - 0.9 ** step)) / (
                np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> Attention | None:
    """Fit on at most TRAIN_ROWS of the given labelled rows; None without a labelled text.

    Passages are encoded in the tasks; only their features reach the driver. Rows with a null id
    or label teach nothing.
    """
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
             .filter("id IS NOT NULL AND label IS NOT NULL")
             .orderBy(F.xxhash64("id"), "id", "label").limit(TRAIN_ROWS))
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(known), "id").select("id", "label", "text"))

    def encode(batches):
        for batch in batches:
            bags = [passages(t.as_py()).astype(np.float32).tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(1),
                                              pa.array(bags, pa.binary())],
                                             names=["id", "label", "bag"])
    found = sorted(tuple(r) for r in
                   rows.mapInArrow(encode, "id string, label double, bag binary").collect())
    if not found:
        return None
    bags = [np.frombuffer(r[2], np.float32).reshape(-1, N_FEATURES) for r in found]
    return fit(bags, np.array([r[1] for r in found]))


def score(docs: DataFrame, model: Attention | None, text_col: str = "text",
          score_col: str = "score") -> DataFrame:
    """``docs`` with the chance of label 1 in ``score_col``; 0.5 everywhere without a model.

    Whole texts are scored; null, empty and blank ones as one passage without features. All rows
    and other columns stay; a column named ``score_col`` is replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        known = held.value
        return lambda text: (0.5 if known is None else known.score(text),)
    return with_columns(docs, text_col, [T.StructField(score_col, T.DoubleType())], start)

"""A quality score from statistics of a document.

The statistics of a text (lengths, shares of kinds of characters, repetition,
entropy) are standardised over all documents and mapped to random Fourier
features, whose inner products approximate a Gaussian kernel. Each partition adds
up the normal equations of its labelled rows, and their sum gives ridge scores.
The scores are then calibrated by an isotonic fit, on scores of folds that the
ridge has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rows
from .hashing import words
from .token_store import _batches

FOLDS = 4
#: Partial sums that one task, or the driver, adds up at most.
FAN_IN = 8
STATS = ("log_words", "log_chars", "word_mean", "word_spread", "upper", "digit", "punct", "symbol", "accent", "lines", "dup_lines", "short_lines",
         "distinct_words", "top_word", "top_trigram", "repeat_pairs", "char_entropy", "word_entropy", "capital_words", "sentence", "same_next")


@dataclass(frozen=True)
class Settings:
    features: int = 256
    gamma: float = 0.05
    ridge: float = 1.0
    bins: int = 2000
    threshold: float = 0.3
    seed: int = 7


_KINDS = np.zeros(256, np.uint8)
for _c in range(256):
    _ch = chr(_c)
    _KINDS[_c] = (1 if _ch.isascii() and _ch.isupper() else 2 if _ch.isascii() and _ch.isdigit() else 3 if _c in b".,;:!?'\"()-" else
                  4 if 33 <= _c < 127 and not _ch.isalnum() else 5 if _c >= 128 else 6 if _c == 10 else 7 if _c in b" \t\x0b\x0c\r" else 0)


def _entropy(counts: np.ndarray) -> float:
    p = counts / counts.sum()
    return float(-(p * np.log2(p)).sum())


def statistics(text: str | None) -> np.ndarray:
    """The statistics of one text, all 0 for a text without words."""
    out = np.zeros(len(STATS), np.float32)
    data = (text or "").encode("utf-8", "replace")
    raw = np.frombuffer(data, np.uint8)
    kinds = _KINDS[raw]
    starts, ends, names = words(raw)
    if not len(starts):
        return out
    n, lengths = len(starts), ends - starts
    pairs = names[:-1] * np.uint64(0x9E3779B97F4A7C15) + names[1:]
    triples = pairs[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + names[2:]
    _, uses = np.unique(names, return_counts=True)
    count = np.bincount(kinds, minlength=8) / len(raw)
    lines = [x for x in (text or "").split("\n") if x.strip()]
    heads = raw[starts]
    top = np.unique(triples, return_counts=True)[1].max() if len(triples) else 0
    out[:] = (np.log1p(n), np.log1p(len(raw)), lengths.mean(), lengths.std(), count[1], count[2], count[3], count[4], count[5],
              len(lines) / n, 1 - len(set(lines)) / max(1, len(lines)), sum(len(x) < 30 for x in lines) / max(1, len(lines)),
              len(uses) / n, uses.max() / n, top / max(1, len(triples)), 1 - len(np.unique(pairs)) / max(1, len(pairs)),
              _entropy(np.bincount(raw)[np.unique(raw)]), _entropy(uses), ((heads >= 65) & (heads <= 90)).mean(), np.isin(raw, (33, 46, 63)).sum() / n,
              (names[1:] == names[:-1]).sum() / n)
    return out


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, stats`` of every whole text, written."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, "text"):
            values = np.concatenate([statistics(t) for t in batch["text"].to_pylist()])
            offsets = np.arange(len(batch) + 1, dtype=np.int32) * len(STATS)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["doc_id", "stats"])

    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.stored(slim.mapInArrow(measure, "doc_id bigint, stats array<float>"), "statistics")


def _summed(df: DataFrame, parts, shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all rows of what ``parts`` gives for batches of them.

    A partition with rows writes one partial sum. These are added up in a tree:
    a task holds ``FAN_IN`` of them at most, and as many reach the driver, however
    many partitions there are. The order of adding is fixed, so reruns agree.
    """
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen = np.zeros(shape), False
        for batch in batches:
            if len(batch):
                total += parts(batch)
                seen = True
        if seen:
            yield pd.DataFrame({"task": [_task()], "data": [total.tobytes()]})

    def added(partials: pd.DataFrame) -> np.ndarray:
        total = np.zeros(shape)
        for data in partials.sort_values("task")["data"]:
            total += np.frombuffer(data).reshape(shape)
        return total

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"task": [group["task"].iloc[0] // FAN_IN], "data": [added(group).tobytes()]})

    sums = rows.stored(df.mapInPandas(partial, "task int, data binary"), "sums")
    last = sums.agg(F.max("task")).first()[0] or 0
    while last >= FAN_IN:
        sums = sums.groupBy((F.col("task") / FAN_IN).cast("int").alias("group")).applyInPandas(add, "task int, data binary")
        last //= FAN_IN
    return added(sums.toPandas())


def _task() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def isotonic(positive: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Rates of bins in ascending order that do not fall: pool neighbours while they do."""
    pooled: list[list[float]] = []
    for p, n in zip(positive, count):
        pooled.append([float(p), float(n), 1])
        while len(pooled) > 1 and pooled[-2][0] * pooled[-1][1] >= pooled[-1][0] * pooled[-2][1]:
            last = pooled.pop()
            pooled[-1] = [a + b for a, b in zip(pooled[-1], last)]
    return np.concatenate([np.full(int(k), p / n if n else np.nan) for p, n, k in pooled]) if pooled else np.empty(0)


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray  # a column for each fold left out, then all folds
    low: float
    high: float
    rates: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        z = np.sqrt(2 / len(self.phases)) * np.cos(x @ self.directions + self.phases)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def bin(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(((raw - self.low) / (self.high - self.low) * len(self.rates)).astype(int), 0, len(self.rates) - 1)

    def score(self, stats: np.ndarray) -> np.ndarray:
        return self.rates[self.bin(self.features(stats) @ self.weights[:, -1])]


def fit(stats: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from all rows of ``labels`` (``doc_id, label``) that have statistics.

    A row labelled twice counts twice. Without labels, or with one class only, the
    scores are that class's share (0.5 without any).
    """
    rng = np.random.default_rng(settings.seed)
    d, m = len(STATS), settings.features
    block = lambda batch: np.stack(batch["stats"].to_numpy()).astype(np.float64)
    moments = _summed(stats, lambda b: (lambda x: np.stack([np.full(d, len(x)), x.sum(0), (x * x).sum(0)]))(block(b)), (3, d))
    n = max(1.0, moments[0, 0])
    mean = moments[1] / n
    scale = np.sqrt(np.maximum(moments[2] / n - mean**2, 1e-8))
    model = Model(mean, scale, rng.normal(size=(d, m)) * np.sqrt(2 * settings.gamma), rng.uniform(0, 2 * np.pi, m),
                  np.zeros((m + 1, FOLDS + 1)), -0.5, 1.5, np.full(settings.bins, 0.5))

    known = labels.filter(F.col("label").isNotNull()).select("doc_id", F.col("label").cast("double").alias("label"))
    known = rows.stored(stats.join(known, "doc_id").withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int")), "labelled")

    def equations(batch: pd.DataFrame) -> np.ndarray:
        z, y, of = model.features(block(batch)), batch["label"].to_numpy(), batch["fold"].to_numpy()
        out = np.zeros((FOLDS, m + 1, m + 2))
        for k in range(FOLDS):
            out[k] = z[of == k].T @ np.concatenate([z[of == k], y[of == k, None]], axis=1)
        return out

    folds = _summed(known, equations, (FOLDS, m + 1, m + 2))
    for k in range(FOLDS + 1):
        total = folds.sum(0) - (folds[k] if k < FOLDS else 0)
        model.weights[:, k] = np.linalg.solve(total[:, :-1] + settings.ridge * np.eye(m + 1), total[:, -1])

    def by_bin(batch: pd.DataFrame) -> np.ndarray:
        raw = (model.features(block(batch)) * model.weights[:, batch["fold"].to_numpy()].T).sum(1)
        return np.stack([np.bincount(model.bin(raw), w, settings.bins) for w in (batch["label"].to_numpy(), np.ones(len(batch)))])

    positive, count = _summed(known, by_bin, (2, settings.bins))
    used = np.flatnonzero(count)
    if len(used):
        # Bins without rows lie between two with: in a straight line.
        model.rates[:] = np.interp(np.arange(settings.bins), used, isotonic(positive[used], count[used]))
    return model


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, score, predicted``.

    Every text has a score from 0 to 1, null and empty ones too; ``predicted`` is 1
    from the threshold on. ``labels`` has ``doc_id, label``. Repeated rows stay; an
    empty table gives no rows; other columns are ignored.
    """
    stats = measured(docs, key, text)
    model = docs.sparkSession.sparkContext.broadcast(fit(stats, labels, settings))

    @F.pandas_udf("double")
    def scored(found: pd.Series) -> pd.Series:
        return pd.Series(np.clip(model.value.score(np.stack(found.to_numpy())), 0, 1)) if len(found) else pd.Series([], dtype=float)

    out = stats.withColumn("score", scored("stats"))
    return out.select(F.col("doc_id").alias(key), "score", (F.col("score") >= settings.threshold).cast("int").alias("predicted"))

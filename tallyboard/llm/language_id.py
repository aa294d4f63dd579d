"""Language identification by a recurrent network over bytes.

Two gated recurrent units read a window of bytes, one from each end. Their states
together label every byte with the probabilities of the languages, and a
document's probabilities are the mean over all its bytes. The network is trained
here, by backpropagation through time, on windows of a bounded sample of labelled
documents. A text is cut into windows from its start to its end, so all of it
counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .token_store import _batches

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    #: The sample: of the most frequent labels so many documents each, so many windows of each. Bounds what training reads.
    languages: int = 256
    docs_per_language: int = 800
    windows_per_doc: int = 6
    window: int = 64
    hidden: int = 8
    steps: int = 500
    batch: int = 192
    rate: float = 0.02
    seed: int = 11


#: Windows that are read side by side.
SIDE_BY_SIDE = 4096


class Unit:
    """One gated recurrent unit: input gates by byte, and the weights of the state."""

    def __init__(self, hidden: int, rng: np.random.Generator, kind=np.float32):
        self.inputs = (rng.normal(size=(3 * hidden, 256)) * 0.3).astype(kind)
        self.state = (rng.normal(size=(3 * hidden, hidden)) / np.sqrt(hidden)).astype(kind)

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, list]:
        """``x``: bytes by step and window. The state after each step, and what the way back needs."""
        h3, k = self.state.shape
        h, out, tape = np.zeros((k, x.shape[1]), self.state.dtype), np.empty((len(x), k, x.shape[1]), self.state.dtype), []
        for t, bytes_ in enumerate(x):
            g, u = self.inputs[:, bytes_], self.state @ h
            gates = 1 / (1 + np.exp(-(g[:2 * k] + u[:2 * k])))
            z, r = gates[:k], gates[k:]
            n = np.tanh(g[2 * k:] + r * u[2 * k:])
            tape.append((z, r, n, h, u[2 * k:]))
            h = n + z * (h - n)
            out[t] = h
        return out, tape

    def backward(self, x: np.ndarray, tape: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of ``inputs`` and ``state``, given those of the states."""
        k = self.state.shape[1]
        d_gates, d_state, d_h = np.empty((len(x), 3 * k, x.shape[1]), d_out.dtype), np.zeros_like(self.state), np.zeros_like(d_out[0])
        for t in range(len(x) - 1, -1, -1):
            z, r, n, h, u = tape[t]
            d_h = d_h + d_out[t]
            a_n = d_h * (1 - z) * (1 - n * n)
            a_z, a_r = d_h * (h - n) * z * (1 - z), a_n * u * r * (1 - r)
            d_gates[t] = np.concatenate([a_z, a_r, a_n])
            d_u = np.concatenate([a_z, a_r, a_n * r])
            d_state += d_u @ h.T
            d_h = d_h * z + self.state.T @ d_u
        flat = d_gates.transpose(1, 0, 2).reshape(3 * k, -1)
        at = x.ravel()
        return np.stack([np.bincount(at, row, 256) for row in flat]).astype(d_out.dtype), d_state


class Network:
    """Both units and the output layer."""

    def __init__(self, labels: list[str], settings: Settings, kind=np.float32):
        rng = np.random.default_rng(settings.seed)
        self.labels, self.window = labels, settings.window
        self.units = [Unit(settings.hidden, rng, kind), Unit(settings.hidden, rng, kind)]
        self.out = (rng.normal(size=(len(labels), 2 * settings.hidden)) * 0.1).astype(kind)
        self.bias = np.zeros((len(labels), 1), kind)

    def parameters(self) -> list[np.ndarray]:
        return [p for u in self.units for p in (u.inputs, u.state)] + [self.out, self.bias]

    def loss(self, x: np.ndarray, lengths: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy of all positions of the windows (bytes by step and window), and its gradients."""
        ways = (slice(None), slice(None, None, -1))
        read = [u.forward(x[w]) for u, w in zip(self.units, ways)]
        states = np.concatenate([read[0][0], read[1][0][::-1]], axis=1)
        logits = np.matmul(self.out, states) + self.bias
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        weight = (np.arange(len(x))[:, None] < lengths).astype(p.dtype)
        weight /= weight.sum()
        value = -(np.log(np.maximum(p[:, y, np.arange(len(y))], 1e-20)) * weight).sum()
        d = p
        d[:, y, np.arange(len(y))] -= 1
        d *= weight[:, None, :]
        d_states = np.matmul(self.out.T, d)
        k = self.units[0].state.shape[1]
        grads = []
        for u, w, (_, tape), ds in zip(self.units, ways, read, (d_states[:, :k], d_states[:, k:])):
            grads += u.backward(x[w], tape, ds[w])
        return float(value), [*grads, np.einsum("tcb,tkb->ck", d, states), d.sum(axis=(0, 2))[:, None]]

    def probabilities(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Sums over the positions of each window of the labels' probabilities: labels by windows. Without the tape, in place."""
        steps, b = x.shape
        k = self.units[0].state.shape[1]
        logits = np.empty((steps, len(self.labels), b), np.float32)
        g, h, d = np.empty((3 * k, b), np.float32), np.empty((k, b), np.float32), np.empty((k, b), np.float32)
        u = np.empty((3 * k, b), np.float32)
        # sigmoid(v) = (1 + tanh(v / 2)) / 2: the halves go into the weights.
        half = np.concatenate([np.full(2 * k, 0.5), np.ones(k)]).astype(np.float32)[:, None]
        for way, unit in enumerate(self.units):
            inputs, state = np.ascontiguousarray(unit.inputs * half), np.ascontiguousarray(unit.state * 0.5)
            out = np.ascontiguousarray(self.out[:, way * k:(way + 1) * k])
            h[:] = 0
            for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
                np.take(inputs, x[t], axis=1, out=g, mode="clip")
                np.matmul(state, h, out=u)
                gates, n, un = g[:2 * k], g[2 * k:], u[2 * k:]
                gates += u[:2 * k]
                np.tanh(gates, out=gates)
                gates += 1
                un *= gates[k:]
                n += un
                np.tanh(n, out=n)
                np.subtract(h, n, out=d)
                d *= gates[:k]
                d *= 0.5
                np.add(n, d, out=h)
                if way == 0:
                    np.matmul(out, h, out=logits[t])
                    logits[t] += self.bias
                else:
                    logits[t] += out @ h
        np.clip(logits, -30, 30, out=logits)
        np.exp(logits, out=logits)
        weight = (np.arange(steps)[:, None] < lengths) / logits.sum(axis=1)
        return np.einsum("tcb,tb->cb", logits, weight.astype(np.float32))

    def label(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each text the number of its likeliest label and that label's probability, the mean over all its bytes."""
        w = self.window
        sizes = np.array([len(t) for t in texts], np.int64)
        n = -(-sizes // w)
        total = np.zeros((len(self.labels), len(texts)))
        padded = np.frombuffer(b"".join(t + b" " * (-len(t) % w) for t in texts), np.uint8).reshape(-1, w)
        doc = np.repeat(np.arange(len(texts)), n)
        lengths = np.minimum(w, sizes[doc] - w * (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)))
        for a in range(0, len(doc), SIDE_BY_SIDE):
            part = slice(a, a + SIDE_BY_SIDE)
            found = self.probabilities(np.ascontiguousarray(padded[part].T.astype(np.intp)), lengths[part])
            for c in range(len(self.labels)):
                total[c] += np.bincount(doc[part], found[c], len(texts))
        best = total.argmax(axis=0) if len(self.labels) else np.zeros(len(texts), np.int64)
        return best, total[best, np.arange(len(texts))] / np.maximum(1, sizes)


def train(samples: dict[str, list[bytes]], settings: Settings = Settings()) -> Network:
    """A network trained on windows of text by label: each step as many of each label."""
    labels = sorted(samples)
    net, rng = Network(labels, settings), np.random.default_rng(settings.seed)
    width = settings.window
    arrays = {}
    for label in labels:
        found = [s[:width] for s in samples[label]]
        arrays[label] = (np.frombuffer(b"".join(s.ljust(width) for s in found), np.uint8).reshape(-1, width), np.array([len(s) for s in found]))
    params = net.parameters()
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, settings.steps + 1):
        y = np.arange(settings.batch) % len(labels)
        picks = [rng.integers(len(arrays[labels[c]][1])) for c in y]
        x = np.stack([arrays[labels[c]][0][i] for c, i in zip(y, picks)]).T.astype(np.intp)
        lengths = np.array([arrays[labels[c]][1][i] for c, i in zip(y, picks)])
        short = rng.random(len(y)) < 0.2  # short texts too
        lengths = np.where(short, np.minimum(lengths, rng.integers(6, width + 1, len(y))), lengths)
        x = np.where(np.arange(width)[:, None] < lengths, x, 32)
        _, grads = net.loss(x, lengths, y)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = settings.rate * min(1.0, 2 * (1 - step / (settings.steps + 1)))
        for p, g, m, v in zip(params, grads, first, second):
            g = g / max(1.0, norm)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(p.dtype)
    return net


def _sampled(labelled: DataFrame, settings: Settings) -> dict[str, list[bytes]]:
    """Windows by label: of the documents with the least hashes of each label, at places drawn from the hash.

    The hash is of id and text; rows that are equal in both count once, so null
    and repeated ids draw no more than others. The bound holds before anything
    is collected.
    """
    drawn = labelled.select("lang", "text", F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2).alias("draw"))
    counts = drawn.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("draw").alias("kinds"))
    kinds = {r["lang"]: r["kinds"] for r in counts.orderBy(F.desc("n"), "lang").limit(settings.languages).collect()}
    if not kinds:
        return {}
    most = settings.docs_per_language
    # Somewhat more than the bound by a threshold on the hash, then the least of them.
    below = F.element_at(F.create_map(*[F.lit(x) for lang, n in kinds.items() for x in (lang, int(min(1.0, (2 * most + 50) / n) * 2**62))]), F.col("lang"))
    unlike = drawn.filter(F.col("draw") < below).groupBy("lang", "draw").agg(F.min("text").alias("text"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    picked = unlike.withColumn("_turn", turn).filter(F.col("_turn") <= most)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {"lang": [], "draw": [], "part": []}
            for lang, draw, text in zip(*[batch[c].to_pylist() for c in ("lang", "draw", "text")]):
                data, rng = text.encode("utf-8", "replace"), np.random.default_rng(draw)
                for at in rng.integers(0, max(1, len(data) - settings.window + 1), settings.windows_per_doc):
                    for name, value in (("lang", lang), ("draw", draw), ("part", data[at:at + settings.window])):
                        found[name].append(value)
            yield pa.RecordBatch.from_pydict(found, pa.schema([("lang", pa.string()), ("draw", pa.int64()), ("part", pa.binary())]))

    rows_ = sorted(picked.select("lang", "draw", "text").mapInArrow(windows, "lang string, draw long, part binary").collect())
    out: dict[str, list[bytes]] = {}
    for r in rows_:
        out.setdefault(r["lang"], []).append(bytes(r["part"]))
    return {lang: parts[:most * settings.windows_per_doc] for lang, parts in out.items() if any(parts)}


def learn(labelled: DataFrame, settings: Settings = Settings()) -> Network | None:
    """A network for the labels of ``doc_id, text, lang``; None without labelled texts."""
    samples = _sampled(labelled.filter("lang IS NOT NULL AND text <> ''"), settings)
    return train(samples, settings) if samples else None


def identify(docs: DataFrame, network: Network | None, key: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """One row per row of ``docs``: the key, ``lang_pred``, ``score``.

    Null texts and texts without a letter are ``und`` with score 0, as is every
    text where there was nothing to learn from. Other columns are ignored, or
    returned whole as ``row`` with ``carry``; repeated rows stay.
    """
    kept = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    slim = docs.select(F.col(key).alias("doc_id"), *kept, F.when(letters, F.col(text)).alias("text"))
    if network is None:
        return slim.select(F.col("doc_id").alias(key), *(["row"] if carry else []), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, "text"):
            texts = batch["text"].to_pylist()
            best, share = sent.value.label([(t or "").encode("utf-8", "replace") for t in texts])
            said = [sent.value.labels[b] if t is not None else UNKNOWN for b, t in zip(best, texts)]
            score = np.where([t is not None for t in texts], np.clip(share, 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(said, pa.string()), pa.array(score.astype(np.float64))], [*batch.schema.names[:-1], "lang_pred", "score"])

    from pyspark.sql import types as T

    schema = T.StructType([*slim.schema.fields[:-1], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return slim.mapInArrow(label, schema).withColumnRenamed("doc_id", key)

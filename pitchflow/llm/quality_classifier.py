"""Quality by attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label. Every passage of
the whole text is encoded, gated attention gives each a weight, and the
weighted sum of the encodings is scored (Ilse, Tomczak, Welling 2018):

    h = tanh(E x),  a = softmax(w . (tanh(V h) * sigmoid(U h))),  score = sigmoid(c . sum(a h) + b)

The encoder sees how classes of bytes follow each other in the passage, and
how varied and how long its words are; E, V, U, w, c and b are learned together.
The model is fitted on the driver from at most ``SAMPLE`` labelled documents,
chosen by a hash of their id, with at most ``BAG`` passages each (spread over
the document); scoring takes every passage of every document and needs no
shuffle.

Null and empty texts are one empty passage and get a score. Labels that
contradict each other for one document count as 0. Without labels of both
kinds every score is the share of label 1 (0.5 without any). Extra columns
pass through; ``score`` and ``predicted`` of the input are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchflow.llm.common import fresh, lean, quoted

SAMPLE = 3000
BAG = 64
#: Bytes of a passage; it ends at the next space or line end after that.
PASSAGE = 400
THRESHOLD = 0.7
HIDDEN, GATE = 24, 12
#: Bytes worked at once: what bounds a task's memory beside the longest document.
SLICE = 1 << 19

_CLASSES = 14


def _byte_classes() -> np.ndarray:
    kind = np.full(256, 9, np.uint8)
    for chars, k in (
        (range(97, 123), 0), (range(65, 91), 1), (range(48, 58), 2), (b" ", 3), (b"\n\r\t\x0b\x0c", 4), (b".", 5), (b",;:", 6),
        (b"!?", 7), (b"|<>{}[]#*$%&=", 8), (range(0x80, 0xA0), 10), (range(0xA0, 0xC0), 11), (range(0xC0, 0x100), 12), (b"'\"-()", 13),
    ):
        kind[list(chars)] = k
    return kind


_KIND = _byte_classes()
FEATURES = _CLASSES * _CLASSES + 4


def _passage_starts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where passages start in the joined texts, and the text of each. A line is cut at spaces into passages."""
    space = (data == 32) | (data == 10)
    starts, owner = [], []
    ends = np.flatnonzero(space)
    for i in range(len(bounds) - 1):
        at, stop = bounds[i], bounds[i + 1]
        while True:
            starts.append(at)
            owner.append(i)
            k = np.searchsorted(ends, at + PASSAGE)
            if k == len(ends) or ends[k] + 1 >= stop:
                break
            at = ends[k] + 1
    return np.array(starts, np.int64), np.array(owner, np.int64)


def encode_passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and the index of its text."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    starts, owner = _passage_starts(data, bounds)
    n = len(starts)
    lengths = np.diff(np.append(starts, len(data)))
    out = np.zeros((n, FEATURES), np.float32)
    if len(data):
        passage = np.repeat(np.arange(n), lengths)
        kind = _KIND[data].astype(np.int64)
        pair = kind[:-1] * _CLASSES + kind[1:]
        same = passage[:-1] == passage[1:]
        square = _CLASSES * _CLASSES
        counts = np.bincount(passage[:-1][same] * square + pair[same], minlength=n * square).reshape(n, square)
        out[:, :square] = np.sqrt(counts / np.maximum(lengths - 1, 1)[:, None])
        # Words by a polynomial hash of their bytes, summed between their bounds.
        inside = (kind != 3) & (kind != 4)
        first = inside & np.concatenate([[True], ~inside[:-1] | ~same])
        at = np.flatnonzero(first)
        if len(at):
            word = np.cumsum(first) - 1
            weight = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            place = (np.arange(len(data)) - at[np.maximum(word, 0)]).astype(np.uint64) * np.uint64(2) + np.uint64(1)
            mixed = (weight ^ (weight >> np.uint64(29))) * place * place
            mixed[~inside] = 0
            hashes = np.add.reduceat(mixed, at)
            of = passage[at]
            words = np.bincount(of, minlength=n)
            key = (of.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24))
            key.sort()
            new = np.concatenate([[True], key[1:] != key[:-1]])
            different = np.bincount((key[new] >> np.uint64(40)).astype(np.int64), minlength=n)
            some = np.maximum(words, 1)
            out[:, square] = different / some
            out[:, square + 1] = np.minimum(lengths / some, 40) / 10
            out[:, square + 2] = np.log1p(words) / 5
    out[:, FEATURES - 1] = np.log1p(lengths) / 6
    return out, owner


@dataclass(frozen=True)
class Model:
    """Weights ``E V U w c b``; ``prior`` replaces the score where there was nothing to learn."""

    weights: dict[str, np.ndarray] | None
    prior: float

    def score(self, x: np.ndarray, owner: np.ndarray, bags: int) -> np.ndarray:
        if self.weights is None:
            return np.full(bags, self.prior)
        return _forward(self.weights, x, owner, bags)[-1]


def _forward(p: dict[str, np.ndarray], x: np.ndarray, owner: np.ndarray, bags: int) -> tuple:
    h = np.tanh(x @ p["E"] + p["e"])
    v, u = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
    raw = (v * u) @ p["w"]
    top = np.full(bags, -np.inf)
    np.maximum.at(top, owner, raw)
    grown = np.exp(raw - top[owner])
    a = grown / np.bincount(owner, grown, bags)[owner]
    weighted = a[:, None] * h
    z = np.stack([np.bincount(owner, weighted[:, j], bags) for j in range(h.shape[1])], 1)
    return h, v, u, a, z, 1 / (1 + np.exp(-(z @ p["c"] + p["b"])))


def _gradients(p: dict[str, np.ndarray], x: np.ndarray, owner: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    h, v, u, a, z, s = _forward(p, x, owner, len(y))
    ds = (s - y) / len(y)
    dz = ds[:, None] * p["c"]
    gain = (dz[owner] * h).sum(1)
    draw = a * (gain - np.bincount(owner, a * gain, len(y))[owner])
    dv, du = draw[:, None] * p["w"] * u * (1 - v * v), draw[:, None] * p["w"] * v * u * (1 - u)
    dh = (a[:, None] * dz[owner] + dv @ p["V"].T + du @ p["U"].T) * (1 - h * h)
    return {
        "E": x.T @ dh, "e": dh.sum(0), "V": h.T @ dv, "U": h.T @ du, "w": (v * u).T @ draw, "c": z.T @ ds, "b": ds.sum(keepdims=True)[:1],
    }


def fit_bags(bags: list[np.ndarray], labels: np.ndarray, steps: int = 400, batch: int = 256, seed: int = 7) -> Model:
    """Adam on the cross entropy; the same bags and seed give the same model."""
    labels = np.asarray(labels, float)
    prior = float(labels.mean()) if len(labels) else 0.5
    if not len(labels) or not 0 < prior < 1:
        return Model(None, prior)
    rng = np.random.default_rng(seed)
    p = {
        "E": rng.normal(0, 1 / np.sqrt(8), (FEATURES, HIDDEN)), "e": np.zeros(HIDDEN), "V": rng.normal(0, 0.3, (HIDDEN, GATE)),
        "U": rng.normal(0, 0.3, (HIDDEN, GATE)), "w": rng.normal(0, 0.3, GATE), "c": rng.normal(0, 0.3, HIDDEN), "b": np.zeros(1),
    }
    mean, square = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        chosen = rng.choice(len(bags), min(batch, len(bags)), replace=False)
        x = np.concatenate([bags[i] for i in chosen])
        owner = np.repeat(np.arange(len(chosen)), [len(bags[i]) for i in chosen])
        rate = 0.01 * min(1, 2 * (1 - (step - 1) / steps))
        for k, g in _gradients(p, x, owner, labels[chosen]).items():
            g = g + 1e-5 * p[k]
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.999 * square[k] + 0.001 * g * g
            p[k] = p[k] - rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return Model({k: v.astype(np.float32) for k, v in p.items()}, prior)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text, label in zip(batch["text"], batch["label"], strict=True):
            x, _ = encode_passages([text.as_py().encode()])
            chosen = np.unique(np.linspace(0, len(x) - 1, min(len(x), BAG)).astype(int))
            yield pa.record_batch({"bag": pa.array([x[chosen].astype(np.float16).tobytes()], pa.binary()), "label": pa.array([label.as_py()], pa.int32())})


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", sample: int = SAMPLE) -> Model:
    """A model from at most ``sample`` documents of ``docs`` that ``labels`` (``doc_id``, ``label``) marks."""
    marked = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_id"))
    marked = marked.agg(F.min(label).cast("int").alias("label"))
    # Labels of documents that are not there take no places. Only ids are sorted here.
    there = marked.join(docs.select(F.col(doc_id).alias("_id")), "_id", "left_semi")
    chosen = there.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Of rows that repeat an id the least text is learned from.
    rows = rows.join(F.broadcast(chosen), "_id").groupBy("_id", "label").agg(F.min("text").alias("text")).select("text", "label")
    got = rows.mapInArrow(lean(_bags), "bag binary, label int").collect()
    got.sort(key=lambda r: (r.label, bytes(r.bag)))
    bags = [np.frombuffer(r.bag, np.float16).reshape(-1, FEATURES).astype(np.float32) for r in got]
    return fit_bags(bags, np.array([r.label for r in got]))


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD, keep_text: bool = True, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``, or what ``names`` calls them."""
    out = names if keep_text else (*names, text)
    passed = [n for n in docs.columns if n not in out]
    kept = docs.select(*[F.col(quoted(n)) for n in passed], F.coalesce(F.col(text), F.lit("")).alias(fresh(docs, "_body")[0]))
    schema = T.StructType([*[docs.schema[n] for n in passed], T.StructField(names[0], T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(passed))
            scores, held, size = [], [], 0
            for i in range(batch.num_rows):
                held.append(column[i].as_py().encode())
                size += len(held[-1])
                if size >= SLICE or i == batch.num_rows - 1:
                    x, owner = encode_passages(held)
                    scores.append(model.score(x, owner, len(held)))
                    held, size = [], 0
            if batch.num_rows:
                done = pa.array(np.concatenate(scores).astype(float))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(passed)], done], names=[*passed, names[0]])

    got = kept.mapInArrow(lean(scored), schema)
    return got.withColumn(names[1], (F.col(quoted(names[0])) >= threshold).cast("int"))

"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_BYTES`` bytes. Each passage is encoded
as the square roots of its shares of byte classes and of class pairs (letters by
case, digits, kinds of symbols, white space, bytes beyond ASCII), its text's share of
words not seen before and lengths, and goes through a small layer. Gated attention, learned from the
documents' labels alone, weighs the passages; the weighted passage representation
is scored. Only the weights are broadcast; their size is fixed by the parameters.

Learning uses at most ``SAMPLE_ROWS`` labelled documents of at most
``SAMPLE_BYTES`` bytes, chosen by a hash. Every passage of every text is scored.

Edge cases: NULL and empty texts are one empty passage; without labelled rows the
score is 0.5; NULL labels aren't learned from; repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as st

from docloom.llm.arrays import WordHasher, arrow_batches, bounded_sample, by_text, chunk_table, slices, text_bytes
from docloom.session import materialize

SAMPLE_ROWS, SAMPLE_BYTES = 3_000, 12_000
PASSAGE_BYTES = 1024
HIDDEN, GATE = 24, 12
STEPS, RATE, DECAY, SEED = 160, 0.02, 1e-3, 7

#: Byte classes: (1) lower, (2) upper, (3) digit, (4, 5) beyond ASCII, these groups, and all else.
GROUPS = (b"\n", b" \t", b".,;:?'\"()-", b"!", b"|", b"%&$#*=@/_+<>[]{}\\^`~")
CLASSES = len(GROUPS) + 6
REPEATS = 4  # features besides the class shares
WIDTH = CLASSES * CLASSES + CLASSES + REPEATS


def class_table() -> np.ndarray:
    table = np.zeros(256, np.uint8)  # 0: other
    for low, high, kind in ((0x61, 0x7A, 1), (0x41, 0x5A, 2), (0x30, 0x39, 3), (0x80, 0xBF, 4), (0xC0, 0xFF, 5)):
        table[low : high + 1] = kind
    for k, group in enumerate(GROUPS):
        table[np.frombuffer(group, np.uint8)] = 6 + k
    return table


def passages(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """Encoded passages, and the first passage of each text (n + 1); an empty text is one passage."""
    sizes = np.diff(offsets)
    count = np.maximum(-(-sizes // PASSAGE_BYTES), 1)
    first = np.concatenate([[0], np.cumsum(count)])
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    passage = first[text_of] + (np.arange(len(data)) - offsets[text_of]) // PASSAGE_BYTES
    n = int(first[-1])
    kinds = table[data].astype(np.int64)
    same = passage[1:] == passage[:-1] if len(data) else np.zeros(0, bool)
    pairs = (passage[:-1] * CLASSES + kinds[:-1]) * CLASSES + kinds[1:] if len(data) else np.zeros(0, np.int64)
    pair_counts = np.bincount(pairs[same], minlength=n * CLASSES * CLASSES).reshape(n, -1)
    counts = np.bincount(passage * CLASSES + kinds, minlength=n * CLASSES).reshape(n, -1)
    total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    out = np.empty((n, WIDTH), np.float32)
    out[:, : CLASSES * CLASSES] = np.sqrt(pair_counts / total)
    out[:, CLASSES * CLASSES : -REPEATS] = np.sqrt(counts / total)
    out[:, -4] = np.repeat(distinct_share(data, offsets, hasher), count)
    out[:, -3] = np.minimum(total[:, 0] / PASSAGE_BYTES, 1)
    out[:, -2] = np.log1p(np.repeat(sizes, count)) / 10
    out[:, -1] = 1
    return out, first


def distinct_share(data: np.ndarray, offsets: np.ndarray, hasher: WordHasher) -> np.ndarray:
    """Share of words of each text that it has not had before; words are what lies between white space, told apart by 64-bit hashes."""
    mapped, starts, ends = hasher.spans(data, offsets)
    first = np.searchsorted(starts, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    word = pa.array(hasher.hashes(mapped, starts, ends)).dictionary_encode().indices.to_numpy().astype(np.int64)
    pair = np.sort(text * (int(word.max(initial=0)) + 1) + word)
    new = np.concatenate([[True], pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, bool)
    once = np.bincount(text[new], minlength=len(first) - 1) if len(pair) else np.zeros(len(first) - 1)  # sorting keeps each text's places
    total = np.diff(first)
    return np.where(total > 0, once / np.maximum(total, 1), 1).astype(np.float32)


class Net:
    """tanh layer, gated attention over a bag's passages, logistic score of the weighted mean."""

    def __init__(self, weights: dict[str, np.ndarray]) -> None:
        self.w = weights

    @staticmethod
    def fresh(bias: float) -> Net:
        draw = np.random.default_rng(SEED)
        shapes = {"enc": (WIDTH, HIDDEN), "enc0": (HIDDEN,), "v": (HIDDEN, GATE), "v0": (GATE,), "u": (HIDDEN, GATE), "u0": (GATE,), "a": (GATE,), "out": (HIDDEN,), "out0": (1,)}
        scale = {"enc": 0.5, "v": 0.3, "u": 0.3, "a": 0.3, "out": 0.3}
        w = {k: draw.normal(0, scale.get(k, 0.0), shape) if k in scale else np.zeros(shape) for k, shape in shapes.items()}
        w["out0"][0] = bias
        return Net(w)

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        w, bag = self.w, np.repeat(np.arange(len(first) - 1), np.diff(first))
        h = np.tanh(x @ w["enc"] + w["enc0"])
        t, s = np.tanh(h @ w["v"] + w["v0"]), 1 / (1 + np.exp(-(h @ w["u"] + w["u0"])))
        e = (t * s) @ w["a"]
        e = np.exp(e - np.maximum.reduceat(e, first[:-1])[bag])
        a = e / np.add.reduceat(e, first[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, first[:-1], axis=0)
        return {"bag": bag, "h": h, "t": t, "s": s, "a": a, "z": z, "p": 1 / (1 + np.exp(-np.clip(z @ w["out"] + w["out0"], -50, 50)))}

    def gradient(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.w, self.forward(x, first)
        bag, h, t, s, a = f["bag"], f["h"], f["t"], f["s"], f["a"]
        d = (f["p"] - y) / len(y)
        dz = d[:, None] * w["out"]
        da = np.einsum("ij,ij->i", h, dz[bag])
        de = a * (da - np.add.reduceat(a * da, first[:-1])[bag])
        dt, ds = de[:, None] * w["a"] * s * (1 - t * t), de[:, None] * w["a"] * t * s * (1 - s)
        dh = (a[:, None] * dz[bag] + dt @ w["v"].T + ds @ w["u"].T) * (1 - h * h)
        return {"enc": x.T @ dh, "enc0": dh.sum(0), "v": h.T @ dt, "v0": dt.sum(0), "u": h.T @ ds, "u0": ds.sum(0), "a": (t * s).T @ de, "out": f["z"].T @ d, "out0": d.sum(keepdims=True)}


def fit(x: np.ndarray, first: np.ndarray, y: np.ndarray) -> Net | None:
    """Adam over the whole sample at once."""
    if not len(y):
        return None
    x = x.astype(np.float64)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    net = Net.fresh(float(np.log(share / (1 - share))))
    m = {k: np.zeros_like(v) for k, v in net.w.items()}
    v = {k: np.zeros_like(q) for k, q in net.w.items()}
    for step in range(1, STEPS + 1):
        for k, g in net.gradient(x, first, y).items():
            g = g + DECAY * net.w[k] * (net.w[k].ndim == 2) / 10
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            net.w[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return net


def sample_passages(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages, first passages and labels of the sampled rows, in an order of their own."""
    arrow_batches(labelled)

    def run(batches):
        table, hasher = class_table(), WordHasher(chunk_table())
        for batch in batches:
            for part in slices(batch):
                x, first = passages(*text_bytes(part.column("text")), table, hasher)
                raw = [x[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(raw, pa.binary())], names=["label", "passages"])

    rows = labelled.select("label", "text").mapInArrow(run, "label int, passages binary").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["label"], r["passages"]))
    bags = [np.frombuffer(r["passages"], np.float32).reshape(-1, WIDTH) for r in rows]
    x = np.concatenate(bags) if bags else np.zeros((0, WIDTH), np.float32)
    return x, np.concatenate([[0], np.cumsum([len(b) for b in bags])]).astype(np.int64), np.array([r["label"] for r in rows], float)


def fit_on(docs: DataFrame, labels: DataFrame, label: str = "quality", learn: Column | None = None) -> Net | None:
    """Fit on a bounded sample of documents with a label; ``learn`` says which document ids may be learned from."""
    told = labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label")).where("label IS NOT NULL AND doc_id IS NOT NULL")
    told = told if learn is None else told.where(learn)
    # at most SAMPLE_ROWS ids and labels, so that texts are never shuffled to meet them
    sample = F.broadcast(materialize(bounded_sample(told, SAMPLE_ROWS, "doc_id", "label"), "label-sample"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(sample, "doc_id")
    rows = rows.where(F.octet_length("text") <= SAMPLE_BYTES).orderBy(F.xxhash64("doc_id", "text")).limit(SAMPLE_ROWS)
    return fit(*sample_passages(rows))


def score(docs: DataFrame, net: Net | None, keep: list[str] | None = None) -> DataFrame:
    """Add ``score``: the probability of label 1. A column of this name is replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(None if net is None else {k: v.astype(np.float32) for k, v in net.w.items()})
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != "score"]

    def work() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        table, hasher, model = class_table(), WordHasher(chunk_table()), None if sent.value is None else Net(sent.value)

        def add(batch: pa.RecordBatch) -> list[pa.Array]:
            if model is None:
                return [pa.array(np.full(batch.num_rows, 0.5))]
            x, first = passages(*text_bytes(batch.column("text")), table, hasher)
            return [pa.array(model.forward(x, first)["p"].astype(np.float64))]

        return add

    return by_text(docs, work, [("score", st.DoubleType())], keep)

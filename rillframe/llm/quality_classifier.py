"""Quality classifier by attention-based multiple-instance learning, trained and applied in numpy.

A text is a bag of passages of ``passage`` bytes. A passage's hashed byte trigrams are encoded by a tanh layer; gated
attention (tanh and sigmoid branches, multiplied) weighs the passages; the weighted sum of the encodings gives the
text's score. Only texts have labels; encoder and attention learn from those by back-propagation.

The model is fitted on the driver on a bounded sample of labelled rows: of each class about ``per_class`` texts and about
``train_bytes`` bytes, whichever is less, drawn by the hash of their ids among texts of at most ``longest_bytes``; each
drawn text is a bag of all its passages. Application reads every byte of every text, in one pass without a shuffle and in
blocks of bounded memory: a text's attention is summed over its blocks, so a text of any length is one bag. The sample
has about as many texts of one class as of the other; the score's odds are set back to those of all labels.

Defined cases: a null or empty text is a bag of one empty passage and gets that bag's score; without labelled rows
every score is 0.5; contradicting labels of one id count by their mean (a tie as 1); of several texts of one
labelled id the first in order is learned from; equal texts get equal scores; rows and other columns of the input are
kept, and made columns that clash get leading underscores.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillframe.llm.common import crc_fold, staged, unused
from rillframe.llm.textmodels import Adam


@dataclass(frozen=True)
class Config:
    passage: int = 512
    buckets: int = 2048
    hidden: int = 32
    attention: int = 16
    per_class: int = 2500
    train_bytes: int = 8 << 20
    longest_bytes: int = 1 << 20
    epochs: int = 12
    batch: int = 32
    rate: float = 0.004
    decay: float = 1e-4
    threshold: float = 0.7
    seed: int = 11


def passages(texts: list[bytes], config: Config) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all passages (n, passage), padded with 0, and how many each text has (one at least)."""
    size = config.passage
    counts = np.array([max(1, -(-len(t) // size)) for t in texts])
    joined = b"".join(t.ljust(int(c) * size, b"\0") for t, c in zip(texts, counts, strict=True))
    return np.frombuffer(joined, np.uint8).reshape(-1, size), counts


def features(windows: np.ndarray, config: Config) -> np.ndarray:
    """Square roots of the shares of hashed trigrams."""
    b = windows.astype(np.uint32)
    mixed = (b[:, :-2] * np.uint32(0x9E3779B1)) ^ (b[:, 1:-1] * np.uint32(0x85EBCA77)) ^ (b[:, 2:] * np.uint32(0xC2B2AE3D))
    mixed ^= mixed >> np.uint32(15)
    bucket = (mixed & np.uint32(config.buckets - 1)).astype(np.int64) + np.arange(len(b), dtype=np.int64)[:, None] * config.buckets
    real = windows[:, 2:] != 0
    counts = np.bincount(bucket[real], minlength=len(b) * config.buckets).reshape(len(b), config.buckets).astype(np.float32)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class GatedAttention:
    config: Config
    params: dict[str, np.ndarray]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        p = self.params
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), sigmoid(h @ p["u"])
        return h, t, g, (t * g) @ p["a"]

    def scores(self, texts: list[bytes], block: int = 512) -> np.ndarray:
        """A score for each text. Weights are exp(attention), bounded as both branches are, so blocks can be summed."""
        windows, counts = passages(texts, self.config)
        owner = np.repeat(np.arange(len(texts)), counts)
        top, weights = np.zeros((len(texts), self.config.hidden)), np.zeros(len(texts))
        for i in range(0, len(windows), block):
            h, _, _, s = self.encode(features(windows[i : i + block], self.config))
            e = np.exp(s)
            np.add.at(top, owner[i : i + block], h * e[:, None])
            np.add.at(weights, owner[i : i + block], e)
        return sigmoid(top / weights[:, None] @ self.params["c"] + self.params["d"][0])


def train(texts: list[bytes], labels: list[int], config: Config = Config()) -> GatedAttention:
    rng = np.random.default_rng(config.seed)
    n, h, k = config.buckets, config.hidden, config.attention
    normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    params = {"w": normal(n, h, scale=1.0), "b": np.zeros(h, np.float32), "v": normal(h, k, scale=h**-0.5), "u": normal(h, k, scale=h**-0.5), "a": normal(k, scale=k**-0.5), "c": normal(h, scale=h**-0.5), "d": np.zeros(1, np.float32)}
    model = GatedAttention(config, params)
    bags = [passages([text], config)[0] for text in texts]
    y, adam = np.array(labels, np.float32), Adam(params, config.rate)
    for epoch in range(config.epochs):
        order = rng.permutation(len(bags))
        for i in range(0, len(bags), config.batch):
            chosen = order[i : i + config.batch]
            sizes = np.array([len(bags[j]) for j in chosen])
            starts, owner = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(chosen)), sizes)
            x = features(np.concatenate([bags[j] for j in chosen]), config)
            hid, t, g, s = model.encode(x)
            e = np.exp(s)
            a = e / np.add.reduceat(e, starts)[owner]
            z = np.add.reduceat(hid * a[:, None], starts)
            error = (sigmoid(z @ params["c"] + params["d"][0]) - y[chosen]) / len(chosen)
            d_z = (error[:, None] * params["c"])[owner]
            d_a = (d_z * hid).sum(axis=1)
            d_s = a * (d_a - np.add.reduceat(a * d_a, starts)[owner])
            d_gate = d_s[:, None] * params["a"]
            d_t, d_g = d_gate * g * (1 - t * t), d_gate * t * g * (1 - g)
            d_pre = (a[:, None] * d_z + d_t @ params["v"].T + d_g @ params["u"].T) * (1 - hid * hid)
            grads = {"w": x.T @ d_pre + config.decay * params["w"], "b": d_pre.sum(0), "v": hid.T @ d_t, "u": hid.T @ d_g, "a": (t * g).T @ d_s, "c": z.T @ error, "d": error.sum(keepdims=True)}
            adam.step(grads, config.rate * (1 - epoch / config.epochs) + 1e-5)
    return model


def fit(docs: DataFrame, labels: DataFrame, config: Config = Config(), doc_id: str = "doc_id", text: str = "text", quality: str = "quality") -> GatedAttention | None:
    """Learned from labelled documents of folds 0, 1 and 3. None if there are none."""
    known = labels.where(F.col(doc_id).isNotNull() & F.col(quality).isNotNull() & (crc_fold(doc_id) != 2))
    known = known.groupBy(F.col(doc_id).alias("key")).agg((F.avg(quality) >= 0.5).cast("int").alias("label"))
    size = F.octet_length(F.coalesce(F.col(text), F.lit("")))
    texts = docs.where(size <= config.longest_bytes).select(F.col(doc_id).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), size.alias("size"))
    usable = staged(texts.select("key", "size").join(known, "key"), "labelled")
    sums = usable.groupBy("label").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()  # a row for each class
    if not sums:
        return None
    rate = F.lit(0.0)
    for r in sums:
        rate = F.when(F.col("label") == r["label"], F.lit(min(1.0, config.per_class / r["n"], config.train_bytes / max(1, r["size"])))).otherwise(rate)
    # of the n labelled texts of a class about per_class are drawn at most, however many labels there are, so their ids can be sent
    draw = F.pmod(F.xxhash64(F.col("key").cast("string"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    drawn = usable.where(draw < rate).select("key", "label").distinct()
    found = texts.join(F.broadcast(drawn), "key").groupBy("key").agg(F.min("label").alias("label"), F.min("text").alias("text")).collect()
    found.sort(key=lambda r: str(r["key"]))
    if not found:
        return None
    model = train([r["text"].encode("utf-8", "replace") for r in found], [r["label"] for r in found], config)
    odds = lambda n: np.log((n.get(1, 0) + 1) / (n.get(0, 0) + 1))
    every = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    model.params["d"] += odds(every) - odds(Counter(r["label"] for r in found))  # the sample's classes are even, the labels' aren't
    return model


def predict(docs: DataFrame, model: GatedAttention | None, text: str = "text") -> DataFrame:
    """``docs`` with score and predicted. Only the text column is an input."""
    score, predicted = unused(docs, "score", "predicted")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    threshold = model.config.threshold if model else Config.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for batch in batches:
            for i in range(0, batch.num_rows, 128):
                part = batch.slice(i, 128)
                texts = [(t or "").encode("utf-8", "replace") for t in part.column(text).to_pylist()]
                scores = net.scores(texts) if net else np.full(len(texts), 0.5)
                columns = [*part.columns, pa.array(scores.astype(np.float64)), pa.array((scores >= threshold).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([*part.schema, pa.field(score, pa.float64()), pa.field(predicted, pa.int32())]))

    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField(score, T.DoubleType()), T.StructField(predicted, T.IntegerType())]))


def classify(docs: DataFrame, labels: DataFrame, config: Config = Config()) -> DataFrame:
    return predict(docs, fit(docs, labels, config))

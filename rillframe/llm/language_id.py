"""Language ID by a byte convolutional network, trained and applied in numpy.

A text's UTF-8 bytes are cut into windows of ``window`` bytes, the last one padded. Each byte has a learned vector;
filters of several widths run over the vectors; the largest value of each filter in a window goes through a ReLU and a
softmax layer. A text's scores are its windows' probabilities, weighted by their bytes. Every byte of a text is read.

Beside the languages the network learns a background: training windows with their characters shuffled, and strings of
random characters. It takes probability away from windows that read like no language, but is never predicted. A window is
clear if one language is more probable there than all others and the background together, whatever their number; ``keep``
rejects texts of which less than ``min_clear`` lies in clear windows. Texts of several languages have clear windows.

The model is fitted on the driver on a bounded sample of labelled windows (``per_language`` of each language, fewer if
``total`` would be exceeded), drawn from all windows of all labelled texts by a hash, so each window of a language has the
same chance wherever in a text it is. Windows are counted and cut on the executors; what reaches the driver is the sample,
and what is sent back some tens of kB. Application is one pass without a shuffle; long texts are processed in blocks of
windows, so memory doesn't grow with a text.

Defined cases: a null, empty or letterless text (no character of a Unicode letter category) is ``und`` with score 0; if
there is no labelled row, every text is ``und``; of equally probable languages the first in order is predicted; equal
texts get equal predictions; rows, order and other columns of the input are kept, and made columns that clash get leading
underscores. ``keep`` rejects null, empty and letterless texts; without a labelled row nothing more can be told, so
it rejects nothing else.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillframe.llm.common import crc_fold, staged, unused
from rillframe.llm.textmodels import Adam, softmax

UNKNOWN = "und"
WORDLIKE = re.compile(r"[^\W\d_]")  # letters, and numerals such as halves


def has_letter(text: str | None) -> bool:
    return any(m[0].isalpha() for m in WORDLIKE.finditer(text or ""))


@dataclass(frozen=True)
class Config:
    window: int = 256
    dim: int = 6
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 10
    per_language: int = 3600
    total: int = 200_000
    epochs: int = 8
    least_steps: int = 1200
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


@dataclass
class ByteCnn:
    """``table``: 256 byte vectors, that of the pad byte 0 is zero. ``conv``: widest width x dim rows, a column a filter.

    ``out`` has a column for each language and one for the background.
    """

    config: Config
    languages: list[str]
    table: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def activations(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pooled filter values of windows (n, window) and the places they come from."""
        wide, dim = max(self.config.widths), self.config.dim
        padded = np.zeros((len(windows), windows.shape[1] + wide - 1), np.uint8)
        padded[:, : windows.shape[1]] = windows
        vectors = self.table[padded]
        n, length = windows.shape
        patches = np.lib.stride_tricks.as_strided(vectors, (n, length, wide * dim), (vectors.strides[0], vectors.strides[1], vectors.strides[2])).reshape(-1, wide * dim)
        return (patches @ self.conv).reshape(n, length, -1), patches

    def probabilities(self, windows: np.ndarray, block: int = 48) -> np.ndarray:
        out = np.empty((len(windows), len(self.languages) + 1), np.float32)
        for i in range(0, len(windows), block):
            pooled = np.maximum(self.activations(windows[i : i + block])[0].max(axis=1) + self.bias, 0)
            out[i : i + block] = softmax(pooled @ self.out + self.out_bias)
        return out

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """A row of probabilities of the languages for each text (zeros for an empty one), and its share in clear windows."""
        size = self.config.window
        counts = np.array([-(-len(t) // size) for t in texts])
        result, clear = np.zeros((len(texts), len(self.languages) + 1)), np.zeros(len(texts))
        for first, last in blocks(counts, 4096):  # texts whose windows fit in a block; a longer text is a block of its own
            joined = b"".join(t.ljust(int(c) * size, b"\0") for t, c in zip(texts[first:last], counts[first:last], strict=True))
            if not joined:
                continue
            windows = np.frombuffer(joined, np.uint8).reshape(-1, size)
            p, weight = self.probabilities(windows), (windows != 0).sum(axis=1)
            owner = np.repeat(np.arange(first, last), counts[first:last])
            np.add.at(result, owner, p * weight[:, None])
            np.add.at(clear, owner, (p[:, :-1].max(axis=1) >= 0.5) * weight)
        total = np.maximum(result.sum(axis=1), 1e-12)
        return result[:, :-1] / total[:, None], clear / total

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return self.read(texts)[0]


def blocks(counts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    first, total = 0, 0
    for i, c in enumerate(counts):
        if total and total + c > most:
            yield first, i
            first, total = i, 0
        total += int(c)
    if first < len(counts):
        yield first, len(counts)


def background(windows: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """``n`` windows that read like no language: half with a training window's characters shuffled, half random."""
    out = np.zeros((n, windows.shape[1]), np.uint8)
    for k in range(n):
        size = windows.shape[1]
        if k % 2:
            low, high = [(33, 127), (48, 58), (48, 123), (97, 123)][k // 2 % 4]
            out[k] = rng.integers(low, high, size)
            out[k, rng.random(size) < 0.15 * (k // 8 % 2)] = 32
        else:
            chars = list(bytes(windows[rng.integers(len(windows))]).rstrip(b"\0").decode("utf-8", "ignore"))
            rng.shuffle(chars)
            mixed = "".join(chars).encode()[:size]
            out[k, : len(mixed)] = np.frombuffer(mixed, np.uint8)
    return out


def train(texts: list[bytes], labels: list[str], config: Config = Config()) -> ByteCnn:
    """From all windows of labelled texts."""
    rng = np.random.default_rng(config.seed)
    languages = sorted(set(labels))
    wide, dim, size = max(config.widths), config.dim, config.window
    f = config.filters * len(config.widths)
    mask = np.zeros((wide * dim, f), np.float32)
    for k, width in enumerate(config.widths):
        mask[: width * dim, k * config.filters : (k + 1) * config.filters] = 1
    params = {
        "table": rng.normal(0, 1, (256, dim)).astype(np.float32), "conv": (rng.normal(0, 1, mask.shape) / np.sqrt(wide * dim)).astype(np.float32) * mask,
        "bias": np.zeros(f, np.float32), "out": (rng.normal(0, 1, (f, len(languages) + 1)) / np.sqrt(f)).astype(np.float32), "out_bias": np.zeros(len(languages) + 1, np.float32),
    }
    params["table"][0] = 0
    model = ByteCnn(config, languages, **params)
    counts = [-(-len(t) // size) for t in texts]
    joined = b"".join(t.ljust(c * size, b"\0") for t, c in zip(texts, counts, strict=True))
    if not joined:
        return model
    x = np.frombuffer(joined, np.uint8).reshape(-1, size)
    y = np.repeat([languages.index(v) for v in labels], counts)
    extra = max(1, len(x) // (len(languages) + 1))
    x, y = np.concatenate([x, background(x, extra, rng)]), np.concatenate([y, np.full(extra, len(languages))])
    adam = Adam(params, config.rate)
    epochs = max(config.epochs, -(-config.least_steps * config.batch // len(x)))
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), config.batch):
            rows = order[i : i + config.batch]
            windows, n = x[rows], len(rows)
            values, patches = model.activations(windows)
            at = values.argmax(axis=1)
            pooled = np.take_along_axis(values, at[:, None, :], 1)[:, 0] + params["bias"]
            hidden = np.maximum(pooled, 0)
            p = softmax(hidden @ params["out"] + params["out_bias"])
            p[np.arange(n), y[rows]] -= 1
            p /= n
            d_pool = (p @ params["out"].T) * (pooled > 0)
            place = at + np.arange(n)[:, None] * size
            chosen = patches.reshape(n * size, -1)[place]  # (n, filters, wide * dim)
            d_conv = np.einsum("nfk,nf->kf", chosen, d_pool) * mask
            d_patch = d_pool[:, :, None] * params["conv"].T[None]
            padded = np.concatenate([windows, np.zeros((n, wide - 1), np.uint8)], 1)
            ids = padded[np.arange(n)[:, None, None], at[:, :, None] + np.arange(wide)[None, None]]
            d_table = np.zeros_like(params["table"])
            np.add.at(d_table, ids.reshape(-1), d_patch.reshape(-1, dim))
            d_table[0] = 0
            adam.step({"out": hidden.T @ p, "out_bias": p.sum(0), "bias": d_pool.sum(0), "conv": d_conv, "table": d_table}, config.rate * (1 - epoch / epochs) + 1e-4)
    return model


def is_drawn(key: str, at: Column, quota: int, of: Column) -> Column:
    """Whether window ``at`` of a text is among about ``quota`` of ``of`` windows; in doubles, as the product outgrows a long."""
    return F.pmod(F.xxhash64(key, at), F.lit(1 << 30)) * of.cast("double") < F.lit(float(quota * (1 << 30)))


def fit(docs: DataFrame, config: Config = Config(), doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> ByteCnn | None:
    """Learned from text and non-null lang of the documents of folds 0, 1 and 3. None if there are none."""
    chosen = docs.where((crc_fold(doc_id) != 2) & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    n = F.ceil(F.octet_length(text) / config.window)
    rows = chosen.select(F.col(lang).cast("string").alias("lang"), F.encode(F.col(text), "utf-8").alias("data"), n.alias("n"), F.xxhash64(F.col(doc_id).cast("string"), F.col(text)).alias("key"))
    counts = staged(rows.groupBy("lang").agg(F.sum("n").alias("all")), "languages")
    languages = counts.count()
    if not languages:
        return None
    quota = min(config.per_language, max(1, config.total // languages))
    drawn = F.filter(F.sequence(F.lit(0), F.col("n").cast("int") - 1), lambda at: is_drawn("key", at, quota, F.col("all")))
    cut = F.transform(drawn, lambda at: F.substring("data", at * config.window + 1, F.lit(config.window)))  # a text is never copied for a window
    windows = rows.join(counts, "lang").select("lang", F.explode(cut).alias("window"))
    found = sorted((r["lang"], bytes(r["window"])) for r in windows.toLocalIterator())
    return train([w for _, w in found], [v for v, _ in found], config) if found else None


def predict(docs: DataFrame, model: ByteCnn | None, text: str = "text", clear: bool = False) -> DataFrame:
    """``docs`` with lang_pred and score, and clear if asked for. Only the text column is an input of the prediction."""
    names = unused(docs, "lang_pred", "score", *["clear"] * clear)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = part.column(text).to_pylist()
                letters = [has_letter(t) for t in texts]
                langs, scores, shares = [UNKNOWN] * len(texts), [0.0] * len(texts), [float(has) for has in letters]
                if net is not None and any(letters):
                    p, share = net.read([t.encode("utf-8", "replace") if h else b"" for t, h in zip(texts, letters, strict=True)])
                    best = p.argmax(axis=1)
                    for k in np.flatnonzero(letters):
                        langs[k], scores[k], shares[k] = net.languages[best[k]], min(1.0, float(p[k, best[k]])), float(share[k])
                made = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(shares, pa.float64())][: len(names)]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], schema=pa.schema([*part.schema, *[pa.field(n, m.type) for n, m in zip(names, made, strict=True)]]))

    types = [T.StringType(), T.DoubleType(), T.DoubleType()]
    return docs.mapInArrow(run, T.StructType([*docs.schema, *[T.StructField(n, t) for n, t in zip(names, types, strict=False)]]))


def identify(docs: DataFrame, config: Config = Config()) -> DataFrame:
    return predict(docs, fit(docs, config))


def keep(docs: DataFrame, min_clear: float = 0.5, config: Config = Config()) -> DataFrame:
    """The rows of ``docs`` of whose text at least ``min_clear`` has a clear language, with its columns."""
    share = unused(docs, "lang_pred", "score", "clear")[-1]
    return predict(docs, fit(docs, config), clear=True).where((F.col(share) >= min_clear) & (F.col(share) > 0)).select(*[F.col(f"`{c}`") for c in docs.columns])

"""Language of a text by a small convolutional network over bytes, trained and applied in numpy.

Bytes are embedded, filters of several widths slide over fixed-length windows, the maximum of each
filter over a window feeds a softmax. A text's prediction is the mean over all of its windows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakesteps.llm.common import free_name, per_text, text_or_empty

LENGTH = 256
WIDTHS = (2, 3, 4)
FILTERS, EMBEDDING = 16, 8
#: Training takes at most so many documents per language, and so many windows of each.
PER_LANGUAGE, WINDOWS = 600, 2
SALTS = 64
EPOCHS, BATCH, STEP, SEED = 8, 128, 0.01, 11
UNKNOWN = "und"
#: Windows worked on at once.
BLOCK = 256


@dataclass
class ByteNet:
    """Parameters; ``labels`` in the order of the outputs."""

    labels: list[str]
    embedding: np.ndarray  # (256, e); byte 0 pads and stays zero
    filters: list[np.ndarray]  # per width (width * e, f)
    bias: np.ndarray  # (widths * f,)
    out: np.ndarray  # (widths * f, labels)
    out_bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.bias, self.out, self.out_bias]


def windows(text: str) -> np.ndarray:
    """The lower-case text's UTF-8 bytes as rows of LENGTH, the last one padded with zeros."""
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    rows = max(1, -(-len(data) // LENGTH))
    out = np.zeros(rows * LENGTH, np.uint8)
    out[:len(data)] = data
    return out.reshape(rows, LENGTH)


def _patches(net: ByteNet, x: np.ndarray, width: int) -> np.ndarray:
    e = net.embedding[x]
    n, length, size = e.shape
    view = np.lib.stride_tricks.as_strided(
        e, (n, length - width + 1, width * size), (e.strides[0], e.strides[1], e.strides[2]))
    return view.reshape(-1, width * size)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def probabilities(net: ByteNet, x: np.ndarray) -> np.ndarray:
    """(windows, labels) for rows of bytes."""
    pooled = []
    for width, weight in zip(WIDTHS, net.filters):
        response = _patches(net, x, width) @ weight
        pooled.append(response.reshape(len(x), -1, weight.shape[1]).max(axis=1))
    hidden = np.maximum(np.concatenate(pooled, axis=1) + net.bias, 0)
    return _softmax(hidden @ net.out + net.out_bias)


def train(x: np.ndarray, y: np.ndarray, labels: list[str], epochs: int = EPOCHS, seed: int = SEED) -> ByteNet:
    """Fit by Adam on windows ``x`` with label numbers ``y``, languages weighed equally."""
    random = np.random.default_rng(seed)
    draw = lambda *shape, scale: (random.standard_normal(shape) * scale).astype(np.float32)
    net = ByteNet(
        labels, draw(256, EMBEDDING, scale=0.5),
        [draw(w * EMBEDDING, FILTERS, scale=(w * EMBEDDING) ** -0.5) for w in WIDTHS],
        np.zeros(len(WIDTHS) * FILTERS, np.float32),
        draw(len(WIDTHS) * FILTERS, len(labels), scale=0.2), np.zeros(len(labels), np.float32))
    net.embedding[0] = 0
    weight = (len(y) / (len(labels) * np.maximum(1, np.bincount(y, minlength=len(labels)))))[y]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    t = 0
    for _ in range(epochs):
        order = random.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at:at + BATCH]
            bytes_, target = x[rows], y[rows]
            best, pooled = [], []
            for width, w in zip(WIDTHS, net.filters):
                response = (_patches(net, bytes_, width) @ w).reshape(len(rows), -1, FILTERS)
                best.append(response.argmax(axis=1))
                pooled.append(np.take_along_axis(response, best[-1][:, None], axis=1)[:, 0])
            raw = np.concatenate(pooled, axis=1) + net.bias
            hidden = np.maximum(raw, 0)
            error = _softmax(hidden @ net.out + net.out_bias)
            error[np.arange(len(rows)), target] -= 1
            error *= (weight[rows, None] / len(rows)).astype(np.float32)
            back = (error @ net.out.T) * (raw > 0)
            grads = [np.zeros_like(net.embedding)]
            for k, (width, w) in enumerate(zip(WIDTHS, net.filters)):
                g = back[:, k * FILTERS:(k + 1) * FILTERS]
                # Only the window's strongest place of each filter takes part.
                seen = bytes_[np.arange(len(rows))[:, None, None],
                              best[k][:, :, None] + np.arange(width)]  # (rows, filters, width)
                patch = net.embedding[seen].reshape(len(rows), FILTERS, -1)
                grads.append(np.einsum("bf,bfp->pf", g, patch))
                into = (g[:, :, None] * w.T[None]).reshape(len(rows), FILTERS, width, EMBEDDING)
                np.add.at(grads[0], seen.ravel(), into.reshape(-1, EMBEDDING))
            grads += [back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            grads[0][0] = 0
            t += 1
            for p, g, (m, v) in zip(net.parameters(), grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= STEP * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return net


def held_out(id: Column) -> Column:
    """A fifth of the documents, by a checksum of the id as text."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_windows(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, piece): windows at places chosen by the id's hash, of at most PER_LANGUAGE documents each."""
    key, label, body = F.col(f"`{id}`"), F.col(f"`{lang}`"), F.lower(F.col(f"`{text}`"))
    span = F.greatest(F.lit(1), F.length(body) - LENGTH // 2)
    pieces = F.array(*(F.substring(body, (1 + F.pmod(F.xxhash64(key, F.lit(k)), span)).cast("int"), F.lit(LENGTH))
                       for k in range(WINDOWS)))
    rows = docs.where(~held_out(key) & label.isNotNull() & body.rlike(r"\p{L}")).select(
        label.cast("string").alias("lang"), F.xxhash64(key, F.lit(SEED)).alias("place"), pieces.alias("pieces"))
    # First the best of each of SALTS parts of a language, so that no task gets all its rows.
    order = ("place", "pieces")
    parts = Window.partitionBy("lang", F.pmod("place", F.lit(SALTS))).orderBy(*order)
    rows = rows.withColumn("n", F.row_number().over(parts)).where(F.col("n") <= PER_LANGUAGE)
    ranked = rows.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("n") <= PER_LANGUAGE).select("lang", "n", F.explode("pieces").alias("piece"))


def learn(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> ByteNet | None:
    """A network fitted to the bounded sample; None where no document may be learned from."""
    rows = sorted(map(tuple, training_windows(docs, id, text, lang).collect()))
    if not rows:
        return None
    labels = sorted({r[0] for r in rows})
    number = {label: i for i, label in enumerate(labels)}
    x = np.stack([windows(r[2])[0] for r in rows])
    return train(x, np.array([number[r[0]] for r in rows]), labels)


def predict(net: ByteNet | None, texts: list[str]) -> list[tuple[str, float]]:
    """(language, its mean probability over the text's windows); und and 0 for texts without letters."""
    out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
    told = [i for i, t in enumerate(texts) if net and any(map(str.isalpha, t))]
    if not told:
        return out
    rows = [windows(texts[i]) for i in told]
    counts = [len(r) for r in rows]
    x = np.concatenate(rows)
    p = np.concatenate([probabilities(net, x[at:at + BLOCK]) for at in range(0, len(x), BLOCK)])
    mean = np.add.reduceat(p, np.r_[0, np.cumsum(counts)[:-1]], axis=0) / np.array(counts)[:, None]
    for i, row in zip(told, mean):
        best = int(row.argmax())
        out[i] = net.labels[best], min(1.0, max(0.0, float(row[best])))
    return out


def identify(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang",
             net: ByteNet | None = None) -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred, score.

    Without ``net`` one is learned from the documents that are not held out and have a language.
    Null texts and texts without a letter are 'und' with score 0, as is everything if there is
    nothing to learn from. A null id is not held out. Predictions see the text alone; rows that
    repeat a text get the same one. Other columns are ignored, and only the training sample is
    shuffled.
    """
    net = net or learn(docs, id, text, lang)
    source = free_name(docs, "__text")
    rows = docs.select(F.col(f"`{id}`"), held_out(F.col(f"`{id}`")).alias("held_out"),
                       text_or_empty(text).alias(source))
    return per_text(rows, lambda texts: predict(net, texts), "lang_pred string, score double", source)

"""Language identification by a byte convolutional network.

A text's UTF-8 bytes, all of them, are cut into windows of WINDOW bytes (the last one is
padded with zeros). Bytes are embedded, filters of several widths run over them, each
filter's largest response in the window is kept (max pooling after a rectifier), and a
softmax gives a window's language. A text's prediction is the mean over its windows,
weighted by their letters. The network is trained in numpy on a bounded sample of
labelled texts: about SAMPLE different texts of each language, chosen by a hash of the
text, and up to SLICES windows of each.

Defined results: a null text, and one without any letter, is `und` with score 0. Without
any labelled text every prediction is `und`. Equal texts, and so repeated rows, get equal
predictions. Windows cover texts of any length. Of languages with equal scores the first in
order is predicted. An empty table gives none. Columns of any other name are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, WIDTHS, FILTERS, EMBED = 256, (2, 3, 4), 16, 8
SAMPLE, SLICES, PASSES = 1200, 3, 6
#: Windows that go through the network at once.
BATCH = 256


class ByteNet:
    """Weights as plain arrays, so that they travel with a task."""

    def __init__(self, classes: list[str], seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.embed = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.embed[0] = 0
        # filters of all widths side by side in one matrix of the largest width
        self.mask = np.zeros((max(WIDTHS), EMBED, len(WIDTHS) * FILTERS), np.float32)
        for k, w in enumerate(WIDTHS):
            self.mask[:w, :, k * FILTERS:(k + 1) * FILTERS] = 1
        self.mask = self.mask.reshape(-1, len(WIDTHS) * FILTERS)
        self.filters = (rng.normal(0, 0.25, self.mask.shape) * self.mask).astype(np.float32)
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, max(1, len(classes)))).astype(np.float32)
        self.out_bias = np.zeros(max(1, len(classes)), np.float32)

    def _spread(self, windows: np.ndarray) -> np.ndarray:
        """(windows, positions, largest width * EMBED)."""
        wide = max(WIDTHS)
        x = self.embed[np.pad(windows, ((0, 0), (0, wide - 1)))]
        view = np.lib.stride_tricks.sliding_window_view(x, wide, axis=1)  # windows, positions, EMBED, wide
        return np.ascontiguousarray(view.transpose(0, 1, 3, 2)).reshape(len(windows), windows.shape[1], wide * EMBED)

    def forward(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        x = self._spread(windows)
        h = (x.reshape(-1, x.shape[2]) @ self.filters).reshape(len(windows), windows.shape[1], -1)
        at = h.argmax(axis=1)
        pooled = np.maximum(np.take_along_axis(h, at[:, None, :], axis=1)[:, 0] + self.bias, 0)
        return self.softmax(pooled @ self.out + self.out_bias), pooled, at, x

    def predict(self, windows: np.ndarray) -> np.ndarray:
        x = self._spread(windows)
        h = (x.reshape(-1, x.shape[2]) @ self.filters).reshape(len(windows), windows.shape[1], -1).max(axis=1)
        return self.softmax(np.maximum(h + self.bias, 0) @ self.out + self.out_bias)

    @staticmethod
    def softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def train(self, windows: np.ndarray, labels: np.ndarray, passes: int = PASSES, rate: float = 0.004, seed: int = 7) -> ByteNet:
        """Adam on the cross-entropy, in batches of equal class weight."""
        rng, names = np.random.default_rng(seed), ("embed", "filters", "bias", "out", "out_bias")
        first = {n: np.zeros_like(getattr(self, n)) for n in names}
        second, step = {n: np.zeros_like(getattr(self, n)) for n in names}, 0
        weight = (len(labels) / (len(self.classes) * np.maximum(np.bincount(labels, minlength=len(self.classes)), 1))).astype(np.float32)
        for _ in range(passes):
            order = rng.permutation(len(windows))
            for a in range(0, len(order), 64):
                own = order[a:a + 64]
                w, y = windows[own], labels[own]
                p, pooled, at, x = self.forward(w)
                d = p.copy()
                d[np.arange(len(own)), y] -= 1
                d *= weight[y][:, None] / len(own)
                grads = {"out": pooled.T @ d, "out_bias": d.sum(axis=0)}
                back = (d @ self.out.T) * (pooled > 0)
                grads["bias"] = back.sum(axis=0)
                best = np.take_along_axis(x, at[:, :, None], axis=1)  # windows, filters, inputs at the maximum
                grads["filters"] = np.einsum("wf,wfi->if", back, best) * self.mask
                into = (back[:, :, None] * self.filters.T[None]).reshape(len(own), len(self.bias), max(WIDTHS), EMBED)
                padded = np.pad(w, ((0, 0), (0, max(WIDTHS) - 1)))
                seen = np.take_along_axis(padded[:, None, :], at[:, :, None] + np.arange(max(WIDTHS)), axis=2)
                grads["embed"] = np.zeros_like(self.embed)
                np.add.at(grads["embed"], seen.reshape(-1), into.reshape(-1, EMBED))
                grads["embed"][0] = 0
                step += 1
                for n in names:
                    first[n] = 0.9 * first[n] + 0.1 * grads[n]
                    second[n] = 0.999 * second[n] + 0.001 * grads[n] ** 2
                    move = rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                    setattr(self, n, (getattr(self, n) - move).astype(np.float32))
        return self


def windows_of(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8)
    out = np.zeros((max(1, -(-len(data) // WINDOW)), WINDOW), np.uint8)
    out.reshape(-1)[:len(data)] = data
    return out


def fit(docs: DataFrame, text: str = "text", label: str = "lang", sample: int = SAMPLE) -> ByteNet:
    """Trains on a sample of the labelled texts: at most about `sample` different ones per
    language, of which slices of SLICES * WINDOW characters come to the driver. Every
    label is a class. Copies count once; a text with several labels has the first."""
    rows = docs.select(F.col(text).alias("t"), F.col(label).cast("string").alias("y")).filter("t is not null and y is not null and length(t) > 0")
    hashed = rows.select("y", F.xxhash64("t").alias("h")).distinct()
    counts = hashed.groupBy("y").count().collect()  # one row per language
    net = ByteNet(sorted(r["y"] for r in counts))
    if not counts:
        return net
    u = F.pmod(F.xxhash64("t"), F.lit(1 << 40)) / float(1 << 40)
    rates = F.create_map(*[F.lit(x) for r in counts for x in (r["y"], sample / r["count"])])
    wanted = u < rates[F.col("y")]
    size = SLICES * WINDOW
    start = 1 + F.pmod(F.xxhash64("t", F.lit(1)), F.greatest(F.lit(1), F.length("t") - size)).cast("int")
    got = rows.filter(wanted).groupBy("t").agg(F.min("y").alias("y")).select("y", F.substring(F.col("t"), start, F.lit(size)).alias("t")).collect()
    windows, labels = [], []
    for y, t in sorted(map(tuple, got)):
        own = windows_of(t.encode())
        windows.append(own)
        labels += [net.classes.index(y)] * len(own)
    if not windows:
        return net
    return net.train(np.concatenate(windows), np.array(labels))


def predict_texts(net: ByteNet, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and mean probability of each text."""
    out: list[tuple[str, float]] = []
    sums: dict[int, np.ndarray] = {}
    queue, owners, held = [], [], 0

    def flush() -> None:
        nonlocal held
        windows, of = np.concatenate(queue), np.concatenate(owners)
        for a in range(0, len(windows), BATCH):
            part = windows[a:a + BATCH]
            letters = 1 + ((part >= 0x80) | ((part | 0x20) - 97 < 26)).sum(axis=1)
            p = net.predict(part) * letters[:, None]
            for k in np.unique(of[a:a + BATCH]):
                sums[k] = sums.get(k, 0) + p[of[a:a + BATCH] == k].sum(axis=0)
        queue.clear()
        owners.clear()
        held = 0

    for i, t in enumerate(texts):
        if net.classes and t and any(c.isalpha() for c in t):
            own = windows_of(t.encode())
            queue.append(own)
            owners.append(np.full(len(own), i))
            held += len(own)
            if held >= BATCH:
                flush()
    if queue:
        flush()
    for i in range(len(texts)):
        p = sums.get(i)
        if p is None:
            out.append(("und", 0.0))
        else:
            best = int(p.argmax())
            out.append((net.classes[best], float(min(1.0, p[best] / p.sum()))))
    return out


def predicted(net: ByteNet, text: Column) -> Column:
    """Struct (lang, score) of a text column."""
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(predict_texts(net, texts.tolist()), columns=["lang", "score"])

    return F.pandas_udf(of, "lang string, score double").asNondeterministic()(text)

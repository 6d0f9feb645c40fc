"""Language identification by a byte convolutional network.

A text's bytes are read in windows of fixed length. Filters of several widths run over each window, the largest
response of each filter in it is kept, and a softmax over these gives the window's languages; a text's are the mean of
its windows, weighted by their bytes. The network is trained in numpy on windows from a bounded sample of labelled
texts. In use, the filters' responses to byte pairs are tabulated, so that a position costs a few lookups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.llm.common import batches, utf8
from wardloom.llm.sampling import held_out, sample_keys

WINDOW, WIDTHS, FILTERS, DEPTH = 256, (2, 3, 4), 16, 8
#: Labelled texts of each language to train on, at most, and windows of each.
SAMPLE, CROPS = 800, 4
LETTER = regex.compile(r"\p{L}").search
UNKNOWN = "und"


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # byte -> DEPTH; byte 0 also pads
    filters: dict[int, np.ndarray]  # width -> (width, DEPTH, FILTERS)
    biases: dict[int, np.ndarray]
    dense: np.ndarray
    offset: np.ndarray

    def tables(self) -> dict[int, list[np.ndarray]]:
        """For each width, the filters' responses to each byte at each place."""
        return {w: [(self.embedding @ f[j]).astype(np.float32) for j in range(w)] for w, f in self.filters.items()}


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 1) -> Network:
    """A network fitted to windows (rows of bytes) by Adam; each language has the same weight."""
    rng = np.random.default_rng(seed)
    count = len(languages)
    params = {"embedding": rng.normal(0, 0.3, (256, DEPTH))}
    for w in WIDTHS:
        params[f"filter{w}"] = rng.normal(0, 0.3, (w, DEPTH, FILTERS))
        params[f"bias{w}"] = np.zeros(FILTERS)
    params["dense"] = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), count))
    params["offset"] = np.zeros(count)
    weights = len(labels) / (count * np.maximum(1, np.bincount(labels, minlength=count)))
    means, squares = ({k: np.zeros_like(v) for k, v in params.items()} for _ in range(2))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for start in range(0, len(order), batch):
            mine = order[start : start + batch]
            x, y = windows[mine], labels[mine]
            vectors = params["embedding"][x]  # rows, positions, DEPTH
            pooled, peaks = [], []
            for w in WIDTHS:
                n = x.shape[1] - w + 1
                response = sum(vectors[:, j : j + n] @ params[f"filter{w}"][j] for j in range(w)) + params[f"bias{w}"]
                peak = response.argmax(1)
                peaks.append(peak)
                pooled.append(np.take_along_axis(response, peak[:, None], 1)[:, 0])
            hidden = np.tanh(np.concatenate(pooled, 1))
            error = _softmax(hidden @ params["dense"] + params["offset"])
            error[np.arange(len(y)), y] -= 1
            error *= weights[y][:, None] / len(y)
            grads = {"dense": hidden.T @ error, "offset": error.sum(0), "embedding": np.zeros_like(params["embedding"])}
            back = (error @ params["dense"].T) * (1 - hidden**2)
            rows = np.arange(len(y))[:, None]
            for k, w in enumerate(WIDTHS):
                part = back[:, k * FILTERS : (k + 1) * FILTERS]  # only a filter's largest response learns
                grads[f"bias{w}"] = part.sum(0)
                grads[f"filter{w}"] = np.empty_like(params[f"filter{w}"])
                for j in range(w):
                    at = peaks[k] + j
                    seen = vectors[rows, at]  # rows, FILTERS, DEPTH
                    grads[f"filter{w}"][j] = np.einsum("rfd,rf->df", seen, part)
                    np.add.at(grads["embedding"], x[rows, at], part[:, :, None] * params[f"filter{w}"][j].T[None])
            step += 1
            for k, g in grads.items():
                means[k] += 0.1 * (g - means[k])
                squares[k] += 0.001 * (g * g - squares[k])
                params[k] -= rate * (means[k] / (1 - 0.9**step)) / (np.sqrt(squares[k] / (1 - 0.999**step)) + 1e-8)
    return Network(
        languages,
        params["embedding"],
        {w: params[f"filter{w}"] for w in WIDTHS},
        {w: params[f"bias{w}"] for w in WIDTHS},
        params["dense"],
        params["offset"],
    )


class Reader:
    """A network in use on many texts."""

    def __init__(self, network: Network):
        self.network = network
        t = network.tables()
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(256 * 256, FILTERS)
        self.two = pair(*t[2])
        self.three, self.third = pair(*t[3][:2]), t[3][2]
        self.four, self.last = pair(*t[4][:2]), pair(*t[4][2:])

    def windows(self, windows: np.ndarray) -> np.ndarray:
        """Language shares of each window (rows of bytes)."""
        pooled = []
        wide = windows.astype(np.int32)
        pairs = wide[:, :-1] * 256 + wide[:, 1:]
        pooled.append(self.two[pairs].max(1))
        pooled.append((self.three[pairs[:, :-1]] + self.third[windows[:, 2:]]).max(1))
        pooled.append((self.four[pairs[:, :-2]] + self.last[pairs[:, 2:]]).max(1))
        biases = np.concatenate([self.network.biases[w] for w in WIDTHS])
        hidden = np.tanh(np.concatenate(pooled, 1) + biases)
        return _softmax(hidden @ self.network.dense + self.network.offset)

    def texts(self, raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Language shares of each text; of empty ones zero."""
        sizes = np.diff(starts)
        counts = -(-sizes // WINDOW)
        first = np.concatenate([[0], np.cumsum(counts)])
        padded = np.zeros((int(first[-1]), WINDOW), np.uint8)
        place = np.arange(len(raw)) - np.repeat(starts[:-1], sizes) + np.repeat(first[:-1] * WINDOW, sizes)
        padded.reshape(-1)[place] = raw
        shares = np.empty((len(padded), len(self.network.languages)))
        for k in range(0, len(padded), 64):
            shares[k : k + 64] = self.windows(padded[k : k + 64])
        filled = (padded != 0).sum(1)
        out = np.zeros((len(sizes), shares.shape[1]))
        np.add.at(out, np.repeat(np.arange(len(sizes)), counts), shares * filled[:, None])
        return out / np.maximum(1, out.sum(1, keepdims=True))


def crops(texts: list[str], each: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows from random places of the texts, some of them short, and the text of each."""
    rng = np.random.default_rng(seed)
    rows, owners = [], []
    for k, text in enumerate(texts):
        data = text.encode()
        for _ in range(min(each, 1 + len(data) // 32)):
            size = WINDOW if rng.random() < 0.5 else int(rng.integers(8, WINDOW + 1))
            at = int(rng.integers(0, max(1, len(data) - size + 1)))
            rows.append(np.frombuffer(data[at : at + size].ljust(WINDOW, b"\0"), np.uint8))
            owners.append(k)
    return np.array(rows, np.uint8).reshape(-1, WINDOW), np.array(owners, np.int64)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", divisor: int = 5, fold: int = 0, sample: int = SAMPLE) -> Network | None:
    """A network from at most ``sample`` texts of each language; None if there is no labelled text."""
    chosen = sample_keys(docs.filter(F.col(text).isNotNull()), key, label, divisor, fold, sample)
    if not chosen:
        return None

    def cut(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(read):
            rows, owners = crops(batch.column("text").to_pylist(), CROPS, 3)
            yield pa.record_batch([batch.column("label").take(pa.array(owners)), pa.array([r.tobytes() for r in rows], pa.binary())], names=["label", "bytes"])

    texts = docs.filter(F.col(key).isin(list(chosen)) & F.col(label).isNotNull() & F.col(text).rlike("\\p{L}"))
    made = texts.select(F.col(label).cast("string").alias("label"), F.col(text).alias("text")).mapInArrow(cut, "label string, bytes binary")
    found = made.orderBy("bytes", "label").toArrow()
    if not found.num_rows:
        return None
    languages = sorted(set(found.column("label").to_pylist()))
    windows = np.frombuffer(b"".join(found.column("bytes").to_pylist()), np.uint8).reshape(-1, WINDOW)
    labels = np.array([languages.index(x) for x in found.column("label").to_pylist()])
    return train(windows, labels, languages)


def predict(docs: DataFrame, network: Network | None, key: str = "doc_id", text: str = "text", divisor: int = 5, fold: int = 0) -> DataFrame:
    """key, held_out, lang_pred and score (the share of that language) of every row's whole text.

    Texts that are null or have no letter are ``und`` with score 0, and so is every text if there is no network. Other
    columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), held_out(F.col(key), divisor, fold).alias("held_out"), F.col(text).alias("text"))

    def run(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(network) if network else None
        for batch in batches(read, 2 << 20):
            texts = batch.column("text").to_pylist()
            known = np.array([bool(t and reader and LETTER(t)) for t in texts], bool)
            if reader:
                shares = reader.texts(*utf8(batch.column("text")))
                best = shares.argmax(1)
                names = [network.languages[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)]
                scores = np.where(known, shares.max(1, initial=0), 0.0)
            else:
                names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            columns = [batch.column("key"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores.clip(0, 1))]
            yield pa.record_batch(columns, names=["key", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, f"key {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("key", key)

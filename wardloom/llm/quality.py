"""Quality by positive-unlabelled learning.

Trusted positives are texts labelled as good; unlabelled ones come from the corpus, whatever their quality. The class
prior is estimated from how the two compare where a first classifier finds positives: nowhere can the unlabelled hold
less of the positives than the prior. A small network is then fitted to the non-negative unbiased risk, in which the
negatives' part is what the unlabelled have beyond the positives' share, and is kept from turning negative.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.llm.common import SEPARATORS, batches, shingle_hashes, utf8, word_hashes
from wardloom.llm.sampling import among, held_out, sample_keys

#: Positives, and unlabelled texts, to fit on, at most.
SAMPLE = 6000
HIDDEN = 16
_KINDS = {
    "upper": range(0x41, 0x5B),
    "digit": range(0x30, 0x3A),
    "stop": b".",
    "shout": b"!?",
    "bar": b"|",
    "mark": b"#$%&*+<=>@[\\]^_`{}~/",
    "comma": b",;:'\"()-",
    "other": range(0x80, 0x100),
}
FEATURES = (
    "size", *_KINDS, "word_length", "line_length", "words_again", "next_again", "runs_again", "top_word", "lines_again",
    "worst_upper", "worst_bar", "worst_mark", "worst_shout", "bare_lines",
)


def _ratio(a, b):
    return a / np.maximum(1, b)


def _counted(mask: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return (total[starts[1:]] - total[starts[:-1]]).astype(np.float64)


def _fresh(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many distinct values each row has, and how often it has its most frequent one."""
    rows = len(first) - 1
    owner = np.repeat(np.arange(rows), np.diff(first))
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    begins = np.flatnonzero(new)
    top = np.zeros(rows, np.int64)
    np.maximum.at(top, o[begins], np.diff(np.append(begins, len(h))))
    return np.bincount(o[begins], minlength=rows), top


def features(texts: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` for each text: shares of kinds of bytes, lengths, repetition, and the worst line's shares."""
    raw, starts = utf8(texts)
    rows = len(starts) - 1
    size = np.diff(starts).astype(np.float64)
    out = {"size": np.log1p(size)}
    masks = {}
    for name, members in _KINDS.items():
        chosen = np.zeros(256, bool)
        chosen[list(members)] = True
        masks[name] = chosen[raw]
        out[name] = _ratio(_counted(masks[name], starts), size)
    words, first = word_hashes(raw, starts)
    n = np.diff(first).astype(np.float64)
    out["word_length"] = np.log1p(_ratio(_counted(~SEPARATORS[raw], starts), n))
    distinct, top = _fresh(words, first)
    out["words_again"] = np.where(n > 1, 1 - np.log(np.maximum(1, distinct)) / np.log(np.maximum(2, n)), 0)
    out["top_word"] = _ratio(top, n)
    owner = np.repeat(np.arange(rows), np.diff(first))
    same = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1]) if len(words) > 1 else np.zeros(0, bool)
    out["next_again"] = _ratio(np.bincount(owner[1:][same] if len(same) else [], minlength=rows), n - 1)
    threes, at = shingle_hashes(words, first, 3)
    out["runs_again"] = 1 - _ratio(_fresh(threes, at)[0], np.maximum(1, np.diff(at)))

    # lines: cut at line feeds and at the ends of texts
    cuts = np.unique(np.concatenate([starts[:-1], np.flatnonzero(raw == 10) + 1, starts[-1:]]))
    cuts = cuts[cuts <= len(raw)]
    if len(cuts) > 1:
        line_size = np.diff(cuts).astype(np.float64)
        line_owner = np.searchsorted(starts, cuts[:-1], "right") - 1
        line_words, line_first = word_hashes(raw, cuts)
        whole, whole_first = shingle_hashes(line_words, line_first, max(1, int(np.diff(line_first).max())))
        text_of = line_owner[np.repeat(np.arange(len(cuts) - 1), np.diff(whole_first))]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(text_of, minlength=rows))])
        lines = np.diff(bounds)
        out["lines_again"] = 1 - _ratio(_fresh(whole, bounds)[0], np.maximum(1, lines))
        out["line_length"] = np.log1p(_ratio(size, lines))
        long = line_size >= 20
        for name in ("upper", "bar", "mark", "shout"):
            share = _ratio(_counted(masks[name], cuts), line_size) * long
            worst = np.zeros(rows)
            np.maximum.at(worst, line_owner, share)
            out[f"worst_{name}"] = worst
        bare = (_counted(masks["stop"], cuts) == 0) & (line_size > 1)
        out["bare_lines"] = _ratio(np.bincount(line_owner, bare, rows), lines)
    return np.stack([np.broadcast_to(out.get(f, 0.0), rows) for f in FEATURES], 1).astype(np.float64)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: float
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.tanh(z @ self.inner + self.inner_bias) @ self.outer + self.outer_bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, epochs: int, seed: int = 5, rate: float = 0.01, batch: int = 256) -> Model:
    """By Adam. With a ``prior``: non-negative risk; without: tell positives from unlabelled."""
    rng = np.random.default_rng(seed)
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-6
    p, u = (np.clip((x - mean) / scale, -6, 6) for x in (positive, unlabelled))
    w = [rng.normal(0, 0.3, (p.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(1)]
    m, v = ([np.zeros_like(x) for x in w] for _ in range(2))
    step = 0
    for _ in range(epochs):
        chosen_u = rng.permutation(len(u))
        chosen_p = rng.permutation(len(p))
        for start in range(0, len(u), batch):
            xu = u[chosen_u[start : start + batch]]
            xp = p[np.take(chosen_p, np.arange(start, start + batch), mode="wrap")]
            x = np.concatenate([xp, xu])
            hidden = np.tanh(x @ w[0] + w[1])
            f = np.clip(hidden @ w[2] + w[3], -30, 30)
            g = 1 / (1 + np.exp(-f))
            gp, gu = g[: len(xp)], g[len(xp) :]
            # the logistic loss falls by 1 - g as a positive's f rises, and rises by g as a negative's does
            if prior is None:
                d = np.concatenate([(gp - 1) / len(xp), gu / len(xu)])
            else:
                as_negative = np.logaddexp(0, f)
                rest = as_negative[len(xp) :].mean() - prior * as_negative[: len(xp)].mean()
                if rest >= 0:
                    d = np.concatenate([(prior * (gp - 1) - prior * gp) / len(xp), gu / len(xu)])
                else:  # the negatives' risk went below zero: step back on that part alone
                    d = np.concatenate([prior * gp / len(xp), -gu / len(xu)])
            back = d[:, None] * w[2] * (1 - hidden**2)
            grads = [x.T @ back + 1e-4 * w[0], back.sum(0), hidden.T @ d + 1e-4 * w[2], np.array([d.sum()])]
            step += 1
            for k, grad in enumerate(grads):
                m[k] += 0.1 * (grad - m[k])
                v[k] += 0.001 * (grad**2 - v[k])
                w[k] = w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, w[0], w[1], w[2], float(w[3][0]), prior or 0.5)


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled.

    Over every threshold of a score, the unlabelled above it are at least the prior's share of the positives above it;
    the smallest such ratio, with room for chance, bounds the prior from above.
    """
    cuts = np.quantile(positive, np.linspace(0.02, 0.8, 79))
    p = 1 - np.searchsorted(np.sort(positive), cuts, "left") / len(positive)
    u = 1 - np.searchsorted(np.sort(unlabelled), cuts, "left") / len(unlabelled)
    chance = np.sqrt(u * (1 - u) / len(unlabelled)) + np.sqrt(p * (1 - p) / len(positive))
    return float(np.clip(((u + chance) / np.maximum(p, 1e-9)).min(), 0.05, 0.98))


def learn(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    first = _fit(positive, unlabelled, None, 10)
    prior = estimate_prior(first.logits(positive), first.logits(unlabelled))
    return _fit(positive, unlabelled, prior, 30)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", divisor: int = 3, fold: int = 1, sample: int = SAMPLE) -> Model | None:
    """A model from at most ``sample`` texts labelled 1 and as many unlabelled ones, none held out; None without labels."""
    good = sample_keys(labels.filter(F.col(label) == 1), key, label, divisor, fold, sample)
    drawn = sample_keys(docs, key, None, divisor, fold, sample)
    if not good or not drawn:
        return None

    def measured(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(read):
            rows = list(features(batch.column("text")))
            yield pa.record_batch([batch.column("key"), pa.array(rows, pa.list_(pa.float64()))], names=["key", "x"])

    kind = docs.schema[key].dataType.simpleString()
    texts = among(docs, key, {*good, *drawn}).select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = texts.mapInArrow(measured, f"key {kind}, x array<double>").orderBy("key", "x").toArrow()
    keys, x = found.column("key").to_pylist(), np.array(found.column("x").to_pylist())
    positive, unlabelled = (x[[k in chosen for k in keys]] for chosen in (good, drawn))
    return learn(positive, unlabelled) if len(positive) and len(unlabelled) else None


def score(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text", divisor: int = 3, fold: int = 1) -> DataFrame:
    """key, held_out, score (chance to be good) and predicted of every row's whole text.

    Null texts count as empty; without a model every score is 0.5. Other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), held_out(F.col(key), divisor, fold).alias("held_out"), F.col(text).alias("text"))

    def run(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(read, 2 << 20):
            scores = model.scores(features(batch.column("text"))) if model else np.full(batch.num_rows, 0.5)
            columns = [batch.column("key"), batch.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.record_batch(columns, names=["key", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, f"key {kind}, held_out boolean, score double, predicted int").withColumnRenamed("key", key)

"""Toxicity by weak supervision.

Many voters, words and stems of a lexicon and patterns, say "toxic", "harmless" or nothing about a text. A generative
label model finds out, without labels, how often each voter fires on either kind of text and which voters fire together
beyond what the kind explains; voters that repeat each other share one voice. Its posterior labels train a linear
classifier on the voters and on words that the posterior sets apart, and that classifier scores every text.

The lexicon is a fixed list of insults and, for languages that the list doesn't know, the words and stems that a bounded
sample of labelled texts has in toxic texts alone, more often than chance would.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.llm.common import SEPARATORS, batches, give_back, mix64, remainder, shingle_hashes, utf8, word_hashes
from wardloom.llm.sampling import among, held_out, sample_keys

#: Texts to fit on, and labelled ones of either kind to find the lexicon in, at most; found entries of the lexicon of each
#: kind, and words of the classifier.
SAMPLE, LABELLED, FOUND, WORDS = 5000, 4000, 200, 300
#: Bytes of a stem; shorter words have none.
STEMS = (4, 5, 6)

#: Insults by language, in alphabetical order.
LEXICON = (
    "arschloch", "asshole", "bastard", "bitch", "bollocks", "bullshit", "cabrón", "clown", "connard", "connasse",
    "crap", "cretin", "dickhead", "disgusting", "dumb", "dumbass", "estúpido", "filthy", "freak", "fuck",
    "fucking", "garbage", "gilipollas", "hurensohn", "idiot", "idiota", "idiote", "idiots", "imbécil", "imbécile",
    "imbecile", "jackass", "jerk", "loser", "losers", "merde", "mierda", "miststück", "moron", "morons",
    "motherfucker", "parasite", "pathetic", "pendejo", "pig", "prick", "puta", "putain", "retard", "salaud",
    "salope", "scheiße", "schlampe", "scum", "scumbag", "shit", "shithead", "slut", "stupid", "trash",
    "ugly", "vermin", "whore", "wichser", "worthless", "wretch",
)
#: Patterns of abuse.
PATTERNS = {
    "you_are": r"\byou(?:'re| are)\s+(?:an?\s+|so\s+|such\s+an?\s+)?(?:idiot|moron|stupid|pathetic|worthless|loser|clown|scum|trash|disgusting)",
    "shut_up": r"\bshut\s+(?:the\s+\w+\s+)?up\b",
    "go_away": r"\bgo\s+(?:to\s+hell|die|kill\s+yourself)\b",
    "hate": r"\bi\s+hate\s+(?:you|them|those)\b",
    "masked": r"\b[a-z]+\*+[a-z]+\b",
    "doubled": r"\b(?:idiot|moron|stupid|scum|trash|loser)\W+(?:idiot|moron|stupid|scum|trash|loser)\b",
}
#: Voters on how many words of the lexicon a text has, how densely, and how many different ones.
COUNTS = ("one_hit", "two_hits", "three_hits", "five_hits", "dense", "no_hit", "long_no_hit")
_FIND = {name: re.compile(p).search for name, p in PATTERNS.items()}
_ANY = re.compile(r"you|shut|go |hate|\*|" + "|".join(("idiot", "moron", "stupid", "scum", "trash", "loser"))).search
_EDGE = np.zeros(256, bool)
_EDGE[list(b".,;:!?\"'()[]{}<>|/")] = True


def _hash(words: tuple[str, ...]) -> np.ndarray:
    return np.sort(word_hashes(*utf8(pa.array([" ".join(words)])))[0])


def words_of(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the words of each text without the punctuation around them, hashes of their stems of each length (0:
    none), and the first word of each text."""
    raw, starts = utf8(texts)
    cleaned = np.where(_EDGE[raw] | SEPARATORS[raw], np.uint8(0x20), raw)
    words, first = word_hashes(cleaned, starts)
    made = [words]
    for k, size in enumerate(STEMS):
        stems = word_hashes(cleaned, starts, size)[0]
        made.append(np.where(stems == words, np.uint64(0), mix64(stems + np.uint64(k + 1))))
    return made, first


def _pairs(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each text, and their texts."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    some = np.flatnonzero(values)
    _, at = np.unique(mix64(values[some] + mix64(owner[some].astype(np.uint64))), return_index=True)
    return values[some][at], owner[some][at]


def _hits(values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``values`` that hold one of ``wanted``, which is sorted, and which one."""
    if not len(values) or not len(wanted):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)
    hit = np.flatnonzero(wanted[at] == values)
    return hit, at[hit]


def _present(values: np.ndarray, first: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    made = np.zeros((len(first) - 1, len(wanted)), np.float32)
    hit, which = _hits(values, wanted)
    made[np.searchsorted(first, hit, "right") - 1, which] = 1
    return made


@dataclass
class Voters:
    """Sorted hashes of the lexicon: its words, and its stems of each length."""

    entries: list[np.ndarray]

    @property
    def harmless(self) -> np.ndarray:
        names = [*range(sum(map(len, self.entries))), *PATTERNS, *COUNTS]
        return np.array([v in ("no_hit", "long_no_hit") for v in names])

    def votes(self, texts: pa.Array, words: list[np.ndarray], first: np.ndarray) -> np.ndarray:
        """1 where a voter fires: for each text, the entries of the lexicon, ``PATTERNS`` and ``COUNTS``."""
        entries = [_present(values, first, wanted) for values, wanted in zip(words, self.entries, strict=True)]
        struck = np.zeros(len(words[0]), bool)
        for values, wanted in zip(words, self.entries, strict=True):
            struck[_hits(values, wanted)[0]] = True
        n = np.diff(first)
        hits = np.diff(np.concatenate([[0], np.cumsum(struck)])[first])
        patterns = np.zeros((len(n), len(PATTERNS)), np.float32)
        for k, text in enumerate(texts.to_pylist()):
            if text and _ANY(text := text.lower()):
                patterns[k] = [bool(find(text)) for find in _FIND.values()]
        dense = hits >= np.maximum(1, 0.01 * n)
        counts = np.stack([hits >= 1, hits >= 2, hits >= 3, hits >= 5, dense, hits == 0, (hits == 0) & (n >= 50)], 1)
        return np.concatenate([*entries, patterns, counts], 1).astype(np.float32)


def found_entries(values: np.ndarray, owner: np.ndarray, toxic: np.ndarray, most: int = FOUND) -> np.ndarray:
    """Values that toxic texts alone have, in more texts than chance explains; the most frequent ones, sorted.

    ``values`` and ``owner`` are distinct pairs of a value and a text. Among so many values in at least k texts, less than
    one in a hundred lists is to hold a value whose k texts are all toxic by chance; up to one text in 50 may be harmless.
    """
    known, of = np.unique(values, return_inverse=True)
    times = np.bincount(of, minlength=len(known))
    bad = np.bincount(of, toxic[owner], minlength=len(known))
    share = float(np.clip(toxic.mean(), 1e-3, 0.9)) if len(toxic) else 0.5
    at_least = np.cumsum(np.bincount(times)[::-1])[::-1] if len(times) else np.zeros(1)
    sure = np.log(at_least[times]) + bad * np.log(share) < np.log(0.01) if len(known) else np.zeros(0, bool)
    fit = np.flatnonzero(sure & (times - bad <= 0.02 * times))
    return np.sort(known[fit[np.argsort(-bad[fit], kind="stable")[:most]]])


@dataclass
class LabelModel:
    prior: float
    fires: np.ndarray  # (2, voters): how often each fires on harmless and on toxic texts
    voice: np.ndarray  # what each voter counts, less for those that fire with others
    correlation: np.ndarray  # of voters, given the kind of text

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance that each text is toxic."""
        gain = np.log(self.fires[1] / self.fires[0]) - np.log((1 - self.fires[1]) / (1 - self.fires[0]))
        base = np.log((1 - self.fires[1]) / (1 - self.fires[0]))
        logit = np.log(self.prior / (1 - self.prior)) + votes @ (self.voice * gain) + (self.voice * base).sum()
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def label_model(votes: np.ndarray, harmless: np.ndarray, prior: float, rounds: int = 30) -> LabelModel:
    """By expectation maximisation, from the voters' own direction, with the share of toxic texts given."""
    prior = float(np.clip(prior, 0.005, 0.5))
    voice = np.ones(votes.shape[1])
    weight = np.clip(prior + 0.6 * (votes[:, ~harmless].max(1) > 0), 0, 0.95) * np.where(votes[:, harmless].max(1) > 0, 0.1, 1)
    correlation = np.eye(votes.shape[1])
    model = LabelModel(prior, np.full((2, votes.shape[1]), 0.5), voice, correlation)
    for k in range(rounds):
        kinds = np.stack([1 - weight, weight], 1)
        total = kinds.sum(0)[:, None]
        fires = np.clip((kinds.T @ votes + [[0.01], [0.01]]) / (total + 1), 1e-4, 1 - 1e-4)
        # a voter keeps its direction: nothing may turn an insult into praise
        low, high = np.minimum(fires[0], fires[1]), np.maximum(fires[0], fires[1])
        fires = np.where(harmless, np.stack([high, low]), np.stack([low, high]))
        if k % 5 == 0:
            left = votes - kinds @ fires
            spread = np.sqrt((left**2).mean(0)) + 1e-6
            correlation = (left.T @ left) / len(votes) / spread[:, None] / spread[None, :]
            np.fill_diagonal(correlation, 1)
            voice = 1 / np.where(correlation > 0.1, correlation, 0).sum(1)
        model = LabelModel(prior, fires, voice, correlation)
        weight = model.posterior(votes)
    return model


@dataclass
class Classifier:
    voters: Voters
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float
    labels: LabelModel

    def scores(self, texts: pa.Array) -> np.ndarray:
        words, first = words_of(texts)
        x = np.concatenate([self.voters.votes(texts, words, first), _present(words[0], first, self.words)], 1)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def telling(values: np.ndarray, owner: np.ndarray, posterior: np.ndarray, most: int = WORDS, least: int = 20) -> np.ndarray:
    """The words of at least ``least`` texts that differ most surely between the two kinds, sorted."""
    known, of = np.unique(values, return_inverse=True)
    times = np.bincount(of, minlength=len(known))
    toxic = np.bincount(of, posterior[owner], minlength=len(known))
    a, b = (toxic + 0.5) / (posterior.sum() + 1), (times - toxic + 0.5) / ((1 - posterior).sum() + 1)
    sure = np.abs(np.log(a / b)) / np.sqrt(1 / (toxic + 0.5) + 1 / (times - toxic + 0.5))
    fit = np.flatnonzero(times >= least)
    return np.sort(known[fit[np.argsort(-sure[fit], kind="stable")[:most]]])


def train(x: np.ndarray, target: np.ndarray, penalty: float = 1e-3, rounds: int = 400, rate: float = 0.05) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by Adam on all rows at once."""
    w = np.zeros(x.shape[1] + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    w[-1] = np.log(max(target.mean(), 1e-3) / max(1 - target.mean(), 1e-3))
    for step in range(1, rounds + 1):
        error = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30))) - target
        grad = np.append(x.T @ error / len(x) + penalty * w[:-1], error.mean())
        m += 0.1 * (grad - m)
        v += 0.001 * (grad**2 - v)
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def _in_parts(texts: pa.Array, part: int = 100) -> Iterator[tuple[int, pa.Array]]:
    for start in range(0, len(texts), part):
        yield start, texts.slice(start, part)


def lexicon(texts: pa.Array, toxic: np.ndarray) -> Voters:
    """The fixed list, and what labelled texts add to it; copies and near copies count once."""
    kept, known = [], set()
    for start, part in _in_parts(texts):
        runs, first = shingle_hashes(*word_hashes(*utf8(part)), 3)
        for k, (a, b) in enumerate(zip(first, first[1:], strict=False)):
            least = set(np.unique(runs[a:b])[:4].tolist())
            if not least & known:
                kept.append(start + k)
            known |= least
    texts, toxic = texts.take(pa.array(kept, pa.int64())), toxic[kept]
    entries = []
    for k in range(1 + len(STEMS)):  # one kind at a time, for the sake of memory
        values, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
        for start, part in _in_parts(texts):
            words, first = words_of(part)
            found, owner = _pairs(words[k], first)
            values.append(found)
            owners.append((owner + start).astype(np.int32))
        found = found_entries(np.concatenate(values), np.concatenate(owners), toxic)
        entries.append(np.union1d(found, _hash(LEXICON)) if k == 0 else found)
    return Voters(entries)


def learn(texts: pa.Array, voters: Voters, prior: float) -> Classifier:
    """A classifier from texts without labels and the share of toxic ones."""
    cast, values, owners = [], [], []
    for start, part in _in_parts(texts):
        words, first = words_of(part)
        cast.append(voters.votes(part, words, first))
        found, owner = _pairs(words[0], first)
        values.append(found)
        owners.append(owner + start)
    all_votes = np.concatenate(cast)
    model = label_model(all_votes, voters.harmless, prior)
    posterior = model.posterior(all_votes)
    pairs, owner = np.concatenate(values), np.concatenate(owners)
    chosen = telling(pairs, owner, posterior)
    present = np.zeros((len(texts), len(chosen)), np.float32)
    hit, which = _hits(pairs, chosen)
    present[owner[hit], which] = 1
    weights, bias = train(np.concatenate([all_votes, present], 1), posterior)
    return Classifier(voters, chosen, weights, bias, model)


def keyed_texts(docs: DataFrame, key: str, text: str, chosen: dict) -> tuple[list, pa.Array]:
    """Keys and texts of the rows with one of the chosen keys, in their order; null texts are empty."""
    rows = among(docs, key, chosen).select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # put in order here: to sort them, Spark would bring samples of the texts to the driver as well
    found = rows.toArrow()
    found = found.take(pc.sort_indices(found, sort_keys=[("key", "ascending"), ("text", "ascending")]))
    texts = found.column("text").combine_chunks() if found.num_rows else pa.array([], pa.string())
    return found.column("key").to_pylist(), texts


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    divisor: int = 5,
    fold: int = 0,
    sample: int = SAMPLE,
    labelled: int = LABELLED,
) -> Classifier | None:
    """A classifier from at most ``sample`` texts and ``labelled`` labelled ones of either kind, none of them held out."""
    drawn = sample_keys(docs, key, None, divisor, fold, sample)
    if not drawn:
        return None
    known = sample_keys(labels.select(key, F.col(label).cast("int").alias(label)), key, label, divisor, fold, labelled)
    usable = labels.filter((remainder(F.col(key), divisor) != fold) & F.col(label).isNotNull())
    share = usable.agg(F.avg(F.col(label).cast("double"))).first()[0]
    # one kind of texts at a time, for the sake of the driver's memory
    try:
        keys, texts = keyed_texts(docs, key, text, known)
        voters = lexicon(texts, np.array([known[k] for k in keys], np.float64))
        del texts
        give_back()
        return learn(keyed_texts(docs, key, text, drawn)[1], voters, 0.1 if share is None else share)
    finally:
        give_back()


def score(docs: DataFrame, model: Classifier | None, key: str = "doc_id", text: str = "text", divisor: int = 5, fold: int = 0) -> DataFrame:
    """key, held_out, score (chance to be toxic) and predicted of every row's whole text.

    Null texts count as empty; without a model every score is 0. Other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), held_out(F.col(key), divisor, fold).alias("held_out"), F.col(text).alias("text"))

    def run(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(read, 2 << 20):
            scores = model.scores(batch.column("text")) if model else np.zeros(batch.num_rows)
            columns = [batch.column("key"), batch.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.record_batch(columns, names=["key", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, f"key {kind}, held_out boolean, score double, predicted int").withColumnRenamed("key", key)

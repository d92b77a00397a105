"""Abusive, hateful or sexual content: multiple-instance learning with a noisy-or.

A document is a bag of sentences; it is abusive if one of its sentences is. Sentence scores are trained from document labels
alone, through the noisy-or of the sentences, and then name the offending sentences. Disguised spellings (look-alikes, digits for
letters, letters spelled apart or repeated, stars) are brought to one form first.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirewise.llm.lookalike import skeleton

# Digits and signs that stand for letters.
LEET = str.maketrans("0134578@$!€", "oieastbasie")
_SENTENCE = re.compile(r"(?<=[.!?…])[\"”’»)]*\s+|\n+")
_APART = re.compile(r"(?<![^\W_])(?:[^\W\d_]([ .\-_·*])(?:[^\W_]\1)+[^\W_])(?![^\W_])")
_TOKEN = re.compile(r"[^\W_](?:[\w@$!€*’'\-]*[\w@$€*])?")
_MIXED = re.compile(r"(?=.*[^\W\d_])(?=.*[\d@$!€])")
_RUN = re.compile(r"(.)\1{2,}")


def sentences(text: str) -> list[str]:
    return [s.strip() for s in _SENTENCE.split(text) if s and s.strip()]


def _plain(word: str) -> str:
    """One folded token in plain spelling."""
    if word[0].isdigit() and not _MIXED.search(word):
        return "#"
    if "*" in word:
        return f"{word[0]}*{word[-1] if word[-1] != '*' else ''}"
    if len(word) > 2 and _MIXED.match(word):
        word = word.translate(LEET)
    return _RUN.sub(r"\1", word).replace("’", "'")


class _Plain(dict):
    def __missing__(self, word: str) -> str:
        if len(self) > 300_000:
            self.clear()
        self[word] = out = _plain(word)
        return out


_PLAIN = _Plain()


def tokens(sentence: str) -> list[str]:
    """Folded words of a sentence, in plain spelling; numbers become #."""
    look = skeleton(sentence).casefold()
    look = _APART.sub(lambda m: m.group().replace(m.group(1), ""), look)
    return [_PLAIN[w] for w in _TOKEN.findall(look)]


#: Features of a sentence as numbers: a word, two words in a row, two words one apart; words are numbered below WIDE, the start and the end of a
#: sentence with them.
WIDE, ROW, APART = 1 << 29, 1 << 59, 1 << 60
START, END = 0, 1


def features(ids: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All features (with repeats) of numbered words, each sentence between START and END, and the sentence each belongs to."""
    inner = ids > END
    row, apart = of[:-1] == of[1:], of[:-2] == of[2:]
    keys = [ids[inner], (ROW | (ids[:-1] * WIDE + ids[1:]))[row], (APART | (ids[:-2] * WIDE + ids[2:]))[apart]]
    return np.concatenate(keys), np.concatenate([of[inner], of[:-1][row], of[:-2][apart]])


@dataclass
class SentenceModel:
    """Weights by feature, words by their number (only those that stand in a feature), and the threshold from which a document counts as abusive."""

    words: dict[str, int]
    weights: dict[int, float]
    bias: float
    threshold: float = 0.5

    def logit(self, said: list[str]) -> float:
        """Of a sentence's tokens. What the model has no feature for costs one look-up a token."""
        if self.words.keys().isdisjoint(said):
            return self.bias + (0.0 if said else self.weights.get(ROW | (START * WIDE + END), 0.0))
        get = self.words.get
        ids = [START, *(get(w, -1) for w in said), END]
        keys = {i for i in ids[1:-1] if i >= 0}
        keys.update(ROW | (a * WIDE + b) for a, b in zip(ids, ids[1:]) if a >= 0 <= b)
        keys.update(APART | (a * WIDE + b) for a, b in zip(ids, ids[2:]) if a >= 0 <= b)
        weight = self.weights.get
        return self.bias + sum(weight(k, 0.0) for k in keys)

    def scores(self, parts: list[str]) -> np.ndarray:
        z = np.array([self.logit(tokens(s)) for s in parts], dtype=float)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def noisy_or(scores: np.ndarray) -> float:
    """The probability that at least one sentence offends, if each does on its own with its score."""
    return float(1 - np.prod(1 - scores)) if len(scores) else 0.0


#: A labelled document: its sentences, the share of its raters who call it abusive, and their number.
Bag = tuple[list[str], float, int]


@dataclass
class _Corpus:
    """Numbered sentences of the training documents: words, the features (once a sentence) with the sentence of each, the document of each sentence."""

    words: dict[str, int]
    keys: np.ndarray
    sentence: np.ndarray
    owner: np.ndarray


def _numbered(texts: list[list[str]]) -> _Corpus:
    words: dict[str, int] = {}
    ids, of, owner = [], [], []
    for k, parts in enumerate(texts):
        for x in dict.fromkeys(parts):
            own = [words.setdefault(w, len(words) + 2) for w in tokens(x)]
            ids += [START, *own, END]
            of += [len(owner)] * (len(own) + 2)
            owner.append(k)
    keys, sentence = features(np.array(ids, dtype=np.int64), np.array(of, dtype=np.int64))
    order = np.lexsort((keys, sentence))
    keys, sentence = keys[order], sentence[order]
    once = np.ones(len(keys), dtype=bool)
    once[1:] = (keys[1:] != keys[:-1]) | (sentence[1:] != sentence[:-1])
    return _Corpus(words, keys[once], sentence[once], np.array(owner, dtype=np.int64))


def _bags_with(keys: np.ndarray, bag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each feature, and in how many bags it stands."""
    order = np.lexsort((bag, keys))
    keys, bag = keys[order], bag[order]
    once = np.ones(len(keys), dtype=bool)
    once[1:] = (keys[1:] != keys[:-1]) | (bag[1:] != bag[:-1])
    return np.unique(keys[once], return_counts=True)


def _trained(corpus: _Corpus, use: np.ndarray, given: np.ndarray, raters: np.ndarray, prior: float, error: float, least: int, lift: float, rounds: int, steps: int, penalty: float, rate: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Features, their weights and the bias, from the documents `use` tells."""
    bag = corpus.owner[corpus.sentence]
    positive = use & (given >= 0.5)
    inside, n_in = _bags_with(corpus.keys[positive[bag]], bag[positive[bag]])
    inside, n_in = inside[n_in >= least], n_in[n_in >= least]
    negative = (use & (given < 0.5))[bag]
    at = np.searchsorted(inside, corpus.keys)
    shared = (at < len(inside)) & (np.append(inside, -1)[np.minimum(at, len(inside))] == corpus.keys)
    outside, n_out = _bags_with(corpus.keys[negative & shared], bag[negative & shared])
    against = np.zeros(len(inside))
    against[np.searchsorted(inside, outside)] = n_out
    kept = inside[n_in / max(1, positive.sum()) >= lift * against / max(1, (use & (given < 0.5)).sum())]
    if not len(kept):
        return kept, np.zeros(0), -4.0
    at = np.searchsorted(kept, corpus.keys)
    hit = use[bag] & (at < len(kept)) & (np.append(kept, -1)[np.minimum(at, len(kept))] == corpus.keys)
    r, c, o = corpus.sentence[hit], at[hit], corpus.owner
    votes = raters * (2 * given - 1) * math.log((1 - error) / error)
    labels = np.where(raters > 0, np.clip(given, 0.03, 0.97), prior)
    weight = np.where(use, np.where(raters > 0, 1.0, 0.3), 0.0)
    n = weight.sum()
    w, bias = np.zeros(len(kept)), -4.0
    for _ in range(rounds):
        square, square_b = np.full(len(kept), 1e-6), 1e-6
        for _ in range(steps):
            z = bias + np.bincount(r, w[c], len(o))
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            none = np.exp(np.bincount(o, np.log1p(-np.minimum(p, 1 - 1e-9)), len(labels)))
            any_ = np.clip(1 - none, 1e-6, 1)
            push = p * (weight * (labels * none / any_ - (1 - labels)))[o]
            grad = np.bincount(c, push[r], len(w)) / n - penalty / n * (np.sign(w) + 0.3 * w)
            square += grad**2
            w += rate * grad / np.sqrt(square)
            w[np.abs(w) < 2e-3] = 0
            g = push.sum() / n
            square_b += g**2
            bias = min(bias + rate * g / np.sqrt(square_b), -3.0)
        odds = np.log(np.clip(any_, 1e-4, 1 - 1e-4) / np.clip(1 - any_, 1e-4, 1)) + votes
        labels = np.clip(1 / (1 + np.exp(-odds)), 0.005, 0.97)
    return kept, w, float(bias)


def _scored(corpus: _Corpus, kept: np.ndarray, w: np.ndarray, bias: float, count: int) -> np.ndarray:
    """Noisy-or of all documents."""
    at = np.searchsorted(kept, corpus.keys)
    hit = (at < len(kept)) & (np.append(kept, -1)[np.minimum(at, len(kept))] == corpus.keys)
    z = bias + np.bincount(corpus.sentence[hit], w[at[hit]], len(corpus.owner))
    return 1 - np.exp(np.bincount(corpus.owner, np.log1p(-np.minimum(1 / (1 + np.exp(-np.clip(z, -30, 30))), 1 - 1e-9)), count))


def best_threshold(scores: np.ndarray, labels: np.ndarray, otherwise: float = 0.2) -> float:
    """The score of the best F1 against the labels: of the cuts that reach it, the middle (in logits) of the widest gap. Without labels of both kinds,
    `otherwise`."""
    if not labels.any() or labels.all():
        return otherwise
    order = np.argsort(-scores, kind="stable")
    s, y = np.clip(scores[order], 1e-6, 1 - 1e-6), labels[order]
    f1 = 2 * np.cumsum(y) / (np.arange(1, len(y) + 1) + y.sum())
    logit = np.log(s / (1 - s))
    gap = logit - np.append(logit[1:], logit[-1])
    good = np.flatnonzero(f1 >= f1.max() - 1e-9)
    at = good[gap[good].argmax()]
    z = logit[at] - gap[at] / 2
    return float(1 / (1 + np.exp(-z)))


def fit(bags: list[Bag], others: list[list[str]] = (), prior: float = 0.02, error: float = 0.08, least: int = 3, lift: float = 1.3, rounds: int = 4, steps: int = 120, penalty: float = 0.7, rate: float = 0.3, folds: int = 3) -> SentenceModel:
    """A sentence model from document labels; others: sentences of documents without a label.

    The first round takes the raters' share as label, and `prior` for documents without one. Each further round takes what is most
    likely by the model so far and by raters who err with the share `error`: what is usual in the corpus gains no weight from the few
    labels it happens to stand beside, and wrong labels lose theirs. A feature is kept if it stands in at least `least` bags
    called abusive, and there `lift` times as often as in the others. The threshold is fitted on held-out labels: each of `folds` parts is scored
    by a model of the others.
    """
    given = np.array([b[1] for b in bags] + [prior] * len(others), dtype=float)
    raters = np.array([b[2] for b in bags] + [0] * len(others), dtype=float)
    corpus = _numbered([b[0] for b in bags] + list(others))
    if not len(corpus.keys):
        return SentenceModel({}, {}, -4.0)
    settings = (prior, error, least, lift, rounds, steps, penalty, rate)
    held = np.zeros(len(bags))
    part = np.arange(len(given)) % folds
    for k in range(folds):
        model = _trained(corpus, part != k, given, raters, *settings)
        held[part[: len(bags)] == k] = _scored(corpus, *model, len(given))[: len(bags)][part[: len(bags)] == k]
    kept, w, bias = _trained(corpus, np.ones(len(given), dtype=bool), given, raters, *settings)
    weights = {int(k): float(x) for k, x in zip(kept, w) if x}
    used = {i for k in weights for i in ([k] if k < ROW else [(k & ~(ROW | APART)) // WIDE, k % WIDE])}
    words = {x: i for x, i in corpus.words.items() if i in used}
    return SentenceModel(words, weights, bias, best_threshold(held, given[: len(bags)] >= 0.5))


def training(labels: DataFrame, documents: DataFrame, most: int = 8_000, others: int = 4_000) -> tuple[list[Bag], list[list[str]]]:
    """Bags of at most `most` labelled documents with the mean and number of their raters, and at most `others` documents without a label.

    Both are the documented bounds on the training sample, chosen by hash; scoring covers all documents. Repeated rows of one rater count
    once, null labels not at all.
    """
    votes = (
        labels.where("doc_id is not null and abusive is not null").groupBy("doc_id", "rater").agg(F.max("abusive").alias("vote"))
        .groupBy("doc_id").agg(F.avg("vote").alias("share"), F.count("*").alias("raters"))
    )
    order = [F.xxhash64("doc_id", F.lit("train")), F.col("doc_id")]
    chosen = votes.orderBy(*order).limit(most)
    usable = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    rows = usable.join(chosen, "doc_id").select("doc_id", "text", "share", "raters").distinct().collect()
    free = usable.join(votes.select("doc_id"), "doc_id", "left_anti").orderBy(*order).limit(others).collect()
    return [(sentences(r.text), r.share, r.raters) for r in sorted(rows, key=lambda r: r.doc_id)], [sentences(r.text) for r in free]


SCORED = "doc_id long, score double, abusive boolean, worst int, sentence string, offending array<int>"


def scored(documents: DataFrame, model: SentenceModel) -> DataFrame:
    """(doc_id, score, abusive, worst, sentence, offending): noisy-or of a document's sentences, whether it reaches the model's threshold, number and
    words of the worst one, and all sentences at or above the threshold. A null or empty text scores 0; rows without doc_id are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                parts = sentences(text or "")
                s = model.scores(parts)
                worst = int(s.argmax()) if len(s) else -1
                score = noisy_or(s)
                rows.append((doc, score, score >= model.threshold, worst, parts[worst] if parts else "", np.flatnonzero(s >= model.threshold).tolist()))
            if rows:
                types = [pa.int64(), pa.float64(), pa.bool_(), pa.int32(), pa.string(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["doc_id", "score", "abusive", "worst", "sentence", "offending"])

    return documents.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCORED)


def source_rates(documents: DataFrame, scores: DataFrame) -> DataFrame:
    """(source, documents, abusive, rate): the share of abusive documents by source; spellings of one source count together."""
    name = F.coalesce(F.translate(F.lower(F.trim("source")), "_", "-"), F.lit(""))
    named = documents.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), name.alias("source")).distinct()
    hit = F.sum(F.col("abusive").cast("bigint"))
    return named.join(scores.select("doc_id", "abusive"), "doc_id").groupBy("source").agg(F.count("*").alias("documents"), hit.alias("abusive")).withColumn("rate", F.col("abusive") / F.col("documents"))

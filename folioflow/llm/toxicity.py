"""Toxicity by multiple-instance learning: only documents are labelled, sentences are scored.

A document is a bag of sentences, a sentence the set of its known features. It has the probability sigmoid(bias +
weights of its features); a document is toxic if any of its sentences is (noisy-or): 1 - prod(1 - p). The weights are
fitted through that formula from document labels, with a small share of wrong labels allowed for, so the same weights
point out the offending sentences. `instances` and `noisy_or` serve fitting, scoring and location alike: sentences
without known features are no instances, equal sentences of a document are one, and all instances count, however
unlikely. So that long clean texts stay clean, what documents without the label hold together is clean too: unions of
GROUPS of them are fitted as further clean bags, which keeps the sum over many clean sentences small.
Features of a word: the word in lower case, and its first four and five letters, so that inflected forms count.

Sentences end at . ! ? at the end of a word and at line breaks.
Defined cases: null and empty texts have no sentence and the score 0; repeated rows are scored alike; without both
labels to learn from every score is 0; no rows give an empty result; other columns are ignored or kept as asked, under
any names; a text of any length is scored as a whole; equally likely sentences all count.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, linear

#: Labelled documents read for fitting, at most, both labels together.
SAMPLE = 4000
#: Share of labels of either kind taken to be wrong while fitting.
NOISE = 0.01
#: Features kept for fitting, at most: those that differ most between the labels.
FEATURES = 30_000
#: Clean documents to a union, and the weight of all unions of a size beside that of all documents.
GROUPS, UNION = (8, 64, 512), 0.02
#: How often a toxic document counts while fitting: the unions say no often enough.
RARE = 3.0
#: Code points of texts that are scored at a time.
PORTION = 1 << 21
_TOKEN = re.compile(r"\S+|\n")
_EDGES = ".,;:!?()[]{}\"'`*_~-<>|/\\“”‘’«»…"


def features(token: str) -> tuple[int, ...]:
    """Hashes of the word and of its first four and five letters."""
    word = token.strip(_EDGES).lower()
    if not word:
        return ()
    return tuple(xxhash.xxh64_intdigest(x.encode()) for x in ("w" + word, *(f"{k}{word[:k]}" for k in (4, 5) if len(word) > k)))


def ends_sentence(token: str) -> bool:
    return token[-1] in ".!?" or token == "\n"


@dataclass(frozen=True)
class Model:
    """names: hashes of the known features, ascending."""

    bias: float
    names: np.ndarray
    weights: np.ndarray


def nothing() -> Model:
    return Model(-40.0, np.zeros(0, np.uint64), np.zeros(0))


@dataclass
class Instances:
    """Different sentences with known features: the document and the place of each; and pairs (instance, feature)."""

    doc: np.ndarray
    sentence: np.ndarray
    of: np.ndarray
    feature: np.ndarray

    def logits(self, bias: float, weights: np.ndarray) -> np.ndarray:
        return bias + np.bincount(self.of, weights[self.feature], len(self.doc))


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)


def instances(doc: np.ndarray, sentence: np.ndarray, feature: np.ndarray, once: bool = True) -> Instances:
    """From one row a feature met, sentences numbered over all documents in their order. once: equal sentences of a
    document are one instance."""
    if not len(doc):
        none = np.zeros(0, np.int64)
        return Instances(none, none, none, none)
    width = int(feature.max()) + 1
    pair, at = np.unique(sentence * width + feature, return_index=True)
    doc, sentence, feature = doc[at], pair // width, pair % width
    starts = np.flatnonzero(np.concatenate([[True], sentence[1:] != sentence[:-1]]))
    of = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(pair)))
    doc, sentence = doc[starts], sentence[starts]
    if once:
        same = _spread(np.add.reduceat(_spread(feature.astype(np.uint64)), starts) + _spread(~doc.astype(np.uint64)))
        kept = np.zeros(len(doc), bool)
        kept[np.unique(same, return_index=True)[1]] = True
        held = kept[of]
        of, feature, doc, sentence = (np.cumsum(kept) - 1)[of[held]], feature[held], doc[kept], sentence[kept]
    return Instances(doc, sentence, of, feature)


def noisy_or(z: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """The probability of each document from its instances' logits: 1 - prod(1 - p)."""
    return -np.expm1(-np.bincount(doc, np.logaddexp(0, z), docs))


class Tokens(dict):
    """Token -> twice the number of its set of known features, plus one if it ends a sentence. Bounded."""

    def __init__(self, model: Model, limit: int = 500_000):
        super().__init__()
        self.model, self.limit = model, limit
        self.number = {int(f): i for i, f in enumerate(model.names)}
        self.sets: dict[tuple[int, ...], int] = {(): 0}
        self._packed = (0, None, None, None)

    def __missing__(self, token: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        known = tuple(self.number[f] for f in features(token) if f in self.number)
        got = 2 * self.sets.setdefault(known, len(self.sets)) + ends_sentence(token)
        if len(token) <= 64:
            self[token] = got
        return got

    def packed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sizes and starts of the sets, and their features one after the other."""
        if self._packed[0] != len(self.sets):
            sizes = np.array([len(x) for x in self.sets])
            flat = np.array([f for x in self.sets for f in x], np.int64)
            self._packed = (len(self.sets), sizes, np.cumsum(sizes) - sizes, flat)
        return self._packed[1:]

    def instances(self, codes: list[np.ndarray], once: bool = True) -> Instances:
        """The instances of documents given by their tokens' codes."""
        code = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        doc = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        end = code & 1
        sentence = np.cumsum(end) - end + doc
        some = np.flatnonzero(code > 1)
        sizes, starts, flat = self.packed()
        sets = code[some] >> 1
        n = sizes[sets]
        feature = flat[np.repeat(starts[sets] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        return instances(np.repeat(doc[some], n), np.repeat(sentence[some], n), feature, once)

    def codes(self, text: str) -> np.ndarray:
        tokens = text.replace("\n", " . ").split()
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Score and number of instances of each text."""
        score, number, at = [], [], 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and size < PORTION:
                size += len(texts[end])
                end += 1
            got = self.instances([self.codes(t) for t in texts[at:end]])
            score.append(noisy_or(got.logits(self.model.bias, self.model.weights), got.doc, end - at))
            number.append(np.bincount(got.doc, minlength=end - at))
            at = end
        return (np.concatenate(score), np.concatenate(number)) if score else (np.zeros(0), np.zeros(0, np.int64))

    def sentences(self, text: str) -> np.ndarray:
        """log(1 - p) of each instance, negated."""
        got = self.instances([self.codes(text)])
        return np.logaddexp(0, got.logits(self.model.bias, self.model.weights))

    def score(self, text: str) -> float:
        return float(self.scores([text])[0][0])

    def located(self, text: str, threshold: float = 0.5) -> list[dict]:
        """The sentences with at least that probability, or else the likeliest: start and end in code points,
        probability, text."""
        found = list(_TOKEN.finditer(text))
        tokens = ["." if m.group() == "\n" else m.group() for m in found]
        codes = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        got = self.instances([codes], once=False)
        if not len(got.doc):
            return []
        p = linear.sigmoid(got.logits(self.model.bias, self.model.weights))
        end = codes & 1
        number = np.cumsum(end) - end
        out = []
        for s, x in zip(got.sentence.tolist(), p.tolist(), strict=True):
            if x >= min(threshold, float(p.max())):
                a, b = np.searchsorted(number, [s, s + 1]).tolist()
                words = [m for m in found[a:b] if m.group() != "\n"]
                out.append({"start": words[0].start(), "end": words[-1].end(), "p": x, "text": text[words[0].start() : words[-1].end()]})
        return out


def _chosen(doc: np.ndarray, feature: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The features that differ most between the labels, ascending, by the documents that have them."""
    both = np.unique(np.stack([feature, doc.astype(np.uint64)]), axis=1)
    names, at = np.unique(both[0], return_inverse=True)
    n = np.bincount(at)
    pos = np.bincount(at, labels[both[1].astype(np.int64)])
    neg = n - pos
    n_pos, n_neg = labels.sum(), (1 - labels).sum()
    contrast = np.abs(np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1))) / np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))
    told = np.flatnonzero((n >= 3) & (contrast >= 2.0))
    return np.sort(names[told[np.argsort(-contrast[told], kind="stable")][:FEATURES]])


def fit(sample: list[tuple[str, int, float]], steps: int = 400, rate: float = 0.3, l2: float = 1e-5) -> Model:
    """Fits bias and weights to (text, toxic, weight) rows by the noisy-or likelihood.

    First with all chosen features; then small weights go, and the rest is fitted on."""
    labels = np.array([y > 0 for _, y, _ in sample], np.float64)
    if not len(labels) or labels.min() == labels.max():
        return nothing()
    weight = np.array([w for _, _, w in sample]) * np.where(labels > 0, RARE, 1.0)
    weight = weight / weight.sum()
    memo: dict[str, tuple[int, ...]] = {}
    found, places, numbers, s = [], [], [], 0
    for text, _, _ in sample:
        fs, ss = [], []
        for token in [*text.replace("\n", " . ").split(), "."]:
            got = memo.get(token)
            if got is None:
                if len(memo) > 200_000:
                    memo.clear()
                got = memo[token] = features(token)
            fs += got
            ss += [s] * len(got)
            s += ends_sentence(token)
        found.append(np.array(fs, np.uint64))
        places.append(np.array(ss, np.int64))
        numbers.append(len(fs))
    memo.clear()
    feature, sentence, doc = np.concatenate(found), np.concatenate(places), np.repeat(np.arange(len(sample)), numbers)
    del found, places
    names = _chosen(doc, feature, labels)
    if not len(names):
        return nothing()

    def known(names: np.ndarray) -> Instances:
        at = np.minimum(np.searchsorted(names, feature), len(names) - 1)
        held = names[at] == feature
        return instances(doc[held], sentence[held], at[held])

    clean_docs = np.flatnonzero(labels == 0)
    unions = []
    for size in GROUPS:
        of = np.full(len(labels), -1)
        of[clean_docs] = np.arange(len(clean_docs)) // min(size, len(clean_docs))
        unions.append((of, int(of.max()) + 1))

    def gradient_of(bag: Instances):
        held = [(of[bag.doc], n) for of, n in unions]

        def gradient(x: np.ndarray) -> np.ndarray:
            z = bag.logits(x[0], x[1:])
            cost = np.logaddexp(0, z)
            clean = np.exp(-np.bincount(bag.doc, cost, len(labels)))
            p = NOISE + (1 - 2 * NOISE) * (1 - clean)
            slope = (weight * (labels / p - (1 - labels) / (1 - p)) * (1 - 2 * NOISE) * clean)[bag.doc]
            for of, n in held:
                some = of >= 0
                whole = np.exp(-np.bincount(of[some], cost[some], n))
                share = -UNION / n * (1 - 2 * NOISE) * whole / (NOISE + (1 - 2 * NOISE) * whole)
                slope[some] += share[of[some]]
            g = -slope * linear.sigmoid(z)
            return np.concatenate([[g.sum()], np.bincount(bag.feature, g[bag.of], len(x) - 1) + l2 * x[1:]])

        return gradient

    bag = known(names)
    share = max(1, len(bag.doc) / len(labels))
    x = linear.adam(gradient_of(bag), np.concatenate([[-2 - math.log(share)], np.zeros(len(names))]), steps, rate)
    large = np.abs(x[1:]) > 0.25
    if not large.any():
        return nothing()
    names = names[large]
    x = linear.adam(gradient_of(known(names)), np.concatenate([x[:1], x[1:][large]]), steps // 2, rate / 3)
    return Model(float(x[0]), names, x[1:])


def train(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Model:
    """Fits on a bounded sample of the labelled documents outside the held-out fifth."""
    return linear.fitted(docs, labels, "toxic", bound, fit)


_SPANS = "array<struct<start:int,end:int,p:double,text:string>>"


def scored(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), locate: bool = True, text: str = "text") -> DataFrame:
    """The kept columns, score, predicted, n_scored (different sentences with known features), and with locate the
    offending sentences of predicted documents."""
    spark = docs.sparkSession
    common.ship_code(spark)
    shared = spark.sparkContext.broadcast(model)
    chosen = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(keep)), common.text_of(text).alias("_text"))
    schema = chosen.drop("_text").selectExpr("*", "0D score", "0 predicted", "0L n_scored", *([f"cast(array() as {_SPANS}) sentences"] if locate else [])).schema
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64()), ("text", pa.string())]))

    def run(batches):
        tokens = Tokens(shared.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            score, number = tokens.scores(texts)
            cols = [pa.array(score, pa.float64()), pa.array(score >= 0.5).cast(pa.int32()), pa.array(number, pa.int64())]
            if locate:
                cols.append(pa.array([tokens.located(t) if s >= 0.5 else [] for t, s in zip(texts, score, strict=True)], spans))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *cols], schema.names)

    got = chosen.mapInArrow(common.lean(run), schema)
    return got.toDF(*keep, *schema.names[len(keep) :])


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents whose score stays under 0.5, all columns kept."""
    own = common.Shielded(docs)
    got = scored(own.inner, model, tuple(own.inner.columns), locate=False, text=own("text"))
    return own.restore(got.filter("predicted = 0"))


def with_held_out(result: DataFrame) -> DataFrame:
    return result.withColumn("held_out", F.coalesce(common.held_out(), F.lit(False)))

"""Toxicity by class-conditional Kneser-Ney bigram models.

Two interpolated, absolutely discounted bigram models, one of toxic and one of ordinary texts, share
their lowest order: continuation counts (how many words precede a word) over both classes. All n-grams of the sample
are kept; what rare ones say is smoothed by the discount and that shared backoff. A text's features are its log-likelihood ratio normalised by its length in
several ways, once over all n-grams and once with those seen less than ``OFTEN`` times read as unknown, so that the fit
can weigh rare expressions apart; a logistic fit on further labelled texts turns them into a score.

The fit uses a bounded sample of labelled rows: per class ``sample`` rows for the language models and
``sample`` for the logistic fit, those with the smallest hashes of doc_id (with all that share the largest of these). So the models' size has a bound, too. Scoring
covers all rows and whole texts, however long.

Null texts count as empty; empty texts get the score of a ratio of zero. Labels other than 0 and 1, and null ones,
are not learned from. Without labels of both classes every score is the share of label 1 (0 if there
is none). Rows with one doc_id each give a row. No rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch, given_back, runs, text_of
from tidemark.session import remove_scratch, write_scratch

_WORD = re.compile(r"[^\W\d_]+")
RUN_CHARS = 1_500_000
DISCOUNT = 0.75
FLUSH = 400_000
OFTEN = 5


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class KneserNey:
    """Log-likelihood ratios, toxic over ordinary, by word and kept bigram."""

    index: dict[str, int]
    single: np.ndarray  # by word; 0 is any unknown word
    backoff: np.ndarray  # by context
    keys: np.ndarray  # sorted context * (n + 1) + word
    pair: np.ndarray  # by key
    often: np.ndarray  # words seen often; 0 isn't
    pair_often: np.ndarray  # by key

    @classmethod
    def fit(cls, single: pa.Table, pairs: pa.Table) -> KneserNey:
        """single: word, n0 (ordinary), n1 (toxic); pairs: context, word, n0, n1. All words of pairs are in single."""
        single = single.sort_by("word").combine_chunks()
        words = single["word"].combine_chunks()
        n = len(words)
        one = np.zeros((2, n + 1))
        for k in (0, 1):
            one[k, 1:] = single[f"n{k}"].to_numpy()
        totals = one.sum(axis=1)
        at = np.column_stack(
            [
                *(pc.index_in(pairs[c], value_set=words).to_numpy().astype(np.int64) + 1 for c in ("context", "word")),
                *(pairs[f"n{k}"].to_numpy() for k in (0, 1)),
            ]
        )
        at = at[np.argsort(at[:, 0] * (n + 1) + at[:, 1])]
        follow = 0.5 + np.bincount(at[:, 1], minlength=n + 1)
        shared = follow / follow.sum()
        prob = np.zeros((2, n + 1))
        for k in (0, 1):
            kept = np.maximum(one[k] - DISCOUNT, 0)
            total = max(totals[k], 1)
            prob[k] = kept / total + (1 - kept.sum() / total) * shared
        held = np.zeros((2, n + 1))
        for k in (0, 1):
            np.add.at(held[k], at[:, 0], np.maximum(at[:, 2 + k] - DISCOUNT, 0))
        left = 1 - held / np.maximum(one, 1)
        left = np.clip(np.where(one > 0, left, 1.0), 1e-6, 1.0)
        both = np.zeros((2, len(at)))
        for k in (0, 1):
            seen = one[k][at[:, 0]]
            direct = np.where(seen > 0, np.maximum(at[:, 2 + k] - DISCOUNT, 0) / np.maximum(seen, 1), 0)
            both[k] = direct + left[k][at[:, 0]] * prob[k][at[:, 1]]
        return cls(
            {w: i for i, w in enumerate(words.to_pylist(), 1)},
            np.log(prob[1] / prob[0]),
            np.log(left[1] / left[0]),
            at[:, 0] * (n + 1) + at[:, 1],
            np.log(both[1] / both[0]),
            one.sum(axis=0) >= OFTEN,
            at[:, 2] + at[:, 3] >= OFTEN,
        )

    def features(self, texts: list[str]) -> np.ndarray:
        """Per text, of all n-grams and of those seen often: the ratio by length, by its root, its size and its
        positive part; and the length."""
        split = [words_of(t) for t in texts]
        sizes = np.array([len(w) for w in split], np.int64)
        ids = np.fromiter((self.index.get(w, 0) for words in split for w in words), np.int64, int(sizes.sum()))
        context, hit, at = np.zeros(len(ids), np.int64), np.zeros(len(ids), bool), np.zeros(len(ids), np.int64)
        inside = np.ones(len(ids), bool)
        if len(ids):
            context = np.concatenate([[0], ids[:-1]])
            inside[np.concatenate([[0], np.cumsum(sizes)[:-1]])[sizes > 0]] = False
            context[~inside] = 0
            if len(self.keys):
                key = context * (len(self.index) + 1) + ids
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = (context > 0) & (ids > 0) & (self.keys[at] == key)
        doc = np.repeat(np.arange(len(texts)), sizes)
        n = np.maximum(sizes, 1)
        columns = []
        for only_often in (False, True):
            word, before, known = ids, context, hit
            if only_often:
                word, before = np.where(self.often[ids], ids, 0), np.where(self.often[context], context, 0)
                known = hit & self.pair_often[at] if len(self.keys) else hit
            ratio = self.single[word] + np.where(before > 0, self.backoff[before], 0)
            if len(self.keys):
                ratio = np.where(known, self.pair[at], ratio)
            total = np.bincount(doc, ratio, len(texts))
            strong = np.bincount(doc, np.where(ratio > 1.5, ratio, 0), len(texts))
            columns += [
                total / n,
                total / np.sqrt(n),
                np.sign(total) * np.log1p(np.abs(total)),
                np.log1p(strong),
                strong / n,
            ]
        return np.column_stack([*columns, np.log1p(sizes)])


@dataclass
class Scorer:
    model: KneserNey | None
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the constant

    def score(self, texts: list[str]) -> np.ndarray:
        if self.model is None:
            return np.full(len(texts), self.weights[-1])
        x = (self.model.features(texts) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    keep = np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + keep * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sampled(labels: DataFrame, sample: int) -> tuple[DataFrame, dict[int, int]]:
    """doc_id, label, fits_words of the rows sampled, about ``2 * sample`` per class, and class sizes.

    A doc_id labelled more than once is toxic if any row says so.
    """
    rows = labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    rows = rows.groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    rows = rows.withColumn("h", F.xxhash64("doc_id", F.lit(5)))
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    inside = F.lit(False)
    for k in sizes:
        lowest = rows.filter(F.col("label") == k).select("h").orderBy("h").limit(2 * sample)
        inside = inside | ((F.col("label") == k) & (F.col("h") <= lowest.agg(F.max("h")).first()[0]))
    return rows.filter(inside).select("doc_id", "label", (F.pmod("h", F.lit(2)) == 0).alias("fits_words")), sizes


def learn(docs: DataFrame, labels: DataFrame, *, sample: int = 2500) -> Scorer:
    """A scorer from texts (doc_id, text) and labels (doc_id, label: 0 or 1)."""
    chosen, sizes = sampled(labels, sample)
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    constant = Scorer(None, np.zeros(1), np.ones(1), np.array([share]))
    # The sample's size is bounded by its parameter.
    given = docs.select("doc_id", text_of(docs).alias("text")).join(F.broadcast(chosen), "doc_id")
    picked = write_scratch(given, "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [("context", pa.string()), ("word", pa.string()), ("n0", pa.int64()), ("n1", pa.int64())]
        schema = pa.schema(columns)
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def flush() -> pa.RecordBatch:
            terms = list(seen[0].keys() | seen[1].keys())
            out = batch(
                schema,
                context=[c for c, _ in terms],
                word=[w for _, w in terms],
                n0=[seen[0][t] for t in terms],
                n1=[seen[1][t] for t in terms],
            )
            for c in seen.values():
                c.clear()
            return out

        for got in batches:
            for label, text in zip(got["label"].to_pylist(), got["text"].to_pylist(), strict=True):
                words = words_of(text)
                terms = [(None, w) for w in words] + list(zip(words, words[1:], strict=False))
                seen[label].update(terms)
                if len(seen[0]) + len(seen[1]) > FLUSH:
                    yield flush()
        yield flush()

    counted = (
        picked.filter("fits_words")
        .select("label", "text")
        .mapInArrow(given_back(count), "context string, word string, n0 long, n1 long")
        .groupBy("context", "word")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    )
    counted = write_scratch(counted, "toxicity-terms")
    totals = counted.filter("context is null").agg(F.sum("n0"), F.sum("n1")).first()
    if not totals[0] or not totals[1]:
        return constant
    # Of a sample of bounded size.
    single = counted.filter("context is null").select("word", "n0", "n1").toArrow()
    pairs = counted.filter("context is not null").toArrow()
    model = KneserNey.fit(single, pairs)
    remove_scratch(counted)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("label", pa.int32()), ("x", pa.list_(pa.float64()))])
        for got in batches:
            texts = got["text"].to_pylist()
            for begin, end in runs(texts, RUN_CHARS):
                x = model.features(texts[begin:end])
                yield batch(schema, label=got["label"].slice(begin, end - begin), x=list(x))

    fitted = picked.filter("not fits_words").select("label", "text").mapInArrow(given_back(measure), "label int, x array<double>").collect()
    y = np.array([r["label"] for r in fitted], float)
    if len(np.unique(y)) < 2:
        return constant
    x = np.array([r["x"] for r in fitted])
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    weights = _logistic((x - mean) / scale, y)
    # The sample takes as many of either class; the constant takes the labels' own share.
    weights[-1] += np.log(sizes[1] / sizes[0]) - np.log(y.sum() / (1 - y).sum())
    return Scorer(model, mean, scale, weights)


def score(docs: DataFrame, scorer: Scorer, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of rows with doc_id, held_out and text."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())]
    )

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            texts = got["text"].to_pylist()
            for begin, end in runs(texts, RUN_CHARS):
                n = end - begin
                value = scorer.score(texts[begin:end])
                yield batch(
                    schema,
                    doc_id=got["doc_id"].slice(begin, n),
                    held_out=got["held_out"].slice(begin, n),
                    score=value,
                    predicted=(value >= threshold).astype(np.int32),
                )

    frame = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "held_out", text_of(docs).alias("text"))
    return frame.mapInArrow(given_back(rate), "doc_id long, held_out boolean, score double, predicted int")

"""Language identification of mixed-language text.

Learned from all labelled texts: per language, how often each letter trigram (hashed to
``buckets`` cells, words padded) and each script occurs. A word's score in a language is the
log-likelihood of its trigrams. The script of a word, by its first letter's Unicode range, narrows the
languages to those that use that script. Viterbi over a text's words, with a penalty for
each switch, labels its spans. A text's language is the one with most letters in its spans
(of equal ones, the first by code point); its score is that language's share of the letters.

Null texts and texts without letters are ``und`` with score 0, and so is every text if nothing
was learned. Rows with null text or label are not learned from. A doc_id may repeat or be null;
each row gives a row. Texts are read whole, however long. No rows give no rows. Other columns are ignored. The driver and each task hold
``buckets`` numbers per language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import DOCUMENT_COLUMNS, batch, cuts, given_back, runs, text_of

UNKNOWN = "und"
RUN_CHARS = 1_000_000
RUN_BYTES = 2_000_000  # of a batch, become Python strings at once

# First code points of Unicode ranges, with the script that begins there.
SCRIPT_RANGES = [
    (0x0000, "Latin"),
    (0x0370, "Greek"),
    (0x0400, "Cyrillic"),
    (0x0530, "Armenian"),
    (0x0590, "Hebrew"),
    (0x0600, "Arabic"),
    (0x0900, "Devanagari"),
    (0x0980, "Bengali"),
    (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"),
    (0x0B00, "Oriya"),
    (0x0B80, "Tamil"),
    (0x0C00, "Telugu"),
    (0x0C80, "Kannada"),
    (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"),
    (0x0E00, "Thai"),
    (0x0E80, "Lao"),
    (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"),
    (0x10A0, "Georgian"),
    (0x1100, "Hangul"),
    (0x1200, "Ethiopic"),
    (0x1780, "Khmer"),
    (0x1E00, "Latin"),
    (0x1F00, "Greek"),
    (0x2000, "Common"),
    (0x3040, "Kana"),
    (0x3100, "Han"),
    (0xAC00, "Hangul"),
    (0xD7B0, "Common"),
    (0xF900, "Han"),
    (0xFB00, "Latin"),
    (0xFB1D, "Hebrew"),
    (0xFB50, "Arabic"),
    (0xFF00, "Latin"),
    (0xFF66, "Kana"),
    (0x10000, "Common"),
    (0x20000, "Han"),
]
SCRIPTS = sorted({name for _, name in SCRIPT_RANGES})
PLANE = 0x10000  # letters beyond the first plane are looked up one by one


class Letters:
    """Words and hashed trigrams of texts, by table look-ups."""

    def __init__(self, buckets: int):
        if buckets & (buckets - 1):
            raise ValueError("buckets must be a power of two")
        self.buckets = buckets
        chars = [chr(i) for i in range(PLANE)]
        self.letter = np.fromiter((c.isalpha() for c in chars), bool, PLANE)
        lower = (c.lower() if c.isalpha() else c for c in chars)
        self.lower = np.fromiter((ord(w) if len(w) == 1 else i for i, w in enumerate(lower)), np.uint32, PLANE)
        self.starts = np.array([s for s, _ in SCRIPT_RANGES])
        self.script = np.array([SCRIPTS.index(name) for _, name in SCRIPT_RANGES])

    def read(self, texts: list[str]) -> dict[str, np.ndarray]:
        """trigram per letter; first (letter), size, script, doc, start, end (in its text) per word."""
        joined = "\n".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(points) and points.max() >= PLANE:
            low = np.minimum(points, PLANE - 1)
            letter, lower = self.letter[low], self.lower[low]
            far = np.flatnonzero(points >= PLANE)
            letter[far] = [chr(p).isalpha() for p in points[far].tolist()]
            lower[far] = points[far]
        else:
            letter, lower = self.letter[points], self.lower[points]
        lower = np.where(letter, lower, 0).astype(np.uint64)
        mixed, part = lower * np.uint64(0x9E3779B97F4A7C15), lower * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed[1:] ^= part[:-1]
        np.multiply(lower, np.uint64(0x165667B19E3779F9), out=part)
        mixed[:-1] ^= part[1:]
        del lower, part
        at = np.flatnonzero(letter)
        hashed = mixed[at]
        del mixed, letter
        hashed ^= hashed >> np.uint64(31)
        hashed *= np.uint64(0xD6E8FEB86659FD93)
        trigram = (hashed >> np.uint64(40)).astype(np.int64) & (self.buckets - 1)
        begins = np.ones(len(at), bool)
        begins[1:] = np.diff(at) > 1
        first = np.flatnonzero(begins)
        size = np.diff(np.append(first, len(at)))
        start = at[first]
        doc_starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]]).astype(np.int64)
        doc = np.searchsorted(doc_starts, start, "right") - 1
        script = self.script[np.searchsorted(self.starts, points[start], "right") - 1]
        start = start - doc_starts[doc]
        return {"trigram": trigram, "first": first, "size": size, "script": script, "doc": doc, "start": start, "end": start + size}


@dataclass
class Model:
    languages: list[str]
    buckets: int
    scores: np.ndarray  # language x bucket, log-probability
    uses: np.ndarray  # script x language
    penalty: float

    def label(self, words: dict[str, np.ndarray], docs: int) -> np.ndarray:
        """The language index of each word, by Viterbi over each document; documents advance together."""
        n, k = len(words["doc"]), len(self.languages)
        emit = np.empty((n, k), np.float32)
        for i in range(k):
            emit[:, i] = np.add.reduceat(self.scores[i][words["trigram"]], words["first"])
        emit[~self.uses[words["script"]]] -= 1e6
        counts = np.bincount(words["doc"], minlength=docs)
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        order = np.argsort(-counts, kind="stable")
        order = order[counts[order] > 0]
        first, length = starts[order], counts[order]
        active = np.searchsorted(-length, -np.arange(1, length[0] + 1), "right")
        back = np.empty((n, k), np.int8 if k < 128 else np.int32)
        own = np.arange(k, dtype=back.dtype)
        value = emit[first]
        for t in range(1, int(length[0])):
            m = active[t]
            at, now = first[:m] + t, value[:m]
            best = now.argmax(axis=1)
            floor = now[np.arange(m), best] - self.penalty
            stay = now >= floor[:, None]
            back[at] = np.where(stay, own, best[:, None])
            value[:m] = np.where(stay, now, floor[:, None]) + emit[at]
            value[:m] -= floor[:, None]
        labels = np.empty(n, back.dtype)
        labels[first + length - 1] = value.argmax(axis=1)
        for t in range(int(length[0]) - 1, 0, -1):
            at = first[: active[t]] + t
            labels[at - 1] = back[at, labels[at]]
        return labels


def learn(docs: DataFrame, label: Column, *, buckets: int = 1 << 16, penalty: float = 12.0, least_use: float = 0.001) -> Model:
    """A model from every row with a text and a label."""
    size = buckets + len(SCRIPTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, seen = Letters(buckets), {}
        for got in (some for whole in batches for some in cuts(whole, "text", RUN_BYTES)):
            by_label: dict[str, list[str]] = {}
            for name, text in zip(got["label"].to_pylist(), got["text"].to_pylist(), strict=True):
                by_label.setdefault(name, []).append(text)
            for name, texts in by_label.items():
                total = seen.setdefault(name, np.zeros(size, np.int64))
                for begin, end in runs(texts, RUN_CHARS):
                    words = letters.read(texts[begin:end])
                    total[:buckets] += np.bincount(words["trigram"], minlength=buckets)
                    total[buckets:] += np.bincount(words["script"], words["size"], len(SCRIPTS)).astype(np.int64)
        for name, total in seen.items():
            cells = np.flatnonzero(total)
            schema = pa.schema([("label", pa.string()), ("cell", pa.int32()), ("n", pa.int64())])
            yield batch(schema, label=[name] * len(cells), cell=cells.astype(np.int32), n=total[cells])

    given = docs.select(label.alias("label"), docs["text"].alias("text"))
    given = given.filter(F.col("label").isNotNull() & F.col("text").isNotNull())
    rows = given.mapInArrow(given_back(count), "label string, cell int, n long").groupBy("label", "cell").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["label"].unique(), key=str.encode)
    counts = np.zeros((len(languages), size))
    place = {name: i for i, name in enumerate(languages)}
    counts[rows["label"].map(place).to_numpy(int), rows["cell"].to_numpy(int)] = rows["n"]
    grams, scripts = counts[:, :buckets], counts[:, buckets:]
    scores = np.log((grams + 0.5) / (grams.sum(axis=1, keepdims=True) + 0.5 * buckets)).astype(np.float32)
    uses = (scripts >= least_use * np.maximum(scripts.sum(axis=1, keepdims=True), 1)).T & (scripts.T > 0)
    uses[~uses.any(axis=1)] = True
    return Model(languages, buckets, scores, uses, penalty)


def _tables(texts: list[str], letters: Letters, model: Model) -> Iterator[tuple[int, int, np.ndarray, dict, np.ndarray]]:
    """By run of texts: its range, letters by document and language, its words and their labels."""
    k = len(model.languages)
    for begin, end in runs(texts, RUN_CHARS):
        words = letters.read(texts[begin:end]) if k else {"doc": np.zeros(0, int)}
        share = np.zeros((end - begin, max(k, 1)))
        labels = np.zeros(0, int)
        if len(words["doc"]):
            labels = model.label(words, end - begin)
            cells = words["doc"] * k + labels
            share = np.bincount(cells, words["size"], (end - begin) * k).reshape(-1, k)
        yield begin, end, share, words, labels


def _decide(share: np.ndarray, model: Model) -> tuple[list[str], list[float]]:
    total, best = share.sum(axis=1), share.argmax(axis=1)
    names = [model.languages[b] if t else UNKNOWN for b, t in zip(best, total, strict=True)]
    return names, (share.max(axis=1) / np.maximum(total, 1)).tolist()


PREDICTED = "lang_pred string, score double"


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The ``keep`` columns, then lang_pred and score."""
    # A kept text isn't sent to the workers twice.
    read = "text" if "text" in keep else "_text"
    frame = docs.select(*keep) if read in keep else docs.select(*keep, text_of(docs).alias(read))
    schema = frame.drop("_text").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters(model.buckets)
        for got in (some for whole in batches for some in cuts(whole, read, RUN_BYTES)):
            texts = [t or "" for t in got[read].to_pylist()]
            names, scores = [], []
            for _, _, share, _, _ in _tables(texts, letters, model):
                some, likely = _decide(share, model)
                names += some
                scores += likely
            kept = got if read in keep else got.drop_columns([read])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*kept.schema.names, "lang_pred", "score"],
            )

    return frame.mapInArrow(given_back(score), schema)


def spans(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, start, end, lang: each text's spans of one language, in code points."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters(model.buckets)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])
        for got in (some for whole in batches for some in cuts(whole, "text", RUN_BYTES)):
            ids, texts = got["doc_id"].to_pylist(), got["text"].to_pylist()
            for begin, _, _, words, labels in _tables(texts, letters, model):
                if not len(labels):
                    continue
                new = np.ones(len(labels), bool)
                new[1:] = (labels[1:] != labels[:-1]) | (words["doc"][1:] != words["doc"][:-1])
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(labels)) - 1
                yield batch(
                    schema,
                    doc_id=[ids[begin + d] for d in words["doc"][first]],
                    start=words["start"][first],
                    end=words["end"][last],
                    lang=[model.languages[i] for i in labels[first]],
                )

    frame = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return frame.mapInArrow(given_back(cut), "doc_id long, start long, end long, lang string")


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that have a language, mixed ones too.

    Their columns stay; a null lang becomes the language found.
    """
    found = predict(docs, model, DOCUMENT_COLUMNS)
    kept = found.filter(F.col("lang_pred") != UNKNOWN)
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*DOCUMENT_COLUMNS)

"""N-gram language-model scores from log-frequency Bloom filters.

Training texts' words (A-Z lower-cased, white-space separated) and one end per text are counted, all of
them. Counts are quantised to levels that grow as the logarithm. A filter holds, for an n-gram of level
q, one item for each level from the lowest to q, so membership probes for one level after another until the first miss
read the level back. One filter holds words, another all bigrams seen twice or more, from level 2 on. They are
broadcast and probed by the scoring tasks:

    P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1))
    P(w | v) = (l(v) c(v w) / c(v) + (1 - l(v)) P(w)) / (1 + f(v)),  l(v) = a c(v) / (c(v) + K)

with N the sum of the counts as they are read. P(w) is alone where v is seen less than twice. c(v w) is the least count of its
level and c(v) the greatest of its own, so that the shares of a context add up to 1 at most; f(v) is the mass that
the bigram filter's false hits add to a context on average (its hashes grow with the logarithm of the vocabulary, to
keep that small). So P(. | v) adds up to 1 at most, but for luck with false hits. The weight a is, of ``WEIGHTS``, the one
that makes all training texts likeliest when each token's own occurrence is left out of the counts; it follows from the
counts alone. A filter has ``bits_per_probe`` bits for each bit it sets, up to ``max_bits``, so what is broadcast has a
bound; beyond that it holds only higher counts (the least level rises). Tokens that need a count it doesn't hold are
joined with the lower counts, quantised alike, so no count is dropped at any size.

The base score needs exact counts. Words with at least N / 2**20 occurrences, at most 2**20 of them, are
broadcast; the other words of each text are joined with the counts. Words are identified by
XXH64; at a billion distinct words the chance that any two meet is about 3 %. Of a billion bigrams, identified by 48 bits
and the levels of their words, some 2,000 share a key with another.

Null texts count as empty: one end. A null doc_id is neither held out nor learned from. Rows with one doc_id
are separate documents. Texts are read whole, in runs of bounded size. Of weights that make the texts equally likely the
first of ``WEIGHTS`` is taken. Without training texts every probability is 1. No rows give no rows. Other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch, give_back, given_back, slices, text_of
from tidemark.llm.importance import Spans
from tidemark.session import write_scratch

END = " "  # no word has white space
SEED = 42
RUN_BYTES = 1_000_000
GIVE_BACK = 4  # runs after which freed memory goes back
HELD_PAIRS = 600_000
HASHES = 5
WORD_HASHES = 8  # of the lowest level of words
RARE = 4.0  # K: contexts seen so often get half of the weight
SEGMENT_BITS = 1 << 18
SEGMENT_WORDS = SEGMENT_BITS // 64
WORD_BITS = 8  # of an item that one word of a segment takes at most
HEAVY = 1 << 20


def hashed(words: list[str] | pa.Array) -> np.ndarray:
    """XXH64 of each word, all at once."""
    array = words if isinstance(words, pa.Array) else pa.array(words, pa.string())
    offsets = np.frombuffer(array.buffers()[1], np.int32, len(array) + 1, 4 * array.offset).astype(np.int64)
    raw = array.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return Spans(data, offsets[:-1], np.diff(offsets)).xxhash64(SEED)


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x + np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def bigram(first: np.ndarray, second: np.ndarray, level: np.ndarray, level2: np.ndarray) -> np.ndarray:
    """A bigram's key: 48 bits of hash, and the levels of both words (0 for an open one) as they are read."""
    hashes = mixed(mixed(first, 1) ^ (second * np.uint64(0xC2B2AE3D27D4EB4F)), 2)
    packed = np.maximum(level, 0) << 8 | np.maximum(level2, 0)
    return hashes & ~np.uint64(0xFFFF) | packed.astype(np.uint64)


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of texts, A-Z lower-cased, one after another, and words per text."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    lists = pc.ascii_split_whitespace(trimmed)
    sizes = np.diff(lists.offsets.to_numpy())
    empty = pc.equal(pc.binary_length(trimmed), 0).to_numpy(zero_copy_only=False)
    words = lists.flatten()
    if empty.any():  # the empty text is one empty word
        words = words.filter(pc.greater(pc.binary_length(words), 0))
        sizes = np.where(empty, 0, sizes)
    return words, sizes.astype(np.int64)


def tokens(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Index of each token (END, the first, closes a text) into the distinct words, these, and tokens per text."""
    words, sizes = split(texts)
    encoded = words.dictionary_encode()
    ids = np.zeros(len(words) + len(sizes), np.int64)
    ids[np.arange(len(words)) + np.repeat(np.arange(len(sizes)), sizes)] = encoded.indices.to_numpy() + 1
    return ids, pa.concat_arrays([pa.array([END]), encoded.dictionary]), sizes + 1


# ---- the filter --------------------------------------------------------------------


def _steps() -> np.ndarray:
    """The least count of each level: 1, 2, 3, ... and then each a fifth more."""
    steps = [1]
    while steps[-1] < 1 << 60:
        steps.append(max(steps[-1] + 1, steps[-1] * 6 // 5))
    return np.array(steps, np.int64)


STEPS = _steps()
# By level, with 0 for none: the middle on the log scale, the least and the greatest count.
MIDDLES = np.append(0.0, np.sqrt(STEPS[:-1].astype(float) * (STEPS[1:] - 1)))
LEAST = np.append(0.0, STEPS[:-1].astype(float))
MOST = np.append(0.0, STEPS[1:].astype(float) - 1)


def levels(counts: np.ndarray) -> np.ndarray:
    """How many of STEPS a count reaches."""
    return np.searchsorted(STEPS, counts, "right")


def _marks(keys: np.ndarray, level: int, hashes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each n-gram's item for a level, words of its segment and the bits that are set in them."""
    parts = -(-hashes // WORD_BITS)
    for part in range(parts):
        item = mixed(keys, 100 + level + 1000 * part)
        bits = np.zeros(len(keys), np.uint64)
        for i in range(hashes * (part + 1) // parts - hashes * part // parts):
            bits |= np.uint64(1) << (item >> np.uint64(6 * i) & np.uint64(63))
        yield (item >> np.uint64(64 - SEGMENT_WORDS.bit_length() + 1)).astype(np.int64), bits


@dataclass
class LogFilter:
    """Segments of bits; an n-gram's items all lie in the segment that its hash names."""

    raw: bytes  # not an array, which is copied when it is unpickled
    least: int  # the lowest level held
    most: int
    first: int = HASHES  # hashes of the lowest level's items; the others have ``HASHES``
    whole: bool = True  # no count is below least

    @property
    def segments(self) -> np.ndarray:
        """Segment by word of 64 bits."""
        return np.frombuffer(self.raw, np.uint64).reshape(-1, SEGMENT_WORDS)

    def level(self, keys: np.ndarray) -> np.ndarray:
        """The level of each n-gram, 0 if not held: probes from the lowest until the first miss."""
        out = np.zeros(len(keys), np.int64)
        if not len(self.segments):
            return out
        flat = self.segments.reshape(-1)
        start = (mixed(keys, 7) % np.uint64(len(flat) // SEGMENT_WORDS)).astype(np.int64) * SEGMENT_WORDS
        alive = np.arange(len(keys))
        for level in range(self.least, self.most + 1):
            hit = np.arange(len(keys))
            for word, bits in _marks(keys, level, self.first if level == self.least else HASHES):
                word, bits = start[hit] + word[hit], bits[hit]
                hit = hit[flat[word] & bits == bits]
            alive, keys, start = alive[hit], keys[hit], start[hit]
            if not len(alive):
                break
            out[alive] = level
        return out

    def read(self, keys: np.ndarray) -> np.ndarray:
        """The level of each n-gram; ``OPEN`` where a count below the least level is possible."""
        level = self.level(keys)
        return level if self.whole else np.where(level, level, OPEN)

    def chance(self, hashes: int) -> float:
        """How often an item of so many hashes is found that isn't held."""
        if not len(self.segments):
            return 0.0
        filled = np.bitwise_count(self.segments) / 64
        parts = -(-hashes // WORD_BITS)
        return float((filled ** (hashes / parts)).mean() ** parts)


@dataclass
class Sizes:
    """N-grams, and the sum of their counts, by level."""

    types: dict[int, int]
    total: dict[int, int]


def build_filter(counts: DataFrame, bits_per_probe: float, max_bits: int, first: int) -> tuple[LogFilter, Sizes]:
    """A filter of columns key, n, each segment made by one task; and what the levels hold."""

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*_LEVELS, ("n", pa.int64())])
        for got in batches:
            yield batch(schema, key=got["key"], level=levels(got["n"].to_numpy()).astype(np.int32), n=got["n"])

    held = counts.select("key", "n").mapInArrow(given_back(quantise), "key long, level int, n long")
    found = held.groupBy("level").agg(F.count("*").alias("types"), F.sum("n").alias("total")).collect()
    sizes = Sizes({r["level"]: r["types"] for r in found}, {r["level"]: r["total"] for r in found})
    if not found:
        return LogFilter(b"", 1, 0), sizes
    lowest = least = min(sizes.types)
    most = max(sizes.types)

    def bits() -> float:
        return bits_per_probe * sum(n * (first + HASHES * (k - least)) for k, n in sizes.types.items() if k >= least)

    while bits() > max_bits:
        least += 1
    if least > most:
        return LogFilter(b"", least, most, first, False), sizes
    segments = max(1, math.ceil(bits() / SEGMENT_BITS))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), ("level", pa.int32()), ("segment", pa.int64())])
        for got in batches:
            keys = got["key"].to_numpy().astype(np.int64).view(np.uint64)
            yield batch(schema, key=got["key"], level=got["level"], segment=(mixed(keys, 7) % np.uint64(segments)).astype(np.int64))

    def fill(table: pa.Table) -> pa.Table:
        keys = table["key"].to_numpy().astype(np.int64).view(np.uint64)
        top = table["level"].to_numpy()
        words = np.zeros(SEGMENT_WORDS, np.uint64)
        for k in range(least, int(top.max()) + 1):
            for word, bits in _marks(keys[top >= k], k, first if k == least else HASHES):
                np.bitwise_or.at(words, word, bits)
        return pa.table({"segment": table["segment"].slice(0, 1), "bits": pa.array([words.tobytes()], pa.binary())})

    placed = held.filter(F.col("level") >= least).drop("n").mapInArrow(given_back(place), "key long, level int, segment long")
    made = placed.groupBy("segment").applyInArrow(fill, "segment long, bits binary")
    out = np.zeros((segments, SEGMENT_WORDS), np.uint64)
    # At most max_bits, see above.
    filled = made.toArrow()
    for segment, raw in zip(filled["segment"].to_pylist(), filled["bits"].to_pylist(), strict=True):
        out[segment] = np.frombuffer(raw, np.uint64)
    return LogFilter(out.tobytes(), least, most, first, least == lowest), sizes


OPEN = -1  # a level that only a join gives
NONE = -2  # of a token that ends no bigram

# ---- counting ----------------------------------------------------------------------

_COUNTS = pa.schema([("key", pa.int64()), ("n", pa.int64())])
_LEVELS = pa.schema([("key", pa.int64()), ("level", pa.int32())])
_OPEN_PAIRS = pa.schema([*_COUNTS, ("v", pa.int64()), ("w", pa.int64())])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for got in batches:
        for begin, end in slices(got["text"], 2 * RUN_BYTES):
            words, sizes = split(got["text"].slice(begin, end - begin))
            counted = words.value_counts()
            key = hashed(pa.concat_arrays([pa.array([END]), counted.field("values")]))
            yield batch(_COUNTS, key=key.view(np.int64), n=[len(sizes), *counted.field("counts").to_pylist()])


def word_counts(docs: DataFrame) -> DataFrame:
    """key, n of every word of a column ``text``, and of the end."""
    partial = docs.select(text_of(docs).alias("text")).mapInArrow(given_back(_count_words), "key long, n long")
    return partial.groupBy("key").agg(F.sum("n").alias("n"))


@dataclass
class Mix:
    """What turns levels into probabilities."""

    norm: float
    weight: float = 0.0
    false_hits: float = 0.0  # false bigrams that a context has on average
    raised: float = 0.0  # the share of bigrams that are read a level too high

    def share(self, first: np.ndarray) -> np.ndarray:
        """l(v) by the level of v."""
        return self.weight * MOST[first] / (MOST[first] + RARE)

    def extra(self, first: np.ndarray) -> np.ndarray:
        """f(v) by the level of v: a false hit has level 2, and no level is over half more than the one before."""
        return self.share(first) * (self.false_hits * LEAST[2] / np.maximum(MOST[first], 1) + self.raised / 2)

    def alone(self, word: np.ndarray) -> np.ndarray:
        return (MIDDLES[word] + 0.5) / self.norm

    def after(self, word: np.ndarray, first: np.ndarray, joint: np.ndarray) -> np.ndarray:
        """P(w | v) by the levels of w, of v (2 or more) and of both together."""
        most = MOST[first]
        kept = self.share(first)
        direct = np.minimum(LEAST[joint], most) / most
        return (kept * direct + (1 - kept) * self.alone(word)) / (1 + self.extra(first))


@dataclass
class Model:
    words: object  # broadcast LogFilter
    pairs: object  # broadcast LogFilter
    heavy: object  # broadcast (sorted keys, counts) of the most frequent words, exact
    counts: DataFrame  # key, n of every word
    bigrams: DataFrame  # key, n of every bigram seen twice or more
    train_tokens: int
    types: int
    mix: Mix


_OPEN = pa.list_(pa.struct([*((k, pa.int64()) for k in ("w", "v", "vw")), *((c, pa.int16()) for c in ("lw", "lv", "lvw"))]))
_OPEN_SQL = "array<struct<w: long, v: long, vw: long, lw: smallint, lv: smallint, lvw: smallint>>"


@dataclass
class Read:
    """Tokens and the levels that the filters give for them."""

    ids: np.ndarray  # of each token among keys
    keys: np.ndarray
    sizes: np.ndarray  # tokens per text
    before: np.ndarray  # the token before each
    level: np.ndarray  # by key
    on: np.ndarray  # tokens after one that may be seen twice
    joint: np.ndarray  # of each token with the one before; 0 if either is seen less than twice

    @property
    def open(self) -> np.ndarray:
        """Tokens with a level that only a join gives."""
        unsure = self.level[self.ids] == OPEN
        return unsure | (self.on & ((self.level[self.before] == OPEN) | (self.joint == OPEN)))

    def open_tokens(self) -> pa.ListArray:
        """The open tokens of each text; keys of known levels are null."""
        at = np.flatnonzero(self.open)
        w, v = self.ids[at], self.before[at]
        lw = self.level[w]
        lv = np.where(self.on[at], self.level[v], NONE)
        lvw = np.where(self.on[at], self.joint[at], 0)
        joint = bigram(self.keys[v], self.keys[w], self.level[v], lw)
        asked = zip((self.keys[w], self.keys[v], joint), (lw, lv, lvw), strict=True)
        keys = [pa.array(k.view(np.int64), mask=known != OPEN) for k, known in asked]
        known = [pa.array(x.astype(np.int16)) for x in (lw, lv, lvw)]
        made = pa.StructArray.from_arrays([*keys, *known], fields=list(_OPEN.value_type))
        ends = np.concatenate([[0], np.cumsum(self.sizes)])
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(at, ends).astype(np.int32)), made, type=_OPEN)


def _words_read(words: LogFilter, texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Tokens, keys, sizes, the token before each, levels by key, and tokens after one that may be seen twice."""
    ids, distinct, sizes = tokens(texts)
    keys = hashed(distinct)
    level = words.read(keys)
    follows = np.ones(len(ids), bool)
    follows[np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)] = False
    before = np.concatenate([[0], ids[:-1]])
    again = (level >= 2) | (level == OPEN)
    return ids, keys, sizes, before, level, follows & again[before]


def _distinct_pairs(ids: np.ndarray, keys: np.ndarray, before: np.ndarray, level: np.ndarray, on: np.ndarray) -> tuple:
    """Tokens that may end a bigram seen twice, the distinct bigrams as indices of both words, and which each is."""
    both = np.flatnonzero(on & ((level >= 2) | (level == OPEN))[ids])
    coded = pa.array(before[both] * len(keys) + ids[both]).dictionary_encode()
    code = coded.dictionary.to_numpy()
    return both, code // len(keys), code % len(keys), coded.indices.to_numpy()


def _read(words: LogFilter, pairs: LogFilter, texts: pa.Array) -> Read:
    ids, keys, sizes, before, level, on = _words_read(words, texts)
    both, first, second, which = _distinct_pairs(ids, keys, before, level, on)
    joint = np.zeros(len(ids), np.int64)
    joint[both] = pairs.read(bigram(keys[first], keys[second], level[first], level[second]))[which]
    return Read(ids, keys, sizes, before, level, on, joint)


def looked_up(tokens: DataFrame, model: Model) -> DataFrame:
    """Open tokens (rows with a column ``t``) with all levels: ``lw``, ``lv`` (``NONE`` without a bigram) and ``lvw``."""

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            yield batch(_LEVELS, key=got["key"], level=levels(got["n"].to_numpy()).astype(np.int32))

    def below(counts: DataFrame, least: int) -> DataFrame:
        return counts.filter(F.col("n") < int(STEPS[least - 1])).select("key", "n").mapInArrow(given_back(quantise), "key long, level int")

    out = tokens
    for key, c, counts, held in (("w", "lw", model.counts, model.words.value), ("v", "lv", model.counts, model.words.value), ("vw", "lvw", model.bigrams, model.pairs.value)):
        known = F.col(f"t.{c}").cast("int")
        if held.whole:
            out = out.withColumn(c, known)
            continue
        rest = below(counts, held.least).select(F.col("key").alias(f"key_{c}"), F.col("level").alias(f"level_{c}"))
        # What is known finds nothing; its keys are spread so that a frequent word's are not in one task.
        asked = F.when(known == OPEN, F.col(f"t.{key}")).otherwise(F.xxhash64("t", F.rand(SEED)))
        joined = out.withColumn(f"asked_{c}", asked).join(rest, F.col(f"asked_{c}") == F.col(f"key_{c}"), "left")
        found = F.when(known == OPEN, F.coalesce(f"level_{c}", F.lit(0))).otherwise(known)
        out = joined.withColumn(c, found).drop(f"asked_{c}", f"key_{c}", f"level_{c}")
    return out.drop("t")


def learn(docs: DataFrame, *, bits_per_probe: float = 2.0, max_bits: int = 1 << 30) -> Model:
    """A model of all texts of ``docs`` (doc_id, text)."""
    context = docs.sparkSession.sparkContext
    counts = write_scratch(word_counts(docs), "lm-words")
    total, types = counts.agg(F.sum("n"), F.count("*")).first()
    total = total or 0
    made, sizes = build_filter(counts, bits_per_probe, max_bits, WORD_HASHES)
    words = context.broadcast(made)
    heavy = counts.filter(F.col("n") >= max(1, -(-total // HEAVY))).toPandas().sort_values("key")
    exact = (heavy["key"].to_numpy(np.int64), heavy["n"].to_numpy(np.int64))

    # Where the filter doesn't know all levels, both words are kept to join them.
    schema = _COUNTS if made.whole else _OPEN_PAIRS

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list] = {f.name: [] for f in schema}
        held = 0

        def flush() -> pa.RecordBatch:
            key = np.concatenate([np.zeros(0, np.uint64), *seen["key"]])
            key, one, at = np.unique(key, return_index=True, return_inverse=True)
            n = np.bincount(at, np.concatenate([np.zeros(0), *seen["n"]]), len(key)).astype(np.int64)
            rest = {c: np.concatenate([np.zeros(0, np.int64), *seen[c]])[one] for c in schema.names[2:]}
            for kept in seen.values():
                kept.clear()
            return batch(schema, key=key.view(np.int64), n=n, **rest)

        for got in batches:
            for begin, end in slices(got["text"], RUN_BYTES):
                ids, keys, _, before, level, on = _words_read(words.value, got["text"].slice(begin, end - begin))
                _, first, second, which = _distinct_pairs(ids, keys, before, level, on)
                seen["key"].append(bigram(keys[first], keys[second], level[first], level[second]))
                seen["n"].append(np.bincount(which, minlength=len(first)))
                if "v" in seen:
                    seen["v"].append(keys[first].view(np.int64))
                    seen["w"].append(keys[second].view(np.int64))
                held += len(first)
                if held > HELD_PAIRS:
                    yield flush()
                    held = 0
                    give_back()
        yield flush()

    sql = ", ".join(f"{f.name} long" for f in schema)
    partial = docs.select(text_of(docs).alias("text")).mapInArrow(given_back(count_pairs), sql)
    kept = [F.max(c).alias(c) for c in schema.names[2:]]
    bigrams = partial.groupBy("key").agg(F.sum("n").alias("n"), *kept).filter("n >= 2")
    bigrams = write_scratch(bigrams, "lm-bigrams")
    again = sum(n for k, n in sizes.types.items() if k >= 2)
    held, _ = build_filter(bigrams, bits_per_probe, max_bits, _hashes(again, bits_per_probe))
    # Now and then the item of the next level is found by chance.
    up = made.chance(HASHES)
    read = (1 - up) * sum(up**i * np.append(MIDDLES[i:], np.repeat(MIDDLES[-1], i)) for i in range(20))
    norm = sum(n * read[k] for k, n in sizes.types.items()) + 0.5 * (types + 1)
    mix = Mix(norm, 0.0, held.chance(held.first) * again, held.chance(HASHES))
    if total:
        mix.weight = _tuned(counts, bigrams, sizes, norm)
    return Model(words, context.broadcast(held), context.broadcast(exact), counts, bigrams, total, types, mix)


def _hashes(types: int, bits_per_probe: float) -> int:
    """Hashes of an item of the lowest level, so that of ``types`` n-grams half of one is a false hit."""
    filled = 1 - math.exp(-1 / bits_per_probe)
    # Words of 64 bits are filled unevenly, which costs a hash.
    return min(max(HASHES, math.ceil(math.log(2 * max(types, 1)) / -math.log(filled)) + 1), 40)


WEIGHTS = [0.0, 0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]


def _tuned(counts: DataFrame, bigrams: DataFrame, sizes: Sizes, norm: float) -> float:
    """The bigram weight that makes the training texts likeliest, leaving each token out.

    All occurrences of a bigram have the same term, and it depends on three levels only. A token of a bigram seen once has
    log(1 - l(v)) and a rest that is the same for every weight; there are as many as the contexts' tokens that are left.
    """

    joined = "v" in bigrams.columns
    if joined:
        for c in ("v", "w"):
            of_word = counts.select(F.col("key").alias(c), F.col("n").alias(f"n_{c}"))
            bigrams = bigrams.join(of_word, c)

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("of", pa.int32()), ("level", pa.int32()), ("n", pa.int64())])
        for got in batches:
            of = got["key"].to_numpy() & 0xFFFF
            if joined:
                of = levels(got["n_v"].to_numpy()) << 8 | levels(got["n_w"].to_numpy())
            yield batch(schema, of=of.astype(np.int32), level=levels(got["n"].to_numpy()).astype(np.int32), n=got["n"])

    asked = ["key", "n", *(("n_v", "n_w") if joined else ())]
    levelled = bigrams.select(*asked).mapInArrow(given_back(quantise), "of int, level int, n long")
    # At most a row for every three levels.
    found = levelled.groupBy("of", "level").agg(F.sum("n").alias("n")).toPandas()
    of, level, n = (found[c].to_numpy(np.int64) for c in ("of", "level", "n"))
    first, second = of >> 8, of & 255
    (end,) = hashed([END]).view(np.int64).tolist()
    ends = counts.filter(F.col("key") == end).agg(F.sum("n")).first()[0] or 0
    left = np.zeros(len(MOST))
    for k, tokens_ in sizes.total.items():
        left[k] += tokens_
    left[levels(np.array([ends]))[0]] -= ends  # nothing comes after the end
    np.subtract.at(left, first, n)
    left = np.where((np.arange(len(left)) >= 2) & (left > 0), left, 0)
    direct = np.maximum(np.minimum(LEAST[level], MOST[first]) - 1, 0) / np.maximum(MOST[first] - 1, 1)
    alone = (np.maximum(MIDDLES[second] - 1, 0) + 0.5) / norm
    sums = []
    for a in WEIGHTS:
        kept = a * MOST / (MOST + RARE)
        mine = kept[first]
        sums.append(float((n * np.log(mine * direct + (1 - mine) * alone)).sum() + (left * np.log1p(-kept)).sum()))
    return WEIGHTS[int(np.argmax(sums))]


# ---- scoring -----------------------------------------------------------------------


def _log_probabilities(read: Read, mix: Mix, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each token's text, and by text the log10 probabilities of the tokens that are not open."""
    open_ = read.open
    p = mix.alone(np.maximum(read.level, 0))[read.ids]
    at = np.flatnonzero(read.on & ~open_)
    if mix.weight > 0 and len(at):
        p[at] = mix.after(read.level[read.ids[at]], read.level[read.before[at]], read.joint[at])
    doc = np.repeat(np.arange(n), read.sizes)
    return doc, np.bincount(doc, np.where(open_, 0.0, np.log10(np.minimum(p, 1.0))), n)


_SCORED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("text_hash", pa.int64()),
        ("n_tokens", pa.int64()),
        ("known", pa.int64()),
        ("logs", pa.float64()),
        ("score", pa.float64()),
        ("rare", pa.list_(pa.int64())),
        ("open", _OPEN),
    ]
)
_SCORED_SQL = "doc_id long, held_out boolean, text_hash long, n_tokens long, known long, logs double, score double, rare array<long>, "
_SCORED_SQL += f"open {_OPEN_SQL}"


def _closed(scored: DataFrame, model: Model) -> DataFrame:
    """The scores with the open tokens' log10 probabilities, from joined counts."""
    if model.words.value.whole and model.pairs.value.whole:
        return scored.drop("open")
    key = ["doc_id", "text_hash"]
    mix = model.mix

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("open_log", pa.float64())])
        for got in batches:
            word, first, joint = (got[c].to_numpy() for c in ("lw", "lv", "lvw"))
            p = mix.alone(word)
            at = np.flatnonzero(first >= 2)
            if mix.weight > 0:
                joint = np.where(word >= 2, joint, 0)
                p[at] = mix.after(word[at], first[at], joint[at])
            yield batch(schema, doc_id=got["doc_id"], text_hash=got["text_hash"], open_log=np.log10(np.minimum(p, 1.0)))

    looked = looked_up(scored.select(*key, F.explode("open").alias("t")), model)
    found = looked.mapInArrow(given_back(rate), "doc_id long, text_hash long, open_log double")
    copies = F.count("*").alias("copies")
    sums = found.groupBy(*key).agg(F.sum("open_log").alias("open_logs"))
    sums = sums.select(F.col("doc_id").alias("d_open"), F.col("text_hash").alias("h_open"), "open_logs")
    times = scored.filter(F.size("open") > 0).groupBy(*key).agg(copies).select(
        F.col("doc_id").alias("d_times"), F.col("text_hash").alias("h_times"), "copies"
    )
    sums = sums.join(times, F.col("d_open").eqNullSafe(F.col("d_times")) & (F.col("h_open") == F.col("h_times")))
    same = scored["doc_id"].eqNullSafe(F.col("d_open")) & (scored["text_hash"] == F.col("h_open"))
    whole = F.col("score") + F.coalesce(F.col("open_logs") / F.col("copies"), F.lit(0.0))
    out = scored.join(sums, same, "left").withColumn("score", whole)
    return out.select(*[scored[c] if c != "score" else out["score"] for c in scored.columns if c != "open"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of rows with doc_id, held_out, text."""
    words, pairs, heavy = model.words, model.pairs, model.heavy
    mix = model.mix

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy_keys, heavy_counts = heavy.value
        for got in batches:
            for run, (begin, end) in enumerate(slices(got["text"], RUN_BYTES)):
                if run % GIVE_BACK == GIVE_BACK - 1:
                    give_back()
                n = end - begin
                read = _read(words.value, pairs.value, got["text"].slice(begin, n))
                ids, keys = read.ids, read.keys
                doc, found = _log_probabilities(read, mix, n)
                signed = keys.view(np.int64)
                exact = np.zeros(len(keys), np.int64)
                if len(heavy_keys):
                    at = np.minimum(np.searchsorted(heavy_keys, signed), len(heavy_keys) - 1)
                    exact = np.where(heavy_keys[at] == signed, heavy_counts[at], 0)
                sure = exact[ids] > 0
                logs = np.bincount(doc[sure], np.log10(exact[ids[sure]] + 0.5), n)
                known = np.bincount(doc[sure], minlength=n)
                rare = np.split(signed[ids[~sure]], np.cumsum(np.bincount(doc[~sure], minlength=n))[:-1])
                yield batch(
                    _SCORED,
                    doc_id=got["doc_id"].slice(begin, n),
                    held_out=got["held_out"].slice(begin, n),
                    text_hash=got["text_hash"].slice(begin, n),
                    n_tokens=read.sizes,
                    known=known,
                    logs=logs,
                    score=found,
                    rare=rare,
                    open=read.open_tokens(),
                )
            give_back()

    text = text_of(docs)
    frame = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), "held_out", text.alias("text"), F.xxhash64(text).alias("text_hash")
    )
    scored = write_scratch(frame.mapInArrow(given_back(rate), _SCORED_SQL), "lm-scored")
    key = ["doc_id", "text_hash"]
    single = scored.select(*key, F.explode("rare").alias("key"))
    looked = single.join(model.counts, "key", "left")
    sums = looked.groupBy(*key).agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more_logs"),
        F.count("n").alias("more_known"),
    )
    copies = scored.filter(F.size("rare") > 0).groupBy(*key).agg(F.count("*").alias("copies"))
    sums = sums.join(copies, sums["doc_id"].eqNullSafe(copies["doc_id"]) & (sums["text_hash"] == copies["text_hash"])).select(
        sums["doc_id"].alias("d"),
        sums["text_hash"].alias("h"),
        (F.col("more_logs") / F.col("copies")).alias("more_logs"),
        (F.col("more_known") / F.col("copies")).cast("long").alias("more_known"),
    )
    scored = _closed(scored, model)
    same = scored["doc_id"].eqNullSafe(F.col("d")) & (scored["text_hash"] == F.col("h"))
    norm = math.log10(model.train_tokens + 0.5 * (model.types + 1))
    zero = F.lit(0)
    return scored.drop("rare").join(sums, same, "left").select(
        scored["doc_id"],
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * norm).alias("base_score"),
        "score",
    )

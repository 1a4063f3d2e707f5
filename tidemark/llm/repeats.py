"""Removal of byte strings that occurred before, by common-prefix intervals of suffix arrays.

Texts are read as UTF-8. Every byte covered by a string of ``length`` bytes that also starts earlier (in a smaller
doc_id, or in the same document further left) goes; the strings are those of the input, and none crosses documents.

1. Every string of ``length`` bytes holds an anchor: of its ``anchor``-byte strings, the one of least hash, which is
   the same wherever the string stands. An anchor's context reaches as far to both sides as a string that holds it
   can. Anchors are shuffled by their hash with a fingerprint of their context. All but the first anchor of a context
   are copies as a whole.
2. Where one anchor has several contexts, the first occurrence of each is read. The suffixes of these contexts
   with ``length`` bytes or more are sorted, with the lengths of neighbours' common prefixes (an enhanced suffix
   array), and one scan with a stack gives the tree of common-prefix intervals. An interval whose occurrences
   differ in the byte before them (or stand at an edge) can't be extended to the left: it is a maximal repeat group,
   given with all its occurrences. All but the earliest of a group are copies.
3. Of an anchor with more than ``WIDE`` contexts, only the roots of the tree are looked at, which are the strings of
   ``length`` bytes, at one distance from the anchor after another. This removes the same bytes (a group's span is
   that of its strings) with little memory. An anchor with more than ``group`` contexts is no longer one task's: its
   contexts are cut into those strings, and each is a group of its own.
4. The copies' spans of a document are joined, and taken out of its text.

Hot anchors: each run of texts passes on only its first occurrence of a context, the others are known to be copies
there. An anchor with ``HOT`` contexts in a run has several, so its rows are dealt by context, and one witness row
tells the rest. Contexts are told apart by 128 bits of hashes; groups compare bytes.

Null texts count as empty. Texts of less than ``length`` bytes stay whole, and keep their place. Very long texts are cut into overlapping
parts for step 1. Of rows with one doc_id, the one with the smaller text hash comes first; repeated rows are one
document that is returned as often. A null doc_id comes after all others, by text hash. No rows give no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch, give_back, given_back, per_worker, text_of
from tidemark.session import remove_scratch, write_scratch

PART_BYTES = 1_000_000
FLUSH = 300_000  # anchors that a run collects
HOT = 16
SORT_BYTES = 1_000_000
ROWS = 5_000
WIDE = 1_000
OFFSET_BITS = 32
ONCE, SEVERAL, WITNESS, LATER = range(4)  # what a row says of its anchor

U = np.uint64
FACTORS = (U(0x9E3779B97F4A7C15), U(0xD1342543DE82EF95))
SIGNS = np.random.default_rng(11).integers(1, 1 << 63, (2, 256), dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(29))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(32))


def _powers(which: int, size: int) -> list[np.ndarray]:
    """Powers of a factor, and of its inverse."""

    def make() -> list[np.ndarray]:
        made = []
        for factor in (int(FACTORS[which]), pow(int(FACTORS[which]), -1, 1 << 64)):
            power = np.full(size, U(factor))
            power[0] = 1
            made.append(np.cumprod(power))
        return made

    return per_worker(("powers", which), make) if size <= 1 << 21 else make()


class Rolled:
    """Hashes of any substrings of a buffer, from sums of its bytes times powers of a factor."""

    def __init__(self, data: np.ndarray, which: int):
        n = len(data) + 1
        known = _powers(which, max(1 << n.bit_length(), 1 << 21))
        self.inverse = known[1]
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(SIGNS[which][data] * known[0][: n - 1], out=self.sums[1:])

    def every(self, size: int) -> np.ndarray:
        """The hash of the ``size`` bytes from each place on."""
        sums = self.sums
        return mixed((sums[size:] - sums[:-size]) * self.inverse[: len(sums) - size])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.inverse[begin] + (end - begin).astype(np.uint64))


def _sliding(x: np.ndarray, size: int, pick: np.ufunc) -> np.ndarray:
    """The least or greatest of every ``size`` neighbours."""
    done = 1
    while done < size:
        step = min(done, size - done)
        x = pick(x[:-step], x[step:])
        done += step
    return x


@dataclass(frozen=True)
class Shape:
    length: int
    anchor: int

    @property
    def side(self) -> int:
        """How far a string that holds an anchor may reach beyond it."""
        return self.length - self.anchor

    def anchors(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, hashes and context fingerprints of the anchors of texts that end at ``ends`` in a buffer."""
        none = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        if len(data) < self.length:
            return none
        sizes = np.diff(ends, prepend=0)
        left = np.repeat(ends, sizes) - np.arange(len(data))  # bytes to the end of the text
        hashes = Rolled(data, 0).every(self.anchor) | U(1)
        # An anchor across texts is in no whole string of one, so it needs no care.
        least = _sliding(hashes, self.side + 1, np.minimum)
        least[left[: len(least)] < self.length] = 0
        pad = np.zeros(self.side, np.uint64)
        at = np.flatnonzero(_sliding(np.concatenate([pad, least, pad]), self.side + 1, np.maximum) == hashes)
        end = at + left[at]
        begin = end - sizes[np.searchsorted(ends, at, "right")]
        low, high = np.maximum(begin, at - self.side), np.minimum(end, at + self.length)
        prints = Rolled(data, 1).of(low, high) + (at - low).astype(np.uint64) * FACTORS[0]
        return at, hashes[at], prints


# ---- first occurrences ------------------------------------------------------------

_ROWS = pa.schema([("key", pa.int64()), ("print", pa.int64()), ("doc", pa.int64()), ("pos", pa.int64()), ("says", pa.int8())])
_ROWS_SQL = "key long, print long, doc long, pos long, says tinyint"


def collapsed(key: np.ndarray, prints: np.ndarray, doc: np.ndarray, pos: np.ndarray, hot: int) -> pa.RecordBatch:
    """The rows of a run, with what it knows of them: later copies, and keys with ``hot`` fingerprints or more."""
    order = np.lexsort((pos, doc, prints, key))
    key, prints, doc, pos = key[order], prints[order], doc[order], pos[order]
    new_key = np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]
    new_print = new_key | np.concatenate([[True], prints[1:] != prints[:-1]])[: len(key)]
    again = ~new_print & np.concatenate([[False], (doc[1:] == doc[:-1]) & (pos[1:] == pos[:-1])])[: len(key)]
    group = np.cumsum(new_key) - 1
    many = np.bincount(group, new_print, group[-1] + 1 if len(group) else 0) >= hot
    says = np.where(~new_print, LATER, np.where(many[group], SEVERAL, ONCE)).astype(np.int8)
    keep = np.flatnonzero(~again)
    witness = np.flatnonzero(new_key & many[group])
    rows = np.concatenate([keep, witness])
    return batch(
        _ROWS,
        key=key.view(np.int64)[rows],
        print=prints.view(np.int64)[rows],
        doc=doc[rows],
        pos=pos[rows],
        says=np.concatenate([says[keep], np.full(len(witness), WITNESS, np.int8)]),
    )


_FOUND = pa.schema([("doc", pa.int64()), ("pos", pa.int64()), ("key", pa.int64())])
_FOUND_SQL = "doc long, pos long, key long"


def sorted_out(rows: DataFrame) -> DataFrame:
    """doc, pos, key: later copies, with a null key, and the first of each context of keys that have several."""
    deal = F.when(F.col("says") == SEVERAL, F.xxhash64("key", "print")).when(F.col("says") == LATER, F.xxhash64("doc", "pos"))
    dealt = rows.repartition(deal.otherwise(F.col("key"))).sortWithinPartitions("key", "print", "doc", "pos", F.desc("says"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One pass over sorted rows. Of a key not yet seen with several contexts, its only first row waits."""
        last = None  # key, print, first doc, first pos
        several, waits = False, None
        for got in batches:
            key, prints, doc, pos, says = (got[f.name].to_numpy() for f in _ROWS)
            real = says <= SEVERAL
            later = says == LATER
            # Rows of later copies are done with; they may lie among others.
            out = [(doc[later], pos[later], np.zeros(int(later.sum()), np.int64), np.ones(int(later.sum()), bool))]
            on = np.flatnonzero(~later)
            if len(on):
                key, prints, doc, pos, says, real = (x[on] for x in (key, prints, doc, pos, says, real))
                same_key = np.concatenate([[last is not None and key[0] == last[0]], key[1:] == key[:-1]])
                group = np.cumsum(~same_key)  # 0 goes on from the batch before
                # A witness has its own key and print, but is no occurrence.
                first = np.zeros(len(on), bool)
                at = np.flatnonzero(real)
                if len(at):
                    k, p = key[at], prints[at]
                    goes_on = last is not None and last[1] is not None and k[0] == last[0] and p[0] == last[1]
                    first[at] = np.concatenate([[not goes_on], (k[1:] != k[:-1]) | (p[1:] != p[:-1])])
                n = int(group[-1]) + 1
                firsts = np.bincount(group, first, n)
                marked = np.bincount(group, says != ONCE, n) > 0
                multi = marked | (firsts >= 2)
                if same_key[0]:
                    multi[0] |= several or int(waits is not None) + firsts[0] >= 2
                    if multi[0] and waits is not None:
                        out.append(_one(waits))
                        waits = None
                ask = first & multi[group]
                # Of a context, rows at the first one's own place are repeated rows of the table.
                run = np.cumsum(first)
                start = np.flatnonzero(first)
                d0 = np.concatenate([[last[2] if last else -1], doc[start]])[run]
                p0 = np.concatenate([[last[3] if last else -1], pos[start]])[run]
                copy = real & ~first & ((doc != d0) | (pos != p0))
                out.append((doc[ask], pos[ask], key[ask], np.zeros(int(ask.sum()), bool)))
                out.append((doc[copy], pos[copy], key[copy], np.ones(int(copy.sum()), bool)))
                tail = group == group[-1]
                if group[-1] > 0:
                    waits = None  # of a key that ended
                several = bool(multi[-1])
                lone = np.flatnonzero(tail & first)
                if not several and len(lone):
                    waits = (doc[lone[-1]], pos[lone[-1]], key[lone[-1]])
                goes_on = bool(same_key[0]) and group[-1] == 0
                if len(start) and group[start[-1]] == group[-1]:
                    last = (key[-1], prints[start[-1]], doc[start[-1]], pos[start[-1]])
                elif not goes_on:
                    last = (key[-1], None, -1, -1)
            d, p, k, null = (np.concatenate(x) for x in zip(*out, strict=True))
            if len(d):
                yield batch(_FOUND, doc=d, pos=p, key=pa.array(k, mask=null))

    return dealt.mapInArrow(given_back(walk, "powers"), _FOUND_SQL)


def _one(row: tuple) -> tuple:
    doc, pos, key = row
    return np.array([doc]), np.array([pos]), np.array([key]), np.array([False])


# ---- the interval tree -------------------------------------------------------------


@dataclass
class Suffixes:
    """Sorted suffixes of contexts, ``begin`` to ``end`` in a buffer, with common prefixes of neighbours."""

    begin: np.ndarray
    end: np.ndarray
    before: np.ndarray  # the byte before each, or -1 at an edge
    order: np.ndarray  # where each stands among all, earliest first
    common: np.ndarray  # with the suffix above; 0 for other groups


def enhanced_suffix_array(
    data: np.ndarray, ends: np.ndarray, group: np.ndarray, doc: np.ndarray, pos: np.ndarray, length: int
) -> Suffixes:
    """Of contexts that end at ``ends`` in a buffer and start at (doc, pos), the suffixes that may begin a maximal repeat.

    Their string of ``length`` bytes repeats in the group, with more than one byte before it. Where one byte is before all, no
    interval with that string is maximal, and those of the suffixes one byte longer have the same occurrences.
    """
    begins = np.concatenate([[0], ends[:-1]])
    count = np.maximum(ends - begins - length + 1, 0)
    owner = np.repeat(np.arange(len(ends)), count)
    begin = begins[owner] + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    string = Rolled(data, 0).of(begin, begin + length) + mixed(group[owner].astype(np.uint64))
    before = np.where(begin > begins[owner], data[begin - 1].astype(np.int16), -1)
    order = np.argsort(string, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], string[order][1:] != string[order][:-1]])[: len(order)])
    times = np.diff(first, append=len(order))
    if len(first):
        low, high = (pick.reduceat(before[order], first) for pick in (np.minimum, np.maximum))
        keep = order[np.repeat((times >= 2) & ((low < 0) | (low != high)), times)]
    else:
        keep = order
    owner, begin = owner[keep], begin[keep]
    raw, end = data.tobytes(), ends[owner]
    numbers = group[owner]
    keys = [n.to_bytes(8, "big") + raw[a:b] for n, a, b in zip(numbers.tolist(), begin.tolist(), end.tolist(), strict=True)]
    sorted_ = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
    owner, begin, end = owner[sorted_], begin[sorted_], end[sorted_]
    place = pos[owner] + begin - begins[owner]
    # Contexts of one text may overlap, so that a place stands in several.
    by_place = np.lexsort((place, doc[owner]))
    at, of = place[by_place], doc[owner][by_place]
    order = np.empty(len(owner), np.int64)
    order[by_place] = np.cumsum(np.concatenate([[0], (at[1:] != at[:-1]) | (of[1:] != of[:-1])])[: len(owner)])
    before = np.where(begin > begins[owner], data[begin - 1].astype(np.int64), -1)
    common = np.zeros(len(owner), np.int64)
    if len(owner) > 1:
        common[1:] = _common_prefixes(data, begin[:-1], end[:-1], begin[1:], end[1:])
        common[1:][group[owner[1:]] != group[owner[:-1]]] = 0
    return Suffixes(begin, end, before, order, common)


def _common_prefixes(data: np.ndarray, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    lanes = np.ndarray((len(data) + 1,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    most = np.minimum(a_end - a, b_end - b)
    out = most.copy()
    on, done = np.arange(len(a)), 0
    while len(on):
        on = on[most[on] > done]
        differ = lanes[a[on] + done] ^ lanes[b[on] + done]
        hit = np.flatnonzero(differ)
        lowest = differ[hit] & (~differ[hit] + U(1))
        # The lowest differing bit, a power of two, names the byte.
        byte = np.log2(lowest.astype(np.float64)).astype(np.int64) // 8
        out[on[hit]] = np.minimum(done + byte, most[on[hit]])
        on, done = np.delete(on, hit), done + 8
    return out


def maximal_repeats(found: Suffixes, length: int) -> Iterator[tuple[int, int, int]]:
    """(common bytes, first, last) of the intervals of ``length`` bytes or more that can't be extended to the left.

    Children come before their parents. An interval's occurrences are the suffixes first to last.
    """
    n = len(found.begin)
    common = found.common.tolist() + [0]
    before = found.before.tolist()
    stack: list[list[int]] = []  # common, first, byte before all or -1
    for i in range(1, n + 1):
        now = common[i] if common[i] >= length else 0
        first, byte = i - 1, before[i - 1]
        while stack and stack[-1][0] > now:
            size, first, other = stack.pop()
            byte = byte if byte == other else -1
            if byte < 0:
                yield size, first, i - 1
        if now and stack and stack[-1][0] == now:
            stack[-1][2] = byte if byte == stack[-1][2] else -1
        elif now:
            stack.append([now, first, byte])


def later_occurrences(found: Suffixes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that are not the earliest of a maximal repeat group, with the bytes of the largest such."""
    size = np.zeros(len(found.begin), np.int64)
    for common, first, last in maximal_repeats(found, length):
        order, done = found.order[first : last + 1], size[first : last + 1]
        done[(done == 0) & (order > order.min())] = common
    at = np.flatnonzero(size)
    return at, size[at]


# ---- over tables -------------------------------------------------------------------

_SPANS = pa.schema([("doc", pa.int64()), ("pos", pa.int64()), ("size", pa.int64())])
_SPANS_SQL = "doc long, pos long, size long"


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, doc, hash, n_bytes and the compressed bytes of each row; (doc, hash) orders and names documents."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("doc", pa.int64()), ("hash", pa.int64()), ("n_bytes", pa.int64()), ("raw", pa.binary())]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for got in batches:
            texts = got["text"].cast(pa.binary()).to_pylist()
            yield batch(
                schema,
                **{name: got[name] for name in ("doc_id", "doc", "hash")},
                n_bytes=[len(t) for t in texts],
                raw=[codec.compress(t, asbytes=True) if t else b"" for t in texts],
            )

    return _keyed(docs).mapInArrow(given_back(pack, "powers"), "doc_id long, doc long, hash long, n_bytes long, raw binary")


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_of(docs)
    full = F.xxhash64(text)
    doc_id = docs["doc_id"].cast("long")
    last = F.lit(1 << 62) + full.bitwiseAND(F.lit((1 << 62) - 1))
    hash_ = F.shiftrightunsigned(full, 33)
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, last).alias("doc"), hash_.alias("hash"), text.alias("text"))


def _unpacked(got: pa.RecordBatch) -> Iterator[bytes]:
    codec = pa.Codec("zstd")
    for size, raw in zip(got["n_bytes"].to_pylist(), got["raw"].to_pylist(), strict=True):
        yield codec.decompress(raw, size, asbytes=True) if size else b""


def anchor_rows(docs: DataFrame, shape: Shape, hot: int) -> DataFrame:
    """The anchors of all texts: see ``_ROWS``; pos is the text hash and the byte offset."""
    margin = 2 * shape.length

    def parts(texts: list[bytes]) -> Iterator[tuple[int, int, bytes, int, int]]:
        """(text, offset, bytes, first and end of the strings to look at) of parts of at most about ``PART_BYTES``."""
        for i, text in enumerate(texts):
            for begin in range(0, max(len(text), 1), PART_BYTES):
                low, high = max(0, begin - margin), min(len(text), begin + PART_BYTES + margin)
                yield i, low, text[low:high], begin - low, high == len(text)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, ...]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            rows = [np.concatenate(x) for x in zip(*kept, strict=True)]
            kept.clear()
            return collapsed(rows[0], rows[1], rows[2], rows[3], hot)

        def work(some: list, doc: np.ndarray, hash_: np.ndarray) -> None:
            data = np.frombuffer(b"".join(p[2] for p in some), np.uint8)
            sizes = np.array([len(p[2]) for p in some], np.int64)
            ends = np.cumsum(sizes)
            at, keys, prints = shape.anchors(data, ends)
            part = np.searchsorted(ends, at, "right")
            inside = at - (ends - sizes)[part]
            text = np.array([p[0] for p in some])[part]
            # Anchors near a cut are found whole in the neighbouring part, too.
            low = np.array([p[3] and shape.length for p in some])[part]
            high = np.array([len(p[2]) + 1 if p[4] else len(p[2]) - shape.length for p in some])[part]
            ok = (inside >= low) & (inside < high)
            offset = inside + np.array([p[1] for p in some])[part]
            pos = (hash_[text] << OFFSET_BITS) | offset
            kept.append((keys[ok], prints[ok], doc[text][ok], pos[ok]))

        for got in batches:
            texts = got["text"].cast(pa.binary()).to_pylist()
            doc, hash_ = got["doc"].to_numpy(), got["hash"].to_numpy()
            some, size = [], 0
            for p in parts(texts):
                some.append(p)
                size += len(p[2])
                if size >= PART_BYTES:
                    work(some, doc, hash_)
                    some, size = [], 0
            if some:
                work(some, doc, hash_)
            held = sum(len(k[0]) for k in kept)
            if held >= FLUSH:
                yield flush()
                give_back()
        if kept:
            yield flush()

    return _keyed(docs).select("doc", "hash", "text").mapInArrow(given_back(find, "powers"), _ROWS_SQL)


def contexts(docs: DataFrame, asked: DataFrame, shape: Shape, group: int) -> DataFrame:
    """doc, pos, key, print, at, bytes of the contexts of anchors (doc, pos, key); ``at`` is the anchor's place in it.

    Contexts of keys with more than ``group`` are cut into their strings: two hashes as key and print, no bytes.
    """
    schema = pa.schema([(n, pa.int64()) for n in ("doc", "pos", "key", "print", "at")] + [("bytes", pa.binary())])
    large = asked.groupBy(F.col("key").alias("_key")).agg(F.count("*").alias("_n")).filter(F.col("_n") > group)
    known = asked.join(large, F.col("key") == F.col("_key"), "left")
    offset = F.col("pos").bitwiseAND(F.lit((1 << OFFSET_BITS) - 1))
    wanted = F.struct(offset.alias("offset"), F.col("key"), F.col("_n").isNotNull().alias("cut"))
    lists = known.groupBy(F.col("doc").alias("_doc"), F.shiftright("pos", OFFSET_BITS).alias("_hash")).agg(
        F.collect_list(wanted).alias("wanted")
    )
    texts = packed(docs)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        out: dict[str, list] = {f.name: [] for f in schema}
        for got in batches:
            wanted = got["wanted"]
            ends = np.cumsum(wanted.value_lengths().to_numpy())
            offset, key, cut = (wanted.flatten().field(n).to_pylist() for n in ("offset", "key", "cut"))
            rows = zip(got["doc"].to_pylist(), got["hash"].to_pylist(), [0, *ends.tolist()], ends.tolist(), _unpacked(got), strict=False)
            for doc, hash_, first, last, text in rows:
                for i in range(first, last):
                    begin, end = max(0, offset[i] - shape.side), min(len(text), offset[i] + shape.length)
                    if end - begin < shape.length:
                        continue
                    pos = hash_ << OFFSET_BITS | begin
                    if not cut[i]:
                        made = [(pos, key[i], None, offset[i] - begin, text[begin:end])]
                    else:
                        strings = [text[b : b + shape.length] for b in range(begin, end - shape.length + 1)]
                        hashes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, strings)), "<i8").reshape(-1, 2)
                        made = [(pos + b, k, p, None, None) for b, (k, p) in enumerate(hashes.tolist())]
                    for row in made:
                        for name, value in zip(out, (doc, *row), strict=True):
                            out[name].append(value)
                if len(out["doc"]) >= ROWS:
                    yield batch(schema, **out)
                    out = {f.name: [] for f in schema}
        yield batch(schema, **out)

    joined = texts.join(lists, (F.col("doc") == F.col("_doc")) & (F.col("hash") == F.col("_hash")))
    return joined.select("doc", "hash", "n_bytes", "raw", "wanted").mapInArrow(
        given_back(read, "powers"), "doc long, pos long, key long, print long, at long, bytes binary"
    )


def later_strings(
    data: np.ndarray, ends: np.ndarray, at: np.ndarray, doc: np.ndarray, pos: np.ndarray, shape: Shape
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Contexts of one anchor, and places in them, of strings of ``length`` bytes that are not the earliest such.

    ``at`` is where the anchor stands in each. Equal strings have it at one place in them, so each place is apart.
    """
    begins = np.concatenate([[0], ends[:-1]])
    rolled = Rolled(data, 0)
    for left in range(shape.side + 1):
        begin = begins + at - left
        on = np.flatnonzero((at >= left) & (begin + shape.length <= ends))
        begin = begin[on]
        _, which, times = np.unique(rolled.of(begin, begin + shape.length), return_inverse=True, return_counts=True)
        on, begin = on[times[which] >= 2], begin[times[which] >= 2]
        if not len(on):
            continue
        strings = np.ascontiguousarray(data[begin[:, None] + np.arange(shape.length)]).view(f"V{shape.length}").ravel()
        _, which = np.unique(strings, return_inverse=True)
        place = pos[on] + at[on] - left
        order = np.lexsort((place, doc[on], which))
        new = np.concatenate([[True], which[order][1:] != which[order][:-1]])
        first = order[new][np.cumsum(new) - 1]
        later = order[(doc[on][order] != doc[on][first]) | (place[order] != place[first])]
        yield on[later], at[on[later]] - left


def repeated_in_groups(found: DataFrame, shape: Shape) -> DataFrame:
    """doc, pos, size of the later occurrences of repeats among contexts (doc, pos, key, at, bytes) of one key."""

    def scan(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        key = table["key"].to_numpy()
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        wide = [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if b - a > WIDE]
        narrow = np.ones(len(key), bool)
        for a, b in wide:
            narrow[a:b] = False
        out = [several(table.filter(pa.array(narrow)))] + [one(table.slice(a, b - a)) for a, b in wide]
        doc, pos, size = (np.concatenate(x) for x in zip(*out, strict=True))
        return batch(_SPANS, doc=doc, pos=pos, size=size)

    def opened(table: pa.Table) -> tuple[np.ndarray, ...]:
        raw = table["bytes"].to_pylist()
        ends = np.cumsum(np.array([len(b) for b in raw], np.int64))
        return np.frombuffer(b"".join(raw), np.uint8), ends, table["doc"].to_numpy(), table["pos"].to_numpy()

    def several(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of many keys with few contexts each."""
        data, ends, doc, pos = opened(table)
        key = table["key"].to_numpy()
        group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))[: len(key)]
        array = enhanced_suffix_array(data, ends, group, doc, pos, shape.length)
        at, size = later_occurrences(array, shape.length)
        owner = np.searchsorted(ends, array.begin[at], "right")
        inside = array.begin[at] - np.concatenate([[0], ends])[owner]
        return doc[owner], pos[owner] + inside, size

    def one(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of one key with many contexts. Strings that go on from the last one share its span."""
        data, ends, doc, pos = opened(table)
        covered = np.zeros((len(doc), shape.side + 1), bool)
        for rows, places in later_strings(data, ends, table["at"].to_numpy(), doc, pos, shape):
            covered[rows, places] = True
        edge = np.zeros((len(doc), 1), bool)
        row, begin = np.nonzero(covered & ~np.hstack([edge, covered[:, :-1]]))
        _, last = np.nonzero(covered & ~np.hstack([covered[:, 1:], edge]))
        return doc[row], pos[row] + begin, last - begin + shape.length

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for got in batches:
            key = got["key"].to_numpy()
            begin = 0
            cuts = (np.flatnonzero(key[1:] != key[:-1]) + 1).tolist()
            if held and held[-1]["key"][-1].as_py() != key[0]:
                cuts.insert(0, 0)
            for cut in cuts:  # groups are whole up to here
                if size + (cut - begin) * shape.length >= SORT_BYTES:
                    yield scan([*held, got.slice(begin, cut - begin)])
                    held, size, begin = [], 0, cut
            held.append(got.slice(begin))
            size += (len(key) - begin) * shape.length
        if held:
            yield scan(held)

    dealt = found.select("key", "doc", "pos", "at", "bytes").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(given_back(walk, "powers"), _SPANS_SQL)


def removed(docs: DataFrame, *, length: int = 100, anchor: int = 32, group: int = 200_000, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay) of every row of ``docs`` (doc_id, text)."""
    shape = Shape(length, anchor)
    found = write_scratch(sorted_out(anchor_rows(docs, shape, hot)), "repeats-anchors")
    # A copy's whole context is one; the text may end before it does.
    offset = F.col("pos").bitwiseAND(F.lit((1 << OFFSET_BITS) - 1))
    begin = F.greatest(F.lit(0), offset - shape.side)
    copies = found.filter("key is null").select(
        "doc", (F.col("pos") - offset + begin).alias("pos"), (offset + length - begin).alias("size")
    )
    read = write_scratch(contexts(docs, found.filter("key is not null"), shape, group), "repeats-contexts")
    groups = repeated_in_groups(read.filter("bytes is not null"), shape)

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            key, prints, doc, pos = (got[n].to_numpy() for n in ("key", "print", "doc", "pos"))
            yield collapsed(key.view(np.uint64), prints.view(np.uint64), doc, pos, len(key) + 1)

    strings = read.filter("bytes is null").select("key", "print", "doc", "pos").mapInArrow(given_back(collapse, "powers"), _ROWS_SQL)
    cut = sorted_out(strings).filter("key is null").select("doc", "pos", F.lit(length).cast("long").alias("size"))
    spans = copies.unionByName(groups).unionByName(cut)
    begin = F.col("pos").bitwiseAND(F.lit((1 << OFFSET_BITS) - 1))
    span = F.struct(begin.alias("begin"), (begin + F.col("size")).alias("end"))
    lists = spans.groupBy(F.col("doc").alias("_doc"), F.shiftright("pos", OFFSET_BITS).alias("_hash")).agg(
        F.collect_list(span).alias("spans")
    )
    lists = write_scratch(lists, "repeats-spans")
    remove_scratch(found, read)
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "n_bytes", "n_removed", "n_spans")] + [("kept", pa.binary())])

    def take_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {f.name: [] for f in schema}
        held = 0
        for got in batches:
            spans = got["spans"]
            ends = np.cumsum(pc.fill_null(spans.value_lengths(), 0).to_numpy()).tolist()
            begin, end = (spans.flatten().field(n).to_numpy() for n in ("begin", "end"))
            for doc_id, first, last, text in zip(got["doc_id"].to_pylist(), [0, *ends], ends, _unpacked(got), strict=False):
                merged = joined_spans(begin[first:last], end[first:last], len(text), length)
                edges = [0, *(e for span in merged for e in span), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                for name, value in zip(out, (doc_id, len(text), len(text) - len(kept), len(merged), kept), strict=True):
                    out[name].append(value)
                held += len(kept)
                if held >= PART_BYTES:
                    yield batch(schema, **out)
                    out, held = {f.name: [] for f in schema}, 0
        yield batch(schema, **out)

    same = (F.col("doc") == F.col("_doc")) & (F.col("hash") == F.col("_hash"))
    joined = packed(docs).join(lists, same, "left").select("doc_id", "n_bytes", "raw", "spans")
    return joined.mapInArrow(given_back(take_out, "powers"), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def joined_spans(begin: np.ndarray, end: np.ndarray, size: int, length: int) -> list[tuple[int, int]]:
    """Maximal runs of the spans, each cut at the text's ``size``; those left with less than ``length`` are none."""
    end = np.minimum(end, size)
    ok = end - begin >= length
    begin, end = begin[ok], end[ok]
    if not len(begin):
        return []
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], begin[1:] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(begin) - 1]])
    return list(zip(begin[new].tolist(), reach[last].tolist(), strict=True))


def digests(rows: DataFrame) -> DataFrame:
    """The rows of :func:`removed` with kept_sha256 in place of the bytes."""
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

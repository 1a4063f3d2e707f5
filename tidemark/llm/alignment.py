"""Alignment of two tokenizers' tokens over a corpus, each distinct text tokenised and aligned once.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B (pieces that mark word starts) the text,
to which it adds the space itself; neither adds special tokens, and strings of special tokens in a text are plain
text. Offsets where tokens of both end cut the tokens into groups; tokens whose byte ranges overlap are linked. A
pair of ids counts as often as the corpus links it.

Rows are shuffled by their full text, so that equal texts meet and are tokenised once, with the number of their
copies; the links found are written down, and later steps read those. Pair counts weight each text's links
by its copies. The most frequent pairs, at most ``held_pairs``, are broadcast and looked up in place, the
other links are joined with their counts. Measures then go to all rows by the SHA-256 of their text.

Texts are cut before single spaces between two signs that are not white space. There neither tokenizer has a token
that goes on, so that the pieces are tokenised apart and distinct ones once per run.

Null and empty texts, and those whose joined bytes of A or B differ from space and text, have no tokens: zeros,
and an empty groups_sha256. Very long texts are read whole, in a run of their own. Ties for a B id's highest
count all count as best. Repeated rows and a null doc_id give a row each; copies count. No rows give no rows. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch, give_back, given_back, per_worker, slices
from tidemark.session import remove_scratch, scratch_path, write_scratch

RUN_BYTES = 2_000_000
KNOWN_PIECES = 200_000
BLOCK = 200
LONG_PIECE = 64
# U+180E was white space in old versions of Unicode.
INNER = re.compile(r"[^\s\u180e]")
CUT = re.compile(r" (?<=[^\s\u180e] )(?=[^\s\u180e])")
SPACE_SIGN = "▁"


def byte_signs() -> dict[str, int]:
    """The byte of each sign in entries of a byte-level vocabulary.

    Visible Latin-1 signs stand for their own byte, the signs from U+0100 on for the others in order.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(other)}


def piece_bytes(piece: str) -> bytes:
    """The bytes that a piece of tokenizer B stands for."""
    if re.fullmatch("<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(SPACE_SIGN, " ").encode()


class Aligner:
    """Token groups and links of texts."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_model)
        signs = byte_signs()
        self.size_a, self.size_b = self.a.get_vocab_size(), self.b.get_piece_size()
        self.bytes_a = [b""] * self.size_a
        for entry, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(signs[s] for s in entry) if all(s in signs for s in entry) else entry.encode()
        self.bytes_b = [piece_bytes(self.b.id_to_piece(i)) for i in range(self.size_b)]
        self.width_a = np.array([len(b) for b in self.bytes_a], np.int64)
        self.width_b = np.array([len(b) for b in self.bytes_b], np.int64)
        self.kind = np.int32 if self.size_a * self.size_b < 1 << 31 else np.int64
        self.known: dict[str, tuple | None] = {}

    def _same(self, raw: bytes, a: list[int], b: list[int]) -> bool:
        return b"".join(map(self.bytes_a.__getitem__, a)) == raw and b"".join(map(self.bytes_b.__getitem__, b)) == raw

    def _encoded(self, blocks: list[list[str]]) -> Iterator[tuple[list[str], list[int], list[int]]]:
        """Blocks of pieces with the tokens of each, encoded as one text; without those that differ from their tokens."""
        joined = [" ".join(b) for b in blocks]
        spaced = [" " + t for t in joined]
        all_a = self.a.encode_batch_fast(spaced, add_special_tokens=False)
        all_b = self.b.encode(joined, num_threads=1)
        for block, text, a, b in zip(blocks, spaced, all_a, all_b, strict=True):
            if self._same(text.encode(), a.ids, b):
                yield block, a.ids, b
            elif len(block) > 1:
                yield from self._encoded([[p] for p in block])

    def __call__(self, pieces: list[str]) -> dict[str, tuple]:
        """(A tokens, B tokens, groups, codes of links, groups as text) of each that has tokens.

        A link's code is its A id times the size of B's vocabulary, plus its B id.
        """
        inner = [p for p in pieces if INNER.match(p[0]) and INNER.match(p[-1])]
        blocks = [inner[i : i + BLOCK] for i in range(0, len(inner), BLOCK)]
        blocks += [[p] for p in pieces if not (INNER.match(p[0]) and INNER.match(p[-1]))]
        done = list(self._encoded(blocks))
        if not done:
            return {}
        good = [p for block, _, _ in done for p in block]
        a = np.fromiter(chain.from_iterable(ids for _, ids, _ in done), np.int64)
        b = np.fromiter(chain.from_iterable(ids for _, _, ids in done), np.int64)
        # Both cover the same bytes, so places run on over all pieces.
        last = np.cumsum([len(p.encode()) + 1 for p in good])
        end_a, end_b = np.cumsum(self.width_a[a]), np.cumsum(self.width_b[b])
        begin_a, begin_b = end_a - self.width_a[a], end_b - self.width_b[b]
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        low = np.searchsorted(end_b, begin_a, "right")
        links = np.searchsorted(begin_b, end_a, "left") - low
        linked_a = np.repeat(np.arange(len(a)), links)
        linked_b = np.repeat(low - (np.cumsum(links) - links), links) + np.arange(int(links.sum()))
        codes = (a[linked_a] * self.size_b + b[linked_b]).astype(self.kind)
        last_a, last_b = np.searchsorted(end_a, last, "right"), np.searchsorted(end_b, last, "right")
        # A group's A tokens, then its B tokens, each with the sign before it.
        group = np.concatenate([np.searchsorted(common, end_a), np.searchsorted(common, end_b)])
        is_b = np.arange(len(group)) >= len(a)
        order = np.argsort(2 * group + is_b, kind="stable")
        group, is_b = group[order], is_b[order]
        begins = np.concatenate([[True], group[1:] != group[:-1]])
        begins_b = is_b & np.concatenate([[False], ~is_b[:-1]])
        sign = np.where(begins, ";", np.where(begins_b, "|", ","))
        written = list(map(str.__add__, sign.tolist(), map(str, np.concatenate([a, b])[order].tolist())))
        raw, width = codes.tobytes(), codes.itemsize
        ends = [last_a, last_b, np.searchsorted(common, last, "right"), np.cumsum(links)[last_a - 1] * width]
        n_a, n_b, groups = (np.diff(e, prepend=0).tolist() for e in ends[:3])
        cuts = [0, *ends[3].tolist()]
        tokens = [0, *(last_a + last_b).tolist()]
        return {
            p: (x, y, g, raw[cuts[i] : cuts[i + 1]], "".join(written[tokens[i] : tokens[i + 1]])[1:])
            for i, (p, x, y, g) in enumerate(zip(good, n_a, n_b, groups, strict=True))
        }

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.ListArray, list[str]]:
        """A tokens, B tokens, groups, codes of links and groups_sha256 of each text."""
        cut = [CUT.split(t) for t in texts.to_pylist()]
        sizes = np.array([len(c) for c in cut], np.int64)
        coded = pa.array(list(chain.from_iterable(cut)), pa.large_string()).dictionary_encode()
        distinct, which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        found = [self.known.get(p, ()) for p in distinct]
        new = [i for i, f in enumerate(found) if f == ()]
        for begin in range(0, len(new), 20_000):
            some = new[begin : begin + 20_000]
            made = self([distinct[i] for i in some])
            for i in some:
                piece = distinct[i]
                found[i] = made.get(piece)
                if len(self.known) < KNOWN_PIECES and len(piece) <= LONG_PIECE:
                    self.known[piece] = found[i]
        bad = np.array([f is None for f in found])[which]
        text = np.repeat(np.arange(len(cut)), sizes)
        off = np.zeros(len(cut), bool)
        off[text[bad]] = True  # a text with one such piece has no tokens
        keep = ~off[text]
        which, sizes = which[keep], np.where(off, 0, sizes)
        filled = [f or (0, 0, 0, b"", "") for f in found]
        ends = np.concatenate([[0], np.cumsum(sizes)])

        def added(of_piece: np.ndarray) -> np.ndarray:
            run = np.concatenate([[0], np.cumsum(of_piece[which])])[ends]
            return np.diff(run)

        n_a, n_b, groups = (added(np.array([f[k] for f in filled], np.int64)) for k in range(3))
        width = np.dtype(self.kind).itemsize
        links = np.array([len(f[3]) // width for f in filled], np.int64)
        pool = np.frombuffer(b"".join(f[3] for f in filled), self.kind)
        begins = np.cumsum(links) - links
        run = links[which]
        run_ends = np.concatenate([[0], np.cumsum(run)])
        codes = pool[np.repeat(begins[which] - run_ends[:-1], run) + np.arange(int(run_ends[-1]))]
        written = [f[4] for f in filled]
        at, hashes = which.tolist(), []
        for begin, end in zip(ends.tolist(), ends[1:].tolist(), strict=False):
            joined = ";".join([written[i] for i in at[begin:end]])
            hashes.append(hashlib.sha256(joined.encode()).hexdigest() if end > begin else "")
        lists = pa.ListArray.from_arrays(pa.array(run_ends[ends].astype(np.int32)), pa.array(codes))
        return n_a, n_b, groups, lists, hashes


def aligned(docs: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, int]:
    """text_key, copies, n_a, n_b, n_groups, groups_sha256 and links of each distinct text; size of B's vocabulary."""
    with open(a_path, encoding="utf-8") as f:
        a_json = f.read()
    with open(b_path, "rb") as f:
        b_model = f.read()
    here = Aligner(a_json, b_model)
    link = pa.from_numpy_dtype(np.dtype(here.kind))
    schema = pa.schema(
        [
            ("text_key", pa.binary()),
            ("copies", pa.int64()),
            *((name, pa.int64()) for name in ("n_a", "n_b", "n_groups")),
            ("groups_sha256", pa.string()),
            ("links", pa.list_(link)),
        ]
    )
    sql = "text_key binary, copies long, n_a long, n_b long, n_groups long, groups_sha256 string, "
    sql += f"links array<{'int' if link == pa.int32() else 'long'}>"
    named = hashlib.sha256(a_json.encode() + b_model).hexdigest()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = per_worker(("aligner", named), lambda: Aligner(a_json, b_model))
        for got in batches:
            for begin, end in slices(got["text"], RUN_BYTES):
                some = got.slice(begin, end - begin)
                n_a, n_b, groups, links, hashes = tokens.texts(some["text"])
                yield batch(
                    schema,
                    text_key=some["text_key"],
                    copies=some["copies"],
                    n_a=n_a,
                    n_b=n_b,
                    n_groups=groups,
                    groups_sha256=hashes,
                    links=links,
                )
            give_back()

    distinct = docs.filter(docs["text"] != "").groupBy(docs["text"].alias("text")).agg(F.count("*").alias("copies"))
    keyed = distinct.select(text_key("text"), "copies", "text")
    path = scratch_path(docs.sparkSession, "alignment-links")
    # Long columns of small numbers, read twice.
    keyed.mapInArrow(given_back(align, "aligner"), sql).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(sql).parquet(path), here.size_b


def text_key(text: str):
    return F.unhex(F.sha2(text, 256)).alias("text_key")


def pair_counts(links: DataFrame, size_b: int) -> DataFrame:
    """code, n, best: how often each pair of ids is linked, and whether that is the highest count of its B id."""
    counts = links.select("copies", F.explode("links").alias("code")).groupBy("code").agg(F.sum("copies").alias("n"))
    counts = write_scratch(counts, "alignment-counts")
    b = F.col("code") % size_b
    # At most a row per entry of B's vocabulary.
    top = F.broadcast(counts.groupBy(b.alias("_b")).agg(F.max("n").alias("_top")))
    made = counts.join(top, b == F.col("_b")).select("code", "n", (F.col("n") == F.col("_top")).alias("best"))
    made = write_scratch(made, "alignment-pairs")
    remove_scratch(counts)
    return made


def least_held(counts: DataFrame, held_pairs: int) -> int:
    """The least power of two that at most ``held_pairs`` pairs reach."""
    digits = F.length(F.bin("n"))
    sizes = {r["digits"]: r["rows"] for r in counts.groupBy(digits.alias("digits")).agg(F.count("*").alias("rows")).collect()}
    level = 1
    while sum(rows for digits, rows in sizes.items() if digits >= level) > held_pairs:
        level += 1
    return 1 << (level - 1)


def measured(links: DataFrame, counts: DataFrame, held_pairs: int) -> DataFrame:
    """text_key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each distinct text."""
    least = least_held(counts, held_pairs)
    top = counts.filter(F.col("n") >= least).toArrow()  # at most ``held_pairs`` rows
    codes = top["code"].to_numpy().astype(np.int64)
    order = np.argsort(codes)
    held = links.sparkSession.sparkContext.broadcast(
        (codes[order], top["n"].to_numpy()[order], top["best"].to_numpy().astype(bool)[order])
    )
    names = ["n_a", "n_b", "n_groups"]
    found = ["n_links", "n_best", "count_sum"]
    schema = pa.schema(
        [
            ("text_key", pa.binary()),
            *((name, pa.int64()) for name in (*names, *found)),
            ("groups_sha256", pa.string()),
            ("open", pa.list_(pa.int64())),
        ]
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = held.value
        for got in batches:
            for begin, end in _runs_of_links(got["links"]):
                some = got.slice(begin, end - begin)
                lists = some["links"]
                offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
                coded = lists.flatten().dictionary_encode()
                code, which = coded.dictionary.to_numpy().astype(np.int64), coded.indices.to_numpy()
                at = np.minimum(np.searchsorted(known, code), max(len(known) - 1, 0))
                hit = known[at] == code if len(known) else np.zeros(len(code), bool)
                count = np.where(hit, n[at], 0) if len(known) else np.zeros(len(code), np.int64)
                top_ = (hit & best[at]) if len(known) else hit

                def by_text(values: np.ndarray, offsets=offsets, which=which) -> np.ndarray:
                    return np.diff(np.concatenate([[0], np.cumsum(values[which], dtype=np.int64)])[offsets])

                missed = ~hit[which]
                ends = np.concatenate([[0], np.cumsum(missed)])[offsets]
                yield batch(
                    schema,
                    **{name: some[name] for name in ("text_key", *names, "groups_sha256")},
                    n_links=np.diff(offsets),
                    n_best=by_text(top_),
                    count_sum=by_text(count),
                    open=pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(code[which[missed]])),
                )
            give_back()

    sql = "text_key binary, " + ", ".join(f"{name} long" for name in (*names, *found)) + ", groups_sha256 string, open array<long>"
    rows = write_scratch(links.drop("copies").mapInArrow(given_back(measure, "aligner"), sql), "alignment-measures")
    rare = counts.filter(F.col("n") < least)
    asked = rows.select("text_key", F.explode("open").alias("code")).groupBy("text_key", "code").agg(F.count("*").alias("times"))
    more = asked.join(rare, "code").groupBy(F.col("text_key").alias("_key")).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"),
        F.sum(F.col("times") * F.col("n")).alias("_sum"),
    )
    joined = rows.drop("open").join(more, F.col("text_key") == F.col("_key"), "left")
    zero = F.lit(0)
    return joined.withColumns(
        {"n_best": F.col("n_best") + F.coalesce("_best", zero), "count_sum": F.col("count_sum") + F.coalesce("_sum", zero)}
    ).drop("_key", "_best", "_sum")


def _runs_of_links(lists: pa.ListArray, budget: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most so many links; a row with more is alone."""
    begin = total = 0
    for i, n in enumerate(lists.value_lengths().to_pylist()):
        if total + n > budget and i > begin:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(lists):
        yield begin, len(lists)


def align(docs: DataFrame, a_path: str, b_path: str, *, held_pairs: int = 1_000_000) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs`` (doc_id, text)."""
    links, size_b = aligned(docs, a_path, b_path)
    measures = measured(links, pair_counts(links, size_b), held_pairs)
    remove_scratch(links)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.unhex(F.sha2(docs["text"], 256)).alias("_of"))
    joined = rows.join(measures, F.col("_of") == F.col("text_key"), "left")
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return joined.select(
        "doc_id",
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in numbers],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )

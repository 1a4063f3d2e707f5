"""Cost-balanced packing of documents into fixed-length sequences.

A document is its token ids and one end id. It is cut every ``length`` ids: whole pieces are
sequences of their own, the remainders are dealt to groups by a hash of their document. In a
group, remainders are taken by descending cost, ``linear * n + quadratic * n ** 2`` for n ids,
and each goes to the sequence of lowest cost that has room. One that fits nowhere is cut over
the sequences of lowest cost. The capacities of a group's sequences add up to its ids: as many
of ``length`` as go into them, then the powers of two of the rest. So no sequence is padded.

Null texts count as empty (one end id). Rows with one doc_id are packed as separate documents.
A null doc_id stays null. Text without white space is tokenised as one chunk, however long. No rows
give no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import json
import math
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch, given_back, per_worker, slices, text_of

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_CUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, group long, ids binary"
_CUT_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("group", pa.int64()),
        ("ids", pa.binary()),
    ]
)
LONG_WORD = 64
KNOWN_WORDS = 500_000
RUN_BYTES = 2_000_000
# Signs that a split into runs of letters, single digits and runs of other signs parts from a letter.
TAIL = ".,;:!?|%$#*&"


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


class WordTokens:
    """Ids of texts, tokenising each distinct chunk between white space once.

    Holds for tokenizers that normalise and split chunks between ASCII white space independently
    of each other and drop white space. If the tokenizer lower-cases and parts letters from other signs,
    chunks that differ in case or in trailing signs share their tokenisation too; texts with a special
    token's string don't. At most ``KNOWN_WORDS`` chunks are remembered.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 65536 else "<u4")
        self.known: dict[str, bytes] = {}
        given = json.loads(tokenizer_json)
        self.special = [t["content"].lower() for t in given["added_tokens"]]
        normalizers = json.dumps(given["normalizer"])
        pattern = json.dumps(given["pre_tokenizer"])
        suffix = given["model"].get("end_of_word_suffix")
        self.ends = None
        if suffix:
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.ends[[i for token, i in given["model"]["vocab"].items() if token.endswith(suffix)]] = True
        self.shares = '"Lowercase"' in normalizers and json.dumps(r"[^\s\p{L}\p{N}]+")[1:-1] in pattern

    def _encoded(self, chunks: list[str]) -> dict[str, bytes]:
        """The ids of chunks. Those of letters alone are encoded many at a time.

        Each is one word there, and the ids say where words end; counted, as lower-casing
        may add a sign that is no letter.
        """
        code = "H" if self.kind.itemsize == 2 else "I"
        plain = [c for c in chunks if c.isalpha()] if self.ends is not None else []
        found = {}
        for begin in range(0, len(plain), 500):
            some = plain[begin : begin + 500]
            encoding = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids = np.array(encoding.ids, self.kind)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(some):
                raw, edges = ids.tobytes(), [0, *(cuts * self.kind.itemsize).tolist()]
                found.update((c, raw[a:b]) for c, a, b in zip(some, edges, edges[1:], strict=False))
        rest = [c for c in chunks if c not in found]
        for begin in range(0, len(rest), 5_000):
            some = rest[begin : begin + 5_000]
            made = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            found.update((c, array(code, e.ids).tobytes()) for c, e in zip(some, made, strict=True))
        return found

    def _learn(self, chunks: list[str], share: bool) -> dict[str, bytes]:
        """The ids of new chunks; in lower case if ``share``."""
        if not share:
            return self._encoded(chunks)
        known, parts = self.known, []
        for chunk in chunks:
            head = chunk.rstrip(TAIL)
            cut = len(head) if head and "a" <= head[-1] <= "z" else len(chunk)
            parts.append((chunk[:cut], chunk[cut:]))
        made = self._encoded([p for p in {p for pair in parts for p in pair} if p and p not in known])
        made[""] = b""
        ids = [(made[h] if h in made else known[h]) + (made[t] if t in made else known[t]) for h, t in parts]
        return made | dict(zip(chunks, ids, strict=True))

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text."""
        low = pc.ascii_lower(texts)
        share = self.shares and not any(pc.any(pc.match_substring(low, s)).as_py() for s in self.special)
        split = pc.ascii_split_whitespace(low if share else texts)
        chunks = split.flatten().dictionary_encode()
        distinct, which = chunks.dictionary.to_pylist(), chunks.indices.to_numpy()
        known = self.known
        ids = [known.get(c) for c in distinct]
        new = [i for i, found in enumerate(ids) if found is None]
        if new:
            here = self._learn([distinct[i] for i in new], share)
            for i in new:
                ids[i] = here[distinct[i]]
            if len(known) < KNOWN_WORDS:
                known.update((c, found) for c, found in here.items() if len(c) <= LONG_WORD)
        # All ids in the order of the texts: each chunk's run of ids is copied to its place.
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.kind.itemsize
        pool = np.frombuffer(b"".join(ids), self.kind)
        begins = np.cumsum(sizes) - sizes
        width = sizes[which]
        ends = np.concatenate([[0], np.cumsum(width)])
        out = pool[np.repeat(begins[which] - ends[:-1], width) + np.arange(ends[-1])]
        bounds = ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield out[a:b]


def tokenise(docs: DataFrame, tokenizer_json: str, length: int, end_id: int, groups: int) -> DataFrame:
    """Whole pieces of ``length`` ids, and remainders with their ids, with the group of each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = per_worker(("tokens", tokenizer_json), lambda: WordTokens(tokenizer_json))
        for got in batches:
            for begin, end in slices(got["text"], RUN_BYTES):
                some = got.slice(begin, end - begin)
                keys, deal = some["doc_id"].to_pylist(), some["group"].to_pylist()
                out: dict[str, list] = {f.name: [] for f in _CUT_ARROW}
                texts = tokens(some["text"])
                for doc_id, group, ids in zip(keys, deal, texts, strict=True):
                    ids = np.append(ids, np.array(end_id, ids.dtype))
                    for start in range(0, len(ids), length):
                        piece = ids[start : start + length]
                        whole = len(piece) == length
                        for name, value in (
                            ("doc_id", doc_id),
                            ("start", start),
                            ("length", len(piece)),
                            ("ids_crc32", crc(piece)),
                            ("doc_tokens", len(ids)),
                            ("group", group),
                            ("ids", None if whole else piece.tobytes()),
                        ):
                            out[name].append(value)
                yield batch(_CUT_ARROW, **out)

    text = text_of(docs)
    deal = F.pmod(F.xxhash64(docs["doc_id"], text), F.lit(groups))
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), deal.alias("group")
    ).mapInArrow(given_back(cut, "tokens"), _CUT)


def capacities(ids: int, length: int) -> list[int]:
    """Sequence lengths that add up to ``ids``: ``length``, then the powers of two of the rest."""
    rest = ids % length
    return [length] * (ids // length) + [1 << k for k in range(rest.bit_length())[::-1] if rest >> k & 1]


def assign(lengths: np.ndarray, length: int, linear: float, quadratic: float) -> list[tuple]:
    """(piece, start in it, length, sequence, offset) of pieces shorter than ``length``."""
    room = np.array(capacities(int(lengths.sum()), length), np.int64)
    full = room.copy()
    cost = np.zeros(len(room))
    placed = []

    def put(piece: int, start: int, n: int, k: int) -> None:
        placed.append((piece, start, n, k, int(full[k] - room[k])))
        room[k] -= n
        cost[k] += linear * n + quadratic * n * n

    for piece in np.argsort(-lengths, kind="stable"):
        n, start = int(lengths[piece]), 0
        fits = room >= n
        if fits.any():
            put(piece, 0, n, int(np.where(fits, cost, np.inf).argmin()))
            continue
        while start < n:
            k = int(np.where(room > 0, cost, np.inf).argmin())
            part = min(int(room[k]), n - start)
            put(piece, start, part, k)
            start += part
    return placed


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    length: int = 2048,
    end_id: int = 1,
    linear: float = 1.0,
    quadratic: float = 1 / 2048,
    group_docs: int = 1024,
) -> DataFrame:
    """One row per piece, as in ``PIECES``; a group holds about ``group_docs`` documents."""
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    groups = max(1, math.ceil(docs.count() / group_docs))

    def deal(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "doc_tokens", "start", "ids_crc32"]).reset_index(drop=True)
        base = int(pdf["group"].iloc[0]) << 32
        whole = pdf["ids"].isna()
        done = pdf[whole].assign(offset=0)
        done["sequence_id"] = base + np.arange(len(done))
        rest = pdf[~whole].reset_index(drop=True)
        if rest.empty:
            return done
        kind = "<u2" if len(rest["ids"][0]) == 2 * rest["length"][0] else "<u4"
        placed = assign(rest["length"].to_numpy(), length, linear, quadratic)
        piece, start, n, k, offset = (np.array(x) for x in zip(*placed, strict=True))
        cut = rest.iloc[piece].reset_index(drop=True)
        cut["ids_crc32"] = [
            c if m == whole_n else crc(np.frombuffer(ids, kind)[s : s + m])
            for c, ids, whole_n, s, m in zip(cut["ids_crc32"], cut["ids"], cut["length"], start, n, strict=True)
        ]
        cut["start"] += start
        cut["length"] = n
        cut["sequence_id"] = base + len(done) + k
        cut["offset"] = offset
        return pd.concat([done, cut])

    names = [c.split()[0] for c in PIECES.split(", ")]

    def by_group(table: pa.Table) -> pa.Table:
        # Null doc_id stays null, which pandas integers can't hold.
        null = table["doc_id"].is_null()
        pdf = table.set_column(0, "doc_id", pc.fill_null(table["doc_id"], np.iinfo(np.int64).min)).to_pandas()
        pdf["was_null"] = null.to_pandas()
        packed = deal(pdf)
        out = pa.Table.from_pandas(packed[names], preserve_index=False)
        mask = pa.array(packed["was_null"].to_numpy(bool))
        return out.set_column(0, "doc_id", pc.if_else(mask, pa.scalar(None, pa.int64()), out["doc_id"]))

    cut = tokenise(docs, tokenizer_json, length, end_id, groups)
    return cut.groupBy("group").applyInArrow(by_group, PIECES)

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm.queries import op10_pack, word_tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(word_tokenizer())


@pytest.fixture(scope="module")
def tokenizer_json():
    with open(word_tokenizer(), encoding="utf-8") as f:
        return f.read()


HARD = [
    "",
    " ",
    "It's the cat's, they'll say: 'tis I'd!",
    "word. word, word... (word) word%%% %word 12 1a2b 3.14",
    "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b",
    "<|endoftext| >",
    "ÀÉ á K Å ǅ ß ſ İ Σας ΣΑΣ",
    "日本語 テキスト。 русский, текст! \U0001d400 \U0001f600\u200d",
    "nbsp\u00a0between em\u2003space\u3000 line\u2028sep \x1c\x1d\x85",
    "tab\tand\nline\r\n\x0b\x0cfeed",
    "x" * 5000,
    "A.B.C. U.S.A.| a| |b |",
    "don't DON'T Don't. o'clock, 's 't",
]


def test_word_tokens_equal_the_tokenizer(tokenizer, tokenizer_json, documents, monkeypatch):
    texts = HARD + [r["text"] or "" for r in documents.collect()]
    for known in (packing.KNOWN_WORDS, 50):
        monkeypatch.setattr(packing, "KNOWN_WORDS", known)
        tokens = packing.WordTokens(tokenizer_json)
        assert tokens.shares
        assert list(tokens(pa.array([], pa.string()))) == []
        for group in (texts, texts[::-1], *([t] for t in HARD)):
            for text, ids in zip(group, tokens(pa.array(group, pa.string())), strict=True):
                assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:50]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1000, 2047, 2048, 2049, 100_000])
def test_capacities_add_up(n):
    got = packing.capacities(n, 2048)
    assert sum(got) == n
    assert all(c == 2048 or c & (c - 1) == 0 for c in got)


@pytest.mark.parametrize("seed", range(10))
def test_assignment_fills_every_sequence(seed):
    lengths = np.random.default_rng(seed).integers(1, 64, 200)
    placed = packing.assign(lengths, 64, 1.0, 1 / 64)
    room = dict(enumerate(packing.capacities(int(lengths.sum()), 64)))
    by_piece, by_sequence = defaultdict(list), defaultdict(list)
    for piece, start, n, k, offset in placed:
        by_piece[piece].append((start, n))
        by_sequence[k].append((offset, n))
    for parts, total in [(by_piece[i], n) for i, n in enumerate(lengths)] + [(by_sequence[k], n) for k, n in room.items()]:
        at = 0
        for start, n in sorted(parts):
            assert start == at and n > 0
            at += n
        assert at == total


def test_costs_are_balanced():
    lengths = np.array([32] * 16 + [8] * 64)
    placed = packing.assign(lengths, 64, 1.0, 1 / 8)
    cost = defaultdict(float)
    for _, _, n, k, _ in placed:
        cost[k] += n + n * n / 8
    assert max(cost.values()) <= 1.3 * min(cost.values())


def checked(rows, docs, tokenizer):
    """All ids of each document once, in gapless sequences."""
    texts = defaultdict(list)
    for r in docs:
        texts[r["doc_id"]].append(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1])
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding == 0
    assert pieces.keys() == texts.keys()
    for doc_id, found in pieces.items():
        assert sum(r["length"] for r in found) == sum(map(len, texts[doc_id]))
        for r in found:
            part = [
                ids[r["start"] : r["start"] + r["length"]] for ids in texts[doc_id] if len(ids) == r["doc_tokens"]
            ]
            assert r["ids_crc32"] in [zlib.crc32(np.array(p, "<u4").tobytes()) for p in part]
        if len(texts[doc_id]) == 1:
            at = 0
            for r in sorted(found, key=lambda r: r["start"]):
                assert r["start"] == at
                at += r["length"]


def test_query(spark, sf_dir, documents, tokenizer):
    checked(op10_pack(spark, sf_dir).collect(), documents.collect(), tokenizer)


def test_messy_and_empty_tables(messy, nothing, tokenizer):
    path = word_tokenizer()
    rows = packing.pack(messy, path).collect()
    checked(rows, messy.collect(), tokenizer)
    assert [r["length"] for r in rows if r["doc_id"] == 1] == [1]
    checked(packing.pack(messy, path, group_docs=2).collect(), messy.collect(), tokenizer)
    assert packing.pack(nothing, path).count() == 0

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.alignment import Aligner, align, byte_signs
from tidemark.llm.queries import QUERIES

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    """groups and links of a whole text, token by token."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    names = {i: s for s, i in a.get_vocab().items()}
    signs = byte_signs()

    def of_b(i):
        piece = b.id_to_piece(i)
        if len(piece) == 6 and piece.startswith("<0x"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def spans(parts):
        out, at = [], 0
        for i, raw in parts:
            out.append((i, at, at + len(raw)))
            at += len(raw)
        return out

    def aligned(text):
        if not text:
            return None
        raw = (" " + text).encode()
        ids_a = [(i, bytes(signs[s] for s in names[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
        ids_b = [(i, of_b(i)) for i in b.encode(text)]
        if b"".join(r for _, r in ids_a) != raw or b"".join(r for _, r in ids_b) != raw:
            return None
        at_a, at_b = spans(ids_a), spans(ids_b)
        cuts = sorted({e for *_, e in at_a} & {e for *_, e in at_b})
        groups, low = [], 0
        i = j = 0
        for cut in cuts:
            left, right = [], []
            while i < len(at_a) and at_a[i][2] <= cut:
                left.append(str(at_a[i][0]))
                i += 1
            while j < len(at_b) and at_b[j][2] <= cut:
                right.append(str(at_b[j][0]))
                j += 1
            groups.append(",".join(left) + "|" + ",".join(right))
            low = cut
        assert low == len(raw)
        links, first = [], 0
        for x, begin, end in at_a:
            while at_b[first][2] <= begin:
                first += 1
            k = first
            while k < len(at_b) and at_b[k][1] < end:
                links.append((x, at_b[k][0]))
                k += 1
        return len(at_a), len(at_b), groups, links

    return aligned


def expected(rows, plain):
    found = {t: plain(t) for t in {t for _, t in rows}}
    counts = Counter()
    for _, text in rows:
        if found[text]:
            counts.update(found[text][3])
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for doc_id, text in rows:
        if not found[text]:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = found[text]
        best = sum(counts[link] == top[link[1]] for link in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((doc_id, n_a, n_b, len(groups), len(links), best, sum(counts[link] for link in links), digest))
    return sorted(map(str, out))


def got(df):
    return sorted(str(tuple(r)) for r in df.select(*COLUMNS).collect())


def test_query_against_plain_alignment(spark, sf_dir, load, plain):
    rows = [tuple(r) for r in load("documents").select("doc_id", "text").collect()]
    assert got(QUERIES["op12_align"](spark, sf_dir)) == expected(rows, plain)


@pytest.mark.parametrize("held_pairs", [0, 7, 1_000_000])
def test_messy_rows(messy, plain, held_pairs):
    rows = [(r["doc_id"], r["text"]) for r in messy.select("doc_id", "text").collect()]
    assert got(align(messy, A, B, held_pairs=held_pairs)) == expected(rows, plain)


ODD = [
    "a  b   c", " lead", "trail ", "  ", "\n", "a\nb \n c", "tab\t tab", "it's we'll 'tis",
    "nbsp  x  y", "᠎ x ᠎", "a   b", "x ▁ y", "▁", "<s> </s> <unk> <0x41>",
    "<|endoftext|> <|endoftext|>", "\x00 \x1c \x1f x \x85 y", "é ü 中文 字 \U0001f600\U0001f600 z", "1 22 333 4444 55555",
    "... !!! ?! a.b.c", "﻿ bom", "mixed中 文mixed", "é combining", "a b" * 50,
]


def test_odd_texts_cut_and_uncut(plain):
    tokens = Aligner(Path(A).read_text(encoding="utf-8"), Path(B).read_bytes())
    for _ in range(2):  # the second time from memory
        n_a, n_b, groups, links, hashes = tokens.texts(pa.array(ODD))
        for i, text in enumerate(ODD):
            want = plain(text)
            if want is None:
                assert (n_a[i], n_b[i], groups[i], links[i].as_py(), hashes[i]) == (0, 0, 0, [], "")
                continue
            codes = [x * tokens.size_b + y for x, y in want[3]]
            assert (n_a[i], n_b[i], groups[i]) == (want[0], want[1], len(want[2])), text
            assert links[i].as_py() == codes, text
            assert hashes[i] == hashlib.sha256(";".join(want[2]).encode()).hexdigest(), text


def test_copies_are_tokenised_once_and_counted(spark, plain):
    rows = [(i, "a hot text of many rows") for i in range(300)] + [(300, "another"), (300, "another"), (None, "one more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(align(docs, A, B)) == expected(rows, plain)


def test_no_rows(nothing, messy):
    assert align(nothing, A, B).collect() == []
    empty = messy.filter(F.coalesce("text", F.lit("")) == "")
    assert {tuple(r)[1:] for r in align(empty, A, B).collect()} == {(0, 0, 0, 0, 0, 0, "")}

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import repeats
from tidemark.llm.queries import QUERIES
from tidemark.llm.repeats import Shape, digests, enhanced_suffix_array, joined_spans, later_occurrences, maximal_repeats, removed

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def expected(rows, length=100):
    """By a table of all strings and where each starts first. Rows of one doc_id must have one text."""
    texts = {d: (t or "").encode() for d, t in rows}
    first = {}
    for doc in sorted(texts, key=lambda d: (d is None, d)):
        text = texts[doc]
        for i in range(len(text) - length + 1):
            first.setdefault(hashlib.md5(text[i : i + length]).digest(), (doc, i))
    out = {}
    for doc, text in texts.items():
        gone = np.zeros(len(text) + 1, np.int64)
        for i in range(len(text) - length + 1):
            if first[hashlib.md5(text[i : i + length]).digest()] != (doc, i):
                gone[i] += 1
                gone[i + length] -= 1
        off = np.cumsum(gone)[: len(text)] > 0
        kept = np.frombuffer(text, np.uint8)[~off].tobytes()
        spans = int((off & ~np.concatenate([[False], off[:-1]])).sum()) if len(text) else 0
        out[doc] = (doc, len(text), int(off.sum()), spans, hashlib.sha256(kept).hexdigest())
    return sorted(str(out[d]) for d, _ in rows)


def got(df):
    return sorted(str(tuple(r)) for r in digests(df).select(*COLUMNS).collect())


def test_query_against_all_strings(spark, sf_dir, load):
    rows = [tuple(r) for r in load("documents").select("doc_id", "text").collect()]
    result = QUERIES["op11_repeats"](spark, sf_dir)
    assert sorted(str(tuple(r)) for r in result.select(*COLUMNS).collect()) == expected(rows)


def mutants(seed, n, size, alphabet):
    """Texts that share many passages, with edits, in a small alphabet."""
    rng = random.Random(seed)
    base = "".join(rng.choice(alphabet) for _ in range(size))
    rows = []
    for doc_id in rng.sample(range(10 * n), n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            a = rng.randrange(size)
            part = list(base[a : a + rng.randint(1, 400)])
            for _ in range(rng.choice([0, 0, 1, 3])):
                part[rng.randrange(len(part))] = rng.choice(alphabet)
            parts.append("".join(part))
        rows.append((doc_id, "".join(parts)))
    return rows


@pytest.mark.parametrize("group, hot, wide", [(2000, 16, 1000), (2000, 16, 0), (3, 2, 2), (0, 1, 1), (1, 10_000, 1), (5000, 3, 3)])
def test_overlapping_passages(spark, monkeypatch, group, hot, wide):
    monkeypatch.setattr(repeats, "WIDE", wide)
    rows = mutants(group, 150, 3000, "abcdé ") + mutants(9, 30, 300, "xy")
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got(removed(docs, group=group, hot=hot)) == expected(rows)


@pytest.mark.parametrize("length, anchor", [(20, 8), (12, 12), (5, 1)])
def test_other_lengths(spark, length, anchor):
    rows = [(i, t) for i, (_, t) in enumerate(mutants(length, 60, 400, "abcdefgh"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(removed(docs, length=length, anchor=anchor, group=5)) == expected(rows, length)


def test_periodic_texts_and_long_ones_in_parts(spark, monkeypatch):
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefghij ") for _ in range(9000))
    rows = [(1, "x" * 5000), (2, "ab" * 900), (3, text + text[:3000]), (4, text[500:8000]), (5, "x" * 150 + text[:200]), (6, "b" + "ab" * 80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want = expected(rows)
    assert got(removed(docs)) == want
    monkeypatch.setattr(repeats, "PART_BYTES", 700)
    monkeypatch.setattr(repeats, "SORT_BYTES", 3000)
    assert got(removed(docs)) == want


def test_many_copies_with_and_without_a_common_line(spark, monkeypatch):
    line = "This line, which is well over a hundred bytes long, stands in all of these documents, and nothing else of them does."
    short = "A shorter line that is in all of them as well, though it has few bytes."
    rows = [(i, f"{i * 7919} begins {short} {i * 104729} goes on {line} {i * 1299709} ends") for i in range(500)]
    rows += [(i, "One text, word for word, over and over, in hundreds of rows; it is as long as it has to be for all this.") for i in range(500, 900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = expected(rows)
    for group, wide in ((2000, 1000), (50, 1000), (2000, 20)):
        monkeypatch.setattr(repeats, "WIDE", wide)
        assert got(removed(docs, group=group)) == want


def test_messy_rows(messy):
    """Null and empty texts, repeated rows, several texts under one doc_id, and null doc_ids."""
    rows = [tuple(r) for r in messy.select("doc_id", "text").collect()]
    single = [(d, t) for d, t in rows if d is not None and d != 6]
    result = got(removed(messy))
    assert len(result) == len(rows)
    assert set(expected(single)) <= set(result)
    twice = messy.unionByName(messy)
    assert got(removed(twice)) == sorted(result * 2)


def test_rows_of_one_id_and_null_ids(spark):
    a, b = ("".join(random.Random(s).choices("abcdef", k=300)) for s in (1, 2))
    rows = [(1, a), (1, a + b), (1, a), (None, b), (None, b + a), (None, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = digests(removed(docs)).collect()
    assert sorted(r["n_bytes"] for r in out) == [300] * 4 + [600] * 2
    # Nothing is left of b with a null id, nor of a twice under id 1; the first of each stays.
    gone = {(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in out}
    assert (None, 300, 300) in gone and (None, 600, 600) in gone
    assert gone - {(None, 300, 300), (None, 600, 600)} in ({(1, 300, 0), (1, 600, 300)}, {(1, 300, 300), (1, 600, 0)})


def test_no_rows(nothing):
    assert removed(nothing).collect() == []


# ---- parts of it -------------------------------------------------------------------


def plain_repeats(text, length):
    """All substrings of ``length`` or more that occur twice and whose occurrences all agree on neither side."""
    found = set()
    for size in range(length, len(text)):
        places = {}
        for i in range(len(text) - size + 1):
            places.setdefault(text[i : i + size], []).append(i)
        for string, at in places.items():
            if len(at) < 2:
                continue
            left = {text[i - 1 : i] if i else None for i in at}
            right = {text[i + size : i + size + 1] or None for i in at}
            if (len(left) > 1 or None in left) and (len(right) > 1 or None in right):
                found.add((string, tuple(at)))
    return found


@pytest.mark.parametrize("seed", range(8))
def test_intervals_are_the_maximal_repeats(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice("ab" if seed % 2 else "abc") for _ in range(60)).encode()
    data = np.frombuffer(text, np.uint8)
    one = np.zeros(1, np.int64)
    array = enhanced_suffix_array(data, np.array([len(text)]), one, one, one, 3)
    found = set()
    for size, first, last in maximal_repeats(array, 3):
        at = sorted(array.begin[first : last + 1].tolist())
        found.add((text[at[0] : at[0] + size], tuple(at)))
    assert found == plain_repeats(text, 3)
    at, size = later_occurrences(array, 3)
    spans = joined_spans(array.begin[at], array.begin[at] + size, len(text), 3)
    off = [i for i in range(len(text) - 2) if text.find(text[i : i + 3]) < i]
    assert {j for a, b in spans for j in range(a, b)} == {j for i in off for j in range(i, i + 3)}


def test_every_string_has_an_anchor_that_its_bytes_decide():
    shape = Shape(20, 6)
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcd") for _ in range(n)).encode() for n in (300, 0, 19, 20, 200)]
    texts.append(texts[0][50:250])
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    at, keys, prints = shape.anchors(data, ends)
    assert len(at) < 0.35 * len(data)
    anchors, seen = set(at.tolist()), {}
    raw = data.tobytes()
    for text, end in zip(texts, ends.tolist(), strict=True):
        for i in range(end - len(text), end - 19):
            inside = tuple(j - i for j in range(i, i + 15) if j in anchors)
            assert inside
            seen.setdefault(raw[i : i + 20], set()).add(min(inside, key=lambda j: keys[np.searchsorted(at, i + j)]))
    assert all(len(places) == 1 for places in seen.values())
    by_print = {}
    for i, k, p in zip(at.tolist(), keys.tolist(), prints.tolist(), strict=True):
        n = int(np.searchsorted(ends, i, "right"))
        low, high = max(int(ends[n]) - len(texts[n]), i - 14), min(int(ends[n]), i + 20)
        by_print.setdefault((k, p), set()).add((raw[low:high], i - low))
    assert all(len(c) == 1 for c in by_print.values())

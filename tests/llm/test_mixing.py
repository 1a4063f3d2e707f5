import re
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import mixing
from tidemark.llm.common import WORD
from tidemark.llm.queries import op5_mix


def plain_targets(sizes, weights, most):
    """The contract's rounds: share, stop at the limit, reshare the excess."""
    got, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = float(sum(sizes))
    while open_ and left > 1e-9:
        total = sum(weights[i] for i in open_)
        for i in list(open_):
            got[i] += left * weights[i] / total
        left = 0.0
        for i in list(open_):
            if got[i] > most * sizes[i]:
                left += got[i] - most * sizes[i]
                got[i] = most * sizes[i]
                open_.discard(i)
    return got


@pytest.mark.parametrize("seed", range(20))
def test_targets_equal_resharing_rounds(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(0, 1000, 9).tolist()
    weights = [float(i % 3 + 1) for i in range(9)]
    assert np.allclose(mixing.targets(sizes, weights, 3), plain_targets(sizes, weights, 3))


def test_targets_of_nothing():
    assert mixing.targets([], [], 3) == []
    assert mixing.targets([0, 0], [1.0, 2.0], 3) == [0.0, 0.0]
    assert mixing.targets([5], [1.0], 3) == [5.0]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutations(n):
    a, b = (mixing.permuted(np.arange(n), n, key) for key in (1, 2))
    assert sorted(a.tolist()) == sorted(b.tolist()) == list(range(n))
    if n > 60:
        assert (a != b).any()


def test_query(spark, sf_dir, documents):
    rows = op5_mix(spark, sf_dir).collect()
    given = {r["doc_id"]: r for r in documents.collect()}
    assert {r["doc_id"] for r in rows} == set(given) and len(rows) == len(given)
    by_source, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        row = given[r["doc_id"]]
        assert r["size"] == len(re.findall(WORD, row["text"] or ""))
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_source[row["source"]] += r["size"]
        taken[row["source"]] += r["taken"]
        target[row["source"]] = r["target"]
    names = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    want = plain_targets([by_source[s] for s in names], [float(i % 3 + 1) for i in range(len(names))], 3)
    assert np.allclose([target[s] for s in names], want)
    assert all(r["source_size"] == by_source[given[r["doc_id"]]["source"]] for r in rows)
    for s in names:
        assert abs(taken[s] - target[s]) <= 0.05 * target[s] + 130
    assert sorted(map(tuple, rows)) == sorted(map(tuple, op5_mix(spark, sf_dir).collect()))


def test_many_sources_are_joined_without_broadcast(documents, monkeypatch):
    small = sorted(map(tuple, mixing.mix(documents).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(tuple, mixing.mix(documents).collect())) == small


def test_no_block_repeats_within_an_epoch(documents):
    m = mixing.Mix(documents, block_words=32, shard_slots=100)
    slots = m.slots().toPandas()
    assert not slots.duplicated(["source_ix", "epoch", "block"]).any()
    assert not slots.duplicated(["shard", "slot"]).any()
    assert slots["epoch"].max() <= 2
    for ix, s in enumerate(m.sources):
        assert slots.loc[slots["source_ix"] == ix, "block"].between(0, s.blocks - 1).all()


def test_parts_cover_each_word_once(documents, messy):
    for docs in (documents, messy):
        m = mixing.Mix(docs, block_words=16)
        rows = m.parts().groupBy("source_ix", "block").sum("words").collect()
        assert all(0 < r["sum(words)"] <= 16 for r in rows)
        assert sum(r["sum(words)"] for r in rows) == sum(s.size for s in m.sources)


def test_messy_and_empty_tables(messy, nothing):
    rows = mixing.mix(messy).collect()
    assert len(rows) == messy.count()
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert {r["doc_id"] for r in rows if r["size"] == 0} >= {1, 2, 3}
    assert mixing.mix(nothing).count() == 0
    assert mixing.mixed_documents(nothing).count() == 0


def test_mixed_documents_hold_the_words_taken(spark, documents, messy):
    for docs in (documents, messy):
        taken, out = defaultdict(int), defaultdict(int)
        for r in mixing.mix(docs).collect():
            taken[r["doc_id"]] += r["taken"]
        given = defaultdict(set)
        for r in docs.collect():
            given[r["doc_id"]].add(r["text"])
        for r in mixing.mixed_documents(docs).collect():
            words = re.findall(WORD, r["text"])
            out[r["doc_id"]] += len(words)
            assert r["n_chars"] == len(r["text"])
            assert any(set(words) <= set(re.findall(WORD, t or "")) for t in given[r["doc_id"]])
        assert {k: v for k, v in taken.items() if v} == dict(out)

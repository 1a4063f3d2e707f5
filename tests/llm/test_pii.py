import hashlib
import re

import numpy as np
import pytest

from tidemark.llm import pii
from tidemark.llm.queries import op1_pii

# The contract's patterns as written.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plainly(text):
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            fits = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }
            if fits[kind]:
                found.append((m.start(), order, m.end()))
    return sorted(found)


@pytest.mark.parametrize(
    "text",
    [
        "a@b.c a@b@c.de x..y@z-.q- @b.c a@b a.b@c.d@e.f",
        "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 01.002.3.4 1.2.3.4567 9.9.9.9.",
        "4111 1111-1111 1111 4111111111111111 1 2 3 41111111 11111112 0 0",
        "+1 (743) 555-3824 +12 34 ++49 30 1234567 +1-2-3 + 1234567890",
        "+1 (843) 555-7672 170.106.4.2",
        "é@x.yz ünï@code.org 𝐀1.2.3.4",
        "",
    ],
)
def test_base_spans_equal_the_plain_patterns(text):
    assert pii.base_spans(text) == plainly(text)


def test_base_spans_equal_the_plain_patterns_on_random_texts():
    rng = np.random.default_rng(5)
    for _ in range(3000):
        text = "".join(rng.choice(list("ab1230.@+- ()%"), rng.integers(1, 60)))
        assert pii.base_spans(text) == plainly(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" * 100_000, "@" * 300_000):
        pii.base_spans(text)


def test_crf_marginal_training_separates_examples():
    rows = pii.examples(600)
    model = pii.train(rows)
    right = total = extra = 0
    for text, spans in pii.examples(300, seed=12):
        _, found = pii.spans_of([text], model, {})[0]
        got = {(pii.KINDS[k], s, e) for s, k, e in found}
        want = set(spans)
        right += len(want & got)
        total += len(want)
        extra += len(got - want)
    assert right / total > 0.9
    assert extra / total < 0.1


def test_a_word_is_shaped_as_a_whole():
    short, long = ("=" * n + "555-123-4567" for n in (10, 90))
    assert pii.shape(long) == pii.shape(short) == "=93-93-94"
    model = pii.trained(None)
    assert [s[1] for s in pii.spans_of([f"call {long} now"], model, {})[0][1]] == [pii.KINDS.index("phone")]
    blob = "a1" * 300
    key = pii.shape(blob)
    cache: dict = {}
    assert len(model.decode([[("", key, "")]], cache)) == 1 and not cache


def test_neighbours_of_a_run_have_their_own_shapes():
    run, later = pii.runs_of(0, "Tel: 555-1234 9 mail, then x@y")
    assert run.keys == [("Aa:", "93-94", "91"), ("93-94", "91", "a,")]
    assert later.keys == [("a", "a@a", "")]
    assert [r.keys for r in pii.runs_of(0, "12")] == [[("", "92", "")]]


def test_viterbi_equals_trying_every_labelling():
    rng = np.random.default_rng(1)
    k = len(pii.KINDS) + 1
    model = pii.Crf({}, np.zeros((0, k)), rng.normal(size=(k, k)))
    scores = {("", str(i), ""): rng.normal(size=k) for i in range(12)}
    model.scores = scores.__getitem__
    keys = [[("", str(i), "") for i in part] for part in ([0, 1, 2, 3], [4], [5, 6, 7], [8, 9, 10, 11])]
    for run, labels in zip(keys, model.decode(keys, {}), strict=True):
        best = max(
            np.ndindex(*[k] * len(run)),
            key=lambda y: sum(scores[x][a] for x, a in zip(run, y, strict=True))
            + sum(model.moves[a, b] for a, b in zip((0, *y), (*y, 0), strict=True)),
        )
        assert tuple(labels) == best


def test_query_against_plain_patterns(spark, sf_dir, documents):
    got = {r["doc_id"]: r for r in op1_pii(spark, sf_dir).collect()}
    docs = documents.collect()
    assert len(got) == len(docs)
    for row in docs:
        base = plainly(row["text"] or "")
        texts = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base]
        found = got[row["doc_id"]]
        assert found["base_sha256"] == hashlib.sha256(",".join(texts).encode()).hexdigest()
        assert [found[f"n_{name}"] for name in pii.KINDS] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert set(texts) <= set(found["spans"].split(",")) | {""}


def test_messy_and_empty_tables(messy, nothing):
    rows = pii.find(messy).collect()
    assert len(rows) == messy.count()
    empty = next(r for r in rows if r["doc_id"] == 1)
    assert empty["spans"] == "" and empty["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert sum(r["n_email"] for r in rows) == 2
    assert pii.find(nothing).count() == 0
    assert pii.redact(nothing).count() == 0


def test_redact_replaces_spans_and_keeps_the_rest(messy):
    rows = pii.redact(messy).collect()
    assert len(rows) == messy.count()
    assert rows[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}
    twice = [r for r in rows if r["doc_id"] == 6 and "<EMAIL>" in r["text"]]
    assert len(twice) == 2
    assert twice[0]["text"] == "The same words stand here twice, mail <EMAIL>."
    assert twice[0]["n_chars"] == len(twice[0]["text"])
    assert next(r for r in rows if r["doc_id"] == 1)["text"] is None
    assert pii.redacted("ab 1.2.3.4 c", [(3, 1, 10), (5, 2, 10)]) == "ab <IP> c"


def test_too_many_examples_are_refused():
    with pytest.raises(ValueError, match="at most"):
        pii.train([("a", [])] * (pii.MAX_EXAMPLES + 1))


def test_own_labelled_table(spark, messy):
    schema = "text string, spans array<struct<kind:string,start:int,end:int>>"
    labelled = spark.createDataFrame([("call 555-123-4567 now", [("phone", 5, 17)]), ("see 12", [])], schema)
    assert pii.find(messy, labelled).count() == messy.count()
    assert pii.find(messy, labelled.limit(0)).count() == messy.count()

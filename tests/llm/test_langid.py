import zlib

import numpy as np

from tidemark.llm import langid
from tidemark.llm.queries import op3_langid


def plain_viterbi(emit, penalty):
    """The best path by trying all predecessors."""
    value, back = emit[0].astype(float), []
    for row in emit[1:]:
        options = value[:, None] - penalty * (1 - np.eye(len(value)))
        back.append(options.argmax(axis=0))
        value = options.max(axis=0) + row
    path = [int(value.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1], value.max()


def test_labels_are_a_best_path():
    rng = np.random.default_rng(2)
    letters = langid.Letters(64)
    model = langid.Model(
        ["a", "b", "c"], 64, rng.normal(size=(3, 64)).astype(np.float32) * 3, np.ones((len(langid.SCRIPTS), 3), bool), 4.0
    )
    texts = ["".join(rng.choice(list("abcde "), 80)) for _ in range(20)] + ["", "x", "12 ."]
    words = letters.read(texts)
    labels = model.label(words, len(texts))
    for d in range(len(texts)):
        mine = words["doc"] == d
        if not mine.any():
            continue
        emit = np.array(
            [
                model.scores[:, words["trigram"][f : f + n]].sum(axis=1)
                for f, n in zip(words["first"][mine], words["size"][mine], strict=True)
            ]
        )
        path = labels[mine]
        reached = emit[np.arange(len(path)), path].sum() - 4.0 * (path[1:] != path[:-1]).sum()
        assert abs(reached - plain_viterbi(emit, 4.0)[1]) < 1e-3


def test_scripts_narrow_the_candidates(spark):
    rows = [("de", "ein zwei drei vier"), ("ru", "один два три четыре"), ("ja", "ひとつ ふたつ みっつ")]
    docs = spark.createDataFrame(rows, "label string, text string")
    model = langid.learn(docs, docs["label"])
    asked = spark.createDataFrame([(1, "четыре"), (2, "zwei ein"), (3, "ふたつ"), (4, "λόγος")], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(asked, model, ["doc_id"]).collect()}
    assert (got[1], got[2], got[3]) == ("ru", "de", "ja")
    assert got[4] in ("de", "ja", "ru")


def test_spans_of_mixed_text(spark, documents):
    model = langid.learn(documents, documents["lang"])
    some = {r["lang"]: r["text"] for r in documents.filter("length(text) > 600 and length(text) < 2000").collect()}
    text = some["de"][:400] + "\n" + some["fr"][:400]
    asked = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = [(r["lang"], r["start"], r["end"]) for r in langid.spans(asked, model).orderBy("start").collect()]
    assert [name for name, _, _ in spans] == ["de", "fr"]
    assert abs(spans[0][2] - 400) < 30


def test_query_holds_out_and_is_accurate(spark, sf_dir, documents):
    lang = {r["doc_id"]: r["lang"] for r in documents.collect()}
    rows = op3_langid(spark, sf_dir).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"] and lang[r["doc_id"]]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_messy_and_empty_tables(messy, nothing, documents):
    for model in (langid.learn(messy, messy["lang"]), langid.learn(documents, documents["lang"])):
        rows = langid.predict(messy, model, ["doc_id"]).collect()
        assert len(rows) == messy.count()
        unknown = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
        assert {1, 2, 3, 5} <= unknown
        assert langid.predict(nothing, model, ["doc_id"]).count() == 0
        assert langid.spans(nothing, model).count() == 0
    none = langid.learn(nothing, nothing["lang"])
    assert {r["lang_pred"] for r in langid.predict(messy, none, ["doc_id"]).collect()} == {"und"}
    assert langid.identified(messy, none).count() == 0


def test_clean_documents_of_three_languages_stay(spark):
    words = {"en": "the cat sat on the mat", "ru": "кошка сидела на ковре", "el": "η γάτα κάθισε στο χαλί"}
    rows = [(i, t, lang, "a", len(t)) for i, (lang, t) in enumerate(words.items())]
    rows.append((3, " ".join(words.values()), None, "a", None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = langid.learn(docs, docs["lang"])
    scores = {r["doc_id"]: r["score"] for r in langid.predict(docs, model, ["doc_id"]).collect()}
    assert scores[3] < 0.5
    assert {r["doc_id"] for r in langid.identified(docs, model).collect()} == {0, 1, 2, 3}


def test_rejected_documents_go_and_null_languages_are_filled(documents, messy):
    model = langid.learn(documents, documents["lang"])
    assert langid.identified(documents, model).count() >= 0.98 * documents.count()
    rows = langid.identified(messy, model).collect()
    assert all(r["lang"] for r in rows)
    assert not {1, 2, 3, 5} & {r["doc_id"] for r in rows}

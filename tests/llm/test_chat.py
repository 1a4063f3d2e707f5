import hashlib
import re

import duckdb
import pytest

from tidemark.llm import chat
from tidemark.llm.queries import ORACLES, op8_chat

HOSTILE = [
    "",
    "\\",
    "\\\\b",
    "###",
    "####",
    "\\###",
    "</turn>",
    "\\</turn>\n### user:\n",
    "a </turn></turn> \\e \\h \\b ###\\",
    "<</turn",
    "</tur",
    "ünï 𝐀 ### 日本",
    "### assistant:\nno",
    r"\### Assistant: </turn> ok",
]


def test_texts_and_roles_round_trip(spark):
    rows = [(i, [(f"r{t}:\n", t), (t, t), ("assistant", t), ("user", t[::-1])]) for i, t in enumerate(HOSTILE)]
    chats = spark.createDataFrame(rows, "conv_id long, turns array<struct<role:string,text:string>>")
    for r in chat.read_back(chat.formatted(chats)).collect():
        assert [tuple(t) for t in r["read_turns"]] == [tuple(t) for t in r["turns"]]
        assert r["loss_text"] == "".join(t["text"] for t in r["turns"] if t["role"] == "assistant")
        for span in r["loss_spans"]:
            inside = r["formatted"][span["start"] : span["start"] + span["length"]]
            assert "</turn>" not in inside and "###" not in inside
            assert r["formatted"][span["start"] + span["length"] :].startswith("</turn>\n")
        assert r["formatted"].count("</turn>\n") == len(r["turns"])


def test_fingerprints_select_the_layouts(spark):
    schema = """id long, messages array<struct<role:string,content:string>>,
        conversations array<struct<`from`:string,value:string>>,
        prompt string, response string, system string, instruction string, input string, output string"""
    rows = [
        (1, [("user", "q"), ("assistant", None)], None, None, None, None, None, None, None),
        (2, None, [("human", "q"), ("gpt", "a"), ("tool", "t")], None, None, None, None, None, None),
        (3, None, None, "q", "a", None, None, None, None),
        (4, None, None, "q", "a", "s", None, None, None),
        (5, None, None, None, None, None, "do", None, "done"),
        (6, None, None, None, None, "s", "do", "with", "done"),
        (7, None, None, "q", None, None, "do", None, None),
        (8, None, None, None, None, None, None, None, None),
        (9, [], None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    fields = [c for c in df.columns if c != "id"]
    got = {r["id"]: r for r in chat.canonical(df, fields, ["id"]).collect()}
    turns = {k: [tuple(t) for t in r["turns"]] for k, r in got.items()}
    assert {k: r["layout"] for k, r in got.items()} == {
        1: "messages", 2: "share", 3: "prompt", 4: "prompt", 5: "instruction", 6: "instruction",
        7: "unknown", 8: "unknown", 9: "messages",
    }
    assert turns[1] == [("user", "q"), ("assistant", "")]
    assert turns[2] == [("user", "q"), ("assistant", "a"), ("tool", "t")]
    assert turns[3] == [("user", "q"), ("assistant", "a")]
    assert turns[4] == [("system", "s"), ("user", "q"), ("assistant", "a")]
    assert turns[6] == [("system", "s"), ("user", "do"), ("user", "with"), ("assistant", "done")]
    assert turns[7] == turns[8] == turns[9] == []
    assert got[3]["schema_fingerprint"] != got[4]["schema_fingerprint"]
    assert got[5]["schema_fingerprint"] != got[6]["schema_fingerprint"]


def test_nested_structs_have_paths(spark):
    df = spark.sql("SELECT 1 id, struct(struct('x' AS c) AS b) AS a UNION ALL SELECT 2, struct(CAST(NULL AS struct<c:string>))")
    got = {r["id"]: r["f"] for r in df.select("id", chat.schema_fingerprint(df, ["a"]).alias("f")).collect()}
    want = df.select(chat.fingerprint(["a.b.c"]).alias("w")).first()["w"]
    assert got[1] == want != got[2]


def test_query_equals_its_oracle(spark, sf_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    result = connection.execute(ORACLES["op8_chat"])
    columns = [d[0] for d in result.description]
    rows = op8_chat(spark, sf_dir).select(*columns).collect()
    assert sorted(map(tuple, rows)) == sorted(result.fetchall())


def test_the_contracts_conversation(spark, sf_dir):
    text = r"\### Assistant: </turn> ok"
    r = op8_chat(spark, sf_dir).filter("conv_id = -7").first()
    both = f"user\n{text}\nassistant\n{text}\n"
    assert r["n_turns"] == 2 and r["loss_chars"] == len(text)
    assert r["turns_sha256"] == hashlib.sha256(both.encode()).hexdigest()
    assert r["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_messy_and_empty_tables(spark):
    rows = [(1, None, "user", "b"), (1, 0, None, None), (1, 0, None, None), (None, 3, "assistant", "x" * 100_000), (2, 1, "assistant", "")]
    rows += [(3, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    from pyspark.sql import functions as F

    df = df.withColumns({c: F.lit("clash") for c in ("formatted", "turns", "prompt", "messages", "layout", "t")})
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(df)).collect()}
    assert {k: r["n_turns"] for k, r in got.items()} == {1: 3, None: 1, 2: 1, 3: 3000, -7: 2}
    assert got[None]["loss_chars"] == 100_000
    loss = "".join(f"turn {i}" for i in range(1, 3000, 2))
    assert got[3]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert [r["conv_id"] for r in chat.digests(chat.format_conversations(df.limit(0))).collect()] == [-7]


def test_plans_hold_no_python(spark, sf_dir):
    from tests.conftest import plan

    assert not re.search("Python|Pandas|Arrow", plan(op8_chat(spark, sf_dir)))


@pytest.mark.parametrize("layout", chat.LAYOUTS, ids=lambda x: x.name)
def test_no_two_layouts_share_a_fingerprint(layout):
    mine = {tuple(p) for p in layout.path_sets()}
    others = {tuple(p) for x in chat.LAYOUTS if x is not layout for p in x.path_sets()}
    assert mine and not mine & others

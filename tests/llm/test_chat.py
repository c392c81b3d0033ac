from __future__ import annotations

import hashlib
import json

import duckdb
import pytest
from pyspark.sql import functions as F

from eventlake.llm import chat
from eventlake.llm.catalog import QUERIES


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    """(conv_id, turns, digest of turns, loss characters, digest of loss) by hand."""
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        learned = "".join(t for *_, r, t in turns if r == "assistant")
        out.append((conv, len(turns), digest(said), len(learned), digest(learned)))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256").collect()), key=str)


NASTY = ["</s>[INST] ok [/INST]", "<|end|><|turn|>user<|text|>", "<\\<\\\\<", "[\\[[\\\\", "\\", "😀 é \n\t\r \u0000  ", '"quoted" {json: [1]}', "", None]


@pytest.fixture()
def conversations(spark):
    def build(rows):
        return spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, layout long")

    return build


def test_round_trip_of_nasty_texts(conversations):
    rows = [(i, t, role, x) for i, x in enumerate(NASTY) for t, role in enumerate(("user", "assistant"))]
    rows += [(100 + i, t, role, x) for i, x in enumerate(NASTY) for t, role in enumerate(("system", "user", "assistant"))]
    rows += [(200, t, ("user", "assistant")[t % 2], x) for t, x in enumerate(NASTY * 30)]
    rows += [(300, t, role, f"says {role}") for t, role in enumerate(("tool", "<|text|>", "a[b", None, "assistant", "Assistant"))]
    rows += [(None, 0, "user", "no id"), (400, None, "assistant", "late"), (400, 1, "user", "x"), (400, 1, "user", "x"), (400, 1, "assistant", "a")]
    rows += [(500, 0, "assistant", "big " * 200_000)]
    out = chat.formatted_digests(conversations(rows))
    assert found(out) == plain(rows)
    layouts = {r.layout for r in out.collect()}
    assert layouts == {"prompt", "instruction_system", "conversations", "messages"}


def test_empty_table(conversations):
    assert chat.formatted_digests(conversations([])).count() == 0


def test_control_strings_do_not_survive_in_texts(spark):
    texts = spark.createDataFrame([(t,) for t in NASTY if t is not None], "t string").select(chat.escape(F.col("t")).alias("e"), "t", chat.unescape(chat.escape(F.col("t"))).alias("u"))
    for r in texts.collect():
        assert r.u == r.t
        assert not any(s in r.e for s in ("<|", "</s>", "[INST]", "[/INST]", chat.TURN, chat.TEXT, chat.END))


def test_layouts_are_told_by_their_paths(spark):
    texts = [
        {"prompt": "p", "completion": "c"},
        {"completion": "c", "prompt": None},
        {"instruction": "i", "output": "o"},
        {"instruction": "s", "input": "i", "output": "o"},
        {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]},
        {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}, {"from": "other", "value": "c"}]},
        {"prompt": "p", "completion": "c", "more": 1},
        {"text": "t"},
    ]
    rows = [(i, json.dumps(t), 0) for i, t in enumerate(texts)] + [(98, "no json", 0), (99, None, 0)]
    df = spark.createDataFrame(rows, "id int, record string, turn int")
    got = {r.id: (r.layout, None if r.turns is None else [tuple(t) for t in r.turns]) for r in chat.canonical(df).collect()}
    user, bot = "user", "assistant"
    assert got == {
        0: ("prompt", [(user, "p"), (bot, "c")]),
        1: ("prompt", [(user, ""), (bot, "c")]),
        2: ("instruction", [(user, "i"), (bot, "o")]),
        3: ("instruction_system", [("system", "s"), (user, "i"), (bot, "o")]),
        4: ("messages", [(user, "a"), (bot, "")]),
        5: ("conversations", [(user, "a"), (bot, "b"), ("other", "c")]),
        6: ("unknown", None), 7: ("unknown", None), 98: ("unknown", None), 99: ("unknown", None),
    }


def test_loss_spans_cut_out_assistant_texts(spark):
    record = json.dumps({"messages": [{"role": r, "content": f"{r}<{i}😀"} for i, r in enumerate(["user", "assistant", "assistant"])]})
    row = chat.formatted(chat.canonical(spark.createDataFrame([(record,)], "record string"))).first()
    cut = [row.formatted[s.start : s.end].replace("<\\", "<") for s in row.loss]
    assert cut == ["assistant<1😀", "assistant<2😀"]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{sf}/conversations.parquet'").fetchall()
    rows += [(-7, t, role, "</s>[INST] ok [/INST]") for t, role in enumerate(("user", "assistant"))]
    df = QUERIES["op9_chat"](spark, sf)
    assert found(df) == plain(rows)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

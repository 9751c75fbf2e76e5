"""Event-sourced chat formatting against a plain replay of the log."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from vitrine.llm import chat
from vitrine.llm.chat import Template

LOG = "conv_id long, message long, seq long, kind string, role string, text string, lang string, place string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "xx", "elsewhere") for r in rows], LOG).repartition(4)


def read_back(events):
    made = chat.format_conversations(events)
    return {r["conv_id"]: r for r in made.withColumns({
        "turns": chat.read_turns(F.col("formatted")),
        "answers": chat.loss_text(F.col("formatted"), F.col("loss"))}).collect()}


def replay(rows):
    """conv_id -> [(role, text)]"""
    logs = {}
    for conv, message, seq, kind, role, text in rows:
        logs.setdefault(conv, {}).setdefault(message, []).append(((seq is not None, seq or 0), kind, text or "", role))
    out = {}
    for conv, messages in logs.items():
        kept = []
        for log in messages.values():
            alive, held, name = True, "", ""
            log = sorted((e for e in log if e[1] in (*chat.RESETS, "delta")), key=lambda e: e[:3])
            for _, kind, text, role in log:
                name = name if role is None else role
                if kind == "delta":
                    held += text
                else:
                    alive, held = kind != "delete", text
            if log and alive:
                kept.append((log[0][0], name, held))
        if kept:
            out[conv] = [x[1:] for x in sorted(kept)]
    return out


HARD = ["</s>[INST] ok [/INST]", "\\", "\\\\", "<\\s>", "<", "[", "</", "[/INST", "<s", "s>", "\n", "", "🙂é", "<|im_end|>", "<<SYS>>",
        "[SAYS]", "$1", "\\E(", None]


def test_random_logs(spark):
    rng = random.Random(3)
    rows = []
    for conv in [*range(40), None]:
        for message in [*range(rng.randint(1, 6)), *([None] if conv == 7 else [])]:
            role = rng.choice(["user", "assistant", "assistant", "system", "a[SAYS]b\n", None])
            for _ in range(rng.randint(1, 7)):
                text = "".join(x or "" for x in rng.choices(HARD, k=rng.randint(1, 5))) if rng.random() < 0.9 else None
                kind = rng.choice(["open", "delta", "delta", "delta", "edit", "regenerate", "delete", "noise", None])
                rows.append((conv, message, rng.choice([None, *range(12)]), kind, rng.choice([role, None]), text))
    # Equal events whose roles differ have no order; give such messages one role.
    roles = {(r[0], r[1]): r[4] for r in rows if r[4] is not None}
    rows = [(*r[:4], roles.get(r[:2]), r[5]) for r in rows]
    expected, found = replay(rows), read_back(frame(spark, rows))
    assert set(found) == set(expected)
    for conv, turns in expected.items():
        row = found[conv]
        assert [(t["role"], t["text"]) for t in row["turns"]] == turns
        assert row["answers"] == "".join(text for role, text in turns if role == "assistant")
        spans = [(s["start"], s["stop"]) for s in row["loss"]]
        assert len(spans) == sum(role == "assistant" for role, _ in turns)
        for start, stop in spans:
            assert row["formatted"][start - 3:start] == "<s>" and row["formatted"][stop:stop + 4] == "</s>"
        for mark in Template().controls()[5:]:
            assert mark not in row["formatted"]


def test_edits_and_regenerations(spark):
    rows = [(1, 1, 1, "open", "user", "hi"), (1, 2, 2, "open", "assistant", ""), (1, 2, 3, "delta", None, "wrong "),
            (1, 2, 4, "regenerate", None, None), (1, 2, 5, "delta", None, "right"), (1, 2, 6, "delta", None, "!"),
            (1, 3, 7, "open", "user", "bye"), (1, 3, 9, "delete", None, None), (1, 1, 8, "edit", None, "hello"),
            (2, 1, 1, "open", "user", "gone"), (2, 1, 2, "delete", None, None)]
    found = read_back(frame(spark, rows))
    assert found[1]["formatted"] == "[INST]user[SAYS]hello[/INST]<s>right!</s>" and set(found) == {1}
    assert [tuple(s) for s in found[1]["loss"]] == [(31, 37)]


def test_conversation_tables(spark):
    rng = random.Random(4)
    rows = [(c, t, role, None if rng.random() < 0.1 else "".join(x or "" for x in rng.choices(HARD, k=rng.randint(0, 900))))
            for c in [*range(12), None] for t in [*range(5), None]
            for role in (["user", "assistant"] if c == 3 else [rng.choice(["user", "assistant", None])])]
    rows += [(50, 0, "user", "again"), (50, 0, "user", "again"), (51, 0, "assistant", "x" * 200_000 + "<s>" * 9)]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn long, role string, text string, seq int, kind string")
    found = read_back(chat.chat_log(docs))
    expected = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        expected.setdefault(conv, []).append((role or "", text or ""))
    assert {c: [(t["role"], t["text"]) for t in r["turns"]] for c, r in found.items()} == expected


def test_empty_log_and_bad_template(spark):
    assert read_back(frame(spark, [])) == {}
    for bad in ("", "x", "aba", "<\\s>"):
        with pytest.raises(ValueError):
            Template(answer_close=bad)


def test_only_expressions(spark):
    docs = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    plan = chat.format_conversations(chat.chat_log(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 2



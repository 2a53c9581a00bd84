"""Chat formatting: round trips, spans of black-box templates, templates that rewrite history."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from bellwire.llm import chat_format as C
from bellwire.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
PIECES = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "/", "s>", "INST]", "é", "\n", "a", "\ue000"]))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    convs = defaultdict(list)
    for n, (c, turn, role, text) in enumerate(rows):
        convs[(c, n if c is None else 0)].append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for (c, _), turns in convs.items():
        turns = [t[2:] for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        out.append((c, len(turns), sha(said), len(loss), sha(loss), len(C.instruction_template(turns))))
    return Counter(out)


def test_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    got = QUERIES["op13_chat_format"](spark, SF).collect()
    assert Counter(tuple(r) for r in got) == brute(rows)
    assert {r["conv_id"]: r["loss_chars"] for r in got}[-1] == len(said)


def test_sql(spark):
    from oracle_check import compare, connect

    for name in ("op11_hard_negatives", "op13_chat_format"):
        assert compare(connect(SF), QUERIES[name](spark, SF), entry.oracle_sql()[name]) == []


def test_awkward_rows(spark):
    rows = [
        (1, 2, "assistant", "<s>second</s>"), (1, None, None, None), (1, 2, "assistant", "<s>second</s>"),
        (1, 1, "user", "[INST] \\[/INST]"), (2, 0, "assistant", ""), (None, 0, "user", "a"), (None, 0, "assistant", "b"),
        (3, 0, "[/INST]\ue000</s>", "role of control strings"), (4, 0, "assistant", "long " * 100_000), (5, 1, "system", "<"),
        (6, 0, "assistant", "\ue000 mark"), (6, 1, "assistant", "s>"),
    ]
    clash = {c: F.lit(3) for c in ("formatted", "said", "alone", "turns", "learned")}
    df = spark.createDataFrame(rows, SCHEMA).withColumns(clash).repartition(3)
    got = C.digest(C.format_conversations(df)).collect()
    assert Counter(tuple(r) for r in got) == brute(rows)
    assert C.digest(C.format_conversations(df.where("false"))).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(PIECES.map("".join), PIECES.map("".join)), max_size=4))
def test_escapes_are_reversible(turns):
    turns = [("assistant" if len(r) % 2 else r, t) for r, t in turns]
    out = C.render(turns, C.instruction_template)
    assert C.read_turns(out.text) == turns and out.rewritten_at is None and not out.unmarked
    assert [C.unescaped(out.text[a:b]) for a, b in out.learned] == [t for r, t in turns if r == "assistant"]
    for control in (C.BEGIN, C.END, C.OPEN, C.CLOSE):
        assert out.text.count(control) == len(turns)


TURNS = [("system", "be kind"), ("user", "hi"), ("assistant", "hello"), ("user", "bye"), ("assistant", "hello")]


def spans(out):
    return [out.text[a:b] for a, b in out.turns]


def test_black_boxes():
    def first_turn_differs(turns):
        return "".join(f"[{i}]" * (i == 0) + f"{r}: {t}\n" for i, (r, t) in enumerate(turns))

    out = C.render(TURNS, first_turn_differs)
    assert spans(out)[:2] == ["[0]system: be kind\n", "user: hi\n"] and out.rewritten_at is None
    assert [out.text[a:b] for a, b in out.learned] == ["hello", "hello"]

    def system_text_goes_into_the_user_turn(turns):
        said = [t for r, t in turns if r == "system"]
        return "".join(f"<{r}>{' '.join(said) if r == 'user' else ''}{t}" for r, t in turns if r != "system")

    out = C.render(TURNS, system_text_goes_into_the_user_turn)
    assert spans(out)[:2] == ["", "<user>be kindhi"] and out.rewritten_at is None


@pytest.mark.parametrize(
    "template, at",
    [
        (lambda turns: "".join(t for _, t in turns) + "<end>", 1),
        (lambda turns: f"{len(turns)} turns:" + "".join(t for _, t in turns), 1),
        (lambda turns: "".join(t if i + 3 > len(turns) else "..." for i, (_, t) in enumerate(turns)), 2),
    ],
)
def test_rewritten_history(spark, template, at):
    out = C.render(TURNS, template)
    assert out.rewritten_at == at and len(out.turns) == at and out.text == template(TURNS)
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(TURNS)], SCHEMA)
    row = C.format_conversations(df, template).first()
    assert row["rewritten_at"] == at and row["formatted"] == template(TURNS)


def test_texts_that_a_template_changes():
    assert C.render(TURNS, lambda turns: "".join(f"{r}:{t.upper()};" for r, t in turns)).unmarked == 0
    assert C.render(TURNS, lambda turns: "".join(f"{r}:{t}{t};" for r, t in turns)).unmarked == 2
    assert C.render(TURNS, lambda turns: "".join(f"{r};" for r, t in turns)).unmarked == 2

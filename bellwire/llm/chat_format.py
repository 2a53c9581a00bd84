"""Chat formatting by rendering successive turn prefixes with a template that is a black box."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A template makes one text of the turns (role, text) of a conversation.
Template = Callable[[list[tuple[str, str]]], str]

# The control strings of the template below.
BEGIN, END, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\])")
ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\])")
TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)
# Stands for a turn's text where its place in the output is looked up.
MARK = "\ue000"
LEARNED = ("assistant",)
# Outputs that leave a task together.
OUTPUT_CHARS = 4 << 20


def escaped(text: str) -> str:
    """A text without control strings: each gets one more backslash after its first character."""
    return CONTROL.sub(r"\1\\\2\3", text)


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def instruction_template(turns: list[tuple[str, str]]) -> str:
    """``<s>[INST]role[/INST]text</s>`` for each turn, roles and texts escaped."""
    return "".join(f"{BEGIN}{OPEN}{escaped(role)}{CLOSE}{escaped(text)}{END}" for role, text in turns)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns that ``instruction_template`` wrote."""
    return [(unescaped(m[1]), unescaped(m[2])) for m in TURN.finditer(formatted)]


@dataclass
class Rendered:
    """A conversation's output and, in characters, the span of each turn and of the texts to be learned.

    ``rewritten_at`` is the first turn (from 0) at which the output of the turns so far isn't what the turns before it
    gave and more; from there on no span is known. ``unmarked`` counts learned turns whose text doesn't
    stand once in their span.
    """

    text: str
    turns: list[tuple[int, int]]
    learned: list[tuple[int, int]]
    rewritten_at: int | None
    unmarked: int


def render(turns: list[tuple[str, str]], template: Template, learned: tuple[str, ...] = LEARNED) -> Rendered:
    """Renders the first turn, the first two, and so on; what an output adds to the one before is its turn's span.

    A learned turn is rendered once more with a mark for its text: what stands before and after the mark
    surrounds the text itself. The template sees nothing but turns, so nothing is assumed of its output.
    """
    before, spans, texts, rewritten, unmarked = template([]) if not turns else "", [], [], None, 0
    if not turns:
        return Rendered(before, spans, texts, rewritten, unmarked)
    for k, (role, _) in enumerate(turns):
        now = template(turns[: k + 1])
        if rewritten is None and k and not now.startswith(before):
            rewritten = k
        if rewritten is None:
            spans.append((len(before), len(now)))
            if role in learned:
                found = marked(turns[:k], role, now, before, template)
                if found is None:
                    unmarked += 1
                else:
                    texts.append(found)
        elif k + 1 < len(turns):
            # Only the whole output is still of use.
            before = template(turns)
            break
        before = now
    return Rendered(before, spans, texts, rewritten, unmarked)


def marked(
    past: list[tuple[str, str]], role: str, now: str, before: str, template: Template
) -> tuple[int, int] | None:
    """Where the last turn's text stands in the output ``now``."""
    mark = MARK
    while mark in role:
        mark += MARK
    probe = template([*past, (role, mark)])
    if not probe.startswith(before):
        return None
    head, found, tail = probe[len(before) :].partition(mark)
    if not found or mark in tail:
        return None
    start, end = len(before) + len(head), len(now) - len(tail)
    if start > end or not now.startswith(head, len(before)) or not now.endswith(tail):
        return None
    return start, end


SPANS = "array<struct<start: long, end: long>>"
FORMATTED = f"conv_id long, formatted string, turns {SPANS}, learned {SPANS}, rewritten_at int, unmarked int"


def format_conversations(
    conversations: DataFrame, template: Template = instruction_template, learned: tuple[str, ...] = LEARNED
) -> DataFrame:
    """``conv_id, formatted, turns, learned, rewritten_at, unmarked``: one row per conversation, see ``Rendered``.

    Turns are ordered by ``turn``, nulls first, then role, then text, so that reruns agree; a null role or text
    is empty, and repeated rows are turns of their own. A row without ``conv_id`` is a conversation of one turn without an
    id. An empty table gives no rows; other columns are ignored.

    A conversation's turns make one output, so they come together in one row; conversations share nothing. Since a black
    box may look at all turns, one of n turns is rendered n times, and once more per learned turn.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        # Rows without an id never come together.
        F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).alias("alone"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("said"),
    )
    whole = turns.groupBy("conv_id", "alone").agg(F.sort_array(F.collect_list("said")).alias("said"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

        def pairs(values):
            return pa.array([[{"start": a, "end": b} for a, b in v] for v in values], span)

        held, size = [], 0

        def report():
            ids, outs = zip(*held)
            return pa.record_batch(
                [
                    pa.array(ids, pa.int64()), pa.array([o.text for o in outs], pa.string()),
                    pairs([o.turns for o in outs]), pairs([o.learned for o in outs]),
                    pa.array([o.rewritten_at for o in outs], pa.int32()),
                    pa.array([o.unmarked for o in outs], pa.int32()),
                ],
                names=["conv_id", "formatted", "turns", "learned", "rewritten_at", "unmarked"],
            )

        for batch in batches:
            for conv, said in zip(batch["conv_id"], batch["said"]):
                out = render([(t["role"], t["text"]) for t in said.as_py()], template, learned)
                held.append((conv.as_py(), out))
                size += len(out.text)
                if size >= OUTPUT_CHARS:
                    yield report()
                    held, size = [], 0
        if held:
            yield report()

    return whole.select("conv_id", "said").mapInArrow(run, FORMATTED)


def digest(formatted: DataFrame) -> DataFrame:
    """What is read back from outputs of ``instruction_template`` and their spans: counts and digests.

    ``turns_sha256`` is of role, line feed, text, line feed of each turn; ``loss_chars`` and ``loss_sha256`` are of
    the texts under the loss mask, without escapes and with nothing between. Turns that are read elsewhere than at the
    spans fail the job.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                text = r["formatted"]
                turns = read_turns(text)
                spans = [(s["start"], s["end"]) for s in r["turns"]]
                if [m.span() for m in TURN.finditer(text)] != spans or r["unmarked"]:
                    raise ValueError(f"conversation {r['conv_id']} can't be read back")
                said = "".join(f"{role}\n{words}\n" for role, words in turns)
                loss = "".join(unescaped(text[s["start"] : s["end"]]) for s in r["learned"])
                rows.append(
                    (
                        r["conv_id"], len(turns), hashlib.sha256(said.encode()).hexdigest(),
                        len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text),
                    )
                )
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    kinds = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.mapInArrow(run, kinds)

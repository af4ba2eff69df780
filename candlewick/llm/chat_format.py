"""Chat formatting by incremental black-box rendering.

The template is a black box ``render(turns) -> str``. Successive prefixes of a conversation are rendered; what one prefix adds
to the output of the one before is the span of its last turn. A second rendering with a mark in place of the last text tells
where the text begins inside the span. A template whose output of a longer prefix does not begin with the output of the
shorter one rewrites history: such conversations are flagged, get no spans and no loss mask.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import runs

Turn = tuple[str, str]
MARK = "\ue000"


@dataclass(frozen=True)
class Template:
    """``render`` gets escaped turns; ``read_role`` finds the escaped role in what stands before a text."""

    render: Callable[[list[Turn]], str]
    read_role: Callable[[str], str]
    controls: tuple[str, ...]


def render_marked(turns: list[Turn]) -> str:
    return "<s>" + "".join(f"<|turn|>{role}\n{text}</s>" for role, text in turns)


def role_of_marked(header: str) -> str:
    return header[header.rindex("<|turn|>") + len("<|turn|>") : -1]


#: Marks every turn with its role; appends only.
MARKED = Template(render_marked, role_of_marked, ("<s>", "</s>", "<|turn|>", "[INST]", "[/INST]"))


def escape(text: str, controls: tuple[str, ...]) -> str:
    """Replace control strings by ``\\c<number>;`` and double backslashes; ``unescape`` undoes both."""
    number = {c: i for i, c in enumerate(controls)}
    found = re.compile("|".join(re.escape(c) for c in ("\\", *sorted(controls, key=len, reverse=True))))
    return found.sub(lambda m: "\\\\" if m[0] == "\\" else f"\\c{number[m[0]]};", text)


def unescape(text: str, controls: tuple[str, ...]) -> str:
    return re.sub(r"\\\\|\\c(\d+);", lambda m: "\\" if m[1] is None else controls[int(m[1])], text)


def locate(turns: list[Turn], template: Template) -> tuple[str, list[tuple[int, int, int, int]], int | None]:
    """Output for all turns, (start, end, text start, text end) of each, and the first turn that rewrote history, if any."""
    before, spans = template.render([]), []
    for k, (role, text) in enumerate(turns):
        now = template.render(turns[: k + 1])
        probe = template.render([*turns[:k], (role, MARK)])
        if not (now.startswith(before) and probe.startswith(before)):
            return template.render(turns), [], k
        at = probe.index(MARK, len(before))
        if now[at : at + len(text)] != text:  # the template changed the text itself
            return template.render(turns), [], k
        spans.append((len(before), len(now), at, at + len(text)))
        before = now
    return before, spans, None


def format_conversations(
    df: DataFrame, template: Template = MARKED, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, turns, rewrites``.

    ``turns`` holds, read back from ``formatted``: role, text, start, end, text_start, text_end (code points, end exclusive) and
    loss (the text is trained on). ``rewrites`` is the first turn position at which the template changed earlier output; then
    ``turns`` is empty. Turns are taken by number, equal numbers by role and text, null numbers first; null roles and texts
    count as empty; rows without a conversation id form one conversation with a null id. An empty table gives an empty result.
    A conversation becomes one row, so it must fit into a task; rows of a conversation arrive sorted and streamed, and a
    partition holds one conversation at a time.
    """
    names = [*template.controls, "\n", MARK]  # what a role may not show in the output

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["conv_id"]):
            roles = ["" if r is None else r for r in table.column("role").to_pylist()]
            texts = ["" if x is None else x for x in table.column("text").to_pylist()]
            turns = [(escape(r, tuple(names)), escape(x, template.controls)) for r, x in zip(roles, texts, strict=True)]
            out, spans, rewritten = locate(turns, template)
            read = []
            for start, end, a, b in spans:
                name = unescape(template.read_role(out[start:a]), tuple(names))
                read.append({"role": name, "text": unescape(out[a:b], template.controls), "start": start, "end": end, "text_start": a, "text_end": b, "loss": name == trained})
            yield pa.RecordBatch.from_pylist([{"conv_id": table.column("conv_id")[0].as_py(), "formatted": out, "turns": read, "rewrites": rewritten}], schema)

    kind = df.schema[conv].dataType.simpleString()
    fields = f"conv_id {kind}, formatted string, turns array<struct<role:string,text:string,start:bigint,end:bigint,text_start:bigint,text_end:bigint,loss:boolean>>, rewrites int"
    span = pa.struct([("role", pa.string()), ("text", pa.string()), *((n, pa.int64()) for n in ("start", "end", "text_start", "text_end")), ("loss", pa.bool_())])
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([("conv_id", to_arrow_type(df.schema[conv].dataType)), ("formatted", pa.string()), ("turns", pa.list_(span)), ("rewrites", pa.int32())])
    sorted_turns = (
        df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    return sorted_turns.mapInArrow(rows, fields)

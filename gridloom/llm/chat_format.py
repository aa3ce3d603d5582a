r"""Chat formatting with a grammar round trip.

Grammar of the rendered text, one production a turn, whatever the order of the roles:

    turn  := "<s>[" role "]" level body "</s>"        level := "" | "#1"
    role  := "user" -> INST, "assistant" -> OUT, "system" -> SYS, else ROLE:<role in level-1 escapes>

A deterministic parser reads it back. Each turn starts plain. Where what is read back differs from the source, as when
a text itself holds a control string, that turn goes to level 1: every backslash, and the first character of every
control string, gets a backslash before it. That repeats until source and recovered turns are the same.

Defined results: a null text is empty; a null role is the role "" ; turns are ordered by (turn, role, text) with nulls
first, so ties have one order; repeated rows are turns of their own; no rows of conversations leave just the added
conversation; extra columns are ignored. Roles are compared as they are, in any case and script.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import pick, table

#: The control strings of the template.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "[OUT]", "[SYS]", "[ROLE:"]
_NAMES = {"user": "INST", "assistant": "OUT", "system": "SYS"}
_ROLES = {v: k for k, v in _NAMES.items()}
_ESCAPE = re.compile("|".join(map(re.escape, ["\\", *CONTROL])))
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
_HEAD = re.compile(r"<s>\[(INST|OUT|SYS|ROLE:((?:[^\]\\]|\\.)*))\](#1)?", re.DOTALL)

Turn = tuple[str, str]


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def _head(role: str) -> str:
    return _NAMES.get(role) or "ROLE:" + re.sub(r"([\\\]\[<])", r"\\\1", role)


def render(turns: list[Turn], levels: list[int]) -> str:
    return "".join(f"<s>[{_head(role)}]" + (f"#1{escape(text)}" if level else text) + "</s>" for (role, text), level in zip(turns, levels, strict=True))


def _close(rendered: str, at: int, escaped: bool) -> int:
    """Where the turn's "</s>" is; in an escaped body, one behind a backslash is text."""
    while (at := rendered.find("</s>", at)) >= 0:
        if not escaped:
            return at
        back = at
        while rendered[back - 1] == "\\":
            back -= 1
        if (at - back) % 2 == 0:
            return at
        at += 1
    return -1


def parse(rendered: str) -> list[tuple[str, str, int, int]] | None:
    """Role, text, and the span of the body as rendered, for each turn; None if the grammar does not fit."""
    out, at = [], 0
    while at < len(rendered):
        if not (head := _HEAD.match(rendered, at)) or (end := _close(rendered, head.end(), bool(head[3]))) < 0:
            return None
        body = rendered[head.end() : end]
        out.append((_ROLES.get(head[1]) or unescape(head[2] or ""), unescape(body) if head[3] else body, head.end(), end))
        at = end + 4
    return out


def format_turns(turns: list[Turn]) -> tuple[str, list[tuple[int, int]], list[Turn]]:
    """The rendered text, the spans under the loss mask, and the turns read back, which equal the given ones."""
    levels = [0] * len(turns)
    while True:
        rendered = render(turns, levels)
        back = parse(rendered)
        if back is not None and [x[:2] for x in back] == turns:
            return rendered, [(a, b) for role, _, a, b in back if role == "assistant"], [x[:2] for x in back]
        worse = [i for i, (turn, level) in enumerate(zip(turns, levels, strict=True)) if not level and [x[:2] for x in parse(render([turn], [0])) or []] != [turn]]
        if not worse:
            worse = [i for i, level in enumerate(levels) if not level]
        if not worse:
            raise ValueError("turns do not survive the round trip")
        for i in worse:
            levels[i] = 1


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text): conv_id, formatted, loss_spans and the turns read back.

    loss_spans: starts and ends, in code points of formatted, of the assistants' texts. One row holds one conversation.
    """
    said = pick(conversations, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("said"),
    )
    grouped = said.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                done = [format_turns([(x["role"], x["text"]) for x in said]) for said in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([x[0] for x in done], pa.string()),
                        pa.array([[{"start": a, "end": b} for a, b in x[1]] for x in done], spans),
                        pa.array([[{"role": r, "text": t} for r, t in x[2]] for x in done], kind),
                    ],
                    names=["conv_id", "formatted", "loss_spans", "turns"],
                )

    return grouped.mapInArrow(formatted, "conv_id long, formatted string, loss_spans array<struct<start:int,end:int>>, turns array<struct<role:string,text:string>>")


#: The contract's added conversation.
ADDED = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests, all taken from the formatted text: its turns are parsed and unescaped again."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                turns = parse(text) or []
                escaped = {a: text[a - 2 : a] == "#1" for _, _, a, _ in turns}
                loss = "".join(unescape(text[s["start"] : s["end"]]) if escaped[s["start"]] else text[s["start"] : s["end"]] for s in spans)
                whole = "".join(f"{role}\n{body}\n" for role, body, _, _ in turns)
                rows.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    slim = formatted.select("conv_id", "formatted", "loss_spans")
    return slim.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = pick(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    added = spark.createDataFrame(ADDED, "conv_id long, turn long, role string, text string")
    return digests(format_conversations(conversations.unionByName(added)))


SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, CASE role WHEN 'user' THEN 4 WHEN 'assistant' THEN 3 WHEN 'system' THEN 3 ELSE 5 + length(role) END AS head,
         len(regexp_extract_all(text, '\\|<s>|</s>|\[INST\]|\[/INST\]|\[OUT\]|\[SYS\]|\[ROLE:')) AS marks,
         (strpos(text, '</s>') > 0 OR starts_with(text, '#1')) AS conflict FROM said
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(9 + head + length(text) + CASE WHEN conflict THEN 2 + marks ELSE 0 END)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

"""Conversations as formatted text with the intervals that a model learns from.

A compiled template (``chat_template``) renders every turn where it is read, without a shuffle,
unless it asks for the turn's place.  The rendered turns are then brought together by conversation
in order and written as pieces of bounded length, cut between turns, so that a conversation of any
length passes through a task as a stream.  ``read_back`` reads turns and learned text from such
pieces again.  A digest over a whole conversation is sequential by its nature: the turns of one
conversation end in one task, which holds one batch and two hash states of it.

Defined results
    NULL role or text: empty.  NULL turn: before the others.  Turns alike in number: in the order of
    their formatted text; repeated rows are turns of their own.  NULL conv_id: one conversation.
    Empty table: empty result.  Further columns are ignored."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm import common as C
from larder.llm.chat_template import Template, TemplateError

OPEN, CLOSE = "<turn>", "</turn>"

#: Turns between markers, the role on a line of its own; what the assistant says is learned.
TURNS = """{%- control "<turn>", "</turn>" -%}
{%- for m in messages -%}
<turn>{{ m.role | escape_line }}
{% if m.role == "assistant" %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}</turn>
{% endfor -%}
"""

PART = "turn_text string, starts array<int>, ends array<int>"
PIECE = "piece long, text string, starts array<int>, ends array<int>"


@dataclass(frozen=True)
class FormatParams:
    template: str = TURNS
    #: A piece is closed before the turn that would make it longer (a longer turn stands alone).
    piece_chars: int = 1_000_000


def format_turns(conversations: DataFrame, template: Template) -> DataFrame:
    """``conv_id, turn, turn_text, starts, ends``: a row for every row of ``conversations`` (conv_id, turn,
    role, text)."""
    C.ship(conversations.sparkSession)
    empty = F.lit("")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    places: list[str] = []
    if template.positional:
        order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
        places = ["index0", "last"]
        rows = rows.withColumn("index0", F.row_number().over(order) - 1).withColumn("last", F.lead(F.lit(True)).over(order).isNull())
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches):
        for batch in batches:
            ids, turns, roles, texts = (batch.column(i) for i in range(4))
            loops = [None] * batch.num_rows
            if places:
                loops = [{"index0": i, "index": i + 1, "first": i == 0, "last": last}
                         for i, last in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())]
            found = [template.turn({"role": r, "text": t}, loop) for r, t, loop in zip(roles.to_pylist(), texts.to_pylist(), loops)]
            yield pa.RecordBatch.from_arrays(
                [ids, turns, pa.array([f[0] for f in found], pa.string()), pa.array([[s[0] for s in f[1]] for f in found], pa.list_(pa.int32())),
                 pa.array([[s[1] for s in f[1]] for f in found], pa.list_(pa.int32()))], ["conv_id", "turn", "turn_text", "starts", "ends"])

    return rows.select("conv_id", "turn", "role", "text", *places).mapInArrow(run, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, {PART}")


def format_conversations(conversations: DataFrame, params: FormatParams = FormatParams(), constants: dict | None = None) -> DataFrame:
    """``conv_id, piece, text, starts, ends``: the formatted text of every conversation in pieces (from 0),
    and the intervals of code points of a piece that a model learns from.  The pieces of one
    conversation stand in one partition, in order."""
    template = Template(params.template, constants)
    parts = format_turns(conversations, template)
    kind = parts.schema["conv_id"].dataType.simpleString()
    limit = params.piece_chars

    def assemble(batches):
        rows: list[tuple] = []
        texts, starts, ends = [], [], []
        length = piece = size = 0
        now, begun = None, False

        def add(text, own_starts, own_ends):
            nonlocal length, piece
            if texts and length + len(text) > limit:
                close()
            texts.append(text)
            starts.extend(s + length for s in own_starts)
            ends.extend(e + length for e in own_ends)
            length += len(text)

        def close():
            nonlocal length, piece, size
            rows.append((now, piece, "".join(texts), list(starts), list(ends)))
            size += length
            length, piece = 0, piece + 1
            for kept in (texts, starts, ends):
                kept.clear()

        def finish():
            add(template.tail[0], [s for s, _ in template.tail[1]], [e for _, e in template.tail[1]])
            close()

        def batch_of():
            kinds = [ids_kind, pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["conv_id", "piece", "text", "starts", "ends"])
            rows.clear()
            return out

        ids_kind = None
        for batch in batches:
            ids_kind = batch.column(0).type
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for conv_id, text, own_starts, own_ends in zip(*columns):
                if not begun or conv_id != now:
                    if begun:
                        finish()
                    now, begun, piece = conv_id, True, 0
                    add(template.head[0], [s for s, _ in template.head[1]], [e for _, e in template.head[1]])
                add(text, own_starts, own_ends)
                if size > limit or len(rows) >= 10_000:
                    if rows:
                        yield batch_of()
                    size = 0
        if begun:
            finish()
            yield batch_of()

    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "turn_text")
    return ordered.select("conv_id", "turn_text", "starts", "ends").mapInArrow(assemble, f"conv_id {kind}, {PIECE}")


def turn_reader(control: tuple[str, ...] = (OPEN, CLOSE)) -> re.Pattern:
    """Matches one turn of ``TURNS``: the escaped role, then the escaped text."""
    guarded = Template(TURNS).escaper.guarded
    return re.compile(f"{re.escape(control[0])}((?:\\\\.|[^\\\\\n])*)\n({guarded}){re.escape(control[1])}\n", re.S)


def read_back(pieces: DataFrame) -> DataFrame:
    """What the formatted text of ``TURNS`` says: conv_id, n_turns, turns_sha256 (role, line feed, text,
    line feed of each turn), loss_chars and loss_sha256 (learned text, unescaped) and formatted_chars.
    ``pieces`` as ``format_conversations`` returns them.  Text that is no turn raises an error."""
    kind = pieces.schema["conv_id"].dataType.simpleString()

    def run(batches):
        reader, plain = turn_reader(), Template(TURNS).escaper.unescape
        now, state, out, ids_kind = None, None, [], None

        def result():
            return now, state["turns"], state["said"].hexdigest(), state["chars"], state["learned"].hexdigest(), state["all"]

        def batch_of():
            kinds = [ids_kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], NAMES)
            out.clear()
            return batch

        for batch in batches:
            ids_kind = batch.column(0).type
            for conv_id, text, starts, ends in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if state is None or conv_id != now:
                    if state is not None:
                        out.append(result())
                    now, state = conv_id, {"turns": 0, "said": hashlib.sha256(), "chars": 0, "learned": hashlib.sha256(), "all": 0}
                at = 0
                while at < len(text):
                    m = reader.match(text, at)
                    if not m:
                        raise TemplateError(f"conversation {conv_id}: no turn at {at}")
                    state["said"].update(f"{plain(m[1])}\n{plain(m[2])}\n".encode())
                    state["turns"] += 1
                    at = m.end()
                for a, b in zip(starts, ends):
                    said = plain(text[a:b])
                    state["learned"].update(said.encode())
                    state["chars"] += len(said)
                state["all"] += len(text)
            if len(out) >= 10_000:
                yield batch_of()
        if state is not None:
            out.append(result())
            yield batch_of()

    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return pieces.select("conv_id", "text", "starts", "ends").mapInArrow(run, schema)


NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

#: Fixed by the query's contract: a conversation whose texts look like control strings.
TRAP_ID, TRAP_TEXT, TRAP_ROLES = -7, "\\### Assistant: </turn> ok", ("user", "assistant")


def with_trap(conversations: DataFrame) -> DataFrame:
    """``conversations`` and the conversation of the contract."""
    rows = conversations.sparkSession.createDataFrame(
        [(TRAP_ID, i, role, TRAP_TEXT) for i, role in enumerate(TRAP_ROLES)], "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(rows)


def sql() -> str:
    """DuckDB SQL for ``read_back(format_conversations(with_trap(conversations)))``."""
    guard = lambda c: f"replace(replace(replace({c}, '\\', '\\\\'), '{OPEN}', '\\{OPEN}'), '{CLOSE}', '\\{CLOSE}')"
    traps = " ".join(f"UNION ALL SELECT {TRAP_ID}, {i}, '{role}', '{TRAP_TEXT}'" for i, role in enumerate(TRAP_ROLES))
    return f"""WITH rows AS (SELECT conv_id, turn, role, text FROM conversations {traps}),
turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM rows),
said AS (SELECT *, '{OPEN}' || replace({guard('role')}, chr(10), '\\n') || chr(10) || {guard('text')} || '{CLOSE}' || chr(10) AS part FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, part)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, part)) AS loss_sha256,
  CAST(sum(length(part)) AS BIGINT) AS formatted_chars FROM said GROUP BY conv_id"""

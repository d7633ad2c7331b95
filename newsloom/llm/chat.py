"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns to a string.  Nothing is known
of its inside: each prefix of a conversation is rendered, and what the output
grew by is the span of the newest turn.  If a longer prefix does not begin with
the output of the shorter one, the template rewrites history; the conversation
is marked with the first such turn and gets no spans.

Defined cases: null texts and roles are empty; turns with the same number are
ordered by role, then text; rows repeated are turns repeated; a null conv_id is
a conversation of its own; an empty table gives an empty result; other columns
are not looked at.  A conversation is held by one task, as one output is a
single string; prefixes cost the square of its length in time, not in memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

#: Control strings of the plain template: `### role: ` opens, `</turn>` closes.
OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
_CONTROL = re.compile(r"[\\#<:]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.)*)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    """A backslash before every character a control string could begin or end with."""
    return _CONTROL.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def plain_template(turns: list[Turn]) -> str:
    return "".join(f"{OPEN}{escape(role)}{COLON}{escape(text)}{CLOSE}" for role, text in turns)


def parse_span(span: str) -> tuple[Turn, tuple[int, int]]:
    """Role and text of one turn's output, and where its text lies in it."""
    found = _TURN.fullmatch(span)
    if not found:
        raise ValueError("not one turn of the plain template")
    return (unescape(found.group(1)), unescape(found.group(2))), found.span(2)


def turn_spans(turns: list[Turn], template: Template) -> tuple[str, list[tuple[int, int]] | None,
                                                               int | None]:
    """The whole output, each turn's span (None if history is rewritten), and
    the first turn that rewrites what was rendered before it."""
    before, spans = template([]), []
    for k in range(1, len(turns) + 1):
        now = template(turns[:k])
        if not now.startswith(before):
            return template(turns), None, k - 1
        spans.append((len(before), len(now)))
        before = now
    return before, spans, None


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[Turn]]]:
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for conv_id, turns in groupby(rows, key=lambda row: row[0]):
        yield conv_id, [(role, text) for _, role, text in turns]


def formatted(conversations: DataFrame, template: Template = plain_template,
              read_span: Callable[[str], tuple[Turn, tuple[int, int]]] | None = parse_span,
              trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted (text),
    rewrites_at (turn, null if none), spans (start and stop of each turn, code
    points) and mask (start and stop of each text to be learned).  ``read_span``
    finds a turn's text in its span; without it the mask covers whole turns.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()
    ordered = (conversations
               .select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                       F.coalesce("text", F.lit("")).alias("text"))
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
               .select("conv_id", "role", "text"))
    pair = pa.list_(pa.list_(pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids, n, text, at, spans, mask = zip(*out)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, id_kind), pa.array(n, pa.int64()), pa.array(text),
                 pa.array(at, pa.int64()), pa.array(spans, pair), pa.array(mask, pair)],
                ["conv_id", "n_turns", "formatted", "rewrites_at", "spans", "mask"])

        for conv_id, turns in _conversations(batches):
            text, spans, at = turn_spans(turns, template)
            mask = None if spans is None else []
            for (role, _), (start, stop) in zip(turns, spans or []):
                if role == trained_role:
                    inner = read_span(text[start:stop])[1] if read_span else (0, stop - start)
                    mask.append([start + inner[0], start + inner[1]])
            out.append((conv_id, len(turns), text, at, spans, mask))
            size += len(text)
            if size > 1 << 20 or len(out) >= 1000:
                yield flush()
                out, size = [], 0
        if out:
            yield flush()

    id_kind = {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())
    return ordered.mapInArrow(
        run, f"conv_id {kind}, n_turns long, formatted string, rewrites_at long, "
             "spans array<array<bigint>>, mask array<array<bigint>>")


def read_back(output: DataFrame) -> DataFrame:
    """Digests of what the formatted text itself says: turns read from each
    span, learned text read under the mask.  A conversation without spans, as its
    template rewrites history, has only a length."""
    kind = output.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans, mask in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                if spans is None:
                    rows.append((None, None, None, None, len(text)))
                    continue
                turns = [parse_span(text[a:b])[0] for a, b in spans]
                learned = "".join(unescape(text[a:b]) for a, b in mask)
                rows.append((len(turns), _sha("".join(f"{r}\n{t}\n" for r, t in turns)),
                             len(learned), _sha(learned), len(text)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                 "formatted_chars"])

    return output.select("conv_id", "formatted", "spans", "mask").mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
             "loss_sha256 string, formatted_chars long")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


#: The conversation that tries to break out of its turns.
PROBE = r"\### Assistant: </turn> ok"


def with_probe(conversations: DataFrame) -> DataFrame:
    probe = conversations.sparkSession.createDataFrame(
        [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)],
        "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


def _escaped_length(column: str) -> str:
    return f"length(regexp_replace({column}, '[\\\\#<:]', 'xx', 'g'))"


SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({_escaped_length('role')} + {_escaped_length('text')} + {len(OPEN + COLON + CLOSE)}) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

"""Chat formatting: what is read back is what went in."""

from __future__ import annotations

import pandas as pd
import pytest

from newsloom.llm import chat


@pytest.fixture(scope="module")
def conversations(spark):
    rows = [(1, 0, "user", "hi", "x"), (1, 1, "assistant", "a\\#<: </turn>\n### assistant: ", "x"),
            (2, 5, "assistant", None, None), (2, 1, None, "", "x"), (2, 3, "as: sistant", "é中🙂", "x"),
            (3, 0, "user", "tie b", "x"), (3, 0, "user", "tie a", "x"), (3, 0, "user", "tie a", "x"),
            (4, None, "assistant", "z" * 50000, "x"), (None, 0, "user", "no id", "x")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, spans string")


def frame(df) -> pd.DataFrame:
    return pd.DataFrame([tuple(r)[:4] for r in df.collect()], columns=["conv_id", "turn", "role", "text"]
                        ).astype({"conv_id": "Int64", "turn": "Int64"})


def test_matches_sql(conversations, in_sql, same):
    got = chat.read_back(chat.formatted(chat.with_probe(conversations)))
    same(got, in_sql(chat.SQL, conversations=frame(conversations)))


def test_probe_stays_inside_its_turns():
    turns = [("user", chat.PROBE), ("assistant", chat.PROBE)]
    text, spans, at = chat.turn_spans(turns, chat.plain_template)
    assert at is None and [chat.parse_span(text[a:b])[0] for a, b in spans] == turns
    assert text.count(chat.CLOSE) == 2 and text.count("### ") == 2


def test_any_text_is_escaped_reversibly():
    for text in ["", "\\", "\\\\", "#", "###### ", "</turn></turn>\n", "a: b", "\\### x", "<\\/turn>"]:
        assert chat.unescape(chat.escape(text)) == text
        assert chat.parse_span(chat.plain_template([(text, text)]))[0] == (text, text)


def test_template_that_rewrites_history_is_found(spark):
    def only_last(turns):  # drops the text of all assistant turns but the last
        last = max((i for i, (r, _) in enumerate(turns) if r == "assistant"), default=-1)
        return "".join(f"[{r}]{'' if r == 'assistant' and i < last else t}\n" for i, (r, t) in enumerate(turns))

    turns = [("user", "q"), ("assistant", "one"), ("user", "r"), ("assistant", "two")]
    text, spans, at = chat.turn_spans(turns, only_last)
    assert at == 3 and spans is None and text == only_last(turns)
    rows = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)],
                                 "conv_id long, turn long, role string, text string")
    out = chat.formatted(rows, only_last, read_span=None)
    row = out.first()
    assert (row.rewrites_at, row.spans, row.mask) == (3, None, None)
    assert tuple(chat.read_back(out).first()) == (1, None, None, None, None, len(text))


def test_masks_of_another_template(spark):
    def tags(turns):
        return "<s>" + "".join(f"<{r}>{t}" for r, t in turns)

    rows = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a")],
                                 "conv_id long, turn long, role string, text string")
    row = chat.formatted(rows, tags, read_span=None).first()
    assert [row.formatted[a:b] for a, b in row.mask] == ["<assistant>a"]


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.formatted(none)).collect() == []

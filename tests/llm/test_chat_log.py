import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.llm import chat_log

LOG = "conv_id bigint, msg bigint, seq bigint, kind string, role string, text string"


def rendered(spark, events):
    return {r["conv_id"]: r for r in chat_log.render(chat_log.fold_events(spark.createDataFrame(events, LOG))).collect()}


def test_events_are_folded(spark):
    events = [
        (1, 0, 1, "open", "user", None),
        (1, 0, 2, "delta", None, "Hel"),
        (1, 0, 3, "delta", None, "lo"),
        (1, 1, 9, "delta", None, "new"),
        (1, 1, 4, "open", "assistant", None),
        (1, 1, 5, "delta", None, "old"),
        (1, 1, 6, "regenerate", None, None),
        (1, 1, 7, "delta", None, "a "),
        (1, 2, 10, "open", "user", None),
        (1, 2, 11, "delta", None, "draft"),
        (1, 2, 12, "edit", None, "final"),
        (1, 2, 13, "delta", None, "!"),
    ]
    row = rendered(spark, events)[1]
    assert chat_log.parse(row["formatted"]) == [("user", "Hello"), ("assistant", "a new"), ("user", "final!")]
    (start, end) = row["loss"]
    assert row["formatted"][start:end] == "a new"


def test_order_of_arrival_does_not_matter(spark):
    events = [(3, m, s, k, r, t) for m in range(3) for s, k, r, t in ((0, "open", "user", None), (1, "delta", None, "x"), (2, "delta", None, "y"))]
    assert rendered(spark, events)[3] == rendered(spark, events[::-1])[3]


def test_missing_open_and_empty_log(spark):
    assert chat_log.parse(rendered(spark, [(5, 0, 0, "delta", None, "t")])[5]["formatted"]) == [("", "t")]
    assert chat_log.render(chat_log.fold_events(spark.createDataFrame([], LOG))).collect() == []


def test_query_digests(spark):
    rows = [
        (1, 0, "user", "\\### <turn user>\n</turn>\n"), (1, 1, "assistant", None), (1, 2, "assistant", "é\n😀" * 900),
        (2, 0, None, "a"), (2, 0, None, "a"), (2, 0, "b", "z"), (None, None, "user", ""),
    ]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = chat_log.read_back(chat_log.render(chat_log.fold_events(chat_log.as_events(table))))
    got = {r["conv_id"]: r for r in out.collect()}
    assert len(got) == 3
    for conv, r in got.items():
        mine = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] or 0, x[2] or "", x[3] or ""))
        text = "".join(f"{role or ''}\n{body or ''}\n" for _, _, role, body in mine)
        loss = "".join(body or "" for _, _, role, body in mine if role == "assistant")
        assert r["n_turns"] == len(mine)
        assert r["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


@settings(deadline=None, max_examples=200)
@given(st.lists(st.tuples(st.text(), st.text(alphabet="<>\\/turn \né"))))
def test_parse_inverts_the_template(turns):
    def escape(text):
        return text.replace("\\", "\\\\").replace("<", "\\<").replace(">", "\\>")

    text = "".join(f"<turn {escape(role)}>\n{escape(body)}\n</turn>\n" for role, body in turns)
    assert chat_log.parse(text) == turns


def test_foreign_text_is_refused():
    with pytest.raises(ValueError):
        chat_log.parse("<turn a>\nb</turn>\n")

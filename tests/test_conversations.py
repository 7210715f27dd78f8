from pyspark.sql import functions as F

from callgrain.operators.conversations import tag_conversations
from callgrain.operators.interactions import directed_interactions
from callgrain.params import Calendar, FeatureParams
from callgrain.plans.features import FEATURES
from conftest import START, as_set, cell

EPOCH = 1704103200  # START


def tags(df, caller="A", **params):
    rows = tag_conversations(df, FeatureParams(**params)).where(F.col("caller_id") == caller)
    return [
        (r.direction, r.txn_type, r.wait, None if r.conversation is None else r.conversation - EPOCH)
        for r in rows.orderBy("timestamp", "event_id", "direction").collect()
    ]


def test_epoch():
    assert START.isoformat() == "2024-01-01T10:00:00"


def test_break_at_exactly_the_wait(records):
    df = records(*[{"at": t, "type": "text"} for t in (0, 3599, 7199)])
    assert tags(df) == [
        ("out", "text", None, 0), ("out", "text", 3599, 0), ("out", "text", 3600, 7199),
    ]
    assert [t[0] for t in tags(df, "B")] == ["in"] * 3
    assert [t[2:] for t in tags(df, "B")] == [t[2:] for t in tags(df)]
    assert [t[3] for t in tags(df, max_wait=10_000)] == [0, 0, 0]


def test_call_breaks(records):
    df = records({"at": 0, "type": "text"}, {"at": 20, "type": "call"}, {"at": 40, "type": "text"})
    assert [t[3] for t in tags(df)] == [0, None, 40]


def test_other_types_do_not_break(records):
    df = records({"at": 0, "type": "text"}, {"at": 20, "type": "mms"}, {"at": 40, "type": "text"})
    assert [t[3] for t in tags(df)] == [0, None, 0]


def test_text_without_opening(records):
    # The first record is of another type and recent: no text opens, so there is no conversation.
    df = records({"at": 0, "type": "mms"}, {"at": 20, "type": "text"})
    assert [t[3] for t in tags(df)] == [None, None]


def test_pairs_are_separate(records):
    df = records({"at": 0, "type": "text"}, {"at": 10, "b": "C", "type": "text"}, {"at": 20, "type": "text"})
    assert tags(df) == [("out", "text", None, 0), ("out", "text", None, 10), ("out", "text", 20, 0)]


def test_call_to_oneself_is_seen_twice(records):
    df = records({"at": 0, "b": "A", "type": "text"}, {"at": 60, "b": "A", "type": "text"})
    assert tags(df) == [
        ("in", "text", None, 0), ("out", "text", 0, 0), ("in", "text", 60, 0), ("out", "text", 0, 0),
    ]
    plain = directed_interactions(df, Calendar()).select("caller_id", "recipient_id", "direction", "event_id")
    tagged = tag_conversations(df, FeatureParams()).select("caller_id", "recipient_id", "direction", "event_id")
    assert as_set(plain) == as_set(tagged) and plain.count() == tagged.count() == 4


def test_missing_parties_are_left_out(records):
    df = records({"at": 0, "b": None}, {"at": 5})
    assert tag_conversations(df, FeatureParams()).count() == 2


def test_reply_delay_in_all_cells(inputs):
    got = inputs({"at": 0, "a": "B", "b": "A", "type": "text"}, {"at": 60, "type": "text"})
    delays = FEATURES["response_delay_text"].long(got)
    for weekday in ("weekday", "allweek"):
        for daytime in ("day", "allday"):
            row = cell(delays, "A", weekday, daytime)
            assert (row.mean, row.median, row.std, row.skewness) == (60.0, 60, 0.0, None)
            assert cell(delays, "B", weekday, daytime).mean is None
    assert delays.count() == 8


def test_no_reply_across_conversations(inputs):
    got = inputs(
        {"at": 0, "a": "B", "b": "A", "type": "text"}, {"at": 30, "type": "call"}, {"at": 60, "type": "text"},
    )
    assert cell(FEATURES["response_delay_text"].long(got)).mean is None
    assert cell(FEATURES["response_rate_text"].long(got)).value == 0.0


def test_initiated_and_answered(inputs):
    hours = [0, 10_000, 20_000, 30_000]
    texts = [{"at": t, "a": "B", "b": "A", "type": "text"} for t in hours] + [
        {"at": 10_060, "type": "text"}, {"at": 40_000, "type": "text"},
    ]
    got = inputs(*texts)
    assert cell(FEATURES["percent_initiated_conversations"].long(got), "A").value == 0.2
    assert cell(FEATURES["percent_initiated_conversations"].long(got), "B").value == 0.8
    assert cell(FEATURES["response_rate_text"].long(got), "A").value == 0.25
    assert cell(FEATURES["response_rate_text"].long(got), "B").value == 0.0

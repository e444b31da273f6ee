import base64

from broadsheet.operators.mime import select_bodies, to_messages
from broadsheet.schemas import MESSAGE_EXPORT


def enc(text):
    return base64.urlsafe_b64encode(text.encode()).decode().rstrip("=")


TREES = {
    "root of odd type": ([([], "text/calendar", enc("cal"))], "cal"),
    "root html": ([([], "text/html", enc("<p>x</p>"))], "x"),
    "nested plain beats earlier html": (
        [([], "m", None), ([0], "text/html", enc("h")), ([1], "m", None), ([1, 0], "text/plain", enc("p"))], "p"),
    "empty plain skipped": ([([], "m", None), ([0], "text/plain", ""), ([1], "text/html", enc("<b>h</b>"))], "h"),
    "first plain in depth-first order": (
        [([], "m", None), ([1], "text/plain", enc("late")), ([0], "m", None), ([0, 5], "text/plain", enc("early"))], "early"),
    "data hides children": (
        [([], "m", None), ([0], "multipart/mixed", enc("own")), ([0, 0], "text/plain", enc("hidden"))], ""),
    "html without text skipped": ([([], "m", None), ([0], "text/html", enc("<b></b>")), ([1], "text/html", enc("z"))], "z"),
    "type compared exactly": ([([], "m", None), ([0], "TEXT/PLAIN", enc("p"))], ""),
    "nothing": ([([], "m", None)], ""),
}


def test_bodies_long_and_nested(spark):
    long = [("a", name, *part) for name, (parts, _) in TREES.items() for part in parts]
    df = spark.createDataFrame(long, "account string, message_id string, part_path array<int>, mime string, data string")
    want = {name: body for name, (_, body) in TREES.items()}
    assert {r.message_id: r.body for r in select_bodies(df).collect()} == want
    nested = [("a", name, None, [("Subject", name)], parts) for name, (parts, _) in TREES.items()]
    export = spark.createDataFrame(nested, MESSAGE_EXPORT)
    rows = to_messages(export).collect()
    assert {r.message_id: r.body for r in rows} == want
    assert {r.sender for r in rows} == {"Unknown Sender"}

import pytest

from broadsheet.operators import answers as A

GOOD = '{"type":"unique","item_ids":[1,"2",3.0],"group_title":"a","group_summary":"b"}'
# answer, its departures
GROUP_CASES = [
    ('{"groups":[%s]}' % GOOD, []), ('{"groups":[],"note":1}', []),
    ('{"groups":[{"type":"odd","item_ids":[1.5,true,null,"x"],"group_title":null}]}', [
        ("$.groups[0].type", "not in list"), *[(f"$.groups[0].item_ids[{k}]", "not an integer") for k in range(4)],
        ("$.groups[0].group_title", "not a string"), ("$.groups[0].group_summary", "missing")]),
    ('{"groups":[%s,7]}' % GOOD, [("$.groups[1]", "not an object")]),
    ('{"groups":{}}', [("$.groups", "not a list")]), ('{"groups":null}', [("$.groups", "not a list")]), ("{}", [("$.groups", "missing")]),
    ("[]", [("$", "not an object")]), ("3", [("$", "not an object")]), ('{"groups":[', [("$", "not json")]), ("", [("$", "not json")]), (None, [("$", "not json")]),
    ('{"groups":[%s]}' % GOOD.replace("3.0", "99999999999999999999"), [("$.groups[0].item_ids[2]", "not an integer")]),
]


def frame(spark, cases):
    return spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "id long, response string")


def test_every_kind_of_departure(spark):
    got = [tuple(r) for r in A.violations(frame(spark, GROUP_CASES), A.GROUPS, ["id"]).collect()]
    want = [(i, *v) for i, (_, found) in enumerate(GROUP_CASES) for v in found]
    assert sorted(got) == sorted(want)


def test_good_answers_are_read_and_others_are_not(spark):
    rows = A.checked(frame(spark, GROUP_CASES), A.GROUPS, A.GROUP_ANSWER).collect()
    assert {r.id: r.answer is not None for r in rows} == {i: not found for i, (_, found) in enumerate(GROUP_CASES)}
    assert next(r.answer.groups[0].item_ids for r in rows if r.id == 0) == [1, 2, 3]


@pytest.mark.parametrize("fields, schema, answer", [
    (A.ITEMS, A.ITEM_ANSWER, '{"items":[{"title":"t","summary":"s","main_topic":"m","source_urls":["u"],"key_points":[]}]}'),
    (A.LAYOUTS, A.LAYOUT_ANSWER, '{"newsletter_title":"n","executive_summary":"e","categories":[{"category_name":"c","subcategories":'
                                 '[{"subcategory_name":"s","item_ids":[0,-1],"intro_text":"i"}]}]}'),
])
def test_the_other_formats(spark, fields, schema, answer):
    row = A.checked(spark.createDataFrame([(answer,)], "response string"), fields, schema).first()
    first = row.answer.asDict(recursive=True)
    assert first.get("items", [{}])[0].get("title") == "t" or first["categories"][0]["subcategories"][0]["item_ids"] == [0, -1]
    assert A.violations(spark.createDataFrame([(answer.replace('"s"', "5"),)], "response string"), fields, []).count() == 1

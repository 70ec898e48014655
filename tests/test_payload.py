"""Payload log: records, predictions and broken calls against their plain definitions."""

from pyspark.sql import functions as F

from tidemark.operators import payload as pl

CALLS = [
    (1, '{"dataframe_records":[{"a":1,"b":"x"},{"a":2.5,"b":null},{"b":"z"}]}', '{"predictions":[10,20.5,30]}'),
    (2, '{"dataframe_records":[{"a":7,"b":"x"},{"a":"no","b":3}]}', '{"predictions":[1]}'),
    (3, '{"dataframe_records":[{"a":7}', '{"predictions":[1]}'),
    (4, '{"rows":[]}', '{"predictions":[1]}'),
    (5, '{"dataframe_records":[]}', '{"predictions":[]}'),
    (6, '{"dataframe_records":[{"a":1}]}', None),
    (7, '{"dataframe_records":[{"a":1}]}', '{"error":"x"}'),
    (8, None, None),
    (9, "", "[]"),
    (9, '{"dataframe_records":[{"a":1}]}', '{"predictions":[4,5]}'),
    (None, '{"dataframe_records":[{"a":1,"c":[1,{"d":2}]}]}', '{"predictions":["x"]}'),
    (10, '{"dataframe_records":{"a":1}}', '{"predictions":[4]}'),
]


def _log(spark, rows=CALLS):
    return spark.createDataFrame(rows, "request_id long, request string, response string").withColumn("position", F.lit("clash"))


def test_records_meet_their_predictions(spark):
    calls = pl.parse_calls(_log(spark))
    got = sorted(map(tuple, pl.explode_records(calls, {"a": "double", "b": "string"}, ["request_id"]).collect()), key=str)
    assert got == sorted([
        (1, 0, 1.0, "x", 10.0, True), (1, 1, 2.5, None, 20.5, True), (1, 2, None, "z", 30.0, True),
        (2, 0, 7.0, "x", 1.0, False), (2, 1, None, "3", None, False), (9, 0, 1.0, None, 4.0, False),
        (None, 0, 1.0, None, None, True)], key=str)  # a prediction that is no number is null


def test_broken_calls_are_counted_and_kept_apart(spark):
    calls = pl.parse_calls(_log(spark))
    assert {r.request_id: r.broken for r in calls.where("broken is not null and request_id <> 9").collect()} == {
        3: "request_not_json", 4: "request_without_records", 6: "response_not_json",
        7: "response_without_predictions", 8: "request_not_json", 10: "request_without_records"}
    assert dict(map(tuple, pl.broken_counts(calls).collect())) == {
        "request_not_json": 3, "request_without_records": 2, "response_not_json": 1, "response_without_predictions": 1}
    empty = pl.parse_calls(_log(spark, []))
    assert pl.broken_counts(empty).count() == 0 and pl.explode_records(empty, {"a": "int"}, ["request_id"]).count() == 0


def test_observed_schema_merges_all_requests(spark):
    log = _log(spark, [(1, '{"a":1}', None), (2, '{"a":2.5,"b":"x"}', None), (3, "broken{", None)])
    schema = pl.observed_schema(log)
    assert "a: " in schema and "b: STRING" in schema


def test_records_need_no_shuffle(spark):
    plan = pl.explode_records(pl.parse_calls(_log(spark)), {"a": "int"}, ["request_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan

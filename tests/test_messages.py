import json

import pytest
from pyspark.sql import functions as F

from paywarden.operators.messages import parse_messages, route_failed, sort_messages
from paywarden.schema import TRANSACTION_SCHEMA

GOOD = [
    '{"transaction_id":"a","amount":1.5}', '{"transaction_id":"a","_retry_count":9}',
    '{"a":1,"a":2}', '{"amount":NaN}', '{"amount":{"a":1}}', '{"merchant":[1]}',
    '{"amount":"12x"}', '{}', '  {"a":1}\t', '{"a":{"b":[1,{"c":null}]}}', '{"a":"}] x"}',
]
DEAD = [
    '{bad', '[1]', '"x"', 'null', '', '   ', '5', 'true', "{'a':1}", '{"a":01}', '{"a":1} x',
    '{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1}] x', '{"a":1},1]', '{"a":1},true]',
    '{"a":1}} x', '{"a":1},"b":2', '{"a":1}]}', '[{"a":1}]', '{"a":1,}',
]


def messages(spark, raws, headers=None):
    return spark.createDataFrame(
        [(r, headers) for r in raws], "raw string, headers map<string,int>")


def test_objects_and_only_objects_are_good(spark):
    good, dead = parse_messages(messages(spark, GOOD + DEAD + [None]))
    assert sorted(r.raw_message for r in good.collect()) == sorted(GOOD)
    letters = dead.collect()
    assert sorted(r.raw_message for r in letters if r.raw_message is not None) == sorted(DEAD)
    assert len(letters) == len(DEAD) + 1
    assert {r.dlq_reason for r in letters} == {"INVALID_JSON"}


def test_agrees_with_a_json_parser(spark):
    def is_object(text):
        try:
            return isinstance(json.loads(text), dict)
        except ValueError:
            return False

    pieces = ['{"a":1}', "{}", "[", "]", "{", "}", ",", " ", '"k":2', "1", "x", '"', "null",
              '{"transaction_id":5,"amount":"12x"}', '{"merchant":[1]}', '{"a":1,"a":NaN}']
    texts = sorted({a + b + c for a in pieces for b in pieces for c in pieces})
    good, dead = parse_messages(messages(spark, texts))
    assert {r.raw_message for r in good.collect()} == {t for t in texts if is_object(t)}
    assert dead.count() == sum(not is_object(t) for t in texts)


def test_fields_and_retry_count(spark):
    good, _ = parse_messages(messages(spark, GOOD, {"retry_count": 1}))
    rows = {r.raw_message: r for r in good.collect()}
    assert {r._retry_count for r in rows.values()} == {1}
    assert rows[GOOD[0]].transaction_id == "a" and rows[GOOD[0]].amount == 1.5
    assert rows['{"amount":"12x"}'].amount is None
    # the same fields as a plain read of the text
    plain = messages(spark, GOOD).select(
        "raw", F.from_json("raw", TRANSACTION_SCHEMA).alias("f")).select("raw", "f.*")
    for r in plain.collect():
        assert str(tuple(rows[r.raw])[:10]) == str(tuple(r)[1:])
    for headers in (None, {}, {"other": 3}):
        good, _ = parse_messages(messages(spark, GOOD[1:2], headers))
        assert good.first()._retry_count == 0


def test_a_message_is_parsed_once(spark):
    for frame in (*parse_messages(messages(spark, GOOD)), sort_messages(messages(spark, GOOD))):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1


def test_bytes_that_are_not_text(spark):
    raw = messages(spark, GOOD).select(F.col("raw").cast("binary").alias("raw"), "headers")
    broken = raw.limit(1).withColumn("raw", F.unhex(F.lit("7B2261223A22FF227D")))
    good, dead = parse_messages(raw.unionByName(broken))
    assert good.count() == len(GOOD)
    assert dead.first().raw_message == '{"a":"�"}'


def test_sorted_in_one_table(spark):
    rows = messages(spark, GOOD + DEAD + [None], {"retry_count": 2})
    table = sort_messages(rows).cache()
    good, dead = parse_messages(rows)
    fields = TRANSACTION_SCHEMA.names
    assert sorted(map(str, table.filter("route = 'GOOD'").select(*fields, "_retry_count").collect())
                  ) == sorted(map(str, good.select(*fields, "_retry_count").collect()))
    assert table.filter("route = 'GOOD'").filter(
        "raw_message IS NULL OR dlq_reason IS NOT NULL").count() == 0
    assert sorted(map(str, table.filter("route = 'DLQ'").select("raw_message", "dlq_reason").collect())
                  ) == sorted(map(str, dead.collect()))
    assert table.filter("route = 'DLQ' AND _retry_count IS NOT NULL").count() == 0
    table.unpersist()


@pytest.mark.parametrize("tried, want", [
    (0, ("RETRY_1", 1, 5000, None)),
    (1, ("RETRY_2", 2, 10000, None)),
    (2, ("DLQ", None, None, "HDFS_WRITE_FAILED_AFTER_RETRIES")),
    (7, ("DLQ", None, None, "HDFS_WRITE_FAILED_AFTER_RETRIES")),
])
def test_failed_rows_are_routed(spark, tried, want):
    rows = spark.range(1).select(F.lit(tried).alias("_retry_count"))
    got = route_failed(rows).select("route", "next_retry_count", "delay_ms", "dlq_reason")
    assert tuple(got.first()) == want

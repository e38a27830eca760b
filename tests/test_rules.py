"""Rules in text form: reading them, filing them under one condition, and verifying the rest."""

import pytest
from pyspark.sql import functions as F

from tracewell.operators import flatten, rules
from tracewell.sources import telemetry

FILE = """# a test
type: Test
spec:
  id: one
  specs:
  - name: It answers
    selector: span[tracetest.span.type="general" name="trigger"]
    assertions:
    # a remark
    - attr:response.body | json_path '$.order.id' != ""
    - attr:response.body| json_path '$.nanos'     >=    599
    - "attr:response.body = '{\\n}'"
  - selector: span[tracetest.span.type="messaging"
      name="orders publish" kind="producer" messaging.system="kafka"]
    assertions:
    - attr:tracetest.selected_spans.count >= 1
"""


def test_rule_files(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "one.yaml").write_text(FILE)
    (tmp_path / "other.txt").write_text(FILE)
    got = {r.rule_id.split("/")[-1]: r for r in rules.from_files(spark, str(tmp_path)).collect()}
    assert sorted(got) == ["one.yaml#0#0", "one.yaml#0#1", "one.yaml#0#2", "one.yaml#1#0"]
    first, number, text, count = (got[k] for k in sorted(got))
    assert (first.attribute, first.json_path, first.op, first.expected, first.number) == ("response.body", "$.order.id", "!=", "", None)
    assert (number.op, number.number, text.expected) == (">=", 599.0, "{\n}")
    assert [tuple(c) for c in count.conditions] == [
        ("tracetest.span.type", "messaging"), ("name", "orders publish"), ("kind", "4"), ("messaging.system", "kafka"),
    ]
    bad = spark.createDataFrame([("r", "span[]", "attr:x like 3")], "rule_id string, selector string, assertion string")
    with pytest.raises(Exception, match="unreadable assertion"):
        rules.parse(bad).collect()


def attr(key, **value):
    return {"key": key, "value": value}


SPANS = [
    ("t1", "orders publish", 4, [attr("messaging.system", stringValue="kafka"), attr("n", intValue="3"), attr("n", intValue="9")]),
    ("t1", "query", 3, [attr("db.system", stringValue="redis"), attr("http.method", stringValue="GET"), attr("ok", boolValue=True)]),
    ("t2", "call", 2, [attr("rpc.system", stringValue="grpc"), attr("body", stringValue='{"a": {"b": 5}, "c": []}')]),
    ("t2", "plain", 1, None),
    ("t2", None, None, [attr("http.request.method", stringValue="GET")]),
]


@pytest.fixture(scope="module")
def spans(spark, tmp_path_factory):
    import json

    folder = tmp_path_factory.mktemp("spans")
    lines = [
        {"resourceSpans": [{"scopeSpans": [{"spans": [{"traceId": t, "name": n, "kind": k, "attributes": a}]}]}]}
        for t, n, k, a in SPANS
    ]
    (folder / "a.json").write_text("\n".join(map(json.dumps, lines)))
    return flatten.spans(telemetry.traces(spark, str(folder)))


RULES = [
    ("kafka", 'span[tracetest.span.type="messaging" kind="producer"]', "attr:n = 3", 1, 1),
    ("first-wins", 'span[n="9"]', "attr:name != 1", 0, 0),
    ("type-order", 'span[tracetest.span.type="database" http.method="GET"]', 'attr:ok = "true"', 1, 1),
    ("http", 'span[tracetest.span.type="http"]', "attr:name != 1", 1, 0),
    ("general", 'span[tracetest.span.type="general"]', 'attr:name = "plain"', 1, 1),
    ("path", 'span[name="call"]', "attr:body | json_path '$.a.b' > 4.5", 1, 1),
    ("empty-list", 'span[name="call"]', "attr:body | json_path '$.c' = \"[]\"", 1, 1),
    ("no-path", 'span[name="call"]', "attr:body | json_path '$.d' != \"\"", 1, 0),
    ("whole", "span[]", 'attr:rpc.system contains "rp"', 5, 1),
    ("none", 'span[name="call" kind="client"]', "attr:n < 0", 0, 0),
    ("two", 'span[rpc.system="grpc"]', "attr:tracetest.selected_spans.count >= 2", 1, 0),
    ("one", 'span[rpc.system="grpc"]', "attr:tracetest.selected_spans.count <= 1", 1, 1),
]


def test_rules_on_spans(spark, spans):
    texts = spark.createDataFrame([r[:3] for r in RULES], "rule_id string, selector string, assertion string")
    parsed = rules.parse(texts)
    got = {r.rule_id: (r.matched, r.passed, r.ok) for r in rules.check(spans, parsed).collect()}
    assert got == {i: (m, p, i == "one" if i in ("one", "two") else m == p) for i, _, _, m, p in RULES}
    by_trace = rules.check(spans, parsed, by=("traceId",))
    totals = by_trace.groupBy("rule_id").agg(F.sum("matched").alias("m")).collect()
    assert {r.rule_id: r.m for r in totals} == {i: m for i, _, _, m, _ in RULES if m}
    assert by_trace.where("rule_id = 'whole'").count() == 2
    assert rules.check(spans.limit(0), parsed).where("matched = 0").count() == len(RULES)


def test_rules_are_filed_under_what_fewest_rules_ask_for(spark, spans):
    common = 'span[tracetest.span.type="http" name="call" user="{}"]'
    texts = [(f"user-{i}", common.format(i), "attr:n = 3") for i in range(40)]
    texts += [("plain", 'span[tracetest.span.type="http" name="plain"]', "attr:n = 3"), ("whole", "span[]", "attr:n = 3")]
    parsed = rules.parse(spark.createDataFrame(texts + texts[:1], "rule_id string, selector string, assertion string"))
    got = sorted((r.rule_id, r.filed_key, r.filed_value) for r in rules.filed(parsed).collect())
    want = [(f"user-{i}", "user", str(i)) for i in [0, *range(40)]] + [("plain", "name", "plain"), ("whole", "", "")]
    assert got == sorted(want)


def test_spans_are_not_held_in_memory_to_be_joined(spark, spans):
    parsed = rules.parse(spark.createDataFrame([r[:3] for r in RULES], "rule_id string, selector string, assertion string"))
    plan = rules.check(spans, parsed)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    join = next(line for line in plan.split("\n") if "Join [key#" in line)
    assert "ShuffledHashJoin" in join and "BuildRight" in join

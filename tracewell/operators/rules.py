"""Trace rules as a table: selectors and assertions in their text form, hundreds of them checked in one pass.

A rule reads ``span[key="value" ...]`` and ``attr:key | json_path '$.path' = value``. Every rule is filed under one of its
equalities, the one that the fewest rules ask for. Spans are joined to rules by what they carry; the other conditions and
the assertion are then verified on the pairs, so a span meets only the rules that name something it has, and not all
those that share a condition which most spans meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions import attributes

NAME, KIND, TYPE, COUNT = "name", "kind", "tracetest.span.type", "tracetest.selected_spans.count"
#: Span kinds by number from 1.
KINDS = ("internal", "server", "client", "producer", "consumer")
#: The attribute that makes a span one of a type, the first one present deciding; others are general.
TYPES = (
    ("database", "db.system"),
    ("rpc", "rpc.system"),
    ("messaging", "messaging.system"),
    ("faas", "faas.trigger"),
    ("exception", "exception.type"),
    ("http", "http.method"),
    ("http", "http.request.method"),
)
GENERAL = "general"

_CONDITION = r"([\w.\-]+)\s*=\s*\"([^\"]*)\""
_ASSERTION = r"(?s)^\s*attr:\s*([\w.\-]+)\s*(?:\|\s*json_path\s+'([^']*)'\s*)?(!=|<=|>=|=|<|>|contains)\s*(.*?)\s*$"
_BLOCK = r"(?m)^[ \t]*(?:- )?selector:\s*(span\[[^\]]*\])\s*\n[ \t]*assertions:[ \t]*\n((?:[ \t]*(?:#|- (?!name:|selector:))[^\n]*(?:\n|$))+)"


def parse(texts: DataFrame) -> DataFrame:
    """Rules of ``texts(rule_id, selector, assertion)``: ``(rule_id, conditions, attribute, json_path, op, expected,
    number)``. An assertion that can't be read fails."""
    part = lambda i: F.regexp_extract("assertion", _ASSERTION, i)
    pairs = F.arrays_zip(
        F.regexp_extract_all("selector", F.lit(_CONDITION), 1).alias("key"),
        F.regexp_extract_all("selector", F.lit(_CONDITION), 2).alias("value"),
    )
    kind = lambda value: F.coalesce(
        *(F.when(F.lower(value) == k, F.lit(str(i))) for i, k in enumerate(KINDS, 1)), value
    )
    conditions = F.transform(
        pairs,
        lambda c: F.struct(c["key"], F.when(c["key"] == KIND, kind(c["value"])).otherwise(c["value"]).alias("value")),
    )
    expected = part(4)
    quoted = expected.rlike("""(?s)^(".*"|'.*')$""")
    read = F.when(part(3) == "", F.raise_error(F.concat(F.lit("unreadable assertion: "), F.col("assertion")))).otherwise(part(3))
    return texts.select(
        "rule_id",
        conditions.alias("conditions"),
        part(1).alias("attribute"),
        F.nullif(part(2), F.lit("")).alias("json_path"),
        read.alias("op"),
        F.when(quoted, F.regexp_replace(expected, """(?s)^["'](.*)["']$""", "$1")).otherwise(expected).alias("expected"),
        F.when(~quoted, expected.try_cast("double")).alias("number"),
    )


def from_files(spark: SparkSession, folder: str) -> DataFrame:
    """The rules of all test files (``*.yaml``) below a folder, ``rule_id`` being the file's path, the number of the
    selector and that of the assertion."""
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.yaml")
    blocks = files.select(
        F.col("_metadata.file_path").alias("file"),
        F.posexplode(
            F.arrays_zip(
                F.regexp_extract_all("value", F.lit(_BLOCK), 1).alias("selector"),
                F.regexp_extract_all("value", F.lit(_BLOCK), 2).alias("lines"),
            )
        ),
    )
    lines = F.regexp_extract_all(F.col("col.lines"), F.lit(r"(?m)^[ \t]*- ([^\n]*)$"), 1)
    asserted = blocks.select("file", F.col("pos").alias("block"), "col.selector", F.posexplode(lines))
    plain = F.regexp_replace(F.regexp_replace("col", r'^"(.*)"\s*$', "$1"), r"\\n", "\n")
    wrapped = F.col("col").startswith('"')
    return parse(
        asserted.select(
            F.concat_ws("#", "file", "block", "pos").alias("rule_id"),
            "selector",
            F.when(wrapped, plain).otherwise(F.col("col")).alias("assertion"),
        )
    )


def _carried(spans: DataFrame, by: list[str]) -> DataFrame:
    """``(*by, keys, values)``: what a span carries as two parallel arrays, its own fields first."""
    value = lambda a: F.coalesce(
        *(F.try_variant_get(a["value"], f"$.{f}", "string") for f in attributes.SCALAR_FIELDS)
    )
    has = lambda key: F.exists("attributes", lambda a: a["key"] == key)
    kind_of = F.coalesce(*(F.when(has(key), F.lit(kind)) for kind, key in TYPES), F.lit(GENERAL))
    more = lambda own, each: F.concat(own, F.coalesce(F.transform("attributes", each), F.array().cast("array<string>")))
    return spans.select(
        *by,
        more(F.array(*map(F.lit, (NAME, KIND, TYPE))), lambda a: a["key"]).alias("keys"),
        more(F.array(F.col("name"), F.col("kind").cast("string"), kind_of), value).alias("values"),
    )


def _value(key: Column) -> Column:
    """The first value that the span carries under a key."""
    at = F.array_position("keys", key).cast("int")
    return F.when(at > 0, F.get("values", at - 1))


def _holds(actual: Column) -> Column:
    op, expected, number = F.col("op"), F.col("expected"), F.col("number")

    def compared(a: Column, b: Column) -> Column:
        choices = {"=": a == b, "!=": a != b, "<=": a <= b, ">=": a >= b, "<": a < b, ">": a > b}
        return F.coalesce(*(F.when(op == name, test) for name, test in choices.items()))

    test = F.when(op == "contains", F.contains(actual, expected))
    test = test.when(number.isNotNull(), compared(actual.try_cast("double"), number))
    return F.coalesce(test.otherwise(compared(actual, expected)), F.lit(False))


def filed(rules: DataFrame) -> DataFrame:
    """``rules`` with ``filed_key`` and ``filed_value``, the condition that fewest rules have, that of the span name or
    else the first one among equals; empty for rules without conditions."""
    selectors = rules.groupBy("conditions").agg(F.count(F.lit(1)).alias("rules"))
    asked = selectors.select("conditions", "rules", F.posexplode("conditions").alias("at", "mark"))
    shared = asked.groupBy("mark").agg(F.sum("rules").alias("shared"))
    order = F.struct("shared", F.col("mark.key") != NAME, "at", "mark")
    rarest = asked.join(shared, "mark").groupBy("conditions").agg(F.min(order)["mark"].alias("mark"))
    part = lambda name: F.coalesce(F.col("mark")[name], F.lit("")).alias(f"filed_{name}")
    return rules.join(rarest, "conditions", "left").select(*rules.columns, part("key"), part("value"))


def check(spans: DataFrame, rules: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``(*by, rule_id, matched, passed, ok)``: how many spans each rule selects and how many of these pass.

    An assertion holds if all selected spans pass; a missing attribute or path fails. ``tracetest.selected_spans.count``
    is asserted on the number of selected spans. Without ``by`` every rule has a row, with ``by`` (such as the trace) those
    that select a span of the group.
    """
    filed_rules = filed(rules)
    filed_keys = filed_rules.agg(F.collect_set("filed_key").alias("filed_keys"))  # names of attributes, one row

    carried = _carried(spans, list(by)).crossJoin(filed_keys)
    marks = F.concat(F.array(F.struct(F.lit("").alias("key"), F.lit("").alias("value"))), F.filter(
        F.zip_with("keys", "values", lambda k, v: F.struct(k.alias("key"), v.alias("value"))), lambda m: m["value"].isNotNull()
    ))
    marks = F.filter(marks, lambda m: F.array_contains("filed_keys", m["key"]))
    pairs = carried.select(*by, "keys", "values", F.inline(F.array_distinct(marks)))
    # Spark takes spans for small, as their files are; the hint keeps them from being the side that is held in memory
    on = (F.col("key") == F.col("filed_key")) & (F.col("value") == F.col("filed_value"))
    met = pairs.join(filed_rules.hint("shuffle_hash"), on)
    chosen = met.where(F.forall("conditions", lambda c: F.coalesce(_value(c["key"]) == c["value"], F.lit(False))))

    actual = _value(F.col("attribute"))
    actual = F.when(F.col("json_path").isNull(), actual).otherwise(F.call_function("get_json_object", actual, F.col("json_path")))
    counted = chosen.groupBy(*by, "rule_id").agg(
        F.count(F.lit(1)).alias("matched"), F.count_if(_holds(actual)).alias("passed")
    )
    if by:
        result = counted.join(rules, "rule_id")
    else:
        result = rules.join(counted, "rule_id", "left").fillna(0, ["matched", "passed"])
    total = F.col("attribute") == COUNT
    ok = F.when(total, _holds(F.col("matched").cast("string"))).otherwise(F.col("passed") == F.col("matched"))
    passed = F.when(total, F.when(ok, F.col("matched")).otherwise(F.lit(0).cast("bigint"))).otherwise(F.col("passed"))
    return result.select(*by, "rule_id", "matched", passed.alias("passed"), ok.alias("ok"))

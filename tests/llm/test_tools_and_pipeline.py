import json

import corpus_pipeline
import pytest

from parlance.llm import queries, tool_linking
from parlance.llm.common import materialise, table

SCHEMA = {"add": {"type": "object", "required": ["x"], "properties": {"x": {"type": ["integer", "string"], "minimum": 0}, "l": {"type": "array", "items": {"type": "number"}, "maxItems": 2}}, "additionalProperties": False}}


@pytest.mark.parametrize(
    "value,error",
    [({"x": 1}, None), ({}, "$.x: missing"), ({"x": 1.5}, "$.x: type"), ({"x": -1}, "$.x: range"), ({"x": True}, "$.x: type"), ({"x": 1, "y": 1}, "$.y: not allowed"), ({"x": 1, "l": [1, "a"]}, "$.l[1]: type"), ({"x": 1, "l": [1, 2, 3]}, "$.l: length"), ([], "$: type"), ({"x": {"$ref": "c"}}, None)],
)
def test_schemas(value, error):
    assert tool_linking.violation(value, SCHEMA["add"]) == error


CALL = "conv_id string, call_id string, seq long, name string, arguments string"
RESULT = "conv_id string, call_id string, seq long, content string"


def linked(spark, calls, results):
    c = spark.createDataFrame(calls, CALL).selectExpr("*", "1 as level", "'x' as linked")
    return tool_linking.link_tools(c, spark.createDataFrame(results, RESULT), SCHEMA)


def test_linking(spark):
    ref = lambda *ids: json.dumps({"x": 1, "l": [{"$ref": i} for i in ids]})
    calls = [
        ("a", "1", 0, "add", '{ "x": 2 }'), ("a", "2", 2, "add", ref("1")), ("a", "2", 9, "add", '{"x": 9}'),
        ("b", "1", 0, "add", ref("2")), ("b", "2", 1, "add", ref("3")), ("b", "3", 2, "add", '{"x": "é"}'), ("b", "4", 3, "add", ref("9")),
        ("c", "1", 0, "add", ref("2")), ("c", "2", 1, "add", ref("1")), ("c", "3", 2, "nope", "{}"), ("c", "4", 3, "add", "{"), ("c", "5", 4, "add", None),
        (None, "1", 0, "add", "{}"), ("a", None, 0, "add", "{}"),
    ]
    results = [("a", "1", 1, "two"), ("a", "1", 5, "late"), ("b", "7", 1, "orphan"), ("c", "1", 1, None), (None, "1", 0, "x")]
    r = {(x.conv_id, x.call_id): x for x in linked(spark, calls, results).collect()}
    assert r[("a", "1")].linked and r[("a", "1")].message == '{"call":{"arguments":{"x":2},"id":"1","name":"add"},"result":{"content":"two","id":"1"}}'
    assert [r[("b", k)].level for k in "1234"] == [2, 1, 0, 0] and r[("a", "2")].level == 1 and r[("a", "2")].seq == 2
    assert r[("b", "4")].error == "unknown reference" and r[("b", "7")].error == "no call" and "é" in r[("b", "3")].message
    assert r[("c", "1")].error == r[("c", "2")].error == "cyclic reference" and r[("c", "1")].linked
    assert (r[("c", "3")].error, r[("c", "4")].error, r[("c", "5")].error) == ("unknown tool", "not JSON", "no arguments")
    assert r[("a", None)].error == "no identifier" and not r[("a", None)].linked and linked(spark, calls, results).count() == 15
    assert linked(spark, [], []).count() == 0


def test_each_stage_works_on_what_the_last_one_kept(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    extra = spark.createDataFrame([(900_001, "123 456 !!!", "en", "src0", 11), (900_002, None, None, "src0", 0), (900_003, docs.first().text, "en", "src1", 1)], docs.schema)
    docs = materialise(docs.unionByName(extra))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialise(stage(spark, docs, sf_dir))
        seen[name] = docs
        assert {r.doc_id for r in docs.select("doc_id").collect()} <= {r.doc_id for r in before.select("doc_id").collect()}
        if name != "bpe":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    ids = {r.doc_id for r in seen["language_id"].collect()}
    assert not ids & {900_001, 900_002} and 900_003 in ids and len(ids) == before_count(spark, sf_dir) + 1
    assert 900_003 not in {r.doc_id for r in seen["line_dedup"].collect()}
    assert all(len(r.ids) == r.n_tokens for r in seen["bpe"].collect())


FOREIGN = [
    "Девочка, которая жила в доме у реки, каждое утро ходила на рынок, чтобы купить хлеб и свежие овощи для семьи.",
    "川の近くの家に住んでいた少女は毎朝市場へ行ってパンと新鮮な野菜を買いました。そして家族のために夕食を作りました。",
    "Dziewczyna, która mieszkała w domu nad rzeką, codziennie rano chodziła na targ, aby kupić chleb i świeże warzywa dla rodziny.",
    "Tyttö, joka asui joen lähellä olevassa talossa, kävi joka aamu torilla ostamassa leipää ja tuoreita vihanneksia perheelleen.",
    "xqzvk wpfjq zzkqx vbnmq jkwxz qpwzk fjvxq kzzwq xjkvb qqwzx pfvkj wqxzj kkvqp zxwfq",
]


def test_documents_of_no_known_language_go(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    halves = [docs.where(f"lang = '{v}' and n_chars > 600").orderBy("doc_id").first().text[:600] for v in ("en", "fr")]
    planted = [(800_000 + i, t, "en", "src0", len(t)) for i, t in enumerate(FOREIGN)] + [(800_100, " ".join(halves), "en", "src0", 1201), (800_101, "le la les " * 300, "fr", "src0", 3000)]
    all_docs = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    kept = {r.doc_id for r in corpus_pipeline.detect_language(spark, all_docs, sf_dir).select("doc_id").collect()}
    assert not kept & {800_000 + i for i in range(len(FOREIGN))}
    assert {800_100, 800_101} <= kept and len(kept) == before_count(spark, sf_dir) + 2


def test_documents_without_an_id_pass_the_join(spark, docs):
    rows = [(1, "one two three four five six seven"), (2, "one two three four five six seven"), (None, "one two three four five six seven"), (None, None), (3, "other words")]
    got = corpus_pipeline.join_near_duplicates(spark, docs(rows), "").collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((str(i), str(t)) for i, t in rows if i != 2)


def before_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("text is not null").count()


def test_queries_are_ten():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 11))
    assert set(queries.oracle_sql()) <= set(queries.queries())


def test_malformed_arguments(spark):
    calls = [
        ("a", "1", 0, "add", '{"x": "\\ud800"}'), ("a", "2", 1, "add", "[" * 100_000 + "]" * 100_000), ("a", "3", 2, "add", '{"x": NaN}'), ("a", "4", 3, "add", '{"x": 1e999}'),
        ("a", "5", 4, "add", '{"x": {"$ref": 5}}'), ("a", "6", 5, "add", '{"x": {"$ref": "\\ud800"}}'), ("a", "7", 6, "add", '{"x": "[[[["}'),
    ]
    r = {x.call_id: x for x in linked(spark, calls, []).collect()}
    assert [r[str(k)].error for k in range(1, 8)] == [None, "nested too deeply", "not JSON", "not JSON", "$.x: type", "unknown reference", None]
    assert '"x":"\\ud800"' in r["1"].message and all(json.loads(x.message) for x in r.values())


@pytest.mark.parametrize(
    "schema,good,bad",
    [
        ({"anyOf": [{"type": "string"}, {"minimum": 3}]}, 4, 2), ({"allOf": [{"minimum": 1}, {"maximum": 3}]}, 2, 4), ({"oneOf": [{"minimum": 1}, {"maximum": 3}]}, 0, 2), ({"not": {"type": "null"}}, 1, None),
        ({"exclusiveMinimum": 1}, 2, 1), ({"uniqueItems": True}, [1, 2], [1, 1.0]), ({"minProperties": 1}, {"a": 1}, {}), ({"enum": [1]}, 1.0, True), ({"const": [True]}, [True], [1]),
        ({"multipleOf": 3}, 9, 10), ({"patternProperties": {"^a": {"type": "string"}}}, {"ab": "x"}, {"ab": 1}), ({"propertyNames": {"maxLength": 1}}, {"a": 1}, {"ab": 1}), ({"type": ["nonsense", "null"]}, None, 1),
    ],
)
def test_schema_rules(schema, good, bad):
    assert tool_linking.violation(good, schema) is None and tool_linking.violation(bad, schema)


def test_levels_across_tasks(spark):
    """One long conversation over several tasks: a chain, forward references and a cycle at its end."""
    n = 400
    to = lambda k: [k - 1] if 0 < k < 200 else [k + 1] if 200 <= k < 398 else [399] if k == 398 else [398] if k == 399 else []
    rows = [("a", f"c{k}", k, [f"c{x}" for x in to(k)]) for k in range(n)] + [("b", "c0", 0, ["c1"]), ("b", "c1", 1, [])]
    got = {(r.conv_id, r.call_id): r.level for r in tool_linking.levels(spark.createDataFrame(rows, "conv_id string, call_id string, seq long, refs array<string>")).collect()}
    assert [got["a", f"c{k}"] for k in range(200)] == list(range(200)) and all(got["a", f"c{k}"] is None for k in range(200, 400)) and got["b", "c0"] == 1 and len(got) == n + 2


def test_an_empty_table_through_the_pipeline(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, ""))
    assert docs.count() == 0

"""The schema compiler: each rule kept and broken, shapes that differ, schemas that it refuses."""

import json

import pytest

from parlance.plans import schemas

ANY = {"$defs": {"id": {"type": "string", "minLength": 2, "pattern": "^[a-z]'?[0-9]"}}, "type": "object"}


def broken(spark, schema, *values):
    """The errors of each value, as path and message."""
    rows = [(i, None if v is None else v if isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    found = schemas.check(spark.createDataFrame(rows, "i int, j string"), "j", schema).orderBy("i").collect()
    return [[("/".join(e.path), e.message) for e in r.errors] for r in found]


def test_each_rule_is_kept_and_broken(spark):
    schema = {
        **ANY,
        "required": ["id"],
        "additionalProperties": False,
        "properties": {
            "id": {"$ref": "#/$defs/id"},
            "n": {"type": "integer", "minimum": 1, "exclusiveMaximum": 9},
            "m": {"exclusiveMinimum": 0, "maximum": 5},
            "c": {"const": True},
            "e": {"enum": [1, "one", None]},
            "s": {"type": ["string", "null"], "maxLength": 3},
            "a": {"type": "array", "minItems": 1, "maxItems": 2, "items": {"type": "object", "required": ["x"], "properties": {"x": {"type": "array", "items": {"type": "number"}}}}},
            "o": {"oneOf": [{"type": "number"}, {"minimum": 5}]},
            "y": {"anyOf": [{"type": "number"}, {"type": "null"}]},
            "z": {"not": {"type": "string"}},
            "never": False,
        },
    }
    sound = {"id": "a'1", "n": 2.0, "m": 5, "c": True, "e": None, "s": None, "a": [{"x": [1, 2.5]}], "o": 1, "y": None, "z": 1}
    cases = [
        (sound, []),
        ({"id": "a1", "e": 1.0, "s": "äöü", "a": [{"x": []}, {"x": []}]}, []),
        ({}, [("", "required id")]),
        ({"id": "a1", "other": 1}, [("", "additionalProperties")]),
        ({"id": "a"}, [("id", "minLength"), ("id", "pattern")]),
        ({"id": 7}, [("id", "type")]),
        ({"id": "a1", "n": 0}, [("n", "minimum")]),
        ({"id": "a1", "n": 9}, [("n", "exclusiveMaximum")]),
        ({"id": "a1", "n": 2.5}, [("n", "type")]),
        ({"id": "a1", "n": True}, [("n", "type")]),
        ({"id": "a1", "m": 0}, [("m", "exclusiveMinimum")]),
        ({"id": "a1", "m": 6}, [("m", "maximum")]),
        ({"id": "a1", "c": 1}, [("c", "const")]),
        ({"id": "a1", "e": True}, [("e", "enum")]),
        ({"id": "a1", "s": "abcd"}, [("s", "maxLength")]),
        ({"id": "a1", "a": []}, [("a", "minItems")]),
        ({"id": "a1", "a": [{"x": []}] * 3}, [("a", "maxItems")]),
        ({"id": "a1", "a": [{"x": [1]}, {"x": [1, "q"]}]}, [("a/1/x/1", "type")]),
        ({"id": "a1", "a": [{}, 3]}, [("a/0", "required x"), ("a/1", "type")]),
        ({"id": "a1", "o": 6}, [("o", "oneOf")]),
        ({"id": "a1", "y": "x"}, [("y", "anyOf")]),
        ({"id": "a1", "z": "x"}, [("z", "not")]),
        ({"id": "a1", "never": 1}, [("never", "false")]),
        ("no json", [("", "json")]),
        (None, [("", "json")]),
        ([], [("", "type")]),
    ]
    assert broken(spark, schema, *(v for v, _ in cases)) == [want for _, want in cases]


def test_conditions_and_the_order_of_errors(spark):
    schema = {"if": {"required": ["k"], "properties": {"k": {"const": "p"}}}, "then": {"required": ["q"]}, "else": {"properties": {"r": {"type": "object", "properties": {"s": {"type": "string"}, "t": {"minimum": 3}}, "required": ["u"]}}}}
    assert broken(spark, schema, {"k": "p"}, {"k": "p", "q": None}, {"r": {"s": 1, "t": 2}}, 5) == [[("", "required q")], [], [("r/s", "type"), ("r/t", "minimum"), ("r", "required u")], []]


def test_a_schema_that_cannot_be_kept_is_refused(spark):
    for schema in ({"uniqueItems": True}, {"type": "text"}, {"$ref": "http://x"}, {"const": [1]}, {"$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}, "$ref": "#/$defs/a"}, {"properties": {"it's": {"minimum": 1}}}):
        with pytest.raises(ValueError):
            schemas.errors("v", schema)


def test_records_part_into_sound_and_quarantined(spark):
    df = spark.createDataFrame([(1, '{"a": 1}', "x"), (2, '{"a": "1"}', "y"), (3, "{", "z")], "id int, record string, path string")
    schema = {"type": "object", "properties": {"a": {"type": "number"}}}
    sound, bad = schemas.gate(df, "record", schema)
    assert [r.id for r in sound.collect()] == [1] and sorted(r.id for r in bad.collect()) == [2, 3] and sound.columns == df.columns
    hard, _ = schemas.gate(df.where("id < 3"), "record", schema, hard=True)
    with pytest.raises(Exception, match=r"at \[a\]: type \(1 in all\)"):
        hard.collect()
    assert schemas.gate(df.limit(0), "record", schema)[0].count() == 0


def test_a_schema_is_read_from_a_file(spark, tmp_path):
    p = tmp_path / "schema.json"
    p.write_text(json.dumps(schemas.record_schema(), indent=1))
    assert schemas.read(spark, str(p)) == schemas.record_schema()


def test_the_query_breaks_every_kind_of_rule(spark, sf_dir):
    from parlance.queries_blocks import schema_gate_compiled

    found = {e.split(": ")[1].split()[0] for r in schema_gate_compiled(spark, sf_dir).collect() for e in r.errors.split("; ") if e}
    assert found >= {"const", "enum", "minLength", "minimum", "maximum", "required", "type", "anyOf"}

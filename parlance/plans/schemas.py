"""JSON schemas as expressions: a schema (a dict, or a file's) becomes one expression that lists a record's broken rules.

Records are VARIANT values, so they may differ in shape, and paths that a record lacks are null. Rules known are those of
`RULES`; `ANNOTATIONS` say nothing about a record (format is one, as by default in the 2020-12 draft). Another keyword
raises ValueError while the expression is built, rather than be left unchecked.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANNOTATIONS = {"$schema", "$id", "$defs", "definitions", "$comment", "title", "description", "default", "examples", "format"}
TYPES = {"object", "array", "string", "number", "integer", "boolean", "null"}
ERROR = "array<struct<path:array<string>,message:string>>"


NONE = f"CAST(array() AS {ERROR})"


def _text(x: str) -> str:
    """A literal of SQL."""
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


class _Place:
    """A value within a record, as SQL: below `root` by keys; `path` names it from the record's top, `depth` tells lambdas apart."""

    def __init__(self, root: str, keys: tuple[str, ...], path: str, depth: int = 0):
        self.root, self.keys, self.path, self.depth = root, keys, path, depth

    def read(self, kind: str) -> str:
        if any(c in k for k in self.keys for c in "'\\"):
            raise ValueError(f"property names with quotes or backslashes: {self.keys}")
        return f"try_variant_get({self.root}, " + _text("$" + "".join(f"['{k}']" for k in self.keys)) + f", '{kind}')"

    def below(self, key: str) -> _Place:
        return _Place(self.root, (*self.keys, key), f"concat({self.path}, array({_text(key)}))", self.depth)

    @property
    def value(self) -> str:
        return self.read("variant")

    def kind(self, *names: str) -> str:
        """Whether the value is of one of the JSON types; null where there is nothing."""
        head = f"regexp_extract(schema_of_variant({self.value}), '^[A-Z]+', 0)"
        heads = {"object": "OBJECT", "array": "ARRAY", "string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}
        among = ", ".join(f"'{heads[n]}'" for n in names if n in heads)
        parts = [f"{head} IN ({among})"] if among else []
        if "number" in names:
            parts.append(f"{head} NOT IN ('OBJECT', 'ARRAY', 'STRING', 'BOOLEAN', 'VOID')")
        return "(" + " OR ".join(parts) + ")"

    def number(self) -> str:
        return f"(CASE WHEN {self.kind('number')} THEN {self.read('double')} END)"

    def string(self) -> str:
        return f"(CASE WHEN {self.kind('string')} THEN {self.read('string')} END)"

    def array(self) -> str:
        return f"(CASE WHEN {self.kind('array')} THEN {self.read('array<variant>')} END)"


def _fail(broken: str, at: _Place, message: str) -> str:
    """One error where broken is true; null counts as sound."""
    return f"CASE WHEN {broken} THEN array(named_struct('path', {at.path}, 'message', {_text(message)})) ELSE {NONE} END"


def _all(parts: list[str]) -> str:
    return f"concat({', '.join(parts)})" if parts else NONE


def _equals(at: _Place, want: object) -> str:
    if want is None:
        return f"coalesce({at.kind('null')}, false)"
    if isinstance(want, bool):
        return f"coalesce({at.kind('boolean')} AND {at.read('boolean')} = {str(want).lower()}, false)"
    if isinstance(want, str):
        return f"coalesce({at.string()} = {_text(want)}, false)"
    if isinstance(want, (int, float)):
        return f"coalesce({at.number()} = {float(want)!r}D, false)"
    raise ValueError(f"const and enum take plain values, not {want!r}")


def _type(at: _Place, want: object) -> str:
    names = [want] if isinstance(want, str) else list(want)
    if not set(names) <= TYPES:
        raise ValueError(f"unknown type in {names}")
    plain = [n for n in names if n != "integer"]
    parts = [at.kind(*plain)] if plain else []
    if "integer" in names and "number" not in names:
        parts.append(f"coalesce({at.number()} % 1 = 0, false)")
    return "(" + " OR ".join(parts) + ")"


def _items(at: _Place, schema: object, top: dict) -> str:
    x, i = f"x{at.depth}", f"i{at.depth}"
    inner = _errors(_Place(x, (), f"concat({at.path}, array(string({i})))", at.depth + 1), schema, top)
    return f"coalesce(flatten(transform({at.array()}, ({x}, {i}) -> {inner})), {NONE})"


def _extra(at: _Place, schema: dict) -> str:
    if schema["additionalProperties"] is True:
        return NONE
    if schema["additionalProperties"] is not False:
        raise ValueError("additionalProperties is true or false")
    known = "CAST(array(" + ", ".join(map(_text, schema.get("properties", {}))) + ") AS array<string>)"
    names = f"map_keys(CASE WHEN {at.kind('object')} THEN {at.read('map<string,variant>')} END)"
    return _fail(f"size(array_except({names}, {known})) > 0", at, "additionalProperties")


def _properties(at: _Place, schemas: dict, top: dict) -> str:
    inner = {k: _errors(at.below(k), x, top) for k, x in schemas.items()}
    return _all([f"CASE WHEN {at.below(k).value} IS NOT NULL THEN {x} ELSE {NONE} END" for k, x in inner.items() if x != NONE])


def _kept(at: _Place, schemas: list, top: dict) -> str:
    """How many of the schemas the value keeps."""
    return "(" + " + ".join(f"int(size({_errors(at, x, top)}) = 0)" for x in schemas) + ")"


def _condition(at: _Place, schema: dict, top: dict) -> str:
    then, other = (_errors(at, schema.get(k, True), top) for k in ("then", "else"))
    return f"CASE WHEN size({_errors(at, schema['if'], top)}) = 0 THEN {then} ELSE {other} END"


def _bound(sign: str, measure: Callable[[_Place], str]) -> Callable[[_Place, object, dict, dict, str], str]:
    return lambda at, x, s, top, rule: _fail(f"{measure(at)} {sign} {float(x)!r}D", at, rule)


def _length(at: _Place) -> str:
    return f"length({at.string()})"


def _size(at: _Place) -> str:
    return f"nullif(size({at.array()}), -1)"


#: keyword -> (place, the keyword's value, the schema around it, the whole schema, the keyword) -> errors
RULES: dict[str, Callable[[_Place, object, dict, dict, str], str]] = {
    "$ref": lambda at, x, s, top, rule: _errors(at, _resolve(x, top), top),
    "type": lambda at, x, s, top, rule: _fail(f"NOT {_type(at, x)}", at, rule),
    "const": lambda at, x, s, top, rule: _fail(f"NOT {_equals(at, x)}", at, rule),
    "enum": lambda at, x, s, top, rule: _fail("NOT (" + " OR ".join(_equals(at, y) for y in x) + ")" if x else "true", at, rule),
    "minLength": _bound("<", _length),
    "maxLength": _bound(">", _length),
    "pattern": lambda at, x, s, top, rule: _fail(f"NOT regexp_like({at.string()}, {_text(x)})", at, rule),
    "minimum": _bound("<", _Place.number),
    "maximum": _bound(">", _Place.number),
    "exclusiveMinimum": _bound("<=", _Place.number),
    "exclusiveMaximum": _bound(">=", _Place.number),
    "minItems": _bound("<", _size),
    "maxItems": _bound(">", _size),
    "required": lambda at, x, s, top, rule: _all([_fail(f"{at.kind('object')} AND {at.below(k).value} IS NULL", at, f"required {k}") for k in x]),
    "properties": lambda at, x, s, top, rule: _properties(at, x, top),
    "additionalProperties": lambda at, x, s, top, rule: _extra(at, s),
    "items": lambda at, x, s, top, rule: _items(at, x, top),
    "allOf": lambda at, x, s, top, rule: _all([_errors(at, y, top) for y in x]),
    "anyOf": lambda at, x, s, top, rule: _fail(f"{_kept(at, x, top)} = 0", at, rule),
    "oneOf": lambda at, x, s, top, rule: _fail(f"{_kept(at, x, top)} <> 1", at, rule),
    "not": lambda at, x, s, top, rule: _fail(f"{_kept(at, [x], top)} = 1", at, rule),
    "if": lambda at, x, s, top, rule: _condition(at, s, top),
    "then": lambda at, x, s, top, rule: NONE,
    "else": lambda at, x, s, top, rule: NONE,
}


def _resolve(ref: str, top: dict) -> object:
    """What a reference within the schema (#/a/b) names."""
    if not ref.startswith("#"):
        raise ValueError(f"references stay within the schema: {ref}")
    found: object = top
    for part in ref.removeprefix("#").split("/")[1:]:
        found = found[part.replace("~1", "/").replace("~0", "~")]
    return found


def _no_circle(schema: object, top: dict, within: tuple[str, ...]) -> None:
    if isinstance(schema, dict) and isinstance(schema.get("$ref"), str):
        if schema["$ref"] in within:
            raise ValueError(f"the schema refers to itself by {schema['$ref']}")
        _no_circle(_resolve(schema["$ref"], top), top, (*within, schema["$ref"]))
    inner = [x for k, x in schema.items() if k not in ANNOTATIONS] if isinstance(schema, dict) else schema if isinstance(schema, list) else []
    for x in inner:
        _no_circle(x, top, within)


def _errors(at: _Place, schema: object, top: dict) -> str:
    if schema is True:
        return NONE
    if schema is False:
        return _fail("true", at, "false")
    unknown = set(schema) - set(RULES) - ANNOTATIONS
    if unknown:
        raise ValueError(f"rules not known: {sorted(unknown)}")
    parts = [RULES[k](at, x, schema, top, k) for k, x in schema.items() if k in RULES]
    return _all([x for x in parts if x != NONE])


def errors(column: str, schema: dict) -> Column:
    """The broken rules of the records in a VARIANT column as structs path (keys and positions), message; the longest paths
    first, equal ones by name. A null record (text that is no JSON) breaks the rule `json`."""
    _no_circle(schema, schema, ())
    at = _Place(f"`{column}`", (), "CAST(array() AS array<string>)")
    found = F.expr(f"CASE WHEN `{column}` IS NULL THEN {_fail('true', at, 'json')} ELSE {_errors(at, schema, schema)} END")
    key = lambda x: F.struct(-F.size(x["path"]), F.array_join(x["path"], "\0"), x["message"])
    return F.array_sort(found, lambda a, b: F.when(key(a) < key(b), -1).when(key(a) > key(b), 1).otherwise(0))


def check(records: DataFrame, column: str, schema: dict) -> DataFrame:
    """records with errors: what the JSON text in `column` breaks. A null text is no JSON."""
    parsed = records.withColumn("_parsed", F.try_parse_json(column))  # a column of its own, read once for all rules
    return parsed.withColumn("errors", errors("_parsed", schema)).drop("_parsed")


def gate(records: DataFrame, column: str, schema: dict, hard: bool = False) -> tuple[DataFrame, DataFrame]:
    """(sound, quarantined) records; with hard, reading the sound ones raises at the first broken record, by its deepest error."""
    checked = check(records, column, schema)
    bad = checked.where(F.size("errors") > 0)
    if not hard:
        return checked.where(F.size("errors") == 0).drop("errors"), bad
    text = F.concat(F.lit("at ["), shown(F.col("errors")[0]["path"]), F.lit("]: "), F.col("errors")[0]["message"], F.lit(" ("), F.size("errors").cast("string"), F.lit(" in all)"))
    kept = F.when(F.size("errors") > 0, F.raise_error(text).cast("boolean")).otherwise(True)
    return checked.where(kept).drop("errors"), bad


def shown(path: Column) -> Column:
    return F.when(F.size(path) == 0, "(root)").otherwise(F.array_join(path, " -> "))


def read(spark, path: str) -> dict:
    """A schema file, from any file system that Spark reads."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def _typed(kind: str, *names: str, **rules: object) -> dict:
    return {n: {"type": kind, **rules} for n in names}


def _share() -> dict:
    return {"type": "number", "minimum": 0, "maximum": 1}


def _object_of(required: tuple[str, ...], properties: dict) -> dict:
    return {"type": "object", "required": list(required), "properties": properties}


def record_schema() -> dict:
    """The schema of dataset records. Names, stages and bounds are fixed values of the format."""
    accuracies = ("word", "speaker", "timestamp", "code_switch")
    shares = {f"{when}_{a}_accuracy": _share() for a in accuracies for when in ("target", "estimated")}
    verified = {n: {"anyOf": [_share(), {"type": "null"}]} for n in (*(f"verified_{a}_accuracy" for a in accuracies), "measured_word_accuracy", "reviewed_delivery_confidence")}
    flags = ("passed", "human_review_required", "human_review_completed", "human_review_required_for_delivery")
    more_flags = ("estimated", "verified_accuracy", "reviewed_delivery_target_met", "measured_word_accuracy_available")
    strings = {"type": "array", "items": {"type": "string"}}
    gate = _object_of(flags, {**shares, **verified, **_typed("boolean", *flags, *more_flags), **_typed("string", "word_accuracy_basis", "asr_accuracy_basis"), "reasons": strings})
    segment = _object_of(
        ("segment_id", "start", "end", "speaker_id", "text", "sample_rate"),
        {**_typed("string", "segment_id", "speaker_id", minLength=1), **_typed("number", "start", minimum=0), **_typed("number", "end", "duration"), **_typed("string", "text", "text_normalized", "language"), **_typed("integer", "sample_rate", minimum=1), "missing_fields": strings},
    )
    delivery = {"stage": {"enum": ["review_required", "reviewed", "approved", "rejected"]}, **_typed("boolean", "approved_for_client_delivery"), "reason": {"type": ["string", "null"]}}
    top = {
        "schema_version": {"const": "3.0.0"},
        **_typed("string", "session_name", "session_id", "input_mode", minLength=1),
        **_typed("string", "pipeline_mode"),
        **_typed("object", "metadata", "consensus", "review_artifacts"),
        **_typed("array", "transcript_candidates"),
        "validation": _object_of(("passed",), _typed("boolean", "passed")),
        "accuracy_gate": gate,
        "human_review": _object_of(("required", "status"), {**_typed("boolean", "required"), **_typed("string", "status")}),
        "delivery_status": _object_of(("stage", "approved_for_client_delivery"), delivery),
        "transcript": _object_of(("raw", "segments"), {**_typed("string", "raw", "normalised"), "segments": {"type": "array", "items": segment}}),
    }
    needed = ("schema_version", "session_name", "session_id", "input_mode", "pipeline_mode", "transcript", "metadata", "validation", "accuracy_gate", "human_review", "delivery_status")
    premium = {"if": {"properties": {"pipeline_mode": {"const": "premium_accuracy"}}, "required": ["pipeline_mode"]}, "then": {"required": ["transcript_candidates", "consensus", "review_artifacts", "accuracy_gate", "delivery_status"]}}
    return {**_object_of(needed, top), "allOf": [premium]}

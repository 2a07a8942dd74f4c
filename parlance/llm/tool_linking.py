"""Linking tool calls with their results: validated arguments, topological order, canonical JSON."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import groups, materialise, partitions, task

#: Objects and arrays in one another, at most; deeper arguments are an error of their own.
DEPTH = 200
CALLS = "conv_id string, call_id string, seq long, name string, arguments string, error string, refs array<string>"

_LONE = regex.compile("[\ud800-\udfff]")


def canonical(value: object) -> str:
    """JSON with sorted keys, no spaces, no escapes but those JSON needs; halves of surrogate pairs, which UTF-8 can't hold, are escaped."""
    return _LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False))


def _refuse(name: str) -> object:
    raise ValueError(name)


def _finite(text: str) -> float:
    value = float(text)
    return value if math.isfinite(value) else _refuse(text)


def _depth(text: str) -> int:
    """How deep objects and arrays are in one another; brackets within strings don't count."""
    level = most = 0
    for mark in _BRACKETS.finditer(text):
        level += mark[0] in ("{", "[")
        level -= mark[0] in ("}", "]")
        most = max(most, level)
    return most


_BRACKETS = regex.compile(r'"(?:[^"\\]|\\.)*+"|[\[\]{}]', regex.DOTALL)


def parse(text: str) -> tuple[object, str | None]:
    """A JSON text's value, or why it has none. NaN, Infinity and numbers beyond a double are not JSON."""
    if _depth(text) > DEPTH:
        return None, "nested too deeply"
    try:
        return json.loads(text, parse_constant=_refuse, parse_float=_finite), None
    except (ValueError, RecursionError):
        return None, "not JSON"


def references(value: object) -> Iterator[str]:
    """Identifiers of calls whose results a value stands for: {"$ref": id}, at any depth."""
    if isinstance(value, dict):
        if _stands_for_a_result(value):
            yield value["$ref"]
        for x in value.values():
            yield from references(x)
    elif isinstance(value, list):
        for x in value:
            yield from references(x)


def _stands_for_a_result(value: object) -> bool:
    return isinstance(value, dict) and set(value) == {"$ref"} and isinstance(value["$ref"], str)


def _number(value: object) -> bool:
    return isinstance(value, int | float) and not isinstance(value, bool)


_TYPES = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "integer": lambda v: _number(v) and (isinstance(v, int) or v.is_integer()),
    "number": _number,
}


def _same(a: object, b: object) -> bool:
    """Equality of JSON values: 1 and 1.0 are one, 1 and true are not."""
    if _number(a) and _number(b):
        return a == b
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(_same(a[k], b[k]) for k in a)
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(_same, a, b))
    return type(a) is type(b) and a == b


@lru_cache(maxsize=1024)
def _pattern(text: str) -> regex.Pattern | None:
    try:
        return regex.compile(text)
    except regex.error:
        return None


def _repeats(items: list) -> bool:
    """Whether two items are equal, by canonical texts in which equal numbers read alike."""
    plain = lambda v: float(v) if _number(v) and abs(v) < 2**53 else {k: plain(x) for k, x in v.items()} if isinstance(v, dict) else [plain(x) for x in v] if isinstance(v, list) else v
    return len({canonical(plain(v)) for v in items}) < len(items)


def violation(value: object, schema: object, at: str = "$") -> str | None:
    """The first way in which a value breaks a JSON schema; null if none.

    In order: type, enum and const (value), minimum, maximum and their exclusive forms (range), multipleOf,
    lengths and counts (length), pattern, uniqueItems (repeated), then items, required, property names and
    properties, and last allOf, anyOf, oneOf and not (combination). A type or pattern that can't be told is broken
    by any value; other keywords, format among them, say nothing. A value {"$ref": id}, id a string, is a
    result that is not there yet and breaks nothing.
    """
    if not isinstance(schema, dict):
        return f"{at}: not allowed" if schema is False else None
    if _stands_for_a_result(value):
        return None
    kinds = schema.get("type")
    if kinds and not any(k in _TYPES and _TYPES[k](value) for k in (kinds if isinstance(kinds, list) else [kinds])):
        return f"{at}: type"
    if "enum" in schema and not any(_same(value, x) for x in schema["enum"]) or "const" in schema and not _same(value, schema["const"]):
        return f"{at}: value"
    if _number(value):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value) or value <= schema.get("exclusiveMinimum", -math.inf) or value >= schema.get("exclusiveMaximum", math.inf):
            return f"{at}: range"
        if "multipleOf" in schema and (value / schema["multipleOf"]) % 1:
            return f"{at}: multiple"
    for kind, least, most in ((str, "minLength", "maxLength"), (list, "minItems", "maxItems"), (dict, "minProperties", "maxProperties")):
        if isinstance(value, kind) and not schema.get(least, 0) <= len(value) <= schema.get(most, len(value)):
            return f"{at}: length"
    if isinstance(value, str) and "pattern" in schema and not ((p := _pattern(schema["pattern"])) and p.search(value)):
        return f"{at}: pattern"
    if isinstance(value, list) and schema.get("uniqueItems") is True and _repeats(value):
        return f"{at}: repeated"
    return _inside(value, schema, at) or _combined(value, schema, at)


def _inside(value: object, schema: dict, at: str) -> str | None:
    if isinstance(value, list):
        first = schema.get("prefixItems", [])
        return next((x for k, v in enumerate(value) if (x := violation(v, first[k] if k < len(first) else schema.get("items", True), f"{at}[{k}]"))), None)
    if not isinstance(value, dict):
        return None
    if missing := sorted(k for k in schema.get("required", []) if k not in value):
        return f"{at}.{missing[0]}: missing"
    parts, patterns = schema.get("properties", {}), schema.get("patternProperties", {})
    for k in sorted(value):
        rules = [parts[k]] if k in parts else []
        rules += [rule for p, rule in patterns.items() if (q := _pattern(p)) and q.search(k)]
        found = violation(k, schema.get("propertyNames", True), f"{at}.{k}") or next((x for rule in rules or [schema.get("additionalProperties", True)] if (x := violation(value[k], rule, f"{at}.{k}"))), None)
        if found:
            return found
    return None


def _combined(value: object, schema: dict, at: str) -> str | None:
    if found := next((x for rule in schema.get("allOf", []) if (x := violation(value, rule, at))), None):
        return found
    fits = lambda rules: sum(violation(value, rule, at) is None for rule in rules)
    if "anyOf" in schema and not fits(schema["anyOf"]) or "oneOf" in schema and fits(schema["oneOf"]) != 1 or "not" in schema and fits([schema["not"]]):
        return f"{at}: combination"
    return None


def check_calls(calls: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Calls with canonical arguments, the first error (null if none) and the identifiers they refer to. schemas: a JSON schema for each tool, by name.

    Arguments that are no JSON, or too deep, stand as a JSON string of what was given; null arguments as null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, raw in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                value, error = (None, "no arguments") if raw is None else parse(raw)
                text = "null" if raw is None else canonical(raw if error else value)
                refs = sorted({_LONE.sub("\ufffd", x) for x in references(value)})
                error = ("unknown tool" if name not in schemas else violation(value, schemas[name])) if raw is not None and not error else error
                out.append((text, error, refs))
            text, error, refs = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(text, pa.string()), pa.array(error, pa.string()), pa.array(refs, pa.list_(pa.string()))], ["conv_id", "call_id", "seq", "name", "arguments", "error", "refs"])

    rows = calls.select(F.col("conv_id").cast("string").alias("conv_id"), F.col("call_id").cast("string").alias("call_id"), F.col("seq").cast("long").alias("seq"), "name", "arguments")
    return rows.mapInArrow(task(run), CALLS)


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level): 0 for a call that refers to no call, else one more than the highest level that it refers to; null on a cycle and for what hangs on one.

    Calls are dealt by ranges of (conv_id, seq), so a conversation is in one task, or
    in neighbouring ones if it is a large one. A task orders what it holds as far as
    it gets; a round more is needed only where references lead from one task's range into another's,
    and it works only on calls that are not ordered yet.
    """
    refs = calls.select("conv_id", "call_id", F.explode("refs").alias("ref"))
    known = calls.select("conv_id", F.col("call_id").alias("ref"))
    edges = materialise(refs.join(known, ["conv_id", "ref"]))
    n = partitions(calls.sparkSession)
    todo = calls.select("conv_id", "call_id", "seq")
    done = []
    while True:
        if done:
            before = done[-1].select("conv_id", F.col("call_id").alias("ref"), F.col("level").alias("below"))
            edges = materialise(edges.join(todo.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_semi").join(before, ["conv_id", "ref"], "left").select("conv_id", "call_id", "ref", F.coalesce("below", "known").alias("known")))
        else:
            edges = edges.withColumn("known", F.lit(None).cast("int"))
        # What a call still waits for, and the highest level of what it no longer waits for.
        waits = edges.groupBy("conv_id", "call_id").agg(F.max("known").alias("below"), F.collect_list(F.when(F.col("known").isNull(), F.col("ref"))).alias("waits"))
        rows = todo.join(waits, ["conv_id", "call_id"], "left").select("conv_id", "seq", "call_id", F.coalesce("below", F.lit(-1)).alias("below"), F.coalesce("waits", F.array().cast("array<string>")).alias("waits"))
        dealt = rows.repartitionByRange(n, "conv_id", "seq", "call_id").sortWithinPartitions("conv_id", "seq", "call_id")
        told = Observation()
        state = materialise(dealt.mapInArrow(task(_order), "conv_id string, call_id string, seq long, level int").observe(told, F.count("level").alias("ordered"), F.count(F.lit(1)).alias("all")))
        done.append(state.where("level is not null").select("conv_id", "call_id", "level"))
        todo = state.where("level is null").select("conv_id", "call_id", "seq")
        if told.get["ordered"] in (0, told.get["all"]):
            break
    out = todo.select("conv_id", "call_id", F.lit(None).cast("int").alias("level"))
    for part in done:
        out = out.unionByName(part)
    return out


def _order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Levels of each conversation's calls in this task; null for those that wait for a call which is not here, or for each other."""
    for group in groups(batches, "conv_id"):
        calls, below, waits = (group.column(c).to_pylist() for c in ("call_id", "below", "waits"))
        place = {c: k for k, c in enumerate(calls)}
        level = [None if any(w not in place for w in ws) else b for b, ws in zip(below, waits, strict=True)]
        stuck = [v is None for v in level]
        left = [len(ws) for ws in waits]
        users: dict[int, list[int]] = {}
        for k, ws in enumerate(waits):
            for w in ws:
                if w in place:
                    users.setdefault(place[w], []).append(k)
        ready = [k for k, n in enumerate(left) if not n and not stuck[k]]
        settled: list[int | None] = [None] * len(calls)
        while ready:
            k = ready.pop()
            settled[k] = level[k] + 1
            for u in users.get(k, ()):
                left[u] -= 1
                if not stuck[u]:
                    level[u] = max(level[u], settled[k])
                    if not left[u]:
                        ready.append(u)
        yield pa.RecordBatch.from_arrays([*(group.column(c).combine_chunks() for c in ("conv_id", "call_id", "seq")), pa.array(settled, pa.int32())], ["conv_id", "call_id", "seq", "level"])


def link_tools(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call and per result without a call: conv_id, seq, call_id, name, level, linked, valid, error, message.

    calls: conv_id, call_id, seq, name, arguments (JSON). results: conv_id, call_id, seq, content.
    message is canonical JSON of the call and its result (null where there is none). Of calls with one
    identifier in one conversation the first by (seq, arguments) stands, of results by (seq, content), nulls first.
    Every call or result without a conversation or identifier is a row of its own, linked with nothing.
    error is the first of: no identifier, no arguments, not JSON, nested too deeply, unknown tool, a broken schema
    rule, unknown reference, cyclic reference, no call. level is as levels() has it, null where there is no call: a conversation
    reads in order of (level, seq). Empty tables give no rows; other columns are ignored.
    """
    firsts = lambda df, *c: df.groupBy("conv_id", "call_id").agg(F.min(F.struct("seq", *c)).alias("v")).select("conv_id", "call_id", "v.*")
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    every = materialise(check_calls(calls, schemas))
    checked = materialise(firsts(every.where(named), "arguments", "name", "error", "refs"))
    answers = results.select(F.col("conv_id").cast("string").alias("conv_id"), F.col("call_id").cast("string").alias("call_id"), F.col("seq").cast("long").alias("seq"), F.col("content").cast("string").alias("content"))

    known = checked.select("conv_id", F.col("call_id").alias("ref"))
    lost = checked.select("conv_id", "call_id", F.explode("refs").alias("ref")).join(known, ["conv_id", "ref"], "left_anti").select("conv_id", "call_id").distinct().withColumn("lost", F.lit(True))
    joined = checked.join(levels(checked), ["conv_id", "call_id"]).join(lost, ["conv_id", "call_id"], "left").withColumn("called", F.lit(True))
    joined = joined.join(firsts(answers.where(named), "content").withColumnRenamed("seq", "answer_seq").withColumn("answered", F.lit(True)), ["conv_id", "call_id"], "full")
    error = (
        F.when(F.col("called").isNull(), "no call")
        .when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("lost"), "unknown reference")
        .when(F.col("level").isNull(), "cyclic reference")
    )
    yes = lambda c: F.coalesce(c, F.lit(False))
    rows = joined.select("conv_id", F.coalesce("seq", "answer_seq").alias("seq"), "call_id", "name", "level", error.alias("error"), "arguments", "content", yes("called").alias("called"), yes("answered").alias("answered"))
    alone = every.where(~named).select("conv_id", "seq", "call_id", "name", F.lit(None).cast("int").alias("level"), F.lit("no identifier").alias("error"), "arguments", F.lit(None).cast("string").alias("content"), F.lit(True).alias("called"), F.lit(False).alias("answered"))
    orphans = answers.where(~named).select("conv_id", "seq", "call_id", F.lit(None).cast("string").alias("name"), F.lit(None).cast("int").alias("level"), F.lit("no identifier").alias("error"), F.lit(None).cast("string").alias("arguments"), "content", F.lit(False).alias("called"), F.lit(True).alias("answered"))

    def message(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = []
            for r in batch.to_pylist():
                call = f'{{"arguments":{r["arguments"]},"id":{canonical(r["call_id"])},"name":{canonical(r["name"])}}}' if r["called"] else "null"
                answer = canonical({"content": r["content"], "id": r["call_id"]}) if r["answered"] else "null"
                text.append(f'{{"call":{call},"result":{answer}}}')
            names = ["conv_id", "seq", "call_id", "name", "level", "linked", "error"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(text, pa.string())], [*names, "message"])

    rows = rows.unionByName(alone).unionByName(orphans).withColumn("linked", F.col("called") & F.col("answered"))
    out = rows.mapInArrow(task(message), "conv_id string, seq long, call_id string, name string, level int, linked boolean, error string, message string")
    return out.select("conv_id", "seq", "call_id", "name", "level", "linked", F.col("error").isNull().alias("valid"), "error", "message")

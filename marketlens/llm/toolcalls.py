"""Chat formatting: tool calls linked to their results, ordered, validated and serialised."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterable, Iterator, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketlens.llm.shared import Shared

TYPES: Mapping[str, tuple[type, ...]] = {
    "object": (dict,), "array": (list,), "string": (str,), "boolean": (bool,),
    "integer": (int,), "number": (int, float), "null": (type(None),),
}
#: Schema words that are checked, and those that say nothing about a value.
CHECKED = {
    "type", "enum", "minLength", "maxLength", "pattern", "minimum", "maximum", "items",
    "required", "properties", "additionalProperties",
}
NOTES = {"title", "description", "default", "examples", "$schema", "$id", "$comment"}
#: Arguments nested deeper than this are refused, as they could not be written out again.
DEEPEST = 400


def kinds_of(schema: Mapping) -> list[str]:
    kind = schema.get("type", [])
    return [kind] if isinstance(kind, str) else list(kind)


def check_schema(schema: Mapping, path: str = "$") -> None:
    """Raise for what ``faults`` would pass over: unknown words, types or forms."""
    if not isinstance(schema, Mapping):
        raise ValueError(f"{path}: not a schema of words")
    if unknown := sorted(set(schema) - CHECKED - NOTES):
        raise ValueError(f"{path}: unknown schema words {', '.join(unknown)}")
    if unknown := [k for k in kinds_of(schema) if k not in TYPES]:
        raise ValueError(f"{path}: unknown types {unknown}")
    if not isinstance(schema.get("additionalProperties", True), bool):
        raise ValueError(f"{path}: additionalProperties is neither true nor false")
    re.compile(schema.get("pattern", ""))
    for name, below in schema.get("properties", {}).items():
        check_schema(below, f"{path}.{name}")
    if "items" in schema:
        check_schema(schema["items"], f"{path}[]")


def is_a(value: Any, kind: str) -> bool:
    if isinstance(value, bool) and kind in ("integer", "number"):
        return False
    return isinstance(value, TYPES[kind])


def faults(value: Any, schema: Mapping, path: str = "$") -> Iterator[str]:
    """What keeps ``value`` from a JSON schema: type, enum, bounds, properties and items."""
    kinds = kinds_of(schema)
    if kinds and not any(is_a(value, kind) for kind in kinds):
        yield f"{path}: not of type {' or '.join(kinds)}"
        return
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        yield f"{path}: not an allowed value"
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            yield f"{path}: too short"
        if len(value) > schema.get("maxLength", math.inf):
            yield f"{path}: too long"
        if "pattern" in schema and not re.search(schema["pattern"], value):
            yield f"{path}: does not match"
    elif isinstance(value, (int, float)) and not isinstance(value, bool):
        if not schema.get("minimum", -math.inf) <= value <= schema.get("maximum", math.inf):
            yield f"{path}: out of range"
    elif isinstance(value, list):
        for i, item in enumerate(value):
            yield from faults(item, schema.get("items", {}), f"{path}[{i}]")
    elif isinstance(value, dict):
        known = schema.get("properties", {})
        for name in schema.get("required", ()):
            if name not in value:
                yield f"{path}.{name}: missing"
        for name in sorted(value):
            if name in known:
                yield from faults(value[name], known[name], f"{path}.{name}")
            elif schema.get("additionalProperties") is False:
                yield f"{path}.{name}: unknown"


def too_deep(value: Any) -> bool:
    """Whether lists and objects stand in one another more than ``DEEPEST`` times."""
    level = [value]
    for _ in range(DEEPEST):
        level = [some for some in level if isinstance(some, (list, dict))]
        if not level:
            return False
        level = [v for some in level for v in (some.values() if isinstance(some, dict) else some)]
    return any(isinstance(some, (list, dict)) for some in level)


def plain_numbers(value: Any) -> Any:
    """Whole floats as integers, so equal numbers are written alike."""
    if isinstance(value, float) and value.is_integer() and abs(value) < 1 << 53:
        return int(value)
    if isinstance(value, dict):
        return {k: plain_numbers(v) for k, v in value.items()}
    return [plain_numbers(v) for v in value] if isinstance(value, list) else value


def canonical(value: Any) -> str:
    """JSON with sorted names and without spaces; every value has one form."""
    return json.dumps(
        plain_numbers(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False,
        allow_nan=False,
    )


def parsed(text: str | None) -> tuple[Any, str | None]:
    """The value of a JSON text and why there is none; a repeated name, NaN, half of a
    surrogate pair and nesting beyond ``DEEPEST`` are errors."""

    def once(pairs: list[tuple[str, Any]]) -> dict:
        if len({k for k, _ in pairs}) < len(pairs):
            raise ValueError("repeated name")
        return dict(pairs)

    def refuse(name: str) -> None:
        raise ValueError(f"{name} is no JSON")

    if text is None:
        return None, "$: no arguments"
    try:
        value = json.loads(text, object_pairs_hook=once, parse_constant=refuse)
        if too_deep(value):
            return None, "$: nested too deep"
        canonical(value).encode()
    except (ValueError, RecursionError):
        return None, "$: not JSON"
    return value, None


def levels(shared: Shared, needs: DataFrame) -> DataFrame:
    """(conv, call, level) of every call in ``needs`` (conv, call, dep); level -1 in or behind
    a cycle. Calls without a row here have level 0.

    Calls with one dependency are followed by doubling steps to the end of their chain: a
    call without dependencies or one with several. Only the latter take rounds, each
    settling those whose chains all end at settled calls; so rounds grow with the number of
    such calls one behind another, whatever else the table holds. Settled levels go into
    one stored table.
    """
    edges = shared.put(needs.distinct())
    per_call = edges.groupBy("conv", "call").agg(F.count("*").alias("n"), F.min("dep").alias("up"))
    per_call = shared.put(per_call)
    chains = chain_ends(shared, per_call.filter("n = 1").drop("n"), per_call.count())
    several = per_call.filter("n > 1").select("conv", "call")
    settled = joint_levels(shared, edges, several, chains)
    at = settled.select(F.col("conv").alias("c"), F.col("call").alias("d"),
                        F.col("level").alias("base"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("up") == F.col("d"))
    stuck = F.col("open") | (F.coalesce("base", F.lit(0)) < 0)
    level = F.when(stuck, -1).otherwise(F.coalesce("base", F.lit(0)) + F.col("steps"))
    single = chains.join(at, same, "left").select("conv", "call", level.alias("level"))
    return single.unionByName(settled)


def chain_ends(shared: Shared, singles: DataFrame, calls: int) -> DataFrame:
    """(conv, call, up, steps, open): where the chain of each call in ``singles`` (conv, call,
    up) ends, and how far away; ``open`` if it never does."""
    state = shared.put(singles.select("conv", "call", "up", F.lit(1).alias("steps"),
                                      F.lit(True).alias("open")))
    for _ in range(calls.bit_length() + 1):
        if state.filter("open").isEmpty():
            break
        above = state.select(F.col("conv").alias("c"), F.col("call").alias("d"),
                             F.col("up").alias("next"), F.col("steps").alias("more"),
                             F.col("open").alias("goes_on"))
        same = F.col("open") & F.col("conv").eqNullSafe(F.col("c")) & (F.col("up") == F.col("d"))
        following = shared.put(state.join(above, same, "left").select(
            "conv", "call", F.coalesce("next", "up").alias("up"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            F.coalesce("goes_on", F.lit(False)).alias("open"),
        ))
        shared.drop(state)
        state = following
    return state


def joint_levels(
    shared: Shared, edges: DataFrame, several: DataFrame, chains: DataFrame
) -> DataFrame:
    """(conv, call, level) of the calls with several dependencies."""
    joints = several.select(F.col("conv").alias("jc"), F.col("call").alias("jd"))
    ends = chains.select(F.col("conv").alias("c"), F.col("call").alias("d"), "up", "steps", "open")
    chained = F.col("conv").eqNullSafe(F.col("c")) & (F.col("dep") == F.col("d"))
    own = F.col("conv").eqNullSafe(F.col("jc")) & (F.col("call") == F.col("jd"))
    rows = edges.join(joints, own, "left_semi").join(ends, chained, "left").select(
        "conv", "call", F.coalesce("up", "dep").alias("end"),
        F.coalesce("steps", F.lit(0)).alias("steps"), F.coalesce("open", F.lit(False)).alias("stuck"))
    known = F.col("conv").eqNullSafe(F.col("jc")) & (F.col("end") == F.col("jd"))
    # ``wait``: the joint that has to be settled first; a chain without an end waits for ever.
    waiting = shared.put(rows.join(joints, known, "left").select(
        "conv", "call", "steps",
        F.when(F.col("stuck"), F.col("call")).otherwise(F.col("jd")).alias("wait")))
    folder, schema = shared.path(), waiting.select("conv", "call").schema.add("level", "integer")
    while True:
        ready = shared.put(waiting.groupBy("conv", "call").agg(
            F.count("wait").alias("open"), (F.max("steps") + 1).alias("level")
        ).filter("open = 0").drop("open"))
        if ready.isEmpty():
            stuck = waiting.select("conv", "call").distinct().withColumn("level", F.lit(-1))
            stuck.write.mode("append").parquet(folder)
            return shared.spark.read.schema(schema).parquet(folder)
        ready.write.mode("append").parquet(folder)
        done = ready.select(F.col("conv").alias("c"), F.col("call").alias("d"), "level")
        own = F.col("conv").eqNullSafe(F.col("c")) & (F.col("call") == F.col("d"))
        met = F.col("conv").eqNullSafe(F.col("c")) & (F.col("wait") == F.col("d"))
        left = waiting.join(done, own, "left_anti").join(done, met, "left").select(
            "conv", "call", (F.col("steps") + F.coalesce("level", F.lit(0))).alias("steps"),
            F.when(F.col("level").isNull(), F.col("wait")).alias("wait"))
        following = shared.put(left)
        shared.drop(waiting, ready)
        waiting = following


def link_tool_calls(
    calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping]
) -> DataFrame:
    """One row per (call, result) pair, unanswered call and orphan result.

    ``calls``: conv, call, seq, name, arguments (JSON text) and after (array of call ids
    it depends on); ``results``: conv, call, seq, content. Both are joined by (conv, call);
    a hot identifier on the result side can be split, as the call side has one owner per
    identifier: the first by seq, name and arguments. Further calls of that identifier come
    back as ``duplicate``, exact repetitions as one row with their number in ``repeats``.

    Returned: conv, call, seq, name, result_seq, status (linked, unanswered, duplicate,
    orphan), repeats, level, valid, errors (joined by "; ") and json, the canonical
    {"arguments", "id", "name", "result"}. Ordered by level, then seq, then call, calls
    follow all they depend on; a call in or behind a cycle has level -1, an orphan null. Dependencies on
    identifiers that the conversation lacks, or on the call itself, are errors and do not
    order. Unknown names and arguments that are no JSON, hold half of a surrogate pair or
    are nested more than ``DEEPEST`` times are errors; such arguments are kept as text.
    Types are those that the text shows: 1.0 is no integer and true is not 1. A schema may use the
    words in ``CHECKED``, its type may be a list; other words raise a ValueError at once.

    A null conv is a conversation of its own. A null call identifier links with nothing.
    Null content is JSON null; empty tables give the rows of the other one.
    """
    for name, schema in schemas.items():
        check_schema(schema, name)
    shared = Shared(calls.sparkSession)
    columns = ["conv", "call", "seq", "name", "arguments", "after"]
    distinct = calls.groupBy(*columns).agg(F.count("*").alias("repeats"))
    distinct = shared.put(distinct.withColumn("row", F.monotonically_increasing_id()))
    first = distinct.filter("call is not null").groupBy("conv", "call").agg(
        F.min(F.struct("seq", "name", "arguments", "row"))["row"].alias("owner")
    )
    first = shared.put(first)
    owners = first.select("owner")
    needs = distinct.join(owners, F.col("row") == F.col("owner"), "left_semi").select(
        "conv", "call", F.explode("after").alias("dep")
    ).filter("dep is not null")
    there = first.select(F.col("conv").alias("c"), F.col("call").alias("d"))
    known = F.col("conv").eqNullSafe(F.col("c")) & (F.col("dep") == F.col("d"))
    needs = shared.put(needs.join(there, known, "left").select(
        "conv", "call", "dep", (F.col("d").isNotNull() & (F.col("dep") != F.col("call"))).alias("ok")
    ))
    depth = levels(shared, needs.filter("ok").drop("ok")).select(
        F.col("conv").alias("lc"), F.col("call").alias("ld"), "level"
    )
    lost = needs.filter("not ok").groupBy("conv", "call").agg(
        F.array_sort(F.collect_set("dep")).alias("lost")
    ).select(F.col("conv").alias("mc"), F.col("call").alias("md"), "lost")
    told = (
        distinct.join(first.select("owner"), F.col("row") == F.col("owner"), "left")
        .join(depth, F.col("conv").eqNullSafe(F.col("lc")) & (F.col("call") == F.col("ld")), "left")
        .join(lost, F.col("conv").eqNullSafe(F.col("mc")) & (F.col("call") == F.col("md")), "left")
        .select(*columns[:5], "repeats", F.col("owner").isNotNull().alias("owns"),
                F.coalesce("level", F.lit(0)).alias("level"), "lost")
    )
    answers = results.select(
        F.col("conv").alias("rc"), F.col("call").alias("rd"),
        F.col("seq").cast("long").alias("result_seq"), F.col("content").cast("string"),
    )
    owned = told.filter("owns").drop("owns")
    same = F.col("conv").eqNullSafe(F.col("rc")) & (F.col("call") == F.col("rd"))
    met = answers.join(owned, same, "left").select(
        F.col("rc").alias("conv"), F.col("rd").alias("call"), "seq", "name", "arguments",
        "repeats", "level", "lost", "result_seq", "content",
        F.when(F.col("call").isNull(), "orphan").otherwise("linked").alias("status"),
    )
    none = [F.lit(None).cast("long").alias("result_seq"),
            F.lit(None).cast("string").alias("content")]
    asked = owned.join(answers.select("rc", "rd").distinct(), same, "left_anti").select(
        *columns[:5], "repeats", "level", "lost", *none, F.lit("unanswered").alias("status")
    )
    others = told.filter("not owns").select(
        *columns[:5], "repeats", "level", "lost", *none,
        F.when(F.col("call").isNull(), "unanswered").otherwise("duplicate").alias("status"),
    )
    rows = met.unionByName(asked).unionByName(others).select(
        F.col("conv").cast("string"), F.col("call").cast("string"), F.col("seq").cast("long"),
        F.col("name").cast("string"), F.col("arguments").cast("string"),
        F.coalesce("repeats", F.lit(1)).cast("long").alias("repeats"), F.col("level").cast("int"),
        F.col("lost").cast("array<string>"), F.col("result_seq").cast("long"),
        F.col("content").cast("string"), "status",
    )
    return rows.mapInArrow(serialiser(schemas), ", ".join(f"{n} {t}" for n, t in OUT.items()))


OUT = {
    "conv": "string", "call": "string", "seq": "long", "name": "string", "result_seq": "long",
    "status": "string", "repeats": "long", "level": "int", "valid": "boolean",
    "errors": "string", "json": "string",
}


def serialiser(schemas: Mapping[str, Mapping]):
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    schema = pa.schema([(n, kinds[t]) for n, t in OUT.items()])

    def one(row: dict) -> dict:
        out = {n: row.get(n) for n in OUT}
        body: dict[str, Any] = {"id": row["call"], "result": row["content"]}
        errors = []
        if row["status"] == "orphan":
            errors.append("$: no call")
        else:
            arguments, why = parsed(row["arguments"])
            if why:
                errors.append(why)
                arguments = row["arguments"]
            elif row["name"] not in schemas:
                errors.append("$: unknown name")
            else:
                errors += faults(arguments, schemas[row["name"]])
            errors += [f"after {dep}: missing" for dep in row["lost"] or ()]
            body |= {"arguments": arguments, "name": row["name"]}
            if row["level"] == -1:
                errors.append("after: cycle")
        return out | {"valid": not errors, "errors": "; ".join(errors), "json": canonical(body)}

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for start in range(0, batch.num_rows, 1024):
                rows = [one(r) for r in batch.slice(start, 1024).to_pylist()]
                yield pa.RecordBatch.from_pylist(rows, schema)

    return batches

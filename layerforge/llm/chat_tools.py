"""Tool calls of conversations: linked, ordered, validated, written as canonical JSON.

Calls and results are hash-joined by (conv_id, call_id).  A call may name the call it follows; its
level, by which a conversation's calls are in topological order, is the length of that chain, found
by pointer doubling (a conversation of n calls takes log2(n) rounds, each one staged join, and no
task holds a conversation).  Arguments are parsed and checked against the tool's schema.  The JSON
has sorted keys, no white space and every field, nulls included.  All of it is DataFrame functions.

Defined cases: calls or results without conv_id or call_id are never linked (status "unnamed");
identical rows of one call or result count once, of several that differ the smallest stands and the
others are the rows of ``duplicates`` (status "duplicate", no level); a missing followed call is an error and counts as none; calls in a cycle have no level and an error;
arguments that are null, not JSON, not an object or have a repeated key are errors; results without
a call are "orphan"; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerforge.llm.common import stage


@dataclass(frozen=True)
class Argument:
    """Kind as in ``schema_of_variant``; least and most bound a number, or a string's length."""

    kind: str
    required: bool = False
    least: int | None = None
    most: int | None = None


Schemas = dict[str, dict[str, Argument]]


def argument_errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """Sorted messages of what is wrong with a call's arguments; empty when they are valid."""
    parsed, keys = F.try_parse_json(arguments), F.json_object_keys(arguments)
    checked = F.when(parsed.isNull(), F.array(F.lit("not JSON"))).when(keys.isNull(), F.array(F.lit("not an object")))
    for tool, fields in schemas.items():
        found = []
        for field, want in fields.items():
            kind = F.schema_of_variant(F.try_variant_get(parsed, f"$.{field}", "variant"))
            text = F.try_variant_get(parsed, f"$.{field}", "string")
            size = F.length(text) if want.kind == "STRING" else F.try_variant_get(parsed, f"$.{field}", "bigint")
            if want.required:
                found.append(F.when(~F.array_contains(keys, field), F.lit(f"{field} is missing")))
            found.append(F.when(F.array_contains(keys, field) & (F.coalesce(kind, F.lit("VOID")) != want.kind),
                                F.lit(f"{field} is not {want.kind}")))
            if want.least is not None:
                found.append(F.when((kind == want.kind) & (size < want.least), F.lit(f"{field} is under {want.least}")))
            if want.most is not None:
                found.append(F.when((kind == want.kind) & (size > want.most), F.lit(f"{field} is over {want.most}")))
        extra = F.transform(F.array_except(keys, F.array(*[F.lit(f) for f in fields])),
                            lambda k: F.concat(k, F.lit(" is unexpected")))
        checked = checked.when(name == tool, F.array_sort(F.concat(F.array_compact(F.array(*found)), extra)))
    return checked.otherwise(F.array(F.lit("unknown tool")))


def call_levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level, lost): level 0 follows none, null is in or behind a cycle; lost: follows a missing call.

    ``calls``: one row per (conv_id, call_id) with ``after``.
    """
    ids = calls.select("conv_id", F.col("call_id").alias("after"), F.lit(True).alias("there")).distinct()
    state = stage(calls.select("conv_id", "call_id", "after").join(ids, ["conv_id", "after"], "left").select(
        "conv_id", "call_id", (F.col("after").isNotNull() & F.col("there").isNull()).alias("lost"),
        F.when(F.col("there"), F.col("after")).alias("up"),
        F.when(F.col("there"), 1).otherwise(0).cast("long").alias("level")), "call-levels")
    n, open_ = state.agg(F.count(F.lit(1)), F.count("up")).head()
    for _ in range(math.ceil(math.log2(n + 1)) + 1 if n else 0):
        if not open_:
            break
        above = state.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("up2"), F.col("level").alias("more"))
        state = stage(state.join(above, ["conv_id", "up"], "left").select(
            "conv_id", "call_id", "lost", F.col("up2").alias("up"),
            (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")), "call-levels")
        open_ = state.agg(F.count("up")).head()[0]
    return state.select("conv_id", "call_id", "lost", F.when(F.col("up").isNull(), F.col("level")).alias("level"))


CALL = ("turn", "after", "name", "arguments")


def _named() -> Column:
    return F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()


def _first_calls(calls: DataFrame) -> DataFrame:
    return calls.where(_named()).groupBy("conv_id", "call_id").agg(F.min(F.struct(*CALL)).alias("c")).select("conv_id", "call_id", "c.*")


def _first_results(results: DataFrame) -> DataFrame:
    return results.where(_named()).groupBy("conv_id", "call_id").agg(F.min("content").alias("content"))


def _with_json(rows: DataFrame) -> DataFrame:
    line = F.to_json(F.struct(  # keys in ascending order
        "after", F.try_parse_json("arguments").alias("arguments"), "content", "errors", F.col("call_id").alias("id"),
        "level", "name", "status"), {"ignoreNullFields": "false"})
    return rows.select("conv_id", "call_id", "level", "status", line.alias("json"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """conv_id, call_id, level, status, json of every call, and of results without a call; one row an id.

    ``calls``: conv_id, turn, call_id, after, name, arguments (JSON text).
    ``results``: conv_id, call_id, content.  Order a conversation by level, then call_id.
    """
    named = _named()
    once = stage(_first_calls(calls), "calls")
    answers = _first_results(results).withColumn("answered", F.lit(True))
    # Both sides have one row an id, so a task's hash table holds its share of the ids, whatever their calls.
    linked = once.join(call_levels(once).hint("shuffle_hash"), ["conv_id", "call_id"]).join(
        answers.hint("shuffle_hash"), ["conv_id", "call_id"], "full")
    nowhere = calls.where(~named).select(
        "conv_id", "call_id", "turn", "after", "name", "arguments", F.lit(False).alias("lost"),
        F.lit(None).cast("long").alias("level"), F.lit(None).cast("string").alias("content"),
        F.lit(None).cast("boolean").alias("answered"), F.lit("unnamed").alias("status"))
    lone = results.where(~named).select(
        "conv_id", "call_id", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("turn", "long"), ("after", "string"), ("name", "string"), ("arguments", "string"), ("lost", "boolean"),
            ("level", "long"))], "content", F.lit(True).alias("answered"), F.lit("unnamed").alias("status"))
    is_call = F.col("turn").isNotNull() | F.col("name").isNotNull() | F.col("lost").isNotNull()
    wrong = F.when(is_call, F.concat(
        argument_errors(F.col("name"), F.col("arguments"), schemas),
        F.when(F.col("lost"), F.array(F.lit("follows a missing call"))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("level").isNull() & (F.col("status") != "unnamed"), F.array(F.lit("follows itself")))
        .otherwise(F.array().cast("array<string>")))).otherwise(F.array().cast("array<string>"))
    status = F.when(F.col("status") == "unnamed", F.col("status")).when(~is_call, "orphan").when(
        F.size("errors") > 0, "invalid").when(F.col("answered"), "ok").otherwise("unanswered")
    rows = (linked.withColumn("status", F.lit("")).unionByName(nowhere).unionByName(lone)
            .withColumn("errors", wrong).withColumn("status", status))
    return _with_json(rows)


def duplicates(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """The calls and results that ``link_tool_calls`` leaves for another one of their id, in its columns.

    Every distinct row but the one that stands there; together they hold all that the tables hold.
    """
    call, result = ("conv_id", "call_id", *CALL), ("conv_id", "call_id", "content")
    others = calls.where(_named()).select(*call).subtract(_first_calls(calls).select(*call)).withColumn(
        "errors", argument_errors(F.col("name"), F.col("arguments"), schemas))
    answers = results.where(_named()).select(*result).subtract(_first_results(results).select(*result)).withColumn(
        "errors", F.array().cast("array<string>"))
    return _with_json(others.unionByName(answers, allowMissingColumns=True)
                      .withColumn("level", F.lit(None).cast("long")).withColumn("status", F.lit("duplicate")))


#: The tools of the derived calls: a user's turn asks for a reply, a system's turn configures.
CHAT_SCHEMAS: Schemas = {
    "configure": {"text": Argument("STRING", True, 1, 4096)},
    "reply": {"turn": Argument("BIGINT", True, 0), "query": Argument("STRING", True, 1, 300),
              "limit": Argument("BIGINT", False, 1, 256)},
}


def calls_of_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations.

    A system or user turn is a call named conv_id-turn that follows the call before it; an assistant
    turn is the result of the call one turn before.
    """
    turns = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    name = lambda back: F.concat_ws("-", "conv_id", F.col("turn") - back)
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("before")).distinct()
    asked = turns.where(F.col("role").isin("system", "user")).join(before, ["conv_id", "turn"], "left")
    calls = asked.select(
        "conv_id", "turn", F.when(F.col("turn").isNotNull() & F.col("conv_id").isNotNull(), name(0)).alias("call_id"),
        F.when(F.col("before") == "assistant", F.when(F.col("turn") > 1, name(2))).when(F.col("before").isNotNull(), name(1)).alias("after"),
        F.when(F.col("role") == "user", "reply").otherwise("configure").alias("name"),
        F.when(F.col("role") == "user", F.to_json(F.struct("turn", F.col("text").alias("query"), F.length("text").alias("limit"))))
        .otherwise(F.to_json(F.struct("text"))).alias("arguments"))
    results = turns.where(F.col("role") == "assistant").select(
        "conv_id", F.when(F.col("turn").isNotNull() & F.col("conv_id").isNotNull(), name(1)).alias("call_id"),
        F.col("text").alias("content"))
    return calls, results


ORACLE = """
WITH RECURSIVE t AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, text FROM conversations),
c AS (SELECT a.conv_id, a.turn, a.role, a.text, a.conv_id || '-' || a.turn AS id,
        CASE WHEN b.role = 'assistant' AND a.turn > 1 THEN a.conv_id || '-' || (a.turn - 2)
             WHEN b.role <> 'assistant' THEN a.conv_id || '-' || (a.turn - 1) END AS after
      FROM t a LEFT JOIN t b ON a.conv_id = b.conv_id AND b.turn = a.turn - 1 WHERE a.role IN ('system', 'user')),
lev AS (SELECT conv_id, id, 0 AS level FROM c WHERE after IS NULL OR after NOT IN (SELECT id FROM c)
        UNION ALL SELECT c.conv_id, c.id, lev.level + 1 FROM c JOIN lev ON c.after = lev.id AND c.conv_id = lev.conv_id),
x AS (SELECT c.conv_id, c.id AS call_id, CAST(lev.level AS BIGINT) AS level, c.after, c.role, c.turn, c.text, r.text AS content,
        list_filter([CASE WHEN c.role = 'user' AND length(c.text) > 256 THEN 'limit is over 256' END,
                     CASE WHEN c.role = 'user' AND length(c.text) < 1 THEN 'limit is under 1' END,
                     CASE WHEN c.role = 'user' AND length(c.text) > 300 THEN 'query is over 300' END,
                     CASE WHEN c.role = 'user' AND length(c.text) < 1 THEN 'query is under 1' END,
                     CASE WHEN c.role = 'system' AND length(c.text) > 4096 THEN 'text is over 4096' END,
                     CASE WHEN c.role = 'system' AND length(c.text) < 1 THEN 'text is under 1' END,
                     CASE WHEN c.after IS NOT NULL AND c.after NOT IN (SELECT id FROM c) THEN 'follows a missing call' END],
                    lambda e: e IS NOT NULL) AS errors
      FROM c JOIN lev ON c.id = lev.id LEFT JOIN t r ON r.conv_id = c.conv_id AND r.turn = c.turn + 1 AND r.role = 'assistant'),
y AS (SELECT *, CASE WHEN len(errors) > 0 THEN 'invalid' WHEN content IS NOT NULL THEN 'ok' ELSE 'unanswered' END AS status FROM x)
SELECT conv_id, call_id, level, status,
  CAST(json_object('after', after, 'arguments',
    CASE WHEN role = 'user' THEN json_object('limit', length(text), 'query', text, 'turn', turn) ELSE json_object('text', text) END,
    'content', content, 'errors', errors, 'id', call_id, 'level', level,
    'name', CASE WHEN role = 'user' THEN 'reply' ELSE 'configure' END, 'status', status) AS VARCHAR) AS json
FROM y
UNION ALL
SELECT a.conv_id, a.conv_id || '-' || (a.turn - 1), NULL, 'orphan',
  CAST(json_object('after', NULL, 'arguments', NULL, 'content', a.text, 'errors', CAST([] AS VARCHAR[]), 'id', a.conv_id || '-' || (a.turn - 1),
    'level', NULL, 'name', NULL, 'status', 'orphan') AS VARCHAR)
FROM t a WHERE a.role = 'assistant' AND NOT EXISTS (SELECT 1 FROM c WHERE c.conv_id = a.conv_id AND c.turn = a.turn - 1)
"""

"""Chat formatting: tool calls are linked to their results, ordered, validated and written as canonical JSON.

Messages are rows (conv_id, turn, role, text).  A call is a ``<tool_call>{...}</tool_call>`` block with ``id``, ``name``,
``arguments`` and, if it needs other calls' results, ``after`` (their ids); a result is a ``<tool_response>{...}</tool_response>``
block with ``id`` and ``content``.  What stands outside blocks is the message's text.

1. Messages are taken apart (one row for the text, one for each block); arguments are held against the tool's schema.
2. Calls and results are hash-joined by (conversation, id).  An id used again is a duplicate; the first call counts.
   The key is the id, not the conversation, so that a very long conversation is spread over the cluster.
3. Calls are ordered topologically: a call is ready at the latest turn of itself, what it needs and the first results
   of that, and among the calls that are ready at one turn Kahn's method gives levels (a round of joins for each,
   written to the shared folder).  What a call needs from earlier turns costs no round, however long such a chain is;
   only calls behind a cycle do, a round for each step.  A result follows its call, and a call the first result of
   each call that it needs.  Sorting by (ready_turn, level, turn, part) gives every conversation in order; no
   conversation is gathered in one task.

Status: ``text``; calls ``answered``, ``unanswered``, ``duplicate``, ``cyclic`` (in a cycle, or behind one at
whatever turn); results ``linked``, ``orphan``; blocks that are
no JSON object with the needed members are ``malformed`` and keep their text.  ``errors`` lists what the schema or a reference
violates.

Defined cases: null text = empty text; null roles are written as null; a null turn counts as -1; rows with a null
conv_id are one conversation; repeated rows are linked alike; extra columns pass by; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, small_batches, table, text_of

OPENING = re.compile(r"<(tool_call|tool_response)>")
SCHEMA = ("conv_id bigint, turn bigint, part int, kind string, call_id string, name string, errors array<string>, "
          "after array<string>, json string")
TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def canonical(value) -> str:
    """Sorted keys, no white space, no escapes but those that JSON or UTF-8 needs."""
    out = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    try:
        out.encode()
    except UnicodeEncodeError:  # half of a surrogate pair
        out = json.dumps(value, sort_keys=True, separators=(",", ":"), allow_nan=False)
    return out


def violations(value, schema: dict, path: str = "$") -> list[str]:
    """What of a JSON schema (type, enum, required, properties, additionalProperties, items, minimum, maximum) a value
    violates."""
    kind = schema.get("type")
    if kind in ("number", "integer"):
        ok = isinstance(value, (int, float)) and not isinstance(value, bool) and (kind == "number" or value == int(value))
    else:
        ok = kind is None or isinstance(value, TYPES[kind])
    if not ok:
        return [f"{path}: not {kind}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{path}: not in enum")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            out.append(f"{path}: below minimum")
        if value > schema.get("maximum", value):
            out.append(f"{path}: above maximum")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}.{k}: missing" for k in schema.get("required", ()) if k not in value]
        for k in sorted(value):
            if k in known:
                out += violations(value[k], known[k], f"{path}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{path}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += violations(x, schema["items"], f"{path}[{i}]")
    return out


def _not_json(name: str):
    raise ValueError(f"{name} is not JSON")


def _entry(kind: str, body: str, tools: dict) -> tuple:
    """(kind, id, name, errors, after, json) of a block."""
    try:
        value = json.loads(body, parse_constant=_not_json)
        name, after = value.get("name"), value.get("after", [])
        if not isinstance(value["id"], str) or not isinstance(after, list) or not all(isinstance(x, str) for x in after):
            raise ValueError("ids are strings")
        if kind == "tool_response":
            return "result", value["id"], None, [], [], canonical(
                {"type": "tool_result", "tool_call_id": value["id"], "content": value["content"]})
        if not isinstance(name, str):
            raise ValueError("a call has a name")
        errors = violations(value["arguments"], tools[name]) if name in tools else ["unknown tool"]
        return "call", value["id"], name, errors, after, canonical(
            {"type": "tool_call", "id": value["id"], "name": name, "arguments": value["arguments"]})
    except (ValueError, KeyError, TypeError, AttributeError, RecursionError, OverflowError):
        return "malformed", None, None, ["malformed"], [], canonical({"type": "malformed", "content": body})


def blocks_of(text: str) -> tuple[str, list[tuple[str, str]]]:
    """(the text without its blocks, the blocks' kinds and bodies): a block reaches from its opening to the next closing
    of its kind, and an opening that none follows is text.  Each scan goes on where the last one ended."""
    left, found, at, never = [], [], 0, set()
    seek = 0
    while (m := OPENING.search(text, seek)) is not None:
        kind = m[1]
        end = -1 if kind in never else text.find(f"</{kind}>", m.end())
        if end < 0:
            never.add(kind)
            if len(never) == 2:
                break
            seek = m.end()
            continue
        left.append(text[at:m.start()])
        found.append((kind, text[m.end():end]))
        at = seek = end + len(kind) + 3
    left.append(text[at:])
    return "".join(left), found


def _parts(tools: dict):
    def run(batches):
        for batch in batches:
            out = []
            for conv, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text"))):
                left, found = blocks_of(text) if "<tool_" in text else (text, [])
                if left.strip() or not found:
                    out.append((conv, turn, 0, "text", None, None, [], [],
                                canonical({"type": "message", "role": role, "content": left})))
                for i, (kind, body) in enumerate(found, 1):
                    out.append((conv, turn, i, *_entry(kind, body, tools)))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()),
                     pa.list_(pa.string()), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], names=[
                "conv_id", "turn", "part", "kind", "call_id", "name", "errors", "after", "json"])
    return run


def _ready(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """(c, id, ready, heard): the latest turn among a call, all that it needs, directly or not, and their first results."""
    state = calls.select("c", "id", F.col("turn").alias("ready"), "heard")
    while True:  # a round for each time that a need stands later than what needs it
        own = edges.join(state.select("c", "id", F.col("ready").alias("now")), ["c", "id"])
        there = state.select("c", F.col("id").alias("need"), F.greatest("ready", "heard").alias("when"))
        late = own.join(there, ["c", "need"]).where(F.col("when") > F.col("now"))
        late = saved(late.groupBy("c", "id").agg(F.max("when").alias("late")), "tool-late")
        if late.isEmpty():
            return state
        state = saved(state.join(late, ["c", "id"], "left").select("c", "id", F.greatest("ready", "late").alias("ready"), "heard"),
                      "tool-ready")


def _ordered(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """(c, id, ready, level): the ready turn, and the level among the calls ready at that turn; calls in a cycle, or
    behind one at whatever turn, are left out.

    ``calls`` has (c, id, turn, heard), ``heard`` the turn of the first result, if any; ``edges`` (c, id, need); every
    need is a call.
    """
    state = saved(_ready(calls, edges), "tool-ready")
    there = state.select("c", F.col("id").alias("need"), F.col("ready").alias("when"), F.greatest("ready", "heard").alias("until"),
                         F.when(F.col("heard").isNull(), 1).otherwise(2).alias("step"))
    # what ends before the turn asks for no order; a result later than its call has level 1 there
    met = saved(edges.join(state.select("c", "id", "ready"), ["c", "id"]).join(there, ["c", "need"])
                .where(F.col("until") == F.col("ready")).select("c", "id", "need", "step", (F.col("when") < F.col("ready")).alias("later")),
                "tool-same")
    least = met.where("later").select("c", "id").distinct().withColumn("level", F.lit(2))
    calls = state.select("c", "id").join(least, ["c", "id"], "left").select("c", "id", F.coalesce("level", F.lit(0)).alias("level"))
    same = met.where("not later").select("c", "id", "need", "step")
    levels = saved(_levels(calls, same), "tool-levels")
    blocked = _blocked(state.select("c", "id").join(levels, ["c", "id"], "left_anti"), edges)
    return state.select("c", "id", "ready").join(levels, ["c", "id"]).join(blocked, ["c", "id"], "left_anti")


def _blocked(cyclic: DataFrame, edges: DataFrame) -> DataFrame:
    """The calls (c, id) given and all that need one of them, directly or not."""
    last = done = saved(cyclic, "tool-blocked")
    while not last.isEmpty():  # a round for each step behind a cycle; calls behind none cost nothing
        behind = edges.join(last.withColumnRenamed("id", "need"), ["c", "need"]).select("c", "id").distinct()
        last = saved(behind.join(done, ["c", "id"], "left_anti"), "tool-blocked")
        done = done.union(last)
    return done


def _levels(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """(c, id, level) of the calls (c, id, least level) that Kahn's method reaches; an edge raises the level by its step."""
    needs = saved(edges.groupBy("c", "id").agg(F.count("*").alias("n")), "tool-needs")
    done = saved(calls.join(needs, ["c", "id"], "left_anti"), "tool-level")
    waiting = calls.withColumnRenamed("level", "least")
    last, counted = done, None
    while True:
        # of each call: how many needs are met so far, and the level that they ask for
        met = edges.join(last.select("c", F.col("id").alias("need"), "level"), ["c", "need"]) \
            .groupBy("c", "id").agg(F.count("*").alias("met"), F.max(F.col("level") + F.col("step")).alias("level"))
        if counted is not None:
            met = met.union(counted).groupBy("c", "id").agg(F.sum("met").alias("met"), F.max("level").alias("level"))
        counted = saved(met, "tool-met")
        last = saved(counted.join(needs.withColumnRenamed("n", "met"), ["c", "id", "met"]).join(waiting, ["c", "id"])
                     .select("c", "id", F.greatest("level", "least").alias("level")), "tool-level")
        if last.isEmpty():
            return done
        counted = counted.join(last.select("c", "id"), ["c", "id"], "left_anti")
        done = done.union(last)


def link(messages: DataFrame, tools: dict) -> DataFrame:
    """(conv_id, turn, part, kind, call_id, name, status, valid, errors, ready_turn, level, json) for every text, call and
    result.  ``tools``: a JSON schema of the arguments by tool name."""
    small_batches(messages.sparkSession)
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                           F.col("role").cast("string").alias("role"), text_of("text").alias("text"))
    parts = saved(rows.mapInArrow(_parts(tools), SCHEMA)
                  .withColumn("c", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
                  .withColumn("t", F.coalesce("turn", F.lit(-1))), "tool-parts")
    calls = parts.where("kind = 'call'")
    first = saved(calls.groupBy("c", F.col("call_id").alias("id")).agg(F.min(F.struct("t", "part")).alias("at"))
                  .select("c", "id", F.col("at.t").alias("turn"), F.col("at.part").alias("part")), "tool-calls")
    is_first = calls.withColumnRenamed("call_id", "id").join(
        first.select("c", "id", F.col("turn").alias("t"), "part"), ["c", "id", "t", "part"])
    wanted = is_first.select("c", "id", F.explode("after").alias("need")).distinct()
    edges = saved(wanted.join(first.select("c", F.col("id").alias("need")), ["c", "need"]).select("c", "id", "need"), "tool-edges")
    missing = saved(wanted.join(first.select("c", F.col("id").alias("need")), ["c", "need"], "left_anti")
                    .groupBy("c", "id").agg(F.array_sort(F.collect_set("need")).alias("missing")), "tool-missing")
    answers = saved(parts.where("kind = 'result'").groupBy("c", F.col("call_id").alias("id")).agg(F.min("t").alias("heard")), "tool-answers")
    order = _ordered(first.join(answers, ["c", "id"], "left").select("c", "id", "turn", "heard"), edges)
    answers = answers.select("c", "id", F.lit(True).alias("answered"))
    facts = first.join(order, ["c", "id"], "left").join(answers, ["c", "id"], "left").join(missing, ["c", "id"], "left")
    facts = saved(facts.select("c", F.col("id").alias("call_id"), F.col("turn").alias("at_turn"), F.col("part").alias("at_part"),
                               "ready", "level", "answered", "missing"), "tool-facts")
    linked = parts.where("call_id is not null").join(facts, ["c", "call_id"], "left")
    call, own = F.col("kind") == "call", (F.col("t") == F.col("at_turn")) & (F.col("part") == F.col("at_part"))
    status = F.when(call, F.when(~own, "duplicate").when(F.col("ready").isNull(), "cyclic")
                    .when(F.col("answered"), "answered").otherwise("unanswered")) \
        .otherwise(F.when(F.col("at_turn").isNull(), "orphan").otherwise("linked"))
    errors: Column = F.concat("errors", F.when(call & own, F.transform(
        F.coalesce("missing", F.array().cast("array<string>")), lambda x: F.concat(F.lit("after unknown "), x)))
        .otherwise(F.array().cast("array<string>")))
    known = F.col("ready").isNotNull() & (own | ~call)
    linked = linked.select("conv_id", "turn", "part", "kind", "call_id", "name", status.alias("status"), errors.alias("errors"),
                           F.when(known, F.greatest("t", "ready")).otherwise(F.col("t")).alias("ready_turn"),
                           F.when(~known, 0).when(call, F.col("level")).when(F.col("t") > F.col("ready"), 1)
                           .otherwise(F.col("level") + 1).alias("level"), "json")
    plain = parts.where("call_id is null").select("conv_id", "turn", "part", "kind", "call_id", "name", F.col("kind").alias("status"),
                                                  "errors", F.col("t").alias("ready_turn"), F.lit(0).alias("level"), "json")
    return linked.unionByName(plain).withColumn("valid", F.size("errors") == 0)


#: The tool of the query: a question and its turn.
TOOLS = {"answer": {"type": "object", "required": ["question", "turn"], "additionalProperties": False, "properties": {
    "question": {"type": "string"}, "turn": {"type": "integer", "minimum": 0}}}}


def _block(name: Column, after: list[Column], arguments: Column) -> Column:
    needs = F.array_join(F.array(*[F.concat(F.lit('"'), x, F.lit('"')) for x in after]), ",") if after else F.lit("")
    return F.concat(F.lit('<tool_call>{"id":"'), name, F.lit('","name":"answer","after":['), needs, F.lit('],"arguments":'), arguments,
                    F.lit("}</tool_call>"))


def with_tool_traffic(conversations: DataFrame) -> DataFrame:
    """The conversations' messages (turn t at 3 t) and, as they have no tool traffic of their own, a call for every user
    message (3 t + 1, after the call two turns before) and a result from every assistant message (3 t - 1).

    By (conv_id + t) modulo 4, a call's message holds further blocks: 1, a chain of two calls behind it at the same turn;
    2, two calls that need each other and one that needs the first of them; 3, the call's id again, a broken block, and a
    call that needs the next user message's call and whose arguments violate the schema.
    """
    base = conversations.select("conv_id", (F.col("turn") * 3).alias("turn"), "role", "text")
    t = F.col("turn")
    name = lambda t, kind="c": F.concat(F.lit(kind), t.cast("string"))
    body = F.to_json(F.struct(
        name(t).alias("id"), F.lit("answer").alias("name"),
        F.when(t >= 2, F.array(name(t - 2))).otherwise(F.array().cast("array<string>")).alias("after"),
        F.struct(text_of("text").alias("question"), t.alias("turn")).alias("arguments")))
    plain = F.concat(F.lit('{"question":"","turn":'), t.cast("string"), F.lit("}"))
    c, d, e, f = (name(t, kind) for kind in "cdef")
    more = F.when((F.col("conv_id") + t) % 4 == 1, F.concat(_block(d, [c], plain), _block(e, [d], plain))) \
        .when((F.col("conv_id") + t) % 4 == 2, F.concat(_block(d, [e], plain), _block(e, [d], plain), _block(f, [d], plain))) \
        .when((F.col("conv_id") + t) % 4 == 3, F.concat(_block(c, [], plain), F.lit('<tool_call>{"id":</tool_call>'),
                                                        _block(d, [name(t + 2)], F.lit('{"question":5,"turn":-1}')))).otherwise("")
    calls = conversations.where("role = 'user'").select(
        "conv_id", (t * 3 + 1).alias("turn"), F.lit("assistant").alias("role"),
        F.concat(F.lit("<tool_call>"), body, F.lit("</tool_call>"), F.coalesce(more, F.lit(""))).alias("text"))
    answer = F.to_json(F.struct(name(t - 1).alias("id"), text_of("text").alias("content")))
    results = conversations.where("role = 'assistant'").select(
        "conv_id", (t * 3 - 1).alias("turn"), F.lit("tool").alias("role"),
        F.concat(F.lit("<tool_response>"), answer, F.lit("</tool_response>")).alias("text"))
    return base.unionByName(calls).unionByName(results)


def op7_tool_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(with_tool_traffic(table(spark, sf_dir, "conversations")), TOOLS).select(
        "conv_id", "turn", "part", "kind", "call_id", "status", "valid", F.array_join("errors", "; ").alias("errors"),
        "ready_turn", "level", "json")


ORACLE = r"""
WITH m AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT conv_id, turn, text FROM m WHERE role = 'user'),
k AS (
  SELECT c.conv_id, c.turn, c.text, a.turn IS NOT NULL AS answered, c.turn >= 2 AND b.turn IS NULL AS lost
  FROM c
  LEFT JOIN (SELECT conv_id, turn FROM m WHERE role = 'assistant') a ON a.conv_id = c.conv_id AND a.turn = c.turn + 1
  LEFT JOIN c b ON b.conv_id = c.conv_id AND b.turn = c.turn - 2)
SELECT conv_id, 3 * turn AS turn, 0 AS part, 'text' AS kind, NULL::VARCHAR AS call_id, 'text' AS status, true AS valid,
       '' AS errors, 3 * turn AS ready_turn, 0 AS level,
       '{"content":' || to_json(text)::VARCHAR || ',"role":' || coalesce(to_json(role)::VARCHAR, 'null') || ',"type":"message"}' AS json
FROM m
UNION ALL
SELECT conv_id, 3 * turn + 1, 1, 'call', 'c' || turn, CASE WHEN answered THEN 'answered' ELSE 'unanswered' END, NOT lost,
       CASE WHEN lost THEN 'after unknown c' || (turn - 2) ELSE '' END, 3 * turn + 1, 0,
       '{"arguments":{"question":' || to_json(text)::VARCHAR || ',"turn":' || turn || '},"id":"c' || turn || '","name":"answer","type":"tool_call"}'
FROM k
UNION ALL
SELECT m.conv_id, 3 * m.turn - 1, 1, 'result', 'c' || (m.turn - 1), CASE WHEN k.turn IS NULL THEN 'orphan' ELSE 'linked' END, true, '',
       3 * m.turn - 1, CASE WHEN k.turn IS NULL THEN 0 ELSE 1 END,
       '{"content":' || to_json(m.text)::VARCHAR || ',"tool_call_id":"c' || (m.turn - 1) || '","type":"tool_result"}'
FROM m LEFT JOIN k ON k.conv_id = m.conv_id AND k.turn = m.turn - 1 WHERE m.role = 'assistant'
UNION ALL
SELECT conv_id, 3 * turn + 1, part, kind, call_id, status, errors = '', errors, ready, level,
       CASE WHEN kind = 'malformed' THEN '{"content":"{\"id\":","type":"malformed"}'
            ELSE '{"arguments":' || CASE WHEN call_id[1] = 'd' AND v = 3 THEN '{"question":5,"turn":-1}' ELSE '{"question":"","turn":' || turn || '}' END
                 || ',"id":"' || call_id || '","name":"answer","type":"tool_call"}' END
FROM (
  SELECT x.*, (x.conv_id + x.turn) % 4 AS v, n.turn IS NOT NULL AS goes_on, n.answered AS heard FROM k x
  LEFT JOIN k n ON n.conv_id = x.conv_id AND n.turn = x.turn + 2) q,
LATERAL (
  SELECT * FROM (VALUES
    (1, 2, 'call', 'd' || turn, 'unanswered', '', 3 * turn + 1 + answered::INT, 1 + answered::INT),
    (1, 3, 'call', 'e' || turn, 'unanswered', '', 3 * turn + 1 + answered::INT, 2 + answered::INT),
    (2, 2, 'call', 'd' || turn, 'cyclic', '', 3 * turn + 1, 0),
    (2, 3, 'call', 'e' || turn, 'cyclic', '', 3 * turn + 1, 0),
    (2, 4, 'call', 'f' || turn, 'cyclic', '', 3 * turn + 1, 0),
    (3, 2, 'call', 'c' || turn, 'duplicate', '', 3 * turn + 1, 0),
    (3, 3, 'malformed', NULL, 'malformed', 'malformed', 3 * turn + 1, 0),
    (3, 4, 'call', 'd' || turn, 'unanswered',
     '$.question: not string; $.turn: below minimum' || CASE WHEN goes_on THEN '' ELSE '; after unknown c' || (turn + 2) END,
     CASE WHEN NOT goes_on THEN 3 * turn + 1 WHEN heard THEN 3 * turn + 8 ELSE 3 * turn + 7 END,
     CASE WHEN NOT goes_on THEN 0 WHEN heard THEN 2 ELSE 1 END)) AS y(w, part, kind, call_id, status, errors, ready, level)
  WHERE w = v) z
"""

import json
import random
import re
import time

from tools.check_oracle import duck, rows_of
from vaultline.llm import toollink as L

from ..conftest import SF_SMALL

TOOLS = {"add": {"type": "object", "required": ["a", "b"], "additionalProperties": False, "properties": {
    "a": {"type": "integer", "minimum": 0}, "b": {"type": "number", "maximum": 9}, "how": {"enum": ["fast", "slow"]},
    "list": {"type": "array", "items": {"type": "string"}}}}}


def call(i, args=None, after=(), name="add"):
    return "<tool_call>" + json.dumps({"id": i, "name": name, "arguments": {"a": 1, "b": 2} if args is None else args, "after": list(after)}) + "</tool_call>"


def answer(i, content="ok"):
    return "<tool_response>" + json.dumps({"id": i, "content": content}) + "</tool_response>"


def linked(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, status string, c int")
    return L.link(frame, TOOLS).orderBy("conv_id", "ready_turn", "level", "turn", "part").collect()


def test_query_equals_sql(spark):
    assert rows_of(L.op7_tool_links(spark, SF_SMALL).toPandas()) == rows_of(duck(SF_SMALL).sql(L.ORACLE).df())


def test_links_and_order(spark):
    rows = [(1, 0, "user", "hi", "x", 1), (1, 1, "tool", answer("p"), "x", 1), (1, 2, "assistant", "so " + call("p") + call("q", after=["p"]), "x", 1),
            (1, 3, "tool", answer("q") + answer("none"), "x", 1), (1, 4, "assistant", call("p"), "x", 1), (2, 0, "tool", answer("p"), "x", 1)]
    got = linked(spark, rows)
    assert [(r["conv_id"], r["kind"], r["call_id"], r["status"]) for r in got] == [
        (1, "text", None, "text"), (1, "text", None, "text"), (1, "call", "p", "answered"), (1, "result", "p", "linked"),
        (1, "call", "q", "answered"), (1, "result", "none", "orphan"), (1, "result", "q", "linked"), (1, "call", "p", "duplicate"),
        (2, "result", "p", "orphan")]


def test_cycles_and_unknown_needs(spark):
    rows = [(1, 0, "assistant", call("a", after=["b"]) + call("b", after=["a"]) + call("c", after=["a"]) + call("d", after=["zz"])
             + call("e", after=["e"]), "x", 1)]
    got = {r["call_id"]: r for r in linked(spark, rows)}
    assert {k: r["status"] for k, r in got.items()} == {"a": "cyclic", "b": "cyclic", "c": "cyclic", "d": "unanswered", "e": "cyclic"}
    assert got["d"]["errors"] == ["after unknown zz"] and not got["d"]["valid"]


def test_a_long_chain_and_a_diamond(spark):
    chain = [(1, i, "assistant", call(f"k{i}", after=[f"k{i + 1}"] if i < 12 else []), "x", 1) for i in range(13)]
    wide = [(2, 0, "assistant", call("s") + call("l", after=["s"]) + call("r", after=["s"]) + call("t", after=["l", "r"]), "x", 1)]
    got = {(r["conv_id"], r["call_id"]): (r["ready_turn"], r["level"]) for r in linked(spark, chain + wide)}
    assert [got[1, f"k{i}"] for i in range(13)] == [(12, 12 - i) for i in range(13)]
    assert [got[2, k] for k in "slrt"] == [(0, 0), (0, 1), (0, 1), (0, 2)]


def test_what_stands_behind_a_cycle_is_cyclic_at_every_turn(spark):
    rows = [(1, 1, "assistant", call("a", after=["b"]) + call("b", after=["a"]), "x", 1), (1, 3, "tool", answer("c"), "x", 1),
            (1, 5, "assistant", call("c", after=["a"]) + call("free"), "x", 1), (1, 7, "assistant", call("d", after=["c"]), "x", 1),
            (1, 9, "assistant", call("e", after=["free"]) + call("f", after=["e", "d"]), "x", 1),
            (2, 1, "assistant", call("a"), "x", 1), (2, 5, "assistant", call("c", after=["a"]), "x", 1)]
    got = {(r["conv_id"], r["call_id"]): r["status"] for r in linked(spark, rows) if r["kind"] == "call"}
    assert {k[1]: v for k, v in got.items() if k[0] == 1} == {
        "a": "cyclic", "b": "cyclic", "c": "cyclic", "free": "unanswered", "d": "cyclic", "e": "unanswered", "f": "cyclic"}
    assert got[2, "c"] == "unanswered"


def test_calls_follow_the_results_they_need(spark):
    rows = [(1, 0, "assistant", call("p") + call("q", after=["p"]) + answer("p"), "x", 1), (1, 1, "assistant", call("r", after=["q"]), "x", 1),
            (1, 4, "tool", answer("q"), "x", 1), (1, 4, "assistant", call("s", after=["r"]), "x", 1), (1, 5, "tool", answer("r"), "x", 1)]
    got = [(r["kind"], r["call_id"], r["ready_turn"], r["level"]) for r in linked(spark, rows)]
    assert got == [("call", "p", 0, 0), ("result", "p", 0, 1), ("call", "q", 0, 2), ("result", "q", 4, 1), ("call", "r", 4, 2),
                   ("result", "r", 5, 1), ("call", "s", 5, 2)]


def test_random_needs_against_brute_force(spark):
    rng = random.Random(7)
    rows, turn, after, heard = [], {}, {}, {}
    for conv in range(40):
        ids = [f"k{i}" for i in range(8)]
        for i in ids:
            key = (conv, i)
            turn[key] = rng.randrange(6)
            after[key] = rng.sample(ids, rng.choice([0, 0, 1, 1, 2]))
            rows.append((conv, turn[key], "assistant", call(i, after=after[key]), "x", 1))
            for _ in range(rng.choice([0, 1, 1, 2])):
                t = rng.randrange(9)
                heard[key] = min(t, heard.get(key, t))
                rows.append((conv, t, "tool", answer(i), "x", 1))
    got = linked(spark, rows)
    good: set = set()  # all that they need is good already
    while len(good) < len(good := good | {k for k in turn if all((k[0], n) in good for n in after[k])}):
        pass
    assert {(r["conv_id"], r["call_id"]) for r in got if r["kind"] == "call" and r["status"] != "cyclic"} == good
    assert 0 < len(good) < len(turn)
    place, first = {}, {}
    for at, r in enumerate(got):
        (place if r["kind"] == "call" else first).setdefault((r["conv_id"], r["call_id"]), at)
    for k in good:
        assert k not in first or place[k] < first[k]
        for n in after[k]:
            assert place[k] > max(place[k[0], n], first.get((k[0], n), -1))


def test_schemas():
    v = lambda x: L.violations(x, TOOLS["add"])
    assert v({"a": 1, "b": 2.5, "how": "fast", "list": ["x"]}) == []
    assert v([]) == ["$: not object"]
    assert v({"a": -1, "b": 10, "z": 0}) == ["$.a: below minimum", "$.b: above maximum", "$.z: unknown"]
    assert v({"a": True, "how": "no", "list": ["x", 1]}) == ["$.b: missing", "$.a: not integer", "$.how: not in enum", "$.list[1]: not string"]


def test_canonical_json_and_malformed_blocks(spark):
    bad = ["<tool_call>{nope</tool_call>", "<tool_call>{\"id\": 1, \"name\": \"add\", \"arguments\": {}}</tool_call>",
           "<tool_call>[1]</tool_call>", "<tool_response>{\"id\": \"x\"}</tool_response>", "<tool_call>" + "[" * 100000 + "</tool_call>",
           "<tool_call>{\"id\": \"n\", \"name\": \"add\", \"arguments\": NaN}</tool_call>"]
    got = linked(spark, [(1, i, "assistant", t, None, None) for i, t in enumerate(bad)])
    assert {r["status"] for r in got} == {"malformed"} and not any(r["valid"] for r in got)
    assert L.canonical({"b": [1, 2.0], "a": "é\n\"", "c": None}) == '{"a":"é\\n\\"","b":[1,2.0],"c":null}'
    assert L.canonical("\ud800") == '"\\ud800"'


def test_edges(spark):
    rows = [(None, None, None, None, None, None), (1, None, "user", "", None, None), (1, 0, "assistant", call("a"), None, None),
            (1, 0, "assistant", call("a"), None, None), (1, 1, "tool", answer("a"), None, None), (3, 0, "user", "y" * 300000, None, None)]
    got = linked(spark, rows)
    assert len(got) == 6 and [r["status"] for r in got if r["kind"] != "text"] == ["answered", "answered", "linked"]
    assert linked(spark, rows[:1])[0]["json"] == '{"content":"","role":null,"type":"message"}'
    assert L.link(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), TOOLS).count() == 0


def test_blocks_equal_the_pattern():
    """A scan that goes forward finds what the plain (quadratic) pattern finds."""
    pattern = re.compile(r"<(tool_call|tool_response)>(.*?)</\1>", re.S)
    rng = random.Random(2)
    bits = ["<tool_call>", "</tool_call>", "<tool_response>", "</tool_response>", "x", "<tool_", " "]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        assert L.blocks_of(text) == (pattern.sub("", text), pattern.findall(text))


def test_unclosed_openings_take_linear_time(spark):
    text = "<tool_call>" * 100000 + "<tool_response>" * 100000
    start = time.time()
    assert L.blocks_of(text) == (text, [])
    assert L.blocks_of(text + "</tool_response>")[1][0][0] == "tool_response"
    assert time.time() - start < 10
    assert [r["kind"] for r in linked(spark, [(1, 0, "user", text, None, 0)])] == ["text"]

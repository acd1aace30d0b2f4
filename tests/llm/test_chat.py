"""Chat formatting: links, order, validation and canonical JSON against plain versions."""
import json

import pytest

from custmaster.llm import chat as C


def call(i, name="search", args=None, after=()):
    return {"id": i, "name": name, "arguments": {"query": "q"} if args is None else args, "after": list(after)}


def calls(*each):
    return json.dumps({"tool_calls": list(each)}, ensure_ascii=False)


def result(i, content="r"):
    return json.dumps({"tool_call_id": i, "content": content})


def rows_of(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return C.format_chat(df).orderBy("conv_id", "order_key", "order_level", "order_kind", "turn").collect()


def test_links_and_order(spark):
    rows = rows_of(spark, [
        (1, 0, "user", "hello"), (1, 1, "assistant", calls(call("a"), call("b", after=["a"]))),
        (1, 2, "assistant", calls(call("c", after=["a"]), call("d", after=["c"]))), (1, 5, "tool", result("a", "late")),
        (1, 6, "tool", result("a", "again")), (1, 3, "tool", result("c")), (1, 7, "tool", result("zz")),
        (2, 0, "assistant", calls(call("a")))])
    one = [(r.kind, r.call_id, r.status) for r in rows if r.conv_id == 1]
    assert one == [("message", None, "plain"), ("call", "a", "linked"), ("call", "b", "unanswered"),
                   ("result", "a", "linked"), ("call", "c", "linked"), ("result", "c", "linked"),
                   ("call", "d", "unanswered"), ("result", "a", "orphan"), ("result", "zz", "orphan")] or one
    place = {(r.kind, r.call_id, r.turn): k for k, r in enumerate(r for r in rows if r.conv_id == 1)}
    assert place["call", "a", 1] < place["result", "a", 5] < place["call", "c", 2] < place["result", "c", 3]
    errors = {r.call_id: r.errors for r in rows if r.kind == "call" and r.conv_id == 1}
    assert errors["b"] == "uses a call that is not earlier" and errors["c"] == ""
    assert errors["d"] == "uses a call that is not earlier"       # c is of the same turn
    assert [r.status for r in rows if r.conv_id == 2] == ["unanswered"]


def test_long_chain_of_late_results(spark):
    n = 12
    rows = [(1, k, "assistant", calls(call(f"c{k}", after=[f"c{k - 1}"] if k else []))) for k in range(n)]
    rows += [(1, 100, "tool", result("c0"))]
    got = rows_of(spark, rows)
    order = [r.call_id for r in got]
    assert order == ["c0", "c0"] + [f"c{k}" for k in range(1, n)]


@pytest.mark.parametrize("name,args,errors", [
    ("search", {"query": "x", "limit": 3}, ""), ("search", {}, "missing query"), ("search", {"query": 1}, "query is not string"),
    ("search", {"query": "x", "limit": "3"}, "limit is not integer"), ("search", {"query": "x", "more": 1}, "unknown parameter more"),
    ("search", [1], "arguments are not an object"), ("search", "text", "arguments are not an object"),
    ("nothing", {"query": "x"}, "unknown tool"), ("translate", {"text": None}, "missing to; text is not string"),
    ("summarise", {"text": "t", "words": 1.5}, "words is not integer")])
def test_validation(spark, name, args, errors):
    (r,) = rows_of(spark, [(1, 0, "assistant", calls(call("a", name, args)))])
    assert r.errors == errors


def test_canonical_json(spark):
    text = '{"tool_calls": [ {"name":"search", "id":"a", "after":["z","b"], "arguments": {"query": "é \\"x\\"\\n", "limit": 7} } ]}'
    (r,) = rows_of(spark, [(1, 0, "assistant", text)])
    assert r.json == '{"after":["b","z"],"arguments":{"limit":7,"query":"é \\"x\\"\\n"},"id":"a","name":"search","role":"call"}'
    (m,) = rows_of(spark, [(1, 0, "user", 'say "hi"\t')])
    assert json.loads(m.json) == {"content": 'say "hi"\t', "role": "user"} and m.json.startswith('{"content":')


def test_odd_rows(spark):
    got = rows_of(spark, [
        (None, None, None, None), (1, 0, "assistant", "{broken"), (1, 1, "tool", "{}"), (1, 2, "assistant", '{"tool_calls": []}'),
        (1, 3, "assistant", ""), (None, 4, "assistant", calls(call("a"))), (1, None, "assistant", calls(call("n"))),
        (1, 5, "assistant", calls(call(None))), (1, 6, "user", "x" * 100_000), (1, 6, "user", "x" * 100_000),
        (1, 7, "assistant", calls(call("t"))), (1, 7, "assistant", calls(call("t"))), (1, 8, "tool", result("t"))])
    kinds = [r.kind for r in got]
    assert kinds.count("message") == 7 and kinds.count("call") == 5 and kinds.count("result") == 1
    assert [r.status for r in got if r.call_id == "t"] == ["linked"] * 3
    assert rows_of(spark, []) == []


def plain_order(turns):
    """(conv, id): (key, level) and the ids with references that are no earlier calls, one call after another."""
    called, answered, uses = {}, {}, {}
    for conv, turn, role, text in turns:
        said = json.loads(text) if text.startswith("{") else {}
        for c in said.get("tool_calls", []) if role == "assistant" else []:
            k = conv, c["id"]
            called[k] = min(turn, called.get(k, turn))
            uses.setdefault(k, set()).update((u, turn) for u in c["after"])
        if role == "tool" and "tool_call_id" in said:
            k = conv, said["tool_call_id"]
            answered[k] = min(turn, answered.get(k, turn))
    good = {k: {(k[0], u) for u, at in us if called.get((k[0], u), at) < at} for k, us in uses.items()}
    bad = {k for k, us in uses.items() if any(called.get((k[0], u), at) >= at for u, at in us)}
    done = {}
    for k in sorted(called, key=lambda k: called[k]):  # used calls are of earlier turns
        place = (called[k], 0)
        for u in good[k]:
            key, level = done[u]
            late = answered.get(u, -1) > key
            place = max(place, (answered[u] if late else key, (0 if late else level) + 1))
        done[k] = place
    return done, answered, bad


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    turns = [tuple(r) for r in C.with_tool_turns(spark.read.parquet(f"{sf}/conversations.parquet")).collect()]
    got = C.run(spark, sf).collect()
    done, answered, bad = plain_order(turns)
    made = [r for r in got if r.kind == "call"]
    assert {(r.conv_id, r.call_id): (r.order_key, r.order_level) for r in made} == done
    assert {(r.conv_id, r.call_id) for r in made if "not earlier" in r.errors} == bad
    assert {(r.conv_id, r.call_id) for r in made if r.status == "linked"} == set(done) & set(answered)
    # the order does work here: late results move calls, one behind another, and results too
    assert sum(r.order_key > r.turn for r in made) > 20 and max(r.order_level for r in made) > 0 and bad
    results = [r for r in got if r.kind == "result"]
    for r in results:
        k = r.conv_id, r.call_id
        first = k in done and answered[k] == r.turn
        assert (r.status == "linked") == first
        assert r.order_key == (max(done[k][0], r.turn) if first else r.turn)
    assert {r.status for r in results} == {"linked", "orphan"}
    # in the order a call stands behind the results it uses
    place = {}
    for i, r in enumerate(sorted(got, key=lambda r: (r.conv_id, r.order_key, r.order_level, r.order_kind, r.turn))):
        place.setdefault((r.kind, r.conv_id, r.call_id), i)
    for r in made:
        for u in json.loads(r.json)["after"]:
            if ("result", r.conv_id, u) in place and (r.conv_id, u) in done and done[r.conv_id, u] < done[r.conv_id, r.call_id]:
                if answered[r.conv_id, u] <= r.order_key and (r.conv_id, r.call_id) not in bad:
                    assert place["result", r.conv_id, u] < place["call", r.conv_id, r.call_id]
    asked = {(c, json.loads(x)["tool_calls"][0]["id"]): json.loads(x) for c, _, role, x in turns if role == "assistant"}
    for r in made:
        if r.call_id.startswith("c"):
            assert json.loads(r.json)["arguments"] == asked[r.conv_id, r.call_id]["tool_calls"][0]["arguments"]
    for r in got:
        assert json.dumps(json.loads(r.json), ensure_ascii=False, sort_keys=True, separators=(",", ":")) == r.json


def test_clashing_columns(spark):
    rows = [(1, 0, "assistant", calls(call("a")), 5, "x", 1), (1, 1, "tool", result("a"), 6, "y", 2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, salt int, call_id string, place int")
    assert sorted((r.kind, r.status) for r in C.format_chat(df).collect()) == [("call", "linked"), ("result", "linked")]


def test_native_plan(spark):
    plan = C.run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_result_without_turn_answers_nothing(spark):
    rows = rows_of(spark, [(1, 0, "assistant", calls(call("a"), call("b"))), (1, None, "tool", result("a", "no turn")),
                           (1, 2, "tool", result("a")), (1, None, "tool", result("b"))])
    got = {(r.kind, r.call_id, r.turn): r.status for r in rows}
    assert got == {("call", "a", 0): "linked", ("call", "b", 0): "unanswered", ("result", "a", 2): "linked",
                   ("result", "a", None): "orphan", ("result", "b", None): "orphan"}

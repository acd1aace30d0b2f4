"""Chat formatting with linked tool calls [DataFrame functions only].

A conversation's turns are plain messages, assistant messages whose text is
``{"tool_calls": [{"id", "name", "arguments", "after"}]}`` (``after``: ids of
calls whose results this one uses), or messages of role ``tool`` whose text is
``{"tool_call_id", "content"}``.  ``format_chat`` turns them into one row per
message, call and result:

* Calls and results are joined by hash on (conversation, id).  The earliest
  result of an id counts; later ones, and results without a call, are kept as
  orphans.  The join is salted: one id that a third of the calls repeat is
  spread over tasks.
* A call comes after the results it uses.  ``order_key``, ``order_level``,
  ``order_kind`` and ``turn`` give the order inside a conversation; they come
  from rounds that push a call behind its latest dependency until nothing
  moves, as many as the longest chain of results that arrive late.  Only calls
  of earlier turns can be used; other references are errors.
* Arguments are validated against the tools' schemas (parameter, JSON type,
  required): unknown tool, not an object, missing, unknown and mistyped
  parameters are listed.
* ``json`` is the row in canonical JSON: keys in order, no white space, the
  arguments' keys in order too.

No group is collected: a conversation of any length is rows.  Null roles and
texts read as empty plain messages, very long ones are kept whole; malformed JSON leaves a
message plain.  Repeated rows stay repeated; calls with equal ids are one call for the order,
at the first one's turn.  Rows without conversation id or turn link to nothing.  Null fields of
a call or result are not written to its JSON, null values inside its arguments are.  An
empty table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custmaster.llm.common import materialise, table

SALTS = 8
_CALLS = "tool_calls array<struct<id:string,name:string,arguments:variant,after:array<string>>>"
_RESULT = "tool_call_id string, content string"

#: tool: parameter: (JSON type, required)
TOOLS = {
    "search": {"query": ("string", True), "limit": ("integer", False)},
    "translate": {"text": ("string", True), "to": ("string", True)},
    "summarise": {"text": ("string", True), "words": ("integer", True)},
}


def _type_of(value: Column) -> Column:
    """JSON type of a variant value."""
    kind = F.schema_of_variant(value)
    return (F.when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind == "BIGINT", "integer")
            .when(kind.rlike("^(DECIMAL|DOUBLE)"), "number").when(kind.startswith("ARRAY"), "array")
            .when(kind.startswith("OBJECT"), "object").otherwise("null"))


def argument_errors(name: Column, arguments: Column, tools: dict = TOOLS) -> Column:
    """What is wrong with a call's arguments (a variant), sorted; empty for nothing."""
    keys = F.coalesce(F.json_object_keys(F.to_json(arguments)), F.array().cast("array<string>"))
    is_object = F.coalesce(_type_of(arguments) == "object", F.lit(False))
    found = F.when(name.isin(*tools) & name.isNotNull(), F.array().cast("array<string>")).otherwise(
        F.array(F.lit("unknown tool")))
    for tool, params in tools.items():
        checks = []
        for param, (kind, required) in params.items():
            value = F.try_variant_get(arguments, f"$.{param}", "variant")
            there = F.array_contains(keys, param)
            right = _type_of(value).isin(kind, *(["integer"] if kind == "number" else []))
            checks.append(F.when(~there & F.lit(required), F.lit(f"missing {param}"))
                          .when(there & ~F.coalesce(right, F.lit(False)), F.lit(f"{param} is not {kind}")))
        other = F.transform(F.array_except(keys, F.array(*map(F.lit, params))),
                            lambda k: F.concat(F.lit("unknown parameter "), k))
        wrong = F.when(is_object, F.array_sort(F.concat(F.array_compact(F.array(*checks)), other))).otherwise(
            F.array(F.lit("arguments are not an object")))
        found = F.when(name == tool, wrong).otherwise(found)
    return found


def parts(chat: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(messages, calls, results) of conversations (conv_id, turn, role, text)."""
    rows = chat.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                       F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("calls", F.when((F.col("role") == "assistant") & F.col("text").startswith("{"),
                                           F.from_json("text", _CALLS)["tool_calls"]))
    rows = rows.withColumn("result", F.when((F.col("role") == "tool") & F.col("text").startswith("{"),
                                            F.from_json("text", _RESULT)))
    rows = materialise(rows, "turns")  # parsed once, read by messages, calls and results
    is_result = F.col("result")["tool_call_id"].isNotNull()
    has_calls = F.coalesce(F.size("calls") > 0, F.lit(False))
    messages = rows.where(~has_calls & ~F.coalesce(is_result, F.lit(False))).select("conv_id", "turn", "role", "text")
    calls = rows.where(has_calls).select("conv_id", "turn", F.posexplode("calls").alias("place", "c")).select(
        "conv_id", "turn", "place", F.col("c.id").alias("call_id"), F.col("c.name").alias("name"),
        F.col("c.arguments").alias("arguments"),
        F.array_distinct(F.coalesce(F.col("c.after"), F.array().cast("array<string>"))).alias("after"))
    results = rows.where(is_result).select("conv_id", "turn", F.col("result")["tool_call_id"].alias("call_id"),
                                           F.col("result")["content"].alias("content"))
    return messages, calls, results


def _look_up(rows: DataFrame, unique: DataFrame, keys: list[str]) -> DataFrame:
    """Left join with a table that has one row a key, salted on both sides."""
    salt = F.pmod(F.xxhash64("turn", "place"), F.lit(SALTS))
    right = unique.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    return rows.withColumn("salt", salt).join(right, [*keys, "salt"], "left").drop("salt")


def _order(calls: DataFrame, answers: DataFrame) -> DataFrame:
    """(conv_id, call_id, order_key, order_level, bad_after) of each call id."""
    ids = ["conv_id", "call_id"]
    nodes = (calls.groupBy(*ids).agg(F.min("turn").alias("called")).join(answers.select(*ids, "answered"), ids, "left")
             .where("conv_id IS NOT NULL AND call_id IS NOT NULL"))
    nodes = materialise(nodes, "calls")
    wanted = calls.select("conv_id", "call_id", "turn", F.explode("after").alias("used")).distinct()
    earlier = nodes.select("conv_id", F.col("call_id").alias("used"), F.col("called").alias("used_called"))
    wanted = wanted.join(earlier, ["conv_id", "used"], "left").withColumn(
        "good", F.coalesce(F.col("used_called") < F.col("turn"), F.lit(False)))
    wanted = materialise(wanted.select("conv_id", "call_id", "used", "good"), "uses")
    edges = wanted.where("good").select("conv_id", "call_id", "used").distinct()
    state = nodes.select(*ids, "called", "answered", F.struct(
        F.col("called").alias("key"), F.lit(0).cast("long").alias("level")).alias("at"))
    while True:
        late = F.col("answered") > F.col("at.key")
        done = state.select("conv_id", F.col("call_id").alias("used"), F.struct(
            F.when(late, F.col("answered")).otherwise(F.col("at.key")).alias("key"),
            (F.when(late, F.lit(0)).otherwise(F.col("at.level")) + 1).cast("long").alias("level")).alias("ready"))
        behind = edges.join(done, ["conv_id", "used"]).groupBy(*ids).agg(F.max("ready").alias("ready"))
        moved = state.join(behind, ids, "left").select(
            *ids, "called", "answered", F.greatest("at", "ready").alias("next"), F.col("at").alias("was"))
        moved = materialise(moved, "order")
        changed = moved.where("next <> was").limit(1).count()
        state = moved.select(*ids, "called", "answered", F.col("next").alias("at"))
        if not changed:
            break
    bad = wanted.where("NOT good").groupBy(*ids).agg(F.count("*").alias("bad_after"))
    return state.join(bad, ids, "left").select(
        *ids, F.col("at.key").alias("order_key"), F.col("at.level").alias("order_level"),
        F.coalesce("bad_after", F.lit(0).cast("long")).alias("bad_after"))


def format_chat(chat: DataFrame, tools: dict = TOOLS) -> DataFrame:
    """One row per message, call and result: conv_id, turn, kind, call_id, status, errors,
    order_key, order_level, order_kind, json."""
    messages, calls, results = parts(chat)
    ids = ["conv_id", "call_id"]
    # a result without turn or conversation answers nothing
    answers = (results.where("turn IS NOT NULL AND conv_id IS NOT NULL").groupBy(*ids).agg(F.min(F.struct("turn", "content")).alias("first"))
               .select(*ids, F.col("first.turn").alias("answered"), F.col("first.content").alias("answer")))
    order = _order(calls, answers)
    linked = _look_up(calls, answers.select(*ids, "answered").join(order, ids, "full"), ids)
    errors = F.concat(argument_errors(F.col("name"), F.col("arguments"), tools),
                      F.when(F.col("bad_after") > 0, F.array(F.lit("uses a call that is not earlier")))
                      .otherwise(F.array().cast("array<string>")))
    call_rows = linked.select(
        "conv_id", "turn", F.lit("call").alias("kind"), "call_id",
        F.when(F.col("answered").isNotNull(), "linked").otherwise("unanswered").alias("status"),
        F.array_join(errors, "; ").alias("errors"),
        F.coalesce("order_key", "turn").alias("order_key"),
        F.coalesce("order_level", F.lit(0).cast("long")).alias("order_level"), F.lit(0).alias("order_kind"),
        F.to_json(F.struct(F.array_sort("after").alias("after"), "arguments", F.col("call_id").alias("id"), "name",
                           F.lit("call").alias("role"))).alias("json"))
    placed = _look_up(results.withColumn("place", F.lit(0)), order.join(answers.select(*ids, "answered"), ids), ids)
    first = F.col("order_key").isNotNull() & (F.col("turn") == F.col("answered"))
    on_time = first & (F.col("order_key") >= F.col("turn"))
    result_rows = placed.select(
        "conv_id", "turn", F.lit("result").alias("kind"), "call_id",
        F.when(first, "linked").otherwise("orphan").alias("status"), F.lit("").alias("errors"),
        F.when(on_time, F.col("order_key")).otherwise(F.col("turn")).alias("order_key"),
        F.when(on_time, F.col("order_level")).otherwise(F.lit(0).cast("long")).alias("order_level"),
        F.lit(1).alias("order_kind"),
        F.to_json(F.struct("content", F.lit("result").alias("role"), F.col("call_id").alias("tool_call_id"))).alias("json"))
    message_rows = messages.select(
        "conv_id", "turn", F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"),
        F.lit("plain").alias("status"), F.lit("").alias("errors"), F.col("turn").alias("order_key"),
        F.lit(0).cast("long").alias("order_level"), F.lit(0).alias("order_kind"),
        F.to_json(F.struct(F.col("text").alias("content"), "role")).alias("json"))
    return call_rows.unionByName(result_rows).unionByName(message_rows)


def with_tool_turns(conversations: DataFrame) -> DataFrame:
    """A tool conversation from a plain one; what exactly happens, texts' lengths decide.

    Each user turn is kept and also asks one or two tools at once, using calls before it, now and
    then one of its own turn or one that nobody made (errors).  Each assistant turn is the result
    of the first call of the turn before, at its place or some turns later, when further calls
    have been made that use it; some results come twice, and some are of calls that were not made."""
    t, n, turn = F.col("text"), F.length("text"), F.col("turn")
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))

    def call_id(letter: str, back: int) -> Column:
        return F.concat(F.lit(letter), (turn - back).cast("string"))

    def made(letter: str, kind: Column, after: Column) -> Column:
        asks = (F.when(kind == 0, F.to_json(F.struct(t.alias("query"), (n % 20).alias("limit"))))
                .when(kind == 1, F.to_json(F.struct(F.lit("en").alias("to"), t.alias("text"))))
                .otherwise(F.to_json(F.struct(  # a number of words as text, where the length says so, is an error
                    F.when(n % 2 == 0, F.lit("25")).alias("words"), t.alias("text")))))
        name = F.when(kind == 0, "search").when(kind == 1, "translate").otherwise("summarise")
        return F.struct(call_id(letter, 0).alias("id"), name.alias("name"), F.parse_json(asks).alias("arguments"),
                        F.array_compact(after).alias("after"))

    one = made("c", n % 3, F.array(F.when(turn > 1, call_id("c", 2)), F.when((turn > 3) & (n % 5 == 0), call_id("c", 4)),
                                   F.when(n % 11 == 0, F.lit("nobody's"))))
    two = made("d", (n + 1) % 3, F.array(F.when(turn > 1, call_id("c", 2)), F.when(n % 8 == 1, call_id("c", 0))))
    calls = rows.where("role = 'user'").select(
        "conv_id", "turn", F.lit("assistant").alias("role"),
        F.to_json(F.struct(F.when(n % 4 == 1, F.array(one, two)).otherwise(F.array(one)).alias("tool_calls"))).alias("text"))
    arrivals = F.array(F.struct((turn + 2 * (n % 3)).alias("at"), call_id("c", 1).alias("id")),
                       F.when(n % 7 == 0, F.struct((turn + 1).alias("at"), call_id("c", 1).alias("id"))),
                       F.when(n % 2 == 0, F.struct(turn.alias("at"), call_id("d", 1).alias("id"))))
    results = rows.where("role = 'assistant'").select("conv_id", "text", F.explode(F.array_compact(arrivals)).alias("a"))
    results = results.select("conv_id", F.col("a.at").alias("turn"), F.lit("tool").alias("role"), F.to_json(F.struct(
        F.col("a.id").alias("tool_call_id"), F.col("text").alias("content"))).alias("text"))
    plain = rows.where("role IS NULL OR role <> 'assistant'")
    return plain.unionByName(calls).unionByName(results)


def run(spark, sf_dir: str) -> DataFrame:
    return format_chat(with_tool_turns(table(spark, sf_dir, "conversations")))

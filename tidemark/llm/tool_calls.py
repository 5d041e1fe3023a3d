"""Tool calls and their results in chats: linked, ordered, validated and written as canonical JSON; DataFrame operations only.

An ``assistant`` message may hold ``{"tool_calls": [{"id", "name", "arguments", "after"}, ...]}``: arguments are an object or its JSON
text, ``after`` is the id of a call in the same conversation whose result this one needs, or a list of them. A ``tool`` message
holds ``{"tool_call_id", "content"}``. Everything else in a chat passes by.

- Linking: calls, results and what calls wait for meet on conversation and id. Ids may start again in every turn: calls of an id are numbered in
  order; a result means the latest call of its id before it, and so does a waiting call, or the id's first call if all come later. The hash join is on id and
  number. Numbers are running counts within stretches of turns plus sums over earlier stretches, so one id that very many messages
  share is as many tasks' work as its conversation has stretches.
- Order: a call's level is its longest distance from a call that waits for none. Calls that wait for one other point at it, and pointers are
  replaced by what their target points at, so chains of n calls take log2(n) joins; what is left are calls that wait for several, whose
  levels follow in as many rounds as lie behind each other. A call without level waits, in the end, for itself. Sorting by level,
  calls before their results, is a topological order.
- Validation: names, presence and types of arguments against ``Tool`` schemas, on parsed variants.
- Canonical JSON: keys sorted at every depth, no blanks, numbers as the parser reads them.

Nulls and oddities: messages that are not such JSON, or null, are ignored; a call without id is reported but not linked; a call that a
repeated message holds again, equal in every part, is one call; a null conversation is one of its own; a result without a call before it is a row of status
``orphan_result``; calls of one message are in the order of its list, a result follows the calls of its turn.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored

KINDS = {"string": "STRING", "integer": "BIGINT|DECIMAL\\(\\d+,0\\)", "number": "BIGINT|DOUBLE|FLOAT|DECIMAL.*", "boolean": "BOOLEAN",
         "array": "ARRAY<.*", "object": "OBJECT<.*"}


@dataclass(frozen=True)
class Tool:
    """A tool's parameters by name, each of a type of ``KINDS``, and which of them are required."""

    name: str
    parameters: dict[str, str]
    required: frozenset[str] = field(default_factory=frozenset)

    def __post_init__(self):
        for name, kind in self.parameters.items():
            if kind not in KINDS or not re.fullmatch(r"[A-Za-z_]\w*", name):
                raise ValueError(f"{self.name}: parameter {name!r} of type {kind!r}")
        if not self.required <= set(self.parameters):
            raise ValueError(f"{self.name}: required parameters must be declared")


def _key(conversation: str, call_id: str) -> Column:
    """Conversation and id as one text; null parts stay apart from every value."""
    return F.to_json(F.struct(F.col(conversation).alias("c"), F.col(call_id).alias("i")))


def calls_of(messages: DataFrame) -> DataFrame:
    shape = "struct<tool_calls: array<struct<id: string, name: string, arguments: string, after: string>>>"
    parsed = messages.where("role = 'assistant'").select("conv_id", "turn", F.from_json("text", shape).alias("m"))
    each = parsed.select("conv_id", "turn", F.posexplode("m.tool_calls").alias("position", "call"))
    return each.select("conv_id", "turn", "position", F.col("call.id").alias("id"), F.col("call.name").alias("name"),
                       F.col("call.arguments").alias("arguments"), F.col("call.after").alias("after")).where("id is not null or name is not null")


def results_of(messages: DataFrame) -> DataFrame:
    parsed = messages.where("role = 'tool'").select("conv_id", "turn", F.from_json("text", "struct<tool_call_id: string, content: string>").alias("m"))
    return parsed.select("conv_id", "turn", F.col("m.tool_call_id").alias("id"), F.col("m.content").alias("content")).where("id is not null")


def _wanted(after: Column) -> Column:
    """The ids that a call waits for: one, or a list of them."""
    listed = F.when(after.startswith("["), F.from_json(after, "array<string>"))
    ids = F.coalesce(listed, F.when(after.isNotNull(), F.array(after)), F.array().cast("array<string>"))
    return F.array_distinct(F.filter(ids, lambda i: i.isNotNull()))


REF, CALL, RESULT = 0, 1, 2  # what comes first at one place
STRETCH = 256  # turns


def _numbered(events: DataFrame) -> DataFrame:
    """``events(key, turn, position, kind, ...)`` with ``nth``: how many calls of the key there are up to and with each."""
    one = (F.col("kind") == CALL).cast("long")
    rows = events.withColumn("stretch", F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-(1 << 60))))
    ahead = rows.groupBy("key", "stretch").agg(F.sum(one).alias("here"))
    ahead = ahead.withColumn("base", F.sum("here").over(Window.partitionBy("key").orderBy("stretch")) - F.col("here")).drop("here")
    order = [F.col("turn").asc_nulls_first(), "position", "kind", F.col("name").asc_nulls_first(), F.col("arguments").asc_nulls_first(), F.col("after").asc_nulls_first()]
    within = F.sum(one).over(Window.partitionBy("key", "stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("within", within).join(ahead, ["key", "stretch"]).withColumn("nth", F.col("base") + F.col("within")).drop("stretch", "within", "base")


def _anchored(nodes: DataFrame, single: DataFrame) -> DataFrame:
    """``key, anchor, far``: where the chain of each node's only waits ends, and how many it passes; null for a ring."""
    count = nodes.count()
    step = stored(nodes.join(single, "key", "left").select("key", F.coalesce("on", "key").alias("to"), F.col("on").isNotNull().cast("long").alias("far")))
    ends = nodes.join(single.select("key"), "key", "left_anti").select(F.col("key").alias("to"), F.lit(True).alias("end"))
    reach = 1
    while reach <= count and not step.join(ends, "to", "left_anti").isEmpty():
        ahead = step.select(F.col("key").alias("to"), F.col("to").alias("next"), F.col("far").alias("more"))
        step = stored(step.join(ahead, "to").select("key", F.col("next").alias("to"), (F.col("far") + F.col("more")).alias("far")))
        reach *= 2
    return step.join(ends, "to", "left").select("key", F.when(F.col("end"), F.col("to")).alias("anchor"), "far")


def levels(nodes: DataFrame, waits: DataFrame) -> DataFrame:
    """``key, level`` for ``nodes(key, turn, position)`` and ``waits(key, on)``, both keys; a node that waits for a ring has a null level."""
    waits = stored(waits.select("key", "on").distinct())
    if waits.isEmpty():
        return nodes.select("key", F.lit(0).cast("long").alias("level"))
    # What the latest of a call's waits waits for itself, as its latest, adds nothing.
    place = nodes.select(F.col("key").alias("on"), F.struct("turn", "position", "key").alias("place"))
    latest = stored(waits.where("key <> on").join(place, "on").groupBy("key").agg(F.max_by("on", "place").alias("latest")))
    second = latest.join(latest.select(F.col("key").alias("latest"), F.col("latest").alias("on")), "latest").select("key", "on").where("key <> on")
    needed = stored(waits.join(second, ["key", "on"], "left_anti"))
    needs = stored(needed.groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    single = needed.join(needs.where("n = 1").select("key"), "key")
    reached = stored(_anchored(nodes.select("key"), single))
    # Calls that wait for several: each of them is as far as its chain from where that ends.
    chain = reached.select(F.col("key").alias("on"), "anchor", "far")
    several = stored(needed.join(needs.where("n > 1"), "key").join(chain, "on").select("key", "n", "anchor", (F.col("far") + 1).alias("far")))
    known = stored(nodes.select("key").join(needs.select("key"), "key", "left_anti").select(F.col("key").alias("anchor"), F.lit(0).cast("long").alias("level")))
    left = several
    while not left.isEmpty():
        ready = left.join(known, "anchor").groupBy("key", "n").agg(F.count(F.lit(1)).alias("met"), F.max(F.col("level") + F.col("far")).alias("level"))
        ready = stored(ready.where("met = n").select(F.col("key").alias("anchor"), "level"))
        if ready.isEmpty():
            break
        known = stored(known.unionByName(ready))
        left = stored(left.join(ready.select(F.col("anchor").alias("key")), "key", "left_anti"))
    return reached.join(known, "anchor", "left").select("key", (F.col("far") + F.col("level")).alias("level"))


def _errors(name: Column, arguments: Column, parsed: Column, tools: list[Tool]) -> Column:
    keys = F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>"))

    def faults(tool: Tool) -> Column:
        checks = [F.transform(F.array_except(keys, F.array(*[F.lit(p) for p in tool.parameters]).cast("array<string>")), lambda k: F.concat(F.lit("unknown:"), k))]
        for parameter, kind in tool.parameters.items():
            there = F.array_contains(keys, parameter)
            if parameter in tool.required:
                checks.append(F.when(~there, F.array(F.lit(f"missing:{parameter}"))))
            found = F.schema_of_variant(F.variant_get(parsed, f"$.{parameter}", "variant"))
            checks.append(F.when(there & ~F.coalesce(found.rlike(f"^(?:{KINDS[kind]})$"), F.lit(False)), F.array(F.lit(f"type:{parameter}"))))
        none = F.array().cast("array<string>")
        return F.array_sort(F.concat(*[F.coalesce(c, none) for c in checks]))

    by_tool = reduce(lambda rest, tool: F.when(name == tool.name, faults(tool)).otherwise(rest), tools, F.array(F.lit("unknown_tool")))
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    return F.when(~is_object, F.array(F.lit("malformed"))).otherwise(by_tool)


def link_tool_calls(messages: DataFrame, tools: list[Tool]) -> DataFrame:
    """A row per call and per id of results without call.

    ``conv_id, call_id, nth`` (which call of its id), ``name, turn, status, level, arguments`` (canonical JSON, null if malformed), ``errors``,
    ``result_turn, results`` (how many), ``record`` (canonical JSON of the call with its first result). ``status`` is ``linked``, ``no_result``, ``no_id``
    or ``orphan_result``; ``waits_for`` tells whether all that ``after`` names are there (null if it names none).
    """
    messages = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.col("text").cast("string").alias("text"))
    parts = ["conv_id", "turn", "position", "id", "name", "arguments", "after"]
    all_calls = stored(calls_of(messages).groupBy(*parts).agg(F.count(F.lit(1)).alias("copies")).drop("copies").withColumn("uid", F.monotonically_increasing_id()))
    named = all_calls.where("id is not null")
    refs = named.select("uid", "conv_id", "turn", "position", F.explode(_wanted(F.col("after"))).alias("id"))
    results = results_of(messages).groupBy("conv_id", "turn", "id").agg(F.min(F.struct("content")).alias("first"), F.count(F.lit(1)).alias("n"))
    none = lambda kind: F.lit(None).cast(kind)
    events = named.select(_key("conv_id", "id").alias("key"), *parts, F.lit(CALL).alias("kind"), "uid", none("string").alias("content"), none("long").alias("n"))
    blank = [none("string").alias(c) for c in ("name", "arguments", "after")]
    events = events.unionByName(refs.select(_key("conv_id", "id").alias("key"), "conv_id", "turn", "position", "id", *blank, F.lit(REF).alias("kind"), "uid",
                                            none("string").alias("content"), none("long").alias("n")))
    events = events.unionByName(results.select(_key("conv_id", "id").alias("key"), "conv_id", "turn", F.lit((1 << 31) - 1).alias("position"), "id", *blank,
                                               F.lit(RESULT).alias("kind"), none("long").alias("uid"), F.col("first.content").alias("content"), "n"))
    numbered = stored(_numbered(events))
    calls = numbered.where(F.col("kind") == CALL).drop("kind", "content", "n")
    # The latest call before, or the first one where all come later.
    meant = F.greatest("nth", F.lit(1).cast("long")).alias("nth")
    targets = calls.select("key", "nth", F.col("uid").alias("on"))
    asked = stored(numbered.where(F.col("kind") == REF).select("uid", "key", meant).join(targets, ["key", "nth"], "left"))
    waits = asked.where("on is not null").select(F.col("uid").alias("key"), "on")
    order = levels(calls.select(F.col("uid").alias("key"), "turn", "position"), waits).withColumnRenamed("key", "uid")
    known = asked.groupBy("uid").agg((F.count("on") == F.count(F.lit(1))).alias("waits_for"))
    given = numbered.where(F.col("kind") == RESULT).select("key", "nth", "conv_id", "id", "turn", "content", "n")
    first = F.min(F.struct("turn", "content")).alias("f")
    answers = stored(given.groupBy("key", "nth", "conv_id", "id").agg(first, F.sum("n").alias("results")).select(
        "key", "nth", "conv_id", "id", F.col("f.turn").alias("result_turn"), F.col("f.content").alias("content"), "results"))

    linked = (
        calls.join(answers.drop("conv_id", "id"), ["key", "nth"], "left").join(order, "uid", "left").join(known, "uid", "left")
        .withColumn("status", F.when(F.col("result_turn").isNull() & F.col("results").isNull(), "no_result").otherwise("linked")))
    nameless = all_calls.where("id is null").withColumn("status", F.lit("no_id"))
    orphans = answers.join(targets, ["key", "nth"], "left_anti").drop("nth").withColumn("status", F.lit("orphan_result"))

    parsed = F.try_parse_json("arguments")
    is_call = F.col("status") != "orphan_result"
    rows = linked.unionByName(nameless, True).unionByName(orphans, True)
    rows = rows.withColumn("errors", F.when(is_call, _errors(F.col("name"), F.col("arguments"), parsed, tools)))
    canonical = F.when(is_call & ~F.coalesce(F.array_contains("errors", "malformed"), F.lit(False)), F.to_json(parsed))
    # Fields in the order of their names; the arguments are canonical text already.
    quoted = lambda c: F.to_json(F.struct(F.col(c).alias("x")))
    part = lambda label, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f'"{label}":'), F.regexp_extract(quoted(c), r'(?s)^\{"x":(.*)\}$', 1)))
    record = F.concat(F.lit("{"), F.concat_ws(",", F.concat(F.lit('"arguments":'), canonical), part("id", "id"), part("name", "name"), part("result", "content")), F.lit("}"))
    return rows.select(
        "conv_id", F.col("id").alias("call_id"), "nth", "name", "turn", "status", "waits_for", "level", canonical.alias("arguments"), "errors", "result_turn",
        F.coalesce("results", F.lit(0)).cast("long").alias("results"), record.alias("record"))


def topological(linked: DataFrame, conversation: Column) -> DataFrame:
    """One conversation's calls in order: by level, then as they came."""
    return linked.where(F.col("conv_id").eqNullSafe(conversation)).orderBy(F.col("level").asc_nulls_last(), "turn", "call_id", "nth")

"""Chat messages with linked tool calls, as canonical JSON."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.functions import column
from larder.llm.common import map_batches, ranked, saved
from larder.llm.schemas import every, judged

# How calls and results are written in a message's text
CALL = re.compile(r"<tool_call>(.*?)</tool_call>", re.S)
RESULT = re.compile(r"<tool_result>(.*?)</tool_result>", re.S)
TOOLS = re.compile(r"<tools>(.*?)</tools>", re.S)
SURROGATE = re.compile("[\ud800-\udfff]")

FIELDS = "call_id string, name string, body string, valid boolean, more string"


def canonical(value: object) -> str:
    """JSON with sorted keys, no white space, and characters as they are, but for halves of
    surrogate pairs, which stay escaped. Numbers that are not finite are no JSON: ValueError."""
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return SURROGATE.sub(lambda half: f"\\u{ord(half[0]):04x}", text)


def plain(text: str) -> str:
    """A text without halves of surrogate pairs, which no column can hold: they are escaped."""
    return SURROGATE.sub(lambda half: f"\\u{ord(half[0]):04x}", text)


def refuse(constant: str) -> None:
    raise ValueError(f"{constant} is not JSON")


def rest_of(found: dict, *known: str) -> str | None:
    """What an object has beside the known keys."""
    more = {name: value for name, value in found.items() if name not in known}
    return canonical(more) if more else None


def defined_tools(text: str) -> list[dict]:
    """Name and JSON schema of each tool that a system message defines."""
    found = []
    for body in TOOLS.findall(text):
        try:
            tools = json.loads(body, parse_constant=refuse)
            canonical(tools)
        except (ValueError, RecursionError):
            continue
        for tool in tools if isinstance(tools, list) else [tools]:
            if isinstance(tool, dict) and isinstance(tool.get("name"), str):
                schema = tool.get("parameters")
                found.append({"name": plain(tool["name"]), "schema": canonical(schema if isinstance(schema, dict) else {})})
    return found


def fits_defined(body: str, schema: str | None) -> bool | None:
    """Whether arguments fit a tool's definition; none, or one that is no schema, fits nothing."""
    return False if schema is None else judged(json.loads(body), json.loads(schema))


def parsed(text: str) -> dict | None:
    """The object that a text is; None for anything else, also where numbers are not finite or the nesting
    is too deep to be read."""
    try:
        found = json.loads(text, parse_constant=refuse)
        canonical(found)
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def read_message(role: str | None, text: str, schemas: Mapping[str, Mapping]) -> tuple[str, list[dict], list[dict]]:
    """The text left of a message, its calls and its results."""
    calls, results = [], []
    if "<tool_" in text:
        for kind, into in ((CALL, calls), (RESULT, results)):
            for body in kind.findall(text):
                found = parsed(body)
                if found is None:
                    into.append({"call_id": None, "name": None, "body": canonical(body.strip()), "valid": False, "more": None})
                    continue
                given = found.get("arguments" if into is calls else "content")
                name = found.get("name")
                one = {"call_id": plain(str(found["id"])) if found.get("id") is not None else None}
                one |= {"name": plain(name) if isinstance(name, str) else None, "body": canonical(given)}
                read = ("id", "arguments", "name") if into is calls else ("id", "content")
                one["more"] = rest_of(found, *read)
                valid = True
                if into is calls:
                    schema = schemas.get(one["name"])
                    valid = isinstance(given, dict) and (judged(given, schema) if schema is not None else not schemas)
                into.append(one | {"valid": valid})
            text = kind.sub("", text)
    elif role == "tool" and (found := parsed(text)) is not None and found.get("tool_call_id") is not None:
        one = {"call_id": plain(str(found["tool_call_id"])), "name": None, "body": canonical(found.get("content"))}
        results.append(one | {"valid": True, "more": rest_of(found, "tool_call_id", "content")})
        text = ""
    return text, calls, results


def settled(links: DataFrame, step: int) -> DataFrame:
    """``(n, s)``: of each turn in ``links`` (a, b) the place and the depth it moves to.

    A turn moves to the largest place among its own and those its predecessors move to, with
    a depth of ``step`` more than theirs. Each round hands the values on by one link and is
    stored; there are as many rounds as the longest chain of turns that move.
    """
    ends = links.select(F.col("a").alias("n")).union(links.select(F.col("b").alias("n"))).distinct()
    state = saved(ends.select("n", F.struct(F.col("n").alias("m"), F.lit(0).alias("d")).alias("s")), "chat-places")
    while True:
        handed = links.join(state, F.col("a") == F.col("n")).groupBy("b").agg(
            F.max(F.struct(F.col("s.m").alias("m"), (F.col("s.d") + step).alias("d"))).alias("t")
        )
        # greatest skips the null of a turn without predecessors
        new = state.join(handed, F.col("n") == F.col("b"), "left").select(
            "n", F.greatest("s", "t").alias("s"), (F.col("t") > F.col("s")).alias("more")
        )
        new = saved(new, "chat-places")
        state = new.select("n", "s")
        if new.where("more").isEmpty():
            return state


def without_cycles(links: DataFrame) -> DataFrame:
    """The links, but of those in cycles or between them only the ones that point forward.

    Turns of a cycle move to one place, so only links within a place are peeled: those that
    nothing leads to, or that lead nowhere, until none is left or none goes.
    """
    state = settled(links, 0)
    at_a = state.select(F.col("n").alias("a"), F.col("s.m").alias("m_a"))
    at_b = state.select(F.col("n").alias("b"), F.col("s.m").alias("m_b"))
    core = saved(links.join(at_a, "a").join(at_b, "b").where("m_a = m_b").select("a", "b"), "chat-core")
    many = core.count()
    while many:
        targets, sources = core.select(F.col("b").alias("a")).distinct(), core.select(F.col("a").alias("b")).distinct()
        core = saved(core.join(targets, "a", "left_semi").join(sources, "b", "left_semi").select("a", "b"), "chat-core")
        before, many = many, core.count()
        if many == before:
            return saved(links.join(core.where("a > b"), ["a", "b"], "left_anti"), "chat-links")
    return links


def format_chats(
    turns: DataFrame,
    schemas: Mapping[str, Mapping] | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``(conv_id, turn, position, role, n_calls, n_results, n_linked, n_invalid, message)``,
    one row per turn, ``message`` being canonical JSON.

    A text may hold calls, ``<tool_call>{"id", "name", "arguments"}</tool_call>``, and
    results, ``<tool_result>{"id", "content"}</tool_result>``; a turn of the role "tool" may
    be one JSON result with a ``tool_call_id``. Calls and results are joined by conversation
    and identifier; of repeated calls with one identifier the first counts. A turn with a
    result that stands before its call moves right behind the call's turn, and the turns with
    results of its own calls move behind it in turn; else turns keep their order. ``position``
    (from 0 in each conversation) is a topological order of the links; where turns wait for
    each other, only links with the call before the result count, and a turn may hold both a
    call and its result. Arguments are checked against ``schemas``, JSON schemas by tool name;
    with schemas given, a tool without one is invalid. Without ``schemas``, the tools that a
    conversation's system turns define count, ``<tools>[{"name", "parameters"}]</tools>``, the
    first of a name; a conversation that defines none takes any object. ``valid`` is null in the message, and the call is
    not in ``n_invalid``, where a keyword that :mod:`larder.llm.schemas` doesn't read would decide. A result without a call, broken JSON
    and a call without an identifier stay in the message and are not linked. Broken is also JSON with numbers that
    are not finite and with nesting too deep to be read. Further keys of calls and results stand under ``more``.

    Null conversations form one conversation, a null turn comes first, a null role is the
    empty string, a null text is empty. Turns with equal numbers are ordered by role and
    text. An empty table gives an empty one, a long text is a message like any other, and of the input only the four named
    columns are read. Rows are never gathered by conversation: positions come from one range sort by
    conversation, turn and row, so a conversation may hold a third of all rows.
    """
    known = dict(schemas or {})

    def make():
        def work(batch: pa.RecordBatch) -> list:
            texts, calls, results, tools = [], [], [], []
            for role, text in zip(batch["role"].to_pylist(), batch["text"].to_pylist()):
                left, made, got = read_message(role, text, known)
                texts.append(left)
                calls.append(made)
                results.append(got)
                tools.append(defined_tools(text) if role == "system" and schemas is None and "<tools>" in text else [])
            return [batch["conv"], batch["turn"], batch["role"], texts, calls, results, tools]

        return work

    conv, turn = (turns.schema[name].dataType.simpleString() for name in (conv_col, turn_col))
    rows = turns.select(
        column(conv_col).alias("conv"),
        column(turn_col).alias("turn"),
        F.coalesce(column(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"),
    )
    item = f"array<struct<{', '.join(field.replace(' ', ': ') for field in FIELDS.split(', '))}>>"
    schema = f"conv {conv}, turn {turn}, role string, content string, calls {item}, results {item}, tools array<struct<name: string, schema: string>>"
    read = map_batches(rows, schema, make).withColumn("row", F.monotonically_increasing_id())
    read = saved(read, "chat-turns")
    placed = ranked(read, ["conv", "turn", "role", "content", "row"], "place")
    calls = (
        placed.select("conv", "place", F.explode("calls.call_id").alias("call"))
        .where("call is not null")
        .groupBy(F.col("conv").alias("call_conv"), "call")
        .agg(F.min("place").alias("after"))
    )
    results = placed.select("conv", "place", F.explode("results.call_id").alias("id")).where("id is not null")
    linked = saved(
        results.join(calls, F.col("conv").eqNullSafe(F.col("call_conv")) & (F.col("id") == F.col("call"))).select("place", "after", "id"),
        "chat-links",
    )
    links = saved(linked.select(F.col("after").alias("a"), F.col("place").alias("b")).where("a != b").distinct(), "chat-links")
    found = linked.groupBy("place").agg(F.count("*").alias("n_linked"), F.sort_array(F.collect_set("id")).alias("links"))
    placed = placed.join(found, "place", "left")
    if not links.where("a > b").isEmpty():
        moves = settled(without_cycles(links), 1).select(F.col("n").alias("place"), F.col("s.m").alias("moved"), F.col("s.d").alias("depth"))
        placed = placed.join(moves, "place", "left").withColumns(
            {"moved": F.coalesce("moved", "place"), "depth": F.coalesce("depth", F.lit(0)), "stood": F.col("place")}
        )
        placed = ranked(placed.drop("place"), ["moved", "depth", "stood"], "place")
    tools = placed.select("conv", "place", F.explode("tools").alias("t")).groupBy(F.col("conv").alias("tool_conv"), F.col("t.name").alias("tool"))
    tools = saved(tools.agg(F.min(F.struct("place", "t.schema")).getField("schema").alias("schema")), "chat-tools")
    if tools.isEmpty():
        placed = placed.withColumns({"defined": F.lit(False), "known": F.expr("cast(null as map<string, string>)")})
    else:
        named = placed.select("conv", "place", F.explode(F.array_distinct("calls.name")).alias("name"))
        named = named.join(tools, F.col("conv").eqNullSafe(F.col("tool_conv")) & (F.col("name") == F.col("tool")))
        named = named.groupBy("place").agg(F.map_from_entries(F.collect_list(F.struct("tool", "schema"))).alias("known"))
        convs = tools.select("tool_conv", F.lit(True).alias("has")).distinct()
        placed = placed.join(named, "place", "left").join(convs, F.col("conv").eqNullSafe(F.col("tool_conv")), "left")
        placed = placed.withColumn("defined", F.coalesce("has", F.lit(False)))
    firsts = saved(placed.groupBy("conv").agg(F.min("place").alias("first")).withColumnRenamed("conv", "first_conv"), "chat-first")
    placed = placed.join(firsts, F.col("conv").eqNullSafe(F.col("first_conv"))).withColumn("position", F.col("place") - F.col("first"))

    def make_json():
        def work(batch: pa.RecordBatch) -> list:
            messages, invalid = [], []
            for role, content, calls, results, links, defined, known in zip(
                *(batch[name].to_pylist() for name in ("role", "content", "calls", "results", "links", "defined", "known"))
            ):
                if defined:
                    schema_of = dict(known or ())
                    for c in calls:
                        c["valid"] = every((c["valid"], fits_defined(c["body"], schema_of.get(c["name"]))))
                invalid.append(sum(c["valid"] is False for c in calls))
                message: dict = {"content": content, "role": role}
                if calls:
                    message["tool_calls"] = [
                        {"arguments": json.loads(c["body"]), "id": c["call_id"], "name": c["name"], "valid": c["valid"]}
                        | ({"more": json.loads(c["more"])} if c["more"] else {})
                        for c in calls
                    ]
                if results:
                    message["tool_results"] = [
                        {"content": json.loads(r["body"]), "id": r["call_id"], "linked": r["call_id"] in (links or ())}
                        | ({"more": json.loads(r["more"])} if r["more"] else {})
                        for r in results
                    ]
                messages.append(canonical(message))
            return [*[batch[name] for name in kept], invalid, messages]

        return work

    kept = ["conv", "turn", "position", "role", "n_calls", "n_results", "n_linked"]
    counted = placed.withColumns(
        {
            "n_calls": F.size("calls").cast("bigint"),
            "n_results": F.size("results").cast("bigint"),
            "n_linked": F.coalesce("n_linked", F.lit(0)).cast("bigint"),
        }
    ).select(*kept, "content", "calls", "results", "links", "defined", "known")
    counts = ", ".join(f"{name} bigint" for name in [*kept[4:], "n_invalid"])
    schema = f"{conv_col} {conv}, {turn_col} {turn}, position bigint, role string, {counts}, message string"
    return map_batches(counted, schema, make_json)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP7_SQL = """
SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS position,
       role, 0::BIGINT AS n_calls, 0::BIGINT AS n_results, 0::BIGINT AS n_linked, 0::BIGINT AS n_invalid,
       json_object('content', text, 'role', role)::VARCHAR AS message
FROM conversations
"""

"""Chat formatting with tool-call linking, in DataFrame functions only.

Turns become canonical JSON messages. An assistant's turn may be a JSON object with
`tool_calls` (a list of id, name, arguments), a tool's turn one with `tool_call_id` and
`content`. Results are hash-joined to calls by conversation and identifier; an argument whose
value is the text `${id}` waits for the result of call id. Calls are ordered behind the
results they wait for and results behind their calls; arguments are checked against schemas.

The order is given by the sortable columns order_turn, order_level, order_kind and place and
not by a running number, so no conversation is gathered in one task.

Cases: a null text is an empty content, a null role is kept null and left out of the JSON;
tool JSON that does not parse or holds a number beyond a double is plain text; of calls with the same identifier the first (by
turn and place) is linked, the others are marked `repeated id` (repeated rows count as one
call); a result without a call is not linked; calls that wait for each other in a circle, for themselves or for no known call are
marked, and ordered by their turn, and so are calls that wait for such a one (as `circle`);
arguments that are no JSON object or name a key twice are marked, and the latter kept as the
text they are; a parameter listed twice is required if one row says so and has
the least of its types; a null conv_id or identifier links nothing; repeated rows each get a
row; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.sources.workspace import checkpoint_dir

CALLS = "struct<tool_calls:array<struct<id:string,name:string,arguments:string>>>"
WAITS = r'"\$\{([^}"]+)\}"'
INFINITE = r'"-?Infinity"'


def _turns(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    rows = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # a number beyond a double would come back as this word
    infinite = [F.size(F.regexp_extract_all(t, F.lit(INFINITE), F.lit(0))) for t in ("text", F.get_json_object("text", "$"))]
    looks = F.col("text").startswith("{") & (infinite[0] == infinite[1])
    calls = F.when(looks & (F.col("role") == "assistant"),
                   F.from_json("text", CALLS)["tool_calls"])
    result = F.when(looks & (F.col("role") == "tool"), F.get_json_object("text", "$.tool_call_id"))
    return rows.select("*", calls.alias("calls"), result.alias("result_of"))


def _errors(arguments: Column, schema: Column) -> Column:
    """Sorted complaints about the arguments (map of variants) under a schema (map to type and
    required); a call without schema is an unknown tool."""
    keys = F.coalesce(F.map_keys(arguments), F.array().cast("array<string>"))
    missing = F.transform(
        F.filter(F.map_keys(schema), lambda k: schema[k]["required"] & ~F.array_contains(keys, k)),
        lambda k: F.concat(F.lit("missing "), k))
    extra = F.transform(
        F.filter(keys, lambda k: ~F.array_contains(F.map_keys(schema), k)), lambda k: F.concat(F.lit("unknown "), k))
    wrong = F.transform(
        F.filter(F.map_entries(arguments), lambda e: F.coalesce(
            (F.regexp_extract(F.schema_of_variant(e["value"]), "^[A-Z]+", 0) != schema[e["key"]]["type"])
            & ~((schema[e["key"]]["type"] == "DOUBLE")
                & F.regexp_extract(F.schema_of_variant(e["value"]), "^[A-Z]+", 0).isin("BIGINT", "DECIMAL")),
            F.lit(False))),
        lambda e: F.concat(F.lit("type "), e["key"]))
    none = F.array().cast("array<string>")
    found = F.concat(missing, extra, F.coalesce(wrong, none))
    return (
        F.when(arguments.isNull(), F.array(F.lit("arguments are no object")))
        .when(schema.isNull(), F.array(F.lit("unknown tool"))).otherwise(F.array_sort(found)))


def _paths(singles: DataFrame) -> DataFrame:
    """conv_id, id, to, hops and latest of calls that wait for one other (`needs`): where the
    chain behind a call ends and the last turn on it. Pointers double, so the rounds are the
    logarithm of the longest chain; a call on or behind a circle keeps pointing at one of them.
    """
    paths = singles.select(
        "conv_id", "id", F.col("needs").alias("to"), F.lit(1).cast("long").alias("hops"), F.col("turn").alias("latest")).checkpoint()
    longest = paths.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    for _ in range(longest.bit_length()):
        further = paths.select(
            "conv_id", F.col("id").alias("to"), F.col("to").alias("next"), F.col("hops").alias("more"), F.col("latest").alias("later"))
        paths = paths.join(further, ["conv_id", "to"], "left").select(
            "conv_id", "id", F.coalesce("next", "to").alias("to"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"),
            F.greatest("latest", "later").alias("latest"), F.col("next").isNotNull().alias("moved")).checkpoint()
        moved = not paths.filter("moved").isEmpty()
        paths = paths.drop("moved")
        if not moved:
            break
    return paths


def _levels(calls: DataFrame) -> DataFrame:
    """Of one row per identifier conv_id, id, ready (turn behind which a call can stand) and
    level, the longest chain of calls before it; `state` says ready, circle or unknown call.

    Calls that wait for one other are resolved by `_paths`; those that wait for several take one
    round per link of the longest chain of such calls.
    """
    nodes = calls.select("conv_id", "id", "turn", F.size("waits").alias("n"), "waits").checkpoint()
    done = nodes.filter("n = 0").select("conv_id", "id", F.col("turn").alias("ready"), F.lit(0).cast("long").alias("level"))
    edges = nodes.select("conv_id", "id", "turn", "n", F.explode("waits").alias("needs")).checkpoint()
    if edges.isEmpty():
        return done.withColumns({"state": F.lit("ready"), "level": F.col("level").cast("int")})
    lost = edges.join(nodes.select("conv_id", F.col("id").alias("needs")), ["conv_id", "needs"], "left_anti").select(
        "conv_id", "id").distinct().checkpoint()
    sound = edges.join(lost, ["conv_id", "id"], "left_anti")
    paths = _paths(sound.filter("n = 1"))
    behind = paths.select("conv_id", F.col("id").alias("needs"), "to", "hops", "latest")
    several = sound.filter("n > 1").join(behind, ["conv_id", "needs"], "left").select(
        "conv_id", "id", "turn", F.coalesce("to", "needs").alias("to"), F.coalesce("hops", F.lit(0)).alias("hops"), "latest").checkpoint()
    ends = ["conv_id", "to"]
    while not several.isEmpty():
        ready = done.select("conv_id", F.col("id").alias("to"), "ready", "level")
        fresh = (
            several.join(ready, ends, "left").groupBy("conv_id", "id")
            .agg(F.min(F.col("level").isNotNull()).alias("all"), F.max(F.greatest("turn", "latest", "ready")).alias("ready"),
                 (F.max(F.col("level") + F.col("hops")) + 1).alias("level"))
            .filter("all").drop("all").checkpoint()
        )
        if fresh.isEmpty():
            break
        done = done.unionByName(fresh).checkpoint()
        several = several.join(fresh, ["conv_id", "id"], "left_anti").checkpoint()
    ready = done.select("conv_id", F.col("id").alias("to"), "ready", "level")
    done = done.unionByName(paths.join(ready, ends).select(
        "conv_id", "id", F.greatest("latest", "ready").alias("ready"), (F.col("level") + F.col("hops")).alias("level"))).checkpoint()
    stuck = (
        nodes.join(done, ["conv_id", "id"], "left_anti")
        .join(lost.withColumn("lost", F.lit(True)), ["conv_id", "id"], "left")
        .select("conv_id", "id", F.col("turn").alias("ready"), F.lit(0).cast("long").alias("level"),
                F.when(F.col("lost"), "unknown call").otherwise("circle").alias("state"))
    )
    return done.withColumn("state", F.lit("ready")).unionByName(stuck).withColumn("level", F.col("level").cast("int")).checkpoint()


def format_turns(
    turns: DataFrame, schemas: DataFrame | None = None, conv_id: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per message, call and result.

    `schemas` has tool, parameter, type (a variant type: BIGINT, DOUBLE, STRING, BOOLEAN,
    ARRAY, OBJECT) and required.
    """
    spark = turns.sparkSession
    checkpoint_dir(spark)
    if schemas is None:
        schemas = spark.createDataFrame([], "tool string, parameter string, type string, required boolean")
    rules = schemas.filter("parameter is not null").groupBy(F.col("tool").alias("name"), "parameter").agg(
        F.struct(F.min("type").alias("type"), F.max("required").alias("required")).alias("rule"))
    tools = rules.groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("parameter", "rule"))).alias("schema"))
    rows = _turns(turns, conv_id, turn, role, text)
    no_errors = F.array().cast("array<string>")

    calls = rows.filter("calls is not null").select(
        "conv_id", "turn", "role", F.posexplode("calls").alias("place", "call")).select(
        "conv_id", "turn", "role", "place", F.col("call.id").alias("id"), F.col("call.name").alias("name"),
        F.coalesce("call.arguments", F.lit("{}")).alias("arguments")).checkpoint()
    first = calls.filter("id is not null").groupBy("conv_id", "id").agg(
        F.min(F.struct("turn", "place", "name", "arguments")).alias("at")).select(
        "conv_id", "id", "at.turn", "at.place", "at.name",
        F.array_distinct(F.regexp_extract_all("at.arguments", F.lit(WAITS), F.lit(1))).alias("waits"))
    calls = calls.join(
        first.select("conv_id", "id", "turn", "place", F.lit(True).alias("first")),
        ["conv_id", "id", "turn", "place"], "left").withColumn("first", F.coalesce("first", F.lit(False)))
    levels = _levels(first)
    calls = calls.withColumn("parsed", F.try_parse_json("arguments")).join(levels.hint("shuffle_hash"), ["conv_id", "id"], "left").join(tools, "name", "left")
    read = F.when(F.col("parsed").isNotNull(), F.from_json("arguments", "map<string,variant>"))
    complaints = _errors(read, F.col("schema"))
    complaints = F.concat(
        complaints, F.when(F.col("id").isNotNull() & ~F.col("first"), F.array(F.lit("repeated id"))).otherwise(no_errors),
        F.when(F.col("state") != "ready", F.array(F.col("state"))).otherwise(no_errors))
    call_rows = calls.select(
        "conv_id", "turn", "place", F.lit("call").alias("kind"), "role", F.col("id").alias("call_id"), "name",
        complaints.alias("errors"), F.coalesce("ready", "turn").alias("order_turn"),
        F.coalesce("level", F.lit(0)).alias("order_level"),
        F.to_json(F.struct(F.coalesce("parsed", F.col("arguments").cast("variant")).alias("arguments"),
                           F.col("id").alias("id"), F.col("name").alias("name"), F.col("role").alias("role"))).alias("message"))

    results = rows.filter("result_of is not null").select(
        "conv_id", "turn", F.col("role"), "text", F.col("result_of").alias("id"))
    linked = first.join(levels, ["conv_id", "id"], "left").select(
        "conv_id", "id", "name", F.coalesce("ready", "turn").alias("ready"), F.coalesce("level", F.lit(0)).alias("level"))
    result_rows = results.join(linked.hint("shuffle_hash"), ["conv_id", "id"], "left").select(
        "conv_id", "turn", F.lit(0).alias("place"), F.lit("result").alias("kind"), "role",
        F.col("id").alias("call_id"), "name",
        F.when(F.col("ready").isNull(), F.array(F.lit("no call"))).otherwise(no_errors).alias("errors"),
        F.greatest("turn", "ready").alias("order_turn"), F.coalesce("level", F.lit(0)).alias("order_level"),
        F.to_json(F.struct(F.get_json_object("text", "$.content").alias("content"), F.col("id").alias("id"),
                           F.col("name").alias("name"), F.col("role").alias("role"))).alias("message"))

    plain = rows.filter("calls is null and result_of is null").select(
        "conv_id", "turn", F.lit(0).alias("place"), F.lit("text").alias("kind"), "role",
        F.lit(None).cast("string").alias("call_id"), F.lit(None).cast("string").alias("name"),
        no_errors.alias("errors"), F.col("turn").alias("order_turn"), F.lit(0).alias("order_level"),
        F.to_json(F.struct(F.col("text").alias("content"), F.col("role").alias("role"))).alias("message"))
    result_kind = F.when(F.col("kind") == "result", 1).otherwise(0)
    return plain.unionByName(call_rows).unionByName(result_rows).select(
        "conv_id", "turn", "place", "kind", "role", "call_id", "name", (F.size("errors") == 0).alias("valid"), "errors",
        "order_turn", "order_level", result_kind.alias("order_kind"), "message")

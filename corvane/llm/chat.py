"""Chat formatting: tool calls linked with their results, in topological order, checked and written as canonical JSON.

A call and its result carry the same call_id within a conversation and are joined on it by hash. A result depends on its call;
a call may depend on the result of another call (`after`). The order of messages is that of turns wherever it follows these dependencies: a
message stands at the latest turn of itself and all it depends on, behind those (by depth) that stand there too. Depths and latest turns
come from pointer doubling, in as many joins as the depth's
logarithm, on (conversation, call), so that a conversation of any length is spread over all tasks. Positions in that order come
from one sort of all messages by ranges, whatever their conversation, and counts by range; messages are returned as rows, never
gathered by conversation, and writing them sorted by (conversation, position) serialises conversations in order. Arguments are parsed as JSON variants and checked field by field against
their tool's schema; a variant holds an object's keys sorted, so writing it gives canonical JSON. Equal numbers are written alike: those with
an exponent are written out where 38 digits hold them, and 100, 100.0 and 1e2 are all the integer 100.

DataFrame operations only. Defined cases: messages with null or unknown call_id are plain; of calls (or results) that repeat an
id in a conversation the one with the least turn is linked and the others are marked as duplicates; a result without call or
a call without result is kept and marked; calls that depend on each other in a circle have no depth, are marked and come last. Null texts give
JSON without content. Arguments with a number beyond the range of doubles are at fault and left out. A null conversation or turn is kept as such and linked with nothing. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.common import cut, partitions

#: Variant types that a schema's type allows.
KINDS = {"string": ["STRING"], "integer": ["BIGINT", "DECIMAL"], "number": ["BIGINT", "DOUBLE", "DECIMAL"], "boolean": ["BOOLEAN"], "array": ["ARRAY"], "object": ["OBJECT"]}

#: The parts of a JSON text: strings, numbers, what is between, and single characters where it is none.
PART = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"|-?[0-9][0-9.eE+-]*+|[^"0-9-]++|.'
NUMBER = r"^-?(0|[1-9][0-9]*)([.][0-9]+)?([eE][+-]?[0-9]+)?$"


def parts(json: Column) -> Column:
    return F.regexp_extract_all(json, F.lit(PART), F.lit(0))


def plain(json: Column) -> Column:
    """A JSON text with its numbers' exponents written out, where a decimal of 38 digits is the same double. What isn't JSON stays so."""

    def one(part: Column) -> Column:
        out, double = F.when(~part.rlike(NUMBER) | ~part.rlike("[eE]"), part), part.try_cast("double")
        for scale in (18, 0, 37):
            exact = part.try_cast(f"decimal(38,{scale})")
            out = out.when(exact.cast("double") == double, exact.cast("string"))
        return out.otherwise(part)

    return F.when(json.rlike("[0-9][eE]"), F.array_join(F.transform(parts(json), one), "")).otherwise(json)


def out_of_range(json: Column) -> Column:
    """Whether a number in a JSON text is beyond the range of doubles; null for null."""
    infinite = lambda part: part.rlike(NUMBER) & (F.abs(part.try_cast("double")) == float("inf"))
    return json.rlike("[0-9][eE]|[0-9]{300}") & F.exists(parts(json), infinite)


def argument_error(arguments: Column, tool: Column, schemas: dict[str, dict[str, tuple[str, bool]]]) -> Column:
    """The first fault of arguments (a JSON text) under schemas {tool: {field: (type, required)}}, null if there is none. Fields are checked in
    the schema's order."""
    v = F.try_parse_json(arguments)
    out = F.when(arguments.isNull(), "no arguments").when(v.isNull() | ~F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), "not a JSON object").when(out_of_range(arguments), "a number is out of range")
    for name, fields in schemas.items():
        mine = tool == name
        for f, (kind, required) in fields.items():
            quote = '"' if "'" in f else "'"  # a path has no way to escape either
            got = F.try_variant_get(v, f"$[{quote}{f}{quote}]", "variant")
            type_ = F.regexp_extract(F.schema_of_variant(got), "^[A-Z]+", 0)
            fraction = F.lit(kind == "integer") & F.schema_of_variant(got).rlike(r"^DECIMAL\([0-9]+,[^0]")
            none = got.isNull() | (type_ == "VOID")
            if required:
                out = out.when(mine & none, f"{f} is missing")
            out = out.when(mine & ~none & (~type_.isin(KINDS[kind]) | fraction), f"{f} is no {kind}")
        keys = F.map_keys(F.from_json(arguments, "map<string,string>"))
        out = out.when(mine & (F.size(F.array_except(keys, F.array(*[F.lit(x) for x in fields]).cast("array<string>"))) > 0), "unknown field")
    return out.when(tool.isNull() | ~tool.isin(list(schemas)), "unknown tool")


def canonical(json: Column) -> Column:
    """A JSON text with keys sorted, no spaces, and equal numbers alike; null if it isn't JSON or has a number beyond the range of doubles."""
    return F.when(~out_of_range(json), F.to_json(F.try_parse_json(plain(json))))


def depths(nodes: DataFrame) -> DataFrame:
    """conv_id, node, depth (null in or behind a circle), latest (of the turns of the node and all above it) for nodes(conv_id, node, parent, turn),
    unique in the first two. A parent that isn't there is none."""
    there = nodes.select("conv_id", F.col("node").alias("parent"), F.lit(True).alias("_there"))
    n = cut(nodes.join(there, ["conv_id", "parent"], "left").select("conv_id", "node", F.when(F.col("_there"), F.col("parent")).alias("parent"), F.when(F.col("_there"), 1).otherwise(0).cast("bigint").alias("depth"), F.col("turn").alias("latest")))
    total = n.count()
    open_ = n.where(f"parent is not null and depth <= {total}")
    while open_.take(1):
        # latest: of the nodes from this one to before its parent; with the parent's it reaches as far as the parent's parent
        up = n.select("conv_id", F.col("node").alias("parent"), F.col("parent").alias("_up"), F.col("depth").alias("_more"), F.col("latest").alias("_late"))
        # only what isn't at its root yet is joined again
        moved = n.where("parent is not null").join(up, ["conv_id", "parent"], "left")
        moved = moved.select("conv_id", "node", F.col("_up").alias("parent"), (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"), F.greatest("latest", "_late").alias("latest"))
        n = cut(n.where("parent is null").select("conv_id", "node", "parent", "depth", "latest").union(moved))
        open_ = n.where(f"parent is not null and depth <= {total}")
    return n.select("conv_id", "node", F.when(F.col("parent").isNull(), F.col("depth")).alias("depth"), "latest")


def format_chats(messages: DataFrame, schemas: dict[str, dict[str, tuple[str, bool]]]) -> DataFrame:
    """A row for each row of messages(conv_id, turn, role, text, kind, call_id, tool, arguments, after); kind is call, result or null.
    Returns conv_id, turn, role, kind (or plain), call_id, linked, depth, valid, error, json, position."""
    m = messages.select("conv_id", "turn", "role", "text", F.when(F.col("call_id").isNotNull() & F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), F.col("kind")).alias("kind"), "call_id", "tool", plain(F.col("arguments")).alias("arguments"), "after")
    m = m.withColumn("kind", F.when(F.col("kind").isin("call", "result"), F.col("kind")).otherwise("plain"))
    m = m.withColumn("node", F.when(F.col("kind") != "plain", F.concat("kind", F.lit(":"), "call_id")))
    first = m.where("node is not null").groupBy("conv_id", "node").agg(F.min("turn").alias("first"), F.min_by("after", "turn").alias("after"))
    first = cut(first)
    calls = first.where("node like 'call:%'").select("conv_id", F.substring("node", 6, 1 << 30).alias("call_id"), F.lit(True).alias("_called"))
    results = first.where("node like 'result:%'").select("conv_id", F.substring("node", 8, 1 << 30).alias("call_id"))
    pairs = calls.join(results.withColumn("_answered", F.lit(True)), ["conv_id", "call_id"], "full_outer").select("conv_id", "call_id", (F.coalesce("_called", F.lit(False)) & F.coalesce("_answered", F.lit(False))).alias("linked"))
    call = F.col("node").startswith("call:")
    parent = F.when(call, F.concat(F.lit("result:"), "after")).otherwise(F.concat(F.lit("call:"), F.substring("node", 8, 1 << 30)))
    depth = depths(first.select("conv_id", "node", parent.alias("parent"), F.col("first").alias("turn")))
    out = m.join(depth, ["conv_id", "node"], "left").join(first.select("conv_id", "node", "first"), ["conv_id", "node"], "left").join(pairs, ["conv_id", "call_id"], "left")
    fault = F.when(F.col("kind") == "plain", F.lit(None)).when(F.col("turn") != F.col("first"), "duplicate").when(~F.coalesce("linked", F.lit(False)), F.when(F.col("kind") == "call", "no result").otherwise("no call")).when(F.col("depth").isNull(), "circular")
    out = out.withColumn("fault", fault)
    out = out.withColumn("error", F.coalesce("fault", F.when(F.col("kind") == "call", argument_error(F.col("arguments"), F.col("tool"), schemas))))
    # keys in sorted order; absent ones are left out
    made = F.to_json(F.struct(F.col("arguments_json").alias("arguments"), F.when(F.col("kind") != "plain", F.col("call_id")).alias("call_id"), F.col("text").alias("content"), F.col("role").alias("role"), F.when(F.col("kind") == "call", F.col("tool")).alias("tool")))
    out = out.withColumn("arguments_json", F.when((F.col("kind") == "call") & ~out_of_range(F.col("arguments")), F.try_parse_json(F.col("arguments")))).withColumn("json", made)
    out = out.select("conv_id", "turn", "role", "kind", F.when(F.col("kind") != "plain", F.col("call_id")).alias("call_id"), F.coalesce("linked", F.lit(False)).alias("linked"), F.coalesce("depth", F.when(F.col("kind") == "plain", 0)).alias("depth"), F.col("error").isNull().alias("valid"), "error", "json", F.when(F.col("turn").isNotNull() & ((F.col("kind") == "plain") | F.col("depth").isNotNull()), F.greatest("latest", "turn")).alias("place"))
    return positioned(out)


def positioned(messages: DataFrame) -> DataFrame:
    """Without place, with position: from 0 within each conversation by (place, depth, turn), those in circles and without turn last; rows that
    agree in all follow role and text. Ranges of the sort hold neighbouring messages of one conversation or of many, so a long conversation is
    spread over several."""
    last = lambda c: F.col(c).asc_nulls_last()
    keys = [last("conv_id"), last("place"), last("depth"), last("turn"), last("role"), last("json")]
    dealt = messages.repartitionByRange(partitions(messages.sparkSession), *keys).sortWithinPartitions(*keys)
    dealt = cut(dealt.withColumn("_at", F.monotonically_increasing_id()))
    dealt = dealt.withColumn("_range", F.shiftright("_at", 33))
    counts = dealt.groupBy("conv_id", "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    # a row for each conversation and range it lies in
    before = F.sum("_n").over(Window.partitionBy("conv_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(F.col("conv_id").alias("_conv"), F.col("_range").alias("_r"), (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    out = dealt.join(counts, (F.col("_range") == F.col("_r")) & F.col("conv_id").eqNullSafe(F.col("_conv")))
    return out.select(*[c for c in messages.columns if c != "place"], (F.col("_at") + F.col("_shift")).alias("position"))


#: The one tool of plain conversations.
ASK = {"ask": {"chars": ("integer", True), "text": ("string", True)}}


def as_messages(conversations: DataFrame) -> DataFrame:
    """Conversations(conv_id, turn, role, text) as messages: each user turn is a call of the tool `ask`, named by its turn; an assistant turn is
    the result of the turn before; a call comes after the result that the turn before it is. What isn't answered stays unlinked."""
    turn = F.col("turn").cast("string")
    prior = (F.col("turn") - 1).cast("string")
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    args = F.to_json(F.struct(F.length("text").alias("chars"), F.col("text").alias("text")))
    return conversations.select("conv_id", "turn", "role", "text", F.when(user, "call").when(assistant, "result").alias("kind"), F.when(user, turn).when(assistant, prior).alias("call_id"), F.when(user, "ask").alias("tool"), F.when(user, args).alias("arguments"), F.when(user, (F.col("turn") - 2).cast("string")).alias("after"))

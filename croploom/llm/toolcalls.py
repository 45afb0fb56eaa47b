"""Linking tool calls with their results for chat formatting.

Calls and results of a conversation are joined by their identifier, ordered so that a call comes after
the one whose result it uses, checked against the tool's schema, and written as canonical JSON (sorted
keys, no blanks).  Everything is built-in functions and joins.  Depths in the graph of calls are found
by doubling: every round each call looks twice as far along its chain of parents, so the number of
rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from croploom.operators.joins import dim_join
from croploom.operators.numbering import number_rows
from croploom.session import materialise

#: What a value of each schema type looks like to Spark.
TYPES = {"string": "STRING", "integer": "BIGINT", "number": "(BIGINT|DOUBLE|FLOAT|DECIMAL.*)", "boolean": "BOOLEAN", "array": "ARRAY<.*", "object": "OBJECT<.*"}

Schemas = dict[str, dict[str, tuple[str, bool]]]


# One of these marks numbers while their text is parsed: the first that the text does not hold in any form.
_MARKS = ("\uE000", "\uF8FE", "\uE7A1")
_TOKEN = r"""("(?:[^"\\]|\\.)*"|-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|[^"0-9-]+|["-])"""


def _plain_number(t: str) -> str:
    """SQL for the canonical text of a number token: its exact digits, in plain form from 1e-6 to 1e21.

    No leading or trailing zeros, no minus before zero; beyond the plain form one digit, the others after
    a point, and the exponent with its sign.  An exponent that is no 64-bit number leaves the token as it is.
    """
    whole, part = f"regexp_extract({t}, '^-?([0-9]+)', 1)", f"regexp_extract({t}, '[.]([0-9]+)', 1)"
    power = f"if({t} rlike '[eE]', try_cast(regexp_replace(regexp_extract({t}, '[eE]([+-]?[0-9]+)', 1), '^[+]', '') as bigint), 0L)"
    sign = f"if(left({t}, 1) = '-', '-', '')"
    small = "concat('0.', repeat('0', cast(-n.x as int)), n.sig)"
    large = "concat(n.sig, repeat('0', cast(n.x - length(n.sig) as int)))"
    inner = "concat(left(n.sig, cast(n.x as int)), '.', substring(n.sig, cast(n.x + 1 as int)))"
    power_form = "concat(left(n.sig, 1), if(length(n.sig) > 1, concat('.', substring(n.sig, 2)), ''), 'e', if(n.x > 0, '+', ''), cast(n.x - 1 as string))"
    text = f"case when n.sig = '' then '0' when n.x is null then {t} else concat({sign}, case when n.x > 21 or n.x < -5 then {power_form} when n.x <= 0 then {small} when n.x >= length(n.sig) then {large} else {inner} end) end"
    digits = f"named_struct('sig', trim(trailing '0' from trim(leading '0' from concat({whole}, {part}))), 'x', try_add({power}, cast(length({whole}) - length(regexp_extract(concat({whole}, {part}), '^0*', 0)) as bigint)))"
    return f"transform(array({digits}), n -> {text})[0]"


def canonical(json: str) -> Column:
    """The JSON text of a column with sorted keys, one form for each number and without blanks; null where it is none.

    Numbers keep their exact digits, however many: ``1.0``, ``1`` and ``10e-1`` are ``1``.  Repeated keys in
    an object, and texts that hold all of three reserved characters, count as no JSON.
    """
    mark = " ".join(f"when not {json} rlike '(?i){m}|u{ord(m):04x}' then '{m}'" for m in _MARKS)
    token = f"if(k rlike '^-?[0-9]', concat('\"', r.m, {_plain_number('k')}, r.m, '\"'), k)"
    joined = f"array_join(transform(regexp_extract_all(r.t, {_sql(_TOKEN)}, 1), k -> {token}), '')"
    done = f"regexp_replace(to_json(try_parse_json({joined})), concat('\"', r.m, '([^', r.m, ']*)', r.m, '\"'), '$1')"
    # what is no JSON before its numbers are marked is none after
    # and so is what something follows, which the parser would leave unread
    whole = "try_parse_json(concat('[', r.t, ']')) is not null and variant_get(try_parse_json(concat('[', r.t, ']')), '$[1]', 'variant') is null"
    one = f"case when r.m is not null and try_parse_json(r.t) is not null and {whole} then {done} end"
    return F.expr(f"transform(array(named_struct('t', {json}, 'm', case {mark} end)), r -> {one})[0]")


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(text: Column) -> Column:
    """A string as JSON; null as null."""
    packed = F.to_json(F.array(text))
    return F.when(text.isNull(), F.lit("null")).otherwise(F.substring(packed, 2, F.length(packed) - 2))


def problems(schemas: Schemas, tool: str = "tool", arguments: str = "arguments") -> Column:
    """What is wrong with a call's arguments, in alphabetical order.

    ``unknown_tool``, ``not_an_object``, ``missing:<name>``, ``type:<name>`` or ``unknown:<name>``.  The
    schemas map a tool to its argument names, and these to a type (a key of TYPES) and whether they
    are required; null stands for a missing argument.
    """
    v = F.try_parse_json(F.col(arguments))
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    none = F.array().cast("array<string>")
    out = F.array(F.lit("unknown_tool"))
    for name, fields in schemas.items():
        found = [
            F.when(F.schema_of_variant(F.variant_get(v, f'$["{field}"]', "variant")).isNull() | (F.schema_of_variant(F.variant_get(v, f'$["{field}"]', "variant")) == "VOID"), F.lit(f"missing:{field}") if required else F.lit(None))
            .when(~F.schema_of_variant(F.variant_get(v, f'$["{field}"]', "variant")).rlike(f"^{TYPES[kind]}$"), F.lit(f"type:{field}"))
            .cast("string")
            for field, (kind, required) in fields.items()
        ]
        known = F.array(*(F.lit(f) for f in fields)).cast("array<string>") if fields else none
        extra = F.transform(F.array_except(F.coalesce(F.json_object_keys(F.col(arguments)), none), known), lambda k: F.concat(F.lit("unknown:"), k))
        own = F.array_sort(F.array_compact(F.concat(F.array(*found) if found else none, extra)))
        out = F.when(F.col(tool) == name, F.when(is_object, own).otherwise(F.array(F.lit("not_an_object")))).otherwise(out)
    return out


def depths(calls: DataFrame) -> DataFrame:
    """conv_id, call_id and depth of calls (conv_id, call_id, parent_id), one row per call.

    A call without parent, or whose parent is no call of its conversation, has depth 0, any other one
    more than its parent; calls on a cycle or after one have none (null).
    """
    keys = calls.select("conv_id", F.col("call_id").alias("parent_id"), F.lit(True).alias("there"))
    start = calls.join(keys, ["conv_id", "parent_id"], "left").select(
        "conv_id", "call_id", F.when(F.col("there"), F.col("parent_id")).alias("up"), F.when(F.col("there"), 1).otherwise(0).cast("long").alias("depth")
    )
    now = materialise(start, "depths")
    left = now.filter("up is not null").count()
    while left:
        above = now.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        moved = now.filter("up is not null").join(above, ["conv_id", "up"]).select("conv_id", "call_id", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"))
        now = materialise(now.filter("up is null").unionByName(moved), "depths")
        before, left = left, now.filter("up is not null").count()
        if left == before:
            break
    return now.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def link(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per call with its place, result, problems and canonical JSON, and one per other result.

    calls: conv_id, call_id, parent_id, tool, arguments (JSON text), turn; results: conv_id, call_id,
    content, turn; other columns are ignored.  Output: conv_id, call_id, tool, depth, position (from 1
    in the conversation, parents first, then by turn, id and a digest of the texts; cycles and what has no id
    after them, results without a line of a call last), n_results, problems, line.

    Rows of one identifier are one call: the earliest turn counts (then the smallest tool, arguments
    and parent); if they differ, ``conflict`` is among the problems.  A call without result has
    ``no_result``, one whose parent is no call ``no_parent``, one on or after a cycle ``cycle``.  A call
    without call_id or conv_id is one by itself, told from others by its content, with ``no_id``; no result
    joins it.  The call's line has its earliest result (then that of the smallest content).  Each other
    result is a row with tool and arguments null: ``repeated_result`` for a further one of a call,
    ``no_call`` where there is none, and ``no_id`` where it names none.  Rows that are equal in all columns
    count once.  A null tool is an unknown one.  Empty tables give no rows.
    """
    row = F.struct("turn", "tool", "arguments", "parent_id")
    known = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    own = calls.where(known).groupBy("conv_id", "call_id").agg(F.min(row).alias("c"), (F.min(row) != F.max(row)).alias("conflict"))
    fields = ["conv_id", "call_id", "turn", "tool", "arguments", "parent_id"]
    alone = calls.where(~known).select(*fields).distinct().withColumn("conflict", F.lit(False))
    own = materialise(own.select("conv_id", "call_id", "c.*", "conflict").unionByName(alone), "calls")
    named = own.where(known)

    heard = results.select("conv_id", "call_id", "turn", "content").distinct()
    heard = materialise(heard, "results")
    told = heard.where(known).groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "content")).alias("r"), F.count("*").alias("n_results"))
    told = materialise(told, "told")
    firsts = named.select("conv_id", "call_id").join(told, ["conv_id", "call_id"])
    # every result but those that stand in a call's line; an identifier may have very many of them
    # and this table may be repeated for each salt, so it has a digest for the text
    first = F.struct(F.col("r.turn").alias("turn"), F.sha2("r.content", 256).alias("digest"))
    firsts = materialise(firsts.select("conv_id", "call_id", first.alias("r")), "first-results")
    own_digest = F.struct("turn", F.sha2("content", 256).alias("digest"))
    rest = dim_join(heard.where(known), firsts, ["conv_id", "call_id"]).where(F.col("r").isNull() | (own_digest != F.col("r")))
    rest = rest.withColumn("problems", F.when(F.col("r").isNull(), F.array(F.lit("no_call"))).otherwise(F.array(F.lit("repeated_result")))).drop("r")
    rest = rest.unionByName(heard.where(~known).withColumn("problems", F.array(F.lit("no_call"), F.lit("no_id"))))

    # places among the calls are worked out on identifiers; rows with texts are dealt by their own one only
    slim = named.select("conv_id", "call_id", "parent_id")
    keys = named.select("conv_id", F.col("call_id").alias("parent_id"), F.lit(True).alias("has_parent"))
    found = slim.join(keys, ["conv_id", "parent_id"], "left").select("conv_id", "call_id", "has_parent").join(depths(slim), ["conv_id", "call_id"])
    told = told.select("conv_id", "call_id", F.col("r.content").alias("content"), "n_results")
    out = named.join(told, ["conv_id", "call_id"], "left").join(found, ["conv_id", "call_id"], "left")
    nameless = own.where(~known).join(keys, ["conv_id", "parent_id"], "left")
    nameless = nameless.withColumns({"content": F.lit(None).cast("string"), "n_results": F.lit(None).cast("long"), "depth": F.lit(None).cast("long")})
    out = out.unionByName(nameless)
    flags = {
        "conflict": F.col("conflict"),
        "cycle": F.col("depth").isNull() & known,
        "no_id": ~known,
        "no_parent": F.col("parent_id").isNotNull() & F.col("has_parent").isNull(),
        "no_result": F.col("n_results").isNull(),
    }
    flagged = F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in flags.items())))
    out = out.withColumn("problems", F.array_sort(F.concat(flagged, problems(schemas)))).withColumn("n_results", F.coalesce("n_results", F.lit(0).cast("long")))
    out = out.select(*fields, "content", "depth", "n_results", "problems", F.lit(0).alias("sort_kind"), F.coalesce("depth", F.lit((1 << 63) - 1)).alias("sort_depth"))
    none = {c: F.lit(None).cast("string") for c in ("tool", "arguments", "parent_id")}
    none |= {"depth": F.lit(None).cast("long"), "n_results": F.lit(1).cast("long"), "sort_kind": F.lit(1), "sort_depth": F.lit(0).cast("long")}
    out = out.unionByName(rest.withColumns(none))
    # rows without an identifier, and results, may be alike in all but their texts
    alike = ~known | (F.col("sort_kind") == 1)
    tie = F.when(alike, F.md5(F.to_json(F.struct("tool", "arguments", "parent_id", "content")).cast("binary")))
    out = number_rows(out.withColumn("tie", tie), "position", ["sort_kind", "sort_depth", "turn", "call_id", "tie"], by=["conv_id"], unique=True)
    arguments = F.coalesce(canonical("arguments"), quoted(F.col("arguments")))
    pieces = {"arguments": arguments, "id": quoted(F.col("call_id")), "parent": quoted(F.col("parent_id")), "position": F.col("position").cast("string"), "result": quoted(F.col("content")), "tool": quoted(F.col("tool"))}
    line = F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), v) for k, v in pieces.items()]), F.lit("}"))
    return out.select("conv_id", "call_id", "tool", "depth", "position", "n_results", "problems", line.alias("line"))

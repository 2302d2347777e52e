"""Tool calls of conversations: linked with their results, ordered, checked, and written as canonical JSON.

Everything is DataFrame expressions; calls and results meet in hash joins by identifier.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored

#: Of each tool: argument -> (type, whether it must be there).
Schemas = Mapping[str, Mapping[str, tuple[str, bool]]]

TYPES = {
    "string": "^STRING$",
    "integer": r"^(BIGINT|DECIMAL\([0-9]+,0\))$",
    "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*)$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY<",
    "object": "^OBJECT<",
}

TOOLS: Schemas = {
    "search": {"query": ("string", True), "limit": ("integer", True)},
    "lookup": {"key": ("string", True), "exact": ("boolean", True)},
    "count": {"words": ("integer", True), "ratio": ("number", False)},
}


def argument_errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with a call, in a fixed order: an array, empty if nothing is.

    ``arguments`` is a VARIANT, null if the text was no JSON.
    """
    is_object = F.coalesce(F.schema_of_variant(arguments).startswith("OBJECT<"), F.lit(False))
    given = F.try_variant_get(arguments, "$", "map<string,variant>")
    keys = F.array_sort(F.map_keys(given))
    found = F.array(F.lit("unknown tool"))
    for tool, fields in schemas.items():
        checks = []
        for field, (kind, needed) in sorted(fields.items()):
            value = F.try_element_at(given, F.lit(field))
            fits = F.coalesce(F.schema_of_variant(value).rlike(TYPES[kind]), F.lit(False))
            there = F.array_contains(keys, field)
            missing = F.lit(f"missing {field}") if needed else F.lit(None).cast("string")
            checks.append(F.when(~there, missing).when(~fits, F.lit(f"type of {field}")))
        extra = F.transform(F.array_except(keys, F.array(*map(F.lit, fields))), lambda k: F.concat(F.lit("unknown "), k))
        of_tool = F.concat(F.array_compact(F.array(*checks)), extra)
        found = F.when(name == tool, of_tool).otherwise(found)
    return F.when(~is_object, F.array(F.lit("arguments are no object"))).otherwise(found)


def levels(calls: DataFrame) -> DataFrame:
    """(call_id, level) of ``calls`` (call_id, depends_on), call_ids unique and not null.

    The level is the number of calls that a call waits for in a row, so calls in the order of their levels
    are topologically ordered.  A dependency that does not exist counts as none.  Null for calls that wait
    for a circle.  Ancestors are doubled in each round, which is written to the shared folder.
    """
    known = calls.select(F.col("call_id").alias("known"))
    linked = calls.join(known, calls.depends_on == known.known, "left")
    now = stored(linked.select("call_id", F.col("known").alias("next"), F.when(F.col("known").isNull(), 0).otherwise(1).alias("level")), "levels")
    reach, most, waiting = 1, now.count(), now.where("next is not null").count()
    while waiting and reach <= most:
        above = now.select(F.col("call_id").alias("next"), F.col("next").alias("further"), F.col("level").alias("more"))
        met = now.join(above, "next", "left")
        now = stored(met.select("call_id", F.col("further").alias("next"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")), "levels")
        reach, waiting = 2 * reach, now.where("next is not null").count()
    return now.select("call_id", F.when(F.col("next").isNull(), F.col("level")).alias("level"))


def link(calls: DataFrame, results: DataFrame, schemas: Schemas = TOOLS) -> DataFrame:
    """A row for each call of ``calls`` (call_id, name, arguments, depends_on) and for each result without one.

    (call_id, name, level, status, errors, n_calls, n_results, message).  ``results`` has (call_id, content).
    Status: ``answered``, ``unanswered``, ``orphan`` (a result without a call), or ``no id``.  Of calls, or of
    results, that share an id, the smallest by its values counts, and their number is told.  Rows without id
    are kept, each alone.  ``message`` is JSON with sorted keys and without blanks; arguments that are no JSON
    stand there as the text they are.  Other columns are ignored.
    """
    one_call = calls.where("call_id is not null").groupBy("call_id").agg(
        F.min(F.struct(*(F.coalesce(c, F.lit("")).alias(c) for c in ("name", "arguments")), "depends_on")).alias("call"), F.count("*").alias("n_calls")
    )
    one_call = stored(one_call.select("call_id", "call.*", "n_calls"), "calls")
    one_result = results.where("call_id is not null").groupBy("call_id").agg(F.min("content").alias("content"), F.count("*").alias("n_results"))
    ordered = one_call.join(levels(one_call.select("call_id", "depends_on")), "call_id")
    both = ordered.join(one_result, "call_id", "full_outer")
    status = F.when(F.col("n_calls").isNull(), "orphan").when(F.col("n_results").isNull(), "unanswered").otherwise("answered")
    both = both.withColumn("status", status)
    loose = calls.where("call_id is null").select("name", F.coalesce("arguments", F.lit("")).alias("arguments"), F.lit("no id").alias("status"), F.lit(1).cast("long").alias("n_calls"))
    stray = results.where("call_id is null").select("content", F.lit("no id").alias("status"), F.lit(1).cast("long").alias("n_results"))
    every = both.unionByName(loose, allowMissingColumns=True).unionByName(stray, allowMissingColumns=True)
    parsed = F.try_parse_json("arguments")
    called = F.col("n_calls").isNotNull()
    errors = F.when(called, argument_errors(F.col("name"), parsed, schemas)).otherwise(F.array())
    as_is = F.when(called & parsed.isNull(), F.col("arguments"))
    message = F.to_json(F.struct(parsed.alias("arguments"), as_is.alias("arguments_text"), F.col("call_id").alias("id"), "level", "name", F.col("content").alias("result")))
    zero = F.lit(0).cast("long")
    return every.select("call_id", "name", "level", "status", F.array_join(errors, "; ").alias("errors"), F.coalesce("n_calls", zero).alias("n_calls"), F.coalesce("n_results", zero).alias("n_results"), message.alias("message"))


def _id(turn: str) -> Column:
    return F.concat(F.lit("call-"), F.col("conv_id").cast("string"), F.lit("-"), F.expr(turn).cast("string"))


def calls_of(conversations: DataFrame) -> DataFrame:
    """Tool calls derived from assistant turns: some with wrong, missing or unknown arguments, some no JSON."""
    rows = conversations.where("role = 'assistant'").select("*", F.length("text").alias("n"), F.regexp_extract("text", "[A-Za-z]+", 0).alias("w"))
    tool = F.expr("CASE turn % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'lookup' ELSE 'count' END")
    search = F.expr("""CASE WHEN n % 7 = 0 THEN concat('{"query":"', w, '"') WHEN n % 11 = 0 THEN concat('{"query":"', w, '","limit":"', n % 50, '"')
        ELSE concat('{"query": "', w, '", "limit": ', n % 50) END""")
    lookup = F.expr("""concat('{"key":"', w, '","exact":', IF(n % 2 = 0, 'true', 'false'), IF(n % 7 = 0, ',"verbose":1', ''))""")
    count = F.expr("""concat('{"words":', n, ', "ratio":', n % 90 + 1, '.5')""")
    body = F.when(F.col("turn") % 3 == 0, search).when(F.col("turn") % 3 == 1, lookup).otherwise(count)
    arguments = F.concat(body, F.expr("IF(n % 13 = 0, '', '}')"))
    depends = F.when((F.col("turn") >= 3) & (F.col("n") % 3 != 0), _id("turn - 2"))
    return rows.select(_id("turn").alias("call_id"), tool.alias("name"), arguments.alias("arguments"), depends.alias("depends_on"))


def results_of(conversations: DataFrame) -> DataFrame:
    """User turns as results of the turn before; some of these were no calls."""
    return conversations.where("role = 'user' and turn > 0").select(_id("turn - 1").alias("call_id"), F.col("text").alias("content"))


#: The rows of ``link`` over what is derived from ``conversations``, in DuckDB.
LINK_SQL = """
WITH RECURSIVE base AS (
    SELECT *, length(text) AS n, regexp_extract(text, '[A-Za-z]+') AS w FROM conversations),
calls AS (
    SELECT 'call-' || conv_id || '-' || turn AS call_id, n,
        CASE turn % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'lookup' ELSE 'count' END AS name,
        CASE turn % 3
            WHEN 0 THEN CASE WHEN n % 7 = 0 THEN '{"query":"' || w || '"' WHEN n % 11 = 0 THEN '{"query":"' || w || '","limit":"' || (n % 50) || '"'
                        ELSE '{"query": "' || w || '", "limit": ' || (n % 50) END
            WHEN 1 THEN '{"key":"' || w || '","exact":' || CASE WHEN n % 2 = 0 THEN 'true' ELSE 'false' END || CASE WHEN n % 7 = 0 THEN ',"verbose":1' ELSE '' END
            ELSE '{"words":' || n || ', "ratio":' || (n % 90 + 1) || '.5' END || CASE WHEN n % 13 = 0 THEN '' ELSE '}' END AS arguments,
        CASE turn % 3
            WHEN 0 THEN CASE WHEN n % 7 = 0 THEN '{"query":"' || w || '"}' WHEN n % 11 = 0 THEN '{"limit":"' || (n % 50) || '","query":"' || w || '"}'
                        ELSE '{"limit":' || (n % 50) || ',"query":"' || w || '"}' END
            WHEN 1 THEN '{"exact":' || CASE WHEN n % 2 = 0 THEN 'true' ELSE 'false' END || ',"key":"' || w || '"' || CASE WHEN n % 7 = 0 THEN ',"verbose":1}' ELSE '}' END
            ELSE '{"ratio":' || (n % 90 + 1) || '.5,"words":' || n || '}' END AS canonical,
        CASE turn % 3
            WHEN 0 THEN CASE WHEN n % 7 = 0 THEN 'missing limit' WHEN n % 11 = 0 THEN 'type of limit' ELSE '' END
            WHEN 1 THEN CASE WHEN n % 7 = 0 THEN 'unknown verbose' ELSE '' END
            ELSE '' END AS wrong,
        CASE WHEN turn >= 3 AND n % 3 <> 0 THEN 'call-' || conv_id || '-' || (turn - 2) END AS depends_on
    FROM base WHERE role = 'assistant'),
linked AS (SELECT c.call_id, p.call_id AS above FROM calls c LEFT JOIN calls p ON c.depends_on = p.call_id),
ordered AS (
    SELECT call_id, 0 AS level FROM linked WHERE above IS NULL
    UNION ALL SELECT l.call_id, o.level + 1 FROM linked l JOIN ordered o ON l.above = o.call_id),
results AS (SELECT 'call-' || conv_id || '-' || (turn - 1) AS call_id, text AS content FROM base WHERE role = 'user' AND turn > 0)
SELECT call_id, name, level, CASE WHEN name IS NULL THEN 'orphan' WHEN content IS NULL THEN 'unanswered' ELSE 'answered' END AS status,
    CASE WHEN name IS NULL THEN '' WHEN n % 13 = 0 THEN 'arguments are no object' ELSE wrong END AS errors,
    CAST(name IS NOT NULL AS BIGINT) AS n_calls, CAST(content IS NOT NULL AS BIGINT) AS n_results,
    '{' || concat_ws(',', CASE WHEN name IS NULL THEN NULL WHEN n % 13 = 0 THEN '"arguments_text":' || CAST(to_json(arguments) AS VARCHAR) ELSE '"arguments":' || canonical END,
        '"id":"' || call_id || '"', '"level":' || level, '"name":"' || name || '"', '"result":' || CAST(to_json(content) AS VARCHAR)) || '}' AS message
FROM (SELECT * FROM calls JOIN ordered USING (call_id)) FULL JOIN results USING (call_id)
"""


def tool_messages(conversations: DataFrame) -> DataFrame:
    """``link`` over the calls and results that are derived from ``conversations`` (conv_id, turn, role, text)."""
    turns = conversations.select("conv_id", "turn", "role", "text")
    return link(calls_of(turns), results_of(turns))

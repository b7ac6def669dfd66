"""Chat formatting: tool-call linking (operator 1), DataFrame functions only.

Calls and results meet in a hash join on the call's identifier.  A call may take up
another call's result (its parent); its level in the topological order is its distance from a
root, found for all calls at once by pointer doubling: each round joins a call with its
ancestor and doubles the distance covered, so a chain of n calls takes log2 n rounds
and no conversation, however long, is gathered in one task.  Arguments are parsed, held against
the tool's schema and written as canonical JSON: keys sorted at every depth, no white
space, numbers in plain form, nulls of the envelope left out.

Status of a row: ``linked``; ``unanswered`` (no result); ``orphan`` (a result without call);
``cyclic`` (its parents form a ring: no level); ``unidentified`` (a null identifier: never
linked, level 0).  A call or result that comes more than once counts once, the smallest row
standing for it, and the row says how often it came.  A parent that is no call makes a root,
with an error.  Null or unreadable arguments, an unknown tool and every breach of the schema
are errors.  Null or empty results are results.  Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.io import cut

#: tool -> field -> (type, required, least, most); least and most bound a number, or a string's length
SCHEMAS = {
    "lookup": {"limit": ("integer", True, 1, 4), "query": ("string", True, 1, 80)},
    "search": {"limit": ("integer", True, 1, 4), "query": ("string", True, 1, 400), "spread": ("number", False, 0, 1)},
}
_KINDS = {"integer": ["BIGINT"], "number": ["BIGINT", "DOUBLE", "DECIMAL"], "string": ["STRING"], "boolean": ["BOOLEAN"],
          "object": ["OBJECT"], "array": ["ARRAY"]}


def schema_errors(args: Column, name: Column, schemas: dict = SCHEMAS) -> Column:
    """Sorted array of what is wrong with parsed arguments (a variant)."""
    out = F.array(F.lit("unknown tool"))
    for tool, fields in sorted(schemas.items()):
        found = []
        for field, (kind, required, least, most) in sorted(fields.items()):
            value = F.try_variant_get(args, f"$['{field}']", "variant")
            shape = F.regexp_extract(F.schema_of_variant(value), r"^[A-Z]+", 0)
            missing = value.isNull() | (shape == "VOID")
            wrong = ~shape.isin(_KINDS[kind])
            size = (F.try_variant_get(args, f"$['{field}']", "double") if kind in ("integer", "number")
                    else F.length(F.try_variant_get(args, f"$['{field}']", "string")).cast("double"))
            off = (size < least) | (size > most) if least is not None else F.lit(False)
            found.append(F.when(missing, F.lit(f"{field}: missing") if required else F.lit(None).cast("string"))
                         .when(wrong, F.lit(f"{field}: not {kind}"))
                         .when(off, F.lit(f"{field}: out of range")))
        out = F.when(name == tool, F.array_compact(F.array(*found))).otherwise(out)
    return F.when(args.isNull(), F.array(F.lit("arguments: unreadable"))).otherwise(out)


def levels(calls: DataFrame) -> DataFrame:
    """(call_id, level) of distinct calls (call_id, parent_id, both known or the parent null);
    level null on a ring."""
    state = cut(calls.select("call_id", F.col("parent_id").alias("up"),
                             F.when(F.col("parent_id").isNull(), 0).otherwise(1).cast("long").alias("level")))
    rounds = state.count().bit_length() + 1
    for _ in range(rounds):
        going = state.where("up IS NOT NULL")
        if going.isEmpty():
            break
        at = state.select(F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("level").alias("more"))
        state = cut(state.where("up IS NULL").union(
            going.join(at, "up").select("call_id", F.col("next").alias("up"), (F.col("level") + F.col("more")).alias("level"))))
    return state.select("call_id", F.when(F.col("up").isNull(), F.col("level")).alias("level"))


def link(calls: DataFrame, results: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """One row per call and per result without call.  ``calls``: conv_id, call_id, parent_id,
    name, arguments (JSON text); ``results``: call_id, content.  Other columns are ignored."""
    c = calls.select("conv_id", F.col("call_id").cast("string").alias("call_id"), F.col("parent_id").cast("string").alias("parent_id"),
                     F.col("name").cast("string").alias("name"), F.col("arguments").cast("string").alias("arguments"))
    known = (c.where("call_id IS NOT NULL").groupBy("call_id")
             .agg(F.min(F.struct("conv_id", "parent_id", "name", "arguments")).alias("c"), F.count(F.lit(1)).alias("n_calls"))
             .select("call_id", "c.*", "n_calls"))
    known = cut(known)
    parents = known.select(F.col("call_id").alias("parent_id"), F.lit(True).alias("there"))
    placed = (known.where("parent_id IS NOT NULL").join(parents, "parent_id", "left")
              .select("call_id", "conv_id", "name", "arguments", "n_calls", F.when(F.col("there"), F.col("parent_id")).alias("parent_id"),
                      F.col("there").isNull().alias("lost"))
              .unionByName(known.where("parent_id IS NULL").withColumn("lost", F.lit(False))))
    placed = cut(placed)
    ranked = placed.join(levels(placed), "call_id")
    r = (results.where("call_id IS NOT NULL").groupBy(F.col("call_id").cast("string").alias("call_id"))
         .agg(F.min("content").alias("content"), F.count(F.lit(1)).alias("n_results")))
    both = ranked.join(r.hint("shuffle_hash"), "call_id", "full_outer").withColumn("known", F.col("n_calls").isNotNull())
    blank = c.where("call_id IS NULL").select(
        F.lit(None).cast("string").alias("call_id"), "conv_id", "name", "arguments", F.lit(1).cast("long").alias("n_calls"),
        F.lit(None).cast("string").alias("parent_id"), F.lit(False).alias("lost"), F.lit(0).cast("long").alias("level"),
        F.lit(None).cast("string").alias("content"), F.lit(None).cast("long").alias("n_results"), F.lit(True).alias("known"))
    lone = results.where("call_id IS NULL").select(
        *(F.lit(None).cast(t).alias(n) for n, t in both.dtypes if n not in ("content", "n_results", "known")),
        "content", F.lit(1).cast("long").alias("n_results"), F.lit(False).alias("known"))
    every = both.unionByName(blank).unionByName(lone)
    every = every.withColumn("args", F.try_parse_json("arguments"))
    status = (F.when(~F.col("known"), "orphan").when(F.col("call_id").isNull(), "unidentified")
              .when(F.col("level").isNull(), "cyclic").when(F.col("n_results").isNull(), "unanswered").otherwise("linked"))
    errors = F.when(F.col("known"), F.concat(
        schema_errors(F.col("args"), F.coalesce("name", F.lit("")), schemas),
        F.when(F.col("lost"), F.array(F.lit("parent: missing"))).otherwise(F.array().cast("array<string>")))).otherwise(
        F.array().cast("array<string>"))
    out = every.withColumn("status", status).withColumn("errors", errors)
    quoted = lambda col: F.to_json(F.to_variant_object(F.array(col)))
    field = lambda key, text: F.concat(F.lit(f'"{key}":'), text)
    bare = lambda col: F.expr(f"substring({col}, 2, length({col}) - 2)")
    out = (out.withColumn("q_id", quoted(F.col("call_id"))).withColumn("q_name", quoted(F.col("name")))
           .withColumn("q_up", quoted(F.col("parent_id"))).withColumn("q_content", quoted(F.col("content")))
           .withColumn("q_errors", F.to_json(F.to_variant_object("errors"))))
    line = F.concat(F.lit("{"), F.concat_ws(
        ",", F.when(F.col("args").isNotNull(), field("arguments", F.to_json("args"))),
        F.when(F.col("call_id").isNotNull(), field("call_id", bare("q_id"))),
        field("errors", F.col("q_errors")),
        F.when(F.col("level").isNotNull(), field("level", F.col("level").cast("string"))),
        F.when(F.col("name").isNotNull(), field("name", bare("q_name"))),
        F.when(F.col("parent_id").isNotNull(), field("parent_id", bare("q_up"))),
        F.when(F.col("content").isNotNull(), field("result", bare("q_content"))),
        field("status", F.concat(F.lit('"'), F.col("status"), F.lit('"')))), F.lit("}"))
    return out.select("conv_id", "call_id", "parent_id", "level", "name", "status",
                      F.when(F.col("known"), F.size("errors") == 0).alias("valid"),
                      F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results"),
                      line.alias("line"))


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results) that a table of chat turns stands for: a user's turn is a call, whose
    parent is the call two turns before, the assistant's turn after it is its result."""
    at = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    known = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    words = F.size(F.split("text", " "))
    user = conversations.where("role = 'user'")
    before = F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - 2).cast("string"))
    calls = user.select(
        "conv_id", F.when(known, at).alias("call_id"),
        F.when(known & (F.col("turn") >= 2), before).alias("parent_id"),
        F.when(words <= 12, "lookup").otherwise("search").alias("name"),
        F.when(F.col("text").isNotNull(), F.to_json(F.struct(
            F.col("text").alias("query"), (F.col("turn") + 1).alias("limit")))).alias("arguments"))
    results = conversations.where("role = 'assistant'").select(
        F.when(known, F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - 1).cast("string"))).alias("call_id"),
        F.col("text").alias("content"))
    return calls, results


SQL = r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, text, len(string_split(text, ' ')) AS words, conv_id || ':' || turn AS call_id,
         CASE WHEN turn >= 2 THEN conv_id || ':' || (turn - 2) END AS up
  FROM conversations WHERE role = 'user'),
p AS (SELECT c.*, u.call_id AS parent_id FROM c LEFT JOIN (SELECT call_id FROM c) u ON u.call_id = c.up),
l AS (SELECT call_id, CAST(0 AS BIGINT) AS level FROM p WHERE parent_id IS NULL
      UNION ALL SELECT p.call_id, l.level + 1 FROM p JOIN l ON p.parent_id = l.call_id),
r AS (SELECT conv_id || ':' || (turn - 1) AS call_id, min(text) AS content, count(*) AS n FROM conversations
      WHERE role = 'assistant' GROUP BY 1),
b AS (
  SELECT p.conv_id, coalesce(p.call_id, r.call_id) AS call_id, p.parent_id, l.level, p.turn, p.text,
         CASE WHEN p.call_id IS NULL THEN NULL WHEN p.words <= 12 THEN 'lookup' ELSE 'search' END AS name,
         CASE WHEN p.call_id IS NULL THEN 'orphan' WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
         CASE WHEN p.call_id IS NULL THEN 0 ELSE 1 END AS n_calls, coalesce(r.n, 0) AS n_results, r.content,
         CASE WHEN p.call_id IS NULL THEN [] ELSE list_filter([
           CASE WHEN p.turn + 1 NOT BETWEEN 1 AND 4 THEN 'limit: out of range' END,
           CASE WHEN length(p.text) < 1 OR length(p.text) > CASE WHEN p.words <= 12 THEN 80 ELSE 400 END
                THEN 'query: out of range' END,
           CASE WHEN p.up IS NOT NULL AND p.parent_id IS NULL THEN 'parent: missing' END], lambda e: e IS NOT NULL) END AS errors
  FROM p JOIN l ON l.call_id = p.call_id FULL JOIN r ON r.call_id = p.call_id)
SELECT conv_id, call_id, parent_id, level, name, status,
       CASE WHEN n_calls = 0 THEN NULL ELSE len(errors) = 0 END AS valid,
       CAST(n_calls AS BIGINT) AS n_calls, CAST(n_results AS BIGINT) AS n_results,
       '{' || CASE WHEN n_calls = 0 THEN '' ELSE '"arguments":{"limit":' || (turn + 1) || ',"query":' || to_json(text) || '},' END
       || '"call_id":"' || call_id || '","errors":['
       || coalesce(array_to_string(list_transform(errors, lambda e: '"' || e || '"'), ','), '') || '],'
       || CASE WHEN n_calls = 0 THEN '' ELSE '"level":' || level || ',"name":"' || name || '",' END
       || CASE WHEN parent_id IS NULL THEN '' ELSE '"parent_id":"' || parent_id || '",' END
       || CASE WHEN n_results = 0 THEN '' ELSE '"result":' || to_json(content) || ',' END
       || '"status":"' || status || '"}' AS line
FROM b
"""

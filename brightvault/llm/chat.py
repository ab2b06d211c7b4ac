"""Chat formatting with rotated perspectives.

For every participant of a conversation the dialogue is rendered once, with
that participant as the assistant, the others as named users, and a loss mask
that covers only the participant's own turns.  System turns keep their place
and are nobody's perspective.

Conversations are rendered in chunks of ``chunk`` turns, counted in their order,
so that no row grows with a conversation; the chunks of a perspective joined in
their order are the whole dialogue.  The turns of most conversations are numbered
by a window.  Those of a conversation with more than ``LONG`` turns are dealt to
ranges of their order first and numbered within each, from where the range before
ended; their chunks meet the participants where they lie.

Nobody can speak for others: a mark within a text or a name gets a backslash more
after its ``<`` (so it can be taken away again), and white space in a name
becomes a blank.

Defined cases: a null text is an empty turn; a turn without a role is spoken by
the user "unknown", who has no perspective; turns without a number come first;
ties are ordered by role and text; repeated rows are turns of their
own; null conversation ids form one conversation; a conversation of system turns
only gives no rows; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brightvault.llm.common import small, stash, table

CHUNK = 512
#: Turns of a conversation that one window numbers.
LONG = 50_000
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
MARK = r"<(\\*)\|(im_start|im_end)\|>"
ORDER = ("turn", "name", "text", "no_role")


def unmarked(text: Column) -> Column:
    return F.regexp_replace(text, MARK, r"<\\$1|$2|>")


def numbered(told: DataFrame, hot: DataFrame) -> DataFrame:
    """``told`` with ``nr``, the number of a turn within its conversation, from 0; conversations of ``hot`` are ``split``."""
    order = [F.col(c).asc_nulls_first() for c in ORDER]
    same = F.col("conv_id").eqNullSafe(F.col("c"))
    short = told.join(hot, same, "left_anti").withColumns({"nr": F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)) - 1, "split": F.lit(False)})
    # Equal turns may be many: a number of their own deals them to ranges too.
    dealt = told.join(hot, same, "left_semi").withColumn("tie", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange("conv_id", *order, "tie").withColumn("part", F.spark_partition_id())
    dealt = stash(dealt, "ranges")
    sizes = dealt.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = small(stash(sizes.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start")), "starts"))
    within = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order, "tie")) - 1
    dealt = dealt.withColumn("within", within).join(starts, same & (F.col("part") == F.col("p")))
    return short.unionByName(dealt.select(*told.columns, (F.col("start") + F.col("within")).alias("nr"), F.lit(True).alias("split")))


def rotations(turns: DataFrame, chunk: int = CHUNK, long: int = LONG) -> DataFrame:
    """``conv_id, turn, role, text`` to a row per conversation, participant and chunk.

    ``mask_spans`` lists the code points ``start-end`` (end excluded) of the
    rendered text on which loss is taken: the assistant's words and their end mark.
    """
    told = turns.select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("name"), F.coalesce("text", F.lit("")).alias("text"), F.col("role").isNull().alias("no_role"))
    counts = told.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > long)
    hot = small(stash(counts.select(F.col("conv_id").alias("c")), "long"))
    told = numbered(told, hot).withColumn("chunk", F.floor(F.col("nr") / chunk).cast("long"))
    chunks = told.groupBy("conv_id", "chunk", "split").agg(F.sort_array(F.collect_list(F.struct("nr", "name", "text", "no_role"))).alias("turns"))
    people = turns.where("role IS NOT NULL AND role <> 'system'").select(F.col("conv_id").alias("c"), F.col("role").alias("perspective")).distinct()
    same = F.col("conv_id").eqNullSafe(F.col("c"))
    theirs = small(stash(people.join(hot.withColumnRenamed("c", "h"), F.col("c").eqNullSafe(F.col("h")), "left_semi"), "people"), 64)
    seen = chunks.where("NOT split").join(people, same).unionByName(chunks.where("split").join(theirs, same))
    own = lambda t: (t["name"] == F.col("perspective")) & ~t["no_role"]
    named = lambda t: unmarked(F.regexp_replace(t["name"], r"\s", " "))
    head = lambda t: F.concat(
        F.lit(OPEN), F.when(own(t), "assistant").when((t["name"] == "system") & ~t["no_role"], "system").otherwise(F.concat(F.lit("user name="), named(t))), F.lit("\n")
    )
    parts = F.transform("turns", lambda t: F.struct(head(t).alias("head"), F.concat(unmarked(t["text"]), F.lit(CLOSE)).alias("body"), own(t).alias("own")))
    seen = seen.select("conv_id", "chunk", "perspective", parts.alias("parts"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def add(acc, p):
        a = acc["at"] + F.char_length(p["head"])
        b = a + F.char_length(p["body"])
        span = F.array(F.concat(a.cast("string"), F.lit("-"), b.cast("string")))
        return F.struct((b + 1).alias("at"), F.when(p["own"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return seen.select(
        "conv_id",
        "perspective",
        "chunk",
        F.size("parts").cast("long").alias("n_turns"),
        F.size(F.filter("parts", lambda p: p["own"])).cast("long").alias("n_own_turns"),
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("rendered"),
        F.array_join(F.aggregate("parts", start, add)["spans"], ",").alias("mask_spans"),
    )


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotations(table(spark, sf_dir, "conversations"))


OP3_SQL = r"""
WITH n AS (SELECT conv_id, turn, role, coalesce(role, 'unknown') AS name, coalesce(text, '') AS text FROM conversations),
t AS (SELECT conv_id, role, name, regexp_replace(text, '<(\\*)\|(im_start|im_end)\|>', '<\\\1|\2|>', 'g') || '<|im_end|>' AS body,
      regexp_replace(regexp_replace(name, '[ \t\n\x0B\f\r]', ' ', 'g'), '<(\\*)\|(im_start|im_end)\|>', '<\\\1|\2|>', 'g') AS shown,
      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name, text, role IS NULL) - 1 AS nr FROM n),
p AS (SELECT DISTINCT conv_id AS c, role AS perspective FROM conversations WHERE role IS NOT NULL AND role <> 'system'),
r AS (SELECT conv_id, perspective, nr // 512 AS chunk, nr AS i, role IS NOT NULL AND name = perspective AS own, body,
      '<|im_start|>' || CASE WHEN role IS NOT NULL AND name = perspective THEN 'assistant' WHEN role = 'system' THEN 'system' ELSE 'user name=' || shown END || chr(10) AS head
      FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.c),
o AS (SELECT *, length(head) + coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective, chunk ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM r)
SELECT conv_id, perspective, chunk, count(*) AS n_turns, count(*) FILTER (own) AS n_own_turns,
       string_agg(head || body || chr(10), '' ORDER BY i) AS rendered,
       coalesce(string_agg(a::BIGINT || '-' || (a + length(body))::BIGINT, ',' ORDER BY i) FILTER (own), '') AS mask_spans
FROM o GROUP BY conv_id, perspective, chunk
"""

"""Chat formatting of reply trees.

Messages name the message they answer. Paths from the root to each leaf are enumerated by
self-joins that double their reach, branches are ranked by score, and each chosen path is written
as one conversation. Texts are escaped so that nothing in them can be read as a mark of the
template, of this one or one with ``[`` or ``<`` marks; the escapes are undone without loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.base import table
from tidemark.session import materialize

#: No conversation is deeper than 2^40 messages; more rounds than that mean a cycle.
MAX_ROUNDS = 40
OPEN, CLOSE = "<|turn|>", "<|/turn|>\n"


def escaped(c: Column) -> Column:
    for plain, code in (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")):
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescaped(c: Column) -> Column:
    for plain, code in (("[", "&#91;"), ("<", "&lt;"), ("&", "&amp;")):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def jumps_to_roots(messages: DataFrame) -> list[DataFrame]:
    """Tables (conv_id, node, to, total): the ancestor 2^k steps up, if there is one, and the score on the way.

    ``messages`` has conv_id, node (unique within it), parent and score. A node whose parent is
    null or absent is a root. Each round joins the last table with itself, so rounds are
    logarithmic in the depth and rows as many as there are nodes; in the last table no node has
    an ancestor that far, and ``total`` is the score of its whole path. A cycle raises an error.
    """
    nodes = messages.select("conv_id", "node", "parent", "score")
    ids = nodes.select(F.col("conv_id").alias("c"), F.col("node").alias("n"))
    jump = materialize(
        nodes.join(ids, nodes["conv_id"].eqNullSafe(ids["c"]) & (nodes["parent"] == ids["n"]), "left")
        .select("conv_id", "node", F.col("n").alias("to"), F.col("score").alias("total")),
        "jumps",
    )
    jumps = [jump]
    while not jump.where("`to` IS NOT NULL").isEmpty():
        if len(jumps) > MAX_ROUNDS:
            raise ValueError("replies form a cycle")
        further = jump.select(F.col("conv_id").alias("c"), F.col("node").alias("n"), F.col("to").alias("next"), F.col("total").alias("more"))
        jump = materialize(
            jump.join(further, jump["conv_id"].eqNullSafe(further["c"]) & (jump["to"] == further["n"]), "left")
            .select("conv_id", "node", F.col("next").alias("to"), (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("total")),
            "jumps",
        )
        jumps.append(jump)
    return jumps


def root_paths(leaves: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """(conv_id, leaf, node, up): every node of the path from each of ``leaves`` to its root, ``up`` steps above the leaf.

    Going back through the jumps, the ancestors found so far are joined once for each k.
    """
    paths = leaves.select("conv_id", "leaf", F.col("leaf").alias("node"), F.lit(0).cast("bigint").alias("up"))
    for k in range(len(jumps) - 2, -1, -1):
        step = jumps[k].where("`to` IS NOT NULL").select(F.col("conv_id").alias("c"), F.col("node").alias("n"), "to")
        above = paths.join(step, paths["conv_id"].eqNullSafe(step["c"]) & (paths["node"] == step["n"])).select(
            "conv_id", "leaf", F.col("to").alias("node"), (F.col("up") + 2**k).alias("up")
        )
        paths = materialize(paths.unionByName(above), "paths")
    return paths


def format_turns(turns: Column) -> tuple[Column, Column]:
    """The text of an array of (role, text), and the (start, end) of what is learned from.

    Starts and ends are code points of the formatted text, end exclusive.
    """
    pieces = F.transform(
        turns,
        lambda t: F.struct(
            F.concat(F.lit(OPEN), F.replace(escaped(t["role"]), F.lit("\n"), F.lit("&#10;")), F.lit("\n")).alias("head"),
            escaped(t["text"]).alias("body"),
            (t["role"] == "assistant").alias("learn"),
        ),
    )
    formatted = F.array_join(F.transform(pieces, lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"))
    def step(acc, p):
        begin = acc["at"] + F.length(p["head"])
        end = begin + F.length(p["body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(
            (end + len(CLOSE)).alias("at"), F.when(p["learn"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans")
        )
    return formatted, F.aggregate(pieces, start, step)["spans"]


def format_branches(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(conv_id, leaf, branch_score, formatted, loss_spans) of the best ``branches`` of each tree.

    ``messages`` has conv_id, node, parent, role, text and score. A branch scores the sum of its
    messages, null counting as nothing; ties go to the smaller leaf. Branches are ranked before
    any path is written. Of rows with the same conv_id and node, repeated or different, the one
    with the smallest parent, role, text and score counts, nulls first; a row without a node is
    no message. Null texts and roles count as empty, a null conv_id is a conversation of its own, and an
    empty table gives no rows. Other columns are not looked at.
    """
    m = messages.where(F.col("node").isNotNull()).select(
        "conv_id", "node", "parent", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    first = Window.partitionBy("conv_id", "node").orderBy(F.asc_nulls_first("parent"), "role", "text", "score")
    m = materialize(m.withColumn("place", F.row_number().over(first)).where("place = 1").drop("place"), "messages")
    jumps = jumps_to_roots(m)
    inner = m.select(F.col("conv_id").alias("c"), F.col("parent").alias("n")).where("n IS NOT NULL")
    scores = jumps[-1].join(
        inner, jumps[-1]["conv_id"].eqNullSafe(inner["c"]) & (jumps[-1]["node"] == inner["n"]), "left_anti"
    ).select("conv_id", F.col("node").alias("leaf"), F.col("total").alias("branch_score"))
    best = Window.partitionBy("conv_id").orderBy(F.desc("branch_score"), "leaf")
    chosen = scores.withColumn("place", F.row_number().over(best)).where(F.col("place") <= branches).drop("place")
    chosen = materialize(chosen, "branches")
    paths = root_paths(chosen, jumps)
    said = m.select(F.col("conv_id").alias("c"), F.col("node").alias("n"), "role", "text")
    picked = chosen.select(F.col("conv_id").alias("cc"), F.col("leaf").alias("ll"), "branch_score")
    turns = (
        paths.join(said, paths["conv_id"].eqNullSafe(said["c"]) & (paths["node"] == said["n"]))
        .groupBy("conv_id", "leaf")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "role", "text"))).alias("turns"))
        .join(picked, F.col("conv_id").eqNullSafe(F.col("cc")) & (F.col("leaf") == F.col("ll")))
    )
    formatted, spans = format_turns(F.col("turns"))
    return turns.select("conv_id", "leaf", "branch_score", formatted.alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The (role, text) of a formatted conversation, as they were before escaping."""
    parts = F.split(formatted, "<\\|/turn\\|>\n", -1)
    turns = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.transform(
        turns,
        lambda t: F.struct(
            unescaped(F.replace(F.substring_index(F.substr(t, F.lit(len(OPEN) + 1)), "\n", 1), F.lit("&#10;"), F.lit("\n"))).alias("role"),
            unescaped(F.substr(t, F.locate("\n", t) + 1)).alias("text"),
        ),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What is read back from the output, under digests."""
    turns = read_turns(F.col("formatted"))
    learned = F.array_join(
        F.transform("loss_spans", lambda s: unescaped(F.substr(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))), ""
    )
    return formatted.withColumns({"turns": turns, "learned": learned}).select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def chains(conversations: DataFrame) -> DataFrame:
    """Rows by turn as trees without branches; rows of the same turn follow by role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "role", "text", (F.row_number().over(order)).cast("bigint").alias("node"))
    return rows.select(
        "conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")
    )


CONTROL = "</s>[INST] ok [/INST]"


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text"
    )
    added = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL).alias("text"),
    )
    return digests(format_branches(chains(given.unionByName(added))))


OP5_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS learned,
    length(role) + length(text)
    + 4 * (length(role || text) - length(replace(role || text, '&', '')))
    + 3 * (length(role || text) - length(replace(role || text, '<', '')))
    + 4 * (length(role || text) - length(replace(role || text, '[', '')))
    + 4 * (length(role) - length(replace(role, chr(10), ''))) AS chars
  FROM t
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(length(learned))::BIGINT AS loss_chars,
  sha256(string_agg(learned, '' ORDER BY turn, role, text)) AS loss_sha256,
  sum(chars + 19)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

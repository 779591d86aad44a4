"""Chat formatting of reply trees.

Messages are nodes (tree, node, parent, role, text, score). Iterative
self-joins by pointer doubling find each node's root, depth and path score,
so a tree of depth d takes about log2(d) joins; leaves are ranked by the score
of their path, and each chosen path becomes one conversation in the template

    user       [INST] text [/INST]
    assistant  <s>text</s>
    system     <<SYS>>\\ntext\\n<</SYS>>\\n
    any other  [ROLE]role[/ROLE]text</s>

Control strings inside texts and role names are escaped by a backslash after
their first character, one more if there are some already; that is undone when
the output is read back. The loss mask holds the spans of assistant texts.

Defined results: a null text or role is empty; a table of linear
conversations is a tree of one branch, its rows ordered by turn, role, text
(null turns first), so repeated rows stay as turns of their own; rows with a
null conv_id form one conversation of that id; among leaves of equal score the
smallest node leads; nodes whose parent is missing are roots; nodes on a cycle
belong to no path and are left out; texts of any length stand whole in their
turn; no rows give no conversations; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import materialize

# Fixed values of the template; CONTROL lists what must not occur in a text.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]"]
TAILS = r"(/?s>|<SYS>>|</SYS>>|/?INST\]|/?ROLE\])"
TURN = (r"(?s)\[INST\] (.*?) \[/INST\]|<s>(.*?)</s>|<<SYS>>\n(.*?)\n<</SYS>>\n|\[ROLE\](.*?)\[/ROLE\](.*?)</s>")


def escaped(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"([<\[])(\\*)" + TAILS, r"$1$2\\$3")


def unescaped(text):
    return F.regexp_replace(text, r"([<\[])(\\*)\\" + TAILS, "$1$2$3")


def branches(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """The ``keep`` best root-to-leaf paths of every tree, a row per message:
    tree, leaf, rank (from 1), depth (from 0), role, text.

    ``nodes``: tree, node (unique), parent (null at a root), role, text, score.
    """
    known = nodes.select("node")
    step = nodes.select("tree", "node", "parent", "role", "text", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    step = step.join(known.select(F.col("node").alias("parent"), F.lit(True).alias("there")), "parent", "left") \
        .withColumn("parent", F.expr("IF(there, parent, NULL)")).drop("there")
    base = materialize(step, "nodes")
    # each node's highest ancestor found so far: links to it, and the score below it
    roots = base.where("parent IS NULL").select("node", F.col("node").alias("top"), F.lit(0).alias("links"), F.lit(0.0).alias("total"), F.lit(True).alias("ended"))
    now = materialize(base.where("parent IS NOT NULL").join(roots.select(F.col("node").alias("parent"), "ended"), "parent", "left")
                      .select("node", F.col("parent").alias("top"), F.lit(1).alias("links"), F.col("score").alias("total"), F.coalesce("ended", F.lit(False)).alias("ended")), "ups")
    ended, ups = roots.unionByName(now.where("ended")), [now.select("node", F.col("top").alias("up"))]
    limit = max(1, base.count()).bit_length()  # nodes on a cycle never end
    while len(ups) <= limit and now.where("NOT ended").limit(1).count():
        open_ones = now.where("NOT ended")
        above = ended.unionByName(open_ones).select(F.col("node").alias("top"), F.col("top").alias("further"), F.col("links").alias("more"),
                                                    F.col("total").alias("added"), F.col("ended").alias("over"))
        now = materialize(open_ones.join(above, "top").select("node", F.col("further").alias("top"), (F.col("links") + F.col("more")).alias("links"),
                                                              (F.col("total") + F.col("added")).alias("total"), F.col("over").alias("ended")), "ups")
        ended = ended.unionByName(now.where("ended"))
        ups.append(now.where(F.col("links") == 1 << len(ups)).select("node", F.col("top").alias("up")))
    done = ended.join(base.select(F.col("node").alias("top"), F.col("score").alias("last")), "top").select("node", "links", (F.col("total") + F.col("last")).alias("total"))
    leaves = base.select("tree", "node").join(base.where("parent IS NOT NULL").select(F.col("parent").alias("node")).distinct(), "node", "left_anti").join(done, "node")
    best = Window.partitionBy("tree").orderBy(F.desc("total"), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)
    path = materialize(chosen.select("node", F.col("node").alias("leaf"), "rank"), "paths")
    for up in ups:  # ancestors by ever longer links: all sums of powers of two
        path = materialize(path.unionByName(path.join(up, "node").select(F.col("up").alias("node"), "leaf", "rank")), "paths")
    return path.join(base, "node").join(done.select("node", F.col("links").alias("depth")), "node") \
        .select("tree", "leaf", "rank", "depth", "role", "text")


def from_turns(conversations: DataFrame) -> DataFrame:
    """Linear conversations as trees: each row answers the one before it."""
    turn = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("place", F.row_number().over(turn))
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")), F.format_string("%012d", "place"))
    before = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")), F.format_string("%012d", F.col("place") - 1))
    return rows.select(F.col("conv_id").alias("tree"), name.alias("node"), F.expr("place > 1").alias("later"), before.alias("before"),
                       "role", "text", F.lit(1.0).alias("score")) \
        .withColumn("parent", F.expr("IF(later, before, NULL)")).drop("later", "before")


def formatted(paths: DataFrame) -> DataFrame:
    """One row per path: tree, leaf, rank, formatted, loss_spans (start, end
    in code points of each assistant text, as formatted)."""
    role, text = F.coalesce("role", F.lit("")), escaped(F.col("text"))
    opening = F.when(role == "user", "[INST] ").when(role == "assistant", "<s>").when(role == "system", "<<SYS>>\n") \
        .otherwise(F.concat(F.lit("[ROLE]"), escaped(role), F.lit("[/ROLE]")))
    closing = F.when(role == "user", " [/INST]").when(role == "system", "\n<</SYS>>\n").otherwise("</s>")
    turns = paths.select("tree", "leaf", "rank", F.struct(
        "depth", (role == "assistant").alias("loss"), opening.alias("opening"), text.alias("body"), closing.alias("closing")).alias("turn"))
    lists = turns.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    spans = F.expr("""
        aggregate(turns, named_struct('at', 0L, 'spans', CAST(array() AS ARRAY<STRUCT<start: BIGINT, end: BIGINT>>)),
            (acc, t) -> named_struct(
                'at', acc.at + char_length(t.opening) + char_length(t.body) + char_length(t.closing),
                'spans', IF(t.loss, concat(acc.spans, array(named_struct(
                    'start', acc.at + char_length(t.opening), 'end', acc.at + char_length(t.opening) + char_length(t.body)))), acc.spans)),
            acc -> acc.spans)""")
    return lists.select("tree", "leaf", "rank",
                        F.expr("array_join(transform(turns, t -> concat(t.opening, t.body, t.closing)), '')").alias("formatted"),
                        spans.alias("loss_spans"))


def parsed(output: DataFrame) -> DataFrame:
    """``output`` plus ``turns`` (role, text), read from the formatted text."""
    def turn(whole):
        def part(group):
            return F.regexp_extract(whole, TURN, group)
        return F.when(whole.startswith("[INST]"), F.struct(F.lit("user").alias("role"), unescaped(part(1)).alias("text"))) \
            .when(whole.startswith("<s>"), F.struct(F.lit("assistant").alias("role"), unescaped(part(2)).alias("text"))) \
            .when(whole.startswith("<<SYS>>"), F.struct(F.lit("system").alias("role"), unescaped(part(3)).alias("text"))) \
            .otherwise(F.struct(unescaped(part(4)).alias("role"), unescaped(part(5)).alias("text")))

    return output.withColumn("turns", F.transform(F.regexp_extract_all("formatted", F.lit(TURN), F.lit(0)), turn))


def format_conversations(conversations: DataFrame, keep: int = 1) -> DataFrame:
    """Format conversations, write the output and return it as read back."""
    return materialize(formatted(branches(from_turns(conversations), keep)), "chat")


def digests(conversations: DataFrame) -> DataFrame:
    """Per conversation, from the written output: n_turns, turns_sha256,
    loss_chars, loss_sha256 and formatted_chars."""
    spark = conversations.sparkSession
    probe = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
                                  "conv_id long, turn long, role string, text string")
    own = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    output = parsed(format_conversations(own.unionByName(probe)))
    masked = F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    loss = F.array_join(masked, "")
    return output.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.expr("array_join(transform(turns, t -> concat(t.role, '\\n', t.text, '\\n')), '')").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))

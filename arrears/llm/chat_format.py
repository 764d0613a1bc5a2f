"""Chat formatting of reply trees (operator 3). DataFrame functions only.

A message has a parent message or none. Root-to-leaf paths are found by
self-joins that double the distance each time: after k rounds every message
knows its ancestor 2^k up, and the score and number of messages in between. So a
thread of n messages needs log2(n) rounds, and no join key is hot: a message has
one row in each round. The rounds are written to the shared folder.

Leaves are ranked by the mean score of their path (ties: longer path, then
smaller leaf id). The best `top_k` of each tree are then walked back, again by
doubling, and each path becomes one conversation.

Template, for each message:  <|start|>ROLE<|text|>TEXT<|end|>
Control strings in roles and texts are escaped, see `escape`; so the output can
be split at its marks and read back exactly. The loss mask is the list of spans
(start, length in code points) of the assistant texts in the output.

Defined results
- NULL role or text: empty. Empty text: a message with nothing between its marks.
- NULL conversation id: a conversation of its own. NULL score: 0.
- A parent that is missing, or not before its child in id: the child is a root
  (so there can be no cycle). Each root is a tree of its own.
- Rows with equal turns: successive messages, ordered by role, then text.
- Empty table: no rows. Extra columns: ignored.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arrears.llm.common import materialise

# Fixed values of the template and the control strings that texts may not hold.
START, TEXT, END = "<|start|>", "<|text|>", "<|end|>"
ANGLE_CONTROL = r"<(\||/?s>|</?SYS>>)"     # <| of this template, <s>, </s>, <<SYS>>, <</SYS>>
SQUARE_CONTROL = r"\[(/?INST\])"           # [INST], [/INST]
AMP, ANGLE, SQUARE = "&amp;", "&lt;", "&#91;"
ASSISTANT = "assistant"
# The registered query adds a conversation of this id whose two texts are this string.
CONTROL_ID, CONTROL_TEXT = -7, "</s>[INST] ok [/INST]"


def escape(text: Column) -> Column:
    """Control strings lose their first character to a reference; & itself becomes one first."""
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("&"), F.lit(AMP))
    return F.regexp_replace(F.regexp_replace(text, ANGLE_CONTROL, f"{ANGLE}$1"), SQUARE_CONTROL, f"{SQUARE}$1")


def unescape(text: Column) -> Column:
    for mark, char in ((SQUARE, "["), (ANGLE, "<"), (AMP, "&")):
        text = F.replace(text, F.lit(mark), F.lit(char))
    return text


def linear_thread(rows: DataFrame, *, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """Messages of conversations without branches: each replies to the one before."""
    rows = rows.select(rows[conv_col].alias("conv_id"), rows[turn_col].alias("turn"),
                       F.coalesce(rows[role_col], F.lit("")).alias("role"),
                       F.coalesce(rows[text_col], F.lit("")).alias("text"))
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select("conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                       "role", "text", F.lit(0.0).alias("score"))


def _messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The messages with a key that is never NULL; and their tree without the texts, usable parents only."""
    own = messages.select(
        F.when(F.col("conv_id").isNull(), "-").otherwise(F.concat(F.lit("c"), F.col("conv_id").cast("string"))).alias("k"),
        "conv_id", F.col("node").cast("long").alias("node"), F.col("parent").cast("long").alias("parent"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    own = materialise(own, "chat-messages")
    ids = own.select(F.col("k").alias("pk"), F.col("node").alias("pn"))
    tree = own.select("k", "node", "parent", "score").join(
        ids, (F.col("k") == F.col("pk")) & (F.col("parent") == F.col("pn")) & (F.col("pn") < F.col("node")), "left")
    return own, materialise(tree.select("k", "node", F.col("pn").alias("parent"), "score"), "chat-tree")


def best_paths(messages: DataFrame, top_k: int = 1) -> DataFrame:
    """(k, top, leaf, rank, mean, node, pos) of the chosen root-to-leaf paths.

    messages: k, node, parent (existing and smaller, or NULL), score.
    """
    sizes = materialise(messages.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "chat-sizes")
    largest = sizes.agg(F.max("n")).first()[0] or 0
    state = materialise(messages.join(sizes, "k").select(
        "k", "node", F.col("parent").alias("up"), F.col("node").alias("top"),
        F.lit(1).cast("long").alias("length"), F.col("score").alias("total"), "n"), "chat-up")
    jumps, done = [], []
    while (reach := 1 << len(jumps)) < largest:
        # A conversation of n messages is through once every message has looked n or more up.
        done.append(state.filter(F.col("n") <= reach))
        state = state.filter(F.col("n") > reach)
        jumps.append(state.filter("up is not null").select(F.col("k").alias("jk"), F.col("node").alias("jn"), "up"))
        there = state.select(F.col("k").alias("tk"), F.col("node").alias("tn"), F.col("up").alias("t_up"),
                             F.col("top").alias("t_top"), F.col("length").alias("t_length"), F.col("total").alias("t_total"))
        state = materialise(state.join(there, (F.col("k") == F.col("tk")) & (F.col("up") == F.col("tn")), "left").select(
            "k", "node", F.col("t_up").alias("up"), F.coalesce("t_top", "top").alias("top"),
            (F.col("length") + F.coalesce("t_length", F.lit(0))).alias("length"),
            (F.col("total") + F.coalesce("t_total", F.lit(0.0))).alias("total"), "n"), "chat-up")
    state = functools.reduce(DataFrame.union, [*done, state])
    parents = messages.filter("parent is not null").select("k", F.col("parent").alias("node")).distinct()
    leaves = state.join(parents, ["k", "node"], "left_anti").withColumn("mean", F.col("total") / F.col("length"))
    rank = F.row_number().over(W.partitionBy("k", "top").orderBy(F.desc("mean"), F.desc("length"), "node"))
    path = materialise(leaves.withColumn("rank", rank).filter(F.col("rank") <= top_k).select(
        "k", "top", F.col("node").alias("leaf"), "rank", "mean", "node", F.col("length").alias("pos")), "chat-path")
    for step in reversed(range(len(jumps))):
        above = path.join(jumps[step], (F.col("k") == F.col("jk")) & (F.col("node") == F.col("jn"))).select(
            "k", "top", "leaf", "rank", "mean", F.col("up").alias("node"), (F.col("pos") - (1 << step)).alias("pos"))
        path = materialise(path.union(above), "chat-path")
    return path


def format_threads(messages: DataFrame, top_k: int = 1) -> DataFrame:
    """One row per chosen path: conv_id, root, leaf, rank, score, formatted, loss (spans).

    messages: conv_id, node, parent, role, text, score.
    """
    messages, tree = _messages(messages)
    path = best_paths(tree, top_k)
    told = path.join(messages.select("k", "node", "conv_id", "role", "text"), ["k", "node"])
    told = told.select("k", "conv_id", "top", "leaf", "rank", "mean", "pos", "role",
                       escape(F.col("role")).alias("as_role"), escape(F.col("text")).alias("as_text"))
    before_text = F.lit(len(START) + len(TEXT)) + F.length("as_role")
    whole = before_text + F.length("as_text") + len(END)
    earlier = F.sum(whole).over(W.partitionBy("k", "top", "leaf").orderBy("pos").rowsBetween(W.unboundedPreceding, -1))
    told = told.select("k", "conv_id", "top", "leaf", "rank", "mean", F.struct(
        "pos", F.concat(F.lit(START), "as_role", F.lit(TEXT), "as_text", F.lit(END)).alias("turn"),
        (F.col("role") == ASSISTANT).alias("learn"),
        (F.coalesce(earlier, F.lit(0)) + before_text).cast("long").alias("start"),
        F.length("as_text").cast("long").alias("length")).alias("m"))
    grouped = told.groupBy("k", "top", "leaf").agg(
        F.first("conv_id").alias("conv_id"), F.first("rank").alias("rank"), F.first("mean").alias("score"),
        F.sort_array(F.collect_list("m")).alias("ms"))
    return grouped.select(
        "conv_id", F.col("top").alias("root"), "leaf", "rank", "score",
        F.array_join(F.transform("ms", lambda m: m["turn"]), "").alias("formatted"),
        F.transform(F.filter("ms", lambda m: m["learn"]),
                    lambda m: F.struct(m["start"].alias("start"), m["length"].alias("length"))).alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The messages of a formatted conversation, as structs of role and text."""
    parts = F.split(formatted, START.replace("|", r"\|"))
    return F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda turn: F.struct(
        unescape(F.substring_index(turn, TEXT, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(turn, TEXT, -1), END, 1)).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def digests(threads: DataFrame) -> DataFrame:
    """What the formatted conversations say when they are read back."""
    read = threads.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
                          read_loss(F.col("formatted"), F.col("loss")).alias("learned"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
                       F.length("learned").cast("long").alias("loss_chars"),
                       F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))

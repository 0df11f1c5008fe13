"""Chat formatting of reply trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spliceloom.session import durable

START, END = "<|im_start|>", "<|im_end|>"  # marks of a turn


def escape(text: Column) -> Column:
    """Put one more backslash between ``<`` and ``|``, so no control string is left; ``unescape`` takes it out."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role is one line: newlines become ``\\n`` and backslashes double before control strings are escaped."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    parts = F.split(unescape(role), r"\\\\", -1)  # doubled backslashes
    return F.array_join(F.transform(parts, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def leaf_scores(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Depth and summed score from the root of every message, by doubling ancestor pointers with self-joins.

    ``messages``: tree, id, parent (null at a root), score. Round k knows the ancestor 2^k steps up and the sum of the scores up to
    it, so rounds grow with the logarithm of the depth; a tree whose messages all reach the root takes part in no further round. Returns the
    messages that reach a root with ``depth`` and ``total``, and the pointer tables (tree, id, up) of the rounds. A message that
    needs more steps than there are messages hangs on a cycle and is left out.
    """
    now = durable(messages.select("tree", "id", F.col("parent").alias("up"), F.lit(1).alias("depth"), F.col("score").cast("double").alias("total")))
    reach, n = 1, now.count()
    steps, done = [], []
    while True:
        open_ = now.filter(F.col("up").isNotNull())
        if reach > n or open_.isEmpty():
            break
        steps.append(open_.select("tree", "id", "up"))
        trees = durable(open_.select(F.col("tree").alias("_o")).distinct())
        same = F.col("tree").eqNullSafe(F.col("_o"))
        done.append(now.join(trees, same, "left_anti"))
        live = now.join(trees, same, "left_semi")
        below, roots = live.filter(F.col("up").isNotNull()), live.filter(F.col("up").isNull())
        above = live.select(F.col("tree").alias("_t"), F.col("id").alias("_i"), F.col("up").alias("_up"), F.col("depth").alias("_d"), F.col("total").alias("_s"))
        j = below.join(above, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("up") == F.col("_i")))
        j = j.select("tree", "id", F.col("_up").alias("up"), (F.col("depth") + F.col("_d")).alias("depth"), (F.col("total") + F.col("_s")).alias("total"))
        now = durable(j.unionByName(roots))
        reach *= 2
    for part in done:
        now = now.unionByName(part)
    return durable(now.filter(F.col("up").isNull())), steps


def one_of_each(messages: DataFrame) -> DataFrame:
    """(tree, id, parent, role, text, score): one row for each message. Of rows that repeat (tree, id) the smallest by these columns stays, nulls first; rows without an id are no messages."""
    return messages.filter(F.col("id").isNotNull()).groupBy("tree", "id").agg(F.min(F.struct("parent", "role", "text", "score")).alias("_m")).select("tree", "id", "_m.*")


def best_paths(messages: DataFrame, paths: int = 1) -> DataFrame:
    """The ``paths`` best root-to-leaf paths of every reply tree by mean score, as rows (tree, path, depth, id). ``messages`` are `one_of_each`.

    Ties go to the longer, then to the smaller leaf id. A message whose parent is missing from the table is a root. Messages that lie
    on a cycle never reach a root and are in no path. A null tree is a tree, a null score counts 0; an empty table gives no rows.
    """
    have = messages.select(F.col("tree").alias("_t"), F.col("id").alias("_p"))
    m = messages.join(have, messages["tree"].eqNullSafe(have["_t"]) & (messages["parent"] == have["_p"]), "left").select(
        "tree", "id", F.col("_p").alias("parent"), F.coalesce(F.col("score"), F.lit(0.0)).alias("score"))
    m = durable(m)
    scored, steps = leaf_scores(m)
    parents = m.filter(F.col("parent").isNotNull()).select(F.col("tree").alias("_t"), F.col("parent").alias("_p")).distinct()
    leaves = scored.join(parents, scored["tree"].eqNullSafe(parents["_t"]) & (scored["id"] == parents["_p"]), "left_anti")
    rank = F.row_number().over(W.partitionBy("tree").orderBy((F.col("total") / F.col("depth")).desc(), F.col("depth").desc(), "id"))
    on = durable(leaves.withColumn("path", rank).filter(F.col("path") <= paths).select("tree", "path", "id"))
    for up in steps:  # the places 0..2^k-1 above a leaf are known; the pointers of round k add the next 2^k
        u = up.select(F.col("tree").alias("_t"), F.col("id").alias("_i"), "up")
        on = durable(on.unionByName(on.join(u, on["tree"].eqNullSafe(u["_t"]) & (on["id"] == u["_i"])).select("tree", "path", F.col("up").alias("id"))))
    depth = scored.select(F.col("tree").alias("_t"), F.col("id").alias("_i"), "depth")
    return on.join(depth, on["tree"].eqNullSafe(depth["_t"]) & (on["id"] == depth["_i"])).select("tree", "path", "depth", "id")


def format_paths(turns: DataFrame) -> DataFrame:
    """One text per (tree, path) from rows (tree, path, depth, role, text), with the spans that carry loss.

    Returns tree, path, n_turns, ``formatted`` and ``loss_spans``, an array of (start, length) in code points over the assistant
    texts. Null roles and texts are empty.
    """
    role, text = escape_role(F.coalesce(F.col("role"), F.lit(""))), escape(F.coalesce(F.col("text"), F.lit("")))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    t = turns.select("tree", "path", "depth", head.alias("head"), text.alias("body"), (F.coalesce("role", F.lit("")) == "assistant").alias("loss"))
    t = t.withColumn("piece", F.concat("head", "body", F.lit(END + "\n")))
    at = F.sum(F.char_length("piece")).over(W.partitionBy("tree", "path").orderBy("depth").rowsBetween(W.unboundedPreceding, -1))
    t = t.withColumn("start", F.coalesce(at, F.lit(0)) + F.char_length("head"))
    g = t.groupBy("tree", "path").agg(F.sort_array(F.collect_list(F.struct("depth", "piece", "start", F.char_length("body").alias("length"), "loss"))).alias("t"))
    spans = F.transform(F.filter("t", lambda x: x["loss"]), lambda x: F.struct(x["start"].cast("long").alias("start"), x["length"].cast("long").alias("length")))
    return g.select("tree", "path", F.size("t").cast("long").alias("n_turns"), F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted text."""
    parts = F.split(formatted, r"<\|im_end\|>\n", -1)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    def turn(x: Column) -> Column:
        x = F.substr(x, F.lit(len(START) + 1))
        role = F.substring_index(x, "\n", 1)
        return F.struct(unescape_role(role).alias("role"), unescape(F.substr(x, F.char_length(role) + 2)).alias("text"))
    return F.transform(parts, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss spans, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def chat(messages: DataFrame, paths: int = 1) -> DataFrame:
    """Format the best paths of every reply tree (tree, id, parent, role, text, score) as conversations.

    Parents link messages inside a tree. Rows that repeat (tree, id) are one message (`one_of_each`), so they neither multiply turns nor split a path; rows
    without an id are left out. Null roles and texts are empty, a null tree is a tree, a null score counts 0. All other columns are ignored,
    whatever their names. A path becomes one output row, so its size, and that of its longest text, bounds what meets in one task; trees of any
    width are spread over their messages. An empty table gives no rows.
    """
    messages = one_of_each(messages)
    chosen = best_paths(messages, paths)
    said = messages.select(F.col("tree").alias("_t"), F.col("id").alias("_i"), "role", "text")
    return format_paths(chosen.join(said, chosen["tree"].eqNullSafe(said["_t"]) & (chosen["id"] == said["_i"])).select("tree", "path", "depth", "role", "text"))

r"""Operator 4, chat formatting: reply trees.

Messages (tree, id, parent, role, text, score) form reply trees.  Iterative self-joins by pointer doubling walk all
messages to their roots at once (the number of rounds is the logarithm of the depth); leaves are ranked in each tree
by the mean score of their path, then the longer path, then the smaller leaf id; the paths of the chosen leaves are
enumerated from the same pointers and formatted, each as one conversation.

Template: ``<|im_start|>role\ntext<|im_end|>\n`` for each turn.  Control strings of this and other usual templates
inside a text are escaped by a backslash after their first character (existing backslashes there are kept and one is
added), roles escape backslash and newline; both are undone exactly.  The loss mask covers the text of assistant
turns.  A conversation is cut into segments of ``segment_turns`` turns (one for any usual conversation), so the rows
of one huge conversation are spread over tasks; segments in order are the formatted conversation.

Defined results: null text or role: empty; a parent that is no message of the tree: its child is a root; messages on
or below a cycle have no root and are on no path; of repeated (tree, id) rows the smallest (parent, role, text) counts;
null tree is a tree of its own, rows with a null id are dropped (they can be neither reply nor parent); an empty table
gives no row.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, read, stored

#: What follows the first character of a control string, by that character.
CONTROL = {"<": ("s>", "/s>", "|im_start|>", "|im_end|>", "|endoftext|>", "|system|>", "|user|>", "|assistant|>"),
           "[": ("INST]", "/INST]")}
SEGMENT_TURNS = 256
START, END = "<|im_start|>", "<|im_end|>\n"

def _patterns() -> tuple[str, str]:
    rest = "|".join(re.sub(r"([|\]\[])", r"\\\1", r) for own in CONTROL.values() for r in own)
    return rf"([<\[])(\\*)({rest})", rf"([<\[])\\(\\*)({rest})"


#: A control string, possibly escaped already: (first character)(backslashes)(rest); the same with one backslash more.
ESCAPE, UNESCAPE = _patterns()
_unescape = re.compile(UNESCAPE)
_turn = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def unescape(text: str) -> str:
    return _unescape.sub(r"\1\2\3", text)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def escaped(c: Column) -> Column:
    return F.regexp_replace(c, F.lit(ESCAPE), F.lit(r"$1\\$2$3"))


def escaped_role(c: Column) -> Column:
    return escaped(F.regexp_replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), "\n", r"\\n"))


def chain(rows: DataFrame, tree: str, order: str, role: str, text: str, block: int = SEGMENT_TURNS) -> DataFrame:
    """Messages of linear conversations: every row replies to the one before it by (order, role, text).  Rows are
    numbered by (tree, block of order values), so a huge conversation is ordered in many tasks, not one."""
    src = rows.select(F.col(f"`{tree}`").alias("tree"), F.col(f"`{order}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
                      F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    src = src.withColumn("block", F.floor(F.col("turn") / block))
    counts = src.groupBy("tree", "block").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("tree").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col("tree").alias("_tree"), F.col("block").alias("_block"), F.coalesce(before, F.lit(0)).alias("offset"))
    own = F.row_number().over(Window.partitionBy("tree", "block").orderBy("turn", "role", "text"))
    joined = src.withColumn("own", own).join(offsets, F.col("tree").eqNullSafe(F.col("_tree")) & F.col("block").eqNullSafe(F.col("_block")))
    number = F.col("offset") + F.col("own")
    return joined.select("tree", number.cast("long").alias("id"), F.when(number > 1, number - 1).cast("long").alias("parent"), "role", "text",
                         F.lit(1.0).alias("score"))


def _match(a: str, b: str) -> Column:
    return F.col("tree").eqNullSafe(F.col("_tree")) & (F.col(a) == F.col(b))


def paths(messages: DataFrame, top: int | None = None) -> DataFrame:
    """(tree, leaf, rank, id, pos): the messages of each chosen root-to-leaf path, best ``top`` paths of each tree."""
    m = stored(messages.where(F.col("id").isNotNull()).groupBy("tree", "id").agg(
        F.min(F.struct("parent", "role", "text", "score")).alias("m")).select("tree", "id", "m.parent", "m.score"), "messages")
    ids = m.select(F.col("tree").alias("_tree"), F.col("id").alias("_id"))
    links = m.join(ids, _match("parent", "_id"), "left").select("tree", "id", F.col("_id").alias("up"), F.coalesce("score", F.lit(0.0)).alias("sum"),
                                                              F.lit(1).cast("long").alias("depth"))
    levels = [stored(links, "up0")]
    done, total, limit = [], m.count(), 1
    while True:
        now = levels[-1]
        done.append(now.where(F.col("up").isNull()).select("tree", "id", "sum", "depth"))
        active = now.where(F.col("up").isNotNull())
        if active.isEmpty() or limit > 2 * total:
            break
        limit *= 2
        # pointers that ended at a root are the same for every later level: only they and the active ones are joined
        ahead = reduce(DataFrame.unionByName, [d.withColumn("up", F.lit(None).cast("long")) for d in done], active)
        ahead = ahead.select(F.col("tree").alias("_tree"), F.col("id").alias("_id"), F.col("up").alias("_up"), F.col("sum").alias("_sum"), F.col("depth").alias("_depth"))
        step = active.join(ahead, _match("up", "_id")).select("tree", "id", F.col("_up").alias("up"), (F.col("sum") + F.col("_sum")).alias("sum"),
                                                             (F.col("depth") + F.col("_depth")).alias("depth"))
        levels.append(stored(step, f"up{len(levels)}"))
    ends = reduce(DataFrame.unionByName, done)
    parents = levels[0].where(F.col("up").isNotNull()).select(F.col("tree").alias("_tree"), F.col("up").alias("_id")).distinct()
    leaves = ends.join(parents, _match("id", "_id"), "left_anti").withColumn("mean", F.col("sum") / F.col("depth"))
    if top is not None:
        rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("mean"), F.desc("depth"), "id"))
        leaves = leaves.withColumn("rank", rank).where(F.col("rank") <= top)
    members = leaves.select("tree", F.col("id").alias("leaf"), "id", (F.col("depth") - 1).alias("pos"))
    for j in range(len(levels) - 1, -1, -1):
        up = levels[j].where(F.col("up").isNotNull()).select(F.col("tree").alias("_tree"), F.col("id").alias("_id"), "up")
        members = members.unionByName(members.join(up, _match("id", "_id")).select("tree", "leaf", F.col("up").alias("id"), (F.col("pos") - (1 << j)).alias("pos")))
        members = stored(members, "members") if j and j % 3 == 0 else members
    return members


def format_paths(messages: DataFrame, top: int | None = None, segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """(tree, leaf, segment, formatted, loss): formatted conversations with the loss mask's spans (characters of the
    segment, end exclusive)."""
    messages = stored(messages, "replies")
    p = paths(messages, top)
    own = messages.where(F.col("id").isNotNull()).groupBy("tree", "id").agg(F.min(F.struct("parent", "role", "text", "score")).alias("m")).select(
        F.col("tree").alias("_tree"), F.col("id").alias("_id"), F.coalesce("m.role", F.lit("")).alias("role"), F.coalesce("m.text", F.lit("")).alias("text"))
    turns = p.join(own, _match("id", "_id"))
    head = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"))
    body = escaped(F.col("text"))
    turns = turns.select("tree", "leaf", F.floor(F.col("pos") / segment_turns).alias("segment"), "pos", F.concat(head, body, F.lit(END)).alias("turn"),
                         F.when(F.col("role") == "assistant", F.length(head)).alias("a"), F.length(body).alias("n"))
    segments = turns.groupBy("tree", "leaf", "segment").agg(F.sort_array(F.collect_list(F.struct("pos", "turn", "a", "n"))).alias("t"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("loss"))
    walk = F.aggregate("t", zero, lambda acc, x: F.struct(
        (acc["at"] + F.length(x["turn"])).alias("at"),
        F.when(x["a"].isNull(), acc["loss"]).otherwise(F.concat(acc["loss"], F.array(F.struct(
            (acc["at"] + x["a"]).alias("start"), (acc["at"] + x["a"] + x["n"]).alias("end"))))).alias("loss")), lambda acc: acc["loss"])
    return segments.select("tree", "leaf", "segment", F.array_join(F.transform("t", lambda x: x["turn"]), "").alias("formatted"), walk.alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from its formatted segments alone: turns, digests and the text under the loss mask.
    Segments stream through the task in order; only running digests are held."""
    spark = formatted.sparkSession
    bounded_batches(spark)
    tree_type = formatted.schema["tree"].dataType.simpleString()
    ordered = formatted.repartition("tree", "leaf").sortWithinPartitions("tree", "leaf", "segment")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, tree_field = None, [], None

        def closed(state) -> tuple:
            (tree, leaf), turns, digest, loss_chars, loss, chars = state
            return tree, leaf, turns, digest.hexdigest(), loss_chars, loss.hexdigest(), chars

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            tree, leaf, *rest = zip(*rows) if rows else [()] * 7
            types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(tree, tree_field), pa.array(leaf, pa.int64()), *[pa.array(x, t) for x, t in zip(rest, types)]],
                                              ["tree", "leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for b in batches:
            tree_field = b.schema.field("tree").type
            for tree, leaf, text, spans in zip(*(b.column(n).to_pylist() for n in ("tree", "leaf", "formatted", "loss"))):
                if now is None or now[0] != (tree, leaf):
                    if now is not None:
                        out.append(closed(now))
                    now = [(tree, leaf), 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for t in _turn.finditer(text):
                    now[1] += 1
                    now[2].update(f"{unescape_role(t[1])}\n{unescape(t[2])}\n".encode())
                for s in spans:
                    part = unescape(text[s["start"]:s["end"]])
                    now[3] += len(part)
                    now[4].update(part.encode())
                now[5] += len(text)
            yield batch(out)
            out = []
        if now is not None:
            yield batch([closed(now)])

    return ordered.select("tree", "leaf", "formatted", "loss").mapInArrow(
        run, f"tree {tree_type}, leaf long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def extra_rows(spark: SparkSession) -> DataFrame:
    """Conversation -1 of the contract."""
    text = "</s>[INST] ok [/INST]"
    return spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")


def op4_chat_format(spark, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra_rows(spark))
    out = read_back(format_paths(chain(rows, "conv_id", "turn", "role", "text")))
    return out.select(F.col("tree").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


_marks = len(START) + 1 + len(END)
ORACLE = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({_marks} + length(role) + length(regexp_replace(text, '{ESCAPE}', '\1\\\2\3', 'g')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""

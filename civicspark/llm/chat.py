"""Chat formatting with collapse of cumulative snapshots.

A chat that is logged again after every turn leaves conversations that are prefixes of longer ones. Each turn is hashed
with its place, and the exclusive-or of the hashes of the first n turns is the conversation's rolling prefix hash; an
anti-join of whole-conversation hashes with the proper prefixes of all others leaves the maximal conversations, which
are then rendered. Equal conversations are first merged to one row, so that no key of a join repeats on the other side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import materialize

#: The fixed markers of the template.
BEGIN, END = "<|im_start|>", "<|im_end|>"
#: Rows of keys that are broadcast, up to about 50 bytes each.
_BROADCAST = 500_000


def _hashed(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Conversation, turn, role, text and a hash of the last two, of rows that have a conversation."""
    content = F.to_json(F.struct(F.col(role).alias("r"), F.col(text).alias("x")))
    return turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).alias("_c"), F.col(turn).alias("_t"), F.col(role).alias("_r"), F.col(text).alias("_x"), F.unhex(F.sha2(content, 256)).alias("_h")
    )


def _broadcast(keys: DataFrame) -> DataFrame:
    """Keys of few rows are broadcast, so that texts that don't have them aren't shuffled; more are joined by shuffle."""
    return F.broadcast(keys) if keys.count() <= _BROADCAST else keys


def maximal(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``n_turns``, ``n_copies`` and ``n_prefixes`` of each conversation that is no prefix of a longer one.

    Of equal conversations the one with the smallest id stays; ``n_copies`` counts them, ``n_prefixes`` the logged
    conversations (copies counted) that are proper prefixes. Turns stand by ``turn``, then role, then text (null first);
    repeated rows are one turn; null roles and texts are equal to each other and to nothing else; texts of any length go
    through a hash, whole; rows without a conversation id are left out; an empty table gives no rows; other columns are
    not read.
    """
    hashed = _hashed(turns, conv, turn, role, text)
    rows = hashed.select("_c", "_t", "_r", "_h").dropDuplicates(["_c", "_t", "_h"]).repartition("_c")
    rows = materialize(rows.withColumn("_k", F.count("*").over(Window.partitionBy("_c", "_t", "_r"))))
    # texts decide the order only where a turn and role stand twice in a conversation, so only these travel
    twice = rows.where("_k > 1").select(F.col("_c").alias("_c2"), F.col("_t").alias("_t2"), F.col("_r").alias("_r2")).distinct()
    same = (F.col("_c") == F.col("_c2")) & F.col("_t").eqNullSafe(F.col("_t2")) & F.col("_r").eqNullSafe(F.col("_r2"))
    tied = hashed.join(_broadcast(twice), same, "left_semi").dropDuplicates(["_c", "_t", "_h"])
    tied = tied.select(
        F.col("_c").alias("_c2"),
        F.col("_t").alias("_t2"),
        F.col("_h").alias("_h2"),
        F.row_number().over(Window.partitionBy("_c", "_t", "_r").orderBy(F.asc_nulls_first("_x"))).alias("_i"),
    )
    rows = rows.join(tied, (F.col("_c") == F.col("_c2")) & F.col("_t").eqNullSafe(F.col("_t2")) & (F.col("_h") == F.col("_h2")), "left")
    at = Window.partitionBy("_c").orderBy(F.asc_nulls_first("_t"), F.asc_nulls_first("_r"), F.asc_nulls_first("_i"))
    placed = rows.select("_c", "_h", F.row_number().over(at).alias("_n"))
    # two words of 64 bits: the hash of a turn and its place
    placed = placed.withColumns({"_a": F.xxhash64("_n", "_h"), "_b": F.xxhash64("_h", "_n", F.lit("b"))})
    so_far = Window.partitionBy("_c").orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
    rolled = placed.select(
        "_c",
        "_n",
        F.expr("bit_xor(_a)").over(so_far).alias("_pa"),
        F.expr("bit_xor(_b)").over(so_far).alias("_pb"),
        F.lead("_n").over(Window.partitionBy("_c").orderBy("_n")).isNull().alias("_whole"),
    )
    rolled = materialize(rolled)  # a few numbers a turn
    whole = rolled.where("_whole").groupBy("_n", "_pa", "_pb").agg(F.min("_c").alias(conv), F.count("*").alias("n_copies"))
    proper = rolled.where("not _whole").select("_n", "_pa", "_pb").distinct()
    kept = whole.join(proper, ["_n", "_pa", "_pb"], "left_anti")
    # how many logged conversations each kept one swallows: its proper prefixes that are whole ones too
    inner = rolled.where("not _whole").join(kept.select(F.col(conv).alias("_c")), "_c", "left_semi")
    swallowed = inner.join(
        whole.select("_n", "_pa", "_pb", "n_copies"), ["_n", "_pa", "_pb"]
    ).groupBy(F.col("_c").alias(conv)).agg(F.sum("n_copies").alias("n_prefixes"))
    return kept.join(swallowed, conv, "left").select(
        conv, F.col("_n").cast("long").alias("n_turns"), "n_copies", F.coalesce("n_prefixes", F.lit(0)).cast("long").alias("n_prefixes")
    )


def render(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The columns of ``maximal`` and ``chat``, the whole conversation in the template's markers.

    A null role is written "unknown", a null text as nothing; cases otherwise as in ``maximal``.
    """
    kept = materialize(maximal(turns, conv=conv, turn=turn, role=role, text=text))
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv), F.col(turn).alias("_t"), F.col(role).alias("_r"), F.col(text).alias("_x")
    ).join(_broadcast(kept.select(conv)), conv, "left_semi").distinct()
    key = F.struct("_t", "_r", "_x")  # in a struct null comes first
    line = F.transform(
        F.array_sort(F.collect_list(key)),
        lambda s: F.concat(
            F.lit(BEGIN), F.coalesce(s["_r"], F.lit("unknown")), F.lit("\n"), F.coalesce(s["_x"], F.lit("")), F.lit(END), F.lit("\n")
        ),
    )
    chats = rows.groupBy(conv).agg(F.array_join(line, "").alias("chat"))
    return kept.join(chats, conv)

"""Chat formatting: collapse logged snapshots of a growing conversation, render what is left. DataFrame functions only.

A conversation's turns are ranked; each turn's hash covers its rank, role and text, and the hash of a
prefix is the XOR of its turns' hashes, two of 64 bits, so it rolls from turn to turn and can be
summed in parts. A conversation goes if another one equals it and has a smaller id, or if its full
hash occurs as a proper prefix of another one: both by anti-join on (length, hashes). The rest are
rendered.

Turns are ranked within the parts of one range partitioning by conversation, turn, role and text, and
the parts' totals are added from a small window over parts, so one conversation with a third of all
rows is dealt over many tasks, even if its turns share one number; it is rendered in parts of PART
turns. A null role or text counts as empty; a null turn comes first; equal rows of one
conversation count once; rows of a null conversation id form one conversation, which is the last to
be chosen among equal ones. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.session import materialize

PART = 256


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(ckey, conv_id, rank, role, text, h1, h2: the turn's own, p1, p2: those of the prefix that ends with it)."""
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    rows = turns.select("conv_id", "turn", blank("role"), blank("text")).distinct()
    rows = rows.withColumn("ckey", F.coalesce(F.concat(F.lit("v"), F.col("conv_id").cast("string")), F.lit("")))
    order = ["ckey", F.col("turn").asc_nulls_first(), "role", "text"]
    rows = materialize(rows.repartitionByRange(*order).withColumn("block", F.spark_partition_id()))
    inside = Window.partitionBy("ckey", "block").orderBy(*order[1:])
    rows = rows.withColumn("r", F.row_number().over(inside))
    counts = rows.groupBy("ckey", "block").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("ckey").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("ckey", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    ranked = rows.join(offsets, ["ckey", "block"]).withColumn("rank", F.col("offset") + F.col("r"))
    own = ranked.withColumns({"h1": F.xxhash64("rank", "role", "text"), "h2": F.xxhash64(F.lit("turn"), "text", "role", "rank")})
    rolling = Window.partitionBy("ckey", "block").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    own = own.withColumns({"b1": F.bit_xor("h1").over(rolling), "b2": F.bit_xor("h2").over(rolling)})
    totals = own.groupBy("ckey", "block").agg(F.bit_xor("h1").alias("t1"), F.bit_xor("h2").alias("t2"))
    zero = F.lit(0).cast("long")
    before = totals.select("ckey", "block", F.coalesce(F.bit_xor("t1").over(earlier), zero).alias("e1"), F.coalesce(F.bit_xor("t2").over(earlier), zero).alias("e2"))
    out = own.join(before, ["ckey", "block"])
    return out.select("ckey", "conv_id", "rank", "role", "text", "h1", "h2", F.col("b1").bitwiseXOR(F.col("e1")).alias("p1"), F.col("b2").bitwiseXOR(F.col("e2")).alias("p2"))


def maximal(prefixes: DataFrame) -> DataFrame:
    """(ckey, conv_id, n_turns, n_same) of the conversations that are neither a prefix nor a later copy of another."""
    whole = prefixes.groupBy("ckey", "conv_id").agg(F.max("rank").alias("n_turns"), F.bit_xor("h1").alias("p1"), F.bit_xor("h2").alias("p2"))
    first = F.min(F.struct(F.col("conv_id").isNull().alias("none"), "conv_id", "ckey")).alias("first")
    classes = whole.groupBy("n_turns", "p1", "p2").agg(first, F.count("*").alias("n_same"))
    # each turn after the first shows that the prefix before it is a proper one
    proper = prefixes.filter("rank > 1").select((F.col("rank") - 1).alias("n_turns"), F.col("p1").bitwiseXOR(F.col("h1")).alias("p1"), F.col("p2").bitwiseXOR(F.col("h2")).alias("p2")).distinct()
    kept = classes.join(proper, ["n_turns", "p1", "p2"], "left_anti")
    return kept.select(F.col("first.ckey").alias("ckey"), F.col("first.conv_id").alias("conv_id"), "n_turns", "n_same")


def render(prefixes: DataFrame, kept: DataFrame, part: int = PART) -> DataFrame:
    """(conv_id, part, n_turns, n_same, text): a header and the text for each turn, ``part`` turns a row."""
    turns = prefixes.join(kept.select("ckey", "n_turns", "n_same"), "ckey")
    line = F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n"))
    grouped = turns.groupBy("ckey", "conv_id", "n_turns", "n_same", F.floor((F.col("rank") - 1) / part).cast("long").alias("part")).agg(F.sort_array(F.collect_list(F.struct("rank", line.alias("line")))).alias("lines"))
    return grouped.select("conv_id", "part", "n_turns", "n_same", F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("text"))


def format_conversations(turns: DataFrame) -> DataFrame:
    prefixes = materialize(prefix_hashes(turns))
    return render(prefixes, maximal(prefixes))


def op2_chat_format(conversations: DataFrame) -> DataFrame:
    return format_conversations(conversations)


OP2_SQL = f"""WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') role, coalesce(text, '') text FROM conversations),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) rk FROM t),
c AS (SELECT conv_id, list(role || chr(0) || text ORDER BY rk) l, count(*) n FROM r GROUP BY conv_id),
k AS (SELECT l, n, min(conv_id) conv_id, count(*) n_same FROM c GROUP BY l, n),
p AS (SELECT DISTINCT l[1:i] l FROM (SELECT l, unnest(generate_series(1, n - 1)) i FROM c WHERE n > 1)),
m AS (SELECT conv_id, n n_turns, n_same FROM k WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.l = k.l))
SELECT r.conv_id, (rk - 1) // {PART} part, n_turns, n_same, string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '' ORDER BY rk) text FROM r JOIN m ON r.conv_id IS NOT DISTINCT FROM m.conv_id GROUP BY ALL"""

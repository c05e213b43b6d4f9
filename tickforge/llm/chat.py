"""Chat formatting with cumulative-snapshot collapse.

A chat log often holds the same conversation several times, each time with a few turns more.
Every turn gets a 128-bit hash of (position, role, text); the running XOR over a conversation is
the hash of each of its prefixes. A conversation whose whole hash is a proper prefix of another,
or equals that of another with a smaller id, is anti-joined away; the maximal ones are rendered.

Conversations are cut by a range partitioning on (conversation, turn), so that one conversation
with a third of all turns is spread over many tasks: positions and hashes run inside a partition,
and the offsets of the partitions before come from one row a (conversation, partition).

Defined cases: rows equal in conversation, turn, role and text count once; turns are ordered by
turn (NULL first), then role, then text; rows with a NULL conv_id form one conversation of their
own; NULL role reads as ``unknown``, NULL text as empty; roles and texts that hold the template's
own marks are rendered as they are; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import written

#: Turns rendered into one output row; longer conversations continue in further parts.
PART_TURNS = 256


def _turns(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def prefix_hashes(conversations: DataFrame, partitions: int | None = None) -> DataFrame:
    """conv_id, position (from 1), role, text, h1, h2 (hash of the turns up to here), n_turns."""
    spark = conversations.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _turns(conversations).groupBy("conv_id", "turn", "role", "text").agg(F.lit(1).alias("one")).drop("one")
    rows = rows.repartitionByRange(n, "conv_id", "turn", "role", "text").withColumn("part", F.spark_partition_id())
    rows = written(rows, "chat-turns")  # the partition of a row must not change from here on
    counts = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    # One row a (conversation, partition): at most as many a conversation as there are partitions.
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    run = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    same = F.col("o.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("o.part") == F.col("r.part"))
    placed = (
        rows.alias("r").join(offsets.alias("o"), same).select("r.*", "o.skip")
        .withColumn("position", F.col("skip") + F.count("*").over(run))
        .withColumn("digest", F.sha2(F.to_json(F.struct("position", "role", "text")), 256))
        .withColumn("t1", F.conv(F.substring("digest", 1, 16), 16, -10).cast("long"))
        .withColumn("t2", F.conv(F.substring("digest", 17, 16), 16, -10).cast("long"))
        .withColumn("r1", F.bit_xor("t1").over(run)).withColumn("r2", F.bit_xor("t2").over(run))
    )
    placed = written(placed.select("conv_id", "part", "position", "role", "text", "t1", "t2", "r1", "r2"), "chat-hashes")
    sums = placed.groupBy("conv_id", "part").agg(F.bit_xor("t1").alias("s1"), F.bit_xor("t2").alias("s2"), F.count("*").alias("n"))
    whole = Window.partitionBy("conv_id")
    carried = sums.select(
        "conv_id", "part", F.coalesce(F.bit_xor("s1").over(before), F.lit(0).cast("long")).alias("c1"),
        F.coalesce(F.bit_xor("s2").over(before), F.lit(0).cast("long")).alias("c2"), F.sum("n").over(whole).alias("n_turns"),
    )
    same = F.col("o.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("o.part") == F.col("r.part"))
    return placed.alias("r").join(carried.alias("o"), same).select(
        "r.conv_id", "r.position", "r.role", "r.text", F.col("r.r1").bitwiseXOR(F.col("o.c1")).alias("h1"), F.col("r.r2").bitwiseXOR(F.col("o.c2")).alias("h2"), "o.n_turns"
    )


def maximal(hashed: DataFrame) -> DataFrame:
    """The turns of the conversations that are no prefix of another (see :func:`prefix_hashes`)."""
    last = hashed.where(F.col("position") == F.col("n_turns")).select("conv_id", "n_turns", "h1", "h2")
    # Of equal conversations the smallest id stays (NULL last).
    first = last.groupBy("h1", "h2", "n_turns").agg(F.min("conv_id").alias("conv_id"))
    # Many conversations share their first turns: one row a prefix, whoever has it.
    proper = hashed.where(F.col("position") < F.col("n_turns")).select("h1", "h2", F.col("position").alias("n_turns")).distinct()
    keep = written(first.join(proper, ["h1", "h2", "n_turns"], "left_anti").select("conv_id"), "chat-kept")
    return hashed.alias("h").join(keep.alias("k"), F.col("h.conv_id").eqNullSafe(F.col("k.conv_id")), "left_semi")


def render(turns: DataFrame, *, part_turns: int = PART_TURNS) -> DataFrame:
    """conv_id, part, n_turns, text in the ChatML template; at most ``part_turns`` turns a row."""
    line = F.concat(F.lit("<|im_start|>"), F.col("role"), F.lit("\n"), F.col("text"), F.lit("<|im_end|>\n"))
    return (
        turns.select("conv_id", F.floor((F.col("position") - 1) / part_turns).cast("int").alias("part"), "position", line.alias("line"))
        .groupBy("conv_id", "part").agg(F.count("*").alias("n_turns"), F.array_sort(F.collect_list(F.struct("position", "line"))).alias("lines"))
        .select("conv_id", "part", "n_turns", F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("text"))
    )


def format_chats(conversations: DataFrame, *, part_turns: int = PART_TURNS) -> DataFrame:
    """Snapshots collapsed, maximal conversations rendered."""
    hashed = written(prefix_hashes(conversations), "chat-prefixes")
    return render(maximal(hashed), part_turns=part_turns)


SQL = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
p AS (SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n FROM t
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
x AS (SELECT *, string_agg(pos || ':' || length(role) || ':' || role || length(text) || ':' || text, '|')
      OVER (PARTITION BY conv_id ORDER BY pos) AS prefix FROM p),
f AS (SELECT prefix, n, min(conv_id) AS conv_id FROM x WHERE pos = n GROUP BY prefix, n),
k AS (SELECT conv_id FROM f WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.pos < x.n AND x.pos = f.n AND x.prefix = f.prefix))
SELECT p.conv_id, CAST(floor((pos - 1) / {PART_TURNS}) AS INTEGER) AS part, count(*) AS n_turns,
       string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
FROM p WHERE EXISTS (SELECT 1 FROM k WHERE k.conv_id IS NOT DISTINCT FROM p.conv_id)
GROUP BY p.conv_id, CAST(floor((pos - 1) / {PART_TURNS}) AS INTEGER)
"""

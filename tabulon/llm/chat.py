"""Chat formatting with cumulative-snapshot collapse, in DataFrame functions only.

Chat logs hold the same conversation again and again as it grows.  Each turn's
rolling prefix hash is the exclusive-or, up to that turn, of 128-bit hashes of
(place, role, text): a running window aggregate, linear in the turns.  A logged
conversation whose whole hash is the hash of a proper prefix elsewhere is an
earlier snapshot; an anti-join drops it.  Equal conversations fold into the one with
the smallest id.  What remains is rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.llm.common import stored, table, text_or_empty

TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"


def _half(digest: str, at: int) -> Column:
    """64 bits of a hex digest as a signed long."""
    part = lambda start: F.conv(F.substring(digest, start, 8), 16, 10).cast("long")
    return F.shiftleft(part(at), 32).bitwiseOR(part(at + 8))


def _placed(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, k, role, text, a, b): turns in order, with the 128-bit hash of (place, role, text).

    Nulls come first, null role and text read as empty.  A turn without a conversation id is a conversation by
    itself, so such turns never meet in one group.
    """
    order = [F.col(turn).asc_nulls_first(), F.col(role).asc_nulls_first(), F.col(text).asc_nulls_first()]
    whole = [F.col(conv).alias("conv"), text_or_empty(role).alias("role"), text_or_empty(text).alias("text")]
    placed = turns.where(F.col(conv).isNotNull()).select(*whole, F.row_number().over(Window.partitionBy(conv).orderBy(*order)).alias("k"))
    placed = placed.unionByName(turns.where(F.col(conv).isNull()).select(*whole, F.lit(1).alias("k")))
    digest = F.md5(F.concat_ws("\x1f", F.col("k").cast("string"), F.length("role").cast("string"), "role", "text"))
    return placed.withColumn("d", digest).select("conv", "k", "role", "text", _half("d", 1).alias("a"), _half("d", 17).alias("b"))


def prefix_hashes(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, k, a, b, is_last): the rolling hash of every conversation's first k turns."""
    placed = _placed(turns, conv, turn, role, text).select("conv", "k", "a", "b")
    so_far = Window.partitionBy("conv").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    rolled = placed.where("conv IS NOT NULL").select(
        "conv", "k", F.bit_xor("a").over(so_far).alias("a"), F.bit_xor("b").over(so_far).alias("b"),
        F.lead("k").over(Window.partitionBy("conv").orderBy("k")).isNull().alias("is_last"))
    return rolled.unionByName(placed.where("conv IS NULL").withColumn("is_last", F.lit(True)))


def maximal(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, n_turns, n_copies, a, b): conversations that no longer one begins with, equal ones folded; a and b are their hashes."""
    hashes = stored(prefix_hashes(turns, conv, turn, role, text), "chat-prefixes")
    whole = hashes.where("is_last").groupBy("k", "a", "b").agg(F.min("conv").alias("conv"), F.count("*").alias("n_copies"))
    begun = hashes.where("NOT is_last").select("k", "a", "b").distinct()
    return whole.join(begun, ["k", "a", "b"], "left_anti").select("conv", F.col("k").alias("n_turns"), "n_copies", "a", "b")


def chat_format(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, n_turns, n_copies, text): each maximal conversation rendered once.

    A row without a conversation id is a conversation of one turn.  Null roles and texts are
    empty; turns with the same number are ordered by role, then text; repeated rows
    are turns of their own.  Extra columns are not read; an empty table gives an
    empty result.
    """
    kept = stored(maximal(turns, conv, turn, role, text), "chat-maximal")
    placed = _placed(turns, conv, turn, role, text)
    shown = F.concat(F.lit(TURN_START), F.col("role"), F.lit("\n"), F.col("text"), F.lit(TURN_END + "\n"))
    named = kept.where("conv IS NOT NULL").select("conv", "n_turns", "n_copies")
    mine = placed.where("conv IS NOT NULL").join(named.select("conv"), "conv", "left_semi")
    rendered = mine.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("k", shown.alias("shown")))).alias("ts"))
    rendered = rendered.select("conv", F.array_join(F.transform("ts", lambda t: t["shown"]), "").alias("text")).join(named, "conv")
    alone = kept.where("conv IS NULL").select("a", "b", "n_turns", "n_copies")
    single = placed.where("conv IS NULL").join(alone, ["a", "b"]).groupBy("conv", "a", "b").agg(
        F.min(shown).alias("text"), F.min("n_turns").alias("n_turns"), F.min("n_copies").alias("n_copies"))
    columns = [F.col("conv").alias("conv_id"), F.col("n_turns").cast("long").alias("n_turns"), "n_copies", "text"]
    return rendered.select(*columns).unionByName(single.select(*columns))


def query(spark, sf_dir):
    return chat_format(table(spark, sf_dir, "conversations"))


SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS own,
    CASE WHEN conv_id IS NULL THEN 1 ELSE row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) END AS k FROM conversations),
c AS (
  SELECT conv_id, count(*) AS n_turns, list(md5(role || chr(31) || text) ORDER BY k) AS turns,
    string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY k) AS text FROM t GROUP BY conv_id, own),
w AS (SELECT turns, n_turns, min(conv_id) AS conv_id, count(*) AS n_copies, any_value(text) AS text FROM c GROUP BY turns, n_turns),
p AS (SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, n_turns)) AS k FROM w))
SELECT conv_id, n_turns, n_copies, text FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.turns = w.turns)
"""

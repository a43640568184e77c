"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is two groupings (map-side combined) and two joins; nothing is
gathered on the driver but one row of counts per round.  Hub nodes only
appear on the streamed side of sort-merge joins, which AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import stored


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


#: Rows of a round's tables that one task takes; small tables make few tasks.
ROWS_A_TASK = 100_000


def connected(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(a, b) links -> (node, root) for every linked node but the roots.

    ``root`` is the smallest node of the component.  Self links, repeated links
    and either direction are allowed; links with a null end are ignored.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = stored(pairs, "cc-edges")
    before = _signature(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        tasks = max(4, 2 * before[0] // ROWS_A_TASK)  # a round never has more than twice the edges

        def kept(df: DataFrame, name: str, tasks: int = tasks) -> DataFrame:
            return stored(df.coalesce(tasks), name)

        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = kept(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-low")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = kept(large, "cc-large")
        low = kept(large.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))
        )).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        e = kept(small, "cc-small")
        after = _signature(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))

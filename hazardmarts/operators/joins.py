"""Fan-out joins that stay balanced when one key holds a large share of the rows.

Lookups, whose right side has one row per key, need nothing of the kind and are plain joins: adaptive
execution broadcasts a side once its measured size allows it and otherwise splits partitions
that are too large. A fan-out multiplies rows, which partition sizes do not show.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than one part in HOT_PARTS of the members, so there are
# fewer than HOT_PARTS hot keys whatever the data size, and they can be broadcast.
HOT_PARTS = 1000


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate (file sizes and what the plan does to them)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the estimate is within the session's broadcast limit (negative means never)."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return 0 <= estimated_bytes(df) <= limit


def fan_out(
    facts: DataFrame, members: DataFrame, on: Sequence[str], member: str, parts: int = HOT_PARTS, in_order: Sequence[str] = ()
) -> DataFrame:
    """Inner join that repeats each fact for every member of its key (member ids are unique).

    Members whose estimate is within the broadcast limit are joined plainly: adaptive execution broadcasts
    them if their measured size allows it and otherwise splits partitions that are too large. Beyond it,
    the members of each hot key are spread over salts by a hash of their id and the facts of
    that key are repeated once per salt, so no task gets more than about one part in ``parts``
    of the members. Salts depend on row content only: a task that is run again after a lost
    executor gives the same rows.

    With ``in_order``, columns of the facts, the many rows a task makes leave it in the order of these and need no sort of their
    own. Where ``on`` begins with them both sides are sorted by ``on`` and merged; elsewhere the facts are sorted by them and look up their
    members by hash, of which a task has no more than one part in ``parts`` of any key.
    """
    on, in_order = list(on), list(in_order)
    merged = bool(in_order) and on[: len(in_order)] == in_order

    def joined(facts: DataFrame, members: DataFrame, on: list[str]) -> DataFrame:
        if merged:
            members = members.hint("merge")
        elif in_order:
            # The optimizer removes a sort right below a join; it cannot look through a condition that is not deterministic.
            facts = facts.repartition(*on).sortWithinPartitions(*in_order).where(F.spark_partition_id() >= 0)
            members = members.hint("shuffle_hash")
        return facts.join(members, on)

    if fits_broadcast(members) and (merged or not in_order):
        return joined(facts, members, on)
    per_key = members.groupBy(*on).agg(F.count(F.lit(1)).alias("_members"))
    total = members.agg(F.count(F.lit(1))).scalar()
    share = F.col("_members") * F.lit(float(parts)) / total
    hot = F.broadcast(per_key.filter(share > 1).select(*on, F.ceil(share).alias("_salts")))
    salt = F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(member), F.col("_salts"))).otherwise(F.lit(0))
    spread_members = members.join(hot, on, "left").withColumn("_salt", salt.cast("bigint")).drop("_salts")
    last_salt = (F.coalesce(F.col("_salts"), F.lit(1)) - 1).cast("bigint")
    repeated_facts = (
        facts.join(hot, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last_salt)))
        .drop("_salts")
    )
    return joined(repeated_facts, spread_members, [*on, "_salt"]).drop("_salt")

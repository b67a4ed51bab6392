"""Per-group selection that stands up to hot groups.

``row_number() <= k`` is planned by Spark as a group limit on both sides of
the shuffle: every map task sends at most ``k`` rows per group, so a group that
holds a third of the table still arrives as a few rows per task.  Spark only
does so up to ``spark.sql.optimizer.windowGroupLimitThreshold``; above it the
same bound is got with an explicit first round over salted groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import materialise

_SALTS = 512


def stored_keys(df: DataFrame) -> DataFrame:
    """``df``, a side of distinct keys, as a stored table.

    Spark then knows its true size in bytes and broadcasts it exactly when that
    is within ``spark.sql.autoBroadcastJoinThreshold``; beyond, it is an ordinary
    join side.  The keys are worked out once.
    """
    return materialise(df, "keys")


def _group_limit(df: DataFrame) -> int:
    """Up to how many rows of a group this session limits before the shuffle."""
    return int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rn"
) -> DataFrame:
    """The first ``k`` rows of every group, with their 1-based place in ``rank``."""
    if k > _group_limit(df):
        # Row content decides the salt, so a retried task gives the same rows.
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[df[c] for c in df.columns]), F.lit(_SALTS)))
        first = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = salted.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") <= k).drop("_rn", "_salt")
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``order``."""
    return top_per_group(df, keys, order, 1, rank="_first").drop("_first")


def smallest_in_group(
    df: DataFrame,
    keys: Sequence[str],
    quota: Column,
    draw: str,
    tie: str,
    flag: str = "chosen",
    bucket_chars: int = 4,
) -> DataFrame:
    """Mark the ``quota`` smallest rows of each group by ``(draw, tie)``, exactly.

    ``draw`` is a hex digest and ``quota`` an expression over the group size
    ``n``.  A plain ``row_number`` would sort a whole group in one task; here
    no task ever holds one:

    1. count rows per (group, digest prefix) - partial sums, then small tables;
    2. running counts over the prefixes give the prefix the cut falls into;
    3. only rows with that prefix are ranked, and the last chosen one becomes
       the group's cut;
    4. every row is compared with its group's cut.
    """
    prefix = F.substring(draw, 1, bucket_chars)
    counted = df.groupBy(*keys, prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_rows"))
    sized = counted.groupBy(*keys).agg(F.sum("_rows").alias("n")).withColumn("_quota", quota.cast("bigint"))
    running = Window.partitionBy(*keys).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    match = [F.col(f"c.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    cut_prefix = (
        counted.withColumn("_upto", F.sum("_rows").over(running))
        .alias("c")
        .join(sized.filter("_quota > 0").alias("s"), match)
        .filter((F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_rows") < F.col("_quota")))
        .select(
            *[F.col(f"c.{k}").alias(k) for k in keys],
            "_prefix",
            (F.col("_quota") - F.col("_upto") + F.col("_rows")).alias("_needed"),
        )
    )
    at_prefix = df.select(*keys, draw, tie, prefix.alias("_prefix"))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys]
    ranked = (
        at_prefix.alias("r")
        .join(cut_prefix.alias("p"), [*same, F.col("r._prefix") == F.col("p._prefix")])
        .select(*[F.col(f"r.{k}").alias(k) for k in keys], draw, tie, "_needed")
    )
    place = Window.partitionBy(*keys).orderBy(draw, tie)
    cut = (
        ranked.withColumn("_place", F.row_number().over(place))
        .filter(F.col("_place") == F.col("_needed"))
        .select(*keys, F.struct(F.col(draw).alias("d"), F.col(tie).alias("t")).alias("_cut"))
    )
    # The cut of a group travels to the rows beside a salt: a group of any size is
    # spread over tasks, and nothing is sorted or sent by the group alone.
    spread = F.pmod(F.xxhash64(draw, tie), F.lit(_SALTS)).cast("int")
    cuts = cut.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    joined = df.withColumn("_salt", spread).alias("r").join(
        cuts.alias("k"),
        [F.col("r._salt") == F.col("k._salt"), *[F.col(f"r.{k}").eqNullSafe(F.col(f"k.{k}")) for k in keys]],
        "left",
    )
    below = F.struct(F.col(f"r.{draw}").alias("d"), F.col(f"r.{tie}").alias("t")) <= F.col("k._cut")
    return joined.select(*[F.col(f"r.{c}") for c in df.columns], F.coalesce(below, F.lit(False)).alias(flag))

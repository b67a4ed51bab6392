"""Named entities as lexical features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The entity labels that are used as features.
ALLOWED_LABELS = ["PERSON", "ORG", "WORK_OF_ART", "PRODUCT", "EVENT"]


def entity_features(entities: DataFrame, doc_id: str = "review_id", out: str = "ner_text") -> DataFrame:
    """``ENTLBL_x ENTTXT_y`` per distinct entity of a review, in reading order.

    Repeats are removed by a partial minimum before anything is gathered, so a
    review with many mentions brings each entity together once.
    """
    token = F.replace(F.trim("value"), F.lit(" "), F.lit("_"))
    first = (
        entities.filter(F.col("label").isin(ALLOWED_LABELS))
        .select(doc_id, "label", F.lower(token).alias("_token"), "pos")
        .filter(F.col("_token") != "")
        .groupBy(doc_id, "label", "_token")
        .agg(F.min("pos").alias("pos"))
    )
    pair = F.concat(F.lit("ENTLBL_"), F.col("label"), F.lit(" ENTTXT_"), F.col("_token"))
    return (
        first.groupBy(doc_id)
        .agg(F.array_sort(F.collect_list(F.struct("pos", "label", pair.alias("pair")))).alias("_list"))
        .select(doc_id, F.array_join(F.col("_list.pair"), " ").alias(out))
    )


def augment_text(
    df: DataFrame,
    features: DataFrame,
    text: str = "preprocessed_text",
    out: str = "augmented_text",
    doc_id: str = "review_id",
) -> DataFrame:
    """Text and entity features around a separator; no entities give blank."""
    joined = df.join(features, doc_id, "left").withColumn("ner_text", F.coalesce("ner_text", F.lit("")))
    both = F.concat(F.coalesce(F.col(text), F.lit("")), F.lit(" [SEP] "), F.col("ner_text"))
    return joined.withColumn(out, F.trim(both))

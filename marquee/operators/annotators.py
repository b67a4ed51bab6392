"""Several people's labels for the same reviews."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import labels as lb

_KEYS = ("review_id", "movie_id")
_TEXTS = ("summary", "content")
_LABELS = ("subjective_label", "polarity_label")


def merge_annotators(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Inner join on the keys all tables share; labels get the annotator's name.

    Texts come from the first table, a column ``notes`` (any case) is dropped,
    and an objective review counts as neutral.
    """
    cleaned = {who: df.drop(*[c for c in df.columns if c.lower() == "notes"]) for who, df in tables.items()}
    keys = [k for k in _KEYS if all(k in df.columns for df in cleaned.values())]
    if not keys:
        raise ValueError("the annotator tables share no key column")
    texts = [c for c in _TEXTS if all(c in df.columns for df in cleaned.values())]

    parts = []
    for place, (who, df) in enumerate(cleaned.items()):
        own = [c for c in _LABELS if c in df.columns]
        if len(own) == len(_LABELS):
            neutral = lb.objective_is_neutral(F.col("subjective_label"), F.col("polarity_label"))
            df = df.withColumn("polarity_label", neutral)
        part = df.select(*keys, *(texts if place == 0 else []), *own)
        parts.append(part.withColumnsRenamed({c: f"{c}_{who}" for c in own}))
    return reduce(lambda left, right: left.join(right, keys), parts)


def label_columns(df: DataFrame, kind: str) -> list[str]:
    return [c for c in df.columns if c.startswith(f"{kind}_label_")]


def normalize_labels(df: DataFrame) -> DataFrame:
    """Every annotator's labels in their fixed set of values, or null."""
    polarity = {c: lb.normalize_polarity(F.col(c)) for c in label_columns(df, "polarity")}
    subjectivity = {c: lb.normalize_subjectivity(F.col(c)) for c in label_columns(df, "subjective")}
    return df.withColumns({**polarity, **subjectivity})


def label_distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(label, one count column per annotator); a null label is a row too."""
    long = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("who"), F.col(c).alias("label")) for c in columns]))
    )
    per_annotator = [F.count_if(F.col("who") == c).alias(c) for c in columns]
    return long.groupBy("label").agg(*per_annotator)


def fleiss_kappa(
    df: DataFrame,
    columns: Sequence[str],
    categories: Sequence[str],
    threshold: float = 0.80,
) -> DataFrame:
    """Fleiss' kappa over the rows that every annotator put in ``categories``.

    One output row: rows used, the share of each category, observed and
    expected agreement, kappa (null where agreement by chance is certain) and
    the threshold check.  The job fails when no row can be used.  Counting is
    per row; only a handful of sums leaves each task.
    """
    n = len(columns)
    usable = reduce(lambda a, b: a & b, [F.coalesce(F.col(c).isin(list(categories)), F.lit(False)) for c in columns])

    def votes(category: str) -> Column:
        return reduce(lambda a, b: a + b, [F.when(F.col(c) == category, 1).otherwise(0) for c in columns])

    counted = df.filter(usable).select(*[votes(c).alias(f"_v{i}") for i, c in enumerate(categories)])
    squares = reduce(lambda a, b: a + b, [F.col(f"_v{i}") * F.col(f"_v{i}") for i in range(len(categories))])
    sums = counted.agg(
        F.count(F.lit(1)).alias("rows_used"),
        *[F.sum(f"_v{i}").alias(f"_s{i}") for i in range(len(categories))],
        F.sum(squares).alias("_squares"),
    )
    rows = F.col("rows_used")
    has_rows = F.when(rows == 0, F.raise_error(F.lit("no complete rows with labels in the expected categories")).cast("boolean"))
    shares = {f"share_{c.lower()}": F.col(f"_s{i}") / (rows * n) for i, c in enumerate(categories)}
    expected = reduce(lambda a, b: a + b, [F.col(s) * F.col(s) for s in shares])
    observed = (F.col("_squares") - rows * n) / (rows * n * (n - 1))
    kappa = F.when(
        F.abs(1 - F.col("expected_agreement")) > 1e-8,
        (F.col("observed_agreement") - F.col("expected_agreement")) / (1 - F.col("expected_agreement")),
    )
    status = (
        F.when(F.col("fleiss_kappa").isNull(), "UNDEFINED")
        .when(F.col("fleiss_kappa") >= threshold, "PASS")
        .otherwise(F.format_string("BELOW %.2f", F.lit(threshold)))
    )
    return (
        sums.filter(F.coalesce(has_rows, F.lit(True)))
        .withColumns(shares)
        .withColumns({"expected_agreement": expected, "observed_agreement": observed})
        .withColumn("fleiss_kappa", kappa)
        .withColumn("status", status)
        .select(
            "rows_used",
            F.lit(n).alias("annotators"),
            *shares,
            "observed_agreement",
            "expected_agreement",
            "fleiss_kappa",
            "status",
        )
    )


def majority_label(columns: Sequence[str]) -> Column:
    """The most frequent non-null label of a row; a tie goes to the first annotator."""
    given = F.filter(F.array(*columns), lambda x: x.isNotNull())
    scored = F.transform(
        given,
        lambda label, place: F.struct(
            F.size(F.filter(given, lambda other: other == label)).alias("votes"),
            (-place).alias("place"),
            label.alias("label"),
        ),
    )
    return F.array_max(scored)["label"]


def majority_vote(df: DataFrame) -> DataFrame:
    """The evaluation set: keys, texts and the voted labels.

    One vote is enough when the others are missing; a row without any polarity
    is dropped.
    """
    polarity, subjectivity = label_columns(df, "polarity"), label_columns(df, "subjective")
    kept = [c for c in (*_KEYS, *_TEXTS) if c in df.columns]
    voted = [majority_label(polarity).alias("ground_truth_polarity")]
    if subjectivity:
        voted.insert(0, majority_label(subjectivity).alias("ground_truth_subjectivity"))
    return df.select(*kept, *voted).filter(F.col("ground_truth_polarity").isNotNull())

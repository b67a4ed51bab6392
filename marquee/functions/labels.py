"""Label texts and numbers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

POSITIVE, NEGATIVE, NEUTRAL = "POSITIVE", "NEGATIVE", "NEUTRAL"


def label_text(label: Column) -> Column:
    """Trimmed upper case; the texts that stand for a missing value become blank."""
    text = F.upper(F.trim(label.cast("string")))
    return F.when(text.isin("NAN", "NONE"), "").otherwise(F.coalesce(text, F.lit("")))


def normalize_polarity(label: Column) -> Column:
    """One of the three known polarities, or null."""
    text = label_text(label)
    return F.when(text.isin(POSITIVE, NEGATIVE, NEUTRAL), text)


def normalize_subjectivity(label: Column) -> Column:
    """SUBJECTIVE, or NEUTRAL for an objective review, or null."""
    text = label_text(label)
    return F.when(text == "SUBJECTIVE", text).when(text == "OBJECTIVE", NEUTRAL)


def polarity_number(label: Column) -> Column:
    """1 positive, 0 negative, 2 neutral, null for anything else."""
    text = label_text(label)
    return F.when(text == POSITIVE, 1).when(text == NEGATIVE, 0).when(text == NEUTRAL, 2).cast("int")


def polarity_label(number: Column) -> Column:
    return F.when(number == 1, POSITIVE).when(number == 0, NEGATIVE)


def objective_is_neutral(subjectivity: Column, polarity: Column) -> Column:
    """An objective review has no polarity of its own."""
    objective = F.lower(F.trim(subjectivity.cast("string"))) == "objective"
    return F.when(F.coalesce(objective, F.lit(False)), F.lit("neutral")).otherwise(polarity)


def irony_flag(label: Column) -> Column:
    """1.0 for an irony label of any case, else 0.0 (also when missing)."""
    return F.when(F.lower(label) == "irony", 1.0).otherwise(0.0)

"""Summaries that analyses of feature tables use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import tables


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Counts by label and prediction, in long form."""
    return df.groupBy(label, prediction).agg(F.count("*").alias("n"))


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: accuracy and misclassification rate."""
    right = F.avg((F.col(label) == F.col(prediction)).cast("double"))
    return df.agg(right.alias("accuracy"), (1 - right).alias("misclassified"))


def correlation_ranking(rows: DataFrame, target: str = "target") -> DataFrame:
    """Features (feature, value, target) by absolute correlation with the target."""
    ranked = rows.groupBy("feature").agg(F.abs(F.corr("value", target)).alias("correlation"))
    return tables.numbered(ranked, [F.desc_nulls_last("correlation"), "feature"], "rank", 1)


def without_duplicate_features(rows: DataFrame) -> DataFrame:
    """Rows (row, feature, value) without features whose values equal those of a feature of smaller name.

    A feature is known by a 128-bit hash of its values, summed over rows in any order, so nothing is gathered by feature.
    """
    value = F.coalesce(F.col("value").cast("string"), F.lit("null"))
    marks = [F.sum(F.xxhash64(F.lit(i), F.col("row"), value).cast("decimal(38,0)")).alias(f"h{i}") for i in (1, 2)]
    kept = rows.groupBy("feature").agg(*marks).groupBy("h1", "h2").agg(F.min("feature").alias("feature")).select("feature")
    return rows.join(kept, "feature", "left_semi")


def labels(df: DataFrame, name: str = "Physical Sample Name", notes: str = "Sample Notes") -> DataFrame:
    """``df`` with labels told from a sample's name and notes: quality, run_date, doping and miscut (first match stands).

    The run's date is what precedes the name's first hyphen; null where it is no date.
    """
    n, t = F.col(name), F.col(notes)
    first = F.trim(F.split(n, "-")[0])
    dates = [F.try_to_timestamp(first, F.lit(f)) for f in ("yyyyMMdd", "yyMMdd", "M/d/yyyy")]
    return df.withColumns({
        "quality": F.when(t.contains("Quality: Textured"), "textured").otherwise("good"),
        "run_date": F.coalesce(*dates, first.try_cast("timestamp")).cast("date"),
        "doping": F.when(n.contains("-V-"), "V").when(n.contains("-N2-"), "N2").otherwise("none"),
        "miscut": F.when(t.contains("0.2deg"), "0.2").when(n.contains("0.5deg"), "0.5").otherwise("none"),
    })


def clip_unit(column: str):
    return F.greatest(F.least(F.col(column), F.lit(1.0)), F.lit(0.0))


def r_squared(df: DataFrame, label: str, prediction: str) -> DataFrame:
    mean = df.agg(F.avg(label).alias("_m"))
    parts = df.join(F.broadcast(mean)).agg(F.sum((F.col(label) - F.col(prediction)) ** 2).alias("rest"), F.sum((F.col(label) - F.col("_m")) ** 2).alias("all"))
    return parts.select((1 - F.try_divide("rest", "all")).alias("r2"))

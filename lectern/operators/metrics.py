"""Accuracy and stage counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def accuracy_summary(results: DataFrame, correct: str = "is_correct") -> DataFrame:
    """Total, correct and accuracy in percent; 0 when there is no result."""
    total, right = F.count(F.lit(1)), F.count_if(correct)
    accuracy = F.when(total > 0, right / total * 100).otherwise(F.lit(0.0))
    return results.agg(total.alias("total"), right.alias("correct"), accuracy.alias("accuracy"))


def accuracy_text(accuracy: Column) -> Column:
    """Two decimals and a percent sign; a half that is exact in binary goes to even."""
    return F.concat(F.format_number(accuracy, 2), F.lit("%"))


def stage_funnel(**stages: DataFrame) -> DataFrame:
    """One row per stage with its number of rows, in the given order."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(place).alias("stage_pos"), F.lit(name).alias("stage"), "rows"
        )
        for place, (name, df) in enumerate(stages.items())
    ]
    return reduce(DataFrame.unionByName, counts)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while another action, such as a write, runs over them."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen

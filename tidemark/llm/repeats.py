"""Rows that stand for several equal ones: counted before a shuffle, written out again at the end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shipping import shipped

shipped(__name__)

RUN = 4096  # rows that one row is written out to in one step


def written_out(rows: DataFrame, count: Column, place: str = "copy") -> DataFrame:
    """Every row `count` times, numbered from 0 in `place`; a row that stands for very many is dealt to all tasks first."""
    runs = rows.withColumn("_runs", F.ceil(count / F.lit(RUN)).cast("long")).withColumn("_left", count.cast("long"))
    few = runs.where("_runs <= 1").withColumn("_run", F.lit(0).cast("long"))
    many = runs.where("_runs > 1").withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_runs") - 1)))
    dealt = few.unionByName(many.repartition("_run"))
    first = F.col("_run") * RUN
    last = F.least(first + RUN, F.col("_left")) - 1
    return dealt.where("_left > 0").withColumn(place, F.explode(F.sequence(first, last))).drop("_run", "_runs", "_left")

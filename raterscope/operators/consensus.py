"""Strict-majority consensus of multi-reviewed labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raterscope.functions.clean import once
from raterscope.operators.skew import lookup

ANSWER_KEY = ["reporting_week", "project_id", "job_id", "parent_label"]


def votes(rows: DataFrame) -> DataFrame:
    """Votes per answer of one job and label."""
    return rows.groupBy(*ANSWER_KEY, "rater_response").agg(F.count("*").alias("response_count"))


def vote_counts(rows: DataFrame) -> DataFrame:
    """Votes per answer beside the total number of votes."""
    per_answer = votes(rows)
    totals = per_answer.groupBy(*ANSWER_KEY).agg(
        F.sum("response_count").alias("total_responses_count"),
        F.count("*").alias("_answers"),
    )
    return lookup(per_answer, totals, ANSWER_KEY, "_answers", ["rater_response"]).drop("_answers")


def majority_answers(rows: DataFrame) -> DataFrame:
    """One row per job and label: vote total and the answer more than half agree on.

    A single vote, a tie and a null winner leave the answer null. Only the strict winner
    is kept, so the pick among tied answers never shows.
    """
    best = votes(rows).groupBy(*ANSWER_KEY).agg(
        F.sum("response_count").alias("_votes"),
        F.max("response_count").alias("_top"),
        F.max_by("rater_response", "response_count").alias("_answer"),
    )
    # out of a generator, so that a plan which takes the totals alone reuses the shuffle of all three
    made = {"votes": F.col("_votes"), "_top": F.col("_top"), "_answer": F.col("_answer")}
    best = once(best, made).drop("_votes")
    decided = (F.col("votes") >= 2) & (F.col("_top") * 2 > F.col("votes"))
    return best.select(
        *ANSWER_KEY, "votes", F.when(decided, F.col("_answer")).alias("consensus_response")
    )


def with_consensus(rows: DataFrame, rows_per_slice: int | None = None) -> DataFrame:
    """Add the consensus answer, whether there is one, and whether the row agrees.

    Votes are counted with map-side aggregation and joined back through `lookup`, so a
    job that collects a third of all votes is cut into slices instead of landing in one
    window partition.
    """
    answers = majority_answers(rows)
    # only decided answers travel; every job counts for the slices
    decided = answers.where(F.col("consensus_response").isNotNull())
    joined = lookup(
        rows, decided, ANSWER_KEY, "votes", ["rater_id"], rows_per_slice=rows_per_slice, sizes=answers
    ).drop("votes")
    answer = F.col("consensus_response")
    agrees = F.coalesce(F.col("rater_response") == answer, F.lit(False))
    return joined.withColumn("is_determined", answer.isNotNull().cast("int")).withColumn(
        "is_agreeing", F.when(answer.isNotNull(), agrees.cast("int"))
    )

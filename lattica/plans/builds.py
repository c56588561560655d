"""Plans from the raw shapes of result dumps to the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scoring
from ..operators import joins, reshape
from .longform import Star, finalize


def judged_turns(judgments: DataFrame, questions: DataFrame, benchmark_id: str) -> Star:
    """Judged answers, a line each (file, pos, model, question_id, turn, score, judgment), to questions with their turns (question_id, turns).

    An item is a turn. The score is the number given, or the one that the
    judgment names; lines with neither are dropped. A question that is not
    listed leaves the item without content. Lines that repeat a cell are trials in input order.
    """
    asked = reshape.turns_to_rows(questions, "turns").select("question_id", "turn", "text")
    rows = joins.lookup(judgments, asked, ["question_id", "turn"])
    rows = rows.select(
        F.lit(benchmark_id).alias("benchmark_id"), F.col("model").alias("label"), F.concat_ws("_", "question_id", "turn").alias("raw_item_id"),
        F.col("text").alias("content"), scoring.judge_score("score", "judgment").alias("response"), "file", "pos",
    )
    return finalize(rows.where("response is not null"), ["file", "pos"])


def positional_results(files: DataFrame, reference: DataFrame, benchmark_id: str) -> Star:
    """Files of results by position (label, results, subset) against one reference row (results, subset, ids, contents).

    Files of another length, or with other subsets, are dropped whole.
    """
    good = joins.validated(files, reference, "results", "subset")
    rows = joins.positional(good.drop("subset"), reference.drop("results"), "results", ["ids", "contents", "subset"])
    rows = rows.select(F.lit(benchmark_id).alias("benchmark_id"), "label", F.col("ids").alias("raw_item_id"), F.col("contents").alias("content"), F.concat(F.lit("subset="), F.col("subset")).alias("test_condition"), F.col("value").cast("double").alias("response"), "pos")
    return finalize(rows, ["label", "pos"])


def resolved_grid(files: DataFrame, benchmark_id: str) -> Star:
    """One object a file and subject (label, value: map to lists of item names, of which "resolved" counts): every subject with every item that any list names."""
    tasks = reshape.list_union(files, "value", "task")
    done = files.select("label", F.explode(F.try_element_at("value", F.lit("resolved"))).alias("task"))
    grid = joins.flagged(joins.dense_grid(files.select("label").distinct(), tasks), done, ["label", "task"], present=1.0)
    rows = grid.select(F.lit(benchmark_id).alias("benchmark_id"), "label", F.col("task").alias("raw_item_id"), F.lit(None).cast("string").alias("content"), "response")
    return finalize(rows, ["label", "raw_item_id"])

"""Table work around text-model sessions: history trimming, usage and safety roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.skew import nest_groups, newest_within_budget

# Fixed value: the documented rule of thumb for the length of one token.
CHARACTERS_PER_TOKEN = 4


def estimated_tokens(text: Column) -> Column:
    return F.ceil(F.length(text) / CHARACTERS_PER_TOKEN).cast("bigint")


def trim_history(turns: DataFrame, budget: int) -> DataFrame:
    """The newest turns of each conversation that fit the budget; older ones are dropped."""
    return newest_within_budget(turns, ["conv_id"], "turn", estimated_tokens(F.col("text")), budget)


def usage(turns: DataFrame, keys: list[str]) -> DataFrame:
    """Prompt, candidate and total tokens and bytes, summed per session."""
    tokens = estimated_tokens(F.col("text"))
    answered = F.col("role") == "assistant"
    return turns.groupBy(*keys).agg(
        F.sum(F.when(~answered, tokens).otherwise(0)).cast("bigint").alias("prompt_tokens"),
        F.sum(F.when(answered, tokens).otherwise(0)).cast("bigint").alias("candidate_tokens"),
        F.sum(tokens).cast("bigint").alias("total_tokens"),
        F.sum(F.octet_length("text")).cast("bigint").alias("serialized_bytes"))


def safety(ratings: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per rated item: scores and categories in category order, blocked if any rating is.

    An item with very many ratings comes in parts; ``blocked`` always covers all of them.
    """
    listed = nest_groups(ratings, [key], ["category", "score"], ["category", "score"], "_r")
    blocked = ratings.groupBy(key).agg(F.bool_or("blocked").alias("blocked"))
    return listed.join(blocked, key).select(
        key, "part", F.col("_r.score").alias("scores"),
        F.col("_r.category").alias("categories"), "blocked")

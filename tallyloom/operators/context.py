"""From ranked hits to the context, the prompt and the answer of each question."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.models import MAX_ANSWER_TOKENS, ExtractiveAnswer, Generator, generate

NOTHING_FOUND = "No relevant passages found in the indexed documents."
INSTRUCTION = (
    "Use only the context to answer the question. Say you do not know when the context has no answer. "
    "Name the source file and page of every fact."
)


def assemble_context(hits: DataFrame, queries: DataFrame, with_relevance: bool = False,
                     query_id: str = "query_id") -> DataFrame:
    """(query_id, context): the hits of each question in rank order under a line that names
    file and page, or a fixed message. A question has at most k hits, which bounds the list."""
    where = F.concat(F.lit("["), F.col("source_file"), F.lit(", page "), F.col("page_number").cast("string"))
    if with_relevance:
        where = F.concat(where, F.lit(", relevance "), F.format_string("%.2f", F.col("score")))
    passage = F.concat(where, F.lit("]\n"), F.col("content"))
    listed = hits.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", passage.alias("passage")))).alias("hits"))
    asked = queries.select(F.col(query_id).alias("query_id"))
    joined = F.concat_ws("\n\n", F.transform("hits", lambda h: h["passage"]))
    return asked.join(listed, "query_id", "left").select(
        "query_id", F.when(F.col("hits").isNull(), NOTHING_FOUND).otherwise(joined).alias("context"))


def prompt_rows(contexts: DataFrame, questions: DataFrame, question: str = "text", query_id: str = "query_id",
                instruction: str = INSTRUCTION) -> DataFrame:
    """(query_id, question, messages): the system and the user message per question."""
    def message(role: str, content):
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    asked = questions.select(F.col(query_id).alias("query_id"), F.col(question).alias("question"))
    user = F.concat(F.lit("Context:\n"), F.col("context"), F.lit("\n\nQuestion: "), F.col("question"))
    return contexts.join(asked, "query_id").select(
        "query_id", "question", F.array(message("system", F.lit(instruction)), message("user", user)).alias("messages"))


def answer(prompts: DataFrame, make_generator: Callable[[], Generator] = ExtractiveAnswer,
           max_tokens: int = MAX_ANSWER_TOKENS) -> DataFrame:
    return prompts.select(
        "query_id", "question", generate(F.col("messages"), make_generator, max_tokens).alias("answer"))

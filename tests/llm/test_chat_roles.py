"""Roles recovered from transcripts: against all sequences of roles, and with the role column hidden."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import chat_format as chat

CONVERSATIONS = "/root/testdata/sf0.01/conversations.parquet"


def likelihood(lines, roles):
    """Log-likelihood of a sequence of roles, by the model's definition."""
    total = chat.FIRST[roles[0]]
    for k, ((begins, seen), role) in enumerate(zip(lines, roles, strict=True)):
        if k:
            total += (chat.NEXT if begins else chat.WITHIN)[roles[k - 1]][role]
        total += seen[role]
    return total


def test_viterbi_finds_the_likeliest_of_all_sequences():
    rng = np.random.default_rng(8)
    texts = ["Human: hi?", "so", "AI: yes", "x" * 400, "why?", "**User:** ok", "System: be kind"]
    for _ in range(60):
        messages = [(rng.choice(["user", "assistant", "?", None]), "\n".join(rng.choice(texts, rng.integers(1, 4)))) for _ in range(rng.integers(1, 4))]
        lines = [line for role, text in messages for line in chat.read_lines(role, text)[1]][:7]
        best = max(itertools.product(range(3), repeat=len(lines)), key=lambda roles: likelihood(lines, roles))
        assert math.isclose(likelihood(lines, chat.viterbi(lines)), likelihood(lines, best))


@pytest.mark.parametrize("form", ["column hidden", "one transcript"])
def test_hidden_roles_are_recovered(spark, form):
    """Without the column only order, questions and lengths tell roles; with markers in one text they are read."""
    turns = spark.read.parquet(CONVERSATIONS)
    names = F.when(F.col("role") == "assistant", "AI").when(F.col("role") == "system", "System").otherwise("Human")
    if form == "column hidden":
        shown = chat.format_chats(turns.withColumn("role", F.lit(None).cast("string")))
        found = shown.select("conv_id", "turn", F.col("role").alias("found"))
        right = turns.join(found, ["conv_id", "turn"]).agg(F.avg((F.col("role") == F.col("found")).cast("double"))).first()[0]
        assert right > 0.75
    else:
        lines = F.concat(names, F.lit(": "), F.regexp_replace("text", "\n", " "))
        whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", lines.alias("line"), "role"))).alias("all"))
        whole = whole.select("conv_id", F.lit(0).alias("turn"), F.lit(None).cast("string").alias("role"), F.array_join("all.line", "\n").alias("text"), "all.role").toDF(
            "conv_id", "turn", "role", "text", "truth"
        )
        got = {r["conv_id"]: r["rendered"] for r in chat.format_chats(whole).collect()}
        for r in whole.collect():
            assert [x[2:-2] for x in got[r["conv_id"]].split("\n") if x.startswith("<|")] == r["truth"]

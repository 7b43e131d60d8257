"""License scans by diagonal voting over word 3-grams."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.llm.tables import text_or_empty

#: Words in a gram; the shortest phrase has as many.
GRAM = 3
#: The letters that are read as small ones; others are taken as they are.
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Everything that is neither a digit, a Latin letter nor outside ASCII separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Diagonals of one template so near to each other belong to one span, as words were put in or left out: so many words, or
#: this share of the template's if that is more.
NEAR, NEAR_SHARE = 3, 0.25
#: Columns that a text and a template bring along.
TEXT = ["id", "row", "n_words"]
TEMPLATE = ["template", "label", "base", "n_grams", "near"]
#: Share of a template's grams that a span must hold for the template's label.
ENOUGH = 0.5

#: Phrases that name a license wherever their words stand one after the other.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Passages of public license texts, in words as the scan reads them.
TEMPLATES = {
    "mit": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    ],
    "apache-2": [
        "licensed under the apache license version 2 0",
        "unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
    ],
    "isc": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "gpl": [
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
        "the free software foundation",
    ],
    "mpl-2": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "cc-by-nc": ["licensed under a creative commons attribution noncommercial 4 0 international license"],
    "cc-by": ["licensed under a creative commons attribution 4 0 international license"],
    "proprietary": ["all rights reserved no part of this publication may be reproduced"],
}


#: Stands for "no gram" in the join.
NO_GRAM = -1


def texts_of(phrases: Mapping[str, str], templates: Mapping[str, list[str]]) -> list[tuple[list[str], str, bool]]:
    """(words, label, is it a phrase?) of all texts to look for; a template's number is its place here."""
    texts = [(text.split(), label, True) for text, label in phrases.items()]
    return texts + [(text.split(), label, False) for label, many in templates.items() for text in many]


def near_of(n_grams: int) -> int:
    return max(NEAR, int(n_grams * NEAR_SHARE))


def demands(texts: list[tuple[list[str], str, bool]]) -> list[tuple[list[int], list[list[int]]]]:
    """What a span of each template must hold besides enough grams: (one of these grams, one of the grams of each list).

    Of a template that shares grams with one of another label, at least one gram that is its own: else it may be the other
    one. And of each word with a digit a gram around it: a version's number tells licenses apart.
    """
    grams = [{tuple(w[i : i + GRAM]): i for i in range(len(w) - GRAM + 1)} for w, _, _ in texts]
    out = []
    for k, (words, label, base) in enumerate(texts):
        others = {g for j, (_, other, phrase) in enumerate(texts) if other != label and not phrase for g in grams[j]}
        shared = others & grams[k].keys()
        own = sorted(i for g, i in grams[k].items() if g not in others) if shared and not base else []
        last = len(words) - GRAM
        numbers = [
            list(range(max(0, i - GRAM + 1), min(i, last) + 1)) for i, w in enumerate(words) if any(c.isdigit() for c in w) and not base
        ]
        out.append((own, numbers))
    return out


def template_grams(spark: SparkSession, phrases: Mapping[str, str], templates: Mapping[str, list[str]]) -> DataFrame:
    """(gram, template, at, label, base, n_grams, near): hashed grams of all templates and where they stand in them.

    It is as large as the templates' texts, which are parameters, and is broadcast. One row more, with NO_GRAM, keeps
    a row per text in the join.
    """
    texts = texts_of(phrases, templates)
    if any(len(words) < GRAM for words, _, _ in texts):
        raise ValueError(f"a template needs {GRAM} words at least")
    rows = [
        (words[at : at + GRAM], k, at, label, base, len(words) - GRAM + 1, near_of(len(words) - GRAM + 1))
        for k, (words, label, base) in enumerate(texts)
        for at in range(len(words) - GRAM + 1)
    ]
    kind = "words array<string>, template int, at int, label string, base boolean, n_grams int, near int"
    table = spark.createDataFrame([*rows, (None, -1, 0, None, False, 1, 0)], kind)
    return table.withColumn("gram", F.when(F.col("template") < 0, NO_GRAM).otherwise(_hash("words", F.lit(0)))).drop("words")


def _hash(words: str, at: Column) -> Column:
    return F.xxhash64(*[F.get(words, at + k) for k in range(GRAM)])


def word_grams(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row, n_words, position, gram): hash of each GRAM words in lower case, and NO_GRAM once for each text."""
    words = F.split(F.translate(text_or_empty(text_col), CAPITALS, CAPITALS.lower()), SEPARATORS)
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), words.alias("words"))
    # A separator at either end makes an empty piece.
    rows = rows.withColumn("words", F.array_remove("words", ""))
    last = F.greatest(F.size("words") - GRAM, F.lit(-1))
    gram = F.transform(
        F.sequence(F.lit(-1), last),
        lambda i: F.struct(i.alias("position"), F.when(i >= 0, _hash("words", i)).otherwise(NO_GRAM).alias("gram")),
    )
    rows = rows.select("id", "row", F.size("words").cast("long").alias("n_words"), F.explode(gram).alias("g"))
    return rows.select("id", "row", "n_words", "g.position", "g.gram")


def diagonals(grams: DataFrame, known: DataFrame) -> DataFrame:
    """Votes per text and diagonal of a template: which of the template's grams stand on it.

    A diagonal is a gram's position in the text less its position in the template.
    """
    hits = grams.join(F.broadcast(known), "gram")
    diagonal = (F.col("position") - F.col("at")).alias("diagonal")
    return hits.groupBy(*TEXT, *TEMPLATE, diagonal).agg(F.collect_set("at").alias("found"))


def spans(votes: DataFrame) -> DataFrame:
    """Neighbouring diagonals of a template as one span, with the share of the template's grams found in it.

    A diagonal at most ``near`` beyond the one before it joins its span, so what stands before and after words that
    were put in adds up. Phrases of the base must stand as they are, so their diagonals remain apart.
    """
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    beyond = F.col("diagonal") - F.lag("diagonal").over(order) > F.col("near")
    starts = F.when(F.col("base") | F.coalesce(beyond, F.lit(True)), 1).otherwise(0)
    numbered = votes.withColumn("starts", starts).withColumn("span", F.sum("starts").over(order))
    merged = numbered.groupBy(*TEXT, *TEMPLATE, "span").agg(
        F.min("diagonal").alias("start"), F.array_distinct(F.flatten(F.collect_list("found"))).alias("at")
    )
    merged = merged.withColumn("found", F.size("at"))
    return merged.withColumn("share", F.col("found") / F.col("n_grams"))


def meets(asked: list[tuple[list[int], list[list[int]]]]) -> Column:
    """Whether a span's grams meet what its template demands: a constant condition per template that demands something."""
    holds = F.lit(True)
    for k, (own, numbers) in enumerate(asked):
        wanted = [own, *numbers] if own else numbers
        if wanted:
            every = reduce(Column.__and__, [F.arrays_overlap("at", F.array(*map(F.lit, grams))) for grams in wanted])
            holds = F.when(F.col("template") == k, every).otherwise(holds)
    return holds


def scan_licenses(
    docs: DataFrame,
    phrases: Mapping[str, str] = BASE_PHRASES,
    templates: Mapping[str, list[str]] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id_col, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places of all phrases; first_word and last_word are the smallest and largest start of one (words
    from 0, null without a place). labels adds those of templates of which a span holds ENOUGH of the grams and what
    ``demands`` asks. score is the largest such share, 1 for a phrase. Null text counts as empty; without a word all counts are 0 and labels are
    empty strings. Rows with equal ids are scanned each for itself. Other columns are neither read nor returned.
    """
    known = template_grams(docs.sparkSession, phrases, templates)
    found = spans(diagonals(word_grams(docs, id_col, text_col), known))
    place = F.col("base") & (F.col("found") == F.col("n_grams"))
    asked = demands(texts_of(phrases, templates))
    found = found.withColumn("meets", meets(asked))
    verified = place | (~F.col("base") & F.col("label").isNotNull() & (F.col("share") >= ENOUGH) & F.col("meets"))
    joined = lambda which: F.array_join(F.sort_array(F.collect_set(F.when(which, F.col("label")))), ",")
    share = F.when(F.col("base"), place.cast("double")).when(F.col("label").isNotNull() & F.col("meets"), F.col("share"))
    return found.groupBy(*TEXT).agg(
        F.count_if(place).alias("n_base"),
        F.min(F.when(place, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(place, F.col("start"))).cast("long").alias("last_word"),
        joined(place).alias("base_labels"),
        joined(verified).alias("labels"),
        F.coalesce(F.max(share), F.lit(0.0)).alias("score"),
    ).select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")

"""Rows of the pipeline, stage by stage: each stage's output from its own input, recomputed in plain Python."""

import hashlib
import math
import re
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lotwise.llm import toxicity
from lotwise.llm.queries import DEFAULT_WEIGHT, SEED, WEIGHTS

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of each stage by name."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name.replace(" ", "-"))
        stage(spark, docs, SMALL).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = docs, after
        docs = after
    return out


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_toxicity(spark, stages):
    before, after = stages["toxicity"]
    model = toxicity.learn_toxicity(before, spark.read.parquet(f"{SMALL}/labels.parquet"))
    everything = rows(before)
    score = model.score(pa.array([r[1] or "" for r in everything]))
    kept = [r for r, s in zip(everything, score, strict=True) if s < toxicity.REJECT]
    assert rows(after) == kept
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    assert not [r[0] for r in everything if toxic.get(r[0]) == 0 and r not in kept]


def test_exact_dedup(stages):
    before, after = stages["exact dedup"]
    first = {}
    for r in rows(before):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or ""), r)
    assert rows(after) == sorted(first.values())


def weights(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])
    return {g: 1 + math.log(n) for g, n in Counter(grams).items()}


def similar(x, y):
    """Probability Jaccard of two weighted sets, by its definition."""
    both = x.keys() & y.keys()
    if len(both) < 0.3 * min(len(x), len(y)):
        return 0.0  # far below; spares the sums
    keys = x.keys() | y.keys()
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in keys) for i in both)


def test_near_dedup(stages):
    before, after = stages["near dedup"]
    everything = rows(before)
    bags, label = [weights(r[1]) for r in everything], list(range(len(everything)))
    holders = {}
    for i, bag in enumerate(bags):
        for g in bag:
            holders.setdefault(g, []).append(i)
    pairs = {(i, j) for held in holders.values() for j in held for i in held if i < j}
    for i, j in pairs:
        if label[i] != label[j] and similar(bags[i], bags[j]) >= 0.8:
            lo, hi = sorted((label[i], label[j]))
            label = [lo if x == hi else x for x in label]
    assert rows(after) == [r for i, r in enumerate(everything) if label[i] == i]
    assert len(rows(after)) < len(everything)


def poisson(rate, uniform):
    n, below, log_fact = 0, math.exp(-rate), 0.0
    while below <= uniform:
        n += 1
        log_fact += math.log(n)
        below += math.exp(n * math.log(rate) - rate - log_fact)
    return n


def test_source_mixing(stages):
    before, after = stages["source mixing"]
    everything = rows(before)
    held = Counter(r[3] for r in everything)
    total = sum(WEIGHTS.get(s, DEFAULT_WEIGHT) for s in held)
    want = []
    for r in everything:
        rate = WEIGHTS.get(r[3], DEFAULT_WEIGHT) / total * len(everything) / held[r[3]]
        uniform = int(hashlib.md5(f"{SEED}:{r[0]}".encode()).hexdigest()[:13], 16) / 16**13
        want += [r] * poisson(rate, uniform)
    assert rows(after) == sorted(want)


def test_bpe(stages):
    before, after = stages["bpe"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in rows(before):
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], len(ids), " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(tuple, after.collect())) == sorted(want)


def test_run_gives_the_rows_of_the_last_stage(spark, stages):
    _, after = stages["bpe"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(tuple, after.collect()))

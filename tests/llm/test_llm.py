"""The text operators against brute force, exact round trips, held-out accuracy, and awkward inputs."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lotwise.llm import bpe, chat_format, exact_dedup, license_scan, mixing, near_dedup, oracle, queries
from lotwise.llm import quality_rules, rule_ensemble, statistics, substring_dedup, toxicity
from lotwise.llm.components import components
from lotwise.llm.words import Words

SMALL = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, lang string, source string, n_chars long, copies long, row long, slot long, label string"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
BASE = " ".join(f"word{i}" for i in range(120))


def near(k: int) -> str:
    words = BASE.split()
    words[k] = f"other{k}"
    return " ".join(words)


ROWS = [
    (1, "same  text\nhere", "en", "a"),
    (2, "same text here", "en", "a"),
    (2, "same text here", "en", "a"),
    (None, "same text here", None, None),
    (3, None, "en", "b"),
    (4, "", "en", "b"),
    (5, LONG, "de", "a"),
    (6, BASE, "en", "a"),
    (7, near(3), "en", "a"),
    (8, near(90), "en", "c"),
    (9, "Released under the MIT License. under the mit license", "en", "c"),
    (10, "!!! ### ÉÉÉ ñ 123 <|endoftext|> it's", "es", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 0, 1, 2, 3, "x") for r in ROWS], KIND)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KIND)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (6, 1, 1), (9, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")


def by_id(df):
    found = {}
    for r in df.collect():
        found.setdefault(r["doc_id"], []).append(r)
    return found


def test_exact_groups(docs, empty):
    got = by_id(exact_dedup.exact_groups(docs))
    assert sum(map(len, got.values())) == len(ROWS)
    assert {r["keep_id"] for k in (1, 2, None) for r in got[k]} == {1}
    assert got[1][0]["group_size"] == 4 and got[1][0]["kept"] and not any(r["kept"] for r in got[2] + got[None])
    assert (got[3][0]["keep_id"], got[4][0]["keep_id"], got[4][0]["kept"]) == (3, 3, False)
    assert got[6][0]["text_sha256"] == hashlib.sha256(BASE.encode()).hexdigest()
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 5, 6, 7, 8, 9, 10]
    assert exact_dedup.exact_groups(empty).count() == exact_dedup.drop_exact_copies(empty).count() == 0


def test_repeated_row_stays_once(spark):
    rows = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "c")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in exact_dedup.drop_exact_copies(rows).collect()) == [1, 2]
    assert sorted(r["doc_id"] for r in near_dedup.drop_near_copies(rows).collect()) == [1, 2]


def test_license_scan(docs, empty):
    got = by_id(license_scan.scan_licenses(docs))
    assert sum(map(len, got.values())) == len(ROWS)
    r = got[9][0]
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (9, 2, 1, 5)
    assert (r["base_labels"], r["labels"], r["score"]) == ("mit", "mit", 1.0)
    assert (got[3][0]["n_words"], got[3][0]["labels"], got[3][0]["first_word"]) == (0, "", None)
    assert got[5][0]["n_words"] == 20_000 and license_scan.scan_licenses(empty).count() == 0


def test_license_text_with_changes_is_found(spark):
    words = license_scan.TEMPLATES["mit"][0].split()
    text = " ".join([*words[:12], "and", *words[12:30], *words[31:]])
    row = license_scan.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["labels"] == "mit" and row["base_labels"] == "" and 0.8 < row["score"] < 1


def test_licenses_are_told_apart(spark):
    """Near relatives, other versions, words put in, and letters outside ASCII."""
    mit = license_scan.TEMPLATES["mit"][0].split()
    texts = [
        "licensed under a creative commons attribution noncommercial 4 0 international license",
        "licensed under a creative commons attribution 4 0 international license",
        "licensed under the apache license version 1 1",
        "Licensed under the Apache License, Version 2.0",
        " ".join([*mit[:24], "and", "here", "five", "words", "more", *mit[24:]]),
        "UNDER THE MIT LİCENSE, under the mit licensÉ, UNDER THE MIT LICENSE",
    ]
    rows = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = {r["doc_id"]: (r["labels"], r["base_labels"], r["n_base"]) for r in rows}
    assert [found[k][0] for k in range(5)] == ["cc-by-nc", "cc-by", "", "apache-2", "mit"]
    assert found[3][1:] == ("apache-2", 1) and found[5] == ("mit", "mit", 1)


def test_mixing(spark, docs, empty):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "big").otherwise("small").alias("source"))
    mixed = mixing.mix_sources(rows, {"big": 1.0, "small": 3.0}, seed=5)
    n = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(n["big"] / sum(n.values()) - 0.25) < 0.03 and abs(sum(n.values()) - 6000) < 300
    again = mixing.mix_sources(rows.repartition(7), {"big": 1.0, "small": 3.0}, seed=5)
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, again.collect()))
    assert mixing.mix_sources(docs, {"a": 0.0}).filter("source = 'a'").count() == 0
    assert mixing.mix_sources(empty, {}).count() == 0


def test_poisson_of_large_mean(spark):
    numbers = spark.range(2000).select(mixing.copies_of(mixing.poisson_cdf(F.lit(900.0)), (F.col("id") + 0.5) / 2000).alias("n"))
    mean, deviation = numbers.agg(F.avg("n"), F.stddev("n")).first()
    assert abs(mean - 900) < 0.5 and abs(deviation - 30) < 0.5


def test_rates_of_rare_sources_stay_small(spark):
    """A source of two documents with a mean of 500 copies gets no distribution, and the same numbers as with one."""
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2, "rare").otherwise("hot").alias("source"))
    rates = mixing.source_rates(rows, {}, 1.0, None)
    assert rates.agg(F.sum(F.size("cdf"))).first()[0] < 120 and rates.agg(F.max("rate")).first()[0] == 500
    n = {r["doc_id"]: r["n"] for r in mixing.mix_sources(rows, {}, seed=3).filter("source = 'rare'").groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    uniform = mixing._hashed(F.lit(3), F.col("id")) / F.lit(float(16**mixing.DIGITS))
    want = spark.range(2).select("id", mixing.copies_of(mixing.poisson_cdf(F.lit(500.0)), uniform).alias("n"))
    assert n == {r["id"]: r["n"] for r in want.collect()}


def brute_windows(rows, size=substring_dedup.WINDOW):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    count = Counter(" ".join(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for (k, _), w in zip(rows, split, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if count[" ".join(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        out.append((k, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("name", ["small", "odd", "hot"])
def test_substring_dedup(spark, docs, name, monkeypatch):
    if name == "small":
        docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    elif name == "hot":
        # A phrase shorter than a window in all texts, with other words around it: one gram with very many pieces.
        monkeypatch.setattr(substring_dedup, "HEAVY_PIECES", 5)
        phrase = " ".join(f"p{i}" for i in range(25))
        texts = [" ".join(f"l{k}_{i}" for i in range(12)) + f" {phrase} " + " ".join(f"r{k}_{i}" for i in range(12)) for k in range(40)]
        texts += [texts[0], "same " * 80, f"{phrase} {phrase} {phrase}"]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted(map(tuple, substring_dedup.remove_repeated(docs).collect()), key=str)
    assert got == sorted(brute_windows(rows), key=str)


def test_pieces_in_one_automaton_do_not_grow_with_the_input(spark, monkeypatch):
    """Thousands of pieces, and many grams with a few more of them than HEAVY_PIECES."""
    monkeypatch.setattr(substring_dedup, "HEAVY_PIECES", 2)
    largest = []

    def spy(pieces, match=substring_dedup.match_pieces):
        largest.append(pieces.groupBy("shard").count().agg(F.max("count")).first()[0])
        return match(pieces)

    monkeypatch.setattr(substring_dedup, "match_pieces", spy)
    around = lambda side, p, k: " ".join(f"{side}{p}_{k}_{i}" for i in range(12))
    rows = [(p, k, " ".join(f"p{p}_{i}" for i in range(25))) for p in range(900) for k in range(3 + p % 7)]
    texts = [f"{around('l', p, k)} {phrase} {around('r', p, k)}" for p, k, phrase in rows]
    docs = spark.createDataFrame(list(enumerate(texts + texts[:9])), "doc_id long, text string")
    got = sorted(map(tuple, substring_dedup.remove_repeated(docs).collect()), key=str)
    assert got == sorted(brute_windows([tuple(r) for r in docs.collect()]), key=str)
    assert largest == [2]


def test_substring_dedup_of_nothing(empty):
    assert substring_dedup.removal_digests(empty).count() == 0


def brute_statistics(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    c = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    cover = {j for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover)


def test_statistics(spark, docs):
    texts = [r["text"] or "" for r in docs.union(docs.limit(0)).collect()] + ["a\nb\na\n \n \na", "x y\n" * 30]
    texts += [r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    found = statistics.measure(pa.array(texts))
    assert [tuple(int(found[c][i]) for c in statistics.COUNTS) for i in range(len(texts))] == list(map(brute_statistics, texts))


def test_quality_operators(docs, empty, labels):
    rules = rule_ensemble.learn_quality_rules(docs, labels)
    got = rule_ensemble.score_quality(docs, rules)
    assert got.count() == len(ROWS) and got.filter("score < 0 or score > 1 or score is null").count() == 0
    forest = quality_rules.learn_quality_trees(docs, labels)
    kept = by_id(quality_rules.apply_quality_rules(docs, forest))
    assert kept[3][0]["base_failed"] and not kept[3][0]["kept"] and not kept[6][0]["base_failed"]
    assert rule_ensemble.score_quality(empty, rules).count() == quality_rules.apply_quality_rules(empty, forest).count() == 0
    nothing = rule_ensemble.learn_quality_rules(empty, labels)
    assert rule_ensemble.score_quality(docs, nothing).select("score").distinct().collect()[0][0] == 0.5


def test_trees_are_monotonic():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 3))
    y = (x[:, 0] + rng.normal(0, 0.5, 2000) > 0.5).astype(float)
    forest = quality_rules.boosting.fit(x, y, {0: 1, 1: -1})
    for f, sign in ((0, 1), (1, -1)):
        grid = np.repeat(x[:50], 40, 0)
        grid[:, f] = np.tile(np.linspace(0, 1, 40), 50)
        assert (sign * np.diff(forest.raw(grid).reshape(50, 40), axis=1) >= -1e-9).all()


@pytest.mark.parametrize("name, label", [("op3_quality_rule_ensemble", "quality"), ("op10_toxicity", "toxic")])
def test_held_out_accuracy(spark, name, label):
    sf = "/root/testdata/sf0.01"
    found = queries.queries()[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out")
    right, n = found.agg(F.avg((F.col("predicted") == F.col(label)).cast("double")), F.count("*")).first()
    assert n > 80 and right > 0.93


def test_toxicity_awkward(docs, empty, labels):
    model = toxicity.learn_toxicity(docs, labels)
    assert toxicity.score_toxicity(docs, model).filter("score between 0 and 1").count() == len(ROWS)
    assert toxicity.score_toxicity(empty, model).count() == 0
    assert toxicity.drop_toxic(docs, model).columns == docs.columns
    assert toxicity.score_toxicity(docs, toxicity.learn_toxicity(empty, labels)).count() == len(ROWS)


def test_obfuscated_words_are_read():
    none = toxicity.Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    x = toxicity.features(pa.array(["you 1d!0t and fine", "an idiot, IDIOT", ""]), none)
    column = dict(zip(toxicity.FEATURES, x.T, strict=True))
    assert list(column["obfuscated_hits"]) == [1, 0, 0] and list(column["seed_hits"]) == [0, 2, 0]


def test_all_forms_of_obfuscated_words_are_read():
    none = toxicity.Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    hidden = ["1diot", "a $tupid one", "idio7", "mor0n!", "idi0ts", "i d i o t", "a i d 1 o t!", "!!mor0n?!", "moron$ i.d.i.o.t"]
    plain = ["idiot! (idiot), idiot", "i d i", "a b c d e f", "100 $5 well-known 8am", "!!! ### 42", "ididots i diot", "é è ü", ""]
    x = toxicity.features(pa.array(hidden + plain), none)[:, toxicity.FEATURES.index("obfuscated_hits")]
    assert list(x) == [1] * 8 + [1] + [0] * len(plain)


@pytest.fixture(scope="module")
def tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    vocabulary = bpe.Vocabulary.parse(open(path, encoding="utf-8").read())
    return Tokenizer.from_file(path), bpe.Encoder(vocabulary, vocabulary.lookahead()), vocabulary


def test_bpe_equals_the_library(spark, docs, empty, tokenizer):
    library, encoder, vocabulary = tokenizer
    texts = [r["text"] or "" for r in docs.collect()] + ["ΑΣ'S don't İ \x1c  x", "a" * 5000, "thein" * 1500, "日本語 text"]
    texts += [r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()]
    for text in texts:
        e = library.encode(text, add_special_tokens=False)
        assert encoder.encode(text) == (" ".join(map(str, e.ids)), library.decode(e.ids, skip_special_tokens=False))
    got = by_id(bpe.encode_texts(docs, public_tokenizers.path("word_bpe_49k.json")))
    assert got[3][0]["n_tokens"] == 0 and got[3][0]["ids"] == "" and len(got[2]) == 2
    assert bpe.encode_digests(empty, public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_bpe_classes_are_spelled_out():
    plane = "".join(chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000)
    mixed = "".join(f"{c}a'{c}1{c}ll" for c in plane)
    usual, spelled = regex.compile(bpe.WORD), bpe.plane_word()
    assert spelled.findall(plane) == usual.findall(plane) and spelled.findall(mixed) == usual.findall(mixed)


def test_bpe_streams_and_decodes(tokenizer):
    _, encoder, vocabulary = tokenizer
    rng = np.random.default_rng(2)
    for n in (1, 700, 9000):
        symbols = [str(c) for c in rng.choice(list("theinarods"), n)]
        assert list(encoder.transducer.stream(symbols)) == encoder.transducer.merge(symbols)
    ids = [int(i) for i in encoder.encode("Größe déjà 日本 ok")[0].split()]
    assert "".join(encoder.decoder.text(ids, vocabulary.suffix, vocabulary.special)) == "größe déjà 日本 ok "


def plain_similarity(a, b):
    x, y = Counter(a), Counter(b)
    x, y = ({k: 1 + np.log(n) for k, n in c.items()} for c in (x, y))
    keys = {*x, *y}
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in keys) for i in x.keys() & y.keys())


def test_probability_jaccard():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a, b = (np.sort(rng.integers(0, 30, 40).astype(np.uint64)) for _ in range(2))
        assert abs(near_dedup.similarity(a, b) - plain_similarity(a.tolist(), b.tolist())) < 1e-9
    w = Words(pa.array([BASE + " x" * 30, near(50) + " x" * 25]))
    s = near_dedup.signatures(*near_dedup.weighted(w), w.n)
    keys, text = near_dedup.shingles(w)
    assert abs((s[0] == s[1]).mean() - near_dedup.similarity(keys[text == 0], keys[text == 1])) < 0.15


def test_near_groups(spark, docs, empty):
    got = by_id(near_dedup.near_groups(docs))
    assert sum(map(len, got.values())) == len(ROWS)
    assert {got[k][0]["class_id"] for k in (6, 7, 8)} == {6} and got[6][0]["class_size"] == 3
    assert [got[k][0]["class_id"] for k in (1, 3, 4, 5, 9)] == [1, 3, 3, 5, 9]
    kept = near_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 5, 6, 9, 10]
    assert near_dedup.near_groups(empty).count() == near_dedup.drop_near_copies(empty).count() == 0


def test_near_groups_of_large_buckets(spark):
    """More copies than a bucket's pairs are made for; some are linked only through others."""
    rng = np.random.default_rng(4)
    texts = []
    for _ in range(90):
        words = BASE.split()
        for k in rng.integers(0, 120, rng.integers(0, 7)):
            words[k] = f"z{rng.integers(1 << 30)}"
        texts.append(" ".join(words))
    got = near_dedup.near_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    bags = []
    for t in texts:
        w = Words(pa.array([t]))
        bags.append(near_dedup.shingles(w)[0])
    label = list(range(90))
    for i in range(90):
        for j in range(i):
            if near_dedup.similarity(bags[i], bags[j]) >= near_dedup.SIMILAR and label[i] != label[j]:
                lo, hi = sorted((label[i], label[j]))
                label = [lo if x == hi else x for x in label]
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == dict(enumerate(label))


def test_components(spark):
    pairs = [(1, 2), (3, 2), (3, 4), (9, 8), (7, 9), *[(k, k + 1) for k in range(20, 40)], (5, 5)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**dict.fromkeys((1, 2, 3, 4), 1), **dict.fromkeys((7, 8, 9), 7), **dict.fromkeys(range(20, 41), 20)}


CHAT = "conv_id long, turn long, role string, text string, key string"


def test_chat_format(spark):
    rows = [
        (1, 0, None, "Human: Hi?\nmore\n**Assistant:** Hello\nAI: again"),
        (1, 1, "user", "thanks"),
        (2, 0, "system", "Be brief."),
        (2, 1, None, "What is it?"),
        (2, 2, None, "x" * 400),
        (3, None, None, None),
        (None, 1, "user", "lost"),
    ]
    got = {(r["conv_id"], r["turn"]): r for r in chat_format.format_chats(spark.createDataFrame([(*r, "k") for r in rows], CHAT)).collect()}
    assert got[1, 0]["rendered"] == "<|user|>\nHi?\nmore\n<|assistant|>\nHello\n<|assistant|>\nagain"
    assert [got[2, k]["role"] for k in range(3)] == ["system", "user", "assistant"]
    assert got[1, 0]["n_turns"] == 3 and got[3, None]["n_lines"] == 1 and len(got) == len(rows)
    assert chat_format.format_chats(spark.createDataFrame([], CHAT)).count() == 0


def test_cut_conversation_equals_whole_one(spark):
    """One conversation over many partitions gives what Viterbi's algorithm gives for it at once."""
    rng = np.random.default_rng(6)
    rows = [(1, k, str(rng.choice(["user", "assistant", "?"])), "y" * int(rng.integers(1, 500)), "k") for k in range(300)]
    turns = spark.createDataFrame(rows, CHAT)
    whole = chat_format.viterbi([line for r in rows for line in chat_format.read_lines(r[2], r[3])[1]])
    got = {r["turn"]: r["role"] for r in chat_format.format_chats(turns).collect()}
    assert [got[k] for k in range(300)] == [chat_format.ROLES[i] for i in whole]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()[name]).df()
    got = queries.queries()[name](spark, SMALL).toPandas()[list(want.columns)]
    text = lambda df: sorted(tuple("" if v is None or v != v else f"{v:.9g}" if isinstance(v, float | np.floating) else str(v) for v in r) for r in df.astype(object).to_numpy())
    plain = lambda df: df.assign(**{c: df[c].astype(float) for c in df if df[c].dtype.kind in "iuf"})
    assert text(plain(got)) == text(plain(want))


def test_pipeline(spark, docs, empty):
    read = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty.select(read.columns), SMALL).count() == 0
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded"] and out.count() > 50
    assert oracle.OP1 and corpus_pipeline.ORACLE_SQL is None


def test_pieces_alone_in_a_shard_need_no_automaton():
    rng = np.random.default_rng(7)
    for _ in range(300):
        size = int(rng.integers(substring_dedup.WINDOW, substring_dedup.WINDOW + substring_dedup.PIECE))
        period = int(rng.integers(1, 20))
        words = [f"w{i % period}" for i in range(size)] if rng.random() < 0.7 else [f"w{i}" for i in range(size)]
        for n in (1, 3):
            found = substring_dedup.alone_mask(" ".join(words), n)
            assert found is None or found == substring_dedup.shard_masks([(" ".join(words), n)])[0]

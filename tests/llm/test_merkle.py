"""The manifest against a tree built in plain Python, at several fans and record sizes."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lotwise.llm import merkle, queries

SMALL = "/root/testdata/sf0.001"
KIND = "doc_id long, source string, lang string, n_chars long, text string, rank long, group long, place string, digest string, path string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(digests, fan):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + fan]) for i in range(0, len(levels[-1]), fan)])
    return levels


def siblings(levels, place, fan):
    out = []
    for level in levels[:-1]:
        first = place // fan * fan
        out.append((level[first:place], level[place + 1 : first + fan]))
        place //= fan
    return out


def expected(rows, fan=2):
    by = defaultdict(list)
    for r in rows:
        by[r[2]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    trees = {}
    for lang, held in by.items():
        held.sort(key=lambda x: x[:3])
        trees[lang] = tree([x[2] for x in held], fan)
    langs = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    top = tree([trees[g][-1][0] for g in langs], fan)
    out = []
    for k, lang in enumerate(langs):
        for i, (_, _, own, r) in enumerate(by[lang]):
            path, now = siblings(trees[lang], i, fan) + siblings(top, k, fan), own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                now = leaf((*r[:3], r[3] + 1, r[4]))
            for before, after in path:
                now = sha(*before, now, *after)
            root, proof = top[-1][0], sha(*(d for before, after in path for d in (*before, *after)))
            out.append((r[0], own, trees[lang][-1][0], root, proof, now, now == root))
    return sorted(out, key=str)


def verified(docs, **how):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return sorted(map(tuple, merkle.verify_documents(docs, tampered, **how).collect()), key=str)


def test_registered_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]
    got = queries.queries()["op13_merkle_manifest"](spark, SMALL)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted(map(tuple, got.collect()), key=str)
    assert got == expected(rows) and 0 < sum(not r[-1] for r in got) < len(got) / 3
    assert verified(docs, levels=3) == got  # many rounds of records


ODD = [
    (None, None, None, None, None),
    *[(1, "a", "en", 2**63 - 1, "")] * 2,
    (1, "a", "en", 5, "x"),
    (2, "b", None, None, "é" * 100_000),
    (2, "b", "", 3, "z"),
    (7, "q", "zz", None, "t"),
    *[(i, "s", "hot", i, f"t{i}") for i in range(16)],
    *[(8, "same", "hot", 1, "same")] * 9,
]


@pytest.mark.parametrize("fan, levels", [(2, 2), (2, 4), (3, 1), (3, 10)])
def test_odd_rows(spark, fan, levels):
    docs = spark.createDataFrame([(*r, 0, 0, "p", "d", "x") for r in ODD], KIND).repartition(5)
    assert verified(docs, fan=fan, levels=levels) == expected(ODD, fan)


def test_empty_table_and_no_tampering(spark):
    docs = spark.createDataFrame([(*r, 0, 0, "p", "d", "x") for r in ODD], KIND)
    nothing = merkle.verify_documents(docs.limit(0))
    assert nothing.count() == 0 and nothing.columns == merkle.verify_documents(docs).columns
    assert merkle.verify_documents(docs).filter("not verified").count() == 0


def test_a_few_leaves_open_their_way_only(spark):
    """Requests for two leaves descend through the records on their ways; other records aren't opened."""
    nodes = spark.range(100).select(F.lit("g").alias("group"), F.col("id").alias("rank"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    manifest = merkle.build(nodes, 2, 2)
    assert len(manifest.records) == 4 and manifest.records[0].count() == 25
    wanted = nodes.filter("rank in (3, 77)")
    assert sorted(r["place"] for r in merkle.descend(manifest, wanted).collect()) == [0, 19]
    root = tree([sha(str(i)) for i in range(100)], 2)[-1][0]
    proofs = merkle.prove(manifest, wanted).collect()
    assert len(proofs) == 2 and all(merkle.fold(r["digest"], r["path"]) == r["root"] == root for r in proofs)

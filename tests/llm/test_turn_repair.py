"""Conversation repair against a plain search, whole and cut into stretches, and on awkward input."""

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lotwise.llm import queries, turn_repair

SMALL = "/root/testdata/sf0.001"
KIND = "conv_id long, turn long, role string, text string, look int, part long, idx long"
BLANK = re.compile(r"[\x20\x09-\x0D]*")


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        n = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if n == 1 else re.sub("[.!?]", "", text) if n == 2 else text
        out[conv] += [] if n == 0 else [(turn, "user" if n == 4 else role, text)] * (2 if n == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, lines) over rows (role, text, fault); by trying every edit in every state, all sequences kept apart."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    insert = lambda ways: [
        *ways, *((c + 3, a + "I", lines + [f"{r}:"], r[0]) for c, a, lines, s in ways for r in ("user", "assistant") if r[0] in after[s])
    ]
    ways = [(0, "", [], "")]
    for role, text, fault in rows:
        new = []
        for c, a, lines, s in insert(ways):
            new.append((c + 4, a + "D", lines, s))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault else 0
            if role[:1] and role[0] in after[s]:
                new.append((c + more, a + "K", lines + [f"{role}:{text}"], role[0]))
            for r in ("user", "assistant"):
                if r[0] in after[s]:
                    new.append((c + 3 + more, a + "R", lines + [f"{r}:{text}"], r[0]))
        ways = [min((w for w in new if w[3] == s), key=lambda w: w[:2]) for s in {w[3] for w in new}]
    return min((w for w in insert(ways) if w[3] in ("", "a")), key=lambda w: w[:2])


def expected(rows):
    out = []
    for conv, held in damage(rows).items():
        held = sorted(held, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faulty = set(), []
        for _, role, text in held:
            last = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1:]
            fault = "blank" if BLANK.fullmatch(text) else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None
            seen.add((role, text))
            faulty.append((role, text, fault))
        turns = {t for t, _, _ in held} - {None}
        count = lambda f: sum(x[2] == f for x in faulty)  # noqa: B023, E731
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(held))
        cost, audit, lines, _ = cheapest(faulty)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def repaired(turns):
    return sorted(map(tuple, turn_repair.repair_conversations(turn_repair.damaged(turns)).collect()), key=str)


def test_registered_query_equals_plain_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.queries()["op11_turn_repair"](spark, SMALL)
    assert got.columns == ["conv_id", *turn_repair.COUNTS, "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


AWKWARD = [
    *[(1, None, r, t) for r, t in (("user", "a."), (None, None), ("user", "a."), ("", "x"), ("system", " \t\n"), ("user", "B!\n"))],
    *[(2, k, "user", "again.") for k in range(9)],
    *[(3, k % 4, ("assistant", "user")[k % 2], f"t{k}.") for k in range(9)],
    *[(None, k, "system", "s?") for k in range(3)],
    *[(4, 10 * k, r, "z" * 70_000 + "." * (k % 2)) for k, r in enumerate(("Human", "user", "assistant", "assistant", "user", "agent"))],
    *[(k, 0, "user", "lost.") for k in range(100, 140)],  # some lose their only row
    (5, 2**40, "user", "far."), (5, 0, "system", "near."), (6, 1, "user", "ünï ✓?"), (6, 2, "assistant", ""),
]


@pytest.mark.parametrize("partitions", [1, 3, 30])
def test_awkward_conversations(spark, partitions):
    """Few partitions hold conversations whole, many cut them, between equal turns and equal rows too."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        rows = AWKWARD + AWKWARD[6:20]
        turns = spark.createDataFrame([(*r, 0, 0, 0) for r in rows], KIND).repartition(3)
        assert repaired(turns) == expected(rows)
        assert repaired(turns.limit(0)) == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_conversation_is_cut(spark, monkeypatch):
    """One conversation over many partitions, with a row that makes a third of it."""
    cuts = []
    inner = turn_repair._repair_cut
    monkeypatch.setattr(turn_repair, "_repair_cut", lambda dealt, cut, *a: cuts.append(cut) or inner(dealt, cut, *a))
    rows = [(7, k // 2, ("user", "assistant", "tool")[k % 3], "same." if k % 3 == 1 else f"text {k % 50}{'.' * (k % 4)}") for k in range(600)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert repaired(spark.createDataFrame([(*r, 0, 0, 0) for r in rows], KIND)) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert cuts == [{7}]


def test_heaps_from_both_sides_meet():
    """The forward side alone doesn't pass the middle, so the result comes from both."""
    looks = bytes([3 + 0, 6 + 0] * 200 + [3 + 2, 3 + 2] + [6 + 0, 3 + 0] * 200)
    passed = {0: set(), 1: set()}

    class Spy(turn_repair.Lattice):
        def after(self, node):
            passed[0].add(node // 4)
            return super().after(node)

        def before(self, node):
            passed[1].add(node // 4)
            return super().before(node)

    original, turn_repair.Lattice = turn_repair.Lattice, Spy
    try:
        cost, audit, _ = turn_repair.search(looks)
        backward = passed[1].copy()
    finally:
        turn_repair.Lattice = original
    assert min(backward) > 0 or max(passed[0]) == len(looks)
    rows = [("user" if k // 3 == 1 else "assistant", str(i), "truncated" if k % 3 else None) for i, k in enumerate(looks)]
    assert (cost, audit) == cheapest(rows)[:2]


def test_look_of_equals_its_rule(spark):
    texts = ["", " \x0b", "a. \t\r\n", "a. ", "?", "a", "!b", "é."]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(turn_repair.look_of(F.lit("assistant"), F.col("t")) % 3).collect()
    assert [r[0] for r in got] == [1, 1, 0, 2, 0, 2, 2, 0]

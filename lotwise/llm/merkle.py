"""Merkle manifest of a dataset: a content-addressed DAG of digests, and proofs by descent from its root."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lotwise.llm.tables import checkpointed

#: Consecutive nodes that become one node of the next level.
FAN = 2
#: Levels that one record spans: it holds a digest and the FAN ** LEVELS nodes below, the inner ones following from them.
LEVELS = 10
#: Columns of a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(*values: str) -> str:
    return hashlib.sha256("".join(values).encode()).hexdigest()


def field(value: Column) -> Column:
    """What stands for a value in a leaf: ``-`` for null, else its number of bytes, a colon, the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def one_more(number: Column) -> Column:
    """The number plus one, at any size; null stays null."""
    return (number.cast("decimal(38,0)") + 1).cast("decimal(38,0)")


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Add ``rank``: the row's place, from 0, in its group by ``order`` (nulls first). Written to the checkpoint folder.

    Rows are dealt by ranges of (group, order), so a group of any size spreads over tasks, as do rows alike in all of these.
    Two rows per partition, about its first and last group, come to the driver to continue the count across partitions.
    """
    keys = [group, *order]
    dealt = rows.repartitionByRange(*keys, F.monotonically_increasing_id()).sortWithinPartitions(*keys)
    dealt = checkpointed(dealt)
    kind, arrow_kind = dealt.schema[group].dataType.simpleString(), to_arrow_type(dealt.schema[group].dataType)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[list] = []  # [group, rows] of the first and the last group
        n_groups = 0
        for key in (k for b in batches for k in b.column(group).to_pylist()):
            if not found or found[-1][0] != key:
                n_groups += 1
                found = [*found[:1], [key, 0]]
            found[-1][1] += 1
        if found:
            p = TaskContext.get().partitionId()
            out = {"partition": [p] * len(found), "place": [0, 1][: len(found)], group: pa.array([f[0] for f in found], arrow_kind), "n": [f[1] for f in found]}
            yield pa.RecordBatch.from_pydict(out)

    met = dealt.select(group).mapInArrow(ends, f"partition long, place long, `{group}` {kind}, n long").collect()
    base, carried, count = {}, object(), 0
    for r in sorted(met, key=lambda r: (r["partition"], r["place"])):
        if not r["place"]:
            base[r["partition"]] = count if r[group] == carried else 0
            count = base[r["partition"]]
        else:
            count = 0
        carried, count = r[group], count + r["n"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, before, begun = base.get(TaskContext.get().partitionId(), 0), None, False
        for batch in batches:
            ranks = []
            for key in batch.column(group).to_pylist():
                if begun and key != before:
                    at = 0
                ranks.append(at)
                at, before, begun = at + 1, key, True
            yield batch.append_column("rank", pa.array(ranks, pa.int64()))

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    return dealt.mapInArrow(number, f"{columns}, rank long")


def climb(digests: list[str], levels: int, fan: int) -> list[list[str]]:
    """All levels over the given one, lowest first, the given one included."""
    out = [digests]
    for _ in range(levels):
        below = out[-1]
        out.append([digest_of(*below[i : i + fan]) for i in range(0, len(below), fan)])
    return out


def height(n: int, alone: bool, levels: int, fan: int) -> int:
    """Levels of a record over n nodes: all of them if it is one of many, else until one node remains."""
    if not alone:
        return levels
    h = 0
    while n > 1:
        n, h = -(-n // fan), h + 1
    return h


def segments(tree: list[list[str]], fan: int) -> list[list[str]]:
    """Per node of the lowest level, what stands beside its path, lowest level first, as ``before|after``."""
    out = []
    for place in range(len(tree[0])):
        taken = []  # from the top down, by the digits of the place
        for h in range(len(tree) - 2, -1, -1):
            digit = place // fan**h
            run = digit // fan * fan
            taken.append("".join(tree[h][run:digit]) + "|" + "".join(tree[h][digit + 1 : run + fan]))
        out.append(taken[::-1])
    return out


def fold(leaf: str, path: list[str]) -> str:
    """The root that a leaf and the digests beside its path give."""
    for beside in path:
        before, _, after = beside.partition("|")
        leaf = digest_of(before, leaf, after)
    return leaf


@dataclass
class Manifest:
    """Records by round, lowest first: group, place (of the record in its round), digest, children, alone; and the
    roots: group, digest. A record with ``alone`` has the group's root as digest."""

    records: list[DataFrame]
    roots: DataFrame
    fan: int
    levels: int


def build(nodes: DataFrame, fan: int = FAN, levels: int = LEVELS) -> Manifest:
    """The DAG over ``nodes`` (group, rank, digest): per group, every ``fan`` consecutive nodes become one until one is left.

    A round deals nodes to records of ``fan ** levels`` consecutive ones, so no task holds more of a group, and goes on with
    the digests of the records: some four rounds for 10 ** 12 nodes. Records are written to the checkpoint folder. A
    record that isn't full is the last of its group; as the first one too, it is alone and gives the root.
    """
    wide = fan**levels
    kind = nodes.schema["group"].dataType.simpleString()

    def record(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("rank").to_pylist(), table.column("digest").to_pylist(), strict=True))
        digests, place = [d for _, d in rows], key[1].as_py()
        alone = place == 0 and len(digests) < wide
        top = climb(digests, height(len(digests), alone, levels, fan), fan)[-1][0]
        group = pa.array([key[0].as_py()], table.schema.field("group").type)
        columns = [group, pa.array([place], pa.int64()), pa.array([top]), pa.array([digests], pa.list_(pa.string())), pa.array([alone])]
        return pa.Table.from_arrays(columns, ["group", "place", "digest", "children", "alone"])

    records: list[DataFrame] = []
    while True:
        dealt = nodes.select("group", "rank", "digest", F.floor(F.col("rank") / F.lit(wide)).alias("place"))
        found = dealt.groupBy("group", "place").applyInArrow(record, f"group {kind}, place long, digest string, children array<string>, alone boolean")
        records.append(checkpointed(found))
        open_ones = records[-1].filter("not alone")
        if open_ones.isEmpty():
            break
        nodes = open_ones.select("group", F.col("place").alias("rank"), "digest")
    roots = records[0].filter("alone").select("group", "digest")
    for r in records[1:]:
        roots = roots.unionByName(r.filter("alone").select("group", "digest"))
    return Manifest(records, roots, fan, levels)


def descend(manifest: Manifest, wanted: DataFrame, paths: DataFrame | None = None) -> DataFrame:
    """The lowest records on the way to the wanted leaves (group, rank), found from the roots by digest.

    Requests for leaves below one node go down together: a round looks the digests of its nodes up in the records, opens
    those on the way to a wanted rank by the rank's digits, and adds to the path of each child what stands beside it.
    ``paths`` (group, path) says how to go on from a group's root. Gives group, place, children, alone, path, root.
    """
    fan, levels = manifest.fan, manifest.levels
    wide = fan**levels
    kind = manifest.roots.schema["group"].dataType.simpleString()
    goals = wanted.select("group", "rank")
    above = manifest.roots.select("group", F.lit(0).cast("long").alias("place"), "digest", F.col("digest").alias("root"))
    if paths is None:
        above = above.withColumn("path", F.array().cast("array<string>"))
    else:
        known = paths.select(F.col("group").alias("of"), "path")
        above = above.join(known, F.col("group").eqNullSafe(F.col("of"))).drop("of")
    begun = above

    def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["children"])
                tree = climb(row["children"], height(n, row["alone"], levels, fan), fan)
                paths = [p + row["path"] for p in segments(tree, fan)]
                yield pa.RecordBatch.from_pydict({
                    "group": pa.array([row["group"]] * n, batch.schema.field("group").type),
                    "place": [row["place"] * wide + i for i in range(n)], "digest": row["children"],
                    "path": pa.array(paths, pa.list_(pa.string())), "root": [row["root"]] * n,
                })

    nodes = None
    for number in range(len(manifest.records) - 1, -1, -1):
        record = manifest.records[number]
        # Groups whose root is a record of this round begin here, the others come from the round above.
        tops = record.filter("alone").select(F.col("group").alias("of"), F.col("digest").alias("as"))
        first = begun.join(tops, F.col("group").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("as")), "left_semi")
        nodes = first if nodes is None else nodes.unionByName(first)
        ways = goals.select(F.col("group").alias("to"), F.floor(F.col("rank") / F.lit(wide ** (number + 1))).alias("at")).distinct()
        nodes = nodes.join(ways, F.col("group").eqNullSafe(F.col("to")) & (F.col("place") == F.col("at")), "left_semi")
        # Content addresses: equal records (of equal leaves) are one.
        addressed = record.select("digest", "children", "alone").dropDuplicates(["digest", "alone"])
        met = nodes.join(addressed, "digest").select("group", "place", "children", "alone", "path", "root")
        if not number:
            return met
        nodes = met.mapInArrow(children, f"group {kind}, place long, digest string, path array<string>, root string")
    raise AssertionError("a manifest has one round of records at least")


def prove(manifest: Manifest, leaves: DataFrame, paths: DataFrame | None = None) -> DataFrame:
    """For the wanted ``leaves`` (group, rank, and others): their columns, ``path``, lowest level first, and the group's ``root``."""
    fan, levels = manifest.fan, manifest.levels
    wide = fan**levels
    met = descend(manifest, leaves, paths)

    def open_record(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        row = right.to_pylist()[0]
        tree = climb(row["children"], height(len(row["children"]), row["alone"], levels, fan), fan)
        found = segments(tree, fan)
        own = [found[r % wide] + row["path"] for r in left.column("rank").to_pylist()]
        out = left.drop_columns(["place"]).append_column("path", pa.array(own, pa.list_(pa.string())))
        return out.append_column("root", pa.array([row["root"]] * len(left), pa.string()))

    dealt = leaves.withColumn("place", F.floor(F.col("rank") / F.lit(wide)))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in leaves.schema)
    return dealt.groupBy("group", "place").cogroup(met.groupBy("group", "place")).applyInArrow(open_record, f"{columns}, path array<string>, root string")


def verify_documents(
    docs: DataFrame, tampered: Column | None = None, id_col: str = "doc_id", group_col: str = "lang", fan: int = FAN, levels: int = LEVELS
) -> DataFrame:
    """One row per document: id_col, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of the document's FIELDS. Per value of ``group_col`` the leaves ascend by id, and a tree over
    them ends in a subroot; the subroots, by group, end in the root. Records hold a digest and the nodes below it; a request for
    a leaf goes down from the root by the digits of its ranks and collects what it leaves aside: its proof. ``tampered``
    tells the rows whose n_chars is taken as one higher when the proof is checked.

    Null ids and null groups come first and are never tampered with by a null condition. Rows with equal ids are ordered
    by leaf; repeated rows are leaves of their own. Empty texts are ``0:``, null ones ``-``; a text of any length is
    hashed in the JVM and not carried on. An empty table gives an empty result. Other columns aren't read.
    """
    values = [F.col(id_col if c == "doc_id" else c) for c in FIELDS]
    changed = [one_more(v) if c == "n_chars" else v for c, v in zip(FIELDS, values, strict=True)]
    condition = F.lit(False) if tampered is None else tampered
    shown = F.when(condition, leaf_of(changed))
    rows = docs.select(F.col(group_col).alias("group"), F.col(id_col).alias("id"), leaf_of(values).alias("digest"), shown.alias("shown"))
    leaves = numbered(rows, "group", ["id", "digest"])
    result = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if leaves.isEmpty():
        return docs.sparkSession.createDataFrame([], result)

    lower = build(leaves, fan, levels)
    tops = numbered(lower.roots.select(F.lit(0).alias("group"), F.col("group").alias("name"), "digest"), "group", ["name"])
    upper = build(tops, fan, levels)
    root = upper.roots.first()["digest"]
    paths = checkpointed(prove(upper, tops).select(F.col("name").alias("group"), "path"))

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("proof_sha256", "folded_root", "verified")}
            for leaf, other, path in zip(*(batch.column(c).to_pylist() for c in ("digest", "shown", "path")), strict=True):
                folded = fold(leaf if other is None else other, path)
                out["proof_sha256"].append(digest_of("".join(path).replace("|", "")))
                out["folded_root"].append(folded)
                out["verified"].append(folded == root)
            roots = pa.array([root] * batch.num_rows, pa.string())
            columns = [batch.column("id"), batch.column("digest"), batch.column("root"), roots, *map(pa.array, out.values())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "leaf", "subroot", "root", *out])

    return prove(lower, leaves, paths).mapInArrow(checked, result)

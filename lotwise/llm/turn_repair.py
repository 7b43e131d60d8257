"""Conversation structure repair: the cheapest edits to a legal sequence of roles, by bidirectional Dijkstra search."""

from __future__ import annotations

import hashlib
import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lotwise.llm.tables import checkpointed, look_up

BLANK_CHARACTERS = " \t\n\x0b\f\r"
ENDINGS = ".!?"
#: Costs of edits; a truncated row that stays adds TRUNCATED_STAYS.
REROLE, DELETE, INSERT, TRUNCATED_STAYS = 3, 4, 3, 3
#: Where a sequence stands: before its first row, after a system, a user, an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The role that must come next, other than a system row at the start.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: What remains to pay at the end of a conversation: it may end where no pair is open.
ENDS = (0.0, math.inf, math.inf, 0.0)
REMEMBERED = 50_000
LEGAL_PAIRS = ("su", "ua", "au")
#: A row as the search sees it: 3 * kind of its role's initial (place in INITIALS, else OTHER) + fault.
INITIALS = "sua"
OTHER = 3
SOUND, MUST_GO, TRUNCATED = range(3)

Move = tuple[str, int, int]  # letter, state after it, cost


def moves_of(look: int) -> list[list[Move]]:
    """Edits that take a row, by the state before it."""
    kind, fault = divmod(look, 3)
    out: list[list[Move]] = []
    for state in range(4):
        found = [("D", state, DELETE)]
        if fault != MUST_GO:
            more = TRUNCATED_STAYS if fault == TRUNCATED else 0
            found.append(("R", NEXT[state], REROLE + more))
            if kind == 0 and state == START:
                found.append(("K", SYSTEM, more))
            elif kind in (1, 2) and NEXT[state] == (USER if kind == 1 else ASSISTANT):
                found.append(("K", NEXT[state], more))
        out.append(found)
    return out


MOVES = [moves_of(look) for look in range(12)]
#: The same by the state after the row: (letter, state before it, cost).
MOVES_BACK = [[[(c, s, w) for s in range(4) for c, t, w in m[s] if t == after] for after in range(4)] for m in MOVES]
BEFORE = [[s for s in range(4) if NEXT[s] == t] for t in range(4)]


class Lattice:
    """Nodes are 4 * rows passed + state. ``last``: no rows follow, so texts may be inserted after the last one too."""

    def __init__(self, looks: bytes, last: bool):
        self.looks, self.last, self.n = looks, last, len(looks)

    def after(self, node: int) -> Iterator[tuple[str, int, int]]:
        i, state = divmod(node, 4)
        if i < self.n:
            for letter, to, cost in MOVES[self.looks[i]][state]:
                yield letter, 4 * (i + 1) + to, cost
        if i < self.n or self.last:
            yield "I", 4 * i + NEXT[state], INSERT

    def before(self, node: int) -> Iterator[tuple[str, int, int]]:
        i, state = divmod(node, 4)
        if i:
            for letter, of, cost in MOVES_BACK[self.looks[i - 1]][state]:
                yield letter, 4 * (i - 1) + of, cost
        if i < self.n or self.last:
            for of in BEFORE[state]:
                yield "I", 4 * i + of, INSERT


def search(looks: bytes, entry: int = START, exits: Sequence[float] = ENDS, last: bool = True) -> tuple[float, str, int]:
    """(cost, audit, state at the end) of the cheapest edits from ``entry``; of equal ones, the least audit.

    ``exits`` is what remains to pay in each state at the end. Two heaps advance from both sides, the cheaper one first,
    until their tops together exceed the best sum met; by then an optimal path is known from the one or the other
    side at each of its nodes. All its crossings from the forward to the reverse side are kept, with all equally cheap
    ways to them, and the audit is read off with the least letter at each node. A sequence of letters determines the
    states, so no two ways have the same audit, and none's audit begins another's.
    """
    lattice, n = Lattice(looks, last), len(looks)
    labels: tuple[dict[int, float], dict[int, float]] = ({entry: 0.0}, {4 * n + s: x for s, x in enumerate(exits) if x < math.inf})
    heaps = [[(w, v) for v, w in side.items()] for side in labels]
    settled: tuple[set[int], set[int]] = (set(), set())
    for heap in heaps:
        heapq.heapify(heap)
    best = min((labels[1][v] for v in labels[0] if v in labels[1]), default=math.inf)
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= best:
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        mine, other = labels[side], labels[1 - side]
        cost, node = heapq.heappop(heaps[side])
        if node in settled[side]:
            continue
        settled[side].add(node)
        for _, to, w in lattice.before(node) if side else lattice.after(node):
            if cost + w < mine.get(to, math.inf):
                mine[to] = cost + w
                heapq.heappush(heaps[side], (cost + w, to))
                best = min(best, cost + w + other.get(to, math.inf))
    return best, *_least_audit(lattice, labels, settled, best, exits)


def _least_audit(lattice: Lattice, labels, settled, best: float, exits: Sequence[float]) -> tuple[str, int]:
    there, back = labels
    ways: dict[int, list[tuple[str, int]]] = defaultdict(list)
    tails, heads = [], []
    for u in settled[0]:
        i, state = divmod(u, 4)
        if i == lattice.n and there[u] + exits[state] == best:
            tails.append(u)
        for letter, v, w in lattice.after(u):
            if v in settled[1] and there[u] + w + back[v] == best:
                ways[u].append((letter, v))
                tails.append(u)
                heads.append(v)
    for starts, side in ((tails, 0), (heads, 1)):
        label, seen, waiting = labels[side], set(starts), list(starts)
        while waiting:
            node = waiting.pop()
            for letter, to, w in lattice.after(node) if side else lattice.before(node):
                if to in settled[side] and label[to] + w == label[node]:
                    way = (node, (letter, to)) if side else (to, (letter, node))
                    if way[1] not in ways[way[0]]:
                        ways[way[0]].append(way[1])
                    if to not in seen:
                        seen.add(to)
                        waiting.append(to)
    node, letters = min(u for u in there if u < 4 and there[u] == 0), []
    while ways.get(node):
        letter, node = min(ways[node])
        letters.append(letter)
    return "".join(letters), node % 4


def costs_through(looks: bytes) -> list[list[float]]:
    """Least costs from each state before a stretch of rows to each state after it, nothing inserted at its end."""
    out = []
    for entry in range(4):
        costs = [0.0 if s == entry else math.inf for s in range(4)]
        for look in looks:
            for s in (START, SYSTEM, USER, ASSISTANT, USER):  # inserts lead on at most twice
                costs[NEXT[s]] = min(costs[NEXT[s]], costs[s] + INSERT)
            after = [math.inf] * 4
            for s in range(4):
                for _, t, w in MOVES[look][s]:
                    after[t] = min(after[t], costs[s] + w)
            costs = after
        out.append(costs)
    return out


def at_the_end(costs: Sequence[float] = ENDS) -> list[float]:
    """What remains to pay in each state after the last row, when texts may be inserted there."""
    out = list(costs)
    for _ in range(2):
        out = [min(out[s], INSERT + out[NEXT[s]]) for s in range(4)]
    return out


class Repairer:
    """Goes through a conversation's edits and digests the repaired one, a row at a time."""

    def __init__(self):
        self.state, self.sha, self.begun = START, hashlib.sha256(), False

    def _line(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.begun else ''}{role}:{text}".encode())
        self.begun = True

    def insert(self) -> None:
        self.state = NEXT[self.state]
        self._line(NAMES[self.state], "")

    def row(self, letter: str, role: str, text: str) -> None:
        if letter == "K":
            self.state = SYSTEM if self.state == START and role[:1] == "s" else NEXT[self.state]
            self._line(role, text)
        elif letter == "R":
            self.state = NEXT[self.state]
            self._line(NAMES[self.state], text)


def damaged(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows after a reproducible damage: conv, at, role, text; a dropped row stays with null role and text.

    The crc32 of ``id:turn`` modulo 20 decides: 0 drops the row, 1 empties its text, 2 takes the ENDINGS out of it, 3 repeats
    it, 4 sets its role to user. Nulls count as one blank, but ids and turns keep theirs.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    number = F.crc32(F.concat(blank(id_col), F.lit(":"), blank(turn_col))) % 20
    rows = turns.select(
        F.col(id_col).alias("conv"), F.col(turn_col).alias("at"), blank(role_col).alias("role"), blank(text_col).alias("text"), number.alias("number")
    )
    number = F.col("number")
    text = F.when(number == 1, "").when(number == 2, F.translate("text", ENDINGS, "")).otherwise(F.col("text"))
    return rows.select(
        "conv", "at",
        F.when(number == 0, F.lit(None)).when(number == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(number != 0, text).alias("text"),
        F.explode(F.when(number == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def look_of(role: Column, text: Column) -> Column:
    """How the search sees a row, duplicates apart."""
    trimmed = F.rtrim(text, F.lit(BLANK_CHARACTERS))
    kind = F.lit(OTHER)
    for k, initial in enumerate(INITIALS):
        kind = F.when(role.startswith(initial), k).otherwise(kind)
    fault = F.when(trimmed == "", MUST_GO).when(~F.right(trimmed, F.lit(1)).isin(*ENDINGS), TRUNCATED).otherwise(SOUND)
    return (kind * 3 + fault).cast("int")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_conversations(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row per conversation: id_col, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows`` holds conv, at, role, text; a null role says that the conversation exists, and is no row of it. Faults are
    counted and the cheapest edits found as the module says; ``repaired_sha256`` digests the repaired ``role:text`` lines.

    Conversations are dealt to tasks by ranges of (conversation, turn, role, text), so that one of any length spreads, as do
    rows alike in all of these. Most lie wholly in a task and are repaired there. Those that ranges cut, two per
    task at most, are done in stretches: their duplicates by a grouping, the costs through each stretch as a matrix, the
    matrices joined on the driver, each stretch searched between the costs known at its ends. Only the digest, which has
    to read the texts in order, streams such a conversation through one task, a row at a time.

    Null ids form one conversation. Null turns come first; equal turns are ordered by role and text. Repeated rows are
    duplicates but for the first. Empty and blank texts are blank rows. A conversation without rows has zeros, an
    empty audit and the digest of an empty text. An empty table gives an empty result. Other columns aren't read. The audit
    is one value, so a conversation may have 2 ** 31 rows at most.
    """
    rows = rows.select("conv", "at", "role", "text").withColumn("look", look_of(F.col("role"), F.col("text")))
    head = F.substring("text", 1, 64)  # in the order of the whole texts, and short
    dealt = rows.repartitionByRange("conv", "at", "role", head, F.monotonically_increasing_id())
    dealt = checkpointed(dealt.sortWithinPartitions("conv", "at", "role", "text"))
    kind, arrow_kind = dealt.schema["conv"].dataType.simpleString(), to_arrow_type(dealt.schema["conv"].dataType)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for batch in batches:
            if batch.num_rows:
                conv = batch.column("conv")
                first, last = first or (conv[0].as_py(),), (conv[-1].as_py(),)
        if first is not None:
            convs = pa.array(list(dict.fromkeys([*first, *last])), arrow_kind)
            yield pa.RecordBatch.from_arrays([convs], ["conv"])

    met = Counter(r["conv"] for r in dealt.select("conv").mapInArrow(ends, f"conv {kind}").collect())
    cut = {conv for conv, n in met.items() if n > 1}
    result = f"conv {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        known: dict[bytes, tuple[float, str, int]] = {}
        for conv, held in _conversations(batches, cut):
            out.append({"conv": conv} | repaired(held, known))
            if len(out) == 2000:
                yield _as_batch(out, arrow_kind)
                out = []
        if out:
            yield _as_batch(out, arrow_kind)

    found = dealt.mapInArrow(repair, result)
    if cut:
        found = found.unionByName(_repair_cut(dealt, cut, kind, arrow_kind, result))
    return found.withColumnRenamed("conv", id_col)


def _as_batch(rows: list[dict], arrow_kind: pa.DataType) -> pa.RecordBatch:
    fields = [("conv", arrow_kind), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())]
    return pa.RecordBatch.from_pylist(rows, pa.schema(fields))


def _conversations(batches: Iterator[pa.RecordBatch], others: set) -> Iterator[tuple[object, list[dict]]]:
    """Rows of a sorted partition by conversation, those of ``others`` left out."""
    conv, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["conv"] in others:
                continue
            if held and row["conv"] != conv:
                yield conv, held
                held = []
            conv = row["conv"]
            held.append(row)
    if held:
        yield conv, held


def _search_known(looks: bytes, known: dict[bytes, tuple[float, str, int]]) -> tuple[float, str, int]:
    """``search``; ``known`` remembers REMEMBERED short conversations, which are often alike."""
    if len(looks) > 100:
        return search(looks)
    if looks not in known:
        if len(known) >= REMEMBERED:
            known.clear()
        known[looks] = search(looks)
    return known[looks]


def repaired(held: list[dict], known: dict) -> dict:
    """The result for one conversation, its rows in order."""
    rows = [r for r in held if r["role"] is not None]
    seen: set[tuple[str, str]] = set()
    looks, faults = bytearray(), [0, 0, 0, 0]
    for r in rows:
        look, key = r["look"], (r["role"], r["text"])
        duplicate = look % 3 != MUST_GO and key in seen
        seen.add(key)
        faults[3 if duplicate else look % 3] += 1
        looks.append(look - look % 3 + MUST_GO if duplicate else look)
    initials = [r["role"][:1] for r in rows]
    turns = {r["at"] for r in rows} - {None}
    cost, audit, _ = _search_known(bytes(looks), known)
    repairer, at = Repairer(), iter(rows)
    for letter in audit:
        if letter == "I":
            repairer.insert()
        else:
            r = next(at)
            repairer.row(letter, r["role"], r["text"])
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        "blank": faults[MUST_GO], "duplicate": faults[3], "truncated": faults[TRUNCATED],
        "illegal": sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:], strict=False)),
        "cost": int(cost), "audit": audit, "repaired_sha256": repairer.sha.hexdigest(),
    }


def _repair_cut(dealt: DataFrame, cut: set, kind: str, arrow_kind: pa.DataType, result: str) -> DataFrame:
    """``repair_conversations`` for those that lie in several partitions of ``dealt``."""
    spark = dealt.sparkSession

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, at = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            rows = [r for r in batch.to_pylist() if r["conv"] in cut and r["role"] is not None]
            for r in rows:
                conv, at = r["conv"], at + 1 if r["conv"] == conv else 0
                r |= {"part": part, "idx": at}
            if rows:
                yield pa.RecordBatch.from_pylist(rows, batch.schema.append(pa.field("part", pa.int64())).append(pa.field("idx", pa.int64())))

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    rows = dealt.mapInArrow(pick, f"{columns}, part long, idx long")
    shown = lambda c: F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
    rows = checkpointed(rows.withColumn("alike", F.sha2(F.concat(shown("conv"), shown("role"), F.col("text")), 256)))

    # Rows seen earlier: groups are combined before the shuffle, and their rows looked up whatever the size of a group.
    places = rows.select("alike", "conv", "part", "idx")
    firsts = places.groupBy("alike").agg(F.min(F.struct("part", "idx")).alias("first"), F.count("*").alias("size"))
    firsts = checkpointed(firsts.filter("size > 1"))
    later = look_up(places, firsts, "alike", "size").filter(F.struct("part", "idx") > F.col("first"))
    later = later.select(F.col("conv").alias("c"), F.col("part").alias("p"), F.col("idx").alias("i"))
    here = F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("idx") == F.col("i"))
    fault, duplicate = F.col("look") % 3, F.col("p").isNotNull() & (F.col("look") % 3 != MUST_GO)
    seen = rows.select("conv", "part", "idx", "at", "look", F.substring("role", 1, 1).alias("initial")).join(later, here, "left")
    seen = checkpointed(seen.select("conv", "part", "idx", "at", "look", "initial", duplicate.alias("duplicate")))

    count = lambda condition: F.count(F.when(condition, 1))
    turns = seen.groupBy("conv", "at").agg(F.lit(1).alias("one"))
    turns = turns.groupBy("conv").agg((F.max("at") - F.min("at") + 1 - F.count("at")).alias("gaps"))
    counts = seen.groupBy("conv").agg(
        count(fault == MUST_GO).alias("blank"), count(F.col("duplicate")).alias("duplicate"), count((fault == TRUNCATED) & ~F.col("duplicate")).alias("truncated")
    )

    def looks_of(table: pa.Table) -> bytes:
        look, gone = table.column("look").to_pylist(), table.column("duplicate").to_pylist()
        return bytes(k - k % 3 + MUST_GO if d else k for k, d in zip(look, gone, strict=True))

    def measure(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        initials = table.column("initial").to_pylist()
        illegal = sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:], strict=False))
        through = [x for row in costs_through(looks_of(table)) for x in row]
        out = [[k.as_py()] for k in key] + [[initials[0]], [initials[-1]], [illegal], [through]]
        return pa.Table.from_arrays([pa.array(out[0], arrow_kind), *map(pa.array, out[1:])], ["conv", "part", "first", "last", "illegal", "through"])

    stretches = seen.groupBy("conv", "part")
    met = stretches.applyInArrow(measure, f"conv {kind}, part long, first string, last string, illegal long, through array<double>").collect()
    chains: dict[object, list] = defaultdict(list)
    for r in sorted(met, key=lambda r: r["part"]):
        chains[r["conv"]].append(r)
    exits, costs, illegal = {}, {}, {}
    for conv, chain in chains.items():
        rest = at_the_end()
        for k, r in reversed(list(enumerate(chain))):
            exits[conv, r["part"]] = (tuple(ENDS if k == len(chain) - 1 else rest), k == len(chain) - 1)
            rest = [min(r["through"][4 * e + x] + rest[x] for x in range(4)) for e in range(4)]
        costs[conv] = int(rest[START])
        illegal[conv] = sum(r["illegal"] for r in chain) + sum(a["last"] + b["first"] not in LEGAL_PAIRS for a, b in zip(chain, chain[1:], strict=False))

    def edits(key: tuple, table: pa.Table) -> pa.Table:
        conv, part = (k.as_py() for k in key)
        after, last = exits[conv, part]
        looks = looks_of(table.sort_by("idx"))
        found = [(e, *search(looks, e, after, last)) for e in range(4)]
        found = [(e, end, audit) for e, cost, audit, end in found if cost < math.inf]
        names = ["conv", "part", "entry", "end", "audit"]
        columns = [pa.array([conv] * len(found), arrow_kind), pa.array([part] * len(found)), *(pa.array([f[k] for f in found]) for k in range(3))]
        return pa.Table.from_arrays(columns, names)

    ways = checkpointed(stretches.applyInArrow(edits, f"conv {kind}, part long, entry long, end long, audit string"))
    ends = {(r["conv"], r["part"], r["entry"]): r["end"] for r in ways.select("conv", "part", "entry", "end").collect()}
    taken = []
    for conv, chain in chains.items():
        state = START
        for r in chain:
            taken.append((conv, r["part"], state))
            state = ends[conv, r["part"], state]
    chosen = spark.createDataFrame(taken, f"c {kind}, p long, e long")
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("entry") == F.col("e"))
    pieces = ways.join(chosen, same, "left_semi").select("conv", "part", "audit")
    ordered = F.sort_array(F.collect_list(F.struct("part", "audit")))
    audits = pieces.groupBy("conv").agg(F.concat_ws("", F.transform(ordered, lambda x: x["audit"])).alias("audit"))

    steps = pieces.select(
        F.col("conv").alias("c"), F.col("part").alias("p"),
        F.posexplode(F.regexp_extract_all("audit", F.lit("(I*[KRD]|I+$)"), F.lit(1))).alias("i", "step"),
    )
    lines = steps.join(rows.select("conv", "part", "idx", "role", "text"), here, "left")
    kept = ~F.col("step").endswith("D")
    lines = lines.select(F.col("c").alias("conv"), "p", "i", "step", "role", F.when(kept, F.col("text")).alias("text"))
    lines = lines.repartition("conv").sortWithinPartitions("conv", "p", "i")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, repairer = None, None
        for row in (r for b in batches for r in b.to_pylist()):
            if repairer is None or row["conv"] != conv:
                if repairer is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([conv], arrow_kind), pa.array([repairer.sha.hexdigest()])], ["conv", "repaired_sha256"])
                conv, repairer = row["conv"], Repairer()
            for letter in row["step"]:
                if letter == "I":
                    repairer.insert()
                else:
                    repairer.row(letter, row["role"], row["text"])
        if repairer is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], arrow_kind), pa.array([repairer.sha.hexdigest()])], ["conv", "repaired_sha256"])

    digests = lines.mapInArrow(digest, f"conv {kind}, repaired_sha256 string")
    known = spark.createDataFrame([(c, costs.get(c, 0), illegal.get(c, 0)) for c in cut], f"conv {kind}, cost long, illegal long")
    for side in (turns, counts, audits, digests):
        known = known.withColumnRenamed("conv", "c")
        known = known.join(side, F.col("c").eqNullSafe(F.col("conv")), "left").drop("conv").withColumnRenamed("c", "conv")
    known = known.fillna(0, [c for c in COUNTS]).fillna({"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()})
    return known.select("conv", *[F.col(c).cast("long").alias(c) for c in COUNTS], "audit", "repaired_sha256")

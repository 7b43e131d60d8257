"""Chat formatting: a hidden Markov model recovers who speaks in each line; turns are rendered in one form."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.tables import checkpointed, text_or_empty

ROLES = ("system", "user", "assistant")
#: Names under which transcripts know the roles.
NAMES = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "customer", "question", "q", "prompter"),
    "assistant": ("assistant", "ai", "bot", "agent", "gpt", "model", "answer", "a"),
}
_ROLE_OF = {name: i for i, role in enumerate(ROLES) for name in NAMES[role]}
#: A line that begins with a speaker's name, perhaps in bold or as a heading, and a colon.
_MARKER = re.compile(r"\s*(?:\*\*|#+ *|<\|?|\[)?(" + "|".join(sorted(_ROLE_OF, key=len, reverse=True)) + r")(?:\*\*|\|?>|\])? ?:(?:\*\*)? ?", re.I)


def _logs(*shares: float) -> tuple[float, ...]:
    return tuple(math.log(s) for s in shares)


#: Who speaks first.
FIRST = _logs(0.3, 0.6, 0.1)
#: Who speaks next where a message or a marked line begins, after system, user, assistant.
NEXT = (_logs(0.05, 0.9, 0.05), _logs(0.01, 0.09, 0.9), _logs(0.01, 0.9, 0.09))
#: The same within a message, where no line is marked.
WITHIN = (_logs(0.98, 0.01, 0.01), _logs(0.005, 0.99, 0.005), _logs(0.005, 0.005, 0.99))
#: A marker's name given the speaker: right, or one of the others.
RIGHT, WRONG = math.log(0.96), math.log(0.02)
#: Given the speaker: a line that ends in a question mark, one of over LONG characters.
ASKS = _logs(0.02, 0.3, 0.08)
ASKS_NOT = _logs(0.98, 0.7, 0.92)
LONG = 300
LONG_LINE = _logs(0.2, 0.15, 0.45)
SHORT_LINE = _logs(0.8, 0.85, 0.55)

Line = tuple[bool, tuple[float, ...]]
Matrix = list[list[float]]


def read_lines(role: str | None, text: str) -> tuple[list[str], list[Line]]:
    """The lines of a message without their markers, and what the model sees: (begins a turn?, log-likelihoods)."""
    contents, seen = [], []
    for k, line in enumerate(text.split("\n")):
        marker = _MARKER.match(line)
        speaker = _ROLE_OF[marker[1].lower()] if marker else None
        content = line[marker.end() :] if marker else line
        known = _ROLE_OF.get((role or "").strip().lower()) if k == 0 else None
        score = [0.0] * 3
        for name in (speaker, known):
            if name is not None:
                score = [s + (RIGHT if r == name else WRONG) for r, s in enumerate(score)]
        asks = ASKS if content.rstrip().endswith("?") else ASKS_NOT
        long = LONG_LINE if len(content) > LONG else SHORT_LINE
        contents.append(content)
        seen.append((k == 0 or speaker is not None, tuple(s + a + b for s, a, b in zip(score, asks, long, strict=True))))
    return contents, seen


def step(scores: list[float], line: Line) -> tuple[list[float], list[int]]:
    """Best score of each role after a line, and the role before that leads to it."""
    begins, seen = line
    moves = NEXT if begins else WITHIN
    best, came = [], []
    for j in range(3):
        options = [scores[i] + moves[i][j] for i in range(3)]
        i = max(range(3), key=options.__getitem__)
        best.append(options[i] + seen[j])
        came.append(i)
    return best, came


def first_step(line: Line) -> list[float]:
    return [f + s for f, s in zip(FIRST, line[1], strict=True)]


def matrix_of(lines: list[Line], continues: bool) -> Matrix:
    """Best scores through a stretch of lines, from each role before it to each role at its end."""
    out = []
    for i in range(3):
        if continues:
            scores = [0.0 if j == i else -math.inf for j in range(3)]
            rest = lines
        else:
            scores, rest = first_step(lines[0]), lines[1:]
        for line in rest:
            scores = step(scores, line)[0]
        out.append(scores)
    return out


def viterbi(lines: list[Line], before: int | None = None, last: int | None = None) -> list[int]:
    """The likeliest roles of the lines; ``before`` and ``last``, if known, are those just before and of the last one."""
    if before is None:
        scores, rest = first_step(lines[0]), lines[1:]
    else:
        scores, rest = [0.0 if j == before else -math.inf for j in range(3)], lines
    trail = []
    for line in rest:
        scores, came = step(scores, line)
        trail.append(came)
    role = max(range(3), key=scores.__getitem__) if last is None else last
    path = [role]
    for came in reversed(trail):
        path.append(came[path[-1]])
    path.reverse()
    return path if before is None else path[1:]


def joined_ends(stretches: list[tuple[int, bool, str, Matrix]]) -> dict[tuple[int, bool], tuple[int | None, int]]:
    """For conversations that partitions cut: (role before, role at the end) of each stretch.

    ``stretches`` holds the first and the last one of each partition as (partition, is the first?, conversation, best
    scores); one that is both counts as the first. There are two per partition at most.
    """
    found: dict[tuple[int, bool], tuple[int | None, int]] = {}
    chain: list[tuple[int, bool, str, Matrix]] = []

    def close() -> None:
        if len(chain) < 2:
            return
        scores, trail = chain[0][3][0], []
        for _, _, _, m in chain[1:]:
            options = [[scores[i] + m[i][j] for i in range(3)] for j in range(3)]
            trail.append([max(range(3), key=o.__getitem__) for o in options])
            scores = [max(o) for o in options]
        roles = [max(range(3), key=scores.__getitem__)]
        for came in reversed(trail):
            roles.append(came[roles[-1]])
        roles.reverse()
        for k, (p, is_first, _, _) in enumerate(chain):
            found[p, is_first] = (roles[k - 1] if k else None, roles[k])

    for s in sorted(stretches, key=lambda s: (s[0], not s[1])):
        if chain and chain[-1][2] != s[2]:
            close()
            chain = []
        chain.append(s)
    close()
    return found


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[dict]]]:
    """Rows of a sorted partition by conversation."""
    key, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["key"] != key:
                yield key, held
                held = []
            key = row["key"]
            held.append(row)
    if held:
        yield key, held


def _observed(rows: list[dict]) -> list[Line]:
    return [line for row in rows for line in read_lines(row["role"], row["text"])[1]]


def format_chats(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``turns``: id_col, turn_col, role (of its first line), n_lines, n_turns, rendered.

    A message's lines are observations: speaker markers, the role column if it names a role, question marks, lengths.
    Viterbi's algorithm gives the likeliest speakers of the whole conversation. Where the speaker changes or a message
    begins, a canonical turn begins: ``<|role|>`` and a line break before its text, markers left out. n_turns counts
    those in the message; the conversation is its messages' ``rendered`` in order, joined by line breaks.

    Conversations are dealt to partitions by ranges of (conversation, turn, text), so that a very long one spreads.
    What a partition cuts is put together from the best scores between all roles over each part: two small
    matrices per partition come to the driver.

    Null texts count as empty, null roles as unknown. Rows with a null id form one conversation; null turns come first.
    Rows with equal id and turn are ordered by text and role; repeated rows are messages like others. An empty table
    gives an empty result. Other columns are neither read nor returned.
    """
    kind_id, kind_turn = (turns.schema[c].dataType.simpleString() for c in (id_col, turn_col))
    rows = turns.select(
        F.col(id_col).alias("conv"), F.coalesce(F.col(id_col).cast("string"), F.lit("\u0000")).alias("key"),
        F.col(turn_col).alias("at"), F.col(role_col).cast("string").alias("role"), text_or_empty(text_col).alias("text"),
    )
    rows = rows.withColumn("tie", F.xxhash64("text"))
    order = ["key", "at", "tie", "text", "role"]
    rows = checkpointed(rows.repartitionByRange("key", "at", "tie").sortWithinPartitions(*order).drop("tie"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, ends = TaskContext.get().partitionId(), []
        for key, held in _conversations(batches):
            lines = _observed(held)
            ends = [*ends[:1], (key, matrix_of(lines, True), matrix_of(lines, False))] if len(ends) < 1 else [ends[0], (key, lines)]
        if not ends:
            return
        out = [(partition, True, *ends[0])]
        if len(ends) > 1:
            key, lines = ends[1]
            out.append((partition, False, key, matrix_of(lines, True), matrix_of(lines, False)))
        flat = lambda m: [x for row in m for x in row]
        yield pa.RecordBatch.from_pydict({
            "partition": [o[0] for o in out], "is_first": [o[1] for o in out], "key": [o[2] for o in out],
            "inner": [flat(o[3]) for o in out], "outer": [flat(o[4]) for o in out],
        })

    sides = "partition long, is_first boolean, key string, inner array<double>, outer array<double>"
    found = rows.mapInArrow(measure, sides).collect()
    square = lambda m: [list(m[i : i + 3]) for i in (0, 3, 6)]
    stretches, before = [], None
    for r in sorted(found, key=lambda r: (r["partition"], not r["is_first"])):
        stretches.append((r["partition"], r["is_first"], r["key"], square(r["inner"] if r["key"] == before else r["outer"])))
        before = r["key"]
    known = joined_ends(stretches)
    firsts = {s[0]: s[2] for s in stretches if s[1]}
    lasts = {s[0]: s[2] for s in stretches if not s[1]}

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        out: list[dict] = []
        for key, held in _conversations(batches):
            if key == firsts.get(partition):
                before, last = known.get((partition, True), (None, None))
            elif key == lasts.get(partition):
                before, last = known.get((partition, False), (None, None))
            else:
                before = last = None
            roles = iter(viterbi(_observed(held), before, last))
            for row in held:
                out.append(_rendered(row, roles))
                if len(out) >= 2000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    kinds = f"conv {kind_id}, at {kind_turn}, role string, n_lines long, n_turns long, rendered string"
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(rows.select("conv", "at").limit(0).selectExpr("conv", "at", "'' AS role", "0L AS n_lines", "0L AS n_turns", "'' AS rendered").schema)
    return rows.mapInArrow(render, kinds).withColumnsRenamed({"conv": id_col, "at": turn_col})


def _rendered(row: dict, roles: Iterator[int]) -> dict:
    contents, seen = read_lines(row["role"], row["text"])
    path = [next(roles) for _ in contents]
    parts, n_turns = [], 0
    for k, content in enumerate(contents):
        if k == 0 or seen[k][0] or path[k] != path[k - 1]:
            parts.append(f"<|{ROLES[path[k]]}|>")
            n_turns += 1
        parts.append(content)
    return {
        "conv": row["conv"], "at": row["at"], "role": ROLES[path[0]], "n_lines": len(contents), "n_turns": n_turns,
        "rendered": "\n".join(parts),
    }

"""Substring dedup: removal of word windows that occur elsewhere, found by suffix automata of reference shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.tables import CHUNK_BITS, bitmap_size, bitmap_table, checkpointed, look_up, text_or_empty, with_bit
from lotwise.llm.words import Words, covered, groups

#: Words in a window; a run of repeated windows is removed as one span.
WINDOW = 35
#: Words in a gram. Every window holds some; the one with the smallest hash stands for it.
GRAM = 20
#: Windows in a piece, at most: as many as can share a gram.
PIECE = WINDOW - GRAM + 1
#: Filter bits per gram that occurs twice, and in all (32 MB). A fuller filter lets more windows through to the
#: automata, which decide; the result is the same.
BITS_PER_GRAM, MOST_BITS = 16, 2**28
#: Words in the pieces of one automaton, about; only pieces of one gram are never parted.
SHARD_WORDS = 20_000
#: A gram with more different pieces than this has them cut into single windows, whatever the size of the input.
HEAVY_PIECES = 2_000


class Passages(Words):
    """Words of texts with exactly one blank between them, and the gram that stands for each window."""

    def __init__(self, column: pa.Array):
        super().__init__(column)
        if len(self.data):
            blank = np.ones(len(self.data) + 1, bool)
            change = np.zeros(len(self.data) + 1, np.int64)
            np.add.at(change, self.start, 1)
            np.add.at(change, self.end, -1)
            blank[:-1] = np.cumsum(change[:-1]) == 0
            after = np.zeros(len(self.data) + 1, bool)
            after[self.end] = True
            after[self.bounds] = False
            stays = (~blank | after)[:-1]
            data = np.where(blank[:-1], np.uint8(32), self.data)[stays]
            place = np.concatenate([[0], np.cumsum(stays)])
            self.data, self.bounds = data, place[self.bounds]
            self.start, self.end = place[self.start], place[self.end]
        self.grams_, at = self.grams(self.hashes(), GRAM)
        # A window begins at a gram whose next PIECE - 1 grams belong to the same text.
        n = max(len(at) - PIECE + 1, 0)
        whole = at[PIECE - 1 :] - at[:n] == PIECE - 1 if n else np.zeros(0, bool)
        self.windows = np.flatnonzero(whole)
        least = self.grams_
        for step in (1, 2, 4, 8):
            least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
        self.least = least[self.windows]
        self.first_word = at[self.windows]

    def standing(self) -> np.ndarray:
        """Grams that stand for a window, once for each place where they do."""
        highest = np.zeros(len(self.grams_), np.uint64)
        for k in range(PIECE):
            np.maximum.at(highest, self.windows + k, self.least)
        return self.grams_[(highest == self.grams_) & (highest > 0)]

    def words(self, first: int, last: int) -> bytes:
        return self.data[self.start[first] : self.end[last]].tobytes()

    def pieces(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First (index among the windows) and number of windows of each piece: runs of PIECE chosen ones at most, next
        to each other, that the same gram stands for."""
        at = np.flatnonzero(chosen)
        if not len(at):
            return at, at
        new = np.ones(len(at), bool)
        new[1:] = (self.first_word[at[1:]] != self.first_word[at[:-1]] + 1) | (self.least[at[1:]] != self.least[at[:-1]])
        run = np.flatnonzero(new)
        offset = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
        begins = np.flatnonzero(offset % PIECE == 0)
        return at[begins], np.diff(np.append(begins, len(at)))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, mark, text): rows with equal id and mark have the same text, so they share their result."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return rows.select("id", F.xxhash64("id", "text").alias("mark"), "text")


def repeated_grams(rows: DataFrame) -> DataFrame:
    """(gram): those that stand for windows in two places at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in groups(batch.column("text")):
                grams, n = np.unique(Passages(batch.column("text")[lo:hi]).standing(), return_counts=True)
                yield pa.RecordBatch.from_pydict({"gram": grams.view(np.int64), "n": n.astype(np.int64)})

    counted = rows.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return counted.filter("n > 1").select("gram")


def gram_filter(grams: DataFrame) -> tuple[Broadcast, int]:
    """A hash filter of the grams, of MOST_BITS at most, for all tasks."""
    grams = checkpointed(grams)
    bits = bitmap_size(grams.count(), BITS_PER_GRAM, MOST_BITS)
    chunks = bitmap_table(grams.select(F.pmod("gram", F.lit(bits)).alias("slot")), "slot").collect()
    whole = np.zeros(bits // 8, np.uint8)
    for row in chunks:
        whole[row["chunk"] * CHUNK_BITS // 8 :][: CHUNK_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    return grams.sparkSession.sparkContext.broadcast(whole.tobytes()), bits


def suspect_spans(rows: DataFrame, known: Broadcast, bits: int) -> DataFrame:
    """(id, mark, first, text): runs of windows that a repeated gram stands for; first is the index of the first word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.frombuffer(known.value, np.uint8)
        for batch in batches:
            for lo, hi in groups(batch.column("text")):
                p = Passages(batch.column("text")[lo:hi])
                slot = (p.least.view(np.int64) % bits).astype(np.int64)
                at = np.flatnonzero((filled[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
                firsts = p.first_word[at]
                new = np.flatnonzero(np.append(True, firsts[1:] != firsts[:-1] + 1)) if len(at) else at
                a, b = firsts[new], firsts[np.append(new[1:], len(at)) - 1] + WINDOW - 1 if len(at) else firsts
                text = p.text[a]
                own = batch.select(["id", "mark"]).slice(lo, hi - lo).take(pa.array(text))
                values = [own.column("id"), own.column("mark"), pa.array(a - p.first[text], pa.int64())]
                texts = pa.array([p.words(i, j).decode() for i, j in zip(a, b, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([*values, texts], ["id", "mark", "first", "text"])

    return rows.mapInArrow(run, f"id {_kind(rows)}, mark long, first long, text string")


def _kind(rows: DataFrame) -> str:
    return rows.schema["id"].dataType.simpleString()


def span_pieces(spans: DataFrame) -> DataFrame:
    """(id, mark, first, gram, text): the spans cut where another gram stands for the window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in groups(batch.column("text")):
                p = Passages(batch.column("text")[lo:hi])
                at, n = p.pieces(np.ones(len(p.windows), bool))
                a = p.first_word[at]
                text = p.text[a]
                own = batch.select(["id", "mark", "first"]).slice(lo, hi - lo).take(pa.array(text))
                first = own.column("first").to_numpy() + a - p.first[text]
                texts = pa.array([p.words(i, i + k + WINDOW - 2).decode() for i, k in zip(a, n, strict=True)], pa.string())
                columns = [own.column("id"), own.column("mark"), pa.array(first, pa.int64()), pa.array(p.least[at].view(np.int64)), texts]
                yield pa.RecordBatch.from_arrays(columns, ["id", "mark", "first", "gram", "text"])

    return spans.mapInArrow(run, f"id {_kind(spans)}, mark long, first long, gram long, text string")


def single_windows(pieces: DataFrame) -> DataFrame:
    """The pieces' windows, each as a row of its own; ``first``, where there is such a column, moves along."""
    words = F.split("text", " ")
    each = pieces.withColumn("words", words).withColumn("k", F.explode(F.sequence(F.lit(0), F.size("words") - WINDOW)))
    each = each.withColumn("text", F.array_join(F.slice("words", F.col("k") + 1, WINDOW), " "))
    if "first" in pieces.columns:
        each = each.withColumn("first", F.col("first") + F.col("k"))
    return each.drop("words", "k")


class Automaton:
    """Suffix automaton of word sequences, with the number of places where each sequence ends."""

    def __init__(self):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, follows: dict[str, int], link: int) -> int:
        self.next.append(follows)
        self.length.append(length)
        self.link.append(link)
        self.count.append(0)
        return len(self.length) - 1

    def _split(self, state: int, word: str, long: int) -> int:
        """The state that ``word`` leads to from ``state``, parted so that its longest sequence is the one through here."""
        if self.length[long] == self.length[state] + 1:
            return long
        copy = self._state(self.length[state] + 1, dict(self.next[long]), self.link[long])
        self.link[long] = copy
        while state >= 0 and self.next[state].get(word) == long:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def add(self, words: list[str], times: int) -> list[int]:
        """Take in a sequence that occurs so many times; the states after each of its words."""
        last, ends = 0, []
        for word in words:
            known = self.next[last].get(word)
            if known is not None:
                last = self._split(last, word, known)
            else:
                new, state = self._state(self.length[last] + 1, {}, 0), last
                while state >= 0 and word not in self.next[state]:
                    self.next[state][word] = new
                    state = self.link[state]
                if state >= 0:
                    self.link[new] = self._split(state, word, self.next[state][word])
                last = new
            self.count[last] += times
            ends.append(last)
        return ends

    def total(self) -> None:
        """Add up the places: where a sequence ends, its ends do too."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[state]] += self.count[state]

    def twice(self, state: int) -> bool:
        """Whether the last WINDOW words before this state end in more than one place."""
        while self.length[self.link[state]] >= WINDOW:
            state = self.link[state]
        return self.count[state] > 1


def shard_masks(pieces: list[tuple[str, int]]) -> list[int]:
    """For each piece (text, how often it occurs), a bit for each of its windows that has another place."""
    automaton = Automaton()
    ends = [automaton.add(text.split(" "), n) for text, n in pieces]
    automaton.total()
    return [sum(1 << k for k, state in enumerate(e[WINDOW - 1 :]) if automaton.twice(state)) for e in ends]


def alone_mask(text: str, n: int) -> int | None:
    """``shard_masks`` for a piece that has a shard for itself, where it is plain: all windows of one that occurs
    elsewhere, none of one whose words are too many to repeat inside it. A window that stands in it twice, at
    most PIECE - 1 words apart, would have no more different words than that."""
    words = text.split(" ")
    if n > 1:
        return (1 << (len(words) - WINDOW + 1)) - 1
    return 0 if len(set(words)) >= PIECE else None


def match_pieces(pieces: DataFrame) -> DataFrame:
    """(piece, n, mask) of the pieces (shard, text, n) with a repeated window; all pieces of a shard meet in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("shard", "text", "n")), strict=True))
        held: list[tuple[str, int]] = []
        alone: list[tuple[str, int, int]] = []
        words = 0
        for _, group in groupby(rows, key=lambda r: r[0]):
            own = [(text, n) for _, text, n in group]
            mask = alone_mask(*own[0]) if len(own) == 1 else None
            if mask is not None:
                alone += [(*own[0], mask)] if mask else []
            else:
                held += own
                words += sum(text.count(" ") + 1 for text, _ in own)
            if words >= SHARD_WORDS or len(alone) >= 1000:
                yield _matched(held, alone)
                held, alone, words = [], [], 0
        yield _matched(held, alone)

    return pieces.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "piece binary, n long, mask long")


def _matched(held: list[tuple[str, int]], alone: list[tuple[str, int, int]]) -> pa.RecordBatch:
    masked = [*alone, *((t, n, m) for (t, n), m in zip(held, shard_masks(held), strict=True) if m)]
    found = [(hashlib.md5(t.encode()).digest(), n, m) for t, n, m in masked]
    kinds = [("piece", pa.binary()), ("n", pa.int64()), ("mask", pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, (_, k) in enumerate(kinds)], [n for n, _ in kinds])


def _slot(bits: int) -> Column:
    return F.pmod("gram", F.lit(bits)).alias("slot")


def _by_weight(pieces: DataFrame, heavy: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """Pieces that stay whole, and those to be cut: of heavy grams, and of the few others that share a slot with one.

    Which it is follows from the gram alone, so all places of a window go the same way. Pieces stay where they are.
    """
    flagged = with_bit(pieces.withColumn("slot", _slot(bits)), "slot", heavy, "heavy").drop("slot")
    return flagged.filter("not heavy").drop("heavy"), flagged.filter("heavy").drop("heavy")


def repeated_windows(rows: DataFrame) -> DataFrame:
    """(id, mark, runs): where repeated windows stand, as (first word, mask of the windows from there on)."""
    spans = checkpointed(suspect_spans(rows, *gram_filter(repeated_grams(rows))))
    pieces = span_pieces(spans)
    unique = checkpointed(pieces.groupBy("gram", "text").agg(F.count("*").alias("n")))
    many = checkpointed(unique.groupBy("gram").count().filter(F.col("count") > HEAVY_PIECES).select("gram"))
    bits = bitmap_size(many.count(), BITS_PER_GRAM, MOST_BITS)
    heavy = checkpointed(bitmap_table(many.select(_slot(bits)), "slot"))
    whole, cut = _by_weight(unique, heavy, bits)
    windows = single_windows(cut).groupBy("text").agg(F.sum("n").alias("n"))
    shards = whole.select(F.col("gram").alias("shard"), "text", "n")
    matched = checkpointed(match_pieces(shards.unionByName(windows.select(F.xxhash64("text").alias("shard"), "text", "n"))))
    # The pieces are made a second time, in one pass for both kinds.
    flagged = with_bit(pieces.withColumn("slot", _slot(bits)), "slot", heavy, "heavy")
    words = F.split("text", " ")
    starts = F.when(F.col("heavy"), F.sequence(F.lit(0), F.size(words) - WINDOW)).otherwise(F.array(F.lit(0)))
    each = flagged.withColumn("k", F.explode(starts))
    window = F.when(F.col("heavy"), F.concat_ws(" ", F.slice(words, F.col("k") + 1, WINDOW))).otherwise(F.col("text"))
    places = checkpointed(each.select("id", "mark", (F.col("first") + F.col("k")).alias("first"), F.unhex(F.md5(window)).alias("piece")))
    found = look_up(places, matched, "piece", "n")
    return found.groupBy("id", "mark").agg(F.collect_set(F.struct("first", "mask")).alias("runs"))


def _removing(batches: Iterator[pa.RecordBatch], text_too: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in groups(batch.column("text")):
            part = batch.slice(lo, hi - lo)
            p = Words(part.column("text"))
            starts = []
            runs = part.column("runs")
            lists = runs.is_valid().to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(lists):
                for r in runs[int(i)].as_py():
                    starts += [p.first[i] + r["first"] + k for k in range(PIECE) if r["mask"] >> k & 1]
            gone = covered(len(p.text), np.array(starts, np.int64), WINDOW)
            n_removed = np.bincount(p.text[gone], minlength=p.n)
            data, texts = p.data.tobytes(), []
            for i in range(p.n):
                at = np.flatnonzero(~gone[p.first[i] : p.first[i + 1]]) + p.first[i]
                texts.append(b" ".join([data[a:b] for a, b in zip(p.start[at].tolist(), p.end[at].tolist(), strict=True)]))
            columns = [part.column("id"), pa.array(p.n_words, pa.int64()), pa.array(n_removed, pa.int64())]
            columns.append(pa.array([t.decode() for t in texts] if text_too else [hashlib.sha256(t).hexdigest() for t in texts], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_removed", "kept"])


def _result(docs: DataFrame, id_col: str, text_col: str, text_too: bool) -> DataFrame:
    rows = _keyed(docs, id_col, text_col)
    runs = checkpointed(repeated_windows(rows))
    # Texts without a repeated window stay where they are: a filter of the marks tells most of them apart.
    bits = bitmap_size(runs.count(), BITS_PER_GRAM, 2**32)
    slot = F.pmod("mark", F.lit(bits)).alias("slot")
    touched = checkpointed(bitmap_table(runs.select(slot), "slot"))
    flagged = with_bit(rows.withColumn("slot", F.pmod("mark", F.lit(bits))), "slot", touched, "touched").drop("slot")
    none = F.lit(None).cast(runs.schema["runs"].dataType).alias("runs")
    alone = flagged.filter("not touched").select("id", "text", none)
    r = runs.select(F.col("id").alias("r_id"), F.col("mark").alias("r_mark"), "runs")
    both = flagged.filter("touched").join(r, F.expr("id <=> r_id and mark = r_mark"), "left").select("id", "text", "runs")
    kinds = f"id {_kind(rows)}, n_words long, n_removed long, kept string"
    out = [df.mapInArrow(lambda b: _removing(b, text_too), kinds) for df in (alone, both)]
    return out[0].unionByName(out[1]).withColumnRenamed("id", id_col)


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, n_words, n_removed, kept (the words that stay, joined by one blank).

    A window is WINDOW consecutive words of one text; words are runs of anything but ASCII blanks. All words in
    windows that occur more than once, be it in one text or several, go, at every place. Each window is represented by
    the gram in it with the smallest hash. Only windows of grams that occur twice are looked at further: cut into pieces
    that share a gram, they are sent to the shard of that gram, whose suffix automaton has the number of places of
    each window. Nothing is sampled or capped: a gram with very many pieces has them cut into windows, which
    spread over all shards.

    Null counts as empty; texts of fewer than WINDOW words stay whole. Repeated rows repeat each other, so both lose
    their windows. An empty table gives an empty result. Other columns are neither read nor returned.
    """
    return _result(docs, id_col, text_col, True)


def removal_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``remove_repeated`` with kept_sha256 (SHA-256 of the UTF-8 text, lowercase hex) in the place of kept."""
    return _result(docs, id_col, text_col, False).withColumnRenamed("kept", "kept_sha256")

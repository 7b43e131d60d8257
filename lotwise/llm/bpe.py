"""BPE encoding and decoding as a streaming transducer with bounded lookahead."""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.tables import kept_in_process, lean, text_or_empty

#: Encoded words that a task remembers, in two generations of so many.
REMEMBERED = 80_000
#: White space as the tokenizer's patterns understand it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed value: what the tokenizer treats as a word.
WORD = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"


#: Characters beyond the basic plane.
_BEYOND = re.compile("[\U00010000-\U0010ffff]")


def char_class(chars: Iterable[str]) -> str:
    """What stands in brackets of a pattern for just these characters of the basic plane. Python's patterns look such a class
    up in a table, whatever its size."""
    runs: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if runs and runs[-1][1] == code - 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in runs)


def plane_word() -> re.Pattern:
    """WORD for texts without characters beyond the basic plane, with its classes spelled out."""
    plane = "".join(chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000)
    space, letter, number = (char_class(regex.findall(p, plane)) for p in (f"[{SPACE}]", r"\p{L}", r"\p{N}"))
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{space}{letter}{number}]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 characters for themselves, others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@dataclass
class Vocabulary:
    """What the file of a tokenizer says: ids of tokens, ranks of merges, strings that are never cut."""

    ids: dict[str, int]
    ranks: dict[tuple[str, str], int]
    special: dict[str, int]
    suffix: str

    @classmethod
    def parse(cls, text: str) -> Vocabulary:
        file = json.loads(text)
        model = file["model"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        return cls(model["vocab"], {p: i for i, p in enumerate(pairs)}, special, model["end_of_word_suffix"] or "")

    def lookahead(self) -> int:
        """Symbols beyond a token's end that can still change it.

        Whether a merge (x, y) takes place can depend on what follows only if an earlier merge (s, z) takes s, the
        end of y, away from it; whether that one takes place, in turn, on an earlier one still. The longest such
        chain, over ever earlier merges, bounds the text that it spans. Ends of y are y itself, the right part of the
        merge that makes y, that one's right part, and so on.
        """
        right = {x + y: y for x, y in self.ranks}
        size = lambda token: len(token) - (len(self.suffix) if self.suffix and token.endswith(self.suffix) else 0) + bool(self.suffix and token.endswith(self.suffix))
        longest: dict[str, int] = {}  # by left part, over the merges so far
        most = 1
        for x, y in self.ranks:
            end, beyond = y, 0
            while end is not None:
                beyond = max(beyond, longest.get(end, 0))
                end = right.get(end)
            span = size(y) + beyond
            longest[x] = max(longest.get(x, 0), span)
            most = max(most, span)
        return most


class Transducer:
    """Merges symbols as they come; a token leaves as soon as nothing that may follow can change it."""

    def __init__(self, ranks: dict[tuple[str, str], int], lookahead: int):
        self.ranks, self.lookahead = ranks, lookahead

    def merge(self, symbols: list[str]) -> list[str]:
        """All merges in order of rank, equal ranks from the left."""
        out, ranks = list(symbols), self.ranks
        if len(out) > 32:
            return self._merge_long(out)
        get, never = ranks.get, len(ranks)
        waiting = [get(p, never) for p in zip(out, out[1:], strict=False)]
        while waiting and (best := min(waiting)) < never:
            i = waiting.index(best)
            out[i] += out.pop(i + 1)
            del waiting[i]
            if i:
                waiting[i - 1] = get((out[i - 1], out[i]), never)
            if i < len(waiting):
                waiting[i] = get((out[i], out[i + 1]), never)
        return out

    def _merge_long(self, out: list[str]) -> list[str]:
        ranks, n = self.ranks, len(out)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(out, out[1:], strict=False)) if (r := ranks.get((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j < 0 or out[i] != a or out[j] != b:
                continue
            out[i], out[j], after[i] = a + b, "", after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, at in ((before[i], before[i]), (i, i)):
                if left >= 0 and after[left] >= 0 and (r := ranks.get((out[left], out[after[left]]))) is not None:
                    heapq.heappush(heap, (r, at, out[left], out[after[left]]))
        return [s for s in out if s]

    def stream(self, symbols: Iterable[str]) -> Iterator[str]:
        """Tokens of a symbol stream, with a buffer of some lookaheads whatever the length of the stream."""
        coming, enough = iter(symbols), 4 * self.lookahead + 64
        held = list(islice(coming, enough))
        while len(held) == enough:
            used = 0
            for token, size in self._sized(held):
                if used + size + self.lookahead > len(held):
                    break
                used += size
                yield token
            held = [*held[used:], *islice(coming, used)]
        yield from self.merge(held)

    def _sized(self, held: list[str]) -> Iterator[tuple[str, int]]:
        at = 0
        for token in self.merge(held):
            size, text = 0, ""
            while len(text) < len(token):
                text += held[at + size]
                size += 1
            at += size
            yield token, size


class Encoder(dict):
    """Maps a word to what its tokens give: (ids as text, decoded text). Remembers a bounded number of words.

    A worker process keeps one for all its tasks: reading the file and meeting the common words takes a second."""

    def __init__(self, vocabulary: Vocabulary, lookahead: int):
        super().__init__()
        self.vocabulary, self.older = vocabulary, {}
        self.transducer = Transducer(vocabulary.ranks, lookahead)
        self.letters = dict(enumerate(byte_letters()))
        self.special = vocabulary.special
        self.decoder = Decoder({i: t for t, i in (*vocabulary.ids.items(), *vocabulary.special.items())})
        self.word, self.plane_word = regex.compile(WORD), plane_word()
        self.cut = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")") if vocabulary.special else None

    def __missing__(self, word: str) -> tuple[str, str]:
        found = self.older.get(word)
        if found is None:
            ids = [self.special[word]] if word in self.special else list(self.word_ids(word))
            found = " ".join(map(str, ids)), " ".join(self.decoder.pieces(ids))
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found

    def word_ids(self, word: str) -> Iterator[int]:
        """Ids of one word; a symbol is a byte, and the last one carries the mark of the word's end."""
        letters = list(word.encode().decode("latin-1").translate(self.letters))
        letters[-1] += self.vocabulary.suffix
        return (self.vocabulary.ids[t] for t in self.transducer.stream(letters))

    def words(self, text: str) -> list[str]:
        """Words of a text: strings that are never cut, and the words between them after NFC and in lower case."""
        if self.cut is None or not self.cut.search(text):
            return self._between(text)
        return [w for k, part in enumerate(self.cut.split(text)) for w in ([part] if k % 2 else self._between(part))]

    def _between(self, part: str) -> list[str]:
        if part.isascii():
            return self.plane_word.findall(part.lower())
        # Sigma apart, as lower() would make a final one of the last in a word.
        low = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
        return (self.word if _BEYOND.search(low) else self.plane_word).findall(low)

    def encode(self, text: str) -> tuple[str, str]:
        """(decimal ids joined by one space, decoded text) of a whole text."""
        found = list(map(self.__getitem__, self.words(text)))
        return " ".join([f[0] for f in found]), " ".join([f[1] for f in found])


class Decoder:
    """Turns ids into text one by one."""

    def __init__(self, token: dict[int, str]):
        self.token = token

    def pieces(self, ids: Iterable[int]) -> Iterator[str]:
        """What the tokenizer's file gives back for each id: it names no decoder, so tokens stay in byte letters."""
        return (self.token[i] for i in ids)

    def text(self, ids: Iterable[int], suffix: str, special: dict[str, int]) -> Iterator[str]:
        """Readable text, as soon as it is complete: bytes wait until they make a character, ends of words become
        blanks. The state is the bytes of one unfinished character."""
        byte = {letter: b for b, letter in enumerate(byte_letters())}
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            token = self.token[i]
            if token in special:
                yield machine.decode(b"", True) + token + " "
                machine.reset()
                continue
            ends = bool(suffix) and token.endswith(suffix)
            letters = token[: -len(suffix)] if ends else token
            yield machine.decode(bytes(byte[c] for c in letters), ends) + " " * ends
        yield machine.decode(b"", True)


def encode_texts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, n_tokens, ids (decimal, joined by one space), decoded.

    The driver reads the tokenizer's file and broadcasts its text (a few MB, the same for any input). Null counts as
    empty; a text without words has no tokens and empty strings. Rows with equal ids are encoded each for itself. An
    empty table gives an empty result. Other columns are neither read nor returned.
    """
    kinds = f"encoded_id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids string, decoded string"
    return _rows(docs, id_col, text_col).mapInArrow(_encoding(docs, tokenizer_path, False), kinds).withColumnRenamed("encoded_id", id_col)


def encode_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode_texts`` with SHA-256 (lowercase hex) in the place of ids and decoded: ids_sha256, decoded_sha256."""
    kinds = f"encoded_id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _rows(docs, id_col, text_col).mapInArrow(_encoding(docs, tokenizer_path, True), kinds).withColumnRenamed("encoded_id", id_col)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("encoded_id"), text_or_empty(text_col).alias("encoded_text"))


def _encoding(docs: DataFrame, tokenizer_path: str, digests: bool):
    with open(tokenizer_path, encoding="utf-8") as file:
        text = file.read()
    shared = docs.sparkSession.sparkContext.broadcast((text, Vocabulary.parse(text).lookahead()))
    last = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, lookahead = shared.value
        encoder = kept_in_process(("bpe", hash(file)), lambda: Encoder(Vocabulary.parse(file), lookahead))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                sizes, ids, decoded = [], [], []
                for value in part.column("encoded_text").to_pylist():
                    a, b = encoder.encode(value)
                    sizes.append(a.count(" ") + 1 if a else 0)
                    ids.append(sha(a) if digests else a)
                    decoded.append(sha(b) if digests else b)
                columns = [part.column("encoded_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["encoded_id", "n_tokens", *last])

    return lean(run)

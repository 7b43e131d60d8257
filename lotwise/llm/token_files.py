"""Token ids as binary files: blocks in patched frame of reference, a directory of documents, an index of block starts.

A file holds the ids of consecutive documents as one stream, cut into blocks of BLOCK ids. A block stores its least id and
every id's distance from it in ``width`` bits, the width that PERCENTILE of 100 distances fit; the few that don't fit are
patched from a list of exceptions (place, distance). Layout, all numbers little-endian:

    MAGIC | block ... | directory | starts of blocks | footer
    block      n ids (u16), n exceptions (u16), least id (u32), width (u8), packed distances, places (u16), distances (u32)
    directory  Arrow stream: doc_id, n_tokens
    starts     u64 per block, from the file's first byte
    footer     start of directory (u64), start of starts (u64), ids (u64), MAGIC

Every block but the last is full, so the id at place p of the file is in block p // BLOCK: reading a range seeks.
"""

from __future__ import annotations

import io
import json
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.bpe import byte_letters, char_class
from lotwise.llm.tables import checkpoint_folder, kept_in_process, text_or_empty

#: Ids in a block.
BLOCK = 1024
#: Share of a block's ids, in percent, that the chosen width must hold.
PERCENTILE = 95
MAGIC = b"PFORIDS1"
_HEAD = "<HHIB"
_FOOT = "<QQQ8s"
#: Texts are encoded in parts of about so many characters, cut where no token can span the cut.
GROUP_CHARS = 1 << 20
#: Texts or parts are cut into words together, about so many characters at once.
TOGETHER_CHARS = 1 << 22
#: A blank between two ASCII letters: the patterns of byte-level BPE begin a new piece there, whatever surrounds it.
_SAFE_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
#: ASCII, Latin, Greek and Cyrillic letters and common signs, of the same class in all tables of Unicode. Left out are the few
#: numbers that Python's patterns take for letters.
KNOWN = r"\t\n\r\x20-\x7e\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-\u052f\u2010-\u2027\u2030-\u205e"
#: Fixed value: how byte-level BPE cuts a text, for KNOWN characters.
WORDS = r" ?[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
#: Words that a worker process remembers, in two generations of about so many.
REMEMBERED = 400_000


def known_words() -> re.Pattern:
    """WORDS with the classes of its letters and signs spelled out, for KNOWN characters: the words that ``word_starts`` finds."""
    known = "".join(re.findall(f"[{KNOWN}]", "".join(map(chr, range(0x2060)))))
    letter, sign = (char_class(re.findall(p, known)) for p in (r"[^\W\d_]", r"[^\s\w]|_"))
    return re.compile(rf" ?[{letter}]+|'(?:s|t|re|ve|m|ll|d)| ?\d+| ?[{sign}]+|\s+(?!\S)|\s+")


def _kinds() -> np.ndarray:
    """By code point, below U+2060: the kind of a KNOWN character, 0 for others."""
    kinds = np.zeros(0x2060, np.uint8)
    for kind, pattern in ((_LETTER, r"[^\W\d_]"), (_DIGIT, r"\d"), (_SIGN, r"[^\s\w]|_"), (_WHITE, r"\s"), (_BLANK, " ")):
        kinds[[c for c in range(0x2060) if re.fullmatch(f"[{KNOWN}]", chr(c)) and re.fullmatch(pattern, chr(c))]] = kind
    return kinds


_LETTER, _DIGIT, _SIGN, _WHITE, _BLANK = range(1, 6)
_KINDS = _kinds()
_OF_BYTE = np.concatenate([_KINDS[:128], np.zeros(128, np.uint8)])


def byte_kinds(data: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte of UTF-8 belongs to; 0 for characters that aren't KNOWN."""
    kinds = _OF_BYTE[data]
    lead = np.flatnonzero(data >= 0xC2)
    if len(lead):
        b = np.concatenate([data, np.zeros(2, np.uint8)]).astype(np.uint16, copy=False)
        first, second, third = b[lead], b[lead + 1], b[lead + 2]
        two = (first < 0xE0) & (second & 0xC0 == 0x80)
        at = lead[two]
        kinds[at] = kinds[at + 1] = _KINDS[(first[two] & 0x1F) << 6 | second[two] & 0x3F]
        # Of the characters of three bytes, the KNOWN ones begin with this byte.
        three = (first == 0xE2) & (second & 0xC0 == 0x80) & (third & 0xC0 == 0x80)
        at, code = lead[three], 0x2000 | (second[three] & 0x3F) << 6 | third[three] & 0x3F
        kinds[at] = kinds[at + 1] = kinds[at + 2] = np.where(code < len(_KINDS), _KINDS[np.minimum(code, len(_KINDS) - 1)], 0)
    return kinds


def word_starts(data: np.ndarray, kinds: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the words of WORDS begin in texts of KNOWN characters, which stand one behind the other in ``data`` as UTF-8.

    ``texts`` are the places where they begin. A word is a run of letters, digits or signs with the one blank before it. Of
    white space, what doesn't go with the next word is a word, and its last character another one if a word follows. An
    apostrophe that begins a word takes the letters of a short form with it.
    """
    n = len(data)
    first = np.zeros(n + 3, bool)
    first[texts] = True
    white = kinds >= _WHITE
    change = np.ones(n, bool)
    # All white space is one kind of run.
    change[1:] = np.where(white[1:], ~white[:-1], kinds[1:] != kinds[:-1])
    starts = np.concatenate([change, np.zeros(3, bool)]) | first
    after = np.flatnonzero(change[1:] & ~white[1:] & white[:-1] & ~first[1:n]) + 1
    starts[after] = kinds[after - 1] != _BLANK
    starts[after - 1 - (data[after - 1] & 0xC0 == 0x80)] = True
    mark = np.flatnonzero(starts[:n] & (data == ord("'")))
    if len(mark):
        b = np.concatenate([data, np.zeros(2, np.uint8)])
        one, two = np.where(first[mark + 1], 0, b[mark + 1]), np.where(first[mark + 1] | first[mark + 2], 0, b[mark + 2])
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        double = np.isin(one.astype(np.int32) << 8 | two, [int.from_bytes(s) for s in (b"re", b"ve", b"ll")])
        held, size = mark[short | double], np.where(double, 3, 2)[short | double]
        starts[held + 1] = False
        starts[held + size] = True
    return np.flatnonzero(starts[:n])


def pack_block(ids: np.ndarray) -> bytes:
    """One block: ids as an array of unsigned 32-bit numbers, 1 to BLOCK of them."""
    least = int(ids.min())
    distance = ids - np.uint32(least)
    fits = int(np.partition(distance, k := (len(ids) - 1) * PERCENTILE // 100)[k])
    width = fits.bit_length()
    places = np.flatnonzero(distance >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    held = distance.astype("<u2" if width <= 16 else "<u4")
    bits = np.unpackbits(held.view(np.uint8).reshape(len(ids), -1), axis=1, count=width, bitorder="little")
    return b"".join((
        struct.pack(_HEAD, len(ids), len(places), least, width),
        np.packbits(bits.ravel(), bitorder="little").tobytes(),
        places.astype("<u2").tobytes(),
        distance[places].astype("<u4").tobytes(),
    ))


def unpack_block(block: bytes) -> np.ndarray:
    n, n_exceptions, least, width = struct.unpack_from(_HEAD, block)
    after = struct.calcsize(_HEAD) + (n * width + 7) // 8
    packed = np.frombuffer(block, np.uint8, after - struct.calcsize(_HEAD), struct.calcsize(_HEAD))
    room = 16 if width <= 16 else 32
    bits = np.zeros((n, room), np.uint8)
    bits[:, :width] = np.unpackbits(packed, count=n * width, bitorder="little").reshape(n, width)
    distance = np.packbits(bits.ravel(), bitorder="little").view("<u2" if room == 16 else "<u4").astype(np.uint32)
    if n_exceptions:
        places = np.frombuffer(block, "<u2", n_exceptions, after)
        distance[places] = np.frombuffer(block, "<u4", n_exceptions, after + 2 * n_exceptions)
    return distance + np.uint32(least)


class TokenWriter:
    """Writes documents to one file, in the order given. Holds one block, and two numbers a document."""

    def __init__(self, file: BinaryIO):
        self.file, self.at = file, file.write(MAGIC)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.starts: list[int] = []
        self.ids: list[pa.Array] = []
        self.sizes: list[int] = []

    def _block(self, ids: np.ndarray) -> None:
        self.starts.append(self.at)
        self.at += self.file.write(pack_block(ids))

    def add(self, ids: np.ndarray) -> None:
        self.sizes.append(len(ids))
        self.n_ids += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= BLOCK:
            stream = np.concatenate(self.held)
            whole = len(stream) // BLOCK * BLOCK
            for lo in range(0, whole, BLOCK):
                self._block(stream[lo : lo + BLOCK])
            self.held, self.n_held = [stream[whole:]], len(stream) - whole

    def name(self, doc_ids: pa.Array) -> None:
        """The ids of the documents, as many and in the same order as those given to ``add``."""
        self.ids.append(doc_ids)

    def close(self) -> None:
        if self.n_held:
            self._block(np.concatenate(self.held))
        directory = self.at
        batch = pa.table({"doc_id": pa.chunked_array(self.ids), "n_tokens": pa.array(self.sizes, pa.int64())})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_table(batch)
        self.at += self.file.write(sink.getvalue().to_pybytes())
        starts = self.at
        self.file.write(np.array(self.starts, "<u8").tobytes())
        self.file.write(struct.pack(_FOOT, directory, starts, self.n_ids, MAGIC))
        self.file.close()


class TokenReader:
    """Reads a file of ``TokenWriter``: all documents one by one, or any range of ids by seeking."""

    def __init__(self, file: BinaryIO, size: int):
        self.file = file
        file.seek(size - struct.calcsize(_FOOT))
        directory, starts, self.n_ids, magic = struct.unpack(_FOOT, file.read(struct.calcsize(_FOOT)))
        if magic != MAGIC:
            raise ValueError("not a file of token ids, or an unfinished one")
        file.seek(directory)
        self.directory = pa.ipc.open_stream(file.read(starts - directory)).read_all()
        self.n_blocks = (size - struct.calcsize(_FOOT) - starts) // 8
        self.starts = [*np.frombuffer(file.read(8 * self.n_blocks), "<u8").tolist(), directory]

    def block(self, number: int) -> np.ndarray:
        self.file.seek(self.starts[number])
        return unpack_block(self.file.read(self.starts[number + 1] - self.starts[number]))

    def range(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from place ``start`` of the file on; only the blocks that hold them are read."""
        if not 0 <= start <= start + count <= self.n_ids:
            raise IndexError(f"{start}, {count} of {self.n_ids} ids")
        if not count:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, (start + count - 1) // BLOCK
        return np.concatenate([self.block(b) for b in range(first, last + 1)])[start - first * BLOCK :][:count]

    def parts(self) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(number of the document, some of its ids, are they its last ones?), block by block."""
        blocks, held = iter(range(self.n_blocks)), np.zeros(0, np.uint32)
        for doc, left in enumerate(self.directory.column("n_tokens").to_pylist()):
            while left > len(held):
                if len(held):
                    yield doc, held, False
                    left -= len(held)
                held = self.block(next(blocks))
            yield doc, held[:left], True
            held = held[left:]


def _place(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a folder given as a path or a URI (file:, hdfs:, s3:, gs:)."""
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    if ":" in folder.split("/")[0]:
        return pyarrow.fs.FileSystem.from_uri(folder)
    return pyarrow.fs.LocalFileSystem(), folder


class WordEncoder(dict):
    """The library's ids of whole texts, with a memory of words: word to ids as unsigned 32-bit numbers of the machine.

    The library cuts a text into words by a pattern and encodes each word for itself, so the ids of a text are those of its
    words in order. Here many texts are cut at once, where the same pattern cuts; each of their different words is looked
    up once, and the library's model encodes those that aren't remembered.
    Texts with other characters than KNOWN ones, whose class may depend on the version of Unicode's tables, or with
    strings that the library never cuts, are given to the library whole.
    """

    def __init__(self, file_text: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_str(file_text)
        self.library.no_truncation()
        self.library.no_padding()
        self.tokenize = self.library.model.tokenize
        self.letters = dict(enumerate(byte_letters()))
        self.older: dict[str, bytes] = {}
        special = [re.escape(t.content.encode()) for t in self.library.get_added_tokens_decoder().values()]
        self.never_cut = re.compile(b"|".join(special) or rb"(?!)")
        file = json.loads(file_text)
        first = file["pre_tokenizer"] or {}
        self.usual = first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space") and not file["normalizer"]

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            # Of the printable letters of ASCII only the blank has another letter for its byte.
            plain = word.isascii() and word.isprintable()
            letters = word.replace(" ", self.letters[32]) if plain else word.encode().decode("latin-1").translate(self.letters)
            ids = array("I", [t.id for t in self.tokenize(letters)]).tobytes()
        self[word] = ids
        return ids

    def _whole(self, text: str) -> np.ndarray:
        parts = (self.library.encode(p, add_special_tokens=False).ids for p in _pieces(text))
        return np.concatenate([np.array(ids, np.uint32) for ids in parts])

    def encode(self, text: str) -> bytes:
        """The ids of a text, as unsigned 32-bit numbers of the machine."""
        return self.encode_all([text])[0].tobytes()

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit numbers of the machine."""
        if not self.usual:
            return [self._whole(t) for t in texts]
        data, kinds, ends = _bytes(texts)
        for match in self.never_cut.finditer(data):
            # It may seem to begin in a text and end in a later one: these go to the library too.
            kinds[match.start() : match.end()] = 0
        odd = set(np.searchsorted(ends, np.flatnonzero(kinds == 0), "right").tolist())
        if not odd:
            return self._by_words(data, kinds, ends)
        rest = iter(self._by_words(*_bytes([t for k, t in enumerate(texts) if k not in odd])))
        return [self._whole(t) if k in odd else next(rest) for k, t in enumerate(texts)]

    def _by_words(self, data: np.ndarray, kinds: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        if not len(data):
            return [np.zeros(0, np.uint32)] * len(ends)
        if len(self) > REMEMBERED:
            self.older = dict(self)
            self.clear()
        starts = word_starts(data, kinds, np.concatenate([[0], ends[:-1]]))
        places = np.append(starts, len(data)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(data)).dictionary_encode()
        found = list(map(self.__getitem__, words.dictionary.to_numpy(zero_copy_only=False)))
        sizes, which = np.fromiter(map(len, found), np.int64, len(found)) // 4, words.indices.to_numpy()
        n = sizes[which]
        after = np.cumsum(n)
        # Place in the words' ids of each id of the texts.
        place = np.repeat((np.cumsum(sizes) - sizes)[which] - after + n, n) + np.arange(after[-1])
        ids = np.frombuffer(b"".join(found), np.uint32)[place]
        return np.split(ids, np.append(0, after)[np.searchsorted(starts, ends[:-1])])


def _bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts as UTF-8, one behind the other, the kind of each byte's character, and where each text ends."""
    parts = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    return data, byte_kinds(data), np.cumsum([len(p) for p in parts], dtype=np.int64)


def _pieces(text: str) -> Iterator[str]:
    """A text in parts of about GROUP_CHARS whose tokens are those of the whole."""
    at = 0
    while len(text) - at > 2 * GROUP_CHARS and (cut := _SAFE_CUT.search(text, at + GROUP_CHARS)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def _together(texts: Iterable[str]) -> Iterator[list[tuple[str, bool]]]:
    """Parts of texts, of TOGETHER_CHARS in all: (part, is it its text's last one?)."""
    group, chars = [], 0
    for text in texts:
        left = len(text)
        for part in _pieces(text):
            left -= len(part)
            group.append((part, not left))
            chars += len(part)
            if chars >= TOGETHER_CHARS:
                yield group
                group, chars = [], 0
    if group:
        yield group


def encoded(tokenizer_text: str, texts: Iterable[str], end_id: int) -> Iterator[np.ndarray]:
    """The ids of each text, and ``end_id`` after them."""
    encoder = kept_in_process(("token files", hash(tokenizer_text)), lambda: WordEncoder(tokenizer_text))
    held, end = [], np.array([end_id], np.uint32)
    for group in _together(texts):
        for (_, last), ids in zip(group, encoder.encode_all([part for part, _ in group]), strict=True):
            held.append(ids)
            if last:
                yield np.concatenate([*held, end])
                held = []


def write_token_files(
    docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode all texts and write their ids to files below ``folder``, in ascending order of id_col over all files.

    Texts are dealt by ranges of the id, in order, before they are encoded: one shuffle of the texts, none of the ids; each
    task writes one file. A file's name is new with each attempt of a task, and readers take the names in the manifest,
    which Spark commits: what a lost executor left behind is never read. The folder must be one that all executors
    share (path or URI).

    Returns the manifest, read from where it is written: partition, file, n_docs, n_ids; one row per file.

    Null texts count as empty and have the end id alone. Null ids come first. Rows with equal ids follow one another in
    any order; equal rows are documents like others. Both may spread over several files. An empty table gives an
    empty manifest. Very long texts are encoded in parts. Other columns aren't read.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    # The place in the input spreads rows with equal ids. Looking for the ranges reads no texts.
    rows = rows.repartitionByRange("id", F.monotonically_increasing_id()).sortWithinPartitions("id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, writer, n_docs = TaskContext.get().partitionId(), None, 0
        name = f"ids-{partition:06d}-{uuid.uuid4().hex}.pfor"
        for batch in batches:
            if writer is None:
                system, path = _place(folder)
                system.create_dir(path)
                writer = TokenWriter(system.open_output_stream(f"{path}/{name}"))
            writer.name(batch.column("id"))
            texts = (t for lo in range(0, batch.num_rows, 256) for t in batch.column("text")[lo : lo + 256].to_pylist())
            for ids in encoded(shared.value, texts, end_id):
                writer.add(ids)
            n_docs += batch.num_rows
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"partition": [partition], "file": [name], "n_docs": [n_docs], "n_ids": [writer.n_ids]})

    rows.mapInArrow(write, "partition long, file string, n_docs long, n_ids long").write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.parquet(f"{folder}/manifest")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """One row and one task per file: file, base (ids in all files before it). The manifest has a row per task that wrote."""
    listed = sorted((r["partition"], r["file"], r["n_ids"]) for r in spark.read.parquet(f"{folder}/manifest").collect())
    rows, base = [], 0
    for _, file, n_ids in listed:
        rows.append((file, base))
        base += n_ids
    return spark.createDataFrame(rows, "file string, base long").repartitionByRange(max(1, len(rows)), "base", "file")


def _open(folder: str, name: str) -> TokenReader:
    system, path = _place(folder)
    where = f"{path}/{name}"
    return TokenReader(io.BufferedReader(system.open_input_file(where), 1 << 20), system.get_file_info(where).size)


def read_token_files(spark: SparkSession, folder: str, id_type: str = "long") -> DataFrame:
    """The documents of written files: doc_id, start (ids of all documents before), ids (array)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            reader = _open(folder, row["file"])
            sizes, at, first, n_held, held = [], row["base"], 0, 0, []
            for doc, part, last in reader.parts():
                held.append(part)
                n_held += len(part)
                sizes += [n_held - sum(sizes)] if last else []
                if last and (n_held > GROUP_CHARS or len(sizes) == 1000):
                    yield _batch(reader, first, at, sizes, held)
                    sizes, at, first, n_held, held = [], at + n_held, doc + 1, 0, []
            if sizes:
                yield _batch(reader, first, at, sizes, held)

    return _files(spark, folder).mapInArrow(read, f"doc_id {id_type}, start long, ids array<long>")


def _batch(reader: TokenReader, first: int, at: int, sizes: list[int], held: list[np.ndarray]) -> pa.RecordBatch:
    names = reader.directory.column("doc_id").slice(first, len(sizes)).combine_chunks()
    ends = np.concatenate([[0], np.cumsum(sizes)])
    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(held).astype(np.int64)))
    return pa.RecordBatch.from_arrays([names, pa.array(at + ends[:-1], pa.int64()), ids], ["doc_id", "start", "ids"])


def digest_token_files(spark: SparkSession, folder: str, id_type: str = "long") -> DataFrame:
    """Per document of the written files: doc_id, start, n_tokens, ids_crc32 (of the ids as unsigned 32-bit numbers)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            reader, crc, crcs = _open(folder, row["file"]), 0, []
            for _, part, last in reader.parts():
                crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                if last:
                    crcs.append(crc)
                    crc = 0
            sizes = reader.directory.column("n_tokens").to_numpy()
            starts = row["base"] + np.cumsum(sizes) - sizes
            table = reader.directory.append_column("start", pa.array(starts)).append_column("ids_crc32", pa.array(crcs, pa.int64()))
            yield from table.select(["doc_id", "start", "n_tokens", "ids_crc32"]).combine_chunks().to_batches(8192)

    return _files(spark, folder).mapInArrow(read, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def new_folder(spark: SparkSession) -> str:
    """A folder for files that executors share, below the checkpoint folder."""
    return f"{checkpoint_folder(spark)}/token-files-{uuid.uuid4()}"

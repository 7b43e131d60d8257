"""Files of token ids: exact round trips, random access, and the library's own ids."""

import io
import itertools
import json
import os
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lotwise.llm import queries, token_files

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@given(st.lists(st.one_of(st.integers(0, 2**32 - 1), st.integers(0, 60), st.integers(1000, 1007)), min_size=1, max_size=token_files.BLOCK))
def test_block_round_trip(ids):
    assert token_files.unpack_block(token_files.pack_block(np.array(ids, np.uint32))).tolist() == ids


def test_outliers_are_exceptions():
    ids = np.full(1000, 7, np.uint32)
    ids[::100] += 40_000
    block = token_files.pack_block(ids)
    n, exceptions, least, width = struct.unpack_from(token_files._HEAD, block)
    assert (n, exceptions, least, width) == (1000, 10, 7, 0) and len(block) == struct.calcsize(token_files._HEAD) + 10 * 6
    assert (token_files.unpack_block(block) == ids).all()
    assert len(token_files.pack_block(np.arange(1024, dtype=np.uint32) % 16 + 9)) < 1024


def test_known_characters_are_cut_by_spelled_out_classes():
    known = re.findall(f"[{token_files.KNOWN}]", "".join(map(chr, range(0x2060))))
    text = "".join(f"{c}a {c}1 {c}{c}'ll_{c}  {c}\n" for c in known)
    assert token_files.known_words().findall(text) == re.compile(token_files.WORDS).findall(text)


class Kept(io.BytesIO):
    def close(self):
        self.kept = self.getvalue()


def test_file_round_trip_and_ranges():
    rng = np.random.default_rng(5)
    docs = [rng.integers(0, 50_257, n).astype(np.uint32) for n in (1, 0, 5000, 1024, 0, 3, 2047, 0)]
    file = Kept()
    writer = token_files.TokenWriter(file)
    writer.name(pa.array(range(len(docs)), pa.int64()))
    for d in docs:
        writer.add(d)
    writer.close()
    reader = token_files.TokenReader(io.BytesIO(file.kept), len(file.kept))
    got = [[] for _ in docs]
    for doc, part, _ in reader.parts():
        got[doc].extend(part.tolist())
    assert got == [d.tolist() for d in docs]
    stream = np.concatenate(docs)
    for start, count in ((0, 0), (0, 1), (1023, 2), (4000, 3000), (len(stream), 0), (0, len(stream))):
        assert (reader.range(start, count) == stream[start : start + count]).all()
    with pytest.raises(IndexError):
        reader.range(len(stream), 1)
    with pytest.raises(ValueError):
        token_files.TokenReader(io.BytesIO(file.kept[:-1]), len(file.kept) - 1)


def test_words_are_those_of_the_public_pattern():
    """Character by character over all KNOWN ones, and on odd texts; ids against the library."""
    known = [chr(c) for c in range(0x2100) if re.fullmatch(f"[{token_files.KNOWN}]", chr(c))]
    assert len(known) > 1300 and not {"\xb2", "\x85", "\u2028", "\u0530"} & set(known)
    theirs, ours = regex.compile(public_tokenizers.PATTERN), re.compile(token_files.WORDS)
    rng = np.random.default_rng(1)
    odd = ["it's I'LL 'tis ''s", "a  b\n\n c ", " \t\xa0x", "__a_1 2_", "’’ 3a4", "   ", "x   y"]
    mixed = ["".join(rng.choice([*known, *" 's\n1a_"] * 1, 60)) for _ in range(300)]
    for text in [c + "a" for c in known] + [f"a{c}1 {c}{c}" for c in known] + odd + mixed:
        assert ours.findall(text) == theirs.findall(text), text
    library, encoder = Tokenizer.from_file(PATH), token_files.WordEncoder(open(PATH, encoding="utf-8").read())
    for text in odd + mixed + ["½ 日本 \u2028 x", "<|endoftext|>", "\ud7ff \x1c", ""]:
        assert np.frombuffer(encoder.encode(text), np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids


def test_texts_are_cut_together():
    """Words and ids of many texts at once: no word spans two texts, and odd texts are the library's."""
    theirs, rng = regex.compile(public_tokenizers.PATTERN), np.random.default_rng(2)
    small = np.array(list(" ''  \n\t\r\xa0stmdrevlabX1_9.!é’я—"))
    library, encoder = Tokenizer.from_file(PATH), token_files.WordEncoder(open(PATH, encoding="utf-8").read())
    known = re.findall(f"[{token_files.KNOWN}]", "".join(map(chr, range(0x2060))))
    groups = [["", "it'", "s ", "", " x", "'re's", "'", "ll", "a ", "\n b", ""], [""], [], [f"{c}'s{c} {c}  {c}1\n" for c in known]]
    groups += [["".join(rng.choice(small, rng.integers(0, 14))) for _ in range(5)] for _ in range(1000)]
    for texts in groups:
        data, kinds, ends = token_files._bytes(texts)
        assert kinds.all()
        if len(data):
            at = [*token_files.word_starts(data, kinds, np.append(0, ends[:-1])).tolist(), len(data)]
            assert [data.tobytes()[a:b].decode() for a, b in itertools.pairwise(at)] == [w for t in texts for w in theirs.findall(t)], texts
    for texts in [*groups[:100], ["a b", "日本 a", "", "<|endoftext|>", "<|endof", "text|> b", "\u2028", "½ \x1c", "😀 a", "b a"]]:
        got = [ids.tolist() for ids in encoder.encode_all(texts)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts], texts


def test_strings_never_cut_end_with_their_text():
    file = json.load(open(PATH, encoding="utf-8"))
    file["added_tokens"].append({**file["added_tokens"][0], "id": len(file["model"]["vocab"]), "content": "aa"})
    text = json.dumps(file)
    library, encoder = Tokenizer.from_str(text), token_files.WordEncoder(text)
    for texts in (["xa", "aa b", "a"], ["a", "", "a", "aab"], ["b", "aa"], ["xa", "ab", "baab", "c"]):
        assert [ids.tolist() for ids in encoder.encode_all(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_bytes_that_are_no_known_characters():
    for data in (b"a\xa0", b"\xc3a", b"\xc0\xa0", b"\xe2\x80a", b"\xe3\x80\x80", b"\xf0\x9f\x98\x80", b"\x1c", b"a\xe2", b"\xc3"):
        assert (token_files.byte_kinds(np.frombuffer(data, np.uint8)) == 0).any(), data
    assert token_files.byte_kinds(np.frombuffer(" aé’\xa0".encode(), np.uint8)).tolist() == [5, 1, 1, 1, 3, 3, 3, 4, 4]


def test_words_are_looked_up_once_for_many_texts(monkeypatch):
    asked = []
    ids_of = lambda self, word: asked.append(word) or self.get(word) or self.__missing__(word)
    monkeypatch.setattr(token_files.WordEncoder, "__getitem__", ids_of, raising=False)
    texts = ["the same few words, again and again"] * 1000
    ids = np.array([*Tokenizer.from_file(PATH).encode(texts[0], add_special_tokens=False).ids, 7])
    assert all((got == ids).all() for got in token_files.encoded(open(PATH, encoding="utf-8").read(), texts, 7))
    assert len(asked) < 20


def test_long_texts_are_grouped_by_size():
    long = "a few words " * 400_000
    groups = list(token_files._together(["x", "", long, "y", ""]))
    assert len(groups) > 1 and all(sum(len(p) for p, _ in g[:-1]) < token_files.TOGETHER_CHARS for g in groups)
    parts = [p for g in groups for p in g]
    assert "".join(p for p, _ in parts) == "x" + long + "y" and sum(last for _, last in parts) == 5


def expected(rows):
    library, start, out = Tokenizer.from_file(PATH), 0, []
    for doc, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_registered_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sorted(tuple(r) for r in docs.select("doc_id", "text").collect())
    got = queries.queries()["op12_token_files"](spark, SMALL)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == expected(rows)


def test_odd_rows_in_many_files(spark, tmp_path):
    long = " ".join(f"w{i % 977}, x{i % 31}" for i in range(400_000))
    assert len(long) > 3 * token_files.GROUP_CHARS
    rows = [(None, "no id"), (None, None), (3, long), (1, ""), (2, "twice <|endoftext|>"), (2, "twice <|endoftext|>"), (5, "é 日本 \n\n  it's"), (2**40, "far")]
    kind = "doc_id long, text string, partition long, file string, tie long, id string, start long"
    docs = spark.createDataFrame([(*r, 0, "f", 1, "i", 2) for r in rows], kind).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_files.write_token_files(docs, PATH, str(tmp_path / "ids"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert manifest.count() > 1 and manifest.agg(F.sum("n_docs")).first()[0] == len(rows)
    (tmp_path / "ids" / "ids-000000-left-by-a-lost-task.pfor").write_bytes(b"unfinished")
    got = [tuple(r) for r in token_files.digest_token_files(spark, str(tmp_path / "ids")).orderBy("start").collect()]
    nulls = [rows[0], rows[1]] if got[0][2] > 1 else [rows[1], rows[0]]
    assert got == expected(nulls + sorted(rows[2:]))
    read = {r["start"]: r["ids"] for r in token_files.read_token_files(spark, str(tmp_path / "ids")).collect()}
    assert all(zlib.crc32(np.array(read[s], "<u4").tobytes()) == crc and len(read[s]) == n for _, s, n, crc in got)
    size = sum(os.path.getsize(tmp_path / "ids" / r["file"]) for r in manifest.collect())
    assert size < 4 * sum(n for _, _, n, _ in got) * 0.7


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.write_token_files(docs, PATH, str(tmp_path / "none")).count() == 0
    assert token_files.digest_token_files(spark, str(tmp_path / "none")).count() == 0

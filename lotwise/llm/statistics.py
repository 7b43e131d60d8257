"""Statistics of whole texts that the quality operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.tables import text_or_empty
from lotwise.llm.words import Words, covered, groups, later_repeats, mixed, repeated, spans_hash

#: Words in a window that is looked for twice within a text.
WINDOW = 8

#: Whole numbers, exact.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Rates made from these and other counts.
RATES = [
    "log_words",
    "mean_chars",
    "symbol_rate",
    "repeat_rate",
    "dup_line_rate",
    "upper_rate",
    "punct_rate",
    "bang_rate",
    "bar_rate",
    "digit_rate",
    "distinct_rate",
    "echo_rate",
    "top_word_rate",
    "words_per_line",
    "long_word_rate",
    "short_word_rate",
]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[*b"#*$%&|<>"]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[*b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS and RATES of each text. A text without words has 0 everywhere."""
    w = Words(column)
    total = lambda marked: np.add.reduceat(np.concatenate([marked, [0]]).astype(np.int64), np.minimum(w.bounds[:-1], len(marked))) * (np.diff(w.bounds) > 0)
    of_text = mixed(np.arange(w.n, dtype=np.uint64) + np.uint64(1))
    hashes = w.hashes() if len(w.start) else np.zeros(0, np.uint64)
    own = hashes ^ of_text[w.text]

    in_word = np.zeros(len(w.data) + 1, np.int64)
    np.add.at(in_word, w.start, 1)
    np.add.at(in_word, w.end, -1)
    begins = ((w.data & 0xC0) != 0x80) & (np.cumsum(in_word[:-1]) > 0)
    chars = np.concatenate([[0], np.cumsum(begins)])
    word_chars = chars[w.end] - chars[w.start]

    grams, at = w.grams(hashes, WINDOW)
    twice = repeated(grams ^ of_text[w.text[at]]) if len(at) else np.zeros(0, bool)
    repeat = covered(len(w.text), at[twice], WINDOW)

    line_start, line_end = w.runs(w.data != 10)
    held = np.searchsorted(w.start, line_end) > np.searchsorted(w.start, line_start)
    line_start, line_end = line_start[held], line_end[held]
    lines = w.text_of(line_start)
    line_keys = spans_hash(w.data, line_start, line_end) ^ of_text[lines]
    n_lines = w.per_text(lines)
    dup_lines = w.per_text(lines[later_repeats(line_keys)])

    new = ~later_repeats(own)
    _, which, count = np.unique(own, return_inverse=True, return_counts=True)
    top = np.zeros(w.n)
    np.maximum.at(top, w.text, count[which] if len(own) else np.zeros(0))
    echo = np.zeros(len(own), bool)
    if len(own):
        echo[1:] = (own[1:] == own[:-1]) & (w.text[1:] == w.text[:-1])

    n = w.n_words
    per_word = lambda x: x / np.maximum(n, 1)
    out = {
        "n_words": n,
        "word_chars": w.per_text(w.text, word_chars),
        "n_symbols": total(_SYMBOL[w.data]),
        "n_dup_lines": dup_lines,
        "n_repeat_words": w.per_text(w.text[repeat]),
    }
    some = np.maximum(out["word_chars"], 1)
    return out | {
        "log_words": np.log1p(n),
        "mean_chars": per_word(out["word_chars"]),
        "symbol_rate": per_word(out["n_symbols"]),
        "repeat_rate": per_word(out["n_repeat_words"]),
        "dup_line_rate": dup_lines / np.maximum(n_lines, 1),
        "upper_rate": total(_UPPER[w.data]) / np.maximum(total(_LETTER[w.data]), 1),
        "punct_rate": total(_PUNCT[w.data]) / some,
        "bang_rate": per_word(total(w.data == 33)),
        "bar_rate": per_word(total(w.data == 124)),
        "digit_rate": total(_DIGIT[w.data]) / some,
        "distinct_rate": per_word(w.per_text(w.text[new])),
        "echo_rate": per_word(w.per_text(w.text[echo])),
        "top_word_rate": per_word(top),
        "words_per_line": n / np.maximum(n_lines, 1),
        "long_word_rate": per_word(w.per_text(w.text[word_chars > 15])),
        "short_word_rate": per_word(w.per_text(w.text[word_chars < 3])),
    }


def with_statistics(docs: DataFrame, columns: dict[str, str], text_col: str = "text") -> DataFrame:
    """``columns`` (new name: SQL expression over ``docs``), then COUNTS as long and RATES as double, for each row."""
    chosen = docs.selectExpr(*[f"{e} AS {name}" for name, e in columns.items()], f"`{text_col}` AS measured_text")
    chosen = chosen.withColumn("measured_text", text_or_empty("measured_text"))
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema if f.name != "measured_text"]
    kinds += [f"{c} long" for c in COUNTS] + [f"{c} double" for c in RATES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("measured_text")
            rest = batch.drop_columns(["measured_text"])
            for lo, hi in groups(texts):
                found = measure(texts[lo:hi])
                arrays = [pa.array(found[c].astype(np.int64)) for c in COUNTS]
                arrays += [pa.array(found[c].astype(np.float64)) for c in RATES]
                part = rest.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], [*part.schema.names, *COUNTS, *RATES])

    return chosen.mapInArrow(run, ", ".join(kinds))


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))

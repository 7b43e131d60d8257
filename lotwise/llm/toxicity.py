"""Toxicity: boosted trees over lexicon densities and other dense features, with isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm import boosting
from lotwise.llm.labelled import MOST_LABELLED, TASKS, labelled_sample
from lotwise.llm.statistics import held_out
from lotwise.llm.tables import checkpointed, lean, text_or_empty
from lotwise.llm.words import Spans, Texts, groups, mixed

#: Texts are scored in groups of about so many bytes.
SCORED_BYTES = 1 << 18
#: Score from which on a document is rejected.
REJECT = 0.7
#: Log-odds of a lexicon entry, and the share of toxic texts (with the number of texts) it must occur in. The share bounds a
#: lexicon: it holds no more entries than 1 / LEAST_SHARE toxic texts have different words and word beginnings.
LEAST_ODDS, LEAST_SHARE, LEAST_TEXTS = 3.0, 0.005, 3
#: Lengths in bytes of the word beginnings that a lexicon holds besides whole words: they catch inflected forms.
BEGINNINGS = (4, 5, 6)
#: A second-person word so many words away from a lexicon word is near it.
NEAR = 5

#: Common insults, known before anything is learned.
INSULTS = """
idiot moron stupid loser scum trash clown worthless disgusting pathetic imbecile filth vermin dumb fool bastard
dummkopf abschaum dreckskerl arschloch trottel
imbécile ordure crétin salaud connard
idiota estúpido imbécil escoria basura
""".split()
#: Lengths in bytes of the insults, which are looked for at the beginning of obfuscated words too.
SEED_SIZES = sorted({len(w.encode()) for w in INSULTS})
#: Lengths in bytes of words that are looked for in runs of single letters.
SPACED = range(4, 17)
#: Pronouns of the second person in English, German, French and Spanish.
SECOND_PERSON = """
you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton vous votre ti tú usted ustedes vosotros
""".split()

FEATURES = [
    "log_words", "seed_hits", "hits", "hit_rate", "odds_sum", "odds_max", "distinct_hits", "obfuscated_hits",
    "near_you", "you_rate", "upper_rate", "punct_rate", "bang_rate", "obfuscation_rate",
]
#: The more of these, the higher the score.
RISING = ["seed_hits", "hits", "odds_sum", "odds_max", "distinct_hits", "obfuscated_hits"]

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Characters that stand for letters in obfuscated words.
_LEET = _LOWER.copy()
for _sign, _letter in zip(b"0134578@$!", b"oieastbasi", strict=True):
    _LEET[_sign] = _letter
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[*b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = True


@dataclass
class Lexicon:
    """Sorted hashes of words and word beginnings, with their log-odds."""

    keys: np.ndarray
    odds: np.ndarray

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Log-odds of each hash, 0 if unknown."""
        if not len(self.keys):
            return np.zeros(len(hashes))
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.odds[at], 0.0)


def _known(words: list[str]) -> np.ndarray:
    t = Texts(pa.array(words))
    return np.sort(Spans(t.data).hash(t.bounds[:-1], t.bounds[1:]))


class Tokens(Texts):
    """Letter runs of texts in lower case, with the hashes of the words and of their beginnings."""

    def __init__(self, column: pa.Array):
        super().__init__(column)
        self.raw = self.data
        self.data = _LOWER[self.raw]
        accented = np.zeros(len(self.raw), bool)  # capitals from À to Þ
        accented[1:] = (self.raw[:-1] == 0xC3) & (self.raw[1:] >= 0x80) & (self.raw[1:] <= 0x9E) & (self.raw[1:] != 0x97)
        self.data = self.data + accented.astype(np.uint8) * 0x20
        self.start, self.end = self.runs(_LETTER[self.data])
        self.text = self.text_of(self.start)
        self.spans = Spans(self.data)
        self.words = self.spans.hash(self.start, self.end)

    def all_keys(self) -> list[np.ndarray]:
        """For whole words and for each length of beginnings: a key per word, 0 where the word is too short."""
        keys = [self.words]
        for n in BEGINNINGS:
            longer = self.end - self.start > n
            cut = self.spans.hash(self.start, np.minimum(self.end, self.start + n)) ^ np.uint64(n)
            keys.append(np.where(longer, cut, np.uint64(0)))
        return keys

    def odds(self, lexicon: Lexicon) -> np.ndarray:
        return np.max([lexicon.of(k) for k in self.all_keys()], axis=0) if len(self.words) else np.zeros(0)


def token_counts(column: pa.Array, toxic: np.ndarray, fold: np.ndarray) -> dict[str, np.ndarray]:
    """For each key in these texts, in how many toxic and clean texts of each fold it occurs."""
    t = Tokens(column)
    per_text = [np.unique(np.stack([k[k != 0], t.text[k != 0].astype(np.uint64)], 1), axis=0) for k in t.all_keys()]
    pairs = np.concatenate(per_text) if per_text else np.zeros((0, 2), np.uint64)
    keys, which = np.unique(pairs[:, 0], return_inverse=True)
    text = pairs[:, 1].astype(np.int64)
    count = lambda label, f: np.bincount(which, (toxic[text] == label) & (fold[text] == f), len(keys)).astype(np.int64)
    return {"key": keys.view(np.int64)} | {f"{n}_{f}": count(v, f) for n, v in (("toxic", 1), ("clean", 0)) for f in (0, 1)}


def hidden_words(t: Tokens, start: np.ndarray, end: np.ndarray, lexicon: Lexicon, seeds: np.ndarray) -> np.ndarray:
    """Which blank-separated words, each with a letter in it, read as or begin with a known word in disguise.

    Signs are read as letters and anything else is left out. Punctuation at either end is read as signs or left out, as
    'mor0n!' and '$tupid' need. What matches must hold more than plain letters.
    """
    leet = _LEET[t.data]
    reads = _LETTER[leet]
    at, place = np.flatnonzero(reads), np.concatenate([[0], np.cumsum(reads)])
    spans = Spans(leet[reads])
    other = np.concatenate([[0], np.cumsum(~_LETTER[t.data])])
    disguised = lambda p, q: other[at[q - 1] + 1] > other[at[p]]
    maybe = np.flatnonzero(disguised(place[start], place[end]))
    start, end = start[maybe], end[maybe]
    solid = ~_PUNCT[t.raw]
    solid_at, n_solid = np.flatnonzero(solid), np.concatenate([[0], np.cumsum(solid)])
    inner_start, inner_end = solid_at[n_solid[start]], solid_at[n_solid[end] - 1] + 1
    hit = np.zeros(len(maybe), bool)
    for lo, hi in ((start, end), (start, inner_end), (inner_start, end), (inner_start, inner_end)):
        p, q = place[lo], place[hi]
        whole = spans.hash(p, q)
        hit |= ((lexicon.of(whole) > 0) | np.isin(whole, seeds)) & disguised(p, q)
        for n in sorted({*BEGINNINGS, *SEED_SIZES}):
            cut = np.minimum(p + n, q)
            begins = spans.hash(p, cut)
            known = np.isin(begins, seeds)
            if n in BEGINNINGS:
                known |= lexicon.of(begins ^ np.uint64(n)) > 0
            hit |= known & (q - p > n) & disguised(p, cut)
    return maybe[hit]


def spaced_words(
    t: Tokens, start: np.ndarray, end: np.ndarray, text: np.ndarray, lexicon: Lexicon, seeds: np.ndarray
) -> np.ndarray:
    """The text of each known word, of SPACED bytes, in a run of single letters or signs with blanks between them."""
    leet = _LEET[t.data]
    size = np.where(t.raw[start] >= 0xC0, 2, 1)
    tail = np.concatenate([[0], np.cumsum(~_PUNCT[t.raw])])
    single = _LETTER[leet[start]] & (end - start >= size)
    single &= tail[end] == tail[np.minimum(start + size, end)]
    one = np.flatnonzero(single)
    if not len(one):
        return one
    first, size, own = start[one], size[one], text[one]
    bytes_ = np.sort(np.concatenate([first, first[size == 2] + 1]))
    spans = Spans(leet[bytes_])
    p = np.searchsorted(bytes_, first)
    ends = np.append((one[1:] != one[:-1] + 1) | (own[1:] != own[:-1]), True)
    last = (p + size)[np.flatnonzero(ends)[np.cumsum(ends) - ends]]
    hit = np.zeros(len(one), bool)
    for n in SPACED:
        word = spans.hash(p, np.minimum(p + n, last))
        hit |= (p + n <= last) & ((lexicon.of(word) > 0) | np.isin(word, seeds))
    return own[hit]


def features(column: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """FEATURES of each text; a text without letters has 0 in all that concern words."""
    t = Tokens(column)
    n = np.bincount(t.text, minlength=t.n)
    seeds, you = _known(INSULTS), _known(SECOND_PERSON)
    odds = t.odds(lexicon)
    seed = np.isin(t.words, seeds)
    hit = (odds > 0) | seed
    is_you = np.isin(t.words, you)
    near = np.zeros(len(hit), bool)
    for d in range(1, NEAR + 1):
        same = t.text[d:] == t.text[:-d]
        near[d:] |= is_you[:-d] & same
        near[:-d] |= is_you[d:] & same

    blank = (t.raw == 32) | ((t.raw >= 9) & (t.raw <= 13))
    w_start, w_end = t.runs(~blank)
    w_text = t.text_of(w_start)
    # Words with something else between their first and last letter.
    where = np.flatnonzero(_LETTER[t.data])
    letters = np.concatenate([[0], np.cumsum(_LETTER[t.data])])
    held = letters[w_end] - letters[w_start]
    some = held > 0
    a, b = where[letters[w_start[some]]], where[letters[w_end[some]] - 1] + 1
    o_text = w_text[some][(b - a) > held[some]]
    hidden = np.concatenate([
        w_text[some][hidden_words(t, w_start[some], w_end[some], lexicon, seeds)],
        spaced_words(t, w_start, w_end, w_text, lexicon, seeds),
    ])

    count = lambda text, w=None: np.bincount(text, w, t.n)
    total = lambda marked: np.diff(np.concatenate([[0], np.cumsum(marked)])[t.bounds])
    strongest = np.zeros(t.n)
    np.maximum.at(strongest, t.text, odds)
    hits = count(t.text[hit])
    pair = np.unique(np.stack([t.text[hit].astype(np.uint64), t.words[hit]], 1), axis=0)[:, 0].astype(np.int64)
    ascii_letters = total(((t.raw | 32) >= 97) & ((t.raw | 32) < 123) & (t.raw < 128))
    sizes, n_blank = np.maximum(np.diff(t.bounds), 1), np.maximum(count(w_text), 1)
    found = {
        "log_words": np.log1p(n),
        "seed_hits": count(t.text[seed]),
        "hits": hits,
        "hit_rate": hits / np.maximum(n, 1),
        "odds_sum": count(t.text, odds),
        "odds_max": strongest,
        "distinct_hits": count(pair),
        "obfuscated_hits": count(hidden),
        "near_you": count(t.text[hit & near]) / np.maximum(hits, 1),
        "you_rate": count(t.text[is_you]) / np.maximum(n, 1),
        "upper_rate": total((t.raw >= 65) & (t.raw < 91)) / np.maximum(ascii_letters, 1),
        "punct_rate": total(_PUNCT[t.raw]) / sizes,
        "bang_rate": total(t.raw == 33) / sizes,
        "obfuscation_rate": count(o_text) / n_blank,
    }
    return np.stack([found[f].astype(float) for f in FEATURES], 1)


@dataclass
class Toxicity:
    lexicon: Lexicon
    forest: boosting.Forest
    points: tuple[np.ndarray, np.ndarray]

    def score(self, column: pa.Array) -> np.ndarray:
        return np.interp(self.forest.score(features(column, self.lexicon)), *self.points)


def _count_tokens(sample: DataFrame) -> pd.DataFrame:
    """Keys of a sample with their log-odds (column per lexicon, null if they don't pass): of either fold, and of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, fold = (batch.column(c).to_numpy() for c in ("learn_label", "fold"))
            for lo, hi in groups(batch.column("learn_text")):
                yield pa.RecordBatch.from_pydict(token_counts(batch.column("learn_text")[lo:hi], toxic[lo:hi], fold[lo:hi]))

    names = ["toxic_0", "toxic_1", "clean_0", "clean_1"]
    counted = sample.select("learn_text", F.col("learn_label").cast("int"), F.col("fold").cast("int"))
    counts = counted.mapInArrow(lean(run), ", ".join(f"{c} long" for c in ["key", *names]))
    summed = counts.groupBy("key").agg(*[F.sum(c).alias(c) for c in names])
    sizes = {(r["learn_label"], r["fold"]): r["count"] for r in sample.groupBy("learn_label", "fold").count().collect()}
    n = {f"{name}_{f}": float(sizes.get((v, f), 0)) for name, v in (("toxic", 1), ("clean", 0)) for f in (0, 1)}
    odds_of = {}
    for which, folds in (("0", (0,)), ("1", (1,)), ("all", (0, 1))):
        toxic, clean = (sum((F.col(f"{c}_{f}") for f in folds), F.lit(0)) for c in ("toxic", "clean"))
        n_toxic, n_clean = (sum(n[f"{c}_{f}"] for f in folds) for c in ("toxic", "clean"))
        odds = F.log((toxic + 0.5) / (n_toxic + 1)) - F.log((clean + 0.5) / (n_clean + 1))
        enough = max(LEAST_TEXTS, LEAST_SHARE * n_toxic)
        odds_of[which] = F.when((toxic >= enough) & (odds >= LEAST_ODDS), odds).alias(which)
    passing = summed.select("key", *odds_of.values())
    return passing.filter(" OR ".join(f"`{which}` IS NOT NULL" for which in odds_of)).toPandas()


def _lexicon(counts: pd.DataFrame, which: str) -> Lexicon:
    own = counts[counts[which].notna()]
    keys = own["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Lexicon(keys[order], own[which].to_numpy(float)[order])


def learn_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
    most: int = MOST_LABELLED,
) -> Toxicity:
    """Lexicon, trees and calibration fitted on at most ``most`` labelled rows outside the held-out fold.

    Texts of one fold get their features from the lexicon of the other; the calibration is fitted on scores of
    trees that haven't seen the text. Equal texts take part once.
    """
    sample = labelled_sample(docs, labels, label, id_col, text_col, most).withColumn("learn_text", text_or_empty("learn_text"))
    sample = sample.dropDuplicates(["learn_text"]).withColumn("fold", F.pmod(F.xxhash64("learn_text"), F.lit(2)))
    sample = checkpointed(sample.repartition(TASKS, "learn_id"))
    counts = _count_tokens(sample)
    lexicons = {f: _lexicon(counts, str(1 - f)) for f in (0, 1)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold = batch.column("fold").to_numpy()
            for lo, hi in groups(batch.column("learn_text")):
                texts = batch.column("learn_text")[lo:hi]
                x = np.where(fold[lo:hi, None] == 0, features(texts, lexicons[0]), features(texts, lexicons[1]))
                names = ["learn_label", "fold"]
                columns = [batch.column(c)[lo:hi] for c in names] + [pa.array(c) for c in x.T]
                yield pa.RecordBatch.from_arrays(columns, names + FEATURES)

    kinds = "learn_label int, fold int, " + ", ".join(f"{c} double" for c in FEATURES)
    known = sample.select("learn_text", F.col("learn_label").cast("int"), F.col("fold").cast("int"))
    known = known.mapInArrow(lean(run), kinds).toPandas()
    return fit_toxicity(known[FEATURES].to_numpy(float), known["learn_label"].to_numpy(float), known["fold"].to_numpy(), _lexicon(counts, "all"))


def fit_toxicity(x: np.ndarray, y: np.ndarray, fold: np.ndarray, lexicon: Lexicon) -> Toxicity:
    grow = lambda x, y: boosting.fit(x, y, {FEATURES.index(c): 1 for c in RISING}, least=0.2)
    unseen = np.zeros(len(y))
    for f in (0, 1):
        unseen[fold == f] = grow(x[fold != f], y[fold != f]).score(x[fold == f])
    return Toxicity(lexicon, grow(x, y), boosting.isotonic(unseen, y))


def score_toxicity(docs: DataFrame, model: Toxicity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, held_out, score (0 to 1), predicted (1 from REJECT on).

    Null counts as empty; empty texts are scored like any other, from features of 0. Rows with equal ids are scored
    each for itself; a null id isn't held out. An empty table gives an empty result. Other columns are neither read
    nor returned.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("scored_id"), text_or_empty(text_col).alias("scored_text"))
    scored = rows.mapInArrow(_scorer(model, "scored_text", ["scored_id"]), f"scored_id {kind}, score double")
    return scored.select(
        F.col("scored_id").alias(id_col),
        held_out("scored_id").alias("held_out"),
        "score",
        (F.col("score") >= REJECT).cast("int").alias("predicted"),
    )


def _scorer(model: Toxicity, text: str, keep: list[str], below: float | None = None):
    """Batches with the ``keep`` columns and the score; with ``below``, only rows that score less, without the score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).fill_null("")
            for lo, hi in groups(texts, SCORED_BYTES):
                score = model.score(texts[lo:hi])
                columns = [batch.column(c)[lo:hi] for c in keep]
                if below is None:
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], [*keep, "score"])
                else:
                    yield pa.RecordBatch.from_arrays(columns, keep).filter(pa.array(score < below))

    return lean(run)


def drop_toxic(docs: DataFrame, model: Toxicity, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with their columns, that score below REJECT."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    kinds = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema, strict=True))
    rows = docs.toDF(*names)
    return rows.mapInArrow(_scorer(model, names[docs.columns.index(text_col)], names, REJECT), kinds).toDF(*docs.columns)

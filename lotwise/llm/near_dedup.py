"""MinHash near-dedup: ProbMinHash over weighted shingles, banding, and verification of the exact similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.components import components
from lotwise.llm.exact_dedup import digest_of, digests
from lotwise.llm.tables import bitmap_size, bitmap_table, checkpointed, lean, text_or_empty, with_bit
from lotwise.llm.words import Words, groups, mixed, spans_hash

#: Words in a shingle. One that occurs n times in a text weighs 1 + ln n there, so that a line repeated many times does
#: not outweigh all the rest.
SHINGLE = 5
#: Probability Jaccard similarity from which on two texts are near copies.
SIMILAR = 0.8
#: Registers of a signature in each band, and bands. A pair at 0.8 shares no band once in 9,000 cases.
ROWS, BANDS = 6, 30
#: A bucket of up to so many texts has all its texts compared, a larger one at first all with its most typical one.
SMALL = 32
#: Texts outside a bucket's largest class that are compared at once, and texts that they are compared with.
BLOCK, CHUNK = 256, 1024
#: Registers, of 180, in which signatures must agree before the bags of a large bucket are compared. A pair at 0.8 agrees
#: in fewer once in 590 million cases, so that large buckets lose no more than small ones, where all bags are compared.
AGREEING = 110
#: Bits per key in filters, and their largest size (128 MB).
BITS_PER_KEY, MOST_BITS = 16, 2**30

_REGISTERS = ROWS * BANDS


def shingles(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of SHINGLE consecutive words and the text each belongs to; a shorter text is one shingle."""
    hashes = w.hashes()
    grams, at = w.grams(hashes, SHINGLE)
    short = np.flatnonzero((w.n_words > 0) & (w.n_words < SHINGLE))
    from_short = spans_hash(hashes, w.first[short], w.first[short + 1])
    text = np.concatenate([w.text[at], short])
    keys = np.concatenate([grams, from_short])
    order = np.lexsort((keys, text))
    return keys[order], text[order]


def weighted(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles per text: hash, text, weight."""
    keys, text = shingles(w)
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return keys[first], text[first], 1 + np.log(np.diff(np.append(first, len(keys))))


def _uniform(keys: np.ndarray, k: int) -> np.ndarray:
    h = mixed(keys + np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 % 2**64))
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53


def signatures(keys: np.ndarray, text: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """ProbMinHash: in each of _REGISTERS registers of each of n texts, the shingle that arrives there first.

    A shingle arrives at random times, at a rate of its weight, each time in a random register. All is made from its
    hash, so equal shingles arrive alike in all texts. Arrivals are made in rounds, one per shingle, and a shingle stops
    when its next one is later than the time by which the text's registers are full; where some are still
    empty then, the time is doubled.
    """
    out = np.zeros((n, _REGISTERS), np.uint64)
    total = np.bincount(text, weight, n)
    horizon = np.where(total > 0, _REGISTERS * (np.log(_REGISTERS) + 2) / np.maximum(total, 1), 0.0)
    pending = total > 0
    while pending.any():
        mine = pending[text]
        key, own, rate = keys[mine], text[mine], weight[mine].astype(float)
        time, k = np.zeros(len(key)), 0
        places, times, which = [], [], []
        while len(key):
            time = time - np.log(_uniform(key, k)) / rate
            alive = time < horizon[own]
            key, own, rate, time = key[alive], own[alive], rate[alive], time[alive]
            register = (mixed(key ^ np.uint64((k + 1) * 0xD1342543DE82EF95 % 2**64)) % np.uint64(_REGISTERS)).astype(np.int64)
            places.append(own * _REGISTERS + register)
            times.append(time)
            which.append(key)
            k += 1
        place, at, key = np.concatenate(places), np.concatenate(times), np.concatenate(which)
        first = np.full(n * _REGISTERS, np.inf)
        np.minimum.at(first, place, at)
        won = at == first[place]
        out.reshape(-1)[place[won]] = key[won]
        empty = np.isinf(first.reshape(n, _REGISTERS)).any(axis=1)
        pending = pending & empty
        horizon[pending] *= 2
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A hash per band of each signature."""
    part = signature.reshape(len(signature), BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] + np.uint64(1)
    for r in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + part[:, :, r])
    return key


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Probability Jaccard similarity of two bags of shingles (sorted hashes, repeated as often as they occur).

    The sum over common shingles i of 1 / sum over all j of max(a_j / a_i, b_j / b_i). With weights of 1 it is the
    plain Jaccard similarity. Two empty bags are equal.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    keys, which = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = (np.bincount(part, minlength=len(keys)) for part in (which[: len(a)], which[len(a) :]))
    x, y = (np.where(n > 0, 1 + np.log(np.maximum(n, 1)), 0.0) for n in (x, y))
    with np.errstate(divide="ignore"):
        ratio = np.where(x > 0, y / np.maximum(x, 1e-300), np.inf)
    # Up to the ratio of i, a_j / a_i is the larger; beyond it b_j / b_i is.
    order = np.argsort(ratio, kind="stable")
    r, xs, ys = ratio[order], np.cumsum(x[order]), np.cumsum(y[order])
    common = np.flatnonzero((x > 0) & (y > 0))
    upto = np.searchsorted(r, ratio[common], "right") - 1
    return float(np.sum(1 / (xs[upto] / x[common] + (ys[-1] - ys[upto]) / y[common])))


def _by_text(rows: DataFrame, name: str, kind: str, make) -> DataFrame:
    """(digest, name): what ``make`` gives for the texts, once for each digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in groups(batch.column("text")):
                w = Words(batch.column("text")[lo:hi])
                yield pa.RecordBatch.from_arrays([batch.column("digest")[lo:hi], make(w)], ["digest", name])

    made = rows.select("digest", "text").mapInArrow(lean(run), f"digest binary, {name} {kind}")
    return made.groupBy("digest").agg(F.first(name).alias(name))


def _buckets(w: Words) -> pa.Array:
    keys = band_keys(signatures(*weighted(w), w.n)).view(np.int64)
    keys = keys[w.n_words > 0]
    size = np.where(w.n_words > 0, BANDS, 0)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(keys.reshape(-1)))


def _bags(w: Words) -> pa.Array:
    """Sorted shingles of each text, and the lower halves of its signature's registers."""
    keys, text = shingles(w)
    packed = lambda values, ends: pa.Array.from_buffers(pa.binary(), w.n, [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())])
    held = signatures(*weighted(w), w.n).astype(np.uint32)
    bags = packed(keys, np.cumsum(np.bincount(text, minlength=w.n)) * 8)
    return pa.StructArray.from_arrays([bags, packed(held, np.arange(1, w.n + 1) * _REGISTERS * 4)], ["bag", "signature"])


def shared_buckets(texts: DataFrame) -> DataFrame:
    """(bucket, node, n) of all buckets with n >= 2 of the texts (node, buckets). Rows of other buckets aren't moved: a
    filter finds them."""
    every = texts.select("node", F.explode("buckets").alias("bucket"))
    sizes = checkpointed(every.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"))
    bits = bitmap_size(sizes.count(), BITS_PER_KEY, MOST_BITS)
    slot = F.pmod("bucket", F.lit(bits)).alias("slot")
    shared = bitmap_table(sizes.select(slot), "slot")
    kept = with_bit(every.withColumn("slot", slot), "slot", shared, "shared").filter("shared").select("bucket", "node")
    return checkpointed(kept.join(sizes, "bucket"))


def first_pairs(members: DataFrame, typical: DataFrame) -> DataFrame:
    """Pairs (node, center) of a bucket: all pairs of a small one; in a larger one, the most typical text and each other.

    Centers are written before the join by bucket, so that Spark can split the rows of a bucket with very many texts.
    """
    small = F.col("n") <= SMALL
    scored = members.join(typical, "node")
    centers = scored.groupBy("bucket", F.when(small, F.col("node")).alias("one")).agg(F.max(F.struct("score", "node")).alias("c"))
    pairs = members.join(checkpointed(centers.select("bucket", F.col("c.node").alias("center"))), "bucket")
    return pairs.filter(F.when(small, F.col("node") < F.col("center")).otherwise(F.col("node") != F.col("center"))).select("node", "center").distinct()


def other_links(members: DataFrame, labels: DataFrame, bags: DataFrame) -> DataFrame | None:
    """Links (a, b) between different classes in buckets too large for all pairs; signatures must agree well first.

    A pair of different classes has a text outside the bucket's largest class. Those are dealt into blocks of about BLOCK
    and compared with all texts of the bucket, which come in chunks of about CHUNK; so no task gets a whole bucket. None
    if each of the buckets is of one class.
    """
    known = members.filter(F.col("n") > SMALL).join(labels, "node", "left")
    known = checkpointed(known.withColumn("class", F.coalesce("label", "node")).drop("label"))
    counts = known.groupBy("bucket", "class").agg(F.count("*").alias("k"), F.max("n").alias("n"))
    major = counts.groupBy("bucket").agg(F.max(F.struct("k", "class")).alias("m"), F.max("n").alias("size"))
    major = major.select("bucket", F.col("m.class").alias("major"), F.expr("ceil((size - m.k) / {b})".format(b=BLOCK)).alias("blocks"), F.expr(f"ceil(size / {CHUNK})").alias("chunks"))
    major = checkpointed(major.filter("blocks > 0"))
    if major.isEmpty():
        return None
    rows = known.join(major, "bucket").join(bags, "node")
    block, chunk = (F.pmod(F.xxhash64("node", F.lit(k)), F.col(n)) for k, n in enumerate(("blocks", "chunks")))
    each = lambda n: F.explode(F.expr(f"sequence(0L, {n} - 1)"))
    columns = ["bucket", "node", "class", "bag", "signature"]
    apart = rows.filter("class != major").select(*columns, F.lit(True).alias("apart"), block.alias("block"), each("chunks").alias("chunk"))
    every = rows.select(*columns, F.lit(False).alias("apart"), each("blocks").alias("block"), chunk.alias("chunk"))

    def compare(table: pa.Table) -> pa.Table:
        apart = table.column("apart").to_numpy()
        node, label = table.column("node").to_numpy(), table.column("class").to_numpy()
        flat = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, _REGISTERS)
        queries, rest = np.flatnonzero(apart), np.flatnonzero(~apart)
        bags = table.column("bag").to_pylist()
        bag = lambda i: np.frombuffer(bags[i], np.uint64)
        links = set()
        for q in queries:
            agree = (flat[rest] == flat[q]).sum(1) >= AGREEING
            for x in rest[agree & (label[rest] != label[q])]:
                pair = int(min(node[x], node[q])), int(max(node[x], node[q]))
                if pair not in links and similarity(bag(q), bag(x)) >= SIMILAR:
                    links.add(pair)
        return pa.table({"a": pa.array([p[0] for p in links], pa.int64()), "b": pa.array([p[1] for p in links], pa.int64())})

    grouped = apart.unionByName(every).groupBy("bucket", "block", "chunk")
    return checkpointed(grouped.applyInArrow(compare, "a long, b long").distinct())


def _links(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs (a, b) out of (node, center) whose bags (node, bag) are similar."""
    of_center = bags.withColumnsRenamed({"node": "center", "bag": "other"})
    both = checkpointed(pairs).join(of_center, "center").join(bags, "node").select("node", "center", "bag", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bag = lambda b: np.frombuffer(b.as_buffer(), np.uint64)
        for batch in batches:
            same = [similarity(bag(a), bag(b)) >= SIMILAR for a, b in zip(batch.column("bag"), batch.column("other"), strict=True)]
            pair = pa.RecordBatch.from_arrays([batch.column("node"), batch.column("center")], ["a", "b"])
            yield pair.filter(pa.array(same, pa.bool_()))

    return checkpointed(both.mapInArrow(lean(run), "a long, b long"))


def linked_texts(rows: DataFrame) -> DataFrame:
    """(digest, label) of the texts (digest, text) that share a bucket with another; linked ones have equal labels.

    First come all pairs of small buckets and, in larger ones, pairs with the most typical text: one that shares large
    buckets in other bands too, as the origin of many near copies does. The links' components are the classes. What
    is left are pairs of different classes in large buckets; they are compared by signature first. So no link between
    classes is lost, and most pairs within a class are never made.
    """
    texts = _by_text(rows, "buckets", "array<long>", _buckets).withColumn("node", F.monotonically_increasing_id())
    texts = checkpointed(texts)
    members = shared_buckets(texts)
    typical = checkpointed(members.groupBy("node").agg(F.sum(F.log2("n")).alias("score")))
    nodes = checkpointed(texts.select("node", "digest").join(typical.select("node"), "node"))
    bits = bitmap_size(nodes.count(), BITS_PER_KEY, MOST_BITS)
    slot = F.pmod(F.xxhash64("digest"), F.lit(bits)).alias("slot")
    some = with_bit(rows.withColumn("slot", slot), "slot", bitmap_table(nodes.select(slot), "slot"), "wanted").filter("wanted")
    bags = _by_text(some, "made", "struct<bag: binary, signature: binary>", _bags).join(nodes, "digest")
    bags = checkpointed(bags.select("node", "made.bag", "made.signature"))
    links = _links(first_pairs(members, typical), bags)
    labels = checkpointed(components(links))
    more = other_links(members, labels, bags)
    if more is not None and not more.isEmpty():
        labels = checkpointed(components(links.unionByName(more)))
    labels = nodes.select("node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    return nodes.join(labels, "node").select("digest", "label")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, class_id, class_size, kept.

    Two texts are linked if their bags of SHINGLE-word shingles have a probability Jaccard similarity of SIMILAR or
    more; classes are connected texts. Texts equal up to runs of blanks are one text and are only counted. class_id is
    the smallest id in the class, and that row is kept (one of them if its row is repeated; a null id counts as
    larger than all others). Null counts as empty; texts without words are linked to each other only if equal. An
    empty table gives an empty result. Other columns are neither read nor returned.
    """
    return _grouped(docs, id_col, text_col).select(F.col("id").alias(id_col), "class_id", "class_size", "kept")


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``near_groups`` with the column names id and digest."""
    every = checkpointed(digests(docs, id_col, text_col))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    texts = checkpointed(every.groupBy("digest").agg(first.alias("keep"), F.count("*").alias("n")))
    rows = docs.select(digest_of(text_col).alias("digest"), text_or_empty(text_col).alias("text"))
    named = texts.join(linked_texts(rows), "digest", "left")
    # A text without a link is a class of its own, named by a number below all labels.
    named = checkpointed(named.withColumn("label", F.coalesce("label", -1 - F.monotonically_increasing_id())))
    classes = named.groupBy("label").agg(F.min("keep").alias("kept"), F.sum("n").alias("size"))
    known = checkpointed(named.join(checkpointed(classes), "label").select("digest", "kept", "size"))
    found = every.join(known, "digest")
    return found.select(
        "id",
        "digest",
        F.col("kept.id").alias("class_id"),
        F.col("size").alias("class_size"),
        (F.col("row") == F.col("kept.row")).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``near_groups`` keeps, with all their columns, whatever their names.

    Rows to drop are found by their id and text; of repeated rows that are kept, one stays.
    """
    named = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = docs.select(named, F.col(id_col).alias("id"), digest_of(text_col).alias("digest"))
    gone = _grouped(docs, id_col, text_col).select("id", "digest", "kept")
    stays = F.max("kept").alias("stays")
    # A row that is kept may have a copy with the same id; those ids and texts are looked at as a whole.
    pairs = gone.groupBy("id", "digest").agg(stays, F.count("*").alias("n")).filter("not stays or n > 1")
    pairs = pairs.select(F.col("id").alias("p_id"), F.col("digest").alias("p_digest"), "stays")
    bits = bitmap_size((pairs := checkpointed(pairs)).count(), BITS_PER_KEY, MOST_BITS)
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(bits)).alias("slot")
    flagged = with_bit(rows.withColumn("slot", slot("digest")), "slot", bitmap_table(pairs.select(slot("p_digest")), "slot"), "maybe")
    both = flagged.filter("maybe").join(pairs, F.expr("id <=> p_id and digest = p_digest"), "left")
    once = both.filter("stays").dropDuplicates(["id", "digest"])
    kept = [flagged.filter("not maybe"), both.filter("stays is null"), once]
    return kept[0].select("doc").unionByName(kept[1].select("doc")).unionByName(kept[2].select("doc")).select("doc.*")

"""SimHash near-duplicates, found by fuzzy hashing with the Golay code.

A fingerprint of 64 bits is cut into segments of 22, 21 and 21 bits, each read as a word of the
perfect binary Golay code of length 23: every word lies within three bits of exactly one codeword.
The keys of a segment are the codewords of the word itself and of all words one bit away, one to
six in all. Words one bit apart share the codeword of either; words two bits apart share that of
a word between them. By the pigeonhole principle, of up to three errors two segments have at most
one each, so a key of both segments is shared by the codeword pair of one fingerprint and the fuzzy
pairs of the other; of up to five errors two segments have at most two each, so fuzzy pairs meet
fuzzy pairs. Key pairs have 24 bits and a segment pair, so buckets stay small. Pairs that meet are
verified by their Hamming distance.

Only different fingerprints meet, whatever the number of copies. In a bucket the smallest stored
fingerprint is the pivot; a link between two members that both link to the pivot is left out, since
it joins nothing new. So a dense bucket gives a link per member, not per pair, and groups stay as
they are. Groups are the components of the links, by rounds of star contraction.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlytics.llm.common import LOWER, checkpointed, saved, text_function

# Seed of the shingle hash, and the Golay code's generator polynomial.
SEED = 42
GENERATOR = 0b101011100011
SEGMENTS = (22, 21, 21)
PAIRS = ((0, 1), (0, 2), (1, 2))

CHUNK = 1 << 15


def fingerprints(text: str | None, size: int = 3, prints: int = 1) -> list[int]:
    """SimHashes of the word shingles as signed longs; a text without words has zeros.

    The first is by the shingle hash itself, each further one by another mix of it.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return [0] * prints
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(size, len(words))
    starts, ends = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    counts = np.zeros((prints, 64), np.int64)
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK], ends[at : at + CHUNK])
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], np.uint64)
        for number in range(prints):
            bits = (_mixed(hashes, number) if number else hashes).astype(">u8").view(np.uint8)
            counts[number] += np.unpackbits(bits.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(starts), axis=1).view(">i8").ravel().tolist()


def _mixed(hashes: np.ndarray, number: int) -> np.ndarray:
    """A one-to-one mix of hashes (multiply and shift), different for every number."""
    mixed = hashes + np.uint64(number * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return mixed ^ (mixed >> np.uint64(31))


def fingerprints_of(text: str, size: int = 3, prints: int = 1) -> Column:
    kind = T.ArrayType(T.LongType())
    return text_function(lambda value: fingerprints(value, size, prints), kind)(F.col(text).cast("string"))


def _remainder(words: np.ndarray) -> np.ndarray:
    words = words.copy()
    for bit in range(22, 10, -1):
        words ^= np.where(words >> bit & 1, GENERATOR << (bit - 11), 0)
    return words


def _error_patterns() -> np.ndarray:
    """For every remainder, the pattern of up to three wrong bits that causes it."""
    bits = [0] + [1 << i for i in range(23)]
    patterns = np.unique([a | b | c for a in bits for b in bits for c in bits])
    table = np.zeros(2048, np.int64)
    table[_remainder(patterns)] = patterns
    return table


ERRORS = _error_patterns()


def nearest_codewords(words: np.ndarray) -> np.ndarray:
    """The 12 data bits of the one codeword within three bits of each 23-bit word."""
    return (words ^ ERRORS[_remainder(words)]) >> 11


def fuzzy_codewords(words: np.ndarray, width: int) -> np.ndarray:
    """One row per word: the codewords of the word and of its neighbours by one of `width` bits."""
    flips = np.array([0] + [1 << i for i in range(width)])
    return nearest_codewords(words[:, None] ^ flips[None, :])


def segments_of(prints: np.ndarray) -> list[np.ndarray]:
    rest, parts = prints.view(np.uint64), []
    for width in reversed(SEGMENTS):
        parts.append((rest & np.uint64((1 << width) - 1)).astype(np.int64))
        rest = rest >> np.uint64(width)
    return parts[::-1]


def exact_keys(prints: np.ndarray) -> list[np.ndarray]:
    """Per fingerprint one key for each pair of segments."""
    near = [nearest_codewords(part) for part in segments_of(prints)]
    columns = [pair << 24 | near[a] << 12 | near[b] for pair, (a, b) in enumerate(PAIRS)]
    return list(np.stack(columns, axis=1)) if len(prints) else []


def fuzzy_keys(prints: np.ndarray) -> list[np.ndarray]:
    """Per fingerprint all keys of its fuzzy codewords, each once."""
    near = [fuzzy_codewords(part, width) for part, width in zip(segments_of(prints), SEGMENTS)]
    rows = []
    for row in range(len(prints)):
        sets = [np.unique(part[row]) for part in near]
        rows.append(np.concatenate([
            (pair << 24 | sets[a][:, None] << 12 | sets[b][None, :]).ravel() for pair, (a, b) in enumerate(PAIRS)
        ]))
    return rows


def _key_column(keys):
    @F.arrow_udf("array<long>")
    def apply(prints: pa.Array) -> pa.Array:
        values = prints.to_numpy(zero_copy_only=False).astype(np.int64)
        rows = [row for at in range(0, len(values), 2048) for row in keys(values[at : at + 2048])]
        offsets = np.concatenate([[0], np.cumsum([len(row) for row in rows])]).astype(np.int32)
        flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))

    return apply


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(prints: DataFrame, max_distance: int = 3) -> DataFrame:
    """(which, a, b): links that join all distinct fingerprints (which, fp) of the same `which`.

    Every pair within the distance, 3 or 5 at most, is connected by the result, and each row is
    such a pair. `which` numbers the kind of fingerprint, from 0.

    Spark sizes the exploded keys by the fingerprints, a few bytes each, and would broadcast up to 108
    times as many rows as it expects; so they are merged, where adaptive execution splits skewed keys.
    """
    if max_distance > 5:
        raise ValueError("the segments cover up to five errors")
    key = (F.shiftleft(F.col("which").cast("long"), 26) + F.col("key")).alias("key")
    stored_keys = _key_column(exact_keys if max_distance <= 3 else fuzzy_keys)
    stored = prints.select("which", "fp", F.explode(stored_keys("fp")).alias("key")).select("which", F.col("fp").alias("b"), key)
    probes = prints.select("which", "fp", F.explode(_key_column(fuzzy_keys)("fp")).alias("key")).select(F.col("fp").alias("a"), key)
    met = stored.withColumn("pivot", F.min("b").over(Window.partitionBy("key"))).join(probes.hint("merge"), "key")
    by_pivot = (_distance("a", "pivot") <= max_distance) & (_distance("b", "pivot") <= max_distance)
    wanted = (F.col("b") == F.col("pivot")) | ((F.col("a") < F.col("b")) & ~by_pivot)
    found = met.filter((F.col("a") != F.col("b")) & (_distance("a", "b") <= max_distance) & wanted)
    return found.select("which", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label): every node of the edges (a, b) with the smallest node it can reach.

    Rounds of large-star and small-star contraction; the number of rounds grows with the logarithm
    of the longest path. Each round is saved by a reliable checkpoint.
    """
    ordered = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = checkpointed(ordered.filter("a <> b").distinct())
    state = None
    for _ in range(max_rounds):
        signature = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if signature == state:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).union(
                edges.select(F.col("a").alias("node"), F.col("a").alias("label"))
            ).distinct()
        state = signature
        edges = checkpointed(_small_star(_large_star(edges)))
    raise RuntimeError("the components did not settle")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    larger = both.filter("b > a").join(least, "a")
    return larger.select(F.col("low").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("low"))
    moved = edges.join(least, "b")
    return (
        moved.filter("a <> low").select(F.col("low").alias("a"), F.col("a").alias("b"))
        .union(least.select(F.col("low").alias("a"), "b"))
        .distinct()
    )


def print_edges(prints: DataFrame, max_distance: int = 3) -> DataFrame:
    """(a, b): edges between first fingerprints of the distinct rows of (prints array<long>).

    Texts are linked when any of their fingerprints are. Each value of a further fingerprint is
    stood for by the smallest first one that has it, and the others that share it link to that.
    """
    rows = prints.select("prints").distinct()
    each = rows.select(F.col("prints")[0].alias("first"), F.posexplode("prints").alias("which", "fp"))
    found = links(each.select("which", "fp").distinct(), max_distance)
    stand = each.groupBy("which", "fp").agg(F.min("first").alias("stand"))
    shared = each.join(stand, ["which", "fp"]).filter("first <> stand").select(F.col("first").alias("a"), F.col("stand").alias("b"))
    left = stand.select("which", F.col("fp").alias("a"), F.col("stand").alias("stand_a"))
    right = stand.select("which", F.col("fp").alias("b"), F.col("stand").alias("stand_b"))
    linked = found.join(left, ["which", "a"]).join(right, ["which", "b"]).select("stand_a", "stand_b")
    return linked.union(shared)


def groups(docs: DataFrame, size: int = 3, max_distance: int = 3, prints: int = 1) -> DataFrame:
    """(doc_id, fp, component_id) per row of `docs`; fp is the first of the fingerprints.

    Null texts and texts without words have fingerprint zero and are linked like any other. The
    component is named by its smallest doc_id; rows without doc_id take part but name none, so a
    component of such rows alone has a null name. Repeated rows each give a row.
    """
    found = saved(docs.select("doc_id", fingerprints_of("text", size, prints).alias("prints")), "simhash")
    found = found.withColumn("fp", F.col("prints")[0])
    if prints == 1:
        edges = links(found.select(F.lit(0).alias("which"), "fp").distinct(), max_distance)
    else:
        edges = print_edges(found, max_distance).toDF("a", "b")
    first = found.groupBy("fp").agg(F.min("doc_id").alias("first_doc"))
    label = components(edges).withColumnRenamed("node", "fp")
    labelled = first.join(label, "fp", "left").select("fp", "first_doc", F.coalesce("label", "fp").alias("label"))
    named = labelled.groupBy("label").agg(F.min("first_doc").alias("component_id"))
    of_print = labelled.join(named, "label").select("fp", "component_id")
    return found.select("doc_id", "fp").join(of_print, "fp").select("doc_id", "fp", "component_id")


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint in hex, component_id) by three-word shingles and three bits."""
    fingerprint_hex = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return groups(docs).select("doc_id", fingerprint_hex.alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, size: int = 3, max_distance: int = 3) -> DataFrame:
    """The documents without near copies: of each group the row with the smallest doc_id stays.

    Groups are those of `groups`: all fingerprints that few bits connect. Of rows of a group that
    repeat its smallest doc_id, that with the smallest digest of its text stays, once. Rows without
    doc_id cannot be told apart and all stay. The columns, whatever their names, are those of `docs`.
    """
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    fp = fingerprints_of("text", size)[0]
    rows = saved(docs.select(F.monotonically_increasing_id().alias("place"), fp.alias("fp"), row.alias("row")), "fingerprints")
    numbered = rows.filter("row.doc_id IS NOT NULL")
    order = F.struct(F.col("row.doc_id"), F.xxhash64("row.text"), F.col("place"))
    first = numbered.groupBy("fp").agg(F.min(order).alias("first"))
    edges = links(rows.select(F.lit(0).alias("which"), "fp").distinct(), max_distance)
    label = components(edges).withColumnRenamed("node", "fp")
    labelled = first.join(label, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    chosen = labelled.groupBy("label").agg(F.min("first").alias("first")).select(F.col("first.place").alias("place"))
    kept = numbered.join(chosen, "place", "left_semi").select("row.*")
    return kept.union(rows.filter("row.doc_id IS NULL").select("row.*"))

"""Near-duplicates by SimHash fingerprints and Golay-code fuzzy hashing.

The binary Golay code has 4,096 codewords of 23 bits, and every 23-bit word lies within three bits of exactly one.
A fingerprint is cut into three segments of at most 23 bits. A segment's key is the index of the codeword it
decodes to; words one bit apart may decode differently, but then one's codeword is among the few that lie
within four bits of the other. So fingerprints that differ in a segment by at most one bit always share a key,
if one side looks with all its nearby codewords and the other is filed under its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.components import smallest_reachable
from tillhouse.llm.text import map_texts, texts_of
from tillhouse.session import written

#: Bits that linked fingerprints may differ in.
DISTANCE = 3
#: Words of a shingle.
SHINGLE = 3
SEED = 42
#: Lowest bit and width of the three segments of a fingerprint.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
#: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, the generator of the Golay code.
GENERATOR = 0b101011100011
#: Fingerprints under one key up to which all pairs are verified.
CROWD = 256
#: Shingles whose hashes are counted at once.
COUNTED = 1 << 16


# ---- Fingerprints ----


def fingerprint(text: bytes) -> int:
    """SimHash over the hashes of three-word shingles, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], "<u8")
    else:
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(b" ".join(s), SEED) for s in zip(words, words[1:], words[2:], strict=False)), "<u8", len(words) - 2)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), COUNTED):
        part = hashes[at : at + COUNTED]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, the fingerprint ``fp`` as a signed long, and a hash ``which`` of the text, of each row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x) for x in texts_of(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps), batch.column("which")], ["doc_id", "fp", "which"])

    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("which"))
    return map_texts(hashed, ["doc_id", "text", "which"], "doc_id long, fp long, which long", each)


# ---- The code ----


def remainders(words: np.ndarray) -> np.ndarray:
    """The remainder of each 23-bit word by the generator: 0 for codewords, else that of its error alone."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest ^= ((rest >> bit) & 1) * (GENERATOR << (bit - 11))
    return rest


@lru_cache(maxsize=1)
def error_patterns() -> np.ndarray:
    """For every remainder, the errors of at most four bits that leave it, lightest first, padded with the first.

    One has at most three bits: the code is perfect. Where it has three, five have four.
    """
    found: list[list[int]] = [[] for _ in range(1 << 11)]
    for weight in range(5):
        errors = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), weight)], np.int64)
        for rest, error in zip(remainders(errors).tolist(), errors.tolist(), strict=True):
            found[rest].append(error)
    most = max(map(len, found))
    return np.array([x + x[:1] * (most - len(x)) for x in found], np.int64)


def nearby_indices(words: np.ndarray) -> np.ndarray:
    """Indices of the codewords within four bits of each word, its own first; repeats fill a row up."""
    return (words[:, None] ^ error_patterns()[remainders(words)]) >> 11


# ---- Keys ----
#
# Three errors over three segments fall in one of two ways. Either some segment has none and another at most one:
# the key is the first segment itself and the other's codeword, for each ordered pair of segments. Or each has
# exactly one: the key is all three codewords.

PAIRS = tuple(permutations(range(3), 2))


def segments(fps: np.ndarray) -> list[np.ndarray]:
    raw = fps.view(np.uint64)
    return [((raw >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64) for low, width in SEGMENTS]


def keys(fps: np.ndarray, probing: bool) -> tuple[np.ndarray, np.ndarray]:
    """``(row, key)`` of the keys under which fingerprints are filed or, if ``probing``, looked for."""
    exact = segments(fps)
    near = [nearby_indices(s) for s in exact]
    if not probing:
        near = [x[:, :1] for x in near]
    rows, out = [], []
    for kind, (i, j) in enumerate(PAIRS):
        key = (exact[i][:, None] << 12 | near[j]) << 3 | kind
        rows.append(np.repeat(np.arange(len(fps)), key.shape[1]))
        out.append(key.ravel())
    triple = (near[0][:, :, None, None] << 24 | near[1][:, None, :, None] << 12 | near[2][:, None, None, :]) << 3 | len(PAIRS)
    triple = triple.reshape(len(fps), -1)
    rows.append(np.repeat(np.arange(len(fps)), triple.shape[1]))
    out.append(triple.ravel())
    row, key = np.concatenate(rows), np.concatenate(out)
    if probing:  # drop what only filled rows up
        order = np.lexsort((key, row))
        row, key = row[order], key[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
        row, key = row[new], key[new]
    return row, key


def keyed(fps: DataFrame, probing: bool) -> DataFrame:
    """``key`` and ``fp`` (``near`` if probing) of distinct fingerprints."""
    name = "near" if probing else "fp"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("fp").to_numpy()
            for at in range(0, len(own), 512):
                part = own[at : at + 512]
                row, key = keys(part, probing)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row])], ["key", name])

    return fps.select("fp").mapInArrow(each, f"key long, {name} long")


def links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links ``a < b`` of distinct fingerprints, each within ``DISTANCE`` bits, that reach whatever any link reaches.

    Under a key with at most ``crowd`` fingerprints all pairs are verified. In a larger crowd pairs would grow with
    its square; there every member is linked by ``crowd_links`` instead.
    """
    shares = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fps = fps.repartition(shares, "fp")  # a number, so that they aren't put together for being small: each makes a hundred keys and more
    filed, asked = keyed(fps, False), keyed(fps, True)
    crowded = written(filed.groupBy("key").count().filter(F.col("count") > crowd).select("key")).hint("shuffle_merge")
    some = not crowded.isEmpty()
    few = filed.join(crowded, "key", "left_anti") if some else filed
    close = (F.col("near") < F.col("fp")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("near"))) <= DISTANCE)
    pairs = few.join(asked.hint("shuffle_merge"), "key").filter(close).select(F.col("near").alias("a"), F.col("fp").alias("b"))
    if not some:
        return pairs
    members = filed.join(crowded, "key", "left_semi").select("fp").distinct()
    seekers = asked.join(crowded, "key", "left_semi").select(F.col("near").alias("fp")).distinct()
    return pairs.unionByName(crowd_links(members, seekers))


def _around(fps: DataFrame, bits: int) -> DataFrame:
    """Every 64-bit word within so many bits of each fingerprint: ``point`` and ``fp``."""
    flips = [sum(1 << b for b in chosen) for n in range(bits + 1) for chosen in combinations(range(64), n)]
    masks = np.array(flips, np.uint64).view(np.int64)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("fp").to_numpy()
            for at in range(0, len(own), 32):
                part = own[at : at + 32]
                points = (part[:, None] ^ masks).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(points), pa.array(np.repeat(part, len(masks)))], ["point", "fp"])

    return fps.select("fp").mapInArrow(each, "point long, fp long")


def crowd_links(members: DataFrame, seekers: DataFrame) -> DataFrame:
    """Links of crowded fingerprints, in number proportional to the seekers.

    Two words within three bits have some word between them that is within one bit of the one and two of the
    other. Whoever is within two bits of such a point is within three of every member within one bit of it; so
    the smallest of these members stands for them, and no pair needs to be formed or verified. Members are
    among the seekers.
    """
    least = _around(members, 1).groupBy("point").agg(F.min("fp").alias("least"))
    met = _around(seekers, 2).join(least.hint("shuffle_merge"), "point").filter("fp <> least")
    return met.select(F.least("fp", "least").alias("a"), F.greatest("fp", "least").alias("b"))


def _groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows with fingerprint and text hash, and the group (``root``) of each distinct fingerprint."""
    marked = written(fingerprints(docs))
    nodes = marked.select("fp").distinct()
    edges = written(links(nodes).distinct())
    linked = smallest_reachable(edges).withColumnRenamed("node", "fp")
    return marked, nodes.join(linked.hint("shuffle_merge"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def components(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id``, the smallest id reachable over links.

    Needs ``doc_id`` and ``text``. A null text is empty; texts without words have fingerprint 0 and are linked like
    any other. Rows without an id belong to groups too, whose id is null only if all its rows' are. Repeated
    rows are returned each. An empty table gives no rows. Texts are never shuffled, and copies meet
    as one fingerprint, so the cost of links follows the distinct fingerprints. Tables that grow with them are merged, not
    broadcast: nothing of them passes through the driver.
    """
    marked, groups = _groups(docs)
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("doc_id")).join(groups.hint("shuffle_merge"), "fp")
    heads = least.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_fp = groups.join(heads.hint("shuffle_merge"), "root").select("fp", "component_id")
    return marked.join(by_fp.hint("shuffle_merge"), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group, with all its columns: that of the smallest id (rows without one come last).

    Rows with one id and one text are one document, of which one row stays. Of other rows with equal ids, that
    with the smallest text hash stays. Names that begin with two underscores are reserved.
    """
    marked, groups = _groups(docs)
    best = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("__id"), F.col("which").alias("__which"))).alias("best")
    by_fp = marked.groupBy("fp").agg(best).join(groups.hint("shuffle_merge"), "fp")
    kept = by_fp.groupBy("root").agg(F.min("best").alias("best")).select("best.__id", "best.__which")
    same = docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__which"))
    stay = docs.withColumn("__text_hash", F.xxhash64("text")).join(kept.hint("shuffle_merge"), same, "left_semi")
    return stay.dropDuplicates(["doc_id", "__text_hash"]).drop("__text_hash")

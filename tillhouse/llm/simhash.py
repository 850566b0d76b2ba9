"""Document fingerprints: SimHash by weighted terms, and all fingerprints within a Hamming radius by permuted block tables.

Every term of a text votes with its weight on every bit of the fingerprint, for or against as the term's hash says.
The share of equal bits of two fingerprints falls with the angle between the texts' term vectors.

Fingerprints that differ in at most ``radius`` bits agree in at least ``blocks - radius`` of their ``blocks`` blocks. There is a
table for every choice of so many blocks, in which fingerprints are permuted to begin with these; who is near
has the same beginning in some table. A pair is taken from the first table in which it meets, so none counts twice.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.text import freed, map_texts, slices, texts_of
from tillhouse.session import written

#: Bits of a fingerprint, as 64-bit words.
WORDS = 4
BITS = 64 * WORDS
#: Bits that near fingerprints may differ in, and the blocks of the tables.
RADIUS, BLOCKS = 7, 8
#: Weight of a word against that of a pair of neighbouring words.
SINGLE = 0.5
SEED = 77
#: Odd factors that turn a term's hash into the words of its vote.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
#: Terms whose votes are added up at once.
VOTES = 1 << 14


# ---- Fingerprints ----


def terms(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and weights of a text's distinct terms: its lower-cased (A to Z) words and pairs of neighbouring words.

    A term found n times weighs 1 + ln n, a single word ``SINGLE`` of that, in whole sixteenths, so that sums are exact.
    """
    words = text.lower().split()
    known = {w: xxhash.xxh64_intdigest(w, SEED) for w in set(words)}
    own = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    single, n_single = np.unique(own, return_counts=True)
    double, n_double = np.unique(own[:-1] * FACTORS[0] + (own[1:] ^ (own[1:] >> np.uint64(29))) * FACTORS[1], return_counts=True)
    weights = np.concatenate([SINGLE * (1 + np.log(n_single)), 1 + np.log(n_double)])
    return np.concatenate([single, double]), np.rint(16 * weights).astype(np.float32)


def fingerprint(text: bytes) -> np.ndarray:
    """The ``WORDS`` words of the fingerprint. A bit is set if more weight votes for than against it; without words none is."""
    hashes, weights = terms(text)
    votes = np.zeros(BITS, np.float64)
    for at in range(0, len(hashes), VOTES):
        spread = hashes[at : at + VOTES, None] * FACTORS
        spread ^= spread >> np.uint64(32)
        spread *= FACTORS[::-1]
        spread ^= spread >> np.uint64(29)
        signs = np.unpackbits(spread.view(np.uint8), axis=1, bitorder="little").astype(np.float32)
        votes += weights[at : at + VOTES] @ signs
    return np.packbits(2 * votes > weights.sum(dtype=np.float64), bitorder="little").view("<u8")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal bits."""
    return 1 - int(np.bitwise_count(a ^ b).sum()) / BITS


# ---- The next document's beginning ----


def replaced(text: bytes, following: bytes) -> tuple[int, bytes]:
    """The text's code points, and the text whose latter half (rounded down) is as much of the beginning of the other."""
    own = text.decode("utf-8", "replace")
    half = len(own) // 2
    # Four bytes hold any code point; what the cut leaves of one at the end is dropped with all behind it.
    head = following[: 4 * half + 4].decode("utf-8", "ignore" if len(following) > 4 * half + 4 else "replace")[:half]
    return len(own), (own[: len(own) - half] + head).encode()


EDITED = "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_CHAINED = f"task int, place string, text binary, {EDITED}"


def _row(doc_id: int | None, text: bytes, own: np.ndarray, following: bytes, other: np.ndarray) -> tuple:
    n, edited = replaced(text, following)
    changed = own if edited == text else fingerprint(edited)
    return doc_id, n, hashlib.sha256(edited).digest(), own.astype(">u8").tobytes(), changed.astype(">u8").tobytes(), likeness(own, changed), likeness(own, other)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def chained(docs: DataFrame) -> DataFrame:
    """Every document with its fingerprint, and the document that follows it by id, as ``EDITED`` says.

    The order is by id (null last), then by hashes of the text, so repeated ids have one too; the last is followed by the
    first. Rows are dealt by ranges of it, so that many rows of one id are split as well. A range is read in
    order, two texts at a time; its first and last rows, one of each a range, are joined with those of the neighbours.
    """
    keys = [F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text"), F.hash("text")]
    order = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    order = order.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text", F.spark_partition_id().alias("task"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, rows, task, none = None, [], 0, (None,) * len(EDITED.split(", "))
        for batch in slices(batches):
            task = batch.column("task")[0].as_py() if batch.num_rows else task
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                own = before[2] if before and before[1] == text else fingerprint(text)
                if before is None:
                    rows.append((task, "first", text, *none))
                else:
                    rows.append((task, "inside", None, *_row(*before, text, own)))
                before = doc_id, text, own
            yield _batch(rows, _CHAINED)
            rows = []
        if before is not None:
            yield _batch([(task, "last", before[1], before[0], *none[1:])], _CHAINED)

    found = written(order.mapInArrow(lambda it: freed(each(it)), _CHAINED))
    ends = found.filter("place = 'last'").select("task", "doc_id", "text")
    tasks = sorted(r["task"] for r in ends.select("task").collect())  # the numbers of the ranges that have rows
    after = docs.sparkSession.createDataFrame(list(zip(tasks, tasks[1:] + tasks[:1], strict=True)), "task int, next int")
    firsts = found.filter("place = 'first'").select(F.col("task").alias("next"), F.col("text").alias("following"))
    pairs = ends.join(after, "task").join(firsts, "next").select("doc_id", "text", "following")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            rows = []
            for doc_id, text, following in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following")), strict=True):
                rows.append(_row(doc_id, text, fingerprint(text), following, fingerprint(following)))
            yield _batch(rows, EDITED)

    names = [f.split()[0] for f in EDITED.split(", ")]
    return found.filter("place = 'inside'").select(*names).unionByName(pairs.mapInArrow(lambda it: freed(joined(it)), EDITED))


# ---- Permuted block tables ----


def block_tables(radius: int, blocks: int) -> list[tuple[int, ...]]:
    """The blocks with which each table begins."""
    if not 0 <= radius < blocks or BITS % blocks:
        raise ValueError(f"{blocks} blocks must divide {BITS} bits evenly and be more than the radius {radius}")
    return list(combinations(range(blocks), blocks - radius))


def _bits_of(words: list[Column], low: int, width: int) -> Column:
    """So many bits of a fingerprint, a long; a block of up to 64 bits lies in one or two words."""
    word, at = divmod(low, 64)
    taken = min(width, 64 - at)
    part = F.shiftrightunsigned(words[word], at)
    part = part if taken == 64 else part.bitwiseAND(F.lit((1 << taken) - 1))
    return part if taken == width else part.bitwiseOR(F.shiftleft(_bits_of(words, low + taken, width - taken), taken))


def within(fps: DataFrame, asked: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """How many rows of other fingerprints lie within the radius of each asked one: ``fingerprint``, ``n_near``.

    ``fps`` and ``asked`` have distinct ``fingerprint`` (binary), ``fps`` also ``n``, the rows that bear it. Only matches come out
    of the join, which verifies within it, and they are added up before the next shuffle.
    """
    tables, wide = block_tables(radius, blocks), BITS // blocks
    names = [f"w{k}" for k in range(WORDS)]
    half = lambda at: F.conv(F.hex(F.substring("fingerprint", at, 4)), 16, 10).cast("long")
    words = [F.shiftleft(half(8 * k + 1), 32).bitwiseOR(half(8 * k + 5)).alias(names[k]) for k in range(WORDS)]

    def keyed(df: DataFrame, *more: str) -> DataFrame:
        split = df.select(*words, *more)
        columns = [F.col(n) for n in names]
        key = lambda t: F.xxhash64(*[_bits_of(columns, wide * b, wide) for b in t]) if len(t) * wide > 64 else _joined([_bits_of(columns, wide * b, wide) for b in t], wide)
        starts = F.array(*[F.struct(F.lit(i).cast("short").alias("at"), key(t).alias("key")) for i, t in enumerate(tables)])
        return split.withColumn("t", F.explode(starts)).select("t.at", "t.key", *names, *more)

    filed, probes = keyed(fps, "n").alias("f"), keyed(asked).alias("q")
    differing = [F.col(f"f.{n}").bitwiseXOR(F.col(f"q.{n}")) for n in names]
    distance = sum((F.bit_count(d) for d in differing[1:]), F.bit_count(differing[0]))
    equal = [(_bits_of(differing, wide * b, wide) == 0) for b in range(blocks)]
    near = (F.col("f.at") == F.col("q.at")) & (F.col("f.key") == F.col("q.key")) & (distance > 0) & (distance <= radius) & _first_table(equal, tables)
    name = F.unhex(F.concat(*[F.lpad(F.hex(f"q.{n}"), 16, "0") for n in names])).alias("fingerprint")
    return filed.join(probes, near).groupBy(name).agg(F.sum("f.n").alias("n_near"))


def _joined(blocks: list[Column], wide: int) -> Column:
    """Blocks one after the other in a long."""
    out = blocks[0]
    for b in blocks[1:]:
        out = F.shiftleft(out, wide).bitwiseOR(b)
    return out


def _first_table(equal: list[Column], tables: list[tuple[int, ...]]) -> Column:
    """Whether a pair meets in this table (``f.at``) for the first time: the table of the first blocks in which it agrees.

    Tables are in the order of their blocks, so that is the one of the first so many equal blocks: within the table's
    last block, no other block is equal.
    """
    need, blocks = len(tables[0]), len(equal)
    before = [F.lit(0)]
    for e in equal:
        before.append(before[-1] + e.cast("int"))
    last = F.element_at(F.array(*[F.lit(t[-1] + 1) for t in tables]), F.col("f.at").cast("int") + 1)
    return F.element_at(F.array(*before[: blocks + 1]), last + 1) == need


def report(docs: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, every: int = 50) -> DataFrame:
    """Per document: what ``chained`` gives, and ``n_near``.

    ``n_chars`` (code points), ``edited_sha256`` and ``edited_fingerprint`` of its text with the latter half replaced by the
    beginning of the next document's, ``fingerprint`` (hex), ``near_edited`` and ``near_next`` (the shares of bits equal to the
    edited text's and the next document's fingerprint). ``n_near``, for documents whose id is divisible by ``every`` (null
    for others): how many documents have another fingerprint within ``radius`` bits of its own.

    Needs ``doc_id`` and ``text``; other columns, whatever their names, are not read. A null text is empty; texts without
    words have a fingerprint without bits. A row without an id comes after the others and asks nothing. Rows of one
    id, and repeated rows, are documents of their own. A single document is followed by itself. An empty
    table gives no rows. Texts are shuffled once.
    """
    rows = written(chained(docs))
    asks = F.coalesce(F.col("doc_id") % every == 0, F.lit(False))
    fps = written(rows.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"), F.max(asks).alias("asks")))
    near = within(fps.select("fingerprint", "n"), fps.filter("asks").select("fingerprint"), radius, blocks)
    counted = fps.filter("asks").join(near, "fingerprint", "left").select(F.col("fingerprint").alias("own"), F.coalesce("n_near", F.lit(0)).alias("n_near"))
    asking = rows.filter(asks).join(counted, F.col("fingerprint") == F.col("own")).drop("own")
    hexed = {c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")}
    return asking.unionByName(rows.filter(~asks).withColumn("n_near", F.lit(None).cast("long"))).withColumns(hexed)

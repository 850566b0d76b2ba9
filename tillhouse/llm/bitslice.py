"""Exact top-k inner products with a bit-sliced index.

A block of vectors is kept as bitmaps: slice ``j`` of attribute ``d`` has one bit per row, bit ``j`` of the row's
quantised value. A query's scores against a whole block come from adding slices with bitmap arithmetic, which
gives the slices of the score. The best rows are then chosen from the most significant slice downward,
and rows whose quantised score could still lie on either side of the boundary are resolved by exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.session import written

SCALE = 256
#: Rows of a block, and queries that meet a block at once.
BLOCK = 8192
QUERIES = 128
#: Bits of each attribute that are left out of the slices; the exact step resolves them.
DROPPED = 2
#: Shares into which blocks are dealt; every query batch visits each share.
LANES = 1024


def quantise(vectors: list) -> tuple[np.ndarray, np.ndarray]:
    """``floor(256 x)`` as int64, and which rows take part.

    A row takes no part if it is null or has a null or non-finite component. Rows of unequal lengths are
    read as ending in zeros.
    """
    usable = np.array([v is not None and all(x is not None for x in v) for v in vectors], bool)
    width = max((len(v) for v, u in zip(vectors, usable, strict=True) if u), default=0)
    out = np.zeros((len(vectors), width))
    for i in np.flatnonzero(usable):
        out[i, : len(vectors[i])] = vectors[i]
    usable &= np.isfinite(out).all(axis=1)
    out[~usable] = 0
    return np.floor(SCALE * out).astype(np.int64), usable


def _pack(flags: np.ndarray) -> np.ndarray:
    """Boolean rows as words of 64 bits, row i being bit i % 64 of word i // 64."""
    padded = np.zeros((*flags.shape[:-1], -(-flags.shape[-1] // 64) * 64), bool)
    padded[..., : flags.shape[-1]] = flags
    return np.packbits(padded, axis=-1, bitorder="little").view("<u8")


def _rows(bitmap: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[:n])


class Block:
    """The bit-sliced index of some rows."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, dropped: int = DROPPED):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values, self.dropped = ids[order], values[order], dropped
        self.n, self.width = values.shape
        self.low = self.values.min(axis=0) if self.n else np.zeros(self.width, np.int64)
        #: The block's rows as a bitmap.
        self.all = _pack(np.ones((1, self.n), bool))[0]
        above = (self.values - self.low) >> dropped
        self.bits = max(1, int(above.max(initial=0)).bit_length())
        #: All slices, attribute by attribute, and behind them their complements, for negative weights.
        self.slices = np.zeros((2 * self.width * self.bits, len(self.all)), "<u8")
        for j in range(self.bits):
            self.slices[j : self.width * self.bits : self.bits] = _pack((above.T >> j) & 1 == 1)
        self.slices[self.width * self.bits :] = self.slices[: self.width * self.bits] ^ self.all

    def sum_slices(self, weights: np.ndarray) -> list[np.ndarray]:
        """Slices of ``sum |w| * a`` over attributes, ``a`` being the quantised value above the block's lowest, or its complement where w < 0."""
        levels: dict[int, list[np.ndarray]] = {}
        size = np.abs(weights)
        for b in range(int(size.max()).bit_length() if len(size) else 0):
            for j in range(self.bits):
                chosen = np.flatnonzero((size >> b) & 1)
                if len(chosen):
                    at = chosen * self.bits + j + np.where(weights[chosen] < 0, self.width * self.bits, 0)
                    levels.setdefault(b + j, []).append(at)
        out: list[np.ndarray] = []
        carried: list[np.ndarray] = []
        level, top = 0, max(levels, default=-1)
        while level <= top or carried:
            stack = np.concatenate([*([self.slices[np.concatenate(levels[level])]] if level in levels else []), *carried, self.slices[:0]])
            carried = []
            while len(stack) > 2:  # full adders on thirds of the stack: three bitmaps become a sum here and a carry above
                third = len(stack) // 3
                x, y, z = stack[:third], stack[third : 2 * third], stack[2 * third : 3 * third]
                xy = x ^ y
                carried.append((x & y) | (xy & z))
                stack = np.concatenate([xy ^ z, stack[3 * third :]])
            if len(stack) == 2:
                carried.append((stack[0] & stack[1])[None])
                stack = (stack[0] ^ stack[1])[None]
            out.append(stack[0] if len(stack) else np.zeros_like(self.all))
            level += 1
        return out

    def top(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """The k best (vec_id, score) of rows whose id isn't ``own``, ties to the smaller id."""
        weights = np.zeros(self.width, np.int64)
        weights[: len(query)] = query[: self.width]
        allowed = self.all.copy()
        for i in range(np.searchsorted(self.ids, own, "left"), np.searchsorted(self.ids, own, "right")):
            allowed[i // 64] &= ~np.uint64(1 << (i % 64))
        slices = self.sum_slices(weights)
        # From the most significant slice downward: `sure` rows lie above the k-th value, `level` rows tie with it so far.
        sure, level, value = np.zeros_like(allowed), allowed, 0
        for j in range(len(slices) - 1, -1, -1):
            ahead = level & slices[j]
            if int(np.bitwise_count(sure | ahead).sum()) >= k:
                level, value = ahead, value | 1 << j
            else:
                sure, level = sure | ahead, level & ~slices[j]
        # A row's exact score is a constant plus 2^dropped times its sum plus something within this range, so rows less
        # than `reach` below the k-th sum may still be among the best. With fewer than k rows `value` ends at 0.
        reach = int(np.abs(weights).sum()) * ((1 << self.dropped) - 1)
        least = max(0, value - (-(-reach // (1 << self.dropped))))
        rows = _rows(self._at_least(slices, least) & allowed, self.n)
        scores = self.values[rows] @ weights
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return [(int(self.ids[rows[i]]), int(scores[i])) for i in best]

    def _at_least(self, slices: list[np.ndarray], least: int) -> np.ndarray:
        """Rows whose sum is at least ``least``."""
        if least >> len(slices):
            return np.zeros_like(self.all)
        more, equal = np.zeros_like(self.all), self.all
        for j in range(len(slices) - 1, -1, -1):
            if least >> j & 1:
                equal = equal & slices[j]
            else:
                more = more | (equal & slices[j])
                equal = equal & ~slices[j]
        return more | equal


def _as_batch(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    columns = [[r[0] for r in rows], [r[2].shape[1] for r in rows], [r[1].astype("<i8").tobytes() for r in rows], [_shrink(r[2]) for r in rows]]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "width", "ids", "vals"])


def _shrink(values: np.ndarray) -> bytes:
    """Integers with one byte ahead that tells their size."""
    size = next(s for s in (2, 4, 8) if not values.size or (-(1 << 8 * s - 1) <= int(values.min()) and int(values.max()) < 1 << 8 * s - 1))
    return bytes([size]) + values.astype(f"<i{size}").tobytes()


def _grow(ids: bytes, width: int, vals: bytes) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, "<i8")
    return own, np.frombuffer(vals, f"<i{vals[0]}", offset=1).astype(np.int64).reshape(len(own), width)


def blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """The usable rows of ``vec_id`` and ``embedding``, quantised, so many to a row. No shuffle."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = 0
        ids: list[np.ndarray] = []
        values: list[np.ndarray] = []

        def flush(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal part, ids, values
            width = max((v.shape[1] for v in values), default=0)
            have = np.concatenate(ids) if ids else np.zeros(0, np.int64)
            data = np.concatenate([np.pad(v, ((0, 0), (0, width - v.shape[1]))) for v in values]) if values else np.zeros((0, 0), np.int64)
            done = 0
            while len(have) - done >= rows or (final and done < len(have)):
                yield _as_batch([(part, have[done : done + rows], data[done : done + rows])])
                part, done = part + 1, min(done + rows, len(have))
            ids, values = [have[done:]], [data[done:]]

        for batch in batches:
            quantised, usable = quantise(batch.column("embedding").to_pylist())
            usable &= batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
            ids.append(batch.column("vec_id").fill_null(0).to_numpy(zero_copy_only=False)[usable])
            values.append(quantised[usable])
            if sum(map(len, ids)) >= rows:
                yield from flush(False)
        yield from flush(True)

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(each, "part long, width int, ids binary, vals binary")


def usable(vectors: DataFrame) -> DataFrame:
    """The rows that have an id and a vector of finite components."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x) < float("inf")))
    return vectors.filter(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = BLOCK) -> DataFrame:
    """For each row of ``queries`` the ``k`` rows of ``vectors`` with the highest integer inner product.

    Both need ``vec_id`` and ``embedding``. Rows whose vector is null or has a null or non-finite component,
    and rows without an id, take no part. A row isn't compared with rows of its own id; ties go to the
    smaller id; candidates that repeat an id are ranked each, queries that repeat one are asked once (with the
    smallest of its usable vectors). An empty table gives no rows.

    Both sides are cut into blocks. Blocks are dealt into at most ``LANES`` lanes, each batch of queries is
    sent to every lane once, and a pair of blocks leaves at most k rows per query, so neither a hot vector nor
    a large table makes more.
    """
    index = written(blocks(vectors, block))
    lanes = min(LANES, max(1, index.count()))
    dealt = index.withColumn("lane", F.pmod(F.xxhash64("ids"), F.lit(lanes)).cast("int"))
    once = usable(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = blocks(once, QUERIES).select(F.col("width").alias("q_width"), F.col("ids").alias("q_ids"), F.col("vals").alias("q_vals"))
    asked = asked.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes, Block] | None = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if last is None or last[0] != row["ids"]:
                    last = row["ids"], Block(*_grow(row["ids"], row["width"], row["vals"]))
                out = [
                    (int(own), vec_id, score)
                    for own, query in zip(*_grow(row["q_ids"], row["q_width"], row["q_vals"]), strict=True)
                    for vec_id, score in last[1].top(query, int(own), k)
                ]
                columns = zip(*out, strict=True) if out else [[]] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    pairs = dealt.repartition(lanes, "lane").join(asked.repartition(lanes, "lane"), "lane")  # so many that none are put together
    found = pairs.select("width", "ids", "vals", "q_width", "q_ids", "q_vals").mapInArrow(each, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def every_nth(vectors: DataFrame, n: int = 50) -> DataFrame:
    return vectors.filter(F.col("vec_id") % n == 0)

"""Alignment of two tokenizers' cuts of the same texts, by divide and conquer at shared cuts.

Both tokenizers cut the same bytes. Where a token of either ends at one offset, the text falls apart into two
that have nothing to do with each other. So a common end near the middle of an interval is looked for by bisection in
the other side's ends, and both halves are divided in turn; an interval without a common end inside is a group.
All intervals of many texts are divided in the same numpy steps, one level after the other.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillhouse.llm.bpe import PATTERN, byte_letters
from tillhouse.llm.text import freed, map_texts, slices, texts_of
from tillhouse.session import written

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bits of a pair's key that name the id of the second vocabulary.
ID_BITS = 15
#: Most frequent pairs whose counts every worker has (at most; cut at a frequency): 13 bytes each.
HEAD = 1 << 20
#: Bytes of texts that are aligned at once (a longer text by itself), and links that are counted at once.
ALIGNED, LINKS = 1 << 21, 1 << 21
#: Distinct pairs a counting task holds before it passes them on.
COUNTED = 1 << 21
#: Bytes from which characters after U+0540 begin. There the letter tables of pattern libraries differ by their age.
_LATER_LETTERS = bytes(range(0xD5, 0x100))
#: Longer texts (bytes) go through the first tokenizer's own library, whose patterns need no stack.
_LONG_TEXT = 1 << 20


# ---- Tokenizers ----


class Vocabularies:
    """Both encoders, and the bytes of every id."""

    def __init__(self, byte_level: str, pieces: str):
        with open(byte_level, encoding="utf-8") as f:
            spec = json.load(f)
        letters, special = byte_letters(), {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.quick = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.exact = Tokenizer.from_file(byte_level)
        self.exact.encode_special_tokens = True
        self.exact.no_truncation()
        self.exact.no_padding()
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        size = self.pieces.get_piece_size()
        if size > 1 << ID_BITS:
            raise ValueError(f"the second vocabulary has more than {1 << ID_BITS} ids")
        self.bytes_a = [b""] * (max(spec["model"]["vocab"].values()) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode() for i in range(size) for p in [self.pieces.id_to_piece(i)]
        ]
        self.long_a, self.long_b = (np.array([len(b) for b in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        # An id as text, with what follows it: the next id of its side, or the other side's first.
        self.said = np.array([f"{i}{end}".encode() for x, end in ((self.bytes_a, ","), (self.bytes_a, "|"), (self.bytes_b, ","), (self.bytes_b, ";")) for i in range(len(x))], object)

    def encode_a(self, text: str, raw: bytes) -> list[int]:
        if len(raw) <= _LONG_TEXT and len(raw) == len(raw.translate(None, _LATER_LETTERS)):
            return self.quick.encode_ordinary(" " + text)
        return self.exact.encode(" " + text, add_special_tokens=False).ids

    def encode(self, raws: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides per text; none on either side for empty texts and those that one side's tokens don't spell."""
        texts = [x.decode("utf-8", "replace") for x in raws]
        a = [self.encode_a(t, x) if x else [] for t, x in zip(texts, raws, strict=True)]
        b = self.pieces.encode(texts, num_threads=1)
        for i, raw in enumerate(raws):
            own = b" " + raw
            if not raw or b"".join(map(self.bytes_b.__getitem__, b[i])) != own or b"".join(map(self.bytes_a.__getitem__, a[i])) != own:
                a[i] = b[i] = []
        return a, b


@lru_cache(maxsize=1)
def load(byte_level: str, pieces: str) -> Vocabularies:
    return Vocabularies(byte_level, pieces)


# ---- Groups ----


def divide(ends_a: np.ndarray, ends_b: np.ndarray, texts_a: np.ndarray, texts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups end, as numbers of tokens of either side.

    ``ends_*`` are the tokens' byte offsets, rising over all texts; ``texts_*`` the numbers of tokens at which the texts
    end. An interval's common end is looked for from the middle of its first side's ends outward.
    """
    low_a, high_a = np.concatenate([[0], texts_a[:-1]]), texts_a
    low_b, high_b = np.concatenate([[0], texts_b[:-1]]), texts_b
    probe = np.zeros(len(texts_a), np.int64)
    done_a, done_b = [], []
    while len(low_a):
        inner = high_a - 1 - low_a  # ends inside
        leaf = (probe >= inner) | (high_b - low_b == 1)
        done_a.append(high_a[leaf])
        done_b.append(high_b[leaf])
        low_a, high_a, low_b, high_b, probe, inner = (x[~leaf] for x in (low_a, high_a, low_b, high_b, probe, inner))
        at = low_a + (inner - 1) // 2 + np.where(probe % 2, (probe + 1) // 2, -(probe // 2))
        other = np.searchsorted(ends_b, ends_a[at])
        hit = ends_b[other] == ends_a[at]
        cut_a, cut_b = at[hit] + 1, other[hit] + 1
        probe = np.concatenate([probe[~hit] + 1, np.zeros(2 * len(cut_a), np.int64)])
        low_a, high_a = np.concatenate([low_a[~hit], low_a[hit], cut_a]), np.concatenate([high_a[~hit], cut_a, high_a[hit]])
        low_b, high_b = np.concatenate([low_b[~hit], low_b[hit], cut_b]), np.concatenate([high_b[~hit], cut_b, high_b[hit]])
    ends = np.concatenate(done_a) if done_a else np.zeros(0, np.int64)
    order = np.argsort(ends)
    return ends[order], (np.concatenate(done_b) if done_b else ends)[order]


class Aligned:
    """Texts with tokens, aligned. Tokens of all texts follow each other; groups are numbered over all of them."""

    def __init__(self, a: list[list[int]], b: list[list[int]], known: Vocabularies):
        self.known = known
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        self.a, self.b = (np.array([i for x in side for i in x], np.int64) for side in (a, b))
        ends_a, ends_b = np.cumsum(known.long_a[self.a]), np.cumsum(known.long_b[self.b])
        texts_a, texts_b = np.cumsum(self.sizes_a), np.cumsum(self.sizes_b)
        self.end_a, self.end_b = divide(ends_a, ends_b, texts_a, texts_b)
        self.start_a, self.start_b = (np.concatenate([[0], e[:-1]])[: len(e)] for e in (self.end_a, self.end_b))
        self.last = np.searchsorted(self.end_a, texts_a) + 1  # groups up to the end of each text
        self.first = np.concatenate([[0], self.last[:-1]])[: len(self.last)]
        links = (self.end_a - self.start_a) * (self.end_b - self.start_b)
        self.links = np.add.reduceat(links, self.first) if len(self.first) else links

    def digests(self) -> list[str]:
        """sha256 of each text's groups as written out."""
        n, size_a, size_b = len(self.a), len(self.known.bytes_a), len(self.known.bytes_b)
        said = np.empty(n + len(self.b), np.int64)
        count_a, count_b = self.end_a - self.start_a, self.end_b - self.start_b
        said_a, said_b = self.a.copy(), self.b + 2 * size_a
        said_a[self.end_a - 1] += size_a
        said_b[self.end_b - 1] += size_b
        said[np.arange(n) + np.repeat(self.start_b, count_a)] = said_a
        said[np.arange(len(self.b)) + np.repeat(self.end_a, count_b)] = said_b
        ends = np.cumsum(self.sizes_a + self.sizes_b)
        words = self.known.said.take(said)
        return [hashlib.sha256(b"".join(words[end - size : end].tolist())[:-1]).hexdigest() for end, size in zip(ends.tolist(), (self.sizes_a + self.sizes_b).tolist(), strict=True)]

    def pairs(self, groups: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Group number and both ids of every link of these groups."""
        start_a, start_b = self.start_a[groups], self.start_b[groups]
        count_a, count_b = self.end_a[groups] - start_a, self.end_b[groups] - start_b
        links = count_a * count_b
        which = np.repeat(np.arange(len(links)), links)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(links) - links, links)
        i, j = np.divmod(inside, count_b[which])
        return which + groups.start, self.a[start_a[which] + i], self.b[start_b[which] + j]

    def distinct(self, limit: int = LINKS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(text, keys, times): distinct linked id pairs and how many links they have. A text comes several times if it
        has more than ``limit`` links, each time with other pairs, so that no more than about so many are held at once."""
        text = 0
        while text < len(self.links):
            room = np.searchsorted(np.cumsum(self.links[text:]), limit, "right")
            if room == 0:
                for keys, times in self._of_long(text, limit):
                    yield text, keys, times
                text += 1
                continue
            which, a, b = self.pairs(slice(int(self.first[text]), int(self.last[text + room - 1])))
            owner = np.searchsorted(self.last[text : text + room], which, "right")
            found, times = np.unique(owner << 2 * ID_BITS + 2 | a << ID_BITS | b, return_counts=True)
            cuts = np.searchsorted(found, np.arange(room + 1) << 2 * ID_BITS + 2)
            keys = found & (1 << 2 * ID_BITS + 2) - 1
            for k in range(room):
                yield text + k, keys[cuts[k] : cuts[k + 1]], times[cuts[k] : cuts[k + 1]]
            text += room

    def _of_long(self, text: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The pairs of one text, a range of first ids at a time, each id with its whole groups."""
        first, last = int(self.first[text]), int(self.last[text])
        groups = np.arange(first, last)
        count_a, count_b = self.end_a[first:last] - self.start_a[first:last], self.end_b[first:last] - self.start_b[first:last]
        own = self.a[self.start_a[first] : self.end_a[last - 1]]
        group = np.repeat(groups, count_a)
        order = np.argsort(own, kind="stable")
        own, group = own[order], group[order]
        ends = np.append(np.flatnonzero(own[1:] != own[:-1]) + 1, len(own))  # of every id's occurrences
        made = np.cumsum(count_b[group - first])[ends - 1]
        at = begun = 0
        while at < len(ends):
            to = max(at + 1, int(np.searchsorted(made, limit + (made[at - 1] if at else 0), "right")))
            yield self._of_range(own[begun : ends[to - 1]], group[begun : ends[to - 1]], limit)
            at, begun = to, ends[to - 1]

    def _of_range(self, own: np.ndarray, group: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of these occurrences of first ids with all second ids of their groups, added up in steps of about ``limit``."""
        keys, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        counts = self.end_b[group] - self.start_b[group]
        made, at = np.cumsum(counts), 0
        while at < len(own):
            end = max(at + 1, int(np.searchsorted(made, limit + (made[at - 1] if at else 0), "right")))
            part = counts[at:end]
            which = np.repeat(np.arange(at, end), part)
            inside = np.arange(len(which)) - np.repeat(np.cumsum(part) - part, part)
            new, n = np.unique(own[which] << ID_BITS | self.b[self.start_b[group[which]] + inside], return_counts=True)
            keys, times = _added(keys, times, new, n)
            at = end
        return keys, times


def _added(keys: np.ndarray, times: np.ndarray, more: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both counts together; keys are distinct in either."""
    found, at = np.unique(np.concatenate([keys, more]), return_inverse=True)
    return found, np.bincount(at, np.concatenate([times, n]), len(found)).astype(np.int64)


# ---- Documents ----

ALIGNMENT = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, keys array<int>, times array<int>"


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """Ids and texts, about ``ALIGNED`` bytes at a time."""
    ids, texts, held = [], [], 0
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
        if held and held + len(text) > ALIGNED:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(doc_id)
        texts.append(text)
        held += len(text)
    if ids:
        yield ids, texts


def align(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None, limit: int = LINKS) -> DataFrame:
    """Per document its numbers of tokens, groups and links, the digest of its groups, and its linked id pairs.

    ``keys`` (first id times 2^15 plus second) and ``times`` are the distinct pairs and the links each has. A
    document with more than ``limit`` links has several rows, of one ``row`` number: the first has the numbers, each has
    other pairs. Needs ``doc_id`` and ``text``; every worker must have the two files. No shuffle.
    """
    paths = byte_level or public_tokenizers.path(BYTE_LEVEL), pieces or public_tokenizers.path(PIECES)
    names = [c.split()[0] for c in ALIGNMENT.split(", ")]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        *plain, keys, times = zip(*rows, strict=True)
        ends = pa.array(np.cumsum([0, *map(len, keys)]), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x).astype(np.int32))) for x in (keys, times)]
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in plain[:-1]], pa.array(plain[-1], pa.string()), *lists], names)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number, none = load(*paths), 0, np.zeros(0, np.int64)
        for batch in batches:
            base = batch.column("task")[0].as_py() << 33 if batch.num_rows else 0
            for ids, texts in _portions(batch):
                a, b = known.encode(texts)
                has = [i for i, x in enumerate(a) if x]
                whole = Aligned([a[i] for i in has], [b[i] for i in has], known)
                groups, digests = (whole.last - whole.first).tolist(), whole.digests()
                rows: list[tuple] = [(base + number + i, ids[i], 0, 0, 0, 0, "", none, none) for i in range(len(ids)) if not a[i]]
                seen, held = -1, 0
                for k, keys, times in whole.distinct(limit):
                    i = has[k]
                    told = (len(a[i]), len(b[i]), groups[k], int(whole.links[k]), digests[k]) if k != seen else (0, 0, 0, 0, None)
                    rows.append((base + number + i, ids[i], *told, keys, times))
                    seen, held = k, held + len(keys)
                    if held > limit:
                        yield made(rows)
                        rows, held = [], 0
                if rows:
                    yield made(rows)
                number += len(ids)

    return map_texts(docs.select("doc_id", "text", F.spark_partition_id().alias("task")), ["doc_id", "text", "task"], ALIGNMENT, each)


def count_pairs(aligned: DataFrame) -> DataFrame:
    """``key`` and ``n``, the number of documents that hold the pair linked. Counted in the tasks before the shuffle."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), pa.array(times)], ["key", "n"])

        keys, times, held, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0
        for batch in batches:
            part = batch.column("keys").flatten().to_numpy()
            held.append(part)
            size += len(part)
            if size >= COUNTED:
                keys, times = _added(keys, times, *np.unique(np.concatenate(held).astype(np.int64), return_counts=True))
                held, size = [], 0
                if len(keys) >= COUNTED:
                    yield from out()
                    keys, times = keys[:0], times[:0]
        if held:
            keys, times = _added(keys, times, *np.unique(np.concatenate(held).astype(np.int64), return_counts=True))
        yield from out()

    return aligned.select("keys").mapInArrow(lambda it: freed(each(it)), "key int, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _head(counts: DataFrame, most: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """The frequency from which pairs are in the head, and the head's keys (rising), counts and marks of the best."""
    step = F.floor(F.log2("n") * 8).alias("step")
    steps = counts.groupBy(step).agg(F.count(F.lit(1)).alias("v"), F.min("n").alias("least")).collect()
    room, least = most, 1 << 62
    for r in sorted(steps, key=lambda r: -r["step"]):
        if (room := room - r["v"]) < 0:
            break
        least = r["least"]
    head = counts.filter(F.col("n") >= least).select("key", "n", "best").toArrow()
    keys, n, best = (head.column(c).to_numpy() for c in ("key", "n", "best"))
    order = np.argsort(keys)
    return least, keys[order], n[order], best[order]


def report(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None, head: int = HEAD, limit: int = LINKS) -> DataFrame:
    """Per document: ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256``.

    ``n_best`` counts the links whose pair is held linked by as many documents as any pair of its first id, ``count_sum``
    adds the numbers of documents up over all links.

    Needs ``doc_id`` and ``text``; other columns, whatever their names, are not read. A null or empty text, and one that
    either side's tokens don't spell byte for byte, has no tokens: zeros and an empty digest. A null id stays null;
    repeated rows count, and are reported, each. An empty table gives no rows.

    Texts are encoded once and never shuffled. Counts of pairs are added up in the tasks first. Workers get the counts of
    at most ``head`` pairs; the other pairs of a document go to their counts by a shuffle, and only sums come back.
    The highest count per first id is broadcast: one row per id of the first vocabulary.
    """
    aligned = written(align(docs, byte_level, pieces, limit))
    counted = written(count_pairs(aligned))
    owner = F.shiftright("key", ID_BITS)
    highest = counted.groupBy(owner.alias("own")).agg(F.max("n").alias("highest"))
    counts = counted.join(F.broadcast(highest), owner == F.col("own")).select("key", "n", (F.col("n") == F.col("highest")).alias("best"))
    least, keys, numbers, best = _head(counts, head)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, marks = np.append(numbers, 0), np.append(best, False)
        for batch in slices(batches):
            sizes = np.diff(batch.column("keys").offsets.to_numpy())
            own, times = (batch.column(c).flatten().to_numpy() for c in ("keys", "times"))
            at = np.minimum(np.searchsorted(keys, own), max(0, len(keys) - 1))
            inside = keys[at] == own if len(keys) else np.zeros(len(own), bool)
            at[~inside] = len(keys)
            rows = np.repeat(np.arange(len(sizes)), sizes)
            sums = [_sums(rows, times * marks[at], len(sizes)), _sums(rows, times * weight[at], len(sizes))]
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(rows[~inside], minlength=len(sizes)))]), pa.int32())
            tail = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(own[~inside]), pa.array(times[~inside])], ["key", "times"]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in told], *map(pa.array, sums), tail], [*told, "n_best", "count_sum", "tail"])

    told = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = ALIGNMENT.split(", keys")[0] + ", n_best long, count_sum long, tail array<struct<key:int,times:int>>"
    looked = written(aligned.mapInArrow(lambda it: freed(each(it)), schema))
    tails = looked.select("row", F.explode("tail").alias("t")).select("row", "t.key", "t.times")
    rest = tails.join(counts.filter(F.col("n") < least), "key").select("row", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    numbers_of = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    both = looked.drop("tail").unionByName(rest.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_best", "count_sum")]), allowMissingColumns=True)
    sums = both.groupBy("row").agg(F.max("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in numbers_of], F.max("groups_sha256").alias("groups_sha256"))
    return sums.select("doc_id", *numbers_of, "groups_sha256")


def _sums(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of whole numbers per row; ``rows`` rise."""
    total = np.concatenate([[0], np.cumsum(values.astype(np.int64))])
    ends = np.searchsorted(rows, np.arange(n + 1))
    return total[ends[1:]] - total[ends[:-1]]

"""Byte-pair encoding with a queue of merge ranks over a linked list of symbols, and decoding."""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers.pre_tokenizers import ByteLevel

from tillhouse.llm.text import map_texts, texts_of

VOCABULARY = "byte_bpe_50k.json"
#: Fixed value: the published pattern by which this vocabulary's tokenizer cuts a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes that only occur from U+0558 on. From there the letter tables of the two pattern libraries differ.
_LATER_LETTERS = bytes(range(0xD5, 0x100))
#: Pieces kept in each of a worker's two caches. When the fresh one is full it becomes the older one, which is let go.
CACHE = 300_000
#: Bits for an id in the key of a pair.
ID_BITS = 20
#: Longer pieces are merged but not kept in the cache.
LONGEST_CACHED = 64


def byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte in a byte-level vocabulary: itself if printable, else 256 and up."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class BytePairs:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of: dict[int, bytes] = {i: as_bytes(t) for t, i in ids.items() if t not in self.special}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.first = [ids.get(c) for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, (a, b) in enumerate(tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]):
            self.ranks.setdefault(ids[a] << ID_BITS | ids[b], rank)
            self.made.append(ids[a + b])
        self.cut = regex.compile(PATTERN)
        self.exact_cut = ByteLevel(add_prefix_space=False, use_regex=True)
        self.letters = letters
        self.split_special = regex.compile("(" + "|".join(regex.escape(t) for t in self.special) + ")") if self.special else None
        self.digits = {i: str(i) for i in self.bytes_of}
        self.fresh: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece: always the best-ranked, then leftmost pair is joined next.

        Symbols are a doubly linked list over positions. A queue entry that names symbols which have
        since been merged away is stale and skipped, so no entry is ever searched for: n log n steps.
        """
        symbol = [self.first[b] for b in piece]
        n, rank_of, made = len(symbol), self.ranks.get, self.made
        queue = [r << 32 | i for i in range(n - 1) if (r := rank_of(symbol[i] << ID_BITS | symbol[i + 1])) is not None]
        if not queue:
            return symbol
        heapq.heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            best = heapq.heappop(queue)
            i = best & 0xFFFFFFFF
            j = after[i]
            if j >= n or symbol[i] < 0 or rank_of(symbol[i] << ID_BITS | symbol[j]) != best >> 32:
                continue
            symbol[i] = s = made[best >> 32]
            symbol[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of(s << ID_BITS | symbol[k])) is not None:
                    heapq.heappush(queue, r << 32 | i)
            if (h := before[i]) >= 0 and (r := rank_of(symbol[h] << ID_BITS | s)) is not None:
                heapq.heappush(queue, r << 32 | h)
        return [s for s in symbol if s >= 0]

    def pieces(self, text: str, raw: bytes) -> list[str]:
        """The text cut by the pattern. Letters newer than one library's tables go through the tokenizer's own cutter."""
        if len(raw) == len(raw.translate(None, _LATER_LETTERS)):
            return self.cut.findall(text)
        return [bytes(self.letters[c] for c in piece).decode() for piece, _ in self.exact_cut.pre_tokenize_str(text)]

    def known(self, piece: str) -> bytes:
        """Ids of a piece as unsigned 32-bit integers."""
        if (found := self.fresh.get(piece)) is None:
            if (found := self.older.get(piece)) is None:
                found = array("I", self.merge(piece.encode())).tobytes()
            if len(piece) <= LONGEST_CACHED:
                if len(self.fresh) >= CACHE:
                    self.fresh, self.older = {}, self.fresh
                self.fresh[piece] = found
        return found

    def encode(self, raw: bytes) -> list[int]:
        """The ids of a UTF-8 text; the strings of special tokens become those tokens."""
        text = raw.decode("utf-8", "replace")
        parts = self.split_special.split(text) if self.split_special and any(t in text for t in self.special) else [text]
        found: list[bytes] = []
        for part in parts:
            if part in self.special:
                found.append(array("I", [self.special[part]]).tobytes())
            elif part:
                found.extend(map(self.known, self.pieces(part, raw)))
        return array("I", b"".join(found)).tolist()

    def decode(self, ids: list[int]) -> str:
        """The vocabulary strings of the ids one after another; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> BytePairs:
    return BytePairs(path)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: the number of ids, and hashes of its ids and of the text decoded from them.

    Needs ``doc_id`` and ``text``; ``path`` names the vocabulary file, which every worker must have. A null
    text is empty (no ids), a null id stays null, repeated rows are encoded each. No shuffle.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = load(path)
        for batch in batches:
            counts, id_hashes, text_hashes = [], [], []
            for raw in texts_of(batch):
                ids = pairs.encode(raw)
                counts.append(len(ids))
                id_hashes.append(hashlib.sha256(",".join(map(pairs.digits.__getitem__, ids)).encode()).hexdigest())
                text_hashes.append(hashlib.sha256(pairs.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_hashes, pa.string()), pa.array(text_hashes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return map_texts(docs, ["doc_id", "text"], "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", each)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document its ids, as an array."""
    path = path or public_tokenizers.path(VOCABULARY)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = load(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([pairs.encode(x) for x in texts_of(batch)], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return map_texts(docs, ["doc_id", "text"], "doc_id long, ids array<int>", each)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """The texts of ``doc_id`` and ``ids``; null ids give an empty text."""
    path = path or public_tokenizers.path(VOCABULARY)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = load(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([pairs.decode(x or []) for x in batch.column("ids").to_pylist()], pa.string())], ["doc_id", "text"])

    return map_texts(encoded, ["doc_id", "ids"], "doc_id long, text string", each)

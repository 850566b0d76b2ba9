"""Harmonic packing of documents into token sequences.

A sequence holds ``CAPACITY`` tokens. Pieces are put into reciprocal-capacity classes: class ``i`` takes pieces of
at most ``CAPACITY / i`` tokens, and each of its sequences is filled with exactly ``i`` pieces. So a piece's place
follows from its rank in its class alone, and every worker fills its own share of a class without knowing
about the others. Documents may be cut, so each is cut into pieces that lie just below such a reciprocal.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce
from typing import TYPE_CHECKING

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.bpe import byte_letters
from tillhouse.llm.text import map_texts, texts_of
from tillhouse.session import written

if TYPE_CHECKING:
    import pandas as pd

CAPACITY = 4096
VOCABULARY = "word_bpe_49k.json"
#: The id that ends every document.
END = 2
#: A piece whose class leaves at most this share of a sequence unfilled is not cut further.
SLACK = 1 / 32
#: Pieces that are ranked together; a class with more is ranked in several shares.
SHARE = 2_000_000
#: Entries of each of a worker's two caches of words.
CACHE = 400_000
LONGEST_CACHED = 64
#: ASCII characters that are neither letters, digits nor white space.
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_LETTERS = frozenset(range(ord("a"), ord("z") + 1)) | frozenset(range(ord("A"), ord("Z") + 1))
#: Lower-case letters of Latin-1 alone, in UTF-8: no step before the merges changes or cuts such a word.
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
#: The steps of a tokenizer before its merges for which that holds.
_STEPS = (
    r'Sequence(normalizers=[NFC(), Replace(pattern=Regex("\s+"), content=" "), Lowercase()])',
    r"""Sequence(pretokenizers=[Split(pattern=Regex("'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"), behavior=Removed, invert=True), """
    "ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)])",
)


class Cache(dict):
    """Ids of words; ``ask`` is asked for those of a word that it lacks."""

    ask: Callable[[bytes], bytes | bytearray]

    def __missing__(self, word: bytes) -> bytes | bytearray:
        return self.ask(word)


class Words:
    """Ids of a text by a tokenizer that drops white space, so that every word can be looked up by itself.

    Words are cut at ASCII white space, which no token crosses. Within a word, closing marks after an
    letter form a token of their own, so ``word,`` is looked up as ``word`` and ``,``. Words of plain
    letters go to the tokenizer's merges without its steps before, which take most of the time.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        plain = (repr(self.tokenizer.normalizer), repr(self.tokenizer.pre_tokenizer)) == _STEPS
        self.model = self.tokenizer.model if plain else None
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self.fresh: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.long: list[bytes] = []  # words of the fresh cache that the older one is not to have

    def split(self, raw: bytes) -> list[bytes]:
        # Lower case is the tokenizer's own first step. It is taken ahead only where the order of steps cannot
        # matter: no combining marks (U+0300 to U+036F begin with these bytes) and no special tokens.
        if b"<|" not in raw and b"\xcc" not in raw and b"\xcd" not in raw:
            raw = raw.lower()
        return raw.split()

    def _rows(self, cut: list[list[bytes]]) -> list[list[bytes | bytearray]]:
        """The ids of each word. New words are first given an empty array each, and all of them learned at once in the end."""
        fresh = self.fresh = self.fresh if isinstance(self.fresh, Cache) else Cache(self.fresh)
        older, new, split = self.older, {}, []

        def ask(word: bytes) -> bytes | bytearray:
            if len(word) > LONGEST_CACHED:
                self.long.append(word)
            if older and (found := older.get(word)) is not None:
                fresh[word] = found
                return found
            if not word.isalpha():
                stem = word.rstrip(_MARKS)
                if stem != word and stem and b"<|" not in word and (stem[-1] in _LETTERS or _PLAIN.fullmatch(stem)):
                    parts = fresh[stem], fresh[word[len(stem) :]]
                    if type(parts[0]) is bytes is type(parts[1]):
                        fresh[word] = found = parts[0] + parts[1]
                        return found
                    fresh[word] = ids = bytearray()
                    split.append((word, ids, parts))
                    return ids
            fresh[word] = new[word] = ids = bytearray()
            return ids

        fresh.ask = ask
        rows = [list(map(fresh.__getitem__, words)) for words in cut]
        order = self._learn_plain(set(new))
        encoded = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in order], add_special_tokens=False)
        for word, e in zip(order, encoded, strict=True):
            fresh[word] = array("I", e.ids).tobytes()
        for word, ids in new.items():
            ids += fresh[word]
        for word, ids, (stem, marks) in split:
            ids += stem
            ids += marks
            fresh[word] = bytes(ids)
        del fresh.ask  # it holds the older cache
        return rows

    def _learn_plain(self, words: set[bytes]) -> list[bytes]:
        """Bring the plain words into the fresh cache; returns the others."""
        if self.model is None:
            return list(words)
        others, tokenize = [], self.model.tokenize
        for word in words:
            if word.isalpha() and word.islower():
                spelt = word.decode()
            elif _PLAIN.fullmatch(word):
                spelt = word.decode("latin-1").translate(self.letters)
            else:
                others.append(word)
                continue
            self.fresh[word] = array("I", [token.id for token in tokenize(spelt)]).tobytes()
        return others

    def forget(self) -> None:
        """Let the older cache go: a worker lives on after its task, beside other stages' memory."""
        self.older = {}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        if len(self.fresh) >= CACHE:
            for word in self.long:
                self.fresh.pop(word, None)
            self.older, self.fresh, self.long = self.fresh, {}, []
        try:
            return [b"".join(row) for row in self._rows([self.split(x) for x in texts])]
        except BaseException:
            self.fresh, self.long = {}, []  # it may hold words whose ids are still to come
            raise


@lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    return Words(path)


def cuts(length: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[tuple[int, int]]:
    """``(tokens, class)`` of the pieces a document of ``length`` tokens is cut into.

    Whole sequences first. A rest of ``r`` tokens goes uncut into class ``capacity // r`` if such a sequence
    is then full but for ``slack``; otherwise the largest reciprocal ``capacity // i`` in it is cut off. The
    rest shrinks with the square of ``i``, so a document has few pieces, and there are about 2 / slack classes.
    """
    out = [(capacity, 1)] * (length // capacity)
    rest = length % capacity
    while rest:
        i = capacity // rest
        if capacity - i * rest <= slack * capacity or rest <= slack * capacity:
            out.append((rest, i))
            break
        i = -(-capacity // rest)
        out.append((capacity // i, i))
        rest -= capacity // i
    return out


OUT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
PIECE_COLUMNS = [*OUT[:5], "class"]
#: Steps are numbered in four bits of a sequence's id; the last number is that of the final fit.
LAST_STEP = 15
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class int"


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise and cut: one row per piece, with its class. No shuffle."""
    path = path or public_tokenizers.path(VOCABULARY)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(path)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), words.encode(texts_of(batch)), strict=True):
                ids = memoryview(ids + END.to_bytes(4, "little"))
                total, start = len(ids) // 4, 0
                for length, kind in cuts(total, capacity):
                    rows.append((doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), total, kind))
                    start += length
            kinds = [pa.int64()] * 5 + [pa.int32()]
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], PIECE_COLUMNS)

        words.forget()

    return map_texts(docs, ["doc_id", "text"], PIECES, each)


def _sequence_id(step: int, kind, share, number):
    """Ids that no two (step, class, share, number) have in common: 4, 13, 22 and 24 bits."""
    return F.lit(step << 59) + F.shiftleft(kind.cast("long"), 46) + F.shiftleft(share.cast("long"), 24) + number.cast("long")


def _filled(cut: DataFrame, shares: int, step: int) -> DataFrame:
    """Pieces with the sequence their rank in their class and share gives, and whether that one is full."""
    own = Window.partitionBy("class", "share")
    ranked = cut.withColumn("share", F.pmod(F.xxhash64("doc_id", "start", F.lit(step)), F.lit(shares))).withColumns(
        {"rank": F.row_number().over(own.orderBy("doc_id", "start", "ids_crc32", "length")) - 1, "many": F.count(F.lit(1)).over(own)}
    )
    number = F.floor(F.col("rank") / F.col("class"))
    before = own.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranked.withColumns({"number": number, "full": (number + 1) * F.col("class") <= F.col("many"), "ahead": F.coalesce(F.sum("length").over(before), F.lit(0))})
    return placed.withColumns(
        {
            "sequence_id": _sequence_id(step, F.col("class"), F.col("share"), F.col("number")),
            "offset": F.col("ahead") - F.min("ahead").over(Window.partitionBy("class", "share", "number")),
        }
    ).drop("share", "rank", "many", "number", "ahead")


def _last_fit(rest: pd.DataFrame, base: int, capacity: int) -> pd.DataFrame:
    """Sequences for the pieces no class could fill: longest first into the fullest sequence that still takes it."""
    rest = rest.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
    used: list[int] = []
    places: list[tuple[int, int]] = []
    by_room: dict[int, list[int]] = {}  # sequences by the tokens they still take
    rooms: list[int] = []  # the keys of by_room, ascending
    for length in rest["length"].tolist():
        at = bisect_left(rooms, length)
        if at < len(rooms):
            room = rooms[at]
            k = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
        else:
            room, k = capacity, len(used)
            used.append(0)
        places.append((base + k, used[k]))
        used[k] += length
        if left := room - length:
            if left not in by_room:
                insort(rooms, left)
                by_room[left] = []
            by_room[left].append(k)
    rest["sequence_id"], rest["offset"] = zip(*places, strict=True) if places else ((), ())
    return rest[OUT]


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pack all documents: one row per piece with its sequence and its offset there.

    Needs ``doc_id`` and ``text``; other columns are not read. A null or empty text is the end id alone, a null
    id stays null, repeated rows are packed each, an empty table gives no rows.

    Texts are tokenised once and never shuffled; only the pieces' numbers are. Each class is ranked in shares
    of about ``SHARE`` pieces. Pieces that do not fill a sequence of their share (fewer than the class's
    number in each) are ranked again over fewer shares, until one share is left. What then remains is less than
    one sequence per class, at most some 20,000 pieces however large the input; they are fitted together at last.
    """
    cut = written(pieces(docs, path, capacity))
    total, parts = cut.count(), []
    for step in range(LAST_STEP):
        shares = -(-total // SHARE) or 1
        placed = _filled(cut, shares, step)
        if shares > 1:
            placed = written(placed)
        parts.append(placed.filter("full").select(*[F.col(c).cast("long") for c in OUT]))
        rest = placed.filter(~F.col("full")).select(*PIECE_COLUMNS)
        if shares == 1:
            break
        cut = rest
        total = min(cut.count(), total // 2)  # at most half the shares each time, so this ends
    last = rest.groupBy(F.lit(0).alias("all")).applyInPandas(
        lambda group: _last_fit(group, LAST_STEP << 59, capacity), ", ".join(f"{c} long" for c in OUT)
    )
    return reduce(DataFrame.unionByName, parts, last)

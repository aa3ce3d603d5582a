"""Packing by minimum bin slack.

Each task packs its own part of the input, in blocks of bounded tokens, and needs no shuffle. A document is its ids and
the end id. Whole windows are cut off documents that are longer than one. The rest is a multiset of lengths: each
sequence starts with the longest piece, and a subset-sum dynamic programme over bitsets (one Python integer, bit s for
"s tokens can be filled", shifted for binary portions of each length's count) finds the multiset of remaining lengths
that comes closest to the capacity; backtracking through the stages gives the count of each length. A slack that is left
is closed by cutting the shortest piece that is longer. What remains when a task ends is cut into powers of two, which
need no padding.

Equal words get equal ids wherever they stand in this tokenizer, so a worker keeps the ids of words it has seen (a
bounded table) and sends only new words, in batches, to the tokenizers library. Texts with anything outside plain
Latin-1 print, or with "<|", go to the library whole, so that its normaliser, its pattern and its special strings apply.

Defined results: null and empty texts are just the end id; repeated rows are documents of their own; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import array
import heapq
import os
import re
import sys
from collections import defaultdict
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import bounded_batches, pick, slices, table

TOKENIZER, END, CAPACITY = "word_bpe_49k.json", 2, 4096
#: Tokens of a packing block; words a worker keeps.
BLOCK, KEPT_WORDS = 2_000_000, 300_000

_PLAIN = bytes([9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x100)]).replace(b"\xad", b"")
#: The tokenizer's split pattern, with its classes written out for Latin-1.
_WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\\s0-9a-zªµºß-öø-ÿ²³¹¼½¾]+")
#: Byte-level vocabularies show printable Latin-1 bytes as themselves and the others, in turn, from 256 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SHOWN = {b: chr(b) for b in _PRINTED} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*_PRINTED}))}
_encoders: dict[str, Encoder] = {}


class Encoder:
    """Ids of texts, as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallel unit; its threads only wait
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.by_words = path.endswith("word_bpe_49k.json")  # what _WORD and the plain way hold for
        self.model = self.library.model
        self.known: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [_bytes(x.ids) for x in self.library.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _word(self, word: str) -> bytes:
        """A word's ids by the library's model, which takes its bytes in their printable form."""
        shown = word if word.isascii() else "".join(map(_SHOWN.__getitem__, word.encode()))
        return _bytes([t.id for t in self.model.tokenize(shown)])

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        odd, words = [], {}
        for i, text in enumerate(texts):
            lower = self.plain(text) if self.by_words else None
            if lower is None:
                odd.append(i)
            else:
                words[i] = _WORD.findall(lower)
        for i, ids in zip(odd, self._whole([texts[i] for i in odd]), strict=True):
            out[i] = ids
        known = self.known
        new = list(set().union(*words.values()).difference(known)) if words else []
        extra = dict(zip(new, map(self._word, new), strict=True))
        if len(known) + len(extra) <= KEPT_WORDS:
            known.update(extra)
            get = known.__getitem__
        else:
            get = lambda w: known.get(w) or extra[w]
        for i, own in words.items():
            out[i] = b"".join(map(get, own))
        return out

    @staticmethod
    def plain(text: str) -> str | None:
        """The lower-cased text if words can be told apart here, else None."""
        if "<|" in text:
            return None
        try:
            if text.encode("latin-1").translate(None, _PLAIN):
                return None
        except UnicodeEncodeError:
            return None
        return text.lower()


def _bytes(ids: list[int]) -> bytes:
    out = array.array("I", ids)
    if sys.byteorder != "little":
        out.byteswap()
    return out.tobytes()


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of the given lengths (with counts) whose sum is closest to room from below."""
    fits = (1 << (room + 1)) - 1
    reach, stages = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, portion = min(counts[length], room // length), 1
        while left:
            take = min(portion, left)
            stages.append((length, take, reach))
            reach |= (reach << (length * take)) & fits
            left, portion = left - take, portion * 2
        if reach >> room:
            break
    total = reach.bit_length() - 1
    used: dict[int, int] = defaultdict(int)
    for length, take, before in reversed(stages):
        if not before >> total & 1:
            used[length] += take
            total -= length * take
    return used


class Packer:
    """Packs pieces (document number, start, length) into sequences."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.pool: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.lengths: list[int] = []  # a heap of -length
        self.held = 0

    def put(self, doc: int, start: int, length: int) -> None:
        if length:
            if not self.pool[length]:
                heapq.heappush(self.lengths, -length)
            self.pool[length].append((doc, start))
            self.held += length

    def _take(self, length: int) -> tuple[int, int, int]:
        doc, start = self.pool[length].pop()
        if not self.pool[length]:
            del self.pool[length]
        self.held -= length
        return doc, start, length

    def _longest(self) -> int:
        while -self.lengths[0] not in self.pool:
            heapq.heappop(self.lengths)
        return -self.lengths[0]

    def sequence(self, capacity: int | None = None) -> list[tuple[int, int, int]]:
        """One full sequence; the pool must hold enough."""
        room = capacity or self.capacity
        out = []
        longest = self._longest()
        if longest <= room:
            out.append(self._take(longest))
            room -= longest
        for length, count in best_fill({k: len(v) for k, v in self.pool.items()}, room).items():
            for _ in range(count):
                out.append(self._take(length))
                room -= length
        if room:  # no piece left fits: all are longer than the slack
            doc, start, length = self._take(min(self.pool))
            out.append((doc, start, room))
            self.put(doc, start + room, length - room)
        return out

    def full(self) -> Iterator[list[tuple[int, int, int]]]:
        while self.held >= self.capacity:
            yield self.sequence()

    def rest(self) -> Iterator[list[tuple[int, int, int]]]:
        """What is left, in sequences whose lengths are powers of two."""
        yield from self.full()
        while self.held:
            yield self.sequence(1 << (self.held.bit_length() - 1))


def pack(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """documents (doc_id, text): a row per piece: doc_id, start, length, ids (binary), doc_tokens, sequence_id, offset."""
    bounded_batches(documents.sparkSession)
    docs = pick(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kinds = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _encoders:
            _encoders[tokenizer] = Encoder(tokenizer)
        encoder, packer = _encoders[tokenizer], Packer(capacity)
        number = TaskContext.get().partitionId() << 36
        docs: dict[int, list] = {}  # number in this task: doc_id, ids, tokens still to be packed
        last, new = _bytes([end]), 0
        done: list[tuple] = []

        def place(pieces: list[tuple[int, int, int]]) -> None:
            nonlocal number
            offset = 0
            for doc, start, length in pieces:
                own = docs[doc]
                done.append((own[0], start, length, own[1][4 * start : 4 * (start + length)], len(own[1]) // 4, number, offset))
                offset += length
                own[2] -= length
                if not own[2]:
                    del docs[doc]
            number += 1

        def emitted() -> Iterator[pa.RecordBatch]:
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], k) for i, (_, k) in enumerate(kinds)], names=[n for n, _ in kinds])
                done.clear()

        for batch in batches:
            for part in slices(batch):
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist()), strict=True):
                    ids += last
                    n = len(ids) // 4
                    docs[new] = [doc_id, ids, n]
                    whole = n - n % capacity
                    for start in range(0, whole, capacity):
                        place([(new, start, capacity)])
                    packer.put(new, whole, n - whole)
                    new += 1
                if packer.held > BLOCK:
                    for pieces in packer.full():
                        place(pieces)
                yield from emitted()
        for pieces in packer.rest():
            place(pieces)
        yield from emitted()

    return docs.mapInArrow(packed, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def op2_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return done.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

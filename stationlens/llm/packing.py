"""Packing (5): vector bin packing of token sequences by the dot-product heuristic.

An item is a document (or a conversation) with three needs: tokens, one segment,
and loss-bearing tokens. A sequence has a limit on each. Among the items that
wait, the one whose needs have the largest dot product with what is left in the
open sequence goes in next; when none goes in whole, the one with the largest
product is cut at what is left. What remains at the end of a task is cut into
lengths that are powers of two, which need no padding.

Each task packs its own rows, so there is no exchange; a task holds at most
``POOL`` waiting items. ``sequence_id`` is the task's number times 2**40 plus a
count, so it is unique, and the same when a lost task is run again on the same rows.

Null and empty texts are documents of the end id alone. Rows that repeat a doc_id
are packed each on its own. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import shared

CAPACITY = 4096
MAX_SEGMENTS = 512
POOL = 256
TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: Where a text may be cut without changing its ids: this tokenizer drops white space.
SPACES = re.compile(r"[ \t\n\v\f\r]+")
#: A character that is a word, and an id, of its own.
MARK = "\x02"
#: Plain text: Latin letters, digits, signs and spaces, for which lower-casing and splitting agree with the tokenizer's.
_PLAIN = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\u012f\u0131-\u0148\u014a-\u024f]")
_LATIN = bytes([0x09, 0x0A, 0x0D, *range(0x20, 0x7F), *range(0xA1, 0x100)])


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class WordTokenizer:
    """Ids of whole texts, as little-endian 32-bit bytes, with a bounded memory of words.

    The tokenizer lower-cases and never joins characters across white space, so a
    text's ids are its words' ids in a row; words seen before are looked up.
    """

    def __init__(self, path: str, most: int = 1_200_000, longest: int = 48):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most, self.longest = most, longest
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # words not met since there were half of ``most`` others
        (self.mark,) = self.tokenizer.encode(MARK, add_special_tokens=False).ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        lists = [_words(t) if t else [] for t in texts]
        known, older, missing = self.known, self.older, []
        for word in set(chain.from_iterable(lists)).difference(known):
            if (code := older.get(word)) is None:
                missing.append(word)
            else:
                known[word] = code
        self._learn(missing)
        out = [b"".join(map(known.__getitem__, words)) for words in lists]
        for word in missing:
            if len(word) > self.longest:
                del known[word]
        if len(known) > self.most // 2:
            self.known, self.older = {}, known
        return out


    def _learn(self, words: list[str]) -> None:
        """Encode many words at a time, with a mark between them that none of them holds."""
        alone = [w for w in words if MARK in w or "<|" in w]
        for word in alone:
            self.known[word] = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if alone:
            words = [w for w in words if w not in self.known]
        between = f" {MARK} "
        parts = [words[at : at + 256] for at in range(0, len(words), 256)]
        for part, code in zip(parts, self.tokenizer.encode_batch_fast([between.join(p) + between for p in parts], add_special_tokens=False)):
            ids = np.array(code.ids, dtype="<u4")
            ends = (np.flatnonzero(ids == self.mark) * 4).tolist()
            code = ids.tobytes()
            begin = 0
            for word, end in zip(part, ends):
                self.known[word] = code[begin:end]
                begin = end + 4


def _words(text: str) -> list[str]:
    """Pieces between white space; in lower case where one letter's never depends on others or is several."""
    if "<|" not in text and _is_plain(text):
        return text.lower().split()
    return [w for w in SPACES.split(text) if w]


def _is_plain(text: str) -> bool:
    try:
        return not text.encode("latin-1").translate(None, _LATIN)
    except UnicodeEncodeError:
        return _PLAIN.search(text) is None


def tokenizer_at(path: str) -> WordTokenizer:
    """One for each Python worker, so that its tasks share what is known."""
    return shared.kept(f"packing {path}", lambda: WordTokenizer(path))


class Packer:
    """Open sequence and waiting items of one task."""

    def __init__(self, first_id: int, limits: tuple[int, int, int]):
        self.limits = np.array(limits, dtype=np.float64)
        self.sequence = first_id
        self.items: list[tuple] = []  # (key, codes, loss, at)
        self.needs = np.zeros((0, 3))
        self.left = self.limits.copy()
        self.open: list[tuple] = []

    def add(self, items: list[tuple]) -> None:
        self.items += items
        new = np.array([[len(c) // 4 - at, 1, float(loss[at:].sum()) if loss is not None else len(c) // 4 - at] for _, c, loss, at in items]).reshape(-1, 3)
        self.needs = np.concatenate([self.needs, new])

    def _close(self) -> Iterator[tuple]:
        offset = 0
        for key, codes, _, at, length in self.open:
            yield key, at, length, zlib.crc32(codes[4 * at : 4 * (at + length)]), len(codes) // 4, self.sequence, offset
            offset += length
        if self.open:
            self.sequence += 1
        self.open, self.left = [], self.limits.copy()

    def _take(self, k: int, length: int) -> None:
        key, codes, loss, at = self.items[k]
        bearing = length if loss is None else float(loss[at : at + length].sum())
        self.open.append((key, codes, loss, at, length))
        self.left -= (length, 1, bearing)
        if at + length == len(codes) // 4:
            self.items[k] = self.items[-1]
            self.needs[k] = self.needs[-1]
            self.items.pop()
            self.needs = self.needs[:-1]
        else:
            self.items[k] = (key, codes, loss, at + length)
            self.needs[k] -= (length, 0, bearing)

    def _fits(self, k: int) -> int:
        """How many tokens of item k go in."""
        _, codes, loss, at = self.items[k]
        length = int(min(self.left[0], len(codes) // 4 - at))
        if loss is not None:
            length = int(np.searchsorted(np.cumsum(loss[at : at + length]), self.left[2], side="right"))
        return min(length, int(self.left[2])) if loss is None else length

    def pack(self, keep: int) -> Iterator[tuple]:
        """Close sequences while more than ``keep`` items wait."""
        while len(self.items) > keep:
            if min(self.left[0], self.left[1], self.left[2]) < 1:
                yield from self._close()
            score = (self.needs / self.limits) @ (self.left / self.limits)
            whole = (self.needs <= self.left).all(axis=1)
            if whole.any():
                k = int(np.argmax(np.where(whole, score, -1)))
                self._take(k, int(self.needs[k, 0]))
            else:
                k = int(np.argmax(score))
                if length := self._fits(k):
                    self._take(k, length)
                else:
                    yield from self._close()

    def finish(self) -> Iterator[tuple]:
        yield from self.pack(0)
        rest, self.open = self.open, []
        total = sum(x[4] for x in rest)
        rest.reverse()
        while total:
            room = 1 << (total.bit_length() - 1)
            total -= room
            while room:
                key, codes, loss, at, length = rest.pop()
                take = min(room, length)
                self.open.append((key, codes, loss, at, take))
                room -= take
                if take < length:
                    rest.append((key, codes, loss, at + take, length - take))
            yield from self._close()


def _rows(pieces: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for piece in pieces:
        held.append(piece)
        if len(held) >= 8192:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _arrow(key_type: pa.DataType) -> pa.Schema:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.schema([pa.field(names[0], key_type), *(pa.field(n, pa.int64()) for n in names[1:])])


def pack_documents(
    df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY, max_segments: int = MAX_SEGMENTS, max_loss: int | None = None
) -> DataFrame:
    """Pieces of every document's ids, with every token loss-bearing.

    ``tokenizer`` is the path of a tokenizer file that drops white space.
    """
    limits = (capacity, max_segments, max_loss or capacity)
    schema = _arrow(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext

        path = tokenizer
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        words = tokenizer_at(path)
        packer = Packer(TaskContext.get().partitionId() << 40, limits)
        end = np.array([end_id], dtype="<u4").tobytes()

        def pieces() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    codes = words.encode(part.column(1).to_pylist())
                    packer.add([(k, c + end, None, 0) for k, c in zip(part.column(0).to_pylist(), codes)])
                    yield from packer.pack(POOL)
            yield from packer.finish()

        yield from _rows(pieces(), schema)

    return df.selectExpr(f"cast(`{key}` as long) as doc_id", f"`{text}` as text").mapInArrow(run, SCHEMA)


def pack_conversations(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: tuple[str, ...] = ("assistant",), tokenizer: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY, max_segments: int = 64, max_loss: int = CAPACITY // 2
) -> DataFrame:
    """Instruction data: a conversation is one item; only tokens of ``trained`` roles bear loss.

    Turns are gathered by conversation, which is bounded by the longest conversation;
    each turn ends with ``end_id``, which bears loss as its turn does.
    """
    from pyspark.sql import functions as F

    limits = (capacity, max_segments, max_loss)
    schema = _arrow(pa.int64())
    turns = df.select(F.col(conversation).cast("long").alias("doc_id"), F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    gathered = turns.groupBy("doc_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext

        path = tokenizer
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        words = tokenizer_at(path)
        packer = Packer(TaskContext.get().partitionId() << 40, limits)
        end = np.array([end_id], dtype="<u4").tobytes()

        def item(key, said) -> tuple:
            codes = [c + end for c in words.encode([t["text"] for t in said])]
            loss = np.concatenate([np.full(len(c) // 4, t["role"] in trained) for c, t in zip(codes, said)])
            return key, b"".join(codes), loss.astype(np.int64), 0

        def pieces() -> Iterator[tuple]:
            for batch in batches:
                for key, said in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    packer.add([item(key, said)])
                    yield from packer.pack(POOL)
            yield from packer.finish()

        yield from _rows(pieces(), schema)

    return gathered.mapInArrow(run, SCHEMA)

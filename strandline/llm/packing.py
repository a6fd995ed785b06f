"""Packing of tokenised documents into training windows by sum of squares, online.

A document is its ids and an end id.  What fills whole windows goes out at once, cut from
the front; the rest is placed into the window level that keeps the sum of squares of the
counts of partially filled windows smallest.  A level array holds those counts: entry h is
the number of open windows with h ids.  Moving a window from level h to h + s changes the
sum by 2 N[h + s] + 1 (not for a full window) and by 1 - 2 N[h] (not for a new window);
of equal changes the fullest level wins, of equal windows the one opened last.

At the end of a partition the windows still open are closed without padding: a level that
is a power of two stays as it is, the others are joined and cut into whole windows, what
is left into powers of two (at most one sequence of each).  The same joining bounds the
memory of a task: past ``max_open`` open windows (documents of one length that fit nothing
else) they are joined and cut, and the last partial window stays open.

Every task packs the documents of its own partition, so nothing is shuffled, no window
spans two partitions, and a lost executor's partitions are packed again.  Sequence ids
hold the partition number in their upper bits.  The rows of a partition must come in the
same order when a task is run again: pass a table, not the result of a shuffle.

Defined results: null and empty texts are the end id alone; repeated rows and repeated or
null ids are documents of their own; a document of any length is tokenised whole; an empty
table has no pieces; other columns of the caller stay out.  Special tokens written in a
text are ordinary text."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandline.llm.common import broadcast_bytes, docs_of, per_row

WINDOW = 2048
END_ID = 1
#: Open windows of a task, at most (8 KB of ids each).
MAX_OPEN = 4096
MAX_TOKENIZER_BYTES = 32 << 20
#: Cached chunks per generation and worker; two generations are held.
CACHE_ENTRIES = 400_000

_ID_BYTES = 4
# str.split also cuts at the four separators from \x1c, which are no white space here.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_SOLID = re.compile("[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
# Beyond Latin Extended-A, or a letter whose lower case is two characters.
_WIDE = re.compile("[^\x00-\u012f\u0131-\u017f]")
# A sign before a stop or comma, with which it makes one word.
_SIGNS = re.compile(r"[.,][ \n](?:(?<=[^\w\s][.,][ \n])|(?<=_[.,][ \n]))")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, the
    other bytes, in order, for the characters from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in own)
    return {b: chr(0x100 + k) for k, b in enumerate(others)}


class ChunkEncoder:
    """Ids of texts, packed as little-endian unsigned 32-bit integers, chunk by chunk.

    For a tokenizer that composes (NFC), lower-cases and drops white space, and whose words
    never hold any, the ids of a text are those of its chunks between white space, one after
    another.  Texts within Latin Extended-A are composed already and are lower-cased whole,
    with stops and commas after words split off; a chunk of letters only is then one word,
    which the tokenizer's merges take as it is.  All other chunks go through the whole
    tokenizer.  Chunks are kept in a cache of two generations, so that frequent ones stay."""

    def __init__(self, spec: bytes) -> None:
        self.tokenizer = Tokenizer.from_buffer(spec)
        self.tokenizer.encode_special_tokens = True
        self.merges = self.tokenizer.model
        self.letters = _byte_letters()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        if any(c in text for c in _SEPARATORS):
            chunks, narrow = _SOLID.findall(text), False
        else:
            narrow = text.isascii() or not _WIDE.search(text)
            if narrow:
                text = text.lower()
                if not _SIGNS.search(text):
                    text = text.replace(", ", " , ").replace(". ", " . ").replace(".\n", " .\n")
            chunks = text.split()
        out = list(map(self.young.get, chunks))
        if None in out:
            for i, got in enumerate(out):
                if got is None:
                    got = self.young.get(chunks[i])
                    out[i] = self._miss(chunks[i], narrow) if got is None else got
        return b"".join(out)

    def _miss(self, chunk: str, narrow: bool) -> bytes:
        got = self.old.get(chunk)
        if got is None:
            if narrow and chunk.isalpha():
                word = chunk if chunk.isascii() else chunk.encode().decode("latin-1").translate(self.letters)
                ids = [t.id for t in self.merges.tokenize(word)]
            else:
                ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
            got = struct.pack(f"<{len(ids)}I", *ids)
        if len(chunk) <= 256:
            if len(self.young) >= CACHE_ENTRIES:
                self.old, self.young = self.young, {}
            self.young[chunk] = got
        return got


@lru_cache(1)
def _encoder(spec: bytes) -> ChunkEncoder:
    """The worker's encoder; its cache serves the worker's later tasks too."""
    return ChunkEncoder(spec)


@dataclass(slots=True)
class Piece:
    """A cut of a document: packed ids from its id number ``start`` on."""

    doc: object
    start: int
    ids: bytes
    total: int

    def __len__(self) -> int:
        return len(self.ids) // _ID_BYTES

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc, self.start, self.ids[:n * _ID_BYTES], self.total),
                Piece(self.doc, self.start + n, self.ids[n * _ID_BYTES:], self.total))


@dataclass
class Packer:
    """The level array and the open windows behind it.  ``add`` and ``close`` return the
    windows that are finished, each a list of pieces."""

    window: int = WINDOW
    max_open: int = MAX_OPEN
    counts: np.ndarray = field(init=False)
    waiting: dict[int, list[list[Piece]]] = field(default_factory=dict)
    n_open: int = 0

    def __post_init__(self) -> None:
        if self.window < 1 or self.max_open < 1:
            raise ValueError("window and max_open are at least 1")
        self.counts = np.zeros(self.window + 1, np.int64)

    def level(self, size: int) -> int:
        """The level (0: a new window) whose use keeps the sum of squares smallest."""
        here, there = self.counts[:self.window + 1 - size], self.counts[size:]
        change = 2 * there + 1
        change[-1] = 0                      # a full window is not partially filled
        change[1:] += 1 - 2 * here[1:]
        fits = here > 0
        fits[0] = True
        change[~fits] = np.iinfo(np.int64).max
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        while len(piece) >= self.window:
            whole, piece = piece.cut(self.window)
            yield [whole]
        if len(piece):
            h = self.level(len(piece))
            held = self._take(h) if h else []
            held.append(piece)
            if h + len(piece) == self.window:
                yield held
            else:
                self._put(h + len(piece), held)
                if self.n_open > self.max_open:
                    yield from self._join([p for w in self._all() for p in w], last=False)

    def close(self) -> Iterator[list[Piece]]:
        """All windows that are still open, without padding."""
        rest: list[Piece] = []
        for held in self._all():
            if _power(sum(map(len, held))):
                yield held
            else:
                rest += held
        yield from self._join(rest, last=True)

    def _join(self, pieces: list[Piece], last: bool) -> Iterator[list[Piece]]:
        n = sum(map(len, pieces))
        sizes, rest = [self.window] * (n // self.window), n % self.window
        if last:
            sizes += [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
        elif rest:
            sizes.append(rest)
        todo = iter(pieces)
        piece = next(todo, None)
        for size in sizes:
            held: list[Piece] = []
            while size:
                head, tail = piece.cut(min(size, len(piece)))
                held.append(head)
                size -= len(head)
                piece = tail if len(tail) else next(todo, None)
            if not last and sum(map(len, held)) < self.window:
                self._put(rest, held)
            else:
                yield held

    def _all(self) -> list[list[Piece]]:
        """The open windows, fullest first; none is open afterwards."""
        out = [w for h in sorted(self.waiting, reverse=True) for w in self.waiting[h]]
        self.waiting, self.n_open = {}, 0
        self.counts[:] = 0
        return out

    def _put(self, h: int, held: list[Piece]) -> None:
        self.waiting.setdefault(h, []).append(held)
        self.counts[h] += 1
        self.n_open += 1

    def _take(self, h: int) -> list[Piece]:
        self.counts[h] -= 1
        self.n_open -= 1
        held = self.waiting[h].pop()
        if not self.waiting[h]:
            del self.waiting[h]
        return held


def _power(n: int) -> bool:
    return n > 0 and n & (n - 1) == 0


def tokenizer(spark: SparkSession, path: str):
    """The tokenizer file at ``path`` (a path of the driver), broadcast."""
    with open(path, "rb") as f:
        spec = f.read()
    return broadcast_bytes(spark, path, spec, len(spec), MAX_TOKENIZER_BYTES)


def pack(docs: DataFrame, spec, window: int = WINDOW, end_id: int = END_ID, max_open: int = MAX_OPEN,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per piece: id, start (the document's ids before it), length, doc_tokens,
    sequence_id, offset (in the sequence) and ids (little-endian unsigned 32-bit)."""
    schema = pa.schema([("id", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                        ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        encode, packer = _encoder(spec.value), Packer(window, max_open)
        end = np.array([end_id], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 40

        def out(windows: Iterator[list[Piece]]) -> Iterator[tuple]:
            nonlocal sequence
            for held in windows:
                offset = 0
                for p in held:
                    yield p.doc, p.start, len(p), p.total, sequence, offset, p.ids
                    offset += len(p)
                sequence += 1

        for key, text in rows:
            ids = encode(text.decode("utf-8", "replace"))
            yield from out(packer.add(Piece(key, 0, ids + end, len(ids) // _ID_BYTES + 1)))
        yield from out(packer.close())

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs_of(docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("body")), "id", text="body")
    done = src.mapInArrow(per_row(run, schema, 512), "id string, start long, length long, doc_tokens long, "
                          "sequence_id long, offset long, ids binary")
    return done.select(F.col("id").cast(kind).alias(id_col), "start", "length", "doc_tokens", "sequence_id", "offset", "ids")


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, padding, ids): the packed sequences, padded to ``window``
    unless their length is a power of two.  A sequence is at most a window of ids."""
    put = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(put, F.lit(b"").cast("binary"), lambda got, p: F.concat(got, p["ids"]))
    n = F.col("n_tokens")
    short = F.when(n.bitwiseAND(n - 1) == 0, 0).otherwise(window - n)
    pad = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), short.cast("int")))
    return (pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
            .select("sequence_id", "n_tokens", short.cast("long").alias("padding"), F.concat("ids", pad).alias("ids")))

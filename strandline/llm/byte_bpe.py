"""Byte-level BPE with an existing rank table: encoding and decoding whole texts.

A text is cut by the tokenizer's pattern; each piece starts as its single bytes, and the
adjacent pair whose joined bytes have the lowest rank is merged until no pair has a rank.
The folds run once per distinct piece that a task holds in its bounded cache, on a rank
map that is broadcast as a literal table (its size is checked).  Decoding looks every id
up in the table of binary pieces and concatenates them.

Defined results: a null or empty text has no ids, decodes to no bytes and gives the
digests of the empty string; repeated rows are encoded once each; columns of the caller
other than the id stay out.  A text of any length is encoded whole: pieces over
``SHORT_PIECE`` bytes use a heap of candidate merges, so a piece of n bytes costs
O(n log n)."""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import struct
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from strandline.llm.common import broadcast_bytes, docs_of, per_row

#: A rank table on the wire may take this much; public vocabularies stay under 4 MB.
MAX_VOCABULARY_BYTES = 32 << 20
SHORT_PIECE = 48
#: Cached pieces per generation and task; two generations are held.
CACHE_ENTRIES = 400_000

# White space as Unicode's White_Space property lists it (fixed values).
_WS = "\t-\r \x85\xa0  -     　"
# A run of white space with the run of other characters after it.  No match of the
# tokenizer pattern reaches from other characters into white space, so the matches
# within such a chunk do not depend on what stands around it.
CHUNK = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def fold_merges(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The byte strings that ``piece`` ends as after all ranked merges."""
    if piece in ranks:
        return [piece]
    if len(piece) > SHORT_PIECE:
        return _fold_long(piece, ranks)
    get = ranks.get
    parts = [piece[i:i + 1] for i in range(len(piece))]
    none = len(ranks) + 1
    pair = [get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
    while pair:
        low = min(pair)
        if low >= none:
            break
        i = pair.index(low)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pair[i]
        if i:
            pair[i - 1] = get(parts[i - 1] + parts[i], none)
        if i < len(pair):
            pair[i] = get(parts[i] + parts[i + 1], none)
    return parts


def _fold_long(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The same fold with a heap: (rank, start, length) of mergeable pairs; an entry
    whose span has changed since it was pushed is stale and skipped."""
    n = len(piece)
    end = list(range(1, n + 1))          # end[i]: end of the part that starts at i
    begin = list(range(n))               # begin[e - 1]: start of the part that ends at e
    alive = bytearray(b"\1" * n)
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        if end[i] < n:
            j = end[end[i]]
            r = ranks.get(piece[i:j])
            if r is not None:
                heapq.heappush(heap, (r, i, j))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, j = heapq.heappop(heap)
        if not alive[i] or end[i] >= j or end[end[i]] != j:
            continue
        alive[end[i]] = 0
        end[i] = j
        begin[j - 1] = i
        offer(i)
        if i:
            offer(begin[i - 1])
    return [piece[i:end[i]] for i in range(n) if alive[i]]


class _Encoder:
    """Texts to packed ids, with a cache of two generations so that frequent chunks stay."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.cut = ranks, regex.compile(pattern)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        chunks = CHUNK.findall(text)
        out = list(map(self.young.get, chunks))
        if None in out:
            for i, got in enumerate(out):
                if got is None:
                    got = self.young.get(chunks[i])
                    out[i] = self._miss(chunks[i]) if got is None else got
        return b"".join(out)

    def _miss(self, chunk: str) -> bytes:
        got = self.old.get(chunk)
        if got is None:
            ids = [self.ranks[p] for m in self.cut.finditer(chunk) for p in fold_merges(m[0].encode(), self.ranks)]
            got = struct.pack(f"<{len(ids)}I", *ids)
        if len(chunk) <= 256:
            if len(self.young) >= CACHE_ENTRIES:
                self.old, self.young = self.young, {}
            self.young[chunk] = got
        return got


def _encoder(table, pattern: str) -> _Encoder:
    return _Encoder(table.value, pattern)


def _pieces(ranks: dict[bytes, int]) -> list[bytes]:
    out = [b""] * (max(ranks.values()) + 1)
    for p, i in ranks.items():
        out[i] = p
    return out


def ids_of(packed: bytes) -> array:
    ids = array("I")
    ids.frombytes(packed)
    if struct.pack("=I", 1) != struct.pack("<I", 1):
        ids.byteswap()
    return ids


def rank_table(spark: SparkSession, path: str):
    """The rank map of the file at ``path`` (a path of the driver), broadcast."""
    ranks = read_ranks(path)
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"{path}: no rank for the single bytes {missing[:8]}")
    return broadcast_bytes(spark, path, ranks, sum(map(len, ranks)) + 64 * len(ranks), MAX_VOCABULARY_BYTES)


def _mapped(df: DataFrame, fn: Callable, schema: pa.Schema, ddl: str) -> DataFrame:
    return df.mapInArrow(per_row(fn, schema, 512), ddl)


def encode(docs: DataFrame, ranks, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the ids as little-endian unsigned 32-bit integers, one after another."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        enc = _encoder(ranks, pattern)
        for key, text in rows:
            yield key, enc(text.decode("utf-8", "replace"))

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs_of(docs, id_col, text=text_col).withColumnsRenamed({id_col: "id"})
    return _mapped(src.selectExpr("cast(id as string) id", "text"), run, pa.schema([("id", pa.string()), ("ids", pa.binary())]),
                   "id string, ids binary").selectExpr(f"cast(id as {kind}) as `{id_col}`", "ids")


def decode(encoded: DataFrame, ranks, id_col: str = "doc_id") -> DataFrame:
    """(id, data): the bytes that the packed ids stand for."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        piece = _pieces(ranks.value).__getitem__
        for key, packed in rows:
            yield key, b"".join(map(piece, ids_of(packed or b"")))

    kind = encoded.schema[id_col].dataType.simpleString()
    src = encoded.selectExpr(f"cast(`{id_col}` as string) id", "ids")
    return _mapped(src, run, pa.schema([("id", pa.string()), ("data", pa.binary())]),
                   "id string, data binary").selectExpr(f"cast(id as {kind}) as `{id_col}`", "data")


def round_trip(docs: DataFrame, ranks, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """Encode and decode in one pass and return the digests of both: the ids never leave
    the task, so nothing but a row of digests per document is moved."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        enc, piece = _encoder(ranks, pattern), _pieces(ranks.value).__getitem__
        for key, text in rows:
            packed = enc(text.decode("utf-8", "replace"))
            data = b"".join(map(piece, ids_of(packed)))
            yield key, len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(data).hexdigest(), data == text

    src = docs_of(docs, id_col).selectExpr(f"cast(`{id_col}` as bigint) id", "text")
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string()), ("exact", pa.bool_())])
    return _mapped(src, run, schema, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, exact boolean")

"""Operator 8, byte-level BPE: exact encoding in linear time, and decoding.

A piece's bytes are read as Latin-1 characters so that pyahocorasick, which
works on strings, finds every vocabulary entry in them. From the left, the
longest entry is tried that may follow the token before it; where none fits,
the last token is taken back and a shorter one tried. A prefix has one valid
encoding only, so a position that failed once has failed for good and no
position is left twice: the time is linear in the piece's length.

Two tokens may be adjacent if merging their joined bytes never joins across
the border. That is decided from the merge history along the border and kept
in a table, as are whole pieces, which repeat.
"""

from __future__ import annotations

import base64
import struct
from functools import cached_property, lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from parcelmart.llm.chunks import ChunkTable
from parcelmart.llm.common import text_bytes

#: Entries kept in a worker's tables before they are emptied; bounds its memory.
MEMO_PIECES = 200_000
MEMO_PAIRS = 500_000
#: Chunks in each of a worker's two tables. Spark uses workers again for the steps after, with their tables: an executor
#: may have several a core, so these are a third of what operator 9 keeps.
MEMO_CHUNKS = 200_000
#: Longer pieces are encoded each time instead of being kept.
MEMO_BYTES = 64
NEVER = 1 << 62


class Memo(dict):
    """A table that computes missing entries; it starts anew when ``limit`` is reached."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= MEMO_BYTES:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


class BytePairCodec:
    """A rank file's vocabulary: ``bytes -> rank``, the rank being both id and merge order."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.borders: dict[tuple[int, bool], tuple] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces = Memo(lambda piece: self.encode_piece(piece.encode("utf-8", "surrogatepass")), MEMO_PIECES)
        self.chunks = ChunkTable(self.encode_run, lambda chunks: map(self.encode_run, chunks), MEMO_CHUNKS)

    @cached_property
    def finder(self) -> ahocorasick.Automaton:
        """Finds the entries in a piece; made when a worker first encodes."""
        finder = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            # An entry that its own merges do not produce can only be a whole piece.
            if len(token) == 1 or self.halves(token):
                finder.add_word(token.decode("latin-1"), (len(token), rank))
        finder.make_automaton()
        return finder

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge makes ``token``; None if merging its bytes ends in more or fewer."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
            if rank == NEVER:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def border(self, rank: int, right: bool) -> tuple[tuple[bytes, int], ...]:
        """The token's outermost part on one side, from its single byte up to itself.

        Each with the rank of the merge that takes it up (``NEVER`` for the token).
        """
        key = (rank, right)
        if key not in self.borders:
            part, chain, taken = self.token[rank], [], NEVER
            while True:
                chain.append((part, taken))
                if len(part) == 1:
                    break
                taken = self.ranks[part]
                part = self.halves(part)[1 if right else 0]
            self.borders[key] = tuple(reversed(chain))
        return self.borders[key]

    def adjacent(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes leaves exactly these two tokens."""
        known = self.pairs.get((left, right))
        if known is not None:
            return known
        a, b = self.border(left, True), self.border(right, False)
        i = j = 0
        while True:
            (x, x_taken), (y, y_taken) = a[i], b[j]
            across = self.ranks.get(x + y, NEVER)
            # The lowest rank merges first, of equal ones the leftmost.
            if across < x_taken and across <= y_taken:
                fits = False
                break
            if x_taken == y_taken == NEVER:
                fits = True
                break
            if x_taken <= y_taken:
                i += 1
            else:
                j += 1
        if len(self.pairs) >= MEMO_PAIRS:
            self.pairs.clear()
        self.pairs[left, right] = fits
        return fits

    def encode_piece(self, piece: bytes) -> bytes:
        """The piece's ids as little-endian unsigned 32-bit integers."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return whole.to_bytes(4, "little")
        size, letters = len(piece), piece.decode("latin-1")
        # Longest matches all the way, when each may follow the one before.
        path = [value for _, value in self.finder.iter_long(letters)]
        if sum(length for length, _ in path) == size:
            ids = [rank for _, rank in path]
            pairs = self.pairs
            if all(pairs[p] if p in pairs else self.adjacent(*p) for p in zip(ids, ids[1:])):
                return struct.pack(f"<{len(ids)}I", *ids)
        options: list[list] = [[] for _ in range(size)]
        for last, (length, rank) in self.finder.iter(letters):
            options[last + 1 - length].append((length, rank))  # ends ascend, so the longest comes last
        failed = bytearray(size + 1)
        path = []
        at = 0
        while at < size:
            before = path[-1][1] if path else None
            choice = options[at]
            while choice:
                length, rank = choice.pop()
                if not failed[at + length] and (before is None or self.adjacent(before, rank)):
                    path.append((length, rank))
                    at += length
                    break
            else:
                # Reached with the one token that can end here: no continuation, ever.
                failed[at] = 1
                length, _ = path.pop()
                at -= length
        return b"".join([rank.to_bytes(4, "little") for _, rank in path])

    def encode_run(self, text: str) -> bytes:
        pieces = self.pattern.findall(text)
        if len(pieces) == 1:  # kept as a chunk
            return self.encode_piece(pieces[0].encode("utf-8", "surrogatepass"))
        return b"".join(map(self.pieces.__getitem__, pieces))

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.chunks.encode(texts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, memoryview(ids).cast("I").tolist())) if ids else b""


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> BytePairCodec:
    """The codec of a rank file, once per worker process."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return BytePairCodec(ranks, pattern)


def bpe_encode(text: str | Column, path: str, pattern: str) -> Column:
    """The ids of ``text`` as little-endian unsigned 32-bit integers.

    Every match of ``pattern`` is encoded separately; there are no special
    tokens, their names are ordinary text. A null or empty text has no ids. The
    rank file must be at ``path`` on every machine.
    """

    @arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        own = codec(path, pattern)
        return pa.array(own.encode([t.decode("utf-8", "replace") for t in texts.to_pylist()]), pa.binary())

    return encode(text_bytes(text))


def bpe_decode(ids: str | Column, path: str, pattern: str) -> Column:
    """The bytes that the ids stand for; null or no ids give no bytes."""

    @arrow_udf("binary")
    def decode(rows: pa.Array) -> pa.Array:
        own = codec(path, pattern)
        return pa.array([own.decode(r or b"") for r in rows.to_pylist()], pa.binary())

    return decode(F.col(ids) if isinstance(ids, str) else ids)


def bpe_round_trip(text: str | Column, path: str, pattern: str) -> Column:
    """``struct<ids, decoded>``: encoded as by ``bpe_encode`` and decoded again, in one pass over the text."""
    kind = pa.struct([("ids", pa.binary()), ("decoded", pa.binary())])

    @arrow_udf("struct<ids:binary,decoded:binary>")
    def round_trip(texts: pa.Array) -> pa.Array:
        own = codec(path, pattern)
        ids = own.encode([t.decode("utf-8", "replace") for t in texts.to_pylist()])
        return pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(map(own.decode, ids), pa.binary())], fields=list(kind))

    return round_trip(text_bytes(text))

"""Operator 9, token-id files of patched frame-of-reference blocks.

A stream of integers is cut into blocks. A block stores its minimum, the
differences packed at a width that a chosen percentile of them needs, and the
wider ones as exceptions (position and full difference); an index holds where
every block's bits and exceptions start, so one block can be read alone.

A file image is::

    magic  b"PFOR1\\0", block size u16, number of streams u32, byte length of each u64
    stream n u64, blocks u32, minima i64[], widths u8[], bit starts u64[blocks+1] (bytes),
           exception starts u64[blocks+1], bits, exception positions u16[], exception values u64[]

with the streams document ids, null flags of the ids, tokens per document and
token ids. Integers are little-endian.

Documents are range-partitioned by id once and sorted; each task encodes its
range and emits file images of bounded size, which Spark writes as rows of a
table in the shared folder. So files reach any store that Spark reaches, and a
lost executor repeats its own range.
"""

from __future__ import annotations

import os
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelmart.llm.chunks import ChunkTable
from parcelmart.llm.common import small_batches, stored, text_bytes

MAGIC = b"PFOR1\0"
BLOCK = 1024
#: Share of a block's differences that its packed width must hold.
PERCENTILE = 0.95
#: A file is closed at the first document end after so many ids.
FILE_IDS = 1 << 20
#: Marks behind a word, the apostrophe left out, which may start a piece; a worker keeps the ids of
#: so many runs of them, of up to so many characters.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
TAIL, TAILS = 8, 50_000


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit length of each unsigned value (0 for 0)."""
    out = np.zeros(values.shape, np.uint8)
    rest = values.copy()
    for step in (32, 16, 8, 4, 2, 1):
        big = rest >= np.uint64(1 << step)
        out[big] += step
        rest[big] >>= np.uint64(step)
    return out + (rest > 0)


def _lanes(w: int):
    """Eight values of ``w`` bits fill ``w`` bytes: of each, its first byte, its shift in that, and the bytes that it touches."""
    for lane in range(8):
        first, shift = divmod(lane * w, 8)
        yield lane, first, np.uint64(shift), -(-(shift + w) // 8)


def _pack_rows(values: np.ndarray, w: int) -> np.ndarray:
    """The lowest ``w`` bits of every value of each row, little end first, as bytes."""
    if w > 56:  # with its shift, a value may not fit 64 bits
        flags = (values[:, :, None] >> np.arange(w, dtype=np.uint64)) & np.uint64(1)
        return np.packbits(flags.astype(np.uint8).reshape(len(values), -1), axis=1, bitorder="little")
    groups = (values & np.uint64((1 << w) - 1)).reshape(len(values), -1, 8)
    out = np.zeros((*groups.shape[:2], w), np.uint8)
    for lane, first, shift, touched in _lanes(w):
        shifted = groups[:, :, lane] << shift
        for byte in range(touched):
            out[:, :, first + byte] |= (shifted >> np.uint64(8 * byte)).astype(np.uint8)
    return out.reshape(len(values), -1)


def _unpack_rows(data: np.ndarray, w: int) -> np.ndarray:
    """The values that ``_pack_rows`` packed."""
    if w > 56:
        flags = np.unpackbits(data, axis=1, bitorder="little").reshape(len(data), -1, w).astype(np.uint64)
        return (flags << np.arange(w, dtype=np.uint64)).sum(axis=2, dtype=np.uint64)
    groups = data.reshape(len(data), -1, w)
    out = np.zeros((*groups.shape[:2], 8), np.uint64)
    for lane, first, shift, touched in _lanes(w):
        value = np.zeros(groups.shape[:2], np.uint64)
        for byte in range(touched):
            value |= groups[:, :, first + byte].astype(np.uint64) << np.uint64(8 * byte)
        out[:, :, lane] = (value >> shift) & np.uint64((1 << w) - 1)
    return out.reshape(len(data), -1)


def pack(values: np.ndarray, block: int = BLOCK) -> bytes:
    """One stream of 64-bit integers."""
    values = np.ascontiguousarray(values, np.int64)
    n = len(values)
    blocks = -(-n // block)
    padded = np.empty(blocks * block, np.int64)
    padded[:n] = values
    padded[n:] = values[-1] if n else 0
    rows = padded.reshape(blocks, block)
    low = rows.min(axis=1) if blocks else np.zeros(0, np.int64)
    rest = rows.view(np.uint64) - low.view(np.uint64)[:, None]
    at = min(block - 1, int(block * PERCENTILE))
    width = _bits(np.partition(rest, at, axis=1)[:, at]) if blocks else np.zeros(0, np.uint8)
    limit = np.where(width >= 64, np.uint64(2**64 - 1), (np.uint64(1) << (width % 64).astype(np.uint64)) - np.uint64(1))
    over = rest > limit[:, None]
    starts = np.zeros(blocks + 1, np.uint64)
    np.cumsum(width.astype(np.uint64) * np.uint64(block // 8), out=starts[1:])
    bits = np.zeros(int(starts[-1]), np.uint8)
    for w in np.unique(width):
        if w:
            mine = np.flatnonzero(width == w)
            for part in np.array_split(mine, max(1, len(mine) // 512)):  # bounds the memory
                packed = _pack_rows(rest[part], int(w))
                where = starts[part].astype(np.int64)[:, None] + np.arange(packed.shape[1])
                bits[where] = packed
    exceptions = np.zeros(blocks + 1, np.uint64)
    np.cumsum(over.sum(axis=1), out=exceptions[1:])
    which, position = np.nonzero(over)
    return b"".join((
        struct.pack("<QI", n, blocks), low.tobytes(), width.tobytes(), starts.tobytes(), exceptions.tobytes(),
        bits.tobytes(), position.astype(np.uint16).tobytes(), rest[which, position].tobytes(),
    ))


class Stream:
    """Reads a packed stream, whole or block by block."""

    def __init__(self, data: memoryview, block: int):
        self.block = block
        self.n, self.blocks = struct.unpack_from("<QI", data)
        self._data, self._at = data, 12
        self.low = self._take(np.int64, self.blocks)
        self.width = self._take(np.uint8, self.blocks)
        self.starts = self._take(np.uint64, self.blocks + 1).astype(np.int64)
        self.exceptions = self._take(np.uint64, self.blocks + 1).astype(np.int64)
        self.bits = self._take(np.uint8, int(self.starts[-1]))
        self.positions = self._take(np.uint16, int(self.exceptions[-1]))
        self.outliers = self._take(np.uint64, int(self.exceptions[-1]))

    def _take(self, kind, count: int) -> np.ndarray:
        out = np.frombuffer(self._data, kind, count, self._at)
        self._at += out.nbytes
        return out

    def read(self, k: int) -> np.ndarray:
        """Block ``k`` alone."""
        return self._blocks(np.array([k]))[0][: min(self.block, self.n - k * self.block)]

    def _blocks(self, some: np.ndarray) -> np.ndarray:
        out = np.zeros((len(some), self.block), np.uint64)
        for w in np.unique(self.width[some]):
            if w:
                rows = np.flatnonzero(self.width[some] == w)
                for part in np.array_split(rows, max(1, len(rows) // 512)):
                    where = self.starts[some[part]][:, None] + np.arange(self.block // 8 * int(w))
                    out[part] = _unpack_rows(self.bits[where], int(w))
        for row, k in enumerate(some):
            mine = slice(self.exceptions[k], self.exceptions[k + 1])
            out[row, self.positions[mine]] = self.outliers[mine]
        return (out + self.low[some].view(np.uint64)[:, None]).view(np.int64)

    def all(self) -> np.ndarray:
        return self._blocks(np.arange(self.blocks)).reshape(-1)[: self.n]


def file_image(*streams: np.ndarray, block: int = BLOCK) -> bytes:
    packed = [pack(s, block) for s in streams]
    head = MAGIC + struct.pack(f"<HI{len(packed)}Q", block, len(packed), *map(len, packed))
    return head + b"".join(packed)


def open_image(data: bytes) -> list[Stream]:
    view = memoryview(data)
    if bytes(view[:6]) != MAGIC:
        raise ValueError("not a token file")
    block, count = struct.unpack_from("<HI", view, 6)
    lengths = struct.unpack_from(f"<{count}Q", view, 12)
    at, out = 12 + 8 * count, []
    for length in lengths:
        out.append(Stream(view[at : at + length], block))
        at += length
    return out


def byte_alphabet() -> dict[int, int]:
    """The characters that byte-level vocabularies write bytes with: visible Latin-1 ones
    stand for themselves, the others get the characters from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in visible]
    return {b: b for b in visible} | {b: 256 + k for k, b in enumerate(others)}


class WrittenCharacters(dict):
    """A character's bytes in the byte alphabet, made when it is first met."""

    def __init__(self):
        super().__init__()
        self.alphabet = byte_alphabet()

    def __missing__(self, character: str) -> str:
        written = self[character] = "".join(chr(self.alphabet[b]) for b in character.encode())
        return written


class LibraryEncoder:
    """The tokenizers library's ids of texts.

    A chunk that repeats is encoded once while it is kept. Its pieces go to the
    library's model directly, in the byte alphabet that the library's
    pre-tokenizer would write them in; texts with wider white space, and those
    that hold the name of an added token, go through the library's whole pipeline.
    """

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # The library cuts these out of a text before its pieces are found.
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.tokenize, self.pattern, self.characters = self.library.model.tokenize, regex.compile(pattern), WrittenCharacters()
        self.space = self.characters[" "]
        self.tails: dict[str, bytes] = {}
        self.chunks = ChunkTable(self._whole, lambda chunks: map(self._chunk, chunks))

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        # A space and letters are one piece, and so are the marks behind them. A chunk of its own may hold the letters.
        word = chunk[1:].rstrip(MARKS)
        if chunk[0] == " " and word.isalpha():
            tail = chunk[len(word) + 1 :]
            ids = tail and self.chunks.table.get(word) or self._piece(self.space + (word if word.isascii() else self._written(word)))
            return ids + self._tail(tail) if tail else ids
        return b"".join([self._piece(self._written(piece)) for piece in self.pattern.findall(chunk)])

    def _tail(self, piece: str) -> bytes:
        ids = self.tails.get(piece)
        if ids is None:
            ids = self._piece(self._written(piece))
            if len(piece) <= TAIL and len(self.tails) < TAILS:
                self.tails[piece] = ids
        return ids

    def _piece(self, written: str) -> bytes:
        return array("I", [token.id for token in self.tokenize(written)]).tobytes()

    def _written(self, piece: str) -> str:
        return "".join(map(self.characters.__getitem__, piece))

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = {i: self._whole(t) for i, t in enumerate(texts) if any(name in t for name in self.added)}
        rest = iter(self.chunks.encode([t for i, t in enumerate(texts) if i not in whole] if whole else texts))
        return [whole[i] if i in whole else next(rest) for i in range(len(texts))]


@lru_cache(maxsize=2)
def library_encoder(path: str, pattern: str) -> LibraryEncoder:
    """Once per worker process."""
    return LibraryEncoder(path, pattern)


FILES = "part int, file int, first bigint, n_docs bigint, n_ids bigint, content binary"


def write_token_files(
    docs: DataFrame, path: str, pattern: str, end_id: int, file_ids: int = FILE_IDS, block: int = BLOCK
) -> DataFrame:
    """Encode every text, append ``end_id``, write the ids in ascending ``doc_id`` order.

    Returns a scan of the written files: ``part, file`` (their order), ``first``
    (the ids of earlier files of the part), ``n_docs, n_ids, content``. A file
    holds whole documents.

    Edge cases: a null or empty text is the end id alone. Null ids come first;
    rows with one id follow each other by their text's bytes. No rows give no
    file. Other columns are not written.
    """
    from pyspark import TaskContext

    small_batches(docs.sparkSession)
    end = struct.pack("<I", end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number, first = library_encoder(path, pattern), TaskContext.get().partitionId(), 0, 0
        ids: list = []
        nulls: list = []
        tokens: list = []
        chunks: list = []

        def close() -> pa.RecordBatch:
            stream = np.frombuffer(b"".join(chunks), "<u4")
            image = file_image(np.array(ids, np.int64), np.array(nulls), np.array(tokens), stream, block=block)
            row = {"part": part, "file": number, "first": first, "n_docs": len(ids), "n_ids": len(stream), "content": image}
            return pa.RecordBatch.from_pylist([row], FILE_SCHEMA)

        held = 0
        for batch in batches:
            texts = [t.decode("utf-8", "replace") for t in batch.column(1).to_pylist()]
            for doc_id, encoded in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                chunk = encoded + end
                ids.append(doc_id or 0)
                nulls.append(doc_id is None)
                tokens.append(len(chunk) // 4)
                chunks.append(chunk)
                held += len(chunk) // 4
                if held >= file_ids:
                    yield close()
                    number, first, held = number + 1, first + held, 0
                    ids, nulls, tokens, chunks = [], [], [], []
        if ids:
            yield close()

    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return stored(ordered.mapInArrow(write, FILES), "token-files")


FILE_SCHEMA = pa.schema([("part", pa.int32()), ("file", pa.int32()), ("first", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("content", pa.binary())])


def read_token_files(files: DataFrame) -> DataFrame:
    """Each document's ``doc_id, start, n_tokens, ids_crc32`` from the file images.

    ``start`` counts the ids of all documents before it: those of earlier
    ranges (a sum per range, one row each, so small enough for Spark to
    broadcast), earlier files of the range, and earlier documents of the file.
    The files themselves are read where they lie. An id may be repeated or
    null, as it was written; no files give no rows.
    """
    ranges = files.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("part").alias("of_part"), F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("range_start"))
    # Written first: the join is then planned from its true size.
    ranges = stored(ranges, "range-starts")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids, nulls, tokens, stream = open_image(content.as_py())
                doc_ids, lengths, values = ids.all(), tokens.all(), stream.all().astype("<u4")
                ends = np.cumsum(lengths)
                begins = ends - lengths
                crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(begins, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, mask=nulls.all().astype(bool)), pa.array(begins + start), pa.array(lengths), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    placed = files.join(ranges, F.col("part") == F.col("of_part")).select((F.col("range_start") + F.col("first")).alias("start"), "content")
    return placed.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")

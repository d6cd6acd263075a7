"""Texts in chunks that tokenize independently, each encoded once while it is kept.

The pattern of the public byte-level vocabularies starts a piece at every
single space between other characters, and a single line break between them is
a piece by itself. So a text without wider white space is a head, then chunks:
a space and the characters up to the next, or a line break and those. Chunks
repeat far more than texts, so a worker keeps their ids. Arrow cuts a run of
texts and finds its distinct chunks, so that the table is asked for each of them
once. Texts with wider white space are encoded whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks in a worker's table before it becomes the older one, which is dropped then; bounds its memory.
LIMIT = 600_000
#: Characters of texts that are cut and looked up together, about: bounds the memory of a batch of long texts and what a table gets beyond its limit.
RUN = 1 << 22
#: Longer chunks are not kept.
LONGEST = 64
#: In place of ids: wider white space touches the chunk.
WIDER = b"\0"


def _edged(chunk: str) -> bool:
    return not chunk or chunk[0].isspace() or chunk[-1].isspace()


class ChunkTable:
    """``whole`` encodes any text; ``many`` encodes chunks that start with a space or line break."""

    def __init__(self, whole: Callable[[str], bytes], many: Callable[[list[str]], Iterable[bytes]], limit: int = LIMIT):
        self.whole, self.many, self.limit = whole, many, limit
        #: By the chunk without its space, or a line break and the word after it.
        self.table: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text, in runs of texts of about ``RUN`` characters."""
        out: list[bytes] = []
        at, chars = 0, 0
        for end, text in enumerate(texts, 1):
            chars += len(text)
            if chars >= RUN or end == len(texts):
                out += self._encode_run(texts[at:end])
                at, chars = end, 0
        return out

    def _encode_run(self, texts: list[str]) -> list[bytes]:
        """Each distinct chunk of the texts is looked up once; those not yet known are encoded together."""
        words = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n"), " ")
        first = words.offsets.to_numpy()
        behind = np.ones(len(words.values), bool)
        behind[first[:-1]] = False
        heads = words.values.filter(pa.array(~behind)).to_pylist()
        chunks = words.values.filter(pa.array(behind)).dictionary_encode()
        bounds = first - np.arange(len(first))
        of = chunks.indices.to_numpy()
        ids = self._known(chunks.dictionary.to_numpy(zero_copy_only=False).tolist())
        wide = np.array([i == WIDER for i in ids], bool)
        whole = set(np.searchsorted(bounds, np.flatnonzero(wide[of]), "right") - 1) if wide.any() else set()
        every = np.array([*ids, None], object)[of].tolist()
        out = []
        for k, (text, head) in enumerate(zip(texts, heads)):
            if k in whole or head and _edged(head):
                out.append(self.whole(text))
            else:
                out.append(self.whole(head) + b"".join(every[bounds[k] : bounds[k + 1]]))
        return out

    def _known(self, keys: list[str]) -> list[bytes]:
        """The ids of distinct chunks, or ``WIDER``."""
        if len(self.table) >= self.limit:
            self.table, self.older = {}, self.table
        table, older = self.table, self.older
        out = list(map(table.get, keys))
        plain = []
        for i in [i for i, ids in enumerate(out) if ids is None]:
            key = keys[i]
            if key in older:
                out[i] = table[key] = older[key]
            elif _edged(key[1:] if key[:1] == "\n" else key):
                out[i] = table[key] = WIDER
            else:
                plain.append(i)
        for i, ids in zip(plain, self.many([keys[i] if keys[i][0] == "\n" else " " + keys[i] for i in plain])):
            out[i] = ids
            if len(keys[i]) <= LONGEST:
                table[keys[i]] = ids
        return out

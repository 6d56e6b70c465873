"""Problem 8: token ids of the whole corpus under a public byte-level vocabulary.

Method: forced boundaries. Two neighbouring bytes that occur side by side in no token of the vocabulary can never end
up in one token, so every such place is a certain cut. Each pre-token is divided at its certain cuts and the fragments
are encoded on their own; because no merge can reach over a cut, joining the fragments' ids gives the ids of the whole.
Most fragments recur, so a worker keeps what it has encoded; scripts with few merges fall into very short fragments,
which keeps that memory small and the merge loop short even for a text without any blank.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Entries a worker keeps; it only saves work, a fragment beyond it is encoded again.
CACHE = 200_000


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Where a public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class ForcedCutEncoder:
    """Byte-pair encoder over a rank file, dividing at certain cuts."""

    def __init__(self, path: str, pattern: str | None = None):
        import numpy as np
        import regex

        if pattern is None:
            import public_tokenizers

            pattern = public_tokenizers.PATTERN
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.words = regex.compile(pattern)
        joined = np.zeros((256, 256), dtype=bool)
        for token in self.ranks:
            if len(token) > 1:
                b = np.frombuffer(token, dtype=np.uint8)
                joined[b[:-1], b[1:]] = True
        #: inside[a][b]: some token has byte b right after byte a.
        self.inside = [frozenset(np.flatnonzero(row).tolist()) for row in joined]
        self.known: dict[str, list[int]] = {}
        self.parts: dict[bytes, list[int]] = {}

    def fragments(self, data: bytes) -> list[bytes]:
        """data divided at every certain cut."""
        inside, out, start = self.inside, [], 0
        for k in range(1, len(data)):
            if data[k] not in inside[data[k - 1]]:
                out.append(data[start:k])
                start = k
        out.append(data[start:])
        return out

    def merge(self, data: bytes) -> list[int]:
        """Ids of one fragment: the pair of lowest rank is joined first, the leftmost of equals."""
        ranks = self.ranks
        if data in ranks:
            return [ranks[data]]
        n = len(data)
        if n > 48:
            return self._merge_long(data)
        parts = [data[k : k + 1] for k in range(n)]
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                r = ranks.get(parts[k] + parts[k + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _merge_long(self, data: bytes) -> list[int]:
        """The same by a heap and linked neighbours, in n log n steps."""
        import heapq

        ranks, n = self.ranks, len(data)
        nxt, prv, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        heap: list[tuple[int, int, int, int]] = []

        def push(a: int) -> None:
            b = nxt[a]
            if b < n:
                r = ranks.get(data[a : end[b]])
                if r is not None:
                    heapq.heappush(heap, (r, a, b, end[b]))

        for k in range(n - 1):
            push(k)
        while heap:
            _, a, b, e = heapq.heappop(heap)
            if not alive[a] or nxt[a] != b or b >= n or not alive[b] or end[b] != e or end[a] != b:
                continue
            alive[b] = False
            end[a] = e
            nxt[a] = nxt[b]
            if nxt[a] < n:
                prv[nxt[a]] = a
            push(a)
            if prv[a] >= 0:
                push(prv[a])
        out, k = [], 0
        while k < n:
            out.append(ranks[data[k : end[k]]])
            k = nxt[k]
        return out

    def word(self, word: str) -> list[int]:
        ids = self.known.get(word)
        if ids is None:
            ids = []
            for part in self.fragments(word.encode("utf-8", "surrogatepass")):
                got = self.parts.get(part)
                if got is None:
                    got = self.merge(part)
                    if len(self.parts) >= CACHE:
                        self.parts.clear()
                    if len(part) <= 64:
                        self.parts[part] = got
                ids.extend(got)
            if len(word) <= 64:
                if len(self.known) >= CACHE:
                    self.known.clear()
                self.known[word] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        """Ids of text; none for an empty or null text."""
        out: list[int] = []
        if text:
            word = self.word
            for m in self.words.finditer(text):
                out += word(m.group())
        return out


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> ForcedCutEncoder:
    return ForcedCutEncoder(path)


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(id_col, ids array<int>): one row for each row of docs, no special tokens.

    Empty and null texts give an empty list; a blank text gives the ids of its blanks. Repeated rows stay repeated, a
    null id stays null, other columns of docs are never read. No shuffle: one pass over the two columns.
    """
    path = vocabulary or vocabulary_path()
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                ids = pa.array([enc.encode(t) for t in part.column(1).to_pylist()], type=pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=[id_col, "ids"])

    schema = T.StructType([T.StructField(id_col, kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(id_col, n_tokens bigint): as encode_documents, with the number of ids only."""
    path = vocabulary or vocabulary_path()
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            n = pa.array([len(enc.encode(t)) for t in b.column(1).to_pylist()], type=pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), n], names=[id_col, "n_tokens"])

    schema = T.StructType([T.StructField(id_col, kind), T.StructField("n_tokens", T.LongType())])
    return docs.select(id_col, text_col).mapInArrow(run, schema)

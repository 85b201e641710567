"""Token counts by byte-pair merging over a linked list and a heap.

The pre-tokens of a text are merged one by one: a heap holds the adjacent pairs by rank and place, a doubly linked
list the symbols that are left; the pair of lowest rank is popped and merged until none is left. The count of tokens
is the number of bytes less the number of merges; no token is ever named. Counting needs no shuffle. Pre-tokens that
were counted before are looked up in a table of bounded size.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm._common import utf8

#: Rows of a batch that are unpacked at a time.
SLICE = 256
#: Pre-tokens whose counts a Python worker keeps; the table is emptied when it is full.
MEMO = 400_000
#: Longer pre-tokens are counted each time.
MEMO_BYTES = 64


def byte_names() -> dict[str, int]:
    """The printable stand-ins for bytes in byte-level vocabularies: visible Latin-1 stands for itself, the rest
    follows from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class MergeCounter:
    """Counts tokens as the byte-level BPE of a tokenizers .json file gives them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names = byte_names()
        code = lambda s: bytes(names[c] for c in s)
        ids = {code(k): v for k, v in spec["model"]["vocab"].items()}
        self.start = [ids[bytes([b])] for b in range(256)]
        #: (left symbol, right symbol) to (rank, merged symbol); symbols stay inside the merge loop
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = map(code, pair.split(" ") if isinstance(pair, str) else pair)
            self.pairs[ids[a], ids[b]] = (rank, ids[a + b])
        import public_tokenizers

        self.parts = regex.compile(public_tokenizers.PATTERN)
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.memo: dict[str, int] = {}

    def merges(self, piece: bytes) -> int:
        """How many merges a pre-token takes."""
        n, pairs = len(piece), self.pairs
        symbol = [self.start[b] for b in piece]
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(*m, i) for i in range(n - 1) if (m := pairs.get((symbol[i], symbol[i + 1])))]
        heap = [(rank, i, new) for rank, new, i in heap]
        heapq.heapify(heap)
        done = 0
        while heap:
            rank, i, new = heapq.heappop(heap)
            j = after[i]
            if symbol[i] < 0 or j < 0 or pairs.get((symbol[i], symbol[j])) != (rank, new):
                continue  # one of the two has been merged since
            symbol[i], symbol[j] = new, -1
            done += 1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if m := pairs.get((new, symbol[k])):
                    heapq.heappush(heap, (m[0], i, m[1]))
            if (h := before[i]) >= 0 and (m := pairs.get((symbol[h], new))):
                heapq.heappush(heap, (m[0], h, m[1]))
        return done

    def piece(self, piece: str) -> int:
        raw = piece.encode("utf-8")
        count = len(raw) - self.merges(raw)
        if len(raw) <= MEMO_BYTES:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[piece] = count
        return count

    def count(self, text: str) -> int:
        """Tokens of a text; a special string inside it is one token, as the library has it by default."""
        total, known, piece = 0, self.memo.get, self.piece
        spans = self.special.split(text) if self.special else [text]
        for span in spans:
            for x in self.parts.findall(span):
                total += known(x) or piece(x)
        return total + len(spans) - 1


@lru_cache(2)
def counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def token_counts(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", limit: int = 1024, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of docs.

    vocabulary: a file of the public tokenizers, found on each executor, or a path. Null and empty texts have 0
    bytes and 0 tokens; null ids and repeated rows are kept as they are; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        c = counter(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary))
        for batch in (whole.slice(at, SLICE) for whole in batches for at in range(0, whole.num_rows, SLICE)):
            texts = batch.column(1).to_pylist()
            tokens = [c.count(t) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(utf8(t)) for t in texts], pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut into the pieces that the vocabulary's own pre-tokenizer makes.
In each piece the adjacent pair of lowest rank is merged again and again: a
heap holds the pairs, a linked list the symbols.  The count is the number of
initial symbols less the number of merges; identifiers are never made.

Defined results: a null text counts as empty (0 bytes, 0 tokens); null ids,
repeated rows and ties pass through row by row; an empty table gives an empty
table; columns other than the id and the text are not read, so their names
cannot clash.
"""

from __future__ import annotations

import heapq
import json
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import slices

#: Unicode white space; a white-space run and what follows it up to the next run are split alike anywhere.
_SPACE = "\\x09-\\x0d\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CHUNK = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
#: Entries of a worker's memo and the longest chunk it keeps; beyond, chunks are counted anew.
MEMO, MEMO_CHARS = 600_000, 64


def merged_count(piece: str, ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left of ``piece`` when no adjacent pair has a rank."""
    n = len(piece)
    if n < 2:
        return n
    symbols: list[str | None] = list(piece)
    after = [*range(1, n), -1]
    before = list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((piece[i], piece[i + 1]))) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        rank, i = heapq.heappop(heap)
        left, j = symbols[i], after[i]
        if left is None or j < 0 or ranks.get((left, symbols[j])) != rank:
            continue  # one of the two has been merged since
        both = symbols[i] = left + symbols[j]
        symbols[j] = None
        merges += 1
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
            if (r := ranks.get((both, symbols[k]))) is not None:
                heapq.heappush(heap, (r, i))
        k = before[i]
        if k >= 0 and (r := ranks.get((symbols[k], both))) is not None:
            heapq.heappush(heap, (r, k))
    return n - merges


class Counter(dict):
    """Tokens by chunk of text; unknown chunks are counted when asked for."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        self.ranks = {tuple(m.split(" ")) if isinstance(m, str) else tuple(m): i for i, m in enumerate(spec["model"]["merges"])}
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str

    def __missing__(self, chunk: str) -> int:
        n = len(self.special.findall(chunk))
        for part in self.special.split(chunk) if n else (chunk,):
            n += sum(merged_count(piece, self.ranks) for piece, _ in self.split(part))
        if len(chunk) <= MEMO_CHARS:
            self[chunk] = n
        return n

    def of(self, text: str) -> int:
        if len(self) > MEMO:
            self.clear()
        return sum(map(self.__getitem__, CHUNK.findall(text)))


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One counter for each vocabulary and Python worker."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` for each row of ``docs``.

    ``vocabulary`` is the path of a byte-level BPE file in the tokenizers
    format, readable on every executor.  One narrow pass, no shuffle.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def count(batches):
        c = counter(vocabulary)
        for b in slices(batches, "text"):
            text = pc.fill_null(b.column("text"), "")
            yield pa.RecordBatch.from_arrays([b.column("id"), pc.binary_length(text).cast(pa.int64()), pa.array([c.of(t) for t in text.to_pylist()], pa.int64())], ["id", "n_bytes", "n_tokens"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > F.lit(limit)).alias("over_limit"))

"""Best-fit packing by a linear grouping scheme.

Documents become token ids with an end id, longer ones are cut into pieces of
``capacity``, and all pieces are packed into as few sequences as possible:

1. lengths above ``capacity * small`` are dealt, longest first, into groups of
   equal cardinality, and each is rounded up to the longest of its group (done twice,
   the better plan is kept: with groups of exactly that many, or where a length that
   fills a group stays alone in it and few lengths are a group each);
2. for these few sizes configurations are optimised: a knapsack over the
   remaining sizes makes the fullest sequence that holds the largest one left,
   and it is used as often as the sizes last;
3. the actual pieces take the places of the rounded ones;
4. the small pieces are best-fitted into what room is left, longest first.

The plan needs only the histogram of lengths (at most ``capacity`` numbers)
and describes runs of equal sequences, so its size does not grow with the
corpus.  Pieces find their places in Spark: each gets a rank among the pieces
of its length (counted by hash bucket, so that a very common length is
spread), and a rank belongs to one run of the plan.

Defined results: a null text counts as empty, and an empty text is one piece
with the end id alone; null ids are kept; repeated rows are documents of their
own; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.common import slices, stored, words

#: Distinct words that a worker's memo holds at most, and their ids.
MEMO, MEMO_IDS = 1_600_000, 16_000_000
RANK_BUCKETS = 256


class WordIds:
    """Token ids of white-space separated words; equal words are encoded once.

    The vocabulary drops white space and never merges across it, so the ids of
    a text are those of its words, one after another.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.encode = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.row: dict[str, int] = {}
        self.ids, self.ends = array("I"), array("Q", [0])

    def rows(self, known: list[str]) -> np.ndarray:
        if len(self.row) > MEMO or len(self.ids) > MEMO_IDS:
            self.clear()
        new = [w for w in known if w not in self.row]
        for w, e in zip(new, self.encode.encode_batch_fast(new, add_special_tokens=False) if new else (), strict=True):
            self.row[w] = len(self.ends) - 1
            self.ids.extend(e.ids)
            self.ends.append(len(self.ids))
        return np.fromiter(map(self.row.__getitem__, known), np.int64, len(known))

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each text."""
        codes, n, known = words(texts, lower=False)
        row = self.rows(known)
        ends = np.array(self.ends, np.int64)
        ids = np.array(self.ids, np.uint32)
        start, length = ends[:-1][row][codes], np.diff(ends)[row][codes]
        total = np.concatenate([[0], np.cumsum(length)])
        at = np.arange(total[-1]) + np.repeat(start - total[:-1], length)
        bounds = np.concatenate([[0], np.cumsum(n)])
        return ids[at], np.diff(total[bounds])


_encoders: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, piece, start, length, ids_crc32[, ids])``: a row for each piece of each document."""
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], np.uint32)

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        coder = encoder(vocabulary)
        for b in slices(batches, "text"):
            ids, n = coder.of(b.column("text"))
            row, piece, start, length, crc, parts = [], [], [], [], [], []
            at = 0
            for i, k in enumerate(n.tolist()):
                own = np.concatenate([ids[at : at + k], end]).astype("<u4", copy=False)
                at += k
                for p, s in enumerate(range(0, k + 1, capacity)):
                    part = own[s : s + capacity]
                    row.append(i)
                    piece.append(p)
                    start.append(s)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        parts.append(part.astype(np.int32))
            columns = {"id": b.column("id").take(pa.array(row, pa.int64())), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
            if with_ids:
                columns["ids"] = pa.array(parts, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
    return out.withColumnRenamed("id", id_col)


class Plan:
    """Runs of equal sequences.

    ``segments`` are ``(length, first rank, pieces, first sequence, pieces per
    sequence, offset)``: the pieces of a length with these ranks fill
    consecutive sequences from the offset on.
    """

    def __init__(self, capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.segments: list[tuple[int, int, int, int, int, int]] = []
        self.ranks: dict[int, int] = {}
        self.room: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, sequences)
        self.rooms: list[int] = []

    def put(self, length: int, n: int, first: int, per: int, offset: int) -> None:
        rank = self.ranks.get(length, 0)
        self.segments.append((length, rank, n, first, per, offset))
        self.ranks[length] = rank + n

    def free(self, first: int, n: int, used: int) -> None:
        left = self.capacity - used
        if n and left:
            if not self.room.get(left):
                insort(self.rooms, left)
                self.room[left] = []
            self.room[left].append((first, n))

    def best_fit(self, length: int, n: int) -> None:
        while n:
            k = bisect_left(self.rooms, length)
            if k == len(self.rooms):
                new = -(-n // (self.capacity // length))
                self.free(self.sequences, new, 0)
                self.sequences += new
                continue
            left = self.rooms[k]
            first, runs = self.room[left].pop()
            if not self.room[left]:
                self.rooms.pop(k)
            used, per = self.capacity - left, left // length
            full = min(runs, n // per)
            if full:
                self.put(length, full * per, first, per, used)
                self.free(first, full, used + per * length)
                n -= full * per
            if full < runs:
                rest = min(n, per) if n < per else 0
                if rest:
                    self.put(length, rest, first + full, per, used)
                    self.free(first + full, 1, used + rest * length)
                    n -= rest
                self.free(first + full + bool(rest), runs - full - bool(rest), used)


def _configuration(sizes: list[int], left: list[int], capacity: int) -> list[int]:
    """How many of each size make the fullest sequence that holds the largest size left."""
    must = next(i for i, n in enumerate(left) if n)
    room = capacity - sizes[must]
    # reach[r]: the last size used to fill r exactly, -1 where it cannot be filled
    reach = np.full(room + 1, -1, np.int64)
    reach[0] = len(sizes)
    for i, s in enumerate(sizes):
        for _ in range(min(left[i] - (i == must), room // s)):
            new = np.zeros(room + 1, bool)
            new[s:] = (reach[:-s] >= 0) if s <= room else False
            new &= reach < 0
            if not new.any():
                break
            reach[new] = i
    use = [0] * len(sizes)
    use[must] += 1
    r = int(np.flatnonzero(reach >= 0)[-1])
    while r:
        i = int(reach[r])
        use[i] += 1
        r -= sizes[i]
    return use


def plan(histogram: dict[int, int], capacity: int, groups: int = 48, small: float = 0.125) -> Plan:
    """The packing of ``histogram`` (pieces by length, 1 to ``capacity``): by either grouping, the one of fewer sequences."""
    return min((_plan(histogram, capacity, groups, small, alone) for alone in (False, True)), key=lambda made: made.sequences)


def _plan(histogram: dict[int, int], capacity: int, groups: int, small: float, alone: bool) -> Plan:
    """``alone``: no shorter piece joins the group of a length that has filled one, and few lengths are a group each."""
    out = Plan(capacity)
    large = [(s, histogram[s]) for s in sorted(histogram, reverse=True) if s > capacity * small and histogram[s]]
    # 1: groups of equal cardinality, as runs of actual lengths
    each = max(1, -(-sum(n for _, n in large) // groups)) if not alone or len(large) > groups else 1
    grouped: list[list[list[int]]] = []
    filled = each
    for s, n in large:
        while n:
            if filled == each:
                if not grouped or grouped[-1][0][0] != s:
                    grouped.append([])
                elif alone:
                    grouped[-1][0][1] += n
                    break
                filled = 0  # where the same size goes on, another group is of no use
            k = min(n, each - filled)
            if grouped[-1] and grouped[-1][-1][0] == s:
                grouped[-1][-1][1] += k
            else:
                grouped[-1].append([s, k])
            filled += k
            n -= k
    sizes = [g[0][0] for g in grouped]
    left = [sum(n for _, n in g) for g in grouped]
    # 2 and 3: configurations, filled with the actual pieces
    while any(left):
        use = _configuration(sizes, left, capacity)
        times = min(left[i] // a for i, a in enumerate(use) if a)
        runs = [(out.sequences, times, 0)]
        out.sequences += times
        for i, a in enumerate(use):
            left[i] -= a * times
            for _ in range(a):
                new = []
                for first, n, used in runs:
                    while n:
                        s, k = grouped[i][0]
                        k = min(k, n)
                        out.put(s, k, first, 1, used)
                        new.append((first, k, used + s))
                        first, n = first + k, n - k
                        grouped[i][0][1] -= k
                        if not grouped[i][0][1]:
                            grouped[i].pop(0)
                runs = new
        for first, n, used in runs:
            out.free(first, n, used)
    # 4
    for s in sorted((s for s in histogram if s <= capacity * small and histogram[s]), reverse=True):
        out.best_fit(s, histogram[s])
    return out


def pack(cut: DataFrame, capacity: int = 4096, keys: tuple[str, ...] = ("doc_id", "piece", "start", "ids_crc32")) -> DataFrame:
    """``cut`` (a stored table with a ``length`` column) with ``sequence_id`` and ``offset``.

    ``keys`` order the pieces of one length, so that a task that runs again
    ranks them alike.
    """
    cut = cut.withColumn("rank_bucket", F.pmod(F.xxhash64(*keys), F.lit(RANK_BUCKETS)).cast("int"))
    cells = cut.groupBy("length", "rank_bucket").agg(F.count("*").alias("n"))
    made = plan({int(r["length"]): int(r["n"]) for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    before = Window.partitionBy("length").orderBy("rank_bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("length", "rank_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = cut.withColumn("rank", F.row_number().over(Window.partitionBy("length", "rank_bucket").orderBy(*keys)) - 1)
    ranked = ranked.join(cells, ["length", "rank_bucket"]).withColumn("rank", F.col("rank") + F.col("before")).drop("before", "rank_bucket")
    segments = np.array(sorted(made.segments), np.int64).reshape(-1, 6)
    sent = cut.sparkSession.sparkContext.broadcast(segments)  # bounded by the number of lengths, not by the pieces

    def place(batches):
        segments = sent.value
        key = (segments[:, 0] << 46) + segments[:, 1]
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            s = segments[np.searchsorted(key, (length << 46) + rank, "right") - 1]
            k = rank - s[:, 1]
            kept = [c for c in b.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(s[:, 3] + k // s[:, 4]), pa.array(s[:, 5] + k % s[:, 4] * length)], [*kept, "sequence_id", "offset"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank"]
    return ranked.mapInArrow(place, ", ".join([*fields, "sequence_id long", "offset long"]))


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 4096, with_ids: bool = False) -> DataFrame:
    """The pieces of ``docs`` with their places: ``(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset)``."""
    return pack(stored(pieces(docs, vocabulary, capacity, with_ids=with_ids), "packing-pieces"), capacity).select("doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, "sequence_id", "offset")

"""Byte-level BPE encoding by a lazily determinised transducer, and streaming decoding.

Encoding.  A text is cut by the vocabulary's pattern; each match is encoded
alone.  The merges are compiled into a non-deterministic transducer: a
configuration is the last token written and the bytes read of the next one, and
a token may follow another if merging their bytes never joins across the
border.  Whether it does is read from the two tokens' edges (the symbols that
stand at a token's border while it is merged, with their ranks).  Exactly one
run reads a whole match, and it writes what merging by rank gives.  The
transducer is made deterministic as bytes are met: a state holds all live
configurations with what each has written beyond the others' common part, and
that common part is emitted.  Configurations that cannot end in the run that
counts die after at most one token's bytes, so tokens leave after a bounded
lookahead and memory does not grow with the text.

Decoding.  The machine's state is the unfinished bytes of one character (three
at most); a step takes a token and emits the characters that it completes.
Steps are memoised for each state and token.  Bytes that are no UTF-8 become
U+FFFD, one for each maximal part, as usual.

Defined results: a null text counts as empty and gives no ids; null ids give an
empty text; a null id inside, or one that the vocabulary has not, decodes to
U+FFFD; null document ids, repeated rows and ties pass through row by row; very
long texts are encoded whole; an empty table gives an empty table; other columns
are not read, so their names cannot clash.  One narrow pass, no shuffle.
"""

from __future__ import annotations

import base64
import gc
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import slices

#: Entries of a worker's memos (chunks and pieces, states, borders) and the longest chunk kept; beyond, they start anew.
MEMO, STATES, BORDERS, MEMO_CHARS = 400_000, 300_000, 800_000, 40
#: Ids decoded in one step; those of a long text are never parted.
IDS = 500_000
#: White space as Unicode defines it; a run of it and what follows up to the next run are cut alike anywhere.
_SPACE = "\\x09-\\x0d\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CHUNK = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
NEVER = 1 << 40


class Transducer:
    """Encodes single matches; ``ranks`` maps the bytes of each token to its id.

    A configuration is ``(ids written, last token, node)``: the node of the tree
    of tokens that the bytes since the last token lead to, 0 for none.  A state
    is a dictionary from a byte to the next state and the ids emitted; its
    configurations stand under ``LIVE``.
    """

    LIVE = -1

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {i: token for token, i in ranks.items()}
        #: The tree of tokens: the next node by node and byte, the token that ends in a node, whether it goes on.
        self.next: dict[int, int] = {}
        self.ends: list[int | None] = [None]
        self.inner = bytearray(1)
        for token, i in ranks.items():
            node = 0
            for byte in token:
                self.inner[node] = 1
                step = node << 8 | byte
                if step not in self.next:
                    self.next[step] = len(self.ends)
                    self.ends.append(None)
                    self.inner.append(0)
                node = self.next[step]
            self.ends[node] = i
        self.edges: dict[int, tuple | None] = {}
        self.borders: dict[int, bool] = {}
        self.start()

    def start(self) -> None:
        # states refer to each other, so those of a former start wait for the collector
        if getattr(self, "states", None):
            for state in self.states.values():
                state.clear()
        begin = (((), -1, 0),)
        self.first = {self.LIVE: begin}
        self.states: dict[tuple, dict] = {begin: self.first}

    def edge(self, i: int) -> tuple | None:
        """``(left, right)``: the symbols at a token's borders as it is merged, each with the rank that makes it.

        None for a token that merging its own bytes does not give.
        """
        if i not in self.edges:
            token = self.bytes[i]
            parts = [token[n : n + 1] for n in range(len(token))]
            left, right = [(-1, parts[0])], [(-1, parts[-1])]
            while len(parts) > 1:
                rank, n = min((self.ranks.get(a + b, NEVER), n) for n, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
                if rank == NEVER:
                    break
                parts[n : n + 2] = [parts[n] + parts[n + 1]]
                if n == 0:
                    left.append((rank, parts[0]))
                if n == len(parts) - 1:
                    right.append((rank, parts[-1]))
            self.edges[i] = (left, right) if len(parts) == 1 else None
        return self.edges[i]

    def follows(self, last: int, token: int) -> bool:
        """Whether ``token`` may stand behind ``last`` (-1: at the start): no merge joins symbols across their border."""
        edge = self.edge(token)
        if last < 0 or edge is None:
            return edge is not None
        right, left, rank = self.edge(last)[1], edge[0], self.ranks.get
        i = j = 0
        while True:
            grown = right[i + 1][0] if i + 1 < len(right) else NEVER
            other = left[j + 1][0] if j + 1 < len(left) else NEVER
            across = rank(right[i][1] + left[j][1], NEVER)
            # of equal ranks the leftmost is merged first
            if across < grown and across <= other:
                return False
            if grown == other == NEVER:
                return True
            if grown <= other:
                i += 1
            else:
                j += 1

    def step(self, state: dict, byte: int) -> tuple[dict, tuple]:
        """Determinise one transition."""
        live, free, onward, ends, inner = [], self.borders, self.next.get, self.ends, self.inner
        for written, last, node in state[self.LIVE]:
            node = onward(node << 8 | byte)
            if node is None:
                continue
            token = ends[node]
            if token is not None:
                pair = last << 32 | token
                ok = free.get(pair)
                if ok is None:
                    ok = free[pair] = self.follows(last, token)
                if ok:
                    live.append(((*written, token), token, 0))
            if inner[node]:
                live.append((written, last, node))
        # what all live runs have written is certain
        out, n = live[0][0], 0
        if len(live) > 1:
            short, tall = min(x[0] for x in live), max(x[0] for x in live)
            while n < len(short) and short[n] == tall[n]:
                n += 1
            out = short[:n]
            if n:
                live = [(written[n:], last, node) for written, last, node in live]
        elif out:
            live = [((), *live[0][1:])]
        key = tuple(live)
        follow = self.states.get(key)
        if follow is None:
            follow = self.states[key] = {self.LIVE: key}
        state[byte] = found = (follow, out)
        return found

    def encode(self, piece: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        if len(self.states) > STATES:
            self.start()
        if len(self.borders) > BORDERS:
            self.borders.clear()
        state, ids = self.first, []
        for byte in piece:
            state, out = state.get(byte) or self.step(state, byte)
            if out:
                ids += out  # a list: in place
        for written, _, node in state[self.LIVE]:
            if not node:
                return (*ids, *written)
        raise ValueError("the vocabulary lacks single bytes")


class Encoder(dict):
    """Ids by chunk of text; unknown chunks are encoded when asked for."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        # white space by its Unicode property: the module's \s takes four control characters more
        self.cut = regex.compile(pattern.replace("\\s", "\\p{White_Space}").replace("\\S", "\\P{White_Space}")).findall
        self.transducer = Transducer(ranks)
        self.pieces: dict[str, tuple[int, ...]] = {}

    def piece(self, piece: str) -> tuple[int, ...]:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.transducer.encode(piece.encode())
            if len(piece) <= MEMO_CHARS:
                self.pieces[piece] = ids
        return ids

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        ids = tuple(chain.from_iterable(map(self.piece, self.cut(chunk))))
        if len(chunk) <= MEMO_CHARS:
            self[chunk] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        if len(self) > MEMO:
            self.clear()
        if len(self.pieces) > MEMO:
            self.pieces.clear()
        return list(chain.from_iterable(map(self.__getitem__, CHUNK.findall(text))))


class Decoder:
    """The incremental UTF-8 machine over tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.token = {i: token for token, i in ranks.items()}
        #: For each state (unfinished bytes): id -> (characters, next state).
        self.steps: dict[bytes, dict] = {}

    @staticmethod
    def read(unfinished: bytes, more: bytes) -> tuple[str, bytes]:
        """The characters that ``more`` completes, and what is unfinished after it."""
        out = []
        for byte in more:
            if unfinished:
                lead, n = unfinished[0], len(unfinished)
                # the second byte's range keeps out overlong forms, surrogates and what lies beyond U+10FFFF
                low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80) if n == 1 else 0x80
                high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, 0xBF) if n == 1 else 0xBF
                if low <= byte <= high:
                    unfinished += bytes((byte,))
                    if len(unfinished) == 2 + (lead >= 0xE0) + (lead >= 0xF0):
                        out.append(unfinished.decode())
                        unfinished = b""
                    continue
                out.append("�")
                unfinished = b""
            if byte < 0x80:
                out.append(chr(byte))
            elif 0xC2 <= byte <= 0xF4:
                unfinished = bytes((byte,))
            else:
                out.append("�")
        return "".join(out), unfinished

    def step(self, unfinished: bytes, i: int | None) -> tuple[str, bytes]:
        token = self.token.get(i)
        if token is None:
            return ("�" * (1 + bool(unfinished)), b"")
        return self.read(unfinished, token)

    def decode(self, ids) -> str:
        state, out = b"", []
        known = self.steps.setdefault(state, {})
        for i in ids:
            done = known.get(i)
            if done is None:
                done = known[i] = self.step(state, i)
            out.append(done[0])
            if done[1] is not state:
                state = done[1]
                known = self.steps.setdefault(state, {})
        if state:
            out.append("�")
        if len(self.steps) > 4096:
            self.steps.clear()
        return "".join(out)


_loaded: dict[tuple, Encoder | Decoder] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Ids by token of a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encoder(path: str, pattern: str) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Encoder(read_ranks(path), pattern)
        # the tables stay as long as the worker and the memos hold no cycles that matter: the collector need not walk them often
        gc.freeze()
        gc.set_threshold(200_000, 50, 50)
    return _loaded[path, pattern]


def decoder(path: str) -> Decoder:
    if (path,) not in _loaded:
        _loaded[path,] = Decoder(read_ranks(path))
    return _loaded[path,]


def _text_slices(b: pa.RecordBatch):
    """Row slices of about ``IDS`` ids."""
    size = np.cumsum(pc.fill_null(pc.list_value_length(b.column("ids")), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < b.num_rows:
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + IDS, "right")))
        yield b.slice(at, to - at)
        at = to


def _encoded(e: Encoder, b: pa.RecordBatch) -> tuple[list[list[int]], pa.Array]:
    ids = [e.encode(t) for t in pc.fill_null(b.column("text"), "").to_pylist()]
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    return ids, pa.ListArray.from_arrays(pa.array(ends), pa.array(np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]))))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), docs.schema[id_col].dataType.simpleString()


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids array<int>)`` of each row of ``docs``.

    ``vocabulary`` is the path of a file of base64 tokens and ranks, readable on
    every executor; ``pattern`` cuts the texts.
    """
    rows, kind = _texts(docs, id_col, text_col)

    def run(batches):
        e = encoder(vocabulary, pattern)
        for b in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("id"), _encoded(e, b)[1]], ["id", "ids"])

    return rows.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, ids, text)``: the text of each row's ids."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches):
        d = decoder(vocabulary)
        for b in batches:
            for part in _text_slices(b):
                text = [d.decode(ids.as_py() or ()) for ids in part.column("ids")]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(text, pa.string())], ["id", "ids", "text"])

    out = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(run, f"id {kind}, ids array<int>, text string")
    return out.withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids, text)``: ``encode`` and ``decode`` of its ids in one pass, for audits of whole tables."""
    rows, kind = _texts(docs, id_col, text_col)

    def run(batches):
        e, d = encoder(vocabulary, pattern), decoder(vocabulary)
        for b in slices(batches, "text"):
            ids, column = _encoded(e, b)
            yield pa.RecordBatch.from_arrays([b.column("id"), column, pa.array(map(d.decode, ids), pa.string())], ["id", "ids", "text"])

    return rows.mapInArrow(run, f"id {kind}, ids array<int>, text string").withColumnRenamed("id", id_col)

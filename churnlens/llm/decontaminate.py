"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers, names and units are replaced by the
typed placeholders ``<num>``, ``<name>`` and ``<unit>``, other words by their
lower case without outer punctuation.  Windows of ``window`` template tokens
are hash-joined between benchmark items and documents.  For every item,
document and alignment of the two, the values in the slots must be consistent:
one value of the item always meets the same value of the document.  So a
question that was given other numbers or names is found, and a chance meeting
of templates is not.  An inserted or deleted word moves the rest of a passage to
another alignment, so consistent alignments that lie at most ``drift`` words
from the next one are taken together.  A document is contaminated by an item
if the item's windows found in such a run make up ``share`` of all its windows.

Windows with fewer than ``literals`` words that are no placeholders would meet
by chance as templates; an item's are joined on their exact words instead, with
all windows of the documents (which words are names depends on the sentence
around them, so a copy's window may have more literals).  Where an
alignment's values are not consistent, its windows with equal values still
count, so that a verbatim copy with one changed value is found.  Items shorter
than a window are joined as one window of their own length; items with fewer
than ``literals`` words match nothing.  Items with equal words are one item, named
by the smallest id.  A table of ``BITS`` bits (512 KiB, whatever the size of
the benchmark) keeps documents' windows that cannot match out of the shuffle;
the join behind it is exact.

Defined results: null and empty texts match nothing; null document ids are
returned as they are found but cannot be told apart; repeated rows are found
alike and returned once; empty tables give an empty table; other columns are
not read, ``clean`` passes them on.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.common import key_kind, row_key, same_row, slices, stored, words

BITS = 1 << 22
_NUMBER = re.compile(r"[+\-]?[$€£]?\d+(?:[.,:/]\d+)*(?:st|nd|rd|th|%)?")
_QUANTITY = re.compile(r"([+\-]?\d+(?:[.,]\d+)*)([A-Za-z°µ]+)")
UNITS = frozenset("mm cm m km in ft yd mi mg g kg t oz lb ml l cl gal s sec min h hr hrs ms day days week weeks month months year years hour hours minute minutes second seconds meter meters metre metres kilometer kilometers mile miles gram grams kilogram kilograms liter liters litre litres inch inches foot feet pound pounds ounce ounces dollar dollars euro euros cent cents percent degree degrees mph kmh hz khz mhz ghz w kw v j kj cal kcal kb mb gb tb".split())
_AMBIGUOUS = frozenset("in m t s h l g w v j min day".split())
_STRIP = "\"'`“”‘’«»()[]{}<>.,;:!?…*_~|#&"


def token(word: str, first: bool) -> str:
    """Template token of a word; empty for mere punctuation. ``first``: it opens a sentence."""
    core = word.strip(_STRIP)
    if not core:
        return ""
    if _NUMBER.fullmatch(core):
        return "<num>"
    if (m := _QUANTITY.fullmatch(core)) and m.group(2).lower() in UNITS:
        return "<num><unit>"
    low = core.lower()
    if low in UNITS and low not in _AMBIGUOUS:
        return "<unit>"
    if not first and core[0].isupper() and core[1:] == core[1:].lower():
        return "<name>"
    return low


def _hash(known: list[str]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(w) for w in known), np.uint64, len(known))


class Templates:
    """Template tokens of the texts of a batch, punctuation left out."""

    def __init__(self, texts: pa.Array):
        codes, n, known = words(texts, lower=False)
        later, opening = [token(w, False) for w in known], [token(w, True) for w in known]
        self.names = np.array([*later, *opening, ""], object)
        self.cores = np.array([w.strip(_STRIP) for w in known] + [""], object)
        closes = np.array([w.rstrip("\"'”’»)]").endswith((".", "!", "?", ":")) for w in known] + [False], bool)
        owner = np.repeat(np.arange(len(n)), n)
        first = np.ones(len(codes), bool)
        if len(codes):
            first[1:] = closes[codes[:-1]] | (owner[1:] != owner[:-1])
        kind = codes + first * len(known)
        solid = np.array([bool(x) for x in self.names], bool)[kind] if len(codes) else np.zeros(0, bool)
        self.kind, self.code, self.owner = kind[solid], codes[solid], owner[solid]
        self.n = np.bincount(self.owner, minlength=len(n))
        hashes = _hash(self.names.tolist())
        literal = np.array([not x.startswith("<") for x in self.names], bool)
        self.hash, self.literal = hashes[self.kind], literal[self.kind]
        self.exact = _hash([c.lower() for c in self.cores])[self.code]
        self.start = np.concatenate([[0], np.cumsum(self.n)])

    def windows(self, size: int, literals: int, every: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions and hashes of the windows of a size; the third array tells templates from exact words.

        Exact are the windows with too few literals, and with ``every`` all windows once more.
        """
        m = len(self.hash) - size + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)

        def rolled(values: np.ndarray, seed: int) -> np.ndarray:
            h = np.full(m, seed, np.uint64)
            for k in range(size):
                h = h * np.uint64(0x9E3779B97F4A7C15) + values[k : k + m]
            return h ^ (h >> np.uint64(31))

        solid = np.zeros(m, np.int64)
        for k in range(size):
            solid += self.literal[k : k + m]
        own = self.owner[:m] == self.owner[size - 1 : size - 1 + m]
        rich = np.flatnonzero(own & (solid >= literals))
        poor = np.flatnonzero(own if every else own & (solid < literals))
        h = np.concatenate([rolled(self.hash, size)[rich], rolled(self.exact, size + (1 << 32))[poor]])
        return np.concatenate([rich, poor]), h, np.arange(len(h)) < len(rich)

    def text(self, at: int, size: int, rich: bool) -> str:
        if rich:
            return " ".join(self.names[self.kind[at : at + size]])
        return "= " + " ".join(c.lower() for c in self.cores[self.code[at : at + size]])

    def slots(self, at: int, size: int) -> list[str]:
        return [self.cores[c].lower() for c, lit in zip(self.code[at : at + size], self.literal[at : at + size], strict=True) if not lit]


WINDOWS = "id {id}, size int, pos long, total long, h long, template string, slots array<string>"


def _rows(t: Templates, ids: pa.Array, size: int, at: np.ndarray, h: np.ndarray, rich: np.ndarray) -> pa.RecordBatch:
    owner = t.owner[at]
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(owner, pa.int64())),
            pa.array(np.full(len(at), size), pa.int32()),
            pa.array(at - t.start[owner], pa.int64()),
            pa.array(t.n[owner] - size + 1, pa.int64()),
            pa.array(h.view(np.int64)),
            pa.array([t.text(i, size, r) for i, r in zip(at.tolist(), rich.tolist(), strict=True)], pa.string()),
            pa.array([t.slots(i, size) for i in at.tolist()], pa.list_(pa.string())),
        ],
        ["id", "size", "pos", "total", "h", "template", "slots"],
    )


def item_windows(benchmark: DataFrame, window: int, literals: int) -> DataFrame:
    """All windows of the items; an item shorter than a window has one, of its own length."""

    def run(batches):
        for b in slices(batches, "text"):
            t = Templates(b.column("text"))
            for size in range(literals, window + 1):
                at, h, rich = t.windows(size, literals, every=False)
                if size < window:
                    short = t.n[t.owner[at]] == size
                    at, h, rich = at[short], h[short], rich[short]
                if len(at):
                    yield _rows(t, b.column("id"), size, at, h, rich)

    same = benchmark.where("text is not null").groupBy(F.regexp_replace(F.trim("text"), r"[\x20\x09-\x0D]+", " ").alias("text")).agg(F.min("item_id").alias("id"))
    return same.select("id", "text").mapInArrow(run, WINDOWS.format(id=benchmark.schema["item_id"].dataType.simpleString()))


def _bits(items: DataFrame) -> tuple[bytes, list[int]]:
    """Bits of the items' window hashes, and the window sizes."""

    def packed(batches):
        seen = np.zeros(BITS, bool)
        sizes: set[int] = set()
        for b in batches:
            seen[(b.column("h").to_numpy().view(np.uint64) % np.uint64(BITS)).astype(np.int64)] = True
            sizes |= set(b.column("size").to_pylist())
        if sizes:
            yield pa.RecordBatch.from_pydict({"bits": pa.array([np.packbits(seen).tobytes()], pa.binary()), "sizes": pa.array([sorted(sizes)], pa.list_(pa.int32()))})

    def union(batches):
        total, sizes = np.zeros(BITS // 8, np.uint8), set()
        for b in batches:
            for x, s in zip(b.column("bits").to_pylist(), b.column("sizes").to_pylist(), strict=True):
                total |= np.frombuffer(x, np.uint8)
                sizes |= set(s)
        if sizes:
            yield pa.RecordBatch.from_pydict({"bits": pa.array([total.tobytes()], pa.binary()), "sizes": pa.array([sorted(sizes)], pa.list_(pa.int32()))})

    kind = "bits binary, sizes array<int>"
    row = items.select("h", "size").mapInArrow(packed, kind).coalesce(1).mapInArrow(union, kind).first()
    return (bytes(row["bits"]), list(row["sizes"])) if row else (b"", [])


def document_windows(docs: DataFrame, bits: bytes, sizes: list[int], literals: int, id_col: str, text_col: str) -> DataFrame:
    """The windows of the documents whose bit is set."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        seen = np.unpackbits(np.frombuffer(sent.value, np.uint8)).astype(bool)
        for b in slices(batches, "text"):
            t = Templates(b.column("text")) if sizes else None
            for size in sizes:
                at, h, rich = t.windows(size, literals, every=True)
                hit = seen[(h % np.uint64(BITS)).astype(np.int64)]
                at, h, rich = at[hit], h[hit], rich[hit]
                for k in range(0, len(at), 50_000):
                    yield _rows(t, b.column("id"), size, at[k : k + 50_000], h[k : k + 50_000], rich[k : k + 50_000])

    rows = docs.select(row_key(id_col, text_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, WINDOWS.format(id=key_kind(docs, id_col)))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **parameters) -> DataFrame:
    """``(doc id, item_id, windows, item_windows, same_slots)``: a row for each contaminated document and item.

    ``same_slots`` tells a verbatim passage from a re-parameterised one: the
    windows with equal values reach the share alone.  Documents that share an
    id (or have none) are held apart by their texts and have rows of their own.
    """
    found = _contaminated(docs, benchmark, id_col=id_col, **parameters)
    return found.select(F.col("id.id").alias(id_col), "item_id", "windows", "item_windows", "same_slots")


def _contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 8, literals: int = 4, share: float = 0.5, drift: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``contaminated``, with the row's key (see ``row_key``) as ``id``."""
    items = stored(item_windows(benchmark, window, literals), "decontamination-items")
    bits, sizes = _bits(items)
    found = document_windows(docs, bits, sizes, literals, id_col, text_col)
    left = items.select(F.col("id").alias("item_id"), "size", F.col("pos").alias("item_pos"), F.col("total").alias("item_windows"), "h", "template", F.col("slots").alias("item_slots"))
    right = found.select("id", "size", "pos", "h", "template", "slots")
    met = right.join(left, ["h", "size", "template"]).withColumn("shift", F.col("pos") - F.col("item_pos"))
    pairs = F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    same = F.forall(pairs, lambda p: p["a"] == p["b"])
    aligned = met.groupBy("id", "item_id", "shift", "item_windows").agg(F.collect_set("item_pos").alias("at"), F.collect_set(F.when(same, F.col("item_pos"))).alias("same_at"), F.flatten(F.collect_set(pairs)).alias("met"))
    aligned = aligned.withColumn("met", F.array_distinct("met"))
    consistent = F.size(F.array_distinct(F.transform("met", lambda p: p["a"]))) == F.size("met")
    valid = aligned.select("id", "item_id", "item_windows", "shift", F.when(consistent, F.col("at")).otherwise(F.col("same_at")).alias("at"), "same_at").where(F.size("at") > 0)
    by_shift = Window.partitionBy("id", "item_id").orderBy("shift")
    apart = F.coalesce((F.col("shift") - F.lag("shift").over(by_shift) > drift).cast("int"), F.lit(0))
    near = valid.withColumn("apart", apart).withColumn("run", F.sum("apart").over(by_shift))
    count = lambda at: F.size(F.array_distinct(F.flatten(F.collect_list(at))))
    runs = near.groupBy("id", "item_id", "item_windows", "run").agg(count(F.col("at")).alias("windows"), count(F.col("same_at")).alias("same_windows"))
    least = F.greatest(F.lit(1.0), F.col("item_windows") * F.lit(share))
    return (
        runs.where(F.col("windows") >= least)
        .groupBy("id", "item_id", "item_windows")
        .agg(F.max("windows").cast("long").alias("windows"), F.max(F.col("same_windows") >= least).alias("same_slots"))
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """The documents that no item contaminates, with all their columns; a document goes by its own text, whatever its id."""
    found = _contaminated(docs, benchmark, id_col=id_col, text_col=text_col, **parameters)
    bad = found.select(F.col("id.id").alias("bad id"), F.col("id.sign").alias("bad sign")).distinct()
    return docs.join(bad, same_row(id_col, text_col, F.col("`bad id`"), F.col("`bad sign`")), "left_anti")

"""SimHash near-dedup with pivot distance tables.

A text's fingerprint has 64 bits; a bit is 1 if it is set in over half of the
XXH64 hashes of the text's word shingles.  Two fingerprints link if they
differ in at most ``distance`` (4) bits; groups are the connected components.

Candidates come from a table of Hamming distances to reference fingerprints
(pivots).  The 64 bits are cut into blocks, ``distance + 3`` of them; pivot
(b, j) has random bits in block b and zeros elsewhere, and pivot 0 is zero.
The difference of the distances to pivot (b, j) and to pivot 0 depends on block
b alone, and two linked fingerprints agree in three whole blocks at least: they
have equal distance differences to all pivots of these blocks.  So an equality
join on the rows of the pivot table, once for each three of the blocks, misses
no link.  From the joined pairs those are discarded whose distances to any pivot
differ by more than ``distance`` (by the triangle inequality they cannot
link), and the survivors are verified by their own Hamming distance.

Equal fingerprints are one vertex.  To keep a large group of near copies from
making all its pairs, each bucket of the join is first linked to one of its
members only; components are formed, and the full join then takes only the
members outside the main component of a bucket, against the whole bucket.
Pairs inside one component are never needed, and no other pair is left out.

Defined results: null and empty texts and texts without words have
fingerprint 0, linked like any other; rows with equal ids keep rows of their
own; null ids form groups like others but never name one unless all are null;
an empty table gives an empty table; other columns are not read, and
``keep_one`` passes them on.
"""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import connected, row_key, same_row, slices, stored

PIVOTS_PER_BLOCK = 12
#: Blocks beyond ``distance``, which two linked fingerprints have in common at least.
SPARE = 3
#: Shingles hashed at a time.
STEP = 1 << 16


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp long)`` for each row: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, repeats included."""
    kind = docs.schema[id_col].dataType.simpleString()

    def one(text: str) -> int:
        import xxhash

        words = text.encode().split()  # bytes: at ASCII white space only
        if not words:
            return 0
        digest = xxhash.xxh64_intdigest
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        n = max(1, len(words) - shingle + 1)
        starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
        ends = ends[min(shingle, len(words)) - 1 :].tolist()
        ones = np.zeros(64, np.int64)
        for k in range(0, n, STEP):
            h = np.array([digest(line[s:e], 42) for s, e in zip(starts[k : k + STEP], ends[k : k + STEP], strict=True)], np.uint64)
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])

    def run(batches):
        for b in slices(batches, "text"):
            texts = pc.ascii_lower(pc.fill_null(b.column("text"), "")).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([one(t) for t in texts], pa.int64())], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivots(distance: int, per_block: int = PIVOTS_PER_BLOCK, seed: int = 20) -> list[list[int]]:
    """The pivots of each of the ``distance + SPARE`` blocks of bits."""
    blocks = distance + SPARE
    edges = [64 * b // blocks for b in range(blocks + 1)]
    rng = random.Random(seed)
    return [[rng.getrandbits(hi - lo) << lo for _ in range(per_block)] for lo, hi in itertools.pairwise(edges)]


def _to(fp: Column, pivot: int) -> Column:
    return F.bit_count(fp.bitwiseXOR(F.lit(_signed(pivot))))


def _keys(fp: Column, table: list[list[int]]) -> Column:
    """For each choice of ``SPARE`` blocks a hash of the row's pivot distances in them."""
    zero = _to(fp, 0)
    differences = [F.xxhash64(*[_to(fp, p) - zero for p in block]) for block in table]
    choices = list(itertools.combinations(range(len(table)), SPARE))
    # bound as a lambda variable: computed once, and the plan holds it once
    keys = F.transform(F.array(F.array(*differences)), lambda d: F.array(*[F.xxhash64(F.lit(k), *[d[i] for i in chosen]) for k, chosen in enumerate(choices)]))
    return F.get(keys, F.lit(0))


def _linked(a: Column, b: Column, table: list[list[int]], distance: int) -> Column:
    """Largest coordinate difference first, then the Hamming distance itself."""
    coordinates = [F.abs(_to(a, p) - _to(b, p)) for block in table for p in block[:2]]
    return (F.greatest(*coordinates) <= distance) & (F.bit_count(a.bitwiseXOR(b)) <= distance)


def links(distinct: DataFrame, distance: int = 4) -> DataFrame:
    """``(node, root)`` of all fingerprints ``distinct(fp long)`` that link to another."""
    table = pivots(distance)
    keyed = stored(distinct.select("fp", F.explode(_keys(F.col("fp"), table)).alias("key")), "simhash-keys")
    shared = keyed.groupBy("key").agg(F.min("fp").alias("center"), F.count("*").alias("n")).where("n > 1")
    members = stored(keyed.join(shared.select("key", "center"), "key"), "simhash-members")
    star = members.where((F.col("fp") != F.col("center")) & _linked(F.col("fp"), F.col("center"), table, distance)).select(F.col("fp").alias("a"), F.col("center").alias("b")).distinct()
    star = stored(star, "simhash-star")
    near = connected(star, "simhash-near")

    placed = members.select("key", "fp").join(near.withColumnRenamed("node", "fp"), "fp", "left").select("key", "fp", F.coalesce("root", "fp").alias("root"))
    sizes = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
    main = sizes.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots")).where("roots > 1").drop("roots")
    placed = stored(placed.join(main, "key"), "simhash-placed")
    minor = placed.where("root <> main").select("key", F.col("fp").alias("a"), F.col("root").alias("root_a"))
    every = placed.select("key", F.col("fp").alias("b"), F.col("root").alias("root_b"), "main")
    rest = minor.join(every, (minor["key"] == every["key"]) & (F.col("root_a") != F.col("root_b")) & ((F.col("root_b") == F.col("main")) | (F.col("a") < F.col("b"))) & _linked(F.col("a"), F.col("b"), table, distance))
    found = star.unionByName(rest.select("a", "b")).distinct()
    return connected(found, "simhash-all")


def _grouped(docs: DataFrame, shingle: int, distance: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, sign, fp, root, component)`` for each row; ``sign`` is a hash of the text, equal in a group's rows: ``root``."""
    keyed = docs.select(row_key(id_col, text_col).alias("id"), F.col(f"`{text_col}`").alias("text"))
    prints = fingerprints(keyed, shingle, "id", "text").select("id.id", "id.sign", "fp")
    prints = stored(prints, "simhash-prints")
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    roots = links(distinct.select("fp"), distance)
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component"))
    return prints.join(named.join(smallest, "root").select("fp", "root", "component"), "fp")


def simhash_groups(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp, component)`` for each row; the component is the smallest id reachable."""
    return _grouped(docs, shingle, distance, id_col, text_col).select(F.col("id").alias(id_col), "fp", "component")


def fingerprint_text(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, with all its columns: that with the smallest
    id (null last), then the smallest hash of the text; of rows with this id and
    text any one."""
    groups = _grouped(docs, shingle, distance, id_col, text_col)
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "sign")).alias("first"))
    kept = first.select(F.col("first.id").alias("kept id"), F.col("first.sign").alias("kept sign"))
    left = docs.join(kept, same_row(id_col, text_col, F.col("`kept id`"), F.col("`kept sign`")), "left_semi")
    # repeated rows of a document that stays
    again = groups.groupBy("id", "sign").agg(F.count("*").alias("n")).where("n > 1").select(F.col("id").alias("twice id"), F.col("sign").alias("twice sign"))
    twice = same_row(id_col, text_col, F.col("`twice id`"), F.col("`twice sign`"))
    single, several = left.join(again, twice, "left_anti"), left.join(again, twice, "left_semi")
    sign = F.xxhash64(F.col(f"`{text_col}`").cast("string"))
    one = several.groupBy(F.col(f"`{id_col}`"), sign).agg(F.any_value(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row"))
    return single.unionByName(one.select(*[F.col("row")[c].alias(c) for c in docs.columns]))

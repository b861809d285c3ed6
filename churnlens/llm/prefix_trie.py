"""The prefix trie of conversations by truncation peeling.

A node is a distinct sequence of first turns; its members are the conversations
that start with it.  Peeling begins at the greatest depth.  The nodes of a
depth are the truncated survivors of the depth below and the conversations that
end here, grouped by their sequence; each is complete then and written, loses
its last turn and survives into the depth above.  So members, leaves, children
and tokens saved are added up while the nodes are found, by plain sums that
Spark combines before it shuffles: a first turn that a third of all
conversations share costs no task more than another.

A sequence is known by a chain of digests (each of the one before and the turn's
role and text), so truncation is the removal of the last digest and no text
moves after the first grouping.  Equal conversations become one row first.  The
turns at which a conversation stands alone, up to its end, can meet nothing:
they are peeled in place, so one very long conversation adds no rounds; the
number of rounds is the greatest depth that two different conversations share.
Each round is written to the shared folder.

The conversations that end in a node are hashed in ascending order: a sort over
the whole table by (node, id) writes them as strings of at most ``CHUNK`` ids,
and one stream per node hashes these strings.

Defined results: null roles and texts count as empty, a null turn comes first,
turns that share a number are ordered by role and digest of the text (repeated
rows are turns of their own); rows without a conversation id belong to no
conversation; a conversation without turns ends in the root; an empty table
gives no node; a turn's role and text are never cut; other columns are not
read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from churnlens.llm.common import shared_dir, stored

#: Bytes of a digest, and the ids in one string of the hashing of ends.
DIGEST, CHUNK = 16, 8192
SPACE = "[\\x20\\x09-\\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def sequences(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv, turns array<struct<mark, words>>)``: the turns in order, as digests and word counts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    # the role's length stands in front, so that role and text cannot be read in two ways
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col(turn_col).alias("turn"), role.alias("role"), F.substring(F.unhex(F.sha2(whole, 256)), 1, DIGEST).alias("mark"), F.size(F.array_remove(F.split(text, SPACE), "")).alias("words")
    )
    rows = turns.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv"), turn.alias("t"))
    return rows.groupBy("conv").agg(F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["mark"].alias("mark"), t["words"].alias("words"))).alias("turns"))


def spliced(seqs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Give each conversation c the first h turns of conversation ``c - c % every`` for its own first h, h = crc32(c) % ``most``."""
    seqs = stored(seqs, "trie-turns")
    heads = seqs.where(F.col("conv") % every == 0).select(F.col("conv").alias("of"), F.slice("turns", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv").cast("string")) % most).cast("int")
    both = seqs.withColumn("of", F.col("conv") - F.col("conv") % every).join(heads, "of", "left")
    head = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), h))
    rest = F.slice("turns", h + 1, F.size("turns"))
    return both.select("conv", F.concat(head, rest).alias("turns"))


def _chains(batches):
    """Digests of all first parts of a sequence, and the words of its first turns added up."""
    for b in batches:
        paths, totals = [], []
        for marks, words in zip(b.column("marks").to_pylist(), b.column("words").to_pylist(), strict=True):
            key, path = b"", []
            for mark in marks:
                key = hashlib.blake2b(key + mark, digest_size=DIGEST).digest()
                path.append(key)
            paths.append(path)
            totals.append(np.cumsum(np.asarray(words, np.int64)))
        yield pa.RecordBatch.from_pydict({"conv": b.column("conv"), "path": pa.array(paths, pa.list_(pa.binary())), "total": pa.array(totals, pa.list_(pa.int64()))})


def _strings(batches):
    """Rows sorted by (key, conv) to strings of ids: ``(key, first, ids)``."""
    key, ids = None, []

    def flush():
        return pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "first": pa.array([ids[0]], pa.int64()), "ids": [",".join(map(str, ids))]})

    for b in batches:
        for k, conv in zip(b.column("key").to_pylist(), b.column("conv").to_pylist(), strict=True):
            if ids and (k != key or len(ids) == CHUNK):
                yield flush()
                ids = []
            key = k
            ids.append(conv)
    if ids:
        yield flush()


def _digests(batches):
    """Strings sorted by (key, first) to one digest for each key; memory does not grow with a key's strings."""
    key, running, done = None, None, []

    def flush():
        return pa.RecordBatch.from_pydict({"key": pa.array([k for k, _ in done], pa.binary()), "ends": [x for _, x in done]})

    for b in batches:
        for k, ids in zip(b.column("key").to_pylist(), b.column("ids").to_pylist(), strict=True):
            if running is not None and k == key:
                running.update(b"," + ids.encode())
                continue
            if running is not None:
                done.append((key, running.hexdigest()))
            key, running = k, hashlib.sha256(ids.encode())
        if len(done) > CHUNK:
            yield flush()
            done = []
    if running is not None:
        done.append((key, running.hexdigest()))
    if done:
        yield flush()


def end_digests(convs: DataFrame) -> DataFrame:
    """``(key, ends)``: SHA-256 of the ids of each key, ascending and comma-joined."""
    dealt = convs.select("key", "conv").repartitionByRange("key", "conv").sortWithinPartitions("key", "conv")
    strings = dealt.mapInArrow(_strings, "key binary, first long, ids string")
    return strings.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digests, "key binary, ends string")


def _at(path: Column, depth: Column) -> Column:
    """The digest of the first ``depth`` turns; the root's is empty."""
    return F.when(depth > 0, F.element_at(path, F.greatest(depth, F.lit(1)).cast("int"))).otherwise(F.lit(b""))


def _words(total: Column, depth: Column) -> Column:
    """The words of the first ``depth`` turns."""
    return F.when(depth > 0, F.element_at(total, F.greatest(depth, F.lit(1)).cast("int"))).otherwise(F.lit(0)).cast("long")


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """The nodes of the trie of ``seqs`` (``conv``, ``turns``; see ``sequences``), in the columns of ``NODE``."""
    spark = seqs.sparkSession
    chains = seqs.select("conv", F.transform("turns", lambda t: t["mark"]).alias("marks"), F.transform("turns", lambda t: t["words"]).alias("words"))
    chains = chains.mapInArrow(_chains, "conv long, path array<binary>, total array<long>")
    chains = stored(chains.withColumn("key", _at(F.col("path"), F.size("path"))), "trie-chains")

    ended = chains.groupBy("key").agg(F.count("*").alias("n"), F.min("conv").alias("conv"), F.first("path").alias("path"), F.first("total").alias("total"))
    ended = stored(ended.join(end_digests(chains), "key").withColumn("depth", F.size("path")), "trie-ended")
    prefixes = ended.select(F.col("key").alias("whole"), F.posexplode("path").alias("at", "prefix"))
    alone = prefixes.groupBy("prefix").agg(F.count("*").alias("c"), F.first("whole").alias("whole"), F.first("at").alias("at")).where("c = 1")
    alone = alone.groupBy(F.col("whole").alias("key")).agg((F.min("at") + 1).alias("alone"))
    ended = stored(ended.join(alone, "key", "left"), "trie-alone")

    # turns that no other sequence shares: complete nodes, peeled in place
    saved_below = lambda d: (F.col("n") - 1) * (_words(F.col("total"), F.col("depth")) - _words(F.col("total"), d - 1))
    tails = ended.where("alone is not null").withColumn("d", F.explode(F.sequence("alone", "depth")))
    tails = tails.select(
        F.col("conv").alias("conv_id"),
        F.col("d").cast("long").alias("depth"),
        F.when(F.col("d") == F.col("alone"), _at(F.col("path"), F.col("d") - 1)).alias("parent"),
        F.col("n").alias("n_convs"),
        (F.col("d") < F.col("depth")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        saved_below(F.col("d")).alias("saved_tokens"),
        F.when(F.col("d") == F.col("depth"), F.col("ends")).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"),
    )

    # where a sequence enters the rounds: above its lone turns, or at its end
    lone = F.col("alone").isNotNull()
    at = F.when(lone, F.col("alone") - 1).otherwise(F.col("depth"))
    entering = ended.select(
        at.alias("depth"),
        _at(F.col("path"), at).alias("key"),
        F.slice("path", F.lit(1), at).alias("path"),
        F.slice("total", F.lit(1), at).alias("total"),
        "n",
        "conv",
        lone.cast("long").alias("children"),
        lone.cast("long").alias("leaves"),
        F.when(lone, saved_below(F.col("alone"))).otherwise(F.lit(0)).cast("long").alias("saved"),
        F.when(~lone, F.col("ends")).alias("ends"),
    )
    place = f"{shared_dir(spark)}/llm/trie-entering-{uuid.uuid4().hex}"
    entering.write.partitionBy("depth").parquet(place)
    entering = spark.read.schema(entering.schema).parquet(place)
    deepest = entering.agg(F.max("depth")).first()[0]
    if deepest is None:
        return spark.createDataFrame([], NODE)

    levels = f"{shared_dir(spark)}/llm/trie-levels-{uuid.uuid4().hex}"
    below = None
    for depth in range(deepest, -1, -1):
        rows = entering.where(F.col("depth") == depth).drop("depth")
        if below is not None:
            here = F.lit(depth)
            rows = rows.unionByName(
                below.select(
                    F.col("parent").alias("key"),
                    F.slice("path", 1, depth).alias("path"),
                    F.slice("total", 1, depth).alias("total"),
                    F.col("n_convs").alias("n"),
                    F.col("conv_id").alias("conv"),
                    F.lit(1).cast("long").alias("children"),
                    F.col("n_leaves").alias("leaves"),
                    F.col("saved_tokens").alias("saved"),
                    F.lit(None).cast("string").alias("ends"),
                )
            )
        sums = rows.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")], F.min("conv").alias("conv"), F.max("ends").alias("ends"), F.first("path").alias("path"), F.first("total").alias("total"))
        here = F.lit(depth)
        last = _words(F.col("total"), here) - _words(F.col("total"), here - 1) if depth else F.lit(0)
        nodes = sums.select(
            "key",
            F.col("conv").alias("conv_id"),
            (_at(F.col("path"), here - 1) if depth else F.lit(None).cast("binary")).alias("parent"),
            F.col("n").alias("n_convs"),
            F.col("children").alias("n_children"),
            F.greatest("leaves", F.lit(1).cast("long")).alias("n_leaves"),
            (F.col("saved") + (F.col("n") - 1) * last).alias("saved_tokens"),
            F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
            "path",
            "total",
        )
        nodes.write.parquet(f"{levels}/depth={depth}")
        below = spark.read.schema(nodes.schema).parquet(f"{levels}/depth={depth}")

    found = spark.read.schema(StructType([*below.schema, StructField("depth", LongType())])).parquet(levels)
    columns = ["conv_id", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    names = found.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # a node whose parent has other members looks up the parent's name; in a lone tail it is the conversation itself
    top = found.select(*columns).unionByName(tails.where("parent is not null")).join(names, "parent", "left")
    inner = tails.where("parent is null").withColumn("parent_conv_id", F.col("conv_id"))
    order = [c.split(" ")[0] for c in NODE.split(", ")]
    return top.select(*order).unionByName(inner.select(*order))

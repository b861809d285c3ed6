"""Line dedup with content-defined line chunks, in DataFrame functions only.

Each text is cut at line ends.  A rolling hash over two line hashes gives each
line a value; a chunk ends after a line whose value is smaller than its
neighbours', so boundaries depend on near lines alone and shift with them, and
a chunk has at least two lines.  A line of ``passage_words`` words or more is a
chunk of its own, whatever stands around it.  Chunks of two lines or more, and
such long lines, are compared over the whole corpus: their hashes are counted,
and each repeated chunk is compared byte by byte with the first one (smallest
document id, then position) before it is removed.

Passages whose chunks differ at their edges, or that are too short to hold a
boundary, are found by adjacent line pairs: all pairs are counted and compared
like chunks, neighbouring later pairs of a document are joined to runs, and a
run of ``passage_words`` words or more is removed (empty lines have none).  The
first copies of its pairs may stand in different places.  Other lines stay; the
first copy of a line is in no later pair, so each different line is left at least once.

Only hashes are shuffled for all chunks; texts move for repeated chunks and
once by document.  A chunk that occurs very often is counted with partial
aggregates and joined against one row, which Spark can split.

Defined results: a null text stays null and an empty one empty; rows that
share an id are told apart by a hash of all their columns, and equal rows are
first or later ones together; rows without an id are compared like others; an
empty table gives an empty table; all other columns pass through unchanged
(names that the operator adds win over columns of the same name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: it is bound as a lambda variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _words(line: Column) -> Column:
    return F.char_length(line) - F.char_length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def chunks(text: Column, passage_words: int = 50) -> Column:
    """``array<struct<idx, n_lines, long, text>>``: the chunks of a text in order; ``idx`` is the first line."""
    return _let(F.split(text, "\n", -1), lambda lines: _chunks(lines, passage_words))


def _chunks(lines: Column, passage_words: int) -> Column:
    def cut(lines: Column) -> Column:
        marked = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("h"), (_words(x) >= passage_words).alias("long")))
        return _let(marked, lambda m: bounded(lines, m))

    def bounded(lines: Column, m: Column) -> Column:
        n = F.size(lines)
        # rolling hash of lines i - 1 and i; none for the first line
        rolled = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i > 0, F.xxhash64(F.get(m, i - 1)["h"], F.get(m, i)["h"])))
        return _let(rolled, lambda r: started(lines, m, r, n))

    def started(lines: Column, m: Column, r: Column, n: Column) -> Column:
        def starts(i: Column) -> Column:
            """Does a chunk start at line i?"""
            least = (F.get(r, i - 1) < F.get(r, i - 2)) & (F.get(r, i - 1) < F.get(r, i))
            return (i == 0) | F.get(m, i)["long"] | F.get(m, i - 1)["long"] | ((i >= 3) & (i <= n - 2) & F.coalesce(least, F.lit(False)))

        return _let(F.filter(F.sequence(F.lit(0), n - 1), starts), lambda s: pieces(lines, m, s, n))

    def pieces(lines: Column, m: Column, s: Column, n: Column) -> Column:
        def piece(k: Column) -> Column:
            first = F.get(s, k)
            size = F.coalesce(F.get(s, k + 1), n) - first
            return F.struct(
                first.alias("idx"),
                size.alias("n_lines"),
                ((size == 1) & F.get(m, first)["long"]).alias("long"),
                F.array_join(F.slice(lines, first + 1, size), "\n").alias("text"),
            )

        return F.transform(F.sequence(F.lit(0), F.size(s) - 1), piece)

    return cut(lines)


def _units(text: Column, passage_words: int) -> Column:
    """``array<struct<idx, n_lines, pair, text>>``: the chunks that are compared, and the adjacent line pairs."""

    def both(lines: Column) -> Column:
        eligible = F.filter(_chunks(lines, passage_words), lambda c: (c["n_lines"] >= 2) | c["long"])
        own = F.transform(eligible, lambda c: F.struct(c["idx"].alias("idx"), c["n_lines"].alias("n_lines"), F.lit(False).alias("pair"), c["text"].alias("text")))
        firsts = F.when(F.size(lines) > 1, F.sequence(F.lit(0), F.size(lines) - 2)).otherwise(F.array().cast("array<int>"))
        pairs = F.transform(firsts, lambda i: F.struct(i.alias("idx"), F.lit(2).alias("n_lines"), F.lit(True).alias("pair"), F.concat(F.get(lines, i), F.lit("\n"), F.get(lines, i + 1)).alias("text")))
        return F.concat(own, pairs)

    return _let(F.split(text, "\n", -1), both)


def line_dedup(docs: DataFrame, passage_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated chunks and runs removed from the text.

    Adds ``n_chunks_removed``, of chunks and of runs, which may overlap, and
    ``n_lines_removed``; both are 0 where nothing was removed.
    """
    added = ("n_chunks_removed", "n_lines_removed")
    docs = docs.drop(*added)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole.alias("row"), F.col(f"`{id_col}`").alias("key"))
    sign = F.xxhash64("row")
    text = F.col("row")[text_col]

    # hashes alone: which chunks and pairs occur more than once, and which one is the first
    seen = rows.where(text.isNotNull()).select("key", sign.alias("sign"), F.inline(_units(text, passage_words)))
    seen = seen.select("key", "sign", "idx", "n_lines", "pair", F.xxhash64("text").alias("h"), F.octet_length("text").alias("bytes"))
    place = F.struct("key", "sign", "idx")
    repeated = seen.groupBy("h", "bytes", "pair").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    wanted = seen.join(repeated, ["h", "bytes", "pair"]).groupBy("key", "sign").agg(F.collect_set(F.struct("idx", "n_lines", "pair", (place == F.col("first")).alias("is_first"))).alias("wanted"))

    # byte comparison of each later chunk or pair with the first
    of_row = lambda key, row: F.col("key").eqNullSafe(F.col(key)) & (sign == F.col(row))
    by_key = rows.join(wanted.select(F.col("key").alias("wanted_key"), F.col("sign").alias("wanted_sign"), "wanted"), of_row("wanted_key", "wanted_sign"))
    cut = lambda lines, w: F.struct(w["idx"].alias("idx"), w["n_lines"].alias("n_lines"), w["pair"].alias("pair"), w["is_first"].alias("is_first"), F.array_join(F.slice(lines, w["idx"] + 1, w["n_lines"]), "\n").alias("text"))
    named = _let(F.split(text, "\n", -1), lambda lines: F.transform("wanted", lambda w: cut(lines, w)))
    texts = by_key.select("key", F.col("wanted_sign").alias("sign"), F.inline(named)).withColumn("h", F.xxhash64("text"))
    firsts = texts.where("is_first").groupBy("h", F.col("pair").alias("first_pair"), F.col("text").alias("first_text")).agg(F.lit(1).alias("one"))
    later = texts.where("not is_first").drop("is_first")
    same = later.join(firsts, (later["h"] == firsts["h"]) & (later["pair"] == firsts["first_pair"]) & (later["text"] == firsts["first_text"]))
    same = same.select("key", "sign", "idx", "n_lines", "pair", F.transform(F.when(F.col("pair"), F.split("text", "\n", -1)), lambda x: F.when(x == "", 0).otherwise(_words(x))).alias("words")).distinct()

    # neighbouring later pairs make a run: line number less rank is the same for all of them
    by_line = Window.partitionBy("key", "sign", "pair").orderBy("idx")
    runs = same.withColumn("run", F.when(F.col("pair"), F.col("idx") - F.row_number().over(by_line)).otherwise(F.col("idx"))).groupBy("key", "sign", "pair", "run")
    runs = runs.agg(F.min("idx").alias("idx"), F.when(F.col("pair"), F.count("*").cast("int") + 1).otherwise(F.max("n_lines")).alias("n_lines"), (F.sum(F.get("words", F.lit(0))) + F.max_by(F.get("words", F.lit(1)), "idx")).alias("words"))
    removed = runs.where(~F.col("pair") | (F.col("words") >= passage_words)).groupBy(F.col("key").alias("removed_key"), F.col("sign").alias("removed_sign")).agg(F.collect_set(F.struct("idx", "n_lines", "pair")).alias("removed"))

    out = rows.join(removed, of_row("removed_key", "removed_sign"), "left")
    gone = F.coalesce("removed", F.array().cast("array<struct<idx:int,n_lines:int,pair:boolean>>"))
    out = out.select("row", gone.alias("gone"))
    out = out.withColumn("lost", F.array_distinct(F.flatten(F.transform("gone", lambda g: F.sequence(g["idx"], g["idx"] + g["n_lines"] - 1)))))
    kept = lambda lines: F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("lost")), lambda i: F.get(lines, i))
    new = F.when(F.size("gone") == 0, text).otherwise(F.array_join(_let(F.split(text, "\n", -1), kept), "\n"))
    return out.select(
        *[new.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns],
        F.size("gone").cast("long").alias("n_chunks_removed"),
        F.size("lost").cast("long").alias("n_lines_removed"),
    )

"""Source divergence audit: how far the term use of each source of a language
lies from that of every other source, and which terms make a source stand out.

A ``CountVectorizer`` with ``minDF`` and the largest integer ``vocabSize`` is
fitted on the terms of each language and turns stretches of the documents of a
group into exact sparse vectors (terms carry their language in front, so small
languages can share a fit).  A stretch is a few rows with weights, each term once
in a row, so repeats of a term are not vectorised one by one; for the fit a term
of a stretch stands in as many rows as it has documents there, ``minDF`` at most.
The weighted vectors are added up by group, entry by entry, and the group sums
are compared pair by pair over the terms that occur: terms that a pair lacks on
one side or both are counted, not visited.

For a group of N kept tokens and V kept terms in its language a term of count
c gets ``p = 1 + floor(scale * (c + 1) / (N + V))``; a pair adds
``floor((p - q)^2 / q)`` over all kept terms.  All of it is integer or decimal
arithmetic.  A pair's value starts as if every term were missing on both sides
and is then corrected by the terms that occur: those of one side counted by
their share, those of both by a join of the entries.

The vocabulary passes through the driver (that is what the fit does), so no fit
may keep more than about ``part_terms`` terms: small languages share one and the
terms of a large language are dealt by hash over several.  Their number is known
from the documents of those terms whose hash makes them probes; terms of too few
documents never leave the executors and do not count.  Only the languages with
their numbers of kept probes reach the driver.  All fits write to the same tables,
so later plans have the same size however many there are.

Defined results: null texts, languages and sources count as empty; an empty
text has no terms; repeated rows are documents of their own (also for
``minDF``); a group without terms still gets a value against every other group;
ties of a value are ranked by the item's UTF-8 bytes; an empty table gives an
empty table; other columns are not read, so their names cannot clash; very
long texts are one row each and never cut.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.common import Growing, shared_dir, shuffles_removed, slices, stored

#: Bytes as a text is read: A-Z become lower case, what stands in no term (ASCII but letters) becomes a space.
#: All bytes of a character beyond ASCII lie above 0x7F, so terms can be found in UTF-8 as it is.
READ = np.array([b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b > 0x7F else 0x20 for b in range(256)], np.uint8)
#: Parts a language and its term; no term holds it.
MARK = "\x00"
#: A word without the mark, so that of no term.
NO_WORD = ""
#: Text whose terms are put together before they are vectors.
STRETCH_BYTES = 4 << 20
#: Folders of the terms, by a hash of the language.
BUCKETS = 16
#: One of so many distinct terms is a probe by its hash; the number of those kept tells that of all.
PROBES = 256


def _lists(row: np.ndarray, rows: int, values: pa.Array) -> pa.ListArray:
    """The values of each of ``rows`` rows; ``row``, the place of each value, ascends."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)), pa.int32()), values)


def _counted(key: np.ndarray, n: np.ndarray | None, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct ``key``, split by ``width``, and the sum of ``n`` (none: 1 each) of each."""
    if n is None:
        key, total = np.unique(key, return_counts=True)
        return *np.divmod(key, width), total
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return *np.divmod(key[first], width), np.add.reduceat(n, first) if len(first) else n


def _layers(own: np.ndarray, code: np.ndarray, keep: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``code``, one for each layer and owner: the row of each code, the codes, the owner and the layer of each row."""
    layer = np.concatenate([np.full(np.count_nonzero(k), i) for i, k in enumerate(keep)])
    owner, codes = np.concatenate([own[k] for k in keep]), np.concatenate([code[k] for k in keep])
    width = int(own.max()) + 1 if len(own) else 1
    rows, row = np.unique(layer * width + owner, return_inverse=True)
    return row, codes, rows % width, rows // width


def _codes(names: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = names.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _read_terms(min_docs: int):
    """Arrow batches (lang, source, text) to the rows of ``term_rows``."""

    def run(batches):
        for b in slices(batches, "text", STRETCH_BYTES):
            text = pc.fill_null(b.column("text"), "")
            rows = len(text)
            ends = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + rows + 1]
            read = READ[np.frombuffer(text.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]]
            plain = pa.Array.from_buffers(pa.string(), rows, [None, pa.py_buffer(np.ascontiguousarray(ends - ends[0])), pa.py_buffer(read)])
            parts = pc.ascii_split_whitespace(plain)
            term, terms = _codes(parts.flatten())
            owner = np.repeat(np.arange(rows), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
            real = (pc.binary_length(terms).to_numpy(zero_copy_only=False) > 0)[term]
            term, owner, many = term[real], owner[real], max(1, len(terms))
            probe = np.array([zlib.crc32(w) % PROBES == 0 for w in terms.cast(pa.binary()).to_pylist()], bool)

            lang, langs = _codes(b.column("lang"))
            source, sources = _codes(b.column("source"))
            groups, group = np.unique(lang * len(sources) + source, return_inverse=True)
            doc, code, n = _counted(owner * many + term, None, many)

            def marked(of_lang, code, langs=langs, terms=terms):
                return pc.binary_join_element_wise(langs.take(pa.array(of_lang)), terms.take(pa.array(code)), MARK)

            # a term of d documents stands in d rows, but in no more than tell whether it is kept
            own, t, d = _counted(lang[doc] * many + code, None, many)
            row, t, own, _ = _layers(own, t, [d > i for i in range(min(min_docs, int(d.max(initial=0))))] or [d > 0])
            seen, probes = marked(own[row], t), probe[t] if len(t) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays(
                [langs.take(pa.array(own)), pa.nulls(len(own), pa.string()), pa.nulls(len(own), pa.int64()), pa.nulls(len(own), pa.list_(pa.string())), _lists(row, len(own), seen), _lists(row[probes], len(own), seen.filter(pa.array(probes)))],
                _ROWS,
            )

            # a term's number in a group is the sum of the weights of the rows with it; every group has a row
            own, t, n = _counted(group[doc] * many + code, n, many)
            row, t, own, bit = _layers(own, t, [n >> i & 1 == 1 for i in range(int(n.max(initial=1)).bit_length())])
            bare = np.setdiff1d(np.arange(len(groups)), own)
            at, weight = np.concatenate([own, bare]), np.concatenate([1 << bit, np.ones(len(bare), np.int64)])
            of_lang, of_source = np.divmod(groups[at], len(sources))
            yield pa.RecordBatch.from_arrays(
                [langs.take(pa.array(of_lang)), sources.take(pa.array(of_source)), pa.array(weight), _lists(row, len(at), marked(of_lang[row], t)), pa.nulls(len(at), pa.list_(pa.string())), pa.nulls(len(at), pa.list_(pa.string()))],
                _ROWS,
            )

    return run


_ROWS = ["lang", "source", "weight", "terms", "seen", "probes"]


def term_rows(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = 3) -> DataFrame:
    """``(lang, source, weight, terms, seen, probes)``: the marked terms of stretches of documents, once in a row.

    Rows with ``terms`` are for the sums: a term occurs in a group as often as the
    weights of the rows with it say, and every group has a row.  Rows with
    ``seen`` are for the vocabulary: of the documents of a stretch with a term,
    ``min_docs`` at most are rows, so that a term is in ``min_docs`` rows if and only
    if it is in as many documents.  ``probes`` are the probes among ``seen``.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    # texts of one group meet, so that their terms are put together; a large group is dealt over many tasks
    rows = rows.hint("rebalance", "lang", "source")
    return rows.mapInArrow(_read_terms(max(1, min_docs)), "lang string, source string, weight long, terms array<string>, seen array<string>, probes array<string>")


def _add_vectors(batches):
    """Arrow batches (source, weight, i, n) of sparse vectors to their weighted sums by source and entry."""
    for b in batches:
        source = b.column("source").dictionary_encode()
        size = pc.list_value_length(b.column("i")).to_numpy(zero_copy_only=False)
        code = np.repeat(source.indices.to_numpy(zero_copy_only=False).astype(np.int64), size)
        entry, place = np.unique(code << 32 | b.column("i").flatten().to_numpy(zero_copy_only=False), return_inverse=True)
        n = b.column("n").flatten().to_numpy(zero_copy_only=False) * np.repeat(b.column("weight").to_numpy(), size)
        total = np.bincount(place, n, len(entry))
        yield pa.RecordBatch.from_arrays(
            [source.dictionary.take(pa.array(entry >> 32)), pa.array((entry & 0xFFFFFFFF).astype(np.int32)), pa.array(total.astype(np.int64))], ["source", "i", "n"]
        )


def _by_bucket(rows: DataFrame) -> DataFrame:
    """``rows`` written in folders by a hash of the language: a fit reads those of its languages only."""
    place = f"{shared_dir(rows.sparkSession)}/llm/divergence-rows-{uuid.uuid4().hex}"
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("lang"), F.lit(BUCKETS)).cast("int"))
    with shuffles_removed(rows.sparkSession):
        rows.write.partitionBy("bucket").parquet(place)
    return rows.sparkSession.read.schema(rows.schema).parquet(place)


def _parts(rows: DataFrame, part_terms: int, min_docs: int = 1) -> list[tuple[list[tuple[int, str]], int, int]]:
    """The fits: ``([(bucket, language)], n, i)``, the i-th of n hash parts of the terms of some languages.

    Small languages share a fit and large ones are dealt by hash, so that a fit
    has about ``part_terms`` terms of ``min_docs`` documents at most, by the number
    of probes.
    """
    probes = rows.where("probes is not null").select("bucket", "lang", F.explode_outer("probes").alias("t")).groupBy("bucket", "lang", "t").agg(F.count("t").alias("docs"))
    found = probes.groupBy("bucket", "lang").agg(F.count_if(F.col("t").isNotNull() & (F.col("docs") >= min_docs)).alias("n")).orderBy("lang").collect()
    fits, own, held = [], [], 0
    for lang, size in [((r["bucket"], r["lang"]), int(1.1 * PROBES * r["n"])) for r in found]:
        if size > part_terms:
            n = -(-size // part_terms)
            fits += [([lang], n, i) for i in range(n)]
            continue
        if own and held + size > part_terms:
            fits.append((own, 1, 0))
            own, held = [], 0
        own, held = [*own, lang], held + size
    return [*fits, (own, 1, 0)] if own else fits


def _hashed_to(n: int, i: int):
    # a lambda with defaults would count as one of three parameters
    return lambda t: F.pmod(F.xxhash64(t), F.lit(n)) == i


def group_sums(rows: DataFrame, min_docs: int, part_terms: int) -> tuple[DataFrame, DataFrame]:
    """The kept terms ``(id, lang, term)`` and their sums ``(id, source, n)``."""
    spark = rows.sparkSession
    none = spark.createDataFrame([], "id long, lang string, term string, source string, n long")
    vocabulary, sums = Growing(none.select("id", "lang", "term"), "divergence-terms"), Growing(none.select("id", "source", "n"), "divergence-sums")
    for part, (langs, n, i) in enumerate(_parts(rows, part_terms, min_docs)):
        mine = rows.where(F.col("bucket").isin([b for b, _ in langs]) & F.col("lang").isin([x for _, x in langs]))
        seen, counted = (mine.where(F.col(c).isNotNull()).select("source", "weight", (F.filter(c, _hashed_to(n, i)) if n > 1 else F.col(c)).alias("terms")) for c in ("seen", "terms"))
        # the fit refuses an empty vocabulary, so it always finds one word that is no term
        filler = spark.range(max(1, min_docs)).select(F.array(F.lit(NO_WORD)).alias("terms"))
        model = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_docs), vocabSize=2**31 - 1).fit(seen.select("terms").unionByName(filler))
        place = f"{shared_dir(spark)}/llm/vocabulary-{uuid.uuid4().hex}"
        model.write().save(place)
        number = lambda c, part=part: (F.lit(part).cast("long") * 2**31 + c).alias("id")
        words = spark.read.parquet(f"{place}/data").select(F.posexplode("vocabulary").alias("i", "word")).where(F.col("word") != NO_WORD)
        words = words.withColumn("term", F.substring_index("word", MARK, -1))
        words = words.select(number(F.col("i")), F.substr("word", F.lit(1), F.char_length("word") - F.char_length("term") - 1).alias("lang"), "term")
        # the sparse vectors are added entry by entry: a dense sum of a group would be as long as the vocabulary
        vector = F.unwrap_udt("vector")
        entries = model.transform(counted).select("source", "weight", vector["indices"].alias("i"), vector["values"].alias("n"))
        added = entries.mapInArrow(_add_vectors, "source string, i int, n long")
        added = added.groupBy("source", "i").agg(F.sum("n").alias("n")).select(number(F.col("i")), "source", "n")
        vocabulary.add(words)
        sums.add(added)
    return vocabulary.table(), sums.table()


def share(count: Column, tokens: Column, terms: Column, scale: int) -> Column:
    """``1 + floor(scale * (count + 1) / (tokens + terms))``, exact; in decimals only where the product needs more than a long."""
    whole = F.lit(scale).cast("decimal(19,0)") * (count + 1).cast("decimal(19,0)")
    wide = F.call_function("div", whole, (tokens + terms).cast("decimal(38,0)"))
    short = F.call_function("div", F.lit(scale).cast("long") * (count + 1).cast("long"), (tokens + terms).cast("long"))
    return F.when(tokens + terms <= 0, 0).when(count < (2**63 - 1) // scale, short).otherwise(wide).cast("long") + 1


def distance(p: Column, q: Column) -> Column:
    """``floor((p - q) * (p - q) / q)``, exact: both are at most ``scale + 1``, so the product fits."""
    return F.call_function("div", (p - q) * (p - q), q)


def divergence(
    docs: DataFrame,
    min_docs: int = 3,
    top: int = 200,
    scale: int = 1_000_000_000,
    part_terms: int = 500_000,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of every (lang, source) group.

    Part ``pair``: every other source of the language, by value.  Part
    ``term``: the ``top`` terms that the group uses more than its language.
    """
    rows = _by_bucket(term_rows(docs, text_col, lang_col, source_col, min_docs))
    vocabulary, sums = group_sums(rows, min_docs, part_terms)
    sums = stored(sums.join(vocabulary, "id"), "divergence-named")

    # one row a group: its kept terms and tokens, and the share of a term that it lacks
    sizes = vocabulary.groupBy("lang").agg(F.count("*").alias("v"))
    tokens = sums.groupBy("lang", "source").agg(F.sum("n").alias("tokens"))
    groups = rows.where("weight is not null").select("lang", "source").distinct().join(sizes, "lang", "left").join(tokens, ["lang", "source"], "left").fillna(0, ["v", "tokens"])
    groups = stored(groups.withColumn("base", share(F.lit(0), F.col("tokens"), F.col("v"), scale)), "divergence-groups")
    of_a = groups.select("lang", F.col("source").alias("a"), "v", F.col("base").alias("base_a"))
    of_b = groups.select("lang", F.col("source").alias("b"), F.col("base").alias("base_b"))
    pairs = stored(of_a.join(of_b, "lang").where("a <> b"), "divergence-pairs")
    named = groups.select("lang", "source", "v", "tokens", "base")
    rated = sums.join(named, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("tokens"), F.col("v"), scale))
    rated = stored(rated.drop("tokens"), "divergence-rated")  # read five times

    # as if no term occurred in either source, then what the terms of a, of b and of both change
    p, q, base_a, base_b = (F.col(c) for c in ("p", "q", "base_a", "base_b"))
    bare = distance(base_a, base_b)
    counted = rated.groupBy("lang", "source", "p").agg(F.count("*").alias("m"))
    one = counted.join(pairs.select("lang", F.col("a").alias("source"), "b", "base_a", "base_b"), ["lang", "source"])
    one = one.select("lang", F.col("source").alias("a"), "b", (F.col("m") * (distance(p, base_b) - bare)).alias("value"))
    two = counted.withColumnRenamed("p", "q").join(pairs.select("lang", "a", F.col("b").alias("source"), "base_a", "base_b"), ["lang", "source"])
    two = two.select("lang", "a", F.col("source").alias("b"), (F.col("m") * (distance(base_a, q) - bare)).alias("value"))
    left = rated.select("id", "lang", F.col("source").alias("a"), "p", F.col("base").alias("base_a"))
    right = rated.select("id", F.col("source").alias("b"), F.col("p").alias("q"), F.col("base").alias("base_b"))
    both = left.join(right, "id").where("a <> b").groupBy("lang", "a", "b").agg(F.sum(distance(p, q) - distance(p, base_b) - distance(base_a, q) + bare).alias("value"))
    none = pairs.select("lang", "a", "b", (F.col("v") * bare).alias("value"))
    values = none.unionByName(one).unionByName(two).unionByName(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    pair = values.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value")

    of_lang = groups.groupBy("lang").agg(F.sum("tokens").alias("all_tokens"), F.max("v").alias("v"))
    whole = sums.groupBy("id", "lang").agg(F.sum("n").alias("all_n")).join(of_lang, "lang")
    whole = whole.select("id", share(F.col("all_n"), F.col("all_tokens"), F.col("v"), scale).alias("q"))
    term = rated.select("id", "lang", "source", "term", "p").join(whole, "id").where("p > q")
    term = term.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(p, q).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = F.row_number().over(order)
    return pair.withColumn("rank", ranked).unionByName(term.withColumn("rank", ranked).where(F.col("rank") <= top))

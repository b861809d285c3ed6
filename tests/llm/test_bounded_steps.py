"""What the driver, the executors and the disks hold does not grow with the number of steps."""

import os
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from churnlens.llm import common, divergence, quality

WORD = lambda i: "w" + "".join(chr(97 + int(c)) for c in f"{i:05d}")


@pytest.fixture(scope="module")
def rare_and_common(spark):
    """1,500 terms of three documents each and 15,000 of one."""
    rows = [(" ".join([*map(WORD, range(1500)), *map(WORD, range(5000 * (d + 1), 5000 * (d + 2)))]), "en", "ab"[d % 2]) for d in range(3)]
    return spark.createDataFrame(rows, "text string, lang string, source string")


def test_terms_of_too_few_documents_make_no_fits(rare_and_common):
    rows = divergence._by_bucket(divergence.term_rows(rare_and_common))
    assert len(divergence._parts(rows, 4000, 1)) > 2
    assert len(divergence._parts(rows, 4000, 3)) == 1


def test_plans_do_not_grow_with_the_fits(rare_and_common):
    rows = divergence._by_bucket(divergence.term_rows(rare_and_common))
    assert len(divergence._parts(rows, 500, 3)) > 1
    tables = [divergence.group_sums(rows, 3, size) for size in (100_000, 500)]
    for few, many in zip(*tables, strict=True):
        assert few.count() == many.count() > 0
        assert many._jdf.queryExecution().executedPlan().toString().count("Scan") == 1


def test_stored_tables_leave_no_shuffle_files_and_the_setting_stays(spark, monkeypatch):
    seen = []
    plain = common.shuffles_removed

    def watched(session):
        seen.append(session.conf.get(common.CLEANUP))
        return plain(session)

    monkeypatch.setattr(common, "shuffles_removed", watched)
    before = spark.conf.get(common.CLEANUP)
    folder = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {str(f) for f in folder.getAllFiles().mkString("\n").split("\n") if os.path.basename(str(f)).startswith("shuffle_")}
    old = files()
    common.stored(spark.range(1000).repartition(3, "id"), "bounded")
    for _ in range(50):  # they are removed behind the query's back
        if files() <= old:
            break
        time.sleep(0.1)
    assert files() <= old
    assert seen == [before] and spark.conf.get(common.CLEANUP) == before


def test_a_quality_worker_needs_little_memory():
    rng = np.random.default_rng(5)
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(map(WORD, rng.integers(0, 100_000, 300).tolist())) for _ in range(3000)]})
    whole = quality.features(batch.column("text"))
    tracemalloc.start()
    n, most = 0, 0
    for b in common.slices(iter([batch]), "text", quality.STEP_BYTES):
        tracemalloc.reset_peak()
        n += len(quality.features(b.column("text"))[0])
        most = max(most, tracemalloc.get_traced_memory()[1])
    tracemalloc.stop()
    assert n == len(whole[0])
    assert most < 40e6


def test_terms_of_a_group_are_put_together_before_the_vectors(spark):
    """Entries that the vectorizer reads do not grow with the repeats of a term, and tell its number and its documents."""
    import collections

    docs = [("aa aa bb " + "cc" * (i < 2), "en", "x") for i in range(200)] + [("aa", "en", None), ("", "en", "y"), ("aa dd dd", "de", "x")]
    df = spark.createDataFrame(docs, "text string, lang string, source string").coalesce(1)
    rows = divergence.term_rows(df, min_docs=3).collect()
    n, seen, groups = collections.Counter(), collections.Counter(), set()
    for r in rows:
        if r.weight is not None:
            groups.add((r.lang, r.source))
            assert len(set(r.terms)) == len(r.terms)
            n.update({(r.source, t): r.weight for t in r.terms})
        else:
            seen.update(r.seen)
    term = lambda lang, t: lang + divergence.MARK + t
    assert n == {("x", term("en", "aa")): 400, ("x", term("en", "bb")): 200, ("x", term("en", "cc")): 2, ("", term("en", "aa")): 1, ("x", term("de", "aa")): 1, ("x", term("de", "dd")): 2}
    assert seen == {term("en", "aa"): 3, term("en", "bb"): 3, term("en", "cc"): 2, term("de", "aa"): 1, term("de", "dd"): 1}
    assert groups == {("en", "x"), ("en", ""), ("en", "y"), ("de", "x")}
    assert sum(len(r.terms or ()) + len(r.seen or ()) for r in rows) < 30


def test_shares_are_exact_beside_the_bound_of_a_long(spark):
    from pyspark.sql import functions as F

    scale = 1_000_000_000
    counts = [0, 7, (2**63 - 1) // scale - 1, (2**63 - 1) // scale, (2**63 - 1) // scale + 1]
    df = spark.createDataFrame([(c, t, 3) for c in counts for t in (0, 11, 10**10)] + [(0, 0, 0)], "n long, tokens long, v long")
    got = df.select("n", "tokens", "v", divergence.share(F.col("n"), F.col("tokens"), F.col("v"), scale).alias("p")).collect()
    assert all(r.p == 1 + (scale * (r.n + 1) // (r.tokens + r.v) if r.tokens + r.v else 0) for r in got) and len(got) == 16


@pytest.mark.parametrize("histogram, most", [({22: 23, 43: 28}, 40), ({45: 244, 20: 227}, 320), ({12: 108, 23: 293, 51: 10}, 180), ({39: 285, 28: 231}, 420)])
def test_few_lengths_are_not_rounded_up_to_each_other(histogram, most):
    """The last pieces of a length drew shorter ones into their group, which then took the room of the longer."""
    from churnlens.llm import packing

    assert packing.plan(histogram, 64, groups=6).sequences <= most


def test_a_length_that_fills_a_group_stays_alone_in_it():
    from churnlens.llm import packing

    # seven lengths for six groups: the 28 pieces of 43 need a sequence each, two of 22 share one
    histogram = {22: 19, 43: 28, 9: 1, 10: 1, 11: 1, 12: 1, 13: 1}
    assert packing.plan(histogram, 64, groups=6).sequences <= 38

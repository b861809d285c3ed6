"""Operators that compare documents or vectors, and the pipeline, against brute force."""

import collections
import math
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from churnlens.llm import ann, attention, common, decontaminate, line_dedup, lm_score, quality, queries, simhash

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text):
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def components(prints):
    """Smallest id reachable, by brute force over all pairs."""
    best = {i: i for i, _ in prints}

    def find(i):
        while best[i] != i:
            i = best[i]
        return i

    for a, (i, x) in enumerate(prints):
        for j, y in prints[:a]:
            if (x ^ y).bit_count() <= 4:
                i2, j2 = find(i), find(j)
                best[max(i2, j2)] = min(i2, j2)
    return {i: find(i) for i, _ in prints}


def test_simhash_of_documents(spark, sf, documents):
    prints = [(d["doc_id"], fingerprint(d["text"])) for d in documents]
    want = components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op2_simhash(spark, sf).collect()}
    assert got == {i: (f"{x:016x}", want[i]) for i, x in prints}


def test_links_of_crowded_fingerprints(spark):
    """Dense groups, chains and lone fingerprints: the components are those of all pairs."""
    rng = np.random.default_rng(3)
    flips = lambda n: sum(1 << int(b) for b in rng.choice(64, n, replace=False))
    centers = [int(x) for x in rng.integers(0, 1 << 63, 6)]
    prints = {c ^ flips(int(rng.integers(0, 5))) for c in centers[:3] for _ in range(60)}
    x = centers[3]
    for _ in range(12):  # a chain whose ends are far apart
        x ^= flips(4)
        prints.add(x)
    prints |= {int(v) for v in rng.integers(0, 1 << 63, 150)} | {0, 1, (1 << 64) - 1}
    prints = sorted(prints)
    signed = [v - (1 << 64) if v >> 63 else v for v in prints]
    roots = {r.node: r.root for r in simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()}
    want = components(list(enumerate(prints)))
    groups = collections.defaultdict(set)
    for k, v in enumerate(signed):
        groups[roots.get(v, v)].add(k)
    brute = collections.defaultdict(set)
    for k in want:
        brute[want[k]].add(k)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, brute.values()))


def test_odd_documents_have_groups(spark, odd_docs, no_docs):
    got = simhash.simhash_groups(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert {r.component for r in got if r.fp == 0} == {0}
    assert simhash.simhash_groups(no_docs).count() == 0
    assert simhash.keep_one(odd_docs).columns == odd_docs.columns


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (7, 7)]
    got = {r.node: r.root for r in common.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


LONG = " ".join(f"w{i}" for i in range(60))


def test_repeated_passages_go(spark):
    own = lambda d, n: "\n".join(f"own line {d} {i} {'x' * (d * 7 + i * 3)}" for i in range(n))
    block = "\n".join(f"common line {i} of a long block {i * i}" for i in range(14))
    rows = [(0, f"{own(0, 5)}\n{LONG}\n{own(10, 4)}"), (1, f"{own(1, 3)}\n{LONG}"), (2, f"{LONG}\n{own(2, 6)}"), (3, f"{own(3, 4)}\n{block}\n{own(13, 5)}"), (4, f"{own(4, 9)}\n{block}\n{own(14, 4)}"), (5, own(5, 7)), (6, own(5, 7)), (7, None), (8, "")]
    got = {r.doc_id: r for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    assert got[0].text == texts[0] and got[3].text == texts[3] and got[5].text == texts[5]
    assert got[1].text == own(1, 3) and got[2].text == own(2, 6) and got[6].text == ""
    assert set(own(4, 9).split("\n")) <= set(got[4].text.split("\n")) and set(own(14, 4).split("\n")) <= set(got[4].text.split("\n"))
    assert len(got[4].text.split("\n")) <= 9 + 4 + 8  # most of the block is gone, its edges may stay
    assert got[7].text is None and got[8].text == "" and got[1].n_lines_removed == 1


def test_short_blocks_of_lines_go(spark):
    """Whole blocks of 2 to 6 short lines and over 50 words, between differing neighbours."""
    own = lambda d, n: [f"own line {d} {i} {'x' * (d * 7 + i * 3)}" for i in range(n)]
    rows, want = [], {}
    for n in range(2, 7):
        for k in range(6):
            block = [" ".join(f"b{n}k{k}l{i}w{w}" for w in range(60 // n)) for i in range(n)]
            first, later = 100 * n + k, 100 * n + k + 50
            rows += [(first, "\n".join([*own(first, 3), *block, *own(first + 1000, 3)])), (later, "\n".join([*own(later, 4), *block, *own(later + 1000, 2)]))]
            want |= {first: rows[-2][1], later: "\n".join(own(later, 4) + own(later + 1000, 2))}
    few = "\n".join(f"few words {i}" for i in range(2))  # a repeated pair of under 50 words stays
    rows += [(9000, f"{few}\nalone"), (9001, f"other\n{few}\nend"), (9002, "\n" * 80), (9003, "\n" * 70 + "end")]
    want |= {9001: f"other\n{few}\nend", 9003: "\n" * 70 + "end"}
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: got[i] for i in want} == want


def test_line_dedup_of_documents(spark, sf, documents, odd_docs, no_docs):
    got = {r.doc_id: r for r in queries.op1_line_dedup(spark, sf).collect()}
    first = {}
    for d in documents:
        first.setdefault(d["text"], d["doc_id"])
    passages = collections.Counter()
    for d in documents:
        r, lines = got[d["doc_id"]], d["text"].split("\n")
        left = r.text.split("\n") if r.text or not r.n_lines_removed else []
        if r.n_lines_removed:
            rest = iter(lines)
            assert all(x in rest for x in left)  # a subsequence of the lines
            assert len(left) == len(lines) - r.n_lines_removed
        else:
            assert r.text == d["text"]
        if first[d["text"]] != d["doc_id"] and len(lines) > 1:
            assert len(left) < len(lines)
        passages.update({x for x in left if x.count(" ") >= 49})
    assert max(passages.values(), default=1) == 1  # no passage of 50 words is left twice
    rows = line_dedup.line_dedup(odd_docs).collect()
    assert len(rows) == odd_docs.count() and set(odd_docs.columns) <= set(rows[0].asDict())
    assert line_dedup.line_dedup(no_docs).count() == 0


def test_chunks_shift_with_their_lines(spark):
    lines = [f"line {i * 7919 % 1009}" for i in range(60)]
    texts = ["\n".join(lines), "\n".join(["new first line", *lines]), "\n".join(lines[3:])]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(line_dedup.chunks(F.col("text")).alias("c")).collect()
    chunks = [[c["text"] for c in r.c] for r in rows]
    assert ["\n".join(c) for c in chunks] == texts
    assert len(set(chunks[0]) & set(chunks[1])) >= len(chunks[0]) - 2 and len(set(chunks[0]) & set(chunks[2])) >= len(chunks[2]) - 2


def test_leaks_in_documents(spark, sf, documents):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    squeeze = lambda t: f" {' '.join(t.split())} "
    want = {d["doc_id"] for d in documents for t in items.values() if squeeze(t) in squeeze(d["text"])}
    got = queries.op3_decontaminate(spark, sf).collect()
    assert want <= {r.doc_id for r in got}
    for r in got:  # and nothing that does not hold half the words of its item in order
        shared = set(items[r.item_id].lower().split()) & set(next(d for d in documents if d["doc_id"] == r.doc_id)["text"].lower().split())
        assert len(shared) >= 0.5 * len(set(items[r.item_id].lower().split()))


def test_other_numbers_and_names_are_found(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "A train leaves Boston at 60 km per hour and reaches Denver after 12 hours , how far did the train from Boston go ?", 0), (2, "short", 0), (3, None, 0), (4, "the cat sat on 3 mats", 0)], "item_id int, text string, doc_id int")
    rows = [
        (1, "Some words before. A train leaves Paris at 85 km per hour and reaches Berlin after 7 hours, how far did the train from Paris go? And after."),
        (2, "A train leaves Paris at 85 km per hour and reaches Berlin after 7 hours, how far did the train from Rome go?"),
        (3, "A train leaves for the coast every morning and people like the view."),
        (4, "We saw that the cat sat on 9 mats yesterday."),
        (5, "short"),
        (6, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.same_slots for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(1, 1): False, (4, 4): False}
    assert {r.doc_id for r in decontaminate.clean(docs, items).collect()} == {2, 3, 5, 6}
    assert decontaminate.contaminated(odd_docs, items).count() == 0
    assert decontaminate.contaminated(no_docs, items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0


def test_edited_copies_are_found(spark):
    item = [f"word{i}" for i in range(40)]
    edits = {
        1: [*item[:20], "new", *item[20:]],  # inserted
        2: [*item[:20], *item[21:]],  # deleted
        3: [*item[:20], "new", *item[21:]],  # replaced
        4: [*item[:14], "one", "more", *item[14:27], *item[28:]],  # both, net shifts of 2 and 1
        5: [*item[:20], *[f"far{i}" for i in range(30)], *item[20:]],  # two halves far from each other
    }
    rows = [(i, " ".join(["Before", "it", "stands", *words, "and", "then", "more"])) for i, words in edits.items()]
    items = spark.createDataFrame([(7, " ".join(item))], "item_id int, text string")
    got = {r.doc_id: (r.windows, r.item_windows, r.same_slots) for r in decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert got == {1: (26, 33, True), 2: (25, 33, True), 3: (25, 33, True), 4: (18, 33, True)}


def test_items_poor_in_literals_and_one_changed_value(spark):
    sums = "12 + 30 = 42 ; 7 * 8 = 56 ; 90 - 15 = 75 ; 6 * 6 = 36 ; 81 / 9 = 9"
    names = "Anna Bert Carla Dora Emil Frida Georg Hanna Ida Jan Karl Lea Mia Nils"
    long = " ".join(f"word{i} goes with {i % 9} of them and" for i in range(12))
    items = spark.createDataFrame([(1, sums), (2, names), (3, "3 + 4 = 7"), (4, long)], "item_id int, text string")
    changed = long.replace("word1 goes with 1 ", "word1 goes with 77 ")  # word10 keeps its 1
    rows = [
        (1, f"As it was told: {sums} and so on."),
        (2, f"the list {names} ends here"),
        (3, "We know that 3 + 4 = 7 holds."),
        (4, f"It says {changed} no more"),
        (5, sums.replace("1", "2").replace("6", "5").replace("8", "3")),  # other sums
        (6, "Otto Paula Quin Rosa Sven Tina Udo Vera Willi Xenia Yara Zoe Adam Bela"),
        (7, "We know that 3 + 5 = 8 holds."),
    ]
    assert changed != long
    got = {(r.doc_id, r.item_id): r.same_slots for r in decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert got == {(1, 1): True, (2, 2): True, (3, 3): True, (4, 4): True}


def brute_nearest(rows, k=20):
    good = {i: v for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    ids = sorted(good)
    m = np.array([good[i] for i in ids], np.float64)
    out = {}
    for i in ids:
        if i % 20 == 0:
            s = (m * np.array(good[i], np.float64)).sum(axis=1)
            out[i] = sorted(((-x, j) for x, j in zip(s.tolist(), ids, strict=True) if j != i))[:k]
    return out


def nearest_found(df):
    got = collections.defaultdict(list)
    for r in sorted(ann.nearest(df).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((-r.score, r.vec_id))
    return got


def check_nearest(got, want, rows, least):
    """Every query has all its rows, true scores in order, and at least the share ``least`` of the right ones."""
    vectors = dict(rows)
    assert set(got) == set(want)
    hit = 0
    for q, found in got.items():
        assert len(found) == len(want[q]) and found == sorted(found) and q not in {j for _, j in found}
        exact = [sum(float(x) * float(y) for x, y in zip(vectors[q], vectors[j], strict=True)) for _, j in found]
        assert np.allclose(exact, [-s for s, _ in found], rtol=1e-9)
        hit += len({j for _, j in found} & {j for _, j in want[q]})
    assert hit >= least * sum(map(len, want.values()))


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01", "sf0.1"])
def test_nearest_of_embeddings(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet").collect()]
    check_nearest(nearest_found(spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")), brute_nearest(rows), rows, 0.95)


@pytest.mark.parametrize("n", [12, 60, 9_000])
def test_no_query_falls_short(spark, n):
    """Gaussian vectors, whose lists say little, and tables with fewer candidates than results."""
    rows = [(i, v) for i, v in enumerate(np.random.default_rng(n).normal(size=(n, 48)).tolist())]
    check_nearest(nearest_found(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), brute_nearest(rows), rows, 0.9)


def test_recall_and_ties(spark):
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(12, 24))
    v = (centers[rng.integers(0, 12, 6000)] + rng.normal(size=(6000, 24))) * rng.uniform(0.5, 2, (6000, 1))
    rows = [(i, x) for i, x in enumerate(v.astype(np.float32).tolist())]
    rows += [(i, rows[40][1]) for i in range(6000, 6400)]  # equal vectors: ties by id
    rows += [(6400, None), (6420, [0.0] * 24), (6440, [float("nan")] * 24), (6460, [None] * 24), (6480, [1.0]), (None, [1.0] * 24)]
    rows = rows + rows[:3]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    want = brute_nearest([r for r in rows if r[0] != 6480])
    found = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found[r.query_id].append(r.vec_id)
    assert set(found) == set(want) and all(len(x) == 20 for x in found.values())
    assert found[40] == [j for _, j in want[40]]
    assert np.mean([len({j for _, j in want[q]} & set(found[q])) / 20 for q in want]) >= 0.9
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_attention_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 50, 5000)
    vocabulary = attention.Vocabulary(counts, rng.random((5000, 64)))
    p = attention.new_parameters(vocabulary)
    text = rng.integers(0, 5000, 30)
    last = np.arange(5000)
    ids = np.concatenate([np.tile(text, (5000, 1)), last[:, None]], axis=1).ravel()
    each = attention.token_log_p(p, vocabulary, ids, np.full(5000, 31)).reshape(5000, 31)
    assert abs(np.exp(each[:, -1].astype(float)).sum() - 1) < 1e-3
    # causal: what follows changes nothing, and windows score a token as one long text does
    assert np.allclose(each[:, :-1], each[0, :-1], atol=1e-5)


def test_gradients():
    rng = np.random.default_rng(1)
    vocabulary = attention.Vocabulary(rng.integers(0, 50, 4000), rng.random((4000, 64)))
    p = attention.new_parameters(vocabulary)
    ids, n = rng.integers(0, 4000, 200), np.array([120, 80])
    before = -attention.token_log_p(p, vocabulary, ids, n).sum()
    for k in range(6):
        p, _, _ = attention.train(p, vocabulary, ids, n, 0.05, seed=k)
    assert -attention.token_log_p(p, vocabulary, ids, n).sum() < 0.8 * before


def test_language_model_trains_on_every_word(spark):
    rows = [(1, "one two three " * 3000), (2, "single"), (None, None), (4, "word " * 500), (4, "word " * 500)]
    path = P.path("byte_bpe_50k.tiktoken")
    coder = lm_score.Subwords(path, P.PATTERN)
    got = lm_score.stretches(spark.createDataFrame(rows, "id long, text string"), path, P.PATTERN).collect()
    whole = sum(len(coder.encode("".join(" " + w for w in (t or "").split()))) + 1 for _, t in rows)
    assert sum(r["n"] for r in got) == whole and all(len(r["ids"]) == 2 * r["n"] for r in got)
    ids = np.concatenate([np.frombuffer(r["ids"], np.uint16) for r in got])
    assert (ids == coder.end).sum() == len(rows)


def test_lm_scores(spark, sf, documents, odd_docs, no_docs):
    path = P.path("byte_bpe_50k.tiktoken")
    got = {r.doc_id: r for r in queries.op6_lm_score(spark, sf).collect()}
    held = {d["doc_id"]: zlib.crc32(str(d["doc_id"]).encode()) % 7 == 2 for d in documents}
    low = {d["doc_id"]: d["text"].encode().translate(LOWER).split() for d in documents}
    count, total = collections.Counter(), 0
    for i in low:
        if not held[i]:
            count.update(low[i])
            count[""] += 1
    total = sum(count.values())
    scale = math.log10(total + len(count) + 1)
    for i, words in low.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[i], len(words) + 1, total)
        assert r.n_known == sum(count[w] > 0 for w in [*words, b""[:0].decode()] if w != "") + (count[""] > 0)
        assert math.isclose(r.base_score, sum(math.log10(count[w] + 1) - scale for w in [*words, ""]), rel_tol=1e-9)
        assert r.score < 0
    mine = sum(got[i].score for i in low if held[i])
    base = sum(got[i].base_score for i in low if held[i])
    assert mine > 1.25 * base, (mine, base)  # little text to learn from here; check_s and check_l are in the README
    assert lm_score.lm_scores(odd_docs, path, P.PATTERN).count() == odd_docs.count()
    assert lm_score.lm_scores(no_docs, path, P.PATTERN).count() == 0


def test_word_order_and_windows_of_subwords():
    coder = lm_score.Subwords(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    import pyarrow as pa

    texts = ["The quick brown\xa0fox", "", "x\x85y 　 z", "the the"]
    ids, n = coder.of(*common.words(pa.array(texts)))
    own = np.split(ids, np.cumsum(n)[:-1])
    for text, x in zip(texts, own, strict=True):
        words = [w.decode() for w in text.encode().translate(LOWER).split()]
        assert x.tolist() == [i for w in words for i in coder.encode(" " + w)] + [coder.end]


def test_top_k_cut(spark):
    rng = np.random.default_rng(2)
    draws = np.concatenate([rng.normal(size=5000), np.full(700, 0.25)])
    frame = spark.createDataFrame([(int(i), float(x)) for i, x in enumerate(draws)], "doc_id long, draw double")
    order = sorted(range(len(draws)), key=lambda i: (-draws[i], i))
    for k in (1, 10, 2300, 2500, 5600):
        assert quality.top_k_cut(frame, k, bins=16, last=100) == (draws[order[k - 1]], order[k - 1])
    assert quality.top_k_cut(frame, len(draws)) is None


def test_toxic_documents_go(spark, documents, odd_docs, no_docs):
    rng = np.random.default_rng(4)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(900):
        text = rng.choice(plain, 80).tolist()
        kind = i % 9
        if kind == 0:
            for at in rng.integers(0, 80, 6):
                text[at] = f"slur{at % 5}"
        if kind == 1:
            text = [w + "$$$" for w in text]
        rows.append((i, " ".join(text), None))
        if i % 2:
            labels.append((i, int(kind != 1), int(kind == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, log_weight int")
    kept = {r.doc_id for r in quality.keep(docs, spark.createDataFrame(labels + [(None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int")).collect()}
    clean = [i for i in range(900) if i % 9 > 1]
    assert sum(i in kept for i in clean) >= 0.98 * len(clean)
    assert sum(i in kept for i in range(900) if i % 9 < 2) <= 0.02 * 200
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.keep(odd_docs, none).count() == odd_docs.count()
    assert quality.keep(no_docs, none).count() == 0


def test_pipeline(spark, sf, documents):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    before = {d["doc_id"]: d["text"] for d in documents}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf), "test-pipeline")
        assert docs.columns == list(documents[0]), name
        now = {r.doc_id: r.text for r in docs.collect()}
        assert set(now) <= set(before), name
        gone = set(before) - set(now)
        if name == "SimHash near-dedup":
            groups = components([(i, fingerprint(t)) for i, t in before.items()])
            assert set(now) == set(groups.values())
        elif name == "quality classifier":
            clean = [i for i in before if i in labels and labels[i].quality and not labels[i].toxic]
            assert sum(i in now for i in clean) >= 0.8 * len(clean)
        elif name == "line dedup":
            assert all(before[i] in {before[j] for j in before if j < i} or len(before[i].split("\n")) >= 1 for i in gone)
        before = now
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in packed} == set(before)


@pytest.mark.parametrize("stage", range(4))
def test_stages_take_odd_and_empty_tables(spark, sf, odd_docs, no_docs, stage):
    name, f = corpus_pipeline.STAGES[stage]
    assert f(spark, odd_docs, sf).columns == odd_docs.columns
    f(spark, odd_docs, sf).collect()
    assert f(spark, no_docs, sf).count() == 0

"""Prefix trie, transducer codec and divergence audit against brute force; rows without or with equal ids in the stages."""

import collections
import hashlib
import random
import re
import zlib

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from churnlens.llm import bpe_codec, divergence, line_dedup, pii, prefix_trie, queries

VOCABULARY = P.path("byte_bpe_multi_50k.tiktoken")


# --------------------------------------------------------------------------- prefix trie


def brute_trie(seqs):
    """Nodes of ``{conv: [(role, text)]}``, from the definition."""
    members = collections.defaultdict(list)
    for c, turns in seqs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    below = collections.defaultdict(list)
    for node in members:
        for d in range(len(node) + 1):
            below[node[:d]].append(node)
    out = set()
    for node, own in members.items():
        children = [n for n in below[node] if len(n) == len(node) + 1]
        words = lambda n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        ends = ",".join(str(c) for c in sorted(c for c in own if len(seqs[c]) == len(node)))
        out.add((
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children),
            sum(not any(len(m) == len(n) + 1 for m in below[n]) for n in below[node]),
            sum((len(members[n]) - 1) * words(n) for n in below[node]), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def brute_splice(own):
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    return out


def turns_of(rows):
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(x, key=lambda x: x[0])] for c, x in by.items()}


def found(df):
    return [tuple(r[c.split(" ")[0]] for c in prefix_trie.NODE.split(", ")) for r in df.collect()]


def test_trie_of_conversations(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = found(queries.op11_prefix_trie(spark, sf))
    assert len(got) == len(set(got)) and set(got) == brute_trie(brute_splice(turns_of(rows)))


def test_trie_of_random_conversations(spark):
    r = random.Random(3)
    rows = []
    for c in [*range(0, 90), 1003, 2000]:
        for turn in range(r.choice([1, 1, 2, 3, 6])):
            rows.append((c, None if turn == 0 and r.random() < 0.3 else turn, r.choice(["user", None, ""]), r.choice(["a b", "", None, "x\x0by \x85", "a  b"])))
    # one long conversation, and a copy that differs at its last turn only
    rows += [(c, t, "user", f"turn {t}" if t < 39 else f"last {c}") for c in (2040, 2060) for t in range(40)]
    rows.append((None, 0, "user", "no conversation"))
    df = spark.createDataFrame([(*x, "clash", 7) for x in rows], "conv_id long, turn long, role string, text string, depth string, n_convs int")
    seqs = prefix_trie.sequences(df)
    plain, spliced = found(prefix_trie.prefix_trie(seqs)), found(prefix_trie.prefix_trie(prefix_trie.spliced(seqs)))
    own = turns_of(rows)
    assert set(plain) == brute_trie(own) and len(plain) == len(set(plain))
    assert set(spliced) == brute_trie(brute_splice(own)) and any(x[1] == 0 and x[7] != prefix_trie.NO_ENDS for x in spliced) == any(not s for s in brute_splice(own).values())


def test_ties_and_repeated_turns_are_stable(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "user", "b")]
    nodes = found(prefix_trie.prefix_trie(prefix_trie.sequences(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))))
    assert sorted(n[1] for n in nodes) == [0, 1, 2, 3] and all(n[3] == 2 for n in nodes)  # both are the same sequence


def test_trie_of_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert found(prefix_trie.prefix_trie(prefix_trie.spliced(prefix_trie.sequences(none)))) == []


# --------------------------------------------------------------------------- codec


def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe_codec.read_ranks(VOCABULARY), special_tokens={})


def test_codec_of_documents(spark, sf, documents, odd_docs, no_docs):
    known = reference()
    want = {}
    for d in documents:
        ids = known.encode_ordinary(d["text"] or "")
        want[d["doc_id"]] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(known.decode_bytes(ids)).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op12_bpe_codec(spark, sf).collect()} == want
    odd = [(r.text, list(r.ids)) for r in bpe_codec.round_trip(odd_docs, VOCABULARY, P.PATTERN).collect()]
    assert sorted(odd) == sorted((r.text or "", known.encode_ordinary(r.text or "")) for r in odd_docs.collect())
    apart = bpe_codec.decode(bpe_codec.encode(odd_docs, VOCABULARY, P.PATTERN), VOCABULARY)
    assert sorted((r.text, list(r.ids)) for r in apart.collect()) == sorted(odd)
    assert bpe_codec.round_trip(no_docs, VOCABULARY, P.PATTERN).collect() == []


def test_transducer_on_any_bytes():
    known, mine = reference(), bpe_codec.encoder(VOCABULARY, P.PATTERN)
    r = random.Random(5)
    for _ in range(1500):
        raw = bytes(r.choice([r.randrange(256), 97, 101, 116]) for _ in range(r.randint(1, 14)))
        assert mine.transducer.encode(raw) == tuple(known._core_bpe.encode_single_piece(raw))
        text = "".join(r.choice(["the", " th", "é", "漢字", "🙂", "́", "\n", " ", "'s", "12", "--", "\x1c", " ", "Ж"]) for _ in range(r.randint(0, 20)))
        assert mine.encode(text) == known.encode_ordinary(text)
    for raw in (b"a" * 5000, b" " * 700, bytes(range(256)) * 4):
        assert mine.transducer.encode(raw) == tuple(known._core_bpe.encode_single_piece(raw))


def test_every_token_and_states_forgotten(monkeypatch):
    known, mine = reference(), bpe_codec.encoder(VOCABULARY, P.PATTERN)
    assert all(mine.transducer.encode(t) == (i,) for t, i in mine.transducer.ranks.items())
    monkeypatch.setattr(bpe_codec, "STATES", 20)
    monkeypatch.setattr(bpe_codec, "BORDERS", 20)
    fresh = bpe_codec.Transducer(mine.transducer.ranks)
    for word in ("internationalisation", "Donaudampfschifffahrt", "zzzyzx", "прогулка") * 3:
        assert fresh.encode(word.encode()) == tuple(known._core_bpe.encode_single_piece(word.encode()))


def test_decoding_of_broken_bytes(spark):
    d = bpe_codec.decoder(VOCABULARY)
    r = random.Random(6)
    parts = [b"\xf0\x9f", b"\x98\x80", b"\xe0\x80", b"\xed\xa0\x80", b"\xf4\x90", b"\xc3", b"\xa9", b"a", b"\xff", b"\xe6\xbc\xa2"]
    singles = {t: i for i, t in d.token.items() if len(t) == 1}
    for _ in range(500):
        raw = b"".join(r.choice(parts) for _ in range(r.randint(0, 9)))
        assert d.decode([singles[bytes([b])] for b in raw]) == raw.decode("utf-8", "replace")
    rows = spark.createDataFrame([(1, [0, None, 1]), (2, None), (3, []), (None, [999_999])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in bpe_codec.decode(rows, VOCABULARY).collect()}
    assert got == {1: d.token[0].decode() + "�" + d.token[1].decode(), 2: "", 3: "", None: "�"}


# --------------------------------------------------------------------------- divergence


def brute_divergence(rows, min_docs=3, top=200):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(lang or "", source or "", term.findall((text or "").translate(table))) for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = collections.Counter(t for _, _, ts in own for t in set(ts))
        kept = [t for t in df if df[t] >= min_docs]
        count = {s: collections.Counter(t for _, s2, ts in own if s2 == s for t in ts) for s in {d[1] for d in own}}
        count[None] = collections.Counter(t for _, _, ts in own for t in ts)
        p = {}
        for s, c in count.items():
            n = sum(c[t] for t in kept)
            p[s] = {t: 1 + 1_000_000_000 * (c[t] + 1) // (n + len(kept)) for t in kept}
        f = lambda a, b: (a - b) * (a - b) // b
        for s in count:
            if s is None:
                continue
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in count if o not in (s, None)]
            terms = [(-f(p[s][t], p[None][t]), t.encode(), t) for t in kept if count[s][t] > 0 and p[s][t] > p[None][t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(items)}
    return out


def audit(df, **kw):
    return [tuple(r) for r in divergence.divergence(df, **kw).select("lang", "source", "part", "item", "value", "rank").collect()]


ROWS = [("The cat. the CAT, the dog", "en", "a"), ("the cat sat", "en", "b"), ("the dog", "en", "b"), ("The cat's dog", "en", None), (None, "en", "c"), ("", None, "c"), ("éÉ Éa éa ÉA", None, "a"), ("éa", None, "c"), ("éa éa", None, None), ("123 !", "de", "x"), ("zz", "de", "y"), ("the \x00cat\x7fdog " * 40, "en", "c"), ("the cat", "en", "b"), ("the cat", "en", "b")]


@pytest.mark.parametrize("parts", [10**6, 3, 1])
def test_divergence_by_brute_force(spark, parts, monkeypatch):
    monkeypatch.setattr(divergence, "PROBES", 1)
    df = spark.createDataFrame([(*r, 1, "clash") for r in ROWS], "text string, lang string, source string, value int, term string").repartition(3)
    got = audit(df, part_terms=parts)
    assert len(got) == len(set(got)) and set(got) == brute_divergence(ROWS)
    assert set(audit(df, part_terms=parts, min_docs=1, top=2)) == brute_divergence(ROWS, 1, 2)


def test_divergence_of_a_large_language_in_parts(spark):
    word = lambda i: "w" + "".join(chr(97 + int(c)) for c in f"{i:04d}")
    rows = [(" ".join(word(i) for i in range(d % 30 * 100, d % 30 * 100 + 100 + d)), "en", "ab"[d % 2]) for d in range(90)]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert len(divergence._parts(divergence._by_bucket(divergence.term_rows(df)), 1000)) > 1
    assert set(audit(df, part_terms=1000)) == brute_divergence(rows)


def test_divergence_of_documents(spark, sf, documents):
    got = [tuple(r) for r in queries.op13_divergence(spark, sf).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert set(got) == brute_divergence([(d["text"], d["lang"], d["source"]) for d in documents])


def test_divergence_without_terms(spark):
    schema = "text string, lang string, source string"
    assert audit(spark.createDataFrame([], schema)) == []
    rows = [("12", "en", "a"), (None, "en", "b")]
    assert set(audit(spark.createDataFrame(rows, schema))) == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}


# --------------------------------------------------------------------------- rows that share an id


ITEM = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa"
SHARED = [(i, t) for i in (None, 7) for t in (f"clean words number {i} stay in this text for good", f"before {ITEM} after", "another clean text that nobody else has written down")]


def test_decontamination_goes_by_row(spark, tmp_path):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(*r, "x") for r in SHARED], "doc_id long, text string, id string")
    got = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == sorted((i or 0, t) for i, t in SHARED if ITEM not in t)
    # parts of an item in two documents without an id make no copy
    words = ITEM.split()
    halves = spark.createDataFrame([(None, " ".join(words[:9]) + " x y z"), (None, "u v w " + " ".join(words[7:]))], "doc_id long, text string")
    from churnlens.llm import decontaminate

    apart = {r.windows for r in decontaminate.contaminated(halves, bench).collect()}
    assert all(w <= 5 for w in apart)


def test_near_dedup_keeps_one_row_of_each_group(spark):
    long = " ".join(f"w{i}" for i in range(80))
    rows = [(None, long), (None, long), (5, long), (None, "quite another text of its own"), (3, "third text here"), (3, "fourth text there"), (3, "third text here")]
    got = corpus_pipeline.near_deduplication(spark, spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, sign string"), "")
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == sorted([(5, long), (0, "quite another text of its own"), (3, "third text here"), (3, "fourth text there")])


def test_sanitising_goes_by_row(spark):
    rows = [(None, "mail a@b.cd now"), (1, "call +49 30 1234567 now"), (1, "mail x@y.zz soon"), (None, "nothing here"), (1, "mail x@y.zz soon"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = pii.pii_spans(docs, support=3)  # base spans alone: no word stands three times with an entity
    got = sorted((r.doc_id or 0, r.text) for r in pii.sanitise(docs, spans).collect())
    assert got == [(0, "mail <email> now"), (0, "nothing here"), (1, "call <phone> now"), (1, "mail <email> soon"), (1, "mail <email> soon"), (2, "")]


def test_line_dedup_goes_by_row(spark):
    block = "\n".join(f"line {k} of a passage that several documents hold in common with {k} words" for k in range(8))
    rows = [(None, f"own start {i}\n{block}\nown end {i}") for i in range(6)] + [(4, f"first {i}\n{block}\nlast {i}") for i in range(3)]
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 9 and sum(block in r.text for r in got) == 1
    left = {line for r in got for line in r.text.split("\n")}
    assert all(f"own start {i}" in left and f"own end {i}" in left for i in range(6)) and all(f"first {i}" in left for i in range(3))

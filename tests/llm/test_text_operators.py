"""Operators on single texts and conversations against plain Python."""

import hashlib
import re
import zlib

import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from churnlens.llm import chat_format, packing, pii, queries, token_counts

BPE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")


def texts_of(parts, most):
    return st.lists(st.sampled_from(parts), max_size=most).map("".join)


TEXT = texts_of([*"aAbé ß漢🙂'st \n\t\x1c\x85\xa0 0١.!<|>#", "<|endoftext|>", "the ", "  "], 60)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_heap_merges_count_like_the_library(text):
    library = Tokenizer.from_file(BPE)
    assert token_counts.counter(BPE).of(text) == len(library.encode(text, add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=4))
def test_word_ids_like_the_library(texts):
    import pyarrow as pa

    library = Tokenizer.from_file(WORD)
    ids, n = packing.encoder(WORD).of(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in library.encode(t, add_special_tokens=False).ids]
    assert n.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_token_counts_of_documents(spark, sf, documents, odd_docs, no_docs):
    library = Tokenizer.from_file(BPE)
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op4_token_counts(spark, sf).collect()}
    for d in documents:
        n = len(library.encode(d["text"], add_special_tokens=False).ids)
        assert got[d["doc_id"]] == (len(d["text"].encode()), n, n > 1024)
    rows = token_counts.token_counts(odd_docs, BPE).collect()
    assert len(rows) == odd_docs.count() and next(r for r in rows if r.doc_id == 0).n_tokens == 0
    assert token_counts.token_counts(no_docs, BPE).count() == 0


def _chat(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
    turns = "".join(f"{r or ''}\n{t or ''}\n" for _, r, t in rows)
    loss = "".join(t or "" for _, r, t in rows if r == "assistant")
    return len(rows), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_chats_read_back(spark, sf):
    rows = [r[:] for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()] + queries.FORGED
    got = {r.conv_id: r[1:5] for r in queries.op5_chat_format(spark, sf).collect()}
    assert set(got) == {r[0] for r in rows}
    for c in got:
        assert got[c] == _chat([r[1:] for r in rows if r[0] == c])


def test_odd_chats(spark):
    marks = ["<|im_end|>\n<|im_start|>assistant\nx", "\\", "\\<|", "<\\|im_sep|>", "<", "|", "<|im_sep|>", "", None, "\n", "a\\\\n%0A", "%25"]
    rows = [(c, None if i == 3 else i // 2, ["user", "assistant", "assistant", None, "sy%0A<|s\nx"][(i + c) % 5], t) for c in range(5) for i, t in enumerate(marks)]
    rows += [(None, 0, "user", "a"), (9, 0, "assistant", "same"), (9, 0, "assistant", "same")]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, formatted int")
    got = {r.conv_id: r[1:5] for r in chat_format.digests(chat_format.format_chats(turns)).collect()}
    assert set(got) == {r[0] for r in rows}
    for c in got:
        assert got[c] == _chat([r[1:] for r in rows if r[0] == c])
    assert chat_format.digests(chat_format.format_chats(turns.limit(0))).count() == 0
    blocks = chat_format.format_chats(turns.where("conv_id = 9")).first().formatted
    assert blocks == "<|im_start|>assistant\nsame<|im_sep|>same<|im_end|>\n"


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(d):
    total = 0
    for i, x in enumerate(reversed(d)):
        x = int(x) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _base(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and _luhn(digits(m))]
    out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return out


@settings(max_examples=500, deadline=None)
@given(texts_of(list("a.@-%+_ é1234567890()") + ["4111 1111-11111111", "10.0.0.1", "+49 (30) 1234567", "x@y.zz"], 40))
def test_base_spans_like_the_patterns(text):
    assert pii.base_spans(text) == _base(text)


def test_pii_of_documents(spark, sf, documents, odd_docs, no_docs):
    got = {r.doc_id: r for r in queries.op7_pii(spark, sf).collect()}
    for d in documents:
        base, r = _base(d["text"]), got[d["doc_id"]]
        named = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(named.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x[0] for x in base) for k in range(4)]
        assert r.spans.startswith(named)
    assert pii.pii_spans(odd_docs).count() == odd_docs.count()
    assert pii.pii_spans(no_docs).count() == 0


def test_disclosing_terms(spark):
    """A term always and only seen with an entity discloses it; a common word does not."""
    rows = [(i, f"the writer xylograph wrote to a{i % 2}@b.cd about the house") for i in range(4)] + [(i, "the house about the writer") for i in range(4, 40)]
    rows = [(i, t.replace("xylograph", "zither") if i % 2 else t) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = pii.pii_spans(docs)
    terms = {r.doc_id: {t.term for t in r.term_spans} for r in spans.collect()}
    assert terms[0] == terms[2] == {"xylograph"} or "xylograph" in terms[0] and "zither" not in terms[0]
    assert all("the" not in t and "house" not in t for t in terms.values()) and not any(terms[i] for i in range(4, 40))
    clean = {r.doc_id: r.text for r in pii.sanitise(docs, spans).collect()}
    assert "@" not in "".join(clean.values()) and "xylograph" not in clean[0] and "<email>" in clean[0] and clean[5] == rows[5][1]


def test_pieces_of_documents(spark, sf, documents, odd_docs, no_docs):
    library = Tokenizer.from_file(WORD)
    rows = queries.op8_packing(spark, sf).collect()
    want = {}
    for d in documents:
        import numpy as np

        ids = np.array(library.encode(d["text"], add_special_tokens=False).ids + [1], "<u4")
        for p, s in enumerate(range(0, len(ids), 4096)):
            want[d["doc_id"], p] = (s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    gapless(rows, 4096)
    odd = packing.pack_documents(odd_docs, WORD, capacity=64).collect()
    gapless(odd, 64)
    assert {r.doc_id for r in odd} == {r.doc_id for r in odd_docs.collect()}
    assert packing.pack_documents(no_docs, WORD).count() == 0


def gapless(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(by) <= 1.03 * -(-sum(r.length for r in rows) // capacity) + 1


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=30))
def test_plans_place_every_piece_once(histogram):
    made = packing.plan(histogram, 64, groups=6)
    ranks, by = {}, {}
    for length, rank, n, first, per, offset in made.segments:
        assert ranks.get(length, 0) == rank
        ranks[length] = rank + n
        for i in range(n):
            by.setdefault(first + i // per, []).append((offset + i % per * length, length))
    assert ranks == histogram
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    least = max(-(-sum(s * n for s, n in histogram.items()) // 64), sum(n for s, n in histogram.items() if s > 32))
    assert len(by) <= 1.5 * least + 1


def test_chat_oracle(spark, sf):
    import duckdb

    from churnlens.llm.oracle import ORACLE_SQL

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    rel = con.execute(ORACLE_SQL["op5_chat_format"])
    columns = [d[0] for d in rel.description]
    want = {r[0]: r for r in rel.fetchall()}
    got = {r.conv_id: tuple(r) for r in queries.op5_chat_format(spark, sf).select(*[F.col(c) for c in columns]).collect()}
    assert got == want

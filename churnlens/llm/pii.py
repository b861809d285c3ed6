"""Personal data: base patterns, and information-theoretic sanitisation of what reveals them.

Base spans (emails, IP addresses, card and phone numbers) are the protected
entities.  The words within ``window`` words of an entity are terms that may
reveal it.  Over the whole corpus the operator counts the documents of each
term, of each entity and of both together, and from these estimates how much
of an entity's information a term discloses:

    PMI(e; t) / IC(e)  =  log(p(e, t) / (p(e) p(t))) / -log p(e)

1 means that the term alone identifies the entity, 0 that it says nothing.  A
term at or above ``threshold`` that was seen with its entity in at least
``support`` documents is added as a span wherever it stands in the window of
that entity.  ``sanitise`` writes the text back: entities are replaced by
their kind, terms that disclose at least ``remove_at`` are removed and the
others are generalised to a placeholder of their shape.

Statistics cover all documents.  Term counts are gathered only for terms that
occur in a window; a fixed-size bit table (1 MiB, whatever the corpus) sends
them to the tasks, false hits of which are dropped by the exact join.

Defined results: a null text counts as empty (no spans); null ids keep their
rows; repeated rows are documents of their own; an empty table gives an empty
table; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import key_kind, row_key, same_row, slices, stored, words

KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = ".,;:!?()[]{}<>\"'|*#$%&"
#: Bits of the table of window terms.
BITS = 1 << 23


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: the local part is the whole run before an ``@``."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text[start - 1]):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", free)
    return out


def _luhn(digits: str) -> bool:
    own = [int(d) for d in digits[-1::-2]]
    return (sum(own) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` in code points, kinds in the order of ``KINDS``, then by start."""
    out = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    if not _DIGITS.search(text):
        return out
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := re.sub("[^0-9]", "", m.group())) <= 19 and _luhn(d):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
                out.append((3, *m.span()))
    return out


def entity(kind: int, raw: str) -> str:
    """The entity behind a span: kind and value without letter case and separators."""
    return f"{KINDS[kind]}:{raw.lower() if kind < 2 else re.sub('[^0-9]', '', raw)}"


def _terms(text: str, spans: list[tuple[int, int, int]], window: int) -> list[tuple[str, str, int, int]]:
    """``(entity, term, start, end)`` of the words near each span."""
    if not spans:
        return []
    taken = sorted((s, e) for _, s, e in spans)
    own = [m.span() for m in _WORD.finditer(text)]
    starts = np.array([s for s, _ in own])
    ends = np.array([e for _, e in own])
    inner = np.zeros(len(own), bool)
    for s, e in taken:
        inner[np.searchsorted(ends, s, "right") : np.searchsorted(starts, e, "left")] = True
    out = []
    for kind, s, e in spans:
        first, last = int(np.searchsorted(ends, s, "right")), int(np.searchsorted(starts, e, "left"))
        who = entity(kind, text[s:e])
        for i in [*range(max(0, first - window), first), *range(last, min(len(own), last + window))]:
            if inner[i]:
                continue
            a, b = own[i]
            core = text[a:b].lstrip(_EDGE)
            a = b - len(core)
            core = core.rstrip(_EDGE)
            if core:
                out.append((who, core.lower(), a, a + len(core)))
    return out


FOUND = "id {id}, spans array<struct<kind:int,start:int,end:int>>, terms array<struct<entity:string,term:string,start:int,end:int>>"


def find(docs: DataFrame, window: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base spans and window terms of each document; one narrow pass."""

    def run(batches):
        span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
        term = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for b in slices(batches, "text"):
            spans = [base_spans(t) if t else [] for t in b.column("text").to_pylist()]
            terms = [_terms(t, s, window) if s else [] for t, s in zip(b.column("text").to_pylist(), spans, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([[dict(zip(("kind", "start", "end"), x, strict=True)) for x in s] for s in spans], span), pa.array([[dict(zip(("entity", "term", "start", "end"), x, strict=True)) for x in t] for t in terms], term)], ["id", "spans", "terms"])

    chosen = docs.select(row_key(id_col, text_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, FOUND.format(id=key_kind(docs, id_col)))


def _bit(terms: pa.Array | list[str]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(t) for t in terms), np.uint64, len(terms)) % np.uint64(BITS)


def _window_bits(terms: DataFrame) -> bytes:
    """The bits of all window terms, as packed bytes."""

    def bits(batches):
        seen = np.zeros(BITS, bool)
        for b in batches:
            seen[_bit(b.column("term").to_pylist())] = True
        packed = np.packbits(seen)
        for c, part in enumerate(np.split(packed, 64)):
            if part.any():
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([c], pa.int32()), "bits": pa.array([part.tobytes()], pa.binary())})

    def union(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for c, x in zip(b.column("chunk").to_pylist(), b.column("bits").to_pylist(), strict=True):
                x = np.frombuffer(x, np.uint8)
                total[c] = total[c] | x if c in total else x
        if total:
            yield pa.RecordBatch.from_pydict({"chunk": pa.array(list(total), pa.int32()), "bits": pa.array([x.tobytes() for x in total.values()], pa.binary())})

    kind = "chunk int, bits binary"
    rows = terms.select("term").mapInArrow(bits, kind).repartition(16, "chunk").mapInArrow(union, kind).collect()
    whole = np.zeros((64, BITS // 8 // 64), np.uint8)
    for r in rows:
        whole[r["chunk"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return whole.tobytes()


def term_counts(docs: DataFrame, bits: bytes, text_col: str = "text") -> DataFrame:
    """``(term, docs)`` over all documents, for the terms that the bit table holds."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        seen = np.unpackbits(np.frombuffer(sent.value, np.uint8)).astype(bool)
        total: dict[str, int] = {}

        def out():
            rows = pa.RecordBatch.from_pydict({"term": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})
            total.clear()
            return rows

        for b in slices(batches, "text"):
            text = pc.utf8_lower(pc.fill_null(b.column("text"), ""))
            codes, n, known = words(text, lower=False)
            cores = [w.strip(_EDGE) for w in known]
            wanted = seen[_bit(cores)] & np.array([bool(c) for c in cores], bool) if known else np.zeros(0, bool)
            ids: dict[str, int] = {}
            code = np.array([ids.setdefault(c, len(ids)) if w else -1 for c, w in zip(cores, wanted, strict=True)], np.int64)
            if not ids:
                continue
            owner = np.repeat(np.arange(len(n), dtype=np.int64), n)
            at = code[codes]
            pairs = np.unique((owner * len(ids) + at)[at >= 0])
            times = np.bincount(pairs % len(ids), minlength=len(ids))
            for term, i in ids.items():
                total[term] = total.get(term, 0) + int(times[i])
            if len(total) > 200_000:
                yield out()
        if total:
            yield out()

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("docs"))


def disclosing(found: DataFrame, docs: DataFrame, threshold: float = 0.8, support: int = 2, text_col: str = "text") -> DataFrame:
    """``(entity, term, disclosure)`` of the pairs at or above the threshold."""
    near = found.select(F.monotonically_increasing_id().alias("row"), "terms").where(F.size("terms") > 0)
    pairs = near.select("row", F.explode(F.array_distinct(F.transform("terms", lambda t: F.struct(t["entity"].alias("entity"), t["term"].alias("term"))))).alias("p")).select("p.*")
    both = pairs.groupBy("entity", "term").agg(F.count("*").alias("n_both")).where(F.col("n_both") >= support)
    # a document holds an entity once, however often the entity stands in it
    spans = found.where(F.size("terms") > 0).select(F.explode(F.array_distinct(F.transform("terms", lambda t: t["entity"]))).alias("entity"))
    owners = spans.groupBy("entity").agg(F.count("*").alias("n_entity"))
    both = stored(both.join(owners, "entity"), "pii-pairs")
    counts = term_counts(docs, _window_bits(both), text_col)
    total = max(found.count(), 1)
    information = -F.log(F.col("n_entity") / F.lit(total))
    pmi = F.log(F.col("n_both") * F.lit(float(total)) / (F.col("n_entity") * F.greatest(F.col("docs"), F.col("n_both"))))
    rated = both.join(counts, "term").select("entity", "term", F.when(information > 0, pmi / information).otherwise(F.lit(0.0)).alias("disclosure"))
    return rated.where(F.col("disclosure") >= threshold)


def pii_spans(docs: DataFrame, window: int = 5, threshold: float = 0.8, support: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, sign, spans, term_spans)`` for each document: base spans, and the spans the method adds.

    ``term_spans`` holds ``(start, end, term, entity, disclosure)``, by start;
    ``sign`` is a hash of the text, which tells apart documents that share an id.
    """
    found = stored(find(docs, window, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "pii-found")
    rated = stored(disclosing(found, docs, threshold, support, text_col), "pii-rated")
    hits = (
        found.where(F.size("terms") > 0)
        .select("row", F.explode("terms").alias("t"))
        .select("row", "t.*")
        .join(rated, ["entity", "term"])
        .groupBy("row", "start", "end", "term")
        .agg(F.max_by(F.struct("entity", "disclosure"), F.struct("disclosure", "entity")).alias("why"))
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", "term", F.col("why.entity").alias("entity"), F.col("why.disclosure").alias("disclosure")))).alias("term_spans"))
    )
    none = F.array().cast("array<struct<start:int,end:int,term:string,entity:string,disclosure:double>>")
    return found.join(hits, "row", "left").select(F.col("id.id").alias(id_col), F.col("id.sign").alias("sign"), "spans", F.coalesce("term_spans", none).alias("term_spans"))


def span_text(spans: Column, kind_of) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind_of(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def kind_name(s: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)


def sanitise(docs: DataFrame, spans: DataFrame, remove_at: float = 0.95, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with entities and disclosing terms written over.

    ``spans`` is the result of ``pii_spans`` for these documents; a document
    finds its spans by id and text, so ids may be null or repeated.  Overlapping
    spans are written over once, by the first.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = []
            for text, base, terms in zip(*(b.column(c).to_pylist() for c in ("text", "spans", "term_spans")), strict=True):
                cuts = sorted([(s["start"], s["end"], f"<{KINDS[s['kind']]}>") for s in base or []] + [(s["start"], s["end"], "" if s["disclosure"] >= remove_at else "<number>" if s["term"].isdigit() else "<term>") for s in terms or []])
                text, out, at = text or "", [], 0
                for s, e, put in cuts:
                    if s >= at:
                        out += [text[at:s], put]
                        at = e
                texts.append("".join([*out, text[at:]]))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    # copies of a document have equal spans; one row of them is enough
    own = spans.select(F.col(id_col).alias("own id"), F.col("sign").alias("own sign"), "spans", "term_spans").groupBy("own id", "own sign")
    own = own.agg(F.any_value("spans").alias("spans"), F.any_value("term_spans").alias("term_spans"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(own, same_row("id", "text", F.col("`own id`"), F.col("`own sign`")), "left")
    out = rows.select("id", "text", "spans", "term_spans").mapInArrow(run, f"id {kind}, text string")
    return out.select(F.col("id").alias(id_col), F.col("text").alias(text_col))

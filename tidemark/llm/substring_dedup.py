"""Substring dedup on a compacted De Bruijn graph of token k-mers.

Every window of ``k`` consecutive words is an edge of the De Bruijn graph of
order k-1. Edges are grouped by their *anchor*, the smallest hash among the
``m``-word sequences inside the window: equal edges have equal anchors. A
maximal run of consecutive edges of one document with one anchor is a path; it
is stored once, with the hash of its whole word sequence.

* Paths with equal (anchor, sequence) are the same nonbranching path and
  compact into one, held by the smallest document that has it.
* Where an anchor has one path only, nothing else can share its edges. Where it
  has several, the graph branches there, and the holders' paths are opened into
  edges. These stay packed, some ten thousand to a packet: a packet asks once for
  each distinct edge, an aggregate finds the edge's first document, and the answer
  goes to the packet, which returns runs. A passage that many documents share so
  costs rows by packet and edge, not by document and edge.
* Runs of one source that follow each other, in the document as in the source,
  merge into long spans. The words at the source's coordinates are read and
  digested, and a span counts only if the document's own words have that digest;
  equal hashes of different words so remove nothing.

Work and rows are linear in the text; groups of copies meet only in aggregates
that combine before the shuffle and in joins that adaptive execution can split.

Rows with a null ``doc_id`` are neither removed from nor used as a source.
Null and empty texts have no words. Rows that repeat a ``doc_id`` belong to one
document, whose own repetitions never count; each is judged on its own text. A
very long text is one task's work, its windows are packed like any others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as tx
from tidemark.llm.store import discard, save

WORDS = 50
ANCHOR_WORDS = 16
#: Edges of a packet.
PACKET = 1 << 15
#: Where a span lies: the document's id, which of the texts of that id, and its first word. Both latter travel as one number.
_PLACED = "doc_id long, place long, n int, source long, source_place long"


def _copy() -> Column:
    return F.expr("cast(xxhash64(text) & 2147483647 as int)").alias("copy")


def _place(copies: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return (copies.astype(np.int64) << 32) + starts


def _paths(k: int, m: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, copies, texts = np.array(tx.column(batch, "doc_id"), dtype=np.int64), np.array(tx.column(batch, "copy"), dtype=np.int64), tx.texts_in(batch)
            for i, j in tx.slices(texts):
                w = tx.words_of(texts[i:j])
                n = len(w.hashes) - k + 1
                if n <= 0:
                    continue
                low = tx.minimum_of(tx.rolling(w.hashes, m), k - m + 1)
                doc, at = w.doc_of_word()[:n], np.arange(n)
                inside = at + k <= w.last()[:n]
                new = np.ones(n, dtype=bool)
                new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
                first = np.flatnonzero(new & inside)
                # a run ends where the next begins, or with its document's last window
                heads = np.append(np.flatnonzero(new), n)
                stop = np.minimum(heads[np.searchsorted(heads, first, "right")], w.offsets[doc[first] + 1] - k + 1)
                size = stop - first
                content = tx.spans(w.hashes, first, size + k - 1, tx.prefix(w.hashes))
                place = _place(copies[i:j][doc[first]], first - w.offsets[doc[first]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[i:j][doc[first]]), pa.array(place), pa.array(size.astype(np.int32)), tx.signed(low[first]), tx.signed(content)],
                    names=["doc_id", "place", "n", "anchor", "content"],
                )

    return run


_PACKETS = "packet long, docs binary, places binary, anchors binary, edges binary"


def _edges(k: int):
    """Opened paths as packets of edges, each with its document, place and anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get(), 0
        base = (task.partitionId() if task else 0) << 32
        for batch in batches:
            ids, copies, opened = (tx.column(batch, c) for c in ("doc_id", "copy", "opened"))
            texts = tx.texts_in(batch)
            for i, j in tx.slices(texts):
                w = tx.words_of(texts[i:j])
                total = tx.prefix(w.hashes)
                doc, start, anchor = [], [], []
                for d in range(i, j):
                    room = w.offsets[d - i + 1] - w.offsets[d - i] - k + 1
                    for p in opened[d]:
                        at = np.arange(p["start"], min(p["start"] + p["n"], room))
                        start.append(at)
                        doc.append(np.full(len(at), d - i))
                        anchor.append(np.full(len(at), p["anchor"]))
                if not start:
                    continue
                start, doc, anchor = (np.concatenate(x).astype(np.int64) for x in (start, doc, anchor))
                edge = tx.spans(w.hashes, start + w.offsets[doc], np.full(len(start), k), total)
                docs, places = np.array(ids[i:j], dtype=np.int64)[doc], _place(np.array(copies[i:j], dtype=np.int64)[doc], start)
                for a in range(0, len(edge), PACKET):
                    cols = [x[a : a + PACKET].tobytes() for x in (docs, places, anchor, edge)]
                    yield pa.RecordBatch.from_arrays([pa.array([base + number]), *(pa.array([c], pa.binary()) for c in cols)], names=["packet", "docs", "places", "anchors", "edges"])
                    number += 1

    return run


def _packets(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(row, packet, [docs, places, anchors, edges]) of a batch."""
    for i in range(batch.num_rows):
        r = {c: batch.column(batch.schema.get_field_index(c))[i].as_py() for c in ("packet", "docs", "places", "anchors", "edges")}
        yield i, r["packet"], [np.frombuffer(r[c], dtype=np.int64) for c in ("docs", "places", "anchors", "edges")]


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct edge of a packet, with its first and last document there."""
    for batch in batches:
        for _, packet, (docs, places, anchors, edges) in _packets(batch):
            order = np.lexsort((places, docs, edges, anchors))
            a, e = anchors[order], edges[order]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (a[1:] != a[:-1]) | (e[1:] != e[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(order)) - 1
            cols = [np.full(len(first), packet), a[first], e[first], docs[order][first], docs[order][last], places[order][first]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["packet", "anchor", "edge", "lo", "hi", "place"])


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of edges of a packet that follow each other and start, in this order, in one smaller document."""
    for batch in batches:
        answers = batch.column(batch.schema.get_field_index("answers"))
        for i, _, (docs, places, anchors, edges) in _packets(batch):
            own = answers.slice(i, 1).flatten()
            known = {c: own.field(own.type.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("anchor", "edge", "first", "source_place")}
            order = np.argsort(known["edge"], kind="stable")
            known = {c: v[order] for c, v in known.items()}
            at = np.minimum(np.searchsorted(known["edge"], edges), len(order) - 1)
            source, source_place = known["first"][at], known["source_place"][at]
            hit = np.flatnonzero((known["edge"][at] == edges) & (known["anchor"][at] == anchors) & (source < docs))
            cols = [x[hit] for x in (docs, places, source, source_place)]
            follows = np.zeros(len(hit), dtype=bool)
            if len(hit):
                follows[1:] = (cols[0][1:] == cols[0][:-1]) & (cols[1][1:] == cols[1][:-1] + 1) & (cols[2][1:] == cols[2][:-1]) & (cols[3][1:] == cols[3][:-1] + 1)
            head = np.flatnonzero(~follows)
            n = np.diff(np.append(head, len(hit))).astype(np.int32)
            doc, place, source, source_place = (pa.array(c[head]) for c in cols)
            yield pa.RecordBatch.from_arrays([doc, place, pa.array(n), source, source_place], names=["doc_id", "place", "n", "source", "source_place"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one document with one source and distance, joined where they meet."""
    for batch in batches:
        out: list[tuple] = []
        for doc, found in zip(tx.column(batch, "doc_id"), tx.column(batch, "found"), strict=True):
            last = None
            for source, apart, place, n in sorted((s["source"], s["place"] - s["source_place"], s["place"], s["n"]) for s in found):
                if last is not None and last[:2] == [source, apart] and place <= last[2] + last[3]:
                    last[3] = max(last[3], place + n - last[2])
                    continue
                last = [source, apart, place, n]
                out.append((doc, last))
        cols = [pa.array([d for d, _ in out], pa.int64()), pa.array([s[2] for _, s in out], pa.int64()), pa.array([s[3] for _, s in out], pa.int32()), pa.array([s[0] for _, s in out], pa.int64()), pa.array([s[2] - s[1] for _, s in out], pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "place", "n", "source", "source_place"])


def _digest(words: list[bytes], start: int, n: int, k: int) -> bytes:
    """Of the words that n windows from ``start`` on cover; words have no spaces, so joining loses nothing."""
    return hashlib.blake2b(b" ".join(words[start : start + n + k - 1]), digest_size=16).digest()


def _digests(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, copy, t, asked in zip(tx.column(batch, "doc_id"), tx.column(batch, "copy"), tx.texts_in(batch), tx.column(batch, "asked"), strict=True):
                words = t.split()
                out += [(doc, copy, a["start"], a["n"], _digest(words, a["start"], a["n"], k)) for a in asked]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(kinds)], names=["doc_id", "copy", "start", "n", "digest"])

    return run


def _cut(k: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, repeated = tx.texts_in(batch), tx.column(batch, "_repeated")
            n_words, n_removed, digest, kept = [], [], [], []
            for t, found in zip(texts, repeated, strict=True):
                words = t.split()
                n = len(words)
                gone = np.zeros(n + 1, dtype=np.int64)
                for s in found or ():
                    if _digest(words, s["start"], s["n"], k) == s["digest"]:
                        gone[s["start"]] += 1
                        gone[min(s["start"] + s["n"] + k - 1, n)] -= 1
                out = np.cumsum(gone)[:n] > 0
                if removed := int(out.sum()):
                    words = [words[x] for x in np.flatnonzero(~out)]
                rest = b" ".join(words)
                n_words.append(n)
                n_removed.append(removed)
                digest.append(hashlib.sha256(rest).hexdigest())
                if with_text:
                    kept.append((rest if removed else t).decode())
            cols = {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}
            if with_text:
                cols["kept_text"] = pa.array(kept, pa.string())
            rest = [c for c in batch.schema.names if c not in ("_repeated", "text", *cols)]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in rest), *cols.values()], names=[*rest, *cols])

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), _copy(), "text")


def repeated_spans(docs: DataFrame, k: int = WORDS, m: int = ANCHOR_WORDS) -> DataFrame:
    """(doc_id, copy, start, n, source, source_copy, source_start): n windows from word ``start`` on that also start in a smaller document.

    ``source`` is the smallest such document; if it has them in several places, any is given. ``copy`` and
    ``source_copy`` tell texts of one doc_id apart.
    """
    if not 0 < m <= k:
        raise ValueError("the anchor must be no longer than the window")
    slim = _texts(docs)
    paths = save(slim.mapInArrow(_paths(k, m), "doc_id long, place long, n int, anchor long, content long"), "paths")
    # an anchor with several contents is where the graph branches
    contents = (F.min("content") < F.max("content")).alias("branches")
    shared = paths.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), contents).where("lo < hi").select("anchor", "branches")
    met = save(paths.join(shared, "anchor"), "met")
    discard(paths)
    # nonbranching paths compact into one holder each
    compact = met.groupBy("anchor", "content").agg(F.min("doc_id").alias("holder"), F.min_by("place", "doc_id").alias("source_place"))
    seen = met.join(compact, ["anchor", "content"]).where("holder < doc_id or branches and holder = doc_id")
    seen = save(seen.select("doc_id", "place", "n", "anchor", F.col("holder").alias("source"), "source_place", (F.col("holder") < F.col("doc_id")).alias("whole")), "compacted")
    discard(met)
    # branching ones are opened into edges
    path = F.struct(F.expr("cast(place & 4294967295 as int)").alias("start"), "n", "anchor")
    opened = seen.where("not whole").groupBy("doc_id", F.expr("cast(place >> 32 as int)").alias("copy")).agg(F.collect_list(path).alias("opened"))
    packets = save(slim.join(opened, ["doc_id", "copy"]).mapInArrow(_edges(k), _PACKETS), "packets")
    asked = packets.mapInArrow(_asked, "packet long, anchor long, edge long, lo long, hi long, place long")
    # written, so that the join below has a plain exchange on either side and its hot edges can be split
    first = save(asked.groupBy("anchor", "edge").agg(F.min("lo").alias("first"), F.max("hi").alias("end"), F.min_by("place", "lo").alias("source_place")).where("first < end").drop("end"), "first")
    answers = asked.join(first, ["anchor", "edge"]).where("first < hi").groupBy("packet").agg(F.collect_list(F.struct("anchor", "edge", "first", "source_place")).alias("answers"))
    single = packets.join(answers, "packet").mapInArrow(_answered, _PLACED)
    runs = seen.where("whole").select("doc_id", "place", "n", "source", "source_place").unionByName(single)
    found = F.collect_list(F.struct("place", "n", "source", "source_place")).alias("found")
    spans = save(runs.groupBy("doc_id", F.expr("place >> 32").alias("copy")).agg(found).select("doc_id", "found").mapInArrow(_merged, _PLACED), "spans")
    for used in (seen, packets, first):
        discard(used)
    split = lambda p, prefix: (f"cast({p} >> 32 as int) as {prefix}copy", f"cast({p} & 4294967295 as int) as {prefix}start")
    return spans.selectExpr("doc_id", *split("place", ""), "n", "source", *split("source_place", "source_"))


def digests_at(docs: DataFrame, places: DataFrame, k: int = WORDS) -> DataFrame:
    """Distinct rows of ``places`` (doc_id, copy, start, n) with the digest of the words there."""
    asked = places.select("doc_id", "copy", "start", "n").distinct().groupBy("doc_id", "copy").agg(F.collect_list(F.struct("start", "n")).alias("asked"))
    read = _texts(docs).join(asked, ["doc_id", "copy"]).mapInArrow(_digests(k), "doc_id long, copy int, start int, n int, digest binary")
    return read.dropDuplicates(["doc_id", "copy", "start", "n"])


def _with_source(docs: DataFrame, spans: DataFrame, k: int) -> DataFrame:
    """``spans`` with the digest of the words at the source's coordinates."""
    theirs = ["source", "source_copy", "source_start", "n"]
    at = spans.select(*(F.col(a).alias(b) for a, b in zip(theirs, ("doc_id", "copy", "start", "n"), strict=True)))
    there = save(digests_at(docs, at, k), "digests").selectExpr("doc_id as source", "copy as source_copy", "start as source_start", "n", "digest")
    return spans.join(there, theirs)


def verify_spans(docs: DataFrame, spans: DataFrame, k: int = WORDS) -> DataFrame:
    """``spans`` with ``equal``: whether the words at both coordinates are the same, by 128-bit digests."""
    own = digests_at(docs, spans, k).withColumnRenamed("digest", "own")
    both = _with_source(docs, spans, k).join(own, ["doc_id", "copy", "start", "n"])
    return both.select(*spans.columns, (F.col("digest") == F.col("own")).alias("equal"))


def remove_repeats(docs: DataFrame, k: int = WORDS, with_text: bool = False) -> DataFrame:
    """All columns of ``docs`` but text, with n_words, n_removed, kept_sha256 and, if asked for, kept_text.

    kept_text is the unchanged text where nothing goes, else the kept words joined by one space.
    A column of ``docs`` with one of these names is replaced.
    """
    made = ["n_words", "n_removed", "kept_sha256", *(["kept_text"] if with_text else [])]
    docs = docs.drop(*made)
    spans = _with_source(docs, repeated_spans(docs, k), k).groupBy(F.col("doc_id").alias("_doc_id"), F.col("copy").alias("_copy")).agg(F.collect_list(F.struct("start", "n", "digest")).alias("_repeated"))
    own = (F.col("doc_id") == F.col("_doc_id")) & (_copy() == F.col("_copy"))
    joined = docs.join(spans, own, "left").drop("_doc_id", "_copy")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"]
    out = ", ".join([*fields, "n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text])
    return joined.mapInArrow(_cut(k, with_text), out)

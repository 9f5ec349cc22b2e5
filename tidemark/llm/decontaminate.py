"""Benchmark decontamination with SimHash fingerprints of item-sized windows.

Words are lower-cased (A-Z) and taken in shingles of five; an item of fewer
words is one shingle. A window of a document has as many words as an item, or
is the whole document where that is shorter. Its 64-bit SimHash sums plus or
minus one for every shingle, by the bits of the shingle's hash. Items of one
length are indexed by each of BLOCKS blocks of their fingerprints; probing all
block values within RADIUS // BLOCKS bits finds every item within RADIUS bits.
Candidates are then verified by weighted Jaccard similarity: the sum of the
lesser over the sum of the greater multiplicities of shingles, PERCENT at least.

Only windows with enough benchmark shingles to reach that similarity at all are
fingerprinted, which an exact running count shows. Documents stay where they
are; the benchmark is sent to the executors in parts of at most PART_BYTES, one
pass over the documents to a part.

Null and empty texts contain nothing, and items without words match nothing.
Repeated rows are reported each. Ties between windows go to the first.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as tx

WORDS = 5
PERCENT = 80
RADIUS = 23
BLOCKS = 8
PART_BYTES = 8 << 20
_U = np.uint64


def shingles(h: np.ndarray, k: int = WORDS) -> np.ndarray:
    """Shingle hashes in order, repeats included."""
    if len(h) >= k or not len(h):
        return tx.rolling(h, k)
    return tx.spans(h, np.array([0]), np.array([len(h)]), tx.prefix(h))


def simhash(rows: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of shingle hashes."""
    bits = (tx.mix(rows, 71)[:, :, None] >> np.arange(64, dtype=_U)) & _U(1)
    ones = 2 * bits.sum(axis=1, dtype=np.int64) > rows.shape[1]
    return (ones.astype(_U) << np.arange(64, dtype=_U)).sum(axis=1, dtype=_U)


def similarity(a: Counter, b: Counter) -> tuple[int, int]:
    """Shared and total weight."""
    both = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return both, sum(a.values()) + sum(b.values()) - both


class Index:
    """Items of one part, by length in words and by fingerprint blocks."""

    def __init__(self, items: list[tuple[int, str]], k: int = WORDS, radius: int = RADIUS):
        self.k, self.radius = k, radius
        self.items, self.blocks = [], defaultdict(list)
        self.lengths: dict[int, int] = {}
        wide = 64 // BLOCKS
        near = [v for v in range(1 << wide) if v.bit_count() <= radius // BLOCKS]
        every = []
        for item_id, t in items:
            h = tx.words_of([t.encode()], lower=True).hashes
            if not len(h):
                continue
            s = shingles(h, k)
            every.append(s)
            self.lengths[len(h)] = len(s)
            self.items.append((item_id, len(h), int(simhash(s[None, :])[0]), Counter(s.tolist())))
        for at, (_, n, f, _) in enumerate(self.items):
            for b in range(BLOCKS):
                v = f >> (b * wide) & ((1 << wide) - 1)
                for x in near:
                    self.blocks[n, b, v ^ x].append(at)
        self.known = np.unique(np.concatenate(every)) if every else np.zeros(0, dtype=_U)
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[(self.known >> _U(44)).astype(np.int64)] = True

    def hits(self, s: np.ndarray) -> np.ndarray:
        out = self.filter[(s >> _U(44)).astype(np.int64)]
        at = np.flatnonzero(out)
        found = np.searchsorted(self.known, s[at])
        out[at] = self.known[np.minimum(found, len(self.known) - 1)] == s[at]
        return out

    def candidates(self, n: int, fingerprint: int) -> set[int]:
        wide = 64 // BLOCKS
        found: set[int] = set()
        for b in range(BLOCKS):
            found.update(self.blocks.get((n, b, fingerprint >> (b * wide) & ((1 << wide) - 1)), ()))
        return {x for x in found if (self.items[x][2] ^ fingerprint).bit_count() <= self.radius}


def _matches(index: Index, percent: int, s: np.ndarray, n_words: int) -> dict[int, tuple]:
    """By item: (similarity, start, window words, Hamming distance) of its best window in a document."""
    total = np.append(0, np.cumsum(index.hits(s)))
    best: dict[int, tuple] = {}
    for n, m in index.lengths.items():
        width = min(m, len(s))
        # shared weight of similar sets: percent of the union at least, so also of either
        least = -(-percent * (width + m) // (100 + percent))
        count = total[width:] - total[:-width]
        if n < index.k and n_words != n:
            continue  # an item shorter than a shingle is found as a whole document only
        for i in np.flatnonzero(count >= least):
            rows = s[i : i + width]
            f = int(simhash(rows[None, :])[0])
            own = None
            for x in index.candidates(n, f):
                own = own or Counter(rows.tolist())
                both, union = similarity(own, index.items[x][3])
                if 100 * both >= percent * union and (x not in best or (both / union, -int(i)) > (best[x][0], -best[x][1])):
                    best[x] = (both / union, int(i), min(n, n_words), (index.items[x][2] ^ f).bit_count())
    return best


def _found(index: Index, texts: list[bytes], k: int, percent: int) -> Iterator[tuple[int, dict[int, tuple]]]:
    """(position of a text, its matches) for the texts that have any."""
    for i, j in tx.slices(texts):
        w = tx.words_of(texts[i:j], lower=True)
        if not len(w.hashes) or not len(index.known):
            continue
        whole = tx.rolling(w.hashes, k)
        touched = np.flatnonzero(index.hits(whole)) if len(whole) else []
        docs = set(np.unique(w.doc_of_word()[touched]).tolist()) if len(touched) else set()
        docs |= set(np.flatnonzero((np.diff(w.offsets) < k) & (np.diff(w.offsets) > 0)).tolist())
        for d in sorted(docs):
            h = w.hashes[w.offsets[d] : w.offsets[d + 1]]
            if found := _matches(index, percent, shingles(h, k), len(h)):
                yield i + d, found


def _scan(part, k: int, percent: int, radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(part.value, k, radius)
        for batch in batches:
            ids, texts = tx.column(batch, "doc_id"), tx.texts_in(batch)
            out = [(ids[d], index.items[x][0], *m) for d, found in _found(index, texts, k, percent) for x, m in sorted(found.items())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32()))],
                names=["doc_id", "item_id", "similarity", "start", "n_words", "hamming"],
            )

    return run


def _drop(part, k: int, percent: int, radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(part.value, k, radius)
        for batch in batches:
            clean = np.ones(batch.num_rows, dtype=bool)
            clean[[d for d, _ in _found(index, tx.texts_in(batch), k, percent)]] = False
            yield batch.filter(pa.array(clean))

    return run


def _parts(benchmark: DataFrame) -> Iterator:
    """Broadcasts of the items, of at most about PART_BYTES each."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    parts = 1 if size <= PART_BYTES else -(-2 * size // PART_BYTES)
    for p in range(parts):
        own = items if parts == 1 else items.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(parts)) == p)
        yield benchmark.sparkSession.sparkContext.broadcast([tuple(r) for r in own.toLocalIterator()])


def without_leaks(docs: DataFrame, benchmark: DataFrame, k: int = WORDS, percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that contain no item, unchanged; texts are not shuffled."""
    for part in _parts(benchmark):
        docs = docs.mapInArrow(_drop(part, k, percent, radius), docs.schema)
    return docs


def contaminated(docs: DataFrame, benchmark: DataFrame, k: int = WORDS, percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, similarity, start, n_words, hamming): the best window of each leaked item."""
    slim = docs.select("doc_id", "text")
    out = "doc_id long, item_id long, similarity double, start int, n_words int, hamming int"
    return reduce(DataFrame.unionByName, [slim.mapInArrow(_scan(part, k, percent, radius), out) for part in _parts(benchmark)])

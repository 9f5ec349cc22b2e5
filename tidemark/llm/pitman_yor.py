"""Hierarchical Pitman-Yor language model of word pairs, and scores of whole texts.

Every context (the word before) is a restaurant whose customers are the training
tokens behind it; all contexts share one parent, the restaurant of single words,
above a uniform base over the open vocabulary. In a context, the tables of a dish
are seated by Gibbs sampling: each sweep seats the customers of every dish again,
given the tables of the others and the parent's probability of the dish. Past a
dish's first customers they are seated in blocks of a tenth of those seated, with
the probabilities at the block's start. The tables of all contexts are the
parent's customers: it starts with the tokens themselves, and after each of
PARENT_SWEEPS passes over the contexts takes the tables seated there, on average.
The parent's own tables are seated the same way, all dishes at once given their sum.
Predictive probabilities are averaged over the last pass's sweeps but the first.
All draws come from hashes of context, dish, sweep and customer, so that scores do
not depend on how rows are dealt out.

The exchanges are linear in the text and gather exact numbers for every word. Words
are counted first, by range, each slice of documents sending each of its words once.
Occurrences then go to buckets of contexts, once to ask for what is known of their
dishes, once to seat and once to score them. Rows are packed, one to a slice of
documents and bucket. A context with more than one in HOT_SHARE of all tokens (no
more than so many can be) is split over all buckets by dish; its customers are the
count of its word, and its tables are summed over buckets after each pass. A bucket
asks for each of its dishes once, by range of words, and ranges answer with the exact
number of training tokens and the parent's share of every dish. Only sums over the
whole parent and the hot contexts reach the driver. What scoring gives back is a sum
for each document and bucket.

Null texts count as empty: one end token. A null doc_id is scored and, unless
``held`` is true, trained on. Each repeated row counts in training and is scored.
A very long text is a slice of its own, ties have no meaning here. With nothing to
learn from every word has the base's probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as tx
from tidemark.llm.store import discard, save

#: Discount and strength of contexts; strength of the parent, whose discount is estimated.
DISCOUNT, STRENGTH, PARENT_STRENGTH = 0.8, 2.0, 1.0
BURN_IN, SWEEPS = 2, 4
PARENT_SWEEPS = 1
#: Contexts that are split by dish: those with more than one in so many training tokens, and this many at least.
HOT_SHARE, HOT_LEAST = 1 << 12, 1000
SEED = 7
#: Scores are summed as whole numbers of this fraction of a unit, whose sums do not depend on order.
FIXED = 1 << 20
#: Bounds of a slice: documents (their numbers take two bytes), and bytes of text.
ROWS, SLICE_BYTES = 2048, 2 << 20
SINGLE = 24
#: Above this variance a block's new tables are drawn as a rounded normal number.
NORMAL = 25.0
_U = np.uint64
_END, _BEGIN = (tx.mix(np.array([n], dtype=_U), 81)[0] for n in (1, 2))


def _bytes(x: np.ndarray, width: int) -> np.ndarray:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])


def _numbers(b: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(b) // width, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(b, dtype=np.uint8).reshape(-1, width)
    return out.view(_U).reshape(-1)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """First positions of runs of equal rows."""
    if not len(keys[0]):
        return np.zeros(0, dtype=np.int64)
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


#: Occurrences of hot contexts come first, with the number of their context each; the others are runs of one context.
#: Columns of ``_WIDTHS`` are squeezed, as numbers of so many bytes (words repeat whole).
_WIDTHS = {"hot": 2, "contexts": 7, "runs": 4, "docs": 2, "words": 1}
_PACKED = "bucket int, slice long, held binary, ids binary, sizes binary, hot binary, contexts binary, runs binary, docs binary, words binary"
#: To a range of words: some words, and training tokens of each or SWEEPS times its tables. Range -1: numbers of hot contexts and their tables.
_ASK = "range int, bucket int, words binary, counts binary, tables binary"
#: A range of the parent: its words, training tokens and customers, and their sums.
_PARENT = "range int, words binary, counts binary, customers binary, tokens long, kinds long, once long, twice long, seated double"


def _slices(batches: Iterator[pa.RecordBatch]):
    """(slice, ids, held, words) of slices of documents."""
    task, n = TaskContext.get(), 0
    base = (task.partitionId() if task else 0) << 32
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            part = batch.slice(k, ROWS)
            texts, ids, held = tx.texts_in(part), tx.column(part, "doc_id"), np.array(tx.column(part, "held"), dtype=bool)
            for a, b in tx.slices(texts, SLICE_BYTES):
                yield base + n, ids[a:b], held[a:b], tx.words_of(texts[a:b], lower=True)
                n += 1


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds[t]) for c, (_, t) in enumerate(fields)], names=[n for n, _ in fields])


def _narrow(v: np.ndarray) -> np.ndarray:
    """Whole numbers in as many bytes, one, four or eight, as the largest needs."""
    most = v.max(initial=0)
    return v.astype("<u1" if most < 1 << 8 else "<u4" if most < 1 << 32 else "<u8")


def _widened(b: bytes, n: int) -> np.ndarray:
    """n numbers that ``_narrow`` wrote."""
    return np.frombuffer(b, dtype=f"<u{len(b) // n}" if n else "<u1")


def _squeezed(b: bytes, width: int = 1) -> bytes:
    """Length, then zstd of the bytes; of wider numbers all first bytes come first, then all second ones and so on."""
    planes = b if width == 1 else np.frombuffer(b, dtype=np.uint8).reshape(-1, width).T.tobytes()
    return len(b).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True) if b else b


def _restored(b: bytes, width: int = 1) -> bytes:
    """What ``_squeezed`` was given."""
    if not b:
        return b
    whole = pa.decompress(memoryview(b)[8:], int.from_bytes(b[:8], "little"), codec="zstd", asbytes=True)
    return whole if width == 1 else np.frombuffer(whole, dtype=np.uint8).reshape(width, -1).T.tobytes()


def _ranges(words: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range begins among sorted words of 56 bits."""
    return np.searchsorted((words >> _U(56 - (ranges.bit_length() - 1))).astype(np.int64), np.arange(ranges + 1))


def _requests(bucket: int, words: np.ndarray, ranges: int, counts: np.ndarray | None, tables: np.ndarray | None) -> list[tuple]:
    """A row to each range for sorted words."""
    cut, own = _ranges(words, ranges), _bytes(words, 7)
    part = lambda v, a, b: None if v is None else _narrow(v[a:b]).tobytes()
    return [(r, bucket, own[a:b].tobytes(), part(counts, a, b), part(tables, a, b)) for r, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]


def _count(ranges: int):
    """Training tokens of each word of a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, held, w in _slices(batches):
            learn = np.repeat(~held, np.diff(w.offsets))
            words = np.append(w.hashes[learn], np.full(int((~held).sum()), _END)) >> _U(8)
            words, n = np.unique(words, return_counts=True)
            yield _table(_requests(0, words, ranges, n, None), _ASK)

    return run


@dataclass
class Hot:
    """Contexts split by dish, sorted, with their customers and tables."""

    contexts: np.ndarray
    customers: np.ndarray
    tables: np.ndarray

    def among(self, contexts: np.ndarray) -> np.ndarray:
        """Numbers of hot contexts, -1 for others."""
        if not len(self.contexts):
            return np.full(len(contexts), -1)
        # from the first of those that share its upper 16 bits, on past smaller ones
        many = np.bincount((self.contexts >> _U(40)).astype(np.int64), minlength=1 << 16)
        last = len(self.contexts) - 1
        at = np.minimum(np.cumsum(many) - many, last)[(contexts >> _U(40)).astype(np.int64)]
        for _ in range(int(many.max()) - 1):
            at += (self.contexts[at] < contexts) & (at < last)
        return np.where(self.contexts[at] == contexts, at, -1)


def _pack(buckets: int, hot: Hot):
    """Rows of contexts, with the words behind them, by bucket of the context, or of context and word where it is hot."""
    bits = buckets.bit_length() - 1
    shift = _U(56 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, held, w in _slices(batches):
            size = np.diff(w.offsets) + 1
            word = np.insert(w.hashes, w.offsets[1:], _END) >> _U(8)
            doc = np.repeat(np.arange(len(ids), dtype="<u2"), size)
            key = np.insert(w.hashes, w.offsets[:-1], _BEGIN) >> _U(8)
            bucket = key >> shift
            among = hot.among(key)
            split = among >= 0
            bucket[split] = (tx.mix(key[split] + tx.mix(word[split], 83), 84) >> _U(8)) >> shift
            # numbers that hold bucket, context and place sort faster than places do; two contexts cut alike give shorter runs
            places = len(key).bit_length()
            wide = 64 - bits - places
            inner = np.where(split, among.astype(_U), ((key << _U(8 + bits)) >> _U(65 - wide)) | _U(1 << (wide - 1)))
            inner = np.sort((bucket << _U(64 - bits)) | (inner << _U(places)) | np.arange(len(key), dtype=_U))
            order = (inner & _U((1 << places) - 1)).astype(np.int64)
            key, bucket, among, docs = key[order], inner >> _U(64 - bits), among[order], doc[order]
            first = _runs(key)
            first = first[among[first] < 0]
            at = np.searchsorted(bucket.astype(np.int64), np.arange(buckets + 1))
            at_run = np.searchsorted(first, at)
            warm = np.flatnonzero(among >= 0)
            at_hot = np.searchsorted(warm, at)
            numbers, cold = among[warm].astype("<u2"), np.append(np.cumsum(among < 0), 0)
            keys, run_n = _bytes(key[first], 7), np.diff(np.append(cold[first] - 1, cold[-2] if len(key) else 0)).astype("<u4")
            words = _bytes(word[order], 7)
            meta = int(tx.mix(np.array([number], dtype=_U))[0] % _U(buckets))
            rows, apart = [], np.packbits(held).tobytes()
            for b in range(buckets):
                x, y = at[b], at[b + 1]
                if x == y and b != meta:
                    continue
                about = (b"".join((i if i is not None else -(1 << 63)).to_bytes(8, "little", signed=True) for i in ids), size.astype("<u4").tobytes()) if b == meta else (None, None)
                rx, ry = at_run[b], at_run[b + 1]
                own = (numbers[at_hot[b] : at_hot[b + 1]], keys[rx:ry], run_n[rx:ry], docs[x:y], words[x:y])
                rows.append((b, number, apart, *about, *(_squeezed(v.tobytes(), width) for v, width in zip(own, _WIDTHS.values(), strict=True))))
            yield _table(rows, _PACKED)

    return run


_BACK = "slice long, bucket int, ids binary, sizes binary, held binary, docs binary, sums binary, base binary, known binary"


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of large values, without a second copy of a whole batch."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of each bucket of a partition that is sorted by bucket."""
    rows: list[dict] = []
    for r in _one_by_one(batches):
        if rows and rows[0]["bucket"] != r["bucket"]:
            yield rows
            rows = []
        if r["slice"] is not None:
            r |= {c: _restored(r[c], width) for c, width in _WIDTHS.items()}
        rows.append(r)
    if rows:
        yield rows


def _replies(rows: list[dict], lengths: list[int], doc: np.ndarray, score: np.ndarray, base: np.ndarray, known: np.ndarray) -> list[tuple]:
    """One row to a slice: its documents in this bucket and the sums of their values."""
    out, at = [], 0
    for r, n in zip(rows, lengths, strict=True):
        d = doc[at : at + n]
        there = np.unique(d)
        sums = [np.bincount(d, weights=v[at : at + n])[there] if n else np.zeros(0) for v in (score, base, known)]
        # numbers are as wide as the largest needs
        width = "<u1" if not n or sums[2].max() < 1 << 8 else "<u4"
        score_width = "<i4" if not n or np.abs(sums[0]).max() < 1 << 31 else "<i8"
        held = r["held"] if r["ids"] is not None else None
        out.append((r["slice"], r["bucket"], r["ids"], r["sizes"], held, _squeezed(there.astype("<u2").tobytes(), 2), _squeezed(sums[0].astype(score_width).tobytes(), int(score_width[-1])), sums[1].astype("<f8").tobytes(), _squeezed(sums[2].astype(width).tobytes())))
        at += n
    return out


def _held(r: dict) -> np.ndarray:
    return np.unpackbits(np.frombuffer(r["held"], dtype=np.uint8)).astype(bool)


@dataclass
class Parent:
    """Sums over the restaurant of single words."""

    tokens: int
    vocabulary: int
    discount: float
    customers: float
    tables: float

    def probability(self, share: np.ndarray) -> np.ndarray:
        """Of dishes whose customers, less the discount of their tables, are ``share``."""
        base = (PARENT_STRENGTH + self.discount * self.tables) / (self.vocabulary + 1)
        return (share + base) / (PARENT_STRENGTH + self.customers)


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once and twice else 0.5


class Draws:
    """Random numbers of cells, each from the cell's own key, the sweep and the customer."""

    def __init__(self, keys: np.ndarray, number: int):
        self.keys, self.base = keys.astype(_U), (SEED << 56) + (number << 48)

    def sweep(self, n: int) -> Draws:
        drawn = Draws(self.keys, 0)
        drawn.base = self.base + (n << 40)
        return drawn

    def of(self, cells: np.ndarray) -> Draws:
        drawn = Draws(self.keys[cells], 0)
        drawn.base = self.base
        return drawn

    def uniform(self, cells: np.ndarray | slice, customer: int, more: int = 0) -> np.ndarray:
        salt = _U(((self.base + (customer << 8) + more) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        return ((tx.mix(self.keys[cells] ^ salt, 85) >> _U(11)).astype(np.float64) + 0.5) / (1 << 53)

    def binomial(self, cells: np.ndarray, n: np.ndarray, p: np.ndarray, customer: int) -> np.ndarray:
        """Successes in n trials: exact by gaps between them, a rounded normal number where there are many."""
        turned = p > 0.5
        q = np.where(turned, 1 - p, p)
        out, spread = np.zeros(len(cells)), n * q * (1 - q)
        many = np.flatnonzero(spread > NORMAL)
        if len(many):
            a, b = (self.uniform(cells[many], customer, more) for more in (254, 255))
            z = np.sqrt(-2 * np.log(a)) * np.cos(2 * np.pi * b)
            out[many] = np.clip(np.rint(n[many] * q[many] + np.sqrt(spread[many]) * z), 0, n[many])
        left, at, more = np.flatnonzero((spread <= NORMAL) & (q > 0)), np.zeros(len(cells)), 0
        while len(left):
            at[left] += np.floor(np.log(self.uniform(cells[left], customer, more % 254)) / np.log1p(-q[left])) + 1
            left = left[at[left] <= n[left]]
            out[left] += 1
            more += 1
        return np.where(turned, n - out, out)


def seat(c: np.ndarray, tables_there: np.ndarray, p0: np.ndarray, draws: Draws, d: float = DISCOUNT, strength: float = STRENGTH, order: np.ndarray | None = None) -> np.ndarray:
    """Tables of each dish after seating its c customers one after the other.

    ``tables_there``: the restaurant's tables of other dishes; p0: the parent's probability;
    ``order``: what ``by_customers`` gives for c.
    """
    t = (c > 0).astype(np.float64)
    order = by_customers(c) if order is None else order
    # those with customers left stay in front
    left, there, up, own = -c[order], tables_there[order], p0[order], t[order]
    draws = draws.of(order)
    n, j = len(order), 1
    while n:
        step = 1 if j < SINGLE else max(1, j // 10)
        now = np.minimum(-left[:n] - j, step) if step > 1 else 1
        new = (strength + d * (there[:n] + own[:n])) * up[:n]
        p = new / (new + np.maximum(j - d * own[:n], 1e-12))
        own[:n] += draws.binomial(np.arange(n), now, p, j) if step > 1 else draws.uniform(slice(n), j) < p
        j += step
        n = int(np.searchsorted(left[:n], -j))
    t[order] = own
    return t


def by_customers(c: np.ndarray) -> np.ndarray:
    """Dishes of more than one customer, those with most first."""
    many = np.flatnonzero(c > 1)
    return many[np.argsort(-c[many], kind="stable")]


def sweeps(c: np.ndarray, context: np.ndarray, p0: np.ndarray, draws: Draws, split: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tables of each (context, dish) cell and of each context after Gibbs sweeps, the first BURN_IN left out.

    ``split``: of contexts whose other dishes are elsewhere, their tables in all; -1 for others.
    """
    n = int(context[-1]) + 1 if len(context) else 0
    split = np.full(n, -1.0) if split is None else split
    t = (c > 0).astype(np.float64)

    def summed() -> np.ndarray:
        return np.where(split >= 0, split, np.bincount(context, weights=t, minlength=n))

    total, order = summed(), by_customers(c)
    for sweep in range(BURN_IN + SWEEPS):
        t = seat(c, np.maximum(total[context] - t, 0), p0, draws.sweep(sweep), order=order)
        total = summed()
        if sweep >= BURN_IN:
            yield t, total


def predictive(c: np.ndarray, context: np.ndarray, p0: np.ndarray, draws: Draws, split: np.ndarray | None = None, customers: np.ndarray | None = None) -> np.ndarray:
    """Probability of each (context, dish) cell, averaged over Gibbs sweeps."""
    customers = np.bincount(context, weights=c) if customers is None else customers
    out = np.zeros(len(c))
    for t, total in sweeps(c, context, p0, draws, split):
        out += (np.maximum(c - DISCOUNT * t, 0) + (STRENGTH + DISCOUNT * total[context]) * p0) / (STRENGTH + customers[context])
    return out / SWEEPS


def _order(context: np.ndarray, kinds: int, word: np.ndarray) -> np.ndarray:
    """Places of occurrences by number of context, then word: by both in one number, as far as it holds a word's upper bits."""
    left = 64 - max(8, kinds.bit_length())
    both = (context << _U(left)) | (word >> _U(56 - left))
    order = np.argsort(both)
    both, word_there = both[order], word[order]
    if np.any((both[1:] == both[:-1]) & (word_there[1:] != word_there[:-1])):  # two words cut alike
        return np.lexsort((word, context))
    return order


class _Contexts:
    """Occurrences of one bucket of contexts, their (context, dish) cells and its dishes, in order."""

    def __init__(self, rows: list[dict], hot: Hot):
        self.answers = sorted((r for r in rows if r["slice"] is None), key=lambda r: r["range"])
        self.rows = rows = [r for r in rows if r["slice"] is not None]
        docs = [np.frombuffer(r["docs"], dtype="<u2").astype(np.int64) for r in rows]
        self.doc, self.lengths = np.concatenate(docs), [len(d) for d in docs]
        learn = np.concatenate([~_held(r)[d] for r, d in zip(rows, docs, strict=True)])
        runs = [_numbers(r["contexts"], 7) for r in rows]
        kinds, number = np.unique(np.concatenate([hot.contexts, *runs]), return_inverse=True)
        numbers = np.split(number.astype(_U), np.cumsum([len(hot.contexts), *map(len, runs[:-1])]))
        context = np.concatenate([x for r, own in zip(rows, numbers[1:], strict=True) for x in (numbers[0][np.frombuffer(r["hot"], dtype="<u2")], np.repeat(own, np.frombuffer(r["runs"], dtype="<u4")))])
        word = np.concatenate([_numbers(r["words"], 7) for r in rows])
        order = _order(context, len(kinds), word)
        context, word = context[order], word[order]
        first = _runs(context, word)
        self.cell = np.empty(len(order), dtype=np.int64)
        self.cell[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        self.customers = np.bincount(self.cell, weights=learn, minlength=len(first)).astype(np.int64)
        own = kinds[context[first].astype(np.int64)]
        self.context = np.zeros(len(first), dtype=np.int64)
        self.context[1:] = np.cumsum(own[1:] != own[:-1])
        self.dishes, self.dish = np.unique(word[first], return_inverse=True)
        self.keys = tx.mix(own + tx.mix(word[first], 86), 87)
        # of each context: its number among the hot ones, their tables, and customers of any
        self.hot = hot.among(own[_runs(own)])
        split = self.hot >= 0
        self.split = np.full(len(split), -1.0)
        self.split[split] = hot.tables[self.hot[split]]
        self.all_customers = np.bincount(self.context, weights=self.customers, minlength=len(split))
        self.all_customers[split] = hot.customers[self.hot[split]]

    def answered(self, column: str) -> np.ndarray:
        """What ranges answered for each dish, shares or counts: ranges are in the order of dishes."""
        shares = [np.frombuffer(r["shares"], dtype="<f4").astype(np.float64) for r in self.answers]
        got = np.concatenate(shares if column == "shares" else [_widened(r["counts"], len(s)) for r, s in zip(self.answers, shares, strict=True)]) if shares else np.zeros(0)
        if len(got) != len(self.dishes):
            raise ValueError(f"{len(got)} answers to {len(self.dishes)} requests")
        return got

    def ask(self, ranges: int, tables: np.ndarray | None) -> pa.RecordBatch:
        """Requests to ranges, with SWEEPS times the tables by dish, and those of hot contexts, as many as dishes at first."""
        total = None if tables is None else np.rint(np.bincount(self.dish, weights=tables, minlength=len(self.dishes)))
        rows = _requests(self.rows[0]["bucket"], self.dishes, ranges, None, total)
        there = np.flatnonzero(self.hot >= 0)
        if len(there):
            own = np.bincount(self.context, weights=self.customers > 0 if tables is None else tables, minlength=len(self.hot))[there]
            rows.append((-1, self.rows[0]["bucket"], self.hot[there].astype("<u4").tobytes(), None, np.rint(own).astype("<u4").tobytes()))
        return _table(rows, _ASK)


def _ask(ranges: int, hot: Hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches):
            yield _Contexts(rows, hot).ask(ranges, None)

    return run


def _seat_all(parent: Parent, ranges: int, hot: Hot, number: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches):
            x = _Contexts(rows, hot)
            p0 = parent.probability(x.answered("shares"))[x.dish]
            tables = np.zeros(len(x.dish))
            for t, _ in sweeps(x.customers, x.context, p0, Draws(x.keys, number), x.split):
                tables += t
            yield x.ask(ranges, tables)

    return run


def _score(parent: Parent, hot: Hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches):
            x = _Contexts(rows, hot)
            count = x.answered("counts")[x.dish]
            p0 = parent.probability(x.answered("shares"))[x.dish]
            p = predictive(x.customers, x.context, p0, Draws(x.keys, 0), x.split, x.all_customers)
            yield _table(_replies(x.rows, x.lengths, x.doc, np.rint(np.log10(p) * FIXED)[x.cell], np.log10(count + 0.1)[x.cell], (count > 0)[x.cell]), _BACK)

    return run


def _hot_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tables of hot contexts, summed within a task."""
    total: dict[int, int] = {}
    for r in _one_by_one(batches):
        for h, n in zip(np.frombuffer(r["words"], dtype="<u4").tolist(), np.frombuffer(r["tables"], dtype="<u4").tolist(), strict=True):
            total[h] = total.get(h, 0) + n
    yield _table(list(total.items()), "hot int, tables long")


def _hot_words(least: float):
    """Words with so many training tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _one_by_one(batches):
            words, count = _numbers(r["words"], 7), np.frombuffer(r["counts"], dtype="<i8")
            there = count >= least
            yield _table(list(zip(words[there].astype(np.int64).tolist(), count[there].tolist(), strict=True)), "word long, count long")

    return run


def _sum(seated: bool):
    """Ranges of the parent, summed; partitions are sorted by range. Rows of bucket -1 are the parent so far.

    Customers are the tables that buckets have seated, or the tokens as long as there are none.
    """

    def join(parts: list[tuple]) -> tuple[np.ndarray, ...]:
        words, of = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return words, *(np.bincount(of, weights=np.concatenate([p[k] for p in parts]), minlength=len(words)) for k in (1, 2))

    def emit(number: int, parts: list[tuple]) -> pa.RecordBatch:
        words, count, customers = join(parts)
        seen = count > 0
        words, count, customers = words[seen], count[seen].astype("<i8"), customers[seen]
        sums = (int(count.sum()), len(count), int((count == 1).sum()), int((count == 2).sum()), float(customers.sum()))
        return _table([(number, _bytes(words, 7).tobytes(), count.tobytes(), customers.astype("<f8").tobytes(), *sums)], _PARENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, held = None, [], 0
        for r in _one_by_one(batches):
            if now is not None and r["range"] != now:
                yield emit(now, parts)
                parts, held = [], 0
            now, words = r["range"], _numbers(r["words"], 7)
            count = np.zeros(len(words)) if r["counts"] is None else np.frombuffer(r["counts"], dtype="<i8") if r["bucket"] < 0 else _widened(r["counts"], len(words))
            tables = _widened(r["tables"], len(words)) / SWEEPS if r["tables"] is not None else np.zeros(len(words)) if seated else count
            parts.append((words, count, tables))
            held += len(words)
            if held > 1_000_000:  # summed as it grows: no more than one table of the range stays
                parts = [join(parts)]
                held = len(parts[0][0])
        if now is not None:
            yield emit(now, parts)

    return run


_SHARES = "range int, words binary, counts binary, shares binary, tables double"


def _seat_parent(parent: Parent, number: int):
    """Customers of the parent's dishes less the discount of their tables, seated given the tables of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _one_by_one(batches):
            words, customers = _numbers(r["words"], 7), np.frombuffer(r["customers"], dtype="<f8")
            c, p0 = np.ceil(customers).astype(np.int64), np.full(len(words), 1 / (parent.vocabulary + 1))
            tables, order = np.zeros(len(words)), by_customers(c)
            for sweep in range(SWEEPS):
                tables += seat(c, np.full(len(words), max(parent.tables - 1, 0.0)), p0, Draws(tx.mix(words, 88), number).sweep(sweep), parent.discount, PARENT_STRENGTH, order)
            tables /= SWEEPS
            yield _table([(r["range"], r["words"], r["counts"], np.maximum(customers - parent.discount * tables, 0).astype("<f8").tobytes(), float(tables.sum()))], _SHARES)

    return run


_ANSWER = "bucket int, range int, counts binary, shares binary"


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact numbers of the dishes asked for; a range's parent comes before its requests. Unknown dishes have none."""
    now, words, count, share = None, None, None, None
    for r in _one_by_one(batches):
        if r["bucket"] < 0:
            now, words, count, share = r["range"], _numbers(r["words"], 7), np.frombuffer(r["counts"], dtype="<i8"), np.frombuffer(r["shares"], dtype="<f8")
            continue
        asked = _numbers(r["words"], 7)
        if r["range"] != now or not len(words):  # nothing was learned there
            values = [np.zeros(len(asked))] * 2
        else:
            at = np.minimum(np.searchsorted(words, asked), len(words) - 1)
            values = [np.where(words[at] == asked, v[at], 0) for v in (count, share)]
        yield _table([(r["bucket"], r["range"], _narrow(values[0]).tobytes(), values[1].astype("<f4").tobytes())], _ANSWER)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over buckets for each document of a slice; partitions are sorted by slice."""

    def emit(rows: list[dict]) -> pa.RecordBatch:
        about = next(r for r in rows if r["ids"] is not None)
        ids = np.frombuffer(about["ids"], dtype="<i8")
        score, base, seen = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), dtype=np.int64)
        for r in sorted(rows, key=lambda r: r["bucket"]):
            d = np.frombuffer(_restored(r["docs"], 2), dtype="<u2")
            if not len(d):
                continue
            score_width = int.from_bytes(r["sums"][:8], "little") // len(d)
            score[d] += np.frombuffer(_restored(r["sums"], score_width), dtype=f"<i{score_width}")
            base[d] += np.frombuffer(r["base"], dtype="<f8")
            seen[d] += _widened(_restored(r["known"]), len(d))
        cols = [pa.array(ids, mask=ids == -(1 << 63)), pa.array(_held(about)[: len(ids)]), pa.array(np.frombuffer(about["sizes"], dtype="<u4").astype(np.int64)), pa.array(seen), pa.array(base), pa.array(score / FIXED)]
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "held_out", "n_tokens", "n_known", "base", "score"])

    rows: list[dict] = []
    for r in _one_by_one(batches):
        if rows and rows[0]["slice"] != r["slice"]:
            yield emit(rows)
            rows = []
        rows.append(r)
    if rows:
        yield emit(rows)


def score_texts(docs: DataFrame, held: Column) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``.

    Documents for which ``held`` is true are scored only. base_score is that of
    single words with 0.1 added to every count.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # what is sent is a row for each slice and bucket, and for each bucket and range
    buckets = 1 << min(16, max(6, (2 * tasks - 1).bit_length()))
    ranges = 1 << min(16, max(4, (tasks - 1).bit_length() - 2))
    slim = docs.select("doc_id", "text", F.coalesce(held, F.lit(False)).alias("held"))

    def exchange(reply, schema: str, hot: Hot, answers: DataFrame | None = None) -> DataFrame:
        packed = slim.mapInArrow(_pack(buckets, hot), _PACKED)
        if answers is not None:
            packed = packed.unionByName(answers, allowMissingColumns=True)
        return packed.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(reply, schema)

    def by_range(rows: DataFrame) -> DataFrame:
        return rows.repartition(tasks, "range").sortWithinPartitions("range", "bucket")

    def summed(rows: DataFrame, number: int) -> tuple[DataFrame, DataFrame, Parent]:
        """The parent's numbers, its shares after seating, and sums."""
        table = save(by_range(rows).mapInArrow(_sum(number > 0), _PARENT), "parent")
        total = table.agg(*(F.sum(c) for c in ("tokens", "kinds", "once", "twice", "seated"))).first()
        tokens, kinds, once, twice, customers = (x or 0 for x in total)
        parent = Parent(tokens, kinds, _discount(once, twice), float(customers), float(kinds))
        shares = None
        for step in (0, 1):  # given as many tables as dishes, then given those seated
            if shares is not None:
                discard(shares)
            shares = save(table.mapInArrow(_seat_parent(parent, 2 + 2 * number + step), _SHARES), "shares")
            parent.tables = float(shares.agg(F.sum("tables")).first()[0] or 0.0)
        return table, shares, parent

    def answered(asked: DataFrame, shares: DataFrame) -> DataFrame:
        both = asked.where("range >= 0").select("range", "bucket", "words").unionByName(shares.select("range", F.lit(-1).alias("bucket"), "words", "counts", "shares"), allowMissingColumns=True)
        return save(by_range(both).mapInArrow(_answer, _ANSWER), "answers")

    def hot_tables(asked: DataFrame, times: int) -> np.ndarray:
        found = asked.where("range = -1").mapInArrow(_hot_tables, "hot int, tables long").groupBy("hot").agg(F.sum("tables")).collect()
        tables = np.zeros(len(hot.contexts))
        for h, n in found:
            tables[h] = n / times
        return tables

    table, shares, parent = summed(slim.mapInArrow(_count(ranges), _ASK), 0)
    frequent = table.mapInArrow(_hot_words(max(HOT_LEAST, parent.tokens / HOT_SHARE)), "word long, count long").collect()
    end, begin = int(_END >> _U(8)), int(_BEGIN >> _U(8))
    # as many contexts begin a text as tokens end one
    frequent = sorted([(w, n) for w, n in frequent] + [(begin, n) for w, n in frequent if w == end])
    hot = Hot(np.array([w for w, _ in frequent], dtype=_U), np.array([n for _, n in frequent], dtype=np.float64), np.zeros(len(frequent)))
    asked = save(exchange(_ask(ranges, hot), _ASK, hot), "requests")
    hot.tables = hot_tables(asked, 1)
    for number in range(1, PARENT_SWEEPS + 1):
        answers = answered(asked, shares)
        discard(asked)
        asked = save(exchange(_seat_all(parent, ranges, hot, number), _ASK, hot, answers), "tables")
        discard(answers)
        discard(shares)
        hot.tables = hot_tables(asked, SWEEPS)
        so_far = table.select("range", F.lit(-1).alias("bucket"), "words", "counts", F.lit(None).cast("binary").alias("tables"))
        before = table
        table, shares, parent = summed(asked.where("range >= 0").unionByName(so_far), number)
        discard(before)
    answers = answered(asked, shares)
    for used in (asked, shares, table):
        discard(used)
    replies = exchange(_score(parent, hot), _BACK, hot, answers).repartition(tasks, "slice").sortWithinPartitions("slice")
    scored = replies.mapInArrow(_gather, "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double")
    per_token = F.log10(F.lit(parent.tokens + 0.1 * (parent.vocabulary + 1)))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(parent.tokens).cast("long").alias("train_tokens"), (F.col("base") - F.col("n_tokens") * per_token).alias("base_score"), "score"
    )

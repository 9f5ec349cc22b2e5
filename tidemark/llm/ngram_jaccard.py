"""N-gram Jaccard join with PartEnum signatures.

A document's features are its distinct word shingles. Two sets a, b with Jaccard
similarity of J or more differ in at most (|a| + |b|) (1 - J) / (1 + J) features,
so sizes fall into bands: a set signs its own band, and the next one if it is
large enough to be similar to a set there. In a band the feature domain is split
into groups of three partitions. If the differing features are fewer than two to
a group, some group has two partitions without any, so each group is signed by
its subsets of two partitions, the hash of the set's features in them; similar
sets share a signature. Only subsets with a feature are signed. How many
differences would be needed to break every signature of a set is counted
exactly; a set that could be broken by fewer than the bound allows signs again
under further partitionings of the domain until one is proof. Of two similar
sets both sign up to the one that is proof for either, so no pair is lost.

Equal sets, by 128 bits of digest and their size, have one node, which stands for its
smallest document. Signatures travel packed, 12 bytes each, in one row to a slice of
documents and bucket, so one common signature is not one hot key; buckets are gone
through one by one. A signature of up to SMALL nodes yields all its pairs, a larger one a star. Pairs
whose profiles, counts of features by bucket, show too great a difference are
dropped and the others verified on whole texts. Once the components of the
verified pairs are known, larger signatures with more than one are gone through
again: their documents in different components are compared exactly, block by
block, and one link is returned for each union. Every pair that could connect two
components is so compared; copies are never expanded into pairs.

Null and empty texts have an empty set and no links. A document with fewer words
than a shingle has its whole word sequence as one feature. A null doc_id gets a
row but no links. Rows that repeat a doc_id with other texts link through it, as
each text has a node of its own and the nodes of one document are one class. Ties
between documents go to the smaller id; very long texts are signed whole.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text as tx
from tidemark.llm.components import components
from tidemark.llm.store import discard, save

WORDS = 5
#: Least similarity in percent.
PERCENT = 80
RATIO = 1.6
SMALL = 6
#: Documents of a block where those of large signatures are compared.
BLOCK = 1024
#: Buckets of a set's profile.
PROFILE = 256
_U = np.uint64
_LOW48 = _U((1 << 48) - 1)


def shingles_of(w: tx.Words, k: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document."""
    whole = tx.rolling(w.hashes, k)
    out = []
    for a, b in zip(w.offsets[:-1], w.offsets[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(whole[a : b - k + 1]))
        elif b > a:
            h = w.hashes[a:b]
            out.append(tx.spans(h, np.array([0]), np.array([len(h)]), tx.prefix(h)))
        else:
            out.append(np.zeros(0, dtype=_U))
    return out


def digest(s: np.ndarray) -> tuple[int, int]:
    """Of a whole set, two independent numbers of 64 bits, signed."""
    sums = [tx.mix(s, seed).sum(dtype=_U) + _U(len(s)) for seed in (21, 23)]
    return tuple(tx.mix(np.array(sums), 22).view(np.int64).tolist())


def profile(s: np.ndarray) -> bytes:
    """Numbers of features by bucket, 255 at most each.

    The summed differences of two profiles are never more than the sets' own difference.
    """
    return np.minimum(np.bincount((tx.mix(s, 61) >> _U(56)).astype(np.int64), minlength=PROFILE), 255).astype(np.uint8).tobytes()


def bands(largest: int, ratio: float = RATIO) -> np.ndarray:
    """First sizes of the bands, up to the one behind ``largest``."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, int(np.ceil(out[-1] * ratio))))
    return np.array([*out, max(out[-1] + 1, int(np.ceil(out[-1] * ratio)))])


def _most_different(size: np.ndarray, top: np.ndarray, percent: int) -> np.ndarray:
    """Bound of the differences of a set of this size and any similar one of up to ``top``."""
    other = np.minimum(top, size * 100 // percent)
    return (size + other) * (100 - percent) // (100 + percent)


def signatures(sets: list[np.ndarray], percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(set index, signature) of all sets, by the scheme above."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    limits = bands(int(size.max(initial=1)))
    home = np.searchsorted(limits, size, "right") - 1
    # a set that no other can resemble needs none
    alone = size < 100 // (100 - percent) - 1
    own = np.flatnonzero(~alone)
    visits = own[size[own] * 100 >= percent * limits[home[own] + 1]]
    who = np.concatenate([own, visits])
    band = np.concatenate([home[own], home[visits] + 1])
    out_who, out_sig = [], []
    for seed in itertools.count():
        if not len(who):
            break
        top = limits[band + 1] - 1
        most = _most_different(size[who], top, percent)
        # enough that a set with features in two partitions of nearly every group is proof
        groups = (_most_different(top, top, percent) * 0.54).astype(np.int64) + 2
        base = np.cumsum(np.append(0, groups * 3))
        h = np.concatenate([sets[i] for i in who])
        of = np.repeat(np.arange(len(who)), size[who])
        x = tx.mix(h, 100 + seed)
        group = ((x >> _U(32)) * groups[of].astype(_U) >> _U(32)).astype(np.int64)
        cell = base[of] + group * 3 + (x & _U(0xFFFF)).astype(np.int64) % 3
        y = tx.mix(h, 41)
        n = np.bincount(cell, minlength=base[-1]).reshape(-1, 3)
        # exact sums modulo 2**64 from two halves
        low = np.bincount(cell, weights=(y & _U(0xFFFFFFFF)).astype(np.float64), minlength=base[-1]).astype(_U)
        high = np.bincount(cell, weights=(y >> _U(32)).astype(np.float64), minlength=base[-1]).astype(_U)
        total = (low + (high << _U(32))).reshape(-1, 3)
        owner = np.repeat(np.arange(len(who)), groups)
        number = np.arange(len(owner)) - (base[:-1] // 3)[owner]
        tag = tx.mix((band[owner].astype(_U) << _U(48)) + (number.astype(_U) << _U(16)) + _U(seed), 51)
        for j, (p, q) in enumerate(((0, 1), (0, 2), (1, 2))):
            used = n[:, p] + n[:, q] > 0
            out_sig.append(tx.mix(total[used, p] + total[used, q] + tag[used] + _U(j * 0x632BE59BD9B4E019), 52))
            out_who.append(who[owner[used]])
        broken_by = np.bincount(owner, weights=np.minimum((n > 0).sum(axis=1), 2), minlength=len(who))
        weak = broken_by <= most
        who, band = who[weak], band[weak]
    if not out_who:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=_U)
    return np.concatenate(out_who), np.concatenate(out_sig)


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, own = tx.texts_in(batch), [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "copy")]
            for i, j in tx.slices(texts):
                sets = shingles_of(tx.words_of(texts[i:j], lower=True), k)
                names = [digest(s) for s in sets]
                cols = [*(c.slice(i, j - i) for c in own), pa.array([len(s) for s in sets], pa.int64()), *(pa.array([d[x] for d in names], pa.int64()) for x in (0, 1)), pa.array([profile(s) for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "copy", "n_shingles", "node", "more", "profile"])

    return run


def _six(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _eight(x: bytes) -> np.ndarray:
    out = np.zeros((len(x) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(x, dtype=np.uint8).reshape(-1, 6)
    return out.view(_U).reshape(-1)


def _packed(k: int, percent: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tx.texts_in(batch)
            for i, j in tx.slices(texts):
                sets, seen = [], set()
                for s in shingles_of(tx.words_of(texts[i:j], lower=True), k):
                    if len(s) and (d := digest(s)) not in seen:
                        seen.add(d)
                        sets.append((d, s))
                if not sets:
                    continue
                who, sig = signatures([s for _, s in sets], percent)
                node = (np.array([d[0] for d, _ in sets], dtype=np.int64).view(_U) & _LOW48)[who]
                bucket = ((sig >> _U(40)) * _U(buckets) >> _U(24)).astype(np.uint32)
                order = np.argsort(bucket, kind="stable")
                sig, node, bucket = sig[order], node[order], bucket[order]
                cut = np.flatnonzero(np.diff(bucket)) + 1
                a, b = np.append(0, cut), np.append(cut, len(bucket))
                if not len(bucket):
                    continue
                six, nodes = _six(sig), _six(node)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[a].astype(np.int32)), pa.array([six[6 * x : 6 * y] for x, y in zip(a, b, strict=True)], pa.binary()), pa.array([nodes[6 * x : 6 * y] for x, y in zip(a, b, strict=True)], pa.binary())],
                    names=["bucket", "sigs", "nodes"],
                )

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, shared) with a < b, and members (sig, a) of large signatures with null b; rows are sorted by bucket."""
    now, sigs, nodes = None, [], []
    for batch in batches:
        for bucket, s, n in zip(*(tx.column(batch, c) for c in ("bucket", "sigs", "nodes")), strict=True):
            if bucket != now and sigs:
                yield from _met(now, np.concatenate(sigs), np.concatenate(nodes))
                sigs, nodes = [], []
            now = bucket
            sigs.append(_eight(s))
            nodes.append(_eight(n))
    if sigs:
        yield from _met(now, np.concatenate(sigs), np.concatenate(nodes))


def _met(bucket: int, sig: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of one bucket, whose signatures are told apart by their lower 48 bits."""
    order = np.argsort(sig, kind="stable")
    sig, node = sig[order], node[order]
    # keep signatures of several entries, then drop repeated nodes
    twin = np.zeros(len(sig), dtype=bool)
    eq = sig[1:] == sig[:-1]
    twin[1:] |= eq
    twin[:-1] |= eq
    sig, node = sig[twin], node[twin]
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    new = np.ones(len(sig), dtype=bool)
    new[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
    sig, node = sig[new], node[new]
    first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])) if len(sig) else np.zeros(0, dtype=np.int64)
    n = np.diff(np.append(first, len(sig)))
    a, b = [], []
    for size in range(2, SMALL + 1):
        at = first[n == size]
        for x in range(size):
            for y in range(x + 1, size):
                a.append(node[at + x])
                b.append(node[at + y])
    large = first[n > SMALL], n[n > SMALL]
    member = np.repeat(large[0], large[1]) + np.arange(large[1].sum()) - np.repeat(np.cumsum(large[1]) - large[1], large[1])
    hub = np.repeat(large[0], large[1])
    a.append(node[hub[member != hub]])
    b.append(node[member[member != hub]])
    pair, count = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0, return_counts=True) if sum(map(len, a)) else (np.zeros((0, 2), dtype=_U), np.zeros(0, dtype=np.int64))
    yield pa.RecordBatch.from_arrays(
        [pa.nulls(len(pair), pa.int64()), pa.array(pair[:, 0].astype(np.int64)), pa.array(pair[:, 1].astype(np.int64)), pa.array(count.astype(np.int64))],
        names=["sig", "a", "b", "shared"],
    )
    if len(member):
        name = tx.mix(sig[member] ^ (_U(bucket) << _U(40)), 53)
        yield pa.RecordBatch.from_arrays([tx.signed(name), pa.array(node[member].astype(np.int64)), pa.nulls(len(member), pa.int64()), pa.nulls(len(member), pa.int64())], names=["sig", "a", "b", "shared"])


def _possible(percent: int):
    """Pairs whose profiles leave the similarity possible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = np.zeros(0, dtype=bool)
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                a, b = (np.frombuffer(b"".join(tx.column(part, c)), dtype=np.uint8).reshape(-1, PROFILE).astype(np.int16) for c in ("pa", "pb"))
                size = part.column(part.schema.get_field_index("na")).to_numpy() + part.column(part.schema.get_field_index("nb")).to_numpy()
                kept = np.append(kept, (100 + percent) * np.abs(a - b).sum(axis=1, dtype=np.int64) <= (100 - percent) * size)
            yield batch.filter(pa.array(kept, pa.bool_())).select(["a", "copy_a", "b", "copy_b", "shared"])

    return run


def _verify(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[tuple[int, int] | None, np.ndarray | None] = (None, None)
        for batch in batches:
            b = list(zip(tx.column(batch, "b"), tx.column(batch, "copy_b"), strict=True))
            left, right = tx.texts_in(batch, "text_a"), tx.texts_in(batch, "text_b")
            kept = []
            for x in range(len(b)):
                if last[0] != b[x]:
                    last = b[x], shingles_of(tx.words_of([right[x]], lower=True), k)[0]
                mine = shingles_of(tx.words_of([left[x]], lower=True), k)[0]
                both = len(np.intersect1d(mine, last[1], assume_unique=True))
                kept.append(100 * both >= percent * (len(mine) + len(last[1]) - both))
            yield batch.filter(pa.array(kept, pa.bool_())).select(["a", "b"])

    return run


def _across(k: int, percent: int):
    """Links between components among the documents of one family, or of two of its blocks.

    Every pair of different components is compared, one link for each union is returned.
    """

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids, comp, side = (table.column(c).to_numpy() for c in ("doc_id", "component", "side"))
        texts = [t or b"" for t in table.column("text").cast(pa.binary()).to_pylist()]
        sets = [s for i, j in tx.slices(texts) for s in shingles_of(tx.words_of(texts[i:j], lower=True), k)]
        size = np.array([len(s) for s in sets], dtype=np.int64)
        feature = np.unique(np.concatenate(sets), return_inverse=True)[1]
        at = np.append(0, np.cumsum(size))
        names, root = np.unique(comp, return_inverse=True)
        outside = np.flatnonzero(root != np.bincount(root).argmax())
        mark, out = np.zeros(int(feature.max()) + 1, dtype=np.int64), []
        for x in outside:
            open_ = (root != root[x]) & ((side == 2) | (side != side[x]))
            open_ &= 100 * np.minimum(size, size[x]) >= percent * np.maximum(size, size[x])
            if not open_.any():
                continue
            own = feature[at[x] : at[x + 1]]
            mark[own] = 1
            both = np.add.reduceat(mark[feature], at[:-1])
            mark[own] = 0
            for y in np.flatnonzero(open_ & (100 * both >= percent * (size + size[x] - both))):
                if root[y] != root[x]:
                    out.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
                    root[root == root[y]] = root[x]
        return pa.table({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())})

    return run


def _hopeful(percent: int):
    """Documents of a family, or of two of its blocks, that profiles leave a link to another component."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids, comp, side, size = (table.column(c).to_numpy() for c in ("doc_id", "component", "side", "n_shingles"))
        prof = np.frombuffer(b"".join(table.column("profile").to_pylist()), dtype=np.uint8).reshape(-1, PROFILE).astype(np.int16)
        root = np.unique(comp, return_inverse=True)[1]
        found = np.zeros(len(ids), dtype=bool)
        for x in np.flatnonzero(root != np.bincount(root).argmax()):
            y = np.flatnonzero((root != root[x]) & ((side == 2) | (side != side[x])) & (100 * np.minimum(size, size[x]) >= percent * np.maximum(size, size[x])))
            near = y[(100 + percent) * np.abs(prof[y] - prof[x]).sum(axis=1, dtype=np.int64) <= (100 - percent) * (size[y] + size[x])]
            if len(near):
                found[near] = found[x] = True
        return pa.table({"family": pa.array([key[0].as_py()] * int(found.sum()), pa.int64()), "doc_id": pa.array(ids[found], pa.int64())})

    return run


def _in_blocks(inside: DataFrame) -> DataFrame:
    """Rows of families placed in pairs of blocks (x, y); side 2 stands for both, where x = y."""
    blocks = inside.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = inside.join(blocks, "family").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other"), "side": F.expr("if(block = other, 2, if(block < other, 0, 1))")})


def _links(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Those pairs (a, copy_a, b, copy_b) of texts that are similar, as pairs (a, b) of document ids."""
    of = lambda x: texts.select(F.col("doc_id").alias(x), F.col("copy").alias(f"copy_{x}"), F.col("text").alias(f"text_{x}"))
    full = pairs.join(of("a"), ["a", "copy_a"]).join(of("b"), ["b", "copy_b"])
    return save(full.select("a", "b", "copy_b", "text_a", "text_b").mapInArrow(_verify(k, percent), "a long, b long").distinct(), "links")


def _open(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one component yet."""
    c = lambda x: comps.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    own = lambda x: F.coalesce(f"c{x}", F.col(x))
    return pairs.join(c("a"), "a", "left").join(c("b"), "b", "left").where(own("a") != own("b")).select(*pairs.columns)


def _residual(members: DataFrame, nodes: DataFrame, comps: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links across components among the documents of large signatures.

    Signatures with one component only are done. The others are gathered in families, those
    with the same largest component, so that a document is compared once for all of them:
    first by profiles, then, where these leave a link possible, exactly.
    """
    own = save(members.drop("n_shingles").join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id")), "members")
    parts = own.groupBy("sig", "component").agg(F.count(F.lit(1)).alias("n"))
    family = parts.groupBy("sig").agg(F.max_by("component", F.struct("n", -F.col("component"))).alias("family"), (F.count(F.lit(1)) > 1).alias("open")).where("open")
    inside = save(own.join(family, "sig").select("family", "doc_id", "copy", "component").distinct(), "families")
    profiles = nodes.select(F.col("rep").alias("doc_id"), "copy", "n_shingles", "profile")
    hopeful = save(_in_blocks(inside).join(profiles, ["doc_id", "copy"]).groupBy("family", "x", "y").applyInArrow(_hopeful(percent), "family long, doc_id long").distinct(), "hopeful")
    placed = _in_blocks(inside.join(hopeful, ["family", "doc_id"])).join(texts, ["doc_id", "copy"]).select("family", "x", "y", "side", "doc_id", "component", "text")
    return save(placed.groupBy("family", "x", "y").applyInArrow(_across(k, percent), "a long, b long").distinct(), "late")


def _of_one_id(keyed: DataFrame, several: DataFrame, nodes: DataFrame, name: list[str]) -> DataFrame:
    """Pairs (a, b) of the documents that stand for the different texts of one doc_id."""
    reps = keyed.join(several, "doc_id").select("doc_id", *name).distinct().join(nodes.select(*name, "rep"), name)
    return reps.where("rep <> doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))


def similar_groups(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, links_used) for each row of ``docs``.

    component_id is the smallest doc_id reachable by links, the document's own
    included; links_used counts the links of its set to others that were needed
    to join the component, not those within it that were left untested.
    """
    spark: SparkSession = docs.sparkSession
    copy = F.expr("cast(xxhash64(text) & 2147483647 as int)").alias("copy")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), copy, "text")
    rows = save(slim.mapInArrow(_sets(k), "doc_id long, copy int, n_shingles long, node long, more long, profile binary"), "sets")
    keyed = rows.where("doc_id is not null and n_shingles > 0")
    name = ["node", "more", "n_shingles"]
    nodes = save(keyed.groupBy(*name).agg(F.min("doc_id").alias("rep"), F.min_by("copy", "doc_id").alias("copy"), F.first("profile").alias("profile")), "nodes").withColumn("low", F.expr("node & 281474976710655"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(max(64, 4 * tasks), 1 << 24)
    packed = slim.where("doc_id is not null").mapInArrow(_packed(k, percent, buckets), "bucket int, sigs binary, nodes binary")
    met = save(packed.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(_meet, "sig long, a long, b long, shared long"), "met")

    def of(x: str) -> DataFrame:
        return nodes.select(F.col("low").alias(x), F.col("rep").alias(f"r{x}"), F.col("copy").alias(f"c{x}"), F.col("n_shingles").alias(f"n{x}"))

    pairs = met.where("b is not null").groupBy("a", "b").agg(F.sum("shared").alias("shared")).join(of("a"), "a").join(of("b"), "b")
    pairs = pairs.where(f"ra <> rb and 100 * least(na, nb) >= {percent} * greatest(na, nb)")
    ends = (f"{f}(ra, rb) as {x}" if p == "r" else f"if(ra < rb, {p}{x}, {p}{y}) as {c}{x}" for p, c in (("r", ""), ("c", "copy_"), ("n", "n")) for x, y, f in (("a", "b", "least"), ("b", "a", "greatest")))
    sized = save(pairs.selectExpr(*ends, "shared"), "sized")

    def profiled(x: str) -> DataFrame:
        return nodes.select(F.col("rep").alias(x), F.col("copy").alias(f"copy_{x}"), F.col("n_shingles").alias(f"n{x}"), F.col("profile").alias(f"p{x}"))

    pairs = sized.join(profiled("a"), ["a", "copy_a", "na"]).join(profiled("b"), ["b", "copy_b", "nb"]).select("a", "copy_a", "b", "copy_b", "na", "nb", "pa", "pb", "shared")
    pairs = save(pairs.mapInArrow(_possible(percent), "a long, copy_a int, b long, copy_b int, shared long"), "pairs")
    members = save(met.where("b is null").select("sig", F.col("a").alias("low")).join(nodes.select("low", F.col("rep").alias("doc_id"), "copy", "n_shingles"), "low").drop("low"), "members")
    discard(met)
    discard(sized)
    known = pairs.select(F.col("a").alias("doc_id"), F.col("copy_a").alias("copy")).union(pairs.select("b", "copy_b")).union(members.select("doc_id", "copy")).distinct()
    texts = save(slim.join(known, ["doc_id", "copy"]).groupBy("doc_id", "copy").agg(F.max("text").alias("text")), "texts")

    # each document first meets the one it shares most signatures with
    first = F.max_by(F.struct("copy_a", "a", "copy_b"), F.struct("shared", -F.col("a"))).alias("best")
    best = save(pairs.groupBy("b").agg(first).select("best.a", "best.copy_a", "b", "best.copy_b"), "best")
    links = _links(best, texts, k, percent)
    several = save(rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("doc_id"), "several")
    comps = components(links.unionByName(_of_one_id(keyed, several, nodes, name)))
    rest = _links(_open(pairs.drop("shared"), comps).distinct(), texts, k, percent)
    links = links.unionByName(rest)
    if not rest.isEmpty():
        comps = components(comps.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(rest))
    if not members.isEmpty():
        late = _residual(members, nodes, comps, texts, k, percent)
        links = links.unionByName(late)
        if not late.isEmpty():
            comps = components(comps.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(late))

    for used in (pairs, members, best, texts):
        discard(used)

    found = links.select(F.col("a").alias("rep")).unionByName(links.select(F.col("b").alias("rep"))).groupBy("rep").agg(F.count(F.lit(1)).alias("links_used"))
    classes = nodes.join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left").join(found, "rep", "left")
    classes = classes.select(*name, F.coalesce("component", "rep").alias("component"), F.coalesce("links_used", F.lit(0)).alias("links_used"))
    joined = rows.drop("profile", "copy").join(classes, name, "left")
    joined = joined.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"), F.coalesce("links_used", F.lit(0)).cast("long").alias("links_used"))
    if several.isEmpty():
        return joined
    # rows without a shingle belong with their document's others
    least = joined.join(several, "doc_id").groupBy("doc_id").agg(F.min("component_id").alias("least"))
    return joined.join(least, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("least", "component_id").alias("component_id"), "links_used")

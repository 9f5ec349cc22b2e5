"""What op8 sends between buckets."""

import random

import pyarrow as pa

from tidemark.llm import pitman_yor as p


def test_packed_occurrences_come_back_in_fewer_bytes():
    import numpy as np

    rng = random.Random(5)
    texts = [" ".join(f"w{int(rng.paretovariate(0.7)) % 5000}" for _ in range(200)) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array(texts), pa.array([i % 5 == 0 for i in range(300)])], names=["doc_id", "text", "held"])
    hot = p.Hot(np.array([], dtype=np.uint64), np.array([]), np.array([]))
    packed = list(p._pack(64, hot)([batch]))
    n = 300 * 201
    sent = sum(len(x) for b in packed for c in ("docs", "words") for x in b.column(c).to_pylist())
    assert sent < 0.8 * 9 * n
    rows = [r for b in packed for g in p._grouped([b]) for r in g]
    assert sum(len(r["docs"]) for r in rows) == 2 * n and sum(len(r["words"]) for r in rows) == 7 * n
    assert sum(int(np.frombuffer(r["runs"], dtype="<u4").sum()) for r in rows) == n
    for width in (1, 2, 7):
        b = bytes(rng.randrange(256) for _ in range(7 * 2 * 50))
        assert p._restored(p._squeezed(b, width), width) == b and p._restored(p._squeezed(b"", width), width) == b""


def test_occurrences_are_sorted_by_one_number_each(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(3)
    context, word = rng.integers(0, 900, 20_000).astype(np.uint64), rng.integers(0, 1 << 56, 300).astype(np.uint64)[rng.integers(0, 300, 20_000)]
    slow = np.lexsort((word, context))
    # two words of one context that differ in their last bit only are still told apart
    close = np.array([6, 9, 7, 6], dtype=np.uint64), np.array([5 << 20, 1, (5 << 20) + 1, 5 << 20], dtype=np.uint64)
    for kinds in (10, 1 << 20):
        at = p._order(close[0] * np.uint64(0) + np.uint64(1), kinds, close[1])
        assert close[1][at].tolist() == sorted(close[1].tolist())
    batch = pa.RecordBatch.from_arrays([pa.array(range(40), pa.int64()), pa.array([" ".join(f"w{x % 90}" for x in range(i, 40 * i)) for i in range(40)]), pa.array([i % 5 == 0 for i in range(40)])], names=["doc_id", "text", "held"])
    hot = p.Hot(np.array([], dtype=np.uint64), np.array([]), np.array([]))
    rows = [r for b in p._pack(64, hot)([batch]) for g in p._grouped([b]) for r in g]

    def refuse(*_):
        raise AssertionError("sorted by two keys")

    monkeypatch.setattr(np, "lexsort", refuse)
    order = p._order(context, 900, word)
    assert (context[order] == context[slow]).all() and (word[order] == word[slow]).all()
    for b in {r["bucket"] for r in rows}:
        x = p._Contexts([r for r in rows if r["bucket"] == b], hot)
        assert len(x.doc) == len(x.cell) and (np.diff(x.context) >= 0).all()


def test_hot_contexts_are_found_among_those_with_equal_upper_bits():
    import numpy as np

    rng = np.random.default_rng(4)
    own = np.unique(np.concatenate([(np.uint64(77) << np.uint64(40)) + np.arange(1, 60, 2, dtype=np.uint64), rng.integers(0, 1 << 56, 300).astype(np.uint64)]))
    asked = np.concatenate([own, own + np.uint64(1), own - np.uint64(1), np.array([0, (1 << 56) - 1], dtype=np.uint64)])
    place = {int(v): i for i, v in enumerate(own)}
    assert p.Hot(own, own, own).among(asked).tolist() == [place.get(int(v), -1) for v in asked]


def test_seating_does_not_depend_on_the_order_of_dishes():
    import numpy as np

    rng = np.random.default_rng(6)
    c, keys = np.minimum(rng.zipf(1.3, 400), 5000), rng.integers(0, 1 << 62, 400).astype(np.uint64)
    there, up, turn = rng.integers(0, 90, 400).astype(float), rng.random(400) / 9, rng.permutation(400)
    t = p.seat(c, there, up, p.Draws(keys, 1))
    assert (p.seat(c[turn], there[turn], up[turn], p.Draws(keys[turn], 1)) == t[turn]).all()
    assert ((t >= 1) & (t <= c)).all() and (t[c == 1] == 1).all()

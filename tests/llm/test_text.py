import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import text as tx

texts = st.lists(st.text(alphabet="ab é\t\n\x0b\x1c\x85 ", max_size=40), max_size=6)


@given(texts)
@settings(max_examples=150, deadline=None)
def test_words_are_those_of_bytes_split(parts):
    raw = [t.encode() for t in parts]
    w = tx.words_of(raw)
    for j, t in enumerate(raw):
        a, b = w.offsets[j], w.offsets[j + 1]
        assert [w.data[s:e] for s, e in zip(w.starts[a:b], w.ends[a:b])] == t.split()
    names = {}
    for s, e, h in zip(w.starts, w.ends, w.hashes):
        assert names.setdefault(w.data[s:e], h) == h
    assert len(set(names.values())) == len(names)


def test_chunks_do_not_change_hashes(monkeypatch):
    raw = [("x" * 50 + " yy zz\n") * 40, "one", ""]
    raw = [t.encode() for t in raw]
    whole = tx.words_of(raw)
    monkeypatch.setattr(tx, "_CHUNK", 16)
    small = tx.words_of(raw)
    assert np.array_equal(whole.hashes, small.hashes) and np.array_equal(whole.offsets, small.offsets)


def test_windows_and_minima():
    h = tx.words_of([b"a b c a b c a b d"]).hashes
    for k in (2, 3, 5):
        r = tx.rolling(h, k)
        assert len(r) == len(h) - k + 1 and r[0] == r[3]
    assert tx.rolling(h, 3)[3] != tx.rolling(h, 3)[6]
    long = np.random.default_rng(1).integers(0, 1 << 63, 300).astype(np.uint64)
    assert np.array_equal(tx.rolling(np.tile(long, 2), 20)[:281], tx.rolling(np.tile(long, 2), 20)[300:581])
    for w in (1, 2, 7, 35):
        assert np.array_equal(tx.minimum_of(long, w), [long[i : i + w].min() for i in range(len(long) - w + 1)])


def test_case_folding_is_ascii_only():
    a, b = tx.words_of(["ABC É".encode()], lower=True).hashes, tx.words_of(["abc É".encode()]).hashes
    assert np.array_equal(a, b) and tx.words_of(["é".encode()], lower=True).hashes[0] != a[1]

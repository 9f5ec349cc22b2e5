"""Each operator against a brute-force version, and on awkward rows."""

import collections
import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, size long, rule string"


def low(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward(rng):
    """Null, empty, very long, repeated and tied rows; columns whose names operators also use."""
    long = sentence(rng, 30_000, 5000)
    base = sentence(rng, 120)
    edited = base.split()
    edited[60] = "other"
    texts = [None, "", "   \n\t", "one", "A b", base, base, base.upper(), " ".join(edited), long, "x" * 200_000, base + "\n" + base, sentence(rng, 60) + " " + " ".join(base.split()[10:80])]
    texts += [sentence(rng, 80) for _ in range(12)]
    rows = [(i, t, random.Random(i).choice(["en", "de", None]), random.Random(i + 9).choice(["s1", "s2", None]), 1, 7, 8, "r") for i, t in enumerate(texts)]
    rows.append(rows[5])
    rows.append((None, base, None, None, None, None, None, None))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = awkward(random.Random(3))
    return spark.createDataFrame(rows, SCHEMA).repartition(3), rows


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_decontaminate(spark, docs, empty):
    from tidemark.llm.decontaminate import contaminated, without_leaks

    df, rows = docs
    rng = random.Random(4)
    item = sentence(rng, 40)
    near = item.split()
    near[0] = "changed"
    part = " ".join(item.split()[:20])
    bench = spark.createDataFrame([(1, item, "x"), (2, "tiny one", "x"), (3, None, "x"), (4, "", "x"), (1, item, "x")], "item_id long, text string, doc_id string")
    leaks = [(100, "pre " + item + " post"), (101, "a b c " + " ".join(near).upper()), (102, "z " + part), (103, "Tiny\tONE"), (104, sentence(rng, 5) + " tiny one")]
    all_ = df.select("doc_id", "text").union(spark.createDataFrame(leaks, "doc_id long, text string"))
    found = contaminated(all_, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(100, 1), (101, 1), (103, 2)}
    best = {r.doc_id: r for r in found}
    assert best[100].similarity == 1.0 and best[100].start == 1 and best[100].hamming == 0 and 0.8 <= best[101].similarity < 1
    kept = without_leaks(all_, bench)
    assert kept.count() == all_.count() - 3 and kept.columns == all_.columns
    assert contaminated(empty, bench).count() == 0 and contaminated(df, bench.limit(0)).count() == 0


def test_decontaminate_in_parts_and_against_brute_force(spark, monkeypatch):
    from tidemark.llm import decontaminate as d

    rng = random.Random(8)
    items = [sentence(rng, rng.randint(6, 30), 30) for _ in range(25)]
    texts = []
    for _ in range(60):
        w = sentence(rng, rng.randint(0, 60), 30).split()
        it = rng.choice(items).split()
        if rng.random() < 0.5 and len(it) > 3:
            it[rng.randrange(len(it))] = "edit"
        w[len(w) // 2 : len(w) // 2] = it
        texts.append(" ".join(w))
    sh = lambda w: collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else collections.Counter([tuple(w)])
    expected = {}
    for i, t in enumerate(texts):
        w = low(t)
        for j, s in enumerate(items):
            n, own = len(low(s)), sh(low(s))
            for a in range(max(1, len(w) - n + 1)):
                x = sh(w[a : a + n])
                both, union = sum((x & own).values()), sum((x | own).values())
                if 100 * both >= 80 * union and both / union > expected.get((i, j), (0, 0))[0]:
                    expected[i, j] = (both / union, a)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    monkeypatch.setattr(d, "PART_BYTES", 1500)
    got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in d.contaminated(df, bench).collect()}
    assert got == expected and expected


def brute_repeats(rows, k):
    by_id = {}
    for i, t in rows:
        by_id.setdefault(i, set()).add(t or "")
    first = {}
    for i in sorted(x for x in by_id if x is not None):
        for t in by_id[i]:
            w = t.encode().split()
            for a in range(len(w) - k + 1):
                first.setdefault(tuple(w[a : a + k]), i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for a in range(len(w) - k + 1):
            if i is not None and first[tuple(w[a : a + k])] < i:
                gone[a : a + k] = [True] * k
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("k", [50, 20])
def test_substring_dedup(docs, empty, k):
    from tidemark.llm.substring_dedup import remove_repeats

    df, rows = docs
    got = remove_repeats(df, k, with_text=True)
    assert "rule" in got.columns
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()), key=str) == brute_repeats([(r[0], r[1]) for r in rows], k)
    assert remove_repeats(empty, k).count() == 0


def test_substring_dedup_over_branching_and_periodic_texts(spark):
    from tidemark.llm.substring_dedup import remove_repeats, repeated_spans, verify_spans

    rng = random.Random(11)
    base = sentence(rng, 200).split()
    rows = [(i, " ".join(base)) for i in (5, 9)]
    for i in range(20):
        w = list(base)
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(99)}"
        a, b = sorted(rng.sample(range(len(w)), 2))
        rows.append((10 + i, " ".join(rng.choice([w, w[a:b], sentence(rng, 10).split() + w[a:b], (w[:7] * 30)[: rng.randint(40, 200)]]))))
    rows += [(50, "a b " * 60), (51, "b a " * 40), (52, "a b " * 24)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeats(df, 30).collect()), key=str)
    assert got == brute_repeats(rows, 30)
    spans = repeated_spans(df, 30)
    checked = verify_spans(df, spans, 30).collect()
    assert len(checked) == spans.count() > 0 and all(r.equal and r.source < r.doc_id for r in checked)


def test_substring_dedup_of_one_id_with_several_texts_and_a_common_passage(spark, monkeypatch):
    from tidemark.llm import substring_dedup as d

    monkeypatch.setattr(d, "PACKET", 300)
    rng = random.Random(12)
    passage, other = sentence(rng, 90, 5000), sentence(rng, 70, 5000)
    rows = [(1, sentence(rng, 30, 5000) + " " + other), (1, passage), (3, other + " " + sentence(rng, 9, 5000)), (3, sentence(rng, 100, 5000) + " " + passage), (3, None), (None, passage)]
    rows += [(10 + i, sentence(rng, rng.randint(0, 60), 10**6) + " " + passage + " " + sentence(rng, rng.randint(0, 60), 10**6)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in d.remove_repeats(df).collect()), key=str) == brute_repeats(rows, 50)
    spans = d.repeated_spans(df)
    assert spans.where("doc_id >= 10").count() == 60  # one merged span each
    checked = d.verify_spans(df, spans).collect()
    assert len(checked) == spans.count() and all(r.equal for r in checked)
    # a span whose words differ at the source removes nothing
    wrong = spans.withColumn("source_start", F.col("source_start") + 1)
    assert not any(r.equal for r in d.verify_spans(df, wrong).collect())


def features(t):
    w = low(t)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows, percent=80):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(features(t))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(x for x in sets if x is not None)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if any(s and t and 100 * len(s & t) >= percent * len(s | t) for s in sets[a] for t in sets[b]):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def test_ngram_jaccard(docs, empty):
    from tidemark.llm.ngram_jaccard import similar_groups

    df, rows = docs
    got = similar_groups(df).collect()
    expected = brute_components([(r[0], r[1]) for r in rows])
    assert len(got) == len(rows)
    sizes = collections.Counter((r[0], len(features(r[1]))) for r in rows)
    assert collections.Counter((r.doc_id, r.n_shingles) for r in got) == sizes
    assert all(r.component_id == expected.get(r.doc_id) for r in got)
    assert similar_groups(empty).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_jaccard_of_families_and_common_passages(spark, seed, monkeypatch):
    from tidemark.llm import ngram_jaccard as j

    monkeypatch.setattr(j, "BLOCK", 16)
    rng = random.Random(seed)
    passage, rows = sentence(rng, 40), []
    for f in range(6):
        base = sentence(rng, rng.choice([4, 6, 9, 15, 40, 150])).split()
        for _ in range(rng.choice([2, 5, 40])):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = f"e{rng.randrange(999)}"
            rows.append(" ".join(w + (["end"] if rng.random() < 0.3 else [])))
    rows += [sentence(rng, rng.randint(5, 60)) + " " + passage for _ in range(40)]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r.doc_id: r.component_id for r in j.similar_groups(df).collect()} == brute_components(rows)


@pytest.mark.parametrize("swap", [False, True])
def test_ngram_jaccard_of_one_id_with_several_texts(spark, swap):
    from tidemark.llm.ngram_jaccard import similar_groups

    rng = random.Random(21)
    x, y, u, v = (sentence(rng, 40, 900) for _ in range(4))
    if swap:
        x, y = max(x, y), min(x, y)
    else:
        x, y = min(x, y), max(x, y)
    rows = [(1, x), (1, y), (2, y + " more"), (5, u), (4, u), (5, v), (7, v + " more"), (8, x + " else"), (None, x), (9, None), (9, v)]
    got = {(r.doc_id, r.component_id) for r in similar_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == {(1, 1), (2, 1), (8, 1), (4, 4), (5, 4), (7, 4), (9, 4), (None, None)}


def test_signatures_of_less_similar_sets():
    import numpy as np

    from tidemark.llm.ngram_jaccard import signatures

    rng = np.random.default_rng(6)
    for n in (5, 40, 3000):
        a = rng.choice(1 << 62, n, replace=False).astype(np.uint64)
        b = np.concatenate([a[: n * 3 // 4], rng.choice(1 << 62, n // 4).astype(np.uint64)])
        who, sig = signatures([np.sort(a), np.sort(b)], 50)
        assert set(sig[who == 0]) & set(sig[who == 1])


def test_signatures_are_shared_by_all_similar_sets():
    import numpy as np

    from tidemark.llm.ngram_jaccard import signatures

    rng = np.random.default_rng(5)
    for _ in range(150):
        n = int(rng.integers(4, 400))
        a = rng.choice(1 << 62, n, replace=False).astype(np.uint64)
        drop, add = int(rng.integers(0, n // 5 + 1)), int(rng.integers(0, n // 5 + 1))
        b = np.concatenate([a[drop:], rng.choice(1 << 62, add).astype(np.uint64)])
        both = len(np.intersect1d(a, b))
        if 100 * both < 80 * (len(a) + len(b) - both) or drop + add == 0:
            continue
        who, sig = signatures([np.sort(a), np.sort(b)])
        assert set(sig[who == 0]) & set(sig[who == 1]), (n, drop, add)


def test_components(spark):
    from tidemark.llm.components import components

    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100), (60, 50), (70, 60), (50, 70)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 50: 50, 60: 50, 70: 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def junk(rng, kind):
    w = sentence(rng, rng.randint(40, 200)).split()
    return {0: " ".join(x + "###" for x in w), 1: " ".join(w).upper().replace(" ", "!! "), 2: (w[0] + " ") * 80, 3: "\n".join([" ".join(w[:8]) + "."] * 20), 4: " | ".join(w)}[kind]


def labelled(spark, n=900):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        t = ". ".join(sentence(rng, rng.randint(5, 15)).capitalize() for _ in range(rng.randint(6, 25))) + "." if good else junk(rng, rng.randrange(5))
        rows.append((i, t, rng.choice(["en", "de"])))
        labels.append((i, int(good)))
    labels += [labels[0], (None, 1), (10**9, 0), (3, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int"), dict(labels[:n])


def test_quality_qda(spark, docs, empty):
    from tidemark.llm import quality_qda as q

    df, labels, truth = labelled(spark)
    scored = q.score_quality(df, labels, F.expr("doc_id % 2 = 0")).collect()
    held = [r for r in scored if r.doc_id % 2]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= q.CUT) for r in scored)
    kept = q.keep_good(df, labels)
    assert kept.columns == df.columns and 0.9 < kept.count() / sum(truth.values()) < 1.1
    odd, rows = docs
    other = q.score_quality(odd, labels.limit(0)).collect()
    assert len(other) == len(rows) and {r.score for r in other} == {0.5}
    assert len(q.score_quality(odd, spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")).collect()) == len(rows)
    assert q.score_quality(empty, labels).count() == 0 and q.keep_good(odd, labels.limit(0)).count() == len(rows)


def test_quality_qda_against_numpy(spark):
    import numpy as np

    from tidemark.llm import quality_qda as q
    from tidemark.llm.doc_stats import document_counts

    df, labels, truth = labelled(spark, 400)
    rows = q.with_features(document_counts(df.select("doc_id", "text"))).collect()
    x, y = np.array([[r[n] for n in q.FEATURES] for r in rows]), np.array([truth[r.doc_id] for r in rows])
    cov = [np.cov(x[y == c].T, bias=True) for c in (0, 1)]
    share = [(y == c).mean() for c in (0, 1)]
    pooled = cov[0] * share[0] + cov[1] * share[1]

    def density(c):
        s = (1 - q.SHRINK_POOLED - q.SHRINK_DIAGONAL) * cov[c] + q.SHRINK_POOLED * pooled + q.SHRINK_DIAGONAL * np.diag(np.diag(pooled)) + q.FLOOR * np.eye(len(pooled))
        off = x - x[y == c].mean(axis=0)
        return -0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", off, np.linalg.inv(s), off)

    odds = np.clip(math.log(share[1] / share[0]) + (density(1) - density(0)) / q.TEMPER, -60, 60)
    expected = {r.doc_id: 1 / (1 + math.exp(-o)) for r, o in zip(rows, odds)}
    got = {r.doc_id: r.score for r in q.score_quality(df, labels).collect()}
    assert got.keys() == expected.keys() and max(abs(got[i] - expected[i]) for i in got) < 1e-6


def brute_counts(t):
    t = t or ""
    w = t.encode().split()
    seen, dup = set(), 0
    for line in t.encode().split(b"\n"):
        if line.split():
            dup += line in seen
            seen.add(line)
    grams = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    cover = set()
    for i in range(len(w) - 2):
        if grams[tuple(w[i : i + 3])] > 1:
            cover |= {i, i + 1, i + 2}
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t), dup, len(cover)


def test_quality_rules(spark, docs, empty):
    from tidemark.llm import quality_rules as q

    odd, rows = docs
    got = q.apply_rules(odd, spark.createDataFrame([], "doc_id long, quality int")).collect()
    assert collections.Counter((r.doc_id, *(r[c] for c in q.BASE)) for r in got) == collections.Counter((r[0], *brute_counts(r[1])) for r in rows)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and r.kept == (not r.base_failed) for r in got)
    assert q.apply_rules(empty, spark.createDataFrame([], "doc_id long, quality int")).count() == 0
    df, labels, truth = labelled(spark, 3000)
    got = q.apply_rules(df, labels).collect()
    good = [r for r in got if truth[r.doc_id] and not r.base_failed]
    bad = [r for r in got if not truth[r.doc_id] and not r.base_failed]
    assert sum(not r.kept for r in good) <= q.RISK * len(good) and sum(not r.kept for r in bad) > 0.5 * len(bad)
    for t in ("a\na\n \nb\na", "x y z x y z", "a b c d", "\n\n"):
        from tidemark.llm.doc_stats import counts_of

        c = counts_of([t.encode(), b""])
        assert tuple(int(c[n][0]) for n in q.BASE) == brute_counts(t) and int(c["n_words"][1]) == 0


def test_binomial_bounds():
    from tidemark.llm.quality_rules import binomial_tail, certify, least_labels, path, pool

    exact = lambda k, n, p: sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    for k, n, p in ((0, 10, 0.1), (3, 50, 0.02), (7, 40, 0.3), (10, 10, 0.5)):
        assert abs(binomial_tail(k, n, p) - exact(k, n, p)) < 1e-9
    assert certify([0, 0], 10, 0.05) == 0  # too few to be sure
    assert certify([0, 1, 900], 10_000, 0.05) == 2 and certify([], 10_000, 0.05) == 0
    n = least_labels(0.05, 0.01)
    assert binomial_tail(0, n, 0.01) <= 0.05 < binomial_tail(0, n - 1, 0.01)
    assert pool({"en": 5000, "de": 200, None: 150, "fr": 100}) == (["en"], ["fr", None, "de"])
    assert pool({"en": 5000, "de": 200}) == ([], ["de", "en"]) and pool({"en": 20}) == ([], ["en"]) and pool({}) == ([], [])
    steps = lambda **at: [at.get(f"s{i}", 0) for i in range(51)]
    counts = {("a", 1): steps(s0=990, s30=10), ("a", 0): steps(s0=50, s41=50), ("b", 1): steps(s0=1000), ("b", 0): steps(s0=80, s11=20)}
    moves = path(counts)
    assert moves == [("a", 35), ("b", 5)]  # cutoffs stand midway between the labels


def test_cutoffs_bound_false_rejections_of_the_verdict():
    """Over many simulated corpora the true rate of false rejections exceeds RISK in no more than LEVEL of them."""
    import numpy as np

    from tidemark.llm import quality_rules as q

    rng, rules, over, used = np.random.default_rng(4), list(q.RULES)[:4], 0, 0
    draw = lambda y, n: np.minimum(50, rng.geometric(0.12 if y else 0.03, (n, len(rules))) - 1)
    truth = draw(1, 200_000)
    for _ in range(200):
        shape, held = {y: draw(y, 400) for y in (0, 1)}, draw(1, 900)
        counts = {(r, y): np.bincount(shape[y][:, i], minlength=51).tolist() for i, r in enumerate(rules) for y in (0, 1)}
        moves = q.path(counts, worth=1.0)
        beyond = lambda x, some: np.logical_or.reduce([x[:, rules.index(r)] > i for r, i in some] or [np.zeros(len(x), bool)])
        sure = q.certify([int(beyond(held, moves[: p + 1]).sum()) for p in range(len(moves))], len(held), q.LEVEL)
        used += sure > 0
        over += beyond(truth, moves[:sure]).mean() > q.RISK
    assert over <= 200 * q.LEVEL + 3 * (200 * q.LEVEL * (1 - q.LEVEL)) ** 0.5 and used


def test_quality_rules_against_brute_force(spark):
    """The verdicts follow from cutoffs found by plain counting."""
    from tidemark.llm import quality_rules as q

    df, labels, truth = labelled(spark, 2400)
    rows = df.selectExpr("*", f"pmod(xxhash64(doc_id), {q.SHAPING}) = 0 as shaping").collect()

    def steps(t):
        n, chars, symbols, dup, repeats = brute_counts(t)
        w, b = t.encode().split(), t.encode()
        lines = [x for x in b.split(b"\n") if x.split()]
        count = lambda cs: sum(b.count(bytes([c])) for c in cs)
        upper, lower = count(range(65, 91)), count(range(97, 123))
        at_most = lambda x: min(1.0, x)
        values = (symbols / max(chars, 1), dup / max(len(lines), 1), repeats / max(n, 1), at_most(count(b"!?") / max(n, 1)), upper / max(upper + lower, 1), sum(x == y for x, y in zip(w, w[1:])) / max(n, 1), 1 - at_most(10 * count(b".,;:") / max(n, 1)))
        return dict(zip(q.RULES, (min(50, max(0, math.ceil(v * 50))) for v in values))), n < 50 or 100 * repeats > 50 * n

    found = {r.doc_id: (*steps(r.text), r.lang, r.shaping) for r in rows}
    good = collections.Counter(lang for i, (_, base, lang, shaping) in found.items() if truth[i] and not base and not shaping)
    alone, pooled = q.pool(dict(good))
    groups = [[s] for s in alone] + [pooled] * bool(pooled)
    cuts = {}
    for strata in groups:
        own = [(i, s, shaping) for i, (s, base, lang, shaping) in found.items() if lang in strata and not base]
        counts = {(r, y): [sum(s[r] == k for i, s, shaping in own if shaping and truth[i] == y) for k in range(51)] for r in q.RULES for y in (0, 1)}
        moves, held, certified = q.path(counts), [s for i, s, shaping in own if truth[i] and not shaping], []
        for p in range(len(moves)):
            lost = sum(any(s[r] > k for r, k in moves[: p + 1]) for s in held)
            if q.binomial_tail(lost, len(held), q.RISK) > q.LEVEL / len(groups):
                break
            certified = moves[: p + 1]
        cuts |= {lang: certified for lang in strata}
    expected = {i: not base and not any(s[r] > k for r, k in cuts.get(lang, [])) for i, (s, base, lang, _) in found.items()}
    assert {r.doc_id: r.kept for r in q.apply_rules(df, labels).collect()} == expected and any(cuts.values())


def test_chat(spark):
    from tidemark.llm.chat import format_chats, read_back

    rows = [
        (1, 0, "system", "be [good] <|end|> \\s \\"), (1, 1, "user", "a"), (1, 2, "user", None), (1, 3, "assistant", "x <|more|>"), (1, 4, "assistant", "y"), (1, 5, None, ""),
        (2, 1, "assistant", "late"), (2, 0, "user", "</s>[INST] ok [/INST]"), (2, 0, "user", "</s>[INST] ok [/INST]"), (None, 0, "a<|text|>b\n", "é" * 10), (3, None, "user", "null turn"), (3, 0, "user", "z"),
    ]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, turns int, blocks int")
    formatted = format_chats(df)
    got = {r.conv_id: r for r in read_back(formatted).collect()}
    for c in (1, 2, None, 3):
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or ""))
        assert [(t.role, t.text) for t in got[c].turns] == [(r[2] or "", r[3] or "") for r in own]
        assert got[c].loss_text == "".join(r[3] or "" for r in own if r[2] == "assistant")
    assert got[1].formatted.count("<|start|>") == 4 and "</s>" not in got[2].formatted and "[INST]" not in got[2].formatted
    assert format_chats(df.limit(0)).count() == 0
    plan = read_back(formatted)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_chat_of_many_turns(spark):
    from tidemark.llm.chat import format_chats, read_back

    rng = random.Random(3)
    rows = [(1, i, rng.choice(["user", "assistant", "assistant"]), sentence(rng, rng.randint(0, 6)) + rng.choice(["", "é\U0001f600<|end|>"])) for i in range(6000)]
    rows += [(2, 0, "assistant", "long " * 200_000), (2, 1, "user", "<" * 50_000)]
    got = {r.conv_id: r for r in read_back(format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    for c in (1, 2):
        assert [(t.role, t.text) for t in got[c].turns] == [r[2:] for r in rows if r[0] == c]
        assert got[c].loss_text == "".join(r[3] for r in rows if r[0] == c and r[2] == "assistant")


def water(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if most * sizes[s] < level * w[s]}
        if not full:
            return target | {s: level * w[s] for s in open_}
        target |= {s: float(most * sizes[s]) for s in full}
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def test_mixing(spark, docs, empty):
    from tidemark.llm import mixing as m

    df, rows = docs
    one = m.mix_sources(df).collect()
    assert sorted(map(str, one)) == sorted(map(str, m.mix_sources(df.repartition(7)).collect()))
    assert len(one) == len(rows) and m.mix_sources(empty).count() == 0
    rng = random.Random(1)
    rows = [(i, sentence(rng, rng.randint(0, 40)), rng.choice(["a", "b", "b", "b", "c", "Z", None, "tiny"] if i > 5 else ["tiny"])) for i in range(3000)]
    got = m.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    expected, taken = water(sizes), collections.Counter()
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size) and abs(r.target - expected[r.source]) < 1e-6 * max(1, r.target) and r.source_size == sizes[r.source]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - expected[s]) <= 40 for s in sizes)
    plan = m.mix_sources(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_mixing_by_weight_of_documents(spark):
    from tidemark.llm import mixing as m

    rows = [(i, "a b c d", "x", 9.0 if i % 2 else 1.0) for i in range(8000)] + [(i, "a b c d", "y", 1.0) for i in range(8000, 16000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, w double")
    got = m.mix_sources(df, weights=(1.0, 7.0), inclusion=F.col("w"))
    heavy, light = (got.where(f"source = 'x' and w = {w}").agg(F.sum("taken")).first()[0] for w in (9.0, 1.0))
    assert heavy > 3 * light > 0 and abs(heavy + light - got.where("source = 'x'").first().target) <= 4


def test_pitman_yor(spark, docs, empty):
    from tidemark.llm.pitman_yor import score_texts

    df, rows = docs
    got = score_texts(df, F.expr("doc_id % 3 = 0")).collect()
    train = collections.Counter()
    tokens = lambda t: [*low(t), None]
    for r in rows:
        if r[0] is None or r[0] % 3:
            train.update(tokens(r[1]))
    n, v = sum(train.values()), len(train)
    expected = collections.Counter()
    for r in rows:
        t = tokens(r[1])
        base = sum(math.log10((train[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)
        expected[r[0], r[0] is not None and r[0] % 3 == 0, len(t), sum(train[x] > 0 for x in t), n, round(base, 4)] += 1
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == expected
    assert all(r.score < 0 for r in got)
    assert score_texts(empty, F.lit(False)).count() == 0
    assert all(r.score <= 0 for r in score_texts(df, F.lit(True)).collect())  # nothing to learn from


def test_pitman_yor_learns_pairs_and_sums_to_one(spark):
    import numpy as np

    from tidemark.llm import pitman_yor as p

    rng = random.Random(2)
    follow = {i: [rng.randrange(30) for _ in range(3)] for i in range(30)}

    def text():
        w, out = rng.randrange(30), []
        for _ in range(60):
            out.append(f"v{w}")
            w = rng.choice(follow[w])
        return " ".join(out)

    df = spark.createDataFrame([(i, text()) for i in range(300)], "doc_id long, text string")
    held = p.score_texts(df, F.expr("doc_id % 5 = 0")).where("held_out").agg(F.sum("score") / F.sum("n_tokens"), F.sum("base_score") / F.sum("n_tokens")).first()
    assert held[0] > held[1] + 0.5
    # one context: predictive probabilities over all dishes, and over what is new, make one
    c, p0 = np.array([5, 3, 1, 0, 0]), np.full(5, 0.2)
    draws = p.Draws(np.arange(5, dtype=np.uint64), 1)
    assert abs(p.predictive(c, np.zeros(5, dtype=np.int64), p0, draws).sum() - 1) < 1e-9
    many = p.seat(np.array([1, 2, 100_000]), np.zeros(3), np.array([0.1, 0.1, 0.1]), draws)
    assert many[0] == 1 and 1 <= many[1] <= 2 and 1 < many[2] < 100_000


def test_pitman_yor_draws():
    """Tables after seating, against seating one customer after the other with numpy's generator."""
    import numpy as np

    from tidemark.llm import pitman_yor as p

    n = 4000
    for trials, chance in ((9, 0.3), (50, 0.97), (1000, 0.4), (5000, 0.0002)):
        got = p.Draws(np.arange(n, dtype=np.uint64), 3).binomial(np.arange(n), np.full(n, trials), np.full(n, chance), 7)
        mean, sd = trials * chance, (trials * chance * (1 - chance)) ** 0.5
        assert abs(got.mean() - mean) < 5 * sd / n**0.5 and abs(got.std() - sd) < 0.1 * sd + 0.02 and 0 <= got.min() and got.max() <= trials
    rng = np.random.default_rng(5)
    for c, others, p0 in ((2, 0, 0.3), (20, 40, 0.1), (60, 10, 0.02)):
        got = p.seat(np.full(n, c), np.full(n, float(others)), np.full(n, p0), p.Draws(np.arange(n, dtype=np.uint64) * 977, 1))
        t = np.ones(n)
        for j in range(1, c):
            new = (p.STRENGTH + p.DISCOUNT * (others + t)) * p0
            t += rng.random(n) < new / (new + j - p.DISCOUNT * t)
        assert abs(got.mean() - t.mean()) < 0.02 * t.mean() + 5 * t.std() / n**0.5, (c, got.mean(), t.mean())


def brute_pitman_yor(texts, held, p):
    """Scores by Gibbs sampling with plain dictionaries and a generator of its own, averaged over many sweeps."""
    rng = random.Random(8)
    pairs = [list(zip([None, *low(t)], [*low(t), ""])) for t in texts]
    train = [x for t, h in zip(pairs, held) if not h for x in t]
    cells, words = collections.Counter(train), collections.Counter(w for _, w in train)
    once, twice = (sum(n == k for n in words.values()) for k in (1, 2))
    d0, v = p._discount(once, twice), len(words)

    def seated(c, others, base, d, strength):
        t = 1
        for j in range(1, c):
            new = (strength + d * (others + t)) * base
            t += rng.random() < new / (new + j - d * t)
        return t

    def parent_of(customers):
        tables = collections.Counter({w: 1 for w in customers})
        seen = collections.Counter()
        for sweep in range(30):
            for w, c in customers.items():
                others = sum(tables.values()) - tables[w]
                tables[w] = seated(math.ceil(c), others, 1 / (v + 1), d0, p.PARENT_STRENGTH)
            seen.update(tables)
        mean = {w: seen[w] / 30 for w in customers}
        total = sum(customers.values())
        return lambda w: (max(customers.get(w, 0) - d0 * mean.get(w, 0), 0) + (p.PARENT_STRENGTH + d0 * sum(mean.values())) / (v + 1)) / (p.PARENT_STRENGTH + total)

    def contexts(parent, sweeps):
        tables = collections.Counter({x: 1 for x in cells})
        total = collections.Counter(c for c, _ in cells)
        for sweep in range(2 + sweeps):
            for x, n in cells.items():
                total[x[0]] -= tables[x]
                tables[x] = seated(n, total[x[0]], parent(x[1]), p.DISCOUNT, p.STRENGTH)
                total[x[0]] += tables[x]
            if sweep >= 2:
                yield dict(tables), dict(total)

    parent = parent_of(dict(words))
    for _ in range(p.PARENT_SWEEPS):
        customers = collections.Counter()
        for tables, _ in contexts(parent, 30):
            for (_, w), t in tables.items():
                customers[w] += t / 30
        parent = parent_of(dict(customers))
    size, chance = collections.Counter(c for c, _ in train), collections.Counter()
    for tables, total in contexts(parent, 30):
        for x in {x for t in pairs for x in t}:
            chance[x] += (max(cells[x] - p.DISCOUNT * tables.get(x, 0), 0) + (p.STRENGTH + p.DISCOUNT * total.get(x[0], 0)) * parent(x[1])) / (p.STRENGTH + size[x[0]]) / 30
    return [sum(math.log10(chance[x]) for x in t) for t in pairs]


@pytest.mark.parametrize("hot", [1000, 30])
def test_pitman_yor_against_brute_force(spark, monkeypatch, hot):
    from tidemark.llm import pitman_yor as p

    monkeypatch.setattr(p, "HOT_LEAST", hot)
    rng = random.Random(6)
    texts = [" ".join(rng.choice("a b c d e f g h".split()) if rng.random() < 0.7 else f"x{rng.randrange(60)}" for _ in range(rng.randint(0, 40))) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in p.score_texts(df, F.expr("doc_id % 4 = 0")).collect()}
    expected = brute_pitman_yor(texts, [i % 4 == 0 for i in range(120)], p)
    off = [got[i] - e for i, e in enumerate(expected)]
    # contexts that are split take their tables as the pass before left them
    near = 0.01 if hot == 1000 else 0.04
    assert abs(sum(off)) < near * abs(sum(expected)) and max(map(abs, off)) < 60 * near


def test_pitman_yor_does_not_depend_on_partitions(spark, docs, monkeypatch):
    from tidemark.llm import pitman_yor as p

    df, _ = docs
    monkeypatch.setattr(p, "HOT_LEAST", 40)
    found = []
    for partitions in ("3", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            found.append(sorted((str(r.doc_id), round(r.score, 6), round(r.base_score, 6)) for r in p.score_texts(df.repartition(int(partitions)), F.expr("doc_id % 3 = 0")).collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1]


def test_pitman_yor_counts_every_word(spark):
    from tidemark.llm import pitman_yor as p

    words = [f"x{i}" for i in range(80_000)]  # each once, but for some that make the discount
    rows = [(i, " ".join(words[k : k + 800])) for i, k in enumerate(range(0, len(words), 800))] + [(100, " ".join(f"y{i} z y{i}" for i in range(20)))]
    asked = random.Random(5).sample([w for i, w in enumerate(words) if i % 800 not in (0, 799)], 3000)
    rows += [(1000 + i, f"new{i} {w}") for i, w in enumerate(asked)] + [(9000, "new unseen")]
    got = p.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), F.expr("doc_id >= 1000")).where("held_out").collect()
    unseen = next(r.score for r in got if r.doc_id == 9000)
    known = [r.score for r in got if r.doc_id < 9000]
    assert len(known) == len(asked) and max(known) - min(known) < 1e-4  # the same count, the same score
    # behind a new word the parent decides; the end follows a context of one customer
    ratio = 10 ** (known[0] - unseen) * (p.STRENGTH + 1) / (p.STRENGTH + p.DISCOUNT)
    once, twice, kinds = 80_000, 20, 80_022
    d = min(0.95, once / (once + 2 * twice))
    low_, high = (1 + (1 - d) * (kinds + 1) / (1 + d * t) for t in (kinds + 200, kinds))
    assert low_ - 1e-4 < ratio < high + 1e-4


def test_url_filter(spark):
    from tidemark.llm.url_filter import filter_urls

    urls = ["http://A.COM/x", "http://b.com", "https://example.com/en/1", "https://m.Example.com/en/", "https://www.example.com/en/2", "https://m.www.example.com/en/2", "http://x.net/es/?q", "ftp://y.net/fr/#a", "http://notcom/", "x.org/y", None, "", "http://h.org?a://b/c", "http://i.org#/x", "http://a.net/en/", "a://b://c/d", "http://example.com/en"]
    df = spark.createDataFrame([(i, u, "clash", "clash", 1.0) for i, u in enumerate(urls)], "page_id long, url string, host string, suffix string, length double")
    got = filter_urls(df).collect()
    by = {r.page_id: r for r in got}

    def parts(u):
        if not u or "://" not in u:
            return "", ""
        rest = u.split("://", 1)[1]
        host = rest
        for c in "/?#":
            host = host.split(c)[0]
        path = rest[len(host) :]
        return host.translate({c: c + 32 for c in range(65, 91)}), path.split("?")[0].split("#")[0]

    rules = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
    for i, u in enumerate(urls):
        host, path = parts(u)
        fit = [r for r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
        rule = max(fit, key=len, default=None)
        assert (by[i].host, by[i].path, by[i].rule) == (host, path, rule), u
        assert by[i].verdict == rules.get(rule, by[i].verdict) and by[i].verdict in ("allow", "block")
        assert by[i].suffix == "clash" and by[i].length == 1.0
    assert len(got) == len(urls) and filter_urls(df.limit(0)).count() == 0
    assert filter_urls(df.where("page_id in (9, 10, 11)")).count() == 3  # nothing to learn from
    plan = filter_urls(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_url_trees_learn(spark):
    from tidemark.llm import url_filter as u

    rng = random.Random(3)
    urls = []
    for i in range(600):
        spam = i % 2
        path = "/".join("".join(rng.choice("0123456789" if spam else "abcdef") for _ in range(6)) for _ in range(4 if spam else 2))
        urls.append((i, f"http://h{i}.{'bad.' if i % 3 and spam else 'good.' if i % 3 else ''}org/{path}"))
    got = u.filter_urls(spark.createDataFrame(urls, "page_id long, url string"), (("bad.org", "/", "block"), ("good.org", "/", "allow"))).collect()
    free = [r for r in got if r.rule is None]
    assert free and sum((r.verdict == "block") == bool(r.page_id % 2) for r in free) / len(free) > 0.95


def brute_boost(x, y, u):
    """Log-odds of rows x, lists of bins, after boosting trees of depth two."""
    n, pos = len(y), sum(y)
    w = [n / (2 * pos) if v else n / (2 * (n - pos)) for v in y]
    score = [0.0] * n

    def split(rows, g, h):
        best = None
        for f in range(len(x[0])):
            for b in range(max(r[f] for r in x)):
                sides = [[i for i in rows if (x[i][f] <= b) == left] for left in (True, False)]
                (gl, hl), (gr, hr) = ((sum(g[i] for i in s), sum(h[i] for i in s)) for s in sides)
                if min(hl, hr) < u.LEAST:
                    continue
                gain = gl * gl / (hl + u.PENALTY) + gr * gr / (hr + u.PENALTY) - (gl + gr) ** 2 / (hl + hr + u.PENALTY)
                if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                    best = gain, sides, -gl / (hl + u.PENALTY), -gr / (hr + u.PENALTY)
        return best

    for _ in range(u.ROUNDS):
        p = [1 / (1 + math.exp(-s)) for s in score]
        g, h = [a * (b - c) for a, b, c in zip(w, p, y)], [a * b * (1 - b) for a, b in zip(w, p)]
        top = split(range(n), g, h)
        if top is None:
            break
        for side, value in zip(top[1], top[2:]):
            below = split(side, g, h)
            for rows, v in zip(below[1], below[2:]) if below else [(side, value)]:
                for i in rows:
                    score[i] += u.RATE * v
    return score


def test_url_trees_against_brute_force(spark):
    from tidemark.llm import url_filter as u

    rng = random.Random(9)
    rows = []
    for _ in range(300):
        y = int(rng.random() < 0.3)
        rows.append((*(float(rng.randint(0, 5) + 2 * y * (k == 3) + (rng.random() < 0.6) * y * (k % 2)) for k in range(len(u.FEATURES))), y))
    df = spark.createDataFrame(rows, ", ".join(f"{f} double" for f in u.FEATURES) + ", y long")
    cuts, score = u.train(df)
    binned = df.select(*u._bins(cuts), "y", F.monotonically_increasing_id().alias("i"))
    got = [r.s for r in binned.selectExpr("i", f"{score} as s").orderBy("i").collect()]
    bins = binned.orderBy("i").collect()
    expected = brute_boost([[r[f"b_{f}"] for f in u.FEATURES] for r in bins], [r.y for r in bins], u)
    assert max(abs(a - b) for a, b in zip(got, expected)) < 1e-6 and len(set(got)) > 5


def test_url_filter_on_held_out_urls(spark):
    """URLs that a rule labels, judged by a model that has not seen them."""
    from tidemark.llm import url_filter as u

    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    judged = u.filter_urls(pages, learn=F.expr("pmod(hash(url), 5) <> 0")).where("rule is not null and pmod(hash(url), 5) = 0")
    right = judged.groupBy("verdict").agg(F.avg(((F.col("block_score") >= 0.5) == (F.col("verdict") == "block")).cast("double")), F.count(F.lit(1))).collect()
    assert {r[0] for r in right} == {"allow", "block"} and all(r[1] > 0.8 and r[2] > 30 for r in right)


def test_url_filter_on_very_long_urls(spark):
    from tidemark.llm.url_filter import filter_urls

    urls = ["http://a.com/" + "x/" * 50_000, "http://" + "sub." * 50_000 + "net/es/?" + "a=1&" * 50_000, "http://b.com/", "no scheme " * 20_000]
    got = {r.page_id: r for r in filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()}
    assert got[0].rule == "com/" and got[1].rule == "net/es/" and got[0].path == "/" + "x/" * 50_000 and (got[3].host, got[3].path, got[3].rule) == ("", "", None)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><header><h2>Site</h2></header><nav><ul><li><a href="/x">menu {0}</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><{1}><h1>Title {0} &amp; more</h1><p>First <b>bold</b>ly {0}.<br>Second&nbsp;line  of
text<p>Unclosed &lt;tag&gt; text {0}</p><aside>see also</aside><form><input name="q"><p>search</p></form><div class="ad">buy</div><ul><li>one<li>two</ul></{1}><div id="comments"><p>reader says {0}</p></div><footer>&copy; end</footer>{2}"""


def page(i, tag="article", tail="</body></html>"):
    return PAGE.format(i, tag, tail)


def expected_text(i):
    return f"Title {i} & more First boldly {i}. Second line of text Unclosed <tag> text {i} one two"


def test_html(spark):
    from tidemark.llm.html_extract import extract_text, host_templates

    rows = [(i, f"http://h{i % 2}.org/{i}", page(i)) for i in range(8)]
    rows += [(20, "http://h0.org/t", page(20, tail="")), (21, "http://h0.org/n", None), (22, None, ""), (23, "odd", page(23)), (24, "http://one.org/", page(24, 'div class="story"').replace('</div class="story">', "</div>"))]
    rows += [(30 + i, f"http://plain.org/{i}", page(30 + i, "section")) for i in range(4)] + [rows[0]]
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = extract_text(df).collect()
    assert len(got) == len(rows)
    for r in got:
        want = "" if r.page_id in (21, 22) else expected_text(r.page_id)
        assert r.text == want and r.n_chars == len(want), r.page_id
    assert extract_text(df.limit(0)).count() == 0
    t = host_templates(df.selectExpr("page_id", "html", "split_part(url, '/', 3) as host").where("host = 'plain.org'")).first()
    assert t.main == "html/body/section" and len({v for v, _ in t.template}) == 1


def test_html_drops_what_the_template_fixes(spark):
    from tidemark.llm.html_extract import extract_text

    def source(i):
        body = f"<div class=x1><p>words {i} of page</p><div class=x7>Read our app</div><p>more {i}</p></div>"
        return f"<html><body><div class=x3>licence line</div>{body}<p>Read our app</p></body></html>" if i else "<html><body><p>only here</p></body></html>"

    rows = [(i, f"http://h.org/{i}", source(i)) for i in range(10)] + [(100 + i, f"http://few.org/{i}", source(5)) for i in range(3)]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"words {i} of page more {i}" for i in range(1, 10)) and got[0] == "only here"
    assert got[100] == "licence line words 5 of page Read our app more 5 Read our app"
    copies = [(i, "http://h.org/", "<p>the same text</p>") for i in range(10)]
    assert {r.text for r in extract_text(spark.createDataFrame(copies, "page_id long, url string, html string")).collect()} == {"the same text"}


def test_html_keeps_every_slot(spark):
    from tidemark.llm.html_extract import extract_text, text_of

    lead, rest = "lead words of some length", "rest of it"
    parts = f"<div class=post><div class=lead>{lead} {{0}}</div><div class=rest>{rest} {{0}}</div></div>"
    rows = [(i, f"http://h.org/{i}", parts.format(i)) for i in range(10)]
    got = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r.text == f"{lead} {r.page_id} {rest} {r.page_id}" for r in got)
    assert text_of(f"<main><article>{lead}</article><section>{rest}</section></main>", None) == f"{lead} {rest}"
    assert text_of(f"<p class=lead>{lead}</p><p>{rest}</p>", None) == f"{lead} {rest}"


class _Blocks(__import__("html.parser").parser.HTMLParser):
    """Blocks (path, text) of well-formed pages of div, section, p and li elements, and their paths."""

    def __init__(self, source):
        super().__init__()
        self.open, self.blocks, self.paths = [], [], []
        self.feed(source)

    def handle_starttag(self, tag, attrs):
        self.open.append(tag + "".join(f".{v}" for k, v in attrs if k == "class"))
        self.paths.append("/".join(self.open))

    def handle_endtag(self, tag):
        self.open.pop()

    def handle_data(self, data):
        if data.split():
            self.blocks.append(("/".join(self.open), " ".join(data.split())))


def test_html_templates_against_brute_force(spark):
    from tidemark.llm import html_extract as h

    rng = random.Random(7)
    pages = []
    for host in range(6):
        n, boxes = rng.choice([3, 9, 20]), [f"x{rng.randrange(99)}" for _ in range(4)]
        said = [sentence(rng, rng.randint(1, 5)) for _ in range(4)]
        for i in range(n):
            parts = [f"<div class={c}><p>{t if rng.random() < 0.95 else 'odd'}</p></div>" for c, t in zip(boxes, said) if rng.random() < 0.9]
            parts += [f"<section><p>{sentence(rng, rng.randint(1, 9), 9)}</p>" + f"<p>{said[0]}</p>" * rng.randint(0, 2) + "</section>" for _ in range(rng.randint(0, 3))]
            rng.shuffle(parts)
            pages.append((len(pages), f"http://h{host}.org/{i}", "<html>" + "".join(parts) + "</html>"))
    expected = {}
    for host in {u.split("/")[2] for _, u, _ in pages}:
        own = [(i, _Blocks(s)) for i, u, s in pages if u.split("/")[2] == host]
        tokens = {t for _, b in own for t in [*b.blocks, *((p, None) for p in b.paths)]}
        vector = {t: tuple(b.blocks.count(t) if t[1] else b.paths.count(t[0]) for _, b in own) for t in tokens}
        classes = collections.defaultdict(list)
        for t, v in vector.items():
            classes[v].append(t)
        fixed = set()
        for v, members in classes.items():
            there = [x for x in v if x]
            words = sum(len(t[1].split()) if t[1] else 1 for t in members)
            if len(own) >= h.LEAST_PAGES and len(set(there)) == 1 and 2 * len(there) >= len(own) and words >= 2:
                fixed |= set(members)
        for i, b in own:
            slots = [t for p, t in b.blocks if (p, t) not in fixed]
            expected[i] = " ".join(slots or [t for _, t in b.blocks])
    got = {r.page_id: r.text for r in h.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)).collect()}
    assert got == expected and any(len(got[i]) < sum(len(t) + 1 for _, t in _Blocks(s).blocks) - 1 for i, _, s in pages)


def test_html_menus_by_links_and_names(spark):
    from tidemark.llm.html_extract import extract_text, text_of

    def source(i):
        menu = "".join(f"<li><a href=/{i}{k}>go {i} {k}</a></li>" for k in range(5))
        return f"<body><div class=q1><ul>{menu}</ul></div><div class=q2><p>body {i} <a href=x>link {i}</a> and words {i} {i} {i}</p><p class=social-history>told {i}</p><p><a href=y>all of it {i}</a></p></div></body>"

    rows = [(i, f"http://h.org/{i}", source(i)) for i in range(9)]
    rows.append(rows[0])  # a repeated row counts as a page, it cancels nothing
    got = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 10 and all(r.text == f"body {r.page_id} link {r.page_id} and words {r.page_id} {r.page_id} {r.page_id} told {r.page_id} all of it {r.page_id}" for r in got)
    kept = '<article><p class="social-history">a</p><div class="promo-code">b</div><div id="header-image-credits">c</div></article>'
    assert text_of(kept, None) == "a b c"
    gone = "".join(f'<div class="{c}">x</div>' for c in ("ad", "story ad", "cookie-notice", "side-bar", "sidebar_left", "comments-list", "share-buttons", "site-header", "ad-box-3"))
    assert text_of(gone + "<p>t</p>", None) == "t"


def test_html_takes_time_in_proportion():
    import time

    from tidemark.llm.html_extract import _page_tokens, parse, text_of

    sources = ["<p>x</p>" * 100_000, "<div>" * 100_000 + "x", "<span class=ad>" + "<b>" * 50_000 + "</i>" * 50_000, "<a " * 100_000 + '"', "<td>" + "<x>" * 50_000 + "<h1>" * 50_000, "</x>" * 100_000, '<a href="' * 50_000]
    for source in sources:
        began = time.process_time()
        assert len(text_of(source, {1})) in (0, 1, 199_999)
        _page_tokens(parse(source))
        assert time.process_time() - began < 20, source[:20]


def test_html_odd_sources():
    from tidemark.llm.html_extract import text_of

    assert text_of("just text &amp &eacute;", None) == "just text & é"
    assert text_of("<p>a<!-- b --><script>c</script>d<p>e", None) == "ad e"
    assert text_of("a < b <3 </x> c", None) == "a < b <3 c"
    assert text_of("<div>x</div>" * 3 + "<span class='ad'>no <b>no</b></span> y", None) == "x x x y"
    assert text_of("<p>t</p><scr", None) == "t" and text_of("<p class='a>b'>t", None) == "t"


def test_labels_fold_as_crc32(spark):
    from tidemark.llm.queries import fold

    ids = [0, 7, 123456789, -5]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    assert [r[0] for r in df.selectExpr(fold(5)).collect()] == [zlib.crc32(str(i).encode()) % 5 for i in ids]

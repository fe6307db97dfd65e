"""Centroid clustering, MinHash near-duplicates and hard negatives against brute force on odd tables."""

import hashlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm import centroids, minhash, negatives

NAN, INF = float("nan"), float("inf")


def vector_rows(n, dims=64, seed=0, scale=0.3):
    r = np.random.default_rng(seed)
    return [(i, r.normal(0, scale, dims).tolist(), int(r.integers(0, 4))) for i in range(n)]


ODD = [
    (1000, None, 1), (1001, [0.5] * 63, 1), (1002, [0.5] * 63 + [None], 2), (1003, [NAN] + [0.0] * 63, 2), (1004, [INF] + [0.0] * 63, 3), (1005, [], 3),
    (1006, [1.0] * 64, None), (None, [0.25] * 64, 1), (1007, [-3.0] * 64, 0), (1007, [-3.0] * 64, 0), (1008, [0.0] * 64, 2), (1009, [0.0] * 64, 2),
]
KINDS = "vec_id long, embedding array<double>, label int, cluster string, row int, key double"


@pytest.fixture(scope="module")
def vectors(spark):
    rows = vector_rows(150) + ODD + [(2000 + i, [0.125] * 64, 1) for i in range(40)]  # a hot vector
    return spark.createDataFrame([(*r, "clash", 1, 0.5) for r in rows], KINDS).repartition(5)


def kept(row, dims=64):
    v = row["embedding"]
    return v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)


def test_planes_and_popcounts():
    r = np.random.default_rng(1)
    for size in (1, 7, 200, 1 << 26):
        x, c = r.integers(-size, size + 1, (50, 64)), r.integers(-size, size + 1, (7, 64))
        px, pc = centroids.planes_of(x, centroids.bits_of(x)), centroids.planes_of(c, centroids.bits_of(c) + 2)
        assert (centroids.unpacked(px) == x).all() and (centroids.unpacked(pc) == c).all()
        assert (centroids.dots(px, pc) == x @ c.T).all() and (centroids.squares(px) == (x * x).sum(1)).all()
    zero = np.zeros((3, 64), np.int64)
    assert (centroids.dots(centroids.planes_of(zero, centroids.bits_of(zero)), pc) == 0).all()


def brute_clusters(rows, k, rounds):
    rows = [(r["vec_id"], [int(np.floor(256 * x)) for x in r["embedding"]]) for r in rows if kept(r)]
    order = sorted({(hashlib.sha256(b"2:" + (b"" if i is None else str(i).encode())).hexdigest(), n) for n, (i, _) in enumerate(rows)})
    now = [rows[n][1] for _, n in order[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for last in [False] * rounds + [True]:
        found = [min((dist(v, c), j) for j, c in enumerate(now)) for _, v in rows]
        if last:
            break
        members = defaultdict(list)
        for (_, v), (_, j) in zip(rows, found, strict=True):
            members[j].append(v)
        for j, vs in members.items():
            now[j] = [sum(c) // len(vs) for c in zip(*vs, strict=True)]
    total, own = sum(d for d, _ in found), defaultdict(int)
    for d, j in found:
        own[j] += d
    return sorted(((-1 if i is None else i), j, d, own[j], total, hashlib.sha256(",".join(map(str, now[j])).encode()).hexdigest()) for (i, _), (d, j) in zip(rows, found, strict=True))


@pytest.mark.parametrize(("k", "rounds"), [(40, 5), (3, 2), (1, 0), (1000, 1)])
def test_clustering(spark, vectors, k, rounds):
    got = centroids.cluster(vectors, k, rounds).collect()
    assert sorted((-1 if r.vec_id is None else r.vec_id, *r[1:]) for r in got) == brute_clusters(vectors.collect(), k, rounds)


def test_clustering_of_few_rows(spark, vectors):
    assert centroids.cluster(vectors.limit(0)).collect() == [] and centroids.cluster(vectors.where("vec_id = 1003")).collect() == []
    (one,) = centroids.cluster(spark.createDataFrame([(7, [1.5] * 64)], "vec_id int, embedding array<float>")).collect()
    assert (one.vec_id, one.cluster, one.distance, one.inertia) == (7, 0, 0, 0)
    with pytest.raises(Exception, match="would not fit"):
        centroids.cluster(spark.createDataFrame([(7, [1e30] * 64)], "vec_id long, embedding array<double>")).collect()


def brute_negatives(rows, is_anchor, positives, negatives_, low, high):
    rows = [r for r in rows if r["vec_id"] is not None and r["label"] is not None and r["embedding"] is not None and all(x is not None and np.isfinite(x) for x in r["embedding"])]
    x = [[int(np.floor(256 * c)) for c in r["embedding"]] for r in rows]
    dot = lambda a, b: sum(p * q for p, q in zip(a, b, strict=False))
    out = []
    for i, a in enumerate(rows):
        if is_anchor(a):
            scored = sorted((-dot(x[i], x[j]), r["vec_id"], r["label"] == a["label"]) for j, r in enumerate(rows) if j != i)
            for s, p, _ in [t for t in scored if t[2]][:positives]:
                fits = [t for t in scored if not t[2] and low * -s <= 100 * -t[0] <= high * -s][:negatives_]
                out += [(a["vec_id"], p, n + 1, t[1], -s, -t[0]) for n, t in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize(("positives", "negative", "low", "high", "a_pass"), [(5, 5, 80, 100, 8192), (2, 3, 10, 130, 7), (50, 1, 0, 100, 1), (1, 200, 50, 100, 8192)])
def test_hard_negatives(spark, vectors, positives, negative, low, high, a_pass):
    anchor = (F.col("vec_id") % 20 == 0) | (F.col("vec_id") == 1007)
    got = negatives.hard_negatives(vectors, anchor, positives, negative, low, high, anchors_a_pass=a_pass).collect()
    assert got and sorted(map(tuple, got)) == brute_negatives(vectors.collect(), lambda r: r["vec_id"] % 20 == 0 or r["vec_id"] == 1007, positives, negative, low, high)


def test_hard_negatives_of_odd_tables(spark, vectors):
    one = negatives.hard_negatives(vectors.limit(0), F.col("vec_id") % 20 == 0)
    assert one.collect() == [] and negatives.hard_negatives(vectors, F.lit(False)).collect() == []
    rows = [(i, v, l) for i, v, l in vector_rows(60, 100, 3, 5000.0)] + [(100 + i, v, l) for i, v, l in vector_rows(60, 3, 4, 40000.0)] + [(200, [], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)  # lengths differ, sums leave the doubles' exact range
    got = negatives.hard_negatives(frame, F.col("vec_id") % 5 == 0, least_percent=1).collect()
    assert got and sorted(map(tuple, got)) == brute_negatives(frame.collect(), lambda r: r["vec_id"] % 5 == 0, 5, 5, 1, 100)


def test_segment_bounds_hold_and_tighten():
    r = np.random.default_rng(5)
    x, y = (np.floor(256 * r.normal(r.normal(0, 0.5, (40, 4, 1)), 0.2, (40, 4, 16))).reshape(40, 64) for _ in range(2))
    sx, sy, exact, before = negatives.summary(x), negatives.summary(y), x @ y.T, np.inf
    for level in range(3):
        (mx, dx), (my, dy) = negatives.at_level(sx, 64, level), negatives.at_level(sy, 64, level)
        reach = dx @ dy.T
        assert (np.abs(exact - mx @ my.T) <= reach + 1e-6).all() and reach.mean() < before
        before = reach.mean()


def brute_near(rows, percent, k=5):
    def shingles(text):
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
        return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) or (frozenset([tuple(words)]) if words else frozenset())

    sets = [shingles(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            root[find(j)] = find(i)
    least = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            least[find(i)] = min(r.doc_id, least.get(find(i), r.doc_id))
    out = []
    for i, r in enumerate(rows):
        c = least.get(find(i))
        out.append((r.doc_id, len(sets[i]), c, None if c is None or r.doc_id is None else r.doc_id == c))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("percent", "few"), [(85, 2_000_000), (70, 0)])
def test_near_duplicates_are_all_found(spark, docs, nothing, percent, few):
    r = np.random.default_rng(7)
    words = [f"w{i}" for i in range(300)]
    rows = [(x.doc_id, x.text) for x in docs.collect()] + [(None, "x y z " * 60), (None, "a null id alone"), (3, "other text of a known id")]
    for g in range(25):
        base = r.choice(words, int(r.choice([7, 10, 12, 30, 200, 2000]))).tolist()
        for c in range(8):
            text = list(base)
            for at in r.integers(0, len(text), int(r.integers(0, 1 + len(text) // 60))):
                text[at] = f"edit{r.integers(0, 9)}"
            if c % 3 == 2:
                text = text[int(r.integers(0, 1 + len(text) // 8)) :]
            rows.append((100 * g + c + 1000, " ".join(text)))
    frame = spark.createDataFrame([(*x, 1, "clash") for x in rows], "doc_id long, text string, n int, component_id string").repartition(6)
    got = minhash.near_duplicates(frame, percent=percent, few=few)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_near(frame.collect(), percent)
    assert minhash.near_duplicates(nothing).collect() == []


def test_sketches_are_concentrated():
    r = np.random.default_rng(8)
    for n in (1, 2, 7, 60, 5000):
        for j in (0.5, 0.85):
            shared, own = int(np.ceil(2 * n * j / (1 + j))), n - int(np.ceil(2 * n * j / (1 + j)))
            errors = []
            for _ in range(6):
                h = np.unique(r.integers(0, 1 << 63, shared + 2 * own).astype(np.uint64))
                a, b = (np.sort(np.concatenate([h[:shared], part])) for part in (h[shared : shared + own], h[shared + own :]))
                sa, sb = minhash.sketch(a), minhash.sketch(b)
                assert (minhash.sketch(a) == sa).all() and sa.max() < np.iinfo(np.uint64).max
                errors.append((sa == sb).mean() - shared / (shared + 2 * own))
            assert abs(np.mean(errors)) < 4.5 * (0.25 / minhash.SIZE / 6) ** 0.5 + 0.01


def test_pairs_are_only_ruled_out_when_they_must_be(spark):
    r = np.random.default_rng(9)
    rows, want = [], []
    for i in range(300):
        n, d = int(r.choice([20, 200, 3000])), 0
        d = int(r.integers(0, n // 4))
        h = np.unique(r.integers(0, 1 << 63, n + d).astype(np.uint64))
        a, b = h[: len(h) - d], h[d:]
        rows.append((i, len(a), minhash.marks(np.sort(a), minhash.sketch(a)).view(np.int64).tolist(), len(b), minhash.marks(np.sort(b), minhash.sketch(b)).view(np.int64).tolist()))
        want.append(100 * len(np.intersect1d(a, b)) >= 85 * len(h))
    frame = spark.createDataFrame(rows, "i int, a_n long, a_marks array<long>, b_n long, b_marks array<long>")
    got = {x.i for x in frame.where(minhash.may_link("a_", "b_", 85)).collect()}
    linked = {i for i, w in enumerate(want) if w}
    assert linked <= got and len(got - linked) < 0.5 * (300 - len(linked))

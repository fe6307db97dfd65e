from itertools import combinations

import numpy as np
import pytest
import xxhash

from touchline.llm import classifier, decontam, simhash
from touchline.llm.components import components


def smallest_reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    r = np.random.default_rng(0)
    links = [(i, i + 1) for i in range(40)] + [(int(a), int(b)) for a, b in r.integers(100, 200, (60, 2)) if a != b] + [(7, 3), (7, 3)]
    got = {x.node: x.component for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == smallest_reachable({n for link in links for n in link}, links)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_golay_code():
    code, r = simhash.Golay(), np.random.default_rng(1)
    v = r.integers(0, 1 << 23, 300)
    index = code.decode(v)
    words = np.array(sorted({int(x ^ code.error[code.low[x & 0xFFF] ^ code.high[x >> 12]]) for x in r.integers(0, 1 << 23, 60_000)}))
    assert len(words) > 4000 and min(bin(a ^ b).count("1") for a, b in combinations(words[:80].tolist(), 2)) >= 7
    assert set(index.tolist()) <= set((words >> 11).tolist()) | set(range(4096))
    for d in (1, 2):
        for x in v[:60].tolist():
            flips = r.choice(23, d, replace=False)
            y = x ^ sum(1 << int(i) for i in flips)
            a, b = (set(code.keys(np.array([z]))[0].tolist()) - {-1} for z in (x, y))
            assert a & b and (d == 2 or int(code.decode(np.array([x]))[0]) in b)


def test_keys_meet_within_three_bits():
    r = np.random.default_rng(2)
    for _ in range(200):
        x = int(r.integers(0, 1 << 63))
        y = x
        for i in r.choice(63, r.integers(0, 4), replace=False):
            y ^= 1 << int(i)
        _, narrow = simhash.keys_of(np.array([x], np.int64), wide=False)
        _, wide = simhash.keys_of(np.array([y], np.int64), wide=True)
        assert set(narrow.tolist()) & set(wide.tolist())


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_components(spark, docs, nothing):
    r = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(200)]
    rows = [(x.doc_id, x.text) for x in docs.collect()]
    for g in range(12):
        base = r.choice(vocabulary, 300).tolist()
        for c in range(6):
            words = list(base)
            for at in r.integers(0, 300, c):
                words[at] = "changed"
            rows.append((1000 + 10 * g + c, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    fp = {i: brute_fingerprint(t) for i, t in rows}
    want = smallest_reachable(fp, [(a, b) for a, b in combinations(fp, 2) if bin(fp[a] ^ fp[b]).count("1") <= 3])
    got = simhash.fingerprint_components(frame).collect()
    assert len(got) == len(rows)
    for x in got:
        assert (x.fingerprint, x.component_id) == (f"{fp[x.doc_id]:016x}", want[x.doc_id])
    assert simhash.fingerprint_components(nothing).count() == 0


def test_keys_of_fingerprints_are_never_broadcast(spark, docs, monkeypatch):
    plans = []
    monkeypatch.setattr(simhash, "components", lambda links: plans.append(links._jdf.queryExecution().executedPlan().toString()) or components(links))
    assert simhash.fingerprint_components(docs).count() == docs.count()
    # the 84 keys of a node count as one row in Spark's estimate, which is far below its threshold here
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]


def test_keys_of_near_duplicates_are_never_broadcast(spark, docs, monkeypatch):
    plans, real = [], simhash.stash
    monkeypatch.setattr(simhash, "stash", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    assert simhash.near_duplicates(docs).count() > 0
    # both joins by key within links, and that of keys which several groups hold
    assert sum("SortMergeJoin [key#" in p for p in plans) == 3 and not any("BroadcastHashJoin [key#" in p for p in plans)


def test_most_frequent_hashes_are_bounded(spark):
    counts = spark.createDataFrame([(100 - n, n) for n in range(1, 101)], "h long, n long")
    h, n = simhash.most_frequent(counts, most=60)
    assert len(h) == 37 and set(n.tolist()) == set(range(64, 101)) and (h == 100 - n).all() and sorted(h.tolist()) == h.tolist()
    assert len(simhash.most_frequent(counts, most=10)[0]) == 0 and len(simhash.most_frequent(counts)[0]) == 100


def test_near_duplicates(spark, docs, nothing):
    r = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, sets = [], {}
    for g in range(30):
        base = r.choice(vocabulary, 400).tolist()
        for c in range(4):
            words = list(base)
            for at in r.integers(0, 400, 3 * c):
                words[at] = f"new{g}{c}"
            rows.append((10 * g + c, " ".join(words)))
            sets[10 * g + c] = {tuple(words[i : i + 5]) for i in range(396)}
    rows += [(500, rows[0][1].upper()), (501, None), (502, " ")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {x.doc_id: x.component_id for x in simhash.near_duplicates(frame).collect()}
    similar = [(a, b) for a, b in combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = {n: c for n, c in smallest_reachable(sets, similar).items() if n != c}
    assert got.pop(500) == 0 and got.pop(502) == 501
    assert got == want
    assert {x.doc_id: x.component_id for x in simhash.near_duplicates(frame, few=0).collect()} == want | {500: 0, 502: 501}
    assert simhash.near_duplicates(nothing).count() == 0
    assert {x.doc_id: x.component_id for x in simhash.near_duplicates(docs).collect()} == {1: 0, 2: 0, 14: 13}


def test_near_duplicates_of_documents_with_many_texts(spark):
    base = [[f"{c}{k}" for k in range(60)] for c in "abc"]
    a, b, c = (" ".join(x) for x in base)
    rows = [(1, a, 9, "x"), (2, b + " tail", 9, "x"), (5, b, 9, "x"), (5, a + " tail", 9, "x"), (5, a + " tail", 9, "x"), (7, c, 9, "x"), (7, c, 9, "x"), (8, c + " tail", 9, "x"), (None, a, 9, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, row long, same string").repartition(4)
    assert {x.doc_id: x.component_id for x in simhash.near_duplicates(frame).collect()} == {2: 1, 5: 1, 8: 7}


def test_near_duplicates_of_one_base(spark):
    """Many edited copies of a base that is not there: which edits link, and no pairs by the square."""
    r = np.random.default_rng(6)
    base, rows, sets = [f"b{i}" for i in range(150)], [], {}
    for n in range(240):
        words = list(base)
        for at in r.choice(150, n % 6 + 1, replace=False):
            words[at] = f"e{r.integers(0, 400)}"
        rows.append((n, " ".join(words)))
        sets[n] = {tuple(words[i : i + 5]) for i in range(146)}
    frame = spark.createDataFrame([*rows, *rows[:40]], "doc_id long, text string").repartition(5)
    got = {x.doc_id: x.component_id for x in simhash.near_duplicates(frame).collect()}
    similar = [(a, b) for a, b in combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = {n: c for n, c in smallest_reachable(sets, similar).items() if n != c}
    assert got == want and len(want) > 50


def test_near_duplicates_of_block_edits(spark):
    """Pairs at 0.8 or just above that differ by one block; no third copy joins them."""
    r = np.random.default_rng(8)
    rows, want = [], {}
    for g in range(400):
        words = [f"p{g}w{x}" for x in r.integers(0, 10**6, 404)]
        n, block = 2 * g, [f"p{g}x{x}" for x in r.integers(0, 10**6, 110)]
        if g % 2:
            other = words + block[:100]  # 400 of 500
        else:
            at = int(r.integers(20, 340))
            other = words[:at] + block[:40] + words[at + 40 :]  # 356 of 444
        rows += [(n, " ".join(words)), (n + 1, " ".join(other))]
        a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (words, other))
        if len(a & b) >= 0.8 * len(a | b):
            want[n + 1] = n
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {x.doc_id: x.component_id for x in simhash.near_duplicates(frame).collect()}
    assert len(want) == 400 and got == want


def test_containment(spark, docs, nothing):
    item = " ".join(f"i{k}" for k in range(24))  # 20 shingles
    broken = item.replace("i11", "other")  # 5 of them are gone
    edge = item.replace("i3 ", "other ")  # 4 are gone: 0.8
    rows = [(1, f"before {item.upper()} after"), (2, f"x {broken} y"), (3, f"x {edge} y"), (4, None), (5, "short item"), (6, "a short item"), (1, f"before {item.upper()} after"), (None, item)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (8, "short item"), (9, None), (7, item)], "item_id long, text string")
    got = sorted(tuple(x) for x in decontam.contained(frame, items).collect())
    assert got == [(1, 7, 20, 20, 1.0), (3, 7, 16, 20, 0.8), (5, 8, 1, 1, 1.0)]
    assert decontam.contained(nothing, items).count() == 0 and decontam.contained(frame, items.limit(0)).count() == 0
    assert decontam.contained(docs, items).count() == 0


def test_containment_of_items_with_many_texts(spark):
    question, answer = (" ".join(f"{c}{k}" for k in range(14)) for c in "qa")
    docs = spark.createDataFrame([(1, f"x {question} y"), (2, f"x {answer} y")], "doc_id long, text string")
    items = spark.createDataFrame([(7, question), (7, answer), (7, answer)], "item_id long, text string")
    assert sorted(tuple(x) for x in decontam.contained(docs, items).collect()) == [(1, 7, 10, 10, 1.0), (2, 7, 10, 10, 1.0)]


@pytest.mark.parametrize("limits", [{}, {"most_hashes": 0}, {"most_pairs": 0}, {"most_words": 0}, {"most_hashes": 0, "most_pairs": 0, "most_words": 0}])
def test_containment_beyond_its_broadcasts(spark, limits):
    r = np.random.default_rng(15)
    texts = [(g, " ".join(f"t{x}" for x in r.integers(0, 10**6, 12 + g))) for g in range(30)]
    rows = [(i, " ".join(["pre", *texts[i % 30][1].split()[i % 4 :], "post"])) for i in range(90)]
    rows += [(500, " ".join(texts[3][1].split()[:10])), (500, " ".join(texts[3][1].split()[6:]))]  # two halves of an item in two rows
    sets = {}
    for i, t in rows:
        w = t.split()
        sets.setdefault(i, set()).update(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    want = []
    for g, t in texts:
        w = t.split()
        own = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        want += [(i, g, len(own & s), len(own), len(own & s) / len(own)) for i, s in sets.items() if len(own & s) >= 0.8 * len(own)]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, item_id long, hash string").repartition(5)
    items = spark.createDataFrame([(g, t, 2) for g, t in texts], "item_id long, text string, doc_id long")
    assert sorted(tuple(x) for x in decontam.contained(frame, items, **limits).collect()) == sorted(want)
    assert any(x[0] == 500 for x in want)


@pytest.mark.parametrize("limits", [{}, {"most_hashes": 0, "most_pairs": 0, "most_words": 0}, {"shortest": 1}])
def test_containment_of_short_items(spark, limits):
    r = np.random.default_rng(21)
    items = [(g, " ".join(f"t{x}" for x in r.integers(0, 12, 1 + g % 8))) for g in range(40)] + [(50, None), (51, "  ")]
    rows = [(i, " ".join(f"t{x}" for x in r.integers(0, 12, i % 30))) for i in range(150)] + [(300, items[9][1].upper()), (301, items[8][1]), (302, f"so\n{items[19][1]}\tit is"), (303, None), (304, "t1 " * 5000)]
    want = []
    for i, t in rows:
        d = (t or "").lower().split()
        for g, own in ((g, (x or "").split()) for g, x in items):
            k = min(5, len(own))
            runs = [{tuple(w[j : j + k]) for j in range(len(w) - k + 1)} for w in (d, own)]
            shared = len(runs[0] & runs[1])
            if own and (k >= limits.get("shortest", 3) or len(d) == k) and shared >= 0.8 * len(runs[1]):
                want.append((i, g, shared, len(runs[1]), shared / len(runs[1])))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = decontam.contained(frame, spark.createDataFrame(items, "item_id long, text string"), **limits)
    assert sorted(tuple(x) for x in got.collect()) == sorted(want) and {300, 301, 302} <= {x[0] for x in want}


def test_clean_rows(spark):
    item = " ".join(f"i{k}" for k in range(24))
    rows = [(1, f"a {item} b", 0), (1, "other row of it", 0), (2, "clean text", 0), (None, f"x {item} y", 0), (None, "clean without id", 0), (None, None, 0), (3, None, 0), (2, "clean text", 0)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, id long").repartition(3)
    items = spark.createDataFrame([(None, item), (4, None)], "item_id long, text string")
    got = decontam.clean(frame, items)
    assert got.schema == frame.schema
    assert sorted((str(x.doc_id), str(x.text)) for x in got.collect()) == [("2", "clean text"), ("2", "clean text"), ("3", "None"), ("None", "None"), ("None", "clean without id")]


def test_quality_classifier(spark, docs, nothing):
    r = np.random.default_rng(5)
    words = [f"{a}{b}{c}" for a in "the of and to in".split() for b in "ra me lo".split() for c in "sing ted ly".split()]
    rows, marks = [], []
    for i in range(400):
        good = i % 4 != 0
        text = " ".join(r.choice(words, 80))
        rows.append((i, text if good else "!! ".join(text.upper().split())))
        marks.append((i, int(good), 0))
    labels = spark.createDataFrame([*marks, (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame([*rows, (900, None), (900, None)], "doc_id long, text string")
    got = classifier.classify(frame, labels).collect()
    assert len(got) == len(rows) + 2
    for x in got:
        import zlib

        assert x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) and 0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3)
    held = [(x.predicted, x.doc_id % 4 != 0) for x in got if x.held_out and x.doc_id < 400]
    assert sum(p == y for p, y in held) >= 0.97 * len(held) > 20
    assert classifier.classify(nothing, labels).count() == 0
    assert {x.score for x in classifier.classify(docs, labels.limit(0)).collect()} == {0.5}


def test_votes_by_brute_force():
    r = np.random.default_rng(16)
    unit = lambda n: (lambda v: (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32))(r.normal(size=(n, 8)))
    model = {"vectors": unit(90), "good": (r.random(90) < 0.6).astype(float), "weight": r.random(90) + 0.5, "prior": 0.6}
    asked = unit(40)
    asked[7] = 0
    got = classifier.vote(model, asked)
    for v, score in zip(asked, got):
        near = sorted(((float(v @ m), w, g) for m, w, g in zip(model["vectors"], model["weight"], model["good"])), reverse=True)[: classifier.NEIGHBOURS]
        up, all_ = (sum(np.exp(classifier.SHARPNESS * c) * w * y for c, w, y in ((c, w, g if k else 1) for c, w, g in near)) for k in (1, 0))
        assert abs(score - (up / all_ if v.any() else 0.6)) < 1e-5


def test_classifier_of_clashing_labels_and_columns(spark):
    rows = [(i, f"good plain words number {i} here" if i % 2 else f"BAD !! {i} ##", 0.5, 1, True) for i in range(60)] + [(2, "BAD !! again ##", 0.5, 1, True), (None, "BAD !! none ##", 0.5, 1, True)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score double, predicted int, held_out boolean").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(4, 1), (4, 0), (4, None)], "doc_id long, quality int")
    got = classifier.classify(frame, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == 62
    again = classifier.classify(frame.repartition(7), labels)
    assert sorted((x.doc_id or -1, round(x.score, 5)) for x in got.collect()) == sorted((x.doc_id or -1, round(x.score, 5)) for x in again.collect())
    kept = classifier.accepted(frame, labels)
    assert kept.schema == frame.schema and {x.text for x in kept.collect()} - {"BAD !! 4 ##"} == {t for _, t, *_ in rows if t.startswith("good")}  # 4 is labelled 1

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import neardup


def shingle_set(text, k):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def brute(rows, k=4):
    """Components over all pairs."""
    sets = [(i, shingle_set(t, k)) for i, t in rows]
    top = {i: i for i, _ in rows if i is not None}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 80 * len(a | b):
                p, q = sorted((find(i), find(j)))
                top[q] = p
    return sorted(((i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in sets), key=str)


def corpus(seed, n_base=30, hot=150):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(3_000)]
    rows, i = [], 0

    def edit(words, n):
        words = list(words)
        for _ in range(n):
            words[r.randrange(len(words))] = r.choice(vocab)
        return words

    for _ in range(n_base):
        base = r.choices(vocab, k=r.randint(3, 200))
        for _ in range(r.randint(1, 6)):
            rows.append((i, " ".join(edit(base, r.choice([0, 0, 1, 2, 3, 5, 8])))))
            i += 1
    # copies of one text, some nearer to each other than to it
    base = r.choices(vocab, k=150)
    for _ in range(hot):
        rows.append((i, " ".join(edit(base, r.randint(0, 9)))))
        i += 1
    r.shuffle(rows)
    return rows


def result(df, **kw):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(df, **kw).collect()), key=str)


@pytest.mark.parametrize("size", [4, 5])
def test_equals_all_pairs(docs, size):
    rows = corpus(size)
    assert result(docs(rows), size=size) == brute(rows, size)


def test_large_regions_in_parts(docs):
    # a region that does not fit in a block, so that it is deepened, split and tied by pivots
    rows = corpus(11, 5, 300)
    got, want = result(docs(rows), most=40), brute(rows)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert got == want


def test_no_link_is_lost_between_parts(docs):
    # pairs that are similar to each other and not to the rest, in one region that is oversized in every tree
    r = random.Random(5)
    base, rows = [f"w{i}" for i in range(1_000)], []

    def edit(words, n):
        words = list(words)
        for at in r.sample(range(len(words)), n):
            words[at] = f"x{r.random()}"
        return words

    for i in range(0, 200, 2):
        one = edit(base, 3)
        rows += [(i, " ".join(one)), (i + 1, " ".join(edit(one, 1)))]
    rows += [(i, " ".join(edit(base, 1))) for i in range(200, 260)]
    r.shuffle(rows)
    want = sorted(((i, len(s), c, c == i) for i, s, c in similar(rows, 99)), key=str)
    assert len({w[2] for w in want}) > 50
    assert result(docs(rows), percent=99, most=40) == want


def similar(rows, percent, k=4):
    """(id, set, component) over all pairs of rows with words."""
    sets = {i: shingle_set(t, k) for i, t in rows}
    top = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if i < j and top[i] != top[j] and 100 * (both := len(sets[i] & sets[j])) >= percent * (len(sets[i]) + len(sets[j]) - both):
                one, two = sorted((top[i], top[j]))
                top = {x: one if c == two else c for x, c in top.items()}
    return [(i, s, top[i]) for i, s in sets.items()]


def test_odd_rows(docs):
    long = " ".join(f"q{i % 5000}" for i in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "a b"), (5, "A  B"), (6, "b a"), (7, "a b c d"), (8, "a b c d"), (8, "a b c d"), (None, "a b c d"),
        (9, long), (10, long + " end"), (11, "É x y z"), (12, "é x y z"), (13, "a b c d a b c d"), (14, "a b c d e f g"),
    ]
    extra = docs(rows).withColumns({"id": F.lit("x"), "sig": F.lit(1), "f1": F.lit(2), "component": F.lit(3), "region": F.lit(4)})
    assert result(extra) == brute(rows)


def test_candidates_are_prefix_neighbours(docs):
    """Against plain sorted lists: pairs by the longest common prefix of their labels, at the depth of their region."""
    rows = neardup.sketched(docs(corpus(3, 40, 200)), 4).filter("n_shingles > 0")
    classes = rows.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("id"), F.min("sig").alias("sig")).cache()
    sig = {r.id: (r.n_shingles, np.frombuffer(bytes(r.sig), np.uint32).tolist()) for r in classes.collect()}
    want, depths, left = set(), set(), set()
    for tree in range(neardup.TREES):
        start = tree * neardup.DEPTH
        label = {i: tuple(s[start : start + neardup.LAST_DEPTH]) for i, (_, s) in sig.items()}
        size = Counter(x[:d] for x in label.values() for d in (neardup.SHALLOW, neardup.DEPTH))
        for a in sig:
            depth = next((d for d in (neardup.SHALLOW, neardup.DEPTH) if size[label[a][:d]] <= neardup.SMALL), None)
            if depth is None:
                left.add((tree, a))
                continue
            depths |= {depth} if size[label[a][:depth]] > 1 else set()
            for b in sig:
                (n, x), (m, y) = sig[a], sig[b]
                if a < b and label[a][:depth] == label[b][:depth] and 100 * min(n, m) >= 80 * max(n, m):
                    if sum(p == q for p, q in zip(x, y)) >= neardup.LEAST_AGREEMENT * len(x):
                        want.add((a, b))
    assert depths == {neardup.SHALLOW, neardup.DEPTH} and left
    members, large = neardup.regions(classes)
    assert {(r.tree, r.id) for r in large.collect()} == left
    assert {(r.a, r.b) for r in neardup.neighbour_pairs(members, classes, 80).collect()} == want


def test_common_prefix():
    sig = np.arange(4 * neardup.SIGNATURE, dtype=np.uint32).reshape(4, -1)
    sig[1:3] = sig[0]
    sig[2, 3 * neardup.DEPTH + 2] += 1
    sig[3] = sig[2]
    assert neardup.common_prefix(sig, np.array([3, 3, 3, 4])).tolist() == [neardup.LAST_DEPTH, 2, 0]
    assert neardup.common_prefix(sig[:1], np.array([3])).tolist() == []


def test_empty_table_and_stage(docs):
    assert result(docs([])) == []
    rows = docs([(1, "a b c d e f"), (2, "a b c d e f"), (3, "other words in this one"), (None, "a b c d e f")]).withColumn("_drop", F.lit(1))
    kept = neardup.deduplicated(rows)
    assert kept.columns == rows.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "None"]


def test_components_of_long_chains(spark):
    r = random.Random(1)
    names = r.sample(range(10_000), 600)
    links = [(min(p), max(p)) for p in zip(names, names[1:])] + [(20_001, 20_002)] * 3 + [(20_000, x) for x in range(20_010, 20_200)]
    got = {(x.id, x.component) for x in neardup.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {(n, min(names)) for n in names} | {(20_001, 20_001), (20_002, 20_001), (20_000, 20_000)} | {(x, 20_000) for x in range(20_010, 20_200)}


def test_words_of_one_pattern_make_different_shingles(docs):
    """Thue-Morse words and their complements, which cancel out in sums over powers of a base."""
    pairs = ["".join("ab"[(bin(i).count("1") + k) & 1] for i in range(n)) for n in (1024, 4096) for k in (0, 1)]
    rows = [(1, " ".join(pairs * 3)), (2, pairs[0]), (3, pairs[1]), (4, pairs[2]), (5, pairs[3]), (6, pairs[1])]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs(rows)).collect()}
    assert got == {1: (4, 1), 2: (1, 2), 3: (1, 3), 4: (1, 4), 5: (1, 5), 6: (1, 3)}

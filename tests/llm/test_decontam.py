import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import decontam as dc

ITEMS = "item_id bigint, text string"


def words(r, n, vocab=400):
    return [f"{r.choice('abcdefgh')}{r.randrange(vocab)}" if r.random() < 0.7 else r.choice(["the", "of", "and"]) for _ in range(n)]


def brute_search(index, terms):
    """Scores of all segments, one by one."""
    total = [0.0] * len(index.items)
    for t in terms:
        for p in range(index.at[t], index.at[t + 1]):
            total[index.segments[p]] += index.impacts[p]
    return [(s, x) for s, x in enumerate(total) if x >= dc.THRESHOLD - 1e-9]


@pytest.mark.parametrize("seed", range(4))
def test_wand_finds_all_above_the_threshold(seed):
    r = random.Random(seed)
    index = dc.Index.alone([(i, " ".join(words(r, r.randint(2, 40), 60))) for i in range(150)])
    names = list(index.terms.values())
    for _ in range(60):
        terms = sorted(set(r.choices(names, k=r.randint(1, 120))))
        got = dict(index.search(list(terms)))
        assert got == pytest.approx(dict(brute_search(index, terms)))


@pytest.mark.parametrize("seed", range(3))
def test_no_passage_is_left_out_by_the_first_bound(seed):
    r = random.Random(seed)
    items = [(i, " ".join(words(r, r.randint(3, 30), 80)) + ". " + " ".join(words(r, 4, 80))) for i in range(60)]
    index = dc.Index.alone(items)
    texts = []
    for _ in range(40):
        body = words(r, r.randint(1, 300), 80)
        if r.random() < 0.5:
            at = r.randrange(len(body))
            body[at:at] = items[r.randrange(60)][1].upper().split()
        texts.append(" ".join(body))
    got = {(row, item) for row, item, *_ in index.texts(pa.array(texts))}
    want = set()
    step = index.longest
    for row, text in enumerate(texts):
        ids = [index.terms.get(t, -1) for t in dc.terms_of(text)]
        for k in range(max(1, -(-len(ids) // step) - 1)):
            window = ids[k * step : (k + 2) * step]
            triples = dc._triples(window)
            for s, _ in brute_search(index, sorted({t for t in window if t >= 0})):
                q, a, w = (len(x & triples) / len(x) if x else 1.0 for x in index.parts[s])
                if (q >= dc.OVERLAP and a >= dc.OVERLAP) or w >= dc.WHOLE:
                    want.add((row, index.items[s]))
    assert got == want


def test_edited_copies_of_items_with_short_answers():
    question = [f"q{i}" for i in range(20)]
    edited = [w if i not in (4, 10, 16) else f"z{i}" for i, w in enumerate(question)]
    items = [(n, " ".join(f"{w}n{n}" for w in question) + "? " + " ".join(f"{w}{n}" for w in ("paris", "france", "europe")[:n])) for n in (1, 2, 3)]
    texts, want = [], set()
    for n, item in items:
        answer = item.split("? ")[1].split()
        copy = [w if w[0] == "z" else f"{w}n{n}" for w in edited]
        for tail in (answer, ["so", "then", *answer], answer[::-1], ["nothing"], ["x"] * 500 + answer):
            # words in plain lists: at least half of the question's triples, and the answer as it is within the item's length
            body = ["before", "it", *copy, *tail, "after"]
            both = [copy[i : i + 3] == [f"{w}n{n}" for w in question[i : i + 3]] for i in range(18)]
            beside = any(body[i : i + n] == answer for i in range(22 + 20 + n))
            if sum(both) >= 9 and beside:
                want.add((len(texts), n))
            texts.append(" ".join(body))
    found = list(dc.Index.alone(items).texts(pa.array(texts)))
    assert {(row, item) for row, item, *_ in found} == want
    assert {item for _, item in want} == {1, 2, 3} and (2, 1) in want and (7, 2) not in want


def test_short_items_and_rests_of_long_ones():
    long = " ".join(f"t{i}" for i in range(256)) + " the end"
    index = dc.Index.alone([(1, "Capital? Paris"), (2, "one"), (3, long), (4, ""), (5, "?!")])
    texts = ["the capital was, then, Paris", "capital " + "x " * 9 + "paris", "no one here", "one", "the end", "a capital", long]
    assert {(row, item) for row, item, *_ in index.texts(pa.array(texts))} == {(0, 1), (2, 2), (3, 2), (6, 3)}


def test_leaks_odd_rows_and_shards(spark, docs):
    item = "What is the tallest mountain of the northern continent? Mount Everlong the third"
    items = [(1, item), (2, None), (3, ""), (4, "Short one"), (5, item), (None, "a question without an id\nanswer here now"), (6, "..."), (7, " ".join(f"t{i}" for i in range(900)))]
    bench = spark.createDataFrame(items, ITEMS)
    rows = [
        (1, f"Some text, {item.upper()}!! and more text"), (2, "What is the tallest mountain of the northern continent? nobody knows"), (3, None), (4, ""),
        (5, "..."), (6, "x y z " * 50_000 + item), (None, item), (7, "a clean document about the weather of the north"), (7, f"again {item}"), (8, " ".join(f"t{i}" for i in range(300, 620))),
        (9, "so: a question without an id answer, here now"),
    ]
    extra = docs(rows).withColumns({"item_id": F.lit("x"), "score": F.lit(1), "_rows": F.lit(2)})
    want = {(d, i) for d in (1, 6, None, 7) for i in (1, 5)} | {(8, 7), (9, None)}
    for shard_bytes in (dc.SHARD_BYTES, 200):
        got = dc.leaks(extra, bench, shard_bytes).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want
    kept = dc.decontaminated(extra, bench)
    assert kept.columns == extra.columns
    assert sorted((r.doc_id, r.text) for r in kept.filter("doc_id <> 4 and doc_id <> 3").collect()) == sorted((i, t) for i, t in rows if (i, t) in [rows[1], rows[4], rows[7]])
    assert kept.count() == 5


def test_scores_do_not_depend_on_the_number_of_shards(spark, docs):
    r = random.Random(8)
    items = [(i, " ".join(words(r, r.randint(3, 500), 80)) + "? " + " ".join(words(r, r.randint(1, 6), 80))) for i in range(40)]
    items += [(100 + i, items[0][1]) for i in range(30)]
    texts = [(i, " ".join([*words(r, 200, 80), *items[r.randrange(40)][1].split(), *words(r, 50, 80)])) for i in range(30)]
    bench = spark.createDataFrame(items, ITEMS)
    results = []
    for shard_bytes in (dc.SHARD_BYTES, 2_000):
        assert shard_bytes > 2_000 or len(list(dc.Benchmark.of(bench).shards(shard_bytes))) >= 15
        results.append(sorted(map(tuple, dc.leaks(docs(texts), bench, shard_bytes).collect())))
    assert results[0] == results[1] and len({d for d, *_ in results[0]}) == 30
    # the same as one index of the distinct segments, made without Spark
    named = {s: None for _, text in items for s in map(lambda x: (tuple(x[0]), tuple(x[1])), dc.segments_of(text))}
    alone = dc.Index(list(named), [tuple(map(list, s)) for s in named], dc.Statistics.of(list(named)))
    got = {}
    for row, segment, *x in alone.texts(pa.array([t for _, t in texts])):
        for i, text in items:
            if segment in [tuple(map(tuple, s)) for s in dc.segments_of(text)]:
                got[row, i] = tuple(max(a, b) for a, b in zip(x, got.get((row, i), x)))
    assert {k: tuple(round(z, 9) for z in v) for k, v in got.items()} == {(d, i): tuple(round(z, 9) for z in x) for d, i, *x in results[0]}


def test_words_of_one_pattern_are_different_terms():
    pair = ["".join("ab"[(bin(i).count("1") + k) & 1] for i in range(1024)) for k in (0, 1)]
    index = dc.Index.alone([(1, f"one two {pair[0]} three? four five")])
    texts = [f"one two {pair[0]} three four five", f"{pair[1]} {pair[0]}", pair[1], pair[0]]
    assert {row for row, *_ in index.texts(pa.array(texts))} == {0}


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], ITEMS)
    assert dc.leaks(docs([(1, "a b c")]), none).count() == 0
    assert dc.leaks(docs([]), spark.createDataFrame([(1, "a b c")], ITEMS)).count() == 0
    assert dc.decontaminated(docs([(1, "a b c")]), none).count() == 1

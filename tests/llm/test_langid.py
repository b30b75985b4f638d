import math
import re
import zlib

from pyspark.sql import functions as F

from ledgerloom.llm import langid

SF = "/root/testdata/sf0.001"

TRAIN = [(i, t, lang) for i, (t, lang) in enumerate([("the house and the garden", "en"), ("das haus und der garten", "de"), ("the dog and the cat", "en"), ("der hund und die katze", "de")] * 5)]


def model(docs):
    return langid.fit(docs(TRAIN).select("doc_id", "text", "lang"))


def test_words_first_then_shorter_ngrams(docs):
    m = model(docs)
    s = langid.Scorer(m)
    assert m["languages"] == ["de", "en"]
    assert s.run("garden") == m["w"]["garden"]
    assert "gardener" not in m["w"]
    grams = [m["5"][g] for g in langid._grams("gardener", 5) if g in m["5"]]
    assert s.run("gardener") == [sum(x) / len(grams) for x in zip(*grams)]
    shorter = [m["2"][g] for g in langid._grams("zzkaz", 2) if g in m["2"]]
    assert not any(g in m["4"] for g in langid._grams("zzkaz", 4))
    assert shorter and s.run("zzkaz")[0] > s.run("zzkaz")[1]
    assert s.run("ßßß") == [0.0, 0.0]


def test_a_text_is_the_mean_of_its_words_in_any_batch(docs):
    import pyarrow as pa

    m = model(docs)
    s = langid.Scorer(m)
    texts = ["The dog, and the KATZE!", "", None, "123 ...", "hund-garden"]
    sums = s.texts(pa.array(texts))
    alone = [s.run(w) for w in ("the", "dog", "and", "the", "katze")]
    assert [round(x, 9) for x in sums[0]] == [round(sum(x), 9) for x in zip(*alone)] + [5]
    assert sums[:, -1].tolist() == [5, 0, 0, 0, 2]


def test_odd_rows(docs):
    rows = [(1, None), (2, ""), (3, "42 !!"), (4, "the cat " * 50_000), (None, "der hund"), (5, "der hund"), (5, "der hund")]
    extra = docs(rows).withColumns({"score": F.lit("x"), "lang_pred": F.lit(1), "part": F.lit(2)})
    got = langid.predicted(extra, model(docs))
    out = sorted(((r.doc_id, r.lang_pred, r.score > 0.5) for r in got.collect()), key=str)
    assert out == sorted([(1, "und", False), (2, "und", False), (3, "und", False), (4, "en", True), (None, "de", True), (5, "de", True), (5, "de", True)], key=str)
    assert "part" in got.columns and all(0 <= r.score <= 1 for r in got.collect())


def test_nothing_to_learn_or_to_predict(docs):
    empty = langid.fit(docs([]).select("doc_id", "text", "lang"))
    assert [(r.lang_pred, r.score) for r in langid.predicted(docs([(1, "a")]), empty).collect()] == [("und", 0.0)]
    assert langid.predicted(docs([]), empty).count() == 0
    assert langid.recognized(docs([])).count() == 0


def test_stage_keeps_columns_and_drops_unrecognized(docs):
    rows = docs([*TRAIN, (90, "...", "en"), (91, None, "en")]).withColumn("_row", F.lit(1))
    kept = langid.recognized(rows)
    assert kept.columns == rows.columns
    assert {r.doc_id for r in kept.collect()} == set(range(20))


def test_only_letters_make_words(docs):
    """Fractions, superscripts, circled and Roman numerals are no letters."""
    rows = [(i, x) for i, x in enumerate(["½", "x²", "②", "Ⅷ ⅓", "٣", "_", "ª", "日本", "é", "é"])]
    got = {r.doc_id: r.lang_pred for r in langid.predicted(docs(rows), model(docs)).collect()}
    assert [i for i, lang in got.items() if lang == "und"] == [0, 2, 3, 4, 5]
    s = langid.Scorer(model(docs))
    assert s.word("x²y")[-1] == 2


def test_a_small_language_keeps_its_words(docs):
    """However many entries a large language has, a rare one has its own quota."""
    large = [(i, " ".join(f"wort{chr(97 + i % 26)}{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(200)), "de") for i in range(60)]
    small = [(1000 + i, "ett litet ord", "sv") for i in range(2)]
    m = langid.fit(docs(large + small).select("doc_id", "text", "lang"), quota=50)
    place = m["languages"].index("sv")
    assert {w for w, s in m["w"].items() if s[place] > min(s)} >= {"ett", "litet", "ord"}
    assert len(m["w"]) <= 100 and langid.Scorer(m).run("litet")[place] == max(langid.Scorer(m).run("litet"))


def brute(train, texts, quota=langid.QUOTA):
    """Everything again with plain dicts."""
    counts = {}
    for _, text, lang in train:
        for run in re.findall(r"[^\W\d_]+", text.lower()):
            counts[lang, "w", run] = counts.get((lang, "w", run), 0) + 1
            for n in range(1, 6):
                padded = run if n == 1 else f" {run} "
                for i in range(len(padded) - n + 1):
                    counts[lang, n, padded[i : i + n]] = counts.get((lang, n, padded[i : i + n]), 0) + 1
    counts = {k: n for k, n in counts.items() if n > 1 or k[1] != "w"}
    total, best = {}, {}
    for (lang, kind, entry), n in counts.items():
        total[lang, kind] = total.get((lang, kind), 0) + n
        best.setdefault((lang, kind), []).append((-n, entry))
    kept = {(lang, kind, e): math.log(-n / total[lang, kind]) for (lang, kind), x in best.items() for n, e in sorted(x)[:quota]}
    languages = sorted({k[0] for k in total})
    miss = {kind: min(min((s for k, s in kept.items() if k[:2] == (lang, kind)), default=-math.log(1 + quota)) for lang in languages) - langid.PENALTY for kind in ("w", 1, 2, 3, 4, 5)}

    def word(w):
        for kind in ("w", 5, 4, 3, 2, 1):
            padded = w if kind in ("w", 1) else f" {w} "
            parts = [w] if kind == "w" else [padded[i : i + kind] for i in range(len(padded) - kind + 1)]
            known = [p for p in parts if any((lang, kind, p) in kept for lang in languages)]
            if known:
                return [sum(kept.get((lang, kind, p), miss[kind]) for p in known) / len(known) for lang in languages]
        return [0.0] * len(languages)

    out = {}
    for i, text in texts:
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not words:
            out[i] = ("und", 0.0)
            continue
        mean = [sum(x) / len(words) for x in zip(*map(word, words))]
        weight = [math.exp((m - max(mean)) * min(len(words), 40)) for m in mean]
        k = max(range(len(mean)), key=lambda j: (round(mean[j], 9), -j))
        out[i] = (languages[k], weight[k] / sum(weight))
    return out


def test_equals_plain_dicts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    own = [tuple(r) for r in rows.collect()]
    train = [r for r in own if r[1] and r[2] and zlib.crc32(str(r[0]).encode()) % 4 != 2]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predicted(rows, langid.fit(rows.filter(~langid.held_out("doc_id", 4, 2)))).collect()}
    want = brute(train, [r[:2] for r in own])
    assert {i: lang for i, (lang, _) in got.items()} == {i: lang for i, (lang, _) in want.items()}
    assert all(abs(got[i][1] - want[i][1]) < 1e-9 for i in want)
    held = [(lang, got[i][0]) for i, t, lang in own if lang and zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and sum(a == b for a, b in held) >= 0.95 * len(held)

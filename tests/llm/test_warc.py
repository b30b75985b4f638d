import gzip
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import warc
from ledgerloom.llm.store import new_folder, read_files

PAGES = "page_id bigint, url string, html string"


def archived(spark, rows, extra=None):
    df = spark.createDataFrame(rows, PAGES)
    path = new_folder(spark, "warc")
    warc.write_archives(df.withColumns(extra or {}), path, F.lit(1_704_067_200) + F.coalesce("page_id", F.lit(0)))
    return path


def result(spark, rows, extra=None):
    out = warc.merged(warc.read_runs(spark, archived(spark, rows, extra)), 5).collect()
    return {(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in out}, out


def test_loser_tree_equals_sorting():
    r = random.Random(3)
    for k in range(9):
        runs = [sorted(r.choices(range(12), k=r.randint(0, 9))) for _ in range(k)]
        assert [runs[i][j] for i, j in warc.LoserTree(runs)] == sorted(x for run in runs for x in run)
        ties = [(i, j) for i, j in warc.LoserTree(runs)]
        assert all(ties.index((i, j)) < ties.index((i, j + 1)) for i, j in ties if (i, j + 1) in ties)


def test_url_keys():
    assert warc.url_key("https://Blog.Example.com/a?b=1#c") == "com,example,blog)/a?b=1"
    assert warc.url_key("http://www.example.com") == "com,example)/"
    assert warc.url_key("http://example.com:8080/x") == "com,example:8080)/x"
    assert warc.url_key(None) == "" and warc.url_key("no url") == "no url" and warc.url_key("http://[x") == "http://[x"


def test_revisits_odd_rows_and_clashing_columns(spark):
    big, é = "x" * 1000, "é" * 500
    rows = [
        (1, "http://a.com/", big), (2, "http://b.com/", big), (2, "http://b.com/", big), (3, None, None), (4, "http://a.com/\r\nX: y", "x" * 999), (5, "u", "x" * 999),
        (6, "u", é), (7, "u", é), (None, "u", big), (None, "u", "n" * 1000), (8, "u", "<a>\r\n\r\nWARC/1.1\r\n\0" * 100_000), (9, "", ""),
    ]
    got, out = result(spark, rows, {"captured": F.lit("x"), "latest": F.lit(5), "archive": F.lit("y")})
    assert len(out) == len(rows)
    assert got == {
        (1, 1000, "revisit", 2), (2, 1000, "response", None), (3, 0, "response", None), (4, 999, "response", None), (5, 999, "response", None),
        (6, 1000, "revisit", 7), (7, 1000, "response", None), (None, 1000, "revisit", 2), (None, 1000, "response", None),
        (8, 1_800_000, "response", None), (9, 0, "response", None),
    }
    assert result(spark, [])[1] == []


def test_histories_are_in_global_order(spark):
    r = random.Random(5)
    rows = [(i, r.choice(["http://hot.com/"] * 5 + [f"http://h{k}.org/p" for k in range(40)]), f"page {r.random()}") for i in range(400)]
    _, out = result(spark, rows)
    keys = [warc._key(x.asDict()) for x in sorted(out, key=lambda x: (x.range, x.position))]
    assert keys == sorted(keys) and len(keys) == 400
    assert len({x.range for x in out if x.urlkey == "com,hot)/"}) > 1


def test_archives_are_gzip_members_and_damage_is_found(spark):
    path = archived(spark, [(i, "http://a.com/", f"text {i}" * 200) for i in range(30)])
    content = bytes(read_files(spark, path).first().content)
    found = list(warc.members(memoryview(content), 100))
    assert gzip.decompress(content).count(b"WARC-Type: response") == len(found) - 1
    at, n, data = found[-1]
    assert gzip.decompress(content[at : at + n]) == data
    with pytest.raises(ValueError, match="digest"):
        warc.parse(data.replace(b"text", b"tent"))


def test_places_are_the_order_of_url_keys_and_times(spark):
    """Range and position of the merge are one global order, from 0 without gaps, whatever run a capture was in."""
    rows = [(i, f"https://{'abc'[i % 3]}.example.com/{i * 7919 % 101}", "x" * (i % 5)) for i in range(400)] + [(None, "https://a.example.com/0", None), (3, None, "y")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    path = new_folder(spark, "warc")
    warc.write_archives(pages.repartition(5), path, F.lit(1000) + F.coalesce(F.col("page_id"), F.lit(0)))
    runs = warc.read_runs(spark, path)
    merged = warc.merged(runs, rows_per_range=50)
    assert merged.select("range").distinct().count() > 3
    got = warc.in_order(merged).orderBy("place").collect()
    assert [r.place for r in got] == list(range(len(rows)))
    keys = [(r.urlkey, r.captured, r.page_id is not None, r.page_id or 0) for r in got]
    assert keys == sorted((warc.url_key(u), 1000 + (i or 0), i is not None, i or 0) for i, u, _ in rows)

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import tokens
from ledgerloom.llm.store import new_folder, read_files, write_files

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
ODD = [
    (5, "Hello world, it's a test; they're 12 o'clock  \t\n x"), (3, None), (9, ""), (1, "   \n"), (2, "naïve ÉCOLE straße é ﬁ 日本語  x"),
    (7, "a<|endoftext|>b <|startoftext|>"), (8, "word " * 30_000), (4, "don't stop!!! (really) ... foo.bar,baz ñandú×÷"), (10, "x" * 5_000),
    (None, "no id"), (6, "same"), (6, "same"), (6, "other"),
]


def brute(rows):
    t = Tokenizer.from_file(PATH)
    return {(i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, x in rows for ids in [[*t.encode(x or "", add_special_tokens=False).ids, 2]]}


def test_round_trip_equals_the_library(docs):
    out = tokens.tokenized(docs(ODD), PATH).orderBy("start").collect()
    assert len(out) == len(ODD)
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in out} == brute(ODD)
    assert [r.doc_id for r in out] == [None, 1, 2, 3, 4, 5, 6, 6, 6, 7, 8, 9, 10]
    assert [r.start for r in out] == [0, *np.cumsum([r.n_tokens for r in out])[:-1].tolist()]


def test_other_tokenizers_encode_whole_texts(docs):
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(1, "Two  words"), (2, "x")]
    t = Tokenizer.from_file(path)
    want = {(i, len(t.encode(x, add_special_tokens=False).ids) + 1) for i, x in rows}
    assert {(r.doc_id, r.n_tokens) for r in tokens.tokenized(docs(rows), path).collect()} == want


def test_documents_are_fetched_alone_and_other_dictionaries_refused(spark, docs, tmp_path):
    path = new_folder(spark, "tokens")
    tokens.write_tokens(docs([(i, f"some words {i} and others") for i in range(300)]), path, PATH)
    t = Tokenizer.from_file(PATH)
    got = {r.doc_id: r.ids for r in tokens.fetch(spark, path, [7, 250]).collect()}
    assert got == {i: [*t.encode(f"some words {i} and others", add_special_tokens=False).ids, 2] for i in (7, 250)}
    files = read_files(spark, f"{path}/ids").collect()
    with pytest.raises(ValueError):
        list(tokens._frames([__import__("pyarrow").RecordBatch.from_pydict({"path": [f.path for f in files], "content": [bytes(f.content) for f in files]})], b""))


def test_short_access_reads_only_files_that_can_hold_a_document(spark, docs, monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK_BYTES", 2_000)
    path = new_folder(spark, "tokens")
    tokens.write_tokens(docs([(i, f"some words {i} and others") for i in range(900)] + [(None, "null")]), path, PATH)
    every = {f.path for f in read_files(spark, f"{path}/ids").collect()}
    files = tokens.files_with(spark, path, [7, 850])
    assert 0 < len(files) <= 2 < len(every) and set(files) <= every
    # the other files are not needed, and nothing is found where nothing is
    assert {r.doc_id for r in tokens.fetch(spark, path, [7, 850, 5000]).collect()} == {7, 850}
    assert tokens.fetch(spark, path, [5000]).collect() == []
    assert [r.start for r in tokens.read_tokens(spark, path).orderBy(F.col("doc_id").asc_nulls_first()).collect()][:2] == [0, 2]


def test_words_of_one_pattern_keep_their_own_ids(docs):
    """Thue-Morse words and their complements, which cancel out in sums over powers of a base."""
    pairs = ["".join("ab"[(bin(i).count("1") + k) & 1] for i in range(n)) for n in (100, 255, 256, 1024, 4096) for k in (0, 1)]
    rows = [(1, " ".join(pairs)), *((i + 2, w) for i, w in enumerate(pairs)), (50, " ".join(reversed(pairs)))]
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in tokens.tokenized(docs(rows), PATH).collect()} == brute(rows)


def test_equal_rows_go_to_several_files_tasks(docs):
    out = tokens.tokenized(docs([(1, "a b")] * 3000), PATH).collect()
    assert sorted(r.start for r in out) == list(range(0, 9000, 3))


def test_empty_table_and_clashing_columns(docs):
    assert tokens.tokenized(docs([])).count() == 0
    extra = docs([(1, "a b")]).withColumns({"start": F.lit("x"), "file": F.lit(1), "content": F.lit(2), "_hash": F.lit(0)})
    assert [r.n_tokens for r in tokens.tokenized(extra).collect()] == [3]


def test_files_keep_any_bytes(spark):
    path = new_folder(spark, "raw")
    data = [bytes(range(256)) * 40, b"\0", b"\xff\xfe\n\r"]
    write_files(spark.createDataFrame([(bytearray(d),) for d in data], "b binary"), path)
    assert sorted(bytes(r.content) for r in read_files(spark, path).collect()) == sorted(d + b"\0" for d in data)

"""Token-ID files: documents in ascending id order, each compressed by itself with one shared zstandard dictionary.

A file holds a header (place in the order, counts, SHA-256 of the dictionary), one zstandard frame per document, and an
index (id, offset, length, tokens) at its end. The dictionary is trained on a bounded sample of serialized id arrays and
stored beside the files, as is a table of the files (path, place, smallest and largest id, tokens in front): so a short
document is read from the files that can hold it and without touching other documents.

Documents are encoded and compressed where they are read; only frames are put in order and packed into files.

Texts are encoded by the ``tokenizers`` library. If the tokenizer drops white space and splits before anything else (its
file says so), a text's ids are those of its words one after another; then each distinct word is encoded once per worker
and the rest are array lookups. Words of plain letters skip the normalizer and the splitting pattern, which change nothing
in them but case; all others go through the whole tokenizer. Other tokenizers encode whole texts.

A null or empty text is the end id alone. Rows with one id follow each other in the order of a hash of their text; rows
with a null id come first. An empty table writes no file and reads as an empty result. Other columns are not read."""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerloom.llm import text as tx
from ledgerloom.llm.store import durable, new_folder, partitions_for, read_files, write_files

MAGIC = b"IDFRAMES"
HEADER = np.dtype([("magic", "S8"), ("part", "<i4"), ("chunk", "<i4"), ("docs", "<u8"), ("tokens", "<u8"), ("index", "<u8"), ("width", "<u1"), ("dictionary", "S64")])
INDEX = np.dtype([("doc_id", "<i8"), ("null_id", "?"), ("offset", "<u8"), ("length", "<u8"), ("tokens", "<u8")])
CHUNK_BYTES = 2 << 20
#: Bounds of the sample that the dictionary is trained on, and the dictionary's size.
SAMPLE_DOCS, SAMPLE_IDS, DICTIONARY_BYTES = 500, 16_384, 32 << 10
_MEMO_WORDS = 500_000
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)\Z")


class Encoder:
    """Ids of texts. A worker keeps one from task to task; it remembers the words it has met, up to a bound."""

    @classmethod
    def of(cls, path: str) -> Encoder:
        return tx.kept(("encoder", path), lambda: cls(path))

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.steps = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [x["type"] for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        split = spec["pre_tokenizer"]["pretokenizers"][0] if kinds == ["Split", "ByteLevel"] else {}
        steps = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.by_word = split.get("behavior") == "Removed" and split.get("invert") is True and steps == ["NFC", "Replace", "Lowercase"]
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.forget()
        if self.by_word:
            self.last = np.zeros(self.size, bool)
            self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
            self.letters = str.maketrans({chr(c): "".join(_byte_letters()[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)})

    def forget(self) -> None:
        self.seen = tx.Numbers(_MEMO_WORDS)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.at, self.n = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts and where each row's begin (one place more than rows)."""
        if not self.by_word:
            ids = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch([t or "" for t in column.to_pylist()], add_special_tokens=False)]
            return np.concatenate([np.zeros(0, np.uint32), *ids]), np.cumsum([0, *map(len, ids)])
        w = tx.words(column)
        if not len(w.starts):
            return np.zeros(0, np.uint32), np.zeros(len(w.first), np.int64)
        distinct, where, back = np.unique(tx.hashes(w), return_index=True, return_inverse=True)
        if self.seen.full(distinct):
            self.forget()
        known, new = self.seen.of(distinct)
        if len(new):
            s, e = w.starts[where[new]].tolist(), w.ends[where[new]].tolist()
            raw = w.data.tobytes()
            self.learn(known[new], [raw[a:b].decode("utf-8", "replace") for a, b in zip(s, e)])
        place = known[back]
        n = self.n[place]
        upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
        ids = self.flat[np.repeat(self.at[place] - upto[:-1], n) + np.arange(upto[-1])]
        return ids, upto[w.first]

    def learn(self, numbers: np.ndarray, words: list[str]) -> None:
        """Encode new words and keep their ids under their numbers."""
        parts, counts, other = [], [], []
        for i, m in enumerate(map(_PLAIN.match, words)):
            if not m:
                other.append(i)
                counts.append(0)
            elif m[2]:
                parts += m.groups()
                counts.append(2)
            else:
                parts.append(m[1])
                counts.append(1)
        pieces = np.array(counts, np.int64)
        # a call for each line, not for each word: letters become small and then their bytes' letters one by one
        lines = [" ".join(parts[i : i + 1000]).lower() for i in range(0, len(parts), 1000)]
        lines = [x if x.isascii() else x.translate(self.letters) for x in lines]
        coded = self.encoded(lines, bare=True)
        plain = np.concatenate([np.zeros(0, np.uint32), *coded])
        bounds = np.concatenate([np.zeros(1, np.int64), np.flatnonzero(self.last[plain]) + 1])
        ends = np.cumsum(pieces)
        begin, size = self.used + bounds[ends - pieces], bounds[ends] - bounds[ends - pieces]
        whole = self.encoded([words[i] for i in other])
        if other:
            size[other] = [len(x) for x in whole]
            begin[other] = self.used + len(plain) + np.cumsum([0, *map(len, whole)])[:-1]
        fresh = np.concatenate([plain, *whole])
        self.flat = tx.room(self.flat, self.used + len(fresh))
        self.at, self.n = (tx.room(x, int(numbers[-1]) + 1) for x in (self.at, self.n))
        self.flat[self.used : self.used + len(fresh)] = fresh
        self.used += len(fresh)
        self.at[numbers], self.n[numbers] = begin, size

    def encoded(self, texts: list[str], bare: bool = False) -> list[np.ndarray]:
        """Ids of texts; ``bare`` splits at spaces and does nothing else to them."""
        from tokenizers.pre_tokenizers import WhitespaceSplit

        if not texts:
            return []
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = (None, WhitespaceSplit()) if bare else self.steps
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for a byte in byte-level vocabularies: itself where printable, else from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _id_arrays(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int) -> Iterator[tuple[int | None, np.ndarray]]:
    encoder = Encoder.of(tokenizer)
    for batch in batches:
        for part in tx.slices(batch, "text"):
            ids, at = encoder.texts(part.column("text"))
            for i, doc_id in enumerate(part.column("doc_id").to_pylist()):
                yield doc_id, np.append(ids[at[i] : at[i + 1]], np.uint32(end_id))


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, width: int) -> bytes:
    """A dictionary from at most SAMPLE_DOCS documents of at most SAMPLE_IDS ids, chosen by a hash of the id; empty if
    there are too few to train one."""
    n = docs.count()
    chosen = docs.filter(F.col("doc_id").isNotNull())
    if n > SAMPLE_DOCS:
        chosen = chosen.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < F.lit(int((1 << 40) * SAMPLE_DOCS / n)))

    def serialize(batches):
        for _, ids in _id_arrays(batches, tokenizer, end_id):
            if len(ids) <= SAMPLE_IDS:
                yield pa.RecordBatch.from_arrays([pa.array([ids.astype(f"<u{width}").tobytes()], pa.binary())], ["ids"])

    sample = [bytes(r[0]) for r in chosen.mapInArrow(serialize, "ids binary").limit(2 * SAMPLE_DOCS).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sorted(sample)).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _compression(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> str:
    """Encode ``docs`` (doc_id, text) into files under ``path``; returns the dictionary's SHA-256."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    width = 2 if max(Encoder.of(tokenizer).size - 1, end_id) < 1 << 16 else 4
    dictionary = train_dictionary(docs, tokenizer, end_id, width)
    digest = hashlib.sha256(dictionary).hexdigest()
    write_files(spark.createDataFrame([(bytearray(dictionary),)], "dictionary binary"), f"{path}/dictionary")

    def encode(batches):
        packer = zstandard.ZstdCompressor(level=3, **_compression(dictionary))
        encoder = Encoder.of(tokenizer)
        for batch in batches:
            for part in tx.slices(batch, "text"):
                ids, at = encoder.texts(part.column("text"))
                own = [np.append(ids[a:b], np.uint32(end_id)).astype(f"<u{width}") for a, b in zip(at[:-1], at[1:])]
                columns = [pa.array([len(x) for x in own], pa.int64()), pa.array([packer.compress(x.tobytes()) for x in own], pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("hash"), *columns], ["doc_id", "hash", "tokens", "frame"])

    def pack(batches):
        part, chunk = TaskContext.get().partitionId(), 0
        frames, index, size = [], [], 0

        def file():
            head = np.zeros((), HEADER)
            head["magic"], head["part"], head["chunk"], head["docs"], head["width"], head["dictionary"] = MAGIC, part, chunk, len(index), width, digest.encode()
            head["tokens"], head["index"] = sum(x[4] for x in index), HEADER.itemsize + size
            data = b"".join([head.tobytes(), *frames, np.array(index, INDEX).tobytes()])
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["file"])

        for batch in batches:
            for doc_id, tokens, frame in zip(batch.column("doc_id").to_pylist(), batch.column("tokens").to_pylist(), batch.column("frame")):
                frame = frame.as_py()
                index.append((doc_id or 0, doc_id is None, HEADER.itemsize + size, len(frame), tokens))
                frames.append(frame)
                size += len(frame)
                if size >= CHUNK_BYTES:
                    yield file()
                    frames, index, size, chunk = [], [], 0, chunk + 1
        if index:
            yield file()

    hashed = docs.select("doc_id", F.xxhash64("text").alias("hash"), "text")
    rows = durable(hashed.mapInArrow(encode, "doc_id bigint, hash bigint, tokens bigint, frame binary"))
    # the place in the stored table, so that equal rows need not go to one task
    rows = rows.withColumn("at", F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index")))
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash"), F.col("at")]
    placed = rows.repartitionByRange(partitions_for(docs), *order).sortWithinPartitions(*order)
    write_files(placed.select("doc_id", "tokens", "frame").mapInArrow(pack, "file binary"), f"{path}/ids")
    _write_list(spark, path)
    return digest


def _write_list(spark: SparkSession, path: str) -> None:
    """Store the table of files: path, smallest and largest id, whether a null id is in it, tokens of all files before it."""

    def look(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                head, index = _open(memoryview(content.as_buffer()))
                ids = index["doc_id"][~index["null_id"]]
                yield pa.RecordBatch.from_pylist(
                    [{
                        "path": name, "part": int(head["part"]), "chunk": int(head["chunk"]), "tokens": int(head["tokens"]), "nulls": bool(index["null_id"].any()),
                        "least": int(ids.min()) if len(ids) else None, "most": int(ids.max()) if len(ids) else None,
                    }],
                    kinds,
                )

    kinds = pa.schema([("path", pa.string()), ("part", pa.int32()), ("chunk", pa.int32()), ("tokens", pa.int64()), ("nulls", pa.bool_()), ("least", pa.int64()), ("most", pa.int64())])
    found = read_files(spark, f"{path}/ids").mapInArrow(look, "path string, part int, chunk int, tokens bigint, nulls boolean, least bigint, most bigint")
    listed = durable(found)
    # one sum per range partition goes to the driver; within one, files add up in their order
    sums = {r["part"]: r["n"] for r in listed.groupBy("part").agg(F.sum("tokens").alias("n")).collect()}
    starts = dict(zip(sorted(sums), accumulate([0, *(sums[p] for p in sorted(sums))])))
    table = spark.createDataFrame(list(starts.items())[: len(sums)], "part int, start bigint")
    within = F.sum("tokens").over(W.partitionBy("part").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1))
    before = F.col("start") + F.coalesce(within, F.lit(0))
    listed.join(table, "part").select("path", "least", "most", "nulls", before.alias("before")).write.parquet(f"{path}/files")


def _open(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    head = np.frombuffer(content, HEADER, 1)[0]
    if head["magic"] != MAGIC:
        raise ValueError("not a token-id file")
    return head, np.frombuffer(content, INDEX, int(head["docs"]), int(head["index"]))


def _dictionary(spark: SparkSession, path: str) -> bytes:
    """The stored dictionary (at most DICTIONARY_BYTES)."""
    row = read_files(spark, f"{path}/dictionary").first()
    return bytes(row["content"])[:-1] if row else b""


def _frames(batches, dictionary: bytes, wanted: set[int] | None = None):
    unpacker = zstandard.ZstdDecompressor(**_compression(dictionary))
    digest = hashlib.sha256(dictionary).hexdigest().encode()
    for batch in batches:
        for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            view = memoryview(content.as_buffer())
            head, index = _open(view)
            if head["dictionary"] != digest:
                raise ValueError("the file was written with another dictionary")
            starts = np.cumsum(index["tokens"]) - index["tokens"]
            for start, row in zip(starts.tolist(), index.tolist()):
                if wanted is None or (not row[1] and row[0] in wanted):
                    raw = unpacker.decompress(view[row[2] : row[2] + row[3]], max_output_size=row[4] * int(head["width"]))
                    yield name, row, start, np.frombuffer(raw, f"<u{head['width']}")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    dictionary = _dictionary(spark, path)
    names = ["path", "doc_id", "offset", "n_tokens", "ids_crc32"]
    kinds = pa.schema([("path", pa.string()), *((n, pa.int64()) for n in names[1:])])

    def parse(batches):
        rows: list[tuple] = []
        for name, row, start, ids in _frames(batches, dictionary):
            rows.append((name, None if row[1] else row[0], start, row[4], zlib.crc32(ids.astype("<u4").tobytes())))
            if len(rows) == 10_000:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], kinds)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], kinds)

    rows = read_files(spark, f"{path}/ids").mapInArrow(parse, "path string, doc_id bigint, offset bigint, n_tokens bigint, ids_crc32 bigint")
    files = spark.read.parquet(f"{path}/files").select("path", "before")
    return rows.join(files, "path").select("doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def fetch(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of a short list of documents: only files that can hold them are read, only their frames decompressed."""
    dictionary, wanted = _dictionary(spark, path), set(doc_ids)

    def parse(batches):
        for _, row, _, ids in _frames(batches, dictionary, wanted):
            yield pa.RecordBatch.from_arrays([pa.array([row[0]]), pa.array([ids.tolist()], pa.list_(pa.int64()))], ["doc_id", "ids"])

    files = files_with(spark, path, doc_ids)
    content = read_files(spark, files) if files else spark.createDataFrame([], "path string, content binary")
    return content.mapInArrow(parse, "doc_id bigint, ids array<bigint>")


def files_with(spark: SparkSession, path: str, doc_ids: list[int]) -> list[str]:
    """The files whose range of ids holds one of a short list of ids."""
    held = F.lit(False)
    for i in sorted(set(doc_ids)):
        held = held | F.lit(i).between(F.col("least"), F.col("most"))
    return [r["path"] for r in spark.read.parquet(f"{path}/files").filter(held).select("path").collect()]


def tokenized(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Write the documents and read the files back. The tokenizer's path is the installed word-level vocabulary by default."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = str(public_tokenizers.path("word_bpe_49k.json"))
    path = new_folder(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return read_tokens(docs.sparkSession, path)


def op3_token_ids(spark, sf_dir: str) -> DataFrame:
    return tokenized(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op3_token_ids": op3_token_ids}
ORACLE_SQL: dict[str, str] = {}

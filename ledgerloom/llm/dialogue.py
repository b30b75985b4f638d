"""Repair of conversations: the cheapest edits that give an optional system row and then user and assistant in turn.

Rows of a conversation are taken by turn (null first); rows of one turn by role, then by the SHA-256 of their text. Each row
has at most one fault: blank (nothing but white space), duplicate (its role and text occur earlier) or truncated (its last
visible character does not end a sentence). An edit keeps a row (K, 0), gives it the role user or assistant (R, 2), deletes
it (D, 3; blank and duplicate rows must go) or inserts an empty row of either role (I, 2); truncated rows that stay cost 1.
The initials of the roles that are left must read ``(s?(ua)+)?``. Of the cheapest series of edits the ASCII-least is taken.

The method is a dynamic program with square-root checkpoints. The state is the last role (start, s, u, a); a row is a
min-plus matrix over the states. With N rows in all, rows are numbered in Spark and cut into blocks of about sqrt(N):

1. Every block multiplies its rows' matrices into one 4 x 4 matrix; no row's cost vector is stored.
2. Going backward over the blocks of a conversation (at most about sqrt(N)) gives the checkpoints: the cost vector at the
   end of every block.
3. Every block recomputes the vectors of its own rows from its checkpoint and walks forward along tight edits, once for
   each state in which the walk may enter. Blocks do not wait for each other, so one huge conversation is many tasks.
4. A stream over the blocks and rows of a conversation in order picks the walk of the state it has reached and hashes or
   returns the repaired rows. SHA-256 is sequential, so that a conversation's texts pass one task; as a stream, of which one
   block's edits and one batch of rows are in memory.

Null roles and texts are one space, null ids are one conversation. Conversations of a damaged table that lost all their
rows have zeros, an empty audit and the hash of the empty text. An empty table gives an empty result. Other columns, whatever
their names, are not read."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType

from ledgerloom.llm.sqltext import CRC_TABLE_SQL, crc32_sql
from ledgerloom.llm.store import durable, partitions_for
from ledgerloom.operators.numbering import global_row_number

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
LEAST_BLOCK = 64
WHITE = " \t\n\x0b\x0c\r"
_NONE = 1 << 40

# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. A user row may follow all but user, an assistant
# row only user; so each state has one role that an inserted or renamed row can have.
_NEXT = (2, 2, 3, 2)
_MAY_KEEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "x": {}}
_END = (0, 2 * INSERT, INSERT, 0)
_ROLES = {2: "user", 3: "assistant"}
#: One letter for the rows inserted in front of a row.
_INSERTED = {".": (), "u": (2,), "a": (3,), "b": (2, 3)}


def _step(role: str, fault: str) -> list[list[int]]:
    """Costs of one row from state to state: rows inserted in front of it, then its own edit."""
    edit = [[_NONE] * 4 for _ in range(4)]
    for s in range(4):
        edit[s][s] = DELETE
        if fault not in "bd":
            extra = TRUNCATED * (fault == "t")
            edit[s][_NEXT[s]] = min(edit[s][_NEXT[s]], REROLE + extra)
            if s in _MAY_KEEP[role]:
                kept = _MAY_KEEP[role][s]
                edit[s][kept] = min(edit[s][kept], KEEP + extra)
    once = [[min(edit[s][e], INSERT + edit[_NEXT[s]][e]) for e in range(4)] for s in range(4)]
    return [[min(edit[s][e], INSERT + once[_NEXT[s]][e]) for e in range(4)] for s in range(4)]


_STEPS = {r + f: _step(r, f) for r in "suax" for f in "-bdt"}


def _before(step: list[list[int]], after) -> tuple[int, ...]:
    """Cost vector in front of a row, from the one behind it."""
    a, b, c, d = after
    return tuple(min(row[0] + a, row[1] + b, row[2] + c, row[3] + d) for row in step)


def block_matrix(roles: str, faults: str) -> list[int]:
    """Least cost from each state in front of a block to each state behind it, row by row."""
    columns = [[0 if e == s else _NONE for s in range(4)] for e in range(4)]
    for key in map("".join, zip(reversed(roles), reversed(faults))):
        columns = [_before(_STEPS[key], c) for c in columns]
    return [min(columns[e][s], _NONE) for s in range(4) for e in range(4)]


def checkpoints(matrices: list[list[int]]) -> tuple[list[tuple[int, ...]], int]:
    """The cost vector behind each block, and the cost of the whole conversation."""
    vector, out = tuple(_END), []
    for m in reversed(matrices):
        out.append(vector)
        vector = _before([m[4 * s : 4 * s + 4] for s in range(4)], vector)
    return out[::-1], vector[0]


def walks(roles: str, faults: str, behind, last: bool, states: range) -> list[tuple[int, str, str, str]]:
    """For each state in which a block may be entered: the state behind it, the edits, and per row one letter for the rows
    in front of it and one for itself (k kept, u or a with that role, - deleted)."""
    vectors = [tuple(behind)]
    for key in map("".join, zip(reversed(roles), reversed(faults))):
        vectors.append(_before(_STEPS[key], vectors[-1]))
    vectors.reverse()
    out = []
    for s in states:
        audit, front, fate = [], [], []
        for i, (role, fault) in enumerate(zip(roles, faults)):
            added = ""
            while True:
                here, after, extra = vectors[i], vectors[i + 1], TRUNCATED * (fault == "t")
                if DELETE + after[s] == here[s]:
                    audit.append("D")
                    fate.append("-")
                elif INSERT + here[_NEXT[s]] == here[s]:
                    audit.append("I")
                    s = _NEXT[s]
                    added += _ROLES[s][0]
                    continue
                elif fault not in "bd" and s in _MAY_KEEP[role] and KEEP + extra + after[_MAY_KEEP[role][s]] == here[s]:
                    audit.append("K")
                    fate.append("k")
                    s = _MAY_KEEP[role][s]
                else:
                    audit.append("R")
                    s = _NEXT[s]
                    fate.append(_ROLES[s][0])
                break
            front.append({"": ".", "ua": "b"}.get(added, added))
        tail = ""
        while last and s in (1, 2):
            audit.append("I")
            s = _NEXT[s]
            tail += _ROLES[s][0]
        out.append((s, "".join(audit), "".join(front) + {"": ".", "ua": "b"}.get(tail, tail), "".join(fate)))
    return out


# --- the same in Spark ----------------------------------------------------------------------


def _key(conv_id: Column) -> Column:
    """A conversation as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def numbered(rows: DataFrame) -> DataFrame:
    """(c, turn, role, text, r, blank, whole, digest, n): stored, numbered by conversation and order in it."""
    role, text = (F.coalesce(F.col(x), F.lit(" ")) for x in ("role", "text"))
    seen = F.rtrim(F.col("text"), F.lit(WHITE))
    first = F.substring("role", 1, 1)
    plain = rows.select(_key(F.col("conv_id")).alias("c"), F.col("turn"), role.alias("role"), text.alias("text"))
    plain = plain.withColumns(
        {
            "r": F.when(first.isin("s", "u", "a"), first).otherwise(F.lit("x")),
            "blank": seen == "",
            "whole": F.right(seen, F.lit(1)).isin(".", "!", "?"),
            "digest": F.sha2(F.col("text").cast("binary"), 256),
            "salt": F.monotonically_increasing_id(),  # deals equal rows over tasks; their order changes nothing
        }
    )
    return global_row_number(plain, ["c", F.col("turn").asc_nulls_first(), "role", "digest", "salt"], out="n", start=0).drop("salt")


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """(c, block, n, roles, faults) of numbered rows: at most ``size`` of them, one letter each."""
    firsts = rows.groupBy("c", "role", "digest").agg(F.min("n").alias("n")).select("n", F.lit(True).alias("new"))
    fault = F.when(F.col("blank"), "b").when(F.col("new").isNull(), "d").when(~F.col("whole"), "t").otherwise("-")
    marked = rows.select("c", "n", "r", "blank", "whole").join(firsts, "n", "left").select("c", "n", F.col("r"), fault.alias("f"))
    letters = F.array_sort(F.collect_list(F.struct("n", "r", "f")))
    grouped = marked.groupBy("c", F.floor(F.col("n") / F.lit(size)).alias("block")).agg(letters.alias("l"))
    joined = lambda name: F.array_join(F.transform("l", lambda x: x[name]), "")
    return durable(grouped.select("c", "block", F.col("l")[0]["n"].alias("n"), joined("r").alias("roles"), joined("f").alias("faults")))


def _mapped(df: DataFrame, fn: Callable[[dict], Iterator[dict]], schema: str) -> DataFrame:
    """Rows to rows in Python, batch by batch."""
    kinds = to_arrow_schema(DataType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = [o for row in batch.slice(at, 256).to_pylist() for o in fn(row)]
                if out:
                    yield pa.RecordBatch.from_pylist(out, kinds)

    return df.mapInArrow(run, schema)


def walked(pieces: DataFrame) -> DataFrame:
    """(c, n, cost, roles, faults, walks) of blocks: steps 1 to 3."""
    matrices = _mapped(
        pieces.select("c", "block", "roles", "faults"),
        lambda x: iter([{"c": x["c"], "block": x["block"], "matrix": block_matrix(x["roles"], x["faults"])}]),
        "c string, block bigint, matrix array<bigint>",
    )
    # about sqrt(N) small matrices for the largest conversation
    chains = matrices.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("block", "matrix"))).alias("chain"))

    def back(x: dict) -> Iterator[dict]:
        vectors, cost = checkpoints([b["matrix"] for b in x["chain"]])
        for i, (b, v) in enumerate(zip(x["chain"], vectors)):
            yield {"c": x["c"], "block": b["block"], "behind": list(v), "first": i == 0, "last": i == len(vectors) - 1, "cost": cost if i == 0 else 0}

    marks = _mapped(chains, back, "c string, block bigint, behind array<bigint>, first boolean, last boolean, cost bigint")

    def forward(x: dict) -> Iterator[dict]:
        found = walks(x["roles"], x["faults"], x["behind"], x["last"], range(1 if x["first"] else 4))
        ways = [dict(zip(("state", "audit", "front", "fate"), w)) for w in found]
        yield {**{k: x[k] for k in ("c", "n", "cost", "roles", "faults")}, "walks": ways}

    return _mapped(
        pieces.join(marks, ["c", "block"]), forward,
        "c string, n bigint, cost bigint, roles string, faults string, walks array<struct<state: int, audit: string, front: string, fate: string>>",
    )


class _Conversation:
    """What a stream knows of the conversation it is in."""

    def __init__(self, c: str):
        self.c, self.state, self.cost, self.previous, self.audit = c, 0, 0, "", []
        self.count, self.illegal = dict.fromkeys("bdt", 0), 0
        self.at, self.front, self.fate = 0, ".", ""

    def enter(self, n: int, block: dict) -> None:
        way = block["walks"][self.state]
        self.state, self.at, self.front, self.fate = way["state"], n, way["front"], way["fate"]
        self.audit.append(way["audit"])
        self.cost += block["cost"]
        roles = self.previous + block["roles"]
        self.illegal += sum(pair not in ("su", "ua", "au") for pair in map("".join, zip(roles, roles[1:])))
        self.previous = roles[-1]
        for f in self.count:
            self.count[f] += block["faults"].count(f)

    def lines(self, n: int, role: str, text: str) -> Iterator[tuple[str, str]]:
        """Repaired rows for row n, with those in front of it, and those behind if it ends its block."""
        i = n - self.at
        yield from ((_ROLES[s], "") for s in _INSERTED[self.front[i]])
        if self.fate[i] != "-":
            yield (role if self.fate[i] == "k" else {"u": "user", "a": "assistant"}[self.fate[i]], text)
        if i + 1 == len(self.fate):
            yield from ((_ROLES[s], "") for s in _INSERTED[self.front[i + 1]])


def _streamed(rows: DataFrame, edits: DataFrame, make: Callable, schema: str) -> DataFrame:
    """Step 4: ``make()`` gives an object with ``line(conversation, role, text)`` and ``end(conversation)``, which return rows."""
    names = ["c", "n", "role", "text", "block"]
    info = F.struct("cost", "roles", "faults", "walks").alias("block")
    heads = edits.select("c", "n", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), info)
    body = rows.select("c", "n", "role", "text", F.lit(None).cast(heads.schema["block"].dataType).alias("block"))
    order = F.when(F.col("block").isNull(), 1).otherwise(0)
    both = heads.unionByName(body).repartition(partitions_for(rows), "c").sortWithinPartitions("c", "n", order)

    kinds = to_arrow_schema(DataType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, to = None, make()
        for batch in batches:
            out: list[dict] = []
            for c, n, role, text, block in zip(*(batch.column(x).to_pylist() for x in names)):
                if now is None or now.c != c:
                    if now is not None:
                        out += to.end(now)
                    now = _Conversation(c)
                if block is not None:
                    now.enter(n, block)
                    continue
                for line in now.lines(n, role, text):
                    out += to.line(now, *line)
            if out:
                yield pa.RecordBatch.from_pylist(out, kinds)
        if now is not None and (out := to.end(now)):
            yield pa.RecordBatch.from_pylist(out, kinds)

    return both.mapInArrow(run, schema)


class _Hashed:
    def __init__(self):
        self.sha, self.any = hashlib.sha256(), False

    def line(self, now: _Conversation, role: str, text: str) -> list[dict]:
        self.sha.update(("\n" * self.any + role + ":" + text).encode())
        self.any = True
        return []

    def end(self, now: _Conversation) -> list[dict]:
        digest = self.sha.hexdigest()
        self.__init__()
        counts = {"blank": now.count["b"], "duplicate": now.count["d"], "truncated": now.count["t"], "illegal": now.illegal}
        return [{"c": now.c, **counts, "cost": now.cost, "audit": "".join(now.audit), "repaired_sha256": digest}]


class _Rows:
    def __init__(self):
        self.place = 0

    def line(self, now: _Conversation, role: str, text: str) -> list[dict]:
        self.place += 1
        return [{"c": now.c, "place": self.place, "role": role, "text": text}]

    def end(self, now: _Conversation) -> list[dict]:
        self.place = 0
        return []


def _edits(rows: DataFrame, size: int | None) -> DataFrame:
    return walked(blocks(rows, size or max(LEAST_BLOCK, math.isqrt(rows.count()) + 1)))


def repaired(conversations: DataFrame, size: int | None = None) -> DataFrame:
    """The repaired rows (conv_id, place from 1, role, text) of a table (conv_id, turn, role, text). ``size`` sets the rows
    of a block, else about the square root of all."""
    rows = numbered(conversations)
    out = _streamed(rows, _edits(rows, size), _Rows, "c string, place bigint, role string, text string")
    kind = conversations.schema["conv_id"].dataType
    return out.select(F.when(F.col("c") != "", F.expr("substring(c, 2)")).cast(kind).alias("conv_id"), "place", "role", "text")


def audited(conversations: DataFrame, all_ids: DataFrame, size: int | None = None) -> DataFrame:
    """One row per id of ``all_ids``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    rows = numbered(conversations)
    sums = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
    found = _streamed(rows, _edits(rows, size), _Hashed, f"c string, {sums}")
    turns = rows.groupBy("c", "turn").agg(F.lit(1).alias("one")).groupBy("c").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint").alias("gaps")
    )
    ids = all_ids.select("conv_id").distinct().withColumn("c", _key(F.col("conv_id")))
    zeros = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
    empty = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return ids.join(turns, "c", "left").join(found, "c", "left").fillna(zeros | empty).drop("c")


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after damage by a checksum of id and turn: of 20 rows about one is dropped, one emptied,
    one loses its sentence ends, one is there twice and one is the user's."""
    text_of = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    role = F.when(F.col("k") == 4, "user").otherwise(F.coalesce(F.col("role"), F.lit(" ")))
    text = F.coalesce(F.col("text"), F.lit(" "))
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = conversations.select("conv_id", "turn", "role", "text", kind.alias("k")).filter("k <> 0")
    copies = F.explode(F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies).drop("copy")


def op11_conversations(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return audited(damaged(rows), rows)


#: The plain program going forward: per state the least (cost, edits, rows), over rows in order.
DIALOGUE_SQL = rf"""
WITH RECURSIVE {CRC_TABLE_SQL},
plain AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce('=' || conv_id::VARCHAR, '') AS c,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS body FROM conversations
), kinds AS (SELECT *, {crc32_sql('body')} % 20 AS k FROM plain, crc_table),
after AS (
  SELECT c, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE k WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE k <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST, copy) AS nth, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen FROM after
), faulty AS (
  SELECT c, i, turn, role, text, left(role, 1) AS r,
         CASE WHEN seen = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS f,
         lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS before
  FROM placed
), ins(s, e, cost, audit, out) AS (
  VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''), (0, 2, 2, 'I', chr(10) || 'user:'), (1, 2, 2, 'I', chr(10) || 'user:'),
         (3, 2, 2, 'I', chr(10) || 'user:'), (2, 3, 2, 'I', chr(10) || 'assistant:'), (0, 3, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
         (1, 3, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')
), edit(s, e, letter, need, role, cost) AS (
  SELECT s, s, 'D', NULL::VARCHAR, NULL::VARCHAR, 3 FROM range(4) t(s)
  UNION ALL SELECT s, CASE WHEN s = 2 THEN 3 ELSE 2 END, 'R', NULL, CASE WHEN s = 2 THEN 'assistant' ELSE 'user' END, 2 FROM range(4) t(s)
  UNION ALL SELECT * FROM (VALUES (0, 1, 'K', 's', NULL, 0), (0, 2, 'K', 'u', NULL, 0), (1, 2, 'K', 'u', NULL, 0), (3, 2, 'K', 'u', NULL, 0), (2, 3, 'K', 'a', NULL, 0)) v
), walk AS (
  SELECT c, 0::BIGINT AS i, 0 AS s, {{'cost': 0, 'audit': '', 'out': ''}} AS best FROM (SELECT DISTINCT c FROM faulty)
  UNION ALL
  SELECT w.c, w.i + 1, edit.e::INTEGER,
         min({{'cost': (w.best.cost + ins.cost + edit.cost + CASE WHEN f.f = 't' AND edit.letter <> 'D' THEN 1 ELSE 0 END)::INTEGER, 'audit': w.best.audit || ins.audit || edit.letter,
               'out': w.best.out || ins.out || CASE edit.letter WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text ELSE chr(10) || edit.role || ':' || f.text END}})
  FROM walk w JOIN faulty f ON f.c = w.c AND f.i = w.i + 1 JOIN ins ON ins.s = w.s JOIN edit ON edit.s = ins.e
  WHERE (edit.letter = 'D' OR f.f IN ('-', 't')) AND (edit.need IS NULL OR edit.need = f.r)
  GROUP BY w.c, w.i, edit.e
), ends AS (
  SELECT w.c, min({{'cost': w.best.cost + ins.cost, 'audit': w.best.audit || ins.audit, 'out': w.best.out || ins.out}}) AS best
  FROM walk w JOIN ins ON ins.s = w.s AND ins.e IN (0, 3) JOIN (SELECT c, max(i) AS i FROM faulty GROUP BY c) m ON m.c = w.c AND m.i = w.i GROUP BY w.c
), sums AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 'b') AS blank, count(*) FILTER (f = 'd') AS duplicate,
         count(*) FILTER (f = 't') AS truncated, count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY c
)
SELECT p.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(substr(best.out, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, c FROM plain) p LEFT JOIN sums USING (c) LEFT JOIN ends USING (c)
"""

QUERIES = {"op11_conversations": op11_conversations}
ORACLE_SQL = {"op11_conversations": DIALOGUE_SQL}

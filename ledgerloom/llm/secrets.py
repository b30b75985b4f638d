"""Secrets in texts, and multipart credentials: weak candidates count only beside their complementary parts.

Each kind of part has a pattern, matched leftmost and without overlaps in every whole text. Strong kinds are reported as
they are: assignments with a value of 8 or more characters, access identifiers and hex strings. Weak ones are candidates:

    login     a name assigned to a user, login, account or client id    needs a secret near it
    short     an assignment with a value of 4 to 7 characters           needs an identifier (access or login) near it
    key40     a bare run of exactly 40 key characters                   needs an identifier near it
    endpoint  an address with a scheme                                  needs an identifier and a secret near it

A secret is an assignment of either length or a key40. Near is: in one scope (texts are divided at empty lines, where the
scope of a part is that of its start), with at most REACH code points between the end of the one and the start of the other,
however long they are. The parts of all texts are joined on text, scope and stretch of REACH code points: a candidate is in
all stretches that it covers, its partner in all that it covers or that lie within REACH of it. So a text with very many
parts is spread over its stretches; the joins are semi-joins and give no pairs.

Positions are code points. A null or empty text has no part. Rows with one id and text have the same parts and are each
returned. An empty table gives an empty result. Other columns are not read. Everything is Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerloom.llm.store import durable

REACH, STRONG, WEAK = 300, 8, 4
KINDS = ("assign", "access", "hex", "login", "short", "key40", "endpoint")
ASSIGN, ACCESS, HEX, LOGIN, SHORT, KEY40, ENDPOINT = range(7)
_BREAK = 7
_VALUE = r"""["']?\x20*[:=]\x20*["']?"""
#: (kind, pattern, group whose length counts); the first three are fixed by the contract.
PATTERNS = (
    (ASSIGN, rf"(?i:password|passwd|secret|token|api_?key){_VALUE}([A-Za-z0-9+/_.=-]+)", 1),
    (ACCESS, r"AKIA[A-Z0-9]{12,}", 0),
    (HEX, r"[0-9a-f]{32,}", 0),
    (LOGIN, rf"(?i:user_?name|user|login|account|client_?id){_VALUE}([A-Za-z0-9_.@-]{{3,}})", 1),
    (KEY40, r"(?<![A-Za-z0-9/+=])[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+=])", 0),
    (ENDPOINT, r"(?:https?|ftp|postgres|postgresql|mysql|redis|amqp|mongodb|s3)://[^\s\"'<>]+", 0),
)


def _matches(text: Column, kind: int, pattern: str, group: int) -> Column:
    """(kind, nth, gap, size, value) of the pattern's matches: the code points between the match before and this one, and
    the lengths of match and value. The pieces between matches come from splitting at the same pattern."""
    found = F.arrays_zip(
        F.split(text, pattern, -1).alias("piece"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value")
    )
    rows = F.transform(
        F.filter(found, lambda x: x["whole"].isNotNull()),
        lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("nth"), F.length(x["piece"]).alias("gap"), F.length(x["whole"]).alias("size"), F.length(x["value"]).alias("value")),
    )
    return F.when(text.rlike(pattern), rows).otherwise(F.array().cast("array<struct<kind:int,nth:int,gap:int,size:int,value:int>>"))


def parts_of(docs: DataFrame) -> DataFrame:
    """(doc_id, key, parts) of every document, stored; texts are read once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.xxhash64(text).cast("string"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), key.alias("key"), text.alias("text"), F.concat(*[_matches(text, *p) for p in PATTERNS]).alias("parts"))
    # only a text with parts is divided into scopes
    return durable(rows.select("doc_id", "key", F.when(F.size("parts") > 0, F.concat("parts", _matches(F.col("text"), _BREAK, r"\n\s*\n", 0))).otherwise(F.col("parts")).alias("parts")))


def placed(rows: DataFrame) -> DataFrame:
    """(key, kind, start, end, scope) of all parts; short assignments have their own kind."""
    once = rows.filter(F.size("parts") > 0).dropDuplicates(["key"])
    part = once.select("key", F.explode("parts").alias("p")).select("key", "p.*")
    end = F.sum(F.col("gap") + F.col("size")).over(W.partitionBy("key", "kind").orderBy("nth"))
    part = part.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    # an empty line ends a scope; one window per text, over its parts
    scope = F.sum(F.when(F.col("kind") == _BREAK, 1).otherwise(0)).over(W.partitionBy("key").orderBy("start", "kind").rowsBetween(W.unboundedPreceding, 0))
    kind = F.when((F.col("kind") == ASSIGN) & (F.col("value") < STRONG), F.lit(SHORT)).otherwise(F.col("kind"))
    out = part.withColumn("scope", scope).filter((F.col("kind") != _BREAK) & ((F.col("kind") != ASSIGN) | (F.col("value") >= WEAK)))
    return durable(out.select("key", kind.alias("kind"), "start", "end", "scope"))


def linked(parts: DataFrame) -> DataFrame:
    """The weak parts that have their complementary parts near them."""

    def near(weak: DataFrame, partners: DataFrame) -> DataFrame:
        def stretches(by: int) -> Column:
            return F.explode(F.sequence(F.floor((F.col("start") - by) / REACH), F.floor((F.col("end") + by) / REACH)))

        one = weak.withColumn("stretch", stretches(0))
        two = partners.select(F.col("key").alias("k"), F.col("scope").alias("s"), F.col("start").alias("from"), F.col("end").alias("to"), stretches(REACH).alias("t"))
        same = (F.col("key") == F.col("k")) & (F.col("scope") == F.col("s")) & (F.col("stretch") == F.col("t"))
        close = (F.col("start") - F.col("to") <= REACH) & (F.col("from") - F.col("end") <= REACH)
        return one.join(two, same & close, "left_semi").drop("stretch").distinct()

    identifiers, secrets = parts.filter(F.col("kind").isin(ACCESS, LOGIN)), parts.filter(F.col("kind").isin(ASSIGN, SHORT, KEY40))
    by_identifier = near(parts.filter(F.col("kind").isin(SHORT, KEY40, ENDPOINT)), identifiers)
    by_both = near(by_identifier.filter(F.col("kind") == ENDPOINT), secrets)
    by_secret = near(parts.filter(F.col("kind") == LOGIN), secrets)
    return by_identifier.filter(F.col("kind") != ENDPOINT).unionByName(by_both).unionByName(by_secret)


def _digest(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_spans, spans) of every row of ``docs`` (doc_id, text)."""
    rows = parts_of(docs)
    parts = placed(rows)
    base = parts.filter(F.col("kind") <= HEX)
    span = F.struct("start", "kind", "end")
    is_base = F.col("kind") <= HEX
    found = base.unionByName(linked(parts)).groupBy("key").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{KINDS[k]}") for k in (ASSIGN, ACCESS, HEX)],
        _digest(F.collect_list(F.when(is_base, span))).alias("base_spans"), _digest(F.collect_list(span)).alias("spans"),
    )
    zero, none = F.lit(0).cast("bigint"), F.lit("")
    columns = ["doc_id", *(F.coalesce(c, d).alias(c) for c, d in (("n_assign", zero), ("n_access", zero), ("n_hex", zero), ("base_spans", none), ("spans", none)))]
    # most texts have no part and need no join
    with_parts = rows.filter(F.size("parts") > 0).select("doc_id", "key").join(found, "key", "left").select(*columns)
    without = rows.filter(F.size("parts") == 0).select("doc_id", zero.alias("n_assign"), zero.alias("n_access"), zero.alias("n_hex"), none.alias("base_spans"), none.alias("spans"))
    return with_parts.unionByName(without)


def op9_secrets(spark, sf_dir: str) -> DataFrame:
    found = secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base_spans"), 256).alias("base_sha256"), "spans")


QUERIES = {"op9_secrets": op9_secrets}
ORACLE_SQL: dict[str, str] = {}

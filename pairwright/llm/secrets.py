"""Secret scans with a ledger of content-addressed blobs.

Every text, old version or new, is addressed by the SHA-256 of its bytes. A ledger records which (blob, rule version)
pairs were scanned and what was found; a run reads the texts of unseen pairs only, once for each blob, appends to the
ledger and joins the findings back to every path that holds the blob.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairwright.llm.common import cut, plain


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A new version makes every blob unseen for this rule. `hint`: one of these must be in the lower-cased text."""

    kind: str
    version: int
    pattern: str
    flags: int = 0
    group: int = 0
    least: int = 0
    hint: tuple[str, ...] = ()


#: The kinds of the contract, in its order.
BASE_RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 6,
         ("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 0, 20, ("akia",)),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 0, 24),
)
#: What this library adds: web tokens and headers of private keys.
MORE_RULES = (
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}", 0, 0, 0, ("eyj",)),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0, 0, ("private key-----",)),
)
RULES = BASE_RULES + MORE_RULES

LEDGER = "blob_id binary, kind string, version int, spans array<struct<start:long,end:long>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_FOUND = pa.schema([("blob_id", pa.binary()), ("kind", pa.string()), ("version", pa.int32()), ("spans", _SPANS)])


def spans_of(rule: Rule, text: str, lower: str) -> list[dict[str, int]]:
    """Leftmost non-overlapping matches, in code points, end exclusive; those with too short a value go."""
    if rule.hint and not any(h in lower for h in rule.hint):
        return []
    return [
        {"start": m.start(), "end": m.end()}
        for m in re.finditer(rule.pattern, text, rule.flags)
        if len(m.group(rule.group)) >= rule.least
    ]


def _scan(rules: tuple[Rule, ...]):
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256).to_pylist()
                out = []
                for row in rows:
                    lower = row["text"].lower()
                    for k in row["todo"]:
                        rule = rules[k]
                        out.append((row["blob_id"], rule.kind, rule.version, spans_of(rule, row["text"], lower)))
                yield pa.RecordBatch.from_pylist([dict(zip(_FOUND.names, x, strict=True)) for x in out], schema=_FOUND)

    return scan


def addressed(docs: DataFrame, path: str = "doc_id", text: str = "text") -> DataFrame:
    """(path, blob_id, text); a null text is the empty blob."""
    body = F.coalesce(plain(text), F.lit(""))
    return docs.select(plain(path).alias("path"), F.unhex(F.sha2(body, 256)).alias("blob_id"), body.alias("text"))


def read_ledger(spark: SparkSession, folder: str | None) -> DataFrame:
    """The ledger in a folder; empty where there is no folder. The folder must hold a ledger once it is named."""
    return spark.read.schema(LEDGER).parquet(folder) if folder else spark.createDataFrame([], LEDGER)


def scan_unseen(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, path: str = "doc_id",
                text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(paths with their blob, what the unseen pairs of blob and rule version gave). Append the second to the ledger.

    Of the rows that hold a blob, the one with the smallest path is read. Texts pass one shuffle, by (blob, path), so
    that copies of one text spread; the counting of blobs is narrow and combined before its shuffle.
    """
    whole = addressed(docs, path, text)
    paths = cut(whole.select("path", "blob_id"))
    blobs = paths.groupBy("blob_id").agg(F.min("path").alias("path"))
    pairs = blobs.select(
        "blob_id", "path",
        F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"))
                            for k, r in enumerate(rules)])).alias("r"),
    ).select("blob_id", "path", "r.*")
    unseen = pairs.join(ledger.select("blob_id", "kind", "version"), ["blob_id", "kind", "version"], "left_anti")
    todo = unseen.groupBy("blob_id", "path").agg(F.sort_array(F.collect_list("rule")).alias("todo"))
    picked = whole.alias("w").join(
        todo.alias("t"), (F.col("w.blob_id") == F.col("t.blob_id")) & F.col("w.path").eqNullSafe(F.col("t.path"))
    ).select("w.blob_id", "w.text", "t.todo")
    schema = "blob_id binary, kind string, version int, spans array<struct<start:bigint,end:bigint>>"
    found = picked.mapInArrow(_scan(rules), schema).dropDuplicates(["blob_id", "kind", "version"])
    return paths, cut(found)


def findings(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per path: all spans of its blob in order of start, then of the rules.

    Only the given versions of the rules count. A path without findings has an empty list. A blob that a third of the
    paths hold is one row on one side of a plain join, which may be split.
    """
    order = {r.kind: k for k, r in enumerate(rules)}
    wanted = F.lit(False)
    rank = F.lit(len(rules))
    for r in rules:
        wanted = wanted | ((F.col("kind") == r.kind) & (F.col("version") == r.version))
        rank = F.when(F.col("kind") == r.kind, F.lit(order[r.kind])).otherwise(rank)
    each = (
        ledger.where(wanted & (F.size("spans") > 0)).withColumn("rank", rank)
        .select("blob_id", F.transform("spans", lambda s: F.struct(
            s["start"].alias("start"), F.col("rank").alias("rank"), s["end"].alias("end"), F.col("kind").alias("kind"))).alias("spans"))
    )
    by_blob = each.groupBy("blob_id").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    return paths.join(by_blob, "blob_id", "left").select("path", "blob_id", F.coalesce("spans", empty).alias("spans"))


def _line(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Counts and lines of what `findings` gives."""
    kinds = [r.kind for r in base]
    of = lambda *names: F.filter("spans", lambda s: s["kind"].isin(*names))
    return found.select(
        F.col("path").alias("doc_id"),
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(_line(of(*kinds)), 256).alias("base_sha256"),
        _line(F.col("spans")).alias("spans"),
    )


def find_secrets(docs: DataFrame, ledger_folder: str | None = None, rules: tuple[Rule, ...] = RULES, path: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Secrets in every text.

    Null texts are empty, empty texts have no findings, and a very long text is scanned whole. Repeated rows and rows
    with equal texts each get a row; a null path is a path like any other. An empty table gives an empty table; further
    columns are ignored. With `ledger_folder`, an existing ledger there is extended and used; without, it starts empty.
    """
    spark = docs.sparkSession
    ledger = read_ledger(spark, ledger_folder)
    paths, new = scan_unseen(docs, ledger, rules, path, text)
    if ledger_folder:
        new.write.mode("append").parquet(ledger_folder)
        ledger = read_ledger(spark, ledger_folder)
    else:
        ledger = new
    return digest(findings(paths, ledger, rules))


def start_ledger(spark: SparkSession, folder: str) -> None:
    """An empty ledger in a new folder."""
    spark.createDataFrame([], LEDGER).write.parquet(folder)

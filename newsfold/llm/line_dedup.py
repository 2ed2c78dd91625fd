"""Line deduplication: lines that many documents share stay in one of them.

Texts are split at line feeds.  A line's key is the line without ASCII white space at both
ends and with A-Z lower-cased; keys of enough code points are hashed (MD5), each document names a
hash once, and the documents of each hash are counted after a map-side sum.  Hashes found in
enough documents lose all their lines except in the document with the largest id.  The hashes of each document's lines are
written once (about 45 bytes a line) and read by the count and by the join.  The positions that go are
joined back to the documents, and the other lines are put together again in their order.

Everything is DataFrame functions.  Lines travel as hashes, texts once.  A hash that holds a large share of all
lines would meet its table of dropped hashes in one task; such hashes, with at least
a ``HOT_SHARE`` of all (document, hash) pairs and so at most 1 / ``HOT_SHARE`` of them, are broadcast instead.

Every row is a document of its own; rows that repeat an id are counted each, and keep a line alike if their id
is the largest.  Null ids count as smaller than all others; where no document of a hash has an id, all keep it.
Null and empty texts are one empty line, which is too short to go.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import let
from .common import cut, text_of

MIN_LENGTH = 20
MIN_DOCUMENTS = 3
HOT_SHARE = 1 / 1000

WHITE = "\t\n\x0b\f\r "
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_hash(line: Column, min_length: int) -> Column:
    """MD5 of the line's key (no white space at its ends, A-Z lower-cased), null where the key is too short."""
    low = lambda bare: F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))
    hashed = lambda key: F.when(F.char_length(key) >= min_length, F.md5(key.cast("binary")))
    # each step is bound once; a key has no more code points than its line has bytes
    return F.when(F.octet_length(line) >= min_length, let(F.btrim(line, F.lit(WHITE)), lambda bare: let(low(bare), hashed)))


def drop_lines(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_documents: int = MIN_DOCUMENTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text for every row of docs."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).cast("string").alias("text"))
    rows = rows.withColumn("copy", F.unhex(F.md5(F.col("text").cast("binary"))))
    hashes = F.transform(F.split("text", "\n", -1), lambda line: line_hash(line, min_length))
    lines = cut(rows.select("doc_id", "copy", hashes.alias("hashes")))

    named = lines.select("doc_id", F.explode(F.array_distinct("hashes")).alias("hash")).filter("hash IS NOT NULL")
    counted = named.groupBy(F.unhex("hash").alias("hash")).agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
    shared = cut(counted.filter((F.col("n") >= min_documents) & F.col("keeper").isNotNull()))

    pairs = shared.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") >= F.lit(max(1.0, hot_share * pairs))
    placed = lines.select("doc_id", "copy", F.posexplode("hashes").alias("place", "hash")).filter("hash IS NOT NULL")
    placed = placed.select("doc_id", "copy", "place", F.unhex("hash").alias("hash"))
    keepers = lambda rows_: rows_.select("hash", "keeper")
    of_hot = placed.join(F.broadcast(keepers(shared.filter(hot)).withColumn("hot", F.lit(True))), "hash", "left")
    # hot lines are decided where they are; the rest meets its table by hash
    decided = of_hot.filter("hot").select("doc_id", "copy", "place", "keeper")
    rest = of_hot.filter("hot IS NULL").drop("keeper", "hot").join(keepers(shared.filter(~hot)), "hash")
    gone = decided.unionByName(rest.select("doc_id", "copy", "place", "keeper")).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    gone = gone.groupBy(F.col("doc_id").alias("its_id"), F.col("copy").alias("its_copy")).agg(F.collect_set("place").alias("places"))

    found = rows.join(gone.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("copy") == F.col("its_copy")), "left")
    kept = lambda all_lines: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("places")), lambda place: F.get(all_lines, place)
    )
    rebuilt = let(F.split("text", "\n", -1), lambda all_lines: F.array_join(kept(all_lines), "\n"))
    return found.select(
        "doc_id",
        F.regexp_count("text", F.lit("\n")).cast("long").alias("n_breaks"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("places").isNull(), F.col("text")).otherwise(rebuilt).alias("kept_text"),
    ).selectExpr("doc_id", "n_breaks + 1 AS n_lines", "n_dropped", "kept_text")


def dedup(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 (of the text that stays) for every row of docs."""
    kept = drop_lines(docs, **options)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT r, doc_id, line, i, md5(key) AS h, length(key) >= {MIN_LENGTH} AS long
  FROM (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{UPPER}', '{LOWER}') AS key
        FROM (SELECT r, doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM d))
), s AS (
  SELECT h, max(doc_id) AS keeper FROM l WHERE long GROUP BY h HAVING count(DISTINCT r) >= {MIN_DOCUMENTS} AND max(doc_id) IS NOT NULL
), kept AS (
  SELECT r, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS text
  FROM l LEFT JOIN s ON long AND l.h = s.h WHERE s.h IS NULL OR l.doc_id IS NOT DISTINCT FROM s.keeper GROUP BY r
)
SELECT d.doc_id, len(d.ls)::BIGINT AS n_lines, (len(d.ls) - coalesce(kept.n, 0))::BIGINT AS n_dropped,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

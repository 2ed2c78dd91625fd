"""Documents to packed training sequences in five stages, each one of the operators of newsfold.llm.

Every stage works on what its predecessor left; all but the last return the columns of documents.  Between stages the documents are
written as Parquet in the shared folder of the session and read again, so a lost executor costs at most a stage's own work.

Decisions come back to the texts by joins on doc_id, whose keys are unique where ids are; an id that repeats shares its decision
among its rows.  Rows without an id: the first two stages decide on them by their text, the third keeps them, the fourth
mixes them as one id, the fifth packs them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfold.llm import exact_dedup, langid, mixing, packing, simhash
from newsfold.session import ensure_checkpoint_dir
from newsfold.sources.tables import read_table

#: A text whose shortest code takes so many bits a byte more than its bytes as they are is in none of the learned languages.  Letters that
#: no training text has cost about 20 bits a byte, unknown words of known letters 9 to 14.  A rate, so that length does not decide.
EXCESS_RATE = 7.0


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and texts that every learned language codes EXCESS_RATE bits a byte longer than raw bytes.
    Where nothing is there to learn from, only texts without a letter go."""
    train = F.coalesce(~langid.held_out(), F.lit(False))
    tagged = langid.identify(docs.withColumnsRenamed({c: f"d_{c}" for c in docs.columns}).withColumns({c: F.col(f"d_{c}") for c in ("doc_id", "text", "lang")}), train, [f"d_{c}" for c in docs.columns])
    letters = F.coalesce(F.col("d_text").rlike(r"\p{L}"), F.lit(False))
    return tagged.filter(letters & (F.col("bits_per_byte") < 8 + EXCESS_RATE)).select(*[F.col(f"d_{c}").alias(c) for c in docs.columns])


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one row of each text: that of the largest doc_id."""
    stays = exact_dedup.exact_dedup(docs).select(F.col("keep_id").alias("id"), F.col("text_sha256").alias("sha")).distinct()
    sha = F.sha2(F.coalesce(F.col("row.text"), F.lit("")).cast("binary"), 256)
    rows = docs.select(F.struct(*docs.columns).alias("row")).withColumns({"row_id": F.col("row.doc_id"), "row_sha": sha})
    kept = rows.join(stays, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_sha") == F.col("sha")), "left_semi")
    return kept.dropDuplicates(["row_id", "row_sha"]).select("row.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves the document with the smallest doc_id of each component of near copies."""
    gone = simhash.near_dedup(docs, shingle=3, distance=3).filter(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves each document as often as the mix takes it: not at all, once or more."""
    taken = mixing.mix(docs).filter("copies > 0").groupBy(F.col("doc_id").alias("id")).agg(F.max("copies").alias("n"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("row_id"))
    found = rows.join(taken, F.col("row_id").eqNullSafe(F.col("id")))
    return found.select("row", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("mixing", mixed),
    ("best_fit_packing", packed),
]

#: Language identification and the tokenizer cannot be expressed in SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each one's result but the last's stands as Parquet only until the next one is written."""
    docs = read_table(spark, sf_dir, "documents")
    folder, past = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}", None
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if past is not None:
            place = spark._jvm.org.apache.hadoop.fs.Path(past)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        past = path
    return STAGES[-1][1](spark, docs, sf_dir)

"""Phrases of a large dictionary in texts, and formulas over them (inventory P6).

A formula is an OR of alternatives, each an AND of clauses, each an OR of
phrases; a phrase holds where it is a substring of the text.  Testing every
phrase on every text costs texts times phrases.  Here the cost follows the
texts: every phrase is filed under one of its own character sequences of a few
characters, the one that fewest other phrases have; the distinct sequences of
a text look the dictionary up by one hash join, and only the phrases found so
are compared with the text.  What holds of a text's clauses is a bit vector
per alternative, put together by ``bit_or`` on the map side; an alternative
holds where all its bits are set.

The dictionary is a table; it is broadcast up to a checked number of rows and
joined by a shuffle beyond.  Texts do not travel in the aggregation, only ids, bits and what the caller wants carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .resolve import sized_broadcast

#: Characters of the sequences that phrases are filed under; shorter phrases are filed whole.
GRAM = 6
BITS = 63


def _grams(text: Column, length: int) -> Column:
    """All character sequences of a length, by one pass of a lookahead."""
    return F.regexp_extract_all(text, F.lit("(?s)(?=(.{%d}))" % length), F.lit(1))


def dictionary(formulas: DataFrame, gram: int = GRAM) -> DataFrame:
    """gram, phrase: every distinct phrase under its sequence that fewest phrases have."""
    phrases = formulas.select("phrase").distinct()
    size = F.least(F.length("phrase"), F.lit(gram))
    every = F.when(size < gram, F.array("phrase")).otherwise(F.array_distinct(_grams(F.col("phrase"), gram)))
    filed = phrases.select("phrase", F.explode(every).alias("gram"))
    shares = filed.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    best = filed.join(shares, "gram").groupBy("phrase").agg(F.min(F.struct("n", "gram")).alias("b"))
    return best.select(F.col("b.gram").alias("gram"), "phrase")


def phrase_matches(texts: DataFrame, formulas: DataFrame, keys: list[str], carry: tuple = (), gram: int = GRAM) -> DataFrame:
    """texts: id, text; formulas: keys, alt, clause (numbered from 0), phrase.  Gives id and keys, once for each formula that a text satisfies.

    ``carry``: further columns of texts to be given too (short ones; one value per id), so that texts are read once.  Both sides are compared as they are; callers lower-case them.  An empty phrase holds of every text."""
    formulas = formulas.select(*keys, "alt", "clause", "phrase").checkpoint()
    clauses, n = formulas.agg(F.coalesce(F.max("clause") + 1, F.lit(0)), F.count(F.lit(1))).first()
    filed = dictionary(formulas, gram).checkpoint()
    lengths = sorted(r[0] for r in filed.select(F.length("gram")).distinct().collect())  # at most GRAM + 1 of them
    if not lengths:
        return texts.limit(0).select("id", *carry, "text").join(formulas.limit(0).select(*keys, F.col("phrase").alias("text")), "text").drop("text")
    own = F.array_distinct(F.flatten(F.array(*[_grams(F.col("text"), k) for k in lengths])))
    met = texts.select("id", "text", *carry, F.explode(own).alias("gram")).join(sized_broadcast(filed, n), "gram")
    held = met.filter(F.contains("text", F.col("phrase"))).select("id", "phrase", *carry)
    of = formulas.groupBy(*keys, "alt").agg((F.max("clause") + 1).alias("n_clauses"))
    placed = sized_broadcast(formulas.join(of, [*keys, "alt"]), n)
    bits = held.join(placed, "phrase")
    vector = [
        F.bit_or(F.when(F.floor(F.col("clause") / BITS) == k, F.expr(f"shiftleft(1L, clause % {BITS})")).otherwise(F.lit(0).cast("long"))).alias(f"v{k}")
        for k in range(-(-clauses // BITS))
    ]
    carried = [F.first(c).alias(c) for c in carry]
    whole = bits.groupBy("id", *keys, "alt", "n_clauses").agg(*vector, *carried)
    count = sum((F.bit_count(f"v{k}") for k in range(1, len(vector))), F.bit_count("v0"))
    found = whole.filter(count == F.col("n_clauses"))
    return found.groupBy("id", *keys).agg(*carried) if carry else found.select("id", *keys).distinct()

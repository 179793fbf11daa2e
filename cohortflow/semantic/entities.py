"""Misspelt values in questions: an index of character pairs finds candidates, a bounded edit distance decides.

A value of length n within d edits of a phrase shares all but 2d of its n + 1 padded character pairs with it. So of any 2d + 1 pairs of the
value at least one occurs in the phrase: the rarest ones are indexed, and no match is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortflow.plans.lineage import broadcast_if_small, cut_lineage
from cohortflow.semantic.model import phrases

#: Edits allowed from this length on. Shorter values have to be written as they are.
ONE_EDIT, TWO_EDITS = 4, 9


def edits_allowed(value: Column) -> Column:
    return F.when(F.length(value) >= TWO_EDITS, 2).when(F.length(value) >= ONE_EDIT, 1).otherwise(0)


def character_pairs(text: Column) -> Column:
    """The padded pairs of neighbouring characters, numbered where a pair repeats: "aaa" has "aa" once and "aa" a second time."""
    padded = F.concat(F.lit("\u0001"), text, F.lit("\u0002"))
    pairs = F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda at: padded.substr(at, F.lit(2)))
    return F.transform(pairs, lambda pair, at: F.struct(pair.alias("pair"), F.size(F.filter(F.slice(pairs, 1, at), lambda p: p == pair)).alias("nth")))


def value_index(dictionary: DataFrame) -> DataFrame:
    """column, value, spelling, edits, pair: the indexed pairs of every dictionary value (column, value), the rarest ones first."""
    spelt = dictionary.select("column", "value").filter(F.col("value") != "").distinct()
    spelt = spelt.withColumn("spelling", F.lower("value")).withColumn("edits", edits_allowed(F.col("spelling")))
    pairs = spelt.withColumn("pair", F.explode(character_pairs(F.col("spelling"))))
    common = pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("_uses"))
    ranked = pairs.join(broadcast_if_small(common), "pair").withColumn("_rank", F.row_number().over(Window.partitionBy("column", "value").orderBy("_uses", "pair")))
    return ranked.filter(F.col("_rank") <= 2 * F.col("edits") + 1).select("column", "value", "spelling", "edits", "pair")


def match_values(asked: DataFrame, text: str, dictionary: DataFrame) -> DataFrame:
    """Columns of ``asked`` plus (phrase, column, value, distance) for every dictionary value that a phrase of the text names or nearly names.

    Phrases are runs of at most as many words as the longest value has, in lower case. Every distinct phrase is looked up once. Null and
    empty texts match nothing; equal rows of ``asked`` stay apart. Rows that lie in few files are spread over all cores first: the work is
    in their phrases, not in their bytes.
    """
    cores = asked.sparkSession.sparkContext.defaultParallelism
    asked = asked if asked.rdd.getNumPartitions() >= cores else asked.repartition(cores)
    longest = dictionary.agg(F.coalesce(F.max(F.size(F.split("value", r"[^\p{L}\p{N}_]+"))), F.lit(1)).alias("n")).first()["n"]
    found = asked.withColumn("phrase", F.explode(F.array_distinct(phrases(F.col(text), longest))))
    distinct = found.select("phrase").distinct()
    index = broadcast_if_small(value_index(dictionary))
    candidates = distinct.withColumn("pair", F.explode(character_pairs(F.col("phrase")))).join(index, "pair")
    near = candidates.filter(F.abs(F.length("phrase") - F.length("spelling")) <= F.col("edits")).select("phrase", "column", "value", "spelling", "edits").distinct()
    judged = near.withColumn("distance", F.levenshtein("phrase", "spelling")).filter(F.col("distance") <= F.col("edits"))
    named = cut_lineage(judged.select("phrase", "column", "value", "distance"))  # counted and then joined: judged once for both
    return found.join(broadcast_if_small(named), "phrase")

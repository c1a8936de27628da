"""Whether what an answer says stands in the paragraph that it cites.

A containment join: an answer of ``a`` distinct shingles, of which a share ``t``
has to be in the paragraph, shares at least one of any ``a - ceil(t * a) + 1``
of them with it. The rarest ones are taken, by how many paragraphs hold them, so
that few pairs of answer and paragraph are left, and only these are compared
shingle by shingle. Texts do not move: shingles are hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textkiln.sources.folders import kept

from .joins import join_per_key

WORD = r"[\p{L}\p{N}]+"


def shingles(text: Column, n: int) -> Column:
    """Hashes of the distinct ``n``-word shingles of a text; a shorter text is
    one shingle, an empty one none. The words are a field of a lambda's argument,
    so that they are found once."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))

    def of(x):
        last = F.size(x["words"]) - n
        places = F.sequence(F.lit(0), F.greatest(last, F.lit(0)))
        return F.transform(places, lambda i: F.xxhash64(F.array_join(F.slice(x["words"], i + 1, F.lit(n)), " ")))

    found = F.transform(F.array(F.struct(words.alias("words"))), of)[0]
    return F.when(F.size(words) > 0, F.array_distinct(found)).otherwise(F.array().cast("array<bigint>"))


def supported(answers: DataFrame, paragraphs: DataFrame, share: float = 0.8, n: int = 2) -> DataFrame:
    """``answers`` (``key, cited, text``) against ``paragraphs`` (``para_id,
    text``; several rows of one id are one paragraph): ``key, cited, found,
    n_shingles, n_shared, supported``.

    ``found`` tells that there is such a paragraph; ``n_shared`` is exact where
    the answer can be supported, else null. ``supported`` needs ``share`` of the
    answer's shingles. An answer without words says nothing and is not
    supported. ``key`` is unique. Null citations are not found.
    """
    asked = kept(answers.select("key", "cited", F.explode_outer(shingles(F.col("text"), n)).alias("h")))
    held = paragraphs.where("para_id IS NOT NULL").select(F.col("para_id").alias("cited"), F.explode(shingles(F.col("text"), n)).alias("h"))
    held = kept(held.groupBy("cited", "h").agg(F.lit(1).alias("__one")).drop("__one"))
    total = asked.count()
    # every shingle of an answer, with the number of paragraphs that hold it: those
    # that none holds are the rarest
    spread = held.groupBy("h").agg(F.count("*").alias("rarity"))
    uses = asked.groupBy("h").agg(F.count("*").alias("n")).join(spread, "h", "left").select("h", "n", F.coalesce("rarity", F.lit(0)).alias("rarity"))
    ranked = join_per_key(asked.where("h IS NOT NULL"), uses, ["h"], "n", total)
    size = Window.partitionBy("key")
    ranked = ranked.withColumns({"place": F.row_number().over(size.orderBy("rarity", "h")), "n_shingles": F.count("*").over(size)})
    need = F.ceil(F.col("n_shingles") * F.lit(share) - F.lit(1e-9))
    ranked = kept(ranked.withColumn("prefix", F.col("place") <= F.col("n_shingles") - need + 1))
    # only shingles that some paragraph holds can be met; hot ones are broadcast
    pairs = ranked.where("prefix AND rarity > 0").select("key", "cited", "h")
    keys = pairs.groupBy("cited", "h").agg(F.count("*").alias("n")).join(held, ["cited", "h"])
    able = kept(join_per_key(pairs, keys, ["cited", "h"], "n", total).select("key").distinct())
    rest = ranked.join(able, "key", "left_semi").where("rarity > 0").select("key", "cited", "h")
    keys = rest.groupBy("cited", "h").agg(F.count("*").alias("n")).join(held, ["cited", "h"])
    shared = join_per_key(rest, keys, ["cited", "h"], "n", total).groupBy("key").agg(F.count("*").alias("n_shared"))
    sizes = asked.groupBy("key", "cited").agg(F.count("h").alias("n_shingles"))
    known = paragraphs.where("para_id IS NOT NULL").select(F.col("para_id").alias("cited")).distinct()
    cites = sizes.where("cited IS NOT NULL").groupBy("cited").agg(F.count("*").alias("n")).join(known.withColumn("found", F.lit(True)), "cited", "left")
    there = join_per_key(sizes.where("cited IS NOT NULL"), cites.withColumn("found", F.coalesce("found", F.lit(False))), ["cited"], "n", total)
    there = there.union(sizes.where("cited IS NULL").withColumn("found", F.lit(False)))
    enough = F.coalesce(F.col("n_shared") >= F.ceil(F.col("n_shingles") * F.lit(share) - F.lit(1e-9)), F.lit(False)) & (F.col("n_shingles") > 0)
    return there.join(shared, "key", "left").select("key", "cited", "found", "n_shingles", F.when(enough, F.col("n_shared")).alias("n_shared"), enough.alias("supported"))

"""Free-form tags to genres, by an ordered table of synonyms that the caller gives.

``synonyms`` has genre, synonym and priority (a long; the order of the table), ``noise`` has tag.
Both are dimensions; distinct tags are classified once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# Fixed value: the ways to write a decade.
DECADE = r"^(19|20)?[0-9]0\s*(s|'s|er|er jahre|te|ties)?$"
DECADES_GENRE = "oldies"


def genres_of(tags: DataFrame, synonyms: DataFrame, noise: DataFrame, tag: str = "tag") -> DataFrame:
    """(tag, key, noisy, genre) of distinct tags: the synonym itself, then a decade, then a synonym as whole words."""
    keyed = tags.select(tag).distinct().withColumn("key", T.tag_key(F.col(tag)))
    keyed = keyed.join(noise.select(F.col("tag").alias("key"), F.lit(True).alias("noisy")).distinct(), "key", "left").withColumn("noisy", F.coalesce("noisy", F.lit(False)))
    exact = synonyms.groupBy(F.col("synonym").alias("key")).agg(F.min_by("genre", "priority").alias("exact"))
    keyed = keyed.join(exact, "key", "left")
    open_ = keyed.where("not noisy and exact is null and key <> ''").where(~F.col("key").rlike(DECADE)).select("key").distinct()
    # words of a tag up to the longest synonym, joined by equality instead of compared with every synonym
    longest = synonyms.agg(F.coalesce(F.max(F.size(F.split("synonym", " "))), F.lit(1))).first()[0]
    words = F.split("key", " ")
    spans = F.flatten(F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(longest), F.size(words) - i + 1)), lambda n: F.array_join(F.slice(words, i, n), " "))))
    loose = open_.select("key", F.explode(spans).alias("synonym")).join(synonyms, "synonym").groupBy("key").agg(F.min_by("genre", "priority").alias("loose"))
    genre = F.when(F.col("noisy") | (F.col("key") == ""), None).otherwise(F.coalesce("exact", F.when(F.col("key").rlike(DECADE), DECADES_GENRE), "loose"))
    return keyed.join(loose, "key", "left").select(tag, "key", "noisy", genre.alias("genre"))


def classified(df: DataFrame, row: str, tags: str, name: str, synonyms: DataFrame, noise: DataFrame) -> DataFrame:
    """``df`` and its ``genres``: distinct, in order of the tags; the name only counts where no tag has one."""
    listed = df.select(row, F.posexplode(F.transform(tags, lambda t: t)).alias("at", "tag")).unionByName(df.where(F.col(name) != "").select(row, F.lit(-1).alias("at"), F.col(name).alias("tag")))
    known = listed.join(genres_of(listed.select("tag"), synonyms, noise).where("genre is not null").select("tag", "genre"), "tag")
    found = known.groupBy(row).agg(
        F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.col("at") >= 0, F.struct("at", "genre")))), lambda x: x["genre"])).alias("by_tag"), F.collect_list(F.when(F.col("at") < 0, F.col("genre"))).alias("by_name")
    )
    genres = F.when(F.size("by_tag") > 0, F.col("by_tag")).when(F.size("by_name") > 0, F.col("by_name")).otherwise(F.array().cast("array<string>"))
    return df.join(found, row, "left").withColumn("genres", genres).drop("by_tag", "by_name")


def coverage(tags: DataFrame, synonyms: DataFrame, noise: DataFrame, tag: str = "tag", n: str = "n") -> DataFrame:
    """One row for each tag that isn't noise: how often, and its genre or null (what to add to the table next)."""
    known = genres_of(tags.select(F.col(tag).alias("tag")), synonyms, noise)
    return tags.select(F.col(tag).alias("tag"), F.col(n).alias("n")).join(known, "tag").where("not noisy").select("tag", "n", "genre")

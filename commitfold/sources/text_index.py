"""A substring index of post texts: posting lists of trigrams.

`build` writes, for every three letters that follow one another in a text, the uris of the
posts that have them, sorted by (gram, uri), so that a list is a run of rows in few files
and the file statistics lead to it; a list that holds any share of all posts is cut over
as many files as it takes. Beside them it writes how long each list is.

A search intersects the lists of its terms, the shortest ones, and reads only the posts in
all of them; those are looked through for the terms themselves, so the rows are the same as
without the index. A term of fewer than three letters has no list. With no longer term
beside it, a search looks through all posts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import lookups

GRAM = 3
LISTS = 6  # of a search at most; the texts are looked through anyway


def _folded(text: str):
    return F.lower(F.col(text))


def build(post: DataFrame, path: str, files: int | None = None) -> None:
    """Writes the index of a `post` table: `postings` (gram, uri) and `lengths` (gram, n)."""
    places = F.sequence(F.lit(1), F.char_length("low") - GRAM + 1)
    cut = F.transform(places, lambda i: F.substring(F.col("low"), i, F.lit(GRAM)))
    low = post.select("uri", _folded("text").alias("low")).where(F.char_length("low") >= GRAM)
    grams = low.select(F.explode(F.array_distinct(cut)).alias("gram"), "uri")
    order = ["gram", "uri"]
    dealt = grams.repartitionByRange(files, *order) if files else grams.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.parquet(f"{path}/postings")
    spark = post.sparkSession
    lengths = _postings(spark, path).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    lengths.repartitionByRange("gram").sortWithinPartitions("gram").write.parquet(f"{path}/lengths")


def _postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("gram string, uri string").parquet(f"{path}/postings")


def grams_of(query: str) -> list[str]:
    """The trigrams of the terms of a query, folded as texts are."""
    terms = [t.lower() for t in query.split()]
    return sorted({t[i : i + GRAM] for t in terms for i in range(len(t) - GRAM + 1)})


def candidates(spark: SparkSession, path: str, query: str) -> DataFrame | None:
    """The uris that have the rarest trigrams of the query, or None where it has none."""
    wanted = grams_of(query)
    if not wanted:
        return None
    lengths = spark.read.schema("gram string, n bigint").parquet(f"{path}/lengths").where(F.col("gram").isin(wanted))
    known = lengths.orderBy("n", "gram").collect()  # a row per trigram of the query
    if len(known) < len(wanted):
        return _postings(spark, path).select("uri").where("false")
    rarest = [r["gram"] for r in known[:LISTS]]
    found = _postings(spark, path).where(F.col("gram").isin(rarest)).groupBy("uri").agg(F.count(F.lit(1)).alias("n"))
    return found.where(F.col("n") == len(rarest)).select("uri")


def _narrowed(post: DataFrame, path: str, query: str) -> DataFrame:
    found = candidates(post.sparkSession, path, query)
    return post if found is None else post.join(found, "uri", "left_semi")


def search_posts(post: DataFrame, path: str, query: str, limit: int = lookups.DEFAULT_HITS, cursor: lookups.Cursor = None) -> DataFrame:
    """`lookups.search_posts` over the posts that the index leaves."""
    return lookups.search_posts(_narrowed(post, path, query), query, limit, cursor)


def search_total(post: DataFrame, path: str, query: str) -> DataFrame:
    return lookups.search_total(_narrowed(post, path, query), query)

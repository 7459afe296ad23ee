"""An inverted index of stored pages (J4, W4): words to the pages that have them, written once.

``postings`` has a row for each (word, block of pages): the sorted ids of the block's pages
that have the word, and how often each has it. It is partitioned by a hash of the word
into ``buckets`` folders and sorted by word within a file, so a search lists and reads
only the folders its words hash to, and there only the row groups that may hold them. New
pages are appended; ``pages`` lists what is indexed, so a page is added once. A run that
dies between the two writes leaves postings twice, which a search counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import html as H
from ..functions import text as X
from ..streaming.resume import has_data
from .search import CANDIDATES, query_words

#: Pages to a block (a power of two): the most ids in one posting row, also of a word that every page has.
BLOCK_PAGES = 1 << 12
BUCKETS = 64


class PageIndex:
    """The index under ``path``; ``id_type`` is the type of the page ids."""

    def __init__(self, spark: SparkSession, path: str, id_type: str = "LONG", buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.pages_schema = T.StructType.fromDDL(f"page_id {id_type}")
        self.postings_schema = T.StructType.fromDDL(f"word STRING, ids ARRAY<{id_type}>, counts ARRAY<INT>, bucket INT")

    def _read(self, table: str, schema: T.StructType) -> DataFrame:
        path = f"{self.path}/{table}"
        return self.spark.read.schema(schema).parquet(path) if has_data(self.spark, path) else self.spark.createDataFrame([], schema)

    def _bucket(self, word: Column) -> Column:
        return F.pmod(F.xxhash64(word), F.lit(self.buckets)).cast("int")

    def add(self, pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> None:
        """Index the pages not yet indexed; of rows with one id the text of the least counts. Null ids are left out."""
        have = self._read("pages", self.pages_schema)
        named = pages.select(F.col(f"`{id_col}`").alias("page_id"), H.html_to_text(F.col(f"`{html_col}`"), max_chars=None).alias("text"))
        new = named.filter(F.col("page_id").isNotNull()).join(have, "page_id", "left_anti").groupBy("page_id").agg(F.min("text").alias("text"))
        words = X.words(F.lower(F.regexp_replace("text", X.NOT_WORD_OR_SPACE, "")))
        blocked = new.select("page_id", words.alias("w")).withColumn("block", F.shiftright(F.monotonically_increasing_id(), BLOCK_PAGES.bit_length() - 1))
        counted = blocked.select("block", "page_id", F.explode("w").alias("word")).groupBy("block", "word", "page_id").agg(F.count(F.lit(1)).cast("int").alias("n"))
        rows = counted.groupBy("word", "block").agg(F.sort_array(F.collect_list(F.struct("page_id", "n"))).alias("p"))
        rows = rows.select(
            "word", F.transform("p", lambda x: x["page_id"]).alias("ids"), F.transform("p", lambda x: x["n"]).alias("counts"), self._bucket(F.col("word")).alias("bucket")
        )
        rows.repartition("bucket").sortWithinPartitions("bucket", "word").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/postings")
        new.select("page_id").write.mode("append").parquet(f"{self.path}/pages")

    def postings(self, words: DataFrame) -> DataFrame:
        """The postings of the words in ``words`` (column ``word``), read from their buckets alone."""
        keyed = words.select("word").distinct().withColumn("bucket", self._bucket(F.col("word")))
        wanted = sorted(r[0] for r in keyed.select("bucket").distinct().collect())  # at most one number a bucket
        found = self._read("postings", self.postings_schema).filter(F.col("bucket").isin(wanted) if wanted else F.lit(False))
        return found.join(keyed, ["bucket", "word"])

    def search(self, queries: DataFrame, candidates: int = CANDIDATES) -> DataFrame:
        """As ``search.search_candidates``: query_id, page_id, score, rank."""
        asked = query_words(queries)
        met = self.postings(asked).join(asked, "word").select("query_id", "word", F.explode("ids").alias("page_id"))
        hits = met.groupBy("query_id", "page_id").agg(F.count_distinct("word").alias("score"))
        w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("page_id").asc())
        return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= F.lit(candidates))

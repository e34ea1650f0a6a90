"""Queries over acquisition runs: a recorded feed of customers by nation, taken in two runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.plans.registry import query
from cairn.scratch import scratch_path
from cairn.sources.records import table
from cairn.streaming import acquire

ON_PAGE = 2


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of two customers of a nation, each but the first with the last one of the page before again; every 17th customer has no id.

    By the nation's number, sources are bounded by pages or by items, ask for their first page again, or lack their third page.
    """
    nation, k = F.col("c_nationkey"), F.col("c_custkey")
    placed = table(spark, sf_dir, "customer").select(nation.alias("nation"), k.alias("k"), (F.row_number().over(Window.partitionBy(nation).orderBy(k)) - 1).alias("n"))
    page = F.floor(F.col("n") / ON_PAGE)
    again = placed.where(F.col("n") % ON_PAGE == ON_PAGE - 1).select("nation", "k", "n", (page + 1).alias("page"))
    rows = placed.select("nation", "k", "n", page.alias("page")).unionAll(again)
    own = rows.groupBy("nation", "page").agg(F.sort_array(F.collect_list(F.struct("n", "k"))).alias("rows"), F.min("n").alias("low"))
    total = placed.groupBy("nation").agg(F.count(F.lit(1)).alias("reported"))
    both = own.join(total, "nation").where(F.col("page") * ON_PAGE < F.col("reported"))
    kind = F.col("nation") % 5
    ids = F.transform("rows", lambda r: F.when(r["k"] % 17 != 3, F.concat(F.lit("c"), r["k"].cast("string"))))
    following = F.when((F.col("page") + 1) * ON_PAGE < F.col("reported"), F.when((kind == 3) & (F.col("page") == 1), F.lit("0")).otherwise((F.col("page") + 1).cast("string")))
    return both.where((kind != 4) | (F.col("page") != 2)).select(
        F.concat(F.lit("n"), F.col("nation").cast("string")).alias("source"), F.col("page").cast("string").alias("request"), ids.alias("ids"), "reported", following.alias("following"),
        F.when(kind == 1, 2).alias("maximum_pages"), F.when(kind == 2, 3).alias("maximum_items"),
    )


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a feed of which only some pages were there at first, and those in no order; the second run finds some pages again."""
    path = scratch_path(spark, "acquired")
    pages = feed(spark, sf_dir)
    early = F.abs(F.xxhash64("source", "request")) % 3 != 0
    for part in (pages.where(early), pages.where(~early | (F.length("request") == 1))):
        part.repartition(8, F.xxhash64("request", "source")).write.mode("append").parquet(f"{path}/feed")
        acquire.run(spark, f"{path}/feed", f"{path}/receipts", f"{path}/checkpoint")
    return spark.read.schema(acquire.RECEIPT).parquet(f"{path}/receipts")


FEED_SQL = f"""WITH placed AS (SELECT c_nationkey AS nation, c_custkey AS k, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS n, count(*) OVER (PARTITION BY c_nationkey) AS reported FROM customer),
rows AS (SELECT *, n // {ON_PAGE} AS page FROM placed UNION ALL SELECT *, n // {ON_PAGE} + 1 FROM placed WHERE n % {ON_PAGE} = {ON_PAGE - 1} AND n + 1 < reported),
named AS (SELECT *, k % 17 <> 3 AS named, row_number() OVER (PARTITION BY nation, k % 17 <> 3 ORDER BY page, n) AS nth FROM rows),
firsts AS (SELECT *, named AND n // {ON_PAGE} = page AS first FROM named),
counted AS (SELECT *, sum(CASE WHEN first THEN 1 ELSE 0 END) OVER (PARTITION BY nation ORDER BY page, n) AS held FROM firsts),
ends AS (SELECT nation, any_value(reported) AS reported, max(page) AS last, CASE nation % 5 WHEN 1 THEN least(1, max(page)) WHEN 2 THEN coalesce(min(page) FILTER (held >= 3), max(page)) WHEN 3 THEN least(1, max(page)) WHEN 4 THEN least(1, max(page)) ELSE max(page) END AS stop FROM counted GROUP BY nation),
used AS (SELECT c.*, e.last, e.stop, CASE WHEN nation % 5 = 2 THEN least(held, 3) ELSE held END AS own FROM counted c JOIN ends e USING (nation) WHERE page <= stop)"""


@query(
    FEED_SQL + """, s AS (SELECT nation, any_value(reported) AS reported, any_value(last) AS last, any_value(stop) AS stop, count(*) AS upstream, count(*) FILTER (NOT named) AS dropped, CAST(max(own) AS BIGINT) AS items FROM used GROUP BY nation),
    r AS (SELECT *, CASE WHEN nation % 5 = 2 AND items >= 3 THEN CASE WHEN items >= reported THEN 'sourceExhausted' ELSE 'maximumItems' END WHEN stop = last THEN 'sourceExhausted' WHEN nation % 5 = 1 THEN 'maximumPages' WHEN nation % 5 = 3 THEN 'repeatedRequest' END AS reason FROM s)
    SELECT 'n' || nation AS source, CAST(stop + 1 AS INTEGER) AS pages, upstream, dropped, items, greatest(reported - items, 0) AS unrepresented, reason, coalesce(reason = 'sourceExhausted', false) AS complete, coalesce(reason = 'sourceExhausted', false) AND dropped = 0 AND items = reported AS coverage_complete FROM r"""
)
def acquisition_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acquire.summary(receipts(spark, sf_dir))


@query(FEED_SQL + " SELECT 'n' || nation AS source, CAST(page + 1 AS INTEGER) AS page, 'c' || k AS id FROM used WHERE first AND (nation % 5 <> 2 OR held <= 3)")
def acquired_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids with the page on which each was first seen."""
    return receipts(spark, sf_dir).select("source", "page", F.explode("kept").alias("id"))

"""Scans and sinks of files: manifests, event logs, front matter, bundles and checksums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.functions.text import shard
from cairn.operators import index
from cairn.operators.validate import violations
from cairn.scratch import materialize

MANIFEST = "slug string, topic string, subTopic string, dataset string, code string, include string"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A CSV manifest with exactly the known header; ``include`` must be true or false."""
    rows = spark.read.csv(path, header=True, schema=MANIFEST, enforceSchema=False, mode="FAILFAST")
    flag = F.when(F.col("include").isin("true", "false"), F.col("include") == "true").otherwise(F.raise_error(F.concat(F.lit("bad include value: "), F.coalesce("include", F.lit("null")))).cast("boolean"))
    return rows.withColumn("include", flag)


def manifest_violations(rows: DataFrame) -> DataFrame:
    """(slug, rule): rows to include that lack what they then need."""
    needed = {name: ~F.col("include") | F.col(name).isNotNull() for name in ("slug", "topic", "dataset", "code")}
    return violations(rows, "slug", needed)


def read_events(spark: SparkSession, path: str, schema: str = "seq bigint, event string, tool string") -> DataFrame:
    """A JSON-lines log, with its file's name."""
    return spark.read.schema(schema).json(path).withColumn("file", F.input_file_name())


def broken_sequences(events: DataFrame, number: str = "seq") -> DataFrame:
    """Files whose numbers don't run from one without gaps."""
    counts = events.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min(number).alias("low"), F.max(number).alias("high"), F.countDistinct(number).alias("distinct"))
    return counts.where((F.col("low") != 1) | (F.col("high") != F.col("n")) | (F.col("distinct") != F.col("n")))


def read_front_matter(spark: SparkSession, path: str) -> DataFrame:
    """(file, key, value, body) of Markdown files whose first block holds one JSON value for each key."""
    rows = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.regexp_extract("value", r"(?s)\A---\n(.*?)\n---\n", 1).alias("head"), F.regexp_replace("value", r"(?s)\A---\n.*?\n---\n", "").alias("body"))
    lines = rows.select("file", "body", F.explode(F.split("head", "\n")).alias("line")).where("line <> ''")
    key, value = F.regexp_extract("line", r"^([^:]+): ?(.*)$", 1), F.regexp_extract("line", r"^([^:]+): ?(.*)$", 2)
    return lines.select("file", key.alias("key"), F.parse_json(value).alias("value"), "body")


def duplicate_keys(front: DataFrame) -> DataFrame:
    return front.groupBy("file", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def render_front_matter(rows: DataFrame, path_col: str, fields: dict[str, Column], body: Column) -> DataFrame:
    """(path, text): documents with a front-matter line for each field in order, null fields left out."""
    line = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), F.to_json(F.struct(v.alias("v"))).substr(F.lit(6), F.length(F.to_json(F.struct(v.alias("v")))) - 6))) for k, v in fields.items()]
    return rows.select(F.col(path_col).alias("path"), F.concat(F.lit("---\n"), F.concat_ws("\n", *line), F.lit("\n---\n"), body).alias("text"))


def write_chunks(rows: DataFrame, path: str, ordinal: str = "ordinal", size: int = 500) -> None:
    """JSON in folders of ``size`` consecutive ordinals; dealt by folder, so each is one file."""
    own = rows.withColumn("chunk", F.floor(F.col(ordinal) / size))
    own.repartition("chunk").sortWithinPartitions("chunk", ordinal).write.partitionBy("chunk").json(path)


#: Tables of a stored index.
TABLES = ("postings", "lexicon", "prefixes", "documents")


def write_search_index(corpus: DataFrame, path: str, tables: tuple[str, ...] = TABLES) -> None:
    """An index below a folder: capped postings and the lexicon by shard, completions of prefixes, and the document map; all of them, or those that are named.

    Postings and the lexicon are made from the records' own rows, so neither waits for all postings to be stored.
    """
    if "postings" in tables:
        write_index(index.top_postings(index.postings(corpus)), f"{path}/postings", shard(F.col("token")))
    if "lexicon" in tables or "prefixes" in tables:
        words = materialize(index.lexicon(index.tokens_of_records(corpus)), "lexicon")
    if "lexicon" in tables:
        words.repartition("shard").sortWithinPartitions("shard", "token").write.partitionBy("shard").parquet(f"{path}/lexicon")
    if "prefixes" in tables:
        index.completions(words).write.parquet(f"{path}/prefixes")
    if "documents" in tables:
        corpus.select("ordinal", "id", "title", "source_surface").write.parquet(f"{path}/documents")


def lookup(spark: SparkSession, path: str, terms: list[str], limit: int) -> DataFrame:
    """The best records for a query from a stored index: only the shards of its terms are read. A token has a bounded number of postings, so few rows meet."""
    wanted = spark.createDataFrame([(t,) for t in terms], "token string").select("token", shard(F.col("token")).alias("shard"))
    shards = sorted({r["shard"] for r in wanted.collect()})
    found = spark.read.parquet(f"{path}/postings").where(F.col("shard").isin(shards) & F.col("token").isin(terms))
    best = found.groupBy("ordinal").agg(F.count(F.lit(1)).alias("matched"), F.sum("score").alias("score")).orderBy(F.desc("matched"), F.desc("score"), "ordinal").limit(limit)
    documents = spark.read.parquet(f"{path}/documents")
    return documents.join(F.broadcast(best), "ordinal").orderBy(F.desc("matched"), F.desc("score"), "ordinal").select("id", "title", "matched", "score")


def write_index(postings: DataFrame, path: str, shard: Column) -> None:
    """Postings in folders by shard of their token, so that a reader prunes to the shards that it needs."""
    own = postings.withColumn("shard", shard)
    own.repartition("shard").sortWithinPartitions("shard", "token").write.partitionBy("shard").parquet(path)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256) of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Paths that one of two checksum tables lacks or has with another digest."""
    both = a.select("path", F.col("sha256").alias("left")).join(b.select("path", F.col("sha256").alias("right")), "path", "full")
    return both.where(~F.col("left").eqNullSafe(F.col("right")))


def numbered(rows: DataFrame, by: str, order: str) -> DataFrame:
    """Rows numbered from one within each file, for error messages."""
    return rows.withColumn("row", F.row_number().over(Window.partitionBy(by).orderBy(order)))

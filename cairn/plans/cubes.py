"""Queries over cubes: one for each part, of its line items by flag, status and measure, with a register of the parts and aliases from suppliers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.plans.registry import query
from cairn.sources import cubes
from cairn.sources.records import table

FLAGS, STATUSES, MEASURES = ("A", "N", "R"), ("O", "F"), ("quantity", "lines")


def dimension(label: str, names: tuple[str, ...], labels: dict[str, str]) -> str:
    """The JSON of a dimension: positions by category, written in reverse order, and labels."""
    index = ",".join(f'"{n}":{i}' for i, n in reversed(list(enumerate(names))))
    return f'{{"label":"{label}","category":{{"index":{{{index}}},"label":{{{",".join(f"{chr(34)}{k}{chr(34)}:{chr(34)}{v}{chr(34)}" for k, v in labels.items())}}}}}}}'


DIMENSIONS = '"areacd":' + dimension("Flag", FLAGS, {"A": "accepted"}) + ',"sex":' + dimension("Status", STATUSES, {"O": "open", "F": "filled"}) + ',"measure":' + dimension("Measure", MEASURES, {})
#: Defects of registers and documents, by the part's number.
EXTENSION = """concat('{"slug":"part-', CAST(p_partkey AS STRING), CASE WHEN p_partkey % 71 = 5 THEN 'x' ELSE '' END, '","topic":"', p_type, '","subTopic":"', CASE WHEN p_partkey % 73 = 6 THEN 'other' ELSE p_brand END, '","dataset":"parts","code":"', CAST(p_partkey AS STRING), '"}')"""


def items(spark: SparkSession, sf_dir: str, values: bool) -> DataFrame:
    """(p_partkey, item): documents as text, parsed. Those without values have planted defects of shape."""
    parts = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    if values:
        lines = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_returnflag", "l_linestatus").agg(F.sum("l_quantity").cast("bigint").alias("quantity"), F.count(F.lit(1)).alias("lines"))
        of = lambda f, s, m: F.max(F.when((F.col("l_returnflag") == f) & (F.col("l_linestatus") == s), F.col(m)))
        own = lines.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.array(*(F.coalesce(of(f, s, m).cast("string"), F.lit("null")) for f in FLAGS for s in STATUSES for m in MEASURES)).alias("value"))
        parts, value = parts.join(own, "p_partkey"), F.array_join("value", ",")
    else:
        value = F.when(k % 41 == 1, "1").otherwise("")
    size = F.when((k % 43 == 2) & ~F.lit(values), "3,3,2").otherwise("3,2,2")
    ids = F.when((k % 47 == 3) & ~F.lit(values), '"areacd","weight","measure"').otherwise('"areacd","sex","measure"')
    status = F.when((k % 53 == 4) & ~F.lit(values), ',"status":{"0":"p"}').otherwise("")
    kind = F.when((k % 59 == 5) & ~F.lit(values), "collection").otherwise("dataset")
    roles = F.when((k % 61 == 6) & ~F.lit(values), '{"geo":["areacd"],"time":["areacd"]}').otherwise('{"geo":["areacd"]}')
    text = F.concat(F.lit('{"version":"2.0","class":"'), kind, F.lit('","label":"'), "p_name", F.lit('","id":['), ids, F.lit('],"size":['), size, F.lit('],"role":'), roles, F.lit(f',"dimension":{{{DIMENSIONS}}},"value":['), value, F.lit("]"), status, F.lit(',"extension":'), F.expr(EXTENSION), F.lit("}"))
    return parts.select("p_partkey", F.from_json(text, cubes.ITEM).alias("item"))


@query(
    "WITH l AS (SELECT l_partkey AS p_partkey, l_returnflag AS flag, l_linestatus AS status, sum(l_quantity)::DOUBLE AS quantity, count(*)::DOUBLE AS lines FROM lineitem GROUP BY ALL) SELECT p_partkey, flag, status, 'quantity' AS measure, quantity AS value FROM l UNION ALL SELECT p_partkey, flag, status, 'lines', lines FROM l"
)
def cube_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All values of all cubes with the names of their categories."""
    own = cubes.cells(items(spark, sf_dir, values=True), "p_partkey")
    name = lambda d: F.element_at("coordinates", d)
    return own.select("p_partkey", name("areacd").alias("flag"), name("sex").alias("status"), name("measure").alias("measure"), "value")


@query(
    """SELECT p_partkey, d.*, CASE WHEN p_partkey % 61 = 6 AND dimension = 'areacd' THEN 'geo' ELSE role END AS role FROM part CROSS JOIN (VALUES
    ('areacd', 'Flag', 0, 3, 'count-only', NULL), ('sex', 'Status', 1, 2, 'identifiers-and-labels', 'O:open,F:filled'), ('measure', 'Measure', 2, 2, 'identifiers-and-labels', 'quantity:,lines:')) d(dimension, label, "order", "count", projection, categories)
    JOIN (VALUES ('areacd', 'geo'), ('sex', 'dimension'), ('measure', 'measure')) r(name, role) ON name = dimension WHERE p_partkey % 47 <> 3
    UNION ALL SELECT p_partkey, d.* FROM part CROSS JOIN (VALUES ('areacd', 'Flag', 0, 3, 'count-only', NULL, 'geo'), ('weight', NULL, 1, NULL, 'identifiers-and-labels', NULL, 'dimension'), ('measure', 'Measure', 2, 2, 'identifiers-and-labels', 'quantity:,lines:', 'measure')) d WHERE p_partkey % 47 = 3"""
)
def cube_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cubes.dimension_rows(items(spark, sf_dir, values=False), "p_partkey")
    listed = F.array_join(F.transform("categories", lambda c: F.concat(c["id"], F.lit(":"), F.coalesce(c["label"], F.lit("")))), ",")
    return rows.withColumn("categories", listed).withColumn("count", F.when(F.col("count") >= 0, F.col("count")))


@query(
    """SELECT p_partkey, unnest(list_filter([CASE WHEN p_partkey % 59 = 5 THEN 'class' END, CASE WHEN p_partkey % 47 = 3 THEN 'unreviewed dimension' END, CASE WHEN p_partkey % 47 = 3 THEN 'dimension lookup' END,
    CASE WHEN p_partkey % 43 = 2 OR p_partkey % 47 = 3 THEN 'category index' END, CASE WHEN p_partkey % 61 = 6 THEN 'several roles' END, CASE WHEN p_partkey % 41 = 1 THEN 'values' END, CASE WHEN p_partkey % 53 = 4 THEN 'statuses' END], lambda x: x IS NOT NULL)) AS rule FROM part"""
)
def cube_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cubes.item_faults(items(spark, sf_dir, values=False), "p_partkey")


REGISTER_SQL = """reg AS (SELECT p_partkey AS row, CASE WHEN p_partkey % 10 = 0 AND p_partkey % 70 <> 0 THEN '' ELSE 'part-' || (CASE WHEN p_partkey % 89 = 8 THEN p_partkey - 1 ELSE p_partkey END) END AS slug, p_partkey % 10 = 0 AS out FROM part)"""


def register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each part, every tenth left out. Some have no class, a name twice, another word for include or a name although they are left out."""
    k = F.col("p_partkey")
    out = k % 10 == 0
    bare = out & (k % 70 != 0)
    return table(spark, sf_dir, "part").select(
        k.alias("row"), F.when(bare, "").otherwise(F.concat(F.lit("part-"), (k - F.when(k % 89 == 8, 1).otherwise(0)).cast("string"))).alias("slug"), F.when(bare | (k % 83 == 7), "").otherwise(F.col("p_type")).alias("topic"),
        F.when(bare, "").otherwise(F.col("p_brand")).alias("subTopic"), F.lit("parts").alias("dataset"), k.cast("string").alias("code"), F.when(k % 79 == 9, "yes").when(out, " False").otherwise("TRUE").alias("include"),
    )


@query(
    f"""WITH {REGISTER_SQL}, r AS (SELECT *, row % 79 = 9 AS odd, NOT out AND row % 79 <> 9 AS inc FROM reg), t AS (SELECT slug, count(*) AS n FROM r WHERE inc GROUP BY slug)
    SELECT row, unnest(list_filter([CASE WHEN odd THEN 'include' END, CASE WHEN inc AND row % 83 = 7 THEN 'taxonomy' END, CASE WHEN out AND NOT odd AND row % 70 = 0 THEN 'excluded but classed' END, CASE WHEN inc AND n > 1 THEN 'slug occurs twice' END], lambda x: x IS NOT NULL)) AS rule FROM r LEFT JOIN t USING (slug)"""
)
def register_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cubes.register_faults(register(spark, sf_dir))


@query("SELECT 'parts::' || p_partkey AS native_id, p_partkey AS row, 'upstream-manifest-include-false' AS reason FROM part WHERE p_partkey % 10 = 0 OR p_partkey % 79 = 9")
def register_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cubes.split_register(register(spark, sf_dir))[1]


@query(
    f"""WITH {REGISTER_SQL}, inc AS (SELECT r.slug, CASE WHEN row % 83 = 7 THEN '' ELSE p_type END AS topic, p_brand AS sub, row::VARCHAR AS code FROM reg r JOIN part ON p_partkey = row WHERE NOT out AND row % 79 <> 9),
    docs AS (SELECT 'part-' || p_partkey || CASE WHEN p_partkey % 71 = 5 THEN 'x' ELSE '' END AS slug, p_type AS topic, CASE WHEN p_partkey % 73 = 6 THEN 'other' ELSE p_brand END AS sub, p_partkey::VARCHAR AS code FROM part WHERE p_partkey % 10 <> 0)
    SELECT slug, unnest(list_filter([CASE WHEN d.code IS NULL THEN 'no document' END, CASE WHEN i.code IS NULL THEN 'not in the register' END, CASE WHEN i.topic <> d.topic THEN 'disagree on topic' END, CASE WHEN i.sub <> d.sub THEN 'disagree on subTopic' END, CASE WHEN i.code <> d.code THEN 'disagree on code' END], lambda x: x IS NOT NULL)) AS rule FROM inc i FULL JOIN docs d USING (slug)"""
)
def register_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences between the included rows of the register and the documents of parts that it should include."""
    return cubes.closure_faults(cubes.split_register(register(spark, sf_dir))[0], items(spark, sf_dir, values=False).where("p_partkey % 10 <> 0"))


def historical(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Aliases, one for each supplier, published slugs, and pairs that are known to have no target."""
    s = F.col("s_suppkey")
    number: Column = F.when(s % 9 == 4, s * 10).when(s % 17 == 6, s + 10_000_000).otherwise(s)
    alias = F.when(s % 23 == 5, F.concat(F.lit("part-"), number.cast("string"))).when(s % 29 == 7, F.lit("part-1")).otherwise(F.concat(F.lit("old-"), s.cast("string")))
    suppliers = table(spark, sf_dir, "supplier")
    aliases = suppliers.select(alias.alias("alias"), F.concat(F.lit("part-"), number.cast("string")).alias("target"))
    known = suppliers.where("s_suppkey % 9 = 4 AND s_suppkey % 23 <> 5 AND s_suppkey % 29 <> 7").select(alias.alias("alias"), F.concat(F.lit("part-"), number.cast("string")).alias("target"))
    published = table(spark, sf_dir, "part").where("p_partkey % 10 <> 0").select(F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("slug"))
    return aliases, published, known


@query(
    """WITH s AS (SELECT s_suppkey AS s, CASE WHEN s_suppkey % 9 = 4 THEN s_suppkey * 10 WHEN s_suppkey % 17 = 6 THEN s_suppkey + 10000000 ELSE s_suppkey END AS n FROM supplier), a AS (SELECT *, CASE WHEN s % 23 = 5 THEN 'part-' || n WHEN s % 29 = 7 THEN 'part-1' ELSE 'old-' || s END AS alias FROM s)
    SELECT alias, 'part-' || n AS target, CASE WHEN s % 23 = 5 THEN 'alias of itself' WHEN alias = 'part-1' THEN 'shadows a published slug' WHEN n NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 10 <> 0) THEN CASE WHEN s % 9 = 4 THEN 'excluded' ELSE 'unexplained missing target' END ELSE 'accepted' END AS outcome FROM a"""
)
def alias_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cubes.project_aliases(*historical(spark, sf_dir))

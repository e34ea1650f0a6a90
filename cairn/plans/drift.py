"""Queries over drift and measurements: parts as a provider's records in packs by brand, line items as measurements of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import drift, telemetry
from cairn.plans.registry import query
from cairn.sources.records import table

K = "p_partkey"
FIELDS = ["p_name", "p_type", "p_size"]
#: Baseline, snapshot and provider of a part: expressions of Spark and of SQL alike. Parts may be missing from any of the three.
STATES = {
    "b": (f"{K} % 29 <> 3", {"p_name": "p_name", "p_type": f"CASE WHEN {K} % 23 = 1 THEN NULL ELSE p_type END", "p_size": "CAST(p_size AS STRING)"}),
    "s": (f"{K} % 31 <> 4", {"p_name": f"CASE WHEN {K} % 7 = 1 THEN concat('s ', p_name) ELSE p_name END", "p_type": "p_type", "p_size": f"CASE WHEN {K} % 11 = 2 THEN '0' ELSE CAST(p_size AS STRING) END"}),
    "o": (f"{K} % 37 <> 5", {"p_name": f"CASE WHEN {K} % 7 = 1 AND {K} % 2 = 0 THEN concat('s ', p_name) WHEN {K} % 5 = 2 THEN concat('o ', p_name) ELSE p_name END", "p_type": "p_type", "p_size": f"CASE WHEN {K} % 13 = 3 THEN '1' ELSE CAST(p_size AS STRING) END"}),
}


def state(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    there, values = STATES[name]
    return table(spark, sf_dir, "part").where(there).select(K, "p_brand", *(F.expr(v).alias(f) for f, v in values.items()))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What earlier looks at the provider saw: the baseline in the second month, names as they are now since the third to fifth, and once before in the first."""
    own = state(spark, sf_dir, "o")
    k = F.col(K)
    now = own.select(K, F.lit("p_name").alias("field"), F.col("p_name").alias("value"), F.explode(F.array(F.format_string("2026-0%d", (k % 3 + 3).cast("int")), F.when(k % 4 == 0, "2026-01"))).alias("seen")).where("seen IS NOT NULL")
    return now.unionAll(state(spark, sf_dir, "b").select(K, F.lit("p_size").alias("field"), F.col("p_size").alias("value"), F.lit("2026-02").alias("seen")))


STATES_SQL = ", ".join(f"{n} AS (SELECT {K}, p_brand, {', '.join(f'{v} AS {f}' for f, v in values.items())} FROM part WHERE {there})" for n, (there, values) in STATES.items())
DRIFT_SQL = f"""WITH {STATES_SQL}, j AS (SELECT {K}, coalesce(s.p_brand, o.p_brand) AS p_brand, s.{K} IS NOT NULL AS in_s, o.{K} IS NOT NULL AS in_o, b.{K} IS NOT NULL AS in_b, {', '.join(f'[s.{f}, o.{f}, b.{f}] AS {f}' for f in FIELDS)} FROM s FULL JOIN o USING ({K}) LEFT JOIN b USING ({K})),
f AS ({' UNION ALL '.join(f"SELECT {K}, p_brand, in_b, '{f}' AS field, {f}[1] AS s, {f}[2] AS o, {f}[3] AS b FROM j WHERE in_s AND in_o" for f in FIELDS)}),
d AS (SELECT {K}, p_brand, field, CASE WHEN NOT in_b THEN CASE WHEN s IS DISTINCT FROM o THEN 'without-baseline' END WHEN s IS NOT DISTINCT FROM o AND s IS NOT DISTINCT FROM b THEN NULL WHEN s IS NOT DISTINCT FROM b THEN 'provider-changed' WHEN o IS NOT DISTINCT FROM b THEN 'snapshot-changed' WHEN s IS NOT DISTINCT FROM o THEN 'both-changed-alike' ELSE 'conflicting' END AS drift, s AS selected, o AS observed, CASE WHEN in_b THEN b END AS baseline FROM f
 UNION ALL SELECT {K}, p_brand, '*', CASE WHEN in_s THEN 'gone-at-provider' WHEN in_b THEN 'dropped-from-snapshot' ELSE 'new-at-provider' END, NULL, NULL, NULL FROM j WHERE NOT (in_s AND in_o))"""


def drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.drift(state(spark, sf_dir, "s"), state(spark, sf_dir, "o"), state(spark, sf_dir, "b"), K, FIELDS, history(spark, sf_dir))


@query(
    DRIFT_SQL + f""" SELECT {K}, field, drift, selected, observed, baseline, CASE WHEN field = 'p_name' THEN CASE WHEN {K} % 4 = 0 THEN '2026-01' ELSE '2026-0' || ({K} % 3 + 3) END WHEN field = 'p_size' AND observed = baseline THEN '2026-02' END AS first_seen FROM d WHERE drift IS NOT NULL"""
)
def provider_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of parts by what became of them, and when the provider's value was first seen."""
    return drifted(spark, sf_dir)


COMMIT = f"CASE WHEN {K} % 97 = 50 THEN 'c2' ELSE 'c1' END"
BRANDS = "SELECT p_brand, count(*) FILTER ({0}) AS n, CAST(substring(p_brand, 7) AS INTEGER) % 10 AS kind FROM part GROUP BY p_brand".format(STATES["s"][0])


def packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pack for each brand, with a defect by the brand's number."""
    own = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count_if(F.expr(STATES["s"][0])).alias("n"))
    kind = F.substring("p_brand", 7, 9).cast("int") % 10
    return own.select(
        F.concat(F.lit("pack-"), "p_brand").alias("pack"), F.lit("p_brand").alias("field"), F.when(kind == 1, "contains").otherwise("equals").alias("operator"), F.when(kind == 2, "none").otherwise(F.col("p_brand")).alias("value"),
        (F.col("n") + F.when(kind == 3, 1).otherwise(0)).alias("expected"), F.lit("c1").alias("commit"), F.when(kind == 4, "c1").otherwise("c9").alias("live_commit"), F.when(kind == 5, "live").otherwise("reviewed-reference-not-live-validated").alias("live_status"),
    )


@query(
    DRIFT_SQL + f""", g AS ({BRANDS}), c AS (SELECT p_brand, count(*) FILTER ({COMMIT} = 'c2') AS other FROM s GROUP BY p_brand), x AS (SELECT DISTINCT p_brand FROM d WHERE drift IS NOT NULL)
    SELECT 'pack-' || g.p_brand AS pack, unnest(list_filter([CASE WHEN kind = 1 THEN 'selector' END, CASE WHEN kind = 2 THEN 'selector matches nothing' END, CASE WHEN kind = 3 THEN 'record count' END, CASE WHEN kind NOT IN (1, 2) AND other > 0 THEN 'source commit' END, CASE WHEN kind = 5 THEN 'reference status' END,
     CASE WHEN kind NOT IN (1, 2) AND x.p_brand IS NULL THEN 'drift without a difference' END, CASE WHEN kind = 4 THEN 'drift without another commit' END], lambda r: r IS NOT NULL)) AS rule FROM g LEFT JOIN c USING (p_brand) LEFT JOIN x USING (p_brand)"""
)
def provider_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What packs declare of their records against what their selectors take."""
    own = packs(spark, sf_dir)
    taken = drift.select_pack(state(spark, sf_dir, "s").withColumn("commit", F.expr(COMMIT)), own, ["p_brand", "p_type"])
    brand = table(spark, sf_dir, "part").select(K, F.concat(F.lit("pack-"), "p_brand").alias("pack"))
    return drift.pack_faults(own, taken.select("pack", K, "commit"), K, drifted(spark, sf_dir).join(brand, K))


#: measure, unit, scope, least, greatest, by the line's number.
SPECIFICATIONS = [("m1", "calls", "task", None, 40.0), ("m2", "tokens", "task", 2.0, None), ("m3", "seconds", "run", None, None), ("m4", "characters", "run", 0.0, 45.0)]
LINE = "l_linenumber % 5 + 1"
M = {
    "value": "CASE WHEN l_partkey % 11 = 3 THEN NULL WHEN l_partkey % 13 = 4 THEN CAST('NaN' AS DOUBLE) WHEN l_partkey % 17 = 5 THEN -1.0 ELSE CAST(l_quantity AS DOUBLE) END", "minimum": "CASE WHEN l_partkey % 19 = 6 THEN 30.0 END",
    "maximum": "CASE WHEN l_partkey % 19 = 6 THEN CAST(l_suppkey % 60 AS DOUBLE) END", "exact": "CASE l_suppkey % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END",
    "unit": f"CASE WHEN l_partkey % 23 = 7 THEN 'other' ELSE CASE {LINE} WHEN 1 THEN 'calls' WHEN 2 THEN 'tokens' WHEN 3 THEN 'seconds' ELSE 'characters' END END", "scope": f"CASE WHEN l_partkey % 29 = 8 THEN NULL WHEN {LINE} <= 2 THEN 'task' ELSE 'run' END",
    "source": "CASE WHEN l_partkey % 31 = 9 THEN ' ' WHEN l_partkey % 5 = 1 THEN 'An Estimate' ELSE 'log' END",
}


@query(
    "WITH m AS (SELECT l_orderkey AS run, 'm' || (" + LINE + ") AS measure, " + ", ".join(f"{v} AS {c}" for c, v in M.items()) + " FROM lineitem), s(measure, unit2, scope2, least, greatest) AS (VALUES "
    + ", ".join(f"('{m}', '{u}', '{s}', {'NULL' if a is None else a}::DOUBLE, {'NULL' if b is None else b}::DOUBLE)" for m, u, s, a, b in SPECIFICATIONS)
    + """) SELECT run, measure, unnest(CASE WHEN unit2 IS NULL THEN ['unregistered measure'] ELSE list_filter([CASE WHEN exact IS NULL THEN 'exact flag' END, CASE WHEN exact AND (value IS NULL OR minimum IS NOT NULL OR maximum IS NOT NULL) THEN 'exact value' END, CASE WHEN trim(source) = '' THEN 'source' END,
     CASE WHEN exact AND lower(source) LIKE '%estimat%' THEN 'estimate called exact' END, CASE WHEN unit <> unit2 THEN 'unit' END, CASE WHEN scope IS DISTINCT FROM scope2 THEN 'scope' END, CASE WHEN isnan(value) OR value < 0 OR value < least OR value > greatest THEN 'value' END,
     CASE WHEN minimum < 0 OR minimum < least OR minimum > greatest THEN 'minimum' END, CASE WHEN maximum < 0 OR maximum < least OR maximum > greatest THEN 'maximum' END, CASE WHEN minimum > maximum THEN 'range' END], lambda x: x IS NOT NULL) END) AS rule FROM m LEFT JOIN s USING (measure)"""
)
def telemetry_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements of runs that break their measure's specification; of the fifth measure there is none."""
    own = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("run"), F.concat(F.lit("m"), F.expr(LINE).cast("string")).alias("measure"), *(F.expr(v).alias(c) for c, v in M.items()))
    return telemetry.measurement_faults(own.withColumns({c: F.col(c).cast("double") for c in ("value", "minimum", "maximum")}), spark.createDataFrame(SPECIFICATIONS, telemetry.SPECIFICATION))

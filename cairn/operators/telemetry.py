"""Rules on measurements, held as data: a specification of each measure is a row, and a join applies it to long measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators.validate import violations
from cairn.scratch import broadcast_if

#: A measure's unit, scope and bounds; bounds may be null.
SPECIFICATION = "measure string, unit string, scope string, least double, greatest double"


def measurement_faults(measurements: DataFrame, specifications: DataFrame, key: str = "run") -> DataFrame:
    """(key, measure, rule) for measurements (key, measure, value, minimum, maximum, exact, unit, scope, source).

    An exact measurement has one value and no range, and its source doesn't speak of an estimate. Numbers are finite, not negative and within the measure's bounds. A measure without a
    specification breaks that rule alone. A value may be missing where it isn't exact.
    """
    specs = specifications.select("measure", F.struct("unit", "scope", "least", "greatest").alias("spec"))
    rows = measurements.join(broadcast_if(specs, 10_000, cheap=True), "measure", "left").withColumn("place", F.struct(key, "measure"))
    known, exact = F.col("spec").isNotNull(), F.coalesce("exact", F.lit(False))

    def fits(name: str) -> Column:
        x = F.col(name)
        bounded = F.coalesce(x >= F.col("spec.least"), F.lit(True)) & F.coalesce(x <= F.col("spec.greatest"), F.lit(True))
        return x.isNull() | ~F.isnan(x) & (F.abs(x) != float("inf")) & (x >= 0) & bounded

    ranged = F.col("minimum").isNotNull() | F.col("maximum").isNotNull()
    text = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    rules = {
        "unregistered measure": known, "exact flag": ~known | F.col("exact").isNotNull(), "exact value": ~known | ~exact | F.col("value").isNotNull() & ~ranged, "source": ~known | text("source"),
        "estimate called exact": ~known | ~exact | ~F.coalesce(F.lower("source").contains("estimat"), F.lit(False)), "unit": ~known | F.col("unit").eqNullSafe(F.col("spec.unit")), "scope": ~known | F.col("scope").eqNullSafe(F.col("spec.scope")),
        "value": ~known | fits("value"), "minimum": ~known | fits("minimum"), "maximum": ~known | fits("maximum"), "range": ~known | F.coalesce(F.col("minimum") <= F.col("maximum"), F.lit(True)),
    }
    return violations(rows, "place", rules).select(f"place.{key}", "place.measure", "rule")

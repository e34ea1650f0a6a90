from __future__ import annotations

import pytest

from cairn.operators import broker
from cairn.operators.validate import orphans, reachable, secret_kinds
from cairn.sources.records import records

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("query", "code"), [("sk-abcdefghijklmnopqrst", "PROHIBITED_INPUT"), ("the of", "INVALID_ARGUMENT")])
def test_refusals(spark, query, code):
    with pytest.raises(broker.Refused) as e:
        broker.search(records(spark, SF, "suppliers"), query)
    assert e.value.code == code


def test_identities(spark):
    own = records(spark, SF, "parts", "suppliers")
    assert broker.resolve(own, "SUPPLIERS:1") == "suppliers:1"
    for identifier, code in (("nothing", "NOT_FOUND"), ("1", "AMBIGUOUS")):
        with pytest.raises(broker.Refused) as e:
            broker.resolve(own, identifier)
        assert e.value.code == code
    with pytest.raises(broker.Refused):
        broker.guard({"x": [{"Chain-of-Thought": 1}]})
    assert len(broker.hydrate(own, "parts:1").first().binding_sha256) == 64


def test_cycles_orphans_and_secrets(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a")], "node string, needs string")
    assert {r.node for r in reachable(edges).where("node = needs").collect()} == {"a", "b", "c"}
    child, parent = spark.createDataFrame([(1, 2), (3, None), (4, 9)], "k int, p int"), spark.createDataFrame([(2,)], "id int")
    assert [r.k for r in orphans(child, parent, "p", "id").collect()] == [4]
    rows = spark.createDataFrame([("api_key: abcdefghijklmnop",), ("/tmp/x",), ("fine",)], "t string")
    from pyspark.sql import functions as F

    assert [r[0] for r in rows.select(secret_kinds(F.col("t"))).collect()] == [["authorization"], ["local_path"], []]

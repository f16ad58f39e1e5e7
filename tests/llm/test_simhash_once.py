from skeinworks.llm import simhash
from skeinworks.llm.common import Scratch


def test_fingerprints_are_dealt_once(spark, monkeypatch):
    """Above ``SHARD`` what is counted for splitting is what is searched, not made again."""
    monkeypatch.setattr(simhash, "SHARD", 40)
    prints = spark.createDataFrame([(i * 7 << (i % 50),) for i in range(1, 90)], "print long").distinct()
    links = simhash.link_prints(prints, Scratch(spark, "once"))
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation [shard" in plan and "LogicalRDD" not in plan

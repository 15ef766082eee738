"""A small batch upserted into a large table shuffles only the stored rows it names."""

from __future__ import annotations

from pyspark.sql.types import LongType, StringType, StructField, StructType

from noticelake.operators.reconcile import STATUS, reconcile
from noticelake.schemas import PARTITION
from noticelake.sinks.keyed import KeyedTable

SCHEMA = StructType([StructField("k", StringType()), StructField("x", LongType()), StructField(PARTITION, StringType())])


def _children(node):
    return [node.children().apply(i) for i in range(node.children().size())]


def _unions(node):
    found = [node] if node.nodeName() == "Union" else []
    return found + [u for child in _children(node) for u in _unions(child)]


def test_stored_rows_the_batch_does_not_name_are_not_shuffled(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), merge_fields=True)
    stored = [(f"k{i}", i, "2020") for i in range(200)] + [(None, -1, "2020")]
    spark.createDataFrame(stored, SCHEMA).write.partitionBy(PARTITION).parquet(table.path)
    batch = spark.createDataFrame([("k3", None, "2020"), ("k7", 70, "2020"), ("new", 1, "2021"), (None, 5, "2020")], SCHEMA)
    current = table.read()
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        outcome = table._outcome(current, batch.persist())
        plan = outcome._jdf.queryExecution().executedPlan()
        unions = _unions(plan)
        kept = _children(unions[0])[1].toString() if unions else "Exchange"
        assert "Exchange" not in kept.replace("BroadcastExchange", "").replace("ReusedExchange", "")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    whole = reconcile(current, batch, ("k",), merge_fields=True, before=table._before())
    got = sorted(outcome.collect(), key=lambda r: (r["k"] or "", r[STATUS]))
    assert got == sorted(whole.collect(), key=lambda r: (r["k"] or "", r[STATUS]))
    assert len(got) == 202


def test_a_large_batch_is_shuffled_once(spark, tmp_path, monkeypatch):
    """above SMALL_BATCH the join's shuffle is the only one; the outcome is not moved again by partition."""
    from noticelake.sinks import keyed

    monkeypatch.setattr(keyed, "SMALL_BATCH", 0)
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), merge_fields=True)
    stored = [(f"k{i}", i, "2020") for i in range(50)] + [(None, -1, "2021")]
    spark.createDataFrame(stored, SCHEMA).write.partitionBy(PARTITION).parquet(table.path)
    batch = spark.createDataFrame([("k3", None, "2020"), ("k7", 70, "2021"), ("new", 1, "2021"), (None, 5, "2020")], SCHEMA)
    current = table.read()
    outcome = table._outcome(current, batch.persist())
    # a rebalance is planned only where adaptive execution is on, as it is here
    assert "RebalancePartitions" not in outcome._jdf.queryExecution().optimizedPlan().toString()
    whole = reconcile(current, batch, ("k",), merge_fields=True, before=table._before())
    got = sorted(outcome.collect(), key=lambda r: (r["k"] or "", r[STATUS]))
    assert got == sorted(whole.collect(), key=lambda r: (r["k"] or "", r[STATUS]))
    assert len(got) == 52

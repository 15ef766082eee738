"""The pipeline's stages on a small table, and registration."""

from __future__ import annotations

import __spark_entry__
import corpus_pipeline
from tests.llm.fixtures import CLASHING, SCHEMA, awkward, prose, rows
from tests.llm.test_scans import ITEMS, secrets


def test_stages(spark, tmp_path):
    shout = " ".join(w.upper() + "!!" for w in prose(5, 120).split())
    texts = awkward() + [(i, prose(1000 + i, 150)) for i in range(200, 240)] + [(300 + k, shout + f" W{k}!!") for k in range(8)]
    texts += [(400, prose(2, 100) + " " + prose(50, 25) + " " + prose(3, 100)), (401, prose(77, 150) + " " + secrets()[0][1]), (402, prose(210 + 1000, 150))]
    folder = str(tmp_path)
    spark.createDataFrame(rows(texts), SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, ids = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, folder)
        result.write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        ids[name] = {r["doc_id"] for r in docs.select("doc_id").distinct().collect()}
        if number < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *CLASHING]
        if name == "secret_scan":
            text = docs.where("doc_id = 401").first()["text"]
            assert "[secret]" in text and secrets()[0][1][12:30] not in text
    assert set(range(200, 240)) <= ids["quality_rules"] and not ids["quality_rules"] & set(range(300, 308)) and not ids["quality_rules"] & {4, 5, 8, 17}
    assert 402 not in ids["near_dedup"] and {210, 1} <= ids["near_dedup"] and 2 not in ids["near_dedup"]
    assert ids["decontamination"] == ids["near_dedup"] - {400}
    assert ids["packing"] == ids["secret_scan"] == ids["decontamination"]
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, whole.select("doc_id", "piece", "ids_crc32").collect())) == sorted(map(str, docs.select("doc_id", "piece", "ids_crc32").collect()))


def test_registration():
    names = [n for n in __spark_entry__.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

"""The pipeline against a plain version of its stages."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from folioframe.llm import decontaminate, queries, secrets, simhash, toxicity
from folioframe.llm.common import written


def test_stages_are_kept_and_whole(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    names, now = [], docs
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        names.append(name)
        after = written(stage(spark, now, sf_dir), name)
        rows = {r["doc_id"]: r for r in after.collect()}
        if name == "toxicity":
            weights = toxicity.fit(now, queries.table(spark, sf_dir, "labels"))
            model = toxicity.Model(weights, toxicity.Ftrl())
            kept = {d: t for d, t in kept.items() if 1 / (1 + np.exp(-model(t))) < 0.3}
        elif name == "simhash_near_dedup":
            ids = sorted(kept)
            fps = np.array([simhash.fingerprint(kept[d]) for d in ids], np.uint64)
            root = list(range(len(ids)))
            for i in range(len(ids)):
                for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 3).tolist():
                    a, b = i, j
                    while root[a] != a:
                        a = root[a]
                    while root[b] != b:
                        b = root[b]
                    root[max(a, b)] = min(a, b)
            kept = {d: kept[d] for i, d in enumerate(ids) if root[i] == i}
        elif name == "benchmark_decontamination":
            items = [(r["item_id"], r["text"]) for r in queries.table(spark, sf_dir, "benchmark").collect()]
            gone = {d for d, _ in decontaminate.brute_force(list(kept.items()), items)}
            kept = {d: t for d, t in kept.items() if d not in gone}
        elif name == "secret_scans":
            spans = {r["doc_id"]: r["found"] for r in secrets.findings(now).collect()}
            assert {d for d in kept if rows[d]["text"] != kept[d]} == {d for d, s in spans.items() if s}
            kept = {d: rows[d]["text"] for d in kept}
        else:
            assert all(r["decoded_equal"] and r["n_pieces"] == len(r["ids"]) for r in rows.values())
        assert set(rows) == set(kept), name
        if name != "sentencepiece":
            assert after.columns == docs.columns and all(rows[d]["text"] == kept[d] for d in kept)
        now = after
    assert names == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "sentencepiece"]


@pytest.mark.parametrize("keep", [0, 1])
def test_empty_and_odd(spark, sf_dir, keep):
    docs = queries.table(spark, sf_dir, "documents").filter(F.lit(bool(keep)) & (F.col("doc_id") < 3))
    if keep:
        docs = docs.unionByName(docs.select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "lang", "source", "n_chars").limit(1)).withColumn("component_id", F.lit("x"))
    n = docs.count()
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() <= n and (keep == 0 or docs.count() > 0)

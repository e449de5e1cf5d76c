"""The corpus pipeline, stage by stage, against brute force on what each stage was given."""

import re

from tests.llm.data import SF, no_docs, odd_docs
from tests.llm.test_joins import brute_components, brute_items


def test_stages(spark, tmp_path):
    import corpus_pipeline

    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = ({r["doc_id"]: r for r in before.collect()}, {r["doc_id"]: r for r in docs.collect()})
        if name != "mixing":
            assert docs.columns == columns
    given, kept = seen["ngram_join"]
    _, component = brute_components([(d, r["text"]) for d, r in given.items()])
    assert set(kept) == set(component.values())
    given, kept = seen["decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {d for d, _ in brute_items([(d, r["text"]) for d, r in given.items()], items)}
    assert set(given) - set(kept) == leaks
    given, kept = seen["pii"]
    assert set(given) == set(kept)
    assert not any(re.search(r"[a-z0-9]@[a-z0-9-]+\.[a-z]", r["text"]) for r in kept.values())
    assert all(r["n_chars"] == len(r["text"]) for r in kept.values())
    given, kept = seen["mixing"]
    assert set(kept) <= set(given) and all(0 < r["taken"] <= 2 * r["size"] for r in kept.values())


def test_stages_on_odd_and_no_rows(spark):
    import corpus_pipeline

    for docs in (odd_docs(spark), no_docs(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            out.count()
            if name != "mixing":
                assert out.columns == docs.columns

"""The pipeline, stage by stage, on the given tables."""

import corpus_pipeline
from farelake.llm import jaccard, mixing, quality
from farelake.llm.common import table
from tests.llm.test_jaccard import plain as plain_components
from tests.llm.test_mixing import plain_targets

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_copies", "source_mix", "packing"]
    kept = corpus_pipeline.quality_rules(spark, docs, SF).cache()
    verdicts = {r["doc_id"]: r["kept"] for r in quality.quality_verdicts(docs, table(spark, SF, "labels")).collect()}
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, k in verdicts.items() if k)

    once = corpus_pipeline.near_copies(spark, kept, SF).cache()
    assert once.columns == docs.columns
    groups = plain_components([(r["doc_id"], r["text"]) for r in kept.collect()])
    assert sorted(r["doc_id"] for r in once.collect()) == sorted({c for _, _, c in groups})

    mix = corpus_pipeline.source_mix(spark, once, SF).cache()
    assert mix.columns == docs.columns
    sizes, held = {}, {}
    for r in once.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(r["text"].split())
    for r in mix.collect():
        held[r["source"]] = held.get(r["source"], 0) + len(r["text"].split())
    longest = max(len(r["text"].split()) for r in once.collect())
    for source, target in plain_targets(sizes).items():
        assert abs(held.get(source, 0) - target) <= longest / 2 + 1

    packed = corpus_pipeline.packing_batches(spark, mix, SF).collect()
    assert sorted(r["doc_id"] for r in packed) == sorted(r["doc_id"] for r in mix.collect())


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    again = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))
    assert mixing.BLOCK and jaccard.THRESHOLD == 75


def test_stages_give_memory_back(spark, monkeypatch):
    """Every stage has the driver collect what the one before took; near copies also do between their steps."""
    asked = []
    for module in (corpus_pipeline, jaccard):
        monkeypatch.setattr(module, "collected", lambda s, name=module.__name__: asked.append(name) or s)
    docs = table(spark, SF, "documents").limit(20)
    for name, stage in corpus_pipeline.STAGES:
        asked.clear()
        stage(spark, docs, SF).count()
        assert asked[0] == "corpus_pipeline" and asked.count("farelake.llm.jaccard") == 2 * (name == "near_copies")

"""The pipeline's stages on a small table: what goes, what stays."""

import corpus_pipeline
from corpus import edited, prose
from metricloom.llm import pii
from metricloom.session import work_dir


def test_stages(spark):
    base = prose(1, 200).replace("0", "")
    rows = [(i, prose(10 + i, 150).replace("0", ""), "en", f"src{i % 4}") for i in range(30)]
    rows += [(100, base, "en", "src0"), (101, edited(base, 2, 2), "en", "src0"), (102, "short", "en", "src0"),
             (103, prose(900, 100).replace("0", "") + " mail a.b@mail.example.com", "en", "src1"), (104, None, None, None)]
    item = prose(77, 60).replace("0", "")
    rows.append((105, item + " " + prose(78, 100).replace("0", ""), "en", "src2"))
    folder = work_dir(spark, "test-pipeline")
    full = [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, docs, folder), name)
        if name != "mixture":
            assert out.columns == docs.columns
        kept[name], docs = {r["doc_id"]: r["text"] for r in out.collect()}, out
    assert not {102, 104} & set(kept["quality_rules"]) and 100 in kept["quality_rules"]
    assert 100 in kept["near_duplicates"] and 101 not in kept["near_duplicates"]
    assert 105 not in kept["decontamination"]
    assert set(kept["decontamination"]) >= set(range(30)) & set(kept["quality_rules"])
    assert "a.b@" not in kept["pii_surrogates"][103] and pii.mentions(kept["pii_surrogates"][103])
    assert set(kept["mixture"]) <= set(kept["pii_surrogates"])

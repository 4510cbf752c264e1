import subprocess
import sys
import textwrap
from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline
from transitlab.llm import language_id, ngram_join, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen[-1], SF).cache()
        assert out.columns == docs.columns and out.count() <= seen[-1].count()
        seen.append(out)
    identified, clean, single, redacted = seen[1:]
    found = {r["doc_id"]: r for r in language_id.language_spans(docs, language_id.train(docs)).collect()}
    assert {r["doc_id"] for r in identified.collect()} == {i for i, r in found.items() if r["lang_pred"] != "und" and r["score"] >= 0.3}
    scored = {r["doc_id"]: r["score"] for r in toxicity.toxicity(identified, toxicity.train(identified, labels)).collect()}
    assert {r["doc_id"] for r in clean.collect()} == {i for i, s in scored.items() if s < 0.5}
    near = ngram_join.similar_documents(clean).collect()
    assert {r["doc_id"] for r in single.collect()} == {r["class_id"] for r in near}
    assert {r["n_links"] for r in ngram_join.similar_documents(single).collect()} == {0}
    before, after = ({r["doc_id"]: r["text"] for r in d.collect()} for d in (single, redacted))
    assert before.keys() == after.keys() and not any("@mail" in t for t in after.values())
    packed = corpus_pipeline.STAGES[-1][1](spark, redacted, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(after)
    total = packed.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in total) <= 1024


CLASHING = ["_t", "_base", "_spans", "_new", "_cand", "_row", "_hash", "_id", "keeper_id", "keeper_hash", "_copies", "_ids", "cls", "component"]


def test_clashing_columns_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).cache()
    wide = docs.select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in CLASHING])
    plain, extra = docs, wide
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, extra = stage(spark, plain, SF).cache(), stage(spark, extra, SF).cache()
        assert extra.columns == wide.columns, name
        assert sorted(map(tuple, extra.select(docs.columns).collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr), name
        assert all(r[c] == f"{c}{r['doc_id']}" for r in extra.collect() for c in CLASHING), name
    assert corpus_pipeline.STAGES[-1][1](spark, extra, SF).count() == corpus_pipeline.STAGES[-1][1](spark, plain, SF).count()
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name


def test_library_works_without_the_operators():
    root = Path(__file__).resolve().parents[2]
    code = textwrap.dedent("""
        import sys
        class Gone:
            def find_spec(self, name, path=None, target=None):
                if name == "corpus_pipeline" or name.startswith("transitlab.llm"):
                    raise ModuleNotFoundError(name, name=name)
        sys.meta_path.insert(0, Gone())
        import __spark_entry__ as e
        assert len(e.queries()) > 50 and not any(k.startswith("op") for k in e.queries()) and "pipeline" not in e.queries()
        assert set(e.oracle_sql()) <= set(e.queries())
    """)
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_registered_names():
    import __spark_entry__ as e
    numbers = sorted(int(k[2:].split("_")[0]) for k in e.queries() if k.startswith("op") and k[2].isdigit())
    assert numbers == list(range(1, 14)) and "pipeline" in e.queries()

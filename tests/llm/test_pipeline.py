"""The pipeline's stages against the operators' brute-force meaning, and the registration guard."""
import os
import re
import subprocess
import sys

import corpus_pipeline
from tablework.llm import pii

from ..conftest import SF_SMALL
from .test_clean import base_spans
from .test_similar import brute_classes, brute_fp
from .test_tokens import check_packed

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = corpus_pipeline.staged(stage(spark, docs, SF_SMALL), "test-stage")
        results[name] = docs
        if name == "packing":
            check_packed([r.asDict() for r in docs.collect()], {d: r["text"] for d, r in before.items()})
            continue
        assert docs.columns == columns
        after = {r["doc_id"]: r for r in docs.collect()}
        if name == "toxicity":
            labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
            gone = before.keys() - after.keys()
            assert gone and sum(labels.get(d, 1) for d in gone) >= 0.8 * len(gone)
            assert all(after[d] == before[d] for d in after)
        elif name == "near_duplicates":
            fps = {d: brute_fp(r["text"]) for d, r in before.items()}
            sets = brute_classes(set(fps.values()))
            first = {}
            for d in sorted(before):
                first.setdefault(sets.root(fps[d]), d)
            assert after.keys() == set(first.values()) and all(after[d] == before[d] for d in after)
        else:
            assert after.keys() == before.keys()
            for d, r in after.items():
                assert r["n_chars"] == len(r["text"])
                if not base_spans(before[d]["text"]) and r["text"] == before[d]["text"]:
                    continue
                kinds = set(re.findall(r"\[([A-Z_]+)\]", r["text"]))
                assert {k.upper() for k, _, _ in base_spans(before[d]["text"])} <= kinds
    assert list(results) == ["toxicity", "near_duplicates", "personal_data", "packing"]


def test_stages_stand_odd_rows(spark, clashing):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, clashing, SF_SMALL).columns == clashing.columns
        assert stage(spark, clashing.limit(0), SF_SMALL).count() == 0


def test_entry_without_the_subpackage():
    """The other queries stay when this subpackage and the pipeline cannot be imported."""
    code = ("import sys; sys.modules['tablework.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e; q = e.queries(); print(len(q) > 150, any(n.startswith('op') for n in q), 'pipeline' in q)")
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.stdout.split()[-3:] == ["True", "False", "False"], done.stderr[-500:]


def test_all_operators_are_registered():
    sys.path.insert(0, ROOT)
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(names)
    assert pii.KINDS[:4] == ("email", "ip", "card", "phone")

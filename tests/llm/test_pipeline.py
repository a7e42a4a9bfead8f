"""Pipeline stages on sf0.001, and the entry without the subpackage."""

import subprocess
import sys

from conftest import SF_SMALL

CODE = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith(("tabforge.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert "preprocess" in e.queries() and not any(k.startswith("op") or k == "pipeline" for k in e.queries())
"""


def test_entry_without_subpackage():
    subprocess.run([sys.executable, "-c", CODE], check=True, cwd=__file__.rsplit("/tests/", 1)[0])


def test_stages(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, kept = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in cp.STAGES:
        out = cp.cut_lineage(stage(spark, docs, SF_SMALL), "t")
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert ids <= kept
        if name != "bpe_codec":
            assert out.columns == columns
        docs, kept = out, ids
    assert docs.columns == ["doc_id", "n_tokens", "input_ids", "decoded_sha256"] and docs.count() > 0

"""The pipeline's stages on planted cases, and the package's place in the library."""

import os
import random
import subprocess
import sys

from helpers import DOCS, prose

import corpus_pipeline
from casefeatures.sources.files import shared_folder

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_planted_cases(spark, tmp_path):
    rng = random.Random(8)
    language = {"en": "the and of that with is to in for on", "de": "der und die das mit ist zu ein auf von"}
    clean = [(i, " ".join(rng.choice(language["en" if i % 2 else "de"].split()) + f" q{'abcdefgh'[rng.randrange(8)]}{'klmnop'[rng.randrange(6)]}{'abcdefgh'[rng.randrange(8)]}" for _ in range(60)), "en" if i % 2 else "de", f"s{i % 2}", 0) for i in range(40)]
    passage = prose(rng, 60, 10**6).replace("w", "the ")
    item = "every good boy does fine and some more words follow here"
    rows = clean + [(100, clean[0][1], "de", "s0", 0), (101, clean[0][1] + " end", "de", "s0", 0), (102, "12 34", "en", "s0", 0), (103, None, "en", "s0", None)]
    rows += [(104, clean[1][1][:150] + " " + passage, "en", "s1", 0), (105, clean[3][1][:200] + " " + passage, "en", "s1", 0), (106, clean[5][1][:200] + " " + item, "en", "s1", 0)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "suffix_dedup", "decontamination", "source_mixing"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = {r[0] for r in clean}
    assert set(seen["language_id"]) == ids | {100, 101, 104, 105, 106}
    assert set(seen["jaccard_join"]) == ids | {104, 105, 106}
    assert passage in seen["suffix_dedup"][104] and passage not in seen["suffix_dedup"][105]
    assert all(seen["suffix_dedup"][i] == t for i, t, *_ in clean)
    assert set(seen["decontamination"]) == ids | {104, 105}
    assert set(seen["source_mixing"]) <= ids | {104, 105}
    shared = shared_folder(spark)
    before = set(os.listdir(shared))
    out = corpus_pipeline.run(spark, str(tmp_path))
    left = {n for n in set(os.listdir(shared)) - before if any(files for _, _, files in os.walk(f"{shared}/{n}"))}
    assert sorted(n.rsplit("-", 1)[0] for n in left) == sorted(n for n, _ in corpus_pipeline.STAGES)  # the stages' rows only
    assert {r["doc_id"] for r in out.collect()} <= ids | {104, 105}
    assert out.columns == DOCS.replace(" long", "").replace(" string", "").split(", ")


def test_nothing_else_imports_the_package():
    """Without the two folders and the pipeline the entry still gives the other queries."""
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name.startswith('casefeatures.llm') or name == 'corpus_pipeline': raise ImportError(name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 100 and not any(n.startswith('op') or n == 'pipeline' for n in e.queries())\n"
        "assert not any(n.startswith('op') for n in e.oracle_sql())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_registered():
    import __spark_entry__ as e

    names = [n for n in e.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in e.queries()
    assert set(e.oracle_sql()) <= set(e.queries())

from __future__ import annotations

import corpus_pipeline
from obsengine.llm import queries
from obsengine.llm.common import documents

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = documents(spark, SMALL)
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        docs = out.checkpoint()
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    assert docs.where("n_chars <> length(text)").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert pieces.select("doc_id").distinct().count() == sizes[-1]


def test_names():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_stages_bound_the_bytes_of_a_batch(spark):
    """A stage called by itself gets long texts in batches of a few MB."""
    import pyarrow as pa

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "64m")
    try:
        docs = spark.range(3000).selectExpr("id doc_id", "repeat('word ', 2000) text").coalesce(1)
        corpus_pipeline.quality(spark, docs, SMALL)

        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

        found = docs.mapInArrow(sizes, "n long, size long").collect()
        assert sum(r["n"] for r in found) == 3000
        assert max(r["size"] for r in found) < 6 << 20
    finally:
        spark.conf.set(key, old)


def test_an_encoder_starts_no_threads():
    """A task has one core; the library's threads would each keep memory."""
    import os
    import subprocess
    import sys

    code = """
import os
import pyarrow as pa
from obsengine.llm import queries, tokens
before = len(os.listdir("/proc/self/task"))
e = tokens.Encoder(queries.tokenizer_file(queries.WORD_BPE), False)
e.encode(pa.array([" ".join(f"w{i}x{i * 7}" for i in range(20000))]))
print(len(os.listdir("/proc/self/task")) - before)
"""
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    env["PYTHONPATH"] = os.pathsep.join([root, env.get("PYTHONPATH", "")])
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert out.stdout.strip() == "0", out.stdout + out.stderr

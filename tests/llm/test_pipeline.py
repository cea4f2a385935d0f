"""The pipeline against its stages one by one in plain Python, and the guard of the entry point."""

import hashlib
import re
import subprocess
import sys

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from entity360.llm import toxicity
from tests.llm.cases import FOLDER, documents, empty
from tests.llm.test_near_dedup import _expected


def test_pipeline_keeps_what_its_stages_keep(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    rows = [(i, t) for i, t in documents(spark) if model.scores(model.features(t)[None])[0] < 0.5]
    first = {}
    for i, t in rows:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), (i, t))
    rows = sorted(first.values())
    least = {}
    for row, root in zip(rows, _expected(rows)[1], strict=True):
        least[root] = min(row, least.get(root, row))
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    rows = sorted(r for r in least.values() if not any(x in r[1] for x in items))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, t in rows:
        ids = library.encode(t, add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()))
    got = corpus_pipeline.run(spark, FOLDER).select("doc_id", "n_tokens", "ids_sha256").collect()
    assert sorted(tuple(r) for r in got) == want


def test_stages_keep_the_columns_of_their_input(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("text_key", docs_key())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns, name
        assert stage(spark, empty(spark), FOLDER).count() == 0, name


def docs_key():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_entry_point_works_without_the_subpackage():
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not any(n.startswith('op') for n in e.queries())\n"
        "assert 'pipeline' not in e.oracle_sql()"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=corpus_pipeline.__file__.rsplit("/", 1)[0])

import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from holdfast.llm.common import table
from tests.llm.test_decontamination import brute as leaks_of
from tests.llm.test_near_copies import brute_kept as kept_of
from tests.llm.test_passages import brute as cut
from tests.llm.test_quality_rules import brute as measures_of

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before each stage and after the last, as lists of rows."""
    docs, out = table(spark, SMALL, "documents"), []
    out.append(docs.collect())
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("p") / str(k))
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
    return out


def test_columns_and_names(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "repeated passages", "benchmark leaks", "encoding"]
    for rows in stages[:5]:
        assert rows[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality(stages, spark):
    kept = {r.doc_id for r in stages[1]}
    bad = {r.doc_id for r in table(spark, SMALL, "labels").where("quality = 0").collect()}
    for r in stages[0]:
        n, _, _, _, repeated = measures_of(r.text)
        if n < 50 or 100 * repeated > 50 * n:
            assert r.doc_id not in kept
        elif r.doc_id not in bad:
            continue
        else:
            assert r.doc_id not in kept
    assert len(kept) > 0.6 * len(stages[0])


def test_near_duplicates(stages):
    """One document stays of each chain of pairs that share four fifths of their five-word shingles."""
    assert sorted(r.doc_id for r in stages[2]) == kept_of([(r.doc_id, r.text) for r in stages[1]])


def test_repeated_passages(stages):
    """Repeated runs of 51 words and repeated strings of 400 bytes go, whole characters at a time."""
    want = cut(r.text for r in stages[2])
    assert {r.doc_id: r.text for r in stages[3]} == {r.doc_id: t for r, t in zip(stages[2], want)}
    assert all(r.n_chars == len(r.text) for r in stages[3])


def test_leaks_and_encoding(stages, spark):
    items = [(r.item_id, r.text) for r in table(spark, SMALL, "benchmark").collect()]
    clean = [r for r in stages[3] if not leaks_of(r.text, items)]
    assert sorted(r.doc_id for r in stages[4]) == sorted(r.doc_id for r in clean)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by = {r.doc_id: r for r in stages[5]}
    for r in stages[4]:
        ids = np.array(library.encode(r.text, add_special_tokens=False).ids, "<u4")
        assert by[r.doc_id].n_tokens == len(ids) and by[r.doc_id].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert by[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_odd_rows(spark):
    base = table(spark, SMALL, "documents")
    odd = base.limit(40).withColumn("text", F.when(F.col("doc_id") % 5 == 0, F.lit(None)).otherwise(F.col("text")))
    odd = odd.unionByName(odd).withColumn("doc_id", F.when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise(F.col("doc_id")))
    odd = odd.withColumn("fp", F.lit("x")).withColumn("spans", F.lit(1))
    for docs in (odd, base.limit(0).withColumn("row", F.lit(1))):
        for name, stage in corpus_pipeline.STAGES[:4]:
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns, name
            out.collect()
        corpus_pipeline.encoding(spark, docs, SMALL).collect()


def test_workers_give_back_what_others_hold():
    from holdfast.llm import common
    from holdfast.llm.bpe_trie import TrieBPE

    TrieBPE.held["made"] = object()
    assert list(common.lean(iter, "bpe")([1, 2])) == [1, 2] and "made" in TrieBPE.held
    assert list(common.lean(iter)([3])) == [3] and not TrieBPE.held

"""The corpus pipeline, each stage against a brute-force version on its own input."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.test_operators import plain_components
from tickline.llm import bpe
from tickline.llm.common import setup, stage


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output of every stage on a small table with edge rows and clashing columns."""
    setup(spark)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("copies", F.lit("clash")).withColumn("_id", F.lit(1.5))
    some = docs.limit(4).withColumn("doc_id", F.col("doc_id") + 10_000)
    near = docs.limit(3).withColumn("doc_id", F.col("doc_id") + 20_000).withColumn("text", F.concat("text", F.lit(" one more")))
    odd = spark.createDataFrame([(30_000, None), (30_001, ""), (30_002, "12 !! 34"), (None, "La maison de la rue est le lieu dans les mots que vous avez")], "doc_id long, text string")
    for c, t in docs.dtypes[2:]:
        odd = odd.withColumn(c, F.lit(None).cast(t))
    now = stage(docs.unionByName(some).unionByName(some.limit(1)).unionByName(near).unionByName(odd.select(docs.columns)), "pipeline-in")
    found = [now]
    for name, step in cp.STAGES:
        now = stage(step(spark, now, "unused"), f"pipeline-{name}")
        found.append(now)
    return found


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_all_but_the_last_stage_keep_the_columns(steps):
    assert len(cp.STAGES) == 5 and all(df.columns == steps[0].columns for df in steps[:-1])


def test_language_drops_texts_without_letters_only(steps):
    gone = Counter(rows(steps[0])) - Counter(rows(steps[1]))
    assert gone == Counter([(30_000, None), (30_001, ""), (30_002, "12 !! 34")])


def test_language_keeps_letters_when_no_language_is_known(spark, steps):
    docs = steps[0].withColumn("lang", F.lit(None).cast("string"))
    gone = Counter(rows(docs)) - Counter(rows(cp.language(spark, docs, "unused")))
    assert gone == Counter([(30_000, None), (30_001, ""), (30_002, "12 !! 34")])


def test_stages_take_very_long_and_strange_texts(spark, steps):
    strange = "Η γλώσσα αυτή δεν είναι γνωστή στο μοντέλο"
    more = spark.createDataFrame([(40_000, "das Haus und die Zeit " * 40_000), (40_001, strange)], "doc_id long, text string")
    for c, t in steps[0].dtypes[2:]:
        more = more.withColumn(c, F.lit(None).cast(t))
    now = stage(steps[0].unionByName(more.select(steps[0].columns)), "pipeline-in")
    for name, step in cp.STAGES:
        now = stage(step(spark, now, "unused"), f"pipeline-{name}")
        if name == "language":
            assert {r.doc_id for r in now.where("doc_id >= 40000").collect()} == {40_000}
    assert now.where("doc_id = 40000").count() >= 0


def test_exact_keeps_the_largest_id_of_each_text(steps):
    top = {}
    for i, t in rows(steps[1]):
        top[t] = max(top.get(t, -1), -1 if i is None else i)
    assert Counter((i if i is not None else -1, t) for i, t in rows(steps[2])) == Counter((i, t) for t, i in top.items())


def test_near_keeps_the_smallest_id_of_each_component(steps):
    before = rows(steps[2])
    stay = Counter()
    groups = {}
    for (i, _), (_, n, comp) in zip(before, plain_components(before, 5, 80, 100)):
        groups.setdefault((comp, i if comp is None else None), []).append(i)
    for (comp, own), _ in groups.items():
        stay[comp if comp is not None else own] += 1
    assert Counter(i for i, _ in rows(steps[3])) == stay
    assert len(before) - len(rows(steps[3])) >= 2


def test_mix_takes_whole_rows_up_to_three_times(steps):
    before, after = Counter(rows(steps[3])), Counter(rows(steps[4]))
    assert set(after) <= set(before) and max(after.values()) <= 3


def test_encode_is_the_public_encoding_and_decodes_back(steps):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = bpe.parse_ranks(f.read())
    import tiktoken
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for i, t in rows(steps[4]):
        ids = enc.encode_ordinary(t)
        want[i, len(ids), np.asarray(ids, "<u4").tobytes(), hashlib.sha256(t.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded_sha256) for r in steps[5].collect()) == want


def test_an_empty_table_goes_through(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for name, step in cp.STAGES:
        docs = stage(step(spark, docs, "unused"), f"empty-{name}")
    assert docs.count() == 0

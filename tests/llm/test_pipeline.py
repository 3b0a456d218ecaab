"""Each stage against what it promises, on the smallest tables."""

import os

import corpus_pipeline as pipeline
import pytest
from test_mixing import simulated
from test_ngram_join import grams
from test_pii import far_from_values, with_terms

from tidemark.llm import bpe, pii, queries, toxicity

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after each stage, in the order of the files."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, step in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        step(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return df.collect()


def test_all_but_the_last_return_the_columns_of_documents(stages):
    assert [len(pipeline.STAGES), *{tuple(s.columns) for s in stages[:-1]}] == [5, tuple(stages[0].columns)]


def test_toxic_documents_go(spark, stages):
    scores = {r.doc_id: r.score for r in queries.op10_toxicity(spark, SF).collect()}
    want = sorted(r.doc_id for r in rows(stages[0]) if scores[r.doc_id] < toxicity.TOXIC)
    assert sorted(r.doc_id for r in rows(stages[1])) == want


def test_one_of_each_group_stays(stages):
    before, after = rows(stages[1]), {r.doc_id for r in rows(stages[2])}
    sets = [grams(r.text, 5) for r in before]
    root = list(range(len(before)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * (s := len(a & sets[j])) >= 80 * (len(a) + len(sets[j]) - s):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(before):
        least[find(i)] = min(least.get(find(i), r.doc_id), r.doc_id)
    assert after == set(least.values())


def test_personal_data_is_generalised(stages):
    before = sorted(rows(stages[2]), key=lambda r: r.doc_id)
    after = {r.doc_id: r.text for r in rows(stages[3])}
    for r, spans in zip(before, with_terms([r.text for r in before])):
        out, at = "", 0
        for start, kind, end in spans:
            if start >= at:
                out += r.text[at:start] + f"[{pii.KINDS[kind].upper()}]"
            at = max(at, end)
        assert after[r.doc_id] == out + r.text[at:]


def test_sources_follow_their_shares(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert sorted(r.doc_id for r in before) == sorted(r.doc_id for r in after)
    n = {s: sum(r.source == s for r in after) for s in queries.MIXTURE}
    blocks = {s: -(-n[s] // 16) for s in n}
    order = [s for s, b in simulated(blocks, queries.MIXTURE) for _ in range(min(16, n[s] - 16 * b))]
    assert [r.source for r in after] == order


def test_tokens_decode_to_the_text(stages):
    decoded = bpe.decode(stages[5], queries.TOKENIZER)
    assert decoded.where("decoded != text or ids is null").count() == 0


def test_run_gives_the_rows_of_the_stages(spark, stages):
    got = sorted((r.doc_id, r.text, tuple(r.ids)) for r in pipeline.run(spark, SF).collect())
    assert got == sorted((r.doc_id, r.text, tuple(r.ids)) for r in rows(stages[5]))


def test_run_keeps_the_mixture_over_several_files(spark, stages):
    """The position orders the rows of run() as the mixture does, whatever order files are read in."""
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        got = sorted(pipeline.run(spark, SF).collect(), key=lambda r: r.position)
    finally:
        spark.conf.set(coalesce, before)
    assert [r.position for r in got] == list(range(len(got)))
    assert [r.doc_id for r in got] == [r.doc_id for r in rows(stages[4])]
    n = {s: sum(r.source == s for r in got) for s in queries.MIXTURE}
    blocks = {s: -(-n[s] // 16) for s in n}
    order = [s for s, b in simulated(blocks, queries.MIXTURE) for _ in range(min(16, n[s] - 16 * b))]
    assert [r.source for r in got] == order


def test_repeated_and_null_rows_pass_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(5)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "src0", 0), (1, "", "en", "src0", 0)], docs.schema)
    for name, step in pipeline.STAGES:
        out = step(spark, docs.union(odd), SF)
        assert out.where("text is null").count() == 1 and out.where("text = ''").count() == 2, name


def test_terms_far_from_their_value_are_generalised(spark):
    rows = [(i, t, "src0", "en") for i, t in enumerate(far_from_values())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r.doc_id: r.text for r in pipeline.sanitise(spark, docs, SF).collect()}
    far = " 12" * 40
    assert [got[i] for i in range(3)] == [f"[TERM], [TERM]{far} [EMAIL]", f"[EMAIL]{far} [TERM]", "only [TERM] and [TERM] here"]

from pathlib import Path

import pytest

import corpus_pipeline
from opsmart.llm import bpe, mixing
from opsmart.llm.common import stored, table

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF).exists(), reason="supplied tables not present")
def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    sizes = [len(before)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] >= sizes[2] == sizes[3] == sizes[4] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == sizes[-1]
    assert corpus_pipeline.run(spark, SF).count() == sizes[-1]


def test_an_empty_table_passes(spark, tmp_path):
    for name in ("documents", "labels"):
        table(spark, SF, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_the_mix_reaches_the_result(spark):
    rows = [(i, f"text number {i}", "big" if i % 10 else "small", "en", 9) for i in range(700)]
    rows += [(None, "no id", "small", "en", 5), (None, None, None, "en", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    mixed = stored(corpus_pipeline.mixing_order(spark, docs, ""), "mixed")
    out = corpus_pipeline.tokens(spark, mixed.repartition(3, "text"), "").collect()
    want = {r.doc_id: r for r in mixing.mixed(docs).collect() if r.doc_id is not None}
    assert sorted(r.position for r in out) == list(range(702))
    for r in out:
        if r.doc_id is not None:
            assert (r.source, r.position, r.in_ratio) == (want[r.doc_id].source, want[r.doc_id].position, want[r.doc_id].in_ratio)
    plain = {r.doc_id: r for r in bpe.digests(docs).collect()}
    assert all(r[1:-3] == plain[r.doc_id][1:] for r in out if r.doc_id is not None)
    first = [r.source for r in sorted(out, key=lambda r: r.position)[:200]]
    assert first.count("small") >= mixing.BLOCK  # about 20 in raw proportions

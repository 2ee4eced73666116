from collections import Counter

import pytest

import corpus_pipeline
from histora.llm.decontaminate import MATCH, align, plain_words
from histora.llm.quality import quality_scores
from histora.llm.surrogates import mentions
from tests.llm.test_neardup import brute
from tests.llm.test_packing import check_places


@pytest.fixture(scope="module")
def stages(spark, folder, documents, tmp_path_factory):
    """What goes into and comes out of each stage, written and read again."""
    docs, found = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, folder).write.parquet(path)
        out = spark.read.parquet(path)
        found[name] = docs, out
        docs = out
    return found


def test_order_and_columns(stages, documents):
    assert list(stages) == ["quality", "near_dedup", "decontaminate", "pii", "packing"]
    for name in list(stages)[:-1]:
        assert stages[name][1].columns == documents.columns


def pairs(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_quality_keeps_what_the_operator_accepts(spark, folder, stages):
    docs, out = stages["quality"]
    good = {r.doc_id for r in quality_scores(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect() if r.predicted}
    assert pairs(out) == Counter({k: n for k, n in pairs(docs).items() if k[0] in good})


def test_near_dedup_keeps_one_of_each_group(stages):
    docs, out = stages["near_dedup"]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {k[0] for k in pairs(out)} == {n for n, _, c in brute(rows) if n == c}


def test_decontaminate_drops_what_holds_an_item(spark, folder, stages):
    docs, out = stages["decontaminate"]
    items = [plain_words(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    left = {k[0] for k in pairs(out)}
    for r in docs.collect():
        words = plain_words(r.text)
        holds = any(2 * align(i, words)[0] >= MATCH * len(i) for i in items)
        assert holds == (r.doc_id not in left)


def test_pii_changes_entities_only(stages):
    docs, out = stages["pii"]
    old, new = ({r.doc_id: r for r in x.collect()} for x in (docs, out))
    assert set(old) == set(new)
    real = {(k, e) for r in old.values() for _, _, k, e in mentions(r.text)}
    for n, r in new.items():
        assert not real & {(k, e) for _, _, k, e in mentions(r.text)}
        assert r.n_chars == len(r.text) if mentions(old[n].text) else r.text == old[n].text


def test_packing_places_all(stages):
    docs, out = stages["packing"]
    check_places(out.collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_run_gives_the_last_stage(spark, folder, stages):
    key = lambda r: (r.doc_id, r.piece, r.length, r.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, folder).collect())) == sorted(map(key, stages["packing"][1].collect()))


def test_odd_rows(spark, folder, odd_rows):
    """Nulls, empty and repeated rows go through every stage; an empty table too."""
    docs = odd_rows
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name != "quality":
            docs = stage(spark, docs, folder)
            assert docs.columns == odd_rows.columns
    kept = Counter(r.doc_id for r in docs.collect())
    assert kept == Counter([0, 1, 2, 3, 4, 4, 6, None])
    assert sum(r.length for r in corpus_pipeline.packing(spark, docs, folder).collect()) > 8
    assert corpus_pipeline.quality(spark, odd_rows, folder).count() <= odd_rows.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd_rows.limit(0), folder).collect() == []

import os

from pyspark.sql import functions as F

import corpus_pipeline as cp
from tessera.llm import quality
from tessera.llm.catalog import NOT_HELD_OUT
from tessera.llm.common import table, text_hash

from .test_line_dedup import brute as brute_lines
from .test_decontaminate import brute as brute_leaks
from .test_packing import whole_ids
from .test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    stages = dict(cp.STAGES)
    assert [n for n, _ in cp.STAGES] == ["quality", "line_dedup", "near_dedup", "decontaminate", "pack"]

    good = stages["quality"](spark, docs, SF).cache()
    model = quality.fit(docs, table(spark, SF, "labels"), F.expr(NOT_HELD_OUT.format("doc_id", 5)))
    want = {r.doc_id for r in quality.score_quality(docs, model).collect() if r.score >= 0.3}
    assert {r.doc_id for r in good.collect()} == want and good.columns == docs.columns

    lines = stages["line_dedup"](spark, good, SF).cache()
    rows = [tuple(r) for r in good.select("doc_id", text_hash("text"), "text").collect()]
    assert sorted(((r.doc_id, r.text) for r in lines.collect()), key=str) == brute_lines(rows)

    near = stages["near_dedup"](spark, lines, SF).cache()
    rows = [(r.doc_id, r.text) for r in lines.orderBy("doc_id").collect()]
    classes = plain_components([plain_fingerprint(t) for _, t in rows])
    assert sorted(r.doc_id for r in near.collect()) == sorted({min(i for (i, _), c in zip(rows, classes) if c == k) for k in set(classes)})

    clean = stages["decontaminate"](spark, near, SF).cache()
    before = {r.doc_id: r.text for r in near.collect()}
    after = {r.doc_id: r.text for r in clean.collect()}
    for i, t in before.items():
        n, hit, _ = brute_leaks(t, items, 10)
        assert (i in after) == (hit <= 0.5 * n)
        if i in after:
            assert after[i] == t if not hit else brute_leaks(after[i], items, 10)[1] == 0
    assert any(brute_leaks(t, items, 10)[1] for t in before.values())

    packed = stages["pack"](spark, clean, SF).collect()
    for i, t in after.items():
        pieces = sorted((r.start, r.ids) for r in packed if r.doc_id == i)
        assert [x for _, ids in pieces for x in ids] == whole_ids(t)


def test_run_equals_its_stages(spark):
    docs = table(spark, SF, "documents")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
    key = ["doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert sorted(map(tuple, cp.run(spark, SF).select(key).collect())) == sorted(map(tuple, docs.select(key).collect()))


def test_odd_documents_pass_through(spark, tmpdir_fresh):
    from .conftest import ODD

    docs = spark.createDataFrame([(i, t, "en", None, 1, "x") for i, t in ODD], "doc_id long, text string, lang string, source string, n_chars long, h string")
    for name in ("labels", "benchmark"):
        table(spark, SF, name).write.parquet(os.path.join(tmpdir_fresh, f"{name}.parquet"))
    for rows in (docs, docs.limit(0)):
        df = rows
        for name, stage in cp.STAGES:
            df = stage(spark, df, tmpdir_fresh).cache()
            assert df.columns == docs.columns or name == "pack"
        assert (df.count() > 0) == (rows.count() > 0)


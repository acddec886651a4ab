import pytest
from pyspark.sql import functions as F

from tessera.llm import quality
from tessera.llm.common import table

from .conftest import ODD

LEARN = "crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0"


def auc(rows):
    good, bad = [s for s, y in rows if y], [s for s, y in rows if not y]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels")
    out = quality.score_quality(docs, quality.fit(docs, labels, F.expr(LEARN)))
    rows = [(r.score, r.quality) for r in out.join(labels, "doc_id").filter(~F.expr(LEARN)).select("score", "quality").collect()]
    assert len(rows) > 500 and auc(rows) > 0.95
    assert sum(s >= 0.3 for s, y in rows if y) > 0.97 * sum(y for _, y in rows)   # clean documents stay
    assert sum(s < 0.3 for s, y in rows if not y) > 0.6 * sum(1 - y for _, y in rows)


def test_odd_rows_get_scores(spark, docs_of):
    docs = docs_of(ODD + [(100 + i, f"a fine text number {i} " * 9) for i in range(40)] + [(200 + i, f"###!! {i} %%" * 9) for i in range(40)])
    labels = spark.createDataFrame([(100 + i, 1) for i in range(40)] + [(200 + i, 0) for i in range(40)] + [(200, 1), (None, 1), (3, None), (999, 1)],
                                   "doc_id long, quality int")
    model = quality.fit(docs, labels, F.lit(True))
    out = quality.score_quality(docs, model)
    got = out.collect()
    assert len(got) == len(ODD) + 80 and all(0 <= r.score <= 1 for r in got) and out.columns.count("score") == 1
    mean = {k: sum(r.score for r in got if r.doc_id and r.doc_id // 100 == k) / 40 for k in (1, 2)}
    assert mean[1] > 0.8 > 0.2 > mean[2]
    assert quality.score_quality(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("rows,want", [([], 0.5), ([(4, 1)], 1.0), ([(4, 0), (5, 0)], 0.0)])
def test_without_one_of_the_classes(spark, docs_of, rows, want):
    docs = docs_of(ODD)
    model = quality.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int"), F.lit(True))
    assert {r.score for r in quality.score_quality(docs, model).collect()} == {want}

"""The pipeline's stages against brute force, each on what its predecessor kept."""

import collections

import corpus_pipeline as P
from stratum.llm import line_dedup as L
from tests.llm.test_line_dedup import expected
from tests.llm.test_near_dedup import brute

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    stages = dict(P.STAGES)
    assert list(stages) == ["quality classifier", "line dedup", "MinHash near-dedup", "best-fit packing"]

    kept = P.written(stages["quality classifier"](spark, docs, SF), "test")
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    wrong = [d for d, q in labels.items() if (d in ids) != (q == 1)]
    assert len(wrong) < 0.02 * len(labels) and not [d for d in wrong if labels[d] == 1]

    lines = P.written(stages["line dedup"](spark, kept, SF), "test")
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted((r.doc_id, r.text) for r in lines.collect()) == sorted((d, t) for d, t, *_ in expected(rows, 10))
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    single = P.written(stages["MinHash near-dedup"](spark, lines, SF), "test")
    texts = sorted((r.doc_id, r.text) for r in lines.collect())
    comp = brute([t for _, t in texts])
    assert sorted(r.doc_id for r in single.collect()) == sorted({texts[c][0] for c in comp})

    packed = stages["best-fit packing"](spark, single, SF).toPandas()
    words = {r.doc_id: len(r.text.split(None)) for r in single.collect()}
    assert packed.groupby("doc_id")["n_tokens"].sum().to_dict() == {d: n for d, n in words.items() if n}
    assert (packed.groupby("bin_id")["n_tokens"].sum() <= packed.groupby("bin_id")["bin_capacity"].first()).all()


def test_a_rerun_takes_the_same_documents(spark):
    def run():
        return collections.Counter((r.doc_id, r.piece, r.n_tokens) for r in P.run(spark, "/root/testdata/sf0.001").collect())

    assert run() == run()


def test_line_keys_of_the_pipeline_are_those_of_the_operator():
    assert L.keys_sql("x").startswith("transform(")


def test_stages_on_odd_rows_and_empty_tables(spark):
    text = "one two three four five six seven"
    rows = [(1, text), (1, text), (None, text), (2, None), (2, None), (None, None), (3, ""), (4, "\n \n"), (5, "word " * 30_000), (6, "a\nb"), (6, "c d")]
    docs = spark.createDataFrame([(i, t, None, None, None, "x", "y", 1) for i, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint, __score string, __print string, bin_id int")
    stages = dict(P.STAGES)

    kept = stages["quality classifier"](spark, docs, "/root/testdata/sf0.001")
    assert kept.columns == P.DOCUMENT
    first = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    assert not first - collections.Counter(rows) and len({first[1, text], 2 * first[None, text]}) == 1  # equal texts share their fate

    lines = stages["line dedup"](spark, docs, "")
    assert lines.columns == P.DOCUMENT and all(r.n_chars == len(r.text or "") for r in lines.collect())
    assert collections.Counter((r.doc_id, r.text or "") for r in lines.collect()) == collections.Counter((i, t or "") for i, t in rows)

    single = P.written(stages["MinHash near-dedup"](spark, docs, ""), "test")
    got = collections.Counter((r.doc_id, r.text or "") for r in single.collect())
    assert single.columns == P.DOCUMENT
    assert got == collections.Counter({(1, text): 1, (2, ""): 1, (None, ""): 1, (3, ""): 1, (4, "\n \n"): 1, (5, "word " * 30_000): 1, (6, "a\nb"): 1, (6, "c d"): 1})

    packed = stages["best-fit packing"](spark, docs, "").toPandas()
    assert packed["n_tokens"].sum() == 3 * 7 + 30_000 + 4 and packed["doc_id"].isna().sum() == 1

    for name, stage in P.STAGES:
        empty = stage(spark, docs.limit(0), "/root/testdata/sf0.001")
        assert empty.count() == 0 and (name == "best-fit packing" or empty.columns == P.DOCUMENT)

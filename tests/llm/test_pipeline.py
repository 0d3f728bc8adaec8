import corpus_pipeline
from voxloom.llm.bpe import encode_documents
from voxloom.llm.queries import RANKS, tokenizer_path


def test_stages_each_on_what_the_one_before_kept(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "lines", "near_duplicates", "mixing", "bpe"]
    sizes = []
    from voxloom.llm.common import store

    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = store(stage(spark, before, sf), "test")
        assert after.columns == docs.columns
        sizes.append((before.count(), after.count()))
        if name == "toxicity":
            gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()}
            assert all(labels.get(i, 1) == 1 for i in gone)
        if name == "lines":
            assert sizes[-1][0] == sizes[-1][1]
        if name == "near_duplicates":
            assert sizes[-1][1] < sizes[-1][0] and after.select("doc_id").distinct().count() == after.count()
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, before, sf)
    assert last.count() == sizes[-1][1]
    want = encode_documents(before, tokenizer_path(RANKS)).agg({"n_tokens": "sum"}).first()[0]
    assert last.agg({"n_tokens": "sum"}).first()[0] == want


def test_nulls_repeats_clashing_columns_and_empty_tables(spark, sf, docs, rows, empty):
    """Through the whole chain: columns stay, whatever their names, and nothing is lost but by a stage's rule."""
    before = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf)
        assert after.schema == docs.schema
        before = spark.createDataFrame(after.collect(), docs.schema)
    assert 0 < before.count() <= 2 * len(rows)
    assert corpus_pipeline.STAGES[-1][1](spark, before, sf).count() == before.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, sf).count() == 0


def test_stages_by_brute_force(spark, sf):
    """Lines and near duplicates on documents of the tables: no line repeats, no two texts left are near copies."""
    from .test_lines import normal
    from .test_similar import shingles

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.lines_stage(spark, docs, sf)
    forms = [s for r in kept.collect() for x in (r.text or "").split("\n") if (s := normal(x))]
    assert len(forms) == len(set(forms)) and kept.count() == docs.count()
    few = corpus_pipeline.near_duplicates_stage(spark, docs, sf).collect()
    sets = [shingles(r.text) for r in few]
    for i, a in enumerate(sets):
        for b in sets[:i]:
            assert min(len(a), len(b)) < 0.8 * max(len(a), len(b)) or 100 * len(a & b) < 80 * len(a | b)

import corpus_pipeline
from chunkspark.llm.packing import vocabulary_path
from chunkspark.session import read_table
from tokenizers import Tokenizer


def test_stages_keep_columns_and_pack_what_is_left(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = docs.sparkSession.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
        assert docs.columns == read_table(spark, sf_dir, "documents").columns, name
        assert 0.5 * before < docs.count() <= before
    rows = docs.collect()
    assert all(r.n_chars == len(r.text) for r in rows)
    library = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    tokens = sum(len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in rows)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert sum(p.length for p in pieces) == tokens
    ran = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((p.doc_id, p.start, p.doc_tokens) for p in ran if p.start == 0) == sorted((p.doc_id, p.start, p.doc_tokens) for p in pieces if p.start == 0)


def test_stages_of_odd_rows(spark):
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (None, "some words here", None, None, None), (3, "some words here", "en", "s", 15), (3, "some words here", "en", "s", 15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for data in (docs, docs.filter("false")):
        at = data
        for _, stage in corpus_pipeline.STAGES:
            at = stage(spark, at, "")
        assert at.count() == (1 if data is docs else 0)

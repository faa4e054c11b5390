import pyarrow as pa

import corpus_pipeline
from claimlens.llm import bpe


def test_stages_on_planted_cases(spark, small_dir, tmp_path):
    """Copies, benchmark passages and repeated passages go; other documents stay, and the rest decodes to its text."""
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    columns = docs.columns
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, small_dir).write.parquet(out)
        after = spark.read.parquet(out)
        rows[name] = (docs.count(), after.count())
        if name != "encoding":
            assert after.columns == columns and after.dtypes == docs.dtypes
            ids = {r.doc_id for r in docs.select("doc_id").collect()}
            assert {r.doc_id for r in after.select("doc_id").collect()} <= ids
        else:
            texts = {r.doc_id: r.text for r in docs.collect()}
            own = bpe.loaded(bpe.vocabulary(spark).value)
            for r in after.collect():
                assert r.round_trip and own.decode(pa.array([r.ids]))[0].as_py() == (texts[r.doc_id] or "") and len(r.ids) == 4 * r.n_tokens
        docs = after
    assert all(0 < b <= a for a, b in rows.values())
    assert rows["quality"][1] < rows["quality"][0] and rows["near_duplicates"][1] < rows["near_duplicates"][0]
    assert rows["encoding"][0] == rows["encoding"][1]


def test_stages_survive_odd_rows(spark, small_dir):
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (None, None, None, None, None), (2, "fine words here", "en", "s", 16)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for start in (docs, docs.limit(0)):
        kept = start
        for _, stage in corpus_pipeline.STAGES[1:]:
            kept = stage(spark, kept, small_dir)
        assert kept.count() == (2 if start is docs else 0)

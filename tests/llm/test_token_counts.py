import public_tokenizers
from tokenizers import Tokenizer

from claimlens.llm import token_counts

ROWS = [(1, None), (2, ""), (None, "a b"), (4, "it's  two\n\nspaces <|endoftext|> the end"), (4, "the the the"), (4, "the the the"), (5, "unusualword " * 900)]


def test_equals_library(spark, monkeypatch, small_dir):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.createDataFrame([(*r, 0) for r in ROWS], "doc_id long, text string, n_tokens int")
    want = sorted([(str(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS])
    for share in (2.0**-21, 0.2, 2.0):  # all hot, some, none
        monkeypatch.setattr(token_counts, "HOT_SHARE", share)
        got = token_counts.count_tokens(docs).select("doc_id", "n_bytes", "n_tokens").collect()
        assert sorted((str(r[0]), r[1], r[2]) for r in got) == want
    assert token_counts.count_tokens(docs.limit(0)).count() == 0


def test_query_equals_library(spark, small_dir):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for d in spark.read.parquet(f"{small_dir}/documents.parquet").join(token_counts.op7_token_counts(spark, small_dir), "doc_id").collect():
        n = len(library.encode(d.text, add_special_tokens=False).ids)
        assert (d.n_bytes, d.n_tokens, d.over_limit) == (len(d.text.encode()), n, n > 512)

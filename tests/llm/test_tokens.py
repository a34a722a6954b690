from __future__ import annotations

import random

import pytest

from framewright.llm.queries import p8_ids, p8_stitched_ids
from framewright.llm.tokens import decode_ids, encode_corpus, encode_text, vocabulary

PATH = vocabulary("byte_bpe_50k")


def reference():
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


@pytest.mark.parametrize("chunk, overlap", [(200_000, 2_000), (37, 11), (5, 3)])
def test_chunked_equals_whole(spark, chunk, overlap):
    rnd = random.Random(3)
    pool = ["hello", " ", "  ", "\n\n", "你好，世界", "don't", "I'll", "123", "!!", "<|endoftext|>", "é", "🔥", "\t", "_" * 9, "ﬁ", "\n\n", "\x1c", "\x85", " \n "]
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 90))) for _ in range(40)] + ["", " ", "a" * 300, " " * 200, None]
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(0, texts[0], "x"), (None, "null key", "x")]
    got = {r.doc_id: list(r.ids) for r in encode_corpus(spark.createDataFrame(rows, "doc_id long, text string, k string"), "doc_id", "text", PATH, chunk, overlap).collect()}
    ref = reference()
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        want = ref.encode(t, add_special_tokens=False).ids if t else []
        assert got[k] == want, (k, t)
        assert decode_ids(got[k], PATH) == (t or "")


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert encode_corpus(df, "doc_id", "text", PATH).count() == 0
    assert encode_text("", PATH) == []


def test_stitched_documents_have_the_same_ids(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert docs.filter("length(text) > 500").count() > 10
    one, other = ({r.doc_id: list(r.ids) for r in q(spark, sf_dir).collect()} for q in (p8_ids, p8_stitched_ids))
    assert one == other and len(one) == docs.select("doc_id").distinct().count()

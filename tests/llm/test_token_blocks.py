"""Token counts by dictionaries of blocks equal the library's, also where blocks are tiny."""

from __future__ import annotations

import public_tokenizers
import pytest

from lethe.llm.token_counts import CountParameters, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize(
    "p", [CountParameters(), CountParameters(frequent=0, dictionary_bytes=500, numbers_bytes=1_000)]
)
def test_counts_equal_the_library(spark, documents, odd, p):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=MODEL)
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    rows += [tuple(r) for r in odd.select("doc_id", "text").collect()]
    # texts without spaces are one pre-token each, and the same one twice
    rows += [(70, "日本語" * 20_000), (71, "日本語" * 20_000), (72, "x" * 70_000), (73, "a\n" * 9_000), (74, "\n\n\nx  \n\n   y \n")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = token_counts(frame, MODEL, parameters=p).collect()
    want = [(i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in rows]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)
    assert token_counts(frame.where("false"), MODEL).collect() == []

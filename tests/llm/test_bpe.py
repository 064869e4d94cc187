from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers as P
import pytest

from tidemark.llm import bpe

RANKS = P.path("byte_bpe_50k.tiktoken")
TEXTS = [
    "", "Hello world's  end\n\n x", "a" * 3000, "é　ü  x\x1cy\x85z", "<|endoftext|> no special",
    "word " * 9000, "ab" * 60_000, "x" + " " * 90_000 + "y", "1 2\n" * 20_000, "🎉 emoji 漢字" * 3000,
]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_pieces_change_nothing(text):
    whole = bpe.encoder(RANKS, P.PATTERN)[0].encode_ordinary(text)
    assert bpe.encode(text, RANKS, P.PATTERN) == whole
    assert bpe.decode(whole, RANKS, P.PATTERN) == text.encode()
    assert "".join(bpe.pieces(text)) == text


def test_run_too_long_for_the_library():
    text = "x" + " " * 1_000_000 + "\t" * 5 + "y"
    ids = bpe.encode(text, RANKS, P.PATTERN)
    assert bpe.decode(ids, RANKS, P.PATTERN) == text.encode()
    coding = bpe.encoder(RANKS, P.PATTERN)[0]
    runs = ["x", " " * 1_000_000 + "\t" * 4, "\t", "y"]
    assert ids == [i for r in runs for i in coding._encode_single_piece(r)]


def test_documents(spark):
    rows = [(i, t, 7) for i, t in enumerate(TEXTS)] + [(None, None, 1), (0, "", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = bpe.digest_documents(df, RANKS, P.PATTERN).collect()
    coding = bpe.encoder(RANKS, P.PATTERN)[0]
    want = []
    for doc_id, text, _ in rows:
        ids = coding.encode_ordinary(text or "")
        sha = hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        want.append((doc_id, len(ids), sha, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    full = bpe.encode_documents(df, RANKS, P.PATTERN).collect()
    assert sorted((r[0] or -1, bytes(r[2]).decode()) for r in full) == sorted((r[0] or -1, r[1] or "") for r in rows)
    assert bpe.digest_documents(df.limit(0), RANKS, P.PATTERN).count() == 0

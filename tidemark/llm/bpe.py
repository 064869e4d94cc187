"""Byte-level BPE encoding and decoding with a local rank file.

The tiktoken library encodes inside Arrow tasks. Long texts are first cut where the pre-splitting
pattern matches must end anyway, so that the library only ever sees pieces of bounded length.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from tidemark.llm.common import column, whole_text

#: Characters after which a long text is cut at the next safe boundary.
PIECE = 16_384

#: A match of the pattern never holds a non-space followed by white space, and the pattern only looks
#: ahead from white space: so a match ends at each such place, and cutting there changes nothing.
_BOUNDARY = regex.compile(r"(?<=\P{White_Space})(?=[ \n])")


@functools.lru_cache(maxsize=4)
def encoder(rank_file: str, pattern: str) -> tuple[tiktoken.Encoding, regex.Pattern]:
    """The library's encoding, and the same pattern for pieces too long for its regex engine."""
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
    coding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    # White space as Rust defines it.
    own = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
    return coding, own


def pieces(text: str) -> Iterator[str]:
    """Cuts of ``text`` at safe boundaries; a piece is longer than ``PIECE`` only if it has none."""
    at = 0
    while len(text) - at > PIECE:
        cut = _BOUNDARY.search(text, at + PIECE)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def encode(text: str, rank_file: str, pattern: str) -> list[int]:
    """Token ids of a whole text, as the library gives them without special tokens."""
    coding, own = encoder(rank_file, pattern)
    if len(text) <= PIECE:
        return coding.encode_ordinary(text)
    ids: list[int] = []
    for piece in pieces(text):
        if len(piece) <= 4 * PIECE:
            ids.extend(coding.encode_ordinary(piece))
        else:  # one run without a boundary: each match is merged on its own
            for match in own.finditer(piece):
                ids.extend(coding._encode_single_piece(match[0]))
    return ids


def decode(ids: list[int], rank_file: str, pattern: str) -> bytes:
    """The raw bytes of the tokens; they need not be valid UTF-8."""
    return encoder(rank_file, pattern)[0].decode_bytes(ids)


def encode_documents(
    docs: DataFrame,
    rank_file: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, ids, text_bytes``: the tokens of every text and the bytes they decode to.

    One row per input row, in no shuffle. A null text counts as empty and has no tokens; a null id
    stays null; repeated rows are encoded again; other columns are not read. ``rank_file`` must exist
    at the same path on every machine.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                ids = [encode(t, rank_file, pattern) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(ids, pa.list_(pa.int32())),
                        pa.array([decode(x, rank_file, pattern) for x in ids], pa.binary()),
                    ],
                    names=["doc_id", "ids", "text_bytes"],
                )

    rows = docs.select(
        column(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text")
    )
    return rows.mapInArrow(work, "doc_id long, ids array<int>, text_bytes binary")


def digest_documents(
    docs: DataFrame,
    rank_file: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the same encoding and decoding, and ``ids``
    if asked for. Rows as in ``encode_documents``."""
    kinds = [pa.int64(), pa.string(), pa.string()] + [pa.list_(pa.int32())] * with_ids
    names = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                out = []
                for text in part.column("text"):
                    ids = np.asarray(encode(text.as_py(), rank_file, pattern), "<u4")
                    decoded = hashlib.sha256(decode(ids.tolist(), rank_file, pattern))
                    row = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), decoded.hexdigest(), ids.view("<i4"))
                    out.append(row[: len(names)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))],
                    names=["doc_id", *names],
                )

    rows = docs.select(
        column(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text")
    )
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(work, schema + ", ids array<int>" * with_ids)


def _slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, so that the tokens of few texts are in memory at once."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)

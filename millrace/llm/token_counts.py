"""Token counts: texts encoded in batches inside Arrow functions that return lengths only.

Batches are balanced by bytes, not by rows. A long text is split at places no token can cross, so
its parts are counted apart and summed; the sum equals the count of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import appended, bytes_of, fresh, over_batches, runs, text_of, with_columns

#: The word mark of the vocabulary; a space becomes it, and one is put before a text.
MARK = "▁"
#: Bytes encoded by one call, and the size from which a text is split.
BATCH_BYTES, PART_BYTES = 1 << 20, 1 << 16

_loaded: dict[str, tuple] = {}


def _model(path: str):
    """The model and the characters that never merge, loaded once per worker process."""
    if path not in _loaded:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if any(MARK in model.id_to_piece(i).lstrip(MARK) for i in range(model.vocab_size())):
            raise ValueError(f"{path}: tokens cross word marks, so texts have no safe boundaries")
        _loaded.clear()
        _loaded[path] = (model, _stands_alone(model))
    return _loaded[path]


def _stands_alone(model) -> bool:
    """Whether a line feed is outside every merged token, so that a text may be split before it."""
    return not any("\n" in model.id_to_piece(i) for i in range(model.vocab_size())) and len(
        model.encode("a\nb")
    ) == len(model.encode("a")) + len(model.encode("\nb")) - 1


def split_safely(text: str, lines: bool, size: int = PART_BYTES) -> Iterator[tuple[str, int]]:
    """Parts of a text with the tokens that encoding each by itself adds.

    A part begins where a space follows another character: that space turns into the mark that the
    encoder would add anyway, so it is left out. Where the vocabulary has no token with a line feed
    (``lines``), a part may also begin at one; the added mark then is one token too many. A stretch
    without either place stays whole.
    """
    first, extra = 0, 0
    while len(text) - first > size:
        at = _next_break(text, first + size, lines)
        if at < 0:
            break
        yield text[first:at], extra
        first, extra = (at + 1, 0) if text[at] == " " else (at, 1)
    yield text[first:], extra


def _next_break(text: str, at: int, lines: bool) -> int:
    """The first safe place at or after ``at``, or -1."""
    space = text.find(" ", at)
    while space > 0 and text[space - 1] in (" ", MARK):
        space = text.find(" ", space + 1)
    # A part of nothing but the left-out space would lose its token.
    if 0 <= space and (space + 1 == len(text)):
        space = -1
    line = text.find("\n", at) if lines else -1
    found = [p for p in (space, line) if p >= 0]
    return min(found) if found else -1


def count_batch(texts: list[str], path: str) -> list[int]:
    """Tokens of each text, without begin, end or added special tokens."""
    model, lines = _model(path)
    parts, owner, counts = [], [], [0] * len(texts)
    for i, text in enumerate(texts):
        if len(text) <= PART_BYTES:
            parts.append(text)
            owner.append(i)
            continue
        for part, extra in split_safely(text, lines):
            parts.append(part)
            owner.append(i)
            counts[i] -= extra
    sizes = np.array([len(p) for p in parts], np.int64)
    for a, b in runs(sizes, BATCH_BYTES):
        for i, ids in zip(owner[a:b], model.encode(parts[a:b], num_threads=1), strict=True):
            counts[i] += len(ids)
    return counts


def count_tokens(df: DataFrame, path: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """``df`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``path`` names a sentencepiece model every executor can read. Null and empty texts have no bytes
    and no tokens. Repeated rows are counted like any others, an empty table gives no rows, and
    columns that already bear one of the names make the new ones end in an underscore. Memory is
    bounded by one Arrow batch, whatever the length of the table.
    """
    n_bytes, n_tokens, over = fresh(df, "n_bytes", "n_tokens", "over_limit")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_of(batch, text)
            starts = bytes_of(texts)[1]
            sizes = starts[1:] - starts[:-1]
            counts = [0] * len(texts)
            for a, b in runs(sizes, BATCH_BYTES):
                counts[a:b] = count_batch(texts[a:b].to_pylist(), path)
            yield appended(
                batch,
                **{
                    n_bytes: pa.array(sizes, pa.int64()),
                    n_tokens: pa.array(counts, pa.int64()),
                    over: pa.array([c > limit for c in counts], pa.bool_()),
                },
            )

    return over_batches(df, encode, with_columns(df, **{n_bytes: "long", n_tokens: "long", over: "boolean"}))


def op6_token_counts(spark, documents: DataFrame, path: str) -> DataFrame:
    """The operator's counts per document."""
    counted = count_tokens(documents.select("doc_id", "text"), path)
    return counted.select("doc_id", F.col("n_bytes"), F.col("n_tokens"), F.col("over_limit"))

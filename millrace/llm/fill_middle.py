"""Fill-in-the-middle: texts cut at two token borders and written with the middle last.

The token borders of a text form a compressed set (``boundaries``): lists, bitmaps and runs with cumulative
counts. A cut after so many tokens is a search for the container and a selection inside it. Cuts and form
follow from a hash of the row's key alone, so that a task run again gives the same output.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import appended, bytes_of, fresh, over_batches, text_of, with_columns
from millrace.llm.boundaries import BoundarySet

# The marks.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
#: Hundredths of the documents that stay as they are, and of the others that begin with their suffix.
PLAIN, SUFFIX_FIRST = 10, 20
#: Bytes of a text that are looked at together.
BLOCK = 1 << 20

LETTER = np.zeros(256, bool)
LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


class Cutter:
    """Token borders of one text in UTF-8, as code points, and the bytes they stand at.

    A token is a run of letters A-Z, a-z or one other code point.
    """

    def __init__(self, data: np.ndarray):
        self.data = data
        #: First byte of each block, and code points before it.
        self.first, self.points = [0], [0]
        self.ends = BoundarySet(self._blocks())

    def _leads(self, block: int) -> np.ndarray:
        end = self.first[block + 1] if block + 1 < len(self.first) else len(self.data)
        return np.flatnonzero((self.data[self.first[block] : end] & 0xC0) != 0x80)

    def _blocks(self) -> Iterator[np.ndarray]:
        size, at, points = len(self.data), 0, 0
        while at < size:
            end = min(at + BLOCK, size)
            while end < size and (self.data[end] & 0xC0) == 0x80:
                end += 1
            part = self.data[at:end]
            letters = LETTER[part[(part & 0xC0) != 0x80]]
            going_on = np.empty(len(letters), bool)
            going_on[:-1] = letters[1:]
            going_on[-1:] = end < size and LETTER[self.data[end]]
            yield np.flatnonzero(~(letters & going_on)) + (points + 1)
            at, points = end, points + len(letters)
            self.first.append(at)
            self.points.append(points)

    def after(self, tokens: int) -> tuple[int, int]:
        """Code points and bytes of the first ``tokens`` tokens."""
        if tokens == 0:
            return 0, 0
        point = self.ends.select(tokens - 1)
        block = bisect_right(self.points, point) - 1
        if point == self.points[-1]:
            return point, len(self.data)
        return point, self.first[block] + int(self._leads(block)[point - self.points[block]])


def draws(key: str, version: str) -> list[int]:
    """Four numbers below 2^32 from the key."""
    digest = hashlib.sha256(f"{version}:{key}".encode("utf-8", "surrogatepass")).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transformed(text: np.ndarray, key: str, version: str) -> tuple[int, str, int | None, int | None, bytes]:
    """Tokens, form, code points of prefix and middle, and the output for one text in UTF-8."""
    cutter = Cutter(text)
    n = len(cutter.ends)
    data = text.tobytes()
    h1, h2, h3, h4 = draws(key, version)
    if not n or h3 % 100 >= 100 - PLAIN or any(m in data for m in MARKS):
        return n, "plain", None, None, data
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, at), (b, to) = cutter.after(low), cutter.after(high)
    prefix, middle, suffix = data[:at], data[at:to], data[to:]
    p, s, m = MARKS
    if h4 % 100 < SUFFIX_FIRST:
        return n, "spm", a, b - a, s + suffix + p + prefix + m + middle
    return n, "psm", a, b - a, p + prefix + s + suffix + m + middle


def fill_in_middle(df: DataFrame, key: str = "doc_id", text: str = "text", version: str = "1") -> DataFrame:
    """``df`` with ``n`` (tokens), ``form``, ``prefix_chars``, ``middle_chars`` and ``fim``, the text to train on.

    Whole texts are cut, block by block. A null text counts as empty, a null key as an empty one; an empty text
    and one that holds a mark already stay plain, with null lengths. Rows with equal key and text get equal
    results, an empty table gives no rows, and taken column names make the new ones end in an underscore.
    """
    names = fresh(df, "n", "form", "prefix_chars", "middle_chars", "fim")
    kinds = dict(zip(names, ("long", "string", "long", "long", "string"), strict=True))
    (held,) = fresh(df, "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = bytes_of(text_of(batch, text))
            at = batch.schema.get_field_index(held)
            keys = batch.column(at).to_pylist()
            own = pa.RecordBatch.from_arrays(batch.columns[:at], names=batch.schema.names[:at])
            each = [transformed(data[starts[i] : starts[i + 1]], keys[i], version) for i in range(len(keys))]
            n, form, prefix, middle, fim = zip(*each, strict=True) if each else ([], [], [], [], [])
            numbers = [pa.array(c, pa.int64()) for c in (n, prefix, middle)]
            columns = (numbers[0], pa.array(form, pa.string()), numbers[1], numbers[2], pa.array(fim, pa.binary()).cast(pa.string()))
            yield appended(own, **dict(zip(names, columns, strict=True)))

    keyed = df.withColumn(held, F.coalesce(F.col(key).cast("string"), F.lit("")))
    return over_batches(keyed, run, with_columns(df, **kinds))


def restored(fim: str | Column = "fim", form: str | Column = "form") -> Column:
    """The text an output was made from. No mark stands in a text that was cut, so the parts are what lies between marks."""
    fim, form = (F.col(c) if isinstance(c, str) else c for c in (fim, form))
    parts = F.split(fim, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    first, second, third = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return F.when(form == "psm", F.concat(first, third, second)).when(form == "spm", F.concat(second, third, first)).otherwise(fim)


def op11_fill_middle(documents: DataFrame) -> DataFrame:
    """Cuts, forms and digests of all documents."""
    cut = fill_in_middle(documents.select("doc_id", "text"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("fim", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"),
    )

"""Fill-in-middle transformation by block rotations in place.

A text is cut into prefix, middle and suffix at line ends.  The sentinels go
into a bytearray in front of their segments, in the text's own order:
``<P>prefix<M>middle<S>suffix``.  Exchanging the last two blocks gives the form
``psm`` (prefix, suffix, middle), exchanging its first two then gives ``spm``.
Two neighbouring blocks are exchanged by reversing each and then both
together, which needs no second buffer for the text.  The inverse rotations
and the removal of the sentinels restore the text exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import column, id_and_text, numbered, pieces_of, valid_utf8

PREFIX, SUFFIX, MIDDLE = SENTINELS = b"<P>", b"<S>", b"<M>"
SEED = 7
FIM_PERCENT = 100  # share of the texts that are transformed
SPM_PERCENT = 50   # share of the transformed ones that start with the suffix


def _reverse(part: np.ndarray) -> None:
    half = len(part) // 2
    front = part[:half].copy()
    part[:half] = part[len(part) - half:][::-1]
    part[len(part) - half:] = front[::-1]


def rotate(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """Exchange ``buffer[start:middle]`` and ``buffer[middle:end]`` by three reversals."""
    view = np.frombuffer(buffer, np.uint8)
    _reverse(view[start:middle])
    _reverse(view[middle:end])
    _reverse(view[start:end])


def line_ends(raw: bytes) -> np.ndarray:
    """Byte offsets at which the lines of a text end, 0 in front."""
    ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == ord("\n")) + 1
    tail = [len(raw)] if raw and not raw.endswith(b"\n") else []
    return np.concatenate([[0], ends, tail]).astype(np.int64)


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four 32-bit numbers for a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]


def rearranged(raw: bytes, first: int, second: int, form: str) -> bytearray:
    """The text ``raw``, cut at two byte offsets, in ``form``."""
    buffer = bytearray(raw)
    for at, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buffer[at:at] = sentinel
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(buffer, middle, suffix, len(buffer))
    if form == "spm":
        rotate(buffer, 0, middle, middle + len(buffer) - suffix)
    return buffer


def restored(output: bytes, form: str) -> bytes:
    """The text that ``rearranged`` was given."""
    if form == "plain":
        return output
    if form not in ("psm", "spm"):
        raise ValueError(f"unknown form {form!r}")
    buffer = bytearray(output)
    if form == "spm":
        rotate(buffer, 0, buffer.index(PREFIX), buffer.index(MIDDLE))
    suffix, middle = buffer.index(SUFFIX), buffer.index(MIDDLE)
    rotate(buffer, suffix, middle, len(buffer))
    suffix = len(buffer) - (middle - suffix)
    middle = buffer.index(MIDDLE)
    for at, sentinel in ((suffix, SUFFIX), (middle, MIDDLE), (0, PREFIX)):
        del buffer[at:at + len(sentinel)]
    return bytes(buffer)


def transformed(doc_id: int | None, raw: bytes, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
                seed: int = SEED) -> tuple[int, str, int | None, int | None, bytes]:
    """(lines, form, characters of the prefix, those of the middle, output)."""
    ends = line_ends(raw)
    n = len(ends) - 1
    h = draws(doc_id, seed)
    if not raw or h[2] % 100 >= fim_percent or any(s in raw for s in SENTINELS):
        return n, "plain", None, None, raw
    first, second = (int(ends[k]) for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    form = "spm" if h[3] % 100 < spm_percent else "psm"
    return n, form, len(raw[:first].decode()), len(raw[first:second].decode()), bytes(rearranged(raw, first, second, form))


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output: one row per row of ``df``.

    ``n`` counts the lines.  ``form`` is ``psm`` or ``spm``, or ``plain`` where
    the output is the text itself: for an empty or null text, one that holds a
    sentinel, and the share that ``fim_percent`` leaves out.  The lengths are
    in code points, null if plain.  Cuts and form depend on ``seed`` and id
    alone, so rows that repeat an id draw alike; a null id draws as an empty
    one.  Malformed UTF-8 is replaced by U+FFFD first.  Texts of any length are
    cut whole; other columns are ignored, and an empty table gives no rows.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            ids = iter(column(batch, "doc_id"))
            for raws in pieces_of(column(batch, "text")):
                own = list(islice(ids, len(raws)))
                made = [transformed(i, valid_utf8(raw), fim_percent, spm_percent, seed) for i, raw in zip(own, raws)]
                n, form, prefix, middle, output = map(list, zip(*made))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int64()), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()),
                     pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return id_and_text(df, id_col, text_col).mapInArrow(
        batches, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore_middle(df: DataFrame, form_col: str = "form", output_col: str = "output",
                   restored_col: str = "restored") -> DataFrame:
    """``df`` with the text that each output was made from, as ``restored_col`` at the end.

    A null output or form counts as an empty text in plain form.  An unknown
    form raises, and so does an output without the sentinels of its form.
    """
    names, flat = df.columns, numbered(df)
    form, output = f"c{names.index(form_col)}", f"c{names.index(output_col)}"
    inner = [*flat.columns, "restored"]
    raw = flat.withColumn("raw", F.col(output).cast("binary"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            at = 0
            forms = column(batch, form)
            for raws in pieces_of(column(batch, "raw")):
                texts = [restored(valid_utf8(r), f or "plain") for r, f in zip(raws, forms[at:at + len(raws)])]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(at, len(raws)).drop_columns(["raw"]).columns, pa.array(texts, pa.binary()).cast(pa.string())],
                    names=inner)
                at += len(raws)

    made = raw.mapInArrow(batches, StructType([*flat.schema.fields, StructField("restored", StringType())]))
    return made.toDF(*names, restored_col)

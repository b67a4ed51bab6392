"""Fill-in-middle: a text is cut in three and its middle moves behind the rest.

Cuts are drawn in code points and made in bytes.  A sparse exception index holds
only the multibyte characters of a run of texts: the byte where each begins, its
code-point position and the excess bytes up to it.  A position before any
exception is the same number in both; otherwise ``searchsorted`` finds how many
exceptions lie before it and their excess is added or taken away.  ASCII spans
are never looked at, and no text is decoded.

The draws of a document come from the sha256 of ``seed:key``: its first four
groups of eight hex digits.  Two set the cuts, one decides whether the text stays
plain, one the order: psm is prefix, suffix, middle; spm is suffix, prefix, middle.
Markers hold ``<`` at their start and ``>`` at their end only, so none can come
about where a text meets one, and a text that holds one stays plain; that is why
``restored`` gets the text back by splitting at the markers.

Inputs and results that need saying: a null or empty text is plain, with n = 0 and
an empty output; a null key is drawn for as the empty string; one character makes
cuts at 0 and 1; equal rows are rows of their own with equal draws; an empty table
gives no rows; further columns are not looked at.  A row is worked on alone, in
steps of bounded bytes, so a long text costs its own size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKERS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle
STEP_BYTES = 1 << 22  # bytes of texts that one step looks at


class Exceptions:
    """Where code points and bytes part in a run of UTF-8 bytes."""

    def __init__(self, raw: np.ndarray):
        self.lead = np.flatnonzero(raw >= 0xC0)
        first = raw[self.lead]
        excess = 1 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)
        self.before = np.concatenate([[0], np.cumsum(excess)])  # excess bytes of the first i exceptions
        self.place = self.lead - self.before[:-1]

    def points(self, at: np.ndarray) -> np.ndarray:
        """Code points before each byte position; positions are where a character begins, or the end."""
        return at - self.before[np.searchsorted(self.lead, at)]

    def bytes(self, at: np.ndarray) -> np.ndarray:
        """Bytes before each code-point position."""
        return at + self.before[np.searchsorted(self.place, at)]


def _byte_steps(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows, each with ``STEP_BYTES`` bytes at most or a single row."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + STEP_BYTES, side="right")) - 1
        last = max(first + 1, last)
        yield first, last
        first = last


_SCHEMA = "n bigint, form string, prefix_chars bigint, middle_chars bigint, prefix_bytes bigint, middle_bytes bigint, output string"


def _transformed(key: str, markers: tuple[str, str, str], plain_from: int, spm_below: int):
    p, s, m = (x.encode() for x in markers)

    def work(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string())
            marked = np.zeros(len(texts), dtype=bool)
            for marker in markers:
                marked |= pc.match_substring(texts, marker).to_numpy(zero_copy_only=False)
            _, offsets, data = texts.buffers()
            offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
            draws = [batch.column(f"h{i}").to_numpy() for i in range(1, 5)]
            for first, last in _byte_steps(offsets):
                low = int(offsets[first])
                raw = memoryview(data)[low : int(offsets[last])] if data is not None else memoryview(b"")
                index = Exceptions(np.frombuffer(raw, dtype=np.uint8))
                edges = offsets[first : last + 1] - low
                at = index.points(edges)
                n = np.diff(at)
                h1, h2, h3, h4 = (h[first:last] for h in draws)
                one, two = h1 % (n + 1), h2 % (n + 1)
                cut1, cut2 = np.minimum(one, two), np.maximum(one, two)
                byte1, byte2 = index.bytes(at[:-1] + cut1), index.bytes(at[:-1] + cut2)
                plain = (n == 0) | marked[first:last] | (h3 % 100 >= plain_from)
                spm = ~plain & (h4 % 100 < spm_below)
                outputs = []
                for begin, a, b, end, whole, swapped in zip(edges[:-1], byte1, byte2, edges[1:], plain, spm):
                    if whole:
                        outputs.append(bytes(raw[begin:end]))
                    elif swapped:
                        outputs.append(b"".join((s, raw[b:end], p, raw[begin:a], m, raw[a:b])))
                    else:
                        outputs.append(b"".join((p, raw[begin:a], s, raw[b:end], m, raw[a:b])))
                numbers = [cut1, cut2 - cut1, byte1 - edges[:-1], byte2 - byte1]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key).slice(first, last - first), pa.array(n, pa.int64()),
                        pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")).tolist(), pa.string()),
                        *[pa.array(x, pa.int64(), mask=plain) for x in numbers], pa.array(outputs, pa.binary()).cast(pa.string()),
                    ],
                    names=[key, "n", "form", "prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes", "output"],
                )

    return work


def fill_in_middle(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 1,
    plain_from: int = 90,
    spm_below: int = 20,
    markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, prefix_bytes, middle_bytes, output) of each row.

    ``plain_from`` of a hundred are transformed, of these ``spm_below`` of a hundred as spm.
    """
    if any(x[0] != "<" or x[-1] != ">" or len(x) < 3 or set("<>") & set(x[1:-1]) for x in markers) or len(set(markers)) < 3:
        raise ValueError(f"markers have to be three different words in angle brackets: {markers}")
    kind = docs.schema[key].dataType.simpleString()
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    own = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"), *draws)
    return own.mapInArrow(_transformed("key", markers, plain_from, spm_below), f"key {kind}, {_SCHEMA}").withColumnRenamed("key", key)


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text of an output of ``fill_in_middle``."""
    parts = F.split(output, "|".join(re.escape(x) for x in markers), -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)

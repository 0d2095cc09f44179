"""Fill-in-middle transformation of texts as one pyarrow.compute pipeline per batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_slices

#: Marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: A unit: blanks and the word behind them, or the blanks that end a text.
UNIT = "([\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+)"
#: The character that stands behind each unit while a text is split, and the one that escapes both.
BREAK, ESCAPE = b"\x1f", b"\x1e"

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four whole numbers below 2^32 that depend on seed and id alone: the first digits of a SHA-256.

    A null id draws as the empty text.
    """
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.sha2(name.cast("binary"), 256)
    return [F.conv(F.substring(digits, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _escaped(texts: pa.Array) -> tuple[pa.Array, bool]:
    """The texts without the character BREAK, and whether any had to be changed."""
    if not pc.any(pc.match_substring_regex(texts, "[\x1e\x1f]")).as_py():
        return texts, False
    texts = pc.replace_substring(texts, ESCAPE, ESCAPE + b"0")
    return pc.replace_substring(texts, BREAK, ESCAPE + b"1"), True


def _restored_breaks(texts: pa.Array) -> pa.Array:
    return pc.replace_substring(pc.replace_substring(texts, ESCAPE + b"1", BREAK), ESCAPE + b"0", ESCAPE)


def split_units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """All units of a batch of binary texts: flat values, parent rows, ordinals from 0, units per text."""
    marked, changed = _escaped(texts)
    marked = pc.replace_substring_regex(marked, UNIT, "\\1\x1f")
    lists = pc.split_pattern(marked, BREAK)  # each ends with an empty piece behind the last mark
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64) - 1
    parents = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    starts = np.cumsum(counts + 1) - (counts + 1)
    ordinals = np.arange(len(parents)) - starts[parents]
    real = ordinals < counts[parents]
    units = pc.filter(pc.list_flatten(lists), pa.array(real))
    return _restored_breaks(units) if changed else units, parents[real], ordinals[real], counts


def joined(units: pa.Array, parents: np.ndarray, chosen: np.ndarray, rows: int) -> pa.Array:
    """Per row the chosen units, one behind the other."""
    lengths = np.bincount(parents[chosen], minlength=rows)
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
    lists = pa.ListArray.from_arrays(offsets, pc.filter(units, pa.array(chosen)))
    return pc.binary_join(lists, pa.scalar(b"", pa.binary()))


def _chars(texts: pa.Array) -> pa.Array:
    return pc.cast(pc.utf8_length(pc.cast(texts, pa.string())), pa.int64())


def _concatenated(*parts: pa.Array | bytes) -> pa.Array:
    parts = [pa.scalar(p, pa.binary()) if isinstance(p, bytes) else p for p in parts]
    return pc.binary_join_element_wise(*parts, pa.scalar(b"", pa.binary()))


def transformed(texts: pa.Array, cuts: list[np.ndarray], rate: int, suffix_first: int) -> list[pa.Array]:
    """n, form, prefix_chars, middle_chars and output of binary texts; ``cuts`` are the four draws of each."""
    units, parents, ordinals, n = split_units(texts)
    one, other = cuts[0] % (n + 1), cuts[1] % (n + 1)
    first, second = np.minimum(one, other), np.maximum(one, other)
    prefix, middle, suffix = (
        joined(units, parents, chosen, len(n))
        for chosen in (
            ordinals < first[parents],
            (ordinals >= first[parents]) & (ordinals < second[parents]),
            ordinals >= second[parents],
        )
    )
    marked = pc.match_substring_regex(texts, "<[PSM]>").to_numpy(zero_copy_only=False)
    plain = pa.array((n == 0) | marked | (cuts[2] % 100 >= rate))
    spm = pa.array(cuts[3] % 100 < suffix_first)
    moved = pc.if_else(
        spm,
        _concatenated(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle),
        _concatenated(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle),
    )
    none = pa.scalar(None, pa.int64())
    return [
        pa.array(n),
        pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
        pc.if_else(plain, none, _chars(prefix)),
        pc.if_else(plain, none, _chars(middle)),
        pc.if_else(plain, texts, moved),
    ]


def fill_in_middle(documents: DataFrame, seed: int = 42, rate: int = 50, suffix_first: int = 80) -> DataFrame:
    """Every document's text cut in three and put in fill-in-middle order, one row each: see ``SCHEMA``.

    A text of n units is cut behind two of them, drawn from seed and doc_id alone. Of 100 texts some
    ``rate`` are changed, of those some ``suffix_first`` of 100 put the suffix first (``spm``:
    suffix, prefix, middle), the others the prefix (``psm``: prefix, suffix, middle). ``output`` is
    the UTF-8 text with a mark before each part. ``prefix_chars`` and ``middle_chars`` are null for
    ``plain`` texts, which stay as they are.

    Defined cases: a null text is the empty one; the empty text and one that holds a mark of its own
    are plain; blanks alone are one unit; rows of one id and text, null ids too, get one result;
    other columns are ignored; an empty table gives an empty table. Rows are worked on in slices of
    bounded bytes, so memory follows the longest text.
    """

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded_slices(batches, "text"):
            cuts = [batch.column(2 + k).to_numpy(zero_copy_only=False) for k in range(4)]
            out = transformed(batch.column(1), cuts, rate, suffix_first)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *out],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    text = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    numbers = [h.alias(f"h{k}") for k, h in enumerate(draws(F.col("doc_id"), seed), 1)]
    rows = documents.select(F.col("doc_id").cast("long"), text.alias("text"), *numbers)
    return rows.mapInArrow(change, SCHEMA)


def original(output: pa.Array, form: pa.Array) -> pa.Array:
    """The texts that ``transformed`` was given, from its outputs and forms alone.

    A text with marks of its own is plain, so every other output has each mark once: at its start
    and between its parts.
    """
    plain = pc.equal(form, "plain")
    # Plain outputs give way to one without parts, so that all lists have four places.
    pieces = pc.split_pattern_regex(pc.if_else(plain, pa.scalar(b"<P><S><M>", pa.binary()), output), "<[PSM]>")
    one, two, middle = (pc.list_element(pieces, k) for k in (1, 2, 3))
    spm = pc.equal(form, "spm")
    prefix, suffix = pc.if_else(spm, two, one), pc.if_else(spm, one, two)
    return pc.if_else(plain, output, _concatenated(prefix, middle, suffix))


def restore_texts(transformed_rows: DataFrame) -> DataFrame:
    """The rows of ``fill_in_middle`` with ``restored``: the exact UTF-8 text, from output and form."""

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded_slices(batches, "output"):
            form, output = (batch.column(batch.schema.get_field_index(c)) for c in ("form", "output"))
            yield batch.append_column("restored", original(output, form))

    kept = transformed_rows.select(*[f.split()[0] for f in SCHEMA.split(", ")])
    return kept.mapInArrow(rebuild, SCHEMA + ", restored binary")

"""Column expressions on reads: ids, qualities and sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: The standard genetic code, first base slowest, bases in the order T, C, A, G; * stops.
BASES = "TCAG"
AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def normalise_read_id(read_id: Column) -> Column:
    """The id up to its first space, with dots as underscores."""
    return F.translate(F.split_part(read_id, F.lit(" "), F.lit(1)), ".", "_")


def strip_mate_tag(read_id: Column) -> Column:
    """An id that ends in /1 or /2 is cut at its first slash."""
    return F.when(read_id.endswith("/1") | read_id.endswith("/2"), F.split_part(read_id, F.lit("/"), F.lit(1))).otherwise(read_id)


def safe_name(name: Column) -> Column:
    """A name with the characters that file systems refuse replaced by underscores."""
    return F.regexp_replace(name, r"[?<>\\:*|]", "_")


#: Characters of qualities that a task works on at once.
CHUNK = 1 << 20


def _blocks(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(codes, rows, places) of the characters of texts, CHUNK at a time, whatever the lengths: their codes, the texts they
    stand in and their 0-based positions there. Read from Arrow's buffers; beyond Latin-1 a character counts as ?."""
    if not pc.all(pc.string_is_ascii(texts)).as_py() and len(texts) > texts.null_count:
        texts = pa.array([t and t.encode("latin-1", "replace") for t in texts.to_pylist()], pa.large_binary())
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, ends, data = texts.buffers()
    if not len(texts) or data is None:
        return
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    codes = np.frombuffer(data, np.uint8)
    for at in range(int(ends[0]), int(ends[-1]), CHUNK):
        to = min(at + CHUNK, int(ends[-1]))
        first, last = np.searchsorted(ends, at, "right") - 1, np.searchsorted(ends, to, "left")
        rows = np.repeat(np.arange(first, last), np.diff(np.clip(ends[first : last + 1], at, to)))
        yield codes[at:to], rows, np.arange(at, to) - ends[rows]


def _summed(qual: Column, worth: np.ndarray) -> Column:
    """Sum of what each character's code is worth; 0 for an empty text, null for null."""
    @F.arrow_udf(DoubleType())
    def add(texts: pa.Array) -> pa.Array:
        sums = np.zeros(len(texts))
        for codes, rows, _ in _blocks(texts):
            sums[rows[0] : rows[-1] + 1] += np.bincount(rows - rows[0], worth[codes])
        return pa.array(sums, mask=texts.is_null().to_numpy(zero_copy_only=False))

    return add(qual.cast("string"))


def quality_base(qual: Column) -> Column:
    """Aggregate: 64 if no character of any quality stands below code 64, else 33; 64 needs one character at least."""
    return F.when(F.bool_or(qual.rlike("[\\x00-\\x3F]")) | ~F.coalesce(F.bool_or(qual != ""), F.lit(False)), 33).otherwise(64)


def expected_error(qual: Column, base: int = 33) -> Column:
    """Sum of 10^(-Q/10) over the positions of a read; 0 for an empty one, null for null."""
    return _summed(qual, 10.0 ** ((base - np.arange(256)) / 10))


def mean_code(qual: Column) -> Column:
    """Mean code of the characters; null for an empty or null text."""
    return F.when(F.length(qual) > 0, _summed(qual, np.arange(256.0)) / F.length(qual))


def trimmed(seq: Column, qual: Column, keep: Column, base: int = 33, min_q: int = 2) -> Column:
    """``keep`` (seq or qual) without the ends whose quality is at most min_q; '' where nothing is better."""
    low = "".join(chr(base + q) for q in range(min_q + 1))
    left = F.length(qual) - F.length(F.ltrim(qual, F.lit(low)))
    return F.substring(keep, left + 1, F.length(F.trim(qual, F.lit(low))))


def adapter_start(seq: Column, adapter: str, min_overlap: int = 3) -> Column:
    """0-based place where the longest suffix of seq that is a prefix of the adapter (or all of it) begins, or the length."""
    at = F.instr(seq, adapter)
    whole = F.when(at > 0, at - 1)
    ends = [F.when(seq.endswith(adapter[:n]), F.length(seq) - n) for n in range(len(adapter) - 1, min_overlap - 1, -1)]
    return F.coalesce(whole, *ends, F.length(seq))


def adapter_start_fuzzy(seq: Column, adapter: str, min_overlap: int = 3, rate: float = 1 / 3) -> Column:
    """0-based place where the adapter, or at the end a beginning of at least min_overlap of it, first stands with few mismatches.

    Of n bases laid over each other at most floor(rate * n) may differ; an N in the read always fits. Without such a place
    it is the length of seq. Ties do not arise, as the leftmost place counts.
    """
    codes = [F.lit(b) for b in adapter]

    def fits(at: Column) -> Column:
        """Bases laid over each other that differ stay within the rate; a place outside seq counts as no overlap."""
        bases = [F.substring(seq, at + k + 1, F.lit(1)) for k in range(len(adapter))]
        differ = sum((F.when((b != "") & (b != "N") & (b != c), 1).otherwise(0) for b, c in zip(bases, codes, strict=True)), F.lit(0))
        overlap = F.least(F.lit(len(adapter)), F.length(seq) - at)
        return differ <= F.floor(F.lit(rate) * overlap + 1e-9)

    last = F.length(seq) - min_overlap
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.coalesce(F.get(F.filter(places, fits), 0), F.length(seq))


def per_base_codes(reads: DataFrame, qual: str = "qual") -> DataFrame:
    """pos, q, k: how many reads have the code q at the 0-based position pos. Counted in blocks of CHUNK characters, then added up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes, _, places in _blocks(batch.column(0)):
                cells, n = np.unique(places * 256 + codes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cells // 256, pa.int32()), pa.array(cells % 256, pa.int32()), pa.array(n, pa.int64())], ["pos", "q", "k"])

    return reads.select(F.col(qual).cast("string")).mapInArrow(run, "pos int, q int, k long").groupBy("pos", "q").agg(F.sum("k").alias("k"))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def translate_codons(seq: Column) -> Column:
    """Amino acids of the reading frame at 0: stops dropped, unknown codons X, a partial last codon ignored."""
    table = {a + b + c: AMINO[16 * i + 4 * j + k] for i, a in enumerate(BASES) for j, b in enumerate(BASES) for k, c in enumerate(BASES)}
    code = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    # One scan cuts the frame into codons; a substring for each would count from the start every time.
    frame = F.regexp_extract_all(seq, F.lit("(?s)..."), 0)
    return F.translate(F.array_join(F.transform(frame, lambda c: F.coalesce(F.try_element_at(code, c), F.lit("X"))), ""), "*", "")

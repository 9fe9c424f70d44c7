"""Periodic run detection by recompression.

A run is a stretch of consecutive words with smallest period q and at least max(24, 3 q) words that
no neighbouring word extends keeping the period. Candidates come from a harmonic grid: a run of
period p holds a multiple i of g = max(24 - p, 2 p) with w[i] = w[i + p], so n / g places per period, n ln n
in all, meet every run. The longest common extensions of i and i + p to both sides, answered exactly
by a run-length grammar of the texts (``recompression``), are the run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custseg.llm.common import SPACES
from custseg.llm.recompression import Grammar

LEAST_WORDS = 24
LEAST_PERIODS = 3
#: Bytes of text that share one grammar; a longer text has its own.
SLICE_BYTES = 3 << 20
#: Grid places held at once.
GRID_ROWS = 1 << 21


def grid(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The harmonic grids of texts of ``sizes`` words, in slices: text, place i, period p."""
    longest = np.where(sizes >= LEAST_WORDS, sizes // LEAST_PERIODS, 0)
    text = np.repeat(np.arange(len(sizes)), longest)
    period = np.arange(len(text)) - np.repeat(np.cumsum(longest) - longest, longest) + 1
    gap = np.maximum(LEAST_WORDS - period, (LEAST_PERIODS - 1) * period)
    places = -(-(sizes[text] - period) // gap)
    upto = np.cumsum(places)
    at = 0
    while at < len(text):
        base = upto[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(upto, base + GRID_ROWS, "right")))
        n = places[at:to]
        which = np.repeat(np.arange(at, to), n)
        turn = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        yield text[which], turn * gap[which], period[which]
        at = to


def runs_of(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of several texts, given as word numbers one text after the other: text, start, length and
    period, by text, start and period."""
    sizes = np.asarray(sizes, np.int64)
    n_texts = len(sizes)
    # a letter of its own before, between and behind the texts ends every extension there
    ends = np.cumsum(sizes)
    borders = int(words.max()) + 1 + np.arange(n_texts + 1) if len(words) else np.arange(n_texts + 1)
    line = np.insert(words.astype(np.int64), np.concatenate([[0], ends]), borders)
    first = ends - sizes + np.arange(n_texts) + 1
    grammar = None
    found = []
    for text, place, period in grid(sizes):
        i = first[text] + place
        hit = np.flatnonzero(line[i] == line[i + period])
        if not len(hit):
            continue
        grammar = grammar or Grammar(line, smallest=n_texts + 1)
        text, period, i = text[hit], period[hit], i[hit]
        need = np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
        ahead = grammar.extend(i, i + period)
        behind = grammar.extend(i, i + period, back=True)
        length = behind + ahead + period
        long = length >= need
        found.append(np.column_stack([text, i - behind - first[text], length, period])[long])
    rows = np.concatenate(found) if found else np.empty((0, 4), np.int64)
    # multiples of the smallest period find the same stretch: the smallest stays
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1)
    rows = rows[new]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    return rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3]


def kept_words(sizes: np.ndarray, text: np.ndarray, start: np.ndarray, length: np.ndarray,
               period: np.ndarray) -> np.ndarray:
    """Which words no run holds after its first period."""
    total = int(sizes.sum())
    base = (np.cumsum(sizes) - sizes)[text] + start
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, base + period, 1)
    np.add.at(change, base + length, -1)
    return np.cumsum(change[:total]) == 0


def _scan(texts) -> tuple:
    """``n_words, runs, collapsed`` of each text of an Arrow string array."""
    import pyarrow as pa
    import pyarrow.compute as pc
    words = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat, offsets = words.flatten(), words.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    # white space at either end of a text gives an empty word there
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    flat = flat.filter(pa.array(real))
    sizes = np.diff(np.concatenate([[0], np.cumsum(real)])[offsets])
    codes = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    text, start, length, period = runs_of(codes, sizes)
    kept = kept_words(sizes, text, start, length, period)
    left = flat.filter(pa.array(kept))
    bounds = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], np.cumsum(sizes)])]
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), left), pa.scalar(" ", left.type))
    at = np.searchsorted(text, np.arange(len(sizes) + 1))
    triples = pa.StructArray.from_arrays([pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                                          pa.array(period, pa.int64())], names=["start", "length", "period"])
    runs = pa.ListArray.from_arrays(pa.array(at, pa.int32()), triples)
    return pa.array(sizes, pa.int64()), runs, collapsed.cast(pa.string())


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` per row of ``docs``: the runs as (start, length, period) by start
    and period, and the text's words without those that a run holds after its first period, joined
    by one space.

    One pass, no shuffle: a task splits its rows into slices of about ``SLICE_BYTES`` and builds one
    grammar per slice. Null, empty and white-space texts have no words, no runs and an empty
    result; a very long text is one slice, in memory of some 200 bytes a word; null and repeated
    identifiers are rows like others; an empty table gives no rows; other columns are ignored.
    """
    def scan(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for batch in batches:
            texts = batch.column("text")
            size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < len(texts):
                base = size[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(size, base + SLICE_BYTES, "right")))
                n, runs, collapsed = _scan(texts.slice(at, to - at))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, to - at), n, runs, collapsed],
                                                 names=["doc_id", "n_words", "runs", "collapsed"])
                at = to

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(scan, f"doc_id {kind}, n_words long, "
                                 "runs array<struct<start:long,length:long,period:long>>, collapsed string")


def plant_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text``: every tenth document by the checksum of its identifier repeats some of its words.

    With h = crc32(identifier), g = h div 10 and n words, h mod 10 = 0 makes each word from a = g mod n
    on the word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). Documents with no words or a null
    identifier and all others keep their text.
    """
    trimmed = F.btrim(F.col(text_col), F.lit(SPACES))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.crc32(F.col(id_col).cast("string")).alias("h"), trimmed.alias("trimmed"))
    chosen = (F.col("h") % 10 == 0) & (F.col("trimmed") != "")
    words = F.when(chosen, F.split("trimmed", r"[\x20\x09-\x0D]+"))
    rows = rows.withColumn("words", words).withColumn("a", F.expr("(h div 10) % size(words)"))
    rows = rows.withColumn("p", F.expr("1 + (size(words) - a) div (3 + (h div 10) % 8)"))
    planted = F.expr("""array_join(transform(sequence(0, size(words) - 1),
        i -> element_at(words, cast(if(i < a, i, a + (i - a) % p) + 1 AS int))), ' ')""")
    return rows.select("doc_id", F.when(F.col("words").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """One row per document of ``find_runs``: number of runs, the most periodic one, checksums of all
    runs and of the collapsed text."""
    # a fraction is greater where the cross products are, so the best run is an exact fold
    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), lambda m, r: F.when(
        m.isNull() | (r["length"] * m["period"] > m["length"] * r["period"]), r).otherwise(m))
    lines = F.concat(F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n"),
                     F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")

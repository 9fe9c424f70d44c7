"""Repeated long byte strings across documents, by suffix arrays."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custseg.session import materialise

#: Length of a repeated string, and of the grams whose minima anchor it.
LENGTH, GRAM = 400, 32
#: Slices a suffix-array group may hold; larger ones are split by longer keys first.
GROUP_SLICES = 8_192
#: Bytes per suffix-array shard on average.
SHARD_BYTES = 1 << 20
#: Parts into which a class of window offsets is split, and the first classes.
SPLIT = 4
CLASSES = [(low, min(LENGTH - GRAM, low + -(-(LENGTH - GRAM + 1) // SPLIT) - 1))
           for low in range(0, LENGTH - GRAM + 1, -(-(LENGTH - GRAM + 1) // SPLIT))]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes at each position (arithmetic is modulo 2**64)."""
    words = np.lib.stride_tricks.as_strided(data[:8].view(np.uint64), (len(data) - 7,), (1,))
    odd = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
    n = len(data) - GRAM + 1
    out = words[:n] * odd[0]
    for k in range(1, GRAM // 8):
        out ^= out >> np.uint64(31)
        out += words[8 * k:8 * k + n] * odd[k]
    out ^= out >> np.uint64(29)
    out *= odd[3]
    return out ^ (out >> np.uint64(32))


def sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` (minimum or maximum) of every run of ``width`` values, by block prefixes and suffixes."""
    n = len(values)
    fill = np.iinfo(values.dtype).max if best is np.minimum else 0
    blocks = np.full(-(-n // width) * width, fill, values.dtype)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[:n - width + 1], ahead[width - 1:n])


def anchors(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the grams that are smallest in some window of ``length`` bytes.
    Equal windows have the same anchors at the same places, so every repeat shares one."""
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = gram_hashes(np.frombuffer(data, np.uint8))
    width = length - GRAM + 1
    low = sliding(h, width, np.minimum)
    # the largest minimum of the windows that hold a position
    pad = np.zeros(width - 1, np.uint64)
    at = np.flatnonzero(sliding(np.concatenate([pad, low, pad]), width, np.maximum) == h)
    return at, h[at]


def suffix_array(rows: np.ndarray) -> np.ndarray:
    """The suffix array of ``rows`` (a matrix of symbols; suffixes end with their row) by Larsson and
    Sadakane's refinement: suffixes are sorted by their first symbol; groups of equal rank are then
    sorted by the rank ``h`` further on, ``h`` doubles, and suffixes that are alone in their group
    are never touched again. Equal suffixes stay in the order of their rows."""
    width = rows.shape[1]
    n = rows.size
    key = rows.ravel()
    sa = np.argsort(key, kind="stable")
    first = np.ones(n, bool)
    first[1:] = key[sa[1:]] != key[sa[:-1]]
    rank = np.empty(n, np.int64)
    start = np.flatnonzero(first)
    rank[sa] = np.repeat(start, np.diff(np.append(start, n)))
    h = 1
    while h < width:
        slots = np.flatnonzero(~(first & np.append(first[1:], True)))
        if not len(slots):
            break
        group = sa[slots]
        own = rank[group]
        then = np.where(group % width + h < width, rank[np.minimum(group + h, n - 1)], -1)
        order = np.argsort(own * (n + 1) + then, kind="stable")
        group, own, then = group[order], own[order], then[order]
        sa[slots] = group
        fresh = np.ones(len(slots), bool)
        fresh[1:] = (own[1:] != own[:-1]) | (then[1:] != then[:-1])
        first[slots] = fresh
        start = np.flatnonzero(fresh)
        rank[group] = np.repeat(slots[start], np.diff(np.append(start, len(slots))))
        h *= 2
    return sa


def common_prefixes(rows: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Kasai's algorithm: for each suffix the symbols it shares with its predecessor in ``sa``. A
    position's value is at least its left neighbour's less one; all rows advance together."""
    count, width = rows.shape
    flat = rows.ravel()
    before = np.full(rows.size, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    shared = np.zeros(rows.size, np.int64)
    carry = np.zeros(count, np.int64)
    base = np.arange(count) * width
    for t in range(width):
        at = base + t
        other = before[at]
        most = np.where(other >= 0, width - np.maximum(t, other % width), 0)
        k = np.minimum(np.maximum(carry - 1, 0), most)
        going = np.flatnonzero(k < most)
        while len(going):
            same = flat[at[going] + k[going]] == flat[other[going] + k[going]]
            going = going[same]
            k[going] += 1
            going = going[k[going] < most[going]]
        shared[at] = k
        carry = k
    return shared


def aligned_order(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of ``parts`` (cut or zero-padded to ``width`` bytes) and the bytes each shares with the one
    before it in that order: from the suffix array of their 8-byte words, in which the parts are the
    suffixes at their first word, and its common prefixes."""
    words = -(-width // 8)
    packed = np.zeros((len(parts), words * 8), np.uint8)
    for k, part in enumerate(parts):
        packed[k, :len(part)] = np.frombuffer(part, np.uint8)
    raw = packed.view(">u8")
    codes = np.unique(raw, return_inverse=True)[1].reshape(raw.shape).astype(np.int64)
    sa = suffix_array(codes)
    shared = common_prefixes(codes, sa)[sa]
    heads = np.flatnonzero(sa % words == 0)
    order = sa[heads] // words
    # between two neighbouring parts the array's smallest common prefix counts
    lows = np.minimum.reduceat(shared[:heads[-1] + 1], np.append(0, heads[:-1] + 1))
    whole = np.where(np.arange(len(order)) > 0, lows, 0)
    lcp = whole * 8
    some = np.flatnonzero((np.arange(len(order)) > 0) & (whole < words))
    a, b, w = order[some], order[some - 1], whole[some]
    differs = packed.reshape(len(parts), words, 8)[a, w] != packed.reshape(len(parts), words, 8)[b, w]
    lcp[some] += differs.argmax(1)
    return order, lcp


def repeated_offsets(slices: list[bytes], before: np.ndarray, low: np.ndarray, high: np.ndarray,
                     length: int = LENGTH) -> list[np.ndarray]:
    """Per slice the offsets ``o`` (from ``low`` to ``high``) for which the ``length`` bytes that start ``o``
    bytes before its anchor, at ``before``, occur in another slice too.

    Equal windows have their anchor at the same offset, so a window is a stretch of ``o`` bytes left of
    the anchor and one of ``length - o`` bytes from it on. Both sides are put in order by suffix
    arrays; stretches of one length are equal within runs whose common prefixes reach that length.
    """
    count = len(slices)
    right_order, right_lcp = aligned_order([s[b:] for s, b in zip(slices, before)], length)
    left_order, left_lcp = aligned_order([s[:b][::-1] for s, b in zip(slices, before)], length - GRAM)
    behind = np.array([len(s) for s in slices]) - before
    hits = np.zeros((count, length - GRAM + 1), bool)
    right, left = np.empty(count, np.int64), np.empty(count, np.int64)
    for o in range(int(low.min()), int(high.max()) + 1):
        rows = np.flatnonzero((low <= o) & (o <= high) & (before >= o) & (behind >= length - o))
        if len(rows) < 2:
            continue
        right[right_order] = np.cumsum(right_lcp < length - o)
        left[left_order] = np.cumsum(left_lcp < o)
        key = right[rows] * (count + 1) + left[rows]
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        hits[rows[order[1:][same]], o] = True
        hits[rows[order[:-1][same]], o] = True
    return [np.flatnonzero(h) for h in hits]


def anchor_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, hash, pos, size, gram, context, core0 ..``: each anchor of each whole text, with a hash of the
    bytes within reach of a window that holds it, and per class of window offsets a short hash of the
    bytes that all windows of the class share (null if none lies in the text)."""
    reach = LENGTH - GRAM

    def frame(parts: list[tuple]) -> pd.DataFrame:
        counts = [len(part[3]) for part in parts]
        column = lambda k: np.concatenate([part[k] for part in parts])
        each = pd.Series([part[0] for part in parts]).repeat(counts).reset_index(drop=True)
        out = {"id": each, "hash": np.repeat([part[1] for part in parts], counts), "pos": column(3),
               "size": np.repeat([part[2] for part in parts], counts).astype(np.int32), "gram": column(4), "context": column(5)}
        for j in range(len(CLASSES)):
            out[f"core{j}"] = pd.arrays.IntegerArray(column(6 + 2 * j), column(7 + 2 * j))
        return pd.DataFrame(out)

    def cores(data: bytes, at: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        missing = (at < low) | (at - high + LENGTH > len(data))
        values = np.zeros(len(at), np.int16)
        values[~missing] = [(xxhash.xxh32_intdigest(data[p - low:p - high + LENGTH]) & 0xFFFF) - (1 << 15)
                            for p in at[~missing].tolist()]
        return values, missing

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts, held = [], 0
            for key, hashed, text in zip(batch["id"], batch["hash"], batch["text"]):
                data = text.encode("utf-8", "surrogatepass") if text else b""
                at, h = anchors(data)
                if len(at):
                    context = [xxhash.xxh3_64_intdigest(data[max(0, p - reach):p + LENGTH], seed=min(p, reach))
                               for p in at.tolist()]
                    parts.append((key, hashed, len(data), at.astype(np.int32), h.view(np.int64),
                                  np.array(context, np.uint64).view(np.int64),
                                  *[x for c in CLASSES for x in cores(data, at, *c)]))
                    held += len(at)
                if held >= 100_000:
                    yield frame(parts)
                    parts, held = [], 0
            if parts:
                yield frame(parts)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("hash"), F.col(text_col).alias("text"))
    return rows.mapInPandas(find, f"id {kind}, hash long, pos int, size int, gram long, context long, "
                           + ", ".join(f"core{j} short" for j in range(len(CLASSES))))


@F.pandas_udf(T.BinaryType())
def packed_bytes(texts: pd.Series) -> pd.Series:
    """UTF-8 bytes of texts (null: empty), compressed: whole texts go through two exchanges."""
    pack = zstandard.ZstdCompressor(level=3).compress
    return texts.map(lambda t: pack(t.encode("utf-8", "surrogatepass") if t else b""))


def _packed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, hash, data``: identifier, text hash and compressed bytes of each row."""
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("hash"),
                       packed_bytes(F.col(text_col)).alias("data"))


#: Identifier and text hash as keys without nulls: what is grouped by them can be joined by them as it lies.
KEYS = ["key", "none", "hash"]


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds ``key`` and ``none`` of ``KEYS``."""
    return rows.withColumn("key", F.coalesce(F.col("id").cast("string"), F.lit(""))).withColumn("none", F.col("id").isNull())


def _slices(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """The bytes in reach of each anchor of ``wanted`` (id, hash, pos, gram, context), cut from
    its document: adds ``start`` (in the document) and ``bytes``."""
    lists = _keyed(wanted).groupBy(*KEYS).agg(*[F.collect_list(c).alias(c) for c in ("pos", "gram", "context")])
    joined = _keyed(_packed_texts(docs, id_col, text_col)).join(lists.hint("merge"), KEYS) \
        .select("id", "hash", "data", "pos", "gram", "context")
    reach = LENGTH - GRAM

    def cut(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                want = part.column("pos")
                row = pc.list_parent_indices(want)
                pos = want.flatten().to_numpy()
                start = np.maximum(0, pos - reach).astype(np.int32)
                data = [unpack(z.as_py()) for z in part.column("data")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(row), part.column("hash").take(row), pa.array(pos),
                     part.column("gram").flatten(), part.column("context").flatten(), pa.array(start),
                     pa.array([data[r][a:p + LENGTH] for r, a, p in zip(row.to_pylist(), start.tolist(), pos.tolist())], pa.binary())],
                    names=["id", "hash", "pos", "gram", "context", "start", "bytes"])

    kind = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(cut, f"id {kind}, hash long, pos int, gram long, context long, start int, bytes binary")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, hash, start, stop``: byte ranges of documents (by identifier and text hash) covered by
    400-byte strings that also start anywhere else; ranges may overlap.

    1. Anchors: each window's smallest 32-byte gram hash. Two equal windows have the same anchor, so
       repeats are sought among places with one anchor only, about one in 185 bytes.
    2. Places whose whole reach (368 bytes before, 400 after the anchor's start) is equal collapse
       by a map-side combined aggregate; more than one place settles every window in it.
    3. Different reaches of one anchor that share the bytes common to a class of windows (a filter by
       short hashes, which only drops what cannot match) are cut from their documents and dealt to shards of about
       ``SHARD_BYTES``; a shard's suffix arrays (of the 8-byte words to the right and to the left of
       the anchors) and common prefixes show the windows that occur at two places.
    4. Anchors with more than ``GROUP_SLICES`` different reaches do not fit a shard. Their window
       offsets are searched by splitting them in four: the part of the reach that all
       windows of a class share becomes the key, equal reaches of the class collapse again, and what
       is still too large is split further, down to single windows. So a passage that a third of
       all documents share never meets in one task.
    """
    found = materialise(anchor_rows(docs, id_col, text_col), "suffix_anchors", "zstd")
    places = found.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("n"),
                                                  F.min(F.struct("id", "hash", "pos")).alias("one"),
                                                  *[F.max(f"core{j}").alias(f"core{j}") for j in range(len(CLASSES))])
    places = materialise(places, "suffix_places", "zstd")
    several = places.groupBy("gram").agg(F.count(F.lit(1)).alias("slices")).filter("slices > 1").select("gram")
    # a place whose windows share no class's common bytes with another place of the anchor is alone
    classes = F.explode(F.array(*[F.struct(F.lit(j).alias("class"), F.col(f"core{j}").alias("core"))
                                  for j in range(len(CLASSES))])).alias("k")
    # tables that grow with the input are never broadcast, so disk and time grow alike at every size
    cores = places.join(several.hint("merge"), "gram").select("gram", "context", classes).select("gram", "context", "k.*") \
        .filter(F.col("core").isNotNull())
    met = cores.groupBy("gram", "class", "core").agg(F.count(F.lit(1)).alias("places")).filter("places > 1")
    met = cores.join(met.drop("places").hint("merge"), ["gram", "class", "core"], "left_semi").select("gram", "context").distinct()
    open_places = places.join(met.hint("merge"), ["gram", "context"]).select("one.*", "gram", "context")
    slices = materialise(_slices(docs, id_col, text_col, open_places), "suffix_slices", "zstd")

    reach = LENGTH - GRAM
    settled = [places.filter("n > 1").select("gram", "context", F.lit(0).alias("low"), F.lit(reach).alias("high"))]
    # offsets of the anchor in a window run from low to high
    work = slices.select("*", F.col("gram").alias("key"), F.lit(0).alias("low"), F.lit(reach).alias("high"))
    ahead = F.col("pos") - F.col("start")
    keys = ["key", "low", "high"]
    while True:
        # fewer than one row in GROUP_SLICES: the slices stay where they are and go to their shards only
        large = work.groupBy(*keys).agg(F.count(F.lit(1)).alias("slices")).filter(F.col("slices") > GROUP_SLICES).select(*keys)
        large = F.broadcast(materialise(large, "suffix_groups"))
        settled.append(materialise(_array_repeats(work.join(large, keys, "left_anti")), "suffix_settled"))
        if large.isEmpty():
            break
        step = F.ceil((F.col("high") - F.col("low") + 1) / SPLIT).cast("int")
        parts = (work.join(large, keys)
                 .withColumn("to_low", F.explode(F.sequence(F.col("low"), F.col("high"), step)))
                 .withColumn("to_high", F.least(F.col("high"), F.col("to_low") + step - 1))
                 # some window of the class lies in the document
                 .filter((ahead >= F.col("to_low")) & (F.length("bytes") >= ahead - F.col("to_high") + LENGTH)))
        most = F.least(F.col("to_high"), ahead)
        core = F.substring(F.col("bytes"), (ahead - F.col("to_low") + 1).cast("int"),
                           (F.col("to_low") - F.col("to_high") + LENGTH).cast("int"))
        whole = F.substring(F.col("bytes"), (ahead - most + 1).cast("int"),
                            (most - F.col("to_low") + LENGTH).cast("int"))
        parts = materialise(parts.select(
            "id", "hash", "pos", "gram", "context", "start", "bytes", F.xxhash64("gram", core).alias("key"),
            F.col("to_low").alias("low"), F.col("to_high").alias("high"), F.xxhash64(whole, most).alias("reach")),
            "suffix_parts")
        row = F.struct("id", "hash", "pos", "gram", "context", "start", "bytes")
        same = materialise(parts.groupBy(*keys, "reach").agg(F.count(F.lit(1)).alias("n"), F.min(row).alias("one")),
                           "suffix_same")
        settled.append(parts.select("gram", "context", *keys, "reach")
                       .join(same.filter("n > 1").select(*keys, "reach"), [*keys, "reach"], "left_semi")
                       .select("gram", "context", "low", "high"))
        work = same.select("one.*", *keys)

    ranges = settled[0]
    for more in settled[1:]:
        ranges = ranges.unionByName(more)
    # a window with the anchor at offset o starts o bytes before it
    return (found.join(ranges.hint("merge"), ["gram", "context"])
            .select("id", "hash",
                    F.greatest(F.lit(0), F.col("pos") - F.col("high")).alias("start"),
                    F.least(F.col("pos") - F.col("low") + LENGTH, F.col("size")).alias("stop")))


def _array_repeats(work: DataFrame) -> DataFrame:
    """``gram, context, low, high``: runs of anchor offsets whose windows the suffix arrays of their
    shard show at two places."""
    total = work.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = max(1, math.ceil(total / SHARD_BYTES))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # what is alone under its key can have no equal
        rows = rows[rows.duplicated(["key", "low", "high"], keep=False)]
        rows = rows.drop_duplicates(["gram", "context", "low"]).reset_index(drop=True)
        if rows.empty:
            return pd.DataFrame({"gram": [], "context": [], "low": [], "high": []}, dtype="int64")
        before = (rows["pos"] - rows["start"]).to_numpy(np.int64)
        found = repeated_offsets(rows["bytes"].tolist(), before, rows["low"].to_numpy(), rows["high"].to_numpy())
        at, low, high = [], [], []
        for k, offsets in enumerate(found):
            if len(offsets):
                for part in np.split(offsets, np.flatnonzero(np.diff(offsets) > 1) + 1):
                    at.append(k)
                    low.append(int(part[0]))
                    high.append(int(part[-1]))
        picked = rows.iloc[at]
        return pd.DataFrame({"gram": picked["gram"].array, "context": picked["context"].array,
                             "low": low, "high": high})

    return (work.select("pos", "gram", "context", "start", "bytes", "key", "low", "high",
                        F.pmod(F.xxhash64("key", "low"), F.lit(shards)).alias("shard"))
            .groupBy("shard").applyInPandas(run, "gram long, context long, low int, high int"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False
                   ) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` per input row, and with ``keep_text``
    the remaining bytes as ``kept``. Every byte covered by a 400-byte string that also starts at another
    place, in any document or the same one, is removed; matches never cross documents.

    Null texts are empty: nothing to remove. Rows equal in identifier and text are different
    places, so all their windows repeat. Null identifiers are a value like any other. Texts under
    400 bytes stay whole. An empty table gives no rows.
    """
    ranges = repeats(docs, id_col, text_col)
    lists = _keyed(ranges).groupBy(*KEYS).agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))

    def merge(spans) -> list[tuple[int, int]]:
        out: list[list[int]] = []
        for span in spans if spans is not None else ():
            a, b = span["start"], span["stop"]
            if out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        return [tuple(x) for x in out]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for key, packed, spans in zip(batch["id"], batch["data"], batch["spans"]):
                data = unpack(packed)
                merged = merge(spans)
                kept, at = [], 0
                for a, b in merged:
                    kept.append(data[at:a])
                    at = b
                rest = b"".join([*kept, data[at:]])
                out.append((key, len(data), len(data) - len(rest), len(merged), hashlib.sha256(rest).hexdigest(),
                            [{"start": a, "stop": b} for a, b in merged], *([rest] if keep_text else [])))
            yield pd.DataFrame(out, columns=names)

    kind = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"] + ["kept"] * keep_text
    texts = _keyed(_packed_texts(docs, id_col, text_col))
    return texts.join(lists.hint("merge"), KEYS, "left").select("id", "data", "spans").mapInPandas(
        cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
             "spans array<struct<start: long, stop: long>>" + (", kept binary" if keep_text else ""))

"""Mixture-controlled packing by deficit round-robin."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custseg.llm.common import running_before
from custseg.session import materialise

WINDOW = 2048
#: A queue is served once its deficit reaches this many tokens, so no window is cut to crumbs.
QUANTUM = 64
#: Tokens per packing task on average.
SHARD_TOKENS = 1 << 22
#: Words an encoder remembers before it starts afresh, and bytes of text it encodes at a time.
CACHE_WORDS, SLICE_BYTES = 200_000, 2 << 20
# Fixed value: the word pattern of the tokenizer file.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Words that need the tokenizer itself: control characters, characters beyond the Latin blocks (which
#: may be composed, or change when lower-cased, in other ways) and what may be a special token.
ODD = regex.compile(r"[^\x21-\x7e\xa1-\u012f\u0131-\u024f]|<\|")


def fast_encoding(path: str):
    """The merges of the tokenizer file as a tiktoken encoding, and its ids by rank.

    The file marks the end of a word on its last character. Here the mark is a zero byte of its
    own; joining it to the byte before has the first ranks of all merges, so that what follows are
    exactly the file's merges in the file's order.
    """
    import json

    import tiktoken
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    # the byte-level alphabet: printable bytes stand for themselves, others follow from 256 on
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}
    end = "</w>"
    ranks = {bytes([b]): b for b in range(256)}
    ids = dict.fromkeys(range(256), 0)
    ended = {bytes([b, 0]): 256 + b for b in range(256)}
    ranks.update(ended)
    by_id = sorted(vocabulary.items(), key=lambda x: x[1])
    for token, number in by_id:
        marked = token.endswith(end) and token != end
        text = token[:-len(end)] if marked else token
        if not all(c in byte_of for c in text):
            continue
        raw = bytes(byte_of[c] for c in text) + (b"\0" if marked else b"")
        rank = ranks.setdefault(raw, len(ranks))
        ids[rank] = number
    table = np.zeros(len(ranks), "<u2")
    for rank, number in ids.items():
        table[rank] = number
    encoding = tiktoken.Encoding("words", pat_str=r"[^\x00 ]+\x00| ", mergeable_ranks=ranks, special_tokens={})
    return encoding, table


class WordEncoder:
    """Token ids of texts, as little-endian 16-bit bytes, with the ids of each word remembered.

    The tokenizer drops white space and never merges across it, so a text's ids are those of its
    words in turn: each distinct word is encoded once. Words of Latin letters, digits and
    punctuation go through the file's merges directly, all others through the tokenizer; both give
    the tokenizer's ids. Ids must fit in 16 bits (49,408 here), which is checked.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError("token ids do not fit in 16 bits")
        self.encoding, self.table = fast_encoding(path)
        self.end = end_id
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.empty(0, "<u2")
        self.starts = np.empty(0, np.int64)
        self.counts = np.empty(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        odd = [w for w in words if ODD.search(w)] if ODD.search(" ".join(words).replace(" ", "")) else []
        plain = words
        if odd:
            skip = set(odd)
            plain = [w for w in words if w not in skip]
        found = [np.empty(0, "<u2")]
        counts = [np.empty(0, np.int64)]
        if plain:
            text = PIECES.sub("\\g<0>\0", " ".join(plain).lower())
            ranks = np.array(self.encoding.encode_ordinary(text), np.int64)
            gaps = ranks == 32  # the space between two words is a token of its own
            word = np.cumsum(gaps)
            found.append(self.table[ranks[~gaps]])
            counts.append(np.bincount(word[~gaps], minlength=len(plain)))
        for w in odd:
            ids = self.tokenizer.encode(w, add_special_tokens=False).ids
            found.append(np.array(ids, "<u2"))
            counts.append(np.array([len(ids)]))
        counts = np.concatenate(counts)
        for k, w in enumerate([*plain, *odd], len(self.known)):
            self.known[w] = k
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, *found])

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of an Arrow string array, each text's followed by the end id, and their numbers."""
        import pyarrow as pa
        import pyarrow.compute as pc
        words = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        each = np.diff(words.offsets.to_numpy())
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) > CACHE_WORDS:
            self._clear()
        new = [w for w in distinct if w not in self.known]
        if new:
            self._learn(new)
        place = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        at = place[coded.indices.to_numpy()] if len(distinct) else np.empty(0, np.int64)
        counts = self.counts[at]
        ends = np.cumsum(counts)
        flat = self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[at] - ends + counts, counts)]
        upto = np.concatenate([[0], ends])[np.cumsum(each)]
        return np.insert(flat, upto, self.end), np.diff(upto, prepend=0) + 1


def tokenise(docs: DataFrame, id_col: str, text_col: str, source_col: str, tokenizer_path: str,
             end_id: int) -> DataFrame:
    """``uid, doc_id, source, ids, n``: ids of each whole text plus ``end_id``, 16 bits each."""
    def encode(batches):
        import os

        import pyarrow as pa
        import pyarrow.compute as pc
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = WordEncoder(tokenizer_path, end_id)
        for batch in batches:
            texts = batch.column("text")
            size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < len(texts):
                base = size[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(size, base + SLICE_BYTES, "right")))
                ids, counts = encoder.encode(texts.slice(at, to - at))
                data = pa.py_buffer(ids.astype("<u2").tobytes())
                offsets = pa.py_buffer((2 * np.concatenate([[0], np.cumsum(counts)])).astype(np.int32).tobytes())
                packed = pa.Array.from_buffers(pa.binary(), to - at, [None, offsets, data])
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(at, to - at) for c in ("uid", "doc_id", "source")], packed,
                     pa.array(counts, pa.int64())], names=["uid", "doc_id", "source", "ids", "n"])
                at = to

    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("doc_id"),
                       F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(encode, f"uid long, doc_id {id_type}, source string, ids binary, n long")


def round_robin(queues: list[list[int]], shares: np.ndarray, carried: np.ndarray,
                window: int = WINDOW, quantum: int = QUANTUM) -> Iterator[tuple[int, int, int, int]]:
    """Serve ``queues`` (lists of document lengths) window by window; yields pieces as
    ``(queue, document, start, length)`` in window order, each ending inside its window.

    In every window each open queue's deficit grows by its share of the window; queues are
    served in falling order of deficit, up to their deficit once that has reached ``quantum``
    (or empties them), and what space is left goes to the queues with the largest deficits,
    whose overdraft is carried into the next window. ``carried`` holds the deficits at the start.
    """
    deficit = carried.astype(float).copy()
    left = np.array([sum(q) for q in queues], dtype=np.int64)
    at = [0] * len(queues)       # document at the head of each queue
    inside = [0] * len(queues)   # tokens of it already served
    rest = int(left.sum())
    while rest:
        live = np.flatnonzero(left)
        weight = shares[live]
        total = weight.sum()
        deficit[live] += window * (weight / total if total > 0 else 1.0 / len(live))
        space = min(window, rest)
        order = live[np.argsort(-deficit[live], kind="stable")].tolist()
        for forced in (False, True):
            for s in order:
                if not space:
                    break
                have = int(left[s])
                want = space if forced else min(int(max(deficit[s], 0)), space)
                take = min(want, have)
                if not take or not forced and take < quantum and take < have and take < space:
                    continue
                left[s] -= take
                deficit[s] -= take
                space -= take
                rest -= take
                queue = queues[s]
                while take:
                    n = min(take, queue[at[s]] - inside[s])
                    if n:
                        yield s, at[s], inside[s], n
                    take -= n
                    inside[s] += n
                    if inside[s] == queue[at[s]]:
                        at[s] += 1
                        inside[s] = 0


def lay_out(pieces: Iterator[tuple[int, int, int, int]], total: int, window: int = WINDOW
            ) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Give pieces their ``sequence`` and ``offset``: full windows, and the tokens after the last
    full window in sequences of falling powers of two, which need no padding."""
    bounds = [window] * (total // window) + [1 << b for b in reversed(range(window.bit_length()))
                                             if (total % window) >> b & 1]
    sequence = offset = 0
    for s, d, start, n in pieces:
        while n:
            k = min(n, bounds[sequence] - offset)
            yield s, d, start, k, sequence, offset
            start, n, offset = start + k, n - k, offset + k
            if offset == bounds[sequence]:
                sequence, offset = sequence + 1, 0


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source", targets: dict[str, float] | None = None, end_id: int = 1,
         window: int = WINDOW, quantum: int = QUANTUM, shard_tokens: int = SHARD_TOKENS,
         keep_ids: bool = False) -> DataFrame:
    """Pack every token of ``docs`` once into sequences of at most ``window`` tokens; one row per
    piece: ``doc_id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, with
    ``keep_ids``, the piece's ``ids`` (16 bits each).

    Every window is filled to the sources' target proportions by deficit round-robin. Texts are
    tokenised once into a shared table; rows are dealt by a hash of their place in it to shards
    of about ``shard_tokens`` tokens, whatever their keys, so a hot source is spread evenly. By
    default a shard's targets are what its queues hold, under which all queues run dry together
    (shards differ from the whole table only by the luck of the draw); ``targets`` sets other
    proportions. A shard starts from the deficits that the shards before it leave against the
    global proportions, at most one window's share each, from two prefix sums over a table of
    (shard, source) totals, so no shard waits for another. A task holds one shard; the longest
    document bounds what is beyond that.

    A source that runs dry leaves its share of further windows to the others. Null or empty text
    is a document of the one id ``end_id``; a null source is a queue of its own; identifiers may
    be null or repeated, each row is packed by itself. An empty table gives no rows.
    """
    tokens = materialise(tokenise(docs, id_col, text_col, source_col, tokenizer_path, end_id), "pack_ids")
    total = tokens.agg(F.sum("n")).first()[0] or 0
    shards = max(1, math.ceil(total / shard_tokens))
    dealt = tokens.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)))
    sums = dealt.groupBy("shard", "source").agg(F.sum("n").alias("served"))
    whole = tokens.groupBy("source").agg(F.sum("n").alias("share"))
    if targets:
        chosen = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair])
        whole = whole.withColumn("share", F.coalesce(chosen[F.coalesce("source", F.lit(""))], F.lit(0.0)))
    share = F.col("share") / F.greatest(F.sum("share").over(Window.partitionBy()), F.lit(1e-300))
    whole = whole.select(F.col("source").alias("name"), share.alias("share"))
    grid = sums.groupBy("shard").agg(F.sum("served").alias("tokens"))
    grid = running_before(grid, "shard", {"all_before": "tokens"})
    state = running_before(sums, "shard", {"own_before": "served"}, ("source",)).join(grid, "shard")
    state = (state.join(whole, F.col("source").eqNullSafe(F.col("name")))
             .select("shard", "source", "share",
                     (F.col("share") * F.col("all_before") - F.col("own_before")).alias("deficit")))
    state = materialise(state, "pack_state")

    def fill(key, rows: pd.DataFrame, begin: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("uid", kind="stable")
        begin = begin.sort_values("source", na_position="last", kind="stable")
        names = [None if pd.isna(s) else s for s in begin["source"]]
        number = {s: k for k, s in enumerate(names)}
        source = [number[None if pd.isna(s) else s] for s in rows["source"]]
        members: list[list[int]] = [[] for _ in names]
        for row, s in enumerate(source):
            members[s].append(row)
        n = rows["n"].tolist()
        ids = rows["ids"].tolist()
        queues = [[n[row] for row in m] for m in members]
        share = begin["share"].to_numpy() if targets else np.array([sum(q) for q in queues], float)
        share = share / (share.sum() or 1.0)
        carried = np.clip(begin["deficit"].to_numpy(), -window * share, window * share)
        pieces = round_robin(queues, share, carried, window, quantum)
        at, start, length, sequence, offset, crc, kept = [], [], [], [], [], [], []
        for s, d, first, k, seq, off in lay_out(pieces, sum(n), window):
            row = members[s][d]
            part = ids[row][2 * first:2 * (first + k)]
            at.append(row)
            start.append(first)
            length.append(k)
            sequence.append(seq)
            offset.append(off)
            crc.append(zlib.crc32(np.frombuffer(part, "<u2").astype("<u4").tobytes()))
            if keep_ids:
                kept.append(part)
        picked = rows.iloc[at]
        out = pd.DataFrame({
            "doc_id": picked["doc_id"].array, "source": picked["source"].array, "start": start,
            "length": length, "ids_crc32": crc, "doc_tokens": picked["n"].array,
            "sequence_id": np.array(sequence, np.int64) + (int(key[0]) << 32), "offset": offset})
        if keep_ids:
            out["ids"] = kept
        return out

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"doc_id {id_type}, source string, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long" + (", ids binary" if keep_ids else ""))
    return dealt.groupBy("shard").cogroup(state.groupBy("shard")).applyInPandas(fill, schema)

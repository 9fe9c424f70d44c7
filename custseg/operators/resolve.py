"""Customer identity resolution: a lossless fuzzy self-join and grouping of its pairs.

Similarity is the Indel ratio ``100 * 2 * LCS / (|a| + |b|)``; two keys match when the
ratio is at least ``cutoff`` (90). Instead of comparing all n(n-1)/2 pairs, the join

1. collapses identical keys (they match trivially; a hot key costs one row);
2. describes each key by its bigrams numbered per occurrence ("ab#1", "ab#2", ...), below a cutoff of 84 by
   its characters;
3. keeps per key only a *prefix* of these tokens in one global order (rarest first). Two matching keys share
   at least ``need`` tokens (count filter), so they share at least one token among their first
   ``len - need`` ones (prefix filter): an equi-join on prefix tokens finds every match. From a cutoff
   of 86 on, ``method="segments"`` finds them by segment signatures instead (see ``segments``);
4. filters candidates by length, then by ``levenshtein <= allowed indel`` (a JVM built-in,
   banded by the threshold; Levenshtein distance never exceeds Indel distance);
5. computes the exact LCS for survivors in an Arrow-batched UDF.

Keys whose signatures are shared by more than ``CROWD`` keys (URLs of one grammar: nearly all) leave steps 3 to 5: their
candidates grow with the square of the keys, so they are compared with every key of a length that may match,
block by block, where only matches leave a task (see ``block_join``).

Such low cutoffs say little about two keys, so their candidates are many. Steps 1-4 are joins and aggregates that Spark partitions and shuffles; skewed tokens are
split by AQE's skew join. Nothing is capped or sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.hashing import customer_hash
from ..functions.similarity import lcs
from ..session import cut_lineage, materialise
from .block_join import block_pairs, blocks, graph_best, graph_ids
from .segments import LEAST_CUTOFF, LEVELS, LONGEST, key_segments, segment_candidates


def _allowed_indel(total_len, cutoff: int):
    """Largest Indel distance with ratio >= cutoff for a pair of total length ``total_len``."""
    return F.floor((100 - cutoff) * total_len / 100).cast("int")


def _prefix_length(length, cutoff: int):
    """Number of rarest tokens a key must keep so any match shares one of them:
    len - need(len) with

      need(L) = min over admissible partner lengths M of  max(L, M) - 1 - 2 * indel(L + M).

    For M <= L the minimum is at M = L. For M > L the term rises by one per step except
    for a drop of one where indel(L + M) steps up, so its minimum is at M = L + 1 or at the
    first step-up after 2L (equal to brute force for every cutoff 80..99, L < 800).
    """
    c = cutoff
    L = length
    m_max = F.floor((200 - c) * L / c)
    ind = lambda s: F.floor((100 - c) * s / 100)
    v1 = L - 1 - 2 * ind(2 * L)
    v2 = F.when(L + 1 <= m_max, L - 2 * ind(2 * L + 1))
    s_up = F.ceil(100 * (ind(2 * L) + 1) / (100 - c))
    v3 = F.when((s_up > 2 * L) & (s_up - L <= m_max), s_up - L - 1 - 2 * ind(s_up))
    need = F.least(v1, v2, v3)          # least() skips nulls
    return (L - need).cast("int")


def _unigram_prefix_length(length, cutoff: int):
    """The same for single characters: a match shares at least as many characters as its longest common
    subsequence has, ceil(cutoff (L + M) / 200), fewest at the shortest partner M = ceil(cutoff L / (200 - cutoff))."""
    shortest = F.ceil(cutoff * length / (200 - cutoff))
    return (length - F.ceil(cutoff * (length + shortest) / 200) + 1).cast("int")


def distinct_keys(df: DataFrame, key_col: str) -> DataFrame:
    """Distinct non-null keys with a stable id -> (kid, key, len), checkpointed so the id
    is fixed for both sides of the self-join."""
    keys = (df.select(F.col(key_col).alias("key")).where(F.col("key").isNotNull()).distinct()
            .withColumn("kid", F.monotonically_increasing_id())
            .withColumn("len", F.length("key")))
    return cut_lineage(keys.repartition("kid"))


#: Least cutoff at which every match shares a bigram.
BIGRAM_CUTOFF = 84
#: Keys that share a token or segment before the keys that hold it count as crowded.
CROWD = 64
#: Classes of characters whose counts bound the distance of two keys.
CHARACTER_CLASSES = 16


def with_character_counts(keys: DataFrame) -> DataFrame:
    """Adds ``n0 .. n15``: how many characters of ``key`` fall in each class (printable ASCII by code
    modulo 15, everything else in the last class)."""
    classes = ["".join(chr(c) for c in range(32, 127) if c % (CHARACTER_CLASSES - 1) == k)
               for k in range(CHARACTER_CLASSES - 1)]
    counts = [(F.col("len") - F.length(F.translate("key", chars, ""))).alias(f"n{k}") for k, chars in enumerate(classes)]
    out = keys.select("*", *counts)
    known = sum((F.col(f"n{k}") for k in range(1, CHARACTER_CLASSES - 1)), F.col("n0"))
    return out.withColumn(f"n{CHARACTER_CLASSES - 1}", F.col("len") - known)


def prefix_tokens(keys: DataFrame, cutoff: int = C.SIMILARITY_CUTOFF, q: int = 2) -> DataFrame:
    """(kid, len, bg, occ, rk, freq) for the prefix tokens (of ``q`` characters, 1 or 2) of every key of length >= q;
    ``rk`` is the token's 1-based position in the key's globally ordered token list, ``freq`` the keys that hold it."""
    grams = (keys.where(F.col("len") >= q)
             .select("kid", "len", F.explode(F.sequence(F.lit(1), F.col("len") - (q - 1))).alias("pos"), "key")
             .select("kid", "len", F.substring(F.col("key"), F.col("pos"), F.lit(q)).alias("bg")))
    counted = grams.groupBy("kid", "len", "bg").agg(F.count(F.lit(1)).alias("n"))
    tokens = counted.select("kid", "len", "bg", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("occ"))
    freq = tokens.groupBy("bg", "occ").agg(F.count(F.lit(1)).alias("freq"))
    ranked = tokens.join(freq, ["bg", "occ"])
    w = Window.partitionBy("kid").orderBy("freq", "bg", "occ")
    return (ranked.withColumn("rk", F.row_number().over(w))
            .where(F.col("rk") <= (_prefix_length if q == 2 else _unigram_prefix_length)(F.col("len"), cutoff))
            .select("kid", "len", "bg", "occ", "rk", "freq"))


def segment_pairs(keys: DataFrame, cutoff: int = C.SIMILARITY_CUTOFF) -> DataFrame:
    """(ka, la, kb, lb), ka < kb: the candidates that pass the length and count filters, by segments where the
    shorter key has at most ``LONGEST`` characters and by prefixes where both are longer."""
    found = segment_candidates(keys, cutoff).select(F.least("ks", "kl").alias("ka"), F.greatest("ks", "kl").alias("kb")).distinct()
    counts = F.array(*[F.col(f"n{k}") for k in range(CHARACTER_CLASSES)])
    known = cut_lineage(with_character_counts(keys).select("kid", "len", counts.alias("counts")))
    a = known.select(F.col("kid").alias("ka"), F.col("len").alias("la"), F.col("counts").alias("ca"))
    b = known.select(F.col("kid").alias("kb"), F.col("len").alias("lb"), F.col("counts").alias("cb"))
    # one column a key: Spark's inference of constraints doubles with every renamed column of a condition
    apart = F.aggregate(F.zip_with("ca", "cb", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    allowed = _allowed_indel(F.col("la") + F.col("lb"), cutoff)
    return (found.join(a, "ka").join(b, "kb")
            .where((F.abs(F.col("la") - F.col("lb")) <= allowed) & (apart <= allowed))
            .select("ka", "la", "kb", "lb")
            .unionByName(candidate_pairs(keys.where(F.col("len") > LONGEST), cutoff)))


def candidate_pairs(keys: DataFrame, cutoff: int = C.SIMILARITY_CUTOFF, q: int = 2) -> DataFrame:
    """Pairs (ka < kb) sharing a prefix token and passing the length and position filters.

    Position filter (PPJoin, Xiao et al. 2008): tokens are in one global order, so shared
    tokens appear in the same relative order in both keys. At the first shared token, at
    positions ra and rb, the overlap is at most min(La - ra, Lb - rb) (tokens left from
    there on); later shared tokens give smaller bounds. A row whose bound is below the
    pair's required overlap is dropped; a matching pair always keeps its first shared token.

    Count filter: every insertion or deletion changes one character count by one, so two keys
    whose counts per class differ by more than the allowed indel distance in sum cannot match.
    """
    counts = [f"n{k}" for k in range(CHARACTER_CLASSES)]
    p = prefix_tokens(keys, cutoff, q).join(with_character_counts(keys).select("kid", *counts), "kid")
    p = cut_lineage(p)      # both sides of the join read it
    a = p.select(F.col("kid").alias("ka"), F.col("len").alias("la"), F.col("rk").alias("ra"), "bg", "occ",
                 *[F.col(c).alias(f"a_{c}") for c in counts])
    b = p.select(F.col("kid").alias("kb"), F.col("len").alias("lb"), F.col("rk").alias("rb"), "bg", "occ",
                 *[F.col(c).alias(f"b_{c}") for c in counts])
    lo, hi = F.least("la", "lb"), F.greatest("la", "lb")
    apart = sum((F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) for c in counts[1:]), F.abs(F.col("a_n0") - F.col("b_n0")))
    if q == 2:
        need = hi - 1 - 2 * _allowed_indel(F.col("la") + F.col("lb"), cutoff)
    else:
        need = F.ceil(cutoff * (F.col("la") + F.col("lb")) / 200)
    bound = F.least(F.col("la") - F.col("ra"), F.col("lb") - F.col("rb")) + (2 - q)
    return (a.join(b, ["bg", "occ"])
            .where((F.col("ka") < F.col("kb")) & (cutoff * hi <= (200 - cutoff) * lo) & (bound >= need)
                   & (apart <= _allowed_indel(F.col("la") + F.col("lb"), cutoff)))
            .select("ka", "la", "kb", "lb").distinct())


def crowded_keys(keys: DataFrame, cutoff: int, method: str, crowd: int = CROWD) -> DataFrame:
    """Adds ``crowded`` to ``keys``: whether the signatures that the key's candidates would come from are shared by
    more than ``crowd`` keys. Among keys that are not, a signature finds at most so many: their candidates
    grow with the keys alone."""
    if method == "segments":
        entries = key_segments(keys, cutoff)
        often = entries.groupBy("m", "i", "text").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd).drop("n")
        # keys above the longest cut one come from prefixes
        found = entries.join(often, ["m", "i", "text"], "left_semi").groupBy("kid").agg(F.count(F.lit(1)).alias("n")) \
            .where(F.col("n") >= LEVELS).select("kid") \
            .unionByName(_crowded_prefixes(keys.where(F.col("len") > LONGEST), cutoff, 2, crowd))
    else:
        found = _crowded_prefixes(keys, cutoff, 2 if cutoff >= BIGRAM_CUTOFF else 1, crowd)
    return keys.join(found.withColumn("crowded", F.lit(True)), "kid", "left") \
        .select("kid", "key", "len", F.coalesce("crowded", F.lit(False)).alias("crowded"))


def _crowded_prefixes(keys: DataFrame, cutoff: int, q: int, crowd: int) -> DataFrame:
    """``kid`` of the keys with a prefix token that more than ``crowd`` keys hold."""
    return prefix_tokens(keys, cutoff, q).groupBy("kid").agg(F.max("freq").alias("freq")).where(F.col("freq") > crowd).select("kid")


def _flagged(keys: DataFrame, cutoff: int, method: str) -> DataFrame:
    if method not in ("prefix", "segments"):
        raise ValueError("method must be 'prefix' or 'segments'")
    if not 1 <= cutoff <= 100:
        raise ValueError("the cutoff must be 1 to 100")
    return materialise(crowded_keys(keys, cutoff, method if cutoff >= LEAST_CUTOFF else "prefix"), "fuzzy_keys")


def _by_signatures(keys: DataFrame, cutoff: int, method: str, give: str = "keys") -> DataFrame:
    """The matches between keys that are not crowded."""
    alone = keys.where(~F.col("crowded")).drop("crowded")
    if cutoff < BIGRAM_CUTOFF:
        # below it some short keys need no shared bigram to match (checked exhaustively for
        # lengths 2..600), but every match shares a character
        cand = candidate_pairs(alone, cutoff, q=1)
    elif cutoff < LEAST_CUTOFF or method == "prefix":
        cand = candidate_pairs(alone, cutoff)
    else:
        cand = segment_pairs(alone, cutoff)
    ka = keys.select(F.col("kid").alias("ka"), F.col("key").alias("key_a"))
    kb = keys.select(F.col("kid").alias("kb"), F.col("key").alias("key_b"))
    total = F.col("la") + F.col("lb")
    pairs = (cand.join(ka, "ka").join(kb, "kb")
             .where(F.call_function("levenshtein", F.col("key_a"), F.col("key_b"),
                                    _allowed_indel(total, cutoff)) >= 0))
    return (pairs.withColumn("lcs", lcs(F.col("key_a"), F.col("key_b")))
            .where(200 * F.col("lcs") >= cutoff * total)
            .select(*(["key_a", "key_b", "lcs", total.alias("total")] if give == "keys" else ["ka", "kb"])))


def matches(keys: DataFrame, cutoff: int = C.SIMILARITY_CUTOFF, method: str = "prefix", give: str = "keys") -> DataFrame:
    """Pairs of ``keys`` (kid, key, len) with ratio >= cutoff, each once and in no order within a pair: ``give`` names
    their columns, see ``block_pairs``. Crowded keys are compared block by block, all others by signatures."""
    keys = _flagged(keys, cutoff, method)
    if keys.where("NOT crowded").isEmpty():
        return block_pairs(blocks(keys), cutoff, give)
    found = _by_signatures(keys, cutoff, method, give)
    return found if keys.where("crowded").isEmpty() else found.unionByName(block_pairs(blocks(keys), cutoff, give))


def score(lcs_col: str, total_col: str):
    """The ratio, rounded half up to 6 digits as ``round`` does, without a decimal number per row."""
    return F.floor(200.0 * F.col(lcs_col) / F.col(total_col) * 1e6 + 0.5) / 1e6


def similar_key_pairs(df: DataFrame, key_col: str = "key", cutoff: int = C.SIMILARITY_CUTOFF,
                      keys: DataFrame | None = None, method: str = "prefix") -> DataFrame:
    """All pairs of distinct keys with ratio >= cutoff (1 to 100) -> (key_a, key_b, lcs, score),
    key_a < key_b. Identical keys are not listed (their ratio is 100 by definition).

    ``method`` names the way to the candidates of cutoffs from 86 on, with the same result: ``prefix`` (fewer
    steps, candidates per key grow with the keys) or ``segments`` (more lookups, far fewer candidates
    compared in blocks instead, see ``block_join``."""
    keys = keys if keys is not None else distinct_keys(df, key_col)
    return matches(keys, cutoff, method).select(
        F.least("key_a", "key_b").alias("key_a"), F.greatest("key_a", "key_b").alias("key_b"),
        F.col("lcs"),
        score("lcs", "total").alias("score"))


# ---------------------------------------------------------------------------
# Grouping
# ---------------------------------------------------------------------------

def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Connected components of an undirected graph -> (node, component) for every node
    that has an edge; component = smallest node id of the component.

    Alternating large-star / small-star rounds (Kiveris et al., SoCC 2014): each round is
    a few aggregates and joins over the edge table, O(log^2 n) rounds; the edge table is
    checkpointed to keep lineage short. Node ids must be orderable (long or string).
    """
    e = (edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))
         .where(F.col("u") != F.col("v")))
    e = e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    e = cut_lineage(e)
    while True:
        # large star: connect every larger neighbour of u to the minimum of u's neighbourhood
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where(F.col("v") > F.col("u")).join(m, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = large.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")) \
            .where(F.col("u") != F.col("v")).distinct()
        # small star: connect u and its smaller neighbours to the minimum of them
        small_in = large.select(F.col("v").alias("u"), F.col("u").alias("v"))  # v < u
        m2 = small_in.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        small = (small_in.join(m2, "u")
                 .select(F.col("v").alias("x"), "m")
                 .unionByName(m2.select(F.col("u").alias("x"), "m"))
                 .where(F.col("x") != F.col("m"))
                 .select(F.least("x", "m").alias("u"), F.greatest("x", "m").alias("v")).distinct())
        new = cut_lineage(small)
        changed = (new.join(e, ["u", "v"], "left_anti").limit(1).count() > 0
                   or e.join(new, ["u", "v"], "left_anti").limit(1).count() > 0)
        e = new
        if not changed:
            break
    # converged: a star per component, centre = its minimum
    return (e.select(F.col("v").alias("node"), F.col("u").alias("component"))
            .unionByName(e.select(F.col("u").alias("node"), F.col("u").alias("component")))
            .groupBy("node").agg(F.min("component").alias("component")))


def resolve_components(entries: DataFrame, id_col: str, key_col: str, order_col: str,
                       cutoff: int = C.SIMILARITY_CUTOFF, out_col: str = "customer_id", method: str = "prefix") -> DataFrame:
    """Group entries whose keys are linked by a chain of matches (and identical keys).

    -> (id_col, key_col, group_key, out_col): group_key is the key of the member with the
    smallest ``order_col``; ``out_col`` = SHA-256 of it. Null keys get null ids.
    """
    keys = distinct_keys(entries, key_col)
    # as many links as connect what the matches connect, on the keys' numbers
    comp = connected_components(matches(keys, cutoff, method, give="links"), "ka", "kb")
    of = (keys.join(comp, keys["kid"] == comp["node"], "left")
          .select(F.col("key").alias("_key"), F.coalesce("component", "kid").alias("_comp")))
    labelled = entries.join(of, entries[key_col] == of["_key"], "left").drop("_key")
    rep = (labelled.where(F.col("_comp").isNotNull()).groupBy("_comp")
           .agg(F.min_by(F.col(key_col), F.col(order_col)).alias("group_key")))
    return (labelled.join(rep, "_comp", "left")
            .select(id_col, key_col, "group_key", customer_hash("group_key").alias(out_col)))


# ---------------------------------------------------------------------------
# Order-dependent grouping ("later groups overwrite earlier ones")
# ---------------------------------------------------------------------------
#
# Entries are ordered by an ordinal; entry u < v is linked to v when their keys are equal
# or similar. The source pipeline walks the links in ordinal order, lets each group absorb
# the groups it reaches, and finally stamps every group's members with the group's key,
# later groups overwriting earlier ones. Its result has a closed form:
#
#   owner(v) = the smallest ordinal with an increasing path of links to v (v itself if none)
#   label(v) = v if no smaller entry links to v, else the max of owner(u) over those u
#
# owner is non-increasing along the entries of one key, which gives two reductions:
#   * owner(v) only needs the in-links from the key's first entry m(K) and, per similar
#     key K', from pred_K'(v) = the last entry of K' before v (a sparse graph, linear in
#     entries x similar keys, no pairs inside a key group);
#   * label(v) = max over K' in {K} + similar(K) with m(K') < v of owner(m(K')).
# Both are a smallest or largest value over similar keys, so the matches of crowded keys with one
# entry each are never listed: they stay in blocks, two bytes a match, and give each round's values.

def _dense_rank(nodes: DataFrame, order_col: str) -> DataFrame:
    """Adds ``r``: 0..n-1 in ``order_col`` order (``order_col`` unique).

    A range-partitioned sort is checkpointed so its physical partitions are fixed; within a
    partition ``monotonically_increasing_id`` follows the sorted order, and a per-partition
    row count (one row per partition) gives each partition its offset. All JVM-side.
    """
    spark = nodes.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    srt = cut_lineage(nodes.repartitionByRange(n_parts, order_col).sortWithinPartitions(order_col)
                      .withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("_mid"), 33)
    counts = sorted((r["p"], r["n"]) for r in srt.groupBy(part.alias("p"))
                    .agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, acc = [], 0
    for p, n in counts:
        offsets += [F.lit(p), F.lit(acc)]
        acc += n
    off = F.create_map(*offsets) if offsets else F.create_map(F.lit(0), F.lit(0))
    local = F.col("_mid") - F.shiftleft(part, 33)
    return srt.withColumn("r", (off[part] + local).cast("long")).drop("_mid")


def _asof_pred(elements: DataFrame, queries: DataFrame, bucket: int) -> DataFrame:
    """For query rows (K, qr) the largest element rank er of key K with er < qr -> (K, qr, pred).

    Ranks are cut into buckets of ``bucket`` consecutive ranks: within a bucket a window over
    (K, bucket) finds earlier elements (partitions hold at most ``bucket`` elements), and
    a second window over per-(K, bucket) summaries carries the last element of earlier
    buckets, so a key holding a large share of all entries is spread over many windows.
    """
    e = elements.select("K", F.col("er").alias("t"), F.floor(F.col("er") / bucket).alias("b"),
                        F.lit(1).alias("is_e"))
    q = queries.select("K", F.col("qr").alias("t"), F.floor(F.col("qr") / bucket).alias("b"),
                       F.lit(0).alias("is_e"))
    w_in = Window.partitionBy("K", "b").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    within = (e.unionByName(q)
              .withColumn("_prev", F.max(F.when(F.col("is_e") == 1, F.col("t"))).over(w_in))
              .where(F.col("is_e") == 0)
              .select("K", F.col("t").alias("qr"), "b", F.col("_prev").alias("within")))
    summ = e.groupBy("K", "b").agg(F.max("t").alias("last"), F.lit(0).alias("is_q"))
    qb = q.select("K", "b").distinct().select("K", "b", F.lit(None).cast("long").alias("last"),
                                              F.lit(1).alias("is_q"))
    w_b = Window.partitionBy("K").orderBy("b", F.col("is_q").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = (summ.unionByName(qb).withColumn("_carry", F.max("last").over(w_b))
              .where(F.col("is_q") == 1).select("K", "b", F.col("_carry").alias("before")))
    return (within.join(before, ["K", "b"], "left")
            .select("K", "qr", F.greatest("within", "before").alias("pred")))


def _min_ancestor(nodes: DataFrame, edges: DataFrame, more=None) -> DataFrame:
    """For a DAG whose edges go from smaller to larger ids: o(v) = smallest id with a path
    to v (v itself if none). Min-propagation along edges plus pointer jumping
    (o(v) <- o(o(v)), valid because o(v) reaches v), so chains converge in log rounds. ``more``
    maps (node, o) to what o becomes along edges that are not listed in ``edges``.

    Each round is written as a table: a checkpoint keeps the size that Spark estimates for its plan, and the join of
    a round with itself squares it, so after 20 rounds the estimate alone is a number of megabytes on the driver."""
    o = materialise(nodes.select(F.col("r").alias("node"), F.col("r").alias("o")), "ordered_owner")
    while True:
        via_edges = (edges.join(o.select(F.col("node").alias("src"), F.col("o").alias("so")), "src")
                     .groupBy(F.col("dst").alias("node")).agg(F.min("so").alias("o")))
        jump = (o.join(o.select(F.col("node").alias("o"), F.col("o").alias("oo")), "o")
                .select("node", F.col("oo").alias("o")))
        found = o.unionByName(via_edges).unionByName(jump)
        new = materialise((found.unionByName(more(o)) if more else found)
                          .groupBy("node").agg(F.min("o").alias("o")), "ordered_owner")
        changed = (new.join(o.select("node", F.col("o").alias("old")), "node")
                   .where(F.col("o") < F.col("old")).limit(1).count() > 0)
        o = new
        if not changed:
            break
    return o


def resolve_ordered(entries: DataFrame, id_col: str, key_col: str, order_col: str,
                    cutoff: int = C.SIMILARITY_CUTOFF, out_col: str = "customer_id",
                    bucket: int = 4096, pairs: DataFrame | None = None) -> DataFrame:
    """Order-dependent grouping (the source pipeline's own result, which is not transitive:
    a later group can take members from an earlier one). -> (id, key, group_key, out_col).

    ``order_col`` must be unique per entry. Null keys are never linked (null id).
    """
    keys = distinct_keys(entries, key_col)
    kid = lambda key, name: keys.select(F.col("key").alias(key), F.col("kid").alias(name))
    ranked = _dense_rank(entries.where(F.col(key_col).isNotNull())
                         .select(F.col(id_col).alias("_id"), F.col(key_col).alias("_key"),
                                 F.col(order_col).alias("_ord")), "_ord")
    nodes = materialise(ranked.join(kid("_key", "K"), "_key").select("_id", "_key", "K", "r"), "ordered_nodes")
    firsts = materialise(nodes.groupBy("K").agg(F.min("r").alias("mk"), (F.count(F.lit(1)) > 1).alias("several")), "ordered_firsts")
    graph, members = None, None
    if pairs is None:
        flagged = _flagged(keys, cutoff, "prefix")
        pairs = _by_signatures(flagged, cutoff, "prefix", "ids")
        if not flagged.where("crowded").isEmpty():
            # matches of crowded keys stay in blocks; those of keys with several entries are listed for the as-of join
            chunks = blocks(flagged)
            graph = materialise(block_pairs(chunks, cutoff, "graph"), "ordered_graph", "zstd")
            members = materialise(chunks.select("chunk", F.posexplode("kids").alias("idx", "K")).join(firsts, "K"), "ordered_members")
            if not firsts.where("several").isEmpty():
                marked = members.select("chunk", "idx", F.col("K").alias("kid"), F.col("several").cast("int").alias("marked"))
                pairs = pairs.unionByName(graph_ids(graph, marked))
            members = members.where("NOT several").select("chunk", "idx", F.col("mk").alias("r"))
    else:
        pairs = pairs.join(kid("key_a", "ka"), "key_a").join(kid("key_b", "kb"), "key_b").select("ka", "kb")
    pairs = materialise(pairs, "ordered_pairs")             # used twice below: compute once
    adj = (pairs.select(F.col("ka").alias("K"), F.col("kb").alias("NK"))
           .unionByName(pairs.select(F.col("kb").alias("K"), F.col("ka").alias("NK"))))
    q = nodes.select("K", "r").join(adj, "K").select(F.col("NK").alias("K"), F.col("r").alias("qr")).join(firsts, "K")
    # the last entry before one is the only entry of most keys
    lone = q.where(~F.col("several") & (F.col("mk") < F.col("qr"))).select(F.col("mk").alias("src"), F.col("qr").alias("dst"))
    several = nodes.join(firsts.where("several"), "K")
    preds = _asof_pred(several.select("K", F.col("r").alias("er")), q.where("several").select("K", "qr"), bucket) \
        .where(F.col("pred").isNotNull())
    star = several.where(F.col("r") != F.col("mk")).select(F.col("mk").alias("src"), F.col("r").alias("dst"))
    edges = materialise(star.unionByName(preds.select(F.col("pred").alias("src"), F.col("qr").alias("dst"))).unionByName(lone),
                        "ordered_edges")

    def in_blocks(o: DataFrame, smallest: bool) -> DataFrame:
        state = members.join(o.select(F.col("node").alias("r"), F.col("o").alias("x")), "r")
        return graph_best(graph, state.select("chunk", "idx", "r", "x"), smallest)

    owner = _min_ancestor(nodes, edges, graph and (lambda o: in_blocks(o, True)))
    om = firsts.join(owner.select(F.col("node").alias("mk"), F.col("o").alias("om")), "mk").select("K", "mk", "om")
    own_key = (nodes.join(om, "K").where(F.col("mk") < F.col("r"))
               .select("r", F.col("om").alias("cand")))
    nb_key = (nodes.select("K", "r").join(adj, "K")
              .join(om.select(F.col("K").alias("NK"), "mk", "om"), "NK")
              .where(F.col("mk") < F.col("r")).select("r", F.col("om").alias("cand")))
    if graph:
        nb_key = nb_key.unionByName(in_blocks(owner, False).select(F.col("node").alias("r"), F.col("o").alias("cand")))
    label = own_key.unionByName(nb_key).groupBy("r").agg(F.max("cand").alias("lab"))
    keyed = nodes.select(F.col("r").alias("lab"), F.col("_key").alias("group_key"))
    out = (nodes.join(label, "r", "left")
           .withColumn("lab", F.coalesce("lab", "r"))
           .join(keyed, "lab")
           .select(F.col("_id").alias(id_col), F.col("_key").alias(key_col), "group_key"))
    nulls = (entries.where(F.col(key_col).isNull())
             .select(id_col, key_col, F.lit(None).cast("string").alias("group_key")))
    return out.unionByName(nulls).withColumn(out_col, customer_hash("group_key"))

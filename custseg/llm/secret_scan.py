"""Secret scan: fixed rules plus character Markov models, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base rules of the scan. Group 2 of an assignment has 6 characters or more.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
LEAST_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")

#: Characters of the models; strings of LEAST_TOKEN or more of them are scored.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
LEAST_TOKEN = 16
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}"
WORD = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{4,}"
#: Documents that the models are trained on at most; prior odds of a secret among such strings.
TRAIN_DOCS = 4_000
PRIOR_ODDS = 1e-6
#: Weight of the counted transitions; the rest is spread evenly over the alphabet. Random strings
#: come in more alphabets than the sample shows, so less of their weight is counted.
COUNTED = {"random": 0.5, "ordinary": 0.95}


def _found(kind: str, pattern: str, group: int = 0) -> list[Column]:
    """Matches of ``pattern`` and the lengths of the text between them."""
    regex = F.lit(pattern)
    return [F.regexp_extract_all("text", regex, F.lit(0)).alias(f"{kind}_match"),
            *([F.regexp_extract_all("text", regex, F.lit(group)).alias(f"{kind}_value")] if group else []),
            F.transform(F.split("text", pattern, -1), F.length).alias(f"{kind}_gap")]


def _placed(kind: str, value: bool = False) -> Column:
    """Spans (start, stop, string) of the matches in code points: each match starts after the
    gaps and matches before it. ``string`` is the match, or the value it assigns."""
    match, gap = f"{kind}_match", f"{kind}_gap"
    string = f"{kind}_value[i]" if value else "m"
    return F.expr(f"""
        aggregate(
            transform({match}, (m, i) -> named_struct('gap', {gap}[i], 'size', length(m), 'string', {string})),
            named_struct('at', 0, 'out', cast(array() AS array<struct<start: int, stop: int, string: string>>)),
            (s, x) -> named_struct(
                'at', s.at + x.gap + x.size,
                'out', array_append(s.out, named_struct('start', s.at + x.gap, 'stop', s.at + x.gap + x.size,
                                                        'string', x.string))),
            s -> s.out)""")


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, assign, access, hex, token``: spans of each rule, and of strings to score."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", *_found("assign", ASSIGN, 2), *_found("access", ACCESS), *_found("hex", HEX),
                       *_found("token", TOKEN))
    spans = [_placed("assign", True).alias("assign"), _placed("access").alias("access"), _placed("hex").alias("hex"),
             _placed("token").alias("token")]
    rows = rows.select("doc_id", "text", *spans)
    return rows.withColumn("assign", F.filter("assign", lambda x: F.length(x["string"]) >= LEAST_VALUE))


def _folded(token: Column) -> Column:
    """Words in capitals and capitalised words are scored as in lower case."""
    return F.when(token.rlike(r"^([A-Z0-9+/_=-]+|[A-Z][a-z]+)$"), F.lower(token)).otherwise(token)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS) -> list[float]:
    """The log-likelihood ratio random : ordinary of every transition, ``len(ALPHABET)**2`` values.

    Labelled samples come from at most ``train_docs`` documents (smallest hash of the identifier):
    what the fixed rules find is random, all other strings of 4 characters or more are ordinary.
    """
    chosen = docs.select(F.col(id_col).alias("doc_id")).filter(F.col("doc_id").isNotNull()).distinct() \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    some = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")
    rules = F.lit(f"{ASSIGN}|{ACCESS}|{HEX}")
    found = base_spans(some)
    random = found.select(F.explode(F.flatten(F.array("assign", "access", "hex"))).alias("x")) \
        .select(F.col("x.string").alias("string"), F.lit("random").alias("label"))
    ordinary = found.select(F.explode(F.regexp_extract_all(F.regexp_replace("text", rules, F.lit(" ")),
                                                           F.lit(WORD), F.lit(0))).alias("string"),
                            F.lit("ordinary").alias("label"))
    strings = random.unionByName(ordinary).select("label", _folded(F.col("string")).alias("string"))
    pairs = strings.filter(F.length("string") > 1).select("label", F.explode(F.expr(
        "transform(sequence(1, length(string) - 1), i -> substring(string, i, 2))")).alias("pair"))
    counts = {(r["label"], r["pair"]): r["count"] for r in pairs.groupBy("label", "pair").count().collect()
              if all(c in ALPHABET for c in r["pair"])}
    out = []
    for a in ALPHABET:
        total = {label: sum(counts.get((label, a + b), 0) for b in ALPHABET) for label in COUNTED}
        for b in ALPHABET:
            p = {label: (share * counts.get((label, a + b), 0) / total[label] + (1 - share) / len(ALPHABET))
                 if total[label] else 1 / len(ALPHABET) for label, share in COUNTED.items()}
            out.append(math.log(p["random"] / p["ordinary"]))
    return out


def scan(docs: DataFrame, ratios: list[float], id_col: str = "doc_id", text_col: str = "text",
         prior_odds: float = PRIOR_ODDS) -> DataFrame:
    """``doc_id, assign, access, hex, markov``: spans (start, stop, string) per input row, of the whole
    text in code points, end exclusive.

    A string is a ``markov`` span if the log-likelihood ratio of its transitions, random against
    ordinary, outweighs the prior odds, and no rule's span overlaps it. One pass, no shuffle. Null
    text is empty; null or repeated identifiers are kept as they are; an empty table gives no rows.
    """
    rows = base_spans(docs, id_col, text_col)
    clear = rows.withColumn("token", F.filter("token", lambda x: _clear(x, "assign") & _clear(x, "access")
                                              & _clear(x, "hex")))
    folded = clear.withColumn("token", F.transform("token", lambda x: x.withField("folded", _folded(x["string"]))))
    listed = "array(" + ", ".join(f"{r:.6f}D" for r in ratios) + ")"
    code = "instr('" + ALPHABET + "', substring(x.folded, {at}, 1))"
    ratio = (f"aggregate(sequence(1, length(x.folded) - 1), 0D, (s, i) -> s + element_at({listed}, "
             f"({code.format(at='i')} - 1) * {len(ALPHABET)} + {code.format(at='i + 1')}))")
    markov = F.expr(f"filter(token, x -> {ratio} > {-math.log(prior_odds)}D)")
    scored = folded.withColumn("token", markov)
    return scored.select("doc_id", "assign", "access", "hex",
                         F.transform("token", lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"),
                                                                x["string"].alias("string"))).alias("markov"))


def _clear(x: Column, kind: str) -> Column:
    return ~F.exists(F.col(kind), lambda y: (y["start"] < x["stop"]) & (x["start"] < y["stop"]))


def _joined(*kinds: str) -> Column:
    """``kind:start:end`` of the spans, by start and then as the kinds are listed."""
    def listed(kind: str) -> Column:
        return F.transform(F.col(kind), lambda x: F.struct(
            x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
            F.concat(F.lit(f"{kind}:"), x["start"].cast("string"), F.lit(":"), x["stop"].cast("string")).alias("s")))

    parts = [listed(k) for k in kinds]
    return F.array_join(F.transform(F.array_sort(F.flatten(F.array(*parts))), lambda x: x["s"]), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans`` of ``scan``'s rows."""
    return scanned.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                          F.sha2(_joined("assign", "access", "hex"), 256).alias("base_sha256"),
                          _joined(*KINDS).alias("spans"))

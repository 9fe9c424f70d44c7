"""Toxicity by a weighted finite-state pattern grammar over clauses."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custseg.session import materialise

# Closed-class words of the grammar in English, French, German and Spanish.
TARGETS = ("you your youre yourself he him she her they them their tu toi vous votre vos il ils elles du dich dir ihr "
           "euch sie er tú usted ustedes vosotros él ella ellos").split()
NEGATIONS = ("not no never isnt arent dont doesnt didnt wasnt cannot without ne pas jamais aucun sans nicht kein keine "
             "nie niemals ohne nunca jamás ningún sin").split()
REPORTS = ("said says say told claimed claims quoted quote wrote called dit disait écrit cité sagte sagt schrieb "
           "zitiert dijo dice escribió citó").split()
THREATS = "kill hurt destroy shoot beat burn murder tuer frapper töten schlagen matar golpear".split()
INSULTS = "idiot moron stupid loser scum imbecile crétin salaud dummkopf arschloch imbécil estúpido".split()

#: Bounds of the fit: labelled rows read, and learned lexicon terms kept.
TRAIN_ROWS, MAX_TERMS = 20_000, 5_000
#: A term is learned if its log odds ratio is this large and this many standard errors from 0.
LEAST_LOG_ODDS, LEAST_Z = 2.5, 2.9
SEED_WEIGHT = 2.0
#: Leading letters that are learned as terms of their own, so that inflected forms are met.
STEMS = (5, 6, 7)
TOKEN = re.compile(r"\w+|[.!?;:\n|]+|,")
WORD, INSULT, THREAT, TARGET, NEGATION, REPORT, STOP, COLON, COMMA = b"wITYNR.:,"
#: A verb of speech and the colon that opens what is reported: one clause. Other colons end a clause.
OPENS_SPEECH = re.compile(rb"(R[^.:]*):")
CACHE_WORDS = 400_000


@dataclass
class Transducer:
    """A deterministic letter transducer: ``arcs[state][symbol] = (state, output)``; a symbol
    without an arc is copied and leads to ``default[state]`` (the state itself if absent)."""
    arcs: dict[int, dict[int, tuple[int, int]]]
    default: dict[int, int] = field(default_factory=dict)

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        arc = self.arcs.get(state, {}).get(symbol)
        return arc if arc else (self.default.get(state, state), symbol)


def negation(scope: int = 3) -> Transducer:
    """Insults and threats within ``scope`` words after a negation become ``i`` and ``t``; a comma ends the
    scope."""
    arcs = {0: {NEGATION: (scope, NEGATION)}}
    for k in range(1, scope + 1):
        arcs[k] = {NEGATION: (scope, NEGATION), INSULT: (k - 1, ord("i")), THREAT: (k - 1, ord("t")), COMMA: (0, COMMA)}
    return Transducer(arcs, {k: k - 1 for k in range(1, scope + 1)})


def reported() -> Transducer:
    """Insults and threats after a verb of speech become ``q``, also after its colon and quotation marks."""
    return Transducer({0: {REPORT: (1, REPORT)}, 1: {INSULT: (1, ord("q")), THREAT: (1, ord("q"))}})


def directed() -> Transducer:
    """An insult or threat in one clause with a target becomes ``D`` or ``V``; if the target
    follows, the target itself is the match."""
    return Transducer({
        0: {TARGET: (1, TARGET), INSULT: (2, INSULT), THREAT: (3, THREAT)},
        1: {INSULT: (1, ord("D")), THREAT: (1, ord("V"))},
        2: {TARGET: (1, ord("D")), THREAT: (3, THREAT)},
        3: {TARGET: (1, ord("V"))}})


ALPHABET = bytes((WORD, INSULT, THREAT, TARGET, NEGATION, REPORT, COMMA)) + b"itq"
#: What the composed grammar can match in a clause.
MATCHES = b"IDTVitq"


def compose(*parts: Transducer) -> dict[tuple[int, ...], dict[int, tuple[tuple[int, ...], int]]]:
    """The cascade of ``parts`` as one transducer over its reachable product states."""
    start = (0,) * len(parts)
    table: dict = {}
    todo = [start]
    while todo:
        state = todo.pop()
        if state in table:
            continue
        table[state] = {}
        for symbol in ALPHABET:
            out, to = symbol, []
            for part, s in zip(parts, state):
                s, out = part.step(s, out)
                to.append(s)
            table[state][symbol] = (tuple(to), out)
            todo.append(tuple(to))
    return table


class Lexicon(dict):
    """Symbol of every word: the grammar's closed classes, else insult if a learned term fits.
    Filled on demand; ``weight`` gives an insult's weight."""

    def __init__(self, terms: dict[str, float]):
        super().__init__()
        self.terms = terms
        self.fixed = {w: s for words, s in ((THREATS, THREAT), (TARGETS, TARGET), (NEGATIONS, NEGATION),
                                            (REPORTS, REPORT)) for w in words}

    def weight(self, word: str) -> float:
        if word in self.terms:
            return self.terms[word]
        for k in reversed(STEMS):
            if len(word) > k and word[:k] + "*" in self.terms:
                return self.terms[word[:k] + "*"]
        return SEED_WEIGHT if word in INSULTS else 0.0

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        if not (word[0].isalnum() or word[0] == "_"):
            symbol = COMMA if word == "," else COLON if word == ":" else STOP
        else:
            symbol = self.fixed.get(word) or (INSULT if self.weight(word) > 0 else WORD)
        self[word] = symbol
        return symbol


def features(text: str | None, lexicon: Lexicon, grammar: dict) -> list[float]:
    """What the grammar matches in the clauses of a whole text: per kind of match the sum of its
    weights (damped), then clauses matched, the best clause, distinct insulting words and length."""
    total = dict.fromkeys(MATCHES, 0.0)
    clauses, best, distinct, n = 0, 0.0, set(), 0
    if text:
        words = TOKEN.findall(text.lower())
        symbols = bytes(map(lexicon.__getitem__, words))
        n = len(words) - symbols.count(COMMA)
        if INSULT in symbols or THREAT in symbols:
            at = 0
            symbols = OPENS_SPEECH.sub(rb"\1w", symbols).replace(b":", b".")
            for clause in symbols.split(bytes((STOP,))):
                if INSULT in clause or THREAT in clause:
                    state, score = (0, 0, 0), 0.0
                    carried = 1.0
                    for k, symbol in enumerate(clause):
                        if symbol == INSULT:
                            word = words[at + k]
                            distinct.add(word[:5])
                            carried = lexicon.weight(word)
                        elif symbol == THREAT:
                            carried = 1.0
                        state, out = grammar[state][symbol]
                        if out in total:
                            total[out] += carried
                            score += carried
                    clauses += 1
                    best = max(best, score)
                at += len(clause) + 1
    return [math.log1p(total[m]) for m in MATCHES] + [math.log1p(clauses), best, float(len(distinct)),
                                                      math.log1p(sum(total.values())) - 0.3 * math.log1p(n)]


N_FEATURES = len(MATCHES) + 4


def fold(id_col: Column) -> Column:
    """crc32(identifier as text) mod 5; 0 is held out, null never learned from."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5))


def term_counts(train: DataFrame) -> DataFrame:
    """``term, half, toxic, clean``: documents of ``train`` (text, toxic, half) with each term."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[int, int], Counter] = {(h, y): Counter() for h in (0, 1) for y in (0, 1)}
        for batch in batches:
            for text, toxic, half in zip(batch["text"], batch["toxic"], batch["half"]):
                words = {w for w in TOKEN.findall((text or "").lower()) if w[0].isalnum()}
                terms = words | {w[:k] + "*" for k in STEMS for w in words if len(w) > k}
                seen[half, toxic].update(terms)
        for (half, toxic), counter in seen.items():
            if counter:
                yield pd.DataFrame({"term": list(counter), "half": half, "toxic": toxic, "n": list(counter.values())})

    counted = train.select("text", "toxic", "half").mapInPandas(count, "term string, half int, toxic int, n long")
    return counted.groupBy("term", "half").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"),
                                               F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"))


def learn_terms(counts: DataFrame, toxic: int, clean: int, max_terms: int) -> dict[str, float]:
    """Terms whose log odds ratio of document frequencies (half a document added to each cell) is
    large and significant, with that ratio as weight."""
    t, c = F.col("t") + 0.5, F.col("c") + 0.5
    ratio = F.log(t / (F.lit(toxic) - F.col("t") + 0.5)) - F.log(c / (F.lit(clean) - F.col("c") + 0.5))
    error = F.sqrt(1 / t + 1 / (F.lit(toxic) - F.col("t") + 0.5) + 1 / c + 1 / (F.lit(clean) - F.col("c") + 0.5))
    found = (counts.select("term", ratio.alias("ratio"), (ratio / error).alias("z"))
             .filter((F.col("ratio") >= LEAST_LOG_ODDS) & (F.col("z") >= LEAST_Z))
             .orderBy(F.desc("z"), "term").limit(max_terms))
    return {r["term"]: float(r["ratio"]) for r in found.collect()}


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights (bias first) of a ridge logistic regression by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    penalty = np.diag([0.0] + [ridge] * (x.shape[1] - 1))
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty @ w
        curve = (x.T * (p * (1 - p) + 1e-9)) @ x + penalty + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(curve, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    terms: dict[str, float]
    weights: np.ndarray


def featured(rows: DataFrame, terms: dict[str, float], keep: str, extra: tuple[str, ...] = ()) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon, grammar = Lexicon(terms), compose(negation(), reported(), directed())
        for batch in batches:
            batch["f"] = [features(t, lexicon, grammar) for t in batch.pop("text")]
            yield batch

    return rows.select("text", *extra).mapInPandas(run, f"{keep}, f array<double>")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", train_rows: int = TRAIN_ROWS, max_terms: int = MAX_TERMS) -> Model:
    """Learn lexicon and match weights from at most ``train_rows`` labelled rows that are not held
    out (smallest hash of the identifier first; equal texts count once).

    The weights are fitted on matches under the lexicon of the other half of the rows, so that they
    reflect unseen texts; the final lexicon uses both halves. With fewer than two classes the seed
    words and default weights remain.
    """
    chosen = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
              .filter(F.col("toxic").isNotNull() & (fold(F.col("id")) != 0))
              .groupBy("id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("id"), "id").limit(train_rows))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .join(F.broadcast(chosen), "id").withColumn("key", F.xxhash64("text"))
    rows = rows.dropDuplicates(["key"]).select("text", "toxic", F.pmod(F.col("key"), F.lit(2)).cast("int").alias("half"))
    train = materialise(rows, "toxicity_train")
    sizes = {(r["half"], r["toxic"]): r["count"] for r in train.groupBy("half", "toxic").count().collect()}
    counts = materialise(term_counts(train), "toxicity_terms")

    def lexicon(halves: tuple[int, ...]) -> dict[str, float]:
        own = counts.filter(F.col("half").isin(*halves)).groupBy("term").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
        toxic, clean = (sum(sizes.get((h, y), 0) for h in halves) for y in (1, 0))
        return learn_terms(own, toxic, clean, max_terms) if toxic and clean else {}

    xs, ys = [], []
    for half in (0, 1):
        got = featured(train.filter(F.col("half") == half), lexicon((1 - half,)), "toxic int", ("toxic",)).toPandas()
        xs += got["f"].tolist()
        ys += got["toxic"].tolist()
    if len(set(ys)) == 2:
        order = np.lexsort(np.array([[*f, y] for f, y in zip(xs, ys)]).T)  # any row order gives the same sums
        weights = logistic(np.array(xs)[order], np.array(ys, float)[order])
    else:
        weights = np.array([-3.0] + [1.0, 1.5, 0.5, 1.5, 0.0, 0.0, 0.0] + [0.5, 0.2, 0.5, 0.0])
    return Model(lexicon((0, 1)), weights)


def score(text: Column, model: Model) -> Column:
    """The score in [0, 1] of a text column, from the whole text alone. Null and empty texts get
    the score of a text without matches."""
    terms, weights = model.terms, model.weights

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon, grammar = Lexicon(terms), compose(negation(), reported(), directed())
        for texts in batches:
            x = np.array([features(t, lexicon, grammar) for t in texts]).reshape(-1, N_FEATURES)
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ weights[1:] + weights[0], -30, 30))))

    return run(text)


def decide(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``; repeated rows are scored one by
    one, a null identifier is not held out, an empty table gives no rows."""
    scored = docs.select(F.col(id_col).alias("doc_id"), score(F.col(text_col), model).alias("score"))
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_civil(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below 0.5, all columns unchanged."""
    return docs.filter(score(F.col(text_col), model) < 0.5)

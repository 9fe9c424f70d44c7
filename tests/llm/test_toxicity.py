import zlib

import numpy as np
import pytest

from custseg.llm import toxicity
from tests.llm.helpers import documents


def matches(text, terms=None):
    grammar = toxicity.compose(toxicity.negation(), toxicity.reported(), toxicity.directed())
    f = toxicity.features(text, toxicity.Lexicon(terms or {}), grammar)
    return {chr(m): v > 0 for m, v in zip(toxicity.MATCHES, f)}


def test_grammar_reads_clauses():
    assert matches("what an idiot") == dict.fromkeys("DTVitq", False) | {"I": True}
    assert matches("you are an idiot")["D"]
    assert matches("idiot, that is what you are")["D"]
    got = matches("he said the idiot left")
    assert got["q"] and not got["I"] and not got["D"]
    got = matches("it is not stupid")
    assert got["i"] and not got["I"]
    assert matches("we will kill you")["V"] and not matches("we will kill time. you know")["V"]
    assert not any(matches("you said no. never mind").values())
    assert matches("you are not, idiot, my friend")["D"] and matches("you are not an idiot")["i"]


@pytest.mark.parametrize("text", [
    "he said: you idiot", 'he said: "you are an idiot"', 'She wrote:  “you stupid loser”', "il a dit: tu es un imbecile",
    "sie sagte: du dummkopf", "dijo: tú, estúpido", "he said, quietly: you moron"])
def test_reported_speech_goes_on_after_a_colon(text):
    got = matches(text)
    assert got["q"] and not got["D"] and not got["I"]


def test_other_colons_end_a_clause():
    assert matches("note: you are an idiot")["D"]
    got = matches("he said hello. you: idiot")
    assert got["I"] and not got["q"] and not got["D"]
    assert matches("you xyzzying one", {"xyzzy*": 3.0})["D"]


def test_composition_equals_running_the_parts_in_turn():
    rng = np.random.default_rng(0)
    parts = [toxicity.negation(), toxicity.reported(), toxicity.directed()]
    table = toxicity.compose(*parts)
    for _ in range(200):
        state, states = (0, 0, 0), [0, 0, 0]
        for symbol in rng.choice(list(b"wITYNR,"), 12):
            state, out = table[state][int(symbol)]
            passed = int(symbol)
            for k, p in enumerate(parts):
                states[k], passed = p.step(states[k], passed)
            assert passed == out and tuple(states) == state


@pytest.fixture(scope="module")
def model(spark):
    base = "/root/testdata/sf0.1"
    return toxicity.fit(spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet"))


def test_held_out_accuracy(spark, model):
    base = "/root/testdata/sf0.1"
    got = toxicity.decide(spark.read.parquet(f"{base}/documents.parquet"), model).toPandas()
    held = got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    assert (got["held_out"] == held).all() and got["score"].between(0, 1).all()
    both = got.merge(spark.read.parquet(f"{base}/labels.parquet").toPandas(), on="doc_id")
    both = both[both["held_out"]]
    toxic, clean = both[both["toxic"] == 1], both[both["toxic"] == 0]
    # some labels mark texts without any toxic word; no text model can find those
    assert toxic["predicted"].mean() > 0.9 and clean["predicted"].mean() < 0.01
    assert ((both["score"] >= 0.5) == (both["predicted"] == 1)).all()


def test_odd_rows_and_filter(spark, model):
    rows = [(1, None, "a"), (2, "", "a"), (3, "you pathetic idiot", "a"), (None, "a calm text", None),
            (5, "fine words " * 50_000, "a"), (3, "you pathetic idiot", "a")]
    docs = documents(spark, rows, clash=True)
    got = toxicity.decide(docs, model).collect()
    assert len(got) == 6 and all(r.predicted == (r.doc_id == 3) for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    out = toxicity.keep_civil(docs, model)
    assert out.columns == docs.columns and out.count() == 4


def test_no_labels_and_empty_table(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(documents(spark, [(1, "x", "a")]), labels)
    assert toxicity.decide(documents(spark, [(1, "you idiot, you moron", "a"), (2, "hello", "a")]), model).count() == 2
    assert toxicity.decide(documents(spark, []), model).count() == 0

"""Text Column functions against Python's own string semantics on random inputs."""

import random

from pyspark.sql import functions as F

from custseg.functions import text as TX

WS = [" ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", " ", "　"]
CHARS = ["a", "b", "ü", "€", "-", " ", ".", ",", "·", ";"] + WS


def _random_strings(seed, n=400):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(CHARS) for _ in range(rnd.randint(0, 12))) for _ in range(n)]


def test_py_strip_and_split_name_match_python(spark):
    vals = _random_strings(1) + ["100 - Müller - GmbH", "Solo", " - x", "a - "]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i long, s string")
    number, desc = TX.split_name("s", " - ")
    got = {r.i: (r.st, r.n, r.d) for r in
           df.select("i", TX.py_strip("s").alias("st"), number.alias("n"), desc.alias("d")).collect()}
    for i, v in enumerate(vals):
        parts = v.split(" - ", 1)
        assert got[i] == (v.strip(), parts[0], parts[1] if len(parts) > 1 else None), repr(v)


def test_locale_numbers_round_trip(spark):
    rnd = random.Random(2)
    vals = [round(rnd.uniform(-1e7, 1e7), 2) for _ in range(300)] + [0.0, 1234.56, -3.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    out = df.select("x", TX.format_locale_number(F.col("x")).alias("t")) \
        .select("x", "t", TX.parse_locale_number("t").alias("y")).collect()
    for r in out:
        assert r.y == r.x and "," in r.t
    bad = spark.createDataFrame([("12a",)], "t string").select(
        TX.parse_locale_number("t", strict=False).alias("y")).first()
    assert bad.y is None


def test_day_first_dates(spark):
    df = spark.createDataFrame([("1.2.2020",), ("31.02.2020",), ("",), ("15.11.1999",)], "t string")
    got = [r.d for r in df.select(TX.parse_day_first_date("t").alias("d")).collect()]
    assert [str(d) if d else None for d in got] == ["2020-02-01", None, None, "1999-11-15"]


def test_strip_removes_every_python_space_and_nothing_else(spark):
    spaces = "".join(c for c in map(chr, range(0x11000)) if c.isspace())
    texts = [spaces + "a" + spaces + "b" + spaces, "\u200ba\u180e", "a\n", "\n", "", "\t\tx", "x\r\n\n", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    got = {r.i: r.s for r in df.select("i", TX.py_strip("s").alias("s")).collect()}
    assert got == {i: t if t is None else t.strip() for i, t in enumerate(texts)}

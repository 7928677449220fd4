"""Trap T1/T2: JVM String.split semantics as Column expressions."""

from pyspark.sql import functions as F

from tests.conftest import explain_text
from kindling.functions.text import NON_WORD, SPACE, WHITESPACE, java_split, split_lines

# Expected results of JVM "s.split(p)" for the FIXTURES.md edge rows.
CASES = [
    ("", SPACE, [""]),
    ("   ", SPACE, []),
    (" a  b ", SPACE, ["", "a", "", "b"]),
    ("a b", SPACE, ["a", "b"]),
    ("...", NON_WORD, []),
    ("--hi, you--", NON_WORD, ["", "hi", "you"]),
    ("Étion dans", NON_WORD, ["", "tion", "dans"]),
    ("", NON_WORD, [""]),
    ("  x\t y  ", WHITESPACE, ["", "x", "y"]),
]


def test_java_split_edge_rows(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _, _) in enumerate(CASES)], "i INT, s STRING")
    for i, (s, pat, want) in enumerate(CASES):
        got = df.filter(F.col("i") == i).select(java_split("s", pat).alias("t")).first()["t"]
        assert got == want, (s, pat, got, want)


def test_java_split_null(spark):
    df = spark.createDataFrame([(None,)], "s STRING")
    assert df.select(java_split("s", SPACE).alias("t")).first()["t"] is None


def test_split_lines_final_break(spark):
    df = spark.createDataFrame([("a\r\nb\n\nc\n",), ("x\ry",)], "s STRING")
    got = [r["t"] for r in df.select(split_lines("s").alias("t")).collect()]
    assert got == [["a", "b", "", "c"], ["x", "y"]]


def test_split_stays_in_codegen(spark):
    df = spark.range(3).select(F.concat(F.lit(" a b "), F.col("id").cast("string")).alias("s"))
    plan = explain_text(df.select(java_split("s", SPACE).alias("t")))
    assert "Project [codegen id" in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def _jvm_split(s, pattern):
    """JVM ``String.split(pattern)``: no match keeps ``s``; trailing empties are dropped."""
    import re

    if s == "":
        return [""]
    parts = re.split(pattern, s, flags=re.ASCII)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_java_split_random_strings(spark):
    import random

    from kindling.functions.text import LINE_BREAK

    rnd = random.Random(7)
    alphabet = [" ", " ", "\t", "a", "b", "-", ",", "\r", "\n", "É", "_", "1"]
    values = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 9))) for _ in range(400)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, s STRING")
    for pat in (SPACE, NON_WORD, WHITESPACE, LINE_BREAK):
        got = {r["i"]: r["t"] for r in df.select("i", java_split("s", pat).alias("t")).collect()}
        for i, v in enumerate(values):
            assert got[i] == _jvm_split(v, pat), (repr(v), pat, got[i])

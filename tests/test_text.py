"""Letters, entities and nested wrappers against Python's own tables and a plain scanner."""

from __future__ import annotations

import html
import random
import re
import unicodedata

from pyspark.sql import functions as F

from matchledger.functions import text
from matchledger.functions.letters import ascii_letters, unescaped


def column(spark, values, of):
    rows = spark.createDataFrame(list(enumerate(values)), "k int, v string")
    return [r["o"] for r in rows.select("k", of(F.col("v")).alias("o")).orderBy("k").collect()]


def test_letters_are_decomposed(spark):
    names = ["Szőke Šibenik Žižkov", "ĞÜŞ ł ø ß Œ", "ﬁn ½ ™ Ⅳ 𝒳", "a b　c", "", "plain", *(chr(c) for c in range(0xA1, 0x600))]
    assert column(spark, names, ascii_letters) == [unicodedata.normalize("NFKD", n).encode("ascii", "ignore").decode() for n in names]


def test_names_are_compared_alike(spark):
    got = column(spark, ["Newell`s  Old", "NEWELL’S OLD", "C. A. Lanús ( B )", "  “Žďár”. "], text.normalized)
    assert got == ["newell's old", "newell's old", "c a lanus (b)", "zdar"]


def test_entities(spark):
    told = [
        "&#243; &#xF3; &#XF3 &Ntilde; &ntilde &amp;lt; &notit; &notanentity; & &; &# &#x; &#0; &#128; &#150; &#xD800; &#1114112; &#99999999999999; &#11; &#65534; &#128512; &copy2 &amp", "a&lt;b", "none", "", "x&&amp;&eacute;y",
        "&CounterClockwiseContourIntegral; &fjlig; &hellip;&frac12;", "&#00000000000000065;",
    ]
    assert column(spark, told, unescaped) == [html.unescape(t) for t in told]


OPENER = re.compile(r"\{\{\s*nowrap\s*\|", re.I)


def closing(s, at):
    """Where the braces that are open at a place close; None if never."""
    depth = 0
    for m in re.compile(r"\{\{|\}\}").finditer(s, at):
        depth += 1 if m[0] == "{{" else -1
        if not depth:
            return m.start()


def unwrap(s):
    """Wrappers from the left, one at a time; from one that never closes on, openings only."""
    first = OPENER.search(s)
    if not first:
        return s
    end = closing(s, first.start())
    if end is None:
        return OPENER.sub("", s)
    return unwrap(s[: first.start()] + s[first.end() : end] + s[end + 2 :])


def test_wrappers_at_any_depth(spark):
    r = random.Random(3)
    told = [
        "{{nowrap|{{a|{{b|c}}}} Colon}}", "{{nowrap|x {{nowrap|y}} z}}", "{{NoWrap | a}} b", "{{nowrap|A {{nowrap|B}} C", "}} {{nowrap|x}}", "{{a {{nowrap|x}}", "",
        *("".join(r.choice(["{{nowrap|", "{{x|", "}}", "a", "{{", " b"]) for _ in range(r.randrange(9))) for _ in range(300)),
    ]
    assert column(spark, told, text.unwrapped) == [unwrap(t) for t in told]
    assert column(spark, told[:2], text.clean) == ["{{a|}} Colon", "x y z"]


def test_entities_are_looked_up_in_small_parts(spark):
    from html import unescape
    from html.entities import html5

    from matchledger.functions import letters

    assert max(len(p.split("\x02")) for p in letters._named().split("\x03")) < 9
    names = sorted(html5)
    got = spark.createDataFrame([(f"a &{n} b",) for n in names], "t string").select("t", letters.unescaped(F.col("t")).alias("x")).collect()
    assert [r for r in got if r["x"] != unescape(r["t"])] == []


def test_signs_that_are_spelled_out_come_once_each(spark):
    from matchledger.functions import letters

    got = spark.createDataFrame([("ﬁn ½ ﬁ Ñ 漢 x" * 500,), ("",), ("漢",)], "t string").select(letters.ascii_letters(F.col("t")), letters.lowered(F.lit("ÀÞ×ßZ Σ")), letters.lowered(F.lit("ÀÞ×ßZ"))).collect()
    assert [r[0] for r in got] == ["fin 12 fi N  x" * 500, "", ""]
    assert {tuple(r)[1:] for r in got} == {("àþ×ßz σ", "àþ×ßz")}


def test_small_files_are_dealt(spark):
    from matchledger.plans import text_queries

    assert text_queries.QUERIES["core_name"](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 2

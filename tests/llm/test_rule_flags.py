"""Rules with flags find all that their expressions match."""

from __future__ import annotations

import random
import re

from matchledger.llm import secrets
from matchledger.llm.secrets import Rule

RULES = (
    Rule("k", "éclat[0-9]+", re.I), Rule("v", "a b c [0-9]+", re.X), Rule("s", "sick[0-9]", re.I), Rule("o", "(?i:abc)def"), Rule("w", "(?i)straße"),
    Rule("a", "sick[0-9]", re.I | re.A), Rule("n", "(?i)abc(?-i:DEF)"), Rule("u", "(?a:(?i:kis))x", re.I), Rule("c", "ab[ks]de", re.I), Rule("p", "plain[a-z]+"),
)


def test_only_these_letters_fold_beyond_ascii():
    beyond = [chr(c) for c in range(128, 0x30000) if not 0xD800 <= c < 0xE000]
    text = "".join(beyond)
    folded = {a for a in map(chr, range(128)) if a.isalpha() and re.search(a, text, re.I)}
    assert folded == secrets.FOLDED


def test_scan_equals_the_expressions(spark, docs):
    r = random.Random(6)
    parts = ["ÉCLAT12", "abc77", "ſick3", "SICK4", "aBcdef", "STRAßE", "straſe", "AbCDEF", "abcdef", "Kiſx", "kisx", "KISX", "abKde", "ABſDE", "plainx", " ", "zz"]
    texts = ["xx ÉCLAT12 abc77", *("".join(r.choice(parts) + r.choice(["", " "]) for _ in range(r.randrange(1, 6))) for _ in range(300))]
    for row in secrets.scan(docs(list(enumerate(texts))), RULES).collect():
        got = [(s["start"], s["kind"], s["end"]) for s in row["spans"]]
        want = sorted((s, k, e) for k, rule in enumerate(RULES) for s, e in rule.spans(texts[row["doc_id"]]))
        assert got == [(s, RULES[k].kind, e) for s, k, e in want], texts[row["doc_id"]]
    assert secrets.trigram_query("straße", re.I) and secrets.trigram_query("éclat", 0)

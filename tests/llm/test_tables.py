"""Secrets, archives, URL rules, mixing and decontamination on small tables."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from matchledger.llm import decontam, mixing, secrets, urlfilter, warc
from matchledger.llm.queries import op5_secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute_spans(t):
    got = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    got += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    got += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return [f"{k}:{s}:{e}" for s, _, k, e in sorted(got)]


def check_secrets(got, texts):
    rows = got.collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute_spans(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(x.startswith(k) for x in want) for k in ("assign", "access", "hex"))
        assert set(want) <= set(r["spans"].split(",")) | {""}
    return rows


def test_secrets_over_documents(spark):
    d = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    assert sum(r["n_assign"] + r["n_access"] + r["n_hex"] for r in check_secrets(op5_secrets(spark, d), texts)) > 0


def test_trigram_queries():
    assert secrets.trigram_query("[0-9a-f]{32,}") is None
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == [frozenset({"aki", "kia"})]
    got = secrets.trigram_query(secrets.BASE[0].pattern)
    assert frozenset({"tok", "oke", "ken"}) in got and frozenset({"api", "pi_", "i_k", "_ke", "key"}) in got and len(got) == 6
    assert secrets.trigram_query("(abc|d)x?") is None
    assert secrets.trigram_query("foo[0-9]*barbaz") == [frozenset({"foo", "bar", "arb", "rba", "baz"})]


def test_literals_beyond_ascii_and_long_runs(spark, docs):
    rule = (secrets.Rule("own", "ÉCLAT[0-9]+"),)
    assert [r["spans"] for r in secrets.scan(docs([(1, "x ÉCLAT12")]), rule).collect()] == [[("own", 2, 9)]]
    jwt = next(r for r in secrets.RULES if r.kind == "jwt")
    part = "eyJ" + "a" * 12
    assert jwt.spans(f"x {part}.{part}.{part} y") == [(2, 49)] and secrets.trigram_query(jwt.pattern)
    began = time.process_time()
    assert jwt.spans("eyJ" * 200_000) == []
    assert time.process_time() - began < 5  # linear: a quadratic scan takes minutes


def test_secrets_edges(spark, docs):
    rows = [(1, None), (2, ""), (3, "é TOKEN = 'abcdefgh1' token=short"), (4, "x" * 40 + " " + "0123456789abcdef" * 3), (5, "ghp_" + "Z1" * 20), (6, "paſſword=abcdefghi"), (3, "nothing"), (None, "secret:12345678"), (7, "AKIA" + "Z" * 30000)]
    got = [(r["doc_id"], [(s["kind"], s["start"], s["end"]) for s in r["spans"]]) for r in secrets.scan(docs(rows)).collect()]
    assert sorted(got, key=str) == sorted([(1, []), (2, []), (3, [("assign", 2, 20)]), (3, []), (4, [("hex", 41, 89)]), (5, [("github", 0, 44)]), (6, []), (None, [("assign", 0, 15)]), (7, [("access", 0, 30004)])], key=str)
    assert secrets.scan(docs([])).count() == 0


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")


def test_archive_round_trip(spark, tmp_path):
    big, other = "<p>é" * 50, "y" * 100
    rows = [(5, "u5", big), (3, "u3", big), (9, "u\r\n9", big), (1, "a", "small"), (2, "b", "small"), (4, None, None), (7, "c", other), (7, "d", other), (None, "e", other), (None, "f", "only without key" * 9)]
    at = str(tmp_path / "warc")
    warc.write(pages(spark, rows), at)
    assert spark.read.parquet(f"{at}/payloads").count() == 5
    got = warc.records(spark, at).withColumns({"type": warc.field(F.col("header"), "WARC-Type"), "refers": warc.field(F.col("header"), "WARC-Refers-To")}).collect()
    assert len(got) == len(rows)
    kinds = sorted((r["key"] or 0, r["type"], r["refers"]) for r in got)
    assert kinds[2:] == [(1, "response", None), (2, "response", None), (3, "response", None), (4, "response", None), (5, "revisit", "<urn:record:3>"), (7, "response", None), (7, "response", None), (9, "revisit", "<urn:record:3>")]
    for r in got:
        assert bytes(r["record"]) == bytes(r["header"]) + bytes(r["payload"]) + b"\r\n\r\n"
        assert f"Content-Length: {len(r['payload'])}\r\n\r\n".encode() in bytes(r["header"])
        assert hashlib.sha256(bytes(r["payload"])).hexdigest() == r["digest"]
    warc.export(spark, at, str(tmp_path / "out"))
    text = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    assert sorted(bytes(r["record"]) for r in got) == sorted(b"WARC/1.1" + x for x in text.split(b"WARC/1.1")[1:])


def test_archive_finds_damage(spark, tmp_path):
    at = str(tmp_path / "warc")
    warc.write(pages(spark, [(1, "u", "payload")]), at)
    spark.read.parquet(f"{at}/payloads").withColumn("payload", F.lit("other").cast("binary")).write.parquet(str(tmp_path / "bad/payloads"))
    spark.read.parquet(f"{at}/headers").write.parquet(str(tmp_path / "bad/headers"))
    with pytest.raises(Exception, match="damaged"):
        warc.records(spark, str(tmp_path / "bad")).select("payload").collect()


def test_empty_archive(spark, tmp_path):
    warc.write(pages(spark, []), str(tmp_path / "none"))
    assert warc.records(spark, str(tmp_path / "none")).count() == 0


def test_url_rules(spark):
    urls = ["http://a.net", "http://A.Net/x", "https://example.net/en/1", "https://my-example.net/en/1", "http://b.example.com/de/", "http://x.org/fr/?q", "http://x.org/de", None, "no scheme", "s://t/p/doubleclick.exe", "http://e.com/ads/1", "http://casino.com/", "http://net/", "http://x.net:80/"]
    got = {r["page_id"]: r for r in urlfilter.judge(pages(spark, [(i, u, None) for i, u in enumerate(urls)])).collect()}
    assert [(got[i]["host"], got[i]["path"]) for i in range(3)] == [("a.net", ""), ("a.net", "/x"), ("example.net", "/en/1")]
    assert [(got[i]["rule"], got[i]["verdict"]) for i in range(len(urls))] == [
        (None, "allow"), ("net/", "block"), ("example.net/en/", "allow"), ("net/", "block"), ("example.com/de/", "block"), ("org/fr/", "allow"), (None, "allow"),
        (None, "allow"), (None, "allow"), (None, "block"), (None, "block"), (None, "block"), ("net/", "block"), (None, "allow"),
    ]
    index = {r["name"]: r["token"] for r in urlfilter.rarest(spark.createDataFrame([("example.net/en/",), ("b.net/en/",)], "place string"), urlfilter.BASE).collect()}
    assert index["example.net/en/"] == "example" and index["net/"] == "net"
    table = spark.createDataFrame([(r.name, r.pattern, list(r.tokens) or None, r.verdict, r.rank) for r in urlfilter.RULES], "name string, pattern string, tokens array<string>, verdict string, rank int")
    table = table.union(spark.createDataFrame([("odd", "x$", None, "block", 0)], table.schema))  # on every URL
    again = {r["page_id"]: r for r in urlfilter.judge(pages(spark, [(i, u, None) for i, u in enumerate([*urls, "http://e.org/x", "http://ad.e.org/", "http://e.org/wp-login.php", "http://e.org/adslogin"])]), table).collect()}
    assert all(again[i]["verdict"] == got[i]["verdict"] or (urls[i] or "").endswith("x") for i in range(len(urls)))
    assert [again[len(urls) + i]["verdict"] for i in range(4)] == ["block", "block", "block", "allow"]
    assert urlfilter.judge(pages(spark, [])).count() == 0
    assert urlfilter.judge(pages(spark, [(1, "http://a.net/", None)] * 3)).count() == 3


def cells_of(spark, rows):
    return spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")


def test_raking_meets_its_targets(spark):
    """Shares that can be met: within the tolerance of all kept tokens, also where cells end at their bound."""
    cells = cells_of(spark, [("a", "en", "p", 900), ("a", "de", "p", 400), ("b", "en", "q", 300), ("b", "de", "p", 200), ("a", "en", "q", 300), ("b", "en", "p", 40)])
    shares = spark.createDataFrame([("source", "a", 0.6), ("source", "b", 0.4), ("lang", "en", 0.6), ("lang", "de", 0.4), ("topic", "p", 0.7), ("topic", "q", 0.3)], "margin string, value string, share double")
    chances, target = mixing.calibrated(cells, keep=0.5, shares=shares, tolerance=1e-6, rounds=40)
    got = mixing.report(chances, target).collect()
    want = {(r["margin"], r["value"]): r["share"] * 1070 for r in shares.collect()}
    assert {(r["margin"], r["value"]): r["expected"] for r in got} == pytest.approx(want, rel=1e-5)
    p = {(r["source"], r["lang"], r["topic"]): r["p"] for r in chances.collect()}
    assert all(0 <= v <= 1 for v in p.values()) and len(p) == 6


def test_targets_stay_within_the_tokens(spark):
    """b has 50 of 1,010 tokens and a tempered share of 29 %: all of it is wanted, and a gives the rest."""
    cells = cells_of(spark, [("a", "en", "p", 900), ("a", "de", "p", 50), ("b", "en", "q", 30), ("b", "de", "p", 20), ("a", "en", "q", 10)])
    chances, target = mixing.calibrated(cells)
    wanted = {(r["margin"], r["value"]): r["target"] for r in target.collect()}
    assert wanted[("source", "b")] == 50 and wanted[("source", "a")] == pytest.approx(455) and wanted[("topic", "q")] == 40
    for m in mixing.MARGINS:
        assert sum(v for (k, _), v in wanted.items() if k == m) == pytest.approx(505)
    told = mixing.report(chances, target).collect()
    assert all(abs(r["residual"]) <= 0.05 * 505 for r in told)
    p = {(r["source"], r["lang"], r["topic"]): (r["p"], r["tokens"]) for r in chances.collect()}
    for r in told:  # what is reported is what the probabilities give
        i = mixing.MARGINS.index(r["margin"])
        assert r["expected"] == pytest.approx(sum(x * n for k, (x, n) in p.items() if k[i] == r["value"]))


def test_decisions_meet_their_margins(spark):
    """On the documents: expected shares of what decide() keeps against the targets, and their difference as told."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    cells = docs.select(*mixing.cell_keys(), mixing.n_tokens(F.col("text")).alias("n")).groupBy(*mixing.MARGINS).agg(F.sum("n").alias("tokens"))
    chances, target = mixing.calibrated(cells)
    kept = mixing.decide(docs).groupBy().agg(F.sum(F.col("n_tokens") * F.col("p")).alias("n")).first()["n"]
    told = mixing.report(chances, target).collect()
    assert kept == pytest.approx(sum(r["target"] for r in told if r["margin"] == "lang"), rel=0.01)
    assert max(abs(r["residual"]) for r in told) < mixing.TOLERANCE * kept * 1.01


def test_a_topic_column_takes_the_place_of_the_expressions(spark):
    docs = spark.createDataFrame([(i, "some words here", "en", "a", "x" if i % 4 else None) for i in range(40)], "doc_id long, text string, lang string, source string, subject string")
    got = mixing.decide(docs, topic="subject")
    assert {r["topic"] for r in got.collect()} == {"x", ""} and mixing.sample(docs, topic="subject").columns == docs.columns


def test_sampling_edges(spark, docs):
    rows = [(i, f"word {i} text", "en", "a") for i in range(200)] + [(i, "mot é texte", "fr", None) for i in range(200, 220)] + [(300, None, None, None), (None, "x", "en", "a"), (1, "word 1 text", "en", "a"), (301, "w " * 30000, "en", "b")]
    got = mixing.decide(docs(rows)).collect()
    assert len(got) == len(rows)
    kept = mixing.sample(docs(rows))
    assert kept.columns == docs(rows).columns and kept.count() == sum(r["kept"] for r in got)
    assert next(r for r in got if r["doc_id"] == 300)["kept"] is False
    assert len({r["kept"] for r in got if r["doc_id"] == 1}) == 1
    assert mixing.decide(docs([])).count() == 0 == mixing.sample(docs([])).count()


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_decontamination_edges(spark, docs):
    base = [f"w{i}" for i in range(14)]
    bench = items(spark, [(1, " ".join(base)), (2, "Short Item"), (3, None), (4, "!!"), (4, "é é é"), (2, "Short Item")])
    rows = [
        (1, "x " + " ".join(base[:10]).upper() + " y"), (2, " ".join(base[:9])), (3, "a short, ITEM. and short item again"), (4, None), (5, ""), (None, "short item"),
        (6, " ".join(base + base)), (3, "clean"), (7, "short " * 30000), (8, "É É É"), (9, "é é é é"), (1, "x " + " ".join(base[:10]).upper() + " y"),
    ]
    got = sorted(((r["doc_id"] or 0, r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in decontam.judge(docs(rows), bench).collect()))
    assert got == [(0, 2, 2, 1, True), (1, 12, 10, 1, True), (1, 12, 10, 1, True), (2, 9, 0, 0, False), (3, 1, 0, 0, False), (3, 7, 4, 1, True), (4, 0, 0, 0, False), (5, 0, 0, 0, False), (6, 28, 28, 1, True), (7, 30000, 0, 0, False), (8, 3, 0, 0, False), (9, 4, 4, 1, True)]
    kept = decontam.keep_clean(docs(rows), bench)
    assert kept.columns == docs(rows).columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 5, 7, 8]
    assert decontam.judge(docs(rows), items(spark, [])).where("contaminated").count() == 0
    assert decontam.judge(docs([]), bench).count() == 0


def brute_near(rows, bench, slack=5):
    """(doc, item) by definition: windows of 10 words, their three rarest words, offsets within slack of each other."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    docs = {k: cut(t) for k, t in rows}
    df = Counter(w for ws in docs.values() for w in ws)
    found = set()
    for item, t in bench:
        w = cut(t)
        size = min(10, len(w))
        picked = [sorted(range(s, s + size), key=lambda i: (df[w[i]], i))[:3] for s in range(len(w) - size + 1)] if w else []
        for k, ws in docs.items():
            shifts = sorted((p - i, i) for i in {i for x in picked for i in x} for p, v in enumerate(ws) if v == w[i])
            if any(len({i for o, i in shifts if low <= o <= low + slack}) >= min(map(len, picked)) for low, _ in shifts):
                found.add((k, str(item)))
    return found


def test_proximity(spark, docs):
    rng = random.Random(6)
    base = [f"w{i}" for i in range(14)]
    bench = [(1, "the rare word of gold lies in the old stone"), (2, "rare gold"), (3, " ".join(base)), (4, "nowhere at all")]
    rows = [(1, "the rare fine word of gold lies in the very old stone"), (2, "rare " + "filler " * 40 + "gold"), (3, "Stone gold rare"), (4, "rare gold"), (5, None), (6, " ".join(base[:4] + ["x", "y"] + base[4:])), (7, " ".join(f"{w} x y z" for w in base))]
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words.insert(rng.randrange(len(words)), rng.choice(["x", "the", "gold", "w3"]))
        for _ in range(rng.randint(0, 5)):
            del words[rng.randrange(len(words))]
        rows.append((10 + i, " ".join(words)))
    want = brute_near(rows, bench)
    index = decontam.Index(docs(rows), items(spark, bench))
    got = {(r["id"], r["item"]) for r in index.proximity().collect()}
    assert got == want and {(1, "1"), (4, "2"), (6, "3")} <= got and not {(2, "2"), (7, "3"), (3, "1")} & got
    near = {r["doc_id"]: r["n_near"] for r in decontam.judge(docs(rows), items(spark, bench)).collect()}
    assert near == {k: sum(d == k for d, _ in want) for k, _ in rows}

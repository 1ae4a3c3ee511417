"""URL rules, quality rules, licences: against plain versions."""

import re
from collections import Counter

import pytest
from samples import no_docs, odd_docs, odd_rows, words

from larkspur.llm import license_scan, quality_rules, url_filter

URLS = [
    None, "", "no scheme", "http://", "http:///p", "https://EXAMPLE.org/es/1", "http://a.b.example.org/en/12?x#y",
    "http://example.org/en/", "http://myexample.org/es/", "http://x.com/fr/", "http://x.com/de/a", "http://x.com/de",
    "ftp://shop.com?u=/de/", "http://org/", "http://example.org", "http://x.net/es/", "a://b://c.com/de/",
    "http://h.com:80/de/", "http://example.org./es/", "http://x.com/de/a", "HTTP://É.ORG/ü", "http://a\nb.com/de/",
]


def judge(url):
    rest = url[url.index("://") + 3 :] if url and "://" in url else ""
    raw = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(raw) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), raw)
    fits = [
        (len(h + p), v, h + p) for h, p, v in url_filter.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, "allow", None))
    return host, path, best[2], best[1]


def test_urls_meet_rules(spark):
    rows = [(i if i != 3 else None, u, "x", "y", "z") for i, u in enumerate(URLS)] + [(5, URLS[5], "x", "y", "z")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, n string, host string")
    rules = spark.createDataFrame([*url_filter.RULES, (None, "/", "block"), url_filter.RULES[0]], "host string, path string, verdict string")
    got = url_filter.judge_urls(pages, rules)
    assert set(got.columns) == {"page_id", "url", "n", "host", "path", "rule", "verdict"}
    found = Counter(tuple(r) for r in got.select("page_id", "url", "host", "path", "rule", "verdict").collect())
    assert found == Counter((r[0], r[1], *judge(r[1])) for r in rows)
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    none = url_filter.judge_urls(pages, rules.limit(0), default="block")
    assert {r["verdict"] for r in none.collect()} == {"block"} and none.count() == len(rows)


def test_a_tie_of_rules_blocks(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    rules = spark.createDataFrame([("org", "/x", "allow"), ("org", "/x", "block")], "host string, path string, verdict string")
    assert url_filter.judge_urls(pages, rules).first()["verdict"] == "block"


def base(text):
    w, t = words(text), text or ""
    again, covered = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7)), set()
    for i in range(len(w) - 7):
        if again[tuple(w[i : i + 8])] > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in t.split("\n") if words(x)]
    n_symbols = sum(c in "#*$%&|<>" for c in t)
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), n_symbols, len(lines) - len(set(lines)), len(covered), failed


def test_signals_and_verdicts(spark):
    rows = odd_rows()
    loop = " ".join(f"w{i}" for i in range(12))
    more = [" ".join([loop] * k) + " tail" * j for k in (1, 2, 3) for j in (0, 5)] + ["a " * 15, "b " * 16 + "c"]
    rows += [(100 + i, t, None, None, None, *["x"] * 9) for i, t in enumerate(more)]
    got = quality_rules.judge_quality(odd_docs(spark, rows))
    assert got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = got.select("doc_id", "text", *names, "kept", "posterior").collect()
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r[2:8]) == base(r["text"]), r["doc_id"]
        assert r["kept"] == (not r["base_failed"] and r["posterior"] >= 0.5)
    assert quality_rules.judge_quality(no_docs(spark)).count() == 0


def test_the_iteration_finds_good_and_bad_rules():
    good, bad = (1,) * 7, (0,) * 7
    odd = (0, 1, 1, 1, 1, 1, 1)
    model = quality_rules.fit_votes([(good, 800), (bad, 100), (odd, 100), ((None,) * 7, 5)], 7)
    assert model.log_odds(good) > 0 > model.log_odds(bad) and model.log_odds(odd) > 0
    assert 0.8 < model.prior < 0.95 and model.on_good[0] < model.on_good[1]


@pytest.mark.parametrize("text, want", [
    ("intro words\nLicensed under the Apache License, Version 2.0.\nmore", {"Apache-2.0"}),
    ("LICENSED UNDER THE APACHE LICENCE, VERSION 2.0", {"Apache-2.0"}),
    ("x\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0.", {"MIT", "CC-BY-NC-4.0"}),
    ("This work is licensed under the GNU General\nPublic License, version 3.", {"GPL-3.0"}),
    ("we talk about a license here", set()), ("", set()), (None, set()), ("\n\n \n", set()), ("mit", set()),
])
def test_licences(spark, text, want):
    templates = spark.createDataFrame(license_scan.TEMPLATES, "license string, text string")
    docs = spark.createDataFrame([(1, text, "x", "y")], "doc_id long, text string, license string, n string")
    assert {r["license"] for r in license_scan.scan_licenses(docs, templates).collect()} == want


def test_licences_of_odd_texts(spark):
    templates = spark.createDataFrame(license_scan.TEMPLATES, "license string, text string")
    assert license_scan.scan_licenses(odd_docs(spark), templates).count() == 0
    assert license_scan.scan_licenses(no_docs(spark), templates).count() == 0
    assert license_scan.scan_licenses(odd_docs(spark), templates.limit(0)).count() == 0

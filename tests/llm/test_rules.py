"""URL rules, quality rules, secret and licence scans against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.llm import license_scan, quality, queries, secret_scan, sql, url_filter

from .brute import table

RULES = queries.URL_RULES


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :])[0]


def verdict(url, rules, default="allow"):
    host, path = url_parts(url)
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else default


def test_url_rules(spark):
    urls = [
        None, "", "x", "http://", "://", "http://net/", "http://net", "https://A.Example.NET/en/1?x#y", "http://example.net/de/1",
        "http://badexample.net/en/1", "http://example.com/de/", "http://example.com/de", "http://www.example.com/de/x?://", "http://o.org/fr/a",
        "http://org?/fr/", "http://a..net/x", "http://.net/x", "http://net./x", "http://u@example.net:80/en/", "ftp://example.net#/en/",
    ]
    urls += ["http://hot.example.net/en/" + str(i % 3) for i in range(300)]
    pages = spark.createDataFrame([(i if i else None, u, "h", "r") for i, u in enumerate(urls)], "page_id bigint, url string, host string, rule string")
    pages = pages.unionByName(pages.limit(5))
    more = [("a.b.net", "/", "allow"), ("b.net", "/long/path/", "block"), ("example.net", "/en/1", "block"), ("Example.Net", "/en/", "allow")]
    for rules in (RULES, RULES + more, []):
        frame = spark.createDataFrame(rules, "host string, path string, verdict string")
        found = url_filter.judge(pages, frame, keep=("page_id", "url")).collect()
        assert len(found) == len(urls) + 5
        lower = [(h.lower(), p, v) for h, p, v in rules]
        for r in found:
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == verdict(r["url"], lower), r
    empty = url_filter.judge(pages.limit(0), spark.createDataFrame(RULES, "host string, path string, verdict string"))
    assert empty.count() == 0 and empty.columns == ["page_id", "host", "path", "rule", "verdict"]


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def test_quality(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a", "a b", "a b c a b c", "x x x x x", "one\none\n \n\nTwo|<&>\n", "\x0b\x0c\r a\x85b c d 🤦🏼‍♂️"]
    texts += [" ".join(rng.choice("the of and a b c d e f".split()) for _ in range(n)) + "\n" for n in (3, 49, 50, 51, 120)]
    texts += ["\n".join("- the " + " ".join(map(str, rng.sample(range(9999), 9))) for _ in range(8)), "word " * 60 + "\n" + "…\n...\n"]
    texts += [" ".join(map(str, range(20_000))) + " the of" * 900, texts[-1], texts[-2]]
    frame = table(spark, *texts)
    found = {r["doc_id"]: r for r in quality.judge(frame).collect()}
    for i, text in enumerate(texts):
        own = found[i]
        if len(text or "") < 50_000:
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
            assert tuple(own[c] for c in names) == counts(text), (i, text)
        assert own["kept"] == (not own["base_failed"] and not own["broken_rules"])
    assert found[16]["n_repeat_words"] == 1800 and found[16]["n_words"] == 21_800
    assert not found[14]["kept"] and found[14]["broken_rules"] == ["bullet_line_ratio"]
    assert quality.judge(frame.limit(0)).count() == 0


BASE = {
    "assign": (re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), lambda m: len(m[2]) >= 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
    "pem": (re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:(?!-----)[\s\S])*-----END [A-Z ]*PRIVATE KEY-----|(?:\s+[A-Za-z0-9+/=]{16,})*)", re.A), lambda m: True),
    "jwt": (re.compile(r"eyJ[\w-]{8,}\.eyJ[\w-]{8,}\.[\w-]{8,}", re.A), lambda m: True),
    "prefixed": (re.compile(r"gh[opsru]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[\w-]{35}", re.A), lambda m: True),
    "login": (re.compile(r"[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20:/@]+:[^\x00-\x20:/@]+@"), lambda m: True),
}


def spans(text):
    found = [
        (m.start(), i, kind, m.end()) for i, (kind, (p, ok)) in enumerate(BASE.items()) for m in p.finditer(text or "") if ok(m)
    ]
    return sorted(found)


SECRETS = [
    None, "", "password=abcdefabcdef", "token: secret: aaaaaaaaaaaaaaaa", "TOKEN = \"" + "a" * 40 + "\" x", "AKIA" + "B" * 14, "AKIA" + "B" * 13,
    "AKIAAKIA" + "Z9" * 8 + " deadbeefdeadbeef", "🤦🏼‍♂️ é api_key='x.y_z=/+-012345678901' 0123456789abcdef0", "apikey::aaaaaaaaaaaaa passwd=short",
    "secret=token=0123456789abcdef", "-----BEGIN RSA PRIVATE KEY-----\npassword=00000000000000000000", "x" * 30_000 + "secret=abcdefghijklm",
    "a -----BEGIN EC PRIVATE KEY-----\nDEK-Info: AES-128-CBC,00\n\nQUJD\nRA==\n-----END EC PRIVATE KEY----- b -----BEGIN PRIVATE KEY----- is a mark",
    "-----BEGIN PRIVATE KEY-----\n" + ("QUJD" * 16 + "\n") * 600 + "-----END PRIVATE KEY-----\nx", "-----BEGIN PRIVATE KEY-----\n" + "QUJD" * 16 + "\nQUJDQUJDQUJDQUJD end",
    "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl. ghp_" + "a1" * 18 + " xoxb-1234567890-x sk_live_" + "Z" * 16 + " AIza" + "-_" * 18, "see db+x://me:pa55@host and http://host:80/a@b",
]


def test_secrets_and_ledger(spark):
    texts = [*SECRETS, *SECRETS[2:4], *["hot secret=abcdefabcdef12"] * 40]
    frame = table(spark, *texts)
    ledger = secret_scan.Ledger.new(spark)
    found = secret_scan.scan_versions(frame, ledger).collect()
    assert len(found) == len(texts)
    for r in found:
        assert [tuple(s) for s in r["spans"]] == spans(texts[r["doc_id"]]), texts[r["doc_id"]]
    scanned = ledger.rows().count()
    assert scanned == len({t or "" for t in texts})
    # nothing new: nothing read again; a new version of a rule and a new text: only these
    secret_scan.scan_versions(frame, ledger).count()
    assert ledger.rows().count() == scanned
    newer = [*secret_scan.RULES[:2], secret_scan.Rule("hex", 2, r"[0-9a-f]{32,}"), *secret_scan.RULES[3:]]
    again = secret_scan.scan_versions(frame, ledger, newer).collect()
    assert ledger.rows().filter("size(scans) = 1 AND scans[0].rule = 'hex@2'").count() == scanned
    for r in again:
        assert [tuple(s) for s in r["spans"]] == [s for s in spans(texts[r["doc_id"]]) if s[2] != "hex" or s[3] - s[0] >= 32]
    secret_scan.scan_versions(table(spark, "fresh secret=abcdefabcdef12"), ledger).count()
    assert ledger.rows().count() == 2 * scanned + 1
    assert secret_scan.scan_versions(frame.limit(0), ledger).count() == 0


def test_masking_joins_overlaps(spark):
    text = "a token = \"deadbeefdeadbeefdead\" b AKIA" + "B" * 14
    found = secret_scan.scan_versions(table(spark, text), secret_scan.Ledger.new(spark), keep=("doc_id", "text"))
    assert found.select(secret_scan.masked("text", "spans").alias("t")).first()["t"] == "a [secret]\" b [secret]"


def test_bodies_of_keys_are_masked(spark):
    body = "MIIEow" + "Ab+/" * 20
    texts = [f"x -----BEGIN RSA PRIVATE KEY-----\n{body}\n{body}==\n-----END RSA PRIVATE KEY-----\ny", f"-----BEGIN PRIVATE KEY-----\n{body}\nshort words stay"]
    found = secret_scan.scan_versions(table(spark, *texts), secret_scan.Ledger.new(spark), keep=("doc_id", "text"))
    clean = [r["t"] for r in found.orderBy("doc_id").select(secret_scan.masked("text", "spans").alias("t")).collect()]
    assert clean == ["x [secret]\ny", "[secret]\nshort words stay"]


def test_digest_columns_and_sql(spark, tmp_path):
    frame = table(spark, *SECRETS).select("doc_id", "text", "lang", "source", "n_chars")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in queries.op2_secret_scan(spark, str(tmp_path)).collect()}
    for i, text in enumerate(SECRETS):
        base = ",".join(f"{s[2]}:{s[0]}:{s[3]}" for s in spans(text) if s[2] in ("assign", "access", "hex"))
        assert rows[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[2] == k for s in spans(text)) for k in ("assign", "access", "hex")]
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for name in ("op2_secret_scan", "op6_quality_rules"):
        cursor = duck.execute(sql.SQL[name])
        columns = [d[0] for d in cursor.description]
        frame = queries.QUERIES[name](spark, str(tmp_path)).select(*columns)
        assert sorted(map(repr, map(tuple, frame.collect()))) == sorted(map(repr, cursor.fetchall())), name


def test_licences(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    files = [
        ("r/LICENSE", mit), ("r/a/x.py", "code here\n" + apache + "\nmore"), ("r/a/y.py", None), ("r/a/b/z.py", "no licence words"),
        ("r/c/LICENSE.txt", apache), ("r/c/d/e/f.py", ""), ("q/x.py", "plain"), ("top.py", "plain"), (None, mit), ("r/c/bare", mit), ("r/c/bare", mit),
        ("s/doc", "All about a licence that is none of these and goes on and on about something else entirely."), ("s/t/u", "x " * 30_000),
    ]
    files += [(f"r/hot/{i}", "same") for i in range(200)]
    frame = spark.createDataFrame([(p, t, "o", 1.0) for p, t in files], "path string, text string, own string, cosine double")
    found = {r["path"]: (r["own"], r["inherited"], r["source"]) for r in license_scan.scan(frame).collect()}
    assert len(found) == len({p for p, _ in files if p})
    assert found["r/LICENSE"] == ("MIT", None, None) and found["r/a/x.py"][0] == "Apache-2.0"
    assert found["r/a/y.py"] == (None, "MIT", "r/LICENSE") and found["r/a/b/z.py"] == (None, "MIT", "r/LICENSE")
    assert found["r/c/d/e/f.py"] == (None, "Apache-2.0", "r/c/LICENSE.txt")
    assert found["q/x.py"] == found["top.py"] == found["s/doc"] == found["s/t/u"] == (None, None, None)
    assert all(found[f"r/hot/{i}"] == (None, "MIT", "r/LICENSE") for i in range(200))
    assert license_scan.scan(frame.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(license_scan.TEMPLATES))
def test_every_template_names_itself(spark, name):
    frame = spark.createDataFrame([("a/f", f"Some code. {license_scan.TEMPLATES[name]} Bye")], "path string, text string")
    assert license_scan.scan(frame).filter(F.col("own") == name).count() == 1


def test_licence_cosines_equal_brute_force_however_often_a_statement_occurs(spark):
    body = dict(license_scan.PARAGRAPHS)["MIT"].split()
    wrapped = "Copyright 2020 Somebody\n\n" + "\n".join(" ".join(body[i : i + 11]) for i in range(0, len(body), 11)) + "\n\nThe above notice shall be included."
    files = [("a/LICENSE", wrapped), ("a/b/c.py", "x = 1"), ("g/x.c", dict(license_scan.PARAGRAPHS)["GPL-2.0"] + "\n\nint main;")]
    files += [(f"p/{i}", "This project is released under the MIT License.") for i in range(400)]
    frame = spark.createDataFrame(files, "path string, text string")
    found = {r["path"]: r for r in license_scan.scan(frame).collect()}
    assert found["a/LICENSE"]["own"] == "MIT" and found["a/LICENSE"]["cosine"] > 0.99 and found["a/b/c.py"]["inherited"] == "MIT"
    assert found["g/x.c"]["own"] == "GPL-2.0"
    assert all(found[f"p/{i}"]["own"] == "MIT" and found[f"p/{i}"]["cosine"] > 0.7 for i in range(400))
    # cosines of all statements by hand
    counted = license_scan.statements(frame, "path", "text").collect()
    units: dict[tuple, dict[str, int]] = {}
    for r in counted:
        units.setdefault((r["path"], r["unit"]), {})[r["term"]] = r["tf"]
    df = Counter(t for u in units.values() for t in u)
    idf = lambda t: 1 + math.log((1 + len(units)) / (1 + df.get(t, 1)))
    token = re.compile(r"[a-z0-9](?:[a-z0-9.-]*[a-z0-9])?")
    templates = [(n, Counter(token.findall(w.lower()))) for n, w in [*license_scan.TEMPLATES.items(), *license_scan.PARAGRAPHS]]

    def cosine(a, b):
        norm = lambda u: math.sqrt(sum((k * idf(t)) ** 2 for t, k in u.items()))
        return sum(k * b[t] * idf(t) ** 2 for t, k in a.items() if t in b) / norm(a) / norm(b)

    rows = license_scan.similarities(spark.createDataFrame(counted), license_scan.TEMPLATES).collect()
    assert len(rows) > 400
    for r in rows:
        best = max(cosine(units[r["path"], r["unit"]], b) for _, b in templates)
        assert r["cosine"] == pytest.approx(best, abs=2e-6)

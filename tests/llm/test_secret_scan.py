import random
import re

import pytest
from pyspark.sql import functions as F

from gridsight.llm import secret_scan as s

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def base(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    return sorted(found)


def texts():
    pick = random.Random(3)
    bits = ["token", "TOKEN", "Secret", "api_key", "apikey", "passwd", "password", " ", "=", ":", '"', "'", "abcdefgh", "abc", "é", "𝒳",
            "AKIA", "ABCDEFGHIJKL", "deadbeef" * 4, "0123456789abcdef", "\n", "  ", "==", "ſecret", "x.y-z/+", "toKen"]
    out = [None, "", "token=secret:abcdefghijk", "token = \"" + "a1" * 20 + "\"", "AKIAAKIA" + "Z" * 9, "token==abcdefg",
           "deadbeef" * 3 + "x" + "deadbeef" * 4, "password:\nabcdefgh", "a secret: 'tis nothing"]
    return out + ["".join(pick.choice(bits) for _ in range(pick.randint(1, 60))) for _ in range(400)]


def report(spark, ledger, load="1", rules=s.RULES):
    return {(r.path, tuple((x.start, x.nth, x.kind, x.end) for x in r.spans)) for r in s.report(spark, ledger, load, rules).collect()}


def test_same_as_plain_search(spark, folder):
    data = [(None if i == 7 else i, t, "blob", 1) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, blob string, rules int")
    s.scan_load(docs, folder, "1", rules=s.BASE_RULES)
    assert report(spark, folder, rules=s.BASE_RULES) == {(d, tuple(base(t or ""))) for d, t, *_ in data}


def test_whole_rule_set_keeps_base_spans(spark, folder):
    text = "x -----BEGIN RSA PRIVATE KEY----- token=abcdefgh1 ghp_" + "z" * 36
    s.scan_load(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), folder, "1")
    found = s.report(spark, folder, "1").select(s.listed("spans").alias("x")).first().x
    assert found == f"pem:2:33,assign:34:49,forge:50:{len(text)}"


def test_only_unseen_pairs_are_scanned(spark, folder):
    one = spark.createDataFrame([(1, "token=abcdefgh"), (2, "clean"), (3, "token=abcdefgh")], "doc_id bigint, text string")
    s.scan_load(one, folder, "a")
    findings = lambda load: spark.read.parquet(f"{folder}/findings/load={load}").count()
    marks = lambda load: {tuple(r.rules) for r in spark.read.parquet(f"{folder}/marks/load={load}").collect()}
    assert findings("a") == 1 and spark.read.parquet(f"{folder}/marks/load=a").count() == 2
    s.scan_load(spark.createDataFrame([(9, "token=abcdefgh"), (8, "passwd=12345678")], "doc_id bigint, text string"), folder, "b")
    assert findings("b") == 1 and spark.read.parquet(f"{folder}/marks/load=b").count() == 1
    assert {p: len(x) for p, x in report(spark, folder, "b")} == {9: 1, 8: 1}
    newer = (s.Rule("assign", 2, s.BASE_RULES[0].pattern, 2, 4), *s.RULES[1:])
    s.scan_load(one, folder, "c", rules=newer)
    assert marks("c") == {("assign@2",)} and findings("c") == 1
    s.scan_load(one, folder, "a")
    assert findings("a") == 1, "a load that runs again finds the same"


def test_redact(spark, folder):
    rows = [(1, "é token=abcdefgh1 and " + "ab" * 16 + " end", 9), (2, "clean", 5), (3, None, None), (4, "token=" + "ab" * 16, 38)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint")
    s.scan_load(docs, folder, "1")
    got = sorted(tuple(r) for r in s.redact(docs, folder, length="n_chars").collect())
    assert got == [(1, "é [secret] and [secret] end", 27), (2, "clean", 5), (3, None, None), (4, "[secret]", 8)]


def test_a_replaced_load_keeps_what_it_scanned(spark, folder):
    load = lambda name, *rows: s.scan_load(spark.createDataFrame(rows, "doc_id bigint, text string"), folder, name)
    load("1", (1, "token=abcdefgh"), (2, "clean"))
    load("2", (5, "token=abcdefgh"))
    load("1", (1, "corrected"), (2, "passwd=12345678"))
    assert {p: len(x) for p, x in report(spark, folder, "2")} == {5: 1}
    assert {p: len(x) for p, x in report(spark, folder, "1")} == {1: 0, 2: 1}
    docs = spark.createDataFrame([(5, "token=abcdefgh")], "doc_id bigint, text string")
    assert s.redact(docs, folder).first().text == "[secret]"


def test_findings_of_a_failed_load_count_once(spark, folder, monkeypatch):
    docs = spark.createDataFrame([(1, "token=abcdefgh"), (2, "passwd=12345678")], "doc_id bigint, text string")
    s.scan_load(docs.where("doc_id = 1"), folder, "1")
    real, failed = s._folder, []
    monkeypatch.setattr(s, "_folder", lambda ledger, table, load: f"no-such-fs://x/{failed.append(1)}" if table == "marks" and load == "1" else real(ledger, table, load))
    with pytest.raises(Exception):
        s.scan_load(docs, folder, "1")
    monkeypatch.undo()
    assert failed
    s.scan_load(docs.where("doc_id = 2"), folder, "2")
    s.scan_load(docs, folder, "1")
    for load, want in (("1", {1: 1, 2: 1}), ("2", {2: 1})):
        assert {p: len(x) for p, x in report(spark, folder, load)} == want


LINES = "".join(f"{chr(65 + i) * 60}+/9{i}\n" for i in range(25))
PEM = f"-----BEGIN RSA PRIVATE KEY-----\n{LINES}QUJDRA==\n-----END RSA PRIVATE KEY-----"
PGP = f"-----BEGIN PGP PRIVATE KEY BLOCK-----\nVersion: GnuPG v2\n\n{LINES}abc\n=wXyZ\n-----END PGP PRIVATE KEY BLOCK-----"
CUT = f"-----BEGIN EC PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,AB12\n\n{LINES}QUJDRA=="


def test_redact_whole_keys(spark, folder):
    cut = {
        "é a {} b": [PEM, PGP, PEM.replace("\n", "\\n"), PEM.replace("\n", " "), PEM.replace("\n", "\n> "),
                     CUT, "-----BEGIN PRIVATE KEY-----" + "Ab1/" * 300_000],
        "x {}\nno key": [CUT.replace("QUJDRA==", "QUJDRA"), CUT.removesuffix("\nQUJDRA=="), CUT.replace("\n", "\r\n"),
                         PEM.replace("END RSA", "END DSA").split("\n-----END")[0]],
        "{} and token is no key": ["-----BEGIN PRIVATE KEY-----"],
        "{} then {}": [PEM, CUT],
    }
    rows = [(f"{i}", form.replace("{}", key)) for form, keys in cut.items() for i, key in enumerate(keys)]
    docs = spark.createDataFrame([(n, f, t) for n, (f, (_, t)) in enumerate(zip([f for f, k in cut.items() for _ in k], rows))], "doc_id int, form string, text string")
    s.scan_load(docs.select("doc_id", "text"), folder, "1")
    for r in s.redact(docs, folder).collect():
        assert r.text == r.form.replace("{}", "[secret]")


def test_line_rules_know_the_begin_line(spark, folder):
    docs = spark.createDataFrame([(1, "x " + PEM)], "doc_id int, text string")
    spans = lambda rules: next(iter(report(spark, folder, rules=rules)))[1]
    s.scan_load(docs, folder, "1", rules=s.LINE_RULES)
    assert spans(s.LINE_RULES) == ((2, 3, "pem", 33),)
    s.scan_load(docs, folder, "1")
    assert spans(s.RULES) == ((2, 3, "pem", 2 + len(PEM)),)


def test_empty_and_native(spark, folder):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    s.scan_load(docs, folder, "1")
    assert s.report(spark, folder, "1").count() == 0
    plan = s.spans(spark.createDataFrame([], "blob binary, text string, rules array<string>"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert s.report(spark, folder, "1").select(F.size("spans")).count() == 0


def test_results_stay_when_others_follow(spark, folder):
    docs = spark.createDataFrame([(1, "token=abcdefgh " + "ab" * 16), (2, "clean")], "doc_id bigint, text string")
    s.scan_load(docs, folder, "1")
    some = (s.BASE_RULES[0],)
    reports = [s.report(spark, folder, "1", r) for r in (s.RULES, some)]
    cuts = [s.redact(docs, folder, rules=s.RULES, load="1"), s.redact(docs, folder, rules=some), s.redact(docs.where("doc_id = 2"), folder)]
    assert [sum(len(r.spans) for r in x.collect()) for x in reports] == [2, 1]
    assert [sorted(r.text for r in x.collect()) for x in cuts] == [["[secret] [secret]", "clean"], ["[secret] " + "ab" * 16, "clean"], ["clean"]]


def test_a_load_reports_its_own_blobs(spark, folder):
    for load, rows in (("1", [(1, "token=abcdefgh"), (2, "secret=12345678")]), ("2", [(3, "token=abcdefgh"), (4, None)])):
        s.scan_load(spark.createDataFrame(rows, "doc_id bigint, text string"), folder, load)
    assert s._found(spark, folder, s.RULES, "2").count() == 1 and s._found(spark, folder, s.RULES, None).count() == 2
    assert {p: len(x) for p, x in report(spark, folder, "2")} == {3: 1, 4: 0}


def test_known_texts_are_left_before_the_shuffle(spark, folder):
    rows = [(i, f"token=abcdefgh{i % 7}") for i in range(50)] + [(99, None)]
    path = f"{folder}/docs"
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(path)
    docs = spark.read.parquet(path)
    versions = docs.select("text", s.blob("text").alias("blob"))
    unseen = spark.createDataFrame([(bytes(r.blob), ["assign@1"]) for r in versions.where("doc_id < 2").collect()], "blob binary, rules array<string>")
    texts = {m: s.unseen_texts(versions, unseen, m) for m in (2, 1)}
    assert {m: sorted(r.text for r in x.collect()) for m, x in texts.items()} == {m: ["token=abcdefgh0", "token=abcdefgh1"] for m in (2, 1)}
    plan = texts[2]._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi, BuildRight" in plan[plan.index("Exchange hashpartitioning(blob"):], "texts meet the unseen blobs before they move"


def test_query_reports_whole_keys(spark, folder):
    """The query against a search by hand for what its SQL cannot say, on keys that have their END line."""
    from gridsight.llm.queries import QUERIES

    rows = [(1, f"é {PEM} and token=abcdefgh1 {PGP}"), (2, PEM), (3, "no key"), (4, None), (5, PEM + PEM)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    want = {}
    for doc, text in rows:
        at, spans = 0, [(a, n, k, b) for a, n, k, b in base(text or "")]
        while (start := (text or "").find("-----BEGIN ", at)) >= 0:
            at = text.index("-----", text.index("-----END ", start) + 5) + 5
            spans.append((start, 3, "pem", at))
        want[doc] = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))
    assert {r.doc_id: r.spans for r in QUERIES["op4_secret_scan"](spark, folder).collect()} == want


def test_a_very_long_text(spark, folder):
    text = "x" * 3_000_000 + " token=abcdefgh " + "é " * 500_000 + "ab" * 16
    s.scan_load(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), folder, "1")
    assert next(iter(report(spark, folder)))[1] == ((3_000_001, 0, "assign", 3_000_015), (len(text) - 32, 2, "hex", len(text)))

"""Quality rules, secrets and personal data: DataFrame expressions against row-by-row results."""

import random
import time

import brute
import pytest
from conftest import odd_texts, text
from pyspark.sql import functions as F

from tidemark.llm import pii, quality_rules, secrets, spans

BASE = [t[1] for t in odd_texts()]


def noise(seed: int, parts: list[str], n: int = 60) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice(parts) for _ in range(draw.randrange(1, 30))) for _ in range(n)]


def rows_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"source": F.lit("s"), "lang": F.lit("x")})


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow")), plan


def test_measures_row_by_row(spark):
    texts = BASE + noise(1, ["a ", "b ", "c ", "\n", "# ", "| ", "a b c d e ", "\t", "\r\n", "\x0b", "\x1c", " ", "É "])
    rows = quality_rules.measures(rows_of(spark, texts)).collect()
    for r in rows:
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == brute.measures(texts[r["id"]]), texts[r["id"]]


def test_rules_are_weighed_and_good_texts_stay(spark):
    good = [text(k) for k in range(150)]
    junk = [" ".join(f"{w} |" for w in text(k).split()) for k in range(200, 220)] + [text(k).upper() + " A" * 300 for k in range(230, 240)]
    rows = {r["doc_id"]: r for r in quality_rules.judged(rows_of(spark, good + junk + ["short text", None])).collect()}
    assert all(rows[k]["kept"] for k in range(150))
    assert not any(rows[k]["kept"] for k in range(150, 182))
    assert rows[180]["base_failed"] and rows[181]["base_failed"] and not rows[150]["base_failed"]
    assert all(0 <= r["good_chance"] <= 1 for r in rows.values())


def test_estimate_has_no_votes_to_learn_from(spark):
    none = spark.createDataFrame([], "votes array<byte>, n long")
    found, prior = quality_rules.estimate(none, 3), quality_rules._prior(3)
    assert found.poor == pytest.approx(prior.poor)
    assert [x for pair in found.votes for v in pair for x in v] == pytest.approx([x for pair in prior.votes for v in pair for x in v])


def test_quality_rules_on_odd_rows(odd, nothing, clashing):
    rows = quality_rules.judged(odd)
    no_python(rows)
    assert rows.count() == odd.count() and quality_rules.judged(clashing).count() == odd.count()
    assert quality_rules.judged(nothing).collect() == []
    assert rows.where("doc_id in (5, 6, 7, 8) and (kept or not base_failed)").count() == 0


SECRETS = [
    "password=", "TOKEN : ", "api_key\": \"", "apikey='", "secret=", "abcdef", "12345", "AKIA", "ABCDEFGH12345678", "deadbeef", "0123456789abcdef", "-", " ", ".", "=", ":", "x", "é", "ſecret=", "passwd = ",
]
PERSONAL = [
    "a.b", "@", "mail.example.com", ".", "+49 ", "1", "23", "4", "-", " ", "(030) ", "192.168.1.", "0255", "300", "4111 1111 1111 1111", "4041894974608795", "é", "x", "\n", "%", "+1 (988) 555-2485",
]


@pytest.mark.parametrize("seed", range(2))
def test_secrets_row_by_row(spark, seed):
    texts = BASE + noise(seed, SECRETS, 150)
    rows = secrets.digest(secrets.scan(rows_of(spark, texts), repository=F.col("source"), owner=F.col("source"))).collect()
    for r in rows:
        counts, listed, hashed = brute.secrets(texts[r["doc_id"]])
        assert (list(r[1:4]), r["base_sha256"]) == (counts, hashed), texts[r["doc_id"]]
        assert set(filter(None, listed.split(","))) <= set(r["spans"].split(","))


def test_ownership_tells_examples_from_live_values(spark):
    value = "9f8e7d6c5b4a39281706f5e4d3c2b1a0ffee9988"
    docs = [(k, f"token = {value}", f"s{k % 5}") for k in range(20)] + [(50, "key Zx81-kQ_97hTe2LmPw40", "s1"), (51, "password = changeme123", "s2")]
    docs += [(60 + k, "shared Qy77-aB_12cDe3FgHi45", f"s{k}") for k in range(4)] + [(70, "api_key=u8Tq2Lw9zR4x", "s3")]
    rows = spark.createDataFrame(docs, "doc_id long, text string, source string")
    found = secrets.scan(rows, repository=F.col("source"), owner=F.col("source"))
    no_python(found)
    by = {r["doc_id"]: r for r in secrets.digest(found).collect()}
    assert all(by[k]["n_live"] == 0 and by[k]["n_copied"] == 2 for k in range(20))
    assert by[50]["spans"].startswith("token:") and by[51]["n_copied"] == 1 and by[70]["n_live"] == 1
    assert all(by[60 + k]["spans"] == "" for k in range(4))


def test_secrets_on_odd_rows(odd, nothing, clashing):
    scan = lambda df: secrets.digest(secrets.scan(df, repository=F.struct("source", "lang"), owner=F.col("source")))
    assert scan(odd).count() == odd.count() == scan(clashing).count()
    assert scan(nothing).collect() == []


@pytest.mark.parametrize("seed", range(2))
def test_personal_data_row_by_row(spark, seed):
    texts = BASE + noise(seed, PERSONAL, 150)
    found = pii.find(rows_of(spark, texts))
    no_python(found)
    for r in pii.digest(found).collect():
        counts, listed, hashed = brute.personal(texts[r["doc_id"]])
        assert (list(r[1:5]), r["base_sha256"]) == (counts, hashed), texts[r["doc_id"]]
        assert set(filter(None, listed.split(","))) <= set(r["spans"].split(","))


def test_terms_that_give_an_entity_away(spark):
    docs = [(k, f"{text(k, 30)} Zorvax writes from ann@example.org {text(k + 500, 30)}") for k in range(6)]
    docs += [(100 + k, f"{text(k + 900, 40)} writes from somewhere") for k in range(60)]
    # Copies are no evidence: the terms around this one occur once.
    docs += [(200 + k, f"{text(7, 20)} bob@example.org {text(8, 20)}") for k in range(9)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.find(rows).collect()}
    cut = lambda i: {dict(docs)[i][s["start"] : s["end"]] for s in found[i]["more"]}
    assert all(cut(k) == {"Zorvax"} for k in range(6))
    assert all(cut(200 + k) == set() for k in range(9)) and all(found[100 + k]["base"] == [] for k in range(60))
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(rows).collect()}
    assert clean[0] == docs[0][1].replace("ann@example.org", "[EMAIL]").replace("Zorvax", "")
    assert clean[100] == docs[6][1] and "[EMAIL]" in clean[203]


def test_terms_are_looked_for_in_whole_texts(spark):
    docs = [(k, f"Zorvax {text(k, 60)} mail ann@example.org {text(k + 500, 60)} zorvax, ZORVAX") for k in range(4)]
    # All with the same surroundings of the address.
    docs += [(50 + k, f"{text(k + 300, 30)} Quillon {text(77, 20)} bob@example.com {text(78, 20)}") for k in range(4)]
    docs += [(100 + k, f"{text(k + 900, 40)} mail ") for k in range(60)] + [(99, f"zorva xzorvax {text(990, 9)}"), (98, "eve@example.net Quark"), (97, "eve@example.net Quark 1")]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    found = pii.find(rows)
    no_python(found)
    cut = {r["doc_id"]: [dict(docs)[r["doc_id"]][s["start"] : s["end"]] for s in sorted(r["more"])] for r in found.collect()}
    assert all(cut[k] == ["Zorvax", "zorvax", "ZORVAX"] for k in range(4))
    assert all("Quillon" in cut[50 + k] for k in range(4))
    assert all(cut[k] == [] for k in (*range(97, 160),))
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(rows).collect()}
    assert "zorvax" not in clean[0].lower() and "[EMAIL]" in clean[0] and clean[99] == dict(docs)[99]


def test_copies_hide_no_disclosing_term(spark):
    docs = [f"{text(k, 30)} Zorvax mail ann@example.org {text(k + 500, 30)}" for k in range(5)] * 20
    docs += [f"{text(k + 900, 20)} mail" for k in range(300)]
    found = pii.find(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).collect()
    cut = {r["doc_id"]: {docs[r["doc_id"]][s["start"] : s["end"]]: s["share"] for s in r["more"]} for r in found}
    assert len(found) == len(docs) and all(cut[k] == {"Zorvax": pytest.approx(1.0)} for k in range(100))


def test_sanitised_on_odd_rows(odd, nothing, clashing):
    texts = lambda df: sorted(str((r["doc_id"], r["text"])) for r in df.collect())
    assert texts(pii.sanitised(odd)) == texts(odd)
    out = pii.sanitised(clashing)
    assert out.columns == clashing.columns and texts(out) == texts(odd)
    assert pii.sanitised(nothing).collect() == []


def test_replaced_spans_may_overlap(spark):
    row = spark.createDataFrame([("0123456789",)], "t string").withColumn("s", F.expr("array(named_struct('start', 2, 'end', 5, 'new', 'A'), named_struct('start', 4, 'end', 7, 'new', 'B'), named_struct('start', 8, 'end', 9, 'new', ''))"))
    assert row.select(spans.replaced(F.col("t"), F.col("s"))).first()[0] == "01A79"


def test_a_token_may_follow_an_equals_sign(spark):
    """NAME=value credentials whose name is no word of the base pattern; spans of the base pattern add nothing."""
    value = "Ab9dEf3hIj5lMn7pQr1t"
    texts = [f"secret_key={value}", f"secret_key: {value}", f"export ACCESS_KEY={value}x;", f"sig={value}y==", f"token={value}z"]
    rows = spark.createDataFrame([(i, t, f"o{i % 2}", "r") for i, t in enumerate(texts)], "doc_id long, text string, owner string, repository string")
    found = {r["doc_id"]: r["spans"] for r in secrets.digest(secrets.scan(rows)).collect()}
    assert found == {0: "token:11:31", 1: "token:12:32", 2: "token:18:39", 3: "token:4:27", 4: "assign:0:27"}


def test_one_owners_repositories_make_no_example(spark):
    value, shared = "Zq8Rt5Yu2Io9Pa6Sd3Fg", "Mn4Bv7Cx1Zl8Kj5Hg2Fd"
    rows = [(k, f"key {value}", "solo", f"r{k}") for k in range(6)] + [(10 + k, f"key {shared}", f"o{k}", "r") for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, owner string, repository string")
    found = {r["doc_id"]: r["spans"] for r in secrets.digest(secrets.scan(df)).collect()}
    assert found == {**{k: "token:4:24" for k in range(6)}, **{10 + k: "" for k in range(3)}}


@pytest.mark.parametrize("seed", range(2))
def test_spans_apart_and_replaced_row_by_row(spark, seed):
    draw = random.Random(seed)
    rows = []
    for k in range(200):
        size = draw.choice([0, 3, 40, 3000])
        places = lambda n: [(a, draw.randint(a, min(size, a + 9))) for a in (draw.randint(0, size) for _ in range(n))]
        rows.append((k, "".join(draw.choice("abé\U0001f600\n") for _ in range(size)), places(draw.choice([0, 1, 5, 600])), places(draw.choice([0, 1, 5, 600]))))
    df = spark.createDataFrame(rows, "id long, t string, a array<struct<start:int,end:int>>, b array<struct<start:int,end:int>>")
    news = F.transform("a", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit("N").alias("new")))
    for r in df.select("*", spans.apart(F.col("a"), F.col("b")).alias("left"), spans.replaced(F.col("t"), news).alias("out")).collect():
        kept = [tuple(s) for s in r["a"] if not any(o["start"] < s["end"] and s["start"] < o["end"] for o in r["b"])]
        assert sorted(map(tuple, r["left"])) == sorted(kept)
        assert r["out"] == brute.replaced(r["t"], [tuple(s) for s in r["a"]], "N")


def test_one_text_with_very_many_matches(spark):
    n = 100_000
    texts = [" ".join(f"u{k}@example.org key Zx81-kQ_97hTe2LmPw{5_000_000 + k}" for k in range(n))]
    df = rows_of(spark, texts)
    started = time.monotonic()
    row = df.select(F.size(spans.matches(F.col("text"), pii.EMAIL)).alias("n"), spans.matches(F.col("text"), pii.EMAIL)[n - 1].alias("last")).first()
    assert row["n"] == n and texts[0][row["last"]["start"] : row["last"]["end"]] == f"u{n - 1}@example.org"
    assert secrets.digest(secrets.scan(df, repository=F.col("source"), owner=F.col("source"))).first()["spans"].count("token") == n
    clean = pii.sanitised(df).first()["text"]
    assert clean.count("[EMAIL]") == n and "@" not in clean
    assert time.monotonic() - started < 120

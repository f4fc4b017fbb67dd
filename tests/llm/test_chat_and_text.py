"""Chat windows, quality rules, language, secrets, toxicity: edge cases and brute force."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from evenkeel.llm import chat, language, quality, secrets, toxicity

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = ("alpha beta gamma delta\n" * 3000) + "x"
ODD = [
    (1, None, None, None, None), (2, "", "en", None, 0), (3, " \t\n ", "en", "a", 4), (4, "one two", "en", "a", 7),
    (5, "a a a a a", "en", "a", 9), (6, LONG, "en", "b", len(LONG)), (7, "x\ny\nx\n\n \n\ny", None, "b", 9),
    (7, "x\ny\nx\n\n \n\ny", None, "b", 9), (None, "null id here", "en", "b", 12),
    (8, "a\x0bb\x0cc d e * # <|", "fr", "b", 20), (9, "p q r p q r s p q r", "fr", "c", 5),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


def brute_counts(text):
    text = text or ""
    words = WORDS.findall(text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            repeated += line in seen
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    often = collections.Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


def test_quality_counts_equal_brute_force(spark, odd):
    clash = odd.withColumn("quality", F.lit("mine")).withColumn("_text", F.lit(1)).withColumn("words", F.lit(2))
    rows = quality.quality_rules(clash).select("doc_id", "text", "words", "quality.*").collect()
    assert len(rows) == len(ODD)
    for r in rows:
        n = brute_counts(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == n
        assert r["base_failed"] == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert not (r["base_failed"] and r["kept"])


def test_quality_tells_junk_from_prose(spark):
    prose = "the cat and the dog of this house were by the sea as it is on a day with sun and wind in the air "
    words = [w + "zu"[i % 2] + str(i % 7) for i, w in enumerate((prose * 9).split())]
    clean = [" ".join(w if i % 3 else words[(i + k) % len(words)].strip("0123456") for i, w in enumerate((prose * 6).split()))
             for k in range(40)]
    junk = " ".join(f"{w}#{i}$$%" for i, w in enumerate(words[:120]))
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate([*clean, junk])], DOCS)
    kept = {r["doc_id"]: r["quality"] for r in quality.quality_rules(docs, keep=["doc_id"]).collect()}
    assert not kept[40]["kept"] and kept[40]["class_distance"] > quality.MOST_CLASS_DISTANCE
    assert all(kept[i]["word_distance"] < 0.3 for i in range(40))


def test_rare_word_salad_is_not_kept(spark):
    draw = random.Random(7)
    letters = lambda: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randrange(3, 10)))
    words = [letters() for _ in range(1500)]
    shares = [1 / (i + 5) for i in range(1500)]
    texts = [" ".join(draw.choices(words, shares, k=70)).replace(" ", ", ", 9).capitalize() + "." for _ in range(9_999)]
    salad = " ".join(letters() for _ in range(300))
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate([*texts, salad])], DOCS)
    judged = quality.quality_rules(docs, keep=["doc_id"], least_known=quality.LEAST_KNOWN).select("doc_id", "quality.*")
    assert [r["doc_id"] for r in judged.where("not kept and not base_failed").collect()] == [9_999]


def test_every_language_has_references(spark, tmp_path):
    import duckdb
    from evenkeel.llm.queries import ORACLE, QUERIES

    texts = [(" ".join(f"{chr(97 + n % 26)}{n}{'Ab,'[j % 3]}{(i * j) % 13}" for j in range(60)), f"l{n}")
             for n in range(300) for i in (1, 2)]
    texts += [(texts[-1][0], None), (" ".join(f"{j}!" for j in range(80)), "l7"), (None, "l8"), ("", "none")]
    docs = spark.createDataFrame([(i, t, lang, "a", 0) for i, (t, lang) in enumerate(texts)], DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op3_quality_rules"](spark, str(tmp_path))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = duck.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE['op3_quality_rules']}) ORDER BY doc_id").fetchall()
    assert [tuple(r) for r in got.orderBy("doc_id").collect()] == want
    assert got.where("word_distance is not null").count() == 602


@pytest.mark.parametrize("apply", [
    lambda d: quality.quality_rules(d),
    lambda d: secrets.scan_secrets(d, redact=True),
    lambda d: language.identify_languages(d, language.fit_languages(d)),
    lambda d: toxicity.score_toxicity(d, toxicity.fit_lexicon(d, d.select("doc_id", F.lit(1).alias("toxic")))),
])
def test_no_rows(spark, apply):
    assert apply(spark.createDataFrame([], DOCS)).count() == 0


def brute_secrets(text):
    found = []
    for k, kind in enumerate(("assign", "access", "hex")):
        pattern = {"assign": secrets.ASSIGN.pattern, "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}[kind]
        for m in re.finditer(pattern, text, re.I | re.A if kind == "assign" else 0):
            if {"assign": lambda: len(m[2]) >= 6, "access": lambda: len(m[0]) >= 20, "hex": lambda: len(m[0]) >= 24}[kind]():
                found.append((m.start(), k, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


@pytest.mark.parametrize("text", [
    "", "token:token: abcdefgh", "PassWord = 'abc/def+1'", "api_key=apikey:abcdef", "secret:pass secret:longer",
    "toKen=abcdefgh", "İ token=abcdef İ", "AKIA" + "A" * 16 + " akia" + "A" * 20 + " AKIAAKIA" + "0" * 15,
    "x" + "0123456789abcdef" * 2 + "X" + "a" * 23 + "g" + "a" * 24, "password:secret=token=abcdef",
    "passwd\"  =  'x'", "token==abcdef token=: abc", "secret" * 50 + "=abcdef", "é" * 5 + "secret:" + "k" * 9,
])
def test_base_spans_equal_plain_search(text):
    assert [s for s in secrets.Scanner()(text) if s[0] in ("assign", "access", "hex")] == brute_secrets(text)


def test_checksummed_tokens_and_redaction(spark):
    body = "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"
    good, bad = f"ghp_{body}{secrets.checksum62(body)}", f"npm_{body}{'0' * 6}"
    text = f"é {good} and {bad}; password=hunter2hunter2"
    docs = spark.createDataFrame([(1, text, "en", "a", 0), (2, None, None, None, None)], DOCS).withColumn("spans", F.lit(7))
    one, two = secrets.scan_secrets(docs, redact=True).orderBy("doc_id").collect()
    assert [tuple(s) for s in one["spans"]] == [("github", 2, 2 + len(good)), ("assign", text.index("password"), len(text))]
    assert one["text"] == f"é <github> and {bad}; <assign>" and two["text"] is None and two["spans"] == []


def test_language_backs_off_to_grams(spark):
    rows = [(i, t, lang, "a", 0) for i in range(30) for lang, t in (
        ("en", f"the thing with nothing is that they think {i}"), ("de", f"der schöne schnee und das schiff schlafen {i}"))]
    docs = spark.createDataFrame([(n, *r[1:]) for n, r in enumerate(rows)], DOCS)
    model = language.fit_languages(docs)
    asked = spark.createDataFrame([(1, "schnur schlange", None, None, 0), (2, "thither", None, None, 0), (3, "12 ½ !", None, None, 0),
                                   (4, None, None, None, 0), (5, "", None, None, 0)], DOCS).withColumn("score", F.lit("x"))
    got = {r["doc_id"]: r for r in language.identify_languages(asked, model).collect()}
    assert [got[i]["lang_pred"] for i in range(1, 6)] == ["de", "en", "und", "und", "und"]
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[4]["score"] == 0
    nothing = language.fit_languages(docs.where("false"))
    assert {r["lang_pred"] for r in language.identify_languages(asked, nothing).collect()} == {"und"}


def test_rare_languages_are_learned_whole(spark):
    rows = [(i, f"the thing with nothing is that they think {i}", "en", "a", 0) for i in range(20_000)]
    rows += [(20_000 + i, "der schöne schnee und das schiff", "de", "a", 0) for i in range(2)]
    model = language.fit_languages(spark.createDataFrame(rows, DOCS), sample=40)
    assert model.languages == ["de", "en"] and "schnee" in model.index
    assert language.evenly([5, 100, 100], 65) == 30 and language.evenly([5, 6], 65) >= 6 and language.evenly([], 9) >= 0


def test_all_of_many_languages_are_learned(spark, monkeypatch):
    texts = [(" ".join(f"{chr(97 + n % 26)}{chr(97 + n // 26)}{chr(97 + j)}q" for j in range(9)), f"l{n:03d}") for n in range(90)]
    docs = spark.createDataFrame([(7, t, lang, "a", 0) for t, lang in texts * 2], DOCS)  # ids choose nothing alone
    for numbers in (language.NUMBERS, 90 * 90 * 30):
        monkeypatch.setattr(language, "NUMBERS", numbers)
        model = language.fit_languages(docs, sample=40)
        assert model.languages == sorted(lang for _, lang in texts) and model.rows.size <= numbers
        assert language.identify_languages(docs, model).where("lang = lang_pred").count() == 180


def test_rare_toxic_rows_are_learned_whole(spark):
    draw = random.Random(3)
    plain = lambda: " ".join(draw.choice("sun moon rain wind road tree lake hill bird song".split()) + draw.choice("aeiou")
                             for _ in range(20))
    rows = [(i, plain() + " grunkel" * (i < 20), None, None, 0) for i in range(8_000)]
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(8_000)], "doc_id bigint, toxic int")
    lexicon = toxicity.fit_lexicon(spark.createDataFrame(rows, DOCS), labels, sample=400)
    assert any("grunkei" in t for t in lexicon.weights)
    matcher = toxicity.Matcher(lexicon)
    assert matcher.score(plain() + " grunkel") > 0.7 > 0.3 > matcher.score(plain())


def test_language_on_held_out_documents(spark):
    from evenkeel.llm.queries import QUERIES
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op2_language_id"](spark, folder).where("held_out").join(
        spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert found.count() > 100 and found.where("lang = lang_pred").count() >= 0.97 * found.count()


def test_lexicon_folds_and_excuses(spark):
    import random
    draw = random.Random(3)
    plain = lambda: " ".join(draw.choice("sun moon rain wind road tree lake hill bird song".split()) + draw.choice("aeiou")
                             for _ in range(60))
    texts = [(plain() + " blimpo " + plain() + " grunkel ", 1) for _ in range(60)]
    texts += [(plain(), 0) for _ in range(200)] + [(plain() + " dear blimpo " + plain(), 0) for _ in range(2)]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, (t, _) in enumerate(texts)], DOCS)
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)] + [(0, None), (None, 1), (1, 0)],
                                   "doc_id bigint, toxic int")
    lexicon = toxicity.fit_lexicon(docs, labels)
    assert any("grunkei" in t for t in lexicon.weights)
    matcher = toxicity.Matcher(lexicon)
    base = plain()
    for word in ("grunkel", "GRUNKEL!", "grunкel", "grunk3l", "grúnkel", "ｇrunkel", "grunke1"):
        assert matcher.score(f"{base} {word} {base} {word} blimpo") > 0.7, word
    assert matcher.score(base) < 0.3 and matcher.score(None) == matcher.score("") < 0.3
    excused = toxicity.Lexicon({" biimpo ": 3.0}, {" dear biimpo ": 3.0}, (-2.0, 2.0, 1.0, 0.5))
    assert toxicity.Matcher(excused).score("dear blimpo") < 0.3 < 0.7 < toxicity.Matcher(excused).score("you blimpo")


TURNS = "conv_id bigint, turn bigint, role string, text string, window string"


def check_windows(spark, rows, budget=60, history=20):
    windows = chat.format_conversations(spark.createDataFrame(rows, TURNS), budget, history)
    read = sorted(chat.read_windows(windows).collect(), key=lambda r: (r["conv_id"] is not None, r["conv_id"], r["window"]))
    by = collections.defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    for conv, turns in by.items():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        mine = [w for w in read if w["conv_id"] == conv]
        assert [w["window"] for w in mine] == list(range(len(mine)))
        own = [(t["role"], t["text"]) for w in mine for t in w["own"]]
        assert own == [(r[2] or "", r[3] or "") for r in turns]
        assert [t for w in mine for t in w["learnt"]] == [r[3] or "" for r in turns if r[2] == "assistant"]
        at = 0
        for w in mine:
            assert w["oversized"] or w["n_tokens"] <= budget
            assert not w["oversized"] or len(w["own"]) == 1
            system = next((i for i, r in enumerate(turns) if r[2] == "system"), None)
            if system is not None and system < at:
                assert w["formatted"].startswith("<|turn:system|>" + turns[system][3].replace("<|", "<\\|"))
                assert w["n_repeated"] >= 1
            at += len(w["own"])
    return read


def test_windows_hold_every_turn_once(spark):
    rows = [(1, 0, "system", "be <|nice|>", "w")] + [
        (1, i, ("user", "assistant")[i % 2], "word " * (i % 7) + "</s>", "w") for i in range(1, 40)]
    rows += [(2, 0, "user", None, None), (2, 1, None, "<\\|x \\[INST] [\\\\/INST] <s", None), (None, None, "assistant", "", None)]
    rows += [(3, 0, "assistant", "same", None)] * 3 + [(4, None, "a|> b\n<|end|>", "long " * 300, None), (4, 1, "user", "hi", None)]
    rows += [(5, i, "user", "t", None) for i in range(5)] + [(5, 5, "system", "late", None)] + [
        (5, i, "assistant", "t " * 9, None) for i in range(6, 20)]
    read = check_windows(spark, rows)
    assert len([r for r in read if r["conv_id"] == 1]) > 3
    assert any(r["n_repeated"] > 1 for r in read if r["conv_id"] == 1)


def test_no_turns(spark):
    assert chat.format_conversations(spark.createDataFrame([], TURNS)).count() == 0

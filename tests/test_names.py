"""Names, places and raw text against plain Python."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from corvane.functions import text
from corvane.operators import names
from corvane.plans import naming, standins


def plain_normal(name):
    name = re.sub(r"^(?i:Mr\.?|Ms\.?|Mrs\.?|Dr\.?|Prof\.?|Sr\.?|Jr\.?)\s+", "", name.strip(" "))
    return re.sub(r"\s+", " ", name).strip(" ")


def plain_distinct(given):
    kept = []
    for name in map(plain_normal, given or []):
        low = name.lower()
        if not name or any(k.lower() == low for k in kept):
            continue
        for k in kept:
            if low in k.lower():
                break
            if k.lower() in low:
                kept.remove(k)
                kept.append(name)
                break
        else:
            kept.append(name)
    return kept


def test_distinct_names(spark):
    rng = random.Random(2)
    parts = ["Samsung", "Samsung Electronics", "Mr. Smith", "smith", "Electronics", "Dr Jane", "jane", "A", "", "  ", "Smith & Co", "Bank", "World Bank"]
    rows = [(i, [rng.choice(parts) for _ in range(rng.randrange(7))]) for i in range(200)] + [(900, None), (901, [])]
    got = spark.createDataFrame(rows, "i int, n array<string>").select("i", names.distinct(F.col("n")).alias("d")).collect()
    assert {r.i: list(r.d) for r in got} == {i: plain_distinct(n) for i, n in rows}


def test_valid_names(spark):
    rows = [("x", "en", False), ("Foo", "en", True), ("010-1234-5678", "en", False), ("10-20-30-40", "en", True), ("01012345678", "en", False), ("y" * 51, "en", False), ("서울에서", "ko", False), ("서울에서", "en", True), ("한국은행", "ko", True), (None, "en", False), ("아주 긴 이름 하나 그리고 또 하나 더 있는 것", "ko", False), ("OK", None, True)]
    got = spark.createDataFrame(rows, "n string, l string, w boolean").select(names.valid(F.col("n"), F.col("l")).alias("g"), "w").collect()
    assert [r.g for r in got] == [r.w for r in got]


def plain_focus(title, body, named, aliases):
    order = sorted(aliases, key=lambda a: (-len(a), a))
    pattern = re.compile("(?<![가-힣a-z])(" + "|".join(map(re.escape, order)) + ")(?![가-힣a-z])")
    score = {}
    for t, w in ((title or "", 5.0), ((body or "").lower()[:300], 3.0), ((body or "").lower()[300:2000], 1.0)):
        for m in pattern.finditer(t.lower()):
            score[aliases[m[1]]] = score.get(aliases[m[1]], 0) + w
    for n in named or []:
        low = n.strip(" ").lower()
        code, w = (aliases[low], 4.0) if low in aliases else (next((aliases[a] for a in order if len(a) >= 4 and a in low), None), 2.8)
        if code:
            score[code] = score.get(code, 0) + w
    best = max(score.values(), default=0)
    ranked = sorted(score.items(), key=lambda x: (-x[1], x[0]))
    return [(c, s, s / sum(score.values())) for c, s in ranked if s >= max(1.0, 0.1 * best)]


def test_place_focus(spark):
    rng = random.Random(4)
    words = [*naming.ALIASES, "Seoulite", "none", "BANK", "World", "정부는", "War", "x"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(6))), " ".join(rng.choices(words, k=rng.randrange(400))), rng.choices(words, k=rng.randrange(3))) for i in range(60)] + [(99, None, None, None)]
    df = spark.createDataFrame(rows, "article_id int, title string, body string, entities_location array<string>")
    got = {}
    for r in names.place_focus(df, naming.ALIASES).orderBy("article_id", "rank").collect():
        got.setdefault(r.article_id, []).append((r.code, round(r.score, 6), round(r["share"], 6)))
    want = {i: [(c, round(s, 6), round(p, 6)) for c, s, p in plain_focus(t, b, n, naming.ALIASES)] for i, t, b, n in rows}
    assert got == {i: v for i, v in want.items() if v}


def test_raw_text(spark):
    rows = [("ｶﾀｶﾅ é", "ja"), ("ｶﾀｶﾅ é", "en"), (None, "ko"), ("", None)]
    got = spark.createDataFrame(rows, "t string, l string").select(text.unicode_form(F.col("t"), F.col("l")).alias("f")).collect()
    assert [r.f for r in got] == [unicodedata.normalize("NFKC", rows[0][0]), unicodedata.normalize("NFC", rows[1][0]), None, ""]
    raw = ["plain", "é한", None]
    values = [x.encode() if x else None for x in raw] + ["한국은행".encode("euc-kr"), "é".encode("latin-1"), b""]
    got = spark.createDataFrame([(v,) for v in values], "b binary").select(text.decoded(F.col("b")).alias("t")).collect()
    assert [r.t for r in got] == ["plain", "é한", None, "한국은행", "é", ""]


def test_languages(spark):
    rows = [
        ("정부 예산 발표", "오늘 회의", "en", "ko"), ("政策と予算について話します", "", "en", "ja"), ("short", "", "de", "de"), ("The minister of finance said that the budget is ready", "", "de", "en"), ("Der Minister und die Regierung mit dem Haushalt", "", "en", "de"),
        ("Xyz qwv zzz kkk lll", "", "fr", "fr"), (None, None, "es", "es"), ("Политика и экономика страны", None, "en", "ru"),
    ]
    got = spark.createDataFrame(rows, "t string, b string, e string, w string").select(text.language(F.col("t"), F.col("b"), F.col("e")).alias("g"), "w").collect()
    assert [r.g for r in got] == [r.w for r in got]


def test_sentences_of_any_script(spark):
    got = spark.createDataFrame([("One. Two!  Three\nfour。五！六",)], "t string").select(text.sentences(F.col("t")).alias("s")).first().s
    assert got == ["One.", "Two!", "Three", "four。", "五！", "六"]


def test_stand_in_names_are_used(spark, small):
    seen = {n for r in standins.articles(spark, small).select("names").distinct().collect() for n in r.names}
    assert seen == set(standins.NAMES)

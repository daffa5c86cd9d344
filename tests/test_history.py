"""Documents, histories and the archive of old days."""

import datetime
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions import text, urls
from corvane.operators import rollups
from corvane.sources import history, tables

ANSWER = T.StructType().add("question", "string").add("n", "long").add("top", T.ArrayType(T.StructType().add("code", "string").add("n", "long")))
DAY = T.StructType().add("day", "string").add("gti", "double")


def test_documents(spark, tmp_path):
    for day, answer in (("2024-01-02", {"question": "q1", "n": 2, "top": [{"code": "ECO", "n": 1}]}), ("2024-01-03", {"question": "q2", "n": None, "more": 1})):
        (tmp_path / day).mkdir()
        (tmp_path / day / "answers.json").write_text(json.dumps(answer, indent=2))
    (tmp_path / "2024-01-03" / "broken.json").write_text('{"question": "q3",\n')
    got = history.read_documents(spark, f"{tmp_path}/*", ANSWER).orderBy("data_date").collect()
    assert [(r.question, r.n, r.data_date) for r in got] == [("q1", 2, "2024-01-02"), ("q2", None, "2024-01-03")]
    assert got[0].top[0].code == "ECO" and got[1].top is None


def test_history(spark, tmp_path):
    path = str(tmp_path / "history")
    put = lambda rows: history.append_history(spark.createDataFrame(rows, DAY), path)
    put([("d1", 1.0), ("d2", 2.0)])
    put([("d2", 5.0), ("d3", None), (None, 9.0)])
    (tmp_path / "history" / "part-broken.json").write_text("{broken\n\n")
    assert sorted(tuple(r) for r in history.read_history(spark, path, DAY).collect()) == [("d1", 1.0), ("d2", 5.0), ("d3", None)]
    put([("d1", 4.0)])
    assert dict(history.read_history(spark, path, DAY).select("day", "gti").collect()) == {"d1": 4.0, "d2": 5.0, "d3": None}


TODAY = datetime.date(2024, 3, 10)


@pytest.fixture
def days(spark, tmp_path):
    rows = [(i, f"v{i}", TODAY - datetime.timedelta(i % 50)) for i in range(100)] + [(1000, "no day", None)]
    spark.createDataFrame(rows, "id long, v string, crawl_date date").write.partitionBy("crawl_date").parquet(str(tmp_path / "table"))
    return str(tmp_path / "table"), str(tmp_path / "archive"), {r[0] for r in rows}


def ids(spark, path):
    return {r.id for r in spark.read.parquet(path).collect()}


def test_archive(spark, days):
    path, to, every = days
    assert history.archive(spark, path, to, TODAY, dry=True).agg(F.sum("rows")).first()[0] == 38 and ids(spark, path) == every
    told = history.archive(spark, path, to, TODAY).collect()
    assert [r.day for r in told] == [TODAY - datetime.timedelta(d) for d in range(49, 30, -1)] and {r.rows for r in told} == {2}
    old = {i for i in range(100) if i % 50 > 30}
    assert ids(spark, to) == old and ids(spark, path) == every - old
    assert history.archive(spark, path, to, TODAY).count() == 0
    assert history.archive(spark, path, to, TODAY, days=0).count() == 29 - 1 + 1 - 1  # yesterday, the day before and today stay
    assert ids(spark, path) | ids(spark, to) == every and not ids(spark, path) & ids(spark, to)


def test_archive_goes_on_where_it_ended(spark, days):
    path, to, every = days
    spark.read.parquet(path).where(F.col("crawl_date") == F.lit(TODAY - datetime.timedelta(40))).write.partitionBy("crawl_date").parquet(to)  # copied, not yet deleted
    assert history.archive(spark, path, to, TODAY).count() == 19
    assert ids(spark, path) | ids(spark, to) == every and spark.read.parquet(to).count() == 38


def test_archive_keeps_late_rows(spark, days):
    path, to, every = days
    history.archive(spark, path, to, TODAY)
    spark.createDataFrame([(5000, "late", TODAY - datetime.timedelta(40))], "id long, v string, crawl_date date").write.mode("append").partitionBy("crawl_date").parquet(path)
    with pytest.raises(RuntimeError, match="other rows"):
        history.archive(spark, path, to, TODAY)
    assert ids(spark, path) | ids(spark, to) == every | {5000}


def test_digest(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "i long, t string")
    a, b = tables.digest(df).first(), tables.digest(df.orderBy(F.desc("i"))).first()
    assert a == b and a.n == 3 and a.digest != tables.digest(df.distinct()).first().digest
    assert tuple(tables.digest(df.where("false")).first()) == (0, "0")


def test_rollups(spark):
    counts = spark.createDataFrame([("a", 2), ("b", 3), ("c", 4), (None, 5)], "source string, n long")
    groups = spark.createDataFrame([("a", "G"), ("b", "G"), (None, "never")], "source string, group string")
    assert dict(rollups.group_sums(counts, groups).collect()) == {"G": 5, "?": 9}
    got = rollups.filled(counts, [groups], "source", {"group": "none"}).collect()
    assert {(r.source, r.group) for r in got} == {("a", "G"), ("b", "G"), ("c", "none"), (None, "none")}


def test_titles_and_fingerprints_of_characters(spark):
    df = spark.createDataFrame([("정부 예산 정책 발표", "정부예산 정책발표"), ("budget policy", "budget policies today"), ("", "x")], "a string, b string")
    got = df.select(text.mostly_cjk(F.col("a")).alias("c"), text.title_words(F.col("a")).alias("w"), text.titles_alike(F.col("a"), F.col("b")).alias("s")).collect()
    assert [r.c for r in got] == [True, False, False] and got[0].w == list("정부예산책발표") and [r.s for r in got] == [True, False, False]
    t = "반도체 수출이 크게 늘어 경제가 성장했다. " * 4
    x, y, z = (r[0] for r in spark.createDataFrame([(t,), (t.replace(" ", "").replace(".", "!") + "   ",), ("은행 금리가 올라 시장이 위기를 맞았다. " * 4,)], "t string").select(text.simhash64(F.col("t"))).collect())
    assert bin((x ^ y) & (1 << 64) - 1).count("1") <= 12 < bin((x ^ z) & (1 << 64) - 1).count("1")


def test_equivalent(spark):
    pairs = [("http://www.x.org/a/?b=2&a=1#t", "https://x.org/a?a=1&b=2&utm_source=q", True), ("https://x.org/a", "https://x.org/b", False), (None, None, False), ("no address", "no address", False)]
    df = spark.createDataFrame(pairs, "a string, b string, same boolean")
    assert all(r.g == r.same for r in df.select("same", urls.equivalent(F.col("a"), F.col("b")).alias("g")).collect())

"""News-like tables derived from the test tables, by one text that Spark and DuckDB both read.

``articles`` (from ``events``) has the columns that the operators of this package are written against. Both engines get
the same expressions, so a query and its SQL see the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EMOTIONS = ["joy", "trust", "fear", "surprise", "sadness", "disgust", "anger", "anticipation"]
CODES = ["S", "T", "E", "En", "P", "Se"]
DOMAINS = ["SOC", "TEC", "ECO", "ENV", "POL", "SEC", "SPI", "CRS"]
COUNTRIES = ["US", "KR", "JP", "DE", "BR", "NG"]
REGIONS = ["Americas", "Asia", "Asia", "Europe", "Americas", "Africa"]
LANGS = ["en", "ko", "ja", "es"]
TITLES = ["budget policy surprise", "chip export boom", "bank inflation crisis", "oil market crash", "election weather forecast", "vaccine recovery growth", "war tariff uncertainty", "climate talks"]
HEADLINES = {
    "en": TITLES,
    "ko": ["정부 예산 정책 발표", "반도체 수출 성장", "은행 금리 위기", "원유 시장 거품", "선거와 날씨", "백신 회복 기대", "관세 전쟁 불확실", "물가 상승"],
    "ja": ["政策と予算", "半導体の輸出", "銀行の金利", "原油市場", "選挙と天気", "経済の回復", "関税と貿易", "祭りの夜"],
    "es": ["La economía crece", "El fútbol de hoy", "Déficit y presupuesto", "Geopolítica europea", "POLÍTICA de salud", "Un día de sol", "Comercio y arancel", "La incertidumbre"],
}
# Names as extractors give them: good ones, forms of one name, and noise.
NAMES = ["Mr. Smith", "dr  Jane  Doe", "Samsung", "Samsung Electronics", "010-1234-5678", "x", "정부는 오늘 회의를 했다", "서울에서", "한국은행", "World Bank", "noticias", "Seoul City", "12345", "smith", "아주 긴 이름을 가진 어느 회사 이름 하나", "Foo Corp", "  ", "World Bank Group"]


def _pick(values: list[str], index: str) -> str:
    return f"CASE {index} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


_EMOTIONS = ", ".join(f"CAST(event_id * {k} % 101 AS DOUBLE) / 100 AS emotion_{e}" for e, k in zip(EMOTIONS, (3, 7, 11, 13, 17, 19, 23, 29), strict=True))
#: ARR stands for the array constructor of either engine.
ARTICLES = f"""
SELECT event_id AS article_id, ts AS published_at, CAST(ts AS DATE) AS day,
  'src' || CAST(user_id % 12 AS STRING) AS source, {_pick(LANGS, "user_id % 4")} AS language,
  {_pick(COUNTRIES, "user_id % 12 % 6")} AS source_country, {_pick(REGIONS, "user_id % 12 % 6")} AS source_region,
  {_pick(["major", "regional", "niche"], "user_id % 12 % 3")} AS source_tier, {_pick(["LEFT", "CENTER", "RIGHT", "UNKNOWN"], "user_id % 12 % 4")} AS source_lean,
  CAST((event_id * 31 + user_id) % 9 - 1 AS INT) AS topic_id, 'topic_' || CAST((event_id * 31 + user_id) % 9 - 1 AS STRING) AS topic_label,
  CAST(CAST(round(value * 100) AS BIGINT) * 7 % 201 - 100 AS DOUBLE) / 100 AS sentiment_score, {_EMOTIONS},
  {_pick(CODES, "(event_id * 5 + user_id) % 6")} AS steeps_category, {_pick(DOMAINS[:7], "(event_id * 3 + user_id) % 7")} AS steeps_primary,
  ARR({_pick(DOMAINS[:7], "(event_id * 3 + user_id) % 7")}, {_pick(DOMAINS, "(event_id * 11 + 3) % 8")}) AS steeps_all,
  CAST(event_id * 37 % 1001 AS DOUBLE) / 10 AS importance_score, CAST(50 + event_id * 13 % 900 AS INT) AS word_count,
  {_pick(TITLES, "(event_id * 7 + user_id) % 8")} AS title, CASE user_id % 4 {" ".join(f"WHEN {i} THEN {_pick(HEADLINES[x], '(event_id * 7 + CAST(floor(user_id / 4) AS BIGINT)) % 8')}" for i, x in enumerate(LANGS))} END AS headline,
  ARR({_pick(NAMES, "event_id * 5 % 18")}, {_pick(NAMES, "(event_id + user_id) % 18")}, {_pick(NAMES, "event_id * 7 % 18")}) AS names,
  ARR('p' || CAST(event_id * 7 % 23 AS STRING), 'p' || CAST((event_id * 5 + user_id) % 31 AS STRING)) AS entities_person,
  ARR('o' || CAST(user_id % 13 AS STRING), 'o' || CAST(event_id * 3 % 17 AS STRING)) AS entities_org,
  ARR({_pick(COUNTRIES, "(event_id + user_id) % 6")}, {_pick(COUNTRIES, "event_id * 5 % 6")}) AS entities_location,
  {_pick(COUNTRIES, "event_id % 6")} AS geo_focus_primary, ARR({_pick(COUNTRIES, "event_id % 6")}, {_pick(COUNTRIES, "(event_id * 5 + user_id) % 6")}) AS geo_focus_all,
  CASE WHEN event_id % 17 = 0 THEN 'WEAK_SIGNAL' WHEN event_id % 5 = 0 THEN 'NOISE' ELSE 'TREND' END AS signal_type,
  CAST(event_id * 41 % 101 AS DOUBLE) / 100 AS novelty_score, CAST(event_id * 43 % 101 AS DOUBLE) / 100 AS burst_score
FROM events"""


def view(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("ts", __import__("pyspark").sql.functions.col("ts").cast("timestamp"))
    return spark.sql(ARTICLES.replace("ARR(", "array(").replace("FROM events", "FROM {events}"), events=events)


def sql(text: str) -> str:
    """DuckDB SQL over ``articles``."""
    text = text.lstrip()
    return "WITH articles AS (" + ARTICLES.replace("ARR(", "list_value(") + ")" + ("\n" if text.startswith("SELECT") else ",\n") + text

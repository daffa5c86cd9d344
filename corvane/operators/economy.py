"""Economic readings of text: policy uncertainty, sectors, narratives, momentum, hype."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import entities

# Keywords of each measure by language.
UNCERTAINTY = {
    "en": ["economy", "economic", "policy", "regulation", "uncertainty", "uncertain", "deficit", "budget", "federal reserve", "congress", "legislation", "tariff", "trade war"],
    "ko": ["경제", "정책", "규제", "불확실", "불안", "재정", "적자", "금리", "한은", "한국은행", "국회", "입법", "관세", "무역"],
    "ja": ["経済", "政策", "規制", "不確実", "不安", "財政", "赤字", "金利", "日銀", "国会", "法案", "関税", "貿易"],
    "de": ["wirtschaft", "politik", "regulierung", "unsicherheit", "haushalt", "defizit", "zinsen", "bundestag", "gesetz", "zoll"],
    "es": ["economía", "económico", "política", "regulación", "incertidumbre", "déficit", "presupuesto", "legislación", "arancel", "comercio"],
    "fr": ["économie", "économique", "politique", "réglementation", "incertitude", "déficit", "budget", "législation", "tarif"],
    "it": ["economia", "economico", "politica", "regolamentazione", "incertezza", "deficit", "bilancio", "legislazione", "tariffa"],
    "pt": ["economia", "econômico", "política", "regulamentação", "incerteza", "déficit", "orçamento", "legislação", "tarifa"],
    "sv": ["ekonomi", "politik", "reglering", "osäkerhet", "underskott", "budget", "lagstiftning", "tull", "handel"],
    "no": ["økonomi", "politikk", "regulering", "usikkerhet", "underskudd", "budsjett", "lovgivning", "toll", "handel"],
    "cs": ["ekonomika", "politika", "regulace", "nejistota", "deficit", "rozpočet", "legislativa", "clo", "obchod"],
    "ru": ["экономика", "экономический", "политика", "регулирование", "неопределённость", "дефицит", "бюджет", "законодательство", "тариф", "торговля"],
}
SECTORS = {
    "energy": {
        "en": ["oil", "gas", "solar", "renewable", "energy", "petroleum", "opec", "nuclear power", "wind power", "coal", "electricity"],
        "ko": ["원유", "석유", "가스", "태양광", "에너지", "신재생", "원자력", "전력", "석탄", "풍력", "OPEC"],
    },
    "technology": {
        "en": ["ai", "artificial intelligence", "semiconductor", "chip", "software", "cloud", "quantum", "robot", "5g", "blockchain", "data center", "cybersecurity", "startup"],
        "ko": ["인공지능", "반도체", "칩", "소프트웨어", "클라우드", "양자", "로봇", "5G", "블록체인", "데이터센터", "스타트업"],
    },
    "healthcare": {
        "en": ["pharmaceutical", "vaccine", "drug", "hospital", "medical", "health", "biotech", "clinical trial", "fda", "cancer", "pandemic", "therapy"],
        "ko": ["제약", "백신", "의약품", "병원", "의료", "건강", "바이오", "임상시험", "식약처", "암", "팬데믹", "치료"],
    },
    "financial": {
        "en": ["bank", "interest rate", "stock", "bond", "market", "investment", "inflation", "fed", "central bank", "forex", "credit", "insurance", "fintech"],
        "ko": ["은행", "금리", "주식", "채권", "시장", "투자", "인플레이션", "한은", "중앙은행", "환율", "보험", "핀테크"],
    },
    "manufacturing": {
        "en": ["factory", "supply chain", "manufacturing", "production", "automobile", "steel", "shipbuilding", "export", "import", "logistics", "warehouse"],
        "ko": ["공장", "공급망", "제조", "생산", "자동차", "철강", "조선", "수출", "수입", "물류", "창고"],
    },
}
NARRATIVES = {
    "recession": {"en": ["recession", "downturn", "contraction", "slowdown"], "ko": ["불황", "경기침체", "위축", "둔화"]},
    "inflation": {"en": ["inflation", "price surge", "cost of living", "cpi"], "ko": ["인플레이션", "물가", "생활비", "소비자물가"]},
    "bubble": {"en": ["bubble", "overvalued", "speculation", "crash"], "ko": ["버블", "거품", "과대평가", "투기"]},
    "growth": {"en": ["growth", "expansion", "boom", "recovery", "gdp"], "ko": ["성장", "확장", "호황", "회복", "GDP"]},
    "crisis": {"en": ["crisis", "collapse", "meltdown", "default", "bailout"], "ko": ["위기", "붕괴", "부도", "구제금융"]},
}
#: Languages that write words without bounds.
UNSPACED = ("ko", "ja", "zh")


def pattern(words: list[str], lang: str = "en") -> str:
    """An alternation in any case, longest first; with word bounds for languages that part words (any letter or digit binds)."""
    body = "|".join(sorted(words, key=lambda w: (-len(w), w)))
    if lang in UNSPACED:
        return f"(?i)({body})"
    return f"(?i)\\b({body})\\b" if body.isascii() else f"(?iu)(?<![\\p{{L}}\\p{{N}}_])({body})(?![\\p{{L}}\\p{{N}}_])"


def uncertainty(articles: DataFrame, words: dict[str, list[str]] = UNCERTAINTY, text: str = "title") -> DataFrame:
    """``language, day``, articles, and the share of them that match a keyword of their language; languages without keywords are left out."""
    hit = F.coalesce(*(F.when(F.col("language") == lang, F.col(text).rlike(pattern(w, lang))) for lang, w in words.items()), F.lit(False))
    return articles.where(F.col("language").isin(list(words))).groupBy("language", "day").agg(F.count("*").alias("n"), F.avg(hit.cast("double")).alias("epu"))


def sector(text: str, sectors: dict[str, dict[str, list[str]]] = SECTORS) -> Column:
    """The sector with most keyword hits in all its languages, the first of equals; null without any."""
    hits = {s: sum((F.regexp_count(F.col(text), F.lit(pattern(w, lang))) for lang, w in by.items()), F.lit(0)) for s, by in sectors.items()}
    most = F.greatest(*hits.values())
    out = F.when(most == 0, None)
    for s, n in hits.items():
        out = out.when(n == most, s)
    return out


def sector_sentiment(articles: DataFrame, least: int = 50, text: str = "title") -> DataFrame:
    """Economic articles by sector and day: how many and their mean sentiment; nothing under ``least`` articles."""
    a = articles.where("steeps_category = 'E'").withColumn("sector", sector(text)).where("sector is not null")
    enough = a.agg(F.count("*").alias("c")).where(F.col("c") >= least)
    return a.groupBy("sector", "day").agg(F.count("*").alias("n"), F.avg("sentiment_score").alias("sentiment")).join(F.broadcast(enough), how="left_semi")  # one row or none


def narratives(articles: DataFrame, words: dict[str, dict[str, list[str]]] = NARRATIVES, rows: int = 7, text: str = "title") -> DataFrame:
    """Each narrative by language (of those it has keywords in) and day: matches, prevalence, sentiment of matches (0 if none), and
    their means over ``rows`` rows."""
    one = [F.when(F.col("language") == lang, F.struct(F.lit(k).alias("narrative"), F.col(text).rlike(pattern(w, lang)).alias("hit"))) for k, by in words.items() for lang, w in by.items()]
    a = articles.select("language", "day", "sentiment_score", F.explode(F.filter(F.array(*one), lambda x: x.isNotNull())).alias("x")).select("language", "day", "sentiment_score", "x.*")
    n = a.groupBy("narrative", "language", "day").agg(F.sum(F.col("hit").cast("int")).alias("matches"), F.avg(F.col("hit").cast("double")).alias("prevalence"), F.coalesce(F.avg(F.when(F.col("hit"), F.col("sentiment_score"))), F.lit(0.0)).alias("sentiment"))
    w = Window.partitionBy("narrative", "language").orderBy("day").rowsBetween(1 - rows, 0)
    return n.withColumn("matches_mean", F.avg("matches").over(w)).withColumn("sentiment_mean", F.avg("sentiment").over(w))


def gradient(value: str, by: list[str], order: str) -> Column:
    """Central differences, one-sided at the ends, 0 for a single point."""
    w = Window.partitionBy(*by).orderBy(order)
    before, after, x = F.lag(value).over(w), F.lead(value).over(w), F.col(value)
    return F.when(before.isNotNull() & after.isNotNull(), (after - before) / 2).when(after.isNotNull(), after - x).when(before.isNotNull(), x - before).otherwise(0.0)


def momentum(series: DataFrame, value: str, by: list[str], order: str) -> DataFrame:
    """``velocity``, ``acceleration`` and an early ``warning`` (still rising, but slower)."""
    out = series.withColumn("velocity", gradient(value, by, order))
    out = out.withColumn("acceleration", gradient("velocity", by, order))
    return out.withColumn("warning", (F.col("velocity") > 0) & (F.col("acceleration") < 0))


def hype(articles: DataFrame, least: int = 10) -> DataFrame:
    """Entities with ``least`` mentions: slopes of daily mentions and sentiment over their days in order, and the phase."""
    m = entities.mentions(articles, {"entities_org": "org"}, ["day", "sentiment_score"])
    daily = m.groupBy("entity", "day").agg(F.count("*").alias("n"), F.avg("sentiment_score").alias("s"))
    daily = daily.withColumn("x", (F.row_number().over(Window.partitionBy("entity").orderBy("day")) - 1).cast("double"))
    out = daily.groupBy("entity").agg(F.sum("n").alias("mentions"), F.coalesce(F.regr_slope(F.col("n").cast("double"), F.col("x")), F.lit(0.0)).alias("volume_slope"), F.avg("s").alias("sentiment")).where(F.col("mentions") >= least)
    v, s = F.col("volume_slope"), F.col("sentiment")
    phase = F.when((v > 0.10) & (s > 0.20), "peak").when((v > 0.10), "trigger").when((v < -0.05) & (s < -0.10), "trough").when(v < -0.05, "decline").when((F.abs(v) < 0.02) & (F.abs(s) < 0.10), "plateau").otherwise("slope")
    return out.withColumn("phase", phase)

"""Statistics as column expressions: entropy, divergences, concentration, slopes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def entropy2(count: str = "n", total: str = "total") -> Column:
    """Aggregate: Shannon entropy in bits of counts that sum to ``total``; zero counts add nothing."""
    p = F.col(count) / F.col(total)
    return F.coalesce(-F.sum(F.when(p > 0, p * F.log2(p))), F.lit(0.0)) + F.lit(0.0)


def hhi(count: str = "n", total: str = "total") -> Column:
    """Aggregate: Herfindahl-Hirschman concentration of shares."""
    return F.sum((F.col(count) / F.col(total)) ** 2)


def jsd_term(p: Column, q: Column) -> Column:
    """One outcome's part of the Jensen-Shannon divergence (natural logarithm); zero shares add nothing."""
    m = (p + q) / 2
    part = lambda x: F.when(x > 0, x * F.log(x / m)).otherwise(0.0)
    return (part(p) + part(q)) / 2


def kl(p: Column, q: Column, smooth: float = 1e-10) -> Column:
    """Kullback-Leibler divergence of two share arrays, smoothed and normalised anew."""
    norm = lambda a: F.transform(a, lambda x: (x + smooth) / F.aggregate(a, F.lit(0.0), lambda s, y: s + y + smooth))
    return F.aggregate(F.zip_with(norm(p), norm(q), lambda x, y: x * F.log(x / y)), F.lit(0.0), lambda s, x: s + x)


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda u, v: u.cast("double") * v.cast("double")), F.lit(0.0), lambda s, t: s + t)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(0.0)


def clamp(x: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), x))


def label(score: Column, cut: float = 0.1) -> Column:
    """Sentiment label by threshold."""
    return F.when(score > cut, "positive").when(score < -cut, "negative").otherwise("neutral")


def finite(x: Column) -> Column:
    """Null, NaN and infinities as 0."""
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), 0.0).otherwise(x)


def importance(authority: Column, entities: Column, words: Column, coverage: Column, total: Column, hours: Column, sentiment: Column, paywall: Column) -> Column:
    """Importance of an article, 0 to 100: authority, entity density, coverage, recency, sentiment, less 20 behind a paywall."""
    density = F.when(words > 0, F.least(entities * 1000.0 / words, F.lit(100.0))).otherwise(0.0)
    spread = F.when(total > 0, F.least(coverage * 500.0 / total, F.lit(100.0))).otherwise(0.0)
    recency = F.coalesce(100 * F.exp(-0.0289 * hours), F.lit(50.0))
    x = 0.25 * F.coalesce(authority, F.lit(50.0)) + 0.20 * density + 0.25 * spread + 0.15 * recency + 0.15 * 100 * F.abs(sentiment) - F.when(paywall, 20.0).otherwise(0.0)
    return F.round(clamp(x, 0.0, 100.0), 2)


def evidence(importance_score: Column, sentiment: Column, words: Column) -> Column:
    return 0.4 * importance_score + 0.3 * F.abs(sentiment) + 0.1 * F.least(words / 1000, F.lit(1.0)) + 0.2 * F.least(1.5 * importance_score, F.lit(1.0))

"""Column functions: Column in, Column out, all native Spark expressions (no
Python UDFs), usable inside ``select`` / ``withColumn`` / ``filter`` and kept in
whole-stage code generation."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# split on any run of non-letters (Unicode aware)
TOKEN_SPLIT = r"[^\p{L}]+"
VADER_ALPHA = 15.0
# Published rational approximation of the standard normal CDF
# (Abramowitz & Stegun 26.2.17), |error| < 7.5e-8.
AS_P = 0.2316419
AS_B = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)


def tokens(text: Column | str) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(c), TOKEN_SPLIT), lambda t: F.length(t) > 0)


def normalise(s: Column, alpha: float = VADER_ALPHA) -> Column:
    """s / sqrt(s^2 + alpha). The sum is first rounded to 9 places so that valences
    that cancel give exactly 0 whatever the summation order."""
    s = F.round(s, 9)
    return F.when(s == 0, F.lit(0.0)).otherwise(s / F.sqrt(s * s + F.lit(alpha)))


def sentiment_bucket(score: Column | str, pos: float = 0.05, neg: float = -0.05,
                     strict: bool = False) -> Column:
    """'positive' (>= pos), 'negative' (<= neg), else 'neutral'. ``strict=True``
    keeps the literal three-rule form where only exactly 0 is neutral and values
    strictly between the thresholds (other than 0) get NULL."""
    c = F.col(score) if isinstance(score, str) else score
    b = F.when(c >= pos, F.lit("positive")).when(c <= neg, F.lit("negative"))
    return b.when(c == 0, F.lit("neutral")) if strict else b.otherwise(F.lit("neutral"))


def parse_tweet_time(c: Column | str) -> Column:
    """'Mon May 01 12:00:00 +0000 2017' → timestamp. The day-of-week field is
    dropped (its parser pattern is rejected by the current datetime parser) and the
    rest is parsed; malformed text gives NULL instead of failing the job."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(F.substring(col, 5, 1 << 20), F.lit("MMM dd HH:mm:ss Z yyyy"))


def parse_compact_time(c: Column | str) -> Column:
    """'20240101T000007' → timestamp."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(col, F.lit("yyyyMMdd'T'HHmmss"))


def feed_rows(feed_json: Column | str, item_schema: str, feed_field: str = "feed") -> Column:
    """JSON text ``{"feed": [ {...}, ... ]}`` → array of structs (explode it)."""
    col = F.col(feed_json) if isinstance(feed_json, str) else feed_json
    return F.from_json(col, f"struct<{feed_field}: array<struct<{item_schema}>>>")[feed_field]


def to_json_value(*cols: str) -> Column:
    """Row → JSON text, as the ``value`` of a message."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]))


def inverse_scale(x: Column, lo: Column, hi: Column) -> Column:
    """min + x * (max - min)."""
    return lo + x * (hi - lo)


def direction_label(change: Column) -> Column:
    """'rises' / 'falls' / 'same' from a signed change."""
    return (F.when(change > 0, F.lit("rises"))
             .when(change < 0, F.lit("falls"))
             .otherwise(F.lit("same")))


def soft_threshold(b: Column, l1: float | Column, l2: float | Column = 0.0) -> Column:
    """sign(b) · max(|b| - l1, 0) / (1 + 2 l2)."""
    l1c = l1 if isinstance(l1, Column) else F.lit(float(l1))
    l2c = l2 if isinstance(l2, Column) else F.lit(float(l2))
    # an explicit 0.0 (not sign · 0, which is -0.0 for negative b)
    return F.when(F.abs(b) <= l1c, F.lit(0.0)).otherwise(F.signum(b) * (F.abs(b) - l1c) / (1 + 2 * l2c))


def normal_cdf(z: Column) -> Column:
    """Φ(z) as column arithmetic (Spark SQL has no erf)."""
    x = F.abs(z)
    t = 1 / (1 + F.lit(AS_P) * x)
    poly = t * (F.lit(AS_B[0]) + t * (F.lit(AS_B[1]) + t * (F.lit(AS_B[2]) + t * (F.lit(AS_B[3]) + t * F.lit(AS_B[4])))))
    upper = F.exp(-x * x / 2) / F.lit(math.sqrt(2 * math.pi)) * poly
    return F.when(z >= 0, 1 - upper).otherwise(upper)


def dense_cosine(a, b):
    """Cosine of two equal-length numeric arrays in double precision, in native
    higher-order functions; null if one of them is all zero."""
    a, b = a.cast("array<double>"), b.cast("array<double>")
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
    na = F.sqrt(F.aggregate(F.transform(a, lambda x: x * x), F.lit(0.0), lambda s, v: s + v))
    nb = F.sqrt(F.aggregate(F.transform(b, lambda x: x * x), F.lit(0.0), lambda s, v: s + v))
    return F.try_divide(dot, na * nb)


def hash_order(key: str, seed: int | str) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")))

"""Row-level column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Follower tiers are right-closed bins (0,1000], (1000,10000], (10000,100000], (100000,inf).
TIER_EDGES = [0, 1000, 10000, 100000]
TIER_NAMES = ["Nano", "Micro", "Macro", "Mega"]
INFLUENCER_MIN_FOLLOWERS = 10000
PRIME_TIME_HOURS = (18, 22)
ENGAGEMENT_WEIGHTS = {"likes": 1.0, "shares": 3.0, "comments": 2.0}


def follower_tier(followers: Column) -> Column:
    """Right-closed bins; values <= 0 or null fall outside every bin and read as the string "nan"."""
    e = TIER_EDGES
    return (F.when(followers.isNull() | (followers <= e[0]), F.lit("nan"))
            .when(followers <= e[1], TIER_NAMES[0])
            .when(followers <= e[2], TIER_NAMES[1])
            .when(followers <= e[3], TIER_NAMES[2])
            .otherwise(TIER_NAMES[3]))


def is_influencer(followers: Column) -> Column:
    return followers >= INFLUENCER_MIN_FOLLOWERS


def engagement_score(likes: Column, shares: Column, comments: Column) -> Column:
    w = ENGAGEMENT_WEIGHTS
    return F.round(likes * F.lit(w["likes"]) + shares * F.lit(w["shares"]) + comments * F.lit(w["comments"]), 2)


def clip_unit(x: Column) -> Column:
    """Clip to [-1, 1]; null and NaN pass through unchanged."""
    return F.when(x.isNull() | F.isnan(x), x).otherwise(F.least(F.greatest(x, F.lit(-1.0)), F.lit(1.0)))


def is_prime_time(hour: Column) -> Column:
    return hour.between(*PRIME_TIME_HOURS)


def engagement_index(total_likes: Column, total_shares: Column, post_count: Column) -> Column:
    denom = F.when(post_count == 0, F.lit(1)).otherwise(post_count)
    return F.round((total_likes + total_shares * 3) / denom.cast("double"), 2)


def mask_email(email: Column) -> Column:
    """first char + '***@' + domain; anything without exactly one '@' (or an empty part) gives null."""
    pat = r"^([^@])[^@]*@([^@]+)$"
    return F.when(email.rlike(pat), F.regexp_replace(email, pat, "$1***@$2"))


def mask_phone(phone: Column) -> Column:
    """Every digit except the last two becomes '*'."""
    return F.regexp_replace(phone, r"\d(?=(?:\D*\d){2})", "*")


def severity_band(pct: Column) -> Column:
    return F.when(pct > 20, "critical").when(pct > 10, "warning").otherwise("ok")


def sign_class(x: Column) -> Column:
    return F.when(x < 0, "negative").when(x > 0, "positive").otherwise("neutral")


def avg_round(col: str | Column, scale_in: int, scale_out: int) -> Column:
    """round(avg(col), scale_out) for values that are exact ``scale_in``-place decimals.

    Averaging as DECIMAL keeps the mean exact, so rounding ties (common for small groups) resolve the
    same way every time (half away from zero) instead of depending on float summation order.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.round(F.avg(c.cast(f"decimal(18,{scale_in})")), scale_out).cast("double")


def pct_round(num: Column, den: Column, scale_out: int) -> Column:
    """round(100 * num / den, scale_out) of integer counts, exact (decimal division)."""
    return F.round((num * 100).cast("decimal(38,0)") / den.cast("decimal(38,0)"), scale_out).cast("double")

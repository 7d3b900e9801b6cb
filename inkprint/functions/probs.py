"""Row-wise statistics of probability vectors (array<double> columns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkprint.constants import BANDS, EMBEDDING_ACCURACY, FEATURE_ACCURACY, TOP_BAND
from inkprint.functions.rounding import let, round_binary
from inkprint.functions.text import col, log_odds


def total(p) -> Column:
    return F.aggregate(col(p), F.lit(0.0), lambda acc, x: acc + x)


def mean(p) -> Column:
    return total(p) / F.size(col(p))


def variance(p) -> Column:
    """Population variance."""
    return let(mean(p), lambda mu: F.aggregate(
        col(p), F.lit(0.0), lambda acc, x: acc + (x - mu) * (x - mu))) / F.size(col(p))


def std(p) -> Column:
    return F.sqrt(variance(p))


def spread(p) -> Column:
    return F.array_max(col(p)) - F.array_min(col(p))


def argmax(p) -> Column:
    """Index of the largest entry, the first of equals."""
    return (F.array_position(col(p), F.array_max(col(p))) - 1).cast("long")


def _top(p, k: int) -> Column:
    return F.get(F.sort_array(col(p), asc=False), F.lit(k))


def margin(p) -> Column:
    return _top(p, 0) - F.coalesce(_top(p, 1), F.lit(0.0))


def top2(p) -> Column:
    return _top(p, 0) + F.coalesce(_top(p, 1), F.lit(0.0))


def entropy(p, eps: float = 1e-10) -> Column:
    """Natural-log entropy of the vector after adding ``eps`` and renormalising."""
    whole = F.aggregate(col(p), F.lit(0.0), lambda acc, x: acc + x + F.lit(eps))
    return -let(whole, lambda w: F.aggregate(
        F.transform(col(p), lambda x: (x + F.lit(eps)) / w), F.lit(0.0), lambda acc, q: acc + q * F.ln(q)))


def logit_max(p) -> Column:
    return log_odds(F.array_max(col(p)))


def confidence(p) -> Column:
    return F.array_max(col(p)) - mean(p)


def certainty(p) -> Column:
    return F.array_max(col(p)) / total(p)


def scaled(v) -> Column:
    """The vector divided by its sum."""
    return let(col(v), lambda x: let(F.aggregate(x, F.lit(0.0), lambda acc, y: acc + y),
                                     lambda whole: F.transform(x, lambda y: y / whole)))


def softmax(z) -> Column:
    powers = let(F.array_max(col(z)), lambda high: F.transform(col(z), lambda x: F.exp(x - high)))
    return scaled(powers)


def blend(f, e, weight_f: float = FEATURE_ACCURACY, weight_e: float = EMBEDDING_ACCURACY) -> Column:
    """Weighted mean of two vectors over the classes both have."""
    n = F.least(F.size(col(f)), F.size(col(e)))
    whole = weight_f + weight_e
    return F.zip_with(F.slice(col(f), F.lit(1), n), F.slice(col(e), F.lit(1), n),
                      lambda a, b: F.lit(weight_f / whole) * a + F.lit(weight_e / whole) * b)


def meta_columns(f="probs_feature", e="probs_embed") -> dict[str, Column]:
    """The derived columns of the meta table, in order; the blended vector stays one array."""
    both = F.concat(col(f), col(e))
    out: dict[str, Column] = {}
    for name, fn in (("mean_prob", mean), ("std_prob", std), ("var_prob", variance), ("range_prob", spread)):
        out[f"{name}_feature"], out[f"{name}_cnn"] = fn(f), fn(e)
    out["mean_prob_all"], out["std_prob_all"] = mean(both), std(both)
    out["abs_mean_diff"] = F.abs(mean(f) - mean(e))
    out["pred_feature"], out["pred_cnn"] = argmax(f), argmax(e)
    out["model_disagreement"] = (argmax(f) != argmax(e)).cast("long")
    for name, fn in (("margin", margin), ("entropy", entropy), ("logit_max_prob", logit_max),
                     ("confidence", confidence), ("certainty", certainty), ("top2_prob", top2)):
        out[f"{name}_feature"], out[f"{name}_cnn"] = fn(f), fn(e)
    out["weighted_prob"] = blend(f, e)
    out["confidence_ratio"] = F.array_max(col(f)) / F.array_max(col(e))
    return out


def mean_gap(p) -> Column:
    """Mean distance of the entries below the maximum; null where all are equal."""
    def below(high):
        return F.transform(F.filter(col(p), lambda x: x != high), lambda x: high - x)

    def average(gaps):
        return F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x) / F.nullif(F.size(gaps), F.lit(0))

    return let(let(F.array_max(col(p)), below), average)


def band(p) -> Column:
    """Certainty band of a verdict; all entries equal falls through to the top band."""
    def name_of(gap):
        out = None
        for limit, name in BANDS:
            out = F.when(gap < limit, name) if out is None else out.when(gap < limit, name)
        return out.otherwise(TOP_BAND)

    return let(mean_gap(p), name_of)


def percent(x) -> Column:
    """Percentage with two decimals, as display text."""
    value = round_binary(col(x) * 100, ties="up")
    return F.format_string("%.2f", value)


def focal_loss(p_true, alpha: float = 0.5, gamma: float = 2.0) -> Column:
    """alpha (1 - p)^gamma · cross-entropy of the true class's probability."""
    p = col(p_true)
    return F.lit(alpha) * F.pow(1 - p, F.lit(gamma)) * -F.ln(p)

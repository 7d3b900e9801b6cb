"""Statistics over the two probability vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkprint.catalog.base import PROBS, probs, query, r6
from inkprint.functions import probs as pr
from inkprint.operators.stack import meta_frame, meta_inputs

_EXPRESSIONS: dict[str, str] = {
    "mean_prob_feature": "list_avg(f)", "mean_prob_cnn": "list_avg(e)",
    "std_prob_feature": "list_stddev_pop(f)", "std_prob_cnn": "list_stddev_pop(e)",
    "var_prob_feature": "list_var_pop(f)", "var_prob_cnn": "list_var_pop(e)",
    "range_prob_feature": "list_max(f) - list_min(f)", "range_prob_cnn": "list_max(e) - list_min(e)",
    "mean_prob_all": "list_avg(list_concat(f, e))", "std_prob_all": "list_stddev_pop(list_concat(f, e))",
    "abs_mean_diff": "abs(list_avg(f) - list_avg(e))",
    "pred_feature": "list_position(f, list_max(f)) - 1", "pred_cnn": "list_position(e, list_max(e)) - 1",
    "model_disagreement": "(list_position(f, list_max(f)) <> list_position(e, list_max(e)))::INT",
    "margin_feature": "list_reverse_sort(f)[1] - list_reverse_sort(f)[2]",
    "margin_cnn": "list_reverse_sort(e)[1] - list_reverse_sort(e)[2]",
    "confidence_feature": "list_max(f) - list_avg(f)", "confidence_cnn": "list_max(e) - list_avg(e)",
    "certainty_feature": "list_max(f) / list_sum(f)", "certainty_cnn": "list_max(e) / list_sum(e)",
    "top2_prob_feature": "list_reverse_sort(f)[1] + list_reverse_sort(f)[2]",
    "top2_prob_cnn": "list_reverse_sort(e)[1] + list_reverse_sort(e)[2]",
    "confidence_ratio": "list_max(f) / list_max(e)",
}
for _name, _v in (("feature", "f"), ("cnn", "e")):
    _padded = f"list_sum(list_transform({_v}, lambda x: x + 1e-10))"
    _EXPRESSIONS[f"entropy_{_name}"] = (
        f"-list_sum(list_transform({_v}, lambda x: (x + 1e-10) / {_padded} * ln((x + 1e-10) / {_padded})))")
    _clip = f"least(greatest(list_max({_v}), 0.001), 0.999)"
    _EXPRESSIONS[f"logit_max_prob_{_name}"] = f"ln({_clip} / (1 - {_clip}))"

_WHOLE = {"pred_feature", "pred_cnn", "model_disagreement"}


def _sql(names) -> str:
    parts = [f"({_EXPRESSIONS[n]})::BIGINT AS {n}" if n in _WHOLE else f"round({_EXPRESSIONS[n]}, 6) + 0.0 AS {n}"
             for n in names]
    return f"SELECT message_id, {', '.join(parts)} FROM ({PROBS})"


def _columns(names):
    def run(spark, d):
        made = pr.meta_columns()
        return probs(spark, d).select("message_id", *[
            made[n].alias(n) if n in _WHOLE else r6(made[n]).alias(n) for n in names])
    return run


for _key, _names in {
    "x1_mean": ["mean_prob_feature", "mean_prob_cnn"],
    "x2_std_var": ["std_prob_feature", "var_prob_feature", "std_prob_cnn", "var_prob_cnn"],
    "x3_range": ["range_prob_feature", "range_prob_cnn"],
    "x4_mean_std_all": ["mean_prob_all", "std_prob_all"],
    "x5_abs_mean_diff": ["abs_mean_diff"],
    "x6_predictions": ["pred_feature", "pred_cnn"],
    "x7_disagreement": ["model_disagreement"],
    "x8_margin": ["margin_feature", "margin_cnn"],
    "x9_entropy": ["entropy_feature", "entropy_cnn"],
    "x10_logit_max": ["logit_max_prob_feature", "logit_max_prob_cnn"],
    "x11_confidence": ["confidence_feature", "confidence_cnn"],
    "x12_certainty": ["certainty_feature", "certainty_cnn"],
    "x13_top2": ["top2_prob_feature", "top2_prob_cnn"],
    "x15_confidence_ratio": ["confidence_ratio"],
}.items():
    query(_key, _sql(_names))(_columns(_names))


_BLEND = (f"SELECT message_id, i::INTEGER AS i, round(0.7 / 1.33 * f[i + 1] + 0.63 / 1.33 * e[i + 1], 6) AS value "
          f"FROM ({PROBS}), range(10) r(i)")


@query("x14_weighted_prob", _BLEND)
def x14(spark, d):
    blended = probs(spark, d).select("message_id", F.posexplode(pr.blend("probs_feature", "probs_embed")).alias("i", "v"))
    return blended.select("message_id", "i", r6("v").alias("value"))


@query("o2_argmax", _sql(["pred_feature"]))
def o2(spark, d):
    return probs(spark, d).select("message_id", pr.argmax("probs_feature").alias("pred_feature"))


@query("w5_top_two", f"""
SELECT message_id, round(list_reverse_sort(e)[1], 6) AS first, round(list_reverse_sort(e)[2], 6) AS second
FROM ({PROBS})""")
def w5(spark, d):
    ranked = F.sort_array("probs_embed", asc=False)
    return probs(spark, d).select("message_id", r6(F.get(ranked, F.lit(0))).alias("first"),
                                  r6(F.get(ranked, F.lit(1))).alias("second"))


_FULL = _sql(_EXPRESSIONS).replace("SELECT message_id,", 'SELECT message_id, "user",', 1)
for _i in range(10):
    _FULL = _FULL.replace(" FROM (\n", f", round(f[{_i + 1}], 6) AS probs_feature{_i}, round(e[{_i + 1}], 6) AS "
                          f"probs_cnn{_i}, round(0.7 / 1.33 * f[{_i + 1}] + 0.63 / 1.33 * e[{_i + 1}], 6) AS "
                          f"weighted_prob_{_i} FROM (\n", 1)


@query("m17_meta_frame", _FULL)
def m17(spark, d):
    rows = probs(spark, d)
    left = rows.select("message_id", "user", F.col("probs_feature").alias("probability"))
    right = rows.select("message_id", F.col("probs_embed").alias("probability"))
    made = meta_inputs(meta_frame(left, right), 10)
    whole = {"message_id", "user", *_WHOLE}
    return made.select(*[F.col(c) if c in whole else r6(c).alias(c) for c in made.columns])


@query("m15_softmax", f"""
SELECT message_id, i::INTEGER AS i, round(f[i + 1], 6) AS value FROM ({PROBS}), range(10) r(i)""")
def m15_softmax(spark, d):
    return probs(spark, d).select("message_id", F.posexplode("probs_feature").alias("i", "v")).select(
        "message_id", "i", r6("v").alias("value"))

"""Temperature mixing: source weights from an exponent, and their realisation as permuted blocks of documents.

The weight of a source is its share of the tokens to the power ``exponent``, normalised: 1 keeps the shares, 0 makes
them equal. The exponent is found by bisection, either for a target entropy of the weights, or as the smallest one
(most even weights) under which no source is repeated more than ``max_repeats`` times for the token budget. Each
step is an aggregation over the table of sources.

A source gets its weight times the budget in tokens: as many whole passes over its documents as fit, and for the
rest a beginning of one more pass. In a pass the blocks of a source come in an order of their own, by a hash of
source, pass and block. The last block is cut inside: by sub-blocks, and in the last of those document by
document, so a source meets its budget to less than one document.

Scale: documents belong to blocks by the hash of their id, so nothing is sorted but at most ``MAX_BLOCKS`` blocks of a
source, the ``SUB_BLOCKS`` sub-blocks of one block and the documents of one sub-block. A source may hold most rows.

Defined cases: a token is a run of characters other than white space; null and empty texts have none and are never
drawn; rows without a source form one source, ``NO_SOURCE``; an entropy out of reach gives the nearest
exponent in [0, 4], and a repetition limit below budget / tokens gives exponent 1; repeated rows are
drawn one by one; without tokens nothing is drawn.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from inkprint.llm.common import query, table
from inkprint.session import materialize

MAX_BLOCKS = 4096
SUB_BLOCKS = 256
NO_SOURCE = "<none>"
_STEPS = 16  # passes of the bisection; each halves the interval three times


def tokens_of(text):
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"\S+")), F.lit(0)).cast("long")


def draw(*parts):
    """A number below 2^60 from the md5 of the parts, as other systems can compute it too."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


@dataclass
class Mixture:
    exponent: float
    budget: int
    sources: DataFrame  # source, tokens, weight, allowance


def _bisect(low: float, high: float, below: Callable[[list[float]], list[bool]]) -> float:
    """The border between the exponents for which ``below`` holds and the higher ones, where it does not."""
    for _ in range(_STEPS):
        points = [low + (high - low) * k / 8 for k in range(1, 8)]
        held = sum(below(points))
        edges = [low, *points, high]
        low, high = edges[held], edges[held + 1]
    return (low + high) / 2


def weigh(sources: DataFrame, budget: int | None = None, entropy: float | None = None,
          max_repeats: float | None = None) -> Mixture:
    """Weights for a table (source, tokens), by a target entropy (in nats) or a limit of repetitions."""
    if (entropy is None) == (max_repeats is None):
        raise ValueError("give either entropy or max_repeats")
    total, least = sources.agg(F.sum("tokens"), F.min("tokens")).first()
    if not total:
        return Mixture(1.0, 0, sources.withColumn("weight", F.lit(0.0)).withColumn("allowance", F.lit(0).cast("long")).limit(0))
    budget = total if budget is None else budget
    share = F.col("tokens") / total

    def sums(points):
        powers = [F.pow(share, F.lit(a)) for a in points]
        row = sources.agg(*[F.sum(p) for p in powers], *[F.sum(p * F.log(share)) for p in powers]).first()
        return row[:len(points)], row[len(points):]

    def too_even(points):  # the entropy falls with the exponent
        z, e = sums(points)
        return [log(z[k]) - a * e[k] / z[k] > entropy for k, a in enumerate(points)]

    def too_often(points):  # the smallest source is repeated most
        z, _ = sums(points)
        return [budget / total * (least / total) ** (a - 1) / z[k] > max_repeats for k, a in enumerate(points)]

    if entropy is not None:
        exponent = _bisect(0.0, 4.0, too_even)
    elif budget / total > max_repeats:
        exponent = 1.0
    else:
        exponent = _bisect(0.0, 1.0, too_often)
    norm = sums([exponent])[0][0]
    weighed = sources.withColumn("weight", F.pow(share, F.lit(exponent)) / norm) \
        .withColumn("allowance", F.round(F.col("weight") * budget).cast("long"))
    return Mixture(exponent, budget, weighed)


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", budget: int | None = None,
        entropy: float | None = None, max_repeats: float | None = 4.0, block_tokens: int = 1 << 16, seed: int = 0) -> DataFrame:
    """The drawn rows in a schedule: key, source, pass, block_rank (the place of its block in that pass), n_tokens.

    ``budget`` is in tokens; by default as many as there are.
    """
    if entropy is not None:
        max_repeats = None
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(source).cast("string"), F.lit(NO_SOURCE)).alias("source"),
                       tokens_of(text).alias("tokens")).where("tokens > 0")
    rows = materialize(rows, "tokens")
    mixture = weigh(materialize(rows.groupBy("source").agg(F.sum("tokens").alias("tokens")), "sources"),
                    budget, entropy, max_repeats)
    plan = mixture.sources.select(
        "source", F.least(F.lit(MAX_BLOCKS), F.ceil(F.col("tokens") / block_tokens)).cast("long").alias("blocks"),
        F.expr("allowance div tokens").cast("int").alias("passes"), F.expr("allowance % tokens").alias("rest"))
    plan = materialize(plan, "plan")
    number = draw(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(seed))
    placed = rows.withColumn("number", number).join(plan.select("source", "blocks"), "source").select(
        "id", "source", "tokens", F.pmod("number", "blocks").alias("block"),
        F.pmod(F.expr("number div blocks"), F.lit(SUB_BLOCKS)).alias("sub"), "number")
    placed = materialize(placed, "placed")
    blocks = placed.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")).join(plan, "source")
    turns = blocks.withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes")))) \
        .withColumn("order", draw(F.col("source"), F.lit(seed), F.col("pass"), F.col("block")))
    inside = W.partitionBy("source", "pass").orderBy("order", "block")
    turns = turns.withColumn("block_rank", F.row_number().over(inside) - 1) \
        .withColumn("before", F.coalesce(F.sum("tokens").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))) \
        .withColumn("left", F.when(F.col("pass") < F.col("passes"), F.col("tokens")).otherwise(F.col("rest") - F.col("before"))) \
        .where("left > 0").select("source", "block", "pass", "block_rank", "left", (F.col("left") >= F.col("tokens")).alias("whole"))
    turns = materialize(turns, "turns")
    whole = placed.join(turns.where("whole"), ["source", "block"])
    cut = placed.join(turns.where("not whole"), ["source", "block"])
    subs = cut.groupBy("source", "block", "sub").agg(F.sum("tokens").alias("tokens"), F.first("left").alias("left"))
    ahead = W.partitionBy("source", "block").orderBy("sub").rowsBetween(W.unboundedPreceding, -1)
    subs = subs.withColumn("left", F.col("left") - F.coalesce(F.sum("tokens").over(ahead), F.lit(0))).where("left > 0") \
        .select("source", "block", "sub", F.col("left").alias("sub_left"), (F.col("left") >= F.col("tokens")).alias("sub_whole"))
    part = cut.join(subs, ["source", "block", "sub"])
    earlier = W.partitionBy("source", "block", "sub").orderBy("number", "id", "tokens").rowsBetween(W.unboundedPreceding, -1)
    last = part.where("not sub_whole").withColumn("gone", F.coalesce(F.sum("tokens").over(earlier), F.lit(0))) \
        .where("gone < sub_left")
    names = ["id", "source", "pass", "block_rank", "tokens"]
    out = whole.select(names).union(part.where("sub_whole").select(names)).union(last.select(names))
    return out.select(F.col("id").alias(key), F.col("source").alias(source), "pass", "block_rank",
                      F.col("tokens").alias("n_tokens"))


_HASH = "('0x' || substr(md5({}), 1, 15))::BIGINT"
SQL_OF = """
WITH RECURSIVE tok AS (SELECT doc_id, coalesce(source, '<none>') AS source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+'))::BIGINT AS tokens
    FROM {documents}),
doc AS (SELECT doc_id, source, tokens, """ + _HASH.format("doc_id::VARCHAR || ':0'") + """ AS number FROM tok WHERE tokens > 0),
src AS (SELECT source, sum(tokens)::BIGINT AS n, ln(sum(tokens) / (SELECT sum(tokens) FROM doc)) AS p FROM doc GROUP BY source),
bis AS (SELECT 0 AS step, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi UNION ALL
    SELECT step + 1, CASE WHEN often THEN mid ELSE lo END, CASE WHEN often THEN hi ELSE mid END FROM
    (SELECT step, lo, hi, (lo + hi) / 2 AS mid, exp((SELECT min(p) FROM src) * ((lo + hi) / 2 - 1))
        / (SELECT sum(exp(p * ((lo + hi) / 2))) FROM src) > {repeats} AS often FROM bis WHERE step < 48)),
expo AS (SELECT (lo + hi) / 2 AS a FROM bis ORDER BY step DESC LIMIT 1),
plan AS (SELECT source, least(4096, ceil(n / 65536.0))::BIGINT AS blocks, allowance // n AS passes, allowance % n AS rest FROM
    (SELECT source, n, round(exp(p * a) / (SELECT sum(exp(p * a)) FROM src, expo) * (SELECT sum(n) FROM src))::BIGINT AS allowance
     FROM src, expo)),
placed AS (SELECT doc_id, source, tokens, number, number % blocks AS block, number // blocks % 256 AS sub FROM doc JOIN plan USING (source)),
turns AS (SELECT source, block, pass, row_number() OVER w - 1 AS block_rank, tokens,
        CASE WHEN pass < passes THEN tokens ELSE rest - sum(tokens) OVER w + tokens END AS room FROM
    (SELECT source, block, tokens, passes, rest, pass, """ + _HASH.format("source || ':0:' || pass || ':' || block") + """ AS ord FROM
        (SELECT source, block, tokens, passes, rest, unnest(range(0, passes + 1)) AS pass FROM
            (SELECT source, block, sum(tokens)::BIGINT AS tokens FROM placed GROUP BY source, block) JOIN plan USING (source)))
    WINDOW w AS (PARTITION BY source, pass ORDER BY ord, block)),
drawn AS (SELECT doc_id, source, pass, block_rank, placed.tokens, room,
        sum(placed.tokens) OVER (PARTITION BY source, block, pass ORDER BY sub, number, doc_id, placed.tokens ROWS UNBOUNDED PRECEDING)
            - placed.tokens AS gone
    FROM placed JOIN turns USING (source, block) WHERE room > 0)
SELECT doc_id, source, pass::INT AS pass, block_rank::INT AS block_rank, tokens AS n_tokens FROM drawn WHERE gone < room"""


@query("op1_source_mixing", SQL_OF.format(documents="documents", repeats="4.0"))
def op1(spark, d):
    return mix(table(spark, d, "documents"))

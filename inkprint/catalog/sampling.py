"""Balancing and splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkprint.catalog.aggregates import _STRAT
from inkprint.catalog.base import LABELS, label_rows, query, table, vectors
from inkprint.operators import sampling as sm


@query("b1_undersample", f"""
WITH rows_ AS ({LABELS}) SELECT message_id, "user" FROM (SELECT *, row_number() OVER (
    PARTITION BY "user" ORDER BY md5(message_id || ':42')) AS place FROM rows_)
WHERE place <= (SELECT min(n) FROM (SELECT count(*) AS n FROM rows_ GROUP BY "user"))""")
def b1(spark, d):
    return sm.undersample(label_rows(spark, d))


@query("b2_split", """
SELECT o_orderkey AS message_id, CASE WHEN row_number() OVER (ORDER BY md5(o_orderkey || ':42'))
    <= ceil(count(*) OVER () * 0.2 - 1e-9) THEN 'test' ELSE 'train' END AS split FROM orders""")
def b2(spark, d):
    return sm.split(table(spark, d, "orders").select(F.col("o_orderkey").alias("message_id")), 0.2)


@query("b3_stratified_split", f"WITH rows_ AS ({LABELS}), parts AS ({_STRAT.format(size=0.15)}) SELECT * FROM parts")
def b3(spark, d):
    return sm.stratified_split(label_rows(spark, d), "user", [("test", 0.15)])


_THREE = """
WITH rows_ AS ({rows}), first AS ({first}),
sized AS (SELECT "user", count(*) AS n FROM first WHERE split = 'train' GROUP BY "user"),
shared AS (SELECT "user", n, ceil(sum(n) OVER () * {val} - 1e-9) AS want,
                  n * ceil(sum(n) OVER () * {val} - 1e-9) / sum(n) OVER () AS exact FROM sized),
taken2 AS (SELECT "user", floor(exact) + (row_number() OVER (ORDER BY round(exact - floor(exact), 9) DESC, "user")
                  <= want - sum(floor(exact)) OVER ())::INT AS k FROM shared)
SELECT message_id, "user", split FROM first WHERE split = 'test' UNION ALL
SELECT message_id, "user", CASE WHEN row_number() OVER (PARTITION BY "user" ORDER BY md5(message_id || ':42')) <= k
       THEN 'val' ELSE 'train' END FROM first JOIN taken2 USING ("user") WHERE split = 'train'"""
_VECS = 'SELECT vec_id AS message_id, label AS "user" FROM embeddings'


@query("b4_train_val_test", _THREE.format(rows=_VECS, first=_STRAT.format(size=0.2), val=0.25))
def b4(spark, d):
    return sm.train_val_test(vectors(spark, d).select("message_id", "user"))


@query("b5_meta_split", f"""
WITH rows_ AS ({_VECS}), parts AS ({_STRAT.format(size=0.25)})
SELECT message_id, "user", CASE split WHEN 'test' THEN 'val' ELSE split END AS split FROM parts""")
def b5(spark, d):
    return sm.train_val_test(vectors(spark, d).select("message_id", "user"), test_size=0.0)


@query("b6_assign_folds", """
SELECT event_id AS message_id, CASE WHEN p < (q + 1) * r THEN p // (q + 1) ELSE r + (p - (q + 1) * r) // q END::INTEGER
       AS fold FROM (SELECT event_id, row_number() OVER (ORDER BY md5(event_id || ':42')) - 1 AS p,
                            count(*) OVER () // 7 AS q, count(*) OVER () % 7 AS r FROM events)""")
def b6(spark, d):
    return sm.assign_folds(table(spark, d, "events").select(F.col("event_id").alias("message_id")), 7)


def _uniform(text: str) -> str:
    return f"((('0x' || substr(md5({text}), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)"


@query("b7_balanced_resample", f"""
WITH placed AS (SELECT doc_id AS message_id, quality, row_number() OVER (ORDER BY quality, doc_id) - 1 AS place FROM labels),
sizes AS (SELECT quality, min(place) AS lowest, count(*) AS n FROM placed GROUP BY quality),
classes AS (SELECT *, row_number() OVER (ORDER BY quality) - 1 AS c FROM sizes),
draws AS (SELECT i AS draw, floor({_uniform("i || ':42'")} * (SELECT count(*) FROM classes))::BIGINT AS c,
                 {_uniform("i || ':43'")} AS u FROM range((SELECT count(*) FROM placed)) r(i))
SELECT message_id, placed.quality AS "user", draw FROM draws JOIN classes USING (c)
JOIN placed ON place = lowest + floor(u * n)::BIGINT""")
def b7(spark, d):
    return sm.balanced_resample(label_rows(spark, d))


@query("b8_encode_labels", """
SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderpriority)::INTEGER - 1 AS "user" FROM orders""")
def b8(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return sm.encode_labels(rows, "o_orderpriority").drop("o_orderpriority")

"""Registered array / image queries (I1-I7) on 8 x 8 views of embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import arrays as I
from quarry.functions.hashing import rnd
from quarry.plans import sqlfrag as S
from quarry.plans.registry import query
from quarry.sources.tables import emb_view

# weighted checksum of an image: sum((i + 1) * v_i), rounded
def _chk_spark(col):
    return rnd(F.aggregate(F.transform(col, lambda x, i: x * (i + 1)), F.lit(0.0),
                           lambda a, x: a + x), 9)


def _chk_sql(expr):
    return S.rnd(f"list_sum(list_transform({expr}, lambda x, i: x * i))", 9)


def _shift_sql(dx: int, dy: int) -> str:
    # out[i] (0-based) = src[(r - dy) * 8 + (c - dx)] when inside, else 0
    return ("list_transform(range(64), lambda i: CASE WHEN (i // 8) - " + str(dy)
            + " BETWEEN 0 AND 7 AND (i % 8) - " + str(dx) + " BETWEEN 0 AND 7 THEN emb[((i // 8) - "
            + str(dy) + ") * 8 + (i % 8) - " + str(dx) + " + 1] ELSE 0.0 END)")


@query("i1_shift_image", f"""WITH {S.EMB_CTE}
SELECT vec_id, {_chk_sql(_shift_sql(1, -2))} AS checksum, {S.rnd(_shift_sql(1, -2) + '[10]', 12)} AS px9 FROM emb""")
def i1_shift_image(spark, sf):
    e = emb_view(spark, sf).withColumn("s", I.shift_image("emb", 1, -2))
    return e.select("vec_id", _chk_spark(F.col("s")).alias("checksum"),
                    rnd(F.col("s")[9], 12).alias("px9"))


@query("i2_augment_shifts", f"""WITH {S.EMB_CTE}
""" + "\nUNION ALL\n".join(
    f"SELECT vec_id, label, {dx} AS dx, {dy} AS dy, {_chk_sql(_shift_sql(dx, dy))} AS checksum FROM emb"
    for dx, dy in I.UNIT_SHIFTS))
def i2_augment_shifts(spark, sf):
    e = emb_view(spark, sf).select("vec_id", "label", "emb")
    a = I.augment_shifts(e, "emb")
    return a.select("vec_id", "label", "dx", "dy", _chk_spark(F.col("emb")).alias("checksum"))


@query("i3_add_noise", f"""WITH {S.EMB_CTE}
SELECT vec_id, {_chk_sql("list_transform(emb, lambda x, i: x + ((" + S.md5_u32(S.key_text('42', 'vec_id', '(i - 1)')) + " % 100) - 50)::DOUBLE)")} AS checksum FROM emb""")
def i3_add_noise(spark, sf):
    e = emb_view(spark, sf).withColumn("n", I.add_noise("emb", "vec_id", -50, 50))
    return e.select("vec_id", _chk_spark(F.col("n")).alias("checksum"))


@query("i4_transpose_flip_darken", f"""WITH {S.EMB_CTE}
SELECT vec_id,
  {_chk_sql("list_transform(range(64), lambda i: emb[(i % 8) * 8 + (i // 8) + 1])")} AS transposed,
  {_chk_sql("list_transform(range(64), lambda i: emb[(i // 8) * 8 + (7 - i % 8) + 1])")} AS flipped,
  {_chk_sql("list_transform(emb, lambda x, i: x * CASE WHEN (i - 1) // 8 BETWEEN 2 AND 5 THEN 0.3 ELSE 1.0 END)")} AS darkened
FROM emb""")
def i4_transpose_flip_darken(spark, sf):
    e = emb_view(spark, sf)
    return e.select("vec_id", _chk_spark(I.transpose_image("emb")).alias("transposed"),
                    _chk_spark(I.flip_image("emb")).alias("flipped"),
                    _chk_spark(I.darken_rows("emb", 2, 6, 0.3)).alias("darkened"))


@query("i5_dot_norm_dist", f"""WITH {S.EMB_CTE},
r AS (SELECT emb AS r0 FROM emb WHERE vec_id = (SELECT min(vec_id) FROM emb))
SELECT vec_id, {S.rnd('list_dot_product(emb, r0)', 12)} AS dot,
       {S.rnd('sqrt(list_dot_product(emb, emb))', 12)} AS norm,
       {S.rnd('list_distance(emb, r0)', 12)} AS dist FROM emb, r""")
def i5_dot_norm_dist(spark, sf):
    e = emb_view(spark, sf)
    r0 = e.orderBy("vec_id").select("emb").first()[0]   # one reference row (64 values)
    ref = I.lit_vector(r0)
    return e.select("vec_id", rnd(I.dot("emb", ref), 12).alias("dot"),
                    rnd(I.norm("emb"), 12).alias("norm"),
                    rnd(I.euclidean("emb", ref), 12).alias("dist"))


@query("i6_argmax", """
SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INTEGER AS arg_max,
       (list_position(embedding, list_min(embedding)) - 1)::INTEGER AS arg_min FROM embeddings""")
def i6_argmax(spark, sf):
    e = emb_view(spark, sf)
    return e.select("vec_id", I.argmax("emb").alias("arg_max"), I.argmin("emb").alias("arg_min"))


@query("i7_explode_implode", f"""
SELECT vec_id, (i - 1)::INTEGER AS pos, {S.rnd('v', 12)} AS value FROM (
  SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)
WHERE v > 0.1""")
def i7_explode_implode(spark, sf):
    e = emb_view(spark, sf)
    long = I.explode_vector(e, ["vec_id"], "emb")
    back = I.implode_vector(long, ["vec_id"])           # round trip to arrays
    again = I.explode_vector(back, ["vec_id"], "vec")
    return again.filter(F.col("value") > 0.1).select(
        "vec_id", F.col("pos").cast("int"), rnd("value", 12).alias("value"))

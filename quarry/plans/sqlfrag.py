"""DuckDB SQL fragments mirroring the Spark expressions (oracle twins)."""

from __future__ import annotations


def md5_u32(text_sql: str) -> str:
    return f"(('0x' || substr(md5({text_sql}), 1, 8))::BIGINT)"


def key_text(*parts: str) -> str:
    return " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)


def md5_uniform(*parts: str) -> str:
    return f"({md5_u32(key_text(*parts))} / 4294967296.0)"


def md5_order(seed: int, *ids: str) -> str:
    return md5_u32(key_text(str(seed), *ids))


def rnd(x: str, k: int) -> str:
    return f"(round(({x})::DOUBLE, {k}) + 0.0)"


def le_hex64(x: str) -> str:
    return " || ".join(f"printf('%02x', (({x})::BIGINT >> {8 * i}) & 255)" for i in range(8))


LP_CTE = """lp AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
         l_discount + 0.0 AS l_discount, l_tax, l_returnflag, l_linestatus,
         p_brand, p_type, p_size, p_retailprice,
         3.0 * l_quantity + 200.0 * (l_discount + 0.0) + 0.05 * p_retailprice
           + 5.0 * CAST(l_returnflag = 'A' AS DOUBLE)
           + (""" + md5_u32(key_text("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")) + """
              / 4294967296.0 * 2.0 - 1.0) AS y_rule
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

LPN_CTE = LP_CTE + """,
lpn AS (
  SELECT * REPLACE (CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE l_tax END AS l_tax,
                    CASE WHEN l_partkey % 40 = 0 THEN NULL ELSE p_brand END AS p_brand)
  FROM lp)"""

EMB_CTE = """emb AS (
  SELECT vec_id, label, e AS emb,
         CASE WHEN e[1] >= e[2] AND e[1] >= e[3] THEN 0 WHEN e[2] >= e[3] THEN 1 ELSE 2 END
           AS c_rule
  FROM (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e
        FROM embeddings))"""

PLANE_CTE = """plane AS (
  SELECT o_orderkey AS id, o_totalprice / 10000.0 AS x, o_custkey / 30.0 AS y FROM orders)"""

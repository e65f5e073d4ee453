"""Small helpers that write the DuckDB oracle SQL for the search family."""

from __future__ import annotations


def score_sql(metric: str, a: str = "c.value", b: str = "q.qv") -> str:
    m = metric.upper()
    if m == "IP":
        return f"list_inner_product({a}, {b})"
    if m == "L2":
        return f"pow(list_distance({a}, {b}), 2)"
    if m == "COSINE":
        return (f"list_inner_product({a}, {b}) / "
                f"nullif(sqrt(list_inner_product({a}, {a}) * list_inner_product({b}, {b})), 0)")
    raise ValueError(metric)


def topk_sql(collection_sql: str, query_sql: str, metric: str, k: int, *, where: str = "TRUE",
             fields: str = "c.deviceCode, c.createTime, c.dt", out_fields: str = "deviceCode, createTime, dt",
             with_qid: bool = True, tie: str = "id, _dt, _ct") -> str:
    """Brute force: every (query, row) pair scored, ranked per query."""
    direction = "ASC" if metric.upper() == "L2" else "DESC"
    qid_out = "qid, " if with_qid else ""
    return f"""
WITH c AS ({collection_sql}),
q AS ({query_sql}),
s AS (
  SELECT q.qid, c.id, {score_sql(metric)} AS score, c.dt AS _dt, c.createTime AS _ct{', ' + fields if fields else ''}
  FROM q CROSS JOIN c
  WHERE {where}
),
r AS (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score {direction}, {tie}) AS rk
  FROM s WHERE score IS NOT NULL AND NOT isnan(score)
)
SELECT {qid_out}CAST(rk AS BIGINT) AS rank, id, round(score, 6) AS score{', ' + out_fields if out_fields else ''}
FROM r WHERE rk <= {k}
"""

"""Common table expressions reused by the SQL checks."""

from __future__ import annotations

# row number in seeded hash order inside each class, and the 70/15/15 split that follows from it
RANKED = """SELECT *, row_number() OVER (PARTITION BY TARGET
  ORDER BY md5(concat('42:', CAST(SK_ID_CURR AS VARCHAR))), SK_ID_CURR) AS rn, count(*) OVER (PARTITION BY TARGET) AS cn
  FROM loans"""
SPLIT = """SELECT * EXCLUDE (rn, cn), CASE WHEN rn <= floor(0.70 * cn) THEN 'train'
  WHEN rn <= floor(0.85 * cn) THEN 'val' ELSE 'test' END AS SPLIT FROM ranked"""
SPLIT_CTES = {"ranked": RANKED, "tagged": SPLIT}

ENGINEERED = """SELECT *,
  -DAYS_BIRTH / 365.25::DOUBLE AS AGE_YEARS, -DAYS_EMPLOYED / 365.25::DOUBLE AS EMPLOYED_YEARS,
  CASE WHEN AMT_INCOME_TOTAL > 0 THEN AMT_CREDIT / AMT_INCOME_TOTAL END AS CREDIT_INCOME_RATIO,
  CASE WHEN AMT_INCOME_TOTAL > 0 THEN AMT_ANNUITY / AMT_INCOME_TOTAL END AS ANNUITY_INCOME_RATIO,
  CASE WHEN AMT_GOODS_PRICE > 0 THEN AMT_CREDIT / AMT_GOODS_PRICE END AS CREDIT_GOODS_RATIO,
  CASE WHEN CNT_FAM_MEMBERS > 0 THEN AMT_INCOME_TOTAL / CNT_FAM_MEMBERS END AS INCOME_PER_FAM_MEMBER,
  (coalesce(EXT_SOURCE_1, 0) + coalesce(EXT_SOURCE_2, 0) + coalesce(EXT_SOURCE_3, 0)) / nullif(
    (EXT_SOURCE_1 IS NOT NULL)::INT + (EXT_SOURCE_2 IS NOT NULL)::INT + (EXT_SOURCE_3 IS NOT NULL)::INT, 0)
    AS EXT_SOURCE_MEAN
  FROM {source}"""

FIXED = "SELECT * REPLACE (nullif(DAYS_EMPLOYED, 365243) AS DAYS_EMPLOYED) FROM loans"


def unpivot(source: str, cols: list[str], keep: tuple[str, ...] = (), key: str = "feature", value: str = "x",
            cast: str = "DOUBLE") -> str:
    """UNION ALL long form that keeps NULLs."""
    kept = "".join(f"{k}, " for k in keep)
    return " UNION ALL ".join(
        f"SELECT {kept}'{c}' AS {key}, CAST(\"{c}\" AS {cast}) AS {value} FROM {source}" for c in cols
    )


def edge_bin(x: str, edges: str, closed: str = "right") -> str:
    """0-based bin of x on a sorted list column (1-based list access)."""
    if closed == "right":
        idx = f"greatest(len(list_filter({edges}, lambda e: e < {x})) - 1, 0)"
    else:
        idx = f"least(len(list_filter({edges}, lambda e: e <= {x})) - 1, len({edges}) - 2)"
    return f"CASE WHEN {x} >= {edges}[1] AND {x} <= {edges}[len({edges})] AND len({edges}) > 1 THEN {idx} END"


def edge_list(x: str, bins: int, digits: int = 9) -> str:
    """Sorted distinct rounded quantile edges."""
    probs = ", ".join(f"CAST({i} AS DOUBLE) / {bins}" for i in range(bins + 1))
    return f"list_sort(list_distinct(list_transform(quantile_cont({x}, [{probs}]), lambda q: round(q, {digits}))))"

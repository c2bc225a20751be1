"""Daily repricing over the derived store snapshot."""

from __future__ import annotations

from shelfwise.plans.repricing import plan
from shelfwise.queries import views as V
from shelfwise.registry import query

_PREVIEW = f"""
WITH store AS ({V.as_sql(V.STORE)}),
parsed AS (
  SELECT id, sku, name, trim(mode_text) AS mode,
    coalesce(CAST(round(TRY_CAST(replace(regular_price, ',', '') AS DECIMAL(18,4))) AS BIGINT), 0) AS old_price,
    TRY_CAST(replace(weight_text, ',', '') AS DECIMAL(12,4)) AS w,
    CAST(round(TRY_CAST(replace(stone_text, ',', '') AS DECIMAL(18,4))) AS BIGINT) AS s,
    CAST(round(TRY_CAST(replace(legacy_text, ',', '') AS DECIMAL(18,4))) AS BIGINT) AS l
  FROM store WHERE status = 'publish' AND id > 0),
reasoned AS (
  SELECT *, CASE
    WHEN mode = '' THEN 'skip-missing-mode'
    WHEN mode = 'manual_locked' THEN 'skip-manual-locked'
    WHEN mode = 'legacy_mirror' AND coalesce(l, 0) > 0 THEN 'mirror-legacy'
    WHEN mode = 'legacy_mirror' THEN 'skip-missing-legacy-price'
    WHEN mode NOT IN ('silver_weight_only', 'silver_weight_plus_stone') THEN 'skip-unknown-mode'
    WHEN coalesce(w, 0) <= 0 THEN 'skip-missing-or-bad-weight'
    WHEN mode = 'silver_weight_only' THEN 'calc-weight'
    WHEN coalesce(s, 0) > 0 THEN 'calc-weight-stone'
    ELSE 'skip-missing-or-bad-stone' END AS reason
  FROM parsed),
preview AS (
  SELECT id, sku, name, old_price, reason, CAST(CASE reason
      WHEN 'mirror-legacy' THEN l
      WHEN 'calc-weight' THEN greatest(CAST(floor((w * 85000 + 5000) / 10000) AS BIGINT) * 10000, 10000)
      WHEN 'calc-weight-stone' THEN CAST(floor(w * 85000 + s + 0.5) AS BIGINT) END AS BIGINT) AS new_price
  FROM reasoned),
delta AS (
  SELECT *, CASE WHEN old_price > 0 AND new_price IS NOT NULL
    THEN CAST(new_price - old_price AS DOUBLE) / CAST(old_price AS DOUBLE) * 100.0 ELSE 0.0 END AS raw_delta
  FROM preview)
"""


def _plan(spark, folder):
    return plan(V.store(spark, folder), V.rate(spark))


def _rounded(df):
    from pyspark.sql import functions as F

    return df.withColumn("delta_pct", F.round("delta_pct", 4)).drop("rate")


@query("reprice_preview", _PREVIEW + "SELECT id, sku, name, old_price, new_price, reason, round(raw_delta, 4) AS delta_pct FROM delta")
def reprice_preview(spark, folder):
    return _rounded(_plan(spark, folder).preview)


@query("reprice_changes", _PREVIEW + """
SELECT id, sku, name, old_price, new_price, reason, round(raw_delta, 4) AS delta_pct
FROM delta WHERE new_price IS NOT NULL AND new_price <> old_price""")
def reprice_changes(spark, folder):
    return _rounded(_plan(spark, folder).changes)


@query("reprice_reason_counts", _PREVIEW + """
SELECT reason, count(*) AS n, reason LIKE 'skip%' AS skipped FROM delta GROUP BY reason""")
def reprice_reason_counts(spark, folder):
    return _plan(spark, folder).reasons


@query("reprice_top20", _PREVIEW + """
SELECT id, sku, name, old_price, new_price, reason, round(raw_delta, 4) AS delta_pct
FROM delta WHERE new_price IS NOT NULL ORDER BY abs(raw_delta) DESC, id LIMIT 20""")
def reprice_top20(spark, folder):
    return _rounded(_plan(spark, folder).top(20))


@query("price_audit", _PREVIEW + """
SELECT id, sku, old_price AS old_regular_price, new_price AS new_regular_price, reason AS mode, CAST(85000 AS BIGINT) AS rate
FROM delta WHERE new_price IS NOT NULL AND new_price <> old_price""")
def price_audit(spark, folder):
    return _plan(spark, folder).audit

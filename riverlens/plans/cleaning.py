"""Cleaning queries (CLN-1, CLN-2, CLN-4, CLN-5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverlens.functions import dims
from riverlens.operators import cleaning as C
from riverlens.plans.ingest import JOINED_SQL, _JOINED_COLS, joined_table
from riverlens.plans.labelling import scored_observations
from riverlens.plans.oracle import d, scored_cte
from riverlens.plans.registry import register

FEATURES = dims.MODEL_FEATURES


@register("sparse_columns", ("CLN-1",), oracle=f"""
WITH {JOINED_SQL}
SELECT * FROM ({' UNION ALL '.join(f"SELECT '{c}' AS column_name, round(count(*) FILTER (WHERE {c} IS NULL) * {d(100.0)} / count(*), 6) AS pct FROM joined" for c in _JOINED_COLS)})
WHERE pct > {d(40.0)}
""")
def sparse_columns(spark, sf_dir):
    j = joined_table(spark, sf_dir).select(*_JOINED_COLS)
    return C.sparse_columns(j, 40.0).select("column_name", F.round("pct", 6).alias("pct"))


@register("imputation_audit", ("CLN-4",), oracle=f"""
WITH {scored_cte()}
{' UNION ALL '.join(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS imputed, count(*) AS rows, 12 AS columns_after FROM scored" for c in FEATURES)}
""")
def imputation_audit(spark, sf_dir):
    df = scored_observations(spark, sf_dir)
    state = C.fit_cleaning(df, FEATURES, protected=("wqi_class", "potability"))
    return C.imputation_audit(df, state)


@register("cleaned_observations", ("CLN-5", "CLN-2", "WIN-1"), oracle=f"""
WITH {scored_cte()}, d AS (SELECT DISTINCT * FROM scored),
med AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS m_{c}' for c in FEATURES)} FROM d)
SELECT obs_id, {', '.join(f'round(coalesce({c}, m_{c}), 6) AS {c}' for c in FEATURES)} FROM d, med
""")
def cleaned_observations(spark, sf_dir):
    cleaned, _state = C.run_cleaning(scored_observations(spark, sf_dir), FEATURES)
    return cleaned.select("obs_id", *[F.round(c, 6).alias(c) for c in FEATURES])

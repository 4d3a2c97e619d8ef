"""Queries over contracts, conversions and table sets (VAL-3/4, SET-1, SNK-7, SCL-4, CLN-3, PRJ-1/2/3, FLT-4, SPL-2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverlens.functions import dims
from riverlens.functions.index import with_score
from riverlens.functions.scalars import log10_floor1, normalise_text, slug
from riverlens.operators import cleaning as C
from riverlens.operators import ingest as I
from riverlens.operators import models as MD
from riverlens.operators import split as S
from riverlens.plans.labelling import scored_observations
from riverlens.plans.oracle import d, index_ctes, obs_cte, scored_cte
from riverlens.plans.registry import register
from riverlens.plans.training import SPLIT_SQL, split_frame
from riverlens.session import written
from riverlens.sources import feeds as FD
from riverlens.sources import sinks as SK
from riverlens.sources.tables import observations, read_table

FEATURES = dims.MODEL_FEATURES


@register("trimmed_keys", ("PRJ-1",), oracle=f"""
WITH {obs_cte()}
SELECT state, station, count(*) AS n FROM obs GROUP BY state, station
""")
def trimmed_keys(spark, sf_dir):
    """Headers and keys padded as in a hand-made file, then trimmed and counted."""
    obs = observations(spark, sf_dir)
    raw = obs.select(F.concat(F.lit("  "), "state", F.lit(" ")).alias(" state"), F.concat("station", F.lit("   ")).alias("station "))
    return I.trim_keys(raw, ("state", "station")).groupBy("state", "station").agg(F.count(F.lit(1)).alias("n"))


# raw headers, as the feeds have them; hardness and chloride are arithmetic on the quantities
_RAW_HEADERS = {"Potential of Hydrogen (pH)": "ph", "DO": "do_mgl", " Biochemical Oxygen Demand (mg/L) ": "bod_mgl"}
_CANON = ("ph", "do_mgl", "bod_mgl", "hardness", "chloride")
_CANON_IDX, _CANON_OUT = index_ctes("raw5", _CANON, "can")


@register("canonical_alias_map", ("PRJ-2", "PRJ-3", "WQI-2"), oracle=f"""
WITH {obs_cte()},
raw5 AS (SELECT obs_id, ph, do_mgl, bod_mgl, {d(20.0)} * ph AS hardness, {d(30.0)} * ph AS chloride, ph / {d(4.0)} AS ammonia_n FROM obs),
{_CANON_IDX}
SELECT obs_id, n_params, round(wqi_score, 6) AS wqi_score, round(ammonia_n, 6) AS ammonia_n FROM {_CANON_OUT}
""")
def canonical_alias_map(spark, sf_dir):
    """Raw headers and short codes become canonical columns; the score then sees all five parameters."""
    obs = observations(spark, sf_dir)
    raw = obs.select("obs_id", *[F.col(c).alias(h) for h, c in _RAW_HEADERS.items()],
                     (20.0 * F.col("ph")).alias("Total Hardness (mgCaCO3/L)"), (30.0 * F.col("ph")).alias("CHLORIDE (mg/L)"),
                     (F.col("ph") / 4.0).alias("Amonia N (mgN/L)"))
    named = C.canonical_names(raw)
    scored = with_score(named, [dims.PARAMETER_BY_COLUMN[c] for c in _CANON])
    return scored.select("obs_id", "n_params", F.round("wqi_score", 6).alias("wqi_score"),
                         F.round("ammonia_n", 6).alias("ammonia_n"))


@register("part_slugs", ("SCL-4",), oracle="""
SELECT regexp_replace(lower(trim(p_type)), '[^a-z0-9]+', '_', 'g') AS slug, lower(trim(p_brand)) AS brand, count(*) AS n
FROM part GROUP BY ALL
""")
def part_slugs(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    return (part.groupBy(slug(F.col("p_type")).alias("slug"), normalise_text(F.col("p_brand")).alias("brand"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("strict_numeric_totals", ("VAL-3",), oracle=f"""
WITH {obs_cte()}
SELECT state, count(ph) AS n, round(sum(ph), 4) AS ph_sum, round(sum(bod_mgl), 4) AS bod_sum FROM obs GROUP BY state
""")
def strict_numeric_totals(spark, sf_dir):
    """Measurements that arrived as text, converted under the strict contract."""
    obs = observations(spark, sf_dir).select("state", *[F.col(c).cast("string").alias(c) for c in ("ph", "bod_mgl")])
    num = SK.strict_numeric(obs, ("ph", "bod_mgl"))
    return num.groupBy("state").agg(F.count("ph").alias("n"), F.round(F.sum("ph"), 4).alias("ph_sum"),
                                    F.round(F.sum("bod_mgl"), 4).alias("bod_sum"))


_CELLS = ("NA", " n/a ", "", "abc", "NaN", "-1.#IND")


@register("coerced_cells", ("VAL-4", "SRC-2"), oracle=f"""
WITH b AS (SELECT l_orderkey, l_linenumber, l_orderkey % 9 AS r, l_quantity FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN r < {len(_CELLS)} THEN NULL ELSE l_quantity END AS value,
       CASE WHEN r IN (0, 1, 2, 4, 5) THEN NULL WHEN r = 3 THEN 'abc' ELSE 'x' END AS note FROM b
""")
def coerced_cells(spark, sf_dir):
    """A text column with missing tokens, junk and padded numbers, read leniently."""
    li = read_table(spark, sf_dir, "lineitem")
    junk = F.col("l_orderkey") % 9 < len(_CELLS)
    cell = F.when(junk, F.get(F.array(*[F.lit(c) for c in _CELLS]), (F.col("l_orderkey") % 9).cast("int")))
    raw = li.select(F.col("l_orderkey").cast("string").alias("k"), F.col("l_linenumber").cast("string").alias("n"),
                    F.coalesce(cell, F.concat(F.lit(" "), F.col("l_quantity").cast("double").cast("string"))).alias("value"),
                    F.coalesce(cell, F.lit(" x ")).alias("note"))
    out = FD.coerced(raw, ("value",))
    return out.select(F.col("k").cast("long").alias("l_orderkey"), F.col("n").cast(li.schema["l_linenumber"].dataType).alias("l_linenumber"),
                      "value", "note")


@register("union_of_state_tables", ("SET-1",), oracle=f"""
WITH {obs_cte()}, x AS (SELECT state, ph, CASE WHEN substr(state, 1, 1) < 'I' THEN bod_mgl END AS bod_mgl,
                               CASE WHEN substr(state, 1, 1) >= 'I' THEN fc END AS fc FROM obs)
SELECT state, count(*) AS n, count(ph) AS ph, count(bod_mgl) AS bod_mgl, count(fc) AS fc FROM x GROUP BY state
""")
def union_of_state_tables(spark, sf_dir):
    """Two groups of states with different columns, concatenated by name."""
    obs = observations(spark, sf_dir)
    early = F.substring("state", 1, 1) < "I"
    both = FD.union_states([obs.where(early).select("state", "ph", "bod_mgl"), obs.where(~early).select("fc", "state", "ph")])
    return both.groupBy("state").agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(c) for c in ("ph", "bod_mgl", "fc")])


@register("updated_comparison", ("SNK-7", "SET-2"), oracle=f"""
WITH {obs_cte()},
old AS (SELECT state || CASE WHEN l_r = 0 THEN ' (Tuned)' ELSE '' END AS model, round(avg(ph), 6) AS score
        FROM (SELECT *, CASE WHEN bod_mgl IS NULL THEN 0 ELSE 1 END AS l_r FROM obs) GROUP BY ALL),
fresh AS (SELECT state || ' (Tuned)' AS model, round(avg(ph), 6) AS score FROM obs GROUP BY ALL)
SELECT model, score FROM old WHERE NOT contains(model, '(Tuned)') UNION ALL SELECT model, score FROM fresh
""")
def updated_comparison(spark, sf_dir):
    """A comparison table whose tuned rows give way to fresh ones."""
    obs = observations(spark, sf_dir)
    name = F.concat("state", F.when(F.col("bod_mgl").isNull(), " (Tuned)").otherwise(""))
    old = obs.groupBy(name.alias("model")).agg(F.round(F.avg("ph"), 6).alias("score"))
    fresh = obs.groupBy(F.concat("state", F.lit(" (Tuned)")).alias("model")).agg(F.round(F.avg("ph"), 6).alias("score"))
    return SK.update_comparison(old, fresh)


@register("complete_rows", ("CLN-3",), oracle=f"""
WITH {scored_cte()}
SELECT obs_id, {', '.join(f'round({c}, 6) AS {c}' for c in FEATURES)} FROM scored
WHERE {' AND '.join(f'{c} IS NOT NULL' for c in FEATURES)}
""")
def complete_rows(spark, sf_dir):
    df = scored_observations(spark, sf_dir)
    state = C.fit_cleaning(df, FEATURES, protected=("wqi_class", "potability"), strategy="drop_rows")
    return C.apply_cleaning(df, state, FEATURES).select("obs_id", *[F.round(c, 6).alias(c) for c in FEATURES])


@register("seeded_sample", ("FLT-4",), oracle=f"""
WITH {obs_cte()}
SELECT obs_id, round(ph, 6) AS ph FROM obs
ORDER BY CAST(('0x' || substr(md5(obs_id || ':42'), 1, 13)) AS BIGINT), obs_id LIMIT 200
""")
def seeded_sample(spark, sf_dir):
    return C.seeded_sample(observations(spark, sf_dir), 200).select("obs_id", F.round("ph", 6).alias("ph"))


_AUDIT = ("target columns among the features", "statistics fitted beyond the train rows", "features outside the frozen list",
          "keys on both sides", "source rows that repeat", "rows that a second split moves",
          "features that are no function of their row", "rows with another log10 feature")


@register("leakage_audit", ("SPL-2", "VAL-2"), oracle=f"""
WITH {obs_cte()}, twice AS (SELECT count(*) AS n FROM (SELECT obs_id FROM obs GROUP BY obs_id HAVING count(*) > 1))
SELECT item, "check", CASE WHEN item = 5 AND n > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
       CASE WHEN item = 5 THEN n ELSE 0 END AS violations
FROM (VALUES {', '.join(f"({i + 1}, '{c}')" for i, c in enumerate(_AUDIT))}) AS t(item, "check"), twice
""")
def leakage_audit(spark, sf_dir):
    sp = split_frame(spark, sf_dir).withColumn("log10_fc", log10_floor1(F.col("fc")))
    stats = S.fitted_statistics(sp.where(F.col("split") == "train"))
    return S.leakage_audit(sp, MD.FEATURES, stats, observations(spark, sf_dir))


_ORDER = "CAST(split_part(obs_id, '-', 1) AS BIGINT)"


@register("planted_leakage_audit", ("SPL-2", "VAL-2"), oracle=f"""
WITH {SPLIT_SQL}, k AS (SELECT obs_id, split, fc, {_ORDER} AS o FROM sp),
data AS (SELECT * FROM k UNION ALL SELECT obs_id, 'train', fc, o FROM k WHERE split = 'test' AND o % 97 = 0),
per AS (SELECT obs_id, count(*) AS n, bool_or(split = 'train') AND bool_or(split = 'test') AS twosided FROM data GROUP BY obs_id),
v(item, violations) AS (VALUES (1, 1), (2, {len(FEATURES)}), (3, 1), (4, (SELECT count(*) FILTER (WHERE twosided) FROM per)),
  (5, (SELECT count(*) FILTER (WHERE n > 1) FROM per)), (6, (SELECT count(*) FROM data)),
  (7, (SELECT count(*) FILTER (WHERE o % 89 = 0) + count(*) FILTER (WHERE o % 83 = 0 AND fc IS NOT NULL) FROM data)),
  (8, (SELECT count(*) FILTER (WHERE o % 83 = 0 AND fc IS NOT NULL) FROM data)))
SELECT CAST(item AS INTEGER) AS item, "check", CASE WHEN violations > 0 THEN 'FAIL' ELSE 'PASS' END AS status, violations
FROM v JOIN (VALUES {', '.join(f"({i + 1}, '{c}')" for i, c in enumerate(_AUDIT))}) AS t(item, "check") USING (item)
""")
def planted_leakage_audit(spark, sf_dir):
    """A leak of every kind: a target feature, statistics of all rows, test rows among the train rows, no seed, foreign values."""
    raw = observations(spark, sf_dir)
    sp = split_frame(spark, sf_dir).select("obs_id", "wqi_class", "split", *FEATURES)
    sp = written(sp.withColumn("log10_fc", log10_floor1(F.col("fc"))), "clean-split")
    order = F.split("obs_id", "-")[0].cast("long")
    data = sp.unionByName(sp.where((F.col("split") == "test") & (order % 97 == 0)).withColumn("split", F.lit("train")))
    data = data.withColumns({"ph": F.when(order % 89 == 0, F.col("ph") + 1).otherwise(F.col("ph")),
                             "log10_fc": F.when(order % 83 == 0, F.col("log10_fc") + 1).otherwise(F.col("log10_fc"))})
    return S.leakage_audit(data, (*MD.FEATURES, "wqi_score"), S.fitted_statistics(sp), raw, seed=None)

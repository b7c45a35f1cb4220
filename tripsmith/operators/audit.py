"""Attribution and leakage audit, deterministic sampling, behavioural probes
(K1-K4, D4, D8, E16, G4, G5, M1-M7).

Attribution is re-aimed as a job over all rows: for a linear model the exact
Shapley values are ``phi_j = w_j * (x_j - mean_j)`` with base value
``b + sum_j w_j * mean_j`` - pure column expressions, unpivoted into a long
(row, feature, phi) form inside the scan stage.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.numeric import rnd
from ..sources.tables import key_hash
from .ordering import with_global_position


# -- K1(a) / K2 -----------------------------------------------------------------------------
def _attributions(scored: DataFrame, coefs: dict[str, float], intercept: float, background: DataFrame) -> DataFrame:
    """``scored`` with ``_base`` (prediction of the mean row) and ``_phis`` (feature, phi)."""
    feats = list(coefs)
    means = background.agg(*[F.avg(F.col(f).cast("double")).alias(f"_m_{f}") for f in feats])
    j = scored.crossJoin(F.broadcast(means))  # one-row side
    base = F.lit(float(intercept))
    for f in feats:
        base = base + F.lit(float(coefs[f])) * F.col(f"_m_{f}")
    phis = F.array(*[F.struct(F.lit(f).alias("feature"), (
        F.lit(float(coefs[f])) * (F.col(f).cast("double") - F.col(f"_m_{f}"))).alias("phi")) for f in feats])
    return j.withColumns({"_base": base, "_phis": phis}).drop(*[f"_m_{f}" for f in feats])


def linear_attribution(df: DataFrame, coefs: dict[str, float], intercept: float,
                       background: DataFrame, key: str = C.KEY_COL) -> DataFrame:
    """Long table ``key, feature, phi`` plus per-row ``base_value`` for a linear model
    ``intercept + sum w_j x_j``.  ``background`` supplies the feature means (one pass)."""
    j = _attributions(df.select(key, *coefs), coefs, intercept, background)
    return j.select(key, F.col("_base").alias("base_value"), F.explode("_phis").alias("a")).select(key, "base_value", "a.*")


def additivity_violations(scored: DataFrame, coefs: dict[str, float], intercept: float, background: DataFrame,
                          pred: str = "prediction", tolerance: float = C.ADDITIVITY_TOLERANCE) -> DataFrame:
    """K2 on every row: |base + sum(phi) - prediction| >= tolerance counts as a violation.

    ``prediction`` is what a model has written for the row, not rebuilt here; the attributions are
    summed inside the row, without a shuffle.  A NULL prediction counts as a violation.
    """
    j = _attributions(scored, coefs, intercept, background)
    total = F.aggregate("_phis", F.lit(0.0), lambda s, x: s + x["phi"])
    diff = F.abs(F.col("_base") + total - F.col(pred))
    return j.agg(F.count(F.lit(1)).alias("rows_checked"),
                 F.count_if(F.coalesce(diff >= F.lit(float(tolerance)), F.lit(True))).alias("violations"),
                 rnd(F.max(diff), 6).alias("max_abs_diff"))


# -- K1(b) ----------------------------------------------------------------------------------
def permutation_importance(df: DataFrame, score: Callable[[dict[str, Column]], Column], features: Sequence[str],
                           target: str = C.TARGET, key: str = C.KEY_COL, shift: int = 1) -> DataFrame:
    """RMSE of a model when one feature at a time comes from another row, and how much it adds.

    Rows are put in the order of a hash of the key; each row gets the features of the row ``shift``
    places on (the last rows those of the first).  One global order, one join on the unique
    position, and one aggregation serve all features: a feature's permuted score is computed
    inside the row.  ``score`` turns the features (by name) into a prediction.
    """
    feats = list(features)
    rows = df.select(key, key_hash(key).alias("_h"), F.col(target).cast("double").alias("_y"), *feats)
    placed = with_global_position(rows, ["_h", key], "_pos")
    n = placed.count()
    if not n:
        raise ValueError("no row to permute")
    other = placed.select(F.pmod(F.col("_pos") - shift, F.lit(n)).alias("_pos"), F.struct(*feats).alias("_o"))
    j = placed.join(other, "_pos")
    own = {f: F.col(f) for f in feats}

    def rmse(columns):
        return F.sqrt(F.avg(F.pow(F.col("_y") - score(columns), 2)))
    agg = j.agg(rmse(own).alias("_base"), *[rmse({**own, f: F.col(f"_o.{f}")}).alias(f) for f in feats])
    long = agg.select("_base", F.explode(F.map_from_arrays(F.array(*[F.lit(f) for f in feats]), F.array(*feats))).alias("feature", "_r"))
    order = Window.orderBy(F.desc(F.col("_r") - F.col("_base")), "feature")  # a row per feature
    return long.select("feature", rnd("_base", 2).alias("rmse_base"), rnd("_r", 2).alias("rmse_permuted"),
                       rnd(F.col("_r") - F.col("_base"), 2).alias("importance"), F.row_number().over(order).alias("rank"))


# -- E16 / F5 -------------------------------------------------------------------------------
def attribution_power(attr_long: DataFrame, feature: str = "feature", phi: str = "phi",
                      threshold: float = C.DOMINANCE_THRESHOLD) -> DataFrame:
    """Mean |phi| per feature, its share of the total, 1-based rank, dominance flag.
    The per-feature table has one row per feature, so the ranking window is tiny."""
    per = attr_long.groupBy(feature).agg(F.avg(F.abs(F.col(phi).cast("double"))).alias("_mabs"))
    tot = per.agg(F.sum("_mabs").alias("_tot"))
    out = per.crossJoin(F.broadcast(tot)).withColumn("_frac", F.try_divide(F.col("_mabs"), F.col("_tot")))
    out = out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("_mabs"), F.asc(feature))))
    return out.select(F.col(feature).alias("feature"), rnd("_mabs", 2).alias("mean_abs_attribution"),
                      rnd("_frac", 4).alias("fraction"), "rank",
                      (F.col("_frac") > F.lit(float(threshold))).alias("dominant"))


def registry_audit(ranking: DataFrame, registry: DataFrame,
                   share_limit: float = C.REGISTRY_SHARE_LIMIT) -> DataFrame:
    """Ranking joined with registry flags.  LEAKAGE when a feature that is not
    available at inference holds more than ``share_limit`` of the attribution;
    WARNING when its risk is not 'none' (unknown features count as risk UNKNOWN)."""
    flags = registry.select("feature", "available_at_inference", "leakage_risk")
    j = ranking.join(F.broadcast(flags), "feature", "left").withColumns({
        "available_at_inference": F.col("available_at_inference").cast("string"),
        "leakage_risk": F.coalesce(F.col("leakage_risk"), F.lit("UNKNOWN")),
    }).withColumn("available_at_inference",
                  F.coalesce(F.col("available_at_inference"), F.lit("UNKNOWN")))
    big = F.col("fraction") > F.lit(float(share_limit))
    return j.withColumn("status", F.when((F.col("available_at_inference") == "false") & big, "LEAKAGE")
                        .when((F.col("leakage_risk") != "none") & big, "WARNING").otherwise("OK"))


def leakage_verdict(audit: DataFrame) -> DataFrame:
    """K3: counts and CLEAN / LEAKAGE_DETECTED verdict."""
    return audit.agg(F.count_if(F.col("status") == "LEAKAGE").alias("leakage_violations"),
                     F.count_if(F.col("status") == "WARNING").alias("warnings"),
                     F.count_if(F.col("dominant")).alias("dominant_features")).withColumn(
        "verdict", F.when(F.col("leakage_violations") == 0, "CLEAN").otherwise("LEAKAGE_DETECTED"))


# -- G5 -------------------------------------------------------------------------------------
def top_feature(ranking: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` features of highest attribution (a report over one row per feature)."""
    return ranking.where(F.col("rank") <= n)


# -- G4 -------------------------------------------------------------------------------------
def seeded_sample(df: DataFrame, fraction: float, seed: int = 42, key: str = C.KEY_COL) -> DataFrame:
    """Deterministic sample: a fraction of all rows by key hash; a filter, no sort."""
    return df.where(key_hash(key, seed) < F.lit(int(fraction * 4294967296)))


# -- D8 / M: behavioural probes -------------------------------------------------------------
# The probe scenarios and limits (vendor, passengers, direction,
# distance ladder, rush / night, weekday / weekend).
MIDTOWN = (40.7580, -73.9855)
BROOKLYN = (40.6782, -73.9442)
SCENARIOS: list[dict] = [
    {"scenario": "base"},
    {"scenario": "vendor_1", "vendor_id": 1},
    {"scenario": "vendor_2", "vendor_id": 2},
    {"scenario": "vendor_1_20km", "vendor_id": 1, "distance_km": 20.0},
    {"scenario": "vendor_2_20km", "vendor_id": 2, "distance_km": 20.0},
    {"scenario": "vendor_1_plus_1km", "vendor_id": 1, "distance_delta": 1.0},
    *[{"scenario": f"pax_{n}", "passenger_count": n} for n in range(1, 7)],
    {"scenario": "forward", "pickup_latitude": MIDTOWN[0], "pickup_longitude": MIDTOWN[1],
     "dropoff_latitude": BROOKLYN[0], "dropoff_longitude": BROOKLYN[1], "distance_km": 9.5},
    {"scenario": "reverse", "pickup_latitude": BROOKLYN[0], "pickup_longitude": BROOKLYN[1],
     "dropoff_latitude": MIDTOWN[0], "dropoff_longitude": MIDTOWN[1], "distance_km": 9.5},
    *[{"scenario": f"dist_{d}", "distance_km": float(d)} for d in (1, 2, 5, 10, 20, 30)],
    {"scenario": "rush_8", "hour": 8, "is_rush_hour": 1},
    {"scenario": "night_3", "hour": 3, "is_rush_hour": 0},
    {"scenario": "weekday_rush", "hour": 9, "day_of_week": 0, "is_weekend": 0, "is_rush_hour": 1},
    {"scenario": "weekend", "hour": 9, "day_of_week": 5, "is_weekend": 1, "is_rush_hour": 0},
]
#: Scenario keys that are not a feature to override.
_EXTRA = {"scenario", "distance_delta"}


def _scenario_columns(scenario: dict, features: dict[str, Column]) -> dict[str, Column]:
    """The features under a scenario: overrides as literals, the rest as given."""
    unknown = set(scenario) - _EXTRA - set(C.FEATURES)
    if unknown:
        raise ValueError(f"unknown scenario keys: {sorted(unknown)}")
    out = {f: F.lit(scenario[f]) if f in scenario else c for f, c in features.items()}
    if "distance_delta" in scenario:
        out["distance_km"] = out["distance_km"] + F.lit(float(scenario["distance_delta"]))
    return out


def scenario_rows(bases: DataFrame, scenarios: Sequence[dict] = tuple(SCENARIOS),
                  key: str = C.KEY_COL) -> DataFrame:
    """Every base row x every scenario, any feature of the contract overridden; columns keep
    their types.  The scenarios are exploded inside the scan stage: no join, no shuffle."""
    kinds = dict(bases.dtypes)
    feats = [f for f in C.FEATURES if f in kinds]
    missing = {k for s in scenarios for k in s if k in C.FEATURES} - set(feats)
    if missing:
        raise ValueError(f"overridden features that the base rows lack: {sorted(missing)}")
    arr = F.array(*[F.struct(F.lit(s["scenario"]).alias("scenario"), *[
        c.cast(kinds[f]).alias(f) for f, c in _scenario_columns(s, {f: F.col(f) for f in feats}).items()]) for s in scenarios])
    rest = [c for c in bases.columns if c not in feats and c != key]
    return bases.select(F.col(key).alias("base_id"), *rest, F.explode(arr).alias("_s")).select("base_id", *rest, "_s.*")


def probe_results(bases: DataFrame, score: Callable[[dict[str, Column]], Column]) -> DataFrame:
    """M1-M7 per base row, then pass counts per probe.  ``score`` turns the features (by name) into
    a prediction; all scenarios of a row are scored inside the row, so nothing is multiplied or
    shuffled but the counts."""
    feats = {f: F.col(f) for f in C.FEATURES if f in bases.columns}
    named = bases.select(*[score(_scenario_columns(s, feats)).alias(s["scenario"]) for s in SCENARIOS])
    p = {s["scenario"]: F.col(f"`{s['scenario']}`") for s in SCENARIOS}
    dists = [p[f"dist_{d}"] for d in (1, 2, 5, 10, 20, 30)]
    mono = F.lit(True)
    for a, b in zip(dists, dists[1:]):
        mono = mono & (b > a)
    pax = [p[f"pax_{n}"] for n in range(1, 7)]
    checks = {
        "vendor_invariance": (F.abs(p["vendor_1"] - p["vendor_2"]), F.lit(60.0), "lt"),
        "vendor_invariance_20km": (F.abs(p["vendor_1_20km"] - p["vendor_2_20km"]), F.lit(120.0), "lt"),
        "vendor_vs_distance": (F.abs(p["vendor_1"] - p["vendor_2"]),
                               F.abs(p["vendor_1_plus_1km"] - p["vendor_1"]), "lt"),
        "passenger_1_vs_4": (F.abs(p["pax_1"] - p["pax_4"]), F.lit(60.0), "lt"),
        "passenger_spread": (F.greatest(*pax) - F.least(*pax), F.lit(60.0), "lt"),
        "direction_asymmetry": (F.try_divide(F.abs(p["forward"] - p["reverse"]), p["forward"]),
                                F.lit(0.20), "lt"),
        "distance_monotone": (mono.cast("double"), F.lit(1.0), "eq"),
        "distance_beats_rush": (p["rush_8"] - p["base"], p["dist_10"] - p["dist_5"], "lt"),
        "rush_beats_night": (p["night_3"], p["rush_8"], "lt"),
        "weekday_beats_weekend": (p["weekend"], p["weekday_rush"], "lt"),
    }
    structs = []
    for name, (val, lim, cmp) in checks.items():
        ok = (val < lim) if cmp == "lt" else (val == lim)
        structs.append(F.struct(F.lit(name).alias("probe"), val.cast("double").alias("value"),
                                F.coalesce(ok, F.lit(False)).alias("passed")))
    long = named.select(F.explode(F.array(*structs)).alias("c")).select("c.*")
    return long.groupBy("probe").agg(
        F.count(F.lit(1)).alias("bases"), F.count_if("passed").alias("passed"),
        rnd(F.max("value"), 4).alias("max_value"), rnd(F.avg("value"), 4).alias("mean_value"))

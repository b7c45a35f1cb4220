"""Registered queries over fitted models: linear models on the whole feature contract, boosted trees,
their attributions, probes and walk-forward validation (J1-J10, K1, K2, M1-M7, A12).

The SQL solves the same normal equations by elimination, and grows the same small trees.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from .. import config as C
from ..functions.numeric import rnd, rnd_sql
from ..operators import audit as AU
from ..operators import boosted as B
from ..operators import calibration as CA
from ..operators import estimators as E
from ..operators import metrics as M
from ..operators import models as MD
from ..sources.sinks import scratch_path
from . import oracle as O
from .catalog import (_ASSIGN_SQL, _CAL_CTES, _FOLDS_SQL, FOLDS, SPLIT_CTE, THR_CTE, _iso_apply_sql, _iso_ctes, processed_full, query,
                      spike_thr, train_val)

_N = len(C.FEATURES)


# -- least squares over all features, in SQL -----------------------------------------------------
def _solved(name: str, src: str, by: str = "") -> list[str]:
    """CTEs that end in ``name``: a row per group with b0.. (coefficients), m0.. (means), s0.. (spreads), my.

    Normal equations of standardised features, solved by elimination; a feature without spread gets 0.
    """
    g, comma = (f"{by} as g", f"group by {by}") if by else ("0 as g", "")
    x = [f"cast({f} as double)" for f in C.FEATURES]
    stats = f"{name}_s as materialized (select {g}, avg(cast(trip_duration as double)) as my, " + ", ".join(
        f"avg({c}) as m{i}, stddev_pop({c}) as s{i}" for i, c in enumerate(x)) + f" from {src} {comma})"
    z = [f"coalesce(({c} - m{i}) / nullif(s{i}, 0), 0)" for i, c in enumerate(x)] + ["(cast(trip_duration as double) - my)"]
    match = f" on {by} = g" if by else ""
    pairs = [(i, j) for i in range(_N) for j in range(i, _N + 1)]
    cov = f"{name}_c as materialized (select g, " + ", ".join(f"avg({z[i]} * {z[j]}) as c{i}_{j}" for i, j in pairs) \
        + f" from {src} join {name}_s" + (match or " on true") + " group by g)"
    cells = ", ".join(f"{{'i': {i}, 'j': {j}, 'v': c{min(i, j)}_{max(i, j)}}}" for i in range(_N) for j in range(_N + 1))
    steps = [f"{name}_0 as materialized (select g, u.i, u.j, u.v from (select g, unnest([{cells}]) as u from {name}_c))"]
    for k in range(_N):
        p = f"{name}_{k}"
        steps.append(
            f"{name}_{k + 1} as materialized (select a.g, a.i, a.j, case when p.v <= 1e-9 then a.v when a.i = {k} then a.v / p.v"
            f" else a.v - r.v * c.v / p.v end as v from {p} a join {p} r on r.g = a.g and r.i = a.i and r.j = {k}"
            f" join {p} c on c.g = a.g and c.i = {k} and c.j = a.j join {p} p on p.g = a.g and p.i = {k} and p.j = {k})")
    last = f"{name} as materialized (select s.g, any_value(my) as my, " + ", ".join(
        f"coalesce(max(v) filter (where i = {i}) / nullif(any_value(s{i}), 0), 0) as b{i}, any_value(m{i}) as m{i}, any_value(s{i}) as s{i}"
        for i in range(_N)) + f" from {name}_{_N} m join {name}_s s on s.g = m.g where j = {_N} group by s.g)"
    return [stats, cov, *steps, last]


def _linear(columns: dict[str, str] | None = None, row: str = "") -> str:
    """The linear prediction, not clipped."""
    c = columns or {}
    return "(my" + "".join(f" + b{i} * ({c.get(f, row + f)} - m{i})" for i, f in enumerate(C.FEATURES)) + ")"


_TRAIN = "ltr as (select * from split where split = 'train')"
_FULL = [SPLIT_CTE, _TRAIN, *_solved("lw", "ltr")]


def _full_fit(spark, sf):
    """Training and validation rows, and a linear model of all features fitted on the former."""
    tr, va = train_val(spark, sf)
    return tr, va, E.LeastSquares(clip=C.PRED_CLIP_MIN).fit(tr)


def _linear_score(model):
    """The clipped prediction from features by name."""
    return lambda columns: F.greatest(MD.linear_expression(model.coefficients, model.intercept, columns), F.lit(C.PRED_CLIP_MIN))


@query("linear_coefficients", O.ctes(*_FULL, "co as (" + " union all ".join(
    f"select '{f}' as feature, b{i} * s{i} as c from lw" for i, f in enumerate(C.FEATURES)) + ")") +
       f"select feature, {rnd_sql('c', 4)} as scaled_coefficient, cast(row_number() over (order by abs(c) desc, feature) as int) as rank,"
       " case when c > 0 then 'longer trip' else 'shorter trip' end as direction,"
       " not (feature = 'distance_km' and c < 0) as sign_ok from co")
def q_linear_coefficients(spark, sf):
    """J3 over the whole contract."""
    _, _, model = _full_fit(spark, sf)
    t = MD.coefficient_table(spark, C.FEATURES, [model.coefficients[f] * model.spread[f] for f in C.FEATURES])
    return t.withColumn("scaled_coefficient", rnd("scaled_coefficient", 4))


@query("linear_scored", O.ctes(*_FULL) + "select id, case when cast(id as bigint) % 71 = 2 then null else "
       + rnd_sql(f"greatest({_linear()}, 60e0)", 3) + " end as prediction from split cross join lw where split = 'val'")
def q_linear_scored(spark, sf):
    """The pipeline of scaler and least squares over all features; rows that lack one come back without a prediction."""
    tr, va = train_val(spark, sf)
    gone = F.col("id").cast("long") % 71 == 2
    model, _ = MD.fit(MD.linear_pipeline(), tr)
    va = va.withColumn("distance_km", F.when(~gone, F.col("distance_km")))
    return MD.score(model, va, clip_min=C.PRED_CLIP_MIN).select("id", rnd("prediction", 3).alias("prediction"))


@query("linear_full_metrics", O.ctes(*_FULL, f"fs as (select *, greatest({_linear()}, 60e0) as prediction from split cross join lw where split = 'val')") +
       O.five_metrics_sql("fs"))
def q_linear_full_metrics(spark, sf):
    """The linear model of all features on the validation window."""
    _, va, model = _full_fit(spark, sf)
    return M.five_metrics(model.transform(va), C.TARGET, "prediction")


@query("walk_forward_linear_full", O.ctes(
    _FOLDS_SQL, _ASSIGN_SQL, "ltr as (select * from assigned where role = 'train')", *_solved("lw", "ltr", by="fold"),
    f"fs as (select assigned.*, greatest({_linear()}, 60e0) as prediction from assigned join lw on fold = g where role = 'val')")
       + O.five_metrics_sql("fs", by="fold"))
def q_walk_forward_linear_full(spark, sf):
    """J10 for an estimator and its parameters: least squares of all features, fold by fold."""
    return E.walk_forward(processed_full(spark, sf), FOLDS, E.LeastSquares(), {"clip": C.PRED_CLIP_MIN})


# -- K1(a), K2 -----------------------------------------------------------------------------------
@query("linear_attribution", O.ctes(*_FULL) + " union all ".join(
    f"select id, '{f}' as feature, {rnd_sql(f'b{i} * ({f} - m{i})', 4)} as phi, {rnd_sql('my', 4)} as base_value"
    " from split cross join lw where split = 'val'" for i, f in enumerate(C.FEATURES)))
def q_linear_attribution(spark, sf):
    """K1(a): every feature's share in every validation prediction of the full linear model."""
    tr, va, model = _full_fit(spark, sf)
    a = AU.linear_attribution(va, model.coefficients, model.intercept, tr)
    return a.select("id", "feature", rnd("phi", 4).alias("phi"), rnd("base_value", 4).alias("base_value"))


@query("additivity_violations", O.ctes(*_FULL) +
       f"select count(*) as rows_checked, count(*) filter (where {_linear()} < 59e0 or cast(id as bigint) % 89 = 1) as violations"
       " from split cross join lw where split = 'val'")
def q_additivity(spark, sf):
    """K2 against predictions as the model writes them: clipped ones and some spoilt ones do not add up."""
    tr, va, model = _full_fit(spark, sf)
    spoilt = F.when(F.col("id").cast("long") % 89 == 1, 1000.0).otherwise(0.0)
    scored = model.transform(va).withColumn("prediction", F.col("prediction") + spoilt)
    return AU.additivity_violations(scored, model.coefficients, model.intercept, tr).select("rows_checked", "violations")


# -- M1-M7, K1(b) on the fitted model ---------------------------------------------------------------
def _probe_sql() -> str:
    fields = [*C.FEATURES, "distance_delta"]

    def v(s, f):
        x = s.get(f)
        return "null" if x is None else (f"{x!r}e0" if isinstance(x, float) else str(x))
    values = ", ".join("('" + s["scenario"] + "', " + ", ".join(v(s, f) for f in fields) + ")" for s in AU.SCENARIOS)
    scen = f"scen(scenario, {', '.join('o_' + f for f in fields)}) as (values {values})"
    given = {f: f"coalesce(o_{f}, {f})" for f in C.FEATURES}
    given["distance_km"] = f"({given['distance_km']} + coalesce(o_distance_delta, 0e0))"
    x = (f"px as (select id as base_id, scenario, greatest({_linear(given)}, 60e0) as p from split cross join scen cross join lw"
         " where split = 'val')")
    wide = "wide as (select base_id, " + ", ".join(
        f"max(p) filter (where scenario = '{n}') as \"{n}\"" for n in sorted({s["scenario"] for s in AU.SCENARIOS})) + " from px group by base_id)"
    steps = (1, 2, 5, 10, 20, 30)
    mono = " and ".join(f'"dist_{b}" > "dist_{a}"' for a, b in zip(steps, steps[1:]))
    pax = ", ".join(f'"pax_{n}"' for n in range(1, 7))
    vendors, spread = 'abs("vendor_1" - "vendor_2")', f"greatest({pax}) - least({pax})"
    turn = 'abs("forward" - "reverse") / nullif("forward", 0)'
    checks = [
        ("vendor_invariance", vendors, f"{vendors} < 60e0"),
        ("vendor_invariance_20km", 'abs("vendor_1_20km" - "vendor_2_20km")', 'abs("vendor_1_20km" - "vendor_2_20km") < 120e0'),
        ("vendor_vs_distance", vendors, f'{vendors} < abs("vendor_1_plus_1km" - "vendor_1")'),
        ("passenger_1_vs_4", 'abs("pax_1" - "pax_4")', 'abs("pax_1" - "pax_4") < 60e0'),
        ("passenger_spread", spread, f"{spread} < 60e0"),
        ("direction_asymmetry", turn, f"{turn} < 0.2e0"),
        ("distance_monotone", f"cast(({mono}) as double)", f"cast(({mono}) as double) = 1e0"),
        ("distance_beats_rush", '"rush_8" - "base"', '"rush_8" - "base" < "dist_10" - "dist_5"'),
        ("rush_beats_night", '"night_3"', '"night_3" < "rush_8"'),
        ("weekday_beats_weekend", '"weekend"', '"weekend" < "weekday_rush"'),
    ]
    rows = " union all ".join(f"select '{n}' as probe, cast({val} as double) as value, coalesce({ok}, false) as passed from wide" for n, val, ok in checks)
    return (O.ctes(*_FULL, scen, x, wide, f"lng as ({rows})") + "select probe, count(*) as bases, count(*) filter (where passed) as passed,"
            f" {rnd_sql('max(value)', 4)} as max_value, {rnd_sql('avg(value)', 4)} as mean_value from lng group by probe")


@query("probe_results", _probe_sql())
def q_probe_results(spark, sf):
    """M1-M7 on the fitted linear model of all features; probes that it fails show as fewer passes than bases."""
    _, va, model = _full_fit(spark, sf)
    return AU.probe_results(va, _linear_score(model))


def _pi_sql() -> str:
    def rmse(f):
        p = _linear({c: (f"o.{c}" if c == f else f"r.{c}") for c in C.FEATURES})
        return f"sqrt(avg((r.trip_duration - greatest({p}, 60e0)) * (r.trip_duration - greatest({p}, 60e0))))"
    return O.ctes(*_FULL, "r as (select *, row_number() over (order by (cast(id as bigint) * 2654435761 + 42) % 4294967296, id) - 1 as pos,"
                  " count(*) over () as n from split where split = 'val')",
                  "m as (select " + rmse(None) + " as b, " + ", ".join(f"{rmse(f)} as \"{f}\"" for f in C.FEATURES)
                  + " from r join r o on o.pos = (r.pos + 1) % r.n cross join lw)",
                  "l as (" + " union all ".join(f"select '{f}' as feature, b, \"{f}\" as x from m" for f in C.FEATURES) + ")") + (
        f"select feature, {rnd_sql('b', 2)} as rmse_base, {rnd_sql('x', 2)} as rmse_permuted, {rnd_sql('x - b', 2)} as importance,"
        " cast(row_number() over (order by round(x - b, 6) desc, feature) as int) as rank from l")


@query("permutation_importance", _pi_sql())
def q_permutation_importance(spark, sf):
    """K1(b) for the fitted linear model of all features."""
    _, va, model = _full_fit(spark, sf)
    return AU.permutation_importance(va, _linear_score(model), C.FEATURES)


# -- J1, A12: estimators in a pipeline, saved and loaded ----------------------------------------------
_TPROB = ("tprob as (select t.*, coalesce(w.spike_probability, 0e0) as spike_prob from tl t left join"
          " (select low, case when bin = 19 then high + 1 else high end as high, spike_probability from sb) w"
          " on t.prediction >= w.low and t.prediction < w.high)")


@query("saved_models", O.ctes(*_FULL, *_CAL_CTES[1:], _TPROB, *_iso_ctes("tprob", "spike_prob"), _iso_apply_sql("vprob", "spike_prob")) +
       f"select id, {rnd_sql('prediction', 4)} as prediction, {rnd_sql('spike_prob', 6)} as spike_prob,"
       f" {rnd_sql('calibrated_prob', 6)} as calibrated_prob, {rnd_sql(f'greatest({_linear()}, 60e0)', 3)} as linear_prediction"
       " from cal cross join lw")
def q_saved_models(spark, sf):
    """Lookup, spike bins, calibrator and least squares as one pipeline, saved, loaded and then scored."""
    tr, va = train_val(spark, sf)
    labelled = CA.with_spike_label(tr, spike_thr(tr))
    stages = [E.LookupBaseline(), E.SpikeBins(), E.Calibrator(), E.LeastSquares(clip=C.PRED_CLIP_MIN, predictionCol="linear_prediction")]
    path = scratch_path(spark, "pipeline")
    Pipeline(stages=stages).fit(labelled).write().overwrite().save(path)
    scored = PipelineModel.load(path).transform(va)
    return scored.select("id", *[rnd(c, d).alias(c) for c, d in (("prediction", 4), ("spike_prob", 6), ("calibrated_prob", 6),
                                                                 ("linear_prediction", 3))])


# -- J4, J5, J7: boosted trees --------------------------------------------------------------------------
def _tree_sql(depth: int, p: B.Params, weight: str = "1e0") -> list[str]:
    """CTEs that grow one tree on ``split``'s training rows: ``tree`` (node, feature, cut, gain, cover, value)."""
    entries = ", ".join(f"{{'j': {j}, 'feature': '{f}', 'x': cast({f} as double)}}" for j, f in enumerate(C.FEATURES))
    at = ", ".join(repr((i + 1) / p.bins) + "e0" for i in range(p.bins - 1))
    out = [f"tr as materialized (select id, {weight} as w, cast(trip_duration as double) as y, unnest([{entries}], recursive := true)"
           " from split cross join thr where split = 'train')",
           "base as materialized (select sum(w * y) / sum(w) as b from tr where j = 0)",
           "lng as materialized (select id, w, y - b as r, j, feature, x from tr cross join base)",
           f"edges as materialized (select distinct j, unnest(quantile_disc(x, [{at}])) as cut from lng group by j)",
           "n0 as materialized (select id, 0 as node from lng where j = 0)"]
    for d in range(depth):
        out += [
            f"s{d} as materialized (select node, feature, l.j, cut, sum(w * r) filter (where x <= cut) as gl, sum(w) filter (where x <= cut) as hl,"
            f" sum(w * r) as g, sum(w) as h from lng l join n{d} using (id) join edges e on e.j = l.j group by all)",
            f"k{d} as (select *, gl * gl / (hl + {p.l2}) + (g - gl) * (g - gl) / (h - hl + {p.l2}) - g * g / (h + {p.l2}) as gain from s{d}"
            f" where hl >= {p.min_weight} and h - hl >= {p.min_weight})",
            f"b{d} as materialized (select * from (select *, row_number() over (partition by node order by round(gain, 2) desc, j, cut) as place"
            " from k{0} where gain > 1e-6) where place = 1)".format(d),
            f"n{d + 1} as materialized (select n.id, 2 * n.node + case when x <= cut then 1 else 2 end as node from n{d} n join b{d} b using (node)"
            " join lng l on l.id = n.id and l.j = b.j)"]
    every = " union all ".join(f"select * from n{d}" for d in range(depth + 1))
    splits = " union all ".join(f"select node, feature, cut, gain from b{d}" for d in range(depth))
    return [*out, f"ev as ({every})", f"sp as ({splits})",
            f"tree as (select node, any_value(sp.feature) as feature, any_value(cut) as cut, any_value(gain) as gain, sum(w) as cover,"
            f" {p.rate} * sum(w * r) / (sum(w) + {p.l2}) as value from ev join lng l on l.id = ev.id and l.j = 0 left join sp using (node) group by node)"]


_STUMP = B.Params(trees=1, depth=1, rate=1.0, row_share=1.0, column_share=1.0, patience=None, bins=16)
_SMALL = B.Params(trees=1, depth=3, rate=0.5, row_share=1.0, column_share=1.0, patience=None, bins=16)


@query("boosted_stump", O.ctes(SPLIT_CTE, THR_CTE, *_tree_sql(1, _STUMP, "case when trip_duration > spike_threshold then 5e0 else 1e0 end")) +
       f"select node, feature, {rnd_sql('cut', 4)} as cut, {rnd_sql('gain', 1)} as gain, cover, {rnd_sql('value', 4)} as value from tree")
def q_boosted_stump(spark, sf):
    """One split of weighted rows."""
    tr, _ = train_val(spark, sf)
    model = B.fit_boosted(M.sample_weights(tr, spike_thr(tr)), weight="weight", params=_STUMP)
    return model.node_table(spark).select("node", "feature", rnd("cut", 4).alias("cut"), rnd("gain", 1).alias("gain"), "cover",
                                          rnd("value", 4).alias("value"))


@query("boosted_tree", O.ctes(SPLIT_CTE, THR_CTE, *_tree_sql(3, _SMALL)) +
       f"select node, feature, {rnd_sql('cut', 4)} as cut, {rnd_sql('gain', 1)} as gain, cover, {rnd_sql('value', 4)} as value from tree")
def q_boosted_tree(spark, sf):
    """One tree of three levels."""
    tr, _ = train_val(spark, sf)
    return B.fit_boosted(tr, params=_SMALL).node_table(spark).select(
        "node", "feature", rnd("cut", 4).alias("cut"), rnd("gain", 1).alias("gain"), "cover", rnd("value", 4).alias("value"))


#: The boosted model of a session and input, fitted once for the queries that report on it.
_MODELS: dict[tuple[str, str], B.BoostedModel] = {}


def _boosted(spark, sf) -> B.BoostedModel:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        tr, va = train_val(spark, sf)
        _MODELS[key] = B.fit_boosted(tr, validation=va)
    return _MODELS[key]


@query("boosted_importance")
def q_boosted_importance(spark, sf):
    """Up to 300 trees on all training rows, stopped by the validation rows; a row per feature."""
    return _boosted(spark, sf).importance(spark)


@query("boosted_metrics")
def q_boosted_metrics(spark, sf):
    """The boosted model on the validation window, and its number of trees."""
    _, va = train_val(spark, sf)
    model = _boosted(spark, sf)
    scored = va.withColumn("prediction", model.score())
    return M.five_metrics(scored, C.TARGET, "prediction").withColumns(
        {"trees": F.lit(len(model.trees)), "rounds": F.lit(len(model.history) - 1)})


@query("walk_forward_boosted")
def q_walk_forward_boosted(spark, sf):
    """J10 for boosted trees: a fit per fold, two at a time.  Folds have no rows to stop by, so the number of trees is given."""
    return E.walk_forward(processed_full(spark, sf), FOLDS, E.BoostedTrees(), {"settings": {"trees": 100, "patience": None}})


@query("boosted_additivity", O.ctes(SPLIT_CTE) + "select count(*) as rows_checked, cast(0 as bigint) as violations, 0e0 as max_abs_diff"
       " from split where split = 'val'")
def q_boosted_additivity(spark, sf):
    """K1(c), K2: base value and exact tree attributions add up to the prediction on every validation row."""
    _, va = train_val(spark, sf)
    model = _boosted(spark, sf)
    return B.additivity(va.withColumn("prediction", model.score()), model)


@query("attribution_power_boosted")
def q_attribution_power_boosted(spark, sf):
    """K1(c), E16: the power of each feature in the boosted model's attributions of the validation rows."""
    _, va = train_val(spark, sf)
    return AU.attribution_power(B.tree_attribution(va, _boosted(spark, sf)))

"""The registered queries in plain SQL, for a reference database to check results against."""

from __future__ import annotations

from ..schemas import FAMILIES, Family
from ..sources.shapes import ROUTES, STATUS, reading_sql
from .explore_queries import THRESHOLDS
from .sensor_queries import CRM_DAY, DAY, SCORERS, UPSERT_SOURCE, UPSERT_TARGET, engineered_weights

K = "cast(json_extract_string(props, '$.k') as int)"
ISO = "'%Y-%m-%dT%H:%M:%S.%f'"


def _zero_free(a: str, b: str) -> str:
    return f"({a}) / nullif({b}, 0)"


def _floored(a: str, b: str, floor: str) -> str:
    return f"case when {b} is not null then ({a}) / greatest({b}, {floor}::double) end"


SERVING = {
    "arm_robot": {
        "pressure_temp_ratio": _zero_free("hydraulic_pressure_psi", "temperature_celsius"),
        "wear_per_hour": _floored("joint_wear_percent", "operation_time_hours", "0.1"),
        "rpm_vibration_ratio": _floored("servo_motor_rpm", "vibration_mm_per_s", "0.1"),
    },
    "cnc_machine": {
        "speed_temp_ratio": _floored("spindle_speed_rpm", "motor_temperature_celsius", "0.1"),
        "wear_per_hour": _floored("tool_wear_percent", "operation_time_hours", "0.1"),
        "coolant_efficiency": _floored("coolant_flow_rate_l_min", "coolant_temperature_celsius", "0.1"),
        "vibration_per_speed": _floored("vibration_mm_per_s * 1000", "spindle_speed_rpm", "0.1"),
    },
    "injection_molding": {
        "temp_ratio": _floored("barrel_temperature_celsius", "mold_temperature_celsius", "0.1"),
        "pressure_ratio": _floored("injection_pressure_bar", "holding_pressure_bar", "0.1"),
        "wear_per_hour": _floored("mold_wear_percent", "operation_time_hours", "0.1"),
        "parts_per_hour": _floored("parts_produced", "operation_time_hours", "0.1"),
        "cycle_efficiency": _floored("3600::double", "cycle_time_s", "0.1"),
    },
    "battery_assembly": {
        "current_voltage_ratio": _floored("welding_current_amps", "welding_voltage_volts", "0.1"),
        "electrode_wear_per_hour": _floored("electrode_wear_percent", "operation_time_hours", "0.1"),
        "temp_diff": "electrode_temperature_celsius - cooling_system_temperature_celsius",
        "electrical_stability": _floored(
            "cell_voltage_uniformity_ratio * insulation_resistance_mohm", "leakage_current_ma", "0.001"
        ),
    },
}
TRAINING = {
    **SERVING,
    "cnc_machine": {
        **SERVING["cnc_machine"],
        "speed_temp_ratio": _zero_free("spindle_speed_rpm", "motor_temperature_celsius"),
    },
    "injection_molding": {
        **SERVING["injection_molding"],
        "temp_ratio": _zero_free("barrel_temperature_celsius", "mold_temperature_celsius"),
        "pressure_ratio": _zero_free("injection_pressure_bar", "holding_pressure_bar"),
    },
}


def _sensors(family: Family, where: str = "true") -> str:
    """CTEs ``k`` and ``s``: events with ``k``, then flat sensor rows."""
    readings = ", ".join(f"{sql} as {name}" for name, sql in reading_sql(family).items())
    return (
        f"k as (select *, {K} as k from events), "
        f"s as (select event_id, event_type, ts, strftime(ts, {ISO}) as timestamp, 'M-' || user_id as machine_id, "
        f"'{family.machine_type}' as machine_type, {readings} from k where {where})"
    )


def _history(family: Family) -> str:
    return (
        _sensors(family)
        + f", h as (select *, {STATUS} as status, (event_id * 7 % 100)::double as time_since_maintenance, "
        "case when event_type = 'error' then 1 else 0 end as failure from s)"
    )


def _calendar() -> str:
    return "cast(hour(ts) as int) as hour_of_day, cast(isodow(ts) - 1 as int) as day_of_week"


def _list(names) -> str:
    return ", ".join(names)


def _formulas(formulas: dict[str, str]) -> str:
    return ", ".join(f"{sql} as {name}" for name, sql in formulas.items())


def _score(family: Family) -> str:
    weights, intercept = SCORERS[family.name]
    z = f"{intercept}::double" + "".join(f" + {name} * {w}::double" for name, w in weights.items())
    return f"1.0::double / (1.0::double + exp(-({z})))"


RISK = "case when p < 0.3 then 'LOW' when p < 0.7 then 'MEDIUM' when p is not null then 'HIGH' end"


def _feature_align(f: Family) -> str:
    return (
        f"with {_sensors(f)} select event_id, {_list(f.model_inputs)}, 0 as time_since_maintenance, {_calendar()}, "
        f"{_formulas(SERVING[f.name])}, {_list(f'{c} as {c}_prev' for c in f.lagged)}, "
        f"{_list(f'0 as {c}_change' for c in f.lagged)} from s"
    )


def _train_features(f: Family) -> str:
    lags = _list(f"lag({c}) over w as {c}_prev" for c in f.lagged)
    known = " and ".join(
        [f"{c} is not null" for c in (*f.readings, *TRAINING[f.name])] + [f"{c}_prev is not null" for c in f.lagged]
    )
    return (
        f"with {_history(f)}, d as (select *, {_calendar()}, {_formulas(TRAINING[f.name])}, {lags} from h "
        f"window w as (partition by machine_id order by timestamp, event_id)) "
        f"select event_id, machine_id, {_list(f.model_inputs)}, time_since_maintenance, hour_of_day, day_of_week, "
        f"{_list(TRAINING[f.name])}, {_list(f'{c}_prev' for c in f.lagged)}, "
        f"{_list(f'{c} - {c}_prev as {c}_change' for c in f.lagged)}, failure from d where {known}"
    )


def _complete(f: Family) -> str:
    """CTEs ending in ``h``: history with features and look back, rows with anything missing left out."""
    lags = _list(f"lag({c}) over w as {c}_prev" for c in f.lagged)
    known = " and ".join(
        [f"{c} is not null" for c in (*f.readings, *TRAINING[f.name])] + [f"{c}_prev is not null" for c in f.lagged]
    )
    return (
        f"{_history(f).replace(', h as (', ', raw as (')}, d as (select *, {_calendar()}, {_formulas(TRAINING[f.name])}, {lags} "
        f"from raw window w as (partition by machine_id order by timestamp, event_id)), "
        f"h as (select *, {_list(f'{c} - {c}_prev as {c}_change' for c in f.lagged)} from d where {known})"
    )


def _serving_prev(f: Family) -> str:
    zeroed = _list(f"coalesce({c}, 0) as {c}" for c in f.model_inputs)
    prev = _list(f"coalesce(lag({c}) over w, {c}) as {c}_prev" for c in f.lagged)
    return (
        f"with {_sensors(f)}, z as (select event_id, ts, timestamp, machine_id, {zeroed} from s), "
        f"d as (select *, {prev} from z window w as (partition by machine_id order by timestamp, event_id)) "
        f"select event_id, machine_id, {_list(f.model_inputs)}, 0 as time_since_maintenance, {_calendar()}, "
        f"{_formulas(SERVING[f.name])}, {_list(f'{c}_prev' for c in f.lagged)}, "
        f"{_list(f'{c} - {c}_prev as {c}_change' for c in f.lagged)} from d"
    )


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _upsert(f: Family) -> str:
    columns = [*f.lake_schema.fieldNames()]
    changed = _list(f"{c} + 1 as {c}" for c in f.readings)
    merged = _list(
        f"case when n.timestamp is not null then n.{c} else t.{c} end as {c}" for c in f.readings
    )
    return (
        f"with {_sensors(f)}, t as (select {_list(columns)} from s where event_type in {_in(UPSERT_TARGET)}), "
        f"n as (select timestamp, machine_id, machine_type || '_STAGED' as machine_type, {changed} from s "
        f"where event_type in {_in(UPSERT_SOURCE)}) "
        f"select coalesce(t.timestamp, n.timestamp) as timestamp, coalesce(t.machine_id, n.machine_id) as machine_id, "
        f"coalesce(t.machine_type, n.machine_type) as machine_type, {merged} "
        f"from t full join n on t.timestamp = n.timestamp and t.machine_id = n.machine_id"
    )


def _predictions() -> str:
    """All routed events with their risk, as one SELECT."""
    parts = []
    for f in FAMILIES.values():
        parts.append(
            f"select event_id, timestamp as prediction_timestamp, machine_id, machine_type, {_score(f)} as p from "
            f"(with {_sensors(f, f'event_type in {_in(ROUTES[f.name])}')} select * from s)"
        )
    return (
        "select event_id, prediction_timestamp, machine_id, machine_type, round_even(p, 3) as failure_probability, "
        f"{RISK} as risk_level from ({' union all '.join(parts)}) where p is not null"
    )


def _streamed() -> str:
    """The same with the score on engineered features; a single reading is its own predecessor."""
    parts = []
    for f in FAMILIES.values():
        z = f"{SCORERS[f.name][1]}::double" + "".join(f" + {n} * {w}::double" for n, w in engineered_weights(f).items())
        first = f.lagged[0]
        parts.append(
            f"select event_id, timestamp as prediction_timestamp, machine_id, machine_type, 1.0::double / (1.0::double + exp(-({z}))) as p from "
            f"(with {_sensors(f, f'event_type in {_in(ROUTES[f.name])}')} select *, {_calendar()}, {_formulas(SERVING[f.name])}, "
            f"{first} as {first}_prev, 0 as {first}_change from s)"
        )
    return (
        "select event_id, prediction_timestamp, machine_id, machine_type, round_even(p, 3) as failure_probability, "
        f"{RISK} as risk_level from ({' union all '.join(parts)}) where p is not null"
    )


_VISITS = (
    "v as (select strftime(o_orderdate, '%Y-%m-%d') as doc_id, l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    "concat_ws('-', 'SRV', l_orderkey, l_linenumber, l_partkey, l_suppkey) as service_record_id, "
    "'DLR-' || c_nationkey as dealer_id, n_name as dealer_name, 'REGION-' || n_regionkey as dealer_location, "
    "'VIN-' || o_custkey as vin, c_mktsegment as model, cast(o_custkey % 30 + 1995 as int) as year, "
    "cast(floor(o_totalprice) as int) as odometer_reading, o_orderdate, o_orderpriority, c_acctbal as total_cost, "
    "'CUST-' || c_custkey as customer_id, c_name as customer_name, c_nationkey, c_mktsegment, "
    "l_tax, l_discount, l_returnflag, l_linestatus, l_quantity, l_extendedprice, l_shipdate "
    "from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey "
    "join nation on c_nationkey = n_nationkey)"
)
_GOOD = (
    _VISITS + ", g as (select * from v where doc_id not in (select doc_id from v where total_cost < 0))"
)
_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_PARTS = (
    "select doc_id, 'P-' || l_partkey as part_code, 'PART-' || l_partkey as part_name, cast(l_quantity as int) as quantity, "
    "l_extendedprice as unit_cost, service_record_id from g union all "
    "select doc_id, null, 'SEAL-' || l_suppkey, l_linenumber, l_discount, service_record_id from g where l_returnflag = 'R'"
)
# Records with faults: the first broken rule per record without the vehicle, and per vehicle.
_FAULTS = (
    _VISITS
    + ", f as (select *, case when c_nationkey = 7 then 1 end as no_dealer, "
    "case when o_orderpriority = '1-URGENT' then 1 end as no_odometer, "
    "case when c_mktsegment = 'MACHINERY' then 1 end as bad_cost, "
    "case when c_mktsegment <> 'MACHINERY' and total_cost < 0 then 1 end as low_cost, "
    "case when cast(l_quantity as int) - 1 < 1 then 1 end as low_quantity from v)"
)


def _first_per(key: str, columns: str) -> str:
    return (
        f"with {_GOOD}, n as (select *, row_number() over (partition by doc_id, {key} order by {_ORDER}) as rn from g) "
        f"select doc_id, {key}, {columns} from n where rn = 1"
    )


def _corr(pairs: list[tuple[str, str]], cte: str) -> str:
    parts = [
        f"select '{a}' as \"left\", '{b}' as \"right\", round(corr({a}, {b}), 6) as correlation from h" for a, b in pairs
    ]
    return f"with {cte} " + " union all ".join(parts)


def _corr_matrix(f: Family) -> str:
    names = [*f.key_features, "failure"]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    return _corr(pairs, _complete(f))


def _melted(f: Family) -> str:
    return " union all ".join(
        f"select '{c}' as feature, failure, {c}::double as x from h where {c} is not null" for c in f.key_features
    )


_BIN = "case when hi = lo then 0 else cast(least(floor((x - lo) / ((hi - lo) / 30)), 29) as int) end"


def _histogram(f: Family) -> str:
    return (
        f"with {_complete(f)}, m as ({_melted(f)}), b as (select feature, min(x) as lo, max(x) as hi from m group by 1) "
        f"select feature, {_BIN} as bin, failure, count(*) as rows from m join b using (feature) group by 1, 2, 3"
    )


def _density(f: Family) -> str:
    return (
        f"with {_complete(f)}, m as ({_melted(f)}), b as (select feature, min(x) as lo, max(x) as hi from m group by 1), "
        "c as (select feature, failure, count(*) as n, stddev_samp(x) * pow(count(*), -0.2::double) as h from m group by 1, 2), "
        "g as (select unnest(range(30)) as point), "
        "p as (select c.*, point, lo + (hi - lo) * point / 29 as gx from c join b using (feature), g where h > 0) "
        "select feature, failure, cast(point as int) as point, round(gx, 6) as x, "
        "round(sum(exp(-0.5::double * ((m.x - gx) / h) * ((m.x - gx) / h))) / (n * h * sqrt(2.0::double * pi())), 6) as density "
        "from p join m using (feature, failure) group by feature, failure, point, gx, n, h"
    )


def _density_2d() -> str:
    f = FAMILIES["injection_molding"]

    parts = []
    for a, b in f.scatter_pairs:
        x = _BIN.replace("(x - lo)", f"({a}::double - xl)").replace("hi = lo", "xh = xl").replace("(hi - lo)", "(xh - xl)")
        y = _BIN.replace("(x - lo)", f"({b}::double - yl)").replace("hi = lo", "yh = yl").replace("(hi - lo)", "(yh - yl)")
        parts.append(
            f"select '{a}' as x_name, '{b}' as y_name, {x} as x_bin, {y} as y_bin, failure, count(*) as rows from h, "
            f"(select min({a})::double as xl, max({a})::double as xh, min({b})::double as yl, max({b})::double as yh from h) "
            f"where {a} is not null and {b} is not null group by 1, 2, 3, 4, 5"
        )
    return f"with {_complete(f)} " + " union all ".join(parts)


def _standardize(f: Family) -> str:
    scaled = _list(
        f"round(({c} - (select avg({c}) from h)) / (select case when stddev_pop({c}) = 0 then 1 else stddev_pop({c}) end from h), 6) as {c}"
        for c in f.key_features
    )
    return f"with {_history(f)} select event_id, {scaled} from h"


def _judged() -> str:
    arm = FAMILIES["arm_robot"]
    return f"{_history(arm)}, j as (select event_id, failure, {_score(arm)} as p from h)"


def _compared() -> str:
    parts = [
        f"select '{name}' as model, {place} as place, failure as y, case when p > {limit} then 1 else 0 end as yhat "
        "from j where p is not null"
        for place, (name, limit) in enumerate(THRESHOLDS.items())
    ]
    return (
        f"{_judged()}, u as ({' union all '.join(parts)}), {_METRICS_CTE.format(keys='model, place')}"
    )


_METRICS_CTE = (
    "q as (select {keys}, sum(case when y = 1 and yhat = 1 then 1 else 0 end)::double as tp, "
    "sum(case when y = 0 and yhat = 1 then 1 else 0 end)::double as fp, "
    "sum(case when y = 1 and yhat = 0 then 1 else 0 end)::double as fn, "
    "sum(case when y = yhat then 1 else 0 end)::double as hits, count(*) as n from u group by {keys}), "
    "r as (select {keys}, hits / n as accuracy, coalesce(tp / nullif(tp + fp, 0), 0) as precision, "
    "coalesce(tp / nullif(tp + fn, 0), 0) as recall from q), "
    "e as (select {keys}, round(accuracy, 6) as accuracy, round(precision, 6) as precision, round(recall, 6) as recall, "
    "round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 6) as f1_score from r)"
)


def _class_report() -> str:
    return (
        f"with {_judged()}, u as (select failure as y, case when p > 0.5 then 1 else 0 end as yhat from j where p is not null), "
        "c as (select distinct y as cls from u union select distinct yhat from u), "
        "a as (select cls, sum(case when y = cls then 1 else 0 end) as support, sum(case when yhat = cls then 1 else 0 end) as said, "
        "sum(case when y = cls and yhat = cls then 1 else 0 end) as hit from c, u group by cls), "
        "b as (select cls, support, hit, coalesce(hit::double / nullif(said, 0), 0) as precision, "
        "coalesce(hit::double / nullif(support, 0), 0) as recall from a), "
        "d as (select *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) as f1_score from b), "
        "x as (select cls::varchar as row, precision, recall, f1_score, support from d union all "
        "select 'accuracy', sum(hit)::double / sum(support), sum(hit)::double / sum(support), "
        "sum(hit)::double / sum(support), sum(support) from d union all "
        "select 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) from d union all "
        "select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), "
        "sum(f1_score * support) / sum(support), sum(support) from d) "
        "select row, round(precision, 6) as precision, round(recall, 6) as recall, round(f1_score, 6) as f1_score, "
        "cast(support as bigint) as support from x"
    )


def _top_features(f: Family) -> str:
    parts = [f"select '{c}' as feature, round(abs(corr({c}, failure)), 6) as importance from h" for c in f.feature_order]
    return (
        f"with {_complete(f)} select * from "
        f"({' union all '.join(parts)}) order by importance desc nulls last, feature limit {f.top_features}"
    )


_SPLIT = (
    "e as (select event_id, case when event_type = 'error' then 1 else 0 end as failure, "
    "substr(md5(concat_ws('|', event_id, 42)), 1, 15) as h from events), "
    "r as (select *, row_number() over (partition by failure order by h) as rn, "
    "floor(count(*) over (partition by failure) * 0.75 + 0.5) as q from e)"
)
_FOLD = "case when rn > q then 5 else " + " + ".join(f"cast(rn > floor(q * {k} / 5) as int)" for k in range(1, 5)) + " end"


def _first_trees(f: Family, weights: tuple[int, ...], bins: int = 16) -> tuple[str, str]:
    """CTEs of the first two levels of splits by gradient and hessian sums, from a margin of zero, on bins of equal width;
    and the bins of a row as SQL.
    """
    above = ", ".join(
        f"list_sum(list_transform(range(1, {bins}), lambda k: cast({c}::double >= e.lo_{c} + (e.hi_{c} - e.lo_{c}) * k / {bins} as int)))"
        for c in f.readings
    )
    ends = ", ".join(f"min({c}::double) as lo_{c}, max({c}::double) as hi_{c}" for c in f.readings)
    parts = [
        f"with {_complete(f)}, e as (select {ends} from h), w as (select unnest([{_list(map(str, weights))}]) as w)",
        f"n0 as (select w, 0 as node, [{above}] as b, case when failure = 1 then -0.5::double * w else 0.5::double end as g, "
        "case when failure = 1 then 0.25::double * w else 0.25::double end as h from h, e, w)",
    ]
    for d in range(3):
        parts += [
            f"c{d} as (select w, node, f, bin, sum(g) as g, sum(h) as h from (select w, node, g, h, unnest(range(1, {len(f.readings) + 1})) as f, "
            f"unnest(b) as bin from n{d}) group by all)",
            f"u{d} as (select *, sum(g) over o as gl, sum(h) over o as hl, sum(g) over t as gt, sum(h) over t as ht from c{d} "
            "window o as (partition by w, node, f order by bin), t as (partition by w, node, f))",
            f"a{d} as (select *, gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1) as gain from u{d} "
            "where hl >= 1 and ht - hl >= 1)",
            f"s{d} as (select * from a{d} where gain > 1e-6 and {d} < 2 qualify row_number() over (partition by w, node order by gain desc, f, bin) = 1)",
            f"t{d} as (select w, node, any_value(gt) as g, any_value(ht) as h from u{d} where f = 1 group by all)",
            f"n{d + 1} as (select n.w, 2 * n.node + 1 + cast(n.b[s.f] > s.bin as int) as node, b, n.g, n.h from n{d} n join s{d} s using (w, node))",
        ]
    return ", ".join(parts), f"[{above}]"


def _tree_nodes(f: Family, weights: tuple[int, ...], rate: float) -> str:
    names = "[" + ", ".join(f"'{c}'" for c in f.readings) + "]"
    return _first_trees(f, weights)[0] + " " + " union all ".join(
        f"select t.w as positive_weight, t.node, {names}[s.f] as feature, cast(s.bin as int) as bin, round(-t.g / (t.h + 1) * {rate}, 9) as weight "
        f"from t{d} t left join s{d} s using (w, node)"
        for d in range(3)
    )


def _trained_stream(f: Family) -> str:
    """Events through the tree of their half: even ids by the first weight, odd ids by the second."""
    trees, bins = _first_trees(f, (1, 5))
    routed = f"select * from (with {_sensors(f, f'event_type in {_in(ROUTES[f.name])}')} select * from s)"
    step = lambda d: (
        f"p{d + 1} as (select p.*, case when s.f is null then p.node else 2 * p.node + 1 + cast(p.b[s.f] > s.bin as int) end as next from p{d} p left join s{d} s using (w, node))"
    )
    walk = (
        f"z as (select *, case when event_id % 2 = 0 then 1 else 5 end as w, 0 as node, {bins} as b from ({routed}), e), p0 as (select * from z), "
        f"{step(0)}, q1 as (select * exclude (node, next), next as node from p1), {step(1).replace('from p1 p', 'from q1 p')}, "
        "q2 as (select * exclude (node, next), next as node from p2), "
        "leaf as (select w, node, -g / (h + 1) as weight from t0 union all select w, node, -g / (h + 1) from t1 union all select w, node, -g / (h + 1) from t2), "
        "r as (select *, 1.0::double / (1.0::double + exp(-weight)) as p from q2 join leaf using (w, node))"
    )
    return (
        f"{trees}, {walk} select event_id, timestamp as prediction_timestamp, machine_id, machine_type, round_even(p, 3) as failure_probability, "
        f"{RISK} as risk_level from r where {' and '.join(f'{c} is not null' for c in f.readings)}"
    )


def check_sql() -> dict[str, str]:
    arm = FAMILIES["arm_robot"]
    out: dict[str, str] = {}
    for name, f in FAMILIES.items():
        out[f"q_sensor_flatten_{name}"] = (
            f"with {_sensors(f)} select event_id, timestamp, machine_id, machine_type, {_list(f.readings)} from s"
        )
        out[f"q_ratio_features_{name}"] = f"with {_sensors(f)} select event_id, {_formulas(SERVING[name])} from s"
        out[f"q_feature_align_{name}"] = _feature_align(f)
        out[f"q_train_features_{name}"] = _train_features(f)
        out[f"q_serving_prev_{name}"] = _serving_prev(f)
        out[f"q_risk_class_{name}"] = (
            f"with {_sensors(f)}, x as (select *, {_score(f)} as p from s) select event_id, "
            f"timestamp as prediction_timestamp, machine_id, machine_type, round_even(p, 3) as failure_probability, "
            f"{RISK} as risk_level from x"
        )
        out[f"q_upsert_{name}"] = _upsert(f)
        out[f"q_corr_matrix_{name}"] = _corr_matrix(f)
        out[f"q_histogram_{name}"] = _histogram(f)
        out[f"q_kde_{name}"] = _density(f)
        out[f"q_standardize_{name}"] = _standardize(f)
        out[f"q_top_features_{name}"] = _top_features(f)
    out["q_daily_slice"] = (
        f"select event_id, strftime(ts, {ISO}) as timestamp, strftime(ts, '%Y%m%d') as folder, "
        f"strftime(ts::date - 1, '%Y-%m-%d') as day_before from events "
        f"where ts >= timestamp '{DAY}' and ts < timestamp '{DAY}' + interval 1 day"
    )
    out["q_crm_today"] = (
        "select strftime(o_orderdate, '%d-%m-%Y') as \"Tanggal\", 'CUST-' || o_custkey as customer, "
        "o_orderpriority as model, o_orderkey as quantity from orders "
        f"where strftime(o_orderdate, '%d-%m-%Y') = strftime(date '{CRM_DAY}', '%d-%m-%Y')"
    )
    out["q_serving_features"] = f"select event_id, 0 as time_since_maintenance, {_calendar()} from events"
    out["q_union_predictions"] = _predictions()
    out["q_risk_daily"] = (
        "select substr(prediction_timestamp, 1, 10) as date, machine_type, machine_id, risk_level, count(*) as risk_count "
        f"from ({_predictions()}) group by 1, 2, 3, 4"
    )
    cdc = (
        f"with c as (select *, {K} as k, event_type = 'click' and {K} < 5 as broken, "
        f"event_type = 'view' and {K} < 10 as empty from events) "
    )
    out["q_cdc_classify"] = cdc + (
        "select event_id, cast(user_id as int) as id, strftime(ts, '%Y-%m-%d %H:%M:%S') as created_at, event_type as name, "
        "k as stock, case when event_type = 'signup' then 1 else 0 end as is_created, "
        "case when event_type in ('signup', 'error') then 0 else 1 end as is_updated, "
        "case when event_type = 'error' then 1 else 0 end as is_deleted from c where not broken and not empty"
    )
    out["q_cdc_rejects"] = cdc + (
        "select event_id, case when broken then 'malformed' else 'no_image' end as reason from c where broken or empty"
    )
    out["q_upsert_dups"] = (
        "select l_orderkey, l_linenumber, count(*) as copies from lineitem group by 1, 2 having count(*) > 1"
    )
    out["q_upsert_latest"] = (
        "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity from (select *, row_number() over "
        "(partition by l_orderkey, l_linenumber order by l_shipdate desc, l_partkey desc, l_suppkey desc) as rn "
        "from lineitem) where rn = 1"
    )

    out["q_star_fact"] = (
        f"with {_GOOD} select doc_id, service_record_id, dealer_id, vin, customer_id, total_cost, "
        "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as service_datetime_utc, "
        "strftime(o_orderdate + interval 7 hour, '%Y-%m-%d %H:%M:%S') as service_datetime_wib from g"
    )
    out["q_star_dealer"] = _first_per("dealer_id", "dealer_name, dealer_location")
    out["q_star_vehicle"] = _first_per("vin", "model, year, odometer_reading")
    out["q_star_customer"] = _first_per("customer_id", "customer_name")
    out["q_star_services"] = (
        f"with {_GOOD} select doc_id, l_returnflag as service_code, 'SVC-' || l_linestatus as service_name, "
        "l_tax as service_cost, null::varchar as technician_notes, service_record_id, o_orderpriority as service_advisor_name "
        "from g where l_tax > 0 union all select doc_id, null, 'SVC-CHECK', l_discount, o_orderpriority, service_record_id, "
        "o_orderpriority from g where l_discount > 0"
    )
    out["q_star_parts"] = f"with {_GOOD} {_PARTS}"
    out["q_parts_total"] = (
        f"with {_GOOD}, p as ({_PARTS}) select doc_id, cast(sum(quantity) as bigint) as quantity, count(*) as parts "
        "from p group by doc_id"
    )
    out["q_star_join"] = (
        f"with {_GOOD} select dealer_name, count(*) as records, count(distinct customer_name) as customers, "
        "round(sum(total_cost), 2) as total_cost from g group by dealer_name"
    )
    out["q_tz"] = (
        "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as utc, "
        "strftime(o_orderdate + interval 7 hour, '%Y-%m-%d %H:%M:%S') as local from orders"
    )
    counted = [
        ("dim_dealer.dealer_id: not_null", "no_dealer"),
        ("dim_vehicle.odometer_reading: not_null", "no_odometer"),
        ("fact_service_records.total_cost: double", "bad_cost"),
        ("fact_service_records.total_cost: at_least_0", "low_cost"),
        ("dim_parts_used.quantity: at_least_1", "low_quantity"),
    ]
    out["q_dq_violations"] = f"with {_FAULTS} select * from (" + " union all ".join(
        f"select '{rule}' as rule, count({column}) as records from f" for rule, column in counted
    ) + ") where records > 0"
    out["q_accept_reject"] = (
        f"with {_VISITS} select doc_id, count(*) as records, case when min(total_cost) < 0 then "
        "'fact_service_records.total_cost: at_least_0' end as rule from v group by doc_id"
    )
    out["q_first_rule"] = (
        f"with {_FAULTS}, w as (select *, row_number() over (partition by doc_id, vin order by {_ORDER}) as rn from f) "
        "select doc_id, count(*) as records, case when max(no_dealer) = 1 then 'dim_dealer.dealer_id: not_null' "
        "when max(case when rn = 1 then no_odometer end) = 1 then 'dim_vehicle.odometer_reading: not_null' "
        "when max(low_cost) = 1 then 'fact_service_records.total_cost: at_least_0' "
        "when max(bad_cost) = 1 then 'fact_service_records.total_cost: double' "
        "when max(low_quantity) = 1 then 'dim_parts_used.quantity: at_least_1' end as rule from w group by doc_id"
    )
    out["q_posted_verdict"] = (
        f"with {_FAULTS} select doc_id, count(*) as records, cast(coalesce(max(no_dealer), max(no_odometer), max(bad_cost)) "
        "is null as int) as accepted from f group by doc_id"
    )
    out["q_kv_items"] = (
        f"with {_VISITS} select service_record_id, total_cost::varchar::decimal(38,10) as total_cost, "
        "cast((l_tax > 0)::int + (l_discount > 0)::int as int) as services, "
        "cast(1 + (l_returnflag = 'R')::int as int) as parts, l_extendedprice::varchar::decimal(38,10) as first_unit_cost from (select *, row_number() over "
        "(partition by service_record_id order by l_shipdate desc, l_extendedprice desc, l_quantity desc, l_discount desc, "
        "l_tax desc) as rn from v) where rn = 1"
    )
    out["q_exact_numbers"] = (
        "with p as (select *, l_extendedprice::double as price from lineitem) select l_orderkey, l_linenumber, l_partkey, l_suppkey, "
        "price as plain, price / 7 as seventh, price / 7 * 1e-20::double as tiny, price / 7 * 1e30::double as huge from p"
    )
    per_table = {
        "fact_service_records": "select doc_id from g",
        "dim_dealer": "select distinct doc_id, dealer_id from g",
        "dim_vehicle": "select distinct doc_id, vin from g",
        "dim_customer": "select distinct doc_id, customer_id from g",
        "dim_services_performed": "select doc_id from g where l_tax > 0 union all select doc_id from g where l_discount > 0",
        "dim_parts_used": "select doc_id from g where o_orderpriority <> '1-URGENT' union all "
        "select doc_id from g where o_orderpriority <> '1-URGENT' and l_returnflag = 'R'",
        "items": "select doc_id from g",
        "error": "select doc_id from v where doc_id in (select doc_id from v where total_cost < 0)",
    }
    out["q_ingest_to_star"] = f"with {_GOOD} " + " union all ".join(
        f"select '{name}' as \"table\", substr(doc_id, 1, 4) || '-01-01' as date, count(*) as rows from ({sql}) group by 2"
        for name, sql in per_table.items()
    )
    last = {
        "fact_service_records": "select doc_id from k",
        "dim_dealer": "select distinct doc_id, dealer_id from k",
        "dim_vehicle": "select distinct doc_id, vin from k",
        "dim_customer": "select distinct doc_id, customer_id from k",
        "dim_services_performed": "select doc_id from k where l_tax > 0 union all select doc_id from k where l_discount > 0",
        "dim_parts_used": "select doc_id from k union all select doc_id from k where l_returnflag = 'R'",
        "items": "select doc_id from k",
        "error": "select doc_id from s where doc_id in (select doc_id from b)",
        "ledger": "select doc_id from s",
    }
    out["q_document_commits"] = (
        f"with {_VISITS}, m as (select *, substr(doc_id, 6, 2) as mon, bool_or(l_linenumber <= 2) over (partition by doc_id) as cut from v), "
        "s as (select * from m where mon <> '03' or not cut or l_linenumber <= 2), "
        "b as (select distinct doc_id from s where mon = '07' or total_cost < 0), k as (select * from s where doc_id not in (select doc_id from b)) "
    ) + " union all ".join(
        f"select '{name}' as \"table\", 'date=' || substr(doc_id, 1, 4) || '-01-01/' || doc_id as doc_id, count(*) as rows from ({sql}) group by 2"
        for name, sql in last.items()
    )
    out["q_paths"] = (
        "with p as (select *, 'date=' || strftime(o_orderdate, '%Y-%m-%d') || '/' || o_orderkey || ' a' as rest from orders) "
        "select o_orderkey, 'service-records/' || rest || '.json' as key, "
        "'parquet_for_analytics/dim_dealer/' || rest || '.parquet' as analytics, "
        "'json_for_dynamodb/' || rest || '.json' as items, 'error/' || rest || '.json' as error, 1 as is_json, "
        "o_orderpriority as label, cast(contains(o_orderpriority, 'HIGH') as int) as is_high from p"
    )

    out["q_status_counts"] = f"with {_complete(arm)} select status, count(*) as rows from h group by status"
    out["q_failure_by_hour"] = (
        f"with {_complete(arm)} select hour_of_day, round(avg(failure) * 100, 6) as failure_rate "
        "from h group by 1"
    )
    out["q_failure_by_weekday"] = (
        f"with {_complete(arm)} select day_of_week, round(avg(failure) * 100, 6) as failure_rate "
        "from h group by 1"
    )
    out["q_dataset_stats"] = (
        f"with {_history(arm)} select count(*) as rows, count(distinct machine_id) as machines from h"
    )
    out["q_dataset_head"] = (
        f"with {_history(arm)} select event_id, timestamp, machine_id, machine_type, {_list(arm.readings)}, status, "
        "time_since_maintenance, failure from h order by timestamp, event_id limit 5"
    )
    out["q_density_2d"] = _density_2d()
    out["q_confusion"] = (
        f"with {_judged()} select failure, case when p > 0.5 then 1 else 0 end as prediction, count(*) as rows "
        "from j where p is not null group by 1, 2"
    )
    out["q_binary_metrics"] = (
        f"with {_judged()}, u as (select 'fixed' as model, failure as y, case when p > 0.5 then 1 else 0 end as yhat "
        f"from j where p is not null), {_METRICS_CTE.format(keys='model')} select * from e"
    )
    out["q_class_report"] = _class_report()
    out["q_metrics_long"] = f"with {_compared()} " + " union all ".join(
        f"select model, '{m}' as metric, {m} as value from e" for m in ("accuracy", "precision", "recall", "f1_score")
    )
    out["q_best_model"] = (
        f"with {_compared()} select model, f1_score from e order by f1_score desc, place limit 1"
    )
    out["q_split"] = (
        f"with {_SPLIT} select event_id, failure, cast(rn <= q as int) as is_train, cast({_FOLD} as int) as fold from r"
    )
    out["q_split_shares"] = (
        f"with {_SPLIT}, f as (select failure, {_FOLD} as fold from r) select failure, "
        "case when fold < 5 then 'train' else 'test' end as side, cast(nullif(fold, 5) as int) as fold, count(*) as rows from f group by all"
    )
    out["ml_boost_tree"] = _tree_nodes(arm, (1, 3, 5), 0.1)
    out["st_trained_model"] = _trained_stream(arm)
    out["st_score"] = _streamed()
    out["st_sensor_to_lake"] = out["q_sensor_flatten_arm_robot"]
    out["st_cdc_log"] = f"select *, substr(created_at, 1, 10) as date from ({out['q_cdc_classify']})"
    out["st_risk_counts"] = (
        "select substr(prediction_timestamp, 1, 10) as date, machine_type, machine_id, risk_level, count(*) as risk_count "
        f"from ({out['q_risk_class_arm_robot']}) where risk_level is not null group by 1, 2, 3, 4"
    )
    out["st_risk_tally"] = out["st_risk_counts"]
    out["st_prev_state"] = out["q_serving_prev_arm_robot"]
    tables = {
        "fact_service_records": "q_star_fact",
        "dim_dealer": "q_star_dealer",
        "dim_vehicle": "q_star_vehicle",
        "dim_customer": "q_star_customer",
        "dim_services_performed": "q_star_services",
        "dim_parts_used": "q_star_parts",
    }
    counted = [
        f"select '{table}' as \"table\", doc_id, count(*) as rows from ({out[query]}) group by doc_id"
        for table, query in tables.items()
    ]
    counted.append(
        f"select 'error' as \"table\", doc_id, records as rows from ({out['q_accept_reject']}) where rule is not null"
    )
    out["st_lake_to_upsert"] = f"with {_sensors(arm)} select timestamp, machine_id, machine_type, {_list(arm.readings)} from s"
    out["st_star"] = " union all ".join(counted)
    return out

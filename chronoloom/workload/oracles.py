"""SQL twins of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from collections.abc import Sequence

from chronoloom.workload.tables import FIELDS

START, STOP = "TIMESTAMP '2024-01-01'", "TIMESTAMP '2024-01-31'"
LOW, HIGH = "TIMESTAMP '2024-01-10'", "TIMESTAMP '2024-01-13'"
SERIES = 'bucket, _measurement, _field, system_id, "floor", equipment_number'
SYNC = ["system_id", '"floor"', "equipment_number"]


def points_cte(value: str = "value", time: str = "ts") -> str:
    return f"""points AS (
  SELECT {time} AS _time, 'b' || (user_id % 4) AS bucket,
    CASE WHEN event_type IN ('click', 'view') THEN 'traffic' ELSE 'action' END AS _measurement,
    event_type AS _field, {value} AS _value, CAST(user_id % 10 AS VARCHAR) AS system_id,
    CAST(user_id % 3 AS VARCHAR) AS "floor", CAST(user_id AS VARCHAR) AS equipment_number
  FROM events)"""


GAPPY = "CASE WHEN value >= 5.0 THEN value END"


def from_points(body: str, **cte: str) -> str:
    return f"WITH {points_cte(**cte)}\n{body}"


def chosen(where: str) -> str:
    return from_points(f"SELECT * FROM points WHERE {where}")


def snap(time: str, step: int) -> str:
    return f"CAST(round_even(ceil(epoch_us({time}) / 60000000.0) * 60 / {step}, 0) * {step} AS BIGINT)"


def grid_ctes(fields: Sequence[str], keys: Sequence[str], step: int = 300, value: str = "_value") -> str:
    k = ", ".join(keys)
    first = ", ".join(f"avg({value}) FILTER (_field = '{f}') AS {f}" for f in fields)
    second = ", ".join(f"avg({f}) AS {f}" for f in fields)
    names = ", ".join(f"'{f}'" for f in fields)
    return f"""instants AS (
  SELECT _time, {k}, {first} FROM points
  WHERE _value IS NOT NULL AND _field IN ({names}) GROUP BY _time, {k}),
snapped AS (SELECT * EXCLUDE (_time), {snap('_time', step)} AS _time FROM instants),
grid AS (SELECT _time, {k}, {second} FROM snapped GROUP BY _time, {k})"""


def fill_ctes(fields: Sequence[str], keys: Sequence[str], scope: str = "system", limit: int = 2) -> str:
    k = ", ".join(keys)
    part, by = (keys[0], ", ".join(["_time", *keys[1:]])) if scope == "system" else (k, "_time")
    over = f"OVER (PARTITION BY {part} ORDER BY {by} ROWS BETWEEN"
    ahead = ", ".join(f"last_value({f} IGNORE NULLS) {over} {limit} PRECEDING AND CURRENT ROW) AS {f}" for f in fields)
    back = ", ".join(f"first_value({f} IGNORE NULLS) {over} CURRENT ROW AND {limit} FOLLOWING) AS {f}" for f in fields)
    return f"""forward AS (SELECT _time, {k}, {ahead} FROM grid),
filled AS (SELECT _time, {k}, {back} FROM forward)"""


def sync(
    fields: Sequence[str],
    keys: Sequence[str] = SYNC,
    step: int = 300,
    scope: str = "system",
    out: dict[str, str] | None = None,
    digits: int = 6,
    value: str = "_value",
    limit: int = 2,
    **cte: str,
) -> str:
    shown = ", ".join((out or {}).get(f, f"round({f}, {digits})") + f" AS {f}" for f in fields)
    whole = " AND ".join(f"{f} IS NOT NULL" for f in fields)
    return f"""WITH {points_cte(**cte)},
{grid_ctes(fields, keys, step, value)},
{fill_ctes(fields, keys, scope, limit)}
SELECT _time, {', '.join(keys)}, {shown} FROM filled WHERE {whole}"""


def wrapped(field: str) -> str:
    return f"CAST((((CAST(trunc({field}) AS BIGINT) + 128) % 256 + 256) % 256) - 128 AS BIGINT)"


def tried(field: str) -> str:
    return f"CAST(TRY_CAST(trunc({field}) AS TINYINT) AS BIGINT)"


def windows(step: str, keys: str, aggregates: str, where: str = "true") -> str:
    return f"""SELECT {keys}, time_bucket(INTERVAL '{step}', _time) + INTERVAL '{step}' AS _time, {aggregates}
  FROM points WHERE {where} GROUP BY ALL"""


def null_total(table: str, stage: str) -> str:
    nulls = " + ".join(f"count(*) FILTER ({f} IS NULL)" for f in FIELDS)
    return f"SELECT count(*) AS n_rows, CAST(9 AS BIGINT) AS n_columns, {nulls} AS n_nulls, '{stage}' AS stage FROM {table}"


def meters_ctes() -> str:
    keys = [k.strip() for k in SERIES.split(",")]
    same = " AND ".join(f"g.{k} = w.{k}" for k in keys)
    picked = ", ".join(f"g.{k}" for k in keys)
    over = f"OVER (PARTITION BY {SERIES} ORDER BY _time)"
    where = f"""bucket IN ('b0', 'b1', 'b2') AND _time >= {START} AND _time < {STOP}
    AND _field = 'purchase' AND _measurement = 'action'"""
    return f"""{points_cte()},
w AS ({windows('30 minutes', SERIES, 'max(_value) AS _value', where)}),
grid AS (
  SELECT s.*, t._time FROM (SELECT DISTINCT {SERIES} FROM w) s,
    (SELECT unnest(generate_series({START} + INTERVAL 30 MINUTE, {STOP}, INTERVAL 30 MINUTE)) AS _time) t),
sparse AS (SELECT {picked}, g._time, w._value FROM grid g LEFT JOIN w ON {same} AND g._time = w._time),
filled AS (SELECT * REPLACE (last_value(_value IGNORE NULLS) {over} AS _value) FROM sparse),
paired AS (SELECT *, lag(_value) {over} AS before, row_number() {over} AS rn FROM filled),
meters AS (
  SELECT * EXCLUDE (before, rn) REPLACE (CASE WHEN _value - before >= 0 THEN _value - before END AS _value)
  FROM paired WHERE rn > 1)"""


def profile(columns: dict[str, str], source: str) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, "
        f"count(DISTINCT {c}) AS n_distinct FROM {source}"
        for c, t in columns.items()
    ]
    return " UNION ALL ".join(parts)


LINE_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}
LINE_NUMBERS = [c for c, t in LINE_TYPES.items() if t in ("bigint", "int", "double")]
LINES = """lines AS (SELECT * REPLACE (nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax) FROM lineitem)"""


def describe() -> str:
    parts = []
    for c in LINE_NUMBERS:
        q = ", ".join(f"round(quantile_cont({c}, {p}), 6) AS q{int(p * 100)}" for p in (0.25, 0.5, 0.75))
        parts.append(
            f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", round(avg({c}), 6) AS mean, "
            f"round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min, {q}, "
            f"round(CAST(max({c}) AS DOUBLE), 6) AS max FROM lines"
        )
    return f"WITH {LINES} " + " UNION ALL ".join(parts)


def draw(identity: str, salt: str) -> str:
    return f"CAST(('0x' || substr(md5({identity} || '|{salt}'), 1, 8)) AS BIGINT)"


def generated() -> str:
    who = "('0/' || event_id)"

    def uniform(name: str) -> str:
        return f"round({draw(who, name)} / 4294967296.0 * 1000.0, 3)"

    letters = " || ".join(
        f"substr('abcdefghijklmnopqrstuvwxyz', 1 + {draw(who, f'field_13/{i}')} % 26, 1)" for i in range(10)
    )
    text = f"substr({letters}, 1, 5 + {draw(who, 'field_13/length')} % 6)"
    return f"""WITH drawn AS (
  SELECT *, 'measurement_' || (1 + {draw(who, '_measurement')} % 2) AS _measurement,
    'tag_1' || (1 + {draw(who, 'tag_1')} % 3) AS tag_1, 'tag_2' || (1 + {draw(who, 'tag_2')} % 2) AS tag_2
  FROM events)
SELECT _measurement, tag_1, tag_2, ts AS _time,
  CASE WHEN _measurement = 'measurement_1' THEN {uniform('field_11')} END AS field_11,
  CASE WHEN _measurement = 'measurement_1' THEN {draw(who, 'field_12')} % 10001 END AS field_12,
  CASE WHEN _measurement = 'measurement_1' THEN {text} END AS field_13,
  CASE WHEN _measurement = 'measurement_2' THEN {uniform('field_21')} END AS field_21,
  CASE WHEN _measurement = 'measurement_2' THEN {draw(who, 'field_22')} % 2 = 1 END AS field_22
FROM drawn"""


def centred(keys: str, where: str = "true", fit: str = "true", score: bool = True) -> str:
    on = ", ".join(k.strip() for k in keys.split(","))
    extra = ", round(CASE WHEN std > 0 THEN (_value - mean) / std END, 6) AS score" if score else ""
    return from_points(f"""SELECT {SERIES}, _time, round(mean, 6) AS prediction, round(_value - mean, 6) AS residual{extra}
FROM points LEFT JOIN (
  SELECT {on}, avg(_value) AS mean, stddev_samp(_value) AS std FROM points WHERE {fit} GROUP BY ALL) m USING ({on})
WHERE {where}""")


CLOSED = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


def _oracles() -> dict[str, str]:
    sql: dict[str, str] = {}

    sql["sync_5min"] = sync(FIELDS)
    sql["sync_5min_series_scope"] = sync(["click", "view"], scope="series")
    sql["sync_nulls_dups"] = sync(
        FIELDS, ["bucket", '"floor"'], 3600, value="_value", time="time_bucket(INTERVAL '10 minutes', ts)"
    ).replace("value AS _value", f"{GAPPY} AS _value", 1)
    sql["sync_float32"] = sync(FIELDS, digits=3, value="CAST(_value AS FLOAT)")
    ctes = f"WITH {points_cte()},\n{grid_ctes(FIELDS, SYNC)}"
    shown = ", ".join(f"round({f}, 6) AS {f}" for f in FIELDS)
    sql["sync_grid"] = f"{ctes}\nSELECT _time, {', '.join(SYNC)}, {shown} FROM grid"
    sql["sync_missing_report"] = (
        f"{ctes},\n{fill_ctes(FIELDS, SYNC)}\n{null_total('grid', 'before')} UNION ALL {null_total('filled', 'after')}"
    )
    sql["narrow_wrap"] = sync(FIELDS, out={f: wrapped(f) for f in FIELDS})
    tries = {f: tried(f) for f in FIELDS if f != "view"}
    sql["narrow_try"] = sync(FIELDS, out={**tries, "view": "round(round_even(view / power(2, greatest(floor(log2(abs(view))), -14) - 10), 0) * power(2, greatest(floor(log2(abs(view))), -14) - 10), 3)"})

    sql["range_half_open"] = chosen(f"_time >= {LOW} AND _time < {HIGH}")
    sql["range_epoch_seconds"] = sql["range_half_open"]
    sql["range_open_ended"] = chosen(f"_time >= {STOP} - INTERVAL 48 HOUR")
    sql["rerange_plan"] = chosen(
        f"bucket IN ('b1', 'b2') AND _time >= {LOW} AND _time < {HIGH} AND _measurement = 'action'"
    )
    sql["filter_measurement"] = chosen("_measurement = 'traffic'")
    sql["filter_not_measurement"] = chosen("_measurement <> 'traffic'")
    sql["filter_fields_or"] = chosen("_field = 'click' OR _field = 'error'")
    sql["filter_any_of"] = chosen("_field = 'signup' OR \"floor\" = '2'")
    sql["filter_not_field"] = chosen("_field <> 'click' AND _field <> 'error'")
    sql["tag_filters"] = chosen(
        "system_id IN ('1', '4', '7') AND \"floor\" IN ('1', '2') AND equipment_number <> '14'"
    )
    sql["element_and_type_filters"] = from_points(
        "SELECT *, _measurement AS element, \"floor\" AS \"type\" FROM points"
        " WHERE _measurement = 'traffic' AND \"floor\" = '0'"
    )
    sql["value_between_incl"] = chosen("_value BETWEEN 10 AND 40")
    sql["value_between_excl"] = chosen("_value > 10 AND _value < 40")
    sql["contains_set"] = chosen("equipment_number IN ('3', '5', '8', '13', '21')")
    sql["contains_semi"] = (
        "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem"
        " WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25)"
    )
    sql["keep_columns"] = from_points("SELECT _time, bucket, _field, _value FROM points")
    sql["drop_columns"] = from_points("SELECT _time, bucket, _measurement, _field, _value FROM points")
    sql["bucket_tag"] = from_points("SELECT * REPLACE ('site' AS bucket) FROM points")
    sql["union_of_buckets"] = chosen("bucket IN ('b0', 'b2', 'b3')")
    sql["bucket_discovery"] = from_points("SELECT DISTINCT bucket FROM points WHERE bucket <> 'b3'")
    sql["bucket_exclusion_table"] = from_points(
        "SELECT DISTINCT bucket FROM points WHERE bucket NOT IN (SELECT 'b' || (n_nationkey % 2) FROM nation)"
    )
    sql["all_buckets_query"] = chosen("bucket <> 'b1' AND _field = 'purchase'")
    sql["field_keys"] = from_points(f"SELECT DISTINCT _field FROM points WHERE _time >= {STOP} - INTERVAL 100 DAY")
    sql["sql_params"] = "SELECT * FROM orders WHERE o_totalprice > 500.0 ORDER BY o_orderkey LIMIT 100"
    sql["sql_text"] = (
        "SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1"
    )
    sql["sql_rerange"] = (
        "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders"
        " WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'"
    )
    sql["rows_above_value"] = "SELECT * FROM customer WHERE c_acctbal > 5000.0 ORDER BY c_custkey LIMIT 100"

    sql["agg_window_mean_15m"] = from_points(windows("15 minutes", SERIES, "round(avg(_value), 6) AS _value"))
    sql["agg_window_max_30m_empty"] = from_points(f"""SELECT s.*, t._time, w._value
FROM (SELECT DISTINCT bucket, _field, system_id FROM points) s
CROSS JOIN (SELECT unnest(generate_series({START} + INTERVAL 30 MINUTE, {STOP}, INTERVAL 30 MINUTE)) AS _time) t
LEFT JOIN ({windows('30 minutes', 'bucket, _field, system_id', 'max(_value) AS _value')}) w
  USING (bucket, _field, system_id, _time)""")
    first, last = "TIMESTAMP '2024-01-05 10:20:00'", "TIMESTAMP '2024-01-08 07:45:00'"
    sql["agg_window_clipped"] = from_points(f"""SELECT s.*, least(t._time, {last}) AS _time,
  coalesce(w."count", 0) AS "count", w."max"
FROM (SELECT DISTINCT bucket, _field FROM points WHERE _time >= {first} AND _time < {last}) s
CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-05 11:00:00', TIMESTAMP '2024-01-08 08:00:00',
  INTERVAL 1 HOUR)) AS _time) t
LEFT JOIN ({windows('1 hour', 'bucket, _field', 'count(_value) AS "count", max(_value) AS "max"',
  f'_time >= {first} AND _time < {last}')}) w USING (bucket, _field, _time)""")
    sql["agg_window_fns"] = from_points(
        windows(
            "6 hours",
            "bucket, _field",
            'round(avg(_value), 6) AS mean, max(_value) AS "max", min(_value) AS "min", round(sum(_value), 6) AS sum,'
            " count(_value) AS count, round(stddev_samp(_value), 6) AS stddev,"
            " round(max(_value) - min(_value), 6) AS spread, arg_min(_value, _time) AS first,"
            " arg_max(_value, _time) AS last",
        )
    )
    sql["agg_window_median"] = from_points(
        windows("1 day", "bucket, _field", "round(quantile_cont(_value, 0.5), 6) AS _value")
    )
    per_field = ", ".join(f"round(max(_value) FILTER (_field = '{f}'), 6) AS {f}" for f in FIELDS)
    sql["agg_window_pivot"] = from_points(f"""SELECT bucket, _time, {per_field}
FROM ({windows('1 hour', 'bucket, _field', 'avg(_value) AS _value', f'_time >= {START} AND _time < {STOP}')})
GROUP BY bucket, _time""")
    per_field = ", ".join(f"max(_value) FILTER (_field = '{f}') AS {f}" for f in FIELDS)
    sql["pivot_fields"] = from_points(
        f"SELECT _time, bucket, equipment_number, {per_field} FROM points GROUP BY _time, bucket, equipment_number"
    )
    sql["group_keys"] = from_points(f"""SELECT bucket, _time, round(_value - before, 6) AS _value FROM (
  SELECT *, lag(_value) OVER (PARTITION BY bucket ORDER BY _time) AS before,
    row_number() OVER (PARTITION BY bucket ORDER BY _time) AS rn
  FROM ({windows('1 hour', 'bucket', 'sum(_value) AS _value', f'_time >= {START} AND _time < {STOP}')}))
WHERE rn > 1""")
    sql["fill_previous_values"] = from_points(
        "SELECT * REPLACE (last_value(_value IGNORE NULLS) OVER (PARTITION BY bucket, _field, system_id"
        " ORDER BY _time, equipment_number ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _value) FROM points",
        value=GAPPY,
    )
    over = "OVER (PARTITION BY bucket ORDER BY _time, _field, equipment_number ROWS BETWEEN"
    sql["fill_limited_both_ways"] = from_points(
        f"""SELECT * REPLACE (first_value(_value IGNORE NULLS) {over} CURRENT ROW AND 2 FOLLOWING) AS _value) FROM (
  SELECT * REPLACE (last_value(_value IGNORE NULLS) {over} 2 PRECEDING AND CURRENT ROW) AS _value) FROM points)""",
        value=GAPPY,
    )
    sql["fill_by_counts"] = sql["fill_limited_both_ways"]
    sql["lags_by_counts"] = from_points("""SELECT *, lag(_value, 1) OVER w AS lag_1, lag(_value, 3) OVER w AS lag_3 FROM points
WINDOW w AS (PARTITION BY bucket, _field ORDER BY _time, equipment_number)""")
    sql["difference_signed"] = from_points(f"""SELECT * EXCLUDE (before, rn) REPLACE (round(_value - before, 6) AS _value)
FROM (SELECT *, lag(_value) OVER w AS before, row_number() OVER w AS rn FROM points
  WINDOW w AS (PARTITION BY {SERIES} ORDER BY _time)) WHERE rn > 1""")
    sql["difference_nonneg"] = from_points(
        """SELECT * EXCLUDE (before, rn)
  REPLACE (CASE WHEN _value - before >= 0 THEN round(_value - before, 6) END AS _value)
FROM (SELECT *, last_value(_value IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
    row_number() OVER w AS rn FROM points
  WINDOW w AS (PARTITION BY bucket, _field ORDER BY _time, equipment_number)) WHERE rn > 1""",
        value=GAPPY,
    )
    sql["sorted_points"] = from_points(
        "SELECT _time, bucket, _field, _value FROM points ORDER BY bucket, _field, _value, _time"
    )
    sql["preview_rows"] = "SELECT * FROM customer ORDER BY c_custkey LIMIT 5"

    sql["meter_consumption"] = f"""WITH {meters_ctes()}
SELECT _time, bucket, "floor", equipment_number, round(_value, 6) AS _value FROM meters"""
    sql["temperature_reach_input"] = from_points(
        windows(
            "15 minutes",
            SERIES,
            "round(avg(_value), 6) AS _value",
            f"bucket = 'b0' AND _time >= {START} AND _time < {STOP} AND _measurement = 'traffic'"
            " AND _field IN ('click', 'view') AND \"floor\" IN ('0', '1') AND _value >= 10 AND _value <= 40",
        )
    )
    sql["comfort_input"] = chosen(
        "bucket IN ('b0', 'b1', 'b3') AND _time >= TIMESTAMP '2024-01-09 00:00:00.343'"
        " AND _time < TIMESTAMP '2024-01-24 23:48:32.343' AND _measurement = 'action'"
        " AND _field IN ('error', 'purchase', 'signup') AND \"floor\" = '1'"
    )
    sql["demo_fused"] = f"""WITH {points_cte()}
SELECT * FROM points WHERE _time >= {LOW} AND _time < {HIGH} AND _measurement = 'action'
  AND _field IN ('purchase', 'signup')
UNION ALL BY NAME
SELECT * FROM (SELECT * FROM orders WHERE o_totalprice > 500.0 ORDER BY o_orderkey LIMIT 100)
UNION ALL BY NAME SELECT * REPLACE (CAST(s_suppkey AS INTEGER) AS s_suppkey) FROM supplier"""
    sql["fuse_sources"] = (
        "SELECT o_orderkey, o_custkey AS c_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
        " FROM orders UNION ALL BY NAME SELECT * FROM customer"
    )
    sql["fuse_type_conflict"] = (
        "SELECT o_orderkey AS key, o_orderstatus AS code, o_totalprice AS amount FROM orders UNION ALL"
        " SELECT c_custkey, CAST(c_nationkey AS VARCHAR), CAST(c_nationkey AS DOUBLE) FROM customer"
    )
    ids = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
    sql["wide_to_long"] = " UNION ALL ".join(
        f"SELECT {ids}, '{c}' AS _field, {c} AS _value FROM lineitem WHERE {c} IS NOT NULL"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    )
    sql["plot_lines"] = (
        from_points(f"SELECT bucket, _time, {per_field} FROM points GROUP BY bucket, _time").replace(
            "\nSELECT", ", wide AS (SELECT"
        )
        + ") "
        + " UNION ALL ".join(f"SELECT bucket || '-{f}' AS name, _time AS x, {f} AS y FROM wide" for f in FIELDS)
    )

    sql["profile_lineitem"] = f"WITH {LINES} " + profile(LINE_TYPES, "lines")
    sql["distinct_values"] = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM lineitem GROUP BY {c}"
        for c in ("l_returnflag", "l_linestatus", "l_linenumber")
    )
    sql["describe_numeric"] = describe()
    sql["rows_with_gaps"] = (
        f"WITH {LINES} SELECT {', '.join(LINE_NUMBERS)} FROM lines WHERE l_discount IS NULL OR l_tax IS NULL"
    )
    sql["complete_rows"] = (
        f"WITH {LINES} SELECT * EXCLUDE (l_shipdate) FROM lines WHERE l_discount IS NOT NULL AND l_tax IS NOT NULL"
    )
    sql["row_counts"] = from_points("SELECT bucket, _measurement, count(*) AS n FROM points GROUP BY ALL")

    sql["data_quality"] = from_points("""SELECT * FROM (
  SELECT bucket, _field, system_id, count(*) AS n_points,
    120 - count(DISTINCT time_bucket(INTERVAL '6 hours', _time)) AS n_missing_windows,
    count(*) FILTER (gap > 21600) + CASE WHEN max(tail) > 21600 THEN 1 ELSE 0 END AS n_gaps,
    round(greatest(max(gap), max(tail)), 6) AS max_gap_seconds,
    count(*) FILTER (_value < q1 - 1.5 * (q3 - q1) OR _value > q3 + 1.5 * (q3 - q1)) AS n_outliers
  FROM (SELECT *, (epoch_us(_time) - coalesce(lag(epoch_us(_time)) OVER (PARTITION BY bucket, _field, system_id ORDER BY _time),
      epoch_us(TIMESTAMP '2024-01-01'))) / 1e6 AS gap,
      (epoch_us(TIMESTAMP '2024-01-31') - max(epoch_us(_time)) OVER (PARTITION BY bucket, _field, system_id)) / 1e6 AS tail
      FROM points)
  JOIN (SELECT bucket, _field, system_id, quantile_cont(_value, 0.25) AS q1, quantile_cont(_value, 0.75) AS q3
    FROM points GROUP BY ALL) USING (bucket, _field, system_id)
  GROUP BY bucket, _field, system_id)""")
    keys = "bucket, _field, equipment_number"
    sql["data_quality_narrow_range"] = from_points(f"""
SELECT {keys}, coalesce(n_points, 0) AS n_points, coalesce(n_missing_windows, 12) AS n_missing_windows,
  coalesce(n_gaps, 1) AS n_gaps, coalesce(max_gap_seconds, 259200.0) AS max_gap_seconds, coalesce(n_outliers, 0) AS n_outliers
FROM (SELECT DISTINCT {keys} FROM points) LEFT JOIN (
  SELECT {keys}, count(*) AS n_points, 12 - count(DISTINCT time_bucket(INTERVAL '6 hours', _time)) AS n_missing_windows,
    count(*) FILTER (gap > 21600) + CASE WHEN max(tail) > 21600 THEN 1 ELSE 0 END AS n_gaps,
    round(greatest(max(gap), max(tail)), 6) AS max_gap_seconds,
    count(*) FILTER (_value < q1 - 1.5 * (q3 - q1) OR _value > q3 + 1.5 * (q3 - q1)) AS n_outliers
  FROM (SELECT *, (epoch_us(_time) - coalesce(lag(epoch_us(_time)) OVER (PARTITION BY {keys} ORDER BY _time), epoch_us({LOW}))) / 1e6 AS gap,
      (epoch_us({HIGH}) - max(epoch_us(_time)) OVER (PARTITION BY {keys})) / 1e6 AS tail
      FROM points WHERE _time >= {LOW} AND _time < {HIGH})
  JOIN (SELECT {keys}, quantile_cont(_value, 0.25) AS q1, quantile_cont(_value, 0.75) AS q3
    FROM points WHERE _time >= {LOW} AND _time < {HIGH} GROUP BY ALL) USING ({keys})
  GROUP BY {keys}) USING ({keys})""")
    sql["agg_window_empty_unfiltered"] = from_points(f"""
SELECT bucket, _field, s + INTERVAL 6 HOUR AS _time, round(m, 6) AS _value
FROM (SELECT DISTINCT bucket, _field FROM points WHERE _time >= {LOW} AND _time < {HIGH})
CROSS JOIN (SELECT {LOW} + INTERVAL 6 HOUR * k AS s FROM range(12) t(k))
LEFT JOIN (SELECT bucket, _field, time_bucket(INTERVAL '6 hours', _time) AS s, max(_value) AS m FROM points
  WHERE _time >= {LOW} AND _time < {HIGH} GROUP BY ALL) USING (bucket, _field, s)""")
    sql["centre_large_offset"] = from_points("""SELECT bucket, count(_value) AS n, round(avg(_value), 3) AS mean,
  round(stddev_samp(_value), 3) AS std FROM points GROUP BY bucket""")
    sql["consumption_daily"] = f"""WITH {meters_ctes()}
SELECT bucket, "floor", equipment_number, CAST(_time - INTERVAL 1 MICROSECOND AS DATE) AS day,
  round(sum(_value), 6) AS consumption, count(_value) AS n_windows
FROM meters GROUP BY ALL"""
    sql["consumption_daily_local"] = sql["consumption_daily"].replace("_time - INTERVAL", "_time + INTERVAL 1 HOUR - INTERVAL")
    sql["temperature_prediction_external"] = from_points(f"""SELECT bucket, _time, round(purchase, 4) AS purchase,
  round(my + b1 * (before - m1) + b2 * ("view" - m2), 4) AS prediction
FROM (
  SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2
  FROM (SELECT *, lag(purchase) OVER (PARTITION BY bucket ORDER BY _time) AS before FROM (
    SELECT bucket, _time, max(_value) FILTER (_field = 'purchase') AS purchase, max(_value) FILTER (_field = 'view') AS "view"
    FROM ({windows('1 hour', 'bucket, _field', 'avg(_value) AS _value')}) GROUP BY ALL)
    WHERE purchase IS NOT NULL AND "view" IS NOT NULL) rows,
  (SELECT var_pop(before) AS s11, var_pop("view") AS s22, covar_pop(before, "view") AS s12, covar_pop(before, purchase) AS s1y,
      covar_pop("view", purchase) AS s2y, avg(purchase) AS my, avg(before) AS m1, avg("view") AS m2
    FROM (SELECT *, lag(purchase) OVER (PARTITION BY bucket ORDER BY _time) AS before FROM (
      SELECT bucket, _time, max(_value) FILTER (_field = 'purchase') AS purchase, max(_value) FILTER (_field = 'view') AS "view"
      FROM ({windows('1 hour', 'bucket, _field', 'avg(_value) AS _value')}) GROUP BY ALL)
      WHERE purchase IS NOT NULL AND "view" IS NOT NULL)
    WHERE before IS NOT NULL AND _time < TIMESTAMP '2024-01-21') learned)
WHERE before IS NOT NULL AND _time >= TIMESTAMP '2024-01-21'""")
    # The tables lie in January, when the zone of the query is one hour ahead of UTC.
    sql["temperature_reach"] = from_points(f"""SELECT bucket, "floor", CAST(local AS DATE) AS day,
  min(minute) FILTER (abs("view" - click) <= 5.0) AS minutes_to_reach, count(*) AS n_windows
FROM (SELECT *, hour(local) * 60 + minute(local) - 450 AS minute FROM (
  SELECT bucket, "floor", _time - INTERVAL 15 MINUTE + INTERVAL 1 HOUR AS local, max(_value) FILTER (_field = 'view') AS "view",
    max(_value) FILTER (_field = 'click') AS click
  FROM ({windows('15 minutes', 'bucket, "floor", _field', 'avg(_value) AS _value')})
  GROUP BY ALL))
WHERE "view" IS NOT NULL AND click IS NOT NULL AND minute >= 0 AND minute < 360
GROUP BY bucket, "floor", day""")
    sql["temperature_prediction"] = from_points(f"""SELECT bucket, _field, system_id, _time, round(_value, 4) AS _value,
  round(i + s * before, 4) AS prediction
FROM (SELECT *, regr_slope(_value, before) OVER () AS s, regr_intercept(_value, before) OVER () AS i FROM (
  SELECT *, lag(_value) OVER (PARTITION BY bucket, _field, system_id ORDER BY _time) AS before
  FROM ({windows('1 hour', 'bucket, _field, system_id', 'avg(_value) AS _value')}))
WHERE before IS NOT NULL)""")

    hours = windows("1 hour", "bucket, _field, system_id", "avg(_value) AS _value")
    sql["model_per_series"] = from_points(f"""SELECT w.* REPLACE (round(_value, 4) AS _value), round(middle, 4) AS prediction,
  round(CASE WHEN spread > 0 THEN (_value - middle) / spread END, 4) AS score, CASE WHEN spread > 0 THEN abs(_value - middle) / spread > 3.0 END AS alarm
FROM ({hours}) w JOIN (SELECT bucket, _field, system_id, median(_value) AS middle, mad(_value) AS spread FROM ({hours}) GROUP BY ALL)
USING (bucket, _field, system_id)""")
    lagged = f"""rows AS (SELECT * FROM (
  SELECT *, lag(_value, 1) OVER w AS x, lag(_value, 24) OVER w AS z FROM ({windows('1 hour', 'bucket, _field', 'avg(_value) AS _value')})
  WINDOW w AS (PARTITION BY bucket, _field ORDER BY _time)) WHERE x IS NOT NULL AND z IS NOT NULL),
sums AS (SELECT bucket, _field, count(*) AS n, avg(x) AS mx, avg(z) AS mz, avg(_value) AS my, var_pop(x) AS xx, var_pop(z) AS zz,
  covar_pop(x, z) AS xz, covar_pop(x, _value) AS xy, covar_pop(z, _value) AS zy, var_pop(_value) AS yy FROM rows GROUP BY ALL),
learned AS (SELECT *, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS b1, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS b2 FROM sums)"""
    sql["regression_per_series"] = f"""WITH {points_cte()}, {lagged}
SELECT bucket, _field, n, round(my - b1 * mx - b2 * mz, 5) AS intercept, round(b1, 5) AS by_hour, round(b2, 5) AS by_day,
  round((b1 * xy + b2 * zy) / yy, 5) AS r2 FROM learned"""
    sql["regression_predictions"] = f"""WITH {points_cte()}, {lagged}
SELECT bucket, _field, _time, round(my + b1 * (x - mx) + b2 * (z - mz), 4) AS prediction FROM rows JOIN learned USING (bucket, _field)"""
    sql["probability_per_bucket"] = from_points(f"""SELECT {SERIES}, _time, round(score, 5) AS score,
  round(t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * exp(-x * x), 5) AS probability
FROM (SELECT *, 1 / (1 + 0.3275911 * x) AS t FROM (SELECT *, abs(score) / sqrt(2.0::DOUBLE) AS x FROM (
  SELECT points.*, (_value - mean) / std AS score
  FROM points JOIN (SELECT bucket, _field, avg(_value) AS mean, stddev_samp(_value) AS std FROM points GROUP BY ALL) USING (bucket, _field))))""")
    sql["two_plans_one_empty"] = from_points(f"""SELECT 'full' AS pipe, _field, count(_value) AS n, round(avg(_value), 4) AS mean,
  round(stddev_samp(_value), 4) AS std FROM points WHERE bucket = 'b1' AND _time >= {START} AND _time < {STOP} GROUP BY _field""")
    sql["fit_and_predict"] = f"""SELECT *, residual AS again FROM ({centred("bucket", score=False)})"""
    sql["stage_matrices"] = from_points("""SELECT 'CentreModel' AS stage, 'learned' AS result, 'bucket,_field,n,mean,m2,std' AS "columns",
  count(DISTINCT (bucket, _field)) AS n_rows, 'bucket,_field' AS keys, 'stages.py' AS file FROM points""")
    wide = f"""(SELECT bucket, _time, {", ".join(f"max(_value) FILTER (_field = '{f}') AS {f}" for f in FIELDS)}
  FROM ({windows('1 hour', 'bucket, _field', 'avg(_value) AS _value')}) GROUP BY ALL)"""
    described = lambda f: f"""SELECT '{f}' AS "column", 'double' AS dtype, count({f}) AS "count", round(avg({f}), 5) AS mean, round(stddev_samp({f}), 5) AS std,
  round(min({f}), 5) AS "min", round(quantile_cont({f}, 0.25), 5) AS q25, round(quantile_cont({f}, 0.5), 5) AS q50, round(quantile_cont({f}, 0.75), 5) AS q75,
  round(max({f}), 5) AS "max" FROM {wide}"""  # noqa: E731
    other = [f"SELECT '{c}' AS \"column\", '{t}' AS dtype" for c, t in (("bucket", "string"), ("_time", "timestamp_ntz"))]
    some = " OR ".join(f"{f} IS NULL" for f in FIELDS)
    other.append(f"SELECT 'incomplete rows' AS \"column\", count(*) AS \"count\" FROM {wide} WHERE {some}")
    sql["result_view"] = from_points(" UNION ALL BY NAME ".join([*map(described, FIELDS), *other]))
    kinds = {"o_orderkey": "BIGINT", "o_custkey": "BIGINT", "o_orderstatus": "TEXT", "o_totalprice": "FLOAT", "o_orderdate": "TIMESTAMP", "o_orderpriority": "TEXT"}
    sql["sql_types"] = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS sql_type, count(*) AS n_rows, count(*) - count({c}) AS n_nulls FROM orders" for c, t in kinds.items()
    )
    sql["identifiers"] = """SELECT name, count(*) AS n, regexp_full_match(name, '[A-Za-z0-9_]+') AS valid FROM (
  SELECT unnest([p_name, p_brand, p_type, replace(p_type, ' ', '_')]) AS name FROM part) GROUP BY name"""
    sql["clock_coverage"] = f"""SELECT t._time, count(ts) AS n
FROM (SELECT unnest(generate_series({START}, {STOP} - INTERVAL 30 MINUTE, INTERVAL 30 MINUTE)) AS _time) t
LEFT JOIN events ON time_bucket(INTERVAL '30 minutes', ts) = t._time GROUP BY t._time"""
    sql["numbered_points"] = from_points(
        f"SELECT *, row_number() OVER (ORDER BY _value NULLS FIRST, _time, {SERIES}) AS place FROM points"
    )

    sql["sql_rerange_limit"] = """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_totalprice > 500 AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' ORDER BY o_orderkey LIMIT 100"""
    sql["rerange_stop_only"] = from_points(f"""SELECT *, 'none' AS saved FROM early WHERE bucket = 'b1' AND _measurement = 'action' AND _time < {HIGH}
UNION ALL BY NAME SELECT *, 'both' AS saved FROM early
WHERE bucket IN ('b1', 'b2') AND _measurement = 'action' AND _time >= {LOW} AND _time < {HIGH}""").replace(
        "FROM events)", """FROM events), early AS (
  SELECT * REPLACE (CASE WHEN "floor" = '0' THEN _time - INTERVAL 60 YEAR ELSE _time END AS _time) FROM points)"""
    )
    sql["catalogue_discovery"] = from_points(f"""SELECT {SERIES}, min(_time) AS first_time, max(_time) AS last_time, count(*) AS n_rows
FROM points WHERE bucket <> 'b2' OR _field <> 'error' GROUP BY ALL""")
    sql["catalogue_field_keys"] = from_points("""SELECT DISTINCT _field FROM points WHERE bucket IN ('b0', 'b3') AND
  _time >= TIMESTAMP '2024-01-26 06:30:00' AND _time < TIMESTAMP '2024-01-29 06:30:00' AND (_field <> 'signup' OR _time < TIMESTAMP '2024-01-20')""")
    regular = """regular AS (SELECT bucket, _field, make_timestamp((e - e % step) * 1000000) AS _time, avg(_value) AS _value FROM (
  SELECT *, CAST(floor(epoch_us(_time) / 1e6) AS BIGINT) AS e, CASE bucket WHEN 'b0' THEN 300 WHEN 'b1' THEN 900 WHEN 'b2' THEN 3600 ELSE 7200 END AS step
  FROM points) GROUP BY ALL),
hist AS (SELECT bucket, _field, time_bucket(INTERVAL '7 days', _time, TIMESTAMP '1970-01-01') AS period, gap, count(*) AS n FROM (
  SELECT *, CAST(round((epoch_us(_time) - lag(epoch_us(_time)) OVER (PARTITION BY bucket, _field ORDER BY _time)) / 60e6) * 60 AS BIGINT) AS gap FROM regular)
  WHERE gap > 0 GROUP BY ALL),
usual AS (SELECT bucket, _field, arg_max(gap, n * 1e9 - gap) AS nominal_seconds, CAST(sum(n) AS BIGINT) AS n_gaps, round(max(n) / sum(n), 6) AS share
  FROM (SELECT bucket, _field, gap, sum(n) AS n FROM hist GROUP BY ALL) GROUP BY ALL)"""
    sql["nominal_interval"] = f"WITH {points_cte()}, {regular} SELECT * FROM usual"
    sql["interval_drift"] = f"""WITH {points_cte()}, {regular}
SELECT bucket, _field, period, w.nominal_seconds, usual.nominal_seconds AS usual_seconds
FROM (SELECT bucket, _field, period, arg_max(gap, n * 1e9 - gap) AS nominal_seconds FROM hist GROUP BY ALL) w JOIN usual USING (bucket, _field)
WHERE w.nominal_seconds <> usual.nominal_seconds"""
    sql["data_quality_inferred"] = f"""WITH {points_cte()}, {regular},
rows AS (SELECT r.*, u.nominal_seconds, quantile_cont(_value, 0.25) OVER k AS q1, quantile_cont(_value, 0.75) OVER k AS q3,
    (epoch_us(_time) - coalesce(lag(epoch_us(_time)) OVER (PARTITION BY r.bucket, r._field ORDER BY _time), epoch_us({START}))) / 1e6 AS gap,
    (epoch_us({STOP}) - max(epoch_us(_time)) OVER k) / 1e6 AS tail
  FROM regular r JOIN usual u USING (bucket, _field) WINDOW k AS (PARTITION BY r.bucket, r._field))
SELECT bucket, _field, nominal_seconds, count(*) AS n_points,
  (epoch_us({STOP}) - 1) // (nominal_seconds * 1000000) - epoch_us({START}) // (nominal_seconds * 1000000) + 1 - count(DISTINCT epoch_us(_time) // (nominal_seconds * 1000000)) AS n_missing_windows,
  count(*) FILTER (gap > nominal_seconds) + CASE WHEN max(tail) > nominal_seconds THEN 1 ELSE 0 END AS n_gaps,
  round(greatest(max(gap), max(tail)), 6) AS max_gap_seconds,
  count(*) FILTER (_value < q1 - 1.5 * (q3 - q1) OR _value > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM rows GROUP BY bucket, _field, nominal_seconds"""
    islands = lambda keys, holds, order, source="points": f"""SELECT {keys}, min(_time) AS "start", max(_time) AS "end", count(*) AS n_rows FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) - row_number() OVER (PARTITION BY {keys}, {holds} ORDER BY {order}) AS island
  FROM {source}) WHERE {holds} GROUP BY {keys}, island"""  # noqa: E731
    sql["value_runs"] = from_points(islands("bucket, _field", "_value >= 5.0", "_time, equipment_number"))
    sql["value_runs_by_counts"] = from_points(islands("bucket", "_value < 5.0", "_time, _field, equipment_number"))
    near = f"""(SELECT bucket, _time, max(_value) FILTER (_field = 'view') AS "view", max(_value) FILTER (_field = 'click') AS click
  FROM ({windows('30 minutes', 'bucket, _field', 'avg(_value) AS _value')}) GROUP BY ALL HAVING "view" IS NOT NULL AND click IS NOT NULL)"""
    stays = islands("bucket", '(abs("view" - click) <= 20.0)', "_time", near)
    sql["lasting_reach"] = from_points(f"""SELECT bucket, CAST("start" + INTERVAL 1 HOUR AS DATE) AS day, min("start") AS reached,
  arg_min((epoch_us("end") - epoch_us("start")) / 1e6, "start") AS seconds FROM ({stays})
WHERE epoch_us("end") - epoch_us("start") >= 3600000000 GROUP BY ALL""")
    sql["moving_outliers"] = from_points("""SELECT * EXCLUDE (m, recent) REPLACE (round(median, 6) AS median, round(spread, 6) AS spread), abs(_value - m) > 6.0 * spread AS outlier
FROM (SELECT *, m AS median, list_median(list_transform(recent, lambda x: abs(x - m))) AS spread FROM (
  SELECT *, median(_value) OVER w AS m, list(_value) OVER w AS recent FROM points
  WINDOW w AS (PARTITION BY bucket, _field ORDER BY _time, equipment_number ROWS BETWEEN 10 PRECEDING AND CURRENT ROW)))""")
    sql["centre_per_bucket"] = centred("bucket")
    sql["pandas_model_per_bucket"] = from_points("""SELECT bucket, _field, _time, equipment_number,
  bucket || '-' || _field AS label, abs((_value - mean) / std) > 2.0 AS alarm
FROM points JOIN (SELECT bucket, avg(_value) AS mean, stddev_samp(_value) AS std FROM points GROUP BY 1) USING (bucket)""")
    sql["pipeline_save_load"] = centred("bucket, _field", score=False)
    late = "TIMESTAMP '2024-01-21'"
    sql["plan_fit_predict"] = centred(
        "bucket", f"_time >= {late} AND _time < {STOP}", f"_time >= {START} AND _time < {late}", score=False
    )
    sql["updated_stage"] = sync(["purchase", "view"], limit=1)
    sql["pandas_model_whole_groups"] = from_points(
        """SELECT bucket, _field, _time, equipment_number, rank() OVER (PARTITION BY bucket ORDER BY _value) AS rank,
  rank() OVER (PARTITION BY bucket, _field, "floor", CAST(_time AS DATE) ORDER BY _value) AS day_rank FROM points"""
    )
    sql["general_query"] = chosen(f"bucket IN ('b1', 'b3') AND _time >= {LOW} AND _time < {HIGH} AND _field = 'view'")
    sql["demo_fit_predict"] = from_points(f"""SELECT {SERIES}, _time, round(mean, 6) AS prediction,
  round(_value - mean, 6) AS residual
FROM points JOIN (SELECT bucket, avg(_value) AS mean FROM points
  WHERE bucket = 'b0' AND _time >= {START} AND _time < {late} OR bucket = 'b2' AND _value >= 1.0 GROUP BY 1) USING (bucket)
WHERE _time >= {late} AND _time < {STOP} AND (bucket = 'b0' OR _value >= 1.0)""")
    sql["stage_results"] = from_points("""SELECT bucket, system_id, count(_value) AS n, round(var_pop(_value) * count(_value), 4) AS m2,
  round(avg(_value), 4) AS mean, round(stddev_samp(_value), 4) AS std
FROM points GROUP BY bucket, system_id""")
    both = sync(["purchase", "view"], digits=12)
    sql["synchronise_stage"] = f"""SELECT _time, system_id, "floor", equipment_number, round(purchase, 6) AS purchase,
  round("view", 6) AS "view", round(mean, 6) AS prediction, round("view" - mean, 6) AS residual
FROM (SELECT *, avg("view") OVER (PARTITION BY "floor") AS mean FROM ({both}))"""

    sql["rfc3339_text"] = (
        "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS text, date_trunc('milliseconds', ts) AS parsed"
        " FROM events"
    )
    sql["time_functions"] = f"""SELECT event_id, CAST(floor(epoch_us(ts) / 1e6) AS BIGINT) AS seconds,
  CAST(ceil(epoch_us(ts) / 60000000.0) * 60 AS BIGINT) AS ceil_minute, {snap('ts', 300)} AS grid,
  ts + INTERVAL 90 MINUTE AS later, CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 450 MINUTE AS morning,
  ts + INTERVAL 1 HOUR AS "local", date_trunc('second', ts) AS whole FROM events"""

    sql["csv_roundtrip"] = "SELECT * FROM orders"
    sql["json_roundtrip"] = "SELECT * FROM customer"
    sql["json_mixed_layouts"] = "SELECT * FROM customer"
    sql["json_prediction_input"] = "SELECT * FROM customer"
    sql["csv_awkward_text"] = """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN o_orderpriority || chr(10) || 'next'
  WHEN 1 THEN 'say "' || o_orderstatus || '", twice' WHEN 2 THEN '' WHEN 3 THEN o_orderpriority END AS note FROM orders"""
    sql["annotated_mixed_headers"] = """SELECT event_type AS _measurement, date_trunc('milliseconds', ts) AS _time,
  CASE WHEN user_id % 2 = 0 THEN value END AS value, event_id, CASE WHEN user_id % 2 = 1 THEN user_id END AS user_id
FROM events"""
    sql["points_roundtrip_whole"] = chosen("true")
    sql["parquet_prediction_input"] = "SELECT * FROM part"
    sql["csv_prediction_input"] = 'SELECT event_id, ts AS "timestamp", value FROM events'
    sql["points_roundtrip"] = chosen(f"bucket IN ('b0', 'b2') AND _time >= {LOW} AND _time < {HIGH}")
    wide = "event_type AS _measurement, CAST(user_id % 3 AS VARCHAR) AS \"floor\", ts AS _time, 'site' AS bucket"
    sql["upload_wide_rows"] = " UNION ALL BY NAME ".join(
        f"SELECT {wide}, '{f}' AS _field, {v} AS _value, {t} AS _value_text FROM events WHERE {c} IS NOT NULL"
        for f, c, v, t in (
            ("level", "value", "value", "CAST(NULL AS VARCHAR)"),
            ("device", "user_id", "CAST(user_id AS DOUBLE)", "CAST(NULL AS VARCHAR)"),
            ("note", "props", "CAST(NULL AS DOUBLE)", "props"),
        )
    )
    sql["annotated_csv_roundtrip"] = (
        "SELECT event_type AS _measurement, CAST(user_id % 4 AS VARCHAR) AS zone, CAST(user_id % 3 AS VARCHAR) AS"
        " \"floor\", date_trunc('milliseconds', ts) AS _time, value, event_id, props AS note, value > 100 AS high"
        " FROM events"
    )
    sql["generate_sensor_data"] = generated()

    sql["stream_window_max"] = from_points(
        f"SELECT * FROM ({windows('30 minutes', 'bucket, _field', 'max(_value) AS _value')}) w WHERE _time <= {CLOSED}"
    )
    sql["stream_sync_grid"] = (
        f"{ctes}\nSELECT _time, {', '.join(SYNC)}, {shown} FROM grid"
        f" WHERE make_timestamp((_time + 120) * 1000000) < {CLOSED}"
    )
    closed = grid_ctes(FIELDS, SYNC).replace("\ngrid AS (", "\nsteps AS (")
    whole = " AND ".join(f"{f} IS NOT NULL" for f in FIELDS)
    sql["stream_sync_filled"] = f"""WITH {points_cte()},
{closed},
grid AS (SELECT * FROM steps WHERE make_timestamp((_time + 120) * 1000000) < {CLOSED}),
{fill_ctes(FIELDS, SYNC)}
SELECT _time, {', '.join(SYNC)}, {shown} FROM filled WHERE {whole}"""
    sql["stream_window_max_batches"] = sql["stream_window_max"]
    sql["stream_fill_batches"] = sql["stream_sync_filled"]
    two = ["click", "view"]
    some = grid_ctes(two, SYNC).replace("\ngrid AS (", "\nsteps AS (")
    sql["stream_fill_series"] = f"""WITH {points_cte()},
{some},
grid AS (SELECT * FROM steps WHERE make_timestamp((_time + 120) * 1000000) <
  (SELECT max(_time) - INTERVAL 10 MINUTE FROM points WHERE _field IN ('click', 'view'))),
{fill_ctes(two, SYNC, "series", 1)}
SELECT _time, {', '.join(SYNC)}, round(click, 6) AS click, round("view", 6) AS "view" FROM filled
WHERE click IS NOT NULL AND "view" IS NOT NULL"""
    sql["stream_grid_10m"] = f"""WITH {points_cte()},
{grid_ctes(FIELDS, SYNC, 600)}
SELECT _time, {', '.join(SYNC)}, {shown} FROM grid WHERE _time <= (SELECT max(_time) - 600 FROM grid)"""
    batch = " + ".join(f"CASE WHEN _time >= TIMESTAMP '{t}' THEN 1 ELSE 0 END" for t in (
        "2024-01-08 00:10:00", "2024-01-15 12:00:00", "2024-01-22 00:00:00"))
    sql["partial_fit_predictions"] = from_points(f"""SELECT {SERIES}, _time, round(total / n + 3e-8, 6) AS prediction
FROM (SELECT *, {batch} AS batch FROM points) LEFT JOIN (
  SELECT bucket, _field, batch, sum(sum(_value)) OVER w AS total, sum(count(_value)) OVER w AS n
  FROM (SELECT *, {batch} AS batch FROM points) GROUP BY bucket, _field, batch
  WINDOW w AS (PARTITION BY bucket, _field ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
) USING (bucket, _field, batch)""")
    sql["partial_fit_stats"] = from_points(
        "SELECT bucket, _field, count(_value) AS n, round(avg(_value), 4) AS mean,"
        " round(var_pop(_value) * count(_value), 4) AS m2 FROM points GROUP BY bucket, _field"
    )
    return sql


ORACLES = _oracles()

"""The SQL each registered query is checked against, for DuckDB."""

from __future__ import annotations

import math

# One run per line item, the same rule as the Spark adapter, in decimals.
_RUNS = """runs AS (
  SELECT concat('run_', l_orderkey, '_', l_linenumber, '_', l_partkey, '_', l_suppkey) AS run_id,
    CAST(l_suppkey % 16 AS INTEGER) AS search_space_id,
    CAST(l_partkey % 97 AS INTEGER) AS dataset_id,
    CAST((1 + l_orderkey % 2000) * 0.00001 AS DECIMAL(18,6)) AS learning_rate,
    CASE l_linenumber % 5 WHEN 0 THEN 16 WHEN 1 THEN 32 WHEN 2 THEN 64 WHEN 3 THEN 128 ELSE 256 END AS batch_size,
    CAST(l_discount * 5 AS DECIMAL(18,6)) AS dropout,
    CAST(1 + l_partkey % 5 AS INTEGER) AS num_layers,
    CASE l_orderkey % 4 WHEN 0 THEN 64 WHEN 1 THEN 128 WHEN 2 THEN 256 ELSE 512 END AS hidden_units,
    CASE l_partkey % 4 WHEN 0 THEN 'adam' WHEN 1 THEN 'sgd' WHEN 2 THEN 'rmsprop' ELSE 'adagrad' END AS optimizer,
    CAST(l_tax / 10 AS DECIMAL(18,6)) AS weight_decay,
    CAST(10 + l_quantity AS INTEGER) AS epochs,
    CAST(l_quantity / 50 AS DECIMAL(18,6)) AS hp_0,
    CAST(l_discount * 10 AS DECIMAL(18,6)) AS hp_1,
    CAST(l_tax * 10 AS DECIMAL(18,6)) AS hp_2,
    CAST((l_partkey % 101) * 0.01 AS DECIMAL(18,6)) AS hp_3,
    CASE WHEN l_suppkey % 2 = 0 THEN CAST((l_orderkey % 51) * 0.02 AS DECIMAL(18,6)) END AS hp_4,
    CAST(0.5 + 0.3 * (l_quantity / 50) + 1.5 * l_discount + 0.4 * l_tax AS DECIMAL(18,6)) AS val_accuracy
  FROM lineitem)"""

_HP = ["hp_0", "hp_1", "hp_2", "hp_3", "hp_4"]
_MEASURES = ["learning_rate", "dropout", "weight_decay", *_HP, "val_accuracy"]
_COLUMNS = [
    "run_id", "search_space_id", "dataset_id", "learning_rate", "batch_size", "dropout", "num_layers",
    "hidden_units", "optimizer", "weight_decay", "epochs", *_HP, "val_accuracy",
]


def _out(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in _MEASURES else c for c in columns)


def _zero(*columns: str) -> str:
    return ", ".join(f"CAST(COALESCE({c}, 0) AS DOUBLE) AS {c}" for c in columns)


def _mean(c: str, p: int) -> str:
    """Exact mean of a decimal column, rounded half up to ``p`` digits."""
    half, whole = 10 ** (6 - p), 2 * 10 ** (6 - p)
    return (
        f"CAST((2*SUM(CAST({c}*1000000 AS BIGINT)) + {half}*COUNT({c})) // NULLIF({whole}*COUNT({c}), 0)"
        f" AS DOUBLE) / {10**p}"
    )


def _max(c: str) -> str:
    return f"CAST(ROUND(MAX({c}), 4) AS DOUBLE)"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


_ON_RUNS = _with(_RUNS)

# Value and accuracy of every run by column, as doubles.
_HP_LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT search_space_id, '{c}' AS hp, CAST(COALESCE({c}, 0) AS DOUBLE) AS v, CAST(val_accuracy AS DOUBLE) AS y FROM runs" for c in _HP
) + ")"

_PROFILES = f"""profiles AS (
  SELECT search_space_id, dataset_id, COUNT(*) AS n_runs,
    {_mean('val_accuracy', 4)} AS avg_acc, {_max('val_accuracy')} AS best_acc,
    ROUND(STDDEV_SAMP(CAST(val_accuracy AS DOUBLE)), 4) AS std_acc,
    {_mean('hp_0', 4)} AS avg_hp0, {_mean('hp_1', 4)} AS avg_hp1,
    {_mean('hp_2', 4)} AS avg_hp2, {_mean('hp_3', 4)} AS avg_hp3
  FROM runs GROUP BY search_space_id, dataset_id HAVING COUNT(*) >= 10)"""


def _top_configs(threshold: str = "0.95") -> str:
    means = ", ".join(f"{_mean(f'hp_{j}', 6)} AS best_hp{j}" for j in range(5))
    return f"""top_configs AS (
  SELECT search_space_id, {means}, {_max('val_accuracy')} AS best_acc, COUNT(*) AS top_runs
  FROM runs WHERE val_accuracy >= {threshold} GROUP BY search_space_id)"""


_BY_SPACE = f"""by_space AS (
  SELECT search_space_id, COUNT(*) AS runs, {_mean('val_accuracy', 4)} AS avg_acc, {_max('val_accuracy')} AS best_acc
  FROM runs GROUP BY search_space_id)"""

# --- cosine neighbours ------------------------------------------------------------

_FEATURES = ["avg_acc", "best_acc", "std_acc", "avg_hp0", "avg_hp1", "avg_hp2", "avg_hp3"]

_VECTORS = (
    "vectors AS (SELECT search_space_id, dataset_id, best_acc AS own_best, "
    + ", ".join(f"COALESCE({f}, 0) AS {f}" for f in _FEATURES)
    + ", ROW_NUMBER() OVER (ORDER BY best_acc DESC, search_space_id, dataset_id) - 1 AS position FROM profiles)"
)


def _cosine(a: str, b: str) -> str:
    dot = " + ".join(f"{a}.{f}*{b}.{f}" for f in _FEATURES)
    norm = lambda t: "sqrt(" + " + ".join(f"{t}.{f}*{t}.{f}" for f in _FEATURES) + ")"
    return f"({dot}) / ({norm(a)} * {norm(b)})"


_DIFFERENT = "(a.search_space_id <> b.search_space_id OR a.dataset_id <> b.dataset_id)"


def _near(k: int, condition: str = _DIFFERENT, queries: str = "TRUE") -> str:
    return f"""near AS (
  SELECT * FROM (
    SELECT a.search_space_id, a.dataset_id, b.search_space_id AS similar_search_space_id,
      b.dataset_id AS similar_dataset_id, b.own_best AS similar_best, {_cosine('a', 'b')} AS similarity,
      CAST(ROW_NUMBER() OVER (PARTITION BY a.search_space_id, a.dataset_id
        ORDER BY {_cosine('a', 'b')} DESC, b.search_space_id, b.dataset_id) AS INTEGER) AS rank
    FROM vectors a JOIN vectors b ON {condition} WHERE {queries})
  WHERE rank <= {k})"""


_NEAR_OUT = (
    "SELECT search_space_id, dataset_id, rank, similar_search_space_id, similar_dataset_id, "
    "ROUND(similarity, 6) AS similarity FROM near"
)

_RECOMMENDED = """recommended AS (
  SELECT n.search_space_id, n.dataset_id, n.rank, n.similar_dataset_id AS similar_dataset,
    n.similar_search_space_id AS search_space, ROUND(n.similarity, 4) AS similarity, n.similar_best AS best_acc,
    t.best_hp0 AS recommended_hp0, t.best_hp1 AS recommended_hp1, t.best_hp2 AS recommended_hp2,
    t.best_hp3 AS recommended_hp3
  FROM near n JOIN top_configs t ON t.search_space_id = n.similar_search_space_id)"""


def _hit_rate(tolerance: str) -> str:
    return _with(_RUNS, _PROFILES, _top_configs(), _VECTORS, _near(3, queries="a.position < 100"), _RECOMMENDED) + f"""
SELECT COUNT(*) AS profiles, COUNT(*) FILTER (offered >= own_best * CAST({tolerance} AS DOUBLE)) AS hits,
  COUNT(*) FILTER (offered >= own_best * CAST({tolerance} AS DOUBLE)) * 100.0::DOUBLE / COUNT(*) AS hit_rate_pct
FROM vectors v LEFT JOIN (SELECT search_space_id, dataset_id, MAX(best_acc) AS offered FROM recommended GROUP BY ALL) r
  USING (search_space_id, dataset_id) WHERE position < 100"""


# --- draws -------------------------------------------------------------------------


def _draw(key: str, i: int, seed: int = 42) -> str:
    digest = f"md5(concat('{seed}:{i // 4}:', {key}))"
    return f"(CAST('0x' || substr({digest}, {8 * (i % 4) + 1}, 8) AS BIGINT) / 4294967296.0::DOUBLE)"


def _pick(u: str, options: list[str]) -> str:
    return f"([{', '.join(options)}])[CAST(floor({u} * {float(len(options))}::DOUBLE) AS INTEGER) + 1]"


def _between(u: str, low: float, high: float) -> str:
    return f"({low!r}::DOUBLE + {u} * ({high!r}::DOUBLE - {low!r}::DOUBLE))"


def _log_between(u: str, low: str, high: str) -> str:
    return f"round(exp(ln({low}::DOUBLE) + {u} * (ln({high}::DOUBLE) - ln({low}::DOUBLE))), 9)"


def _whole(u: str, low: int, high: int) -> str:
    return f"CAST({low} + floor({u} * {float(high - low)}::DOUBLE) AS INTEGER)"


_SPACES = ["4796", "5527", "5636", "5859", "5860", "5891", "5906", "5965", "5970", "5971"]
_OPTIMIZERS = ["'adam'", "'sgd'", "'rmsprop'", "'adagrad'"]
_BATCHES = ["16", "32", "64", "128", "256"]
_UNITS = ["64", "128", "256", "512"]

_SPACE_CANDIDATES = """spaces AS (SELECT DISTINCT CAST(l_suppkey % 16 AS INTEGER) AS search_space_id FROM lineitem),
candidates AS (SELECT search_space_id, CAST(i AS INTEGER) AS candidate,
  concat(search_space_id, '_', i) AS key FROM spaces, range(200) AS r(i))"""

# --- search -------------------------------------------------------------------------


def _good(source: str, percent: int, name: str) -> str:
    return f"""{name} AS (
  SELECT *, 100 * (RANK() OVER (PARTITION BY search_space_id ORDER BY val_accuracy DESC) - 1)
    < {percent} * COUNT(*) OVER (PARTITION BY search_space_id) AS good
  FROM {source})"""


def _halves() -> str:
    filled = ", ".join(f"COALESCE({c}, 0) AS {c}" for c in _HP)
    return f"""history AS (SELECT run_id, search_space_id, val_accuracy, {filled} FROM runs WHERE md5(run_id) < '8'),
heldout AS (SELECT run_id, search_space_id, val_accuracy, {filled} FROM runs WHERE md5(run_id) >= '8')"""


_BIN = "LEAST(CAST(floor({c} * 10) AS INTEGER), 9)"


def _density(history: str = "history", heldout: str = "heldout", tag: str = "") -> str:
    tall = "\n  UNION ALL ".join(
        f"SELECT search_space_id, '{c}' AS hp, {_BIN.format(c=c)} AS bin, good FROM marked{tag}" for c in _HP
    )
    terms = " + ".join(f"w{j}.weight" for j in range(len(_HP)))
    joins = "\n  ".join(
        f"JOIN weights{tag} w{j} ON w{j}.search_space_id = h.search_space_id AND w{j}.hp = '{c}'"
        f" AND w{j}.bin = {_BIN.format(c='h.' + c)}"
        for j, c in enumerate(_HP)
    )
    return f"""{_good(history, 15, f'marked{tag}')},
tall{tag} AS ({tall}),
counted{tag} AS (SELECT s.search_space_id, h.hp, b.bin,
    COUNT(t.bin) FILTER (t.good) AS g, COUNT(t.bin) FILTER (NOT t.good) AS r
  FROM (SELECT DISTINCT search_space_id FROM {history}) s
  CROSS JOIN (SELECT unnest({_HP}) AS hp) h CROSS JOIN (SELECT CAST(unnest(range(10)) AS INTEGER) AS bin) b
  LEFT JOIN tall{tag} t ON t.search_space_id = s.search_space_id AND t.hp = h.hp AND t.bin = b.bin
  GROUP BY ALL),
weights{tag} AS (SELECT search_space_id, hp, bin,
    ln((g + 1)::DOUBLE / (SUM(g) OVER p + 10)) - ln((r + 1)::DOUBLE / (SUM(r) OVER p + 10)) AS weight
  FROM counted{tag} WINDOW p AS (PARTITION BY search_space_id, hp)),
dense{tag} AS (SELECT h.*, CAST({terms} AS DECIMAL(18,6)) AS density FROM {heldout} h
  {joins})"""


def _elite(source: str, percent: int, tag: str = "", digits: int = 10) -> str:
    means = ", ".join(f"{_mean(c, 6)} AS mean_{c}" for c in _HP)
    deviations = ", ".join(f"ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), {digits}) AS std_{c}" for c in _HP)
    pairs = [(a, b) for i, a in enumerate(_HP) for b in _HP[i + 1 :]]
    covariances = ", ".join(
        f"ROUND(COVAR_SAMP(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), {digits}) AS cov_{a}_{b}" for a, b in pairs
    )
    return f"""{_good(source, percent, f'elite_marked{tag}')},
elite{tag} AS (SELECT search_space_id, COUNT(*) AS n_elite, {means}, {deviations}, {covariances}
  FROM elite_marked{tag} WHERE good GROUP BY search_space_id)"""


_RIDGE = "0.0001::DOUBLE"


def _factor(tag: str = "") -> str:
    """The Cholesky factor of the covariances of ``elite``; a column may use those before it."""
    columns = []
    for j, b in enumerate(_HP):
        minus = "".join(f" - l_{j}_{k} * l_{j}_{k}" for k in range(j))
        pivot = f"COALESCE(std_{b}, 0) * COALESCE(std_{b}, 0) + {_RIDGE}{minus}"
        columns.append(f"sqrt(GREATEST({pivot}, {_RIDGE})) AS l_{j}_{j}")
        for i in range(j + 1, len(_HP)):
            minus = "".join(f" - l_{i}_{k} * l_{j}_{k}" for k in range(j))
            columns.append(f"(COALESCE(cov_{b}_{_HP[i]}, 0){minus}) / l_{j}_{j} AS l_{i}_{j}")
    return f"factor{tag} AS (SELECT *, {', '.join(columns)} FROM elite{tag})"


def _near_elite(source: str, tag: str = "") -> str:
    """``scored``: the rows of ``source`` with their Mahalanobis distance to the elite."""
    steps = []
    for i, c in enumerate(_HP):
        minus = "".join(f" - f.l_{i}_{j} * z{j}" for j in range(i))
        steps.append(f"(CAST(d.{c} AS DOUBLE) - f.mean_{c}{minus}) / f.l_{i}_{i} AS z{i}")
    total = " + ".join(f"z{i} * z{i}" for i in range(len(_HP)))
    return f"""{_factor(tag)},
scored{tag} AS (SELECT d.*, {', '.join(steps)}, CAST({total} AS DECIMAL(18,6)) AS distance
  FROM {source} d JOIN factor{tag} f USING (search_space_id))"""


def _elite_draws() -> str:
    values = []
    for i, c in enumerate(_HP):
        normal = "".join(f" + l_{i}_{j} * u{j}" for j in range(i + 1))
        values.append(f"ROUND(GREATEST(0::DOUBLE, LEAST(1::DOUBLE, mean_{c}{normal})), 6) AS {c}")
    normals = ", ".join(
        f"sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {_draw('key', 2 * i)})) * cos({2 * math.pi!r}::DOUBLE * {_draw('key', 2 * i + 1)}) AS u{i}"
        for i in range(len(_HP))
    )
    return f"""drawn AS (SELECT *, {normals} FROM (SELECT *, CAST(i AS INTEGER) AS candidate, concat(search_space_id, '_', i) AS key
  FROM factor, range(200) AS r(i)))
SELECT search_space_id, candidate, {', '.join(values)} FROM drawn"""


def _generations(count: int, size: int) -> str:
    """Three methods, generation by generation: each learns from its own trials."""
    order = {"random": "digest", "density_ratio": "density DESC", "elite": "distance"}

    def first(rows: str, by: str, g: int) -> str:
        return f"""SELECT search_space_id, {g} AS generation, CAST(place - 1 + {g * size} AS INTEGER) AS trial, run_id, val_accuracy, {', '.join(_HP)}
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY search_space_id ORDER BY {by}, run_id, val_accuracy DESC) AS place FROM {rows}) WHERE place <= {size}"""

    filled = ", ".join(f"COALESCE({c}, 0) AS {c}" for c in _HP)
    parts = [f"pool AS MATERIALIZED (SELECT run_id, search_space_id, val_accuracy, {filled}, md5(concat(run_id, ':42')) AS digest FROM runs)"]
    parts += [f"{m}_0 AS MATERIALIZED ({first('pool', 'digest', 0)})" for m in order]
    for g in range(1, count):
        for m, by in order.items():
            known, tag = f"{m}_{g - 1}", f"_{m}_{g}"
            rest = f"rest{tag}"
            parts.append(f"{rest} AS MATERIALIZED (SELECT * FROM pool p WHERE NOT EXISTS (SELECT 1 FROM {known} k WHERE k.search_space_id = p.search_space_id AND k.run_id = p.run_id))")
            ranked = rest
            if m == "density_ratio":
                parts.append(_density(known, rest, tag))
                ranked = f"dense{tag}"
            elif m == "elite":
                parts += [_elite(known, 10, tag), _near_elite(rest, tag)]
                ranked = f"scored{tag}"
            parts.append(f"{m}_{g} AS MATERIALIZED (SELECT * FROM {known} UNION ALL {first(ranked, by, g)})")
    return ",\n".join(parts)


def _replay() -> str:
    order = lambda *by: (
        f"CAST(ROW_NUMBER() OVER (PARTITION BY search_space_id ORDER BY {', '.join(by)}, run_id, val_accuracy DESC) - 1 AS INTEGER) AS trial"
    )
    row = "search_space_id, run_id, CAST(val_accuracy AS DOUBLE) AS value"
    return f"""{_halves()},
{_density()},
{_elite('history', 10)},
{_near_elite('dense')},
replay AS (SELECT * FROM (
    SELECT 'random' AS method, {row}, {order("md5(concat(run_id, ':42'))")} FROM scored
    UNION ALL SELECT 'density_ratio', {row}, {order('density DESC')} FROM scored
    UNION ALL SELECT 'elite', {row}, {order('distance')} FROM scored)
  WHERE trial < 200),
curves AS (SELECT *, GREATEST(0::DOUBLE, MAX(value) OVER (PARTITION BY search_space_id, method ORDER BY trial)) AS best
  FROM replay)"""


_SPEED = """CASE WHEN {t} > 0 THEN concat(((20 * {b} + {t}) // (2 * {t})) // 10, '.', ((20 * {b} + {t}) // (2 * {t})) % 10, 'x',
  CASE WHEN {t} < {b} THEN ' faster' WHEN {t} > {b} THEN ' slower' ELSE '' END) END"""

_EVENT_TRIALS = """trials AS (
  SELECT event_type, event_id, value,
    ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS trial,
    GREATEST(0::DOUBLE, MAX(value) OVER (PARTITION BY event_type ORDER BY ts, event_id
      ROWS UNBOUNDED PRECEDING)) AS best
  FROM events)"""


def _from_one(side: str) -> str:
    """Trials counted from 1 where either method hits at trial 0, which has no ratio."""
    return (
        f"({side}.trials_to_target + CASE WHEN s.trials_to_target = 0 OR b.trials_to_target = 0 THEN 1 ELSE 0 END)"
    )


def _to_target(base: int) -> str:
    return f"""reached AS (
  SELECT event_type, COUNT(*) AS n_trials,
    COALESCE(MIN(trial) FILTER (best >= 200) + {base}, COUNT(*)) AS trials_to_target,
    COUNT(*) FILTER (best >= 200) > 0 AS reached
  FROM trials GROUP BY event_type)"""


def _profile_columns() -> str:
    types = {
        **{c: "double" for c in _MEASURES}, "run_id": "string", "optimizer": "string",
    }
    return "\nUNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{types.get(c, 'int')}' AS data_type,"
        f" COUNT(*) AS n_rows, COUNT({c}) AS non_null FROM runs"
        for i, c in enumerate(_COLUMNS)
    )


def _frequency(column: str) -> str:
    return (
        f"(SELECT CAST({column} AS VARCHAR) AS label,"
        f" ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, CAST({column} AS VARCHAR)) - 1 AS idx FROM runs GROUP BY 1)"
    )


_FREQUENCY_JOINS = " ".join(
    f"JOIN {_frequency(c)} {t} ON {t}.label = CAST(r.{c} AS VARCHAR)"
    for c, t in (("optimizer", "o"), ("search_space_id", "s"), ("dataset_id", "d"))
)

_MATRIX = (
    _ON_RUNS
    + "SELECT run_id, search_space_id, dataset_id, CAST(val_accuracy AS DOUBLE) AS val_accuracy, optimizer, "
    + ", ".join(
        f"CAST({c} AS DOUBLE) AS f{i}_{c}"
        for i, c in enumerate(
            ["learning_rate", "batch_size", "dropout", "num_layers", "hidden_units", "weight_decay", "epochs"]
        )
    )
    + ", CAST(o.idx AS DOUBLE) AS f7_optimizer_idx, CAST(s.idx AS DOUBLE) AS f8_space_idx,"
    + f" CAST(d.idx AS DOUBLE) AS f9_dataset_idx FROM runs r {_FREQUENCY_JOINS}"
)


def _alphabetical(column: str) -> str:
    return f"(SELECT label, ROW_NUMBER() OVER (ORDER BY label) - 1 AS idx FROM (SELECT DISTINCT CAST({column} AS VARCHAR) AS label FROM runs))"


def _by(column: str) -> str:
    return (
        _ON_RUNS
        + f"SELECT {column}, {_mean('val_accuracy', 4)} AS avg_acc, COUNT(*) AS runs FROM runs GROUP BY {column}"
    )


def _scan(condition: str = "TRUE", columns: list[str] | None = None) -> str:
    return _ON_RUNS + f"SELECT {_out(*(columns or _COLUMNS))} FROM runs WHERE {condition}"


def _manifest_side(sign: str) -> str:
    return _ON_RUNS + (
        f"SELECT search_space_id, {_mean('val_accuracy', 4)} AS avg_acc, COUNT(*) AS runs FROM runs"
        f" WHERE dataset_id % 10 {sign} 0 GROUP BY search_space_id"
    )


def _variation() -> str:
    return _ON_RUNS + "\nUNION ALL ".join(
        f"SELECT search_space_id, '{c}' AS hp, ROUND(STDDEV_SAMP(CAST(COALESCE({c}, 0) AS DOUBLE)), 6) AS std,"
        f" MIN(COALESCE({c}, 0)) < MAX(COALESCE({c}, 0)) AS kept FROM runs GROUP BY search_space_id"
        for c in _HP
    )


def _blanked() -> str:
    columns = ", ".join(
        f"CASE WHEN MIN(COALESCE({c}, 0)) OVER w < MAX(COALESCE({c}, 0)) OVER w"
        f" THEN CAST(COALESCE({c}, 0) AS DOUBLE) END AS {c}"
        for c in _HP
    )
    return _ON_RUNS + f"SELECT run_id, {columns} FROM runs WINDOW w AS (PARTITION BY search_space_id)"


_GAPS = """runs AS (SELECT * REPLACE (CASE WHEN split_part(run_id, '_', 3) IN ('3', '5') THEN NULL ELSE val_accuracy END
  AS val_accuracy) FROM all_runs)"""


def _importance() -> str:
    strengths = ", ".join(
        f"ROUND(ABS(CORR(CAST(COALESCE({c}, 0) AS DOUBLE), CAST(val_accuracy AS DOUBLE))), 6) AS {c}" for c in _HP
    )
    rows = "\n  UNION ALL ".join(f"SELECT '{c}' AS hp, {c} / ({' + '.join(_HP)}) AS importance FROM strengths" for c in _HP)
    return _with(_RUNS, f"strengths AS (SELECT {strengths} FROM runs)", f"shares AS ({rows})") + """
SELECT hp, ROUND(importance, 6) AS importance, ROUND(SUM(importance) OVER w, 6) AS cumulative,
  SUM(importance) OVER w <= 0.8 AS within_line
FROM shares WINDOW w AS (ORDER BY importance DESC, hp ROWS UNBOUNDED PRECEDING)"""


_TOP = """CAST(ROW_NUMBER() OVER (PARTITION BY search_space_id
  ORDER BY val_accuracy DESC, run_id, learning_rate, weight_decay, epochs, dropout) AS INTEGER) AS rank"""

_TRANSFER_FILL = ", ".join(f"CAST(COALESCE({c}, 0) AS DOUBLE) AS {c}" for c in _HP)
_TRANSFER_GAP = " + ".join(f"(t.{c} - p.{c}) * (t.{c} - p.{c})" for c in _HP)


def oracle_sql() -> dict[str, str]:
    scan = _scan()
    profile_base = (_RUNS, _PROFILES)
    sql = {
        "scan_runs": scan,
        "scan_runs_csv": scan,
        "write_runs_csv": scan,
        "write_runs": scan,
        "register_runs": _ON_RUNS + "SELECT search_space_id, COUNT(*) AS runs FROM runs GROUP BY search_space_id",
        "runs_per_space": _ON_RUNS + "SELECT search_space_id, COUNT(*) AS runs FROM runs GROUP BY search_space_id",
        "flatten_nested_runs": _ON_RUNS + "SELECT " + _out("search_space_id", "dataset_id", "val_accuracy", *_HP) + " FROM runs",
        "nested_run_names": _ON_RUNS
        + "SELECT search_space_id, dataset_id, COUNT(*) AS runs, COUNT(*) AS names FROM runs GROUP BY ALL",
        "explode_split_manifest": _ON_RUNS
        + "SELECT DISTINCT search_space_id, dataset_id FROM runs",
        "split_by_manifest": _ON_RUNS
        + f"SELECT search_space_id, {_mean('val_accuracy', 4)} AS avg_acc, COUNT(*) AS runs,"
        " CASE WHEN dataset_id % 10 = 0 THEN 'test' ELSE 'train' END AS part FROM runs GROUP BY search_space_id, part",
        "manifest_test_runs": _manifest_side("="),
        "manifest_train_runs": _manifest_side("<>"),
        "log_run": _with(_RUNS, _BY_SPACE)
        + "\nUNION ALL ".join(
            f"SELECT CAST(search_space_id AS VARCHAR) AS run_id, 'space_summary' AS run_name, '{kind}' AS kind,"
            f" '{key}' AS key, {text} AS value_str, {number} AS value_num FROM by_space"
            for kind, key, text, number in (
                ("param", "search_space", "CAST(search_space_id AS VARCHAR)", "CAST(NULL AS DOUBLE)"),
                ("metric", "avg_acc", "NULL", "avg_acc"),
                ("metric", "best_acc", "NULL", "best_acc"),
                ("metric", "runs", "NULL", "CAST(runs AS DOUBLE)"),
                ("artifact", "table", "'space_summary.parquet'", "NULL"),
            )
        ),
        "search_runs": "SELECT CAST(user_id AS VARCHAR) AS run_id, concat('user ', user_id) AS run_name,"
        " CASE WHEN SUM(n) OVER w % 2 = 0 THEN 'FINISHED' ELSE 'RUNNING' END AS status,"
        " strftime(MIN(start) OVER w, '%Y-%m-%d %H:%M:%S') AS start_time, CAST(SUM(n) OVER w AS VARCHAR) AS events,"
        " event_type AS key, value FROM (SELECT user_id, event_type, COUNT(*) AS n, MIN(ts) AS start,"
        " arg_max(value, (ts, value)) AS value FROM events GROUP BY user_id, event_type) WINDOW w AS (PARTITION BY user_id)",
        "drop_all_null_rows": "SELECT CAST(user_id AS VARCHAR) AS run_id,"
        " arg_max(value, (ts, value)) FILTER (event_type = 'click') AS \"metrics.click\","
        " arg_max(value, (ts, value)) FILTER (event_type = 'error') AS \"metrics.error\""
        " FROM events WHERE event_type IN ('click', 'error') GROUP BY user_id",
        "profile_table": _ON_RUNS + _profile_columns(),
        "feature_matrix": _MATRIX,
        "save_feature_matrix": _MATRIX,
        # projections and filters
        "project_runs": _ON_RUNS
        + "SELECT run_id AS run, search_space_id AS space, CAST(val_accuracy AS DOUBLE) AS accuracy FROM runs",
        "filter_space": _scan("search_space_id = 6", ["run_id", "dataset_id", "val_accuracy"]),
        "filter_top_accuracy": _scan("val_accuracy >= 0.95", ["run_id", "search_space_id", "val_accuracy"]),
        "exclude_target_space": _scan("search_space_id <> 6", ["run_id", "search_space_id"]),
        "lr_bands": _ON_RUNS
        + "SELECT run_id, CAST(learning_rate AS DOUBLE) AS learning_rate, CASE WHEN learning_rate < 0.001 THEN 'low'"
        " WHEN learning_rate < 0.01 THEN 'medium' ELSE 'high' END AS lr_range FROM runs",
        "fill_missing_hp": _ON_RUNS + f"SELECT run_id, {_zero(*_HP)} FROM runs",
        "select_hp_columns": _scan(columns=["run_id", *_HP]),
        "hp_variation": _variation(),
        "drop_constant_hp": _blanked(),
        "top_runs_with_gaps": _with(_RUNS.replace("runs AS", "all_runs AS", 1), _GAPS)
        + f"SELECT search_space_id, rank, run_id, CAST(val_accuracy AS DOUBLE) AS val_accuracy FROM (SELECT *, {_TOP} FROM runs"
        " WHERE val_accuracy IS NOT NULL) WHERE rank <= 3",
        "space_summary_with_gaps": _with(_RUNS.replace("runs AS", "all_runs AS", 1), _GAPS, _BY_SPACE) + "SELECT * FROM by_space",
        "trials_to_target_with_gaps": _with(
            _EVENT_TRIALS.replace("event_id, value,", "event_id, CASE WHEN event_id % 3 <> 0 THEN value END AS value,").replace("MAX(value)", "MAX(CASE WHEN event_id % 3 <> 0 THEN value END)"),
            _to_target(0),
        )
        + "SELECT * FROM reached",
        "accuracy_gain": _with(_RUNS, _BY_SPACE)
        + "SELECT search_space_id, best_acc, avg_acc, (best_acc - avg_acc) / avg_acc * 100 AS gain_pct,"
        " (best_acc - avg_acc) / best_acc * 100 AS gap_pct FROM by_space",
        "metric_names": "SELECT DISTINCT 'Best Value ' || upper(left(event_type, 1)) || substr(event_type, 2) AS label,"
        " 'best_value_' || event_type AS metric_key,"
        " 'Best Value ' || upper(left(event_type, 1)) || substr(event_type, 2) AS title FROM events",
        # summaries
        "dataset_profiles": _with(*profile_base) + "SELECT * FROM profiles",
        "top_config_profile": _with(_RUNS, _top_configs()) + "SELECT * FROM top_configs",
        "space_optimizer_summary": _ON_RUNS
        + f"SELECT search_space_id, optimizer, {_mean('val_accuracy', 4)} AS avg_acc, {_mean('learning_rate', 6)} AS avg_lr,"
        f" {_mean('dropout', 4)} AS avg_dropout, COUNT(*) AS runs FROM runs GROUP BY search_space_id, optimizer"
        " ORDER BY avg_acc DESC, search_space_id, optimizer LIMIT 15",
        "space_summary": _with(_RUNS, _BY_SPACE) + "SELECT * FROM by_space",
        "space_by_accuracy": _with(_RUNS, _BY_SPACE) + "SELECT * FROM by_space",
        "largest_spaces": _with(_RUNS, _BY_SPACE) + "SELECT * FROM by_space ORDER BY runs DESC, search_space_id LIMIT 10",
        "batch_size_summary": _by("batch_size"),
        "optimizer_summary": _by("optimizer"),
        "dataset_distribution": _by("dataset_id") + " ORDER BY runs DESC, dataset_id LIMIT 20",
        "lr_band_summary": _ON_RUNS
        + "SELECT CASE WHEN learning_rate < 0.001 THEN 'low' WHEN learning_rate < 0.01 THEN 'medium' ELSE 'high' END AS lr_range,"
        f" {_mean('val_accuracy', 4)} AS avg_acc, COUNT(*) AS count FROM runs GROUP BY lr_range",
        "global_accuracy": _ON_RUNS
        + f"SELECT {_mean('val_accuracy', 4)} AS avg_acc, {_max('val_accuracy')} AS best_acc, COUNT(*) AS runs FROM runs",
        "space_accuracy": _ON_RUNS
        + f"SELECT {_mean('val_accuracy', 4)} AS avg_acc, {_max('val_accuracy')} AS best_acc, COUNT(*) AS runs"
        " FROM runs WHERE search_space_id = 6",
        "distinct_counts": _ON_RUNS
        + "SELECT COUNT(*) AS runs, COUNT(DISTINCT search_space_id) AS spaces, COUNT(DISTINCT dataset_id) AS datasets FROM runs",
        "list_spaces": _ON_RUNS + "SELECT DISTINCT search_space_id FROM runs",
        "accuracy_heatmap": _ON_RUNS
        + "SELECT LEAST(CAST(floor(hp_0 * 30) AS INTEGER), 29) AS x_bin, LEAST(CAST(floor(hp_3 * 30) AS INTEGER), 29) AS y_bin,"
        f" {_mean('val_accuracy', 4)} AS avg_acc, COUNT(*) AS runs FROM runs WHERE search_space_id = 6 GROUP BY x_bin, y_bin",
        "datasets_per_space": _with(*profile_base)
        + f"SELECT search_space_id, COUNT(*) AS datasets, {_mean('CAST(avg_acc AS DECIMAL(18,6))', 4)} AS mean_acc"
        " FROM profiles WHERE search_space_id IN (2, 4, 6) GROUP BY search_space_id",
        "run_status_counts": "SELECT COUNT(*) AS total, COUNT(*) FILTER (o_orderstatus = 'F') AS finished FROM orders",
        # running values and rankings
        "best_so_far": _with(_EVENT_TRIALS) + "SELECT event_type, event_id, trial, value, best FROM trials",
        "trials_to_target": _with(_EVENT_TRIALS, _to_target(0)) + "SELECT * FROM reached",
        "trials_to_target_from_one": _with(_EVENT_TRIALS, _to_target(1)) + "SELECT * FROM reached",
        "speed_ratio": _with(_EVENT_TRIALS, _to_target(1))
        + f"SELECT event_type, trials_to_target, {_SPEED.format(t='trials_to_target', b='base')} AS speed FROM reached,"
        " (SELECT trials_to_target AS base FROM reached WHERE event_type = 'view')",
        "daily_growth": "SELECT CAST(day AS VARCHAR) AS day, records, CAST(SUM(records) OVER (ORDER BY day) AS BIGINT) AS total_records"
        " FROM (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS records FROM events GROUP BY day)",
        "cumulative_importance": _importance(),
        "top_runs_per_space": _with(_RUNS)
        + f"SELECT search_space_id, rank, run_id, CAST(val_accuracy AS DOUBLE) AS val_accuracy FROM (SELECT *, {_TOP} FROM runs)"
        " WHERE rank <= 3",
        "warm_start_pool": _with(_RUNS)
        + f"SELECT rank, {_out('search_space_id', 'run_id', 'val_accuracy', 'learning_rate', 'batch_size', 'dropout', 'num_layers', 'hidden_units', 'weight_decay', 'epochs', 'optimizer')}"
        f" FROM (SELECT *, {_TOP} FROM runs WHERE search_space_id IN (SELECT DISTINCT search_space_id FROM runs"
        " WHERE search_space_id <> 6 ORDER BY 1 LIMIT 3)) WHERE rank <= 3",
        # neighbours
        "cosine_pairs": _with(*profile_base, _VECTORS)
        + f"SELECT CAST(a.position AS INTEGER) AS query, b.search_space_id, b.dataset_id, ROUND({_cosine('a', 'b')}, 6) AS similarity"
        " FROM vectors a, vectors b WHERE a.position IN (0, 10, 50)",
        "similarity_matrix": _with(*profile_base, _VECTORS)
        + f"SELECT CAST(a.position AS INTEGER) AS \"row\", CAST(b.position AS INTEGER) AS \"column\", ROUND({_cosine('a', 'b')}, 6) AS similarity"
        " FROM vectors a, vectors b WHERE a.position < 20 AND b.position < 20",
        "nearest_profiles": _with(*profile_base, _VECTORS, _near(3)) + _NEAR_OUT,
        "nearest_other_datasets": _with(*profile_base, _VECTORS, _near(3, "a.dataset_id <> b.dataset_id")) + _NEAR_OUT,
        "neighbour_configs": _with(*profile_base, _top_configs("0.98"), _VECTORS, _near(3))
        + "SELECT n.search_space_id, n.dataset_id, rank, similar_search_space_id, similar_dataset_id,"
        " best_hp0 AS recommended_hp0, best_hp1 AS recommended_hp1, best_hp2 AS recommended_hp2, best_hp3 AS recommended_hp3"
        " FROM near n JOIN top_configs t ON t.search_space_id = n.similar_search_space_id",
        "recommend_configs": _with(*profile_base, _top_configs(), _VECTORS, _near(3), _RECOMMENDED)
        + "SELECT * FROM recommended",
        "hit_rate": _hit_rate("0.95"),
        "hit_rate_strict": _hit_rate("0.99"),
        # features
        "encode_alphabetical": _ON_RUNS
        + "SELECT run_id, optimizer, CAST(o.idx AS INTEGER) AS optimizer_enc, search_space_id, CAST(s.idx AS INTEGER) AS space_enc"
        f" FROM runs r JOIN {_alphabetical('optimizer')} o ON o.label = r.optimizer"
        f" JOIN {_alphabetical('search_space_id')} s ON s.label = CAST(r.search_space_id AS VARCHAR)",
        "encode_by_frequency": _ON_RUNS
        + "SELECT run_id, optimizer, search_space_id, dataset_id, CAST(o.idx AS INTEGER) AS optimizer_idx,"
        f" CAST(s.idx AS INTEGER) AS space_idx, CAST(d.idx AS INTEGER) AS dataset_idx FROM runs r {_FREQUENCY_JOINS}",
        "decode_labels": _ON_RUNS
        + f"SELECT run_id, CAST(o.idx AS INTEGER) AS code, optimizer FROM runs r JOIN {_alphabetical('optimizer')} o ON o.label = r.optimizer",
        "split_runs": _ON_RUNS
        + "SELECT run_id, search_space_id, CASE WHEN md5(run_id) < 'cccc' THEN 'train' ELSE 'test' END AS part FROM runs",
        "surrogate_r2": _with(
            _RUNS,
            f"means AS (SELECT epochs, {_mean('val_accuracy', 6)} AS p FROM runs WHERE md5(run_id) < 'cccc' GROUP BY epochs)",
            "test AS (SELECT CAST(val_accuracy AS DOUBLE) AS y, p FROM runs JOIN means USING (epochs) WHERE md5(run_id) >= 'cccc')",
        )
        + "SELECT COUNT(*) AS rows, ROUND(1 - SUM((y - p) * (y - p)) / (VAR_POP(y) * COUNT(*)), 6) AS r2 FROM test",
        "space_surrogate_bounds": _ON_RUNS
        + "SELECT search_space_id, COUNT(*) AS rows, TRUE AS r2_from_099 FROM runs GROUP BY search_space_id",
        "space_top_hp": _with(_RUNS, _HP_LONG)
        + "SELECT search_space_id, hp, rank FROM (SELECT search_space_id, hp, ROW_NUMBER() OVER (PARTITION BY search_space_id"
        " ORDER BY SUM(s * s / n) DESC, hp) AS rank FROM (SELECT search_space_id, hp, v, SUM(y) AS s, COUNT(*) AS n FROM long GROUP BY ALL)"
        " GROUP BY search_space_id, hp) WHERE rank <= 2",
        "space_first_splits": _with(
            _RUNS,
            _HP_LONG,
            "cells AS (SELECT search_space_id, hp, v, COUNT(*) AS n, SUM(y) AS s FROM long GROUP BY ALL)",
            "cuts AS (SELECT search_space_id, hp, v, LEAD(v) OVER one AS next, SUM(n) OVER one AS ln, SUM(s) OVER one AS ls,"
            " SUM(n) OVER every AS n, SUM(s) OVER every AS s FROM cells"
            " WINDOW one AS (PARTITION BY search_space_id, hp ORDER BY v), every AS (PARTITION BY search_space_id, hp))",
            "gains AS (SELECT *, ls * ls / ln + (s - ls) * (s - ls) / (n - ln) - s * s / n AS gain FROM cuts WHERE next IS NOT NULL)",
        )
        + "SELECT search_space_id, hp, ROUND((v + next) / 2, 6) AS threshold, ROUND(gain, 4) AS gain FROM gains"
        " QUALIFY ROW_NUMBER() OVER (PARTITION BY search_space_id ORDER BY gain DESC, hp, v) = 1",
        # search
        "random_candidates": f"WITH {_SPACE_CANDIDATES}\nSELECT search_space_id, candidate, "
        + ", ".join(f"{_draw('key', i)} AS {c}" for i, c in enumerate(_HP)) + " FROM candidates",
        "random_settings": f"WITH {_SPACE_CANDIDATES}\nSELECT search_space_id, candidate, "
        + ", ".join(
            f"{e} AS {name}"
            for name, e in {
                "learning_rate": _log_between(_draw("key", 0), "0.00001", "0.1"),
                "batch_size": _pick(_draw("key", 1), _BATCHES),
                "dropout": _between(_draw("key", 2), 0.0, 0.5),
                "num_layers": _whole(_draw("key", 3), 1, 6),
                "hidden_units": _pick(_draw("key", 4), _UNITS),
                "weight_decay": _log_between(_draw("key", 5), "0.000001", "0.01"),
                "epochs": _whole(_draw("key", 6), 10, 201),
                "optimizer": _pick(_draw("key", 7), _OPTIMIZERS),
            }.items()
        )
        + " FROM candidates",
        "density_ratio_rank": _with(_RUNS, _halves(), _density())
        + "SELECT search_space_id, rank, run_id, CAST(density AS DOUBLE) AS density FROM (SELECT *, CAST(ROW_NUMBER() OVER"
        " (PARTITION BY search_space_id ORDER BY density DESC, run_id) AS INTEGER) AS rank FROM dense) WHERE rank <= 200",
        "elite_profile": _with(
            _RUNS,
            "filled AS (SELECT run_id, search_space_id, val_accuracy, "
            + ", ".join(f"COALESCE({c}, 0) AS {c}" for c in _HP) + " FROM runs)",
            _elite("filled", 10, digits=6),
        )
        + "SELECT * FROM elite",
        "elite_rank": _with(_RUNS, _halves(), _elite("history", 10), _near_elite("heldout"))
        + "SELECT search_space_id, rank, run_id, CAST(distance AS DOUBLE) AS distance FROM (SELECT *, CAST(ROW_NUMBER() OVER"
        " (PARTITION BY search_space_id ORDER BY distance, run_id, val_accuracy DESC) AS INTEGER) AS rank FROM scored) WHERE rank <= 200",
        "elite_draws": _with(
            _RUNS,
            "filled AS (SELECT run_id, search_space_id, val_accuracy, "
            + ", ".join(f"COALESCE({c}, 0) AS {c}" for c in _HP) + " FROM runs)",
            _elite("filled", 10),
            _factor(),
            _elite_draws(),
        ),
        "replay_generations": _with(_RUNS, _generations(3, 50))
        + "\nUNION ALL ".join(
            f"SELECT search_space_id, '{m}' AS method, generation, trial, run_id, CAST(val_accuracy AS DOUBLE) AS value FROM {m}_2"
            for m in ("random", "density_ratio", "elite")
        ),
        "regret_curves": _with(_RUNS, _replay())
        + "SELECT search_space_id, method, trial, run_id, value, best FROM curves",
        "compare_methods": _with(
            _RUNS,
            _replay(),
            "summary AS (SELECT search_space_id, method, COUNT(*) AS n_trials, MAX(value) AS best,"
            " COALESCE(MIN(trial) FILTER (curves.best >= 0.90), COUNT(*)) AS trials_to_target"
            " FROM curves GROUP BY search_space_id, method)",
        )
        + "SELECT s.search_space_id, s.method, s.n_trials, s.best, s.trials_to_target, (s.best - b.best) / b.best * 100 AS gain_pct, "
        + _SPEED.format(t=_from_one("s"), b=_from_one("b"))
        + " AS speed FROM summary s JOIN summary b ON b.search_space_id = s.search_space_id AND b.method = 'random'",
        "transfer_gain": _with(
            _RUNS,
            f"pool AS (SELECT {_TRANSFER_FILL} FROM (SELECT *, {_TOP} FROM runs WHERE search_space_id IN"
            " (SELECT DISTINCT search_space_id FROM runs WHERE search_space_id <> 6 ORDER BY 1 LIMIT 3)) WHERE rank <= 3)",
            f"target AS (SELECT run_id, CAST(val_accuracy AS DOUBLE) AS val_accuracy, {_TRANSFER_FILL} FROM runs WHERE search_space_id = 6)",
            f"placed AS (SELECT t.run_id, t.val_accuracy, CAST(MIN({_TRANSFER_GAP}) AS DECIMAL(18,6)) AS distance"
            " FROM target t, pool p GROUP BY ALL)",
            "ordered AS (SELECT *, ROW_NUMBER() OVER (ORDER BY md5(concat(run_id, ':42')), run_id, val_accuracy DESC) AS cold,"
            " ROW_NUMBER() OVER (ORDER BY distance, run_id, val_accuracy DESC) AS warm FROM placed)",
            "result AS (SELECT 6 AS target_space, COUNT(*) FILTER (cold <= 100) AS n_trials,"
            " MAX(val_accuracy) FILTER (cold <= 100) AS cold_best, MAX(val_accuracy) FILTER (warm <= 100) AS warm_best FROM ordered)",
        )
        + "SELECT *, (warm_best - cold_best) / cold_best * 100 AS gain_pct FROM result",
        # streaming
        "live_best": _with(_EVENT_TRIALS) + "SELECT event_type, event_id, trial, best FROM trials",
        "live_target": _with(_EVENT_TRIALS, _to_target(0)) + "SELECT * FROM reached",
        "live_progress": "SELECT CAST(date_trunc('day', ts)::TIMESTAMP AS VARCHAR) AS window_start, event_type, COUNT(*) AS trials, MAX(value) AS best"
        " FROM events GROUP BY ALL",
    }
    return sql

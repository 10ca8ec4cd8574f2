"""DuckDB twins of the linear models: the same objectives solved in SQL.

Moments are sums of products per group of rows; the elastic net's support
and signs come from sweeps of coordinate descent (a recursive query), the
coefficients from Gauss-Jordan elimination over the support (another one,
a column each step; columns that depend on earlier ones get 0). Both are
repeated from where they ended, as sweeps alone are slow where columns
nearly depend on each other.
"""

from __future__ import annotations

from demandspark import schema as S
from demandspark.plans import run_views as RV
from demandspark.plans import sql as Q

P = len(S.FEATURES)
STAGES, SWEEPS = 4, 1500
FEATURE_LIST = "[" + ", ".join(f"CAST({f} AS DOUBLE)" for f in S.FEATURES) + "]"


def _table(group: str, source: str = "split", where: str = "true") -> str:
    """``base`` (obs_id, y, split if there is one, x, g) with the features and their group, and ``part``: the groups' moments about the common means."""
    n = P + 1
    sums = ", ".join(f"sum(z[{i}]) AS s{i}" for i in range(1, n + 1))
    products = ", ".join(f"sum(z[{i}] * z[{j}]) AS p{i}_{j}" for i in range(1, n + 1) for j in range(i, n + 1))
    flat = ", ".join(f"p{min(i, j)}_{max(i, j)}" for i in range(1, n + 1) for j in range(1, n + 1))
    return f"""{Q.feat_cte(source, "fs")},
base AS MATERIALIZED (SELECT *, {group} AS g, {FEATURE_LIST} AS x, CAST({S.LABEL} AS DOUBLE) AS y FROM fs WHERE {where}),
mu AS MATERIALIZED (SELECT [{", ".join(f"avg(x[{i}])" for i in range(1, P + 1))}, avg(y)] AS m FROM base),
zs AS (SELECT g, list_transform(list_append(x, y), lambda v, i: v - m[i]) AS z FROM base, mu),
sums AS (SELECT g, count(*) AS n, {sums}, {products} FROM zs GROUP BY g),
part AS MATERIALIZED (SELECT g, n, [{", ".join(f"s{i}" for i in range(1, n + 1))}] AS s, [{flat}] AS p FROM sums)"""


def _stage(k: int) -> str:
    """From a start to ``found{k}`` (id, v): sweeps of coordinate descent, then the equations of the support they leave."""
    n, pivot = P + 1, "(m[k])[k]"
    start = "list_transform(b, lambda v: CAST(0 AS DOUBLE))" if k == 1 else "v"
    source = "system WHERE l1 > 0" if k == 1 else f"found{k - 1} JOIN system USING (id) WHERE l1 > 0"
    return f"""sweeps{k} AS (
  SELECT id, 0 AS k, {start} AS w FROM {source}
  UNION ALL
  SELECT id, k + 1, list_reduce(list_concat([w], rows), lambda v, x: CASE WHEN x[{P + 2}] + x[{P + 5}] = 0 THEN v ELSE list_concat(v[1:CAST(x[{P + 3}] AS BIGINT) - 1],
    [greatest(abs(x[{P + 1}] - list_dot_product(x[1:{P}], v) + x[{P + 2}] * v[CAST(x[{P + 3}] AS BIGINT)]) - x[{P + 4}], 0)
     * sign(x[{P + 1}] - list_dot_product(x[1:{P}], v) + x[{P + 2}] * v[CAST(x[{P + 3}] AS BIGINT)]) / (x[{P + 2}] + x[{P + 5}])],
    v[CAST(x[{P + 3}] AS BIGINT) + 1:]) END)
  FROM sweeps{k} JOIN steps USING (id) WHERE k < {SWEEPS}),
signs{k} AS MATERIALIZED (SELECT system.*, COALESCE(w, list_transform(b, lambda v: CAST(1 AS DOUBLE))) AS v FROM system LEFT JOIN (SELECT id, w FROM sweeps{k} WHERE k = {SWEEPS}) USING (id)),
elimination{k} AS (
  SELECT id, 1 AS k, list_transform(range(1, {n}), lambda i: list_append(list_transform(range(1, {n}), lambda j: CASE WHEN v[i] = 0 OR v[j] = 0 THEN CAST(0 AS DOUBLE)
    ELSE (a[i])[j] + CASE WHEN i = j THEN l2 ELSE 0 END END), CASE WHEN v[i] = 0 THEN 0 ELSE b[i] - l1 * sign(v[i]) END)) AS m FROM signs{k}
  UNION ALL
  SELECT id, k + 1, CASE WHEN {pivot} < 1e-9 THEN m ELSE list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda e: e / {pivot})
    ELSE list_transform(r, lambda e, j: e - r[k] * (m[k])[j] / {pivot}) END) END
  FROM elimination{k} WHERE k <= {P}),
found{k} AS MATERIALIZED (SELECT id, list_transform(m, lambda r, i: CASE WHEN abs(r[i] - 1) < 0.5 THEN r[{n}] ELSE 0 END) AS v FROM elimination{k} WHERE k = {n})"""


def _solved() -> str:
    """From ``task`` (id, n, s, p, l1, l2) to ``model`` (id, intercept, w)."""
    n = P + 1
    c = f"(p[(i - 1) * {n} + j] - s[i] * s[j] / n)"
    cy = f"(p[(i - 1) * {n} + {n}] - s[i] * s[{n}] / n)"
    stages = ",\n".join(_stage(k) for k in range(1, STAGES + 1))
    return f"""scaled AS (SELECT *, list_transform(range(1, {n}), lambda i: CASE WHEN p[(i - 1) * {n} + i] - s[i] * s[i] / n <= 1e-14 * p[(i - 1) * {n} + i] THEN 0
  ELSE sqrt((p[(i - 1) * {n} + i] - s[i] * s[i] / n) / n) END) AS sd FROM task),
system AS MATERIALIZED (SELECT id, n, s, sd, l1, l2,
  list_transform(range(1, {n}), lambda i: list_transform(range(1, {n}), lambda j: CASE WHEN sd[i] = 0 OR sd[j] = 0 THEN CAST(0 AS DOUBLE) ELSE {c} / (sd[i] * sd[j] * n) END)) AS a,
  list_transform(range(1, {n}), lambda i: CASE WHEN sd[i] = 0 THEN CAST(0 AS DOUBLE) ELSE {cy} / (sd[i] * n) END) AS b FROM scaled),
-- a coordinate's row: its products, b, diagonal, number, l1, l2
steps AS MATERIALIZED (SELECT id, list_transform(range(1, {n}), lambda j: list_concat(a[j], [b[j], (a[j])[j], CAST(j AS DOUBLE), l1, l2])) AS rows FROM system WHERE l1 > 0),
{stages},
raw AS (SELECT id, n, s, list_transform(v, lambda c, i: CASE WHEN sd[i] = 0 THEN 0 ELSE c / sd[i] END) AS w FROM found{STAGES} JOIN system USING (id)),
model AS MATERIALIZED (SELECT id, w, m[{n}] + s[{n}] / n - list_dot_product(w, list_transform(w, lambda c, i: m[i] + s[i] / n)) AS intercept FROM raw, mu)"""


def _spec(spec, n: str = "n") -> str:
    l1, l2 = spec.alpha * spec.l1_ratio, spec.alpha * (1 - spec.l1_ratio)
    return f"CAST({l1!r} AS DOUBLE) AS l1, " + (f"CAST({spec.alpha!r} AS DOUBLE) / {n} AS l2" if spec.kind == "ridge" else f"CAST({l2!r} AS DOUBLE) AS l2")


def _rounded(names: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in names)


def results_sql(name: str, spec, search: str | None = None) -> str:
    """Train and test metrics of one model fitted on the train rows (of the settings that ``search`` finds, if given)."""
    if search is None:
        head = f"{_table('split')},\ntask AS (SELECT 0 AS id, n, s, p, {_spec(spec)} FROM part WHERE g = 'train'),\n{_solved()}"
    else:
        # the winner's draw is found first, under names of its own
        head = f"won AS MATERIALIZED ({search}),\n{_table('split')},\ntask AS (SELECT 0 AS id, n, s, p, l1, l2 FROM part, won WHERE g = 'train'),\n{_solved()}"
    metrics = [f"{s}_{m}" for s in ("train", "test") for m in ("r2", "rmse", "mae", "mape")]
    return f"""WITH RECURSIVE {Q.DEMAND},
{RV.SPLIT},
{head},
cl AS (SELECT '{name}' AS model_name, split, {S.LABEL}, intercept + list_dot_product(w, x) AS yhat FROM base, model),
mt AS (SELECT model_name, {RV._metric_sql('train')}, {RV._metric_sql('test')} FROM cl GROUP BY model_name)
SELECT model_name, {_rounded(metrics)}, round(train_rmse - test_rmse, 6) AS overfit_score, 'run-' || lower(translate(model_name, ' -', '__')) AS run_id FROM mt"""


def _draws(draws: list[dict]) -> str:
    rows = ", ".join(f"({k}, CAST({d['alpha']!r} AS DOUBLE), CAST({d['l1_ratio']!r} AS DOUBLE))" for k, d in enumerate(draws, 1))
    return f"draws(trial, alpha, l1_ratio) AS (VALUES {rows})"


def _fold(source: str, k: int) -> str:
    return f"CAST(floor((row_number() OVER (ORDER BY obs_id) - 1) * {k} / count(*) OVER ()) AS INTEGER) AS fold FROM {source}"


def _others() -> str:
    """Each fold's training moments: all others'."""
    return """others AS MATERIALIZED (SELECT a.g AS fold, CAST(sum(b.n) AS BIGINT) AS n, list(b.s) AS ss, list(b.p) AS ps FROM part a JOIN part b ON a.g <> b.g GROUP BY a.g),
trained AS MATERIALIZED (SELECT fold, n, list_transform(ss[1], lambda v, i: list_sum(list_transform(ss, lambda s: s[i]))) AS s, list_transform(ps[1], lambda v, i: list_sum(list_transform(ps, lambda s: s[i]))) AS p FROM others)"""


def _search(draws: list[dict], folds: int) -> str:
    return f"""{_draws(draws)},
folded AS (SELECT *, {_fold("split WHERE split = 'train'", folds)}),
{_table('fold', 'folded')},
{_others()},
task AS (SELECT (trial - 1) * {folds} + fold AS id, n, s, p, alpha * l1_ratio AS l1, alpha * (1 - l1_ratio) AS l2 FROM trained, draws),
{_solved()},
errors AS (SELECT id // {folds} + 1 AS trial, avg((y - intercept - list_dot_product(w, x)) * (y - intercept - list_dot_product(w, x))) AS mse FROM model JOIN base ON id % {folds} = g GROUP BY id),
trials AS (SELECT trial, alpha, l1_ratio, avg(mse) AS loss FROM errors JOIN draws USING (trial) GROUP BY ALL)"""


def random_search_sql(draws: list[dict], folds: int) -> str:
    return f"""WITH RECURSIVE {Q.DEMAND},
{RV.SPLIT},
{_search(draws, folds)}
SELECT CAST(trial AS INTEGER) AS trial, round(alpha, 6) AS alpha, round(l1_ratio, 6) AS l1_ratio, round(loss, 1) AS loss,
  round((SELECT arg_min(alpha, loss) FROM trials), 6) AS best_alpha, round((SELECT arg_min(l1_ratio, loss) FROM trials), 6) AS best_l1_ratio FROM trials"""


def best_of_random(draws: list[dict], folds: int) -> str:
    """l1 and l2 of the random search's winner (to stand inside a query that has demand and split)."""
    return f"WITH RECURSIVE {_search(draws, folds)} SELECT arg_min(alpha * l1_ratio, loss) AS l1, arg_min(alpha * (1 - l1_ratio), loss) AS l2 FROM trials"


def continuous_search_sql(draws: list[dict]) -> str:
    return f"""WITH RECURSIVE {Q.DEMAND},
{RV.SPLIT},
{_draws(draws)},
{_table('split')},
task AS (SELECT trial AS id, n, s, p, alpha * l1_ratio AS l1, alpha * (1 - l1_ratio) AS l2 FROM part, draws WHERE g = 'train'),
{_solved()}
SELECT CAST(trial AS INTEGER) AS trial, round(any_value(alpha), 6) AS alpha, round(any_value(l1_ratio), 6) AS l1_ratio,
  round(sqrt(avg((y - intercept - list_dot_product(w, x)) * (y - intercept - list_dot_product(w, x)))), 6) AS loss
FROM model JOIN draws ON id = trial JOIN base ON g = 'val' GROUP BY trial"""


def cross_validated_sql(specs: dict, folds: int) -> str:
    names = list(specs)
    tasks = "\nUNION ALL\n".join(f"SELECT {k * folds} + fold AS id, n, s, p, {_spec(specs[m])} FROM trained" for k, m in enumerate(names))
    name = "CASE id // {f} {c} END".format(f=folds, c=" ".join(f"WHEN {k} THEN '{m}'" for k, m in enumerate(names)))
    return f"""WITH RECURSIVE {Q.DEMAND},
folded AS (SELECT *, {_fold("demand", folds)}),
{_table('fold', 'folded')},
{_others()},
task AS ({tasks}),
{_solved()},
errors AS (SELECT {name} AS model_name, sqrt(avg((y - intercept - list_dot_product(w, x)) * (y - intercept - list_dot_product(w, x)))) AS rmse FROM model JOIN base ON id % {folds} = g GROUP BY id)
SELECT model_name, round(avg(rmse), 6) AS cv_rmse_mean, round(stddev_pop(rmse), 6) AS cv_rmse_std, round(min(rmse), 6) AS cv_rmse_min, round(max(rmse), 6) AS cv_rmse_max,
  count(*) AS folds FROM errors GROUP BY model_name"""

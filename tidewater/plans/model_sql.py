"""SQL that solves the linear models and principal components of the queries by other means.

Least squares with a penalty depend on the data through means, deviations and correlations alone, so
SQL takes those from the training rows and descends on one coefficient after the other until
nothing moves. Logistic regression takes Newton steps with a fixed matrix that no Hessian exceeds.
Principal components come from squaring the covariance matrix again and again.
"""

from __future__ import annotations

from collections.abc import Sequence

SWEEPS = 1500
SQUARINGS = 18
INVERSIONS = 24
STEPS = 250


def md5_bucket(text: str, buckets: int) -> str:
    return f"CAST(('0x' || substr(md5({text}), 1, 7)) AS BIGINT) % {buckets}"


def penalised_fit(models: dict[str, tuple[float, float]], parts: int = 1, inputs: int = 4) -> str:
    """CTEs that end in ``errors`` (model, part, y, z): labels and predictions of rows held out.

    They follow a CTE ``data`` (x1 .. xn, y, fold). Part p is fitted on the rows of all other folds
    and judged on those of fold p. ``models`` holds the penalty and the share of its absolute part;
    it applies to coefficients of scaled inputs and label.
    """
    xs = range(1, inputs + 1)
    pairs = [(i, j) for i in xs for j in xs if i < j]
    stats = [f"avg(x{i}) AS m{i}, stddev_pop(x{i}) AS s{i}, corr(x{i}, y) AS c{i}" for i in xs]
    stats += [f"corr(x{i}, x{j}) AS r{i}_{j}" for i, j in pairs]

    def step(i: int) -> str:
        others = "".join(f" - r{min(i, j)}_{max(i, j)} * {'n' if j < i else 'w'}{j}" for j in xs if j != i)
        return (f"c{i}{others} AS z{i}, "
                f"sign(z{i}) * greatest(abs(z{i}) - absolute, 0) / (1 + squared) AS n{i}")

    values = ", ".join(f"('{name}', {reg}::DOUBLE, {share}::DOUBLE)" for name, (reg, share) in models.items())
    return f"""
    stats AS (SELECT part, avg(y) AS my, stddev_pop(y) AS sy, {', '.join(stats)}
              FROM data, range({parts}) p(part) WHERE fold <> part GROUP BY part),
    systems AS (SELECT model, reg / sy * share AS absolute, reg / sy * (1 - share) AS squared, stats.*
                FROM stats, (VALUES {values}) m(model, reg, share)),
    weights AS (
      SELECT model, part, 0 AS k, {', '.join(f'0::DOUBLE AS w{i}' for i in xs)} FROM systems
      UNION ALL
      SELECT model, part, k + 1, {', '.join(f'n{i}' for i in xs)}
      FROM (SELECT *, {', '.join(step(i) for i in xs)} FROM weights JOIN systems USING (model, part) WHERE k < {SWEEPS})),
    errors AS (SELECT model, part, y, my + {' + '.join(f'w{i} * sy / s{i} * (x{i} - m{i})' for i in xs)} AS z
               FROM weights JOIN systems USING (model, part) JOIN data ON fold = part WHERE k = {SWEEPS})"""


def _power(source: str, name: str) -> str:
    """CTEs from the matrix in ``source`` to ``name`` (v): its first eigenvector, the largest loading positive."""
    return f"""
    {name}_power AS (
      SELECT 0 AS k, m FROM {source}
      UNION ALL
      SELECT k + 1, list_transform(m, lambda a: list_transform(m, lambda b: list_dot_product(a, b) / size))
      FROM (SELECT k, m, list_sum(list_transform(m, lambda a: list_dot_product(a, a))) AS size
            FROM {name}_power WHERE k < {SQUARINGS})),
    {name}_row AS (SELECT r FROM (SELECT unnest(m) AS r FROM {name}_power WHERE k = {SQUARINGS})
                   ORDER BY list_dot_product(r, r) DESC LIMIT 1),
    {name}_sign AS (SELECT r, CASE WHEN list_max(r) >= -list_min(r) THEN 1 ELSE -1 END AS s FROM {name}_row),
    {name} AS (SELECT list_transform(r, lambda x: x * s / sqrt(list_dot_product(r, r))) AS v FROM {name}_sign)"""


def first_components(vector: str, table: str, columns: Sequence[str]) -> str:
    """CTEs ``vectors`` (all columns of ``table`` and the vector ``x``), ``one`` and ``two`` (v)."""
    return f"""
    vectors AS (SELECT {', '.join(columns)}, row_number() OVER () AS place,
                       list_transform({vector}, lambda a: a::DOUBLE) AS x FROM {table}),
    long AS (SELECT place, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM vectors),
    cells AS (SELECT a.i, b.i AS j, covar_samp(a.c, b.c) AS c FROM long a JOIN long b USING (place) GROUP BY ALL),
    lines AS (SELECT i, list(c ORDER BY j) AS r FROM cells GROUP BY i),
    spread AS (SELECT list(r ORDER BY i) AS m FROM lines),{_power('spread', 'one')},
    strength AS (SELECT m, v, list_dot_product(list_transform(m, lambda a: list_dot_product(a, v)), v) AS l FROM spread, one),
    rest AS (SELECT list_transform(m, lambda a, i: list_transform(a, lambda c, j: c - l * v[i] * v[j])) AS m
             FROM strength),{_power('rest', 'two')}"""


def logistic_fit(inputs: int, penalty: float) -> str:
    """CTEs that end in ``scored`` (label, score, prediction): the rows of fold 0, by a model of all others.

    They follow a CTE ``data`` (x1 .. xn, y, fold); the penalty applies to coefficients of scaled inputs.
    The logistic Hessian is at most a quarter of the inputs' correlations, whose inverse comes from
    Schulz's iteration.
    """
    xs = range(1, inputs + 1)
    rows = [", ".join(f"corr(x{i}, x{j}) / 4{f' + {penalty}' if i == j else ''}" for j in xs) for i in xs]
    margin = "w0 + " + " + ".join(f"w{i} * z{i}" for i in xs)
    weights = ", ".join(f"w{i}" for i in range(inputs + 1))
    slopes = ", ".join(f"avg((p - y) * z{i}) + {penalty} * w{i}" for i in xs)
    return f"""
    moments AS (SELECT {', '.join(f'avg(x{i}) AS m{i}, stddev_samp(x{i}) AS s{i}' for i in xs)},
                       [{', '.join(f'[{r}]' for r in rows)}] AS a FROM data WHERE fold <> 0),
    scaled AS (SELECT fold, y, {', '.join(f'(x{i} - m{i}) / s{i} AS z{i}' for i in xs)} FROM data, moments),
    schulz AS (
      SELECT 0 AS k, a, list_transform(a, lambda r: list_transform(r, lambda c: c / size)) AS v
      FROM (SELECT a, list_sum(list_transform(a, lambda r: list_dot_product(r, r))) AS size FROM moments)
      UNION ALL
      SELECT k + 1, a, list_transform(v, lambda r, i: list_transform(r, lambda c, j: 2 * c - list_dot_product(r, q[j])))
      FROM (SELECT k, a, v, list_transform(v, lambda x: list_transform(a, lambda y: list_dot_product(x, y))) AS q
            FROM schulz WHERE k < {INVERSIONS})),
    inverse AS (SELECT v FROM schulz WHERE k = {INVERSIONS}),
    fitted AS (
      SELECT 0 AS k, {', '.join(f'0::DOUBLE AS w{i}' for i in range(inputs + 1))}
      UNION ALL
      SELECT k + 1, w0 - 4 * g0, {', '.join(f'w{i} - list_dot_product(v[{i}], g)' for i in xs)}
      FROM (SELECT k, {weights}, avg(p - y) AS g0, [{slopes}] AS g
            FROM (SELECT *, 1 / (1 + exp(-({margin}))) AS p FROM fitted, scaled WHERE k < {STEPS} AND fold <> 0)
            GROUP BY k, {weights}), inverse),
    scored AS (SELECT y AS label, {margin} AS score, CASE WHEN {margin} > 0 THEN 1.0::DOUBLE ELSE 0 END AS prediction
               FROM fitted, scaled WHERE k = {STEPS} AND fold = 0)"""

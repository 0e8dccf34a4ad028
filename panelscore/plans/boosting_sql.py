"""DuckDB SQL that fits boosted trees again from the raw tables: quantile borders, gradients in whole units, splits by window sums.

Written from the definition of a tree, not from the Spark plan: every node of a level is split at once and rows are routed by path
numbers (root 1, children 2i and 2i + 1). It holds where the leaf limit does not bind and where a sketch of the borders is exact
(fewer rows than ``boosting.ACCURACY``). ``fitted`` writes a few rounds out; ``fitted_whole`` goes on, by recursion, until the patience is spent or the model's own limit
is reached, and down to the last split of each tree."""
from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from ..functions.splitmix import GOLDEN, M64, MIX1, MIX2, SHIFTS
from ..operators.boosting import LEAST_GAIN, ROUND_SEED, UNIT, Settings, feature_sample

_U64 = M64 + 1
LEVELS = 14


def unit_hash(key: str, seed: int) -> str:
    """splitmix64 of a key as a number in [0, 1): nested list lambdas name each step once."""
    return _hashed(key, f"{(seed * GOLDEN) & M64}")


def _hashed(key: str, offset: str) -> str:
    x = f"[(CAST({key} AS UHUGEINT) + {offset}) % {_U64}]"
    for shift, mix in zip(SHIFTS, (MIX1, MIX2, None)):
        x = f"list_transform({x}, lambda v: xor(v, v >> {shift}))"
        if mix:
            x = f"list_transform({x}, lambda v: (v * {mix}) % {_U64})"
    return f"(CAST({x}[1] >> 11 AS DOUBLE) / 9007199254740992.0)"


def _double(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _value(g: str, h: str, l2: float) -> str:
    g, h = f"(CAST({g} AS DOUBLE) / {UNIT})", f"(CAST({h} AS DOUBLE) / {UNIT})"
    return f"({g} * {g} / ({h} + {_double(l2)}))"


def _leaf_value(g: str, h: str, s: Settings) -> str:
    return f"({_double(-s.rate)} * (CAST({g} AS DOUBLE) / {UNIT}) / (CAST({h} AS DOUBLE) / {UNIT} + {_double(s.l2)}))"


def _sums(rows: str, node: str, features: Sequence[int]) -> str:
    picks = ", ".join(f"bins[{f + 1}]" for f in features)
    return (f"SELECT {node}, f, b, SUM(g) AS sg, SUM(h) AS sh, COUNT(*) AS sn FROM "
            f"(SELECT {node}, g, h, UNNEST([{', '.join(map(str, features))}]) AS f, UNNEST([{picks}]) AS b FROM {rows} WHERE drawn) GROUP BY ALL")


def fitted(source: str, features: Sequence[str], s: Settings, rounds: int) -> tuple[list[str], Callable[[int], str], list[str]]:
    """Common table expressions that fit ``rounds`` trees on ``source`` (id, y, is_train, the features): the list of
    them, the name of the table with the margins after r trees (id, y, is_train, bins, margin), and the split tables (tree, path or level, f, b, gain)."""
    ctes = _start(source, features, s)
    splits = []
    for r in range(rounds):
        drawn = "is_train" if s.rows >= 1 else f"is_train AND {unit_hash('id', ROUND_SEED + r)} < {_double(s.rows)}"
        p = "(1 / (1 + exp(-margin)))"
        ctes.append(f"t{r} AS MATERIALIZED (SELECT id, 1::BIGINT AS node, bins, CAST(floor(({p} - y) * {UNIT} + 0.5) AS BIGINT) AS g, CAST(floor({p} * (1 - {p}) * {UNIT} + 0.5) AS BIGINT) AS h, "
                    f"{drawn} AS drawn FROM m{r})")
        chosen = feature_sample(len(features), s.features, r)
        value = _symmetric(ctes, splits, r, chosen, s) if s.symmetric else _leafwise(ctes, splits, r, chosen, s)
        ctes.append(f"m{r + 1} AS MATERIALIZED (SELECT id, y, is_train, bins, margin + value AS margin FROM m{r} JOIN ({value}) USING (id))")
    return ctes, "m{}".format, splits


def _start(source: str, features: Sequence[str], s: Settings) -> list[str]:
    """``source``, its bins and ``m0``: the rows with the first margin."""
    probs = ", ".join(_double(i / (s.borders + 1)) for i in range(1, s.borders + 1))
    ctes = [f"source AS MATERIALIZED ({source})",
            "long AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT id, {i} AS f, CAST({c} AS DOUBLE) AS x, is_train FROM source" for i, c in enumerate(features)) + ")",
            f"quantiles AS (SELECT f, UNNEST(quantile_disc(x, [{probs}])) AS v FROM long WHERE is_train GROUP BY f)",
            "borders AS MATERIALIZED (SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) AS place FROM (SELECT DISTINCT f, v FROM quantiles))",
            "binned AS MATERIALIZED (SELECT id, list(COALESCE(place, 0) ORDER BY l.f) AS bins FROM long l ASOF LEFT JOIN borders b ON l.f = b.f AND l.x >= b.v GROUP BY id)"]
    base = "(SELECT ln(AVG(y) / (1 - AVG(y))) FROM source WHERE is_train)" if s.average else "0.0::DOUBLE"
    ctes.append(f"m0 AS MATERIALIZED (SELECT id, y, is_train, bins, CAST({base} AS DOUBLE) AS margin FROM source JOIN binned USING (id))")
    return ctes


def fitted_whole(source: str, features: Sequence[str], s: Settings) -> list[str]:
    """CTEs that boost leaf-wise trees on ``source`` to the settings' own limits of rounds and patience. ``best``: the margins after the best round (id, y, is_train, margin) and its
    number (rounds); ``splits``: those of the trees kept (tree, node: the path, f, b, gain, n).

    ``fit`` has one row a round: margins by id, the area of the validation rows as whole numbers, the best round so far, the round's splits. Its inner recursion ``grown`` takes each row
    down its tree: one row a level, with the split that led there."""
    seed = lambda number: f"((CAST({ROUND_SEED} + {number} AS UHUGEINT) * {GOLDEN}) % {_U64})"
    least, p = max(1, s.least_rows), "(1 / (1 + exp(-margin)))"
    kept = max(1, math.ceil(s.features * len(features)))
    drawn = "is_train" if s.rows >= 1 else f"is_train AND {_hashed('id', seed('round'))} < {_double(s.rows)}"
    gain = f"{_value('gl', 'hl', s.l2)} + {_value('g - gl', 'h - hl', s.l2)} - {_value('g', 'h', s.l2)}"
    ctes = _start(source, features, s)
    ctes += [f"chosen AS MATERIALIZED (SELECT number, f FROM range({s.rounds}) a(number), range({len(features)}) b(f) QUALIFY row_number() OVER (PARTITION BY number ORDER BY {_hashed('f', seed('number'))}, f) <= {kept})",
             "placed AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY id) AS place FROM m0)",
             f"""fit AS (
SELECT 0 AS round, (SELECT list(margin ORDER BY place) FROM placed) AS margins, NULL::HUGEINT AS twice, 0 AS best, NULL::HUGEINT AS top, []::STRUCT(node BIGINT, f BIGINT, b BIGINT, gain DOUBLE, n BIGINT)[] AS splits
UNION ALL
SELECT * FROM (WITH RECURSIVE last AS MATERIALIZED (SELECT * FROM fit WHERE round < {s.rounds} AND round - best < {s.patience}),
now AS MATERIALIZED (SELECT place, id, y, is_train, bins, m.margin, round FROM (SELECT round, UNNEST(margins) AS margin, UNNEST(range(1, len(margins) + 1)) AS place FROM last) m JOIN placed p USING (place)),
drawn AS MATERIALIZED (SELECT place, bins, CAST(floor(({p} - y) * {UNIT} + 0.5) AS BIGINT) AS g, CAST(floor({p} * (1 - {p}) * {UNIT} + 0.5) AS BIGINT) AS h, {drawn} AS drawn FROM now),
features AS MATERIALIZED (SELECT f FROM chosen WHERE number = (SELECT round FROM last)),
grown AS (
SELECT place, 0 AS level, 1::BIGINT AS node, bins, g, h, drawn, NULL::BIGINT AS f, NULL::BIGINT AS b, NULL::DOUBLE AS gain, NULL::BIGINT AS n FROM drawn
UNION ALL
SELECT w.place, w.level + 1, 2 * w.node + CAST(w.bins[x.f + 1] > x.b AS BIGINT), w.bins, w.g, w.h, w.drawn, x.f, x.b, x.gain, x.n FROM grown w JOIN (
  SELECT node, f, b, gain, n FROM (SELECT *, {gain} AS gain FROM (
    SELECT node, f, b, SUM(sg) OVER w AS gl, SUM(sh) OVER w AS hl, SUM(sn) OVER w AS nl, SUM(sg) OVER v AS g, SUM(sh) OVER v AS h, SUM(sn) OVER v AS n
    FROM (SELECT node, c.f, bins[c.f + 1] AS b, SUM(g) AS sg, SUM(h) AS sh, COUNT(*) AS sn FROM grown, features c WHERE drawn GROUP BY ALL)
    WINDOW w AS (PARTITION BY node, f ORDER BY b), v AS (PARTITION BY node, f)) WHERE nl >= {least} AND n - nl >= {least})
  WHERE gain > {LEAST_GAIN!r} QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, b) = 1) x ON w.node = x.node),
ends AS MATERIALIZED (SELECT place, MAX(node) AS node FROM grown GROUP BY place),
leaves AS (SELECT node, COALESCE(SUM(g) FILTER (WHERE drawn), 0) AS g, COALESCE(SUM(h) FILTER (WHERE drawn), 0) AS h FROM ends JOIN drawn USING (place) GROUP BY node),
after AS MATERIALIZED (SELECT place, y, is_train, margin + {_leaf_value('leaves.g', 'leaves.h', s)} AS margin FROM now JOIN ends USING (place) JOIN leaves USING (node)),
points AS (SELECT margin, SUM(y) AS pos, COUNT(*) - SUM(y) AS neg FROM after WHERE NOT is_train GROUP BY margin),
area AS MATERIALIZED (SELECT SUM(neg * (2 * above - pos))::HUGEINT AS got FROM (SELECT *, SUM(pos) OVER (ORDER BY margin DESC) AS above FROM points)),
made AS MATERIALIZED (SELECT list(x ORDER BY x.node) AS splits FROM (SELECT DISTINCT {{'node': node // 2, 'f': f, 'b': b::BIGINT, 'gain': gain, 'n': n::BIGINT}} AS x FROM grown WHERE level > 0))
SELECT round + 1, (SELECT list(margin ORDER BY place) FROM after), got, CASE WHEN round = 0 OR got > top THEN round + 1 ELSE best END, CASE WHEN round = 0 OR got > top THEN got ELSE top END, COALESCE((SELECT splits FROM made), [])
FROM last, area))""",
             "kept AS MATERIALIZED (SELECT best AS rounds FROM fit ORDER BY round DESC LIMIT 1)",
             "best AS MATERIALIZED (SELECT id, y, is_train, m.margin, rounds FROM (SELECT UNNEST(margins) AS margin, UNNEST(range(1, len(margins) + 1)) AS place, rounds FROM fit JOIN kept ON round = rounds) m JOIN placed USING (place))",
             "splits AS MATERIALIZED (SELECT round - 1 AS tree, UNNEST(splits, recursive := true) FROM fit, kept WHERE round BETWEEN 1 AND rounds)"]
    return ctes


def _leafwise(ctes: list[str], splits: list[str], r: int, features: Sequence[int], s: Settings) -> str:
    leaves, rows = [], f"t{r}"
    for d in range(LEVELS):
        name = f"s{r}_{d}"
        cumulated = (f"SELECT node, f, b, SUM(sg) OVER w AS gl, SUM(sh) OVER w AS hl, SUM(sn) OVER w AS nl, SUM(sg) OVER v AS g, SUM(sh) OVER v AS h, SUM(sn) OVER v AS n "
                     f"FROM ({_sums(rows, 'node', features)}) WINDOW w AS (PARTITION BY node, f ORDER BY b), v AS (PARTITION BY node, f)")
        gain = f"{_value('gl', 'hl', s.l2)} + {_value('g - gl', 'h - hl', s.l2)} - {_value('g', 'h', s.l2)}"
        least = max(1, s.least_rows)
        ctes.append(f"{name} AS MATERIALIZED (SELECT {r} AS tree, node, f, b, gain, n FROM (SELECT *, {gain} AS gain FROM ({cumulated}) WHERE nl >= {least} AND n - nl >= {least}) "
                    f"WHERE gain > {LEAST_GAIN!r} QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, b) = 1)")
        splits.append(name)
        sums = f"SELECT node, COALESCE(SUM(g) FILTER (WHERE drawn), 0) AS g, COALESCE(SUM(h) FILTER (WHERE drawn), 0) AS h FROM {rows} GROUP BY node"
        leaves.append(f"SELECT id, {_leaf_value('x.g', 'x.h', s)} AS value FROM {rows} JOIN ({sums}) x USING (node) WHERE node NOT IN (SELECT node FROM {name})")
        below = f"n{r}_{d + 1}"
        ctes.append(f"{below} AS MATERIALIZED (SELECT id, 2 * node + CAST(bins[f + 1] > b AS BIGINT) AS node, bins, g, h, drawn FROM {rows} JOIN {name} USING (node))")
        rows = below
    return " UNION ALL ".join(leaves)


def _symmetric(ctes: list[str], splits: list[str], r: int, features: Sequence[int], s: Settings) -> str:
    rows = f"t{r}"
    for d in range(s.depth):
        hist, name, below = f"h{r}_{d}", f"s{r}_{d}", f"n{r}_{d + 1}"
        ctes.append(f"{hist} AS MATERIALIZED ({_sums(rows, 'node', features)})")
        grid = (f"SELECT node, f, b, COALESCE(sg, 0) AS sg, COALESCE(sh, 0) AS sh FROM (SELECT DISTINCT f, b FROM {hist}) CROSS JOIN (SELECT DISTINCT node FROM {hist}) LEFT JOIN {hist} USING (node, f, b)")
        cumulated = (f"SELECT node, f, b, SUM(sg) OVER w AS gl, SUM(sh) OVER w AS hl, SUM(sg) OVER v AS g, SUM(sh) OVER v AS h FROM ({grid}) "
                     f"WINDOW w AS (PARTITION BY node, f ORDER BY b), v AS (PARTITION BY node, f)")
        gain = f"{_value('gl', 'hl', s.l2)} + {_value('g - gl', 'h - hl', s.l2)} - {_value('g', 'h', s.l2)}"
        added = "list_reduce(list(gain ORDER BY node), lambda x, y: x + y)"
        ctes.append(f"{name} AS MATERIALIZED (SELECT {r} AS tree, {d}::BIGINT AS node, f, b, gain, 0 AS n FROM (SELECT f, b, {added} AS gain FROM (SELECT node, f, b, {gain} AS gain FROM ({cumulated})) GROUP BY f, b) "
                    f"WHERE gain > {LEAST_GAIN!r} QUALIFY row_number() OVER (ORDER BY gain DESC, f, b) = 1)")
        splits.append(name)
        ctes.append(f"{below} AS MATERIALIZED (SELECT id, 2 * r.node + COALESCE(CAST(bins[f + 1] > b AS BIGINT), 0) AS node, bins, g, h, drawn FROM {rows} r LEFT JOIN {name} ON TRUE)")
        rows = below
    sums = f"SELECT node, COALESCE(SUM(g) FILTER (WHERE drawn), 0) AS g, COALESCE(SUM(h) FILTER (WHERE drawn), 0) AS h FROM {rows} GROUP BY node"
    return f"SELECT id, {_leaf_value('x.g', 'x.h', s)} AS value FROM {rows} JOIN ({sums}) x USING (node)"


def best_round(margins: Callable[[int], str], rounds: int) -> list[str]:
    """CTEs ``history`` (round, auc) and ``best`` (rounds: the first round with the highest AUC of the validation rows)."""
    stages = " UNION ALL ".join(f"SELECT {r} AS round, y, margin FROM {margins(r)} WHERE NOT is_train" for r in range(1, rounds + 1))
    return [f"stages AS MATERIALIZED ({stages})",
            "points AS (SELECT round, margin, SUM(y) AS pos, COUNT(*) - SUM(y) AS neg FROM stages GROUP BY ALL)",
            "ranked AS (SELECT *, SUM(pos) OVER (PARTITION BY round ORDER BY margin DESC) AS above FROM points)",
            "areas AS (SELECT round, SUM(neg * (2 * above - pos)) AS twice, SUM(pos) AS p, SUM(neg) AS n FROM ranked GROUP BY round)",
            "history AS (SELECT round, CAST(twice AS DOUBLE) / CAST(2 * p * n AS DOUBLE) AS auc, twice FROM areas)",
            "best AS (SELECT round AS rounds FROM history ORDER BY twice DESC, round LIMIT 1)"]

"""DuckDB SQL text for the oracle side of the registered queries.

The oracle is an independent formulation of the same semantics in plain SQL
(global windows, recursive CTEs), used only to check Spark results at small
scale. Every double is rounded to 6 places on both sides.
"""

from __future__ import annotations

from ..functions.scalar import SIGMOID_EPS
from ..tables import SQL_TICKS

INTERVALS = {"1 minute": "1 minute", "5 minutes": "5 minutes", "15 minutes": "15 minutes",
             "1 hour": "1 hour", "1 day": "1 day", "1 week": "7 days"}


def sql_bars_from_ticks(width: str, ticks_sql: str = SQL_TICKS) -> str:
    """R1 on trades, as a SELECT."""
    return f"""
SELECT symbol, bts AS ts, open, high, low, close, volume, trade_count, vwap FROM (
  SELECT symbol, time_bucket(INTERVAL '{INTERVALS[width]}', ts) AS bts,
         first(price ORDER BY ts, seq) AS open, max(price) AS high, min(price) AS low,
         last(price ORDER BY ts, seq) AS close, CAST(sum(size) AS BIGINT) AS volume,
         count(*) AS trade_count,
         CASE WHEN sum(size) = 0 THEN NULL ELSE sum(price * size) / sum(size) END AS vwap
  FROM ({ticks_sql}) t GROUP BY 1, 2)"""


def sql_resample(width: str, bars_sql: str) -> str:
    """R1 on bars."""
    return f"""
SELECT symbol, bts AS ts, open, high, low, close, volume, trade_count, vwap FROM (
  SELECT symbol, time_bucket(INTERVAL '{INTERVALS[width]}', ts) AS bts,
         first(open ORDER BY ts) AS open, max(high) AS high, min(low) AS low,
         last(close ORDER BY ts) AS close, CAST(sum(volume) AS BIGINT) AS volume,
         CAST(sum(trade_count) AS BIGINT) AS trade_count,
         CASE WHEN sum(volume) = 0 THEN NULL ELSE sum(vwap * volume) / sum(volume) END AS vwap
  FROM ({bars_sql}) b GROUP BY 1, 2)"""


def sql_sigmoid(z: str) -> str:
    return f"(1.0 / (1.0 + exp(-(({z}) + {SIGMOID_EPS!r}))))"


def sql_lstm_step(weights: dict, xs: list, h: str, c: str):
    """SQL for (h', c') of one cell step, inputs ``xs`` (expressions)."""
    z = {}
    for g, (w, u, b) in weights.items():
        dot = " + ".join(f"{x} * {float(wk)!r}" for x, wk in zip(xs, w))
        z[g] = f"(({dot}) + {float(u)!r} * {h} + {float(b)!r})"
    c2 = f"(tanh({z['a']}) * {sql_sigmoid(z['i'])} + {sql_sigmoid(z['f'])} * {c})"
    h2 = f"(tanh({c2}) * {sql_sigmoid(z['o'])})"
    return h2, c2


def sql_scaled_bars(bars_sql: str) -> str:
    """Indexed bars with the scaled features (close, volume) and target scaler."""
    return f"""
idx AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS g FROM ({bars_sql}) b),
sc AS (SELECT symbol, CAST(min(close) AS DOUBLE) AS close_min, CAST(max(close) AS DOUBLE) AS close_max,
              CAST(min(volume) AS DOUBLE) AS volume_min, CAST(max(volume) AS DOUBLE) AS volume_max,
              min(close) FILTER (WHERE g >= 1) AS target_min, max(close) FILTER (WHERE g >= 1) AS target_max
       FROM idx GROUP BY symbol),
x AS (SELECT i.symbol, i.ts, i.g, i.close, i.volume, sc.target_min, sc.target_max,
             CASE WHEN close_max = close_min THEN 0.0 ELSE (i.close - close_min) / (close_max - close_min) END AS x0,
             CASE WHEN volume_max = volume_min THEN 0.0 ELSE (i.volume - volume_min) / (volume_max - volume_min) END AS x1
      FROM idx i JOIN sc USING (symbol))"""


def sql_forecast_pairs(weights: dict, width: str = "1 hour", b: int = 4) -> str:
    h2, c2 = sql_lstm_step(weights, ["x.x0", "x.x1"], "r.h", "r.c")
    return f"""
WITH RECURSIVE {sql_scaled_bars(sql_bars_from_ticks(width))},
rec(symbol, t, s, h, c) AS (
  SELECT symbol, g, 0, CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE) FROM x WHERE g >= {b}
  UNION ALL
  SELECT r.symbol, r.t, r.s + 1, {h2}, {c2}
  FROM rec r JOIN x ON x.symbol = r.symbol AND x.g = r.t - {b} + r.s
  WHERE r.s < {b}
),
pairs AS (
  SELECT x.symbol, x.ts, x.close AS actual,
         r.h * (x.target_max - x.target_min) + x.target_min AS predicted
  FROM rec r JOIN x ON x.symbol = r.symbol AND x.g = r.t WHERE r.s = {b}
)"""


def sql_window_gradients(weights: dict, bars_sql: str, b: int) -> str:
    """Gradient of the summed loss over all windows of ``b`` bars, per symbol:
    ``per_symbol(symbol, grad, loss, steps)``. Forward mode: every step carries
    the derivatives of h and c by each weight, so nothing is shared with the
    backward pass it checks."""
    gates = list(weights)
    width = len(weights[gates[0]][0]) + 2
    ks = range(len(gates) * width)
    cell = {g: f"{' + '.join(f'{float(w)!r} * x{m}' for m, w in enumerate(ws))} + {float(u)!r} * h + {float(c)!r}"
            for g, (ws, u, c) in weights.items()}
    inputs = [f"x{m}" for m in range(width - 2)] + ["h", "1.0"]

    def dz(gate, k):
        own = inputs[k % width] if gates[k // width] == gate else "0.0"
        return f"({own} + {float(weights[gate][1])!r} * dh{k})"
    dc = {k: (f"(i * (1 - a * a) * {dz('a', k)} + a * i * (1 - i) * {dz('i', k)} "
              f"+ c * f * (1 - f) * {dz('f', k)} + f * dc{k})") for k in ks}
    dh = {k: f"((1 - tc * tc) * o * dc{k}n + tc * o * (1 - o) * {dz('o', k)})" for k in ks}
    state = ", ".join([f"dh{k}" for k in ks] + [f"dc{k}" for k in ks])
    zeros = ", ".join(["CAST(0.0 AS DOUBLE)"] * (2 * len(ks)))
    return f"""
WITH RECURSIVE {sql_scaled_bars(bars_sql)},
xy AS (SELECT symbol, g, x0, x1, count(*) OVER (PARTITION BY symbol) AS n,
              CASE WHEN target_max = target_min THEN 0.0 ELSE
                (lead(close) OVER (PARTITION BY symbol ORDER BY g) - target_min) / (target_max - target_min) END AS y
       FROM x),
rec(symbol, t, s, e, h, c, {state}) AS (
  SELECT symbol, g, 0, CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE), {zeros} FROM xy WHERE g + {b} < n
  UNION ALL
  SELECT symbol, t, s + 1, tc * o - y, tc * o, cn,
         {", ".join(f"{dh[k]}" for k in ks)}, {", ".join(f"dc{k}n" for k in ks)}
  FROM (SELECT *, {", ".join(f"{dc[k]} AS dc{k}n" for k in ks)}
        FROM (SELECT *, tanh(cn) AS tc FROM (SELECT *, a * i + f * c AS cn FROM (
          SELECT r.*, x0, x1, y, tanh({cell['a']}) AS a, {sql_sigmoid(cell['i'])} AS i,
                 {sql_sigmoid(cell['f'])} AS f, {sql_sigmoid(cell['o'])} AS o
          FROM rec r JOIN xy ON xy.symbol = r.symbol AND xy.g = r.t + r.s WHERE r.s < {b}))))
),
per_symbol AS (SELECT symbol, [{", ".join(f"sum(e * dh{k})" for k in ks)}] AS grad, sum(e * e / 2) AS loss,
                      count(*) AS steps FROM rec WHERE s > 0 GROUP BY symbol)"""


def sql_train_in_order(weights: dict, bars_sql: str, b: int, lr: float, epochs: int) -> str:
    """M5: parameters (th0 ..) per symbol after an update at every window of
    ``b`` bars in order. One recursion step is one window, forward and backward
    written out step by step."""
    gates = list(weights)
    width = len(weights[gates[0]][0]) + 2
    ks = range(len(gates) * width)
    start = [v for g in gates for v in (*weights[g][0], weights[g][1], weights[g][2])]

    def th(gate, m):
        return f"th{gates.index(gate) * width + m}"
    parts, h, c = [], "0.0", "0.0"
    for t in range(b):
        for g in gates:
            z = " + ".join([f"{th(g, m)} * x{m}[{t + 1}]" for m in range(width - 2)]
                           + [f"{th(g, width - 2)} * {h}", th(g, width - 1)])
            parts.append((f"{g}{t}", f"tanh({z})" if g == "a" else sql_sigmoid(z)))
        parts += [(f"c{t}", f"a{t} * i{t} + f{t} * {c}"), (f"tc{t}", f"tanh(c{t})"), (f"h{t}", f"tc{t} * o{t}")]
        h, c = f"h{t}", f"c{t}"
    for t in reversed(range(b)):
        last = t == b - 1
        back = "0.0" if last else " + ".join(f"d{g}{t + 1} * {th(g, width - 2)}" for g in gates)
        before = f"c{t - 1}" if t else "0.0"
        parts += [(f"out{t}", f"h{t} - ys[{t + 1}] + {back}"),
                  (f"dc{t}", f"out{t} * o{t} * (1 - tc{t} * tc{t}) + " + ("0.0" if last else f"dc{t + 1} * f{t + 1}")),
                  (f"da{t}", f"dc{t} * i{t} * (1 - a{t} * a{t})"), (f"di{t}", f"dc{t} * a{t} * i{t} * (1 - i{t})"),
                  (f"df{t}", f"dc{t} * {before} * f{t} * (1 - f{t})"), (f"do{t}", f"out{t} * tc{t} * o{t} * (1 - o{t})")]
    moved = []
    for g in gates:
        for m in range(width):
            with_ = [f"x{m}[{t + 1}]" if m < width - 2 else ("1.0" if m == width - 1 else (f"h{t - 1}" if t else "0.0"))
                     for t in range(b)]
            moved.append(f"{th(g, m)} - {lr!r} * (" + " + ".join(f"d{g}{t} * {w}" for t, w in enumerate(with_)) + ")")
    inner = "r.*, w.n, w.x0, w.x1, w.ys"
    nested = f"SELECT {inner} FROM rec r JOIN win w ON w.symbol = r.symbol AND w.g = r.k WHERE r.e < {epochs}"
    for name, expr in parts:
        nested = f"SELECT *, {expr} AS {name} FROM ({nested})"
    frame = f"OVER (PARTITION BY symbol ORDER BY g ROWS BETWEEN CURRENT ROW AND {b - 1} FOLLOWING)"
    return f"""
WITH RECURSIVE {sql_scaled_bars(bars_sql)},
xy AS (SELECT symbol, g, x0, x1, count(*) OVER (PARTITION BY symbol) AS n,
              CASE WHEN target_max = target_min THEN 0.0 ELSE
                (lead(close) OVER (PARTITION BY symbol ORDER BY g) - target_min) / (target_max - target_min) END AS y
       FROM x),
win AS (SELECT * FROM (SELECT symbol, g, n, list(x0) {frame} AS x0, list(x1) {frame} AS x1, list(y) {frame} AS ys FROM xy)
        WHERE g + {b} < n),
rec(symbol, e, k, {", ".join(f"th{k}" for k in ks)}) AS (
  SELECT DISTINCT symbol, 0, CAST(0 AS BIGINT), {", ".join(f"CAST({v!r} AS DOUBLE)" for v in start)} FROM win
  UNION ALL
  SELECT symbol, CASE WHEN k + 1 + {b} < n THEN e ELSE e + 1 END, CASE WHEN k + 1 + {b} < n THEN k + 1 ELSE 0 END,
         {", ".join(moved)}
  FROM ({nested})
),
trained AS (SELECT * FROM rec WHERE e = {epochs})"""

"""DuckDB oracle for the opening-range study.

Written the direct way -- row numbers along each day's path and a running
window for the fade's extreme -- so it checks the Spark plan (conditional
minima, range-chunked scan) by a different route.  Prices are compared in
price space per direction, as the scalar study does.
"""

from __future__ import annotations

from tickline.operators.orb import OrbParams

# The study over the tick view: one continuous contract, Eastern time,
# markers dropped, opening range 09:30:00-09:59:00 (the 30-second range is
# nearly empty at this data's density), width limit 5.
DRIVER_PARAMS = OrbParams(or_seconds=29 * 60)


def study_ctes(p: OrbParams = DRIVER_PARAMS) -> list[str]:
    S, ORE, E = p.t_start, p.t_or_end, p.t_end
    T10, T1130 = p.t_fade, p.t_stop
    W = float(p.width_limit)

    def fav(x):   # favourable move of at least x from the entry
        return (f"((direction = 'Long' AND price >= entry + {float(x)}) OR "
                f"(direction = 'Short' AND price <= entry - {float(x)}))")

    def adv(x):   # adverse move of at least x
        return (f"((direction = 'Long' AND price <= entry - {float(x)}) OR "
                f"(direction = 'Short' AND price >= entry + {float(x)}))")

    profit = "(CASE WHEN direction = 'Long' THEN price - entry ELSE entry - price END)"
    return [
        f"""px AS (
  SELECT 'ES' AS contract, record_no, close AS price,
         (datetime AT TIME ZONE 'UTC') AT TIME ZONE '{p.tz}' AS et
  FROM ticks WHERE abs(open) < 1e10)""",
        """px2 AS (SELECT *, CAST(et AS DATE) AS session_date, epoch_us(et) % 86400000000 AS tod FROM px)""",
        f"""days AS (
  SELECT contract, session_date,
    max(price) FILTER (WHERE tod >= {S} AND tod <= {ORE}) AS or_high,
    min(price) FILTER (WHERE tod >= {S} AND tod <= {ORE}) AS or_low,
    max(price) FILTER (WHERE tod >= {S} AND tod <= {E}) AS daily_high,
    min(price) FILTER (WHERE tod >= {S} AND tod <= {E}) AS daily_low
  FROM px2 GROUP BY contract, session_date
  HAVING count(*) >= {p.min_day_ticks} AND count(*) FILTER (WHERE tod >= {S} AND tod <= {ORE}) > 0)""",
        f"""post AS (
  SELECT x.*, row_number() OVER (PARTITION BY x.contract, x.session_date ORDER BY x.et, x.record_no) AS rn
  FROM px2 x JOIN days d ON x.contract = d.contract AND x.session_date = d.session_date
  WHERE x.tod > {ORE} AND x.tod <= {E})""",
        """brk AS (
  SELECT d.contract, d.session_date, d.or_high, d.or_low, d.or_high - d.or_low AS or_width,
         d.daily_high, d.daily_low,
         min(x.et) FILTER (WHERE x.price > d.or_high) AS t_up,
         min(x.et) FILTER (WHERE x.price < d.or_low) AS t_down
  FROM days d LEFT JOIN post x ON x.contract = d.contract AND x.session_date = d.session_date
  GROUP BY ALL)""",
        """dirs AS (
  SELECT *,
    CASE WHEN t_up IS NOT NULL AND (t_down IS NULL OR t_up < t_down) THEN 'Long'
         WHEN t_down IS NOT NULL THEN 'Short' END AS direction
  FROM brk)""",
        """trd AS (
  SELECT *, CASE WHEN direction = 'Long' THEN t_up ELSE t_down END AS entry_time,
            CASE WHEN direction = 'Long' THEN or_high ELSE or_low END AS entry
  FROM dirs WHERE direction IS NOT NULL)""",
        """path AS (
  SELECT x.contract, x.session_date, x.et, x.record_no, x.price, x.tod, x.rn,
         t.direction, t.entry, t.entry_time, t.or_width, t.or_low
  FROM post x JOIN trd t ON x.contract = t.contract AND x.session_date = t.session_date
  WHERE x.et >= t.entry_time)""",
        f"""pst AS (
  SELECT contract, session_date,
    max(price) AS hi, min(price) AS lo, arg_max(price, rn) AS p_last,
    min(rn) FILTER (WHERE {fav(p.s0_target)}) AS s0_t, min(rn) FILTER (WHERE {adv(p.s0_stop)}) AS s0_s,
    min(rn) FILTER (WHERE {fav(p.s1_target)}) AS s1_t, min(rn) FILTER (WHERE {adv(p.s1_stop)}) AS s1_s,
    min(rn) FILTER (WHERE {fav(p.s4_target)}) AS s4_t, min(rn) FILTER (WHERE {adv(p.s4_stop)}) AS s4_s,
    min(rn) FILTER (WHERE tod >= {T1130} AND {profit} < {float(p.s4_min_profit)}) AS s4_x,
    arg_min(price, rn) FILTER (WHERE tod >= {T1130} AND {profit} < {float(p.s4_min_profit)}) AS s4_x_price,
    min(et) FILTER (WHERE price <= or_low - {float(p.s2_buffer)}) AS s2_time
  FROM path GROUP BY contract, session_date)""",
        f"""s2w AS (
  SELECT x.contract, x.session_date,
    min(x.rn) FILTER (WHERE x.price <= (x.or_low - {float(p.s2_buffer)}) - {float(p.s2_target)}) AS s2_t,
    min(x.rn) FILTER (WHERE x.price >= (x.or_low - {float(p.s2_buffer)}) + {float(p.s2_stop)}) AS s2_s
  FROM path x JOIN pst s ON x.contract = s.contract AND x.session_date = s.session_date
  WHERE x.direction = 'Short' AND x.or_width < {W} AND s.s2_time IS NOT NULL AND x.et >= s.s2_time
  GROUP BY ALL)""",
        """run AS (
  SELECT *,
    CASE WHEN direction = 'Long' THEN max(price) OVER w ELSE min(price) OVER w END AS ext
  FROM path
  WINDOW w AS (PARTITION BY contract, session_date ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
        f"""fire AS (
  SELECT contract, session_date, min(rn) AS f_rn FROM run
  WHERE tod >= {T10}
    AND ((direction = 'Long' AND ext >= entry + or_width * {float(p.s3_stretch)})
      OR (direction = 'Short' AND ext <= entry - or_width * {float(p.s3_stretch)}))
    AND ((direction = 'Long' AND price <= ext - greatest({float(p.s3_min_reversal)}, or_width))
      OR (direction = 'Short' AND price >= ext + greatest({float(p.s3_min_reversal)}, or_width)))
  GROUP BY ALL)""",
        f"""fade AS (
  SELECT r.contract, r.session_date, r.direction, r.et AS f_et, r.price AS f_price,
    CASE WHEN r.direction = 'Long' THEN r.ext + {float(p.s3_stop_beyond)}
         ELSE r.ext - {float(p.s3_stop_beyond)} END AS f_stop
  FROM run r JOIN fire f ON r.contract = f.contract AND r.session_date = f.session_date AND r.rn = f.f_rn)""",
        f"""fx AS (
  SELECT f.contract, f.session_date,
    min(x.rn) FILTER (WHERE (f.direction = 'Long' AND x.price <= f.f_price - {float(p.s3_target)})
                         OR (f.direction = 'Short' AND x.price >= f.f_price + {float(p.s3_target)})) AS x_t,
    min(x.rn) FILTER (WHERE (f.direction = 'Long' AND x.price >= f.f_stop)
                         OR (f.direction = 'Short' AND x.price <= f.f_stop)) AS x_s
  FROM fade f JOIN path x ON x.contract = f.contract AND x.session_date = f.session_date AND x.et >= f.f_et
  GROUP BY ALL)""",
        f"""trades AS (
  SELECT t.contract, t.session_date AS date, t.direction, t.or_high, t.or_low, t.or_width,
    t.daily_high, t.daily_low,
    greatest(0.0, CASE WHEN t.direction = 'Long' THEN s.hi - t.entry ELSE t.entry - s.lo END) + 0.0 AS mfe,
    greatest(0.0, CASE WHEN t.direction = 'Long' THEN t.entry - s.lo ELSE s.hi - t.entry END) + 0.0 AS mae,
    CASE WHEN t.direction = 'Long' THEN s.p_last - t.entry ELSE t.entry - s.p_last END AS last_profit,
    s.* EXCLUDE (contract, session_date), w.s2_t, w.s2_s, fd.f_price, fd.f_stop, fd.f_et, fx.x_t, fx.x_s
  FROM trd t JOIN pst s ON t.contract = s.contract AND t.session_date = s.session_date
  LEFT JOIN s2w w ON t.contract = w.contract AND t.session_date = w.session_date
  LEFT JOIN fade fd ON t.contract = fd.contract AND t.session_date = fd.session_date
  LEFT JOIN fx ON t.contract = fx.contract AND t.session_date = fx.session_date)""",
        f"""results AS (
  SELECT contract, date, direction, or_high, or_low, or_width, daily_high, daily_low, mfe, mae,
    CASE WHEN or_width < {W} THEN
      CASE WHEN s1_t IS NOT NULL AND (s1_s IS NULL OR s1_t < s1_s) THEN {float(p.s1_target)}
           WHEN s1_s IS NOT NULL THEN -{float(p.s1_stop)} ELSE last_profit END
      ELSE 0.0 END AS s1_vol_pnl,
    or_width < {W} AS s1_vol_trig,
    CASE WHEN direction = 'Short' AND or_width < {W} AND s2_time IS NOT NULL THEN
      CASE WHEN s2_t IS NOT NULL AND (s2_s IS NULL OR s2_t < s2_s) THEN {float(p.s2_target)}
           WHEN s2_s IS NOT NULL THEN -{float(p.s2_stop)}
           ELSE (or_low - {float(p.s2_buffer)}) - p_last END
      ELSE 0.0 END AS s2_short_pnl,
    (direction = 'Short' AND or_width < {W} AND s2_time IS NOT NULL) AS s2_short_trig,
    CASE WHEN f_et IS NOT NULL THEN
      CASE WHEN x_t IS NOT NULL AND (x_s IS NULL OR x_t < x_s) THEN {float(p.s3_target)}
           WHEN x_s IS NOT NULL THEN (CASE WHEN direction = 'Long' THEN f_price - f_stop ELSE f_stop - f_price END)
           ELSE (CASE WHEN direction = 'Long' THEN f_price - p_last ELSE p_last - f_price END) END
      ELSE 0.0 END AS s3_fade_pnl,
    f_et IS NOT NULL AS s3_fade_trig,
    CASE WHEN s4_t IS NOT NULL AND (s4_s IS NULL OR s4_t < s4_s) AND (s4_x IS NULL OR s4_t < s4_x) THEN {float(p.s4_target)}
         WHEN s4_s IS NOT NULL AND (s4_x IS NULL OR s4_s <= s4_x) THEN -{float(p.s4_stop)}
         WHEN s4_x IS NOT NULL THEN (CASE WHEN direction = 'Long' THEN s4_x_price - entry_p ELSE entry_p - s4_x_price END)
         ELSE last_profit END AS s4_time_pnl,
    TRUE AS s4_time_trig,
    CASE WHEN s0_t IS NOT NULL AND (s0_s IS NULL OR s0_t < s0_s) THEN {float(p.s0_target)}
         WHEN s0_s IS NOT NULL THEN -{float(p.s0_stop)} ELSE last_profit END AS s0_base_pnl
  FROM (SELECT *, CASE WHEN direction = 'Long' THEN or_high ELSE or_low END AS entry_p FROM trades))""",
        f"""final AS (
  SELECT * EXCLUDE (s0_base_pnl),
    CASE WHEN or_width < {W} THEN s4_time_pnl ELSE 0.0 END AS s5_master_pnl,
    or_width < {W} AS s5_master_trig
  FROM results)""",
    ]

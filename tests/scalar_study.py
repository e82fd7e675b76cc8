"""A plain tick-by-tick implementation of the study's day rules, used only
as a second oracle in tests.  One day at a time, walking the ticks in order."""

from __future__ import annotations

import datetime as dt


def _tod(t: dt.datetime) -> int:
    return ((t.hour * 60 + t.minute) * 60 + t.second) * 1_000_000 + t.microsecond


def day_result(ticks, p):
    """ticks: list of (et, record_no, price) for one Eastern date, any order.
    Returns None (skipped day) or a dict of the trade-row fields."""
    ticks = sorted(ticks, key=lambda r: (r[0], r[1]))
    if len(ticks) < p.min_day_ticks:
        return None
    in_or = [r for r in ticks if p.t_start <= _tod(r[0]) <= p.t_or_end]
    rth = [r for r in ticks if p.t_start <= _tod(r[0]) <= p.t_end]
    post = [r for r in ticks if p.t_or_end < _tod(r[0]) <= p.t_end]
    if not in_or:
        return None
    hi = max(r[2] for r in in_or)
    lo = min(r[2] for r in in_or)
    w = hi - lo
    out = dict(or_high=hi, or_low=lo, or_width=w,
               daily_high=max(r[2] for r in rth), daily_low=min(r[2] for r in rth),
               direction=None)
    ups = [r[0] for r in post if r[2] > hi]
    downs = [r[0] for r in post if r[2] < lo]
    t_up = min(ups) if ups else None
    t_dn = min(downs) if downs else None
    if t_up is not None and (t_dn is None or t_up < t_dn):
        direction, t_in, entry = "Long", t_up, hi
    elif t_dn is not None:
        direction, t_in, entry = "Short", t_dn, lo
    else:
        return out
    out["direction"] = direction
    sgn = 1.0 if direction == "Long" else -1.0
    path = [r for r in post if r[0] >= t_in]
    prices = [r[2] for r in path]

    def gain(price, ref):
        return price - ref if direction == "Long" else ref - price

    last_gain = gain(prices[-1], entry)
    out["mfe"] = max(0.0, max(gain(x, entry) for x in prices)) + 0.0
    out["mae"] = max(0.0, max(-gain(x, entry) for x in prices)) + 0.0

    def walk(target, stop, time_stop=False):
        for t, _, x in path:
            if gain(x, entry) >= target:
                return target
            if gain(x, entry) <= -stop:
                return -stop
            if time_stop and _tod(t) >= p.t_stop and gain(x, entry) < p.s4_min_profit:
                return gain(x, entry)
        return last_gain

    narrow = w < p.width_limit
    out["s0_base_pnl"] = walk(p.s0_target, p.s0_stop)
    out["s1_vol_trig"] = narrow
    out["s1_vol_pnl"] = walk(p.s1_target, p.s1_stop) if narrow else 0.0
    s4 = walk(p.s4_target, p.s4_stop, time_stop=True)
    out["s4_time_trig"] = True
    out["s4_time_pnl"] = s4
    out["s5_master_trig"] = narrow
    out["s5_master_pnl"] = s4 if narrow else 0.0

    out["s2_short_trig"], out["s2_short_pnl"] = False, 0.0
    if direction == "Short" and narrow:
        e2 = lo - p.s2_buffer
        hits = [r[0] for r in path if r[2] <= e2]
        if hits:
            t2 = min(hits)
            out["s2_short_trig"] = True
            pnl = e2 - post[-1][2]
            for t, _, x in post:
                if t < t2:
                    continue
                if x <= e2 - p.s2_target:
                    pnl = p.s2_target
                    break
                if x >= e2 + p.s2_stop:
                    pnl = -p.s2_stop
                    break
            out["s2_short_pnl"] = pnl

    out["s3_fade_trig"], out["s3_fade_pnl"] = False, 0.0
    extreme = prices[0]
    reached = False
    depth = max(p.s3_min_reversal, w)
    for t, _, x in path:
        extreme = max(extreme, x) if direction == "Long" else min(extreme, x)
        if gain(x, entry) >= w * p.s3_stretch:
            reached = True
        if reached and _tod(t) >= p.t_fade and (
                (direction == "Long" and x <= extreme - depth) or (direction == "Short" and x >= extreme + depth)):
            stop = extreme + sgn * p.s3_stop_beyond
            pnl = (x - prices[-1]) if direction == "Long" else (prices[-1] - x)
            for t2, _, y in post:
                if t2 < t:
                    continue
                if (direction == "Long" and y <= x - p.s3_target) or (direction == "Short" and y >= x + p.s3_target):
                    pnl = p.s3_target
                    break
                if (direction == "Long" and y >= stop) or (direction == "Short" and y <= stop):
                    pnl = (x - stop) if direction == "Long" else (stop - x)
                    break
            out["s3_fade_trig"], out["s3_fade_pnl"] = True, pnl
            break
    return out

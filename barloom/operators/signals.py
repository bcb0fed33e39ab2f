"""Exposure rules: bars -> bars with `target`, the exposure wanted after each close, 0 while warming up.

A rule is causal: a target depends on the bars up to it. Rules are long-only unless their name ends in -ls.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.operators import indicators as I
from barloom.operators import scans
from barloom.operators.folds import fold
from barloom.sources.bars import KEY, in_order

Rule = Callable[..., DataFrame]
#: A rule for many sets of parameters at once: bars with `__target{i}` for each, and `__exit{i}` where exits fill inside of a bar.
Many = Callable[[DataFrame, list[dict]], DataFrame]


@dataclass(frozen=True)
class Signal:
    name: str
    rule: Rule
    sweep: str
    fixed: dict = field(default_factory=dict)
    many: Many | None = None

    @property
    def defaults(self) -> dict:
        named = inspect.signature(self.rule).parameters
        return {k: p.default for k, p in named.items() if p.default is not inspect.Parameter.empty and k not in self.fixed}

    def filled(self, params: dict) -> dict:
        """All parameters of a run; unknown ones are refused."""
        unknown = set(params) - set(self.defaults)
        if unknown:
            raise ValueError(f"{self.name} takes {sorted(self.defaults)}, not {sorted(unknown)}")
        return {**self.defaults, **self.fixed, **params}

    def __call__(self, bars: DataFrame, **params) -> DataFrame:
        return self.rule(bars, **self.filled(params))


SIGNALS: dict[str, Signal] = {}


def register_signal(name: str, rule: Rule, sweep: str, *, many: Many | None = None, **fixed) -> None:
    """Adds a rule under a name; `sweep` names the parameter that a sweep varies by default, `fixed` what the name settles."""
    if name in SIGNALS:
        raise ValueError(f"{name} is there already")
    SIGNALS[name] = Signal(name, rule, sweep, fixed, many)


def signal(bars: DataFrame, name: str, **params) -> DataFrame:
    if name not in SIGNALS:
        raise ValueError(f"unknown signal {name!r}; there are {sorted(SIGNALS)}")
    return SIGNALS[name](bars, **params)


def targets(bars: DataFrame, name: str, grid: list[dict]) -> DataFrame:
    """bars with `__target{i}` for each set of parameters, and `__exit{i}` where exits fill inside of a bar.

    Rules of window expressions share one exchange whatever their number; those that walk have a form for many sets, with one walk for all.
    """
    if name not in SIGNALS:
        raise ValueError(f"unknown signal {name!r}; there are {sorted(SIGNALS)}")
    rule = SIGNALS[name]
    filled = [rule.filled(params) for params in grid]
    if rule.many is not None:
        return rule.many(bars, filled)
    rows = bars
    for i, params in enumerate(filled):
        rows = rule.rule(rows, **params).withColumnRenamed("target", f"__target{i}")
    return rows


def _single(rows: DataFrame) -> DataFrame:
    """targets() of one set of parameters under the names of a rule."""
    return rows.withColumnsRenamed({"__target0": "target", "__exit0": "exit_price"})


def _walked(rows: DataFrame, walks: list[Callable], exits: bool = False) -> DataFrame:
    """rows with what each walk(frame, state) -> (targets, exits, state) gives, all in one pass over a series."""

    def step(frame, states):
        found = [walk(frame, state) for walk, state in zip(walks, states or [None] * len(walks), strict=True)]
        columns = {"__targets": list(map(list, zip(*(t for t, _, _ in found), strict=True)))}
        if exits:
            columns["__exits"] = list(map(list, zip(*(e for _, e, _ in found), strict=True)))
        return columns, [state for _, _, state in found]

    out = fold(rows, KEY, step, {"__targets": "arrays"} | ({"__exits": "arrays"} if exits else {}))
    columns = {f"__target{i}": F.element_at("__targets", i + 1) for i in range(len(walks))}
    if exits:
        columns |= {f"__exit{i}": F.element_at("__exits", i + 1) for i in range(len(walks))}
    return out.withColumns(columns).drop("__targets", "__exits")


def describe() -> list[tuple[str, dict, str]]:
    return [(s.name, s.defaults, s.sweep) for s in SIGNALS.values()]


def _sides(bars: DataFrame, up: Column, down: Column, short: bool) -> DataFrame:
    target = F.when(F.coalesce(up, F.lit(False)), F.lit(1.0))
    if short:
        target = target.when(F.coalesce(down, F.lit(False)), F.lit(-1.0))
    return bars.withColumn("target", target.otherwise(F.lit(0.0)))


def _on_grid(bars: DataFrame, score: Column, rebalance: int, short: bool) -> DataFrame:
    """Reads a score's sign at the decision bars only and holds it in between."""
    rows = I.step_of(bars).withColumn("__score", score)
    rows = I.decisions(rows, rebalance, F.col("__score").isNotNull())
    side = F.when(F.col("__score") > 0, F.lit(1.0)).when(F.lit(short) & (F.col("__score") < 0), F.lit(-1.0)).when(F.col("__score").isNotNull(), F.lit(0.0))
    rows = rows.withColumn("__side", side)
    return rows.withColumn("target", F.coalesce(I.held(F.col("__side"), F.col("decide")), F.lit(0.0))).drop("__score", "__side", "decide", "step")


def sma_trend(bars: DataFrame, window: int = 200, rebalance: int = 1, short: bool = False) -> DataFrame:
    """Long above the moving average; short at or below it where shorts are allowed."""
    mean = I.sma(window)
    if rebalance > 1:
        return _on_grid(bars, F.signum(F.col("close") - mean), rebalance, short)
    return _sides(bars, F.col("close") > mean, F.col("close") <= mean, short)


def sma_reversion(bars: DataFrame, window: int = 200, short: bool = False) -> DataFrame:
    mean = I.sma(window)
    return _sides(bars, F.col("close") < mean, F.col("close") > mean, short)


def macd_crosses(bars: DataFrame, grid: list[dict]) -> DataFrame:
    """The line against its average; closer to each other than a double of the close can tell counts as equal."""
    rows = scans.with_macds(bars, [(p["fast"], p["slow"], p["signal"]) for p in grid])
    sides = {}
    for i, p in enumerate(grid):
        gap = F.col(f"line{i}") - F.col(f"trigger{i}")
        side = F.when(F.abs(gap) <= 1e-12 * F.abs(F.coalesce(F.nanvl("close", F.lit(0.0)), F.lit(0.0))), 0.0).when(gap > 0, 1.0).when(gap < 0, -1.0 if p["short"] else 0.0)
        sides[f"__target{i}"] = F.coalesce(side, F.lit(0.0))
    return rows.withColumns(sides).drop(*[f"{c}{i}" for c in ("line", "trigger") for i in range(len(grid))])


def macd_cross(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, short: bool = False) -> DataFrame:
    return _single(macd_crosses(bars, [{"fast": fast, "slow": slow, "signal": signal, "short": short}]))


def _channel_walk(i: int, min_hold: int, short: bool) -> Callable:
    """In and out of a channel with a least holding time; the state is the side and the bars since it was taken."""

    def walk(frame, state):
        side, age = state or (0, 0)
        out = []
        for close, eh, el, xh, xl in zip(frame["close"], *(frame[f"__{k}{i}"] for k in ("eh", "el", "xh", "xl")), strict=True):
            age += 1
            if eh == eh and eh is not None:
                turn = 1 if close > eh and side <= 0 else -1 if short and close < el and side >= 0 else 0
                if turn and (side == 0 or short):
                    side, age = turn, 0
                elif side and age >= min_hold and (close < xl if side > 0 else close > xh):
                    side = 0
            out.append(float(side))
        return out, None, (side, age)

    return walk


def breakouts(bars: DataFrame, grid: list[dict]) -> DataFrame:
    """In beyond the last `entry` bars' range, out beyond that of the last `exit_window` on the other side.

    Without a least holding time the long and the short side are latches of their own, and the position is
    their difference; with one the state is walked, for all such sets of parameters together.
    """
    so_far = in_order().rowsBetween(W.unboundedPreceding, 0)
    channels, latched, walks, c = {}, {}, {}, F.col("close")

    def latch(on: Column, off: Column) -> Column:
        mark = F.when(on, F.lit(1.0)).when(off, F.lit(0.0))
        return F.coalesce(F.last(mark, ignorenulls=True).over(so_far), F.lit(0.0))

    for i, p in enumerate(grid):
        warm = I.nth() > max(p["entry"], p["exit_window"])
        channels |= {f"__eh{i}": F.when(warm, I.channel_high(p["entry"])), f"__el{i}": F.when(warm, I.channel_low(p["entry"]))}
        channels |= {f"__xh{i}": F.when(warm, I.channel_high(p["exit_window"])), f"__xl{i}": F.when(warm, I.channel_low(p["exit_window"]))}
        eh, el, xh, xl = (F.col(f"__{k}{i}") for k in ("eh", "el", "xh", "xl"))
        if p["min_hold"]:
            walks[i] = _channel_walk(i, p["min_hold"], p["short"])
        elif p["short"]:
            latched[f"__target{i}"] = latch(c > eh, (c < xl) | (c < el)) - latch(c < el, (c > xh) | (c > eh))
        else:
            latched[f"__target{i}"] = latch(c > eh, c < xl)
    rows = bars.withColumns(channels).withColumns(latched)
    if walks:
        # the walks number their targets from 0: each goes to the place of its own parameters
        names = dict(enumerate(walks))
        rows = rows.withColumnsRenamed({k: f"__kept{k}" for k in latched})
        rows = _walked(rows, list(walks.values())).withColumnsRenamed({f"__target{k}": f"__walked{i}" for k, i in names.items()})
        rows = rows.withColumnsRenamed({f"__kept{k}": k for k in latched}).withColumnsRenamed({f"__walked{i}": f"__target{i}" for i in walks})
    return rows.drop(*channels)


def breakout(bars: DataFrame, entry: int = 20, exit_window: int = 10, min_hold: int = 0, short: bool = False) -> DataFrame:
    return _single(breakouts(bars, [{"entry": entry, "exit_window": exit_window, "min_hold": min_hold, "short": short}]))


def _stretched_walk(p: dict) -> Callable:
    """The state is the side and the bars since it was taken."""
    column = f"rsi{p['window']}"

    def walk(frame, state):
        side, age = state or (0, 0)
        out = []
        for level in frame[column]:
            age += 1
            known = level is not None and level == level
            if known:
                if side:
                    back = level > p["exit_level"] if side > 0 else level < p["exit_level"]
                    side = 0 if back or age >= p["max_hold"] else side
                elif level < p["oversold"] or (p["short"] and level > p["overbought"]):
                    side, age = 1 if level < p["oversold"] else -1, 0
            out.append(float(side) if known else 0.0)
        return out, None, (side, age)

    return walk


def rsi_reversions(bars: DataFrame, grid: list[dict]) -> DataFrame:
    """In when the index is stretched, out past the exit level or after max_hold bars; never in again on the bar of an exit."""
    windows = sorted({p["window"] for p in grid})
    return _walked(scans.with_rsis(bars, windows), [_stretched_walk(p) for p in grid]).drop(*[f"rsi{n}" for n in windows])


def rsi_reversion(
    bars: DataFrame, window: int = 2, oversold: float = 10, overbought: float = 90, exit_level: float = 50, max_hold: int = 10, short: bool = False
) -> DataFrame:
    given = {"window": window, "oversold": oversold, "overbought": overbought, "exit_level": exit_level, "max_hold": max_hold, "short": short}
    return _single(rsi_reversions(bars, [given]))


def momentum(bars: DataFrame, lookback: int = 720, rebalance: int = 168, threshold: float = 0.0, short: bool = False) -> DataFrame:
    move = I.change(lookback)
    score = F.when(move > threshold, 1.0).when(move < -threshold, -1.0).when(move.isNotNull(), 0.0)
    return _on_grid(bars, score, rebalance, short)


def momentum_blend(bars: DataFrame, base: int = 168, horizons: int = 4, rebalance: int = 168) -> DataFrame:
    """Long while the signs of the returns over base, 2 base, 4 base, ... bars are positive on the whole."""
    total = F.lit(0.0)
    for k in range(horizons):
        total = total + F.signum(I.change(base * 2**k))
    return _on_grid(bars, total / horizons, rebalance, False)


def _inner(params: dict, own: set[str], inner: str) -> dict:
    """What of a wrapped rule's parameters the inner rule takes; the window of volatility is its own too where it has one."""
    return {k: v for k, v in params.items() if k not in own | {"inner"} or k in SIGNALS[inner].defaults}


def vol_targets(bars: DataFrame, inner: str, grid: list[dict]) -> DataFrame:
    """An inner rule's exposure times target over realised volatility, between floor and cap; unscaled under `least` returns."""
    given = [{"target_vol": 0.4, "vol_window": 168, "cap": 1.0, "floor": 0.0, "least": 20, **p} for p in grid]
    rows = I.step_of(targets(bars, inner, [_inner(p, {"target_vol", "vol_window", "cap", "floor", "least"}, inner) for p in given]))
    kinds = sorted({(p["vol_window"], p["least"]) for p in given})
    for window, least in kinds:
        rows = I.with_volatility(rows, window, least).withColumnRenamed("vol", f"__vol{window}_{least}")
    scaled = {}
    for i, p in enumerate(given):
        vol, cap, target = F.col(f"__vol{p['vol_window']}_{p['least']}"), p["cap"], F.col(f"__target{i}")
        scale = F.when(vol.isNull(), F.lit(1.0)).when(vol <= 0, F.lit(cap)).otherwise(F.greatest(F.lit(p["floor"]), F.least(F.lit(cap), F.lit(p["target_vol"]) / F.nullif(vol, F.lit(0.0)))))
        scaled[f"__target{i}"] = F.greatest(F.lit(-cap), F.least(F.lit(cap), target * scale))
    return rows.withColumns(scaled).drop(*[f"__vol{w}_{n}" for w, n in kinds], "step")


def vol_target(
    bars: DataFrame, inner: str = "sma", target_vol: float = 0.4, vol_window: int = 168, cap: float = 1.0, floor: float = 0.0, least: int = 20, **params
) -> DataFrame:
    return _single(vol_targets(bars, inner, [{"target_vol": target_vol, "vol_window": vol_window, "cap": cap, "floor": floor, "least": least, **params}]))


def vol_filter(bars: DataFrame, inner: str = "sma", max_vol: float = 0.8, vol_window: int = 168, **params) -> DataFrame:
    """An inner rule while realised volatility is at most max_vol, or not known yet; else out."""
    rows = I.with_volatility(I.step_of(signal(bars, inner, **params)), vol_window)
    calm = F.col("vol").isNull() | (F.col("vol") <= max_vol)
    return rows.withColumn("target", F.when(calm, F.col("target")).otherwise(F.lit(0.0))).drop("vol", "step")


class _Holding:
    """What one open position may still lose or win: levels are counted from its entry close and its best close."""

    def __init__(self, side: int, close: float):
        self.side, self.entry, self.best = side, close, close

    def fill(self, o: float, h: float, l: float, stop: float, profit: float, trail: float) -> float | None:  # noqa: E741
        """Where a level inside a bar fills, the worst first; a stop that is gapped fills at the open."""
        worst, best = (l, h) if self.side > 0 else (h, l)
        beyond = lambda price, level: (price - level) * self.side <= 0
        for share, base, against in ((stop, self.entry, True), (profit, self.entry, False), (trail, self.best, True)):
            if share and base:
                level = base * (1 + (-share if against else share) * self.side)
                if against and beyond(worst, level):
                    return min(level, o) if self.side > 0 else max(level, o)
                if not against and beyond(level, best):
                    return level
        return None

    def spent(self, close: float, stop: float, profit: float, trail: float) -> bool:
        """Whether the close itself lies beyond a level."""
        won = (close / self.entry - 1) * self.side if self.entry else 0.0
        slid = (close / self.best - 1) * self.side if self.best else 0.0
        return bool((stop and won <= -stop) or (profit and won >= profit) or (trail and slid <= -trail))


def _stops_walk(i: int, p: dict) -> Callable:
    """The state is the open position, side, entry and best close, and the bars that are still to be sat out."""
    levels = (p["stop_loss"], p["take_profit"], p["trail"])

    def walk(frame, state):
        position, wait = state or (None, 0)
        held: _Holding | None = None
        if position:
            held = _Holding(position[0], position[1])
            held.best = position[2]
        out, fills = [], []
        for want, o, h, l, c in zip(frame[f"__target{i}"], *(frame[k] for k in ("open", "high", "low", "close")), strict=True):  # noqa: E741
            side = (want > 0) - (want < 0)
            fill, left, wait = None, False, max(wait - 1, 0)
            if held is None:
                held = _Holding(side, c) if side and not wait else None
            else:
                fill = held.fill(o, h, l, *levels)
                if fill is None:
                    held.best = max(held.best, c) if held.side > 0 else min(held.best, c)
                    if side and side != held.side:
                        held = _Holding(side, c)
                    elif side:
                        left = held.spent(c, *levels)
                if fill is not None or left:
                    wait = 1 + p["cooldown"]
                if fill is not None or left or not side:
                    held = None
            out.append(float(want) if held is not None else 0.0)
            fills.append(fill)
        return out, fills, (None if held is None else [int(held.side), float(held.entry), float(held.best)], wait)

    return walk


def many_stops(bars: DataFrame, inner: str, grid: list[dict]) -> DataFrame:
    """An inner rule with exits inside of the bar: targets and exit prices. After an exit, the position stays out for `cooldown` bars more."""
    given = [{"take_profit": 0.0, "stop_loss": 0.0, "trail": 0.0, "cooldown": 0, **p} for p in grid]
    rows = targets(bars, inner, [_inner(p, {"take_profit", "stop_loss", "trail", "cooldown"}, inner) for p in given])
    wanted = [f"__target{i}" for i in range(len(grid))]
    kept = [c for c in rows.columns if c not in wanted]
    walked = _walked(rows.select(*kept, *wanted), [_stops_walk(i, p) for i, p in enumerate(given)], exits=True)
    return walked.select(*kept, *[f"__{k}{i}" for i in range(len(grid)) for k in ("target", "exit")])


def stops(
    bars: DataFrame, inner: str = "sma", take_profit: float = 0.0, stop_loss: float = 0.0, trail: float = 0.0, cooldown: int = 0, **params
) -> DataFrame:
    return _single(many_stops(bars, inner, [{"take_profit": take_profit, "stop_loss": stop_loss, "trail": trail, "cooldown": cooldown, **params}]))


def liquid_only(rows: DataFrame, window: int, least: float) -> DataFrame:
    """Out while the median turnover of `window` bars is below `least` or not known."""
    return rows.withColumn("target", F.when(I.median_turnover(window) >= least, F.col("target")).otherwise(F.lit(0.0)))


def masked(rows: DataFrame, mask: DataFrame) -> DataFrame:
    """Out where mask (series, time, liquid) says so; bars that it doesn't have are in."""
    joined = rows.join(mask.select(*KEY, "time", "liquid"), [*KEY, "time"], "left")
    return joined.withColumn("target", F.when(F.coalesce("liquid", F.lit(True)), F.col("target")).otherwise(F.lit(0.0))).drop("liquid")


def _register_wrapped(name: str, rule: Rule, inner: str, sweep: str, own: dict, many: Callable | None = None) -> None:
    register_signal(name, _wrapped(rule, inner, own), sweep, many=many and (lambda bars, grid: many(bars, inner, grid)))


def _wrapped(rule: Rule, inner: str, own: dict) -> Rule:
    """A rule around an inner one whose parameters are passed on under their own names."""
    named = {**SIGNALS[inner].defaults, **own}

    def rule_of(bars: DataFrame, **params) -> DataFrame:
        return rule(bars, inner=inner, **{**named, **params})

    kind = inspect.Parameter.KEYWORD_ONLY
    rule_of.__signature__ = inspect.Signature([inspect.Parameter(k, kind, default=v) for k, v in named.items()])
    return rule_of


register_signal("sma", sma_trend, "window", short=False)
register_signal("sma-ls", sma_trend, "window", short=True, rebalance=1)
register_signal("sma-rev", sma_reversion, "window", short=False)
register_signal("sma-rev-ls", sma_reversion, "window", short=True)
for _end, _short in (("", False), ("-ls", True)):
    register_signal("macd" + _end, macd_cross, "fast", many=macd_crosses, short=_short)
    register_signal("breakout" + _end, breakout, "entry", many=breakouts, short=_short)
    register_signal("rsi-rev" + _end, rsi_reversion, "window", many=rsi_reversions, short=_short)
register_signal("tsmom", momentum, "lookback", short=False)
register_signal("tsmom-ls", momentum, "lookback", short=True)
register_signal("tsmom-blend", momentum_blend, "base")
_VOL = {"target_vol": 0.4, "vol_window": 168, "cap": 1.0}
_register_wrapped("voltarget-sma", vol_target, "sma", "window", _VOL, vol_targets)
_register_wrapped("voltarget-sma-ls", vol_target, "sma-ls", "window", _VOL, vol_targets)
_register_wrapped("voltarget-tsmom", vol_target, "tsmom", "lookback", _VOL, vol_targets)
_CALM = {"max_vol": 0.8, "vol_window": 168}
_register_wrapped("volfilter-sma", vol_filter, "sma", "window", _CALM)
_register_wrapped("volfilter-tsmom", vol_filter, "tsmom", "lookback", {**_CALM, "lookback": 30, "rebalance": 7})
_register_wrapped("voltarget-volfilter-sma", vol_target, "volfilter-sma", "window", _VOL, vol_targets)
_EXITS = {"take_profit": 0.0, "stop_loss": 0.0, "trail": 0.0, "cooldown": 0}
_register_wrapped("stops-sma", stops, "sma", "stop_loss", _EXITS, many_stops)
_register_wrapped("stops-breakout", stops, "breakout", "stop_loss", _EXITS, many_stops)
_register_wrapped("voltarget-stops-sma", vol_target, "stops-sma", "stop_loss", _VOL, vol_targets)

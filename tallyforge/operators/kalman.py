"""Motion of a series by two interacting seven-state Kalman filters, and a direction with hysteresis.

The recursion is not linear, so a series is one stream. Rows go to their series once, sorted, and a worker
reads them batch by batch with the filter's state alone in memory; a long series needs time, not memory.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass
from math import factorial, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

EPS = 1e-10


@dataclass(frozen=True)
class Motion:
    """Noise of one model: of the process by state, and of the observed price, velocity and acceleration."""

    process: tuple[float, ...]
    price: float
    velocity: float
    acceleration: float
    acceleration_likelihood: float


# Fixed values.
CALM = Motion((0.020, 0.050, 0.010, 0.002, 0.0004, 0.00008, 0.000016), 0.400, 0.500, 5.0, 0.5)
MOVING = Motion((0.020, 0.150, 0.030, 0.006, 0.0012, 0.00024, 0.000048), 0.400, 5.3194, 50.0, 5.3)
SWITCH = np.array([[0.7837, 0.2163], [0.5730, 0.4270]])  # from row to column
STATES = ("position", "velocity", "acceleration", "jerk", "snap", "crackle", "pop")
COLUMNS = (
    "atr_14", "velocity_observation", "velocity_ema_5", *STATES, "mu_mv", "mu_ma", "observation_trust", "r_price_inflation", "r_velocity_inflation",
    "css_direction", "css_count", "css_raw", "flip_gauge", "fingerprint_6bit", "corrected_direction", "bull_flip", "bear_flip",
)

_SIZE = len(STATES)
_STEP = np.array([[1.0 / factorial(c - r) if c >= r else 0.0 for c in range(_SIZE)] for r in range(_SIZE)])


@dataclass(frozen=True)
class Options:
    velocity: str = "blend"  # midpoint, ohlc4, clv or blend
    linear_scale: bool = False
    adaptive: bool = True
    corrector: bool = True

    def __post_init__(self):
        if self.velocity not in ("midpoint", "ohlc4", "clv", "blend"):
            raise ValueError(f"unknown velocity: {self.velocity}")


class _Smooth:
    """An exponential mean that starts with its first value."""

    def __init__(self, weight: float):
        self.weight, self.now = weight, None

    def __call__(self, x: float) -> float:
        self.now = x if self.now is None else self.now + self.weight * (x - self.now)
        return self.now


class Tracker:
    """The state of one series; step() takes a bar and gives the values of COLUMNS."""

    def __init__(self, options: Options = Options()):
        self.options, self.n = options, 0
        self.atr, self.atr_level = _Smooth(1 / 14), _Smooth(2 / 201)
        self.speed_level, self.speed_mean, self.speed_out = _Smooth(2 / 51), _Smooth(2 / 6), _Smooth(2 / 6)
        self.volumes: deque[float] = deque(maxlen=20)
        self.x, self.p, self.weights = np.zeros((2, _SIZE)), np.zeros((2, _SIZE, _SIZE)), np.array([0.5, 0.5])
        self.close = self.mid = self.ohlc4 = self.speed = self.energy = 0.0
        self.prior = np.zeros(_SIZE)
        self.side = self.count = self.ups = self.downs = 0

    _PLAIN = ("n", "close", "mid", "ohlc4", "speed", "energy", "side", "count", "ups", "downs")
    _MEANS = ("atr", "atr_level", "speed_level", "speed_mean", "speed_out")

    def numbers(self) -> list[float]:
        """The state as numbers, from which of() makes it again."""
        means = [float("nan") if (m := getattr(self, name).now) is None else m for name in self._MEANS]
        return [*(float(getattr(self, name)) for name in self._PLAIN), *map(float, means), *self.weights.tolist(), *map(float, self.prior), *self.x.ravel().tolist(), *self.p.ravel().tolist(), *map(float, self.volumes)]

    @classmethod
    def of(cls, numbers: list[float], options: Options = Options()) -> Tracker:
        """The tracker whose numbers() these are."""
        made, left = cls(options), iter(numbers)
        take = lambda n: [next(left) for _ in range(n)]
        for name, value in zip(cls._PLAIN, take(len(cls._PLAIN)), strict=True):
            setattr(made, name, type(getattr(made, name))(value))
        for name, value in zip(cls._MEANS, take(len(cls._MEANS)), strict=True):
            getattr(made, name).now = None if value != value else value
        made.weights, made.prior = np.array(take(2)), np.array(take(_SIZE))
        made.x, made.p = np.array(take(2 * _SIZE)).reshape(2, _SIZE), np.array(take(2 * _SIZE * _SIZE)).reshape(2, _SIZE, _SIZE)
        made.volumes.extend(left)
        return made

    def _observe(self, o: float, h: float, l: float, c: float, v: float | None) -> tuple:  # noqa: E741
        wide = h - l if not self.n else max(h - l, abs(h - self.close), abs(l - self.close))
        reach = max(self.atr(wide), 1e-4)
        level = max(self.atr_level(reach), 1e-4)
        v = 1.0 if v is None or v != v else max(v, 0.0)
        self.volumes.append(v)
        mass = max(np.log1p(v / max(sum(self.volumes) / len(self.volumes), 1.0)) / log(2.0), 0.1)
        mid, ohlc4 = (h + l) * 0.5, (o + h + l + c) * 0.25
        first = not self.n
        by_mid, by_ohlc4, by_close = 0.0 if first else mid - self.mid, 0.0 if first else ohlc4 - self.ohlc4, 2.0 * (c - mid)
        speed = {"midpoint": by_mid, "ohlc4": by_ohlc4, "clv": by_close, "blend": 0.5 * (by_mid + by_close)}[self.options.velocity]
        push = 0.0 if first else speed - self.speed
        if first:
            self.x[:, 0] = mid
            self.p[:] = np.diag([1000.0] * 3 + [100.0] * 4)
        self.close, self.mid, self.ohlc4, self.speed = c, mid, ohlc4, speed
        return reach, level, mass, mid, speed, push, self.speed_level(abs(speed))

    def _mix(self) -> np.ndarray:
        """Models start a step as mixtures of both; the weights that they are to have."""
        ahead = SWITCH.T @ self.weights
        share = SWITCH * self.weights[:, None] / np.maximum(ahead, EPS)  # source, destination
        x = share.T @ self.x
        apart = self.x[None] - x[:, None]  # destination, source, state
        p = np.einsum("sd,sij->dij", share, self.p) + np.einsum("sd,dsi,dsj->dij", share, apart, apart)
        self.x, self.p = x, 0.5 * (p + p.transpose(0, 2, 1))
        return ahead

    def _advance(self, k: int, motion: Motion, seen: tuple[float, ...], noise: tuple[float, ...], judge: tuple[float, ...], scale: float) -> float:
        """Moves model k a step on and takes in the observations; their log-likelihood."""
        drift = np.array(motion.process)
        drift[1] *= scale
        x, p, total = _STEP @ self.x[k], _STEP @ self.p[k] @ _STEP.T + np.diag(drift), 0.0
        for i, (z, r, r_judge) in enumerate(zip(seen, noise, judge, strict=True)):
            error, spread = z - x[i], max(p[i, i] + r, EPS)
            gain = p[:, i] / spread
            keep = np.eye(_SIZE)
            keep[:, i] -= gain
            judged = max(p[i, i] + r_judge, EPS)
            total -= 0.5 * (error * error / judged + log(2 * np.pi * judged))
            x = x + gain * error
            p = keep @ p @ keep.T + np.outer(gain, gain) * r
            p = 0.5 * (p + p.T)
        self.x[k], self.p[k] = x, p
        return total

    def step(self, o: float, h: float, l: float, c: float, v: float | None = None) -> tuple[float, ...]:  # noqa: E741
        opt = self.options
        reach, level, mass, mid, speed, push, speed_level = self._observe(o, h, l, c, v)
        ahead = self._mix()
        off_price = abs(mid - ahead @ self.x[:, 0]) / reach
        off_speed = abs(speed - ahead @ self.x[:, 1]) / max(speed_level, 0.1 * reach)
        energy = off_price**2 + off_speed**2
        if self.n:
            change = abs(energy - self.energy) / (1 + abs(self.energy))
            self.energy += (0.04 + 0.7 * change / (1 + change)) * (energy - self.energy)
        else:
            self.energy = energy
        trust = 1 / (1 + 0.1 * self.energy)
        more_price = 1 / max(trust, 1e-6) if opt.adaptive else 1.0
        more_speed = more_price**0.5 if opt.adaptive else 1.0
        ratio = reach / level
        scale = ratio if opt.linear_scale else ratio * ratio
        fit = np.zeros(2)
        for k, motion in enumerate((CALM, MOVING)):
            noise = (motion.price * more_price, motion.velocity * scale / mass * more_speed, motion.acceleration * scale)
            fit[k] = self._advance(k, motion, (mid, speed, push), noise, (*noise[:2], motion.acceleration_likelihood * scale), scale)
        score = np.log(np.maximum(ahead, EPS)) + fit
        w = np.exp(score - score.max())
        self.weights = w / w.sum()
        state = self.weights @ self.x
        return self._direct(state, reach, trust, more_price, more_speed, speed)

    def _direct(self, state: np.ndarray, reach: float, trust: float, more_price: float, more_speed: float, speed: float) -> tuple[float, ...]:
        mean, limit, before = self.speed_mean(state[1]), 0.02 * reach, self.side
        self.downs = self.downs + 1 if mean < -limit else 0
        self.ups = self.ups + 1 if mean > limit else 0
        side = before
        if side == 0:
            side = int(mean > 0) - int(mean < 0)
        elif side == 1 and self.downs >= 3:
            side, self.downs = -1, 0
        elif side == -1 and self.ups >= 3:
            side, self.ups = 1, 0
        raw = side
        if self.options.corrector and before and side and side != before and state[6] * before > 0 and state[5] * before > 0 and state[1] * before < 0:
            side, self.ups, self.downs = before, 0, 0
        if side == before or before == 0:
            self.count += 1
        elif side:
            self.count = 1
        _, _, accel, jerk, snap, crackle, _ = state
        rising = crackle > 0 and snap > 0 and jerk > 0 and accel < 0 and state[1] < 0 and jerk > self.prior[3] and self.prior[1] < 0
        falling = crackle < 0 and snap < 0 and jerk < 0 and accel > 0 and state[1] > 0 and jerk < self.prior[3] and self.prior[1] > 0
        signs = sum(1 << (i - 1) for i in range(1, _SIZE) if state[i] > 0)
        gauge = (mean + limit if side > 0 else limit - mean) / max(limit, EPS)
        self.side, self.prior, self.n = side, state, self.n + 1
        return (
            reach, speed, self.speed_out(state[1]), *state, *self.weights, trust, more_price, more_speed, side, self.count, raw, gauge, signs,
            int(rising) - int(falling), int(side > 0 and before <= 0), int(side < 0 and before >= 0),
        )


def imm_kalman(bars: DataFrame, group: tuple[str, ...] = ("symbol",), order: str = "ts", options: Options = Options()) -> DataFrame:
    """bars (open, high, low, close, volume) with COLUMNS, series by series."""
    if clash := {c.lower() for c in bars.columns} & set(COLUMNS):
        raise ValueError(f"columns exist already: {sorted(clash)}")
    prices = ("open", "high", "low", "close", "volume")

    def run(batches):
        key, tracker = None, None
        for b in batches:
            keys = list(zip(*(b[c].to_pylist() for c in group), strict=True)) if group else [()] * b.num_rows
            rows = zip(*(b[c].cast(pa.float64()).to_pylist() for c in prices), strict=True)
            out = []
            for own, row in zip(keys, rows, strict=True):
                if tracker is None or own != key:
                    key, tracker = own, Tracker(options)
                out.append(tracker.step(*row))
            cols = [pa.array(np.array(c, float)) for c in zip(*out, strict=True)] if out else [pa.array([], pa.float64())] * len(COLUMNS)
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], [*b.schema.names, *COLUMNS])

    kinds = T.StructType([*bars.schema.fields, *(T.StructField(c, T.DoubleType()) for c in COLUMNS)])
    return bars.repartition(*group).sortWithinPartitions(*group, order).mapInArrow(run, kinds)

"""A gated recurrent layer in numpy: forward, backpropagation through time, Adam.

Arrays are feature by batch, so that every gate is one contiguous block.  Inputs are ids: each
id has its own column of gate inputs.
"""

from __future__ import annotations

import numpy as np


def bend(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), in place: the cheap sigmoid shape used for states and gates."""
    d = np.abs(x)
    d += 1
    x /= d
    return x


def gate(x: np.ndarray) -> np.ndarray:
    """The same shape between 0 and 1, in place."""
    bend(x)
    x *= 0.5
    x += 0.5
    return x


class Gru:
    """z, r = gate(W[id] + U h); n = bend(W[id] + r * U h); h = n + z * (h - n)."""

    def __init__(self, inputs: int, hidden: int, rng: np.random.Generator):
        self.hidden = hidden
        self.w = (rng.standard_normal((3 * hidden, inputs)) * 0.3).astype(np.float32)
        self.u = (rng.standard_normal((3 * hidden, hidden)) / np.sqrt(hidden)).astype(np.float32)

    def step(self, ids: np.ndarray, h: np.ndarray) -> np.ndarray:
        k = self.hidden
        x = self.w.take(ids, axis=1, mode="clip")
        u = self.u @ h
        x[: 2 * k] += u[: 2 * k]
        gates = gate(x[: 2 * k])
        n = x[2 * k :]
        u = u[2 * k :]
        u *= gates[k:]
        n += u
        bend(n)
        out = h - n
        out *= gates[:k]
        out += n
        return out

    def run(self, ids: np.ndarray, h: np.ndarray, keep: np.ndarray | None = None) -> tuple[np.ndarray, list]:
        """States after each of the T rows of ``ids``; ``keep`` (T, B) clears states before a step."""
        states, memory = [], []
        k = self.hidden
        for t in range(len(ids)):
            if keep is not None:
                h = h * keep[t]
            x = self.w.take(ids[t], axis=1)
            u = self.u @ h
            gates = gate(x[: 2 * k] + u[: 2 * k])
            n = bend(x[2 * k :] + gates[k:] * u[2 * k :])
            out = n + gates[:k] * (h - n)
            memory.append((h, gates, u[2 * k :], n))
            states.append(out)
            h = out
        return np.stack(states), memory

    def back(self, ids: np.ndarray, memory: list, wrong: np.ndarray, keep: np.ndarray | None = None) -> list[np.ndarray]:
        """Gradients of w and u from the gradients ``wrong`` (T, H, B) of the states."""
        k = self.hidden
        du = np.zeros_like(self.u)
        dw_parts = []
        carried = np.zeros_like(wrong[0])
        for t in range(len(ids) - 1, -1, -1):
            h, gates, un, n = memory[t]
            z, r = gates[:k], gates[k:]
            d = wrong[t] + carried
            dn = d * (1 - z) * (1 - np.abs(n)) ** 2
            dz = d * (h - n) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
            dr = dn * un * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
            dx = np.concatenate([dz, dr, dn])
            dun = np.concatenate([dz, dr, dn * r])
            du += dun @ h.T
            carried = d * z + self.u.T @ dun
            if keep is not None:
                carried = carried * keep[t]
            dw_parts.append(dx)
        flat = ids[::-1].ravel()
        order = np.argsort(flat, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(flat[order]) > 0]))
        dw = np.zeros_like(self.w)
        dw[:, flat[order][first]] = np.add.reduceat(np.concatenate(dw_parts, axis=1)[:, order], first, axis=1)
        return [dw, du]

    def back_wide(self, ids: np.ndarray, memory: list, wrong: np.ndarray, keep: np.ndarray) -> list[np.ndarray]:
        """What ``back`` gives, for many streams: all that does not depend on later steps is worked out for all steps at once."""
        k = self.hidden
        h, gates, un, n = (np.stack(x) for x in zip(*memory))
        z, r = gates[:, :k], gates[:, k:]
        slope = 2 * gates
        slope -= 1
        np.abs(slope, out=slope)
        np.subtract(1, slope, out=slope)
        slope *= slope
        slope *= 0.5
        slope[:, :k] *= h - n
        slope[:, k:] *= un
        inner = 1 - np.abs(n)
        inner *= inner
        inner *= 1 - z
        steps, _, streams = wrong.shape
        # feature by step and stream, so that sums over both are one product
        dx = np.empty((3 * k, steps, streams), dtype=wrong.dtype)
        dun = np.empty((3 * k, streams), dtype=wrong.dtype)
        du = np.zeros_like(self.u)
        turned = np.ascontiguousarray(self.u.T)
        carried = np.zeros_like(wrong[0])
        for t in range(steps - 1, -1, -1):
            d = wrong[t] + carried
            dn = d * inner[t]
            np.multiply(d, slope[t, :k], out=dun[:k])
            np.multiply(dn, slope[t, k:], out=dun[k : 2 * k])
            np.multiply(dn, r[t], out=dun[2 * k :])
            dx[: 2 * k, t] = dun[: 2 * k]
            dx[2 * k :, t] = dn
            du += dun @ h[t].T
            carried = turned @ dun
            d *= z[t]
            carried += d
            carried *= keep[t]
        flat = ids.ravel()
        order = np.argsort(flat.astype(np.int16) if len(self.w[0]) < 2**15 else flat, kind="stable")
        ranked = flat[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        dw = np.zeros_like(self.w)
        dw[:, ranked[first]] = np.add.reduceat(dx.reshape(3 * k, -1).take(order, axis=1), first, axis=1)
        return [dw, du]


class Adam:
    """Adam with gradients clipped by their norm; changes the parameters in place."""

    def __init__(self, params: list[np.ndarray], rate: float):
        self.params, self.rate, self.turn = params, rate, 0
        self.m = [np.zeros_like(p) for p in params]
        self.v = [np.zeros_like(p) for p in params]

    def update(self, grads: list[np.ndarray], scale: float = 1.0) -> None:
        self.turn += 1
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads)))
        shrink = min(1.0, 1.0 / max(norm, 1e-9))
        for p, g, m, v in zip(self.params, grads, self.m, self.v):
            g = g * np.float32(shrink)
            part = g - m
            part *= 0.1
            m += part
            np.multiply(g, g, out=part)
            part -= v
            part *= 0.005
            v += part
            np.divide(v, 1 - 0.995**self.turn, out=part)
            np.sqrt(part, out=part)
            part += 1e-8
            step = np.divide(m, 1 - 0.9**self.turn, out=g)
            step /= part
            step *= self.rate * scale
            p -= step


class Streams:
    """The same layer stream by feature: a stream's state, and what an id brings to a gate, lie together.

    The gates come in the order r, z, n: ``w`` is (gate, id, feature), ``u`` has a matrix for each gate.
    """

    def __init__(self, layer: Gru):
        k = self.hidden = layer.hidden
        self.rooms: dict[tuple, np.ndarray] = {}
        self.w, self.u = (np.ascontiguousarray(x.reshape(3, k, -1)[[1, 0, 2]].transpose(0, 2, 1)) for x in (layer.w, layer.u))

    def room(self, name: str, *shape: int) -> np.ndarray:
        """An array to work in, the same each time; it begins where a line of a processor's cache begins."""
        if (name, shape) not in self.rooms:
            size = 4 * int(np.prod(shape))
            raw = np.empty(size + 64, dtype=np.uint8)
            start = -raw.ctypes.data % 64
            self.rooms[name, shape] = raw[start : start + size].view(np.float32).reshape(shape)
        return self.rooms[name, shape]

    def put(self, layer: Gru) -> None:
        """Write the weights back."""
        for x, to in ((self.w, layer.w), (self.u, layer.u)):
            to[...] = x[[1, 0, 2]].transpose(0, 2, 1).reshape(to.shape)

    def step(self, ids: np.ndarray, h: np.ndarray) -> np.ndarray:
        x, u = self.w.take(ids, axis=1), h @ self.u
        gates, n, part = x[:2], x[2], u[2]
        gates += u[:2]
        gate(gates)
        part *= gates[0]
        n += part
        bend(n)
        out = h - n
        out *= gates[1]
        out += n
        return out

    def run(self, ids: np.ndarray, h: np.ndarray, fresh: list[np.ndarray]) -> tuple[np.ndarray, tuple]:
        """States (T, B, H) after each of the T rows of ``ids``; ``fresh`` has the streams whose states are cleared before a step.

        The memory has all states, z, and what the way back multiplies with: r and the slopes of
        r, z (both halved) and n.  It holds until the next run.
        """
        (steps, streams), k = ids.shape, self.hidden
        x = self.room("x", 3, steps, streams, k)
        np.take(self.w, ids, axis=1, out=x, mode="clip")
        factors, states = self.room("factors", 4, steps, streams, k), self.room("states", steps + 1, streams, k)
        u, d, part = self.room("u", 3, streams, k), self.room("d", 3, streams, k), self.room("part", streams, k)
        states[0] = h
        for t in range(steps):
            old, out, gates, n, slopes = states[t], states[t + 1], x[:2, t], x[2, t], factors[1:, t]
            if len(fresh[t]):
                old = old.copy()
                old[fresh[t]] = 0
            np.matmul(old, self.u, out=u)
            gates += u[:2]
            np.abs(gates, out=d[:2])
            d[:2] += 1
            np.divide(0.5, d[:2], out=slopes[:2])
            gates *= slopes[:2]
            r, z = factors[0, t], gates[1]
            np.add(gates[0], 0.5, out=r)
            z += 0.5
            np.multiply(r, u[2], out=part)
            n += part
            np.abs(n, out=d[2])
            d[2] += 1
            np.reciprocal(d[2], out=slopes[2])
            n *= slopes[2]
            np.subtract(old, n, out=out)
            slopes *= slopes
            slopes[0] *= u[2]
            slopes[1] *= out
            np.subtract(1, z, out=part)
            slopes[2] *= part
            out *= z
            out += n
        return states[1:], (states, x[1], factors)

    def back(self, ids: np.ndarray, memory: tuple, wrong: np.ndarray, fresh: list[np.ndarray]) -> list[np.ndarray]:
        """Gradients of w and u from the gradients ``wrong`` (T, B, H) of the states."""
        states, z, factors = memory
        steps, streams, k = wrong.shape
        # what came over r * U h, then r, z and n; the last row is none's
        parts = self.room("parts", 4, steps * streams + 1, k)
        parts[:, -1] = 0
        turned = np.ascontiguousarray(self.u[[2, 0, 1]].transpose(0, 2, 1))
        turned[1:] *= 2
        carried, d, sent = self.room("carried", streams, k), self.room("part", streams, k), self.room("u", 3, streams, k)
        carried[...] = 0
        for t in range(steps - 1, -1, -1):
            now, by = parts[:, t * streams : (t + 1) * streams], factors[:, t]
            np.add(wrong[t], carried, out=d)
            np.multiply(d, by[2:], out=now[2:])
            np.multiply(now[3], by[:2], out=now[:2])
            np.matmul(now[:3], turned, out=sent)
            np.multiply(d, z[t], out=carried)
            carried += sent[0]
            carried += sent[1]
            carried += sent[2]
            if len(fresh[t]):
                carried[fresh[t]] = 0
        before = states[:-1].copy()
        for t in range(steps):
            before[t, fresh[t]] = 0
        du = np.matmul(before.transpose(0, 2, 1), parts[:3, :-1].reshape(3, steps, streams, k)).sum(axis=1)[[1, 2, 0]]
        du[:2] *= 2
        at, sums = sums_by(ids.ravel(), parts[1:], self.w.shape[1])
        sums[:2] *= 2
        dw = np.zeros_like(self.w)
        dw[:, at] = sums
        return [dw, du]


def sums_by(keys: np.ndarray, rows: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, below ``most``, and for each table the sums of their rows.

    ``rows`` (tables, keys + 1, features) ends with a row of zeros.  Rows of a key are added by
    fours, as whole arrays, before the rest is added one by one.
    """
    order = np.argsort(keys.astype(np.int16) if most < 2**15 else keys, kind="stable")
    ranked = keys[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    counts = np.diff(np.append(first, len(order)))
    ends = np.cumsum(-(-counts // 4))
    begin = np.append(0, ends[:-1])
    spot = np.full(4 * int(ends[-1]), len(keys))
    spot[np.arange(len(keys)) + np.repeat(4 * begin - first, counts)] = order
    total = rows.take(spot[::4], axis=1)
    for j in (1, 2, 3):
        total += rows.take(spot[j::4], axis=1)
    return ranked[first], np.add.reduceat(total, begin, axis=1)

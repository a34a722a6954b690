"""A bidirectional gated recurrent network over bytes, in numpy, trained by backpropagation through time."""

from __future__ import annotations

import numpy as np

PAD = 256  # one more symbol than bytes


def squash(x: np.ndarray) -> np.ndarray:
    """A rational curve close to tanh, flat from 3 on: several times cheaper than tanh."""
    x = np.clip(x, -3.0, 3.0)
    y = x * x
    return x * (y + 27.0) / (9.0 * y + 27.0)


def slope(x: np.ndarray) -> np.ndarray:
    y = np.minimum(x * x, 9.0)
    return ((9.0 - y) / (9.0 + 3.0 * y)) ** 2


def init(hidden: int, classes: int, seed: int = 3) -> dict[str, np.ndarray]:
    rnd = np.random.default_rng(seed)
    p = {}
    for d in "fb":
        p["E" + d] = rnd.normal(0, 0.3, (257, 3 * hidden))
        p["U" + d] = rnd.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
        p["c" + d] = np.zeros(hidden)
    p["W"] = rnd.normal(0, 0.3, (2 * hidden, classes))
    p["o"] = np.zeros(classes)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _forward(x: np.ndarray, p: dict, d: str, keep: bool):
    """Hidden states (T, B, H) of one direction; x is (T, B), padded where PAD (the state stays as it is there)."""
    steps, batch = x.shape
    hidden = p["c" + d].size
    table, u, c = p["E" + d], p["U" + d], p["c" + d]
    h = np.zeros((batch, hidden), np.float32)
    out = np.empty((steps, batch, hidden), np.float32)
    saved = []
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        a = table[x[t]]
        q = h @ u
        g = 0.5 * (a[:, : 2 * hidden] + q[:, : 2 * hidden])
        gate = 0.5 * squash(g) + 0.5
        z, r = gate[:, :hidden], gate[:, hidden:]
        m = q[:, 2 * hidden :] + c
        k = a[:, 2 * hidden :] + r * m
        n = squash(k)
        live = (x[t] != PAD)[:, None]
        new = np.where(live, n + z * (h - n), h)
        if keep:
            saved.append((t, h, z, r, n, m, live, 0.25 * slope(g), slope(k)))
        h = new
        out[t] = h
    return out, saved


def _backward(x: np.ndarray, p: dict, d: str, saved: list, grad_out: np.ndarray) -> dict[str, np.ndarray]:
    hidden = p["c" + d].size
    u = p["U" + d]
    steps, batch = x.shape
    ga = np.zeros((steps, batch, 3 * hidden), np.float32)
    gu, gc, gh = np.zeros_like(u), np.zeros(hidden, np.float32), np.zeros((batch, hidden), np.float32)
    for t, h, z, r, n, m, live, sg, sn in reversed(saved):
        gh = gh + grad_out[t]
        g = np.where(live, gh, 0)
        gn = g * (1 - z) * sn
        gz = g * (h - n) * sg[:, :hidden]
        gr = gn * m * sg[:, hidden:]
        gm = gn * r
        gq = np.concatenate([gz, gr, gm], axis=1)
        ga[t, :, : 2 * hidden] = gq[:, : 2 * hidden]
        ga[t, :, 2 * hidden :] = gn
        gu += h.T @ gq
        gc += gm.sum(axis=0)
        gh = np.where(live, g * z, gh) + gq @ u.T
    flat, vals = x.ravel(), ga.reshape(-1, 3 * hidden)
    order = np.argsort(flat, kind="stable")
    symbols, first = np.unique(flat[order], return_index=True)
    ge = np.zeros_like(p["E" + d])
    ge[symbols] = np.add.reduceat(vals[order], first, axis=0)
    return {"E" + d: ge, "U" + d: gu, "c" + d: gc}


def position_logits(x: np.ndarray, p: dict) -> np.ndarray:
    """Class scores of every position: (T, B, classes)."""
    hidden = p["cf"].size
    f, _ = _forward(x, p, "f", False)
    b, _ = _forward(x, p, "b", False)
    return f @ p["W"][:hidden] + b @ p["W"][hidden:] + p["o"]


def loss_and_grads(x: np.ndarray, y: np.ndarray, p: dict, weight: np.ndarray | None = None):
    """Mean cross entropy of the positions of (T, B) symbols with one class a column, its gradients, and column scores."""
    hidden = p["cf"].size
    f, sf = _forward(x, p, "f", True)
    b, sb = _forward(x, p, "b", True)
    logits = f @ p["W"][:hidden] + b @ p["W"][hidden:] + p["o"]
    logits -= logits.max(axis=2, keepdims=True)
    logp = logits - np.log(np.exp(logits).sum(axis=2, keepdims=True))
    live = (x != PAD)[:, :, None].astype(np.float32)
    pooled = (logp * live).sum(axis=0)
    use = live * (1.0 if weight is None else weight[None, :, None].astype(np.float32))
    target = np.eye(logp.shape[2], dtype=np.float32)[y][None]
    total = max(1.0, float(use.sum()))
    loss = -float((logp * target * use).sum()) / total
    gl = (np.exp(logp) - target) * use / total
    flat = gl.reshape(-1, gl.shape[2])
    grads = {"W": np.vstack([f.reshape(-1, hidden).T @ flat, b.reshape(-1, hidden).T @ flat]), "o": flat.sum(axis=0)}
    grads |= _backward(x, p, "f", sf, gl @ p["W"][:hidden].T) | _backward(x, p, "b", sb, gl @ p["W"][hidden:].T)
    return loss, grads, pooled


def pack(windows: list[bytes]) -> np.ndarray:
    """(T, B) symbols of byte strings, padded at the end."""
    longest = max(map(len, windows))
    out = np.full((len(windows), longest), PAD, np.int16)
    for i, w in enumerate(windows):
        out[i, : len(w)] = np.frombuffer(w, np.uint8)
    return np.ascontiguousarray(out.T)


def train(windows: list[bytes], labels: np.ndarray, classes: int, hidden: int, batches: int, batch: int = 256, seed: int = 3, rate: float = 0.02) -> dict[str, np.ndarray]:
    """Adam; after a quarter of the batches, windows that contradict their label strongly are left out. The last third is averaged."""
    rnd = np.random.default_rng(seed)
    p = init(hidden, classes, seed)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(x) for k, x in p.items()}
    of = [np.flatnonzero(labels == c) for c in range(classes)]
    present = [c for c in range(classes) if len(of[c])]
    if not present:
        return p
    # Classes in proportion to the root of their size: the varied ones get more, the rare ones enough.
    share = np.sqrt([len(of[c]) for c in present])
    share = np.maximum(share / share.sum(), 0.4 / len(present))
    each = np.maximum(1, (batch * share / share.sum()).astype(int))
    mean = {k: np.zeros_like(x, dtype=np.float64) for k, x in p.items()}
    averaged = 0
    for step in range(1, batches + 1):
        rows = np.concatenate([rnd.choice(of[c], n) for c, n in zip(present, each)])
        x, y = pack([windows[i] for i in rows]), labels[rows]
        weight = None
        if step > batches // 4:
            q = position_logits(x, p)
            q -= q.max(axis=2, keepdims=True)
            pooled = ((q - np.log(np.exp(q).sum(axis=2, keepdims=True))) * (x != PAD)[:, :, None]).mean(axis=0)
            weight = (pooled.max(axis=1) - pooled[np.arange(len(y)), y] < 0.4).astype(np.float32)
        _, grads, _ = loss_and_grads(x, y, p, weight)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        lr = rate * (1 - 0.9 * step / batches)
        for k, g in grads.items():
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            p[k] = (p[k] - lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        if step > batches * 2 // 3:
            averaged += 1
            for k in p:
                mean[k] += p[k]
    return {k: (mean[k] / averaged).astype(np.float32) for k in p} if averaged else p


def _infer(x: np.ndarray, p: dict, d: str) -> np.ndarray:
    """The forward pass without what training keeps: contiguous buffers are reused, padding costs only where it occurs."""
    steps, batch = x.shape
    hidden = p["c" + d].size
    # Halved gate inputs make both gates (squash + 1) / 2.
    table_g, table_n = (p["E" + d][:, : 2 * hidden] * 0.5).copy(), p["E" + d][:, 2 * hidden :].copy()
    # So are the candidate's, whose reset gate is left doubled.
    uz, ur, un = (p["U" + d][:, i * hidden : (i + 1) * hidden].copy() * np.float32(0.5) for i in range(3))
    c = p["c" + d] * np.float32(0.5)
    table_z, table_r = table_g[:, :hidden].copy(), table_g[:, hidden:].copy()
    h = np.zeros((batch, hidden), np.float32)
    out = np.empty((steps, batch, hidden), np.float32)
    a, z, r, k, s = (np.empty((batch, hidden), np.float32) for _ in range(5))

    def curve(y: np.ndarray) -> None:
        """``squash`` as y * (1/9 + 8/3 / (y * y + 3))."""
        np.clip(y, -3.0, 3.0, out=y)
        np.multiply(y, y, out=s)
        np.add(s, 3.0, out=s)
        np.divide(np.float32(8 / 3), s, out=s)
        np.add(s, np.float32(1 / 9), out=s)
        np.multiply(y, s, out=y)

    padded = (x == PAD).any(axis=1)
    x = x.astype(np.intp)
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        for gate, table, u in ((z, table_z, uz), (r, table_r, ur)):
            np.take(table, x[t], axis=0, out=a, mode="clip")
            np.matmul(h, u, out=gate)
            np.add(gate, a, out=gate)
            curve(gate)
            np.add(gate, 1.0, out=gate)
        np.matmul(h, un, out=k)
        np.add(k, c, out=k)
        np.multiply(k, r, out=k)
        np.take(table_n, x[t], axis=0, out=a, mode="clip")
        np.add(k, a, out=k)
        curve(k)
        new = out[t]
        np.subtract(h, k, out=new)
        np.multiply(new, z, out=new)
        np.multiply(new, 0.5, out=new)
        np.add(new, k, out=new)
        if padded[t]:
            dead = x[t] == PAD
            new[dead] = h[dead]
        h = new
    return out


def window_scores(windows: list[bytes], p: dict, block: int = 2048) -> np.ndarray:
    """Summed log probabilities over the positions of each window: (len(windows), classes)."""
    out = np.zeros((len(windows), p["o"].size), np.float32)
    order = sorted(range(len(windows)), key=lambda i: len(windows[i]))
    hidden = p["cf"].size
    # Hidden states lie within 1, so scores have a bound; below 80 no exponential overflows or vanishes.
    plain = bool((np.abs(p["W"]).sum(axis=0) + np.abs(p["o"])).max() < 80)
    ones = np.ones(p["o"].size, np.float32)
    for at in range(0, len(order), block):
        rows = order[at : at + block]
        x = pack([windows[i] for i in rows])
        q = _infer(x, p, "f").reshape(-1, hidden) @ p["W"][:hidden]
        q += _infer(x, p, "b").reshape(-1, hidden) @ p["W"][hidden:]
        q += p["o"]
        if not plain:
            q -= q.max(axis=1, keepdims=True)
        norm = np.log(np.exp(q) @ ones).reshape(x.shape)
        q = q.reshape(*x.shape, -1)
        live = x != PAD
        if not live.all():
            q[~live] = 0
            norm[~live] = 0
        out[rows] = q.sum(axis=0) - norm.sum(axis=0)[:, None]
    return out

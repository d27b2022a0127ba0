"""A bidirectional LSTM over the blocks of a page, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from daystream.llm import text as T
from daystream.llm.html_blocks import Block, Element

#: Input: hashed path parts, hashed words, measures; size of the state of one direction.
PATH, WORDS, MEASURES, STATE = 160, 32, 8, 16
INPUT = PATH + WORDS + MEASURES


def _cell(s: str, known: dict = {}) -> int:
    c = known.get(s)
    if c is None:
        if len(known) > 100_000:
            known.clear()
        data = np.frombuffer(s.encode(), np.uint8)
        c = known[s] = int(T.span_hash(data, np.array([0]), np.array([len(data)]))[0] % np.uint64(PATH)) if len(data) else 0
    return c


def _path_cells(path: Element | None, known: dict = {}) -> np.ndarray:
    """Cells of a path: its tags, name parts and their beginnings, the last two tags, and its depth.

    An element keeps the cells down to it as the bits of an integer, so a path
    costs what it adds to its parent's.
    """
    new, up = [], path
    while up is not None and up.seen is None:
        new.append(up)
        up = up.parent
    bits = up.seen if up is not None else 0
    for e in reversed(new):
        bits |= 1 << _cell("<" + e.tag)
        for n in e.names:
            bits |= 1 << _cell("." + n) | 1 << _cell("^" + n[:4])
        e.seen = bits
    last = [e.tag for e in (path.parent, path) if e is not None] if path is not None else []
    bits |= 1 << _cell("last " + " ".join(last)) | 1 << _cell(f"depth {min(path.depth, 8) if path is not None else 0}")
    c = known.get(bits)
    if c is None:
        if len(known) > 100_000:
            known.clear()
        c = known[bits] = np.flatnonzero(np.unpackbits(np.frombuffer(bits.to_bytes(PATH // 8, "little"), np.uint8), bitorder="little"))
    return c


def inputs(page: list[Block]) -> np.ndarray:
    """(blocks x INPUT) for one page."""
    n = len(page)
    x = np.zeros((n, INPUT), np.float32)
    if not n:
        return x
    data, off = T.buffers(pa.array([b.text for b in page], pa.large_string()))
    start, end, row = T.words(data, off)
    cell = (T.span_hash(data, start, end) % np.uint64(WORDS)).astype(np.int64)
    count = np.bincount(row * WORDS + cell, minlength=n * WORDS).reshape(n, WORDS)
    total = np.maximum(count.sum(1), 1)
    x[:, PATH:PATH + WORDS] = count / total[:, None]
    chars = np.diff(off)
    linked = np.array([b.linked for b in page])
    marks = np.r_[0, np.cumsum(np.isin(data, np.frombuffer(b".,;:!?", np.uint8)))]
    at = np.arange(n)
    x[:, PATH + WORDS:] = np.stack([
        np.log1p(total) / 5, np.minimum(linked / np.maximum(chars, 1), 1), (marks[off[1:]] - marks[off[:-1]]) / total,
        at / max(1, n - 1), np.minimum(at, 10) / 10, np.minimum(n - 1 - at, 10) / 10,
        chars / max(1, chars.max()), np.array([b.text[-1] in ".!?" for b in page])], 1)
    for i, b in enumerate(page):
        x[i, _path_cells(b.path)] = 1.0
    return x


def start(seed: int = 5) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    w = {}
    for d in "fb":
        w["x" + d] = r.normal(0, 0.1, (INPUT, 4 * STATE))
        w["h" + d] = r.normal(0, 1 / np.sqrt(STATE), (STATE, 4 * STATE))
        w["b" + d] = np.r_[np.zeros(STATE), np.ones(STATE), np.zeros(2 * STATE)]
    w["out"] = r.normal(0, 0.3, 2 * STATE)
    w["in"] = np.zeros(INPUT)
    w["bias"] = np.zeros(1)
    return {k: v.astype(np.float32) for k, v in w.items()}


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _run(z, mask, wh, keep):
    """One direction over (time, page, gates) inputs: states (time + 1, page, STATE), and what the way back needs."""
    steps, pages = mask.shape
    h = np.zeros((steps + 1, pages, STATE), np.float32)
    c = np.zeros((steps + 1, pages, STATE), np.float32)
    tape = []
    for t in range(steps):
        g = z[t] + h[t] @ wh
        i, f, o = (_sigmoid(g[:, k * STATE:(k + 1) * STATE]) for k in range(3))
        u = np.tanh(g[:, 3 * STATE:])
        m = mask[t][:, None]
        new = f * c[t] + i * u
        c[t + 1] = m * new + (1 - m) * c[t]
        th = np.tanh(new)
        h[t + 1] = m * (o * th) + (1 - m) * h[t]
        if keep:
            tape.append((i, f, o, u, th))
    return h, c, tape


def pad(pages: list[np.ndarray]):
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), INPUT), np.float32)
    mask = np.zeros((steps, len(pages)), np.float32)
    for j, p in enumerate(pages):
        x[:len(p), j] = p
        mask[:len(p), j] = 1
    return x, mask


def forward(w, x, mask, keep=False):
    """Logits (time, page); each block sees the blocks before it and after it."""
    flat = x.reshape(-1, INPUT)
    out = {}
    for d in "fb":
        z = (flat @ w["x" + d] + w["b" + d]).reshape(*mask.shape, -1)
        z, m = (z, mask) if d == "f" else (z[::-1], mask[::-1])
        out[d] = _run(z, m, w["h" + d], keep)
    hf, hb = out["f"][0][1:], out["b"][0][1:][::-1]
    logits = hf @ w["out"][:STATE] + hb @ w["out"][STATE:] + x @ w["in"] + w["bias"]
    return logits, out, hf, hb


def gradients(w, x, mask, target):
    """(loss, gradients) of the mean cross entropy over the blocks."""
    logits, out, hf, hb = forward(w, x, mask, True)
    p = _sigmoid(logits)
    total = mask.sum()
    loss = -(mask * (target * np.log(p + 1e-7) + (1 - target) * np.log(1 - p + 1e-7))).sum() / total
    d = mask * (p - target) / total
    g = {k: np.zeros_like(v) for k, v in w.items()}
    g["bias"][0] = d.sum()
    g["in"] = np.tensordot(d, x, 2)
    g["out"][:STATE] = np.tensordot(d, hf, 2)
    g["out"][STATE:] = np.tensordot(d, hb, 2)
    for side, part in (("f", slice(0, STATE)), ("b", slice(STATE, None))):
        h, c, tape = out[side]
        dd, m, xx = (d, mask, x) if side == "f" else (d[::-1], mask[::-1], x[::-1])
        dh = np.zeros_like(h[0])
        dc = np.zeros_like(h[0])
        dz = np.zeros((*mask.shape, 4 * STATE), np.float32)
        for t in range(len(mask) - 1, -1, -1):
            i, f, o, u, th = tape[t]
            k = m[t][:, None]
            dh = dh + dd[t][:, None] * w["out"][part]
            inner = k * dh
            new = k * dc + inner * o * (1 - th * th)
            dz[t] = np.hstack([new * u * i * (1 - i), new * c[t] * f * (1 - f), inner * th * o * (1 - o), new * i * (1 - u * u)])
            dc = new * f + (1 - k) * dc
            dh = dz[t] @ w["h" + side].T + (1 - k) * dh
        flat = dz.reshape(-1, 4 * STATE)
        g["x" + side] = xx.reshape(-1, INPUT).T @ flat
        g["h" + side] = h[:-1].reshape(-1, STATE).T @ flat
        g["b" + side] = flat.sum(0)
    return loss, g


def train(pages: list[np.ndarray], targets: list[np.ndarray], epochs: int = 10, batch: int = 32, rate: float = 0.01, seed: int = 5):
    """Weights fitted by Adam; words and path parts are dropped at random, so none is leaned on alone."""
    r = np.random.default_rng(seed)
    w = start(seed)
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v = {k: np.zeros_like(x) for k, x in w.items()}
    step = 0
    for epoch in range(epochs):
        order = r.permutation(len(pages))
        for s in range(0, len(order), batch):
            who = order[s:s + batch]
            x, mask = pad([pages[j] for j in who])
            y = np.zeros_like(mask)
            for j, q in enumerate(who):
                y[:len(targets[q]), j] = targets[q]
            # the same parts are dropped in all blocks of a page
            drop = (r.random((1, len(who), INPUT)) > 0.15).astype(np.float32)
            drop[:, :, PATH:PATH + WORDS] = (r.random((1, len(who), 1)) > 0.5)
            drop[:, :, PATH + WORDS:] = (r.random((1, len(who), MEASURES)) > 0.1)
            _, g = gradients(w, x * drop, mask, y)
            size = np.sqrt(sum(float((k * k).sum()) for k in g.values()))
            step += 1
            for k in w:
                d = g[k] * min(1.0, 5.0 / (size + 1e-9)) + 1e-5 * w[k]
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                w[k] = w[k] - rate * (1 - 0.9 * epoch / epochs) * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return w


def predict(w, pages: list[np.ndarray], cells: int = 1 << 15) -> list[np.ndarray]:
    """Probability of each block of each page; pages of like length run together."""
    out: list = [np.zeros(0, np.float32)] * len(pages)
    order = sorted((j for j in range(len(pages)) if len(pages[j])), key=lambda j: len(pages[j]))
    while order:
        steps = len(pages[order[-1]])
        take = max(1, cells // steps)
        who, order = order[-take:], order[:-take]
        x, mask = pad([pages[j] for j in who])
        p = _sigmoid(forward(w, x, mask)[0])
        for k, j in enumerate(who):
            out[j] = p[:len(pages[j]), k]
    return out

"""A character tagger: a bidirectional LSTM under a CRF, in numpy."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Classes of characters, by number: padding, these four, each of OWN, other signs, all beyond ASCII.
PAD, LOWER, UPPER, DIGIT, SPACE, BLANK = range(6)
OWN = "@.+-()_%"
SIGN = 6 + len(OWN)
BEYOND = SIGN + 1
CLASSES = BEYOND + 1
#: Sequences of a training batch, and bounds of the moves' scores.
BATCH = 96
MOST_MOVE = 0.5
#: What closes the gates on padding, so that a sequence's states do not depend on it.
SHUT = -30.0


def class_table() -> np.ndarray:
    """The class of each ASCII character, and of all others in the last place."""
    table = np.full(129, SIGN, np.uint8)
    for code in range(128):
        char = chr(code)
        if char.islower():
            table[code] = LOWER
        elif char.isupper():
            table[code] = UPPER
        elif char.isdigit():
            table[code] = DIGIT
        elif char == " ":
            table[code] = SPACE
        elif char.isspace() or code < 32:
            table[code] = BLANK
        elif char in OWN:
            table[code] = BLANK + 1 + OWN.index(char)
    table[128] = BEYOND
    return table


TABLE = class_table()


def classes_of(text: str) -> np.ndarray:
    """One class number for each character of the text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return TABLE[np.minimum(codes, 128)]


class Tagger(NamedTuple):
    """Parameters. The first axis of ``inputs`` and ``recurrent`` is the direction.

    ``inputs`` (2, classes, 4h) is what a character adds to the gates (input,
    forget, output, candidate), ``recurrent`` (2, h, 4h) what the last state
    adds, ``scores`` (2h, tags) and ``bias`` make tag scores from both states,
    ``moves`` (tags, tags) are scores of a tag after another.
    """

    inputs: np.ndarray
    recurrent: np.ndarray
    scores: np.ndarray
    bias: np.ndarray
    moves: np.ndarray


def fresh(tags: int, size: int, seed: int) -> Tagger:
    draw = np.random.default_rng(seed)
    inputs = draw.normal(0, 0.3, (2, CLASSES, 4 * size))
    inputs[:, :, size : 2 * size] += 1.0
    inputs[:, PAD, : 3 * size], inputs[:, PAD, 3 * size :] = SHUT, 0.0
    recurrent = draw.normal(0, 1 / np.sqrt(size), (2, size, 4 * size))
    return Tagger(inputs, recurrent, draw.normal(0, 0.3, (2 * size, tags)), np.zeros(tags), np.zeros((tags, tags)))


def gate(x: np.ndarray) -> np.ndarray:
    """The logistic function's tangent, cut at 0 and 1: a third of the time."""
    return np.clip(0.25 * x + 0.5, 0, 1)


def gate_slope(g: np.ndarray) -> np.ndarray:
    return 0.25 * ((g > 0) & (g < 1))


def states(inputs: np.ndarray, recurrent: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """Gates, cells and states of one direction over ids (steps, rows)."""
    steps, rows = ids.shape
    size = len(recurrent)
    gates = np.empty((steps, rows, 4 * size))
    cells, hidden = np.zeros((steps + 1, rows, size)), np.zeros((steps + 1, rows, size))
    given = inputs[ids]
    for t in range(steps):
        z, g = given[t] + hidden[t] @ recurrent, gates[t]
        g[:, : 3 * size] = gate(z[:, : 3 * size])
        g[:, 3 * size :] = np.tanh(z[:, 3 * size :])
        cells[t + 1] = g[:, size : 2 * size] * cells[t] + g[:, :size] * g[:, 3 * size :]
        hidden[t + 1] = g[:, 2 * size : 3 * size] * np.tanh(cells[t + 1])
    return gates, cells, hidden


def through_time(
    recurrent: np.ndarray, ids: np.ndarray, kept: tuple[np.ndarray, ...], onto: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of ``inputs`` and ``recurrent`` from those of the states."""
    gates, cells, hidden = kept
    steps, rows = ids.shape
    size = len(recurrent)
    d_gates = np.empty_like(gates)
    d_hidden, d_cell = np.zeros((rows, size)), np.zeros((rows, size))
    i, f, o, c = (gates[:, :, k * size : (k + 1) * size] for k in range(4))
    bent = np.tanh(cells[1:])
    slopes = [c * gate_slope(i), cells[:-1] * gate_slope(f), bent * gate_slope(o), i * (1 - c**2)]
    through = o * (1 - bent**2)
    for t in range(steps - 1, -1, -1):
        d_hidden = d_hidden + onto[t]
        d_cell = d_cell + d_hidden * through[t]
        for k, source in enumerate((d_cell, d_cell, d_hidden, d_cell)):
            np.multiply(source, slopes[k][t], out=d_gates[t, :, k * size : (k + 1) * size])
        d_hidden, d_cell = d_gates[t] @ recurrent.T, d_cell * f[t]
    flat = d_gates.reshape(-1, 4 * size)
    d_inputs = (np.arange(CLASSES)[:, None] == ids.ravel()).astype(float) @ flat
    d_inputs[PAD] = 0
    return d_inputs, hidden[:-1].reshape(-1, size).T @ flat


def crf(emitted: np.ndarray, moves: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood of ``tags`` (steps, rows), and its gradients.

    Sums over all paths, forwards and backwards, scaled to 1 at each step.
    """
    steps, rows, count = emitted.shape
    most = emitted.max(2, keepdims=True)
    weight, move = np.exp(emitted - most), np.exp(moves)
    ahead, behind = np.empty_like(emitted), np.ones_like(emitted)
    scale = np.empty((steps, rows, 1))
    for t in range(steps):
        reach = weight[t] * (ahead[t - 1] @ move) if t else weight[t]
        scale[t] = reach.sum(1, keepdims=True)
        ahead[t] = reach / scale[t]
    for t in range(steps - 2, -1, -1):
        behind[t] = (weight[t + 1] * behind[t + 1] / scale[t + 1]) @ move.T
    d_emitted = ahead * behind
    onward = (weight * behind / scale)[1:].reshape(-1, count)
    d_moves = move * (ahead[:-1].reshape(-1, count).T @ onward)
    at = np.arange(steps)[:, None], np.arange(rows)
    right = emitted[*at, tags].sum() + moves[tags[:-1], tags[1:]].sum()
    d_emitted[*at, tags] -= 1
    np.add.at(d_moves, (tags[:-1].ravel(), tags[1:].ravel()), -1)
    return float((np.log(scale) + most).sum() - right) / rows, d_emitted / rows, d_moves / rows


def gradients(model: Tagger, ids: np.ndarray, tags: np.ndarray) -> tuple[float, Tagger]:
    """Loss and gradients for ids and tags (steps, rows)."""
    size = len(model.scores) // 2
    ways = [ids, ids[::-1]]
    kept = [states(model.inputs[d], model.recurrent[d], ways[d]) for d in (0, 1)]
    both = np.concatenate([kept[0][2][1:], kept[1][2][1:][::-1]], axis=2)
    loss, d_emitted, d_moves = crf(both @ model.scores + model.bias, model.moves, tags)
    d_both = d_emitted @ model.scores.T
    flat = d_emitted.reshape(-1, d_emitted.shape[2])
    back = [
        through_time(model.recurrent[d], ways[d], kept[d], way)
        for d, way in enumerate((d_both[:, :, :size], d_both[::-1, :, size:]))
    ]
    return loss, Tagger(
        np.stack([back[0][0], back[1][0]]),
        np.stack([back[0][1], back[1][1]]),
        both.reshape(-1, 2 * size).T @ flat,
        flat.sum(0),
        d_moves,
    )


def trained(
    ids: np.ndarray, tags: np.ndarray, count: int, size: int, steps: int, seed: int = 0, rate: float = 0.02
) -> Tagger:
    """Fit on sequences ids and their tags (a row each), by about ``steps`` steps of Adam.

    Moves stay within MOST_MOVE, so that a clear place is clear whatever its
    neighbours are (``certain_margins``).
    """
    model = fresh(count, size, seed)
    draw = np.random.default_rng(seed)
    first, second = ([np.zeros_like(p) for p in model] for _ in range(2))
    batches = max(1, len(ids) // BATCH)
    step = 0
    for _ in range(-(-steps // batches)):
        for rows in np.array_split(draw.permutation(len(ids)), batches):
            step += 1
            _, found = gradients(model, ids[rows].T, tags[rows].T)
            norm = np.sqrt(sum((g**2).sum() for g in found))
            pace = rate * max(0.05, 1 - step / steps)
            for p, g, a, b in zip(model, found, first, second):
                g = g / max(1.0, norm / 5)
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= pace * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
            np.clip(model.moves, -MOST_MOVE, MOST_MOVE, out=model.moves)
    return model


class Scorer:
    """Tag scores of many sequences of one length, both directions in one pass."""

    def __init__(self, model: Tagger):
        size = len(model.scores) // 2
        # The gates' slope and middle go into the parameters, once.
        gates = np.r_[np.ones(3 * size), np.zeros(size)]
        inputs = model.inputs * (1 - 0.75 * gates) + 0.5 * gates
        self.size = size
        self.inputs = np.ascontiguousarray(inputs.transpose(0, 2, 1), np.float32)
        self.recurrent = np.ascontiguousarray((model.recurrent * (1 - 0.75 * gates)).transpose(0, 2, 1), np.float32)
        self.scores = [np.ascontiguousarray(s.T, np.float32) for s in (model.scores[:size], model.scores[size:])]
        self.bias = model.bias.astype(np.float32)[:, None]

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        """(steps, tags, rows) for ids (steps, rows)."""
        steps, rows = ids.shape
        size = self.size
        out = np.empty((steps, len(self.bias), rows), np.float32)
        out[:] = self.bias
        hidden = np.zeros((2, size, rows), np.float32)
        cells = np.zeros((2, size, rows), np.float32)
        z = np.empty((2, 4 * size, rows), np.float32)
        added = np.empty_like(z)
        gates, candidate = z[:, : 3 * size], z[:, 3 * size :]
        for t in range(steps):
            back = steps - 1 - t
            np.matmul(self.recurrent, hidden, out=z)
            np.take(self.inputs[0], ids[t], axis=1, out=added[0], mode="clip")
            np.take(self.inputs[1], ids[back], axis=1, out=added[1], mode="clip")
            z += added
            np.clip(gates, 0, 1, out=gates)
            np.tanh(candidate, out=candidate)
            cells *= gates[:, size : 2 * size]
            candidate *= gates[:, :size]
            cells += candidate
            np.tanh(cells, out=hidden)
            hidden *= gates[:, 2 * size :]
            out[t] += self.scores[0] @ hidden[0]
            out[back] += self.scores[1] @ hidden[1]
        return out


def certain_margins(moves: np.ndarray) -> np.ndarray:
    """How much tag 0 must lead each other tag in a place to be in the best path there.

    That is the most that the moves to and from the other tag can gain over
    those of tag 0, whatever the neighbours are; at an end, one move is missing.
    """
    into = (moves[:, 1:] - moves[:, :1]).max(0).clip(0)
    out = (moves[1:] - moves[:1]).max(1).clip(0)
    return into + out


def best_paths(emitted: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best tags (rows, steps) for scores (rows, steps, tags)."""
    rows, steps, _ = emitted.shape
    came = np.empty((steps, *emitted.shape[::2]), np.int8)
    best = emitted[:, 0]
    for t in range(1, steps):
        paths = best[:, :, None] + moves
        came[t] = paths.argmax(1)
        best = paths.max(1) + emitted[:, t]
    tags = np.empty((rows, steps), np.int8)
    tags[:, -1] = best.argmax(1)
    for t in range(steps - 1, 0, -1):
        tags[:, t - 1] = came[t][np.arange(rows), tags[:, t]]
    return tags

"""A gated recurrent network over symbols, in numpy: training, and log-likelihoods of whole sequences.

Sequences are laid end to end in lanes; a step advances all lanes by one symbol.
The state starts at zero with each sequence and is carried from window to window,
so a sequence's likelihood does not depend on where windows end; only gradients
stop there (truncated backpropagation).  The output is factored: a class, then a
symbol of that class.  Symbol 0 ends every sequence and is also read at its start.
States have a lane, or a place on the tape, in each row, and the reset gate, the update
gate and the inner part are arrays of their own; softmaxes have a place in each column.
So nearly all operations go over whole runs of memory.
"""

from __future__ import annotations

import numpy as np

HIDDEN, CLASSES = 32, 32
WINDOW, LANES = 32, 256  # in training
FEW_LANES, LONG_WINDOW = 32, 128  # the end of long sequences, with few lanes beside each other
SCORE_WINDOW, SCORE_LANES = 64, 256  # fewer, larger array operations
FEW_ROWS = 16  # added up beside each other
RATE = 0.012
Weights = dict[str, np.ndarray]


def initial(symbols: int, seed: int = 1) -> Weights:
    rng = np.random.default_rng(seed)
    members = -(-symbols // CLASSES)
    shapes = {
        "x": (symbols, 3, HIDDEN), "u": (HIDDEN, 3, HIDDEN), "class": (HIDDEN, CLASSES), "class_b": (CLASSES,),
        "member": (CLASSES, HIDDEN, members), "member_b": (CLASSES, members),
    }
    weights = {k: rng.normal(0, 0.1, shape).astype(np.float32) for k, shape in shapes.items()}
    for k in ("x", "u"):
        weights[k] = np.ascontiguousarray(weights[k].transpose(1, 0, 2))
    weights["class_b"][:] = 0
    weights["member_b"][:] = 0
    # Places of the last class that no symbol has are never chosen.
    weights["member_b"][-1, symbols - (CLASSES - 1) * members :] = -1e9
    return weights


def lanes(lengths: np.ndarray, count: int) -> list[list[int]]:
    """Sequences dealt to lanes, longest first to the shortest lane; the longest lane comes first."""
    import heapq

    heap = [(0, k) for k in range(min(count, len(lengths)))]
    dealt: list[list[int]] = [[] for _ in heap]
    for i in np.argsort(-lengths, kind="stable").tolist():
        total, k = heapq.heappop(heap)
        dealt[k].append(i)
        heapq.heappush(heap, (total + int(lengths[i]), k))
    totals = [int(lengths[x].sum()) for x in dealt]
    return [dealt[k] for k in sorted(range(len(dealt)), key=lambda k: -totals[k])]


class Tape:
    """All lanes one after the other; at a step the first ``width[step]`` lanes still have a symbol.

    Takes memory for the symbols alone, however long a sequence is beside the others.
    """

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, count: int) -> None:
        lengths = np.diff(starts)
        dealt = lanes(lengths, count)
        sizes = np.array([int(lengths[x].sum()) for x in dealt], np.int64)
        order = np.concatenate([np.array(x, np.int64) for x in dealt]) if dealt else np.zeros(0, np.int64)
        ends = np.cumsum(lengths[order])
        begins = ends - lengths[order]
        self.place = np.repeat((starts[:-1][order] - begins).astype(np.int32), lengths[order])
        self.place += np.arange(len(self.place), dtype=np.int32)  # of each symbol in ``symbols``
        self.target = symbols[self.place]
        self.source = np.empty_like(self.target)
        self.source[1:] = self.target[:-1]
        self.source[begins] = 0
        self.first = np.zeros(len(self.target), bool)
        self.first[begins] = True
        self.lane = np.cumsum(sizes) - sizes
        self.steps = int(sizes.max(initial=0))
        self.width = len(sizes) - np.searchsorted(sizes[::-1], np.arange(self.steps), side="right")

    def at(self, step: int) -> np.ndarray:
        """Where the symbols of a step are on the tape."""
        return self.lane[: self.width[step]] + step


    def span(self, begin: int, window: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Places of the symbols of some steps, one step after the other, and each step's bounds in that list."""
        steps = [self.at(t) for t in range(begin, min(begin + window, self.steps))]
        ends = np.cumsum([len(at) for at in steps]).tolist()
        return np.concatenate(steps), list(zip([0, *ends], ends, strict=False))


def forward(w: Weights, h: np.ndarray, read: np.ndarray, first: np.ndarray, kept: np.ndarray, new: np.ndarray, state: np.ndarray) -> np.ndarray:
    """One step of all lanes, from what they read: the state before it, and in the last three arrays, which it
    fills, both gates and the inner part, the candidate, and the new state."""
    if first.any():
        h = h.copy()
        h[first] = 0
    np.matmul(h, w["u"], out=kept)
    gates = kept[:2]
    gates += read[:2]
    np.negative(gates, out=gates)
    np.exp(gates, out=gates)
    gates += 1
    np.reciprocal(gates, out=gates)
    np.multiply(kept[0], kept[2], out=new)
    new += read[2]
    np.tanh(new, out=new)
    np.subtract(h, new, out=state)
    state *= kept[1]
    state += new
    return h


def advance(w: Weights, h: np.ndarray, source: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step of all lanes, from the symbols that they read: the new state, and the one before."""
    new, state = np.empty_like(h), np.empty_like(h)
    before = forward(w, h, w["x"][:, source], first, np.empty((3, *h.shape), h.dtype), new, state)
    return state, before


def softmax(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The softmax of each column, and its natural logarithm at one place of the column; ``x`` is used up."""
    x -= x.max(0)
    picked = x[at, np.arange(len(at))]
    np.exp(x, out=x)
    total = x.sum(0)
    x /= total
    return x, picked - np.log(total)


def outputs(w: Weights, states: np.ndarray, target: np.ndarray):
    """Natural log-likelihood of each target; what the way back needs: softmax of the classes, and, in the order
    of the targets' classes, the states, places in the class, and per class its bounds and softmax."""
    members = w["member"].shape[2]
    of, place = target // members, target % members
    classes, score = softmax(w["class"].T @ states.T + w["class_b"][:, None], of)
    order = np.argsort(of.astype(np.int16), kind="stable")
    ordered, place = states[order], place[order]
    edges = np.searchsorted(of[order], np.arange(CLASSES + 1))
    parts = []
    for c, (start, end) in enumerate(zip(edges, edges[1:], strict=False)):
        if start < end:
            inside, more = softmax(w["member"][c].T @ ordered[start:end].T + w["member_b"][c][:, None], place[start:end])
            score[order[start:end]] += more
            parts.append((c, start, end, inside))
    return score, classes, of, order, ordered, place, parts


def chosen(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The log-softmax of each column at one place; ``x`` is used up."""
    x -= x.max(0)
    picked = x[at, np.arange(len(at))]
    np.exp(x, out=x)
    return picked - np.log(x.sum(0))


def target_scores(w: Weights, states: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log-likelihood of each target, as in ``outputs`` but without what the way back needs."""
    members = w["member"].shape[2]
    of, place = target // members, target % members
    score = chosen(w["class"].T @ states.T + w["class_b"][:, None], of)
    order = np.argsort(of.astype(np.int16), kind="stable")
    states, place = states[order], place[order]
    inside = np.empty(len(target), score.dtype)
    edges = np.searchsorted(of[order], np.arange(CLASSES + 1))
    for c, (start, end) in enumerate(zip(edges, edges[1:], strict=False)):
        if start < end:
            inside[start:end] = chosen(w["member"][c].T @ states[start:end].T + w["member_b"][c][:, None], place[start:end])
    score[order] += inside
    return score


def likelihoods(w: Weights, symbols: np.ndarray, starts: np.ndarray, count: int = SCORE_LANES) -> np.ndarray:
    """Natural log-likelihood of each whole sequence."""
    tape = Tape(symbols, starts, count)
    score = np.zeros(len(symbols), np.float64)
    h = np.zeros((len(tape.lane), HIDDEN), w["u"].dtype)
    kept, new = np.empty((3, *h.shape), h.dtype), np.empty_like(h)
    for begin in range(0, tape.steps, SCORE_WINDOW):
        where, bounds = tape.span(begin, SCORE_WINDOW)
        read, first = np.take(w["x"], tape.source[where], axis=1), tape.first[where]
        states = np.empty((len(where), HIDDEN), h.dtype)
        for start, end in bounds:
            n = end - start
            forward(w, h[:n], read[:, start:end], first[start:end], kept[:, :n], new[:n], states[start:end])
            h = states[start:end]
        score[tape.place[where]] = target_scores(w, states, tape.target[where])
    return np.add.reduceat(score, starts[:-1]) if len(starts) > 1 else np.zeros(0)


def sums_by(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, and for each the sum of its rows (the middle axis): by turns, the rows of each key are cut
    into pieces of a few, and the pieces of all keys are added up beside each other."""
    places = np.argsort(keys.astype(np.int16), kind="stable")
    edges = np.flatnonzero(np.diff(keys[places], prepend=-1))
    found, sizes = keys[places[edges]], np.diff(edges, append=len(keys))
    while True:
        pieces = -(-sizes // FEW_ROWS)
        begins = np.cumsum(pieces) - pieces
        before = (np.arange(pieces.sum()) - np.repeat(begins, pieces)) * FEW_ROWS
        size = np.minimum(np.repeat(sizes, pieces) - before, FEW_ROWS)
        order = np.argsort(-size, kind="stable")
        at = (np.repeat(edges, pieces) + before)[order]
        sums = np.take(rows, places[at], axis=1)
        for k, having in enumerate(np.searchsorted(-size[order], -np.arange(2, size.max() + 1), side="right"), 1):
            sums[:, :having] += np.take(rows, places[at[:having] + k], axis=1)
        places = np.empty_like(order)
        places[order] = np.arange(len(order))
        if len(order) == len(found):
            return found, np.take(sums, places, axis=1)
        rows, edges, sizes = sums, begins, pieces


class Trainer:
    """Adam steps on windows of truncated backpropagation, from given weights, moments and number of steps."""

    def __init__(self, symbols: int) -> None:
        self.w = initial(symbols)
        self.mean = {k: np.zeros_like(v) for k, v in self.w.items()}
        self.square = {k: np.zeros_like(v) for k, v in self.w.items()}
        self.step = 0

    def packed(self) -> np.ndarray:
        """Weights and moments as one array of fixed size, the number of steps last."""
        values = [part[k].ravel() for part in (self.w, self.mean, self.square) for k in sorted(part)]
        return np.append(np.concatenate(values), np.float32(self.step))

    def unpack(self, values: np.ndarray) -> None:
        at = 0
        for part in (self.w, self.mean, self.square):
            for k in sorted(part):
                part[k] = values[at : at + part[k].size].astype(np.float32).reshape(part[k].shape)
                at += part[k].size
        self.step = round(float(values[at]))

    def learn(self, symbols: np.ndarray, starts: np.ndarray) -> None:
        tape = Tape(symbols, starts, LANES)
        h = np.zeros((len(tape.lane), HIDDEN), self.w["u"].dtype)
        begin = 0
        while begin < tape.steps:
            size = WINDOW if tape.width[begin] > FEW_LANES else LONG_WINDOW
            h = self.window(tape, h, begin, size)
            begin += size

    def window(self, tape: Tape, h: np.ndarray, begin: int, size: int) -> np.ndarray:
        w = self.w
        where, bounds = tape.span(begin, size)
        source, target, first = tape.source[where], tape.target[where], tape.first[where]
        read = np.take(w["x"], source, axis=1)
        states, before, new = (np.empty((len(where), HIDDEN), h.dtype) for _ in range(3))
        kept = np.empty_like(read)
        for start, end in bounds:
            before[start:end] = forward(
                w, h[: end - start], read[:, start:end], first[start:end], kept[:, start:end], new[start:end], states[start:end])
            h = states[start:end]
        _, classes, of, order, ordered, place, parts = outputs(w, states, target)
        total = h.dtype.type(1 / len(target))
        grad = {k: np.zeros_like(v) for k, v in w.items()}
        back = classes
        back[of, np.arange(len(target))] -= 1
        back *= total
        grad["class"], grad["class_b"] = (back @ states).T, back.sum(1)
        down = back.T @ w["class"].T
        below = np.empty_like(down)
        for c, start, end, inside in parts:
            back = inside
            back[place[start:end], np.arange(end - start)] -= 1
            back *= total
            grad["member"][c], grad["member_b"][c] = (back @ ordered[start:end]).T, back.sum(1)
            np.matmul(back.T, w["member"][c].T, out=below[start:end])
        down[order] += below
        self.through_time(bounds, source, first, (before, kept, new, read), down, grad)
        self.apply(grad)
        return h

    def through_time(self, bounds: list, source: np.ndarray, first: np.ndarray, arrays: tuple, down: np.ndarray, grad: Weights) -> None:
        """Factors of all steps at once; only the recursion goes step by step.  What was read is used up."""
        before, (r, z, inner), new, read = arrays
        open_z = 1 - z
        to_z = before - new
        to_z *= z
        to_z *= open_z
        to_new = np.square(new, out=new)
        np.subtract(1, to_new, out=to_new)
        to_new *= open_z
        to_r = np.subtract(1, r, out=open_z)
        to_r *= r
        to_r *= inner
        turned = np.ascontiguousarray(self.w["u"].transpose(0, 2, 1))
        through = inner  # of the inner part, which the reset gate scales
        later = np.zeros((0, HIDDEN), down.dtype)
        for start, end in reversed(bounds):
            dh = down[start:end]
            dh[: len(later)] += later
            dread = read[:, start:end]
            dnew = np.multiply(dh, to_new[start:end], out=dread[2])
            np.multiply(dh, to_z[start:end], out=dread[1])
            np.multiply(dnew, to_r[start:end], out=dread[0])
            inward = np.multiply(dnew, r[start:end], out=through[start:end])
            later = dh * z[start:end]
            later += dread[0] @ turned[0]
            later += dread[1] @ turned[1]
            later += inward @ turned[2]
            if first[start:end].any():
                later[first[start:end]] = 0
        for k, part in enumerate((read[0], read[1], through)):
            grad["u"][k] = before.T @ part
        symbols, sums = sums_by(source, read)
        grad["x"][:, symbols] = sums

    def apply(self, grad: Weights) -> None:
        """One step; the gradients are used up."""
        self.step += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        scale = np.float32(min(1.0, 1.0 / max(norm, 1e-9)))
        rate = RATE * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for k, g in grad.items():
            g *= scale
            mean, square, part = self.mean[k], self.square[k], np.subtract(g, self.mean[k])
            part *= np.float32(0.1)
            mean += part
            g *= g
            g -= square
            g *= np.float32(0.001)
            square += g
            np.sqrt(square, out=g)
            g += np.float32(1e-8)
            np.multiply(mean, np.float32(rate), out=part)
            part /= g
            self.w[k] -= part

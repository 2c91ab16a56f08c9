"""A small causal self-attention model over subword ids, in numpy.

A window's ids are embedded, one masked attention layer mixes each position with those before it, and a hidden layer,
which also sees the position's and the previous id directly, gives the weights of ``MIXTURE`` unigram distributions, whose
weighted mean is the distribution of the next id. So a position costs a few small products, not one per entry of the
vocabulary, and the probabilities add up to one.
Ids outside the ``shown`` ones share one entry, which is split by how often each occurs.

What follows from an id alone, or from a place in the window alone, is computed once for each of them (``Front``) and
looked up by the positions; its gradients are added up by id before they go on to the weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from ledgerline.llm.bytepair import ragged

WIDTH, HIDDEN, MIXTURE = 16, 32, 32
WINDOW, STRIDE = 32, 26
#: Columns of what an id gives a position before its part of the hidden layer: query, key, value, a one and a zero.
DEEP = 3 * WIDTH + 2
ONE = DEEP - 2
#: Windows that go through the model together, and in a training step.
BATCH, STEP = 64, 128
#: Steps after which the distributions move, and the part of the mean of all in each of them.
EVERY, FAITH = 2, 0.02
#: Bounds of what goes into an exponential. Numbers too small for normal floats would make the products very slow;
#: for the same reason ``DUST`` keeps the moments of gradients that stay zero away from them.
STEEP, HIGH, DUST = 30, 45, np.float32(1e-15)
#: The same for shares of entries that do not occur for long; far below what ``tables`` adds.
SPECK = np.float32(1e-25)


def grouped(rows: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that brings equal row numbers (below ``most``) together, those that occur, and where each begins."""
    # Numbers of two bytes are sorted by their digits.
    order = np.argsort(rows.astype(np.uint16) if most <= 1 << 16 else rows, kind="stable")
    counts = np.bincount(rows, minlength=most)
    found = np.flatnonzero(counts)
    counts = counts[found]
    return order, found, np.cumsum(counts) - counts


def added(values: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values of each group of ``order``. Short ones are taken in pairs, as complex numbers: half as many
    additions that wait for each other."""
    values = np.take(values, order, axis=0)
    if values.dtype == np.float32 and values.shape[1] % 2 == 0:
        return np.add.reduceat(values.view(np.complex64), first, axis=0).view(np.float32)
    return np.add.reduceat(values, first, axis=0)


def summed(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row numbers that occur, and the sums of their values."""
    if not len(rows):
        return rows, values
    order, found, first = grouped(rows, int(rows.max()) + 1)
    return found, added(values, order, first)


def across(values: np.ndarray) -> np.ndarray:
    """Sums over the last axis, which stays; as a product, much faster than a reduction of many short rows."""
    return values @ np.ones((values.shape[-1], 1), dtype=values.dtype)


def down(values: np.ndarray) -> np.ndarray:
    """Sums over the rows."""
    return np.ones(len(values), dtype=values.dtype) @ values


@dataclass
class Vocabulary:
    """``place`` of each id among the shown entries, and log10 of its share of its entry."""

    place: np.ndarray
    share: np.ndarray
    entries: int

    @classmethod
    def of(cls, counts: np.ndarray, shown: int) -> Vocabulary:
        """From how often each id occurs; the last entry stands for all ids that are not shown."""
        top = np.argsort(-counts, kind="stable")[: min(shown, len(counts) - 1)]
        place = np.full(len(counts), len(top), dtype=np.int32)
        place[top] = np.arange(len(top))
        return cls(place, np.zeros(len(counts)), len(top) + 1).split(counts)

    def split(self, counts: np.ndarray) -> Vocabulary:
        rest = self.place == self.entries - 1
        share = np.zeros(len(counts))
        weight = counts[rest] + 0.1
        share[rest] = np.log10(weight / weight.sum())
        return Vocabulary(self.place, share, self.entries)


@dataclass
class Windows:
    """Overlapping windows of several texts: inputs, targets, and which targets a window scores."""

    inputs: np.ndarray
    targets: np.ndarray
    scored: np.ndarray
    doc: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, counts: np.ndarray, end: int, window: int = WINDOW, stride: int = STRIDE) -> Windows:
        """A text's inputs are the end id and its ids, its targets its ids and the end id; each is scored once."""
        n = counts + 1
        head = np.cumsum(n + 1) - (n + 1)
        flat = np.full(int((n + 1).sum()), end, dtype=np.int32)
        flat[ragged(head + 1, counts)] = ids
        many = np.where(n <= window, 1, 1 + -(-(n - window) // stride))
        doc = np.repeat(np.arange(len(counts)), many)
        turn = ragged(np.zeros(len(counts), dtype=np.int64), many)
        place = (turn * stride)[:, None] + np.arange(window)
        inside = place < n[doc][:, None]
        at = np.minimum(head[doc][:, None] + place, len(flat) - 2)
        new = (np.arange(window) >= window - stride) | (turn == 0)[:, None]
        return cls(flat[at], flat[at + 1], inside & new, doc)


@dataclass
class Front:
    """Of some entries their rows ``w`` of ``W``, ``own`` columns (query, key, value, nothing, hidden), and what they add
    to the hidden layer as the id ``before``; of each ``place`` its columns, with a one; ``joint`` makes the columns from
    embeddings, ``deep`` the hidden layer from what attention mixed, ``mixture`` and ``bias`` the mixture weights."""

    w: np.ndarray
    joint: np.ndarray
    own: np.ndarray
    before: np.ndarray
    place: np.ndarray
    deep: np.ndarray
    mixture: np.ndarray
    bias: np.ndarray


class Attention:
    """Parameters and passes of the model. ``W`` holds an id's embedding and what it adds to the hidden layer as the
    present and as the previous id; ``share`` is the joint share of each (entry, distribution) in all words so far."""

    def __init__(self, theta: dict[str, np.ndarray], share: np.ndarray):
        self.theta, self.share = theta, share
        self.seen = np.tri(WINDOW, dtype=np.float32)

    @classmethod
    def new(cls, unigram: np.ndarray, seed: int = 11) -> Attention:
        random = np.random.default_rng(seed)

        def start(*shape: int) -> np.ndarray:
            return random.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

        entries = len(unigram)
        wide = np.concatenate([np.full(WIDTH, 0.3), np.full(2 * HIDDEN, 0.1)])
        share = unigram[:, None] * np.exp(random.normal(0, 0.5, (entries, MIXTURE)))
        return cls(
            {
                "W": (random.normal(0, 1, (entries, len(wide))) * wide).astype(np.float32),
                "P": random.normal(0, 0.1, (WINDOW, WIDTH)).astype(np.float32),
                "Q": start(WIDTH, WIDTH),
                "K": start(WIDTH, WIDTH),
                "V": start(WIDTH, WIDTH),
                "O": start(WIDTH, WIDTH),
                "H": start(WIDTH, HIDDEN),
                "h": np.zeros(HIDDEN, dtype=np.float32),
                "M": start(HIDDEN, MIXTURE),
                "m": np.zeros(MIXTURE, dtype=np.float32),
            },
            share / share.sum(),
        )

    def front(self, entries: np.ndarray | slice = slice(None)) -> Front:
        """What the entries and the places of a window give a position before it looks at others."""
        t = self.theta
        w = t["W"][entries]
        joint = np.concatenate([t["Q"] * np.float32(WIDTH**-0.5), t["K"], t["V"], np.zeros((WIDTH, 2), dtype=t["H"].dtype), t["H"]], axis=1)
        own, place = w[:, :WIDTH] @ joint, t["P"] @ joint
        own[:, DEEP:] += w[:, WIDTH : WIDTH + HIDDEN]
        place[:, DEEP:] += t["h"]
        place[:, ONE] = 1
        deep = np.zeros((WIDTH + 2, HIDDEN), dtype=own.dtype)
        deep[:WIDTH] = t["O"] @ t["H"]
        # The mixture weights stay the same when one number is taken off all their logarithms: their mean.
        mixture, bias = t["M"] - t["M"].mean(axis=1, keepdims=True), t["m"] - t["m"].mean()
        return Front(w, joint, own, np.ascontiguousarray(w[:, WIDTH + HIDDEN :]), place, deep, mixture, bias)

    def forward(self, inputs: np.ndarray, front: Front | None = None, since: int = 0) -> dict[str, np.ndarray]:
        """From entries [windows, WINDOW], or from rows of ``front``; ``pi`` are the mixture weights of each position from
        ``since`` on. The positions before it are seen by these, but get no weights themselves."""
        out = self.weighed(inputs, front or self.front(), since)
        e = out.pop("e")
        return out | {"pi": (e / across(e)).reshape(len(inputs), -1, MIXTURE)}

    def weighed(self, inputs: np.ndarray, front: Front, since: int = 0) -> dict[str, np.ndarray]:
        """The passes up to ``e``, the mixture weights before they are made to add up to one."""
        n = len(inputs)
        f = np.take(front.own, inputs.ravel(), axis=0).reshape(n, WINDOW, -1)
        f += front.place
        a = f[:, since:, :WIDTH] @ f[:, :, WIDTH : 2 * WIDTH].transpose(0, 2, 1)
        np.clip(a, -STEEP, STEEP, out=a)
        np.exp(a, out=a)
        a *= self.seen[since:]
        # The column of ones gives the sum of a position's attention.
        mixed = (a @ f[:, :, 2 * WIDTH : DEEP]).reshape(-1, WIDTH + 2)
        part = 1 / mixed[:, WIDTH : WIDTH + 1]
        mixed *= part
        u = mixed @ front.deep
        wide = u.reshape(n, WINDOW - since, -1)
        wide += f[:, since:, DEEP:]
        late = max(since - 1, 0)
        wide[:, late + 1 - since :] += np.take(front.before, inputs[:, late:-1].ravel(), axis=0).reshape(n, WINDOW - 1 - late, -1)
        np.maximum(u, 0, out=u)
        e = u @ front.mixture
        e += front.bias
        # The largest of a position is not below their mean, 0. One too steep for an exponential is brought down with the
        # others; a position without one stays as it is, whatever the batch. Turned round, as the largest of many short
        # rows is slow to find.
        if e.max() > HIGH:
            e -= np.maximum(np.ascontiguousarray(e.T).max(axis=0) - HIGH, 0)[:, None]
        np.maximum(e, -STEEP, out=e)
        np.exp(e, out=e)
        return {"f": f, "a": a, "mixed": mixed, "part": part, "u": u, "e": e}

    def tables(self) -> np.ndarray:
        """The unigram distributions as [entries, MIXTURE]; what one has not seen it takes from the mean of all."""
        near = self.share + (across(self.share) * self.share.dtype.type(FAITH / MIXTURE) + self.share.dtype.type(1e-12))
        near *= 1 / down(near)
        return near.astype(np.float32, copy=False)

    def slopes(self, inputs: np.ndarray, targets: np.ndarray, scored: np.ndarray, tables: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, float]:
        """Gradient of the mean log loss of the scored targets, how much of each target each distribution accounts
        for, and the loss. The gradient of ``W`` has one row for each position of the inputs; an entry's stands at one
        of its positions."""
        entries, out, duty, loss = self.gradient(inputs, targets, scored, tables)
        flat = inputs.ravel()
        wide = np.zeros((len(flat), out["W"].shape[1]), dtype=out["W"].dtype)
        wide[np.unique(flat, return_index=True)[1]] = out["W"]
        return out | {"W": wide}, duty, loss

    def gradient(self, inputs: np.ndarray, targets: np.ndarray, scored: np.ndarray, tables: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray], np.ndarray, float]:
        """As ``slopes``; the gradient of ``W`` is that of the entries that occur, which come first."""
        t, flat, shape = self.theta, inputs.ravel(), inputs.shape
        order, entries, first = grouped(flat, len(t["W"]))
        row = np.empty(len(t["W"]), dtype=np.int64)
        row[entries] = np.arange(len(entries))
        front = self.front(entries)
        w = self.weighed(row[inputs], front)
        f, a, mixed, u, e = (w[k] for k in ("f", "a", "mixed", "u", "e"))
        duty = np.take(tables, targets.ravel(), axis=0)
        duty *= e
        p, total = across(duty), across(e)
        n, on = max(int(scored.sum()), 1), scored.reshape(-1, 1).astype(e.dtype)
        loss = float((np.log(total / p) * on).sum() / n)
        duty *= on / p
        # From here on times n.
        dz = np.multiply(e, on / total, out=e)
        dz -= duty
        d = np.empty((len(flat) + 1, DEEP + HIDDEN), dtype=dz.dtype)
        d[-1] = 0
        parts, dpre = d[:-1].reshape(*shape, -1), d[:, DEEP:]
        np.multiply(dz @ t["M"].T, u > 0, out=dpre[:-1])
        dmix = dpre[:-1] @ front.deep.T
        dmix *= w["part"]
        # What the attention of a position gets on average follows from what it mixed.
        dmix[:, WIDTH : WIDTH + 1] = -across(dmix * mixed)
        dmix = dmix.reshape(*shape, WIDTH + 2)
        ds = dmix @ f[:, :, 2 * WIDTH : DEEP].transpose(0, 2, 1)
        ds *= a
        np.matmul(ds, f[:, :, WIDTH : 2 * WIDTH], out=parts[:, :, :WIDTH])
        np.matmul(ds.transpose(0, 2, 1), f[:, :, :WIDTH], out=parts[:, :, WIDTH : 2 * WIDTH])
        np.matmul(a.transpose(0, 2, 1), dmix, out=parts[:, :, 2 * WIDTH : DEEP])
        place = down(parts.reshape(shape[0], -1)).reshape(shape[1], -1)
        own = added(d, order, first)
        # The position after each; none has a row of zeros.
        after = np.append(np.arange(1, len(flat)), 0)
        after[shape[1] - 1 :: shape[1]] = len(flat)
        before = added(dpre, after[order], first)
        for x in (own, place):
            x[:, ONE] = 0
        joint = front.w[:, :WIDTH].T @ own + t["P"].T @ place
        deep = mixed[:, :WIDTH].T @ dpre[:-1]
        out = {
            "W": np.concatenate([own @ front.joint.T, own[:, DEEP:], before], axis=1),
            "P": place @ front.joint.T,
            "Q": joint[:, :WIDTH] * np.float32(WIDTH**-0.5),
            "K": joint[:, WIDTH : 2 * WIDTH],
            "V": joint[:, 2 * WIDTH : 3 * WIDTH],
            "O": deep @ t["H"].T,
            "H": joint[:, DEEP:] + t["O"].T @ deep,
            "h": place[:, DEEP:].sum(axis=0),
            "M": u.T @ dz,
            "m": down(dz),
        }
        return entries, {k: x * x.dtype.type(1 / n) for k, x in out.items()}, duty.reshape(*shape, -1), loss

    def logs(self, inputs: np.ndarray, targets: np.ndarray, tables: np.ndarray, front: Front | None = None, since: int = 0) -> np.ndarray:
        """log10 of the probability of the entry of each target, which are those of the positions from ``since`` on."""
        e = self.weighed(inputs, front or self.front(), since)["e"]
        p = np.take(tables, targets.ravel(), axis=0)
        p *= e
        return np.log10(np.maximum(across(p) / across(e), 1e-30)).reshape(targets.shape)


class Steps:
    """Adam steps on a model's weights; its distributions follow by stepwise expectation and maximisation.

    ``duty`` adds up what every step's targets gave each distribution.
    """

    def __init__(self, model: Attention, pace: float, mix: float):
        self.model, self.pace, self.mix, self.taken = model, pace, mix, 0
        # All weights but ``W`` lie in one vector and are moved together.
        small = {k: v for k, v in model.theta.items() if k != "W"}
        self.small = np.concatenate([v.ravel() for v in small.values()])
        cuts = np.cumsum([v.size for v in small.values()])[:-1]
        model.theta |= {k: x.reshape(v.shape) for (k, v), x in zip(small.items(), np.split(self.small, cuts))}
        self.moment = [(np.zeros_like(x), np.zeros_like(x)) for x in (model.theta["W"], self.small)]
        self.duty, self.fresh = np.zeros(model.share.shape), []
        self.model.share = model.share.astype(np.float32)
        self.tables = model.tables()

    def take(self, inputs: np.ndarray, targets: np.ndarray, scored: np.ndarray) -> float:
        """One step on a batch; returns its mean loss."""
        entries, slopes, duty, loss = self.model.gradient(inputs, targets, scored, self.tables)
        self.taken += 1
        pace, bend = self.pace / (1 - 0.9**self.taken), 1 / np.sqrt(1 - 0.99**self.taken)
        wide = slopes.pop("W")
        flat = np.concatenate([slopes[k].ravel() for k in self.model.theta if k != "W"])
        held = (self.model.theta["W"], entries, wide), (self.small, slice(None), flat)
        for (theta, at, slope), (m, v) in zip(held, self.moment):
            slope += DUST
            own, square = m[at], v[at]
            own *= np.float32(0.9)
            own += np.float32(0.1) * slope
            slope *= slope
            slope *= np.float32(0.01)
            square *= np.float32(0.99)
            square += slope
            m[at], v[at] = own, square
            np.sqrt(square, out=slope)
            slope *= slope.dtype.type(bend)
            slope += 1e-8
            own = own * own.dtype.type(pace)
            own /= slope
            theta[at] -= own
        self.fresh.append(summed(targets.ravel(), duty.reshape(-1, duty.shape[-1])))
        if self.taken % EVERY == 0:
            self.settle()
        return loss

    def settle(self) -> None:
        """Moves the distributions towards the duties of the last steps."""
        if n := sum(float(counts.sum(dtype=float)) for _, counts in self.fresh):
            share = self.model.share
            share *= np.float32(1 - self.mix)
            share += SPECK
            for rows, counts in self.fresh:
                share[rows] += counts * np.float32(self.mix / n)
                self.duty[rows] += counts
            self.fresh = []
            self.tables = self.model.tables()

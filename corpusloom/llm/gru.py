"""A bidirectional gated recurrent network with attention pooling over word and character inputs, in numpy."""

from __future__ import annotations

import numpy as np

from corpusloom.llm.decontamination import words

WORDS, GRAMS, DIM, HIDDEN, ATTEND = 512, 2048, 8, 8, 8
LEAST_TEXTS = 8
LENGTH, STRIDE = 32, 24
PAD = -1
RATE = 0.005


def spelt(offsets: np.ndarray, data: np.ndarray):
    """Texts side by side as word numbers: (number of each word among the distinct ones, row of each word, 64-bit code of each
    distinct word, codes of the character 3- and 4-grams of all distinct words in turn, where each one's begin)."""
    low, s, e, row, h = words(offsets, data)
    known, first, number = np.unique(h, return_index=True, return_inverse=True)
    raw = low.tobytes()
    text = np.frombuffer(b"".join(b"\x01" + raw[a:b] + b"\x02" for a, b in zip(s[first].tolist(), e[first].tolist())), np.uint8).astype(np.uint64)
    size = (e[first] - s[first] + 2).astype(np.int64)
    of = np.repeat(np.arange(len(known)), size)
    buckets, owners = [], []
    for n in (3, 4):
        if len(text) < n:
            continue
        code = np.full(len(text) - n + 1, n, np.uint64)
        for k in range(n):
            code = code * np.uint64(0x9E3779B97F4A7C15) + text[k : len(text) - n + 1 + k]
        code ^= code >> np.uint64(33)
        code *= np.uint64(0xD6E8FEB86659FD93)
        inside = of[: len(code)] == of[n - 1 :]
        buckets.append(code[inside])
        owners.append(of[: len(code)][inside])
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    order = np.argsort(owner, kind="stable")
    buckets = np.concatenate(buckets)[order] if buckets else np.zeros(0, np.uint64)
    return number, row, known, buckets, np.searchsorted(owner[order], np.arange(len(known) + 1))


def worth(ones: np.ndarray, zeros: np.ndarray, label: np.ndarray, most: int, least: int) -> np.ndarray:
    """Of the features in ``least`` texts or more, the places of the ``most`` whose presence differs most between the labels
    (chi-square); ``ones`` and ``zeros`` are the texts of each label that have a feature."""
    n, share = ones + zeros, (ones + zeros) / len(label)
    apart = (ones / max(label.sum(), 1) - zeros / max((1 - label).sum(), 1)) ** 2 / (share * (1 - share) + 1e-3)
    apart = np.where(n >= least, apart, -1)
    keep = np.argsort(-apart, kind="stable")[:most]
    return keep[apart[keep] >= 0]


class Sample:
    """Texts as numbers of distinct words, read in pieces so that no large array of bytes stands in memory."""

    def __init__(self, texts: list[bytes], piece: int = 1 << 19):
        codes, spellings, numbers, rows, at = [], [], [], [], 0
        seen: dict[int, int] = {}
        while at < len(texts):
            size, end = 0, at
            while end < len(texts) and (end == at or size + len(texts[end]) <= piece):
                size += len(texts[end])
                end += 1
            some = texts[at:end]
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in some])]).astype(np.int64)
            number, row, known, grams, starts = spelt(offsets, np.frombuffer(b"".join(some), np.uint8))
            place = np.empty(len(known), np.int64)
            for i, code in enumerate(known.tolist()):
                p = seen.get(code)
                if p is None:
                    p = seen[code] = len(codes)
                    codes.append(code)
                    spellings.append(grams[starts[i] : starts[i + 1]].copy())
                place[i] = p
            numbers.append(place[number].astype(np.int32))
            rows.append((row + at).astype(np.int32))
            at = end
        self.n = len(texts)
        self.words = np.array(codes, np.uint64)
        self.starts = np.concatenate([[0], np.cumsum([len(g) for g in spellings])]).astype(np.int64) if spellings else np.zeros(1, np.int64)
        self.grams = np.concatenate(spellings) if spellings else np.zeros(0, np.uint64)
        self.number = np.concatenate(numbers) if numbers else np.zeros(0, np.int32)
        self.row = np.concatenate(rows) if rows else np.zeros(0, np.int32)

    def vocabularies(self, label: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the telling words and n-grams, sorted."""
        pairs = np.unique(self.number.astype(np.int64) * self.n + self.row)
        word, row = pairs // self.n, pairs % self.n
        ones, zeros = np.bincount(word, label[row], len(self.words)), np.bincount(word, 1 - label[row], len(self.words))
        known_words = np.sort(self.words[worth(ones, zeros, label, WORDS, least)])
        found, gram = np.unique(self.grams, return_inverse=True)
        gram, ones, zeros = gram.astype(np.int32), np.zeros(len(found)), np.zeros(len(found))
        order = np.argsort(row, kind="stable")
        word, row = word[order], row[order]
        for first in range(0, self.n, 100):
            a, b = np.searchsorted(row, [first, first + 100])
            size = np.diff(self.starts)[word[a:b]]
            ids = gram[np.repeat(self.starts[word[a:b]] - (np.cumsum(size) - size), size) + np.arange(size.sum())].astype(np.int64)
            once = np.unique(ids * 100 + np.repeat(row[a:b] - first, size))
            y = label[first + once % 100]
            ones += np.bincount(once // 100, y, len(found))
            zeros += np.bincount(once // 100, 1 - y, len(found))
        return known_words, np.sort(found[worth(ones, zeros, label, GRAMS, least)])


def windows(row: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions of the words of each overlapping window, PAD behind the last; row of each window)."""
    n = np.bincount(row, minlength=n_rows)
    begin = np.cumsum(n) - n
    per = np.where(n == 0, 0, np.where(n <= LENGTH, 1, -(-(n - LENGTH) // STRIDE) + 1))
    own = np.repeat(np.arange(n_rows), per)
    k = np.arange(len(own)) - np.repeat(np.cumsum(per) - per, per)
    at = (begin[own] + k * STRIDE)[:, None] + np.arange(LENGTH)
    return np.where(at < (begin + n)[own][:, None], at, PAD), own


class Network:
    """Its inputs are words and character n-grams of fixed vocabularies; place 0 stands for any other word."""

    def __init__(self, known_words: np.ndarray, known_grams: np.ndarray, seed: int = 5):
        r = np.random.default_rng(seed)
        self.known_words, self.known_grams = known_words, known_grams
        u = lambda *s: (r.normal(size=s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"ew": (r.normal(size=(len(known_words) + 1, DIM)) * 0.1).astype(np.float32), "ec": (r.normal(size=(max(1, len(known_grams)), DIM)) * 0.3).astype(np.float32)}
        for d in "fb":
            self.p |= {f"w{d}": u(2 * DIM, 3 * HIDDEN), f"u{d}": u(HIDDEN, 3 * HIDDEN), f"b{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"wa": u(2 * HIDDEN, ATTEND), "ba": np.zeros(ATTEND, np.float32), "v": u(ATTEND), "w": u(2 * HIDDEN), "b": np.zeros(1, np.float32)}

    def numbered(self, word_codes: np.ndarray, gram_codes: np.ndarray, starts: np.ndarray):
        """Codes as places in the vocabularies; n-grams outside are left out."""
        place = np.searchsorted(self.known_words, word_codes)
        place = np.minimum(place, max(len(self.known_words) - 1, 0))
        bucket = np.where(self.known_words[place] == word_codes, place + 1, 0) if len(self.known_words) else np.zeros(len(word_codes), np.int64)
        if not len(self.known_grams):
            return bucket, np.zeros(0, np.int64), np.zeros_like(starts)
        place = np.minimum(np.searchsorted(self.known_grams, gram_codes), len(self.known_grams) - 1)
        there = self.known_grams[place] == gram_codes
        return bucket, place[there], np.concatenate([[0], np.cumsum(there)])[starts]

    def inputs(self, bucket: np.ndarray, grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A vector for each distinct word: its bucket's, and the mean of its character n-grams'."""
        x = np.zeros((len(bucket), 2 * DIM), np.float32)
        x[:, :DIM] = self.p["ew"][bucket]
        some = np.flatnonzero(np.diff(starts) > 0)
        if len(some):
            x[some, DIM:] = np.add.reduceat(self.p["ec"][grams], starts[some], axis=0) / np.diff(starts)[some][:, None]
        return x

    # ---- scoring

    def scores(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Probability of each window; ``at`` holds rows of ``x``, PAD behind the last word."""
        out = np.zeros(len(at), np.float32)
        gates = {}
        for d in "fb":
            g = x @ self.p[f"w{d}"] + self.p[f"b{d}"]
            g[:, : 2 * HIDDEN] *= 0.5
            u = self.p[f"u{d}"].copy()
            u[:, : 2 * HIDDEN] *= 0.5
            gates[d] = [np.ascontiguousarray(g[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3)], [np.ascontiguousarray(u[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3)]
        whole = at[:, -1] != PAD
        for own, masked in ((np.flatnonzero(whole), False), (np.flatnonzero(~whole), True)):
            for k in range(0, len(own), 2048):
                out[own[k : k + 2048]] = self._score(gates, at[own[k : k + 2048]].T, masked)
        return out

    def _score(self, gates: dict, at: np.ndarray, masked: bool) -> np.ndarray:
        steps, n = at.shape
        hidden = np.empty((steps, n, 2 * HIDDEN), np.float32)
        there = at != PAD
        at = np.where(there, at, 0) if masked else at
        for d, side in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
            (gz, gr, gn), (uz, ur, un) = gates[d]
            h = np.zeros((n, HIDDEN), np.float32)
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                i = at[t]
                z = h @ uz
                z += gz[i]
                np.tanh(z, out=z)
                z += 1
                z *= 0.5
                r = h @ ur
                r += gr[i]
                np.tanh(r, out=r)
                r += 1
                r *= 0.5
                r *= h @ un
                r += gn[i]
                np.tanh(r, out=r)
                new = h - r
                new *= z
                new += r
                h = np.where(there[t][:, None], new, h) if masked else new
                hidden[t, :, side] = h
        flat = hidden.reshape(-1, 2 * HIDDEN)
        e = (np.tanh(flat @ self.p["wa"] + self.p["ba"]) @ self.p["v"]).reshape(steps, n)
        say = (flat @ self.p["w"]).reshape(steps, n)
        if masked:
            e = np.where(there, e, -1e9)
        e = np.exp(e - e.max(axis=0))
        logit = (e * say).sum(axis=0) / e.sum(axis=0) + self.p["b"][0]
        return 1 / (1 + np.exp(-logit))

    # ---- training

    def _forward(self, g: np.ndarray, u: np.ndarray, there: np.ndarray, order) -> tuple[np.ndarray, dict]:
        steps, n, _ = g.shape
        h = np.zeros((n, HIDDEN), np.float32)
        out, kept = np.empty((steps, n, HIDDEN), np.float32), {}
        for t in order:
            a = h @ u
            zr = 1 / (1 + np.exp(-(g[t, :, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])))
            z, r, an = zr[:, :HIDDEN], zr[:, HIDDEN:], a[:, 2 * HIDDEN :]
            new = np.tanh(g[t, :, 2 * HIDDEN :] + r * an)
            kept[t] = (h, z, r, an, new)
            h = np.where(there[t], new + z * (h - new), h)
            out[t] = h
        return out, kept

    def _backward(self, up: np.ndarray, u: np.ndarray, there: np.ndarray, order, kept: dict) -> tuple[np.ndarray, np.ndarray]:
        steps, n, _ = up.shape
        dg, du, carry = np.zeros((steps, n, 3 * HIDDEN), np.float32), np.zeros_like(u), np.zeros((n, HIDDEN), np.float32)
        for t in reversed(order):
            h, z, r, an, new = kept[t]
            dh = up[t] + carry
            live = dh * there[t]
            dn = live * (1 - z) * (1 - new * new)
            dz = live * (h - new) * z * (1 - z)
            dr = dn * an * r * (1 - r)
            dg[t] = np.concatenate([dz, dr, dn], axis=1)
            da = np.concatenate([dz, dr, dn * r], axis=1)
            du += h.T @ da
            carry = live * z + da @ u.T + dh * ~there[t]
        return dg, du

    def step(self, bucket, grams, starts, at: np.ndarray, label: np.ndarray, rate: float) -> float:
        """One Adam step on a batch of windows ``at`` (numbers of distinct words)."""
        p, at = self.p, at.T
        there = (at != PAD)[:, :, None]
        used, local = np.unique(np.where(at == PAD, at.max(), at), return_inverse=True)
        local = local.reshape(at.shape)
        size = np.diff(starts)[used]
        ids = grams[np.repeat(starts[used] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        x = self.inputs(bucket[used], ids, np.concatenate([[0], np.cumsum(size)]))
        orders = {"f": list(range(len(at))), "b": list(range(len(at) - 1, -1, -1))}
        run = {d: self._forward((x @ p[f"w{d}"] + p[f"b{d}"])[local], p[f"u{d}"], there, orders[d]) for d in "fb"}
        h = np.concatenate([run["f"][0], run["b"][0]], axis=2)
        q = np.tanh(h @ p["wa"] + p["ba"])
        e = np.where(there[:, :, 0], q @ p["v"], -1e9)
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        say = h @ p["w"]
        prob = 1 / (1 + np.exp(-((a * say).sum(axis=0) + p["b"][0])))
        d = ((prob - label) / len(label)).astype(np.float32)
        grad = {"b": np.array([d.sum()], np.float32), "w": np.einsum("tn,tnk->k", a * d, h)}
        de = a * d * (say - (a * say).sum(axis=0))
        grad["v"] = np.einsum("tn,tnk->k", de, q)
        dq = de[:, :, None] * p["v"] * (1 - q * q)
        grad["ba"], grad["wa"] = dq.sum(axis=(0, 1)), h.reshape(-1, 2 * HIDDEN).T @ dq.reshape(-1, ATTEND)
        dh = (a * d)[:, :, None] * p["w"] + dq @ p["wa"].T
        order, dx = np.argsort(local.ravel(), kind="stable"), np.zeros_like(x)
        first = np.searchsorted(local.ravel()[order], np.arange(len(used)))
        for k, side in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
            dg, grad[f"u{k}"] = self._backward(dh[:, :, side], p[f"u{k}"], there, orders[k], run[k][1])
            per = np.add.reduceat(dg.reshape(-1, 3 * HIDDEN)[order], first, axis=0)
            grad[f"b{k}"], grad[f"w{k}"] = per.sum(axis=0), x.T @ per
            dx += per @ p[f"w{k}"].T
        mean = np.repeat(dx[:, DIM:] / np.maximum(size, 1)[:, None], size, axis=0)
        grad["ew"] = np.stack([np.bincount(bucket[used], dx[:, k], len(p["ew"])) for k in range(DIM)], axis=1)
        grad["ec"] = np.stack([np.bincount(ids, mean[:, k], len(p["ec"])) for k in range(DIM)], axis=1)
        self._adam(grad, rate)
        return float(-np.log(np.where(label > 0.5, prob, 1 - prob) + 1e-7).mean())

    def _adam(self, grad: dict, rate: float) -> None:
        if not hasattr(self, "m"):
            self.m, self.s, self.t = {k: np.zeros_like(x) for k, x in self.p.items()}, {k: np.zeros_like(x) for k, x in self.p.items()}, 0
        self.t += 1
        for k, g in grad.items():
            g = g.astype(np.float32)
            self.m[k] += 0.1 * (g - self.m[k])
            self.s[k] += 0.01 * (g * g - self.s[k])
            self.p[k] -= rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.s[k] / (1 - 0.99**self.t)) + 1e-6)

    def frozen(self) -> Network:
        for k in ("m", "s", "t"):
            self.__dict__.pop(k, None)
        return self


def trained(texts: list[bytes], labels: list[int], rounds: tuple[int, int] = (1, 3), batch: int = 256, seed: int = 5, most_windows: int = 60_000) -> Network | None:
    """Learn from labels of whole texts: first every window has its text's label; then, in each further round, of a text with
    label 1 only the likeliest window counts (to a new network), then all that it finds likely."""
    label = np.array(labels, np.float32)
    if not len(label) or label.min() == label.max():
        return None
    sample = Sample(texts)
    at, own = windows(sample.row.astype(np.int64), len(texts))
    if not len(at):
        return None
    at = np.where(at == PAD, PAD, sample.number[np.maximum(at, 0)]).astype(np.int32)
    known = sample.vocabularies(label, min(LEAST_TEXTS, 2 + len(texts) // 100))
    net = Network(*known, seed)
    bucket, grams, starts = net.numbered(sample.words, sample.grams, sample.starts)
    del sample
    r = np.random.default_rng(seed)
    if len(at) > most_windows:  # the bound of the sample
        some = np.sort(r.permutation(len(at))[:most_windows])
        at, own = at[some], own[some]
    for k in range(sum(rounds)):
        y, use = label[own], np.arange(len(at))
        if k >= rounds[0]:
            said = net.scores(net.inputs(bucket, grams, starts), at)
            best = np.zeros(len(label), np.float32)
            np.maximum.at(best, own, said)
            use = np.flatnonzero((y < 0.5) | (said == best[own]) | ((said >= 0.5) & (k > rounds[0])))
            net = Network(*known, seed) if k == rounds[0] else net
        ones, zeros = use[y[use] > 0.5], use[y[use] <= 0.5]
        few, many = (ones, zeros) if len(ones) < len(zeros) else (zeros, ones)
        if len(few):
            use = np.concatenate([many, np.tile(few, max(1, min(4, len(many) // len(few) // 2)))])
        for _ in range(max(1, 100 * batch // max(1, len(use)))):  # small samples more than once
            mix = r.permutation(use)
            for i in range(0, len(mix), batch):
                some = mix[i : i + batch]
                net.step(bucket, grams, starts, at[some], y[some], RATE if k < sum(rounds) - 1 else RATE / 3)
    return net.frozen()

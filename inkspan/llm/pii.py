"""Personal data: rules, and a character-level bidirectional LSTM with CRF transitions that adds to them.

The rules find emails, IP addresses, card numbers and phone numbers (leftmost, non-overlapping within a
kind; a match that fails its test is dropped). The network finds these in other forms too, and secrets (keys,
tokens), for which there is no rule. It reads the classes of all characters of the whole text, a run of letters of one
case, with a blank after it, in one step (`steps`: nothing is lost, RUN letters at most are a step), in overlapping
windows, and tags each window by a Viterbi search over CRF transitions. Windows are reconciled over the whole text: each step takes its tag
from the window in which it stands most central, runs of tags that go on over windows are one span whatever its
length, and one weighted choice keeps spans from overlapping. Rule spans always stay; a network span is added where
it meets none of them and its mean marginal is at least CERTAIN.

Training happens in numpy on labelled spans: windows of a bounded sample of documents (SAMPLE) with the
spans that the rules find there, and spans and look-alikes drawn from a plain grammar (`drawn`) and set into
those documents' texts, and windows anywhere in texts of any kind. Windows with long digits or hexadecimal runs that
no rule labels are not shown, for nobody has said what these are. Windows around a digit, an at sign or a bracket
(anchors), where most forms are, have a share of their own in training; in reading, no position is left out.

A null text is empty and has no spans; equal texts have equal spans; a corpus without any text leaves the rules
alone; an empty table gives no rows. Each row is read by itself, whatever its doc_id; further columns are kept by
`redact`.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.llm.common import arrow_map, documents, utf8

#: Kinds of rules, then those that the network alone knows.
KINDS = ("email", "ip", "card", "phone", "secret")
RULED = 4
#: Of about READ documents, SAMPLE at most with an anchor and the beginnings (PART) of as many of any kind are trained
#: on; windows, passes over them.
READ, SAMPLE, PART, WINDOWS, EPOCHS = 6000, 600, 8192, 3000, 12
#: Steps of a window in training and from one to the next; in reading, where EDGE steps on each side are the neighbours'.
WIDTH, STRIDE, HIDDEN = 64, 32, 24
LONG, EDGE = 256, 16
CERTAIN = 0.8
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match of these begins at the start of a run of digits, so a look-behind saves trying inside runs.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((0, start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


# ---- the network -----------------------------------------------------------------------------

_SINGLE = " \n@.-+()_%=\"[]:/,#'"
#: Classes of letters (lower, upper, beyond Latin), of which a run is one step, as is a capital with the small letters after
#: it, with one blank after it if there is one; and letters of a step at most.
_LETTERS, RUN = (2, 3, 5, 0), 16  # the last for capitals with small letters
_BLANK = 6 + len(_SINGLE) + len(_LETTERS) * RUN  # numbers of runs with a blank begin here
CLASSES = _BLANK + len(_LETTERS) * RUN


def steps(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts one after another as steps: the class and length of each as one number (0 pads), its first character;
    and each text's first step and character (and one past the last)."""
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    c = _CLASS[np.minimum(np.frombuffer("".join(texts).encode("utf-32-le"), "<u4"), 255)]
    if not len(c):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(len(at), np.int64), at
    merged = _MERGED[c]
    new = ~merged
    new[1:] |= c[1:] != c[:-1]
    new[1:] &= (c[1:] != 6) | ~merged[:-1]
    new[at[:-1][at[:-1] < len(c)]] = True
    new[1:] &= (c[1:] != 2) | (c[:-1] != 3) | ~new[:-1]
    new[at[:-1][at[:-1] < len(c)]] = True
    first = np.flatnonzero(new)
    blank = np.append(first[1:], len(c)) - 1
    blank = (blank > first) & (c[blank] == 6)
    length = np.diff(first, append=len(c)) - blank
    if length.max() > RUN:
        parts = -(-length // RUN)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first, blank = np.repeat(first, parts) + RUN * nth, np.repeat(blank, parts) & (nth == np.repeat(parts, parts) - 1)
        length = np.diff(first, append=len(c)) - blank
    kind = c[first]
    kind[(kind == 3) & (length > 1) & (c[np.minimum(first + 1, len(c) - 1)] == 2)] = 0
    return np.where(_MERGED[kind], _FIRST[kind] + length - 1 + blank * (CLASSES - _BLANK), kind).astype(np.uint8), first, np.searchsorted(first, at), at


def _class_table() -> np.ndarray:
    t = np.full(256, 5, np.uint8)
    for c in [*range(128), *(c for c in range(128, 256) if chr(c).isalpha())]:
        s = chr(c)
        t[c] = 1 if s.isdigit() else 2 if s.islower() else 3 if s.isupper() else 6 + _SINGLE.index(s) if s in _SINGLE else 4
    return t


_CLASS = _class_table()
_MERGED, _FIRST = np.zeros(6 + len(_SINGLE), bool), np.zeros(6 + len(_SINGLE), np.int64)
_MERGED[list(_LETTERS)] = True  # no character has class 0
#: Number of a run of one letter of each, from where those of two and so on go on.
_FIRST[list(_LETTERS)] = [6 + len(_SINGLE) + i * RUN for i in range(len(_LETTERS))]
LABELS = 1 + 2 * len(KINDS)  # O, then B and I of each kind
_FORBIDDEN = np.zeros((LABELS, LABELS), np.float32)
for _k in range(len(KINDS)):
    _ok = np.zeros(LABELS, bool)
    _ok[[1 + 2 * _k, 2 + 2 * _k]] = True
    _FORBIDDEN[~_ok, 2 + 2 * _k] = -1e4


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lse(x, axis):
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


class Tagger:
    """Parameters and passes of the network; all arrays are time first."""

    def __init__(self, seed: int = 11):
        rng = np.random.Generator(np.random.PCG64(seed))
        w = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {}
        for d in "fb":
            self.p |= {f"x{d}": w(CLASSES, 4 * HIDDEN), f"h{d}": w(HIDDEN, 4 * HIDDEN), f"c{d}": np.zeros(4 * HIDDEN, np.float32)}
            self.p[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1
        self.p |= {"o": w(2 * HIDDEN, LABELS), "ob": np.zeros(LABELS, np.float32), "t": np.zeros((LABELS, LABELS), np.float32)}

    def _lstm(self, x, d, keep):
        z, h = self.p[f"x{d}"][x] + self.p[f"c{d}"], HIDDEN
        n = x.shape[1]
        hs, cs, gates = np.zeros((len(x) + 1, n, h), np.float32), np.zeros((len(x) + 1, n, h), np.float32), []
        for t in range(len(x)):
            a = z[t] + hs[t] @ self.p[f"h{d}"]
            s, g = _sigmoid(a[:, : 3 * h]), np.tanh(a[:, 3 * h :])
            cs[t + 1] = s[:, h : 2 * h] * cs[t] + s[:, :h] * g
            tc = np.tanh(cs[t + 1])
            hs[t + 1] = s[:, 2 * h :] * tc
            if keep:
                gates.append((s, g, tc))
        return hs, cs, gates

    def _back(self, x, d, hs, cs, gates, dh_out, grads):
        h = HIDDEN
        dh = dc = np.zeros((x.shape[1], h), np.float32)
        gh = np.zeros_like(self.p[f"h{d}"])
        kinds = np.zeros((x.size, CLASSES), np.float32)
        kinds[np.arange(x.size), x.reshape(-1)] = 1
        das = np.empty((*x.shape, 4 * h), np.float32)
        for t in range(len(x) - 1, -1, -1):
            s, g, tc = gates[t]
            dh = dh + dh_out[t]
            i, f, o = s[:, :h], s[:, h : 2 * h], s[:, 2 * h :]
            dc = dc + dh * o * (1 - tc * tc)
            da = das[t] = np.concatenate([dc * g * i * (1 - i), dc * cs[t] * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            gh += hs[t].T @ da
            dh, dc = da @ self.p[f"h{d}"].T, dc * f
        gx = kinds.T @ das.reshape(x.size, -1)
        grads[f"x{d}"], grads[f"h{d}"], grads[f"c{d}"] = gx, gh, gx.sum(axis=0)

    def emissions(self, x, keep=False):
        f, b = self._lstm(x, "f", keep), self._lstm(x[::-1], "b", keep)
        both = np.concatenate([f[0][1:], b[0][1:][::-1]], axis=2)
        return both @ self.p["o"] + self.p["ob"], both, f, b

    def read(self, x):
        """Emissions as in `emissions`, but time, label, window: for reading alone. One activation serves all gates (a logistic
        is a tanh of half its argument), halves are left to the weights, and nothing but outputs is kept."""
        h, n = HIDDEN, x.shape[1]
        out = np.repeat(self.p["ob"][None, :, None], len(x), 0)
        half = np.repeat(np.array([0.5, 0.5, 0.5, 1], np.float32), h)
        for d, y, o in (("f", x, self.p["o"][:h]), ("b", x[::-1], self.p["o"][h:])):
            table, weights = np.ascontiguousarray(((self.p[f"x{d}"] + self.p[f"c{d}"]) * half).T), np.ascontiguousarray((self.p[f"h{d}"] * half * np.float32(0.5)).T)
            hs, c, z, a = np.zeros((len(x) + 1, h, n), np.float32), np.zeros((h, n), np.float32), *np.empty((2, 4 * h, n), np.float32)
            tc = np.empty_like(c)
            for t in range(len(x)):
                np.take(table, y[t], axis=1, out=z, mode="clip")
                np.matmul(weights, hs[t], out=a)
                a += z
                np.tanh(a, out=a)
                a[: 3 * h] += 1
                g = a[3 * h :]
                g *= a[:h]
                c *= a[h : 2 * h]
                c += g
                c *= 0.5
                np.multiply(a[2 * h : 3 * h], np.tanh(c, out=tc), out=hs[t + 1])
            made = np.matmul((o * np.float32(0.5)).T, hs[1:])
            out = out + (made if d == "f" else made[::-1])
        return out

    def doubtful(self, e):
        """Windows of `read` whose best path may hold a span: an upper bound of what a run of tags gains over
        none, kind by kind, of the better of a kind's two labels wherever both can go on, is not below zero."""
        trans = self.p["t"] + _FORBIDDEN - self.p["t"][0, 0]
        on = np.maximum(trans[1::2, 2::2].diagonal(), trans[2::2, 2::2].diagonal())[:, None]
        from_none, from_any = trans[0, 1::2][:, None], trans[1:, 1::2].max(axis=0)[:, None]
        off = np.maximum(trans[1::2, 0], trans[2::2, 0])[:, None]
        begins, goes = (e[:, k::2] - e[:, :1] for k in (1, 2))
        s = begins[0]
        most = (s + off).max(axis=0)
        for t in range(1, len(e)):
            fresh = np.maximum(s.max(axis=0) + from_any, from_none)
            fresh += begins[t]
            s = s + on
            s += goes[t]
            np.maximum(s, fresh, out=s)
            np.maximum(most, (s + off).max(axis=0), out=most)
        return np.maximum(most, s.max(axis=0)) > -1e-3

    def marginals(self, e):
        """Label marginals and the normaliser's parts."""
        trans = self.p["t"] + _FORBIDDEN
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0] + _FORBIDDEN[0]
        for t in range(1, len(e)):
            alpha[t] = e[t] + _lse(alpha[t - 1][:, :, None] + trans, 1)
        for t in range(len(e) - 2, -1, -1):
            beta[t] = _lse(trans + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        z = _lse(alpha[-1], 1)
        return np.exp(alpha + beta - z[None, :, None]), alpha, beta, z

    def viterbi(self, e):
        trans = self.p["t"] + _FORBIDDEN
        best, back = e[0] + _FORBIDDEN[0], np.empty(e.shape, np.int64)
        for t in range(1, len(e)):
            s = best[:, :, None] + trans
            back[t] = s.argmax(axis=1)
            best = e[t] + s.max(axis=1)
        out = np.empty(e.shape[:2], np.int64)
        out[-1] = best.argmax(axis=1)
        for t in range(len(e) - 1, 0, -1):
            out[t - 1] = np.take_along_axis(back[t], out[t][:, None], axis=1)[:, 0]
        return out

    def gradients(self, x, y):
        e, both, f, b = self.emissions(x, True)
        m, alpha, beta, z = self.marginals(e)
        trans, n = self.p["t"] + _FORBIDDEN, x.shape[1]
        de = m.copy()
        np.put_along_axis(de, y[:, :, None], np.take_along_axis(de, y[:, :, None], 2) - 1, 2)
        dt = np.zeros_like(self.p["t"])
        for t in range(1, len(x)):
            dt += np.exp(alpha[t - 1][:, :, None] + trans + (e[t] + beta[t])[:, None, :] - z[:, None, None]).sum(axis=0)
            np.add.at(dt, (y[t - 1], y[t]), -1)
        de /= n
        g = {"t": dt / n, "o": np.einsum("tnh,tnl->hl", both, de), "ob": de.sum(axis=(0, 1))}
        db = de @ self.p["o"].T
        self._back(x, "f", *f, db[:, :, :HIDDEN], g)
        self._back(x[::-1], "b", *b, db[::-1, :, HIDDEN:], g)
        return g

    def train(self, x, y, epochs=EPOCHS, batch=96, rate=0.02, seed=5):
        rng, steps = np.random.Generator(np.random.PCG64(seed)), epochs * max(1, x.shape[1] // batch)
        m, v, k = {n: np.zeros_like(a) for n, a in self.p.items()}, {n: np.zeros_like(a) for n, a in self.p.items()}, 0
        for _ in range(epochs):
            for at in np.array_split(rng.permutation(x.shape[1]), max(1, x.shape[1] // batch)):
                g, k = self.gradients(x[:, at], y[:, at]), k + 1
                norm = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
                for n, a in g.items():
                    a = a * min(1.0, 5 / (norm + 1e-9))
                    m[n] += 0.1 * (a - m[n])
                    v[n] += 0.005 * (a * a - v[n])
                    self.p[n] = (self.p[n] - rate * max(0.05, 1 - k / steps) * (m[n] / (1 - 0.9**k)) / (np.sqrt(v[n] / (1 - 0.995**k)) + 1e-6)).astype(np.float32)
        return self


def window_starts(anchors: np.ndarray, length: int) -> list[int]:
    """Starts of overlapping windows that hold every anchor with context on a grid of STRIDE."""
    grid = np.unique(np.concatenate([anchors // STRIDE, np.maximum(anchors // STRIDE - 1, 0)]))
    return (grid[grid * STRIDE < length] * STRIDE).tolist()


#: Digits and the class numbers of an at sign and brackets: the steps that most forms hold.
_ANCHOR = np.zeros(CLASSES, bool)
_ANCHOR[[1, *(6 + _SINGLE.index(c) for c in "@([")]] = True
_RULED = np.zeros(CLASSES, bool)  # what every rule needs one of
_RULED[[1, 6 + _SINGLE.index("@")]] = True


def choose(spans: list[tuple[float, int, int, int]]) -> list[tuple[int, int, int]]:
    """Of (weight, kind, start, end), those of the greatest total weight that do not overlap."""
    spans = sorted(set(spans), key=lambda s: (s[3], s[2], s[1], s[0]))
    ends = [s[3] for s in spans]
    best: list[tuple[float, int | None, int]] = [(0.0, None, 0)]  # total, span taken, where to go on
    for i, (w, _, start, _) in enumerate(spans):
        j = int(np.searchsorted(ends[:i], start, "right"))
        best.append(max((best[j][0] + w, i, j), (best[i][0], None, i), key=lambda x: x[0]))
    out, i = [], len(spans)
    while i:
        _, took, j = best[i]
        if took is not None:
            out.append(spans[took][1:])
        i = j
    return sorted(out)


def find_spans(texts: list[str], tagger: Tagger | None, batch: int = 512) -> list[list[tuple[int, int, int]]]:
    """All spans of each text, by kind, then start."""
    codes, first, begins, at = steps(texts)
    ruled = np.concatenate([[0], np.cumsum(_RULED[codes])])[begins]
    rules = [rule_spans(t) if a < b else [] for t, a, b in zip(texts, ruled[:-1], ruled[1:], strict=True)]
    if tagger is None or not len(codes):
        return rules
    for i, tag, sure in _tagged(codes, begins, tagger, batch):
        edges = np.append(first[begins[i] : begins[i + 1]], at[i + 1]) - at[i]
        found = [(w, k, int(edges[a]), int(edges[b]) - int(codes[begins[i] + b - 1] >= _BLANK)) for w, k, a, b in _runs(tag, sure) if w >= CERTAIN]
        fresh = [x for x in found if not any(x[2] < d and c < x[3] for _, c, d in rules[i])]
        if fresh:
            rules[i] = sorted(rules[i] + choose(fresh))
    return rules


def _tagged(codes: np.ndarray, begins: np.ndarray, tagger: Tagger, batch: int):
    """(text, tags, marginals) of the steps of each text with any tag. Windows of LONG steps begin LONG - 2 * EDGE steps
    apart, so every step of a text is read; a shorter one is filled up to the next multiple of WIDTH."""
    n, own = np.diff(begins), LONG - 2 * EDGE
    count = np.where(n > 0, np.maximum(-(-(n - 2 * EDGE) // own), 1), 0)
    text = np.repeat(np.arange(len(n)), count)
    start = (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * own
    left = np.minimum(n[text] - start, LONG)
    wide = -(-left // WIDTH) * WIDTH
    padded = np.concatenate([codes, np.zeros(LONG, np.uint8)])
    found: dict[int, list] = {}
    for width in np.unique(wide).tolist():
        of = np.flatnonzero(wide == width)
        steps_ = np.arange(width)[:, None]
        for k in range(0, len(of), batch):
            part = of[k : k + batch]
            x = np.where(steps_ < left[part], padded[begins[text[part]] + start[part] + steps_], 0).astype(np.intp)
            e = tagger.read(x)
            some = np.flatnonzero(tagger.doubtful(e))
            if not len(some):
                continue
            e = np.ascontiguousarray(e[:, :, some].transpose(0, 2, 1))
            best = tagger.viterbi(e)
            any_ = np.flatnonzero(best.any(axis=0))
            if len(any_):
                sure = np.take_along_axis(tagger.marginals(e[:, any_])[0], best[:, any_, None], 2)[:, :, 0]
                for j, w in enumerate(part[some[any_]].tolist()):
                    found.setdefault(int(text[w]), []).append((int(start[w]), best[:, any_[j]].astype(np.int8), sure[:, j].astype(np.float32)))
    for i, windows in sorted(found.items()):
        tags, marks = np.zeros(n[i], np.int8), np.zeros(n[i], np.float32)
        for s, tag, mark in windows:
            a = EDGE if s else 0
            b = min(LONG - EDGE if s + LONG < n[i] else LONG, n[i] - s)
            tags[s + a : s + b], marks[s + a : s + b] = tag[a:b], mark[a:b]
        if tags.any():
            yield i, tags, marks


def _runs(tags: np.ndarray, sure: np.ndarray) -> list[tuple[float, int, int, int]]:
    """(mean marginal, kind, first step, one past the last) of the spans of tags; what stands without its beginning begins itself."""
    kinds = (tags.astype(np.int64) + 1) // 2  # 0, then 1 for the first kind
    new = np.flatnonzero(np.concatenate([[True], (kinds[1:] != kinds[:-1]) | ((tags[1:] % 2 == 1))]))
    return [(float(sure[a:b].mean()), int(kinds[a]) - 1, a, b) for a, b in zip(new.tolist(), [*new[1:].tolist(), len(tags)], strict=True) if kinds[a]]


def drawn(rng, kind: int | None = None) -> tuple[int | None, str]:
    """A kind and a form of it, or None and something that only looks like one, from a plain grammar."""
    pick = lambda options: options[int(rng.integers(0, len(options)))]
    d = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    n = lambda a, b: int(rng.integers(a, b + 1))
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, n(2, 9)))
    of = lambda letters, k: "".join(letters[int(i)] for i in rng.integers(0, len(letters), k))
    hexa, wide = "0123456789abcdef", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    letters = wide[10:]
    kind = kind if kind is not None else n(-1, len(KINDS) - 1)
    if kind == 0:
        name, host = pick([word(), f"{word()}.{word()}", f"{word()}_{d(2)}", f"{word()}.{d(2)}", f"{word()}{d(3)}"]), pick([f"{word()}.com", f"{word()}.example.org", f"mail{d(1)}.{word()}.net"])
        shouted = host.replace(".", " DOT ")
        dotted = host.replace(".", pick([" (dot) ", "(dot)", " [dot] "]))
        return 0, pick([f"{name}@{host}", f"{name}@[{host}]", f"{name} @ {host}", f"{name}(at){host}", f"{name} (at) {host}", f"{name}[at]{host}", f"{name} [at] {dotted}", f"{name} (at) {dotted}", f"{name}@[{word()}{word()}.{host}]", f"{name} AT {shouted}", f"{name}{{at}}{host}"])
    if kind == 1:
        part = [str(n(0, 255)) for _ in range(4)]
        return 1, pick([".".join(part), " . ".join(part), "[.]".join(part), "(.)".join(part), ":".join(of(hexa, 4) for _ in range(8))])
    if kind == 2:
        return 2, pick([d(16), d(16), f"{d(4)} {d(4)} {d(4)} {d(4)}", f"{d(4)}-{d(4)}-{d(4)}-{d(4)}", d(n(17, 19)), f"{d(4)}.{d(4)}.{d(4)}.{d(4)}"])
    if kind == 3:
        return 3, pick([f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"0{d(2)} {d(4)} {d(4)}", f"+{d(1)} ({d(3)}) {d(3)}-{d(4)}", f"+{d(2)} {d(3)} {d(3)} {d(3)}", f"00{d(2)} {d(3)} {d(6)}"])
    if kind == 4:
        s = pick([of(hexa, 40), of(hexa, 32), of(hexa, 64), of(wide, n(24, 44)), f"sk-{of(wide, n(20, 40))}", of(hexa, 40).upper(), f"{of(wide, 8)}-{of(wide, 24)}", of(letters, n(24, 44))])
        return 4, s
    year = str(n(1800, 2100))
    return None, pick([year, d(1), d(2), d(3), d(n(4, 9)), f"{d(1)}.{d(1)}", f"{d(2)}.{d(2)}", f"{d(1)}.{d(1)}.{d(2)}", f"{year}-{d(2)}-{d(2)}", f"{d(2)}.{d(2)}.{year}", f"{d(2)}/{d(2)}/{year}", f"{d(2)}:{d(2)}", f"{d(2)}:{d(2)}:{d(2)}", f"${d(2)}.{d(2)}", f"{d(1)},{d(3)},{d(3)}", f"{d(2)}%", f"{word()}{d(1)}", f"v{d(1)}.{d(1)}.{d(1)}", f"@{word()}", f"({word()})", f"[{d(1)}]", f"({year})", f"{d(3)}-{d(3)}", f"({word()} {word()})", f"{word()}-{d(2)}"])


def _lead(rng, kind: int | None) -> str:
    """What may stand before a span, with it in one breath."""
    if kind == 4:
        return ("", 'token = "', "token: ", 'api_key="', "secret ", "password: ", "KEY = ")[int(rng.integers(0, 7))]
    return ("", "", "", "", "(", '"', "<", "tel ", "mail ", "no. ")[int(rng.integers(0, 10))]


def set_in(text: str, rng, items: int = 2) -> tuple[str, list[tuple[int, int, int]]]:
    """A short passage of text (its digits, at signs and brackets as letters) with drawn items between its words,
    and their spans."""
    clear = re.sub(r"[0-9@(\[]", "a", text)
    start = int(rng.integers(0, max(1, len(clear) - 2 * WIDTH)))
    words = clear[start : start + 2 * WIDTH].split(" ")
    if rng.random() < 0.1:
        words = [w.upper() for w in words]
    spans, at, parts = [], 0, []
    places = set(rng.integers(0, len(words), items).tolist())
    for k, w in enumerate(words):
        piece = w
        if k in places:
            kind, form = drawn(rng)
            lead = _lead(rng, kind)
            tail = {"(": ")", '"': '"', "<": ">"}.get(lead[-1:], "") + ("", "", "", ".", ",", "%%%", "###", "!!", "$$$", "\n")[int(rng.integers(0, 10))]
            if kind is not None:
                spans.append((kind, at + len(lead), at + len(lead) + len(form)))
            piece = lead + form + tail
        parts.append(piece)
        at += len(piece) + 1
    return " ".join(parts), spans


#: Runs that may be personal or secret, though no rule says so.
_UNSAID = re.compile(r"[0-9](?:[ .()/-]{0,2}[0-9]){9,}|[0-9A-Za-z_-]*[0-9][0-9A-Za-z_-]{19,}")


def training_windows(texts: list[str], windows: int = WINDOWS, seed: int = 3, plain: list[str] | None = None) -> tuple[np.ndarray, np.ndarray] | None:
    """`windows` windows around anchors and drawn items, and a third as many anywhere in `plain` (the texts, if not given)."""
    rng = np.random.Generator(np.random.PCG64(seed))
    xs, ys = [], []

    def add(read, spans, start, unsaid=()):
        codes, first = read
        at = first[start : start + WIDTH]
        if any(a <= at[-1] and at[0] < b for a, b in unsaid):
            return
        x, y = np.zeros(WIDTH, np.int64), np.zeros(WIDTH, np.int64)
        x[: len(at)] = codes[start : start + WIDTH]
        for k, a, b in spans:  # of a span that began before the window, the rest
            inside = np.flatnonzero((at >= a) & (at < b))
            if len(inside):
                y[inside] = 2 + 2 * k
                y[inside[0]] = 1 + 2 * k
        xs.append(x)
        ys.append(y)

    def known(text):
        spans = rule_spans(text)
        return spans, [m.span() for m in _UNSAID.finditer(text) if not any(a < m.end() and m.start() < b for _, a, b in spans)]

    texts, plain = [t for t in texts if t], [t for t in (texts if plain is None else plain) if t]
    if not texts and not plain:
        return None
    hosts = texts or plain
    for text in texts:
        read, (spans, unsaid) = steps([text])[:2], known(text)
        for s in window_starts(np.flatnonzero(_ANCHOR[read[0]]), len(read[0])):
            add(read, spans, s, unsaid)
    keep = rng.permutation(len(xs))[: windows // 3].tolist()
    xs, ys = [xs[i] for i in keep], [ys[i] for i in keep]
    while len(xs) < windows:
        text, spans = set_in(hosts[int(rng.integers(0, len(hosts)))], rng)
        read = steps([text])[:2]
        where = np.flatnonzero(_ANCHOR[read[0]] | np.any([(read[1] >= a) & (read[1] < b) for _, a, b in spans] or [False], axis=0))
        for s in window_starts(where, len(read[0])) or [0] * bool(text):
            add(read, spans, s)
    xs, ys = xs[:windows], ys[:windows]
    for i in rng.integers(0, len(plain), windows // 3).tolist() if plain else ():
        read = steps([plain[i]])[:2]
        spans, unsaid = known(plain[i])
        add(read, spans, STRIDE * int(rng.integers(0, -(-len(read[0]) // STRIDE))), unsaid)
    return np.array(xs).T, np.array(ys).T


def fit(df: DataFrame, doc_id: str = "doc_id", text: str = "text", read: int = READ, sample: int = SAMPLE) -> Tagger | None:
    """A tagger from at most `sample` documents with an anchor and the beginnings of as many of any kind, of about `read`
    documents by a hash of doc_id."""
    n = df.count()
    share = min(1.0, read / max(n, 1))
    some = df.filter((F.pmod(F.xxhash64(doc_id), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))) & (F.length(text) > 0))
    first = lambda rows, part: [r[0] for r in rows.select(part.alias("_t"), F.xxhash64(doc_id).alias("_h")).orderBy("_h", "_t").limit(sample).collect()]
    marked = first(some.filter(F.col(text).rlike(r"[0-9@(\[]")), F.col(text))
    made = training_windows(marked, plain=first(some, F.substring(text, 1, PART)))
    return None if made is None else Tagger().train(*made)


def _said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


#: Texts, and bytes unless one text has more, that are read at once.
_ROWS, _BYTES = 256, 1 << 21


def _with_spans(column, tagger):
    """Texts that are not empty, and their spans, by row."""
    data, offsets = utf8(column)
    at = np.flatnonzero(offsets[1:] > offsets[:-1])
    k = 0
    while k < len(at):
        end = min(k + _ROWS, max(k + 1, int(np.searchsorted(offsets[at + 1], offsets[at[k]] + _BYTES, "right"))))
        rows = at[k:end].tolist()
        texts = [data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in rows]
        yield from zip(rows, texts, find_spans(texts, tagger), strict=True)
        k = end


def detect(df: DataFrame, tagger: Tagger | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the number of rule spans by kind, their digest, all spans, and the number of all spans and of secrets."""

    def run(batches):
        import pyarrow as pa

        none = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            n = batch.num_rows
            counts, shas, spans = np.zeros((n, RULED), np.int64), [none] * n, [""] * n
            every, secrets = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for i, t, found in _with_spans(batch.column("text"), tagger):
                if not found:
                    continue
                base = rule_spans(t)
                for k, _, _ in base:
                    counts[i, k] += 1
                shas[i] = hashlib.sha256(_said(base).encode()).hexdigest()
                spans[i], every[i], secrets[i] = _said(found), len(found), sum(k == 4 for k, _, _ in found)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | {f"n_{k}": pa.array(counts[:, j]) for j, k in enumerate(KINDS[:RULED])} | {"base_sha256": shas, "spans": spans, "n_spans": pa.array(every), "n_secret": pa.array(secrets)})

    return arrow_map(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long, n_secret long")


def redact(df: DataFrame, tagger: Tagger | None, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """df with every span replaced by its kind in angle brackets (n_chars, if there, follows)."""
    counted = n_chars if n_chars in df.columns else None

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            at = batch.schema.get_field_index(text)
            new = {}
            for i, t, spans in _with_spans(batch.column(at), tagger):
                if not spans:
                    continue
                done, parts = 0, []
                for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
                    if a >= done:
                        parts += [t[done:a], f"<{KINDS[k].upper()}>"]
                        done = b
                    elif b > done:  # overlaps the span before it: nothing of it stays
                        done = b
                new[i] = "".join([*parts, t[done:]])
            texts = batch.column(at).to_pylist()
            for i, t in new.items():
                texts[i] = t
            out = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            if counted:
                c = batch.schema.get_field_index(counted)
                lengths = batch.column(c).to_pylist()
                for i, t in new.items():
                    lengths[i] = len(t)
                out = out.set_column(c, batch.schema.field(c), pa.array(lengths, batch.schema.field(c).type))
            yield out

    return arrow_map(df, run, df.schema)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return detect(docs, fit(docs))

"""Personal data: fixed patterns, and a character BiLSTM with a CRF for what they miss.

Base spans come from four patterns. The network adds spans of the same kinds in other spellings
(phone numbers without a plus, addresses with ``(at)`` or `` at ... dot `` ...). It reads the whole text,
one of about 90 character classes at each place in both directions, and a conditional random field
scores the tags (outside, or beginning or inside of a kind); both are trained in numpy from labelled
spans: base spans of a bounded sample of documents, and spans written into clean passages of that
sample, next to look-alikes that are none (versions, secrets, years, prices). What it adds must pass
the checks of its kind (Luhn, parts up to 255, 9 to 15 digits; an address has a sign for "at").

Texts are covered by overlapping windows; the windows' tag scores are averaged, weighted to their
middles, and one Viterbi run over the whole text makes the spans, so a span over a window's edge is
found once and whole. The run skips places that no span of the best path can cover: those through
which no span of any kind gains on tags outside, with the best transitions (``_alive``); and runs
of places that hold neither four digits nor a sign for "at" that the checks may take, so that no span in
them can pass (``_held``). Neither changes a result. A span ends where its first and last words end (``_settled``).

Defined results: null text is the empty text and has no spans; spans are in code points with the
end exclusive; overlapping base spans of different kinds all stay; a network span that touches a
base span is dropped; repeated rows come out as often as they came in. Time and memory are linear
in the length of a text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.llm.common import table, texts_of

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: The patterns of numbers. A run of digits is tried from its beginning only, as no match can begin inside one.
PATTERNS = {
    1: re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    2: re.compile(r"[0-9](?:[\x20-]?[0-9])++"),
    3: re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
WINDOW, STRIDE = 512, 480
#: Added to the scores of an address's tags: its checks drop what is found too much.
LEAN = 0.7
_BRACKETED = r"[\[({<]\s*at\s*[\])}>]"
#: Signs for "at", and what may follow one: labels joined by dots or spelled-out dots.
_AT = re.compile(rf"\s*(?:@|{_BRACKETED})\s*|\sat\s", re.IGNORECASE)
_HOST = re.compile(r"[a-z0-9-]++(?:(?:\.|\s?[\[({<]dot[\])}>]\s?|\sdot\s)[a-z0-9-]++)*", re.IGNORECASE)
_CLEAN = re.compile(rf"[0-9@]|{_BRACKETED}", re.IGNORECASE)
_SIGNS = "@._%+-()/:,;!?\"'#&*=[]{}<>|~^$"
TAGS = 1 + 2 * len(KINDS)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _passes(kind: int, match: str) -> bool:
    if kind == 1:
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in match.split("."))
    if kind == 0:
        return True
    digits = "".join(c for c in match if "0" <= c <= "9")
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 9 <= len(digits) <= 15


def _settled(text: str, kind: int, a: int, e: int) -> tuple[int, int] | None:
    """The span with whole words at its ends, or None if it can't be of its kind.

    An address has a sign for "at" and reaches over the words on both sides of it; a bare "at" needs a
    dot after it. Of numbers the digits must pass the checks of the patterns, whatever signs are between.
    """
    if kind == 0:
        sign = _AT.search(text, a, min(e + 1, len(text)))
        host = _HOST.match(text, sign.end()) if sign else None
        if not host or (sign.group().strip().isalpha() and host.group().isalnum()):
            return None
        start = sign.start()
        while start > 0 and text[start - 1] in _LOCAL:
            start -= 1
        return (start, host.end()) if start < sign.start() else None
    while a > 0 and text[a].isalnum() and text[a - 1].isalnum():
        a -= 1
    while e < len(text) and text[e].isalnum() and text[e - 1].isalnum():
        e += 1
    while a < e and not (text[a].isalnum() or text[a] in "+("):
        a += 1
    while e > a and not text[e - 1].isalnum():
        e -= 1
    parts = re.findall(r"[0-9]+", text[a:e])
    if kind == 1:
        return (a, e) if len(parts) == 4 and _passes(1, ".".join(parts)) else None
    return (a, e) if _passes(kind, "".join(parts)) else None


def emails(text: str) -> list[tuple[int, int]]:
    """(start, end) of the addresses, leftmost first: one look to the left and right of each @."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        done = at + 1
        if found:
            done = found.end()
            out.append((start, done))
        at = text.find("@", done)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches that pass, sorted."""
    out = [(start, 0, end) for start, end in emails(text)]
    if _ANY_DIGIT.search(text):
        for kind, pattern in PATTERNS.items():
            if kind != 3 or "+" in text:
                out += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if _passes(kind, m.group())]
    return sorted(out)


_ANY_DIGIT = re.compile(r"[0-9]")


def _class_table() -> np.ndarray:
    out = np.full(128, 3, np.int64)  # other
    for c in range(128):
        ch = chr(c)
        if ch.isdigit():
            out[c] = 1
        elif ch == " ":
            out[c] = 2
        elif ch in "\t\n\r\x0b\x0c":
            out[c] = 4
        elif ch in _SIGNS:
            out[c] = 6 + _SIGNS.index(ch)
        elif ch.islower():
            out[c] = 6 + len(_SIGNS) + ord(ch) - ord("a")
        elif ch.isupper():
            out[c] = 6 + len(_SIGNS) + 26 + ord(ch) - ord("A")
    return out


_CLASS = _class_table()
CLASSES = 6 + len(_SIGNS) + 52


def classes_of(text: str) -> np.ndarray:
    """Character class of each place: 0 is padding, 5 any character beyond ASCII; letters and signs have their own."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(c < 128, _CLASS[np.minimum(c, 127)], 5).astype(np.int8)


def _act(x: np.ndarray) -> np.ndarray:
    """The curve of all gates and cells, from -1 to 1 like tanh, at a quarter of its cost."""
    return x / np.sqrt(1 + x * x)


def _slope(x: np.ndarray) -> np.ndarray:
    """The derivative of ``_act``."""
    return (1 + x * x) ** -1.5


def _act_into(x: np.ndarray, room: np.ndarray, out: np.ndarray) -> None:
    """``_act`` of x written to ``out``, which may be x, with an array of its shape as room."""
    np.multiply(x, x, out=room)
    room += 1
    np.sqrt(room, out=room)
    np.divide(x, room, out=out)


@dataclass
class Tagger:
    """Weights: input tables and recurrences of both directions, tag scores, tag transitions."""

    wx: np.ndarray  # 2, classes, 4h
    wh: np.ndarray  # 2, h, 4h
    wo: np.ndarray  # 2, h, tags
    bo: np.ndarray  # tags
    tr: np.ndarray  # tags, tags
    first: np.ndarray  # tags

    def run(self, c: np.ndarray, keep: bool = False):
        """Tag scores (n, T, tags) of windows of classes (n, T)."""
        n, t = c.shape
        h = self.wh.shape[1]
        both = np.stack([c, c[:, ::-1]])
        hid = np.zeros((2, n, h), np.float32)
        cell = np.zeros((2, n, h), np.float32)
        outs = np.empty((2, n, t, h), np.float32)
        trace = []
        for k in range(t):
            z = np.stack([self.wx[0][both[0, :, k]], self.wx[1][both[1, :, k]]]) + hid @ self.wh
            gate = 0.5 * _act(0.5 * z[..., : 3 * h]) + 0.5
            i, f, o = gate[..., :h], gate[..., h : 2 * h], gate[..., 2 * h :]
            g = _act(z[..., 3 * h :])
            new = f * cell + i * g
            tc = _act(new)
            if keep:
                trace.append((hid, cell, z, i, f, o, g, new, tc))
            cell, hid = new, o * tc
            outs[:, :, k] = hid
        outs[1] = outs[1, :, ::-1]
        scores = outs[0] @ self.wo[0] + outs[1] @ self.wo[1] + self.bo
        return (scores, outs, both, trace) if keep else scores

    def gradients(self, c: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log likelihood of the tags and its gradient for each array of weights."""
        scores, outs, both, trace = self.run(c, keep=True)
        loss, ds, dtr, dfirst = crf_loss(scores.astype(np.float64), tags, self.tr, self.first)
        n, t = c.shape
        h = self.wh.shape[1]
        ds = ds.astype(np.float32)
        dbo = ds.sum(axis=(0, 1))
        flat = ds.reshape(n * t, -1)
        dwo = np.stack([outs[d].reshape(n * t, h).T @ flat for d in (0, 1)])
        dout = np.stack([ds @ self.wo[0].T, (ds @ self.wo[1].T)[:, ::-1]])
        dwh = np.zeros_like(self.wh)
        dzs = np.empty((2, t, n, 4 * h), np.float32)
        dh, dc = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
        back = np.swapaxes(self.wh, 1, 2)
        for k in range(t - 1, -1, -1):
            hid, cell, z, i, f, o, g, new, tc = trace[k]
            dh = dh + dout[:, :, k]
            dcell = dc + dh * o * _slope(new)
            dz = np.concatenate([dcell * g, dcell * cell, dh * tc, dcell * i], axis=-1)
            dz[..., : 3 * h] *= 0.25 * _slope(0.5 * z[..., : 3 * h])
            dz[..., 3 * h :] *= _slope(z[..., 3 * h :])
            dzs[:, k] = dz
            dwh += np.swapaxes(hid, 1, 2) @ dz
            dh = dz @ back
            dc = dcell * f
        held = (both.swapaxes(1, 2).reshape(2, 1, n * t) == np.arange(len(self.wx[0]))[:, None]).astype(np.float32)
        dwx = held @ dzs.reshape(2, n * t, 4 * h)
        return loss, [dwx, dwh, dwo, dbo, dtr.astype(np.float32), dfirst.astype(np.float32)]


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def crf_loss(s: np.ndarray, tags: np.ndarray, tr: np.ndarray, first: np.ndarray):
    """Mean loss over windows, and gradients of the scores, the transitions and the first tag."""
    n, t, k = s.shape
    alpha, beta = np.empty_like(s), np.zeros_like(s)
    alpha[:, 0] = first + s[:, 0]
    for j in range(1, t):
        alpha[:, j] = _lse(alpha[:, j - 1, :, None] + tr, 1) + s[:, j]
    for j in range(t - 2, -1, -1):
        beta[:, j] = _lse(tr + (s[:, j + 1] + beta[:, j + 1])[:, None, :], 2)
    z = _lse(alpha[:, -1], 1)
    ds = np.exp(alpha + beta - z[:, None, None])
    dfirst = ds[:, 0].sum(axis=0)
    dtr = np.zeros_like(tr)
    for j in range(t - 1):
        pair = alpha[:, j, :, None] + tr + (s[:, j + 1] + beta[:, j + 1])[:, None, :]
        dtr += np.exp(pair - z[:, None, None]).sum(axis=0)
    rows = np.arange(n)[:, None]
    gold = s[rows, np.arange(t)[None, :], tags].sum(axis=1) + first[tags[:, 0]] + tr[tags[:, :-1], tags[:, 1:]].sum(axis=1)
    ds[rows, np.arange(t)[None, :], tags] -= 1
    np.add.at(dtr, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), -1)
    np.add.at(dfirst, tags[:, 0], -1)
    return float((z - gold).mean()), ds / n, dtr / n, dfirst / n


def _window_scores(net: Tagger, c: np.ndarray, size: np.ndarray, block: int = 8) -> np.ndarray:
    """Tag scores (2, windows, places, tags) of both directions, without the bias, as ``net.run`` gives them.

    ``c`` holds classes (windows, places) and ``size`` the windows' lengths, longest first. The second
    direction runs from a window's own end, so neither reads padding. A window's places are the first
    ones of the first direction and the last ones of the second; the others are undefined. Each gate
    has an array of its own, windows that have ended leave the arrays now and then, and the halves in
    the gates are taken once for a cell and a state.
    """
    n, t = c.shape
    h = net.wh.shape[1]
    half = np.array([0.5, 0.5, 0.5, 1], np.float32)[:, None, None, None]
    gates = lambda w: w.astype(np.float32).reshape(2, -1, 4, h).transpose(2, 0, 1, 3) * half
    wx, wh = gates(net.wx).reshape(-1, h), np.ascontiguousarray(gates(net.wh) * 0.5)  # gate, direction, from, to
    wo = (net.wo * 0.5).astype(np.float32)
    back = np.maximum(size[:, None] - 1 - np.arange(t), 0)
    codes = np.stack([c.T, np.take_along_axis(c, back, 1).T], 1)  # those of one step together
    table = (np.arange(8) * net.wx.shape[1]).reshape(4, 2, 1)
    ends = np.searchsorted(-size, -np.arange(t))  # windows that have a place k
    hid, cell = (np.zeros((2, n, h), np.float32) for _ in range(2))
    scores = np.empty((2, n, t, TAGS), np.float32)
    live = 0
    for k in range(t):
        if k % block == 0:
            if live == 0 or ends[k] < live - live // 16:
                live = int(ends[k])
                hid, cell = hid[:, :live].copy(), cell[:, :live].copy()
                room, held = np.empty_like(hid), np.empty((block, 2, live, TAGS), np.float32)
                z, wide = (np.empty((4, 2, live, h), np.float32) for _ in range(2))
            rows = codes[k : k + block, None, :, :live] + table
        np.matmul(hid, wh, out=z)
        np.take(wx, rows[k % block], axis=0, out=wide, mode="clip")
        z += wide
        _act_into(z, wide, z)
        z[:3] += 1
        i, f, o, g = z
        cell *= f
        i *= g
        cell += i
        cell *= 0.5
        _act_into(cell, room, hid)
        hid *= o  # twice the state
        np.matmul(hid, wo, out=held[k % block])
        if k % block == block - 1 or k == t - 1:
            first = k - k % block
            steps = held[: k + 1 - first].transpose(1, 2, 0, 3)
            scores[0, :live, first : k + 1] = steps[0]
            scores[1, :live, t - 1 - k : t - first] = steps[1, :, ::-1]
    return scores


def _alive(s: np.ndarray, tr: np.ndarray) -> np.ndarray:
    """The places that a span of the best path may cover.

    A span in place of tags outside gains, for its beginning and for each inside place, the difference of
    the scores and of the best transition into that tag, and at its end the best difference of the
    transitions out of it. Where the best span of a kind through a place, found by running sums and
    extremes, gains nothing for any kind, the best path is outside there.
    """
    after = [0, *range(1, TAGS, 2)]  # what may follow a span
    gain = s.T.astype(np.float64, order="C")
    gain[1:] -= gain[0]
    alive = np.zeros(len(s), bool)
    for b in range(1, TAGS, 2):
        start, total = gain[b], gain[b + 1]
        start += float((tr[:, b] - tr[:, 0]).max())
        total += float(tr[b : b + 2, b + 1].max() - tr[0, 0])
        np.cumsum(total, out=total)
        start -= total
        best = np.maximum.accumulate(start, out=start)  # of the beginnings up to a place
        best += np.maximum.accumulate(total[::-1])[::-1]  # and of the ends from it on
        alive |= best > -float((tr[b : b + 2, after] - tr[0, after]).max()) - 1e-6
    return alive


def _best_tags(s: np.ndarray, size: np.ndarray, tr: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Best tags (rows, places) of padded scores (places, tags, rows), given scores of the tags before and
    after each row (tags, rows). Only sums are kept on the way; the way back finds where they came from."""
    wide, _, rows = s.shape
    sums = np.empty_like(s)
    sums[0] = before + s[0]
    into = np.ascontiguousarray(tr.T)[:, :, None]
    room = np.empty((TAGS, TAGS, rows), s.dtype)
    for j in range(1, wide):
        np.add(into, sums[j - 1], out=room)
        np.maximum.reduce(room, axis=1, out=sums[j])
        sums[j] += s[j]
    row = np.arange(rows)
    tag = (sums[size - 1, :, row].T + after).argmax(axis=0)
    tags = np.zeros((rows, wide), np.int8)
    for j in range(wide - 1, -1, -1):
        on = j < size
        tags[on, j] = tag[on]
        if j:
            tag = np.where(on, (sums[j - 1] + into[tag, :, 0].T).argmax(axis=0), tag)
    return tags


def _long_run(s: np.ndarray, tr: np.ndarray, chunk: int = 1024) -> np.ndarray:
    """Best tags of one long run between places outside: scores from each tag to each tag over a chunk,
    for all chunks at once; the best tags at the chunks' ends; then the tags inside all chunks at once."""
    n = -(-len(s) // chunk)
    size = np.full(n, chunk)
    size[-1] = len(s) - (n - 1) * chunk
    padded = np.zeros((n, chunk, TAGS), np.float32)
    padded.reshape(n * chunk, TAGS)[: len(s)] = s
    whole = np.ascontiguousarray((np.broadcast_to(tr, (n, TAGS, TAGS)) + padded[:, :1]).transpose(2, 1, 0))  # to, from, chunk
    into = np.ascontiguousarray(tr.T)
    for j in range(1, chunk):
        step = np.stack([(into[k][:, None, None] + whole).max(axis=0) for k in range(TAGS)]) + padded[:, j].T[:, None]
        if j >= size[-1]:
            step[..., -1] = whole[..., -1]
        whole = step
    best, came = np.where(np.arange(TAGS) == 0, 0.0, -np.inf), []
    for m in whole.transpose(2, 1, 0):
        step = best[:, None] + m
        came.append(step.argmax(axis=0))
        best = step.max(axis=0)
    end = int((best + tr[:, 0]).argmax())
    ends = [end]
    for c in reversed(came):
        ends.append(int(c[ends[-1]]))
    ends = np.array(ends[::-1])  # before the first chunk, then at the end of each
    after = np.where(np.arange(TAGS)[:, None] == ends[1:], 0.0, -np.inf)
    return _best_tags(np.ascontiguousarray(padded.transpose(1, 2, 0)), size, tr, tr[ends[:-1]].T, after).reshape(-1)[: len(s)]


def viterbi(s: np.ndarray, open_: np.ndarray, tr: np.ndarray, cells: int = 1 << 17, long: int = 4096) -> np.ndarray:
    """Best tags of a row of scores whose places that are not ``open_`` are outside."""
    tags = np.zeros(len(s), np.int8)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], open_, [False]]).astype(np.int8)))
    lo, hi = edge[::2], edge[1::2]
    length = hi - lo
    order = np.argsort(length, kind="stable")
    order, far = order[length[order] <= long], order[length[order] > long]
    for k in far:
        tags[lo[k] : hi[k]] = _long_run(s[lo[k] : hi[k]], tr)
    step = np.ceil(np.log2(np.maximum(length[order], 4)))  # rows of nearly equal length together
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(step)) + 1, [len(order)]])
    parts = [
        order[at : min(at + max(1, cells >> int(step[first])), last)]
        for first, last in zip(cuts[:-1], cuts[1:], strict=True)
        if last > first
        for at in range(first, last, max(1, cells >> int(step[first])))
    ]
    for part in parts:
        size = hi[part] - lo[part]
        place = lo[part][:, None] + np.arange(int(size.max()))
        inside = place < hi[part][:, None]
        held = np.ascontiguousarray(s[np.where(inside, place, 0)].transpose(1, 2, 0))
        found = _best_tags(held, size, tr, tr[0][:, None], tr[:, :1])
        tags[place[inside]] = found[inside]
    return tags


_RAMP = (np.arange(1, WINDOW - STRIDE + 1) / (WINDOW - STRIDE + 1)).astype(np.float32)[:, None]


def _laid(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the texts, one text after the other with a pad after each, and where each text starts."""
    start = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)])
    c = np.zeros(start[-1] + WINDOW, np.int8)
    for t, lo in zip(texts, start, strict=False):
        c[lo : lo + len(t)] = classes_of(t)
    return c, start


def tag_scores(texts: list[str], net: Tagger, batch: int = 640) -> tuple[np.ndarray, np.ndarray]:
    """Tag scores (places, tags) of the texts, one text after the other, and where each text starts."""
    c, start = _laid(texts)
    return _laid_scores(c, start, net, batch), start


def _laid_scores(c: np.ndarray, start: np.ndarray, net: Tagger, batch: int = 640) -> np.ndarray:
    """Tag scores (places, tags) of texts as ``_laid`` gives them.

    Where two windows overlap, the weight of one falls as that of the next one grows. A pad after each
    text gets the scores of a place outside.
    """
    length = np.diff(start) - 1
    count = np.where(length > 0, np.maximum(1, -(-(length - (WINDOW - STRIDE)) // STRIDE)), 0)
    owner = np.repeat(np.arange(len(length)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    at = start[owner] + nth * STRIDE
    size = np.minimum(WINDOW, length[owner] - nth * STRIDE)
    after = nth < count[owner] - 1  # another window follows
    sums = np.zeros((start[-1], TAGS), np.float32)
    order = np.argsort(-size, kind="stable")
    for part in np.array_split(order, -(-len(order) // batch)) if len(order) else ():
        wide = int(size[part[0]])
        scores = _window_scores(net, c[at[part][:, None] + np.arange(wide)], size[part])
        for ahead, behind, lo, n, k, more in zip(*scores, at[part], size[part], nth[part], after[part], strict=True):
            both = ahead[:n]
            both += behind[wide - n :]
            if k:
                both[: len(_RAMP)] *= _RAMP[:n]
            if more:
                both[STRIDE:] *= _RAMP[::-1]
            sums[lo : lo + n] += both
    sums += net.bo.astype(np.float32)
    sums[start[1:] - 1] = np.where(np.arange(TAGS) == 0, 0, -1e4)
    return sums


_FIRST_LETTER = 6 + len(_SIGNS)


def _marks(texts: list[str], c: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the digits, and of the signs for "at" that ``_settled`` may take: each @, and each "at"
    after an opening bracket or before a host with a dot or a hyphen."""
    is_, other = lambda x, k: (k == _CLASS[ord(x)]) | (k == _CLASS[ord(x.upper())]), lambda k: (k < _FIRST_LETTER) & (k != 1)
    sign = np.flatnonzero(is_("a", c[1:-2]) & is_("t", c[2:-1]) & other(c[:-3]) & other(c[3:])) + 1
    keep = []
    for at, k in zip(sign.tolist(), (np.searchsorted(start, sign, side="right") - 1).tolist(), strict=True):
        text, place = texts[k], at - int(start[k])
        before = place - 1
        while before >= 0 and text[before].isspace():
            before -= 1
        host = _HOST.match(text, place + 3)
        keep.append((before >= 0 and text[before] in "[({<") or (host is not None and not host.group().isalnum()))
    return np.flatnonzero(c == 1), np.union1d(np.flatnonzero(c == _CLASS[ord("@")]), sign[np.array(keep, bool)])


def _held(c: np.ndarray, lo: np.ndarray, hi: np.ndarray, marks: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which stretches (lo, hi) may hold a span that ``_settled`` keeps: those with a sign for "at", or with
    four digits once they reach over the words that they cut."""
    digit, sign = marks
    apart = np.flatnonzero((c < _FIRST_LETTER) & ((c >= 6) | (c % 2 == 0)))  # pads, white space and signs of ASCII
    before = np.searchsorted(apart, lo) - 1
    left = np.where(before >= 0, apart[before] + 1, 0)
    right = apart[np.searchsorted(apart, hi)]  # a pad follows the last text
    inside = lambda places, a, e: np.searchsorted(places, e) - np.searchsorted(places, a)
    return (inside(sign, lo, hi + 1) > 0) | (inside(digit, left, right) >= 4)


def _to_decode(texts: list[str], c: np.ndarray, start: np.ndarray, s: np.ndarray, tr: np.ndarray) -> np.ndarray:
    """The places of ``_alive`` whose run may hold a span that ``_settled`` keeps. Runs are decoded apart,
    so leaving one out changes no span of another."""
    marks = _marks(texts, c, start)
    out = np.zeros(len(s), bool)
    for k in np.flatnonzero((start[1:] > start[:-1] + 1) & _held(c, start[:-1], start[1:] - 1, marks)):
        text = slice(start[k], start[k + 1] - 1)
        out[text] = _alive(s[text], tr)
    edge = np.flatnonzero(np.diff(out.astype(np.int8), prepend=0, append=0))
    lo, hi = edge[::2], edge[1::2]
    for a, e in np.stack([lo, hi], 1)[~_held(c, lo, hi, marks)].tolist():
        out[a:e] = False
    return out


def network_spans(texts: list[str], net: Tagger) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) that the network finds in each text, whole words, passing the checks."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    c, start = _laid(texts)
    s = _laid_scores(c, start, net)
    s[:, 1:3] += LEAN
    tags = viterbi(s, _to_decode(texts, c, start, s, net.tr), net.tr)
    inside = np.flatnonzero(tags)
    begin = inside[tags[inside] % 2 == 1]
    after = tags[inside + 1]  # a pad follows the last text
    stop = inside[(after % 2 == 1) | (after == 0)] + 1
    owner = np.searchsorted(start, begin, side="right") - 1
    for a, e, k in zip(begin.tolist(), stop.tolist(), owner.tolist(), strict=True):
        low, kind = int(start[k]), (int(tags[a]) - 1) // 2
        span = _settled(texts[k], kind, a - low, e - low)
        if span and span[0] >= (out[k][-1][2] if out[k] else 0):
            out[k].append((span[0], kind, span[1]))
    return out


def find(texts: list[str], net: Tagger | None) -> list[tuple[list, list]]:
    """(base, all) spans of each text; the network's spans that touch no base span are added."""
    base = [base_spans(t) for t in texts]
    more = network_spans(texts, net) if net is not None else [[] for _ in texts]
    out = []
    for b, m in zip(base, more, strict=True):
        k, extra, reach = 0, [], 0
        for s in m:  # both are in order of start
            while k < len(b) and b[k][0] < s[2]:
                reach = max(reach, b[k][2])
                k += 1
            if reach <= s[0]:
                extra.append(s)
        out.append((b, sorted(b + extra)))
    return out


# --- training ------------------------------------------------------------------------------------

TRAIN_WINDOW = 72


def _made(rng: np.random.Generator) -> tuple[str, int]:
    """A piece of text and its kind, -1 for a look-alike that is no personal data."""
    d = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    letters = list("abcdefghijklmnopqrstuvwxyz" + "aeiounrst" * 2)
    w = lambda lo=3, hi=9: "".join(rng.choice(letters, rng.integers(lo, hi)))
    ends = lambda: rng.choice(["com", "org", "net", "de", "co.uk", "info"])
    host = f"{w()}{rng.choice(['', '-' + w(), '.' + w()])}.{ends()}"
    sep = lambda: str(rng.choice(["{}", " {} ", " {}", "{} "])).format(
        str(rng.choice(["({})", "[{}]", "{{{}}}", "<{}>", "( {} )", "[ {} ]"])).format(rng.choice(["at", "AT", "At"]))
    )
    digits = d(15)
    check = next(c for c in "0123456789" if luhn(digits + c))
    card = digits + check
    hexa = "".join(rng.choice(list("0123456789abcdef"), rng.integers(16, 40)))
    forms = [
        (lambda: f"{w()}.{d(2)}@{host}", 0),
        (lambda: f"{w()}{sep()}{host}", 0),
        (lambda: f"{w()}{rng.choice(['.', '_', '-'])}{w()}{sep()}{host}", 0),
        (lambda: f"{w()}{d(2)}{sep()}{w()}{rng.choice([' dot ', ' DOT ', '[dot]', ' (dot) '])}{ends()}", 0),
        (lambda: f"{w()} at {w()} dot {ends()}", 0),
        (lambda: f"{w()} at the {w()}, {w()}", -1),
        (lambda: f"{w()} {rng.choice(['(', '[', '{'])}{w(2, 5)}{rng.choice([')', ']', '}'])} {w()}", -1),
        (lambda: f"{w()}_{w()}@{w()}", 0),
        (lambda: ".".join(str(x) for x in rng.integers(1, 256, 4)), 1),
        (lambda: " . ".join(str(x) for x in rng.integers(1, 256, 4)), 1),
        (lambda: card, 2),
        (lambda: " ".join(card[k : k + 4] for k in range(0, 16, 4)), 2),
        (lambda: ".".join(card[k : k + 4] for k in range(0, 16, 4)), 2),
        (lambda: f"+{rng.integers(1, 99)} ({d(3)}) {d(3)}-{d(4)}", 3),
        (lambda: f"({d(3)}) {d(3)}-{d(4)}", 3),
        (lambda: f"{d(3)}-{d(3)}-{d(4)}", 3),
        (lambda: f"00{rng.integers(1, 99)} {d(2)} {d(7)}", 3),
        (lambda: f'token = "{hexa}"', -1),
        (lambda: f"password={hexa}", -1),
        (lambda: f"Version {rng.integers(1, 9)}.{rng.integers(0, 9)}.", -1),
        (lambda: f"v{rng.integers(1, 9)}.{rng.integers(0, 20)}.{rng.integers(0, 20)}", -1),
        (lambda: str(rng.integers(1900, 2030)), -1),
        (lambda: f"{d(2)},{d(3)}.{d(2)} $", -1),
        (lambda: f"{d(2)}/{d(2)}/20{d(2)}", -1),
        (lambda: f"{rng.integers(1, 60)} {w()}", -1),
        (lambda: f"#{d(6)}", -1),
        (lambda: f"@{w()}", -1),
        (lambda: f"20{d(2)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}", -1),
    ]
    spelled = (1, 2, 3, 4, 5)  # the forms that vary most are drawn more often
    make, kind = forms[rng.choice(spelled) if rng.random() < 0.4 else rng.integers(0, len(forms))]
    return make(), kind


def training_windows(texts: list[str], size: int = 1200, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Windows of character classes and their tags: pieces written into passages, and found ones."""
    rng = np.random.default_rng(seed)
    clean = [t for t in texts if len(t) >= 80 and not _CLEAN.search(t)] or ["lorem ipsum dolor sit amet " * 8]
    rows: list[tuple[str, list[tuple[int, int, int]]]] = []
    for t in texts:
        for start, kind, end in base_spans(t)[:4]:
            lo = max(0, start - int(rng.integers(0, TRAIN_WINDOW // 2)))
            cut = t[lo : lo + TRAIN_WINDOW]
            spans = [s for s in base_spans(cut) if _passes(s[1], cut[s[0] : s[2]])]
            if (start - lo, kind, end - lo) in spans and len({s[0] for s in spans}) == len(spans):
                rows.append((cut, spans))
    rows = rows[: size // 4]
    while len(rows) < size:
        base = clean[rng.integers(0, len(clean))]
        lo = int(rng.integers(0, max(1, len(base) - TRAIN_WINDOW)))
        text, spans = base[lo : lo + TRAIN_WINDOW], []
        for _ in range(int(rng.integers(0, 3))):
            piece, kind = _made(rng)
            gaps = [k for k in range(len(text)) if text[k] == " " and not any(a - 2 <= k <= b + 1 for a, _, b in spans)]
            if not gaps:
                break
            at = gaps[rng.integers(0, len(gaps))] + 1
            tail = rng.choice([" ", ", ", ". ", "; "])
            text = text[:at] + piece + tail + text[at:]
            moved = len(piece) + len(tail)
            spans = [(a + moved, k, b + moved) if a >= at else (a, k, b) for a, k, b in spans]
            if kind >= 0:
                spans.append((at, kind, at + len(piece)))
        shift = int(rng.integers(0, max(1, len(text) - TRAIN_WINDOW + 1)))
        text, spans = text[shift : shift + TRAIN_WINDOW], [(a - shift, k, b - shift) for a, k, b in spans]
        rows.append((text, [(a, k, b) for a, k, b in spans if a >= 0 and b <= TRAIN_WINDOW]) if all(
            b <= 0 or a >= TRAIN_WINDOW or (a >= 0 and b <= TRAIN_WINDOW) for a, _, b in spans) else (text, _clip(spans)))
    x, y = np.zeros((len(rows), TRAIN_WINDOW), np.int64), np.zeros((len(rows), TRAIN_WINDOW), np.int64)
    for r, (text, spans) in enumerate(rows):
        c = classes_of(text[:TRAIN_WINDOW])
        x[r, : len(c)] = c
        for a, kind, b in spans:
            y[r, a:b] = 2 + 2 * kind
            y[r, a] = 1 + 2 * kind
    return x, y


def _clip(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    return [(max(a, 0), k, min(b, TRAIN_WINDOW)) for a, k, b in spans if b > 0 and a < TRAIN_WINDOW]


def fit(texts: list[str], hidden: int = 10, epochs: int = 10, size: int = 4000, batch: int = 128, seed: int = 7) -> Tagger:
    """Train on spans of and in the given texts, by Adam."""
    x, y = training_windows(texts, size, seed)
    rng = np.random.default_rng(seed)
    r = lambda *s: (rng.standard_normal(s) * 0.2).astype(np.float32)
    net = Tagger(r(2, CLASSES, 4 * hidden), r(2, hidden, 4 * hidden), r(2, hidden, TAGS), r(TAGS), r(TAGS, TAGS), r(TAGS))
    for first in (CLASSES - 52, CLASSES - 26):  # letters start alike
        net.wx[:, first : first + 26] = net.wx[:, first : first + 1] + 0.2 * net.wx[:, first : first + 26]
    net.wx[:, :, hidden : 2 * hidden] += 1.0  # forget gates start open
    p = [net.wx, net.wh, net.wo, net.bo, net.tr, net.first]
    m, v, step = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
    total = epochs * -(-len(x) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), batch):
            k = order[lo : lo + batch]
            _, grads = net.gradients(x[k], y[k])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            clip = min(1.0, 5.0 / max(norm, 1e-9))
            step += 1
            rate = 0.03 * (1 - step / (total + 1)) + 0.0005
            for q, g, a, b in zip(p, grads, m, v, strict=True):
                g = g * clip
                a += 0.1 * (g - a)
                b += 0.005 * (g * g - b)
                q -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.995**step)) + 1e-8)
    for kind in range(len(KINDS)):  # an inside tag follows its own kind only
        for tag in range(TAGS):
            if tag not in (1 + 2 * kind, 2 + 2 * kind):
                net.tr[tag, 2 + 2 * kind] = -1e4
        net.first[2 + 2 * kind] = -1e4
    return net


def train(docs: DataFrame, sample: int = 600, id_col: str = "doc_id", text_col: str = "text") -> Tagger:
    """Fit on passages of at most ``sample`` documents, the first in the order of a hash of id and text;
    half of them are documents with base spans. One count and one read: only rows under a hash limit
    (about twice the sample, whatever the number of documents) are grouped by that hash, so that repeated
    rows count once, and an ordered limit sends the first of them to the driver."""
    src = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"))
    src = src.where(F.col("t").isNotNull()).withColumn("m", F.col("t").contains("@") | F.col("t").rlike("[0-9][0-9]"))
    src = src.withColumn("h", F.pmod(F.xxhash64("i", "t"), F.lit(1 << 40)))
    n = {r["m"]: r["n"] for r in src.groupBy("m").agg(F.count(F.lit(1)).alias("n")).collect()}
    half = sample // 2
    limit = {m: int(min(1.0, (2.0 * half + 40) / n.get(m, 1)) * (1 << 40)) for m in (True, False)}
    drawn = src.where(F.col("h") <= max(limit.values()))  # first, as it needs no search of the text
    drawn = drawn.where(F.col("h") <= F.when(F.col("m"), F.lit(limit[True])).otherwise(F.lit(limit[False])))
    rows = drawn.groupBy("m", "h").agg(F.min("t").alias("t")).orderBy("h").limit(8 * half + 400).collect()
    texts = []
    for which in (True, False):
        texts += [r["t"] for r in rows if r["m"] == which][:half]
    return fit(texts)


def _parts(texts: list[str], most: int = 1 << 18) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of at most ``most`` characters in all, or one longer text, with the place of the first."""
    lo, size = 0, 0
    for k, t in enumerate(texts):
        if k > lo and size + len(t) > most:
            yield lo, texts[lo:k]
            lo, size = k, 0
        size += len(t) + 1
    if lo < len(texts):
        yield lo, texts[lo:]


def spans_of(docs: DataFrame, net: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): arrays of (kind, start, end, text) for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few thousand numbers
    item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, part in _parts(texts_of(b)):
                found = find(part, shared.value)
                cols = [
                    pa.array([[(KINDS[k], a, e, t[a:e]) for a, k, e in f[w]] for t, f in zip(part, found, strict=True)], item)
                    for w in (0, 1)
                ]
                yield pa.RecordBatch.from_arrays([b.column("id").slice(lo, len(part)), *cols], ["id", "base", "spans"])

    kind = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(work, f"id long, base {kind}, spans {kind}")


def masked(docs: DataFrame, net: Tagger | None, text_col: str = "text") -> DataFrame:
    """``docs`` with each span in the text replaced by its kind in angle brackets, like <email>."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(text_col)
            texts = b.column(at).to_pylist()
            out = list(texts)
            for lo, part in _parts([t or "" for t in texts]):
                for k, (_, spans) in enumerate(find(part, shared.value)):
                    if spans:
                        out[lo + k] = mask(part[k], spans)
            cols = list(b.columns)
            cols[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return docs.mapInArrow(work, ", ".join(fields))


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Overlapping spans are one mask, of the kind that starts first."""
    out, at = [], 0
    reach = 0
    for start, kind, end in spans:
        if start >= reach:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        reach = max(reach, end)
        at = reach
    return "".join(out) + text[at:]


def _joined(spans: str):
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_<kind> counts the base spans of the kind; ``spans`` holds base and added ones."""
    docs = table(spark, sf_dir, "documents")
    found = spans_of(docs, train(docs))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        F.col("id").alias("doc_id"),
        *[count(k) for k in KINDS],
        F.sha2(_joined("base"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )

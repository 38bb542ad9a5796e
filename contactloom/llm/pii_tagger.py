"""A character-level bidirectional LSTM with CRF transitions, in numpy.

It is trained here, on generated text with labelled spans, from a fixed seed.
Its cells use x / (1 + |x|) in place of the hyperbolic tangent (and half of it,
shifted, in place of the logistic function), which numpy takes four times
faster, as every character of every text passes through them.  Nothing in this
module knows Spark.
"""

from __future__ import annotations

from functools import cache
from itertools import groupby

import numpy as np

KINDS = ("email", "ip", "card", "phone", "secret")
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
EMBED, HIDDEN = 12, 8
#: Characters of a training window.
TRAINED = 96
#: Characters of a window of a text, and what two of them share.
WINDOW, SHARED = 512, 64
#: Windows that pass the network at a time, and the steps of their lengths.
BATCH, PADDED = 1024, 128
CHARS = 98
#: White space that is put around a text.
MARGIN = 8
#: Bound of a transition's score.
MOST_TRANSITION = 1.0
#: Log odds from which a span stays, and for each of its characters, by kind: an address's form is tested besides.
LEAST_ODDS = (0.0, 5.0, 5.0, 5.0, 5.0)
EACH_ODDS = (0.0, 0.5, 0.5, 0.5, 0.5)


def encode(text: str) -> np.ndarray:
    """Printable ASCII by itself, line ends, other letters, everything else."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    out = np.where((codes >= 32) & (codes < 127), codes - 31, 97)
    out[codes == 10] = 96
    letters = (codes >= 0xC0) & (codes < 0x2000)
    out[letters] = ord("a") - 31  # accented letters are letters
    return out


# ---------------------------------------------------------------- training text
# some words, so that not only invented ones stand around what is labelled
COMMON = "a about all auf d dann das de del dem den der des die e ein el em en es est et fr il io ist it l la le les los mit na net ni non o per por que se si sie so su te un una und une van von y zu also and any are as at be but by call can card code contact dot file first for from group has have he her home i if in is it its line list look mail meet more my name new no not number of on one or order our out page point see she so support than that the their there they this time to two under up use was we were what when which who will with work write you your".split()
SYLLABLES = "aux ay an ar be bo ch ci da de do dra el en er es eu eux ex fa fi ga ge gi ha he ich il in ing io ion ix ja ke kin ka la le li lo lu ma me mi mo na ne ni no ó on or ou pa per pre qua que qui ra re ri ro sa sch se si so st ta te th ti tion to tra tu u un ü va ve vi we wh y za ze".split()
MARKS = "!#$%&*.,;:?|-_=~/<>()[]'\""


def _word(rng: np.random.Generator) -> str:
    among = rng.integers(0, 4)
    if among == 0:
        w = COMMON[rng.integers(0, len(COMMON))]
    elif among == 1:
        w = _letters(rng, int(rng.integers(1, 12)), "abcdefghijklmnopqrstuvwxyzéèñüçß")
    else:
        w = "".join(SYLLABLES[k] for k in rng.integers(0, len(SYLLABLES), int(rng.integers(1, 5))))
    style = rng.integers(0, 8)
    return w.capitalize() if style == 0 else w.upper() if style == 1 else w


def _digits(rng: np.random.Generator, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def _letters(rng: np.random.Generator, n: int, among: str) -> str:
    return "".join(among[k] for k in rng.integers(0, len(among), n))


HEX, MIXED = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
ENDINGS = ("com", "org", "net", "de", "fr", "es", "it", "edu", "io", "co.uk", "info", "example.com", "example.org")
SECRET_NAMES = ("token", "api_key", "apikey", "api-key", "secret", "secret_key", "client_secret", "access_token", "auth_token", "password", "passwd", "private_key", "key", "bearer")


def _private(rng: np.random.Generator, kind: str) -> tuple[str, str, str]:
    """What stands before a span, the span, and what stands after it."""
    pick = lambda among: among[rng.integers(0, len(among))]
    plain = lambda: _word(rng).lower().encode("ascii", "ignore").decode() or "jo"
    if kind == "email":
        parts = [plain() for _ in range(int(rng.integers(1, 3)))]
        host, end = [plain() + _digits(rng, int(rng.integers(0, 3)))], str(pick(ENDINGS)).split(".")
        if rng.integers(0, 3) == 0:
            local = str(pick([".", "_", "", "-", "+"])).join(parts) + _digits(rng, int(rng.integers(0, 4)))
            return "", f"{local}@{'.'.join(host + end)}", ""
        at, dot = pick([(" at ", " dot "), (" AT ", " DOT "), ("{at}", "{dot}"), (" AT ", " DOT "), (" {at} ", "."), (" [at] ", " [dot] "), ("[at]", "[dot]"), ("(at)", "(dot)"), (" (at) ", " (dot) "), (" @ ", " . "), ("(at)", "."), (" [at] ", "."), (" at ", " dot ")])
        return "", dot.join(parts) + at + dot.join(host + end), ""
    if kind == "ip":
        if rng.integers(0, 4):
            return "", ".".join(str(x) for x in rng.integers(0, 256, 4)), pick(["", "", "", ":8080", "/24"])
        groups = [_letters(rng, int(rng.integers(1, 5)), HEX) for _ in range(8)]
        cut = int(rng.integers(1, 5))
        return "", pick([":".join(groups), ":".join(groups[:cut]) + "::" + ":".join(groups[cut + 2 : cut + 4])]), ""
    if kind == "card":
        d = _digits(rng, int(rng.integers(14, 20)) if rng.integers(0, 3) == 0 else 16)
        return "", d if rng.integers(0, 3) else str(pick([" ", "-"])).join(d[k : k + 4] for k in range(0, len(d), 4)), ""
    if kind == "phone":
        n = lambda k: _digits(rng, k)
        body = pick([f"({n(3)}) {n(3)}-{n(4)}", f"{n(3)}-{n(3)}-{n(4)}", f"{n(3)} {n(3)} {n(4)}", f"{n(3)}.{n(3)}.{n(4)}"])
        whole = f"+{rng.integers(1, 99)} {body}" if rng.integers(0, 3) else pick([body, f"0{n(3)} {n(6)}", f"0{n(2)} {n(2)} {n(2)} {n(2)} {n(2)}"[:14]])
        return "", whole + pick(["", "", "", f" ext. {n(2)}", f" x{n(3)}"]), ""
    name = pick(SECRET_NAMES)
    name = pick([name, name.upper(), name.capitalize()])
    quote = pick(['"', '"', "'", ""])
    if rng.integers(0, 8) == 0:
        # a signed token: three parts of letters and digits
        return pick(["Bearer ", f"{name} = {quote}", f"{name}: {quote}"]), "eyJ" + ".".join(_letters(rng, int(rng.integers(12, 40)), MIXED + "_-") for _ in range(3)), quote
    value = pick([_letters(rng, int(pick([32, 40, 40, 40, 64, 101, 128])), HEX), _letters(rng, int(rng.integers(16, 48)), MIXED), pick(["sk_live_", "ghp_", "AKIA", "xoxb-"]) + _letters(rng, int(rng.integers(16, 36)), MIXED)])
    if value[-1] in HEX and rng.integers(0, 8) == 0:
        value = value.upper()
    return f"{name}{pick([' = ', '=', ': ', ':', ' is '])}{quote}", value, quote


def _public(rng: np.random.Generator) -> str:
    """What looks a little like the above and is nobody's."""
    pick = lambda among: among[rng.integers(0, len(among))]
    number = lambda a, b: int(rng.integers(a, b))
    return str(
        pick(
            [
                lambda: f"{pick(['Version', 'version', 'v', 'release'])} {number(0, 20)}.{number(0, 10)}",
                lambda: f"{number(0, 20)}.{number(0, 10)}.{number(0, 10)}",
                lambda: number(1900, 2030),
                lambda: _digits(rng, number(1, 9)),
                lambda: f"{number(1, 13)}/{number(1, 29)}/{number(1990, 2030)}",
                lambda: f"{number(1990, 2030)}-{number(10, 13)}-{number(10, 29)}",
                lambda: f"{number(0, 24):02}:{number(0, 60):02}:{number(0, 60):02}",
                lambda: f"{pick('$€')}{number(1, 1000)}.{_digits(rng, 2)}",
                lambda: f"{number(1, 1000)},{_digits(rng, 3)},{_digits(rng, 3)}",
                lambda: f"@{_word(rng)}",
                lambda: f"CC BY-{pick(['NC', 'SA', 'ND'])} {number(1, 5)}.0.",
                lambda: f"{pick(['commit', 'revision', 'sha', 'digest'])} {_letters(rng, pick([7, 8, 40]), HEX)}",
                lambda: "#" + _letters(rng, 6, HEX),
                lambda: "-".join(_letters(rng, k, HEX) for k in (8, 4, 4, 4, 12)),
                lambda: f"ISBN 978-{number(0, 10)}-{_digits(rng, 2)}-{_digits(rng, 6)}-{number(0, 10)}",
                lambda: f"{pick(['class', 'lang', 'title', 'name', 'id'])}{pick([' = ', '='])}\"{_word(rng)} {_word(rng)}\"",
                lambda: f"{pick(['token', 'key', 'secret', 'password', 'card', 'call', 'mail'])} {_word(rng)} {_word(rng)}",
                lambda: f"{_word(rng)} at {pick(['noon', 'the', 'home', 'a', 'least', 'work', 'two', 'last'])} {_word(rng)}",
                lambda: f"{pick(['the', 'a', 'every', 'one'])} dot {pick(['on', 'in', 'com', 'at', 'and', 'of'])} {_word(rng)}",
                lambda: f"{number(2, 90)} at {number(2, 90)}",
                lambda: _digits(rng, number(22, 60)),
                lambda: f"{pick(['x', 'y', 'n'])} = {number(0, 100)}.{_digits(rng, number(1, 9))}",
                lambda: f"{pick(['RFC', 'ISO', 'No.', 'page', 'section'])} {number(1, 9000)}",
            ]
        )()
    )


def labelled_windows(rows: int, seed: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows of generated text: character codes, tags, the texts."""
    rng = np.random.default_rng(seed)
    xs, ys, texts = [], [], []
    for _ in range(rows):
        parts, tags = [], []
        dense, marks = int(rng.integers(0, 6)), "".join(MARKS[k] for k in rng.integers(0, len(MARKS), 2)) if rng.integers(0, 6) == 0 else ""
        upper = rng.integers(0, 12) == 0
        while len(tags) < TRAINED + 60:
            kind = int(rng.integers(0, 12 + 14 * dense))
            before, s, after = "", "", ""
            if kind < len(KINDS):
                before, s, after = _private(rng, KINDS[kind])
                mine = [1 + 2 * kind] + [2 + 2 * kind] * (len(s) - 1)
            else:
                s = _public(rng) if kind < 9 else _word(rng)
                if rng.integers(0, 15) == 0:
                    s = s if rng.integers(0, 3) else ["at", "dot", "to", "At"][rng.integers(0, 4)]
                    s = [" ", " ", ". ", ".\n", ", "][rng.integers(0, 5)].join([s] * int(rng.integers(2, 30)))
                mine = [0] * len(s)
            gap = marks + (" " if rng.integers(0, 6) else [". ", ". ", ", ", ", ", "\n", ": ", "; ", " - ", " | ", ".\n"][rng.integers(0, 10)])
            piece = before + s + after + gap
            raised = piece.upper() if upper else piece
            parts.append(raised if len(raised) == len(piece) else piece)
            tags += [0] * len(before) + mine + [0] * (len(after) + len(gap))
        text = "".join(parts)
        if rng.integers(0, 3) == 0:
            # the end of a text: a last piece, perhaps without its gap, and white space after it
            ends = np.cumsum([len(x) for x in parts])
            last = int(np.searchsorted(ends, TRAINED - MARGIN, side="right"))
            text = text[: ends[last - 1]].rstrip(" " if rng.integers(0, 2) else " .,;:|-\n") if last else ""
            tags = tags[: len(text)] + [0] * TRAINED
            text = text.ljust(TRAINED)
            at = 0
        else:
            at = int(rng.integers(0, 60))
        text = text[at : at + TRAINED]
        cut = np.array(tags[at : at + TRAINED])
        # what a window's edge cuts is a span of its own
        if cut[0] and cut[0] % 2 == 0:
            cut[0] -= 1
        texts.append(text)
        xs.append(encode(text))
        ys.append(cut)
    return np.array(xs), np.array(ys), texts


# ---------------------------------------------------------------- the network
def initial(seed: int = 0) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    scale = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    p = {"emb": 0.5 * rng.standard_normal((CHARS, EMBED)).astype(np.float32), "out": scale(2 * HIDDEN, TAGS), "bias": np.zeros(TAGS, np.float32), "trans": np.zeros((TAGS, TAGS), np.float32)}
    for way in "fb":
        p |= {f"wx{way}": scale(EMBED, 4 * HIDDEN), f"wh{way}": scale(HIDDEN, 4 * HIDDEN), f"b{way}": np.zeros(4 * HIDDEN, np.float32)}
        p[f"b{way}"][HIDDEN : 2 * HIDDEN] = 2
    return p


def _bend(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _slope(s: np.ndarray) -> np.ndarray:
    """The derivative of ``_bend`` where its value is s."""
    return (1 - np.abs(s)) ** 2


def _lstm(p: dict, way: str, x: np.ndarray) -> tuple[np.ndarray, list]:
    """x: (time, rows, EMBED), already in this direction's order; gates in the order i, f, o, g."""
    steps, rows, _ = x.shape
    h = c = np.zeros((rows, HIDDEN), x.dtype)
    out, trace = np.empty((steps, rows, HIDDEN), x.dtype), []
    pre = x @ p[f"wx{way}"] + p[f"b{way}"]
    for t in range(steps):
        s = _bend(pre[t] + h @ p[f"wh{way}"])
        i, f, o = (0.5 + 0.5 * s[:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(3))
        g = s[:, 3 * HIDDEN :]
        c2 = f * c + i * g
        bent = _bend(c2)
        trace.append((h, c, i, f, o, g, s, bent))
        h, c = o * bent, c2
        out[t] = h
    return out, trace


def _lstm_back(p: dict, way: str, x: np.ndarray, trace: list, dout: np.ndarray, grad: dict) -> np.ndarray:
    steps, rows, _ = x.shape
    dh = dc = np.zeros((rows, HIDDEN), x.dtype)
    dz = np.empty((steps, rows, 4 * HIDDEN), x.dtype)
    wh = p[f"wh{way}"]
    gwh = np.zeros_like(wh)
    for t in range(steps - 1, -1, -1):
        h, c, i, f, o, g, s, bent = trace[t]
        dh = dh + dout[t]
        dc = dc + dh * o * _slope(bent)
        dz[t] = np.concatenate([0.5 * dc * g, 0.5 * dc * c, 0.5 * dh * bent, dc * i], axis=1) * _slope(s)
        gwh += h.T @ dz[t]
        dh, dc = dz[t] @ wh.T, dc * f
    grad[f"wh{way}"] = gwh
    grad[f"wx{way}"] = np.tensordot(x, dz, axes=([0, 1], [0, 1]))
    grad[f"b{way}"] = dz.sum(axis=(0, 1))
    return dz @ p[f"wx{way}"].T


def emissions(p: dict, codes: np.ndarray) -> np.ndarray:
    """(rows, time) codes -> (rows, time, TAGS) scores.

    The first layer is a table by character.  Arrays lie as (unit, row), so
    that gates are contiguous, and everything is done in place.
    """
    rows, steps = codes.shape
    codes = np.ascontiguousarray(codes.T)
    out = np.empty((steps, rows, TAGS), np.float32)
    out[:] = p["bias"]
    s, size = np.empty((4 * HIDDEN, rows), np.float32), np.empty((4 * HIDDEN, rows), np.float32)
    i, f, o, g = (s[k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
    h, c, new = (np.empty((HIDDEN, rows), np.float32) for _ in range(3))
    for way, order, to in (("f", range(steps), p["out"][:HIDDEN]), ("b", range(steps - 1, -1, -1), p["out"][HIDDEN:])):
        table = np.ascontiguousarray((p["emb"] @ p[f"wx{way}"] + p[f"b{way}"]).T)
        wh = np.ascontiguousarray(p[f"wh{way}"].T)
        h[:] = c[:] = 0
        for t in order:
            np.matmul(wh, h, out=s)
            table.take(codes[t], axis=1, out=size, mode="clip")
            s += size
            np.abs(s, out=size)
            size += 1
            s /= size
            # a gate is half of one plus its bent sum
            np.multiply(f, c, out=new)
            c += new
            np.multiply(i, g, out=new)
            new += g
            c += new
            c *= 0.5
            np.abs(c, out=new)
            new += 1
            np.divide(c, new, out=new)
            np.multiply(o, new, out=h)
            h += new
            h *= 0.5
            out[t] += h.T @ to
    return out.transpose(1, 0, 2)


def loss_and_gradient(p: dict, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
    """Mean negative log likelihood of the tags, and its gradient."""
    rows, steps = codes.shape
    x = p["emb"][codes.T]
    f, tf = _lstm(p, "f", x)
    b, tb = _lstm(p, "b", x[::-1])
    hidden = np.concatenate([f, b[::-1]], axis=2)
    e = hidden @ p["out"] + p["bias"]  # time, rows, tags
    y, r = tags.T, np.arange(rows)
    # forward and backward sums, scaled to one at every step; before and after a text is outside
    move, most = np.exp(p["trans"]), e.max(axis=2, keepdims=True)
    weight = np.exp(e - most)
    alpha, beta, scale = np.empty_like(e), np.empty_like(e), np.empty((steps + 1, rows, 1), e.dtype)
    for t in range(steps):
        alpha[t] = weight[t] * (alpha[t - 1] @ move if t else move[0])
        scale[t] = alpha[t].sum(axis=1, keepdims=True)
        alpha[t] /= scale[t]
    scale[steps] = alpha[-1] @ move[:, :1]
    beta[-1] = move[:, 0] / scale[steps]
    for t in range(steps - 2, -1, -1):
        beta[t] = (weight[t + 1] * beta[t + 1] / scale[t + 1]) @ move.T
    z = np.log(scale).sum(axis=(0, 2)) + most.sum(axis=(0, 2))
    score = p["trans"][0][y[0]] + p["trans"][:, 0][y[-1]] + sum(e[t][r, y[t]] for t in range(steps)) + sum(p["trans"][y[t - 1], y[t]] for t in range(1, steps))
    de = alpha * beta
    np.add.at(de, (np.arange(steps)[:, None], r[None, :], y), -1)
    de /= rows
    pair = np.tensordot(alpha[:-1], weight[1:] * beta[1:] / scale[1:steps], axes=([0, 1], [0, 1])) * move
    np.add.at(pair, (y[:-1].ravel(), y[1:].ravel()), -1)
    pair[0] += de[0].sum(axis=0) * rows
    pair[:, 0] += de[-1].sum(axis=0) * rows
    grad = {"trans": (pair / rows).astype(p["trans"].dtype), "out": np.tensordot(hidden, de, axes=([0, 1], [0, 1])), "bias": de.sum(axis=(0, 1))}
    dh = de @ p["out"].T
    dx = _lstm_back(p, "f", x, tf, dh[:, :, :HIDDEN], grad)
    dx = dx + _lstm_back(p, "b", x[::-1], tb, dh[::-1, :, HIDDEN:], grad)[::-1]
    grad["emb"] = np.zeros_like(p["emb"])
    np.add.at(grad["emb"], codes.T, dx)
    return float((z - score).mean()), grad


@cache
def trained(steps: int = 500, batch: int = 128, seed: int = 11, windows: int = 7000) -> dict[str, np.ndarray]:
    """Weights after Adam on generated windows; the same on every machine up to rounding."""
    p = initial(seed)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v2 = {k: np.zeros_like(v) for k, v in p.items()}
    xs, ys, _ = labelled_windows(windows, seed)
    rng = np.random.default_rng(seed)
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(xs), batch)
        _, g = loss_and_gradient(p, xs[pick], ys[pick])
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for k in p:
            d = g[k] * min(1.0, 5.0 / (norm + 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * d
            v2[k] = 0.999 * v2[k] + 0.001 * d * d
            p[k] = (p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        # bounded transitions let most characters be settled without a search
        np.clip(p["trans"], -MOST_TRANSITION, MOST_TRANSITION, out=p["trans"])
    return p


def viterbi(p: dict, e: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """Best tags of padded rows (rows, time, TAGS), with outside before and after."""
    rows, steps, _ = e.shape
    best, back = e[:, 0] + p["trans"][0], np.zeros((steps, rows, TAGS), np.int8)
    for t in range(1, steps):
        s = best[:, :, None] + p["trans"]
        live = (t < lengths)[:, None]
        back[t] = np.where(live, s.argmax(axis=1), np.arange(TAGS))
        best = np.where(live, s.max(axis=1) + e[:, t], best)
    tag = (best + p["trans"][:, 0]).argmax(axis=1)
    path = np.empty((steps, rows), np.int64)
    for t in range(steps - 1, -1, -1):
        path[t] = tag
        tag = back[t][np.arange(rows), tag]
    return [path[:n, r] for r, n in enumerate(lengths.tolist())]


def surely_outside(p: dict, e: np.ndarray) -> np.ndarray:
    """Characters that the best path leaves outside.

    Tags other than outside on a stretch gain at most, at each character, their
    best lead and the best transition, and once an entry and an exit.  Where no
    stretch around a character can gain, the best path does not tag it.
    """
    t = p["trans"]
    lead = (e[:, 1:].max(axis=1) - e[:, 0]).astype(np.float64) + float(t[1:, 1:].max() - t[0, 0])
    once = float(t[0, 1:].max() + t[1:, 0].max() - t[1:, 1:].max() - t[0, 0]) + 1e-3
    upto = np.r_[0.0, np.cumsum(lead)]
    before = np.minimum.accumulate(upto[:-1])
    after = np.maximum.accumulate(upto[:0:-1])[::-1]
    return after - before + once <= 0


def spans_of(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) of every run that begins or continues one kind."""
    out, open_kind, start = [], -1, 0
    for k, t in enumerate([*tags.tolist(), 0]):
        kind = (t - 1) // 2 if t else -1
        if open_kind >= 0 and (kind != open_kind or t % 2 == 1):
            out.append((open_kind, start, k))
            open_kind = -1
        if kind >= 0 and open_kind < 0:
            open_kind, start = kind, k
    return out


def _decoded(p: dict, pieces: list[np.ndarray]) -> list[np.ndarray]:
    """Best tags of stretches of any length, in batches of about the same length."""
    out: list = [None] * len(pieces)
    order = sorted(range(len(pieces)), key=lambda r: len(pieces[r]))
    at = 0
    while at < len(order):
        part = [order[at]]
        while at + len(part) < len(order) and len(part) < 1024 and len(pieces[order[at + len(part)]]) <= len(pieces[order[at]]) * 5 // 4 + 4:
            part.append(order[at + len(part)])
        at += len(part)
        lengths = np.array([len(pieces[r]) for r in part])
        e = np.zeros((len(part), int(lengths.max()), TAGS), np.float32)
        for k, r in enumerate(part):
            e[k, : lengths[k]] = pieces[r]
        for r, tags in zip(part, viterbi(p, e, lengths), strict=True):
            out[r] = tags
    return out


def scores(p: dict, codes: list[np.ndarray]) -> list[np.ndarray]:
    """(characters, TAGS) of texts of any length.

    Windows share SHARED characters; there their scores are averaged with
    weights that fall toward a window's edges.
    """
    index, step = [], WINDOW - SHARED
    codes = [np.pad(c, MARGIN, constant_values=1) for c in codes]
    out = [np.zeros((len(c), TAGS), np.float32) for c in codes]
    for r, c in enumerate(codes):
        index += [(r, at) for at in range(0, max(len(c) - SHARED, 1), step)]
    # padding depends on a window's own length only, so that its scores do not depend on its company
    padded = lambda x: min(WINDOW, -(-(len(codes[x[0]]) - x[1]) // PADDED) * PADDED)
    index.sort(key=padded)
    rise = ((np.arange(SHARED) + 1) / (SHARED + 1)).astype(np.float32)[:, None]
    batches = (list(same) for _, same in groupby(index, padded))
    for part in (same[at : at + BATCH] for same in batches for at in range(0, len(same), BATCH)):
        size = padded(part[0])
        w = np.full((len(part), size), 1, np.int64)
        for k, (r, a) in enumerate(part):
            w[k, : len(codes[r]) - a] = codes[r][a : a + size]
        for (r, a), e in zip(part, emissions(p, w), strict=True):
            n = min(size, len(codes[r]) - a)
            e = e[:n].copy()
            if a:
                e[:SHARED] *= rise[:n]
            if a + n < len(codes[r]):
                e[step:] *= rise[::-1]
            out[r][a : a + n] += e
    return [o[MARGIN:-MARGIN] for o in out]


def tag_texts(p: dict, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """Spans (kind, start, end) of whole texts.

    One best path is decoded through each text; what is surely outside parts
    it into stretches that do not depend on each other.  A span stays when its
    tags beat being outside by LEAST_ODDS of its kind, and by EACH_ODDS for
    each of its characters.
    """
    index, pieces = [], []
    for r, e in enumerate(scores(p, [encode(t) for t in texts])):
        open_ = np.flatnonzero(np.diff(np.r_[0, ~surely_outside(p, e), 0])) if len(e) else ()
        for a, z in zip(open_[::2], open_[1::2], strict=True):
            index.append((r, int(a)))
            pieces.append(e[a:z])
    out: list = [[] for _ in texts]
    t = p["trans"]
    for (r, a), e, tags in zip(index, pieces, _decoded(p, pieces), strict=True):
        for kind, x, y in spans_of(tags):
            own = tags[x:y]
            odds = (e[np.arange(x, y), own] - e[x:y, 0]).sum() + t[0, own[0]] + t[own[:-1], own[1:]].sum() + t[own[-1], 0] - t[0, 0] * (y - x + 1)
            if odds >= max(LEAST_ODDS[kind], EACH_ODDS[kind] * (y - x)):
                out[r].append((kind, a + x, a + y))
    return out

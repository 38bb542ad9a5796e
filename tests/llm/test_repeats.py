import random
from collections import Counter

import pytest

from contactloom.llm import repeats as rp

LENGTH = 200


def model(texts):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[k : k + LENGTH] for d in data for k in range(len(d) - LENGTH + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - LENGTH + 1):
            if count[d[k : k + LENGTH]] > 1:
                gone[k : k + LENGTH] = b"\1" * LENGTH
        spans = sum(1 for k in range(len(d)) if gone[k] and not (k and gone[k - 1]))
        out.append((len(d), sum(gone), spans, bytes(b for b, g in zip(d, gone, strict=True) if not g)))
    return out


def passages(rnd):
    letters = "abcdefgh é\n"
    text = lambda n: "".join(rnd.choices(letters, k=n))
    shared = [text(rnd.randrange(150, 500)) for _ in range(8)]
    texts = []
    for _ in range(70):
        parts = []
        for _ in range(rnd.randrange(0, 5)):
            s = rnd.choice(shared)
            a = rnd.randrange(0, 60)
            parts += [text(rnd.randrange(0, 90)), s[a : len(s) - rnd.randrange(0, 60)]]
        texts.append("".join(parts))
    # twice in one text, at the very start and end, exactly the length, one byte short of it
    once = text(LENGTH)
    texts += [once + "x" + once, "y" + once, text(LENGTH - 1), text(LENGTH - 1)]
    short = text(LENGTH - 1)
    texts += [short + "1", short + "2", "3" + short]
    # periods, with all their anchors alike
    texts += ["z" * 700, "z" * (LENGTH + 1), "ab" * 300, "abc" * 100, "z" * LENGTH]
    return texts


def test_against_every_window(documents):
    texts = passages(random.Random(18)) + [None, ""]
    texts += ["copy " * 100, "copy " * 100]
    # copies of whole texts, and texts that share more or less of them
    rnd = random.Random(20)
    for t in [x for x in texts[:70] if len(x) > 2 * LENGTH][:12]:
        cut = rnd.randrange(LENGTH // 2, len(t))
        texts += [t, t[:cut] + "!" + t[cut:], t[:cut], "?" + t[cut // 2 :]]
    want = dict(enumerate(model(texts)))
    got = rp.remove_repeats(documents(list(enumerate(texts)), clash=True), length=LENGTH).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept_bytes"])) for r in got} == want
    assert sum(w[1] for w in want.values()) > 5000


@pytest.mark.parametrize("length", [129, LENGTH, 400])
def test_windows_and_places(monkeypatch, length):
    """Every window has one place, at the same distance in every copy, however the texts are tiled."""
    import numpy as np

    rnd = random.Random(19)
    texts = [np.frombuffer("".join(rnd.choices("abcd", k=n)).encode(), np.uint8) for n in (5000, 300, 12_000, 0, 1024)]
    texts += [np.frombuffer(b"abc" * 500, np.uint8), np.frombuffer(b"z" * 900, np.uint8), np.concatenate([texts[1], texts[0][1000:4000], texts[1]])]
    one = rp.Places(texts, length)
    monkeypatch.setattr(rp, "SLICE", 1024)
    two = rp.Places(texts, length)
    key = lambda x: sorted(zip(x.text.tolist(), x.pos.tolist(), x.first.tolist(), x.low.tolist(), x.high.tolist(), strict=True))
    assert key(one) == key(two) and len(one.pos) > 50
    seen = {}
    for r, t in enumerate(texts):
        owners = Counter()
        for p, a, b in zip(one.pos[one.text == r].tolist(), one.low[one.text == r].tolist(), one.high[one.text == r].tolist(), strict=True):
            for d in range(a, b + 1):
                owners[p - d] += 1
                window = t[p - d : p - d + length].tobytes()
                assert len(window) == length and seen.setdefault(window, d) == d
        assert owners == Counter(range(len(t) - length + 1)), r


def test_edges(documents, edge_pairs):
    rows = rp.remove_repeats(documents(edge_pairs)).collect()
    assert len(rows) == len(edge_pairs)
    assert all(r["n_removed"] == 0 for r in rows if (r["n_bytes"] or 0) < 400)
    repeated = [(1, "r" * 50 + "q" * 400), (1, "r" * 50 + "q" * 400), (None, "s" * 399)]
    assert sorted((r["n_removed"], r["n_spans"]) for r in rp.remove_repeats(documents(repeated)).collect()) == [(0, 0), (450, 1), (450, 1)]
    assert rp.remove_repeats(documents([])).count() == 0
    with pytest.raises(ValueError):
        rp.remove_repeats(documents([]), length=100)

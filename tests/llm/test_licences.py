import math
import random
import re
import textwrap

import pytest

from contactloom.llm.licences import LONGER, TEMPLATES, bigrams_of, every_template, licence_lines, licence_notices


def model(text, threshold=0.8):
    out = []
    for k, line in enumerate(re.split("\n", (text or "").lower())):
        a = set(bigrams_of(line))
        best = None
        for name, ts in sorted(TEMPLATES.items()):
            for t in ts:
                b = set(bigrams_of(t))
                s = 2000 * len(a & b) // (len(a) + len(b))
                if a and s >= 1000 * threshold and (best is None or s > best[1]):
                    best = (name, s)
        if best:
            out.append((k, *best))
    return out


def test_against_all_templates(documents, edge_pairs):
    rnd = random.Random(15)
    notices = [t for ts in TEMPLATES.values() for t in ts]
    texts = []
    for _ in range(150):
        lines = []
        for _ in range(rnd.randrange(1, 6)):
            w = rnd.choice(notices).split()
            for _ in range(rnd.randrange(0, 4)):
                w[rnd.randrange(len(w))] = rnd.choice(["foo", "the", "LICENSE,", "x###"])
            lines.append(rnd.choice([" ", "  "]).join(w) if rnd.random() < 0.7 else "some other line of words here")
        texts.append("\n".join(lines))
    pairs = [p for p in edge_pairs if p[0] not in (None, 5)] + [(100 + k, t) for k, t in enumerate(texts)]
    got = {r["doc_id"]: [tuple(m) for m in r["matches"]] for r in licence_lines(documents(pairs, clash=True)).collect()}
    assert got == {i: model(t) for i, t in pairs}
    assert sum(map(len, got.values())) > 100


def test_own_templates_and_edges(documents):
    df = documents([(1, "alpha beta gamma"), (2, None)])
    got = {r["doc_id"]: [tuple(m) for m in r["matches"]] for r in licence_lines(df, templates={"X": ["Alpha, beta gamma!"]}).collect()}
    assert got == {1: [(0, "X", 1000)], 2: []}
    assert licence_lines(documents([])).count() == 0
    with pytest.raises(ValueError):
        licence_lines(df, templates={"X": ["one"]})


def test_notices_over_lines_and_inside_lines(documents):
    apart = {}
    for name, ts in sorted(TEMPLATES.items()):
        for t in ts:
            apart[name, t] = textwrap.fill(t, 40), f"before it stand some words {t} and others follow behind it until the end of a line that is long"
    mit, bsd, isc = (LONGER[k][-1] for k in ("MIT", "BSD", "ISC"))
    texts = [(name, x) for (name, _), both in apart.items() for x in both]
    texts += [(k, textwrap.fill(t, 72)) for k, t in (("MIT", mit), ("BSD", bsd), ("ISC", isc))] + [("MIT", mit), ("ISC", isc)]
    texts += [(name, f"x y z\n{textwrap.fill(t, 72)}\nmore") for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "Apache-2.0") for t in LONGER[name]]
    texts += [("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."), ("CC-BY-SA-3.0", "Licensed under CC BY-SA 3.0.")]
    got = {r["doc_id"]: [tuple(m) for m in r["matches"]] for r in licence_notices(documents(list(enumerate(x for _, x in texts)), clash=True)).collect()}
    wrong = [(name, x[:80], got[k]) for k, (name, x) in enumerate(texts) if {m[1] for m in got[k]} != {name}]
    assert not wrong


def test_notices_keep_all_lines_and_their_places(documents, edge_pairs):
    mit = TEMPLATES["MIT"][2]
    texts = [(100, f"one\n\n{textwrap.fill(mit, 30)}\nx Licensed under CC BY 4.0. Licensed under CC BY-NC 4.0.\nother"), (101, "\n".join([TEMPLATES["MIT"][0]] * 40)), (102, "nothing of the sort in the words of the text")]
    pairs = [p for p in edge_pairs if p[0] not in (None, 5)] + texts
    got = {r["doc_id"]: [tuple(m) for m in r["matches"]] for r in licence_notices(documents(pairs, clash=True)).collect()}
    at = 3 + textwrap.fill(mit, 30).count("\n")
    assert got[100] == [(2, "MIT", 1000), (at, "CC-BY-4.0", 1000), (at, "CC-BY-NC-4.0", 1000)]
    assert got[101] == [(k, "MIT", 1000) for k in range(40)]
    assert all(not got[i] for i, _ in pairs if i not in (100, 101))


def window_model(text, templates, threshold=0.8):
    """Every window between two word pairs of a template, then the best of those that touch."""
    words, line_of = [], []
    for k, line in enumerate((text or "").lower().split("\n")):
        found = [w for w in re.split(r"[\W_]+", line) if w]
        words += found
        line_of += [k] * len(found)
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    ratio, windows, looked = threshold / (2 - threshold), [], False
    for name, ts in templates.items():
        for t in dict.fromkeys(ts):
            b = bigrams_of(t)
            own, size = set(b), len(b)
            if len(own & set(pairs)) < math.ceil(ratio * size - 1e-9):
                continue
            looked = True
            reach = math.floor(size / ratio + 1e-9) + len([w for w in re.split(r"[\W_]+", t.lower()) if w]) - 1 - size
            at = [p for p, x in enumerate(pairs) if x in own]
            for p in at:
                best = (0, 0, 0)
                for e in at:
                    if p <= e < p + reach:
                        inside = [x for x in pairs[p : e + 1] if x in own]
                        shared = len(set(inside))
                        m = 2000 * shared // (max(e - p + 1 - (len(inside) - shared), size) + size)
                        best = max(best, (m, shared, -e))
                if best[0] >= 1000 * threshold and len([x for x in at if p <= x < p + reach]) >= math.ceil(ratio * size - 1e-9):
                    windows.append((-best[1], -best[0], name, p, -best[2]))
    chosen = []
    for w in sorted(windows):
        if not any(w[3] <= c[4] + 1 and c[3] <= w[4] + 1 for c in chosen):
            chosen.append(w)
    spans = [(line_of[c[3]], c[2], -c[1], line_of[c[4] + 1]) for c in chosen]
    lines = []
    if looked:
        for k, line in enumerate((text or "").lower().split("\n")):
            a, best = set(bigrams_of(line)), None
            for name, ts in sorted(templates.items()):
                for t in ts:
                    b = set(bigrams_of(t))
                    s = 2000 * len(a & b) // (len(a) + len(b))
                    if a and s >= 1000 * threshold and (best is None or s > best[1]):
                        best = (name, s)
            if best and not any(x[0] <= k <= x[3] for x in spans):
                lines.append((k, *best))
    return sorted([s[:3] for s in spans] + lines)


def test_windows_against_every_window(documents):
    """Notices with words changed, left out, repeated and wrapped, in other words, one after another."""
    rnd = random.Random(21)
    templates = every_template()
    short = [t for ts in templates.values() for t in ts if len(t.split()) < 45]
    texts = []
    for _ in range(120):
        words = []
        for _ in range(rnd.randrange(1, 5)):
            w = rnd.choice(short).split()
            for _ in range(rnd.randrange(0, 5)):
                k = rnd.randrange(len(w))
                w[k : k + rnd.randrange(0, 2)] = rnd.choice([["foo"], [], [w[k], w[k]], ["the", "license"]]) or ["x"]
            words += w + rnd.choices("some other words of a text the License under".split(), k=rnd.randrange(0, 9))
        texts.append("".join(w + rnd.choice((" ", " ", " ", "\n")) for w in words))
    got = {r["doc_id"]: [tuple(m) for m in r["matches"]] for r in licence_notices(documents(list(enumerate(texts)))).collect()}
    want = {k: window_model(t, templates) for k, t in enumerate(texts)}
    assert got == want
    assert sum(map(len, want.values())) > 120


def test_identifiers_and_public_domain(documents):
    cases = [(k, f"// SPDX-License-Identifier: {x}\nint main") for k, x in (("MIT", "MIT"), ("ISC", "ISC"), ("GPL-2.0", "GPL-2.0-only"), ("GPL-3.0", "GPL-3.0-or-later"), ("LGPL-2.1", "LGPL-2.1"), ("BSD", "BSD-3-Clause"), ("Apache-2.0", "Apache-2.0"), ("CC0-1.0", "CC0-1.0"), ("Unlicense", "Unlicense"), ("BSL-1.0", "BSL-1.0"), ("MPL-2.0", "MPL-2.0"), ("CC-BY-NC-SA-4.0", "CC-BY-NC-SA-4.0"))]
    cases += [("MIT", "The MIT License (MIT)"), ("CC0-1.0", textwrap.fill(LONGER["CC0-1.0"][0], 40)), ("Unlicense", textwrap.fill(LONGER["Unlicense"][1], 70)), ("BSL-1.0", "x Distributed under the Boost Software License, Version 1.0. y")]
    got = {r["doc_id"]: {m["licence"] for m in r["matches"]} for r in licence_notices(documents([(k, t) for k, (_, t) in enumerate(cases)])).collect()}
    assert got == {k: {name} for k, (name, _) in enumerate(cases)}

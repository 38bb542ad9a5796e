import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from contactloom.llm import packing as pk
from contactloom.llm.queries import tokenizer_path
from contactloom.llm.tables import leaving_little
from contactloom.llm.tokens import WordEncoder

FILE = tokenizer_path("word_bpe_49k.json")


def optimum(items, capacity):
    """The least number of bins, by trying everything."""
    items = sorted(items, reverse=True)
    best = len(items)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(items):
            best = len(bins)
            return
        for b in {x: j for j, x in enumerate(bins)}.values():
            if bins[b] >= items[k]:
                bins[b] -= items[k]
                place(k + 1, bins)
                bins[b] += items[k]
        place(k + 1, [*bins, capacity - items[k]])

    place(0, [])
    return best if items else 0


def test_reduction_keeps_the_optimum():
    rnd = random.Random(4)
    fixed = 0
    for _ in range(250):
        cap = rnd.choice([10, 17, 24])
        items = [rnd.randrange(1 if rnd.random() < 0.5 else cap // 4 + 1, cap + 1) for _ in range(rnd.randrange(1, 9))]
        left = dict(Counter(items))
        sets = pk.reduce_instance(left, cap)
        assert all(sum(used) <= cap for _, used in sets)
        rest = list(itertools.chain.from_iterable([s] * n for s, n in left.items()))
        done = list(itertools.chain.from_iterable(list(used) * n for n, used in sets))
        assert sorted(rest + done) == sorted(items)
        assert sum(n for n, _ in sets) + optimum(rest, cap) == optimum(items, cap)
        fixed += len(sets)
    assert fixed > 200


def sequential_best_fit(items, capacity):
    rooms = []
    for s in sorted(items, reverse=True):
        fits = [k for k, r in enumerate(rooms) if r >= s]
        if fits:
            k = min(fits, key=lambda k: rooms[k])
            rooms[k] -= s
        else:
            rooms.append(capacity - s)
    return sorted(rooms)


def test_bulk_best_fit_equals_one_by_one():
    rnd = random.Random(5)
    for _ in range(60):
        items = [rnd.randrange(1, 101) for _ in range(rnd.randrange(0, 300))]
        bins = pk.best_fit(dict(Counter(items)), 100)
        rooms = sorted(100 - sum(s * c for s, c in content) for n, content in bins for _ in range(n))
        assert rooms == sequential_best_fit(items, 100)


def check_packed(rows, capacity):
    seen = Counter()
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        end = 0
        for r in group:
            assert r["offset"] == end
            end += r["length"]
        assert 0 < end <= capacity
        seen["bins"] += 1
    return seen["bins"]


def test_pieces_are_packed_without_gaps(spark):
    rnd = random.Random(6)
    lengths = [rnd.choice([7, 7, 7, rnd.randrange(1, 65)]) for _ in range(3000)]
    df = spark.createDataFrame([(k, n) for k, n in enumerate(lengths)], "id bigint, length bigint")
    out = [r.asDict() for r in pk.pack(df, 64).collect()]
    assert sorted((r["id"], r["length"]) for r in out) == list(enumerate(lengths))
    bins = check_packed(out, 64)
    assert bins <= 1.01 * sum(lengths) / 64 + 1
    assert pk.pack(df.limit(0), 64).count() == 0
    with pytest.raises(ValueError):
        pk.pack(df.selectExpr("id", "length + 64 as length"), 64)
    with pytest.raises(ValueError):
        pk.pack(df.withColumnRenamed("id", "offset"), 64)


def test_equal_rows_get_places_of_their_own(spark):
    df = spark.createDataFrame([(1, 5)] * 20 + [(None, 5)] * 3, "id bigint, length bigint")
    out = [r.asDict() for r in pk.pack(df, 10).collect()]
    assert len({(r["sequence_id"], r["offset"]) for r in out}) == 23 and check_packed(out, 10) == 12


def test_pieces_equal_the_library(documents, edge_pairs):
    pairs = [p for p in edge_pairs if p[0] != 5] + [(20, "Don't we've 12 3ABC _x_ it's"), (21, "ΑΣ İSTANBUL <|endoftext|> ǅ"), (22, "tok " * 2046), (23, "tok " * 2047), (24, "tok " * 2048)]
    rows = pk.token_pieces(documents(pairs, clash=True), FILE, keep_ids=True).collect()
    library = WordEncoder(FILE).library
    for i, t in pairs:
        if i is None:
            continue
        want = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        got = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [x for r in got for x in r["ids"]] == want
        assert [r["start"] for r in got] == list(range(0, len(want), 2048)) and all(r["length"] == len(r["ids"]) <= 2048 for r in got)
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in got)
    assert len([r for r in rows if r["doc_id"] is None]) == 2


def test_encoder_forgets_and_relearns(monkeypatch):
    from contactloom.llm import tokens

    monkeypatch.setattr(tokens, "MOST_WORDS", 50)
    rnd = random.Random(2)
    texts = [" ".join("".join(rnd.choices("abcdé123'_-.", k=rnd.randrange(1, 8))) for _ in range(20)) for _ in range(40)]
    enc = WordEncoder(FILE)
    for k in range(0, 40, 4):
        for t, ids in zip(texts[k : k + 4], enc(texts[k : k + 4]), strict=True):
            assert ids == np.array(enc.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_idle_worker_holds_little(monkeypatch):
    """Half of a bounded table, and nothing that was only met before, stays between tasks."""
    from contactloom.llm import tokens

    assert 4 * tokens.MOST_WORDS <= 800_000
    monkeypatch.setattr(tokens, "MOST_WORDS", 50)
    enc, forgot = WordEncoder(FILE), []
    run = leaving_little(lambda batches: (enc([t]) for t in batches), enc.rest, lambda: forgot.append(len(enc.strings.old)))
    texts = [" ".join(f"word{k}x{j}" for j in range(40)) for k in range(5)]
    want = [[np.array(enc.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()] for t in texts]
    assert list(run(iter(texts))) == want
    assert forgot == [0] and not enc.words.old and len(enc.strings.young) <= 50 and len(enc.words.young) <= 50
    # a task that ends early gives back as well
    one = run(iter(texts))
    assert next(one) == want[0]
    one.close()
    assert forgot == [0, 0]

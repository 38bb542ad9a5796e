import random

import pytest

from contactloom.operators import contact_map as cm
from contactloom.operators import mismatch, split
from contactloom.session import stage


def contacts_frame(spark, rows):
    return spark.createDataFrame(rows, "ref_id int, pos bigint, next_pos bigint")


def quantile_model(counts, percent=0.949999988079071):
    n, c = len(counts), sorted(counts)
    q = percent * (n + 1)
    if n == 1 or q < 1:
        v = c[0]
    elif q >= n:
        v = c[-1]
    else:
        v = c[int(q) - 1] + (q - int(q)) * (c[int(q)] - c[int(q) - 1])
    return int(v * 100000)


@pytest.mark.parametrize("percent,exact", [(0.95, 0.949999988079071), (0.5, 0.5), (0.01, 0.009999999776482582)])
def test_saturation(spark, rows, percent, exact):
    rnd = random.Random(1)
    data, want = [], []
    for ref, n in enumerate((1, 2, 3, 19, 60)):
        counts = [rnd.randrange(1, 9) for _ in range(n)]
        data += [(ref, 0, 10 * (k + 1), c) for k, c in enumerate(counts)]
        want.append((ref, quantile_model(counts, exact)))
    data.append((9, 10, 10, 4))  # only a diagonal cell: no level
    df = spark.createDataFrame(data, "ref_id int, bin_s bigint, bin_e bigint, cnt bigint")
    assert rows(cm.saturation_level(df, percent)) == want


def score_model(cells, sat, size, dep):
    score = {}
    for (s, e), n in cells.items():
        if e - s <= dep:
            for i in range(s + size, e, size):
                score[i] = score.get(i, 0) + min(n * 100000, sat)
    return score


def track_model(score, size, dep):
    if not score:
        return {}
    return {i: score.get(i, 0) for i in range(min(score) + dep - 2 * size, max(score) - dep + 3 * size, size)}


def mismatch_model(wide_track, thr, narrow_track, wide, narrow):
    """The sequential scan: islands first, then one pass over the fine grid."""
    keys = sorted(wide_track)
    islands, start = [], None
    for p in keys:
        if wide_track[p] < thr:
            start = p if start is None else start
        elif start is not None:
            islands.append((start, last + wide))
            start = None
        last = p
    if start is not None:
        islands.append((start, keys[-1] + wide))
    grid = sorted(narrow_track)
    if not grid or not islands:
        return islands
    picks, k, least, open_ = [], 0, 0, False
    for p in grid:
        if k >= len(islands):
            break
        w0, w1 = islands[k]
        if p <= w0:
            least, open_ = narrow_track[p], True
        elif open_:
            least = min(least, narrow_track[p])
        if p >= w1:
            m = least if open_ else 0
            picks += [i for i in range(w0, w1, narrow) if narrow_track.get(i) == m]
            k, open_, least = k + 1, False, 0
    if k < len(islands):
        w0, w1 = islands[k]
        m = least if open_ else 0
        picks += [i for i in range(w0, w1, narrow) if narrow_track.get(i) == m]
        k += 1
        if k < len(islands):  # a point closes one island; the next one has no point left
            w0, w1 = islands[k]
    if not picks:
        return islands
    out = []
    for p in sorted(set(picks)):
        if out and out[-1][1] == p:
            out[-1] = (out[-1][0], p + narrow)
        else:
            out.append((p, p + narrow))
    return out


def test_scores_and_wide_islands_against_the_scan(spark, rows):
    wide, narrow, dep = 500, 100, 2000
    rnd = random.Random(3)
    data = []
    for ref in range(25):
        for _ in range(rnd.randrange(30, 200)):
            p = rnd.randrange(0, 12000)
            q = p + rnd.choice([rnd.randrange(0, 800), rnd.randrange(0, 2600)])
            data += [(ref, p, q), (ref, q, p)]
    df = contacts_frame(spark, data)
    got = {}
    tracks = {}
    for name, size, d in (("wide", wide, dep), ("narrow", narrow, wide)):
        cells = cm.bin_contacts(df, size)
        level = cm.saturation_level(cells)
        got[name] = (level, cm.crop_track(cm.depletion_score(cells, level, size, d), size, d))
        levels = dict(rows(level))
        for ref in range(25):
            binned = {}
            for r, p, q in data:
                if r == ref:
                    key = (p // size * size, q // size * size)
                    binned[key] = binned.get(key, 0) + 1
            tracks[name, ref] = track_model(score_model(binned, levels[ref], size, d), size, d)
        want = sorted((ref, p, v) for ref in range(25) for p, v in tracks[name, ref].items())
        assert rows(got[name][1]) == want
    thr = cm.threshold_e5(got["wide"][0], wide, dep)
    islands = mismatch.wide_mismatches(got["wide"][1], thr, wide)
    limits = dict(rows(thr))
    wanted = sorted((ref, a, b) for ref in range(25) for a, b in mismatch_model(tracks["wide", ref], limits[ref], {}, wide, narrow))
    assert rows(islands) == wanted and wanted
    fine = rows(mismatch.narrow_mismatches(islands, got["narrow"][1], narrow))
    for ref, a, b in fine:
        inside = [(x, y) for r, x, y in wanted if r == ref and x <= a and b <= y + narrow]
        assert inside
    assert {r for r, *_ in fine} == {r for r, *_ in wanted}


def test_narrow_rule_on_small_cases(spark, rows):
    islands = spark.createDataFrame([(1, 100, 300), (2, 100, 300), (3, 0, 200), (4, 1000, 1200)], "ref_id int, start bigint, end bigint")
    track = spark.createDataFrame(
        # 1: the least score is at 150; 2: the closing point 300 has the least, so no pick and the wide island stays
        [(1, p, s) for p, s in ((50, 9), (100, 5), (150, 1), (200, 1), (250, 5), (300, 7))]
        + [(2, p, s) for p, s in ((50, 9), (100, 5), (150, 4), (200, 6), (250, 5), (300, 2))]
        # 3: no point at or before the start, so the minimum is 0
        + [(3, p, s) for p, s in ((50, 0), (100, 3), (150, 0), (200, 4))],
        "ref_id int, pos bigint, score_e5 bigint",
    )
    assert rows(mismatch.narrow_mismatches(islands, track, 50)) == [(1, 150, 250), (2, 100, 300), (3, 50, 100), (3, 150, 200), (4, 1000, 1200)]


def test_pieces_join_to_the_contig(spark, rows):
    contigs = spark.createDataFrame([("a", "ABCDEFGHIJKL"), ("b", "WHOLE"), ("c", "ABCDEFGH")], "name string, seq string")
    cuts = spark.createDataFrame([("a", 4, 6), ("a", 9, 11), ("c", 3, 9)], "name string, start bigint, end bigint")
    got = rows(split.split_contigs(contigs, cuts))
    assert got == [
        ("a", 0, "a_1_3", "ABC"), ("a", 1, "a_4_5", "DE"), ("a", 2, "a_6_8", "FGH"), ("a", 3, "a_9_10", "IJ"), ("a", 4, "a_10_12", "KL"),
        ("b", 0, "b", "WHOLE"), ("c", 0, "c_1_2", "AB"), ("c", 1, "c_3_8", "CDEFGH"),
    ]


def test_intra_contacts_keep_both_mates(spark, rows):
    df = spark.createDataFrame([(1, 5, 1, 9, 3), (1, 9, 1, 5, 3), (1, 5, 2, 9, 3), (-1, 5, -1, 9, 3), (1, -1, 1, 9, 3), (1, 5, 1, 9, 0)], "ref_id int, pos bigint, next_ref_id int, next_pos bigint, mapq int")
    out = cm.intra_contacts(df)
    assert rows(out) == [(1, 5, 9), (1, 9, 5)]
    assert rows(cm.bin_contacts(out, 5)) == [(1, 5, 5, 2)]


def test_distances_at_the_limits(spark, rows):
    cells = spark.createDataFrame([(1, 0, e, 1) for e in (10, 20, 50, 60)], "ref_id int, bin_s bigint, bin_e bigint, cnt bigint")
    sat = spark.createDataFrame([(1, 100000)], "ref_id int, sat_e5 bigint")
    assert rows(cm.depletion_score(cells, sat, 10, 50)) == [(1, 10, 200000), (1, 20, 100000), (1, 30, 100000), (1, 40, 100000)]


def test_scores_over_many_tiles(spark, rows, monkeypatch):
    """Running sums over tiles of a few bins, with gaps of several tiles, equal the sum bin by bin."""
    monkeypatch.setattr(cm, "TILE_BINS", 3)
    rnd = random.Random(17)
    cells = {}
    for _ in range(300):
        c, s = rnd.randrange(3), 10 * rnd.choice((rnd.randrange(30), 200 + rnd.randrange(10)))
        cells[c, s, s + 10 * rnd.randrange(0, 14)] = rnd.randrange(1, 9)
    table = spark.createDataFrame([(*k, n) for k, n in cells.items()], "ref_id int, bin_s bigint, bin_e bigint, cnt bigint")
    level = {0: 350_000, 1: 0, 2: 10**9}
    want = {}
    for (c, s, e), n in cells.items():
        if 20 <= e - s <= 100:
            for p in range(s + 10, e, 10):
                want[c, p] = want.get((c, p), 0) + min(n * 100_000, level[c])
    got = cm.depletion_score(table, spark.createDataFrame(list(level.items()), "ref_id int, sat_e5 bigint"), 10, 100)
    assert rows(got, "ref_id", "pos", "score_e5") == sorted((*k, v) for k, v in want.items())


def test_track_in_one_shuffle_equals_the_cropped_scores(spark, rows, monkeypatch):
    """Tiles of few bins, contigs with gaps of many tiles, cells over several tiles, contigs without a grid."""
    monkeypatch.setattr(cm, "TILE_BINS", 3)
    rnd = random.Random(8)
    data = [(ref, 10 * a, 10 * (a + rnd.randrange(-2, 14)), rnd.randrange(1, 9)) for ref in range(12) for a in [rnd.choice([0, 40, 300]) + rnd.randrange(25) for _ in range(rnd.randrange(1, 25))]]
    table = spark.createDataFrame(list({d[:3]: d for d in data}.values()), "ref_id int, bin_s bigint, bin_e bigint, cnt bigint")
    level = spark.createDataFrame([(ref, 100_000 * (1 + ref % 6)) for ref in range(11)], "ref_id int, sat_e5 bigint")
    for depletion in (20, 50, 100, 105):
        want = rows(cm.crop_track(cm.depletion_score(table, level, 10, depletion), 10, depletion))
        got = cm.score_track(table, level, 10, depletion)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert rows(got) == want and want
        if depletion % 10 == 0:
            assert plan.count("Exchange hashpartitioning") == 1 and plan.count("SortMergeJoin") == 0


def test_islands_meet_the_track_once(spark, rows, monkeypatch):
    """The grid is not built in the few tasks of a small table of contigs, and one join reads the track."""
    plans = {}

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, name)

    monkeypatch.setattr(mismatch, "stage", seen)
    islands = spark.createDataFrame([(1, 100, 300), (1, 9000, 9600)], "ref_id int, start bigint, end bigint")
    track = spark.createDataFrame([(1, p, abs(p - 9300)) for p in range(50, 20_000, 50)], "ref_id int, pos bigint, score_e5 bigint")
    assert rows(mismatch.narrow_mismatches(islands, track, 50)) == [(1, 9300, 9350)]
    assert sum("track-" in line for line in plans["points"].splitlines()) == 1
    assert not any("track-" in line for line in plans["picks"].splitlines())
    crop = cm.crop_track(spark.createDataFrame([(1, p, 1) for p in range(0, 900, 10)], "ref_id int, pos bigint, score_e5 bigint"), 10, 30)
    assert "REPARTITION_BY_NUM" in crop._jdf.queryExecution().executedPlan().toString()

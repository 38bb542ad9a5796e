import pytest

from contactloom.functions.text import resolve_motif
from contactloom.operators import sites
from contactloom.operators.ordinals import dense_ordinal


def contigs(spark, *seqs):
    return spark.createDataFrame([(k, f"c{k}", s, len(s)) for k, s in enumerate(seqs)], "contig_ord bigint, name string, seq string, length bigint")


def test_motif_names():
    assert resolve_motif("hindiii") == resolve_motif("HIND3") == "AAGCTT"
    assert resolve_motif("NcoI") == "CCATGG"
    assert resolve_motif("DPN1") == resolve_motif("mboi") == "GATC"
    assert resolve_motif("acgt") == "ACGT"
    for bad in ("", "ACGN", "EcoRI"):
        with pytest.raises(ValueError):
            resolve_motif(bad)


def test_sites_do_not_overlap_and_are_case_sensitive(spark, rows):
    df = contigs(spark, "AAAAAA", "AAxAAAx", "aaaa", "", "xxAA")
    assert rows(sites.find_sites(df, "AA"), "name", "site_ord", "pos") == [("c0", 0, 0), ("c0", 1, 2), ("c0", 2, 4), ("c1", 0, 0), ("c1", 1, 3), ("c4", 0, 2)]


def test_nodes_are_numbered_in_contig_order(spark, rows):
    df = contigs(spark, "xGATCx", "xx", "GATCGATC", "GATC")
    assert rows(sites.count_sites(sites.find_sites(df, "GATC")), "node_id", "name", "site_count", "length") == [(0, "c0", 1, 6), (1, "c2", 2, 8), (2, "c3", 1, 4)]


def test_windows_by_case(spark, rows):
    def at(length, pos):
        s = ["x"] * length
        s[pos : pos + 4] = "GATC"
        return "".join(s)

    df = contigs(spark, at(999, 300), at(1000, 499), at(3000, 500), at(3000, 2496), at(3000, 2497))
    found = sites.find_sites(df, "GATC")
    w = sites.site_windows(found, sites.count_sites(found), 4)
    assert rows(w, "name", "win_start", "win_end") == [("c0", 0, 999), ("c1", 0, 1003), ("c2", 0, 1000), ("c3", 1996, 2996), ("c4", 1997, 3000)]


def test_dense_ordinal_over_buckets_and_nulls(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(k * 7 % 100,) for k in range(100)] + [(None,)], "x bigint")
    out = dense_ordinal(df, "n", [F.col("x")])
    assert rows(out, "n", "x") == [(0, None)] + [(k + 1, k) for k in range(100)]
    assert dense_ordinal(df.limit(0), "n", [F.col("x")]).count() == 0


def test_any_window_is_enough_on_both_sides_of_the_flank(spark):
    """Sites at 499 and 500 have their windows by different rules; both ends count."""
    from contactloom.operators import pairs, sites

    contigs = spark.createDataFrame([(0, "c", "A" * 499 + "GG" + "A" * 1499, 2000)], "contig_ord bigint, name string, seq string, length bigint")
    found = sites.find_sites(contigs, "G")
    windows = sites.site_windows(found, sites.count_sites(found), 1)
    ends = {r["site_ord"]: r["win_end"] for r in windows.collect()}
    assert ends[0] == 499 + 1 + 500 and ends[1] == 500 + 500
    rows = spark.createDataFrame([(0, p) for p in (0, 999, 1000, 1001)], "node_id bigint, pos bigint")
    assert sorted(r["pos"] for r in pairs.filter_near_site(rows, windows).collect()) == [0, 999, 1000]


def test_sequences_and_sites_are_made_by_many_tasks(spark):
    """Ids of a few bytes become long sequences: they are not made in one task."""
    from pyspark.sql import functions as F

    from contactloom import fixtures

    made = fixtures.sequences(spark, "/root/testdata/sf0.01").select(F.spark_partition_id().alias("p")).distinct().count()
    assert made > spark.sparkContext.defaultParallelism


def test_sites_are_searched_where_sequences_are(spark):
    found = sites.find_sites(contigs(spark, "xGATCx"), "GATC")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_leftmost_against_a_plain_loop():
    import random

    import numpy as np

    rnd = random.Random(3)
    for _ in range(500):
        step, free, places = rnd.randint(1, 5), rnd.randint(0, 30), sorted(rnd.sample(range(400), rnd.randint(0, 200)))
        want, after = [], free
        for p in places:
            if p >= after:
                want.append(p)
                after = p + step
        got, end = sites._leftmost(np.array(places, np.int64), free, step)
        assert got.tolist() == want and end == after
    assert sites._hits("aéenü😀en", "en").tolist() == [2, 6] and sites._hits("en", "enx").tolist() == []

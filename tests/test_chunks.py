import random

import pytest

from contactloom.operators import sites, split
from contactloom.sources import readers, sinks


def cut(spark, texts, rnd, most):
    """Contigs and chunks of random sizes."""
    rows = []
    for k, t in enumerate(texts):
        at = 0
        while at < len(t):
            n = rnd.randrange(1, most + 1)
            rows.append((k, at, t[at : at + n]))
            at += n
    rnd.shuffle(rows)
    return spark.createDataFrame([(k, f"c{k}", len(t)) for k, t in enumerate(texts)], "contig_ord bigint, name string, length bigint"), spark.createDataFrame(rows, "contig_ord bigint, start bigint, seq string").repartition(3)


def leftmost(text, motif):
    out, at = [], text.find(motif)
    while at >= 0:
        out.append(at)
        at = text.find(motif, at + len(motif))
    return out


@pytest.mark.parametrize("motif", ["A", "AA", "AAA", "ACA", "GATC", "ACAACA", "AAGCTT"])
def test_sites_equal_find_wherever_chunks_are_cut(spark, rows, motif):
    rnd = random.Random(motif)
    letters = "AC" if set(motif) <= set("AC") else "AGTC"
    texts = ["".join(rnd.choices(letters, k=rnd.randrange(200))) for _ in range(25)] + ["A" * 90, "", motif, motif[:-1], motif * 20, (motif[:-1] or "A") * 15]
    want = sorted((k, f"c{k}", len(t), i, p) for k, t in enumerate(texts) for i, p in enumerate(leftmost(t, motif)))
    for most in (1, 5, 60):
        got = sites.find_sites_in_chunks(*cut(spark, texts, rnd, most), motif)
        assert rows(got, "contig_ord", "name", "length", "site_ord", "pos") == want


def test_pieces_equal_those_of_whole_contigs(spark, rows, monkeypatch):
    monkeypatch.setattr(split, "TILE", 16)
    rnd = random.Random(9)
    texts = ["".join(rnd.choices("ACGT", k=n)) for n in (100, 64, 1, 33, 200, 0)]
    cuts = [("c0", 10, 20), ("c0", 40, 61), ("c1", 0, 30), ("c3", 5, 34), ("c4", 1, 90), ("c4", 90, 150), ("c9", 3, 4)]
    table = spark.createDataFrame(cuts, "name string, start bigint, `end` bigint")
    whole = spark.createDataFrame([(f"c{k}", t) for k, t in enumerate(texts)], "name string, seq string")
    contigs, chunks = cut(spark, texts, rnd, 16)
    found = {}
    for name, order, piece, at, seq in rows(split.split_chunks(contigs, chunks, table), "name", "piece_ord", "piece_name", "at", "seq"):
        assert len(found.get((name, order, piece), "")) == at and len(seq) <= 16
        found[name, order, piece] = found.get((name, order, piece), "") + seq
    assert found == {(n, o, p): s for n, o, p, s in rows(split.split_contigs(whole, table), "name", "piece_ord", "piece_name", "seq")}


def test_chunks_written_and_read_again(spark, rows, tmp_path):
    rnd = random.Random(10)
    texts = ["".join(rnd.choices("ACGT", k=n)) for n in (100, 0, 700)]
    contigs, chunks = cut(spark, texts, rnd, 50)
    sinks.write_chunks(split.split_chunks(contigs, chunks, spark.createDataFrame([("c0", 11, 21)], "name string, start bigint, `end` bigint")), f"{tmp_path}/out")
    got = rows(readers.read_fasta(spark, f"{tmp_path}/out", split_bytes=60), "name", "seq")
    assert got == sorted([("c0_1_10", texts[0][:10]), ("c0_11_20", texts[0][10:20]), ("c0_20_100", texts[0][20:]), ("c1", ""), ("c2", texts[2])])

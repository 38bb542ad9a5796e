import struct
import time
import zlib

import pytest

from contactloom.operators.graph import group_contents
from contactloom.plans import workflows
from contactloom.sources import bam, edges, readers, sinks


def test_fasta(spark, rows, tmp_path):
    p = tmp_path / "a.fa"
    p.write_text("junk\n>c1 first\nAC \nGT\r\n\n>c2\n>c3\nTT\n")
    got = rows(readers.read_fasta(spark, str(p)))
    assert got == [(0, "c1 first", "ACGT", 4), (1, "c2", "", 0), (2, "c3", "TT", 2)]
    assert rows(readers.read_fasta(spark, str(p), keep_empty=False, first_token=True), "contig_ord", "name") == [(0, "c1"), (1, "c3")]
    q = tmp_path / "b.fa"
    q.write_text(">x\nAA\n>y\nCC")
    assert rows(readers.read_fasta(spark, str(q)), "name", "seq") == [("x", "AA"), ("y", "CC")]


def test_nodes_edges_coords_round_trip(spark, rows, tmp_path):
    nodes = spark.createDataFrame([(0, "a", 2, 10), (1, "b", 4, 20)], "node_id bigint, name string, site_count bigint, length bigint")
    sinks.write_nodes(nodes, f"{tmp_path}/nodes")
    text = "".join(p.read_text() for p in sorted((tmp_path / "nodes").glob("part-*")))
    assert text == "2\na\t2\t10\nb\t4\t20\n"
    assert rows(readers.read_nodes(spark, f"{tmp_path}/nodes")) == rows(nodes)
    edges.write_edges(spark.createDataFrame([(0, 1, 7), (1, 1, 3)], edges.EDGES).coalesce(1), f"{tmp_path}/edges")
    (part,) = (tmp_path / "edges").iterdir()
    assert part.read_bytes() == struct.pack("<iiq", 1, 0, 7) + struct.pack("<iiq", 1, 1, 3)
    (tmp_path / "x.edge").write_bytes(part.read_bytes())
    assert rows(readers.read_edges(spark, f"{tmp_path}/edges")) == [(0, 1, 7), (1, 1, 3)]
    assert rows(readers.read_edges(spark, f"{tmp_path}/x.edge")) == [(0, 1, 7), (1, 1, 3)]
    (tmp_path / "c.tsv").write_text("id\tx\ty\n1\t0.5\t2\n2\t-1\t3\n")
    assert rows(readers.read_coords(spark, f"{tmp_path}/c.tsv")) == [(0, 0.5, 2.0), (1, -1.0, 3.0)]
    weighted = spark.createDataFrame([(0, 1, 1.5)], "src bigint, dst bigint, weight double")
    sinks.write_pajek(nodes, weighted, f"{tmp_path}/net")
    net = "".join(p.read_text() for p in sorted((tmp_path / "net").glob("part-*")))
    assert net == '*Vertices 2\n1 "a"\n2 "b"\n*arcs\n2 1 1.500000000000000\n'
    members = spark.createDataFrame([(0, 0), (1, 1)], "group_id int, node_id bigint")
    sinks.write_groups(group_contents(members, nodes), f"{tmp_path}/groups")
    part = next((tmp_path / "groups" / "group_label=2g2").glob("part-*"))
    assert part.read_text() == "#Contig\tRECounts\tLength\nb\t4\t20\n"


SAM = "@HD\tVN:1.6\n@SQ\tSN:c1\tLN:100\n@SQ\tSN:c2\tLN:50\nr1\t65\tc1\t11\t60\t4M\tc2\t6\t0\tACGT\tIIII\nr1\t129\tc2\t6\t60\t4M\tc1\t11\t0\tACGT\tIIII\nr2\t4\t*\t0\t0\t*\t=\t0\t0\t*\t*\n"


def block(x):
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = c.compress(x) + c.flush()
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(x), len(x))


def record(name, flag, ref, pos, mapq, nref, npos, cigar, seq, qual):
    codes = ["=ACMGRSVTWYHKDBN".index(c) for c in seq] + [0] * (len(seq) % 2)
    packed = bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2], strict=True))
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, mapq, 0, len(cigar), flag, len(seq), nref, npos, 0) + name.encode() + b"\0"
    body += b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(op)) for n, op in cigar) + packed + bytes(ord(q) - 33 for q in qual)
    return struct.pack("<i", len(body)) + body


def bam_bytes():
    data = b"BAM\x01" + struct.pack("<i", 0) + struct.pack("<i", 2)
    for n, length in (("c1", 100), ("c2", 50)):
        data += struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", length)
    data += record("r1", 65, 0, 10, 60, 1, 5, [(4, "M")], "ACGT", "IIII") + record("r1", 129, 1, 5, 60, 0, 10, [(4, "M")], "ACGT", "IIII") + record("r2", 4, -1, -1, 0, -1, -1, [], "", "")

    # records reach across blocks
    return b"".join(block(data[k : k + 50]) for k in range(0, len(data), 50)) + block(b"")


def test_sam_and_bam_agree(spark, rows, tmp_path):
    (tmp_path / "x.sam").write_text(SAM)
    (tmp_path / "x.bam").write_bytes(bam_bytes())
    refs, aln = readers.read_sam(spark, f"{tmp_path}/x.sam")
    brefs, baln = readers.read_bam(spark, f"{tmp_path}/x.bam")
    assert rows(refs) == rows(brefs) == [(0, "c1", 100), (1, "c2", 50)]
    assert rows(aln) == rows(baln) and aln.count() == 3
    assert rows(aln, "read_name", "ref_id", "pos", "next_ref_id", "next_pos")[-1] == ("r2", -1, -1, -1, -1)


def made_bam(path, n=3000, step=7000):
    """One file with short and long records, blocks that cut through them."""
    import random

    rnd = random.Random(12)
    data = b"BAM\x01" + struct.pack("<i", 0) + struct.pack("<i", 3)
    for name in ("c1", "c2", "c3"):
        data += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", 1 << 20)
    want = []
    for k in range(n):
        size = rnd.choice((20, 0, 101, 90_000 if k % 500 == 7 else 80))
        seq, qual = "".join(rnd.choices("ACGTN", k=size)), "".join(chr(33 + q) for q in rnd.choices(range(40), k=size))
        r = (f"read{k}/{rnd.randrange(10**9)}", rnd.choice((65, 129, 321)), rnd.randrange(-1, 3), rnd.randrange(1 << 20), rnd.randrange(60), rnd.randrange(-1, 3), rnd.randrange(1 << 20))
        steps = [(size, "M"), (3, "S")] if size else []
        data += record(*r, steps, seq, qual)
        want.append((*r, 0, "".join(f"{a}{b}" for a, b in steps) or "*", seq or "*", qual or "*"))
    path.write_bytes(b"".join(block(data[k : k + step]) for k in range(0, len(data), step)) + block(b""))
    return sorted(want)


def test_bam_is_read_in_many_splits(spark, rows, tmp_path):
    """One file in one split, in many, and in splits without any record's start."""
    want = made_bam(tmp_path / "many.bam")
    found = []
    for size in (128 << 20, 150_000, 3_000):
        refs, aln = readers.read_bam(spark, f"{tmp_path}/many.bam", split_bytes=size)
        assert rows(refs) == [(0, "c1", 1 << 20), (1, "c2", 1 << 20), (2, "c3", 1 << 20)]
        assert sorted(tuple(r) for r in aln.collect()) == want
        found.append(aln.rdd.getNumPartitions())
    assert found[0] < found[1] < found[2]


def test_bam_columns_and_filters(spark, rows, tmp_path, monkeypatch):
    want = made_bam(tmp_path / "many.bam", 800)
    _, aln = readers.read_bam(spark, f"{tmp_path}/many.bam", columns=("pos", "ref_id", "mapq"), split_bytes=20_000)
    assert aln.columns == ["ref_id", "pos", "mapq"]
    assert rows(aln.where("ref_id in (0, 2) and mapq > 30")) == sorted((r[2], r[3], r[4]) for r in want if r[2] in (0, 2) and r[4] > 30)
    assert rows(aln) == sorted((r[2], r[3], r[4]) for r in want)
    _, some = readers.read_bam(spark, f"{tmp_path}/many.bam", ("read_name", "mapq"), {"ref_id": (0, None), "pos": (1000, 900_000), "mapq": (None, 30)})
    assert rows(some) == sorted((r[0], r[4]) for r in want if r[2] >= 0 and 1000 <= r[3] <= 900_000 and r[4] <= 30)
    for wrong in ({"columns": ("place",)}, {"where": {"seq": (1, 2)}}):
        with pytest.raises(ValueError, match="no such columns"):
            readers.read_bam(spark, f"{tmp_path}/many.bam", **wrong)

    # what is not asked for is not made
    def never(*a):
        raise AssertionError

    data = record("r1", 65, 0, 10, 60, 1, 5, [(4, "M")], "ACGT", "IIII")
    for name in ("_gather", "_or_star", "_strings"):
        monkeypatch.setattr(bam, name, never)
    assert bam.decoded(data, [0], ("pos", "mapq"), {"mapq": (60, 60)}).to_pylist() == [{"pos": 10, "mapq": 60}]


def test_bam_written_and_read_again(spark, rows, tmp_path):
    want = made_bam(tmp_path / "a.bam", 600)
    refs, aln = readers.read_bam(spark, f"{tmp_path}/a.bam", split_bytes=100_000)
    bam.write_bam(aln, refs, f"{tmp_path}/out", by_place=True)
    again, back = readers.read_bam(spark, f"{tmp_path}/out", split_bytes=20_000)
    assert rows(again) == rows(refs)
    assert sorted(tuple(r) for r in back.collect()) == want
    with pytest.raises(FileExistsError):
        bam.write_bam(aln, refs, f"{tmp_path}/out")
    # stretches of other places are not read
    for ref, pos in (((1, 1), (1000, 50_000)), ((-1, -1), (None, None)), ((None, 0), (None, None)), ((1, None), (5000, None)), ((2, 1), (None, None))):
        _, part = readers.read_bam(spark, f"{tmp_path}/out", ("read_name",), {"ref_id": ref, "pos": pos}, 20_000)
        inside = lambda v, r: (r[0] is None or r[0] <= v) and (r[1] is None or v <= r[1])
        assert rows(part) == sorted((r[0],) for r in want if inside(r[2], ref) and inside(r[3], pos))
        assert pos[1] is None or part.rdd.getNumPartitions() * 3 <= back.rdd.getNumPartitions()
    # columns that are missing count as absent
    bam.write_bam(aln.select("read_name", "ref_id", "pos"), refs, f"{tmp_path}/few")
    assert rows(readers.read_bam(spark, f"{tmp_path}/few")[1], "read_name", "flag", "mapq", "seq", "next_pos") == sorted((r[0], 4, 0, "*", -1) for r in want)


def test_empty_and_broken_bam(spark, rows, tmp_path):
    (tmp_path / "e.bam").write_bytes(block(b"BAM\x01" + struct.pack("<ii", 0, 0)) + block(b""))
    refs, aln = readers.read_bam(spark, f"{tmp_path}/e.bam")
    assert rows(refs) == [] and rows(aln) == []
    whole = bam_bytes()
    (tmp_path / "cut.bam").write_bytes(whole[:-60])
    with pytest.raises(Exception, match="follow|cut off"):
        readers.read_bam(spark, f"{tmp_path}/cut.bam")[1].collect()
    (tmp_path / "two").mkdir()
    (tmp_path / "two/a.bam").write_bytes(whole)
    (tmp_path / "two/b.bam").write_bytes((tmp_path / "e.bam").read_bytes())
    with pytest.raises(ValueError, match="different references"):
        readers.read_bam(spark, f"{tmp_path}/two")


def test_filter_and_partition_jobs(spark, rows, tmp_path):
    (tmp_path / "c.fa").write_text(">c1\n" + "A" * 40 + "GATC" + "A" * 56 + "\n>c2\n" + "A" * 20 + "GATC" + "A" * 26 + "\n")
    (tmp_path / "x.sam").write_text(SAM)
    workflows.run_filter(spark, f"{tmp_path}/c.fa", f"{tmp_path}/x.sam", "DPN1", f"{tmp_path}/out")
    assert rows(spark.read.parquet(f"{tmp_path}/out/edges")) == [(0, 1, 1)]
    assert spark.read.parquet(f"{tmp_path}/out/reduced").count() == 2
    workflows.run_partition(spark, f"{tmp_path}/out/nodes", f"{tmp_path}/out/edges", 2, f"{tmp_path}/part", max_iter=2)
    assert rows(spark.read.parquet(f"{tmp_path}/part/members"), "node_id") == [(0,), (1,)]


def test_correct_job(spark, rows, tmp_path):
    import random

    rnd = random.Random(4)
    n = 4000
    (tmp_path / "c.fa").write_text(">c\n" + "".join(rnd.choice("ACGT") for _ in range(n)) + "\n")
    lines = ["@SQ\tSN:c\tLN:4000"]
    for k in range(6000):
        p = rnd.randrange(0, n - 900)
        q = p + rnd.randrange(0, 800)
        if (p < 2000) == (q < 2000):  # nothing reaches over the middle
            lines += [f"r{k}\t65\tc\t{p + 1}\t60\t1M\t=\t{q + 1}\t0\tA\tI", f"r{k}\t129\tc\t{q + 1}\t60\t1M\t=\t{p + 1}\t0\tA\tI"]
    (tmp_path / "x.sam").write_text("\n".join(lines) + "\n")
    workflows.run_correct(spark, f"{tmp_path}/c.fa", f"{tmp_path}/x.sam", f"{tmp_path}/out", wide=100, narrow=20, depletion=400)
    found = rows(spark.read.parquet(f"{tmp_path}/out/mismatches"), "start", "end")
    assert any(a <= 2000 <= b + 40 for a, b in found)
    text = "".join(p.read_text() for p in sorted((tmp_path / "out/corrected").glob("part-*")))
    assert "".join(x for x in text.split("\n") if not x.startswith(">")) == (tmp_path / "c.fa").read_text().split("\n")[1]


def test_fixed_decimals_are_those_of_the_exact_value(spark):
    import random
    import struct

    from pyspark.sql import functions as F

    from contactloom.functions.text import fixed_15

    rnd = random.Random(31)
    values = [0.2318840579710145, 1.6363636363636365, 0.5, 0.0, -0.0, 1 / 3, -2 / 3, 5e-324, 2**-50, 3 * 2**-51, 0.9999999999999999, 1e-15, 5e-16, 1.5e-15, 2.5e-15, 123456789.987654321, 2.0**52 + 0.5]
    values += [rnd.randrange(1, 5000) / ((rnd.randrange(1, 400) + rnd.randrange(1, 400)) / 2.0) for _ in range(4000)]
    values += [rnd.randrange(2**53) * 2.0**-rnd.randrange(45, 110) for _ in range(4000)]
    # exactly halfway between two results
    values += [(2 * rnd.randrange(2**30) + 1) * 2.0**-16 for _ in range(500)]
    got = spark.createDataFrame([(struct.pack("<d", v).hex(), v) for v in values], "k string, v double").select("v", fixed_15(F.col("v")).alias("s")).collect()
    assert len(got) == len(values)
    assert [(r["v"], r["s"]) for r in got if r["s"] != "%.15f" % r["v"]] == []


def test_bam_header_of_tasks_without_rows_fits_its_blocks(spark, rows, tmp_path):
    names = [zlib.crc32(str(k).encode()) for k in range(9000)]
    refs = spark.createDataFrame([(k, f"r{n}", n >> 8) for k, n in enumerate(names)], "ref_id int, ref_name string, ref_length bigint")
    one = spark.createDataFrame([("a", 0, 8999, 5)], "read_name string, flag int, ref_id int, pos bigint").repartition(3)
    bam.write_bam(one, refs, f"{tmp_path}/few")
    brefs, got = readers.read_bam(spark, f"{tmp_path}/few", split_bytes=4096)
    assert rows(brefs) == rows(refs) and rows(got, "read_name", "ref_id", "pos") == [("a", 8999, 5)]


def test_bam_header_is_parsed_once(tmp_path):
    """A header over very many blocks takes time in proportion to its size."""
    refs = [(f"contig{k}", k) for k in range(60_000)]
    data = b"BAM\x01" + struct.pack("<i", 0) + struct.pack("<i", len(refs)) + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", k) for n, k in refs)
    (tmp_path / "x.bam").write_bytes(b"".join(block(data[k : k + 600]) for k in range(0, len(data), 600)) + block(b""))
    size, began = (tmp_path / "x.bam").stat().st_size, time.process_time()
    h = bam.Header(f"file://{tmp_path}/x.bam", size)
    assert list(h.listed()) == refs and (h.count, h.block, h.at) == (60_000, size, 0)
    assert time.process_time() - began < 5


def test_sam_lines_are_not_gathered_in_one_file(spark, monkeypatch, tmp_path):
    from contactloom import catalog

    monkeypatch.setattr(catalog, "_folder", lambda *_: f"{tmp_path}/sam")
    catalog.sam_files(spark, "/root/testdata/sf0.001")
    parts = [p.read_text().splitlines() for p in sorted((tmp_path / "sam").glob("part-*"))]
    heads, body = ([k for k, p in enumerate(parts) if any(x.startswith("@") == head for x in p)] for head in (True, False))
    assert max(heads) < min(body) and len(body) > 1
    names = [x.split("\t")[1] for k in heads for x in parts[k]]
    assert names == [f"SN:doc{k}" for k in range(len(names))]

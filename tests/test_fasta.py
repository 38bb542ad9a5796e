import random

import pytest

from contactloom.sources import fasta

SPACE = " \t\n\x0b\f\r"


def model(texts):
    """Records of files in order, line by line."""
    out = []
    for text in texts:
        open_ = False
        for line in text.split("\n"):
            line = line.rstrip(SPACE) if not line.startswith(">") else line
            if line.startswith(">"):
                out.append([line[1:].rstrip(SPACE), ""])
                open_ = True
            elif open_:
                out[-1][1] += line
    return [tuple(r) for r in out]


def made(rnd):
    text = rnd.choice(("", "junk\n", "\n\n"))
    for k in range(rnd.randrange(6)):
        text += ">" + rnd.choice(("c", "a > name ", "", "long header " * 4)) + str(k) + rnd.choice(("\n", " \r\n"))
        for _ in range(rnd.randrange(4)):
            text += "".join(rnd.choices("ACGT >", (9, 9, 9, 9, 1, 1), k=rnd.randrange(25))).lstrip(">") + rnd.choice(("\n", "  \n", " \t\r\n", "\n\n"))
    return text.rstrip("\n") if rnd.random() < 0.3 else text


@pytest.mark.parametrize("keep_empty", [True, False])
def test_cut_at_every_place(spark, rows, tmp_path, keep_empty):
    """Ranges of few bytes, so that headers, line ends and white space lie across their borders."""
    rnd = random.Random(5)
    texts = [made(rnd) for _ in range(12)]
    (tmp_path / "x").mkdir()
    for k, t in enumerate(texts):
        (tmp_path / f"x/{k:02d}.fa").write_bytes(t.encode())
    want = [r for r in model(texts) if keep_empty or r[1]]
    assert len(want) > 10
    for size in (3, 10, 1 << 20):
        contigs, chunks = fasta.read_chunks(spark, f"{tmp_path}/x", keep_empty, split_bytes=size)
        assert rows(contigs) == [(k, n, len(s)) for k, (n, s) in enumerate(want)]
        joined = {}
        for k, start, seq in rows(chunks):
            joined[k] = joined.get(k, "") + seq
            assert len(joined[k]) == start + len(seq)
        assert joined == {k: s for k, (_, s) in enumerate(want) if s}
        assert rows(fasta.read_fasta(spark, f"{tmp_path}/x", keep_empty, split_bytes=size)) == [(k, n, s, len(s)) for k, (n, s) in enumerate(want)]


def test_slices_alone(tmp_path):
    """Counting and reading by slices of every size equals reading line by line."""
    rnd = random.Random(6)
    for _ in range(300):
        text = made(rnd).encode()
        if not text:
            continue
        (tmp_path / "a.fa").write_bytes(text)
        size = rnd.randrange(1, 12)
        ranges = [("a", len(text), a, min(a + size, len(text))) for a in range(0, len(text), size)]
        counts, found = {}, []
        with open(tmp_path / "a.fa", "rb") as f:
            for _, n, a, b in ranges:
                s = fasta.Slice(f, a, b, n)
                p, h = list(s.pieces(False)), list(s.pieces(True)) if not s.fresh else [(None, b"")]
                counts["a", a] = {"bases": len(p[0][1]), "header_bases": len(h[0][1]), "begun": len(p) - 1, "tail": len(p[-1][1]), "empty": sum(not x for _, x in p[1:-1]), "open_line": s.open_line()}
            for e in fasta._entries(ranges, counts):
                _, n, a, b, in_header, going, record, at, *_ = e
                for k, (name, bases) in enumerate(fasta.Slice(f, a, b, n).pieces(in_header)):
                    if k or going:
                        if name is not None:
                            found.append([name.decode().rstrip(SPACE), ""])
                        assert record + k == len(found) - 1 and (k or at == len(found[-1][1]))
                        found[-1][1] += bases.decode()
        assert [tuple(r) for r in found] == model([text.decode()])


def test_long_records_are_chunks(spark, rows, tmp_path):
    """Records longer than a range, on one line and on many; no exchange holds a sequence."""
    rnd = random.Random(7)
    a, b = ("".join(rnd.choices("ACGT", k=n)) for n in (300_000, 200_001))
    (tmp_path / "l.fa").write_text(f">one line\n{a}\n>many lines\n" + "\n".join(b[k : k + 60] for k in range(0, len(b), 60)) + "\n>none\n")
    contigs, chunks = fasta.read_chunks(spark, f"{tmp_path}/l.fa", split_bytes=50_000)
    assert rows(contigs) == [(0, "one line", len(a)), (1, "many lines", len(b)), (2, "none", 0)]
    got = rows(chunks)
    assert len(got) > 9 and max(len(r[2]) for r in got) <= 50_000
    assert "".join(r[2] for r in got if r[0] == 0) == a and "".join(r[2] for r in got if r[0] == 1) == b
    assert "Exchange" not in chunks._jdf.queryExecution().executedPlan().toString()


def test_empty_file(spark, rows, tmp_path):
    (tmp_path / "e.fa").write_text("")
    contigs, chunks = fasta.read_chunks(spark, f"{tmp_path}/e.fa")
    assert rows(contigs) == [] and rows(chunks) == []

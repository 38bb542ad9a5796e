import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from contactloom.llm import exact_dedup as ed
from contactloom.llm import queries


def model(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[t or ""].append(i)
    out = []
    for ids in groups.values():
        real = [i for i in ids if i is not None]
        keep = max(real) if real else None
        seen = False
        for i in sorted(ids, key=lambda x: (x is not None, x or 0)):
            stays = i == keep and not seen
            seen |= stays
            out.append((i, keep, len(ids), stays))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in ed.exact_dedup(df).collect()), key=str)


@pytest.mark.parametrize("group_rows", [1000, 3])
def test_against_grouping(documents, edge_pairs, monkeypatch, group_rows):
    """With a small bound the salted comparison of hot groups is used."""
    monkeypatch.setattr(ed, "GROUP_ROWS", group_rows)
    rnd = random.Random(1)
    pairs = edge_pairs + [(100 + k, f"text number {rnd.randrange(60)} " * rnd.randrange(3)) for k in range(400)] + [(1000 + k, "hot") for k in range(200)] + [(None, "hot")] * 40
    # ids that all are null, and one id that rows repeat
    pairs += [(None, "no id")] * 90 + [(7000, "one id")] * 90 + [(k % 3 or None, "few ids") for k in range(90)]
    assert result(documents(pairs, clash=True)) == model(pairs)


def test_empty_table(documents):
    assert result(documents([])) == []


def test_hashes_compose():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 3 * ed.CHUNK + 77, np.uint8)
    for k, (p, x) in enumerate(zip(ed.PRIMES, ed.BASES, strict=True)):
        direct = 0
        for b in data.tolist():
            direct = (direct * x + b + 1) % p
        assert ed.fingerprint(data)[k] == direct
        for cut in (0, 1, ed.CHUNK, ed.CHUNK + 5, len(data)):
            parts = [ed.fingerprint(data[:cut])[k], ed.fingerprint(data[cut:])[k]]
            assert ed.combine(*parts, len(data) - cut, k) == direct
    assert ed.fingerprint(data[:0]) == (0, 0)


def test_colliding_texts_stay_apart():
    texts = ["aa", "bb", "aa", "bb", "cc"]
    batch = pa.RecordBatch.from_pydict({"h1": [1] * 5, "h2": [1] * 5, "n": [2] * 5, "salt": [0] * 5, "i": [1, 2, 3, 3, 4], "t": texts, "hot": [False] * 5})
    out = list(ed._classes(iter([batch.slice(0, 2), batch.slice(2)])))
    assert [c for b in out for c in b.column("c").to_pylist()] == [0, 1, 0, 1, 2]


def test_query_digests(spark, tmp_path, documents):
    pairs = [(1, "ä"), (2, "ä"), (3, None)]
    documents(pairs).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r.asDict() for r in queries.op4_exact_dedup(spark, str(tmp_path)).collect()}
    assert got[1]["keep_id"] == 2 and not got[1]["kept"] and got[2]["kept"] and got[2]["group_size"] == 2
    assert got[3]["text_sha256"] == hashlib.sha256(b"").hexdigest() and got[1]["text_sha256"] == hashlib.sha256("ä".encode()).hexdigest()

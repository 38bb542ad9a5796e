import hashlib
import random

import sentencepiece

from contactloom.llm import queries
from contactloom.llm.queries import tokenizer_path
from contactloom.llm.sentencepiece_codec import ChunkTable, sentencepiece_round_trip

FILE = tokenizer_path("piece_bpe_32k.model")


def test_chunks_equal_the_library():
    m = sentencepiece.SentencePieceProcessor(model_file=FILE)
    rnd = random.Random(3)
    alphabet = ["a", "the", "Z", " ", "  ", "   ", "\n", "\t", "▁", "▁▁", "é", "ß", "漢", "😀", "\u2003", "\x00", "1", "<s>", "</s>", "<0x41>", "."]
    texts = ["", " ", "  ", "▁", "\n", "a ", " a", "a  b   ", "<unk>"] + ["".join(rnd.choices(alphabet, k=rnd.randrange(1, 40))) for _ in range(600)]
    ids, decoded = ChunkTable(FILE)(texts)
    for t, i, d in zip(texts, ids, decoded, strict=True):
        want = m.encode(t)
        assert list(memoryview(i).cast("i")) == want, repr(t)
        assert d == m.decode(want), repr(t)


def test_round_trip_of_a_table(documents, edge_pairs):
    m = sentencepiece.SentencePieceProcessor(model_file=FILE)
    got = sentencepiece_round_trip(documents(edge_pairs, clash=True), FILE).collect()
    want = sorted((str(i), m.encode(t or "")) for i, t in edge_pairs)
    assert sorted((str(r["doc_id"]), list(r["ids"])) for r in got) == want
    assert sentencepiece_round_trip(documents([]), FILE).count() == 0


def test_query_digests(spark, tmp_path, documents):
    documents([(1, "Hello  wörld"), (2, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    m = sentencepiece.SentencePieceProcessor(model_file=FILE)
    ids = m.encode("Hello  wörld")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = sorted(tuple(r) for r in queries.op2_sentencepiece(spark, str(tmp_path)).collect())
    assert got == [(1, len(ids), sha(",".join(map(str, ids))), sha("Hello  wörld")), (2, 0, sha(""), sha(""))]

"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the model reaches from a character into a following white space
mark, so a text falls into chunks, a run of marks and what follows it, that are
segmented independently.  Each task makes a table of the distinct chunks of the
rows at hand, segments each once, and joins ids back by position.  A table of
the whole corpus would need every word occurrence shuffled (several times the
size of the input) or a broadcast that grows with the corpus, so the table is
per task, and a worker remembers a bounded number of chunks.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom.llm.tables import col, field_type, leaving_little
from contactloom.llm.tokens import Remembered

MARK = "▁"
CHUNKS = re.compile(f"{MARK}+[^{MARK}]*")


class ChunkTable:
    """chunk -> (ids, text) for one model file."""

    def __init__(self, file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=file)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in names):
            raise ValueError("a piece of this model crosses a white space mark")
        if self.model.encode("a a") != self.model.encode("a") * 2 or self.model.encode(" a") == self.model.encode("a"):
            raise ValueError("this model needs a dummy prefix and must keep white space")
        self.mark_id = self.model.piece_to_id(MARK)
        self.known = Remembered(self.learn)

    @classmethod
    @cache
    def of(cls, file: str) -> ChunkTable:
        return cls(file)

    def learn(self, chunks: set[str]) -> dict[str, tuple[bytes, str]]:
        todo = sorted(chunks)
        # the library puts the first mark itself; nothing but that mark would encode as nothing
        ids = self.model.encode([c[1:] for c in todo], num_threads=1)
        ids = [i if c != MARK else [self.mark_id] for i, c in zip(ids, todo, strict=True)]
        texts = self.model.decode(ids, num_threads=1)
        return {c: (np.array(i, "<i4").tobytes(), " " + t) for c, i, t in zip(todo, ids, texts, strict=True)}

    def __call__(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """For each text its ids (little-endian 32-bit) and their decoding."""
        split = [CHUNKS.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        known = self.known.covering(set().union(*split))
        found = [[known[c] for c in s] for s in split]
        # decoding drops the mark that encoding put in front
        return [b"".join([f[0] for f in s]) for s in found], ["".join([f[1] for f in s])[1:] for s in found]


def sentencepiece_round_trip(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text as the library does, then decode the ids.

    Returns ``id_col``, ``ids`` (array<int>, without begin or end ids) and
    ``decoded``, a row per input row; a null text counts as empty and has no
    ids.  Repeated rows and null ids are rows like others, an empty table gives
    none.  A text of any length is encoded whole, word by word.  Only the two
    named columns are read.
    """

    def run(batches):
        table = ChunkTable.of(model_file)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                ids, decoded = table(part.column("t").to_pylist())
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(i) // 4 for i in ids], out=offsets[1:])
                values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                yield pa.RecordBatch.from_pydict({"i": part.column("i"), "ids": pa.ListArray.from_arrays(pa.array(offsets), values), "decoded": pa.array(decoded, pa.string())})

    src = docs.select(col(id_col).alias("i"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("t"))
    return src.mapInArrow(leaving_little(run, lambda: ChunkTable.of(model_file).known.rest()), f"i {field_type(docs, id_col)}, ids array<int>, decoded string").withColumnRenamed("i", id_col)

"""Personal data: patterns, and spans that a trained tagger adds."""

from __future__ import annotations

import hashlib
import inspect
import re

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from contactloom.llm import pii_tagger
from contactloom.llm.pii_tagger import KINDS
from contactloom.llm.tables import col, leaving_little
from contactloom.session import shared_dir

DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
CUE = re.compile(r"[0-9@]")
#: An address whose signs may be spelled out; no address is longer than ADDRESS (RFC 5321).
_WORD, _DOT, _AT = (r"[A-Za-z0-9_%+-]+", *(rf"(?:{sign}|\s+{word}\s+|\s*[\[({{]\s*{word}\s*[\])}}]\s*|\x20{sign}\x20)" for sign, word in ((r"\.", "dot"), ("@", "at"))))
SPELLED = re.compile(rf"(?<![A-Za-z0-9_%+-]){_WORD}(?:{_DOT}{_WORD})*{_AT}{_WORD}(?:{_DOT}{_WORD})+", re.IGNORECASE)
ADDRESS = 254
#: A run of characters that keys and tokens are made of.
RUN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-+/.")
#: Digits of a card number, and of any number with a telephone's signs.
CARD_DIGITS, PHONE_DIGITS = range(13, 20), range(9, 16)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the patterns, sorted by start, then kind; linear in the text."""
    out = []
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((0, start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    for m in IP.finditer(text):
        if all(len(x.lstrip("0")) < 4 and int(x) <= 255 for x in m.group().split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m.group()) if m.end() - m.start() < 64 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((3, *m.span()))
    return sorted(out, key=lambda s: (s[1], s[0], s[2]))


def whole_run(text: str, x: int, y: int) -> tuple[int, int]:
    """The span stretched over the run of key characters that it lies in, without marks at its end."""
    while x > 0 and text[x - 1] in RUN:
        x -= 1
    while y < len(text) and text[y] in RUN:
        y += 1
    while y > x and text[y - 1] in ".-/":
        y -= 1
    while text[y : y + 1] == "=":
        y += 1
    return x, y


def addresses(text: str, x: int, y: int) -> list[tuple[int, int]]:
    """The whole addresses, signs spelled out or not, that meet a span."""
    at = max(0, x - ADDRESS)
    found = ((at + m.start(), at + m.end()) for m in SPELLED.finditer(text[at : y + ADDRESS]))
    return [(a, z) for a, z in found if a < y and x < z]


def settled(text: str, kind: int, x: int, y: int) -> list[tuple[int, int, int]]:
    """What a tagged stretch stands for: whole values, or nothing where its kind's form is not met.

    A secret is the whole run of key characters that its tags lie in, of any
    length; so is what was tagged as an address inside of a run without any of
    an address's signs.  An address has a local part, a sign and a domain; a
    card number passes the check of its digits.
    """
    while x < y and text[x].isspace():
        x += 1
    while y > x and (text[y - 1].isspace() or text[y - 1] in ".,;:!"):
        y -= 1
    if x == y:
        return []
    name, value = KINDS[kind], text[x:y]
    if name == "email":
        if found := addresses(text, x, y):
            return [(kind, a, z) for a, z in found]
        if not all(c in RUN for c in value):
            return []
        a, z = whole_run(text, x, y)
        mixed = any(c.isdigit() for c in text[a:z]) and any(c.isalpha() for c in text[a:z])
        return [(KINDS.index("secret"), a, z)] if z - a >= 20 and mixed else []
    if name == "secret":
        return [(kind, *whole_run(text, x, y))]
    cuts = text[x - 1 : x].isdigit() and value[:1].isdigit() or text[y : y + 1].isdigit() and value[-1:].isdigit()
    digits = NOT_DIGIT.sub("", value)
    fits = {"card": len(digits) in CARD_DIGITS and luhn(digits), "phone": len(digits) in PHONE_DIGITS, "ip": value.count(".") >= 3 or value.count(":") >= 2}[name]
    return [(kind, x, y)] if fits and not cuts else []


def find_spans(texts: list[str], weights: dict) -> list[tuple[list, list]]:
    """For each text its base spans and all spans, (kind, start, end).

    The tagger reads every character.  A span that it adds, but for a secret,
    is dropped where it overlaps a base span.
    """
    secret = KINDS.index("secret")
    out = []
    for t, tagged in zip(texts, pii_tagger.tag_texts(weights, texts), strict=True):
        base = base_spans(t) if CUE.search(t) else []
        found = {s for kind, x, y in tagged for s in settled(t, kind, x, y)}
        secrets = [s for s in found if s[0] == secret and (secret, s[1], s[2]) not in base]
        inside = lambda s: any(s[1] < q and p < s[2] for _, p, q in secrets)  # noqa: E731, B023
        more = [s for s in found if s[0] != secret and not any(s[1] < q and p < s[2] for _, p, q in base) and not inside(s)]
        out.append((base, sorted({*base, *secrets, *more}, key=lambda s: (s[1], s[0], s[2]))))
    return out


def weights_for(spark: SparkSession) -> dict[str, np.ndarray]:
    """The tagger's weights: trained once and kept in the shared folder under a hash of the code."""
    source = inspect.getsource(pii_tagger).encode()
    place = f"{shared_dir(spark)}/tagger-{hashlib.sha256(source + np.__version__.encode()).hexdigest()[:32]}.parquet"
    try:
        rows = spark.read.parquet(place).collect()
    except AnalysisException:
        rows = []
    if not rows:
        made = pii_tagger.trained()
        table = spark.createDataFrame([(k, list(v.shape), v.astype("<f4").tobytes()) for k, v in made.items()], "name string, shape array<int>, data binary")
        table.coalesce(1).write.mode("ignore").parquet(place)
        return made
    return {r["name"]: np.frombuffer(r["data"], "<f4").reshape(r["shape"]) for r in rows}


SPANS = "array<struct<kind:string,start:int,end:int>>"


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """A row per input row: ``id_col``, ``carry`` columns, ``base_spans``, ``spans``.

    Spans are (kind, start, end) in code points, end exclusive, sorted by start
    and kind.  Base spans are those of the patterns; ``spans`` has them all and
    what the tagger adds: other writings of the same kinds, and secrets (keys,
    tokens, passwords).  Every character passes through the tagger.  A null
    text counts as empty and has none; repeated rows are tagged alike, each a
    row of its own; spans that start together are ordered by kind; an empty
    table gives none.  Only the named columns are read.
    """
    # 20 KB, whatever the input
    weights = docs.sparkSession.sparkContext.broadcast(weights_for(docs.sparkSession))
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                named = [[[{"kind": KINDS[k], "start": x, "end": y} for k, x, y in s] for s in pair] for pair in find_spans(part.column("t").to_pylist(), weights.value)]
                cols = {n: part.column(n) for n in part.schema.names if n != "t"}
                yield pa.RecordBatch.from_pydict(cols | {"base": pa.array([p[0] for p in named], pa.list_(kind)), "spans": pa.array([p[1] for p in named], pa.list_(kind))})

    carried = [(f"x{k}", name) for k, name in enumerate(carry)]
    src = docs.select(col(id_col).alias("i"), *[col(n).alias(x) for x, n in carried], F.coalesce(col(text_col).cast("string"), F.lit("")).alias("t"))
    spans = StructType.fromDDL(f"base {SPANS}, spans {SPANS}").fields
    out = src.mapInArrow(leaving_little(run), StructType([f for f in src.schema.fields if f.name != "t"] + spans))
    return out.select(F.col("i").alias(id_col), *[F.col(x).alias(n) for x, n in carried], F.col("base").alias("base_spans"), "spans")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets.

    Of overlapping spans the part after the earlier one goes as well.
    """
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a, s):
        begin = F.greatest(a["at"], s["start"])
        done = F.struct(s["end"].alias("at"), F.concat(a["out"], F.substring(text, a["at"] + 1, begin - a["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).alias("out"))
        return F.when(s["end"] > a["at"], done).otherwise(a)

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text)))))

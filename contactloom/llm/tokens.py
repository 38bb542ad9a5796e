"""Fast exact tokenization: words are encoded once and remembered.

Both tokenizers used here never merge across certain boundaries, so a text's
ids are the concatenation of its words' ids.  Each Python worker keeps a
bounded table of encoded words for the tasks it runs; between tasks it holds
the younger half of it.
"""

from __future__ import annotations

import os
import re
from functools import cache
from itertools import chain

import numpy as np

#: Words of a generation; a worker remembers two of them.
MOST_WORDS = 200_000


class Remembered:
    """Values of strings, made in bulk, of which the ones in use stay.

    New entries and those met again live in the young generation.  When it is
    full it becomes the old one, whose rest is forgotten.
    """

    def __init__(self, make):
        self.make, self.young, self.old = make, {}, {}

    def covering(self, wanted: set[str]) -> dict:
        """A table that holds all of ``wanted``."""
        missing = wanted.difference(self.young)
        if len(self.young) + len(missing) > MOST_WORDS:
            self.old, self.young = self.young, {}
            missing = wanted
        fresh = set()
        for w in missing:
            v = self.old.get(w)
            if v is None:
                fresh.add(w)
            else:
                self.young[w] = v
        if fresh:
            self.young.update(self.make(fresh))
        return self.young

    def rest(self) -> None:
        """Forget the old generation, as a worker does that waits for its next task."""
        self.old = {}


class WordEncoder:
    """Ids of whole texts by a ``tokenizers`` file whose pre-tokenizer keeps words apart.

    The words of texts in the Latin script are split here, by the file's own
    pattern; a text with any other character goes through the library whole,
    so that its normalisation rules hold to the letter.  A file that splits or
    lower-cases otherwise is an error when it is loaded.
    """

    PROBE = "It's THE probe's 4th--don't we'll É9_x (\"a.b\")...word,two;  e\u00e8\n12ab"

    # fixed values: the tokenizer file's pattern, for texts of the characters below
    SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\s\w]|_)+")
    MARKS = frozenset(".,;:!?)")
    # printable ASCII with white space, and the letters of Latin-1 that stand for themselves
    PLAIN = re.compile("[\\x09-\\x0d\\x20-\\x7e\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff]*")

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(file)
        self.words, self.strings = Remembered(self.learn), Remembered(self.compose)
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added)) or "(?!)")
        vocab = self.library.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        for piece, i in vocab.items():
            self.ends[i] = piece.endswith("</w>")
        want = self.library.encode(self.PROBE, add_special_tokens=False).ids
        if np.frombuffer(self([self.PROBE])[0], "<u4").tolist() != want:
            raise ValueError("this tokenizer file does not split words as is done here")

    @classmethod
    @cache
    def of(cls, file: str) -> WordEncoder:
        return cls(file)

    def rest(self) -> None:
        self.words.rest()
        self.strings.rest()

    def whole(self, text: str) -> np.ndarray:
        """The library's ids, without the places in the text that it would otherwise track."""
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Encode new words, many in one call; a word's last piece carries the end mark."""
        todo, out = sorted(words), {}
        for at in range(0, len(todo), 2000):
            part = todo[at : at + 2000]
            ids = self.whole(" ".join(part))
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(part):
                start = 0
                for w, c in zip(part, cuts.tolist(), strict=True):
                    out[w] = ids[start:c].tobytes()
                    start = c
            else:
                for w in part:
                    out[w] = self.whole(w).tobytes()
        return out

    def compose(self, strings: set[str]) -> dict[str, bytes]:
        """Ids of strings between white space from those of their words."""
        plain = {s for s in strings if s.isalpha()}
        # a word and one mark, the most frequent of the others
        marked = {s for s in strings - plain if s[-1] in self.MARKS and s[:-1].isalpha()}
        split = {s: self.SPLIT.findall(s) for s in strings - plain - marked}
        wanted = plain | {s[:-1] for s in marked} | {s[-1] for s in marked} | set(chain.from_iterable(split.values()))
        get = self.words.covering(wanted)
        out = {s: get[s] for s in plain} | {s: get[s[:-1]] + get[s[-1]] for s in marked}
        out.update({s: b"".join([get[w] for w in words]) for s, words in split.items()})
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        split = [t.lower().split() if self.PLAIN.fullmatch(t) and not self.special.search(t) else None for t in texts]
        get = self.strings.covering(set().union(*(w for w in split if w is not None))).__getitem__
        return [self.whole(t).tobytes() if w is None else b"".join(map(get, w)) for t, w in zip(texts, split, strict=True)]

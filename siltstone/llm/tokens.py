"""Token ids of whole texts by a tokenizer of the tokenizers library.

A pre-tokenizer that drops white space never joins what ASCII white space
parts, so texts are cut there and each distinct piece is encoded once a batch;
frequent pieces stay in a bounded cache.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

from siltstone.llm.common import AT_END, windows

VOCABULARY = "word_bpe_49k.json"
#: Code points that are encoded at once.
WINDOW = 1 << 22


def default_path() -> str:
    """The tokenizer file that queries use unless they are given another."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, without special tokens.

    If the tokenizer lower-cases, so are A-Z before texts are cut, which leaves
    fewer distinct pieces. Texts that then hold an added token are encoded
    whole, as those are looked for before lower-casing.
    """

    def __init__(self, path: str, capacity: int = 400_000, kept: int = 150_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.capacity, self.kept = capacity, kept
        self.known: dict[bytes, bytes] = {}
        self.again: set[bytes] = set()  # pieces of several batches
        made = json.loads(self.tokenizer.to_str())
        self.lowers = '"Lowercase"' in json.dumps(made.get("normalizer"))
        self.added = [t["content"].lower().encode() for t in made["added_tokens"]]
        # Pieces of plain letters (A-Z and those of Latin-1) with points or commas after them are one or two words to the pre-tokenizer, and each word ends in an id with the end-of-word mark.
        mark = made["model"].get("end_of_word_suffix")
        self.plain = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+([.,]*)").fullmatch if mark else None
        self.last = np.zeros(self.vocabulary + 1, bool)
        self.last[[i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if mark and t.endswith(mark)]] = True

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def learn(self, new: Iterable[bytes]) -> None:
        """Encodes pieces: plain words many at a time, as one text that is cut again at ends of words, with what the points and commas after them give; the others one by one."""
        words, after, rest = [], [], []
        if self.plain:
            words = [p for p in new if p.isalpha()]  # A-Z alone: most pieces
            new = set(new).difference(words)
        for piece in new:
            found = self.plain and self.plain(piece)
            if not found:
                rest.append(piece)
            elif found[1]:
                after.append((piece, found.start(1)))
            else:
                words.append(piece)
        cores = {p[:n] for p, n in after}.difference(words, self.known)
        words += cores
        for i in range(0, len(words), 4096):
            some = words[i : i + 4096]
            ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.last[ids])
            if len(ends) != len(some):
                rest += some
                continue
            ends, data = (4 * (ends + 1)).tolist(), ids.tobytes()
            self.known.update(zip(some, [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)], strict=True))
        rest += {p[n:] for p, n in after}.difference(self.known)
        for piece, found in zip(rest, self.tokenizer.encode_batch_fast([p.decode() for p in rest], add_special_tokens=False), strict=True):
            self.known[piece] = np.array(found.ids, "<u4").tobytes()
        known = self.known
        for piece, n in after:
            known[piece] = known[piece[:n]] + known[piece[n:]]

    def encode(self, texts: list[str], end: int | None = None) -> Iterator[bytes]:
        """Each text's ids as bytes, with the id end after them if given. Long texts are encoded in windows that end at white space, unless one word fills a window."""
        tail, at = b"" if end is None else end.to_bytes(4, "little"), 0
        while at < len(texts):
            if len(texts[at]) > WINDOW:
                parts = list(windows(texts[at], WINDOW))
                apart = all(p[-1] in " \t\n\v\f\r" for p in parts[:-1])
                yield b"".join(x for p in parts for x in self._some([p])) + tail if apart else next(self._some(texts[at : at + 1])) + tail
                at += 1
                continue
            upto, size = at, 0
            while upto < len(texts) and len(texts[upto]) <= WINDOW and (upto == at or size < WINDOW):
                size += len(texts[upto])
                upto += 1
            for ids in self._some(texts[at:upto]):
                yield ids + tail
            at = upto

    def _some(self, texts: list[str]) -> Iterator[bytes]:
        split: list[list[bytes] | None] = []
        for text in texts:
            data = text.encode()
            low = data.lower()
            if any(t in low for t in self.added):
                split.append(None)
            else:
                split.append((low if self.lowers else data).split())
        every = set().union(*filter(None, split))
        if len(self.again) < self.kept:
            self.again |= self.known.keys() & every
        self.learn(every.difference(self.known))
        for text, words in zip(texts, split, strict=True):
            if words is None:
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            else:
                yield b"".join(map(self.known.__getitem__, words))
        if len(self.known) > self.capacity:
            self.shrink()

    def shrink(self) -> None:
        """Forgets all pieces but those that several batches had."""
        self.known = {p: self.known[p] for p in self.again if p in self.known}


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a worker and file; workers are used again by later tasks, which start with the pieces that shrink() leaves."""
    made = Encoder(path)
    AT_END.append(made.shrink)
    return made

"""Token ids of whole texts by the tokenizers library, each distinct pre-token encoded once.

Both vocabularies split a text before they merge: no merge crosses a border between white space and the rest. So a
text's ids are those of its chunks in order, and a chunk's ids are the same wherever it stands. Chunks met before
come from a table of bounded size; the library encodes the others, a batch at a time.
"""

from __future__ import annotations

import re
from itertools import chain, compress
from unicodedata import is_normalized

import numpy as np

#: Unicode White_Space, as the library's patterns have it.
_WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: "byte": a chunk takes one space before it along, and other white space is a chunk of its own; "word": white space goes.
CHUNKS = {
    "byte": re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+").findall,
    "word": re.compile(f"[^{_WS}]+").findall,
}
#: Chunks remembered at most, about 200 bytes each. When the table is full, those met most often since the last time stay,
#: half of it at most.
MOST = 1_000_000
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_chars() -> dict[int, int]:
    """Byte-level BPE writes printable Latin-1 bytes as themselves and the others, in order, from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(rest)}


_BYTE_CHARS = _byte_chars()


class _Index(dict):
    def __init__(self):
        self.new = []

    def __missing__(self, chunk):
        self[chunk] = at = len(self)
        self.new.append(chunk)
        return at


class Encoder:
    def __init__(self, path: str, kind: str, most: int | None = None):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = False
        self.most = most or MOST
        self.model, self.kind, self.find, self.marks = self.library.model, kind, CHUNKS[kind], {}
        self.special = re.compile("|".join(re.escape(x.content) for x in self.library.get_added_tokens_decoder().values()) or r"(?!)")
        self.index, self.ids, self.ends = _Index(), np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.uses = np.zeros(0, np.int64)

    def _plain(self, chunk: str) -> list[int] | None:
        """The ids of a run of letters and the ASCII punctuation after it: two pre-tokens, which go to the library's
        model as they are. None for any other chunk, or one that the normalizer might change in other ways."""
        core = chunk.rstrip(_MARKS)
        marks = chunk[len(core) :]
        letters = core[1:] if core[:1] == " " else core
        if self.kind == "word":
            if "Σ" in letters or not is_normalized("NFC", letters):
                return None
            core = letters = letters.lower()
        if not letters.isalpha():
            return None
        shown = core.replace(" ", "\u0120") if core.isascii() else core.encode().decode("latin-1").translate(_BYTE_CHARS)
        out = [x.id for x in self.model.tokenize(shown)]
        if marks:
            if marks not in self.marks:
                self.marks[marks] = self.library.encode(marks, add_special_tokens=False).ids
            out += self.marks[marks]
        return out

    def _learn(self):
        if self.index.new:
            got = list(map(self._plain, self.index.new))
            other = [i for i, x in enumerate(got) if x is None]
            for i, x in zip(other, self.library.encode_batch([self.index.new[i] for i in other], add_special_tokens=False), strict=True):
                got[i] = x.ids
            size = np.fromiter(map(len, got), np.int64, len(got))
            flat = np.fromiter(chain.from_iterable(got), np.uint32, int(size.sum()))
            self.ids = np.concatenate([self.ids, flat])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(size)])
            self.index.new = []

    def _shrink(self):
        if len(self.index) <= self.most:
            return
        least = 2
        while (kept := np.flatnonzero(self.uses[: len(self.index)] >= least)).size > self.most // 2:
            least += 1
        stays = np.zeros(len(self.index), bool)
        stays[kept] = True
        index = _Index()
        index.update((chunk, k) for k, chunk in enumerate(compress(self.index, stays.tolist())))
        size = self.ends[kept + 1] - self.ends[kept]
        ends = np.concatenate([[0], np.cumsum(size)])
        self.ids = self.ids[np.repeat(self.ends[kept] - ends[:-1], size) + np.arange(int(size.sum()))]
        self.index, self.ends, self.uses = index, ends, self.uses[kept] // 2

    def encode(self, texts: list[str | None], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has; ``end`` follows each text. A text that holds a special
        token's string is encoded by the library as a whole, so its own rules for them hold."""
        at, counts, whole = [], np.zeros(len(texts), np.int64), {}
        look = self.index.__getitem__
        for i, t in enumerate(texts):
            if t and self.special.search(t):
                whole[i] = np.array(self.library.encode(t, add_special_tokens=False).ids, np.uint32)
            elif t:
                got = list(map(look, self.find(t)))
                counts[i] = len(got)
                at += got
        self._learn()
        at = np.array(at, np.int64)
        uses = np.bincount(at, minlength=len(self.index))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        size = self.ends[at + 1] - self.ends[at]
        before = np.cumsum(size) - size
        ids = self.ids[np.repeat(self.ends[at] - before, size) + np.arange(int(size.sum()))]
        chunk_end = np.concatenate([[0], np.cumsum(counts)])
        cut = np.concatenate([before, [len(ids)]])[chunk_end]
        lengths = np.diff(cut)
        if whole or end is not None:
            tail = np.zeros(0, np.uint32) if end is None else np.array([end], np.uint32)
            if whole:
                parts = []
                for i in range(len(texts)):
                    parts += [whole.get(i, ids[cut[i] : cut[i + 1]]), tail]
                    lengths[i] = len(parts[-2])
                ids = np.concatenate(parts) if parts else ids
            else:
                out = np.full(len(ids) + len(texts), end, np.uint32)
                out[np.arange(len(ids)) + np.repeat(np.arange(len(texts)), lengths)] = ids
                ids = out
            lengths = lengths + len(tail)
        self._shrink()
        return ids, lengths


_made: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, kind: str, most: int | None = None) -> Encoder:
    """One for each Python worker; it keeps its table from task to task."""
    if (path, kind) not in _made:
        _made[path, kind] = Encoder(path, kind, most)
    return _made[path, kind]

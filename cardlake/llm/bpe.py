"""Byte-pair encoding helpers: exact ids, exact counts at every prefix, exact joins.

Three facts carry this module.

* A piece (what the vocabulary's pattern splits off) is matched from its own
  start forward, so a text may be cut at piece starts and encoded apart.
* A token sequence is the encoding of its bytes exactly if each neighbouring
  pair is the encoding of its own bytes. So the last token of every prefix is
  unique, and the counts of all prefixes follow by dynamic programming.
* For the same reason two encodings may be joined as soon as a re-encoded
  window around the join begins and ends with tokens of the two sides.
"""

from __future__ import annotations

import functools
import gc
import json
import re
import threading
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import accumulate

import ahocorasick
import public_tokenizers
import regex
from tokenizers import Tokenizer

BYTE_BPE = "byte_bpe_50k.json"
#: Short words that a cache holds about, and what an entry counts besides its letters and items.
CACHE, ENTRY = 400_000, 24
LEAF = 256
#: Seconds without a batch after which a worker lets go of a vocabulary and its words.
IDLE_S = 5.0
#: Beyond these characters the library itself splits the text: word classes differ between versions of Unicode.
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa1-\xac\xae-ɏ]")
#: A space after other white space, or white space at the end: pieces then reach over spaces.
ODD_SPACE = re.compile(r"\s |\s\Z")


def _byte_letters() -> str:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return "".join(chr(b if b in shown else 256 + rest.index(b)) for b in range(256))


LETTERS = _byte_letters()


class Memo(dict):
    """A dictionary that makes what it lacks; when full, it keeps only what is used again.

    It is full at ``limit`` letters and items of keys and values, each entry
    counted as ``ENTRY`` more, so long words do not fill the memory.
    """

    def __init__(self, make, limit: int = CACHE * ENTRY * 2):
        super().__init__()
        self.make, self.limit, self.older, self.size = make, limit, {}, 0

    def __missing__(self, key):
        if self.size >= self.limit:
            self.older, self.size = dict(self), 0
            self.clear()
        value = self.older.get(key)
        value = self[key] = self.make(key) if value is None else value
        self.size += ENTRY + sum(len(x) for x in (key, value) if hasattr(x, "__len__"))
        return value


class ByteBpe:
    """A byte-level vocabulary file with its pieces, ids, prefix counts and decoding."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        vocab = self.library.get_vocab(with_added_tokens=False)
        self.letters_of = {i: t for t, i in vocab.items()}
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.split_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        back = {c: b for b, c in enumerate(LETTERS)}
        self.bytes_of = {i: bytes(back[c] for c in t) for t, i in vocab.items()}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.ids = Memo(self._ids)
        self.chunk = Memo(self._chunk)
        self.stable = Memo(lambda pair: self._is_stable(pair >> 20, pair & 0xFFFFF), CACHE * ENTRY)
        self.counts = Memo(self._counts)
        self.chunk_count = Memo(self._chunk_count)

    # tables that only counting needs

    @functools.cached_property
    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for i, token in self.letters_of.items():
            found.add_word(token, (len(token), i))
        found.make_automaton()
        return found

    @functools.cached_property
    def merges(self) -> tuple[dict, dict, dict]:
        """Age of each pair (merges run in this order), age and parts of each token."""
        ids = {t: i for i, t in self.letters_of.items()}
        pairs = [(ids[a], ids[b]) for a, b in json.loads(self.library.to_str())["model"]["merges"]]
        made = [ids[self.letters_of[a] + self.letters_of[b]] for a, b in pairs]
        age = dict.fromkeys(self.letters_of, -1) | {t: k for k, t in enumerate(made)}
        return {p: k for k, p in enumerate(pairs)}, age, dict(zip(made, pairs))

    # pieces

    def sections(self, text: str) -> list[tuple[str, bool]]:
        """The text cut at special tokens: (section, is it one)."""
        if self.split_special is None or not any(s in text for s in self.special):
            return [(text, False)] if text else []
        out, at = [], 0
        for m in self.split_special.finditer(text):
            out += [(text[at : m.start()], False)] * (m.start() > at) + [(m[0], True)]
            at = m.end()
        return out + [(text[at:], False)] * (at < len(text))

    def pieces(self, section: str) -> list[str]:
        if UNUSUAL.search(section):
            return [section[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(section)]
        return self.pattern.findall(section)

    def chunks(self, section: str) -> list[str] | None:
        """The section cut before spaces, if pieces do not reach over them."""
        return None if UNUSUAL.search(section) or ODD_SPACE.search(section) else section.split(" ")

    # ids

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a chunk behind a space: letters, letters and a point or comma, or anything."""
        if chunk.isalpha():
            return self._ids(" " + chunk)
        if chunk[-1] in ".," and chunk[:-1].isalpha():
            return self.chunk[chunk[:-1]] + self.ids[chunk[-1]]
        return b"".join(map(self.ids.__getitem__, self.pattern.findall(" " + chunk)))

    def _chunk_count(self, chunk: str) -> int:
        if chunk.isalpha():
            return self._counts(" " + chunk)[-1]
        if chunk[-1] in ".," and chunk[:-1].isalpha():
            return self.chunk_count[chunk[:-1]] + self.counts[chunk[-1]][-1]
        return sum(self.counts[p][-1] for p in self.pattern.findall(" " + chunk))

    def _ids(self, piece: str) -> bytes:
        return array("I", self.tree(piece.encode().decode("latin-1").translate(_TO_LETTERS))).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out = []
        for section, special in self.sections(text):
            if special:
                out.append(array("I", [self.special[section]]).tobytes())
            elif (chunks := self.chunks(section)) is not None:
                out += map(self.ids.__getitem__, self.pattern.findall(chunks[0]))
                out += map(self.chunk.__getitem__, chunks[1:])
            else:
                out += map(self.ids.__getitem__, self.pieces(section))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, array("I", ids))).decode("utf-8", "replace")

    # joins

    def plain(self, letters: str) -> list[int]:
        return [t.id for t in self.model.tokenize(letters)]

    def tree(self, letters: str) -> list[int]:
        """One unsplit piece: halves first, then joined."""
        if len(letters) <= LEAF:
            return self.plain(letters)
        half = len(letters) // 2
        return self.join(self.tree(letters[:half]), self.tree(letters[half:]))

    def join(self, a: list[int], b: list[int]) -> list[int]:
        """Re-encode growing windows around the join until both sides agree."""
        k = 4
        while True:
            left, right = a[max(0, len(a) - k) :], b[:k]
            window = self.plain("".join(self.letters_of[i] for i in left + right))
            if (k >= len(a) or window[0] == left[0]) and (k >= len(b) or window[-1] == right[-1]):
                return a[: len(a) - len(left)] + window + b[len(right) :]
            k *= 2

    # counts of prefixes

    def _is_stable(self, x: int, y: int) -> bool:
        """Whether two tokens side by side stay as they are.

        Merges are undone along their border, the latest first. A pair of
        tokens that stand there together for a while must not be one that is
        merged within that time; of equal merges the left one comes first.
        """
        merged, age_of, parts = self.merges
        until_x = until_y = len(merged)
        while True:
            age = merged.get((x, y))
            if age is not None and age < until_x and age <= until_y:
                return False
            age_x, age_y = age_of[x], age_of[y]
            if age_x > age_y:
                until_x, x = age_x, parts[x][1]
            elif age_y >= 0:
                until_y, y = age_y, parts[y][0]
            else:
                return True

    def _counts(self, piece: str) -> bytes | array:
        """The token count of each prefix of a piece, in bytes."""
        letters = piece.encode().decode("latin-1").translate(_TO_LETTERS)
        stable, last, count = self.stable, [0], [0]
        for end, (size, token) in self.automaton.iter(letters):
            if end >= len(count) - 1:  # tokens that end here come longest first; one of them is right
                start = end + 1 - size
                if not start or stable[last[start] << 20 | token]:
                    last.append(token)
                    count.append(count[start] + 1)
        return bytes(count) if max(count) < 256 else array("I", count)

    def units(self, text: str) -> tuple[list[str], list[int]]:
        """Units that the text may be cut at, with their token counts."""
        names: list[str] = []
        counts: list[int] = []
        for section, special in self.sections(text):
            if special:
                names.append(section)
                counts.append(1)
                continue
            chunks = self.chunks(section)
            first = self.pieces(section) if chunks is None else self.pattern.findall(chunks[0])
            names += first
            counts += [self.counts[p][-1] for p in first]
            if chunks is not None:
                names += [" " + c for c in chunks[1:]]
                counts += map(self.chunk_count.__getitem__, chunks[1:])
        return names, counts

    def count(self, text: str) -> int:
        total = 0
        for section, special in self.sections(text):
            chunks = None if special else self.chunks(section)
            if special:
                total += 1
            elif chunks is not None:
                total += sum(self.counts[p][-1] for p in self.pattern.findall(chunks[0]))
                total += sum(map(self.chunk_count.__getitem__, chunks[1:]))
            else:
                total += sum(self.counts[p][-1] for p in self.pieces(section))
        return total


_TO_LETTERS = {b: LETTERS[b] for b in range(256)}


class Prefixes:
    """Exact token counts of the prefixes of one text, from the counts of its units."""

    #: A prefix may change the last units before its end: those of a special token cut in two, or of white space.
    BACK = 4

    def __init__(self, bpe: ByteBpe, text: str):
        self.bpe, self.text = bpe, text
        self.names, counts = bpe.units(text)
        self.starts = [0, *accumulate(map(len, self.names))]
        self.before = [0, *accumulate(counts)]

    def at(self, chars: int, unit: int) -> int:
        """Tokens of the first ``chars`` characters; they end in the given unit."""
        back = max(0, unit - self.BACK)
        return self.before[back] + self.bpe.count(self.text[self.starts[back] : chars])

    def every(self) -> list[int]:
        """Counts at every prefix, the empty one first."""
        out = [0]
        for unit, (a, b) in enumerate(zip(self.starts, self.starts[1:])):
            out += [self.at(c, unit) for c in range(a + 1, b + 1)]
        return out

    def cut(self, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        if self.before[-1] <= budget:
            return len(self.text)
        for unit in range(self._last(budget), -1, -1):
            low, high = self.starts[unit], self.starts[unit + 1]
            for chars in range(high, low, -1) if high - low <= 64 else self._near(unit, budget):
                if self.at(chars, unit) <= budget:
                    return chars
        return 0

    def _last(self, budget: int) -> int:
        """The last unit that a prefix within the budget can end in."""
        low, high = 0, len(self.before) - 1
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.before[mid] <= budget + self.BACK else (low, mid - 1)
        return min(low, len(self.names) - 1)

    def _near(self, unit: int, budget: int) -> list[int]:
        """Ends in a long unit, longest first, that the counts inside its pieces allow."""
        at, used, found = self.starts[unit], self.before[unit], []
        for piece in self.bpe.pieces(self.names[unit]):
            counts = self.bpe.counts[piece]
            ends = accumulate(len(c.encode()) for c in piece)
            found += [at + i for i, e in enumerate(ends, 1) if used + counts[e] <= budget + self.BACK]
            at, used = at + len(piece), used + counts[-1]
        return found[::-1]


@functools.cache
def byte_bpe(path: str) -> ByteBpe:
    """The vocabulary of a file, loaded once a worker."""
    return ByteBpe(path)


_idle: threading.Timer | None = None


def _let_go() -> None:
    byte_bpe.cache_clear()
    gc.collect()  # its memories refer back to it


@contextmanager
def in_use(path: str) -> Iterator[ByteBpe]:
    """The vocabulary of a file for one batch, kept for the next one if that comes soon.

    Spark keeps idle workers for a minute; their words would lie beside what
    the stage after needs.
    """
    global _idle
    if _idle is not None:
        _idle.cancel()
    try:
        yield byte_bpe(path)
    finally:
        _idle = threading.Timer(IDLE_S, _let_go)
        _idle.daemon = True
        _idle.start()

"""Token ids of whole texts by a file of the tokenizers library, word by word.

Words of a corpus repeat. Pieces between single spaces never share a token, so the ids of a piece
are kept and a text is put together from them; a piece that is new is normalised, split and encoded
by the parts of the tokenizer itself. A plain word skips the two first parts, whose effect on single
letters is asked of the tokenizer once. The ids equal those of ``Tokenizer.encode`` with
``add_special_tokens=False``: the tokens added to the vocabulary, such as ``<|endoftext|>``, are found
in the text. With ``plain_special`` they are text as any other, as by ``encode_special_tokens=True``.
"""

from __future__ import annotations

import re
import string
import struct
import unicodedata
from array import array
from collections.abc import Callable
from functools import cache
from itertools import product

from tokenizers import Tokenizer

#: Pieces kept in a Python worker, about 200 bytes each. The memory starts anew beyond it.
KEPT_PIECES = 600_000
#: Words kept without what follows them, for the pieces that are new.
KEPT_WORDS = 50_000

#: A space at which a text can be cut: no other white space beside it.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_ASCII = string.ascii_letters
#: Texts of every kind that may stand beside the end of a line.
_SIGNS = ("a", "Z", "é", "漢", "7", ".", "-", "'s", "_", "🙂", "\u0301")
_WIDE = re.compile(r"\s\s")
#: Letters, then perhaps ASCII punctuation.
_WORD = re.compile(r"([^\W\d_]+)([!-/:-@\[-^`{-~]*)")


class _Kept(dict):
    """What ``make`` gives for a key, kept for the next time."""

    def __init__(self, make: Callable, room: int = KEPT_PIECES) -> None:
        super().__init__()
        self.make, self.room = make, room

    def __missing__(self, key: str):
        if len(self) >= self.room:
            self.clear()
        found = self[key] = self.make(key)
        return found


class WordTokenizer:
    """The tokenizer in a file; :meth:`ids` gives the ids of a text as bytes."""

    def __init__(self, path: str, room: int = KEPT_PIECES, plain_special: bool = False) -> None:
        whole = Tokenizer.from_file(path)
        whole.encode_special_tokens = plain_special
        self._whole = whole
        added = whole.get_added_tokens_decoder()
        met = {t.content: i for i, t in added.items() if not (plain_special and t.special)}
        # others than these look at what is beside them, or at the normalised text
        self._cuts = not any(
            t.normalized or t.lstrip or t.rstrip or t.single_word
            for t in added.values()
            if t.content in met
        )
        self._added = {content: struct.pack("<I", i) for content, i in met.items()}
        longest = sorted(met, key=len, reverse=True)
        self._find_added = re.compile(f"({'|'.join(map(re.escape, longest))})") if met else None
        self._normalise = whole.normalizer.normalize_str if whole.normalizer else str
        self._split = whole.pre_tokenizer.pre_tokenize_str
        self._tokenize = whole.model.tokenize
        shown = lambda text: [word for word, _ in self._split(self._normalise(text))]
        self._letters = _Kept(self._letter)
        self._lead = "".join(w for w, _ in self._split(self._normalise(" a")))[:-1]
        plain = [self._letters[c] for c in _ASCII]
        self._ascii = {_ASCII: str, _ASCII.lower(): str.lower}.get("".join(plain))
        self._lines = all(
            shown(a + "\n" + b) == shown(a) + shown("\n") + shown(b)
            for a, b in product(["", *_SIGNS], repeat=2)
        )
        self._newline = self._encode("\n")
        self._marks = _Kept(self._encode)
        self._starts = _Kept(self._start, KEPT_WORDS)
        self._words = _Kept(self._word, KEPT_WORDS)
        self._pieces = _Kept(self._piece, room)

    def _encode(self, text: str) -> bytes:
        words = self._split(self._normalise(text))
        return b"".join([self._word_ids(word) for word, _ in words])

    def _word_ids(self, word: str) -> bytes:
        return array("I", [t.id for t in self._tokenize(word)]).tobytes()

    def _letter(self, letter: str) -> str:
        """What stands for a letter within a word; nothing if it doesn't stay one letter."""
        plain = self._normalise(letter)
        if len(plain) != 1 or not plain.isalpha():
            return ""
        return "".join(word for word, _ in self._split(plain))

    def _word(self, letters: str) -> bytes:
        """Ids of letters after a space; nothing if one of them doesn't stay a letter."""
        if self._ascii and letters.isascii():
            return self._word_ids(self._lead + self._ascii(letters))
        shown = [self._letters[c] for c in letters]
        return self._word_ids(self._lead + "".join(shown)) if all(shown) else b""

    def _start(self, piece: str) -> bytes:
        """Ids of a piece that begins a text or a line."""
        plain = _WORD.fullmatch(piece)
        if plain and self._ascii and plain[1].isascii():
            return self._word_ids(self._ascii(plain[1])) + self._marks[plain[2]]
        return self._encode(piece)

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece that follows a space."""
        if piece.isalpha():
            if self._ascii and piece.isascii():
                return self._word_ids(self._lead + self._ascii(piece))
            if unicodedata.is_normalized("NFC", piece):
                return self._word(piece) or self._encode(f" {piece}")
            return self._encode(f" {piece}")
        plain = _WORD.fullmatch(piece)
        if plain and plain[1].isalpha() and plain[1].isascii() and self._ascii:
            return self._pieces[plain[1]] + self._marks[plain[2]]
        if plain and plain[1].isalpha() and unicodedata.is_normalized("NFC", piece):
            if word := self._words[plain[1]]:
                return word + self._marks[plain[2]]
        return self._encode(f" {piece}")

    def ids(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids of ``text``; of a null text none."""
        if not text:
            return b""
        if not self._cuts:
            ids = self._whole.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        if self._find_added and any(a in text for a in self._added):
            parts = self._find_added.split(text)
            return b"".join([self._added.get(p) or self._plain(p) for p in parts if p])
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        """Ids of a text, or a part of one, without added tokens."""
        pieces, starts = self._pieces, self._starts
        if _WIDE.search(text):
            first, *parts = _CUT.split(text)
            return self._encode(first) + b"".join([pieces[p] for p in parts])
        if not self._lines:
            first, *parts = text.split(" ")
            return starts[first] + b"".join([pieces[p] for p in parts])
        lines = []
        for line in text.split("\n"):
            first, *parts = line.split(" ")
            lines.append(starts[first] + b"".join([pieces[p] for p in parts]))
        return self._newline.join(lines)


@cache
def word_tokenizer(path: str, plain_special: bool = False) -> WordTokenizer:
    """One tokenizer per file and Python worker, so that tasks share the pieces they have met."""
    return WordTokenizer(path, plain_special=plain_special)

"""Token ids of a byte-level BPE file (tokenizers library), remembered per word.

The library cuts a text into pieces before it merges bytes, and a single space between two
other characters always begins a new piece.  So ids of a text are the ids of its words, each
with the space before it, one after the other; frequent words are encoded once.
"""

from __future__ import annotations

import os
import re

import numpy as np

MEMO_ENTRIES = 1_000_000
LONGEST_REMEMBERED = 64
# a letter of these blocks is a letter in every Unicode version
LAST_OLD_LETTER = "\u0530"
_BETWEEN = re.compile(r"(?<=\S)(?= \S)")
_TAIL = re.compile(r"[!-/:-@\[-`{-~]+\Z")


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for
    themselves, the others for the letters from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder(dict):
    """Maps a word to its ids as little-endian 32-bit bytes, or to None if the word can't be
    encoded by itself."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.letters = _byte_letters()

    def __missing__(self, word: str) -> bytes | None:
        core = word.removeprefix(" ")
        ids = self._word(word, core) if word == "\n" or core.split() == [core] else None
        if len(word) <= LONGEST_REMEMBERED:
            self[word] = ids
        return ids

    def _word(self, word: str, core: str) -> bytes:
        tail = _TAIL.search(core)
        letters = core[:tail.start()] if tail else core
        if not letters.isalpha() or max(letters) >= LAST_OLD_LETTER:
            return self.library(word)
        if tail:  # letters, then signs: two pieces
            cut = len(word) - len(tail[0])
            return self[word[:cut]] + self.library(word[cut:])
        piece = word.encode().decode("latin1").translate(self.letters)
        return np.array([t.id for t in self.tokenizer.model.tokenize(piece)], "<u4").tobytes()

    def library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _stretch(self, text: str) -> bytes:
        ids = self[text]
        return self.library(text) if ids is None else ids

    def _words(self, text: str) -> list[str]:
        if len(self) > MEMO_ENTRIES:
            self.clear()
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def pieces(self, text: str) -> tuple[list[str], list[bytes]]:
        """Stretches of the text and the ids of each.  Wherever a stretch ends the library ends
        a piece, whatever stands before or behind it."""
        words = self._words(text)
        ids = list(map(self.__getitem__, words))
        if None in ids or "\0" in text:
            words = _BETWEEN.split(text)
            ids = list(map(self._stretch, words))
        return words, ids

    def ids(self, text: str) -> bytes:
        try:
            if "\0" not in text:
                return b"".join(map(self.__getitem__, self._words(text)))
        except TypeError:  # a None: white space that is not a single space or line end
            pass
        return b"".join(map(self._stretch, _BETWEEN.split(text)))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This process's encoder for the vocabulary at ``path``."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]

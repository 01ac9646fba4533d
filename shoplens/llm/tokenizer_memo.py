"""Encodings of single words by a library tokenizer, remembered per worker."""

from __future__ import annotations

import os
import re


_LOADED: dict = {}


def library_tokenizer(path: str):
    """The tokenizers library's tokenizer for a file, once per worker process and
    on one thread (Spark runs one task per core)."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


def byte_characters() -> dict[int, str]:
    """Byte (as a Latin-1 code point) to the character that byte-level vocabularies
    write for it: printable bytes stand for themselves, the others for 256, 257, ..."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(256 + i) for i, b in enumerate(rest)}


class WordMemo(dict):
    """word (bytes without white space) -> ``pack(ids)`` of ``before`` + word as the
    library gives them. At most ``limit`` words are held (then all are forgotten), none
    longer than ``LONGEST`` bytes.

    Words of Latin-1 letters are one piece, which goes straight through the library's
    model; a run of punctuation after them is a piece of its own. Other words of
    printable ASCII are cut by ``pattern``, what the vocabulary's splitting pattern comes
    to on such words. All else, and words with a special string, goes through the library
    as a whole. ``pack`` must be additive. The cuts are used only if they agree with the
    library on ``PROBES``.
    """

    LONGEST = 64
    LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
    TAILED = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~]+)")
    PRINTABLE = re.compile(rb"[!-~]+")
    PROBES = ("don't", "I'LL", "a1b22,c.", "(x)", "'s", "''t", "--", "A.b'Ve", "x'", "3.14%", "'re're", "a_b", "~", "Zz''ll9",
              "straße.", "ÀÉÎÕÜß", "naïve,", "niño?!", "\u00d7", "a\u00f7b", "\u00e9|", "mañana")

    def __init__(self, path: str, pattern: str, pack, before: bytes = b"", fold=lambda s: s, limit: int = 500_000):
        super().__init__()
        self.tok = library_tokenizer(path)
        self.model, self.limit, self.before, self.fold, self.pack = self.tok.model, limit, before, fold, pack
        self.tokenize, self.space = self.model.tokenize, "Ġ" if before else ""
        special = [re.escape(t.content.encode()) for t in self.tok.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(special) or rb"(?!)").search
        self.pieces, self.characters, self.tails = re.compile(pattern).findall, byte_characters(), {}
        self.cut = True
        self.cut = all(self._made(w.encode()) == self._whole(w.encode()) for w in self.PROBES)

    def __missing__(self, word: bytes):
        value = self._made(word)
        if len(word) <= self.LONGEST:
            if len(self) >= self.limit:
                self.clear()
            self[word] = value
        return value

    def _whole(self, word: bytes):
        return self.pack(self.tok.encode((self.before + word).decode(), add_special_tokens=False).ids)

    def _piece(self, piece: str):
        written = piece.encode().decode("latin-1").translate(self.characters)
        return self.pack([t.id for t in self.tokenize(written)])

    def _made(self, word: bytes):
        if not self.cut:
            return self._whole(word)
        if word.isalpha():  # of ASCII letters: characters stand for themselves, a space for its own
            piece = self.fold(word.decode())
            return self.pack([t.id for t in self.tokenize(self.space + piece)])
        if self.LETTERS.fullmatch(word):
            return self._piece(self.fold((self.before + word).decode()))
        tailed = self.TAILED.fullmatch(word)
        if tailed and not self.special(word):
            tail = tailed[2]
            if tail not in self.tails:
                if len(self.tails) >= 10_000:
                    self.tails.clear()
                self.tails[tail] = self._piece(tail.decode())
            return self[tailed[1]] + self.tails[tail]
        if self.PRINTABLE.fullmatch(word) and not self.special(word):
            first, *rest = map(self._piece, self.pieces(self.fold((self.before + word).decode())))
            return sum(rest, first) if isinstance(first, int) else first + b"".join(rest)
        return self._whole(word)

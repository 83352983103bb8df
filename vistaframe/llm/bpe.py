"""Byte-level BPE token ids of whole texts, with a memo of words.

The pre-tokenizer of a byte-level BPE never joins characters across a single
blank or line feed that stands between two other characters: a blank opens
the next piece, a lone line feed is a piece by itself. So the ids of a text
whose white space is of that kind are the ids of its words, one after the
other, and a word met before need not be encoded again. All other texts
(runs of blanks, tabs, white space at either end) go to the tokenizer whole.
"""

from __future__ import annotations

import os
import re
import sys
import types

import numpy as np

MEMO_WORDS = 350_000  # words of one generation; those not met for a generation go
_LETTERS_THEN_MARKS = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-&(-/:-@\\[-`{-~]*)")


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the others for the
    characters from 256 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


class _Loose(Exception):
    """White space that doesn't stand alone, or of another kind."""


class _Words(dict):
    """Ids of words after a blank; with a line feed before it, of a line's first word. A word not met yet is
    looked up when it is asked for."""

    def __init__(self, learn):
        super().__init__()
        self._learn = learn

    def __missing__(self, key: str) -> bytes:
        self[key] = got = self._learn(key)
        return got


class WordMemoEncoder:
    """``encode(texts)`` gives, per text, its ids as little-endian unsigned
    32-bit integers in one ``bytes``. Equal to encoding each text whole with
    ``add_special_tokens=False``."""

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(tokenizer_file)
        self._tokenize = self._tok.model.tokenize
        self._symbols = {b: s for b, s in enumerate(byte_symbols())}
        self._feed = self._whole("\n")
        self._blank = self._symbols[ord(" ")]
        self._raw = [k.to_bytes(4, "little") for k in range(self._tok.get_vocab_size())]
        self._old: dict[str, bytes] = {}  # the generation before
        self._marks: dict[str, bytes] = {}
        self._memo = _Words(self._learn)

    def _whole(self, text: str) -> bytes:
        return np.asarray(self._tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _direct(self, piece: str) -> bytes:
        """Ids of one piece, written in the symbols of its bytes."""
        raw = self._raw
        found = self._tokenize(piece)
        return raw[found[0].id] if len(found) == 1 else b"".join([raw[t.id] for t in found])

    def _learn(self, key: str) -> bytes:
        """Letters form one piece with the blank before them and marks after
        them another, so both go to the model directly; words of any other
        make go through the whole tokenizer."""
        if (got := self._old.get(key)) is not None:
            return got
        if key.isascii() and key.isalpha():  # letters stand for themselves
            return self._direct(self._blank + key)
        first = key[:1] == "\n"
        word = key[1:] if first else key
        m = _LETTERS_THEN_MARKS.fullmatch(word)
        if m is None:
            if word.split() != [word]:
                raise _Loose
            return self._feed + self._whole(word) if first else self._whole(" " + word)
        letters, marks = m.groups()
        if not first and marks:
            got = self._memo[letters]
        else:
            lead = "" if first else self._blank
            got = self._direct(lead + (letters if letters.isascii() else letters.encode().decode("latin-1").translate(self._symbols)))
            if first:
                got = self._feed + got
        if marks:
            after = self._marks.get(marks)
            if after is None:
                self._marks[marks] = after = self._direct(marks)  # ASCII stands for itself
            got += after
        return got

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self._memo) > MEMO_WORDS:
            self._old, self._memo = dict(self._memo), _Words(self._learn)
            self._marks.clear()
        return [self._text(t) for t in texts]

    def _text(self, text: str) -> bytes:
        if not text:
            return b""
        try:
            ids = b"".join(map(self._memo.__getitem__, ("\n" + text.replace("\n", " \n")).split(" ")))
        except _Loose:
            return self._whole(text)
        return ids[len(self._feed):]


def encoder(tokenizer_file: str) -> WordMemoEncoder:
    """The encoder of this Python worker: its words serve all tasks that run in it."""
    held = sys.modules.setdefault("_vistaframe_encoders", types.ModuleType("_vistaframe_encoders"))
    if tokenizer_file not in held.__dict__:
        held.__dict__[tokenizer_file] = WordMemoEncoder(tokenizer_file)
    return held.__dict__[tokenizer_file]


def default_tokenizer() -> str:
    """Place of the 50k byte-level vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")

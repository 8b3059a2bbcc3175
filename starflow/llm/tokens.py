"""Encoding texts with a public byte-level BPE, fast enough for whole corpora.

A byte-level BPE cuts a text into pieces first and encodes each on its own, and there is
always a cut before a single blank or a single line break between two words, and between a
run of letters and the ASCII marks that end the word. So a text in which all white space is of that kind is
the sequence of its words' ids, and a word is encoded only the first time a worker meets it.
A word of letters alone is one piece, which the model encodes directly. Any other word or
text, and a text that holds an added token such as ``<|endoftext|>``, is encoded as a whole. All ways give the same ids.
"""

from __future__ import annotations

import os
import re
import string
import struct

TOKENIZER = "byte_bpe_50k.json"
_CACHE_WORDS = 300_000  # of each generation
_CACHE_TAILS = 10_000
_MARKS = string.punctuation
_OTHER_SPACE = re.compile(r"[^\S \n]")


def _byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte: itself if printable."""
    plain = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_ENCODERS: dict[str, "Encoder"] = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


_PACKS = [struct.Struct(f"<{n}I").pack for n in range(64)]


def _pack(ids: list[int]) -> bytes:
    n = len(ids)
    return _PACKS[n](*ids) if n < 64 else struct.pack(f"<{n}I", *ids)


class _Words(dict):
    """Word to its ids, as little-endian unsigned 32-bit bytes; filled on demand.

    Two generations: a full one becomes the older one, and what is looked up there moves to
    the new one. So frequent words stay, and memory is bounded.
    """

    def __init__(self, owner: "Encoder", before: str):
        self.owner, self.before, self.older = owner, before, {}
        self.mark = "".join(owner.letters[b] for b in before.encode())
        self.letters, self.tokenize = owner.letters, owner.tokenizer.model.tokenize

    def trim(self) -> None:
        if len(self) > _CACHE_WORDS:
            self.older = dict(self)
            self.clear()

    def __missing__(self, word: str) -> bytes:
        stem = word.rstrip(_MARKS)
        if len(stem) < len(word) and stem.isalpha():
            known = stem in self
            ids = self[stem] + self.owner.tail(word[len(stem) :])
            if known:  # else both parts are enough
                self[word] = ids
            return ids
        ids = self.older.get(word)
        if ids is None:
            if word.isalpha():  # one piece: the model encodes it as it is
                letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
                ids = _pack([token.id for token in self.tokenize(self.mark + letters)])
            else:
                ids = self.owner.whole(self.before + word)
        self[word] = ids
        return ids


def _spaced(line: str) -> bool:
    """Whether a line without two blanks in a row has white space between words only."""
    ends = line[:1] + line[-1:]
    # White space other than the blank is not printable.
    return bool(ends) and " " not in ends and (line.isprintable() or not _OTHER_SPACE.search(line))


class Encoder:
    """Texts to ids; one per worker process and tokenizer file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Their strings become their own ids wherever they stand, so such texts are encoded whole.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.tails: dict[str, bytes] = {}
        self.first = _Words(self, "")
        self.later = _Words(self, " ")
        self.newline = self.whole("\n")

    def whole(self, text: str) -> bytes:
        return _pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def tail(self, marks: str) -> bytes:
        """The ids of marks that end a word."""
        ids = self.tails.get(marks)
        if ids is None:
            if len(self.tails) >= _CACHE_TAILS:
                self.tails.clear()
            ids = self.tails[marks] = self.whole(marks)
        return ids

    def encode(self, text: str) -> bytes:
        """All ids of the text, as little-endian unsigned 32-bit bytes."""
        parts = text.split("\n")
        if "  " in text or any(token in text for token in self.added) or not all(map(_spaced, parts)):
            return self.whole(text) if text else b""
        self.later.trim()
        self.first.trim()
        first, later, lines = self.first, self.later, []
        for line in parts:
            head, *rest = line.split(" ")
            lines.append(first[head] + b"".join(map(later.__getitem__, rest)))
        return self.newline.join(lines)


def encoder(path: str) -> Encoder:
    """This process's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]

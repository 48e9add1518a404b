"""Exact token ids of whole texts at a bearable cost.

The ids are those of the ``tokenizers`` library for a given file. The library
itself takes about one CPU second for each 1 to 2 MB, so for the two kinds of
BPE file used here the merges run in ``tiktoken`` over the same file's
vocabulary:

* byte-level BPE (a space belongs to the word after it): ranks are the ids;
* BPE with word ends (lower case, white space dropped): a word's last byte and
  its end form one symbol. The end is written as the byte ``A``, which lower-
  cased text never has, and the symbols with an end have the lowest ranks.

The two engines carry Unicode tables of different years. With word ends, a
piece between spaces therefore goes to ``tiktoken`` only if all its characters
are settled: assigned since Unicode 3.2 and unchanged in category and
decomposition; any other piece goes to the library. Byte-level files need only
tell letters, numbers and white space, which both engines do alike. The tests
compare both for every code point.

An encoder first compares itself with the library on probe texts; on any
difference, or for any other kind of file, the library does all the work.
Strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np

#: Space-separated pieces that each Python worker remembers, at most, and their length.
CACHE_PIECES = 250_000
CACHE_CHARS = 40

#: The splitting patterns of the two kinds of file.
GLUED_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ENDED_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"

PROBES = [
    "Don't stop, WORDS: 12 3456 thndedst!! äöü ÉÈ ñandú\n\n  tabs\tand  gaps ",
    "x<|endoftext|>y <|startoftext|> á é ΟΔΟΣ Ωσ 漢字かな 😀😀 ' 　'",
    " ".join(chr(c) for c in range(0x20, 0x250)),
    "", " ", "\n", "we'll they're I'd it's 'tis ''s",
]

_ENCODERS: dict[tuple[int, str, str], "TextEncoder"] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins that byte-level files use, back to bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Remembered(dict):
    def __init__(self, make, most: int):
        self.make, self.most = make, most

    def __missing__(self, piece: str) -> bytes:
        made = self.make(piece)
        if len(self) < self.most and len(piece) <= CACHE_CHARS:
            self[piece] = made
        return made


def settled(char: str) -> bool:
    """Whether every Unicode version since 3.2 treats a character alike."""
    then = unicodedata.ucd_3_2_0
    kind = then.category(char)
    return kind not in ("Cn", "Cs") and kind == unicodedata.category(char) and then.decomposition(char) == unicodedata.decomposition(char)


class TextEncoder:
    """ids of texts as little-endian bytes of ``dtype``.

    engine: ``auto`` as described above, or ``tokenizers`` for the library.
    """

    def __init__(self, path: str, engine: str = "auto", cache_pieces: int = CACHE_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.path, self._library = path, None
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self._one = self._by_library
        if engine == "auto":
            with open(path, encoding="utf-8") as f:
                self._prepare(json.load(f), cache_pieces)

    @property
    def library(self):
        """The library's tokenizer, loaded when it is needed."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
            self._library.encode_special_tokens = True
        return self._library

    def _by_library(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _prepare(self, spec: dict, cache_pieces: int) -> None:
        import regex
        import tiktoken

        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        ended = model.get("end_of_word_suffix") or ""
        glued = split.get("type") == "ByteLevel" and not spec.get("normalizer") and not ended
        if model.get("type") != "BPE" or not (glued or ended == "</w>" and split.get("type") == "Sequence"):
            return
        to_byte = _byte_of_char()
        special = {x["content"] for x in spec.get("added_tokens", [])}
        ranks = {}
        for token, i in model["vocab"].items():
            if token not in special:
                stem = token.removesuffix(ended) if ended else token
                ranks[bytes(to_byte[c] for c in stem) + b"A" * (stem != token)] = i
        try:
            engine = tiktoken.Encoding("own", pat_str=GLUED_PATTERN if glued else r"[^A]+A", mergeable_ranks=ranks, special_tokens={})
        except Exception:  # not a vocabulary of this kind
            return
        ids = engine.encode_ordinary
        if glued:
            one = lambda text: np.array(ids(text), self.dtype).tobytes()
        else:
            mark = regex.compile(f"({ENDED_PATTERN})|.", regex.DOTALL).sub
            marked = lambda m: f"{m[1]}A" if m[1] else ""
            known = _Remembered(settled, 1 << 16)

            def piece(p: str) -> bytes:
                if not p.isascii() and not all(map(known.__getitem__, set(p))):
                    return self._by_library(p)
                p = unicodedata.normalize("NFC", p).replace("Σ", "σ").lower()
                return np.array(ids(mark(marked, p)), self.dtype).tobytes()

            get = _Remembered(piece, cache_pieces).__getitem__

            def one(text: str) -> bytes:
                return b"".join(map(get, text.replace("\n", " ").split(" ")))

        if all(one(p) == self._by_library(p) for p in PROBES):
            self._one = one
            self._library = None  # its tables are seldom needed from here on

    @property
    def fast(self) -> bool:
        return self._one != self._by_library

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """One bytes object for each text; null counts as empty."""
        one = self._one
        return (one(t) if t else b"" for t in texts)


def encoder(path: str, engine: str = "auto") -> TextEncoder:
    """The worker's own encoder of a file; built once in each process."""
    key = (os.getpid(), path, engine)
    if key not in _ENCODERS:
        _ENCODERS[key] = TextEncoder(path, engine)
    return _ENCODERS[key]

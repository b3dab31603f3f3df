"""Token ids of whole texts by the tokenizers library, each chunk of a text encoded once.

The pre-tokenizer of the vocabulary never joins characters across white space, so the ids of a
text are those of its white-space chunks in turn. A worker keeps the ids of the chunks it has met
in a bounded cache of two halves: when the newer one is full it becomes the older one, whose chunks
move up again when they are met. All encoding is done by the library. The short cuts rest on what
the vocabulary's normaliser and pre-tokenizer do, so a file with others is refused.
"""

from __future__ import annotations

import functools
import os
import re
import struct

import public_tokenizers

VOCABULARY = "word_bpe_49k.json"
#: The id that ends each document.
END_ID = 1
#: Chunks that a worker remembers, where it holds other models beside the encoder.
CACHE_CHUNKS = 400_000
LONGEST_CACHED = 40

#: Python splits at these four separators; the library doesn't take them for white space.
_NOT_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")
_SPACE = re.compile(r"[^\S\x1c-\x1f]+")
#: Marks that form a piece of their own after a letter.
_MARKS = ",.!?;:#$%&*()+-=/_"


def _byte_letters() -> dict[int, int]:
    """The character that stands for each byte in the vocabulary: itself if it can be printed."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printed]
    return {b: b for b in printed} | {b: 256 + i for i, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


def vocabulary_path() -> str:
    return public_tokenizers.path(VOCABULARY)


#: Texts that another normaliser or pre-tokenizer would cut or spell differently.
_PROBES = (
    "The house, the HOUSE; it's 3.5% (naïve) Été größe!? a_b c-d e/f <|endoftext|> x  y\n\tz",
    "words.Words,words 12ab ab12 don't we'll ñandú\u3000текст 日本語 \x1c end.",
)


class ChunkIds(dict):
    """Little-endian unsigned 32-bit ids of white-space chunks, made on first use."""

    def __init__(self, path: str, most: int = CACHE_CHUNKS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.most = most
        self.older: dict[str, bytes] = {}
        self.library = Tokenizer.from_file(path)
        self.merge = self.library.model.tokenize
        for text in _PROBES:
            if self.text(text) != self.encode(text):
                raise ValueError(f"{path} doesn't cut texts at white space as {VOCABULARY} does")

    def encode(self, text: str) -> bytes:
        return _packed(self.library.encode(text, add_special_tokens=False).ids)

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self.made(chunk)
        if len(chunk) <= LONGEST_CACHED:
            if len(self) >= self.most // 2:
                self.older = dict(self)
                self.clear()
            self[chunk] = ids
        return ids

    def made(self, chunk: str) -> bytes:
        core = chunk.rstrip(_MARKS)
        if core and core != chunk and core[-1].isalpha() and core[-1] < "\u0100":
            # A run of marks after a letter is a piece of its own.
            return self[core] + self[chunk[len(core) :]]
        if chunk.isalpha() and chunk.islower() and _plain(chunk):
            # One piece as it is: the library's merges are all that is left to do.
            if not chunk.isascii():
                chunk = chunk.encode().decode("latin-1").translate(_BYTE_LETTERS)
            return _packed([t.id for t in self.merge(chunk)])
        return self.encode(chunk)

    def text(self, text: str | None) -> bytes:
        """The ids of a text, without an end id; none for a null."""
        if not text:
            return b""
        if any(c in text for c in _NOT_SPACE):
            chunks = _SPACE.split(text)
        else:
            if "<|" not in text and _plain(text):
                text = text.lower()  # the library lowers as well; equal chunks meet earlier
            chunks = text.split()
        return b"".join(map(self.__getitem__, chunks))


def _packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def _plain(text: str) -> bool:
    """All characters below U+0100, where lower case is the same everywhere."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@functools.lru_cache(maxsize=2)
def chunk_ids(path: str, most: int = CACHE_CHUNKS) -> ChunkIds:
    """The encoder of this worker process for a vocabulary file; it remembers ``most`` chunks."""
    return ChunkIds(path, most)

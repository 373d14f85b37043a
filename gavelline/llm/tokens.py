"""Token ids of whole texts by a public byte-level BPE vocabulary, in tasks.

Ids equal those of the `tokenizers` library for the same vocabulary.  In such a vocabulary no token crosses from a character
that is no white space to a following space, so a text falls into pieces at its single spaces, and the ids of a piece are
looked up or made once per worker.  Where a space follows white space, and for the name of a special token, the whole text
goes through the library.
"""

import base64
import json
import struct
from functools import cached_property, lru_cache

import numpy as np

#: Pieces whose ids a worker remembers; it starts afresh beyond.
REMEMBERED = 150_000


class _Unsafe(Exception):
    pass


class Tokens(dict):
    """Ids of texts as little-endian unsigned 16-bit numbers; as a dict, those of a space and a piece."""

    def __init__(self, name: str):
        import public_tokenizers
        import tiktoken

        self.path = public_tokenizers.path(f"{name}.json")
        with open(self.path) as file:
            described = json.load(file)
        if len(described["model"]["vocab"]) + len(described["added_tokens"]) > 1 << 16:
            raise ValueError("token ids are kept in 16 bits")
        self.special = [t["content"] for t in described["added_tokens"]]
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pieces = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def __missing__(self, piece: str) -> bytes:
        if not piece or piece[-1].isspace():
            raise _Unsafe
        if len(self) >= REMEMBERED:
            self.clear()
        found = self.pieces.encode_ordinary(" " + piece)
        self[piece] = ids = struct.pack(f"<{len(found)}H", *found)
        return ids

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not any(name in text for name in self.special):
            first, *rest = text.split(" ")
            try:
                ids = b"".join(map(self.__getitem__, rest))
                if not first or not first[-1].isspace():
                    return struct.pack(f"<{len(head)}H", *head) + ids if (head := self.pieces.encode_ordinary(first)) else ids
            except _Unsafe:
                pass
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u2").tobytes()


@lru_cache(maxsize=2)
def tokens(name: str) -> Tokens:
    """The worker's tokens of a vocabulary by its file name without ending."""
    return Tokens(name)

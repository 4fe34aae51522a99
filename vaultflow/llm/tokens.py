"""Exact byte-level BPE ids, fast: texts are cut at spaces where the vocabulary's own pattern
always cuts, and the ids of each piece are kept."""

from __future__ import annotations

import json
import re
from array import array
from functools import cached_property

#: Pieces kept at most; then the cache starts anew.
CACHE_PIECES = 250_000

_ENCODERS: dict[str, ByteBPE] = {}


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str | None = None) -> ByteBPE:
    """One encoder for each Python worker and file."""
    path = path or default_tokenizer_path()
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteBPE(path)
    return _ENCODERS[path]


class ByteBPE:
    """The ids that Tokenizer.from_file(path).encode(text, add_special_tokens=False) gives.

    A space before a character that is no white space always starts a token of such a
    vocabulary's pattern, so a text may be cut there. Texts with special tokens' strings, or with a
    space before other white space, are encoded whole.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        self.path = path
        said = json.load(open(path, encoding="utf-8"))
        self.special = re.compile("|".join(re.escape(x["content"]) for x in said.get("added_tokens", [])) or r"(?!)")
        byte_of = _bytes_of_characters()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in said["model"]["vocab"].items() if token not in {x["content"] for x in said.get("added_tokens", [])}}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.uncut = re.compile(r" (?:\s|$)")
        self.cache = _Cache(self.fast)

    @cached_property
    def whole(self):
        """Loaded only where a text needs it: it takes much memory."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def encode_bytes(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.special.search(text):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        if self.uncut.search(text) or not text:
            return array("I", self.fast(text)).tobytes()
        if len(self.cache) > CACHE_PIECES:
            self.cache.clear()
        first, *rest = text.split(" ")
        head = array("I", self.fast(first)).tobytes() if first else b""
        return head + b"".join(map(self.cache.__getitem__, rest))

    def forget(self) -> None:
        """Frees the cache; a worker may serve other operators next."""
        self.cache.clear()

    def count(self, text: str) -> int:
        return len(self.encode_bytes(text)) // 4


class _Cache(dict):
    """Piece without its leading space: bytes of its ids."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        out = array("I", self.encode(" " + piece)).tobytes()
        if len(piece) < 64:
            self[piece] = out
        return out


def _bytes_of_characters() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the rest, in order, from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


__all__ = ["ByteBPE", "default_tokenizer_path", "encoder"]

"""Token ids of the public byte-level BPE vocabulary, with a chunk cache.

Pre-tokens of the vocabulary's pattern never span the start of a run of white
space, nor the last space before a non-space.  A text in which no space touches
other white space can therefore be cut before every space; each chunk's ids
depend on the chunk alone and are cached per Python worker (bounded).  Texts
with other white space, or with a special token's marker, go to the JSON
tokenizer.  Where only a text's ids are wanted it is not cut: one call a text is
cheaper than a cache that the many rare words of a corpus miss.
"""

from __future__ import annotations

import re
import sys
from array import array

_CACHE_LIMIT, _LONGEST_CACHED = 300_000, 200
_ODD = re.compile(r"\s | \s|<\|")
_ODD_SPACE = re.compile(r" (?:(?<=\s )|(?=\s))")  # the same without the marker, looked for at spaces only
_STATE: dict[str, object] = {}


def _rank_encoder(path: str):
    import base64

    import public_tokenizers
    import tiktoken
    if path not in _STATE:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _STATE[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                         mergeable_ranks=ranks, special_tokens={})
    return _STATE[path]


def _json_encoder(path: str):
    from tokenizers import Tokenizer
    if path not in _STATE:
        _STATE[path] = Tokenizer.from_file(path)
    return _STATE[path]


_STOPS = frozenset(".,;:")


def _packed(ids: list[int]) -> bytes:
    a = array("I", ids)  # four bytes an item here
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


class _Chunks(dict):
    """chunk -> its ids as little-endian unsigned 32-bit bytes.

    Two generations: a full cache becomes the old one, whose entries come back
    when they are met again, so common chunks survive."""

    def __init__(self, json_path: str, ranks_path: str):
        self.json_path, self.plain = json_path, _rank_encoder(ranks_path).encode_ordinary
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> list[int]:
        return _json_encoder(self.json_path).encode(text, add_special_tokens=False).ids

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            if chunk[-1:] in _STOPS and chunk[-2:-1].isalpha():
                # a letter run ends before punctuation: both parts are pre-tokens
                ids = self[chunk[:-1]] + self[chunk[-1]]
            else:
                ids = _packed(self.whole(chunk) if _ODD.search(chunk) else self.plain(chunk))
        if len(self) >= _CACHE_LIMIT:
            self.old = dict(self)
            self.clear()
        if len(chunk) <= _LONGEST_CACHED:
            self[chunk] = ids
        return ids


def _chunk_ids(json_path: str | None, ranks_path: str | None) -> _Chunks:
    default_json, default_ranks = default_paths()
    json_path, ranks_path = json_path or default_json, ranks_path or default_ranks
    key = f"chunks:{json_path}:{ranks_path}"
    if key not in _STATE:
        _STATE[key] = _Chunks(json_path, ranks_path)
    return _STATE[key]


def chunk_encoder(json_path: str | None = None, ranks_path: str | None = None):
    """A function chunk -> ids for chunks that end at safe cuts."""
    return _chunk_ids(json_path, ranks_path).__getitem__


def default_paths() -> tuple[str, str]:
    import public_tokenizers as p
    return p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken")


def encoder(json_path: str | None = None, ranks_path: str | None = None):
    """A function text -> ids as little-endian unsigned 32-bit bytes, equal to
    the JSON tokenizer's ``encode(text, add_special_tokens=False)``."""
    default_json, default_ranks = default_paths()
    json_path = json_path or default_json
    plain = _rank_encoder(ranks_path or default_ranks).encode_ordinary

    def encode(text: str) -> bytes:
        if not text:
            return b""
        if "<|" in text or _ODD_SPACE.search(text):
            return _packed(_json_encoder(json_path).encode(text, add_special_tokens=False).ids)
        return _packed(plain(text))

    return encode

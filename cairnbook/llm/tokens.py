"""Token ids of a public byte-level BPE vocabulary, cached by space-delimited unit."""

from __future__ import annotations

import base64
import json
import re

import numpy as np

_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
_UNSAFE = re.compile(r" \s|\s ")
#: Distinct units a worker remembers before it starts over.
CACHE_UNITS = 300_000


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_specials() -> dict[str, int]:
    """Added tokens of the vocabulary's `tokenizers` file, which it finds in any text."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


class UnitEncoder(dict):
    """Little-endian uint32 ids of a text.

    The vocabulary's own pattern never joins characters over a single space that has no white space
    beside it, so a text is cut there and each unit is encoded once. `ranks_path` names a file of
    ranks; the ids equal those of the `tokenizers` file of the same vocabulary (tested). Strings of
    `specials` are tokens of their own wherever they stand; without it they are ordinary text.
    """

    def __init__(self, ranks_path: str, specials: dict[str, int] | None = None):
        import public_tokenizers
        import tiktoken

        super().__init__()
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._bpe = tiktoken.Encoding("unit", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._specials = {text: np.asarray([k], dtype="<u4").tobytes() for text, k in (specials or {}).items()}
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self._specials, key=len, reverse=True))) + ")") if self._specials else None

    def _ids(self, text: str) -> bytes:
        return np.asarray(self._bpe.encode_ordinary(text), dtype="<u4").tobytes()

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= CACHE_UNITS:
            self.clear()
        ids = self._ids(" " + unit)
        if len(unit) <= 64:
            self[unit] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if self._special and self._special.search(text):
            return b"".join(self._specials[part] if part in self._specials else self._plain(part) for part in self._special.split(text) if part)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        units = (_SAFE_CUT.split(text) if _UNSAFE.search(text) else text.split(" ")) if text else [""]
        return self._ids(units[0]) + b"".join(map(self.__getitem__, units[1:]))

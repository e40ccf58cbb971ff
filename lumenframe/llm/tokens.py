"""Token ids of a byte-level BPE vocabulary file, for many texts.

``tokenizers`` encodes a text in one go; here a text is cut at its single spaces, where the word
pattern of the vocabulary always cuts too, and the ids of each piece are kept, so a piece that
recurs costs one lookup. New pieces are merged by ``tiktoken`` from the ranks in the same JSON
file, which gives the same ids (tests compare whole texts). Texts with runs of white space, with
characters outside basic Latin, or with one of the vocabulary's added tokens are encoded as a whole
by ``tokenizers``, so an added token written out in a text gets its own id, as it does there.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from array import array

#: Fixed value: the word pattern of the vocabulary.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LETTERS = "".join(chr(c) for c in range(0x80, 0x250) if unicodedata.category(chr(c))[0] == "L")
#: No two white space characters in a row, and nothing outside basic Latin.
_PLAIN = re.compile(f"[\\t\\n\\r\\x20]?(?:[\\x21-\\x7e{_LETTERS}]+[\\t\\n\\r\\x20]?)*+")
_KEEP = 500_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file, inverted."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in shown]
    out |= {chr(256 + k): b for k, b in enumerate(hidden)}
    return out


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, as bytes."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        special = {t["content"] for t in data.get("added_tokens", [])}
        self._special = re.compile("|".join(map(re.escape, sorted(special)))) if special else None
        alphabet = _byte_alphabet()
        ranks = {
            bytes(alphabet[c] for c in token): rank
            for token, rank in data["model"]["vocab"].items()
            if token not in special
        }
        self._bpe = tiktoken.Encoding("words", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._ids: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> None:
        merge = self._bpe.encode_ordinary
        for p in pieces:
            self._ids[p] = array("I", merge(" " + p)).tobytes()

    def encode(self, text: str) -> bytes:
        if not _PLAIN.fullmatch(text) or (self._special and self._special.search(text)):
            import numpy as np

            ids = self._whole.encode(text, add_special_tokens=False).ids
            return np.array(ids, dtype="<u4").tobytes()
        first, *pieces = text.split(" ")
        head = array("I", self._bpe.encode_ordinary(first)).tobytes()
        try:
            return head + b"".join(map(self._ids.__getitem__, pieces))
        except KeyError:
            if len(self._ids) > _KEEP:
                self._ids.clear()
            self._learn({p for p in pieces if p not in self._ids})
            return head + b"".join(map(self._ids.__getitem__, pieces))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(path)

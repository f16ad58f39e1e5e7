"""Token ids by a public tokenizer file.

Byte-level files whose merges stand in the order of their ids are encoded by a rank encoder built from the same file,
which is several times faster and gives the same ids (tests hold both against each other). Texts that hold a special
token's string, and other kinds of files, go through the tokenizer itself.
"""

from __future__ import annotations

import json
import struct
from array import array


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _printable() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _rank_encoder(path: str):
    """An encoder of plain text by ranks, or None if the file's merges aren't in the order of their ids."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab = model.get("vocab", {})
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", ())]
    ids = [vocab.get(a + b, -1) for a, b in merges]
    if not merges or ids != sorted(ids) or ids[0] < 256:
        return None
    byte = _printable()
    ranks = {bytes(byte[c] for c in k): v for k, v in vocab.items() if all(c in byte for c in k) and (len(k) == 1 or v >= ids[0]) and v <= ids[-1]}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value: the byte-level pre-tokenizer's own
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Little-endian unsigned 32-bit ids of texts; one per Python worker and tokenizer file."""

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        pre = self.tokenizer.pre_tokenizer
        plain = type(pre).__name__ == "ByteLevel" and not pre.add_prefix_space and pre.use_regex and self.tokenizer.normalizer is None
        self.ranks = _rank_encoder(path) if plain else None

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.ranks and not any(x in text for x in self.special):
            out = array("I", self.ranks.encode_ordinary(text))
            return out.tobytes()
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def count(self, text: str | None) -> int:
        return len(self.encode(text)) // 4

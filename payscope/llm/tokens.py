"""Token ids of whole texts under a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import json


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies in JSON: printable Latin-1
    characters stand for themselves, other bytes for those from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def load_ranks(path: str) -> dict[bytes, int]:
    """Piece -> rank from a rank file, or from a JSON vocabulary whose ids are
    the merge ranks."""
    if not path.endswith(".json"):
        with open(path, "rb") as f:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)
    special = {x["content"] for x in vocabulary.get("added_tokens", [])}
    alphabet = byte_alphabet()
    return {bytes(alphabet[c] for c in piece): rank for piece, rank in vocabulary["model"]["vocab"].items() if piece not in special}


def added_tokens(path: str) -> dict[str, int]:
    """Added tokens of a JSON vocabulary, which stand for their literal text."""
    if not path.endswith(".json"):
        return {}
    with open(path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens", [])
    if any(x[k] for x in added for k in ("single_word", "lstrip", "rstrip") if k in x):
        raise ValueError("added tokens that depend on the text around them")
    return {x["content"]: x["id"] for x in added}


def encoding(path: str):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(path), special_tokens=added_tokens(path))


class TextEncoder:
    """Little-endian unsigned 32-bit ids of a text, as bytes; an added token in
    the text is its id."""

    def __init__(self, vocabulary: str) -> None:
        self.encode = encoding(vocabulary).encode_to_numpy

    def encode_bytes(self, text: str) -> bytes:
        return self.encode(text, allowed_special="all", disallowed_special=()).astype("<u4", copy=False).tobytes()

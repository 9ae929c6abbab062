"""Reads the published tokenizer files: vocabulary, merges, pre-splitting; nothing is trained here."""

from __future__ import annotations

import functools
import json
import unicodedata
from dataclasses import dataclass

import regex

# The published patterns that cut text into pieces before merging.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte: visible Latin-1 stands for itself, the rest follows from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@dataclass(frozen=True)
class TokenizerFile:
    """vocab: token to id; merges: pairs of ids in rank order, with the id of the merged token; special: whole strings
    cut out before anything else; word_end: suffix of a word's last symbol, or empty."""

    vocab: dict[str, int]
    merges: list[tuple[int, int, int]]
    special: dict[str, int]
    word_end: str


@functools.lru_cache(maxsize=4)
def load(path: str) -> TokenizerFile:
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    model = data["model"]
    vocab = model["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    return TokenizerFile(vocab, merges, special, model.get("end_of_word_suffix") or "")


@functools.lru_cache(maxsize=4)
def special_cutter(path: str) -> regex.Pattern | None:
    found = sorted(load(path).special, key=len, reverse=True)
    return regex.compile("|".join(map(regex.escape, found))) if found else None


def lowered(text: str) -> str:
    """Lower case letter by letter (no rule for a sigma at a word's end)."""
    return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)


_WORDS = regex.compile(WORD_PATTERN)
_BYTES = regex.compile(BYTE_PATTERN)


def words(text: str) -> list[str]:
    """Pieces of the word vocabulary: composed, lower-cased, white space dropped."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    return _WORDS.findall(lowered(text))


def part_words(part: str) -> list[str]:
    """``words`` of a text without spaces; letters with or without a point or comma need no pattern."""
    low = lowered(part if part.isascii() else unicodedata.normalize("NFC", part))
    if low.isalpha():
        return [low]
    if part[-1:] in {".", ","} and low[:-1].isalpha():
        return [low[:-1], low[-1]]
    return words(part)


def byte_pieces(text: str) -> list[str]:
    """Pieces of the byte vocabulary: they join to the text."""
    return _BYTES.findall(text)

"""Splitting texts into the pieces of a byte-level BPE, and an id memo for pieces.

The split is that of the tokenizers library's ByteLevel pre-tokenizer. A quick pattern of the standard
library does nearly all texts; texts with characters on which its classes differ go through the library.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np

#: Latin, Greek and Cyrillic letters, general punctuation, currency, arrows, box drawing, kana and the common CJK block:
#: there both splits agree on every character (tests/llm checks all of them). Digits such as superscripts are left out.
_PLAIN = re.compile(
    r"[\t-\r -~\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-ͷͺ-Ϳ΄-ΊΎ-ΡΣ-ҁҊ-ԯ"
    r"‐-‧‰-⁞₠-₿←-⏳─-❵、-〄ぁ-ゖァ-ヿ一-龥]*"
)



def _letters() -> str:
    """The letters among the plain characters, as ranges of a character class: one table look-up a character."""
    runs: list[list[int]] = []
    for c in range(0x10000):
        if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c))[0] == "L" and _PLAIN.fullmatch(chr(c)):
            if runs and runs[-1][1] == c - 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in runs)


_L = _letters()
_QUICK = re.compile(rf" ?[{_L}]+|'(?:[stmd]|re|ve|ll)| ?\d+| ?[^\s\d{_L}]+|\s+(?!\S)|\s+")

def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=4)
def library(path: str):
    """The library's tokenizer without truncation and padding, one thread a worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=4)
def added(path: str) -> dict[str, int]:
    """Added tokens by their strings. Only plain ones are understood: no stripping, whole-word or normalised matching."""
    out = {}
    with open(path, encoding="utf-8") as f:
        conf = json.load(f)
    pre = conf["pre_tokenizer"]
    if conf.get("normalizer") or pre["type"] != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or conf["model"].get("ignore_merges"):
        raise ValueError(f"{path}: only a byte-level BPE without normaliser or prefix space is understood")
    for x in conf["added_tokens"]:
        if x["lstrip"] or x["rstrip"] or x["single_word"]:
            raise ValueError(f"{path}: added token {x['content']!r} needs stripping or word borders")
        out[x["content"]] = x["id"]
    return out


@lru_cache(maxsize=4)
def _added_pattern(path: str):
    found = sorted(added(path), key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, found)) + ")") if found else None


@lru_cache(maxsize=1)
def _library_split():
    from tokenizers.pre_tokenizers import ByteLevel

    return ByteLevel(add_prefix_space=False, use_regex=True)


def plain_pieces(text: str) -> list[str]:
    """The pieces of a text without added tokens; joined they are the text."""
    if text.isascii():
        if not any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return _QUICK.findall(text)
    elif _PLAIN.fullmatch(text):
        return _QUICK.findall(text)
    return [text[a:b] for _, (a, b) in _library_split().pre_tokenize_str(text)]


def pieces(text: str, path: str) -> list[str]:
    """All pieces of a text, added tokens as pieces of their own."""
    pattern = _added_pattern(path)
    if pattern is None or not any(x in text for x in added(path)):
        return plain_pieces(text)
    out: list[str] = []
    for i, part in enumerate(pattern.split(text)):
        if i % 2:
            out.append(part)
        elif part:
            out += plain_pieces(part)
    return out


@lru_cache(maxsize=4)
def _pieces_only(path: str):
    """The library's tokenizer for texts that are split already and whose bytes stand as the vocabulary's characters."""
    library(path)
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    t.pre_tokenizer = None
    return t


def byte_characters() -> dict[int, str]:
    """The character by which a byte-level vocabulary writes each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = sorted(set(range(256)) - set(shown))
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_AS_CHARACTERS = byte_characters()
_SPACE = _AS_CHARACTERS[32]


@lru_cache(maxsize=4)
def _lengths(path: str) -> np.ndarray:
    """Characters of each id as the vocabulary writes it."""
    vocab = library(path).get_vocab(with_added_tokens=True)
    out = np.zeros(max(vocab.values()) + 1, np.int64)
    for token, i in vocab.items():
        out[i] = len(token)
    return out


class Memo(dict):
    """Piece -> what `value` makes of its ids. New pieces are encoded by the library, many in one call.

    Holds at most `limit` pieces, then starts anew, so memory is bounded for any vocabulary."""

    def __init__(self, path: str, counts: bool, limit: int = 800_000):
        super().__init__()
        self.path, self.counts, self.limit = path, counts, limit
        self.lacking: list[str] = []

    def __missing__(self, piece: str) -> None:
        self.lacking.append(piece)

    def learn(self, new: list[str]) -> dict:
        """Values of pieces that are not held."""
        special = added(self.path)
        written = [p.replace(" ", _SPACE) if p.isascii() and p.isprintable() else p if p in special else p.encode().decode("latin-1").translate(_AS_CHARACTERS) for p in new]
        ids = np.array(_pieces_only(self.path).encode_batch_fast([written], is_pretokenized=True, add_special_tokens=False)[0].ids, np.int64)
        ends = np.searchsorted(np.cumsum(_lengths(self.path)[ids]), np.cumsum(list(map(len, written)))) + 1
        n = np.diff(ends, prepend=0)  # every character of a piece is one byte of its ids
        if self.counts:
            found = dict(zip(new, n.tolist(), strict=True))
        else:
            data, at, found = ids.astype("<u4").tobytes(), 0, {}
            for piece, end in zip(new, (4 * ends).tolist(), strict=True):
                found[piece] = data[at:end]
                at = end
        if len(self) + len(found) > self.limit:
            self.clear()
        if max(map(len, new)) > 256:
            self.update((k, v) for k, v in found.items() if len(k) <= 256)
        elif len(found) <= self.limit:
            self.update(found)
        return found

    def values_of(self, texts: list[str], chars: int = 1 << 21):
        """For each text the list of its pieces' values, text by text; new pieces are learnt once in about `chars` characters."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and size < chars:
                size += len(texts[end])
                end += 1
            held, lacking = [], []
            for t in texts[at:end]:
                self.lacking = []
                held.append(list(map(self.__getitem__, pieces(t, self.path))))
                lacking.append(self.lacking)
            new = list(dict.fromkeys(p for x in lacking for p in x))
            found = self.learn(new) if new else {}
            for got, x in zip(held, lacking, strict=True):
                if x:
                    rest = map(found.__getitem__, x)
                    got = [v or next(rest) for v in got]
                yield got
            at = end


@lru_cache(maxsize=4)
def memo(path: str, counts: bool) -> Memo:
    return Memo(path, counts)


def encode_all(texts: list[str], path: str):
    """The ids of each text as little-endian unsigned 32-bit integers."""
    return map(b"".join, memo(path, False).values_of(texts))


def count_all(texts: list[str], path: str):
    """The number of ids of each text."""
    return map(sum, memo(path, True).values_of(texts))


def encode(text: str, path: str) -> bytes:
    return next(encode_all([text], path))

"""Token ids of whole texts by two public vocabularies, as the libraries that their files are made for give them."""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache
from itertools import groupby

import numpy as np
import sentencepiece
import tiktoken
import tokenizers

#: Characters that every Unicode version since 3.0 puts in the same class: Latin, Cyrillic, dashes, quotes, kana, Han, Hangul.
_OTHER = re.compile("[^\0-ɏЀ-я‐-‧‰-›€、-。ぁ-んァ-ヶ一-龥가-힣]")
#: Before a single space in front of a plain character: there a word always begins, whatever stands around it.
_BORDER = re.compile("(?<! )(?= [!-~À-ɏ])")


def byte_characters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable bytes stay, others follow from 256."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


def gathered(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """values[starts[0] : starts[0] + counts[0]], values[starts[1] : …], … as one array."""
    ends = np.cumsum(counts)
    return values[np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)]


def as_bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class ByteLevel:
    """A byte-level BPE file of the tokenizers library, with its special tokens or with their strings as plain text.

    The tiktoken library does the same merges by rank several times faster. It is used where both libraries are sure
    to cut words alike; words with other characters, and texts with special tokens, go to the tokenizers library.
    """

    def __init__(self, source: str, special: bool):
        data = json.loads(source)
        vocab: dict[str, int] = data["model"]["vocab"]
        own = {t["content"] for t in data["added_tokens"]}
        back = {c: b for b, c in enumerate(byte_characters())}
        self.token_bytes = {i: bytes(map(back.__getitem__, t)) for t, i in vocab.items() if t not in own}
        self.library = tokenizers.Tokenizer.from_str(source)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = not special
        self.special = sorted(own) if special else []
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in data["model"]["merges"]]
        made = [vocab[a + b] for a, b in merges]
        before = data["pre_tokenizer"]
        if data["normalizer"] or before["type"] != "ByteLevel" or not before["use_regex"] or before["add_prefix_space"] or made != sorted(set(made)):
            raise ValueError("a byte-level vocabulary with ids in the order of merges is needed")
        import public_tokenizers

        ranks = {t: i for i, t in self.token_bytes.items()}
        self.ranked = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if any(s in text for s in self.special):
            return self.library.encode(text, add_special_tokens=False).ids
        if not _OTHER.search(text):
            return self.ranked.encode_ordinary(text)
        out: list[int] = []
        for other, words in groupby(_BORDER.split(text), lambda word: bool(_OTHER.search(word))):
            part = "".join(words)
            out += self.library.encode(part, add_special_tokens=False).ids if other else self.ranked.encode_ordinary(part)
        return out


class Pieces:
    """A sentencepiece model that adds the space in front of a text."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        none = lambda i: self.library.is_unknown(i) or self.library.is_control(i)
        text = lambda i: bytes([int(pieces[i][3:-1], 16)]) if self.library.is_byte(i) else pieces[i].replace("▁", " ").encode()
        self.token_bytes = {i: b"" if none(i) else text(i) for i in range(len(pieces))}

    def ids(self, text: str) -> list[int]:
        return self.library.encode(text)


@lru_cache(maxsize=2)
def byte_level(source: str, special: bool) -> ByteLevel:
    return ByteLevel(source, special)


@lru_cache(maxsize=2)
def pieces(model: bytes) -> Pieces:
    return Pieces(model)

"""Byte-pair encoding by backtracking over longest matches, and decoding through an offset table.

A greedy left-to-right cover of a word by vocabulary tokens equals the merge procedure's result as soon
as every neighbouring pair is *compatible*: merging the pair's own characters would never join anything
across the border. So the encoder takes the longest token that starts at each place (found for all
places at once by Aho-Corasick), tests it against the token before, falls back to the next shorter prefix
token, and steps back over the last token when none fits; places that led nowhere are never tried again.

The vocabulary file is a parameter. It is read on the driver and broadcast; it does not grow with the data.
Words repeat heavily, so each Python worker remembers the codes of up to ``REMEMBERED`` distinct strings between
white space, as many words and as many tested pairs; a full memory is built anew (of the strings, those used lately stay),
which changes no result.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import arrow_type, field_ddl, text_slices, utf8

REMEMBERED, LONGEST_REMEMBERED = 200_000, 100
_ODD_SPACE = "\x1c\x1d\x1e\x1f"  # white space to str.split(), but not to the patterns of vocabulary files
_FINAL = 0x400  # added to the code point of a word's last character; byte characters lie below it


def _byte_characters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable bytes stay, others follow from 256."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


Code = tuple[tuple[int, ...], str, bytes]  # ids, ids as text, decoded


class Coder:
    """Encoder and decoder of one vocabulary file in the JSON form of the tokenizers library."""

    def __init__(self, source: str):
        data = json.loads(source)
        model = data["model"]
        self.suffix = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        pattern = next(p["pattern"]["Regex"] for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern)
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.byte_text = dict(enumerate(_byte_characters()))

        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        made = [vocab[a + b] for a, b in merges]
        if made != sorted(set(made)):
            raise ValueError("token ids must follow the order of merges")
        self.joined = {(vocab[a], vocab[b]): c for (a, b), c in zip(merges, made)}
        self.halves = {c: (vocab[a], vocab[b]) for (a, b), c in zip(merges, made)}

        known = {self._symbols(t): i for t, i in vocab.items() if i in self.halves or len(self._symbols(t)) == 1}
        self.length = [0] * (max(known.values()) + 1)
        self.shorter: list[int | None] = [None] * len(self.length)
        for s, i in known.items():
            self.length[i] = len(s)
            self.shorter[i] = next((known[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in known), None)
        self.whole = known
        self.automaton = ahocorasick.Automaton()
        # the automaton looks through a state's letters in the order they came: those of frequent merges first
        for s, i in sorted(known.items(), key=lambda entry: (entry[1] not in self.halves, entry[1])):
            self.automaton.add_word(s, (i, len(s)))
        self.automaton.make_automaton()

        by_id = {i: t for t, i in (vocab | self.special).items()}
        texts = [by_id.get(i, "").encode() for i in range(max(by_id) + 1)]
        self.blob = b"".join(texts)
        self.offsets = np.cumsum([0, *map(len, texts)]).tolist()
        self.chunks, self.chunks_before = {}, {}
        self.known_words: dict[str, list[int]] = {}
        self.pairs: dict[int, bool] = {}

    def _symbols(self, token: str) -> str:
        if token.endswith(self.suffix) and len(token) > len(self.suffix):
            token = token[: -len(self.suffix)]
            return token[:-1] + chr(ord(token[-1]) + _FINAL)
        return token

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging what stands behind ``left`` and ``right`` would leave the border between them.

        The merges of both sides are undone newest first. At each state of the two tokens at the border their
        join must not exist, or come later than the merge that was undone last.
        """
        halves, joined = self.halves, self.joined
        limit = None
        while True:
            pair = joined.get((left, right))
            if pair is not None and (limit is None or pair < limit):
                return False
            a, b = halves.get(left), halves.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                limit, left = left, a[1]
            else:  # of equal merges the left one comes first: up to its own rank the right token isn't there yet
                limit, right = right + 1, b[0]

    def _fits(self, left: int, right: int) -> bool:
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        found = self.pairs[left << 32 | right] = self.compatible(left, right)
        return found

    def encode_word(self, word: str) -> list[int]:
        """Token ids of one word given in byte characters, in time linear in its length."""
        if not word:
            return []
        n = len(word)
        text = word[:-1] + chr(ord(word[-1]) + _FINAL)
        whole = self.whole.get(text)
        if whole is not None:
            return [whole]
        longest: list[int | None] = [None] * (n + 1)
        for end, (token, size) in self.automaton.iter(text):
            longest[end - size + 1] = token  # matches come by their end, so the last one of a start is the longest
        open_at = bytearray(b"\1") * (n + 1)
        length, shorter, tested = self.length, self.shorter, self.pairs.get
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            while token is not None:
                if open_at[at + length[token]]:
                    fits = not out or tested(out[-1] << 32 | token)
                    if fits or (fits is None and self._fits(out[-1], token)):
                        break
                token = shorter[token]
            if token is not None:
                out.append(token)
                at += length[token]
                token = longest[at]
            elif out:
                open_at[at] = 0
                last = out.pop()
                at -= length[last]
                token = shorter[last]
            else:
                raise ValueError(f"no encoding for {word!r}")
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        """The tokens' texts joined by spaces, which is how a file without a decoder section decodes."""
        blob, offsets = self.blob, self.offsets
        return b" ".join([blob[offsets[i] : offsets[i + 1]] for i in ids])

    def _word(self, word: str) -> list[int]:
        ids = self.known_words.get(word)
        if ids is None:
            ids = self.encode_word(word.encode().decode("latin-1").translate(self.byte_text))
            if len(word) <= LONGEST_REMEMBERED:
                if len(self.known_words) >= REMEMBERED:
                    self.known_words.clear()
                self.known_words[word] = ids
        return ids

    def _chunk(self, chunk: str) -> Code:
        code = self.chunks_before.get(chunk)
        if code is None:
            words = (chunk,) if chunk.isalpha() else self.words.findall(chunk)
            ids = tuple(self._word(words[0]) if len(words) == 1 else [i for w in words for i in self._word(w)])
            code = ids, " ".join(map(str, ids)), self.decode(ids)
        if len(chunk) <= LONGEST_REMEMBERED:
            if len(self.chunks) >= REMEMBERED:
                self.chunks, self.chunks_before = {}, self.chunks
            self.chunks[chunk] = code
        return code

    def codes(self, text: str) -> list[Code]:
        """The codes of the strings between white space and of the special tokens in ``text``, in order."""
        out = []
        for k, part in enumerate(self.split_special.split(text)):
            if k % 2:
                i = self.special[part]
                out.append(((i,), str(i), self.decode((i,))))
            elif part:
                # single characters are lowered by themselves: no final form of the Greek sigma
                low = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                spaced = low.split() if not any(c in low for c in _ODD_SPACE) else regex.split(r"\s+", low)
                found = [self.chunks.get(c) or self._chunk(c) for c in spaced]
                out += [c for c in found if c[0]]  # an empty string between spaces has no ids
        return out


@lru_cache(maxsize=2)
def _coder(source: str) -> Coder:
    return Coder(source)



def encode(docs: DataFrame, path: str, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys``, ``ids`` (array of int) and ``decoded`` (the ids' text) per row; a null text counts as empty.

    Special tokens of the file that stand in a text become their ids. Every row gives one row.
    """

    def columns(codes: list[list]) -> list[pa.Array]:
        ids = [[i for c in row for i in c[0]] for row in codes]
        return [pa.array(ids, type=pa.list_(pa.int32())), pa.array([b" ".join([c[2] for c in row]) for row in codes]).cast(pa.string())]

    return _coded(docs, path, keys, ["ids", "decoded"], "ids array<int>, decoded string", columns)


def digests(docs: DataFrame, path: str, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys``, ``n_tokens`` and the SHA-256 of ids and decoded text, without sending either to the JVM."""

    def columns(codes: list[list]) -> list[pa.Array]:
        n, ids, texts = [], [], []
        for row in codes:
            _, spelt, decoded = zip(*row) if row else ((), (), ())
            written = " ".join(spelt)
            n.append(written.count(" ") + 1 if row else 0)
            ids.append(hashlib.sha256(written.encode()).hexdigest())
            texts.append(hashlib.sha256(b" ".join(decoded)).hexdigest())
        return [pa.array(n, type=pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())]

    return _coded(docs, path, keys, ["n_tokens", "ids_sha256", "decoded_sha256"], "n_tokens bigint, ids_sha256 string, decoded_sha256 string", columns)


def _coded(docs: DataFrame, path: str, keys: tuple[str, ...], names: list[str], ddl: str, columns) -> DataFrame:
    frame = docs.select(*keys, F.col("text").cast("string").alias("text"))
    types = [arrow_type(frame, k) for k in keys]
    with open(path, encoding="utf-8") as file:
        source = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(source.value)
        for batch in text_slices(batches):
            codes = [coder.codes(t.decode()) for t in utf8(batch.column("text"))]
            kept = [batch.column(k).cast(t) for k, t in zip(keys, types)]
            yield pa.RecordBatch.from_arrays([*kept, *columns(codes)], names=[*keys, *names])

    return frame.mapInArrow(run, f"{field_ddl(frame, keys)}, {ddl}")


def decode(frame: DataFrame, path: str, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` and ``decoded`` for a frame with a column ``ids``; null ids decode to the empty text."""
    frame = frame.select(*keys, F.col("ids").cast("array<int>").alias("ids"))
    types = [arrow_type(frame, k) for k in keys]
    with open(path, encoding="utf-8") as file:
        source = frame.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(source.value)
        for batch in text_slices(batches, "ids"):
            decoded = pa.array([coder.decode(ids or ()) for ids in batch.column("ids").to_pylist()], type=pa.binary())
            kept = [batch.column(k).cast(t) for k, t in zip(keys, types)]
            yield pa.RecordBatch.from_arrays([*kept, decoded.cast(pa.string())], names=[*keys, "decoded"])

    return frame.mapInArrow(run, f"{field_ddl(frame, keys)}, decoded string")

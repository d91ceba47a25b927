"""Token alignment between two vocabularies by anchors at word starts, and corpus-wide counts of linked ids.

A text with a space in front is tokenised whole by a byte-level vocabulary (A) and a sentencepiece model (B). Where
tokens of both begin with a space at the same byte, the tokens before them end together, so a document can be cut there
into windows of token ids. Windows repeat: equal (A ids, B ids) have equal alignments, which a worker works out once and
remembers, many new ones at once. Inside a window, byte offsets where tokens of both end bound the groups; all
pairs of a group are links.

Link counts are kept small on the way. A slice of documents has one dictionary of its id pairs, each with the number of
its documents that hold it; documents refer to dictionary places. Only dictionary entries are shuffled, to be summed over
the corpus, and come back once per slice, where they meet the slice's documents again. A frequent pair costs one row
per slice, not one per document, and nothing is broadcast but the two vocabulary files.

Defined results: texts that are null or empty, and texts that a vocabulary doesn't give back byte by byte, have no
tokens. Rows with the same or a null id count each by itself. An empty table gives no rows. Other columns of the
input, whatever their names, play no part.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.bytelevel import as_bytes, byte_level, gathered, pieces
from millwright.llm.common import arrow_type, byte_slices, field_ddl
from millwright.session import written

REMEMBERED, MANY = 400_000, 64  # windows per worker; pairs of a group from which they are counted by distinct ids
LEARNT = 50_000  # new windows aligned at once
_FIGURES = ["n_a", "n_b", "n_groups", "n_links"]
_SLICE = "chunk bigint, " + ", ".join(f"{c} bigint" for c in _FIGURES) + ", groups_sha256 string, links binary, times binary, pairs array<bigint>, docs array<bigint>"
_OUT = ", ".join(f"{c} bigint" for c in [*_FIGURES, "n_best", "count_sum"]) + ", groups_sha256 string"


class Side:
    """The tokens of one vocabulary: their bytes, and which of them begin with a space."""

    def __init__(self, token_bytes: dict[int, bytes]):
        size = max(token_bytes) + 1
        texts = [token_bytes.get(i, b"") for i in range(size)]
        self.length = np.array([len(t) for t in texts], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.blob = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.spaced = np.array([t[:1] == b" " for t in texts])
        spelt = [b"%d," % i for i in range(size)]
        self.spelt_length = np.array([len(t) for t in spelt], dtype=np.int64)
        self.spelt_start = np.cumsum(self.spelt_length) - self.spelt_length
        self.spelt = np.frombuffer(b"".join(spelt), dtype=np.uint8)

    def text(self, ids: np.ndarray) -> bytes:
        return gathered(self.blob, self.start[ids], self.length[ids]).tobytes()


class Aligner:
    """Aligns windows of ids, each distinct one once; the memory is emptied between slices when it is full."""

    def __init__(self, source: str, model: bytes):
        self.a, self.b = byte_level(source, False), pieces(model)
        self.sides = Side(self.a.token_bytes), Side(self.b.token_bytes)
        self.forget()

    def forget(self) -> None:
        self.windows: dict[bytes, int] = {}
        self.pair_place: dict[int, int] = {}
        self.texts: list[bytes] = []  # groups, each with a semicolon behind it
        self.n_groups, self.n_links, self.n_pairs = array("q"), array("q"), array("q")
        self.places, self.times = array("q"), array("q")  # of the windows' pairs, one after the other

    def learn(self, keys: list[bytes]) -> None:
        """Align new windows, each given as A ids, -1, B ids; their numbers follow on."""
        ids = np.frombuffer(b"".join(keys), dtype=np.int32).astype(np.int64)
        owner = np.repeat(np.arange(len(keys)), [len(k) // 4 for k in keys])
        border = np.flatnonzero(ids == -1)
        in_a, in_b = np.arange(len(ids)) < border[owner], np.arange(len(ids)) > border[owner]
        tokens, ends = [ids[in_a], ids[in_b]], []
        for side, own in zip(self.sides, tokens):
            ends.append(np.cumsum(side.length[own]))
        # the sides of a window have as many bytes, so offsets agree over all windows
        both = np.zeros(int(ends[0][-1]) + 1, dtype=bool)
        both[ends[0]] = True
        b_marks = np.zeros(len(both), dtype=bool)
        b_marks[ends[1]] = True
        both &= b_marks
        last = [np.flatnonzero(both[e]) for e in ends]  # the last token of each group
        size = [np.diff(x, prepend=-1) for x in last]
        first = [x - n + 1 for x, n in zip(last, size)]
        window = owner[in_a][last[0]]
        per_window = np.flatnonzero(np.diff(window, prepend=-1))
        n_links = size[0] * size[1]

        few = np.flatnonzero(n_links <= MANY)
        group = np.repeat(few, n_links[few])
        rank = np.arange(len(group)) - np.repeat(np.cumsum(n_links[few]) - n_links[few], n_links[few])
        p, q = tokens[0][first[0][group] + rank // size[1][group]], tokens[1][first[1][group] + rank % size[1][group]]
        pair, times, holder = [p << 32 | q], [np.ones(len(p), dtype=np.int64)], [window[group]]
        for g in np.flatnonzero(n_links > MANY).tolist():
            (p, n), (q, m) = (np.unique(t[f[g] : x[g] + 1], return_counts=True) for t, f, x in zip(tokens, first, last))
            pair.append((p[:, None] << 32 | q).ravel())
            times.append((n[:, None] * m).ravel())
            holder.append(np.full(len(pair[-1]), window[g]))
        distinct, index = np.unique(np.concatenate(pair), return_inverse=True)
        place = np.array([self.pair_place.setdefault(x, len(self.pair_place)) for x in distinct.tolist()], dtype=np.int64)
        key = np.concatenate(holder) * len(distinct) + index
        order = np.argsort(key, kind="stable")
        begin = np.flatnonzero(np.diff(key[order], prepend=-1))
        holder, index = np.divmod(key[order][begin], len(distinct))
        self.places.frombytes(place[index].tobytes())
        self.times.frombytes(np.add.reduceat(np.concatenate(times)[order], begin).tobytes())
        self.n_pairs.frombytes(np.bincount(holder, minlength=len(keys)).astype(np.int64).tobytes())
        self.n_groups.frombytes(np.diff(per_window, append=len(window)).astype(np.int64).tobytes())
        self.n_links.frombytes(np.add.reduceat(n_links, per_window).tobytes())

        # ids as text in the order of the output: a group's A ids, then its B ids
        spelt, length = ([getattr(s, name)[t] for s, t in zip(self.sides, tokens)] for name in ("spelt_start", "spelt_length"))
        ahead = np.cumsum(size[1]) - size[1], np.cumsum(size[0])  # tokens of the other side before those of a group
        at = [np.repeat(x, n) + np.arange(len(t)) for x, n, t in zip(ahead, size, tokens)]
        blob = np.concatenate([s.spelt for s in self.sides])
        starts, lengths = (np.empty(len(at[0]) + len(at[1]), dtype=np.int64) for _ in "sl")
        for k, shift in enumerate((0, len(self.sides[0].spelt))):
            starts[at[k]], lengths[at[k]] = spelt[k] + shift, length[k]
        text, upto = gathered(blob, starts, lengths), np.cumsum(lengths)
        for k, mark in enumerate(b"|;"):
            text[upto[at[k][last[k]]] - 1] = mark
        raw = text.tobytes()
        stops = upto[at[1][last[1][np.concatenate([per_window[1:], [len(window)]]) - 1]]].tolist()
        number = len(self.texts)
        self.texts += [raw[i:j] for i, j in zip([0, *stops], stops)]
        self.windows.update(zip(keys, range(number, len(self.texts))))

    def numbers(self, keys: list[bytes]) -> np.ndarray:
        """The numbers of distinct windows."""
        new = [k for k in keys if k not in self.windows]
        for i in range(0, len(new), LEARNT):
            self.learn(new[i : i + LEARNT])
        return np.fromiter(map(self.windows.__getitem__, keys), dtype=np.int64, count=len(keys))

    def tokens(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """A and B ids per text, as native 32-bit numbers; empty where the joined tokens aren't the text."""
        coded = [(as_bytes(self.a.ids(" " + t)), as_bytes(self.b.ids(t))) if t else (b"", b"") for t in texts]
        same = np.ones(len(texts), dtype=bool)
        for side, codes in zip(self.sides, zip(*coded)):
            ids = np.frombuffer(b"".join(codes), dtype=np.uint32)
            joined = memoryview(side.text(ids))
            bytes_before = np.concatenate([[0], np.cumsum(side.length[ids])])
            ends = bytes_before[np.concatenate([[0], np.cumsum([len(c) // 4 for c in codes])])].tolist()
            same &= [joined[p:q] == (" " + t).encode() for p, q, t in zip(ends, ends[1:], texts)]
        return [c if ok else (b"", b"") for c, ok in zip(coded, same.tolist())]

    def windows_of(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the windows begin among the A tokens, the distinct windows, and the place there of each window."""
        starts, marks = [], []
        for side, ids in zip(self.sides, (a, b)):
            length = side.length[ids]
            at = np.flatnonzero(side.spaced[ids])
            begin = (np.cumsum(length) - length)[at]
            mark = np.zeros(int(length.sum()) + 1, dtype=bool)
            mark[begin] = True
            starts.append((at, begin))
            marks.append(mark)
        (at, begin), (bt, bbegin) = starts
        wa, wb = at[marks[1][begin]], bt[marks[0][bbegin]]  # both sides begin a token with a space at this byte
        na, nb = np.diff(wa, append=len(a)), np.diff(wb, append=len(b))
        ends = np.cumsum(na + nb + 1)
        first = ends - (na + nb + 1)
        keys = np.full(int(ends[-1]), -1, dtype=np.int32)
        keys[np.repeat(first - wa, na) + np.arange(len(a))] = a
        keys[np.repeat(first + na + 1 - wb, nb) + np.arange(len(b))] = b
        offsets = np.concatenate([[0], ends * 4]).astype(np.int64)
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(wa), [None, pa.py_buffer(offsets), pa.py_buffer(keys)]).dictionary_encode()
        return wa, coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy()

    def align(self, texts: list[str], with_groups: bool) -> tuple[list, np.ndarray, np.ndarray]:
        """Columns per text in the order of the output, and the slice's pairs with the number of texts that hold them."""
        if len(self.texts) > REMEMBERED or len(self.places) > 4 * REMEMBERED:
            self.forget()
        coded = self.tokens(texts)
        n_a, n_b = (np.array([len(c[k]) // 4 for c in coded], dtype=np.int64) for k in (0, 1))
        full = np.flatnonzero(n_a)
        figures = np.zeros((2, len(texts)), dtype=np.int64)
        hashes, spelled, links, times = [""] * len(texts), [""] * len(texts), [b""] * len(texts), [b""] * len(texts)
        none = np.zeros(0, dtype=np.int64)
        if not len(full):
            return [n_a, n_b, *figures, hashes, links, times, spelled], none, none
        a, b = (np.frombuffer(b"".join([c[k] for c in coded]), dtype=np.uint32).astype(np.int32) for k in (0, 1))
        wa, distinct, index = self.windows_of(a, b)
        window = self.numbers(distinct.tolist())[index]
        first = np.searchsorted(wa, (np.cumsum(n_a) - n_a)[full])  # the first window of each text with tokens
        for row, kind in zip(figures, (self.n_groups, self.n_links)):
            row[full] = np.add.reduceat(np.array(kind, dtype=np.int64)[window], first)
        numbers, ends = window.tolist(), [*first[1:].tolist(), len(window)]
        for k, p, q in zip(full.tolist(), first.tolist(), ends):
            text = b"".join([self.texts[w] for w in numbers[p:q]])[:-1]
            hashes[k] = hashlib.sha256(text).hexdigest()
            if with_groups:
                spelled[k] = text.decode()
        n_pairs = np.array(self.n_pairs, dtype=np.int64)
        count, start = n_pairs[window], (np.cumsum(n_pairs) - n_pairs)[window]
        place = gathered(np.array(self.places, dtype=np.int64), start, count)
        weight = gathered(np.array(self.times, dtype=np.int64), start, count)
        owner = np.repeat(np.repeat(np.arange(len(full)), np.diff(first, append=len(window))), count)
        key = owner * len(self.pair_place) + place
        order = np.argsort(key, kind="stable")
        key = key[order]
        begin = np.flatnonzero(np.diff(key, prepend=-1))
        weight = np.add.reduceat(weight[order], begin).astype(np.uint32)
        owner, place = np.divmod(key[begin], len(self.pair_place))
        held = np.bincount(place, minlength=len(self.pair_place))
        local = (np.cumsum(held > 0) - 1)[place].astype(np.uint32)
        ends = np.searchsorted(owner, np.arange(len(full) + 1)).tolist()
        for k, p, q in zip(full.tolist(), ends, ends[1:]):
            links[k], times[k] = local[p:q].tobytes(), weight[p:q].tobytes()
        pairs = np.fromiter(self.pair_place, dtype=np.int64, count=len(held))
        return [n_a, n_b, *figures, hashes, links, times, spelled], pairs[held > 0], held[held > 0]


@lru_cache(maxsize=1)
def _aligner(source: str, model: bytes) -> Aligner:
    return Aligner(source, model)


def aligned(docs: DataFrame, a_path: str, b_path: str, keys: Sequence[str] = ("doc_id",), with_groups: bool = False) -> DataFrame:
    """``keys`` and the figures of each document (and its groups as text), with its links by place in its slice's dictionary.

    The first row of a slice carries the dictionary: pairs (A id in the upper, B id in the lower 32 bits) and docs.
    """
    frame = docs.select(*(F.col(k).alias(f"key{i}") for i, k in enumerate(keys)), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = [f"key{i}" for i in range(len(keys))]
    types = [arrow_type(frame, k) for k in own]
    context = docs.sparkSession.sparkContext
    with open(a_path, encoding="utf-8") as a_file, open(b_path, "rb") as b_file:
        files = context.broadcast((a_file.read(), b_file.read()))
    names = [*own, *(c.split()[0] for c in _SLICE.split(", ")), *(["groups"] if with_groups else [])]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, chunk = _aligner(*files.value), TaskContext.get().partitionId() << 32
        for batch in byte_slices(batches):
            (*columns, spelled), pairs, held = aligner.align(batch.column("text").to_pylist(), with_groups)
            n = batch.num_rows
            arrays = [batch.column(k).cast(t) for k, t in zip(own, types)]
            arrays += [pa.array(np.full(n, chunk)), *map(pa.array, columns[:5]), *(pa.array(c, type=pa.binary()) for c in columns[5:])]
            arrays += [pa.array([x.tolist(), *[None] * (n - 1)], type=pa.list_(pa.int64())) for x in (pairs, held)]
            yield pa.RecordBatch.from_arrays(arrays + ([pa.array(spelled)] if with_groups else []), names=names)
            chunk += 1

    return frame.mapInArrow(run, f"{field_ddl(frame, own)}, {_SLICE}" + (", groups string" if with_groups else ""))


def _entries(found: DataFrame) -> DataFrame:
    entry = found.where("pairs is not null").select("chunk", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "entry"))
    return entry.select("chunk", "place", F.col("entry.pairs").alias("pair"), F.col("entry.docs").alias("docs"))


def link_counts(found: DataFrame) -> DataFrame:
    """(a_id, b_id, docs, best): in how many documents a pair is linked, and whether no other B id is linked to a_id in more."""
    counts = written(_entries(found).groupBy("pair").agg(F.sum("docs").alias("docs")), "link-counts")
    counts = counts.select(F.shiftright("pair", 32).alias("a_id"), (F.col("pair").bitwiseAND(0xFFFFFFFF)).alias("b_id"), "docs")
    most = counts.groupBy("a_id").agg(F.max("docs").alias("most"))
    return counts.join(most, "a_id").select("a_id", "b_id", "docs", (F.col("docs") == F.col("most")).alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str, keys: Sequence[str] = ("doc_id",), with_groups: bool = False) -> DataFrame:
    """``keys``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (and groups) per document."""
    found = written(aligned(docs, a_path, b_path, keys, with_groups), "aligned")
    counts = link_counts(found).select((F.shiftleft("a_id", 32) + F.col("b_id")).alias("pair"), F.col("docs").alias("count"), "best")
    scores = _entries(found).join(counts, "pair").select(F.col("chunk").alias("of"), "place", "count", "best")
    own = [f"key{i}" for i in range(len(keys))]
    more = ["groups"] if with_groups else []
    names = [*own, *_FIGURES, "n_best", "count_sum", "groups_sha256", *more]

    def scored(rows: pa.Table, score: pa.Table) -> pa.Table:
        """The rows of a slice with the sums over their links; ``score`` has a row per dictionary entry."""
        order = np.argsort(score["place"].to_numpy())
        counts, best = score["count"].to_numpy()[order], score["best"].to_numpy()[order].astype(np.int64)
        links = rows["links"].to_pylist()
        place = np.frombuffer(b"".join(links), dtype=np.uint32)
        weight = np.frombuffer(b"".join(rows["times"].to_pylist()), dtype=np.uint32).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in links])])
        sums = [np.diff(np.concatenate([[0], np.cumsum(weight * x[place])])[ends]) for x in (best, counts)]
        figures = [rows[c] for c in _FIGURES]
        return pa.table([*(rows[k] for k in own), *figures, *map(pa.array, sums), *(rows[c] for c in ["groups_sha256", *more])], names=names)

    ddl = ", ".join(f"{k} {found.schema[k].dataType.simpleString()}" for k in own) + f", {_OUT}" + (", groups string" if with_groups else "")
    rows = found.drop("pairs", "docs").groupBy("chunk").cogroup(scores.groupBy("of"))
    out = rows.applyInArrow(scored, ddl)
    return out.select(*(F.col(o).alias(k) for o, k in zip(own, keys)), *names[len(own) :])

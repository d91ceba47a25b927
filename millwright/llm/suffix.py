"""Removal of repeated byte strings with suffix arrays, in shards that hold all places of a string.

A byte goes if a string of ``LENGTH`` bytes over it also starts in a document with a smaller id.

1. Anchors. Every window of ``LENGTH`` bytes has an anchor, the k-gram of smallest hash in it (the leftmost of ties).
   Neighbouring windows with one anchor form a segment. Equal windows have equal anchors, so all places of a string meet
   in the shard of its anchor, which finds the anchors that several documents have. Only hashes and places travel.
   Of equal segments in one slice of documents only those of the smallest id take part; the others are repeats,
   whatever else is found. This keeps a very common passage to one segment a slice.
2. Suffix arrays. Segments of shared anchors, with their bytes, go to the shards. A shard keeps one copy of equal
   segments. A string of ``LENGTH`` bytes reaches ``SIDE`` bytes to the left or to the right of its anchor, so a segment
   that agrees with none of another smallest id on either side has no string in common with one. The others are sorted
   by induced sorting, a bounded number of bytes at a time, whole anchors together. Permuted common prefixes of ``LENGTH``
   symbols or more join neighbours to classes of equal strings; the smallest id of each class decides.
3. Repeated spans return to their documents, overlap is merged, and what is left is hashed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import ROW, numbered, text_slices, utf8
from millwright.llm.induced import capped_prefixes, suffix_array
from millwright.session import written

LENGTH, GRAM = 50, 16
SIDE = -(-(LENGTH - GRAM) // 2)
SHARD_BYTES = 4 << 20  # of text for each shard; its segments take about four times that
SORTED_BYTES = 2 << 20  # of segments sorted at once
_CHUNK = 4 << 20  # a longer text is read in overlapping chunks
_BLOCK = 32 << 10  # bytes hashed at once, few enough for a processor's cache
_PLACE = np.uint64((1 << 24) - 1)
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LAST = (1 << 63) - 1
_FIELDS = (("doc", np.int64), ("row", np.int64), ("start", np.int64), ("size", np.uint8), ("check", np.uint32))
_TEXT_FIELDS = (*_FIELDS, ("anchor", np.uint8))


def _anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per window start: order key and place of the anchor in one number; and the hash of the k-gram at each place."""
    least, hashed = np.empty(max(0, len(data) - LENGTH + 1), dtype=np.uint64), np.empty(max(0, len(data) - GRAM + 1), dtype=np.uint64)
    for at in range(0, len(data), _BLOCK):
        part = _block_anchors(data[at : at + _BLOCK + LENGTH - 1], at)
        for out, own in zip((least, hashed), part):
            out[at : at + len(own)] = own
    return least, hashed


def _block_anchors(data: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    x = data.astype(np.uint64) + np.uint64(1)
    width = 1
    while width < GRAM and len(x) > width:
        x = x[:-width] * np.uint64(pow(int(_BASE), width, 1 << 64)) + x[width:]
        width *= 2
    if width < GRAM:
        return x[:0], x[:0]
    hashed = (x ^ (x >> np.uint64(31))) * _MIX
    hashed ^= hashed >> np.uint64(29)
    least = (hashed & ~_PLACE) | np.arange(first, first + len(hashed), dtype=np.uint64)
    reach, wanted = 1, LENGTH - GRAM + 1
    while reach < wanted:
        step = min(reach, wanted - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    return least, hashed


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes at a and at b are equal."""
    out = np.ones(len(a), dtype=bool)
    live = np.arange(len(a))
    for k in range(int(size.max(initial=0))):
        live = live[size[live] > k]
        differ = data[a[live] + k] != data[b[live] + k]
        out[live[differ]] = False
        live = live[~differ]
    return out


def _merged(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of spans that touch, within each row."""
    if not len(row):
        return row, start, end
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    first = np.concatenate([[True], row[1:] != row[:-1]])
    # ends grow along a row once every row is lifted above the one before it
    lift = np.cumsum(first) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift)
    fresh = first | np.concatenate([[True], (start + lift)[1:] > reach[:-1]])
    at = np.flatnonzero(fresh)
    last = np.concatenate([at[1:], [len(row)]]) - 1
    return row[at], start[at], (reach - lift)[last]


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Numbers, offsets and bytes of texts or of chunks of long ones, at most about ``_CHUNK`` bytes together."""
    held: tuple[list[int], list[int], list[bytes]] = ([], [], [])
    size = 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), _CHUNK):
            part = text[at : at + _CHUNK + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            if size + len(part) > _CHUNK + LENGTH and held[0]:
                yield held
                held, size = ([], [], []), 0
            for h, v in zip(held, (i, at, part)):
                h.append(v)
            size += len(part)
    if held[0]:
        yield held


class _Segments:
    """The segments of some texts: arrays doc, row, start and size in bytes; check, shard and place (in the segment) of the anchor."""

    def __init__(self, doc: np.ndarray, row: np.ndarray, piece: tuple[list[int], list[int], list[bytes]], shards: int):
        number, offset, parts = piece
        self.data = np.frombuffer(b"".join(parts), dtype=np.uint8)
        sizes = np.array([len(p) for p in parts])
        begin = np.cumsum(sizes) - sizes
        least, self.hashed = _anchors(self.data)
        fresh = np.ones(len(least) + 1, dtype=bool)
        fresh[1:-1] = least[1:] != least[:-1]
        fresh[begin] = fresh[begin + sizes - LENGTH + 1] = True  # the first window of a text, and the first that lies in two
        at = np.flatnonzero(fresh)
        owner = np.searchsorted(begin, at[:-1], side="right") - 1
        inside = at[:-1] + LENGTH <= (begin + sizes)[owner]
        self.first, owner = at[:-1][inside], owner[inside]
        self.size = np.diff(at)[inside] + LENGTH - 1
        self.text = np.array(number)[owner]
        self.doc, self.row = doc[self.text], row[self.text]
        self.start = self.first - begin[owner] + np.array(offset)[owner]
        place = (least[self.first] & _PLACE).astype(np.int64)
        self.anchor, gram = place - self.first, self.hashed[place]
        self.check = (gram & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        self.shard = (gram >> np.uint64(32)).astype(np.int64) % shards

    def keep(self, which: np.ndarray) -> None:
        for name in ("first", "size", "text", "doc", "row", "start", "check", "shard", "anchor"):
            setattr(self, name, getattr(self, name)[which])

    def drop_repeats(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leave out segments equal to one of a smaller id; their spans."""
        data, first, size = self.data, self.first, self.size
        content = size.astype(np.uint64)
        for k in range(0, 2 * LENGTH - GRAM, GRAM):  # grams over the longest segment
            content = content * _BASE + self.hashed[first + np.minimum(k, size - GRAM)]
        order = np.argsort(content)
        equal = content[order][1:] == content[order][:-1]
        some = order[np.concatenate([[False], equal]) | np.concatenate([equal, [False]])] if len(order) else order
        some = some[np.lexsort((self.doc[some], content[some]))]
        fresh = np.concatenate([[True], content[some][1:] != content[some][:-1]])[: len(some)]
        leader = np.arange(len(first))
        leader[some] = some[np.maximum.accumulate(np.where(fresh, np.arange(len(some)), 0))]
        later = np.flatnonzero((self.doc > self.doc[leader]) & (size == size[leader]))
        later = later[_equal(data, first[later], first[leader[later]], size[later])]
        spans = _merged(self.row[later], self.start[later], self.start[later] + size[later])
        self.keep(np.delete(np.arange(len(first)), later))
        return spans

    def packed(self, with_text: bool) -> Iterator[tuple[int, bytes]]:
        """(shard, packed segments) of each shard touched."""
        packer = zstandard.ZstdCompressor(level=3)
        order = np.argsort(self.shard, kind="stable")
        shard, size = self.shard[order], self.size[order]
        cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else np.zeros(1, dtype=np.int64)
        columns = []
        for name, kind in _TEXT_FIELDS if with_text else _FIELDS:
            values = getattr(self, name)[order].astype(kind)
            # ids and places come in order: differences are small and pack well
            steps = values.copy()
            steps[1:] -= values[:-1]
            steps[cuts[:-1]] = values[cuts[:-1]]
            columns.append(steps)
        if with_text:
            longest = int(size.max(initial=LENGTH))
            held = np.concatenate([self.data, np.zeros(longest, dtype=np.uint8)])
            text = np.lib.stride_tricks.sliding_window_view(held, longest)[self.first[order]][np.arange(longest) < size[:, None]]
            place = np.concatenate([[0], np.cumsum(size)])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            raw = [np.int64(b - a).tobytes(), *(c[a:b].tobytes() for c in columns)]
            if with_text:
                raw.append(text[place[a] : place[b]].tobytes())
            yield int(shard[a]), packer.compress(b"".join(raw))


def _unpacked(payloads: list[bytes], kinds: tuple[tuple[str, type], ...] = _FIELDS) -> tuple[dict[str, np.ndarray], np.ndarray]:
    fields: dict[str, list[np.ndarray]] = {name: [] for name, _ in kinds}
    texts = []
    for raw in map(zstandard.ZstdDecompressor().decompress, payloads):
        n, at = int(np.frombuffer(raw, np.int64, 1)[0]), 8
        for name, kind in kinds:
            fields[name].append(np.cumsum(np.frombuffer(raw, kind, n, at), dtype=kind))
            at += n * np.dtype(kind).itemsize
        texts.append(np.frombuffer(raw, np.uint8, offset=at))
    return {k: np.concatenate(v) for k, v in fields.items()}, np.concatenate(texts)


def _grouped(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order by key; first place and size of each key's group in it; whether several documents have the key."""
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
    many = np.concatenate([head[1:], [len(key)]])[: len(head)] - head
    return order, head, many, doc[head] != doc[head + many - 1]


def shared_anchors(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(row, start) of a shard's segments whose anchor stands in several documents, in order of rows."""
    seg, _ = _unpacked(payloads)
    order, _, many, shared = _grouped(seg["check"], seg["doc"])
    members = order[np.repeat(shared, many)]
    members = members[np.lexsort((seg["start"][members], seg["row"][members]))]
    return seg["row"][members], seg["start"][members]


def _related(data: np.ndarray, begin: np.ndarray, size: np.ndarray, anchor: np.ndarray, check: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether a segment of ``data`` agrees on ``SIDE`` bytes beside its anchor with one of another smallest id; no hash decides more."""
    out = np.zeros(len(begin), dtype=bool)
    for at, inside in ((anchor - SIDE, anchor >= SIDE), (anchor + GRAM, anchor + GRAM + SIDE <= size)):
        own = np.flatnonzero(inside)
        at, key = (begin + at)[own], check[own].astype(np.uint64)
        for k in range(SIDE):
            key = key * _BASE + data[at + k]
        order, _, many, shared = _grouped(key, least[own])
        out[own[order[np.repeat(shared, many)]]] = True
    return out


def shard_repeats(payloads: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, start, end) of the spans in a shard's segments that repeat strings of smaller ids."""
    seg, text = _unpacked(payloads, _TEXT_FIELDS)
    size, anchor = (seg[k].astype(np.int64) for k in ("size", "anchor"))
    place = np.cumsum(size) - size
    order, head, many, shared = _grouped(seg["check"], seg["doc"])
    raw = text.tobytes()
    # whole anchors, about SORTED_BYTES of text at a time
    upto = np.cumsum(np.add.reduceat(size[order], head) * shared) // SORTED_BYTES
    held: list[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []  # to be sorted together
    waiting = 0
    for load in np.unique(upto[shared]).tolist():
        members = order[np.repeat(shared & (upto == load), many)]
        doc, row, start = (seg[k][members] for k in ("doc", "row", "start"))
        number: dict[bytes, int] = {}
        content = np.array([number.setdefault(raw[a : a + n], len(number)) for a, n in zip(place[members].tolist(), size[members].tolist())])
        least = np.full(len(number), _LAST, dtype=np.int64)
        np.minimum.at(least, content, doc)
        later = doc > least[content]
        if later.any():
            yield row[later], start[later], start[later] + size[members[later]]
        one = np.empty(len(number), dtype=np.int64)
        one[content] = members  # any of the equal ones
        kept = _related(text, place[one], size[one], anchor[one], seg["check"][one], least)
        holders = np.flatnonzero(~later & kept[content])
        if len(holders):
            texts = [raw[a : a + n] for a, n in zip(place[one[kept]].tolist(), size[one[kept]].tolist())]
            held.append((texts, least[kept], (np.cumsum(kept) - 1)[content[holders]], row[holders], start[holders]))
            waiting += sum(map(len, texts))
        if waiting >= SORTED_BYTES:
            yield from _sorted_repeats(held)
            held, waiting = [], 0
    if held:
        yield from _sorted_repeats(held)


def _sorted_repeats(held: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Spans of different texts, with the smallest id of each, and of the segments that hold them: text, row and start."""
    texts = [t for h in held for t in h[0]]
    above = np.cumsum([0, *(len(h[0]) for h in held)])
    content = np.concatenate([h[2] + a for h, a in zip(held, above.tolist())])
    least, row, start = (np.concatenate([h[k] for h in held]) for k in (1, 3, 4))
    lengths = np.array([len(t) for t in texts])
    symbols = np.frombuffer(b"\0".join([*texts, b""]), dtype=np.uint8).astype(np.uint16) + 1
    begin = np.cumsum(lengths + 1) - (lengths + 1)
    symbols[begin + lengths] = 0
    array = suffix_array(symbols, 257)
    fresh = capped_prefixes(symbols, array, LENGTH)[array] < LENGTH
    owner = np.repeat(np.arange(len(texts)), lengths + 1)
    of = owner[array]
    whole = begin[of] + lengths[of] - array >= LENGTH
    head = np.flatnonzero(fresh)
    smallest = np.minimum.reduceat(least[of], head)[np.cumsum(fresh) - 1]
    hit = np.zeros(len(symbols), dtype=bool)
    hit[array[whole & (smallest < least[of])]] = True
    at = np.flatnonzero(hit)
    if not len(at):
        return
    fresh = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])])
    first, last = at[fresh], at[np.concatenate([fresh[1:], [True]])]
    which = owner[first]
    # each span counts for all segments of that content and the content's smallest id
    holders = np.argsort(content, kind="stable")
    low = np.searchsorted(content[holders], which, side="left")
    times = np.searchsorted(content[holders], which, side="right") - low
    span = np.repeat(np.arange(len(which)), times)
    rank = np.arange(len(span)) - np.repeat(np.cumsum(times) - times, times)
    holder = holders[low[span] + rank]
    skip = first - begin[which]
    yield row[holder], start[holder] + skip[span], start[holder] + (last + LENGTH - begin[which])[span]


_PACKED = "shard bigint, payload binary, row bigint, start array<bigint>, end array<bigint>"
_LONGS = pa.list_(pa.int64())


def _batch(shard: list[int], payload: list[bytes | None], row: list[int | None], start: list, end: list) -> pa.RecordBatch:
    arrays = [pa.array(shard, pa.int64()), pa.array(payload, pa.binary()), pa.array(row, pa.int64()), pa.array(start, _LONGS), pa.array(end, _LONGS)]
    return pa.RecordBatch.from_arrays(arrays, names=["shard", "payload", "row", "start", "end"])


def _per_row(shard: list[int] | None, row: np.ndarray, start: np.ndarray, end: np.ndarray | None) -> pa.RecordBatch:
    """A row for each ``row`` with lists of its starts and ends; equal rows are adjacent."""
    head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])[: len(row)])
    cuts = pa.array(np.concatenate([head, [len(row)]]).astype(np.int32))
    lists = [pa.ListArray.from_arrays(cuts, pa.array((v if v is not None else start[:0]).astype(np.int64))) if v is not None else pa.nulls(len(head), _LONGS) for v in (start, end)]
    arrays = [pa.nulls(len(head), pa.int64()) if shard is None else pa.array(row[head] % shard[0]), pa.nulls(len(head), pa.binary()), pa.array(row[head]), *lists]
    return pa.RecordBatch.from_arrays(arrays, names=["shard", "payload", "row", "start", "end"])


def _per_shard(batches: Iterable[pa.RecordBatch], work) -> Iterator[pa.RecordBatch]:
    """``work`` on the payloads of each shard; rows come sorted by shard, those without payload pass."""
    last, held = None, []
    for batch in batches:
        passing = batch.filter(batch.column("payload").is_null())
        if passing.num_rows:
            yield passing
        rest = batch.filter(batch.column("payload").is_valid())
        for shard, payload in zip(rest.column("shard").to_pylist(), rest.column("payload")):
            if shard != last:
                if held:
                    yield from work(held)
                last, held = shard, []
            held.append(payload.as_py())
    if held:
        yield from work(held)


def _compressed(frame: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``keys`` (longs) and the text as ``packed``, for joins that must move every text; a null text is empty."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in text_slices(batches):
            packed = pa.array([packer.compress(t) for t in utf8(batch.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), packed], names=[*keys, "packed"])

    return frame.select(*keys, "text").mapInArrow(run, ", ".join(f"{k} bigint" for k in keys) + ", packed binary")


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    unpacker = zstandard.ZstdDecompressor()
    return [unpacker.decompress(t) for t in batch.column("packed").to_pylist()]


def repeated_spans(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(row, start, end) of repeated spans, by ROW of ``docs`` (doc_id, text, ROW), as lists; spans may overlap."""
    frame = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("doc"), F.col(ROW).alias("row"), F.col("text").cast("string").alias("text")
    )
    total = frame.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))

    def segments(batch: pa.RecordBatch, texts: list[bytes]) -> Iterator[_Segments]:
        doc, row = batch.column("doc").to_numpy(), batch.column("row").to_numpy()
        for piece in _pieces(texts):
            yield _Segments(doc, row, piece, shards)

    def packed(found: _Segments, with_text: bool) -> Iterator[pa.RecordBatch]:
        repeats = found.drop_repeats()
        if len(repeats[0]):
            yield _per_row([shards], *repeats)
        for shard, payload in found.packed(with_text):
            yield _batch([shard], [payload], [None], [None], [None])

    def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            for found in segments(batch, utf8(batch.column("text"))):
                yield from packed(found, False)

    def asked(payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
        row, start = shared_anchors(payloads)
        if len(row):
            yield _per_row(None, row, start, None)

    def texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "packed"):
            wanted = batch.column("wanted")
            at = np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy()))
            wanted = (at << 40) + wanted.flatten().to_numpy()
            for found in segments(batch, _texts(batch)):
                found.keep(np.isin((found.text << 40) + found.start, wanted))
                if len(found.first):
                    yield from packed(found, True)

    def repeats(payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
        for spans in shard_repeats(payloads):
            yield _per_row(None, *_merged(*spans))

    dealt = frame.mapInArrow(places, _PACKED).repartition("shard").sortWithinPartitions("shard")
    found = written(dealt.mapInArrow(lambda b: _per_shard(b, asked), _PACKED).drop("shard", "payload"), "shared-anchors")
    wanted = found.where("end is null").groupBy("row").agg(F.flatten(F.collect_list("start")).alias("wanted"))
    cut = _compressed(frame, ("doc", "row")).join(wanted, "row").mapInArrow(texts, _PACKED)
    sorted_ = cut.repartition("shard").sortWithinPartitions("shard").mapInArrow(lambda b: _per_shard(b, repeats), _PACKED)
    return found.where("end is not null").unionByName(sorted_.select("row", "start", "end"))


def without_repeats(docs: DataFrame, shard_bytes: int = SHARD_BYTES, with_kept: bool = True) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left, or null).

    Every row gives one row. Null and empty texts have no bytes. Rows that share an id don't take from each other, and a
    null id counts as larger than any other. Texts under ``LENGTH`` bytes stay whole.
    """
    rows = numbered(docs, "doc_id", "text")
    spans = written(repeated_spans(rows, shard_bytes), "repeated-spans")
    lists = spans.groupBy(F.col("row").alias(ROW)).agg(
        F.flatten(F.collect_list("start")).alias("start"), F.flatten(F.collect_list("end")).alias("end")
    )
    texts = rows.select(ROW, F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = _compressed(texts, (ROW, "doc_id")).join(lists, ROW, "left").select("doc_id", "packed", "start", "end")

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "packed"):
            out = []
            for text, starts, ends in zip(_texts(batch), batch.column("start"), batch.column("end")):
                kept, removed, n = [text], 0, 0
                if starts.is_valid:
                    a, b = (s.values.to_numpy() for s in (starts, ends))
                    _, a, b = _merged(np.zeros(len(a), dtype=np.int64), a, b)
                    kept = [text[i:j] for i, j in zip([0, *b.tolist()], [*a.tolist(), len(text)])]
                    removed, n = int((b - a).sum()), len(a)
                left = b"".join(kept)
                out.append((len(text), removed, n, hashlib.sha256(left).hexdigest(), left if with_kept else None))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return joined.mapInArrow(finish, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")

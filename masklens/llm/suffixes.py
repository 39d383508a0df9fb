"""Repeated passages by a depth-limited radix sort of suffixes.

Two places of the corpus share a window of ``width`` bytes exactly if their suffixes agree to that depth, so
suffixes are ordered only so far. The passes go from the most significant digit down, and what is unique
after a digit is dropped:

1. The leading digit of a suffix is its anchor: of the 16-byte grams of a window, the one of smallest hash.
   Equal windows have equal anchors at equal distances, so consecutive windows with one anchor go together
   as a unit. A pass over anchor hashes keeps those that occur in several documents.
2. Units of kept anchors are dealt out by anchor with their bytes. Windows with the same anchor at the same
   distance are ordered by 8-byte digits down to the full width; in each pass only ties go on. Groups that
   are still tied after the last digit are exactly the repeated windows; each has a smallest document.

The answers (the smallest document of every window of a unit) go back to the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masklens.llm.common import stored

GRAM = 16
#: plain bytes of texts in one chunk, bytes anchored at once, and plain bytes of text per key bucket
CHUNK_BYTES, SLICE_BYTES, BUCKET_BYTES = 4 << 20, 1 << 19, 4 << 20
#: shapes of units of one anchor (windows and place of the anchor, told apart in each chunk) from which on its windows are dealt
#: out by their own content
HOT_SHAPES = 4096
PLACE = (1 << 20) - 1  # low bits of a sort key hold the place in a slice; slice and window stay below it
NO_ID = np.iinfo(np.int64).min
CHUNKS = "chunk long, plain long, blob binary"


class Units(NamedTuple):
    """Runs of windows with one anchor: document number, first window, windows, anchor hash, anchor's place."""

    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    place: np.ndarray


def _zip(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(data)


def _unzip(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def pack_texts(ids: list, texts: list[bytes]) -> bytes:
    """Ids (None allowed) and texts of a chunk as one compressed blob."""
    head = np.array([len(ids), *[NO_ID if i is None else i for i in ids], *[i is None for i in ids], *map(len, texts)],
                    dtype=np.int64)
    return _zip(head.tobytes() + b"".join(texts))


def unpack_texts(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """(ids, which are null, offsets of the texts and of their end, all bytes)."""
    raw = _unzip(blob)
    n = int(np.frombuffer(raw, dtype=np.int64, count=1)[0])
    head = np.frombuffer(raw, dtype=np.int64, count=1 + 3 * n)
    return head[1:1 + n], head[1 + n:1 + 2 * n] != 0, np.concatenate([[0], np.cumsum(head[1 + 2 * n:])]), raw[head.nbytes:]


def anchored_units(data: bytes, bounds: np.ndarray, width: int) -> Units:
    """The units of all texts (``bounds`` as in ``unpack_texts``); no window crosses a text's end."""
    found: list[Units] = []
    grams = width - GRAM + 1
    for begin in range(0, max(0, len(data) - width + 1), SLICE_BYTES):
        end = min(begin + SLICE_BYTES, len(data) - width + 1)  # window starts of this slice
        piece = np.frombuffer(data, dtype=np.uint8, count=end - begin + width - 1, offset=begin)
        eight = np.ndarray(len(piece) - 7, dtype="<u8", buffer=piece, strides=(1,))
        h = eight[:len(piece) - GRAM + 1] * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        h += eight[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        low = (h & np.uint64(~PLACE & 0xFFFFFFFFFFFFFFFF)) | np.arange(len(h), dtype=np.uint64)
        span = 1
        while 2 * span <= grams:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < grams:
            low = np.minimum(low[:len(low) - (grams - span)], low[grams - span:])
        place = (low & np.uint64(PLACE)).astype(np.int64)  # one per window start
        starts = np.arange(begin, end)
        doc = np.searchsorted(bounds, starts, side="right") - 1
        fits = starts + width <= bounds[doc + 1]
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]) | ~fits[:-1]
        first = np.flatnonzero(new & fits)
        stops = np.flatnonzero(np.append(new[1:] | ~fits[1:], True) & fits)
        found.append(Units(doc[first], first + begin, stops - first + 1, h[place[first]], place[first] + begin))
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return Units(none, none, none, none.astype(np.uint64), none)
    return Units(*[np.concatenate(x) for x in zip(*found, strict=True)])


def _known(units: Units, null: np.ndarray) -> Units:
    """Without the units of texts that have no id."""
    keep = ~null[units.doc]
    return Units(*[x[keep] for x in units])


def chunk_anchors(units: Units, ids: np.ndarray, buckets: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By key bucket: a chunk's distinct anchors, ascending, which of them have several documents here, and how many shapes of
    units (windows, place of the anchor) they have."""
    if not len(units.anchor):
        return {}
    order = np.lexsort((ids[units.doc], units.anchor))
    anchor, doc = units.anchor[order], ids[units.doc][order]
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    last = np.append(first[1:], len(anchor)) - 1
    shape = (units.count << 32 | (units.place - units.start))[order]
    by_shape = np.lexsort((shape, anchor))
    new = np.append(True, (shape[by_shape][1:] != shape[by_shape][:-1]) | (anchor[by_shape][1:] != anchor[by_shape][:-1]))
    shapes = np.add.reduceat(new.astype(np.int64), first)  # anchors stand in the same order
    many, anchor = doc[first] != doc[last], anchor[first]
    bucket = (anchor % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.append(True, bucket[by][1:] != bucket[by][:-1]))
    return {int(bucket[own[0]]): (anchor[own], many[own], shapes[own]) for own in np.split(by, cuts[1:])}


class Records(NamedTuple):
    """Distinct units: fingerprint, anchor hash, distance of the anchor from the first window, bytes, smallest id.

    A unit is known by its fingerprint, anchor hash and size: over 128 bits of its content.
    """

    print: np.ndarray
    anchor: np.ndarray
    distance: np.ndarray
    size: np.ndarray
    doc: np.ndarray


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def fingerprints(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, mix: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """64-bit fingerprints of byte runs (of 8 bytes at least), from their 8-byte words and the last 8 bytes."""
    eight = np.ndarray(max(0, len(data) - 7), dtype="<u8", buffer=data, strides=(1,))
    h = sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(0, int(sizes.max(initial=0)), 8):
        more = np.flatnonzero(sizes > j)
        at = np.minimum(starts[more] + j, starts[more] + sizes[more] - 8)
        x = (h[more] ^ eight[at]) * np.uint64(mix)
        h[more] = x ^ (x >> np.uint64(32))
    return h


def distinct(records: Records) -> tuple[np.ndarray, np.ndarray]:
    """(one index per distinct unit, the number of each record's unit); units are numbered in key order."""
    order = np.lexsort((records.size, records.print, records.anchor))
    new = np.ones(len(order), dtype=bool)
    for x in (records.size, records.print, records.anchor):
        if len(order):
            new[1:] = new[1:] & (x[order][1:] == x[order][:-1])
    new[1:] = ~new[1:]
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def chunk_records(units: Units, ids: np.ndarray, data: bytes, kept: np.ndarray, width: int):
    """A chunk's units of kept anchors: which units they are, each one's record, the records in key order, and
    where each record's bytes start."""
    at = np.searchsorted(kept, units.anchor)
    at[at == len(kept)] = 0
    mine = np.flatnonzero(kept[at] == units.anchor) if len(kept) else np.zeros(0, dtype=np.int64)
    start, size = units.start[mine], units.count[mine] + width - 1
    raw = Records(fingerprints(np.frombuffer(data, dtype=np.uint8), start, size), units.anchor[mine],
                  units.place[mine] - start, size, ids[units.doc[mine]])
    one, number = distinct(raw)
    least = np.full(len(one), np.iinfo(np.int64).max)
    np.minimum.at(least, number, raw.doc)
    return mine, number, Records(*[x[one] for x in raw[:4]], least), start[one]


def as_windows(records: Records, starts: np.ndarray, data: np.ndarray, width: int) -> tuple[Records, np.ndarray]:
    """The distinct windows of some records as records of their own, and the number of each window's: a window of a hot anchor is
    known by two fingerprints, and the second one takes the anchor's place, so such windows meet by their content. Their distance
    is -1, and their bytes are not sent."""
    counts = records.size - width + 1
    at = ragged(starts, counts)
    sizes = np.full(len(at), width, dtype=np.int64)
    raw = Records(fingerprints(data, at, sizes), fingerprints(data, at, sizes, 0xA0761D6478BD642F), np.full(len(at), -1), sizes,
                  np.repeat(records.doc, counts))
    one, number = distinct(raw)
    least = np.full(len(one), np.iinfo(np.int64).max)
    np.minimum.at(least, number, raw.doc)
    return Records(*[x[one] for x in raw[:4]], least), number


def sent_bytes(records: Records) -> np.ndarray:
    return np.where(records.distance >= 0, records.size, 0)


def pack_records(records: Records, starts: np.ndarray, data: np.ndarray) -> bytes:
    n = np.array([len(starts)], dtype=np.int64)
    return _zip(n.tobytes() + b"".join(x.tobytes() for x in records) + data[ragged(starts, sent_bytes(records))].tobytes())


def unpack_records(blob: bytes) -> tuple[Records, np.ndarray]:
    raw = _unzip(blob)
    n = int(np.frombuffer(raw, dtype=np.int64, count=1)[0])
    columns = [np.frombuffer(raw, dtype=t, count=n, offset=8 + 8 * n * i)
               for i, t in enumerate((np.uint64, np.uint64, np.int64, np.int64, np.int64))]
    return Records(*columns), np.frombuffer(raw, dtype=np.uint8, offset=8 + 40 * n)


def smallest_documents(units: Records, starts: np.ndarray, data: np.ndarray, width: int) -> np.ndarray:
    """For distinct units (with their smallest documents; bytes in ``data`` at ``starts``): per window of each
    unit, in order, the smallest document of all units that hold the window. Most-significant-digit passes."""
    counts = units.size - width + 1
    best = np.repeat(units.doc, counts)
    # only windows of anchors with several units can be in two of them
    order = np.argsort(units.anchor, kind="stable")
    alone = np.ones(len(order), dtype=bool)
    same = units.anchor[order][1:] == units.anchor[order][:-1]
    alone[1:] &= ~same
    alone[:-1] &= ~same
    shared = np.zeros(len(order), dtype=bool)
    shared[order] = ~alone
    some = np.flatnonzero(shared & (units.distance >= 0))
    if not len(some):
        return best
    live = ragged((np.cumsum(counts) - counts)[some], counts[some])
    owner = np.repeat(some, counts[some])
    inside = ragged(np.zeros(len(some), dtype=np.int64), counts[some])
    where = starts[owner] + inside
    data = np.append(data, np.zeros(8, dtype=np.uint8))
    eight = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))

    def ties(*digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order by digits (the last is the most significant) of those that tie with another; group numbers."""
        order = np.lexsort(digits)
        new = np.zeros(len(order), dtype=bool)
        new[:1] = True
        for d in digits:
            own = d[order]
            new[1:] |= own[1:] != own[:-1]
        group = np.cumsum(new) - 1
        many = (np.bincount(group) > 1)[group] if len(group) else new
        return order[many], group[many]

    keep, group = ties(units.distance[owner] - inside, units.anchor[owner])
    live, where, depth = live[keep], where[keep], 0
    while depth < width and len(live):
        step = min(8, width - depth)
        digit = eight[where + depth]
        if step < 8:
            digit = digit & np.uint64((1 << 8 * step) - 1)
        keep, group = ties(digit, group)
        live, where = live[keep], where[keep]
        depth += step
    if len(live):
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        low = np.minimum.reduceat(best[live], first)
        best[live] = np.repeat(low, np.diff(np.append(first, len(live))))
    return best


def remove_repeats(docs: DataFrame, path: str, *, width: int = 50, doc_id: str = "doc_id", text: str = "text",
                   with_text: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``spans``
    (array of begin and end byte), ``kept_sha256``, and ``kept`` (binary) if ``with_text``.

    A byte goes if it lies in a window of ``width`` bytes (at least ``GRAM``) that also begins in a document of
    a smaller id, overlaps included, as judged on the input. Texts are whole UTF-8 bytes of any length; null
    counts as empty. Texts shorter than the width stay whole. Rows that share an id never remove from each
    other; rows without an id neither remove nor lose anything. An empty table gives an empty result; other
    columns are not read.

    Scale: texts are packed once into compressed chunks under ``path``; messages between chunks and key
    buckets are pre-aggregated per chunk, so units wholly inside a passage of a third of all documents are one record per
    chunk. Units at its borders hold each document's own bytes and stay apart: an anchor with more than ``HOT_SHAPES`` shapes of
    units is hot, and its windows are dealt out by a further digit, their own content, so they spread over all
    buckets and only equal ones meet. The number of chunks and of buckets follows the input.
    """
    if width < GRAM:
        raise ValueError(f"width is at least {GRAM}")
    rows = docs.select(F.col(doc_id).cast("long").alias("row"), F.col(text).alias("text"))

    def chunked(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        serial, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0

        def close():
            return pa.RecordBatch.from_arrays([pa.array([serial], pa.int64()), pa.array([size], pa.int64()),
                                               pa.array([pack_texts(ids, texts)], pa.binary())], names=["chunk", "plain", "blob"])

        for batch in batches:
            for i, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(i)
                texts.append((value.as_py() or "").encode("utf-8", "surrogatepass"))
                size += len(texts[-1])
                if size >= CHUNK_BYTES:
                    yield close()
                    serial, ids, texts, size = serial + 1, [], [], 0
        if ids:
            yield close()

    chunks = stored(rows.mapInArrow(chunked, CHUNKS), f"{path}/chunks")
    total = chunks.agg(F.sum("plain")).first()[0] or 0
    buckets = max(8, -(-total // BUCKET_BYTES))

    def anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                ids, null, bounds, data = unpack_texts(r.blob)
                own = chunk_anchors(_known(anchored_units(data, bounds, width), null), ids, buckets)
                yield pd.DataFrame({"bucket": list(own), "chunk": r.chunk, "anchors": [a.tobytes() for a, _, _ in own.values()],
                                    "many": [np.packbits(m).tobytes() for _, m, _ in own.values()],
                                    "shapes": [np.minimum(n, 1 << 30).astype(np.int32).tobytes() for _, _, n in own.values()]})

    sent = chunks.mapInPandas(anchors, "bucket long, chunk long, anchors binary, many binary, shapes binary")
    most = HOT_SHAPES

    def repeated(rows: pd.DataFrame) -> pd.DataFrame:
        lists = [np.frombuffer(a, dtype=np.uint64) for a in rows["anchors"]]
        flags = [np.unpackbits(np.frombuffer(m, dtype=np.uint8), count=len(a)).astype(bool)
                 for a, m in zip(lists, rows["many"], strict=True)]
        value, of, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        shapes = np.bincount(of, weights=np.concatenate([np.frombuffer(n, dtype=np.int32) for n in rows["shapes"]]))
        twice = times > 1
        twice[np.searchsorted(value, np.concatenate([a[m] for a, m in zip(lists, flags, strict=True)]))] = True
        marked = {"keep": twice, "hot": twice & (shapes > most)}
        return pd.DataFrame({"chunk": rows["chunk"], "bucket": rows["bucket"], **{
            name: [np.packbits(flag[np.searchsorted(value, a)]).tobytes() for a in lists] for name, flag in marked.items()}})

    masks = stored(sent.groupBy("bucket").applyInPandas(repeated, "chunk long, bucket long, keep binary, hot binary"), f"{path}/masks")

    def marked_anchors(own: dict, told: pd.DataFrame, mark: str) -> np.ndarray:
        some = [own[b][0][np.unpackbits(np.frombuffer(k, dtype=np.uint8), count=len(own[b][0])).astype(bool)]
                for b, k in zip(told["bucket"], told[mark], strict=True)]
        return np.sort(np.concatenate(some)) if some else np.zeros(0, dtype=np.uint64)

    def chunk_state(chunk: pd.DataFrame, told: pd.DataFrame):
        ids, null, bounds, data = unpack_texts(chunk["blob"].iloc[0])
        units = _known(anchored_units(data, bounds, width), null)
        own = chunk_anchors(units, ids, buckets)
        found = chunk_records(units, ids, data, marked_anchors(own, told, "keep"), width)
        _, _, records, starts = found
        hot = np.isin(records.anchor, marked_anchors(own, told, "hot"))
        plain = np.frombuffer(data, dtype=np.uint8)
        cut, number = as_windows(Records(*[x[hot] for x in records]), starts[hot], plain, width)
        sent = Records(*[np.concatenate([x[~hot], y]) for x, y in zip(records, cut, strict=True)])
        return ids, null, bounds, data, units, found, hot, sent, np.concatenate([starts[~hot], np.zeros(len(cut.doc), dtype=np.int64)]), number

    def by_bucket(records: Records) -> Iterator[tuple[int, np.ndarray]]:
        bucket = (records.anchor % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1])) if len(order) else []
        for own in np.split(order, cuts[1:]) if len(order) else ():
            yield int(bucket[own[0]]), own

    def send_units(chunk: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(chunk):
            _, _, _, data, _, _, _, records, starts, _ = chunk_state(chunk, told)
            plain = np.frombuffer(data, dtype=np.uint8)
            out = [(bucket, chunk["chunk"].iloc[0], pack_records(Records(*[x[own] for x in records]), starts[own], plain))
                   for bucket, own in by_bucket(records)]
        return pd.DataFrame(out, columns=["bucket", "chunk", "records"])

    units = chunks.groupBy("chunk").cogroup(masks.groupBy("chunk")).applyInPandas(
        send_units, "bucket long, chunk long, records binary")

    def order(rows: pd.DataFrame) -> pd.DataFrame:
        lists, texts = zip(*map(unpack_records, rows["records"]), strict=True)
        every = Records(*[np.concatenate(x) for x in zip(*lists, strict=True)])
        begin = np.cumsum(sent_bytes(every)) - sent_bytes(every)
        one, number = distinct(every)
        least = np.full(len(one), np.iinfo(np.int64).max)
        np.minimum.at(least, number, every.doc)
        units = Records(*[x[one] for x in every[:4]], least)
        best = smallest_documents(units, begin[one], np.concatenate(texts), width)
        counts = units.size - width + 1
        at, told, done = np.cumsum(counts) - counts, [], 0
        for own in lists:
            mine = number[done:done + len(own.size)]
            told.append(_zip(best[ragged(at[mine], counts[mine])].tobytes()))
            done += len(own.size)
        return pd.DataFrame({"chunk": rows["chunk"], "bucket": rows["bucket"], "least": told})

    answers = stored(units.groupBy("bucket").applyInPandas(order, "chunk long, bucket long, least binary"), f"{path}/answers")

    def settle(chunk: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256", *["kept"] * with_text]
        if not len(chunk):
            return pd.DataFrame([], columns=columns)
        answer_rows = told[told["least"].notna()]
        answered = dict(zip(answer_rows["bucket"], answer_rows["least"], strict=True))
        ids, null, bounds, data, units, (mine, number, records, _), hot, sent, _, window = chunk_state(
            chunk, told[told["keep"].notna()])
        each = sent.size - width + 1
        stops = np.cumsum(each)
        answer = np.empty(int(stops[-1]) if len(stops) else 0, dtype=np.int64)
        for bucket, own in by_bucket(sent):
            answer[ragged((stops - each)[own], each[own])] = np.frombuffer(_unzip(answered[bucket]), dtype=np.int64)
        counts = records.size - width + 1
        ends = np.cumsum(counts)
        least = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
        whole = int(counts[~hot].sum())  # windows of units that were sent as such; those of hot anchors follow
        least[ragged((ends - counts)[~hot], counts[~hot])] = answer[:whole]
        least[ragged((ends - counts)[hot], counts[hot])] = answer[whole:][window]
        windows = units.count[mine]
        low = least[ragged((ends - counts)[number], windows)]
        gone = ragged(units.start[mine], windows)[low < np.repeat(ids[units.doc[mine]], windows)]
        step = np.zeros(len(data) + 1, dtype=np.int64)
        step[gone] += 1  # a window starts once in a chunk
        np.add.at(step, gone + width, -1)
        covered = np.cumsum(step[:-1]) > 0
        plain, out = np.frombuffer(data, dtype=np.uint8), []
        for d in range(len(ids)):
            begin, end = bounds[d], bounds[d + 1]
            own, spans, body = covered[begin:end], [], data[begin:end]
            if own.any():
                edge = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
                spans = [{"begin": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2], strict=True)]
                body = plain[begin:end][~own].tobytes()
            out.append((None if null[d] else int(ids[d]), int(end - begin), int(end - begin) - len(body), len(spans), spans,
                        hashlib.sha256(body).hexdigest(), *[body] * with_text))
        frame = pd.DataFrame(out, columns=columns)
        frame["doc_id"] = pd.array([x[0] for x in out], dtype="Int64")
        return frame

    # side by side, not joined: a window of a hot anchor may be answered from a bucket that has no anchor of its chunk
    both = masks.unionByName(answers, allowMissingColumns=True)
    return chunks.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInPandas(
        settle, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<begin: long, end: long>>, "
                "kept_sha256 string" + (", kept binary" if with_text else ""))

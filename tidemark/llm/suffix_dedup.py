"""Removal of long byte strings that occur earlier in the corpus.

Equal strings of ``LENGTH`` bytes are found in sorted suffixes of many short texts. The sorting is
column-wise: each round inserts one symbol of every text, from the right, into the Burrows-Wheeler
transform of the collection, and updates the common prefixes of neighbours.

Spark deals out what has to be sorted together. Every ``LENGTH``-byte window of a document chooses an
anchor, the substring of ``GRAM`` bytes in it with the least hash; equal windows choose equal
anchors. Runs of windows with one anchor form a passage of at most ``2 * LENGTH`` bytes. Passages
whose anchor occurs once in the corpus hold nothing that repeats; the others are grouped by anchor
and each group is sorted by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, hot_keys, partitions, saved, whole_text

LENGTH = 100
GRAM = 40
#: Hashed substrings in a window.
SPAN = LENGTH - GRAM + 1
#: Bytes of a document that are scanned at once.
STEP = 1 << 19
#: Symbols of passages that are sorted at once, unless one anchor has more.
SORT_SYMBOLS = 600_000
#: Buckets of anchors for each shuffle partition, so that the partitions are even.
BUCKETS_EACH = 8

_U = np.uint64
_BASE, _OTHER_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_SCANNED = STEP + LENGTH
_UP, _DOWN = _powers(_BASE, _SCANNED), _powers(pow(_BASE, -1, 1 << 64), _SCANNED)
_UP_2, _DOWN_2 = _powers(_OTHER_BASE, _SCANNED), _powers(pow(_OTHER_BASE, -1, 1 << 64), _SCANNED)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def passages(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, hash of all bytes, start and size of the passages of a document; together they
    hold each window of ``LENGTH`` bytes exactly once."""
    found: list[list[np.ndarray]] = [[], [], [], []]
    whole = np.frombuffer(raw, np.uint8)
    for at in range(0, max(0, len(whole) - LENGTH + 1), STEP):
        part = whole[at : at + STEP + LENGTH - 1].astype(np.uint64) + _U(1)
        n = len(part)
        sums, others = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
        np.cumsum(part * _UP[:n], out=sums[1:])
        np.cumsum(part * _UP_2[:n], out=others[1:])
        grams = _mix((sums[GRAM:] - sums[:-GRAM]) * _DOWN[: n - GRAM + 1])
        # The place in the low bits: of equal hashes the first counts.
        keys = (grams & ~_U((1 << 20) - 1)) | np.arange(len(grams), dtype=np.uint64)
        rows = -(-len(keys) // SPAN)
        table = np.full(rows * SPAN, np.iinfo(np.uint64).max, np.uint64)
        table[: len(keys)] = keys
        table = table.reshape(rows, SPAN)
        before = np.minimum.accumulate(table, axis=1).ravel()
        after = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = n - LENGTH + 1
        anchor = (np.minimum(after[:windows], before[SPAN - 1 : SPAN - 1 + windows]) & _U((1 << 20) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        size = np.diff(np.append(first, windows)) + LENGTH - 1
        content = _mix((others[first + size] - others[first]) * _DOWN_2[first] + size.astype(np.uint64))
        for out, values in zip(found, (grams[anchor[first]], content, first + at, size)):
            out.append(values)
    if not found[0]:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in found)


def sort_collection(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of a collection in order: the text and the start of each, and its common prefix with
    the suffix before it. Ends of texts sort below all bytes, in the order of the texts.

    Round j places the suffixes with j symbols. A suffix with first symbol c stands, among those that
    begin with c, where its rest stands among the suffixes that c precedes; so the place follows from
    the transform alone. Its common prefix with its new neighbour is one more than the least common
    prefix between their rests.
    """
    n = len(texts)
    size = np.array([len(t) for t in texts], np.int64)
    width = int(size.max(initial=0))
    kind = np.uint8 if width < 255 and not any(b"\xff" in t for t in texts) else np.uint16
    # Right-aligned symbols, one row per round; 0 stands before the first symbol.
    columns = np.zeros((width + 1, n), kind)
    for i, t in enumerate(texts):
        columns[: len(t), i] = np.frombuffer(t, np.uint8)[::-1].astype(kind) + kind(1)
    # Common prefixes end with one more value, which ranges up to the end need.
    transform, common = columns[0].copy(), np.zeros(n + 1, kind)
    place = np.arange(n)
    for j in range(width):
        active = np.flatnonzero(columns[j])
        order = _rests(transform)
        # Entry r of ``order`` is the rest of suffix n + r; the rests of the new suffixes are known,
        # and what stands there in ``order`` gives the new places in rising order.
        known = place[active]
        is_rest = np.zeros(len(transform), bool)
        is_rest[known] = True
        text_at = np.empty(len(transform), np.int32)
        text_at[known] = active
        new = np.flatnonzero(is_rest[order])
        rest = order[new]
        own = text_at[rest]
        new += n
        follows = new > n
        same = np.zeros(len(new), bool)
        same[follows] = transform[order[new[follows] - n - 1]] == transform[rest[follows]]
        to_left = np.zeros(len(new), kind)
        if same.any():
            to_left[same] = _least(common, order[new[same] - n - 1] + 1, rest[same] + 1) + kind(1)
        # The suffix after a new one has a new neighbour too.
        after = new - n + 1
        inside = after < len(order)
        right = np.zeros(len(new), bool)
        right[inside] = transform[order[after[inside]]] == transform[rest[inside]]
        to_right = np.zeros(len(new), kind)
        if right.any():
            to_right[right] = _least(common, rest[right] + 1, order[after[right]] + 1) + kind(1)
        total = n + len(order)
        is_old = np.ones(total, bool)
        is_old[new] = False
        merged = []
        for old, fresh in ((transform, columns[j + 1][own]), (common[:-1], to_left)):
            out = np.empty(total + 1, kind)
            out[new], out[:-1][is_old] = fresh, old
            merged.append(out)
        transform, common = merged[0][:-1], merged[1]
        common[-1] = np.iinfo(kind).max
        fits = new + 1 < total
        changed = new[fits] + 1
        old_next = is_old[changed]
        common[changed[old_next]] = to_right[fits][old_next]
        place[own] = new
    # With the transform complete, each suffix leads to the one that is a symbol longer.
    order = _rests(transform)
    target = np.empty(len(transform), np.int64)
    target[order] = np.arange(n, n + len(order))
    who, start = np.empty(len(transform), np.int64), np.empty(len(transform), np.int64)
    alive = at = np.arange(n)
    who[at], start[at] = alive, size
    for j in range(width):
        longer = size[alive] > j
        alive, at = alive[longer], target[at[longer]]
        who[at], start[at] = alive, size[alive] - j - 1
    return who, start, common[:-1]


def _rests(transform: np.ndarray) -> np.ndarray:
    """Places in the transform by their symbol, those of complete texts left out: entry r is the rest of
    the r-th suffix after the empty ones, which come first."""
    return np.argsort(transform, kind="stable")[len(transform) - np.count_nonzero(transform) :]


def _least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least value in each range [low, high), no range being empty or reaching the last value."""
    # From the last start to the first, so that nothing between two ranges is looked at.
    by = np.argsort(-low)
    out = np.empty(len(low), values.dtype)
    out[by] = np.minimum.reduceat(values, np.column_stack([low[by], high[by]]).ravel())[::2]
    return out


def repeated_windows(texts: list[bytes], order: np.ndarray) -> list[np.ndarray]:
    """Starts, in each text, of the windows that an equal window precedes. ``order`` ranks the first
    windows of the texts: windows count from there."""
    who, start, common = sort_collection(texts)
    size = np.array([len(t) for t in texts])
    full = size[who] - start >= LENGTH
    group = np.cumsum(common < LENGTH)
    who, start, group = who[full], start[full], group[full]
    rank = order[who] + start
    first = np.full(int(group.max(initial=0)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, group, rank)
    later = rank > first[group]
    who, start = who[later], start[later]
    by_text = np.lexsort((start, who))
    return np.split(start[by_text], np.searchsorted(who[by_text], np.arange(1, len(texts))))


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Byte ranges that windows at sorted ``starts`` cover."""
    if not len(starts):
        return []
    gaps = np.flatnonzero(np.diff(starts) > LENGTH)
    return list(zip(starts[np.append(0, gaps + 1)].tolist(), (starts[np.append(gaps, len(starts) - 1)] + LENGTH).tolist()))


# Jobs ----------------------------------------------------------------------------------------

_BLOB = pa.schema([("bucket", pa.int32())] + [(c, pa.binary()) for c in ("h", "content", "doc", "variant", "start", "size")])
#: Rows with a key are passages to sort; rows without one carry ranges known to be repeated.
_FOUND = pa.schema([("h", pa.int64()), ("doc", pa.int64()), ("variant", pa.int64()), ("start", pa.int64()), ("size", pa.int32()), ("ranges", pa.binary())])
_PASSAGE = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("variant", pa.int64()), ("start", pa.int64()), ("size", pa.int32()), ("passage", pa.binary())])
_RANGE = pa.schema([("doc", pa.int64()), ("variant", pa.int64()), ("ranges", pa.binary())])
_KINDS = {"h": np.uint64, "content": np.uint64, "doc": np.int64, "variant": np.uint32, "start": np.uint32, "size": np.uint8}


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents by place: id (null before all others), and a hash to tell apart rows that share it."""
    text = whole_text(text_col)
    return docs.select(
        F.coalesce(column(id_col).cast("long"), F.lit(-(2**63))).alias("doc"),
        F.xxhash64(text).bitwiseAND(F.lit(2**32 - 1)).alias("variant"),
        F.encode(text, "UTF-8").alias("raw"),
    )


def _packed(rows: DataFrame) -> DataFrame:
    """The documents with their bytes compressed, for shuffles."""
    schema = pa.schema([("doc", pa.int64()), ("variant", pa.int64()), ("packed", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [packer.compress(x.as_py()) for x in batch.column("raw")]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("variant"), pa.array(packed, pa.binary())], schema=schema)

    return rows.mapInArrow(work, _ddl(schema))


def _pack(low: np.ndarray, high: np.ndarray) -> bytes:
    return np.column_stack([low, high]).astype("<u4").tobytes()


def _per_document(doc: np.ndarray, variant: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple]:
    """``(doc, variant, packed ranges)`` of ranges sorted by document and start, overlaps merged."""
    if not len(doc):
        return
    fresh = np.ones(len(doc), bool)
    same = (doc[1:] == doc[:-1]) & (variant[1:] == variant[:-1])
    # Sizes vary by less than LENGTH and starts rise, so a range can end before the last one ended.
    end = high.copy()
    borders = np.flatnonzero(np.append(True, ~same))
    for a, b in zip(borders, np.append(borders[1:], len(doc))):
        end[a:b] = np.maximum.accumulate(high[a:b])
    fresh[1:] = ~same | (low[1:] > end[:-1])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(doc)) - 1
    d, v, a, b = doc[first], variant[first], low[first], end[last]
    edge = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (v[1:] != v[:-1])))
    for x, y in zip(edge, np.append(edge[1:], len(d))):
        yield int(d[x]), int(v[x]), _pack(a[x:y], b[x:y])


def _later(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For rows in order of document and start: whether an equal passage stands at an earlier place,
    and whether the row is the first of its passage."""
    order = np.lexsort((rows["content"], rows["h"]))  # stable: keeps the order of places
    h, content = rows["h"][order], rows["content"][order]
    head = np.append(True, (h[1:] != h[:-1]) | (content[1:] != content[:-1]))
    lead = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    first = np.zeros(len(order), bool)
    first[order[head]] = True
    here = np.empty(len(order), np.int64)
    here[order] = lead
    moved = np.zeros(len(order), bool)
    for c in ("doc", "variant", "start"):
        moved |= rows[c] != rows[c][here]
    return moved, first


def _by_place(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    order = np.lexsort((rows["start"], rows["variant"], rows["doc"]))
    return {c: x[order] for c, x in rows.items()}


def _anchors(rows: DataFrame, buckets: int) -> DataFrame:
    """Passages of all documents, packed by bucket of their anchor. Of equal passages in a batch the
    earliest goes to the bucket; the others are ranges known to be repeated (bucket below zero)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [passages(raw.as_py()) for raw in batch.column("raw")]
            count = [len(f[0]) for f in found]
            if not sum(count):
                continue
            own = {c: np.concatenate([f[i] for f in found]) for i, c in enumerate(("h", "content", "start", "size"))}
            own["doc"] = np.repeat(batch.column("doc").to_numpy(), count)
            own["variant"] = np.repeat(batch.column("variant").to_numpy(), count)
            own = _by_place(own)
            moved, first = _later(own)
            out = []
            if moved.any():
                gone = {c: x[moved] for c, x in own.items()}
                for k, (doc, variant, packed) in enumerate(_per_document(gone["doc"], gone["variant"], gone["start"], gone["start"] + gone["size"])):
                    place = {"doc": np.int64(doc).tobytes(), "variant": np.uint32(variant).tobytes()}
                    out.append({"bucket": -1 - (doc ^ variant) % buckets, "h": None, "content": None, **place, "start": packed, "size": None})
            own = {c: x[first] for c, x in own.items()}
            spread = (own["h"] % _U(buckets)).astype(np.int64)
            order = np.argsort(spread, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(spread[order])) + 1):
                out.append({"bucket": int(spread[part[0]])} | {c: own[c][part].astype(kind).tobytes() for c, kind in _KINDS.items()})
            for at in range(0, len(out), 2000):
                yield pa.RecordBatch.from_pylist(out[at : at + 2000], _BLOB)

    return rows.mapInArrow(work, _ddl(_BLOB))


def _repeated(blobs: DataFrame) -> DataFrame:
    """From partitions that hold whole buckets: ranges of passages that repeat an equal one, and the
    passages, each once, whose anchor occurs in several different ones."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list[np.ndarray]] = {c: [] for c in _KINDS}
        none = dict.fromkeys(("h", "start", "size"))
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["bucket"] < 0:
                    place = {"doc": int.from_bytes(row["doc"], "little", signed=True), "variant": int.from_bytes(row["variant"], "little")}
                    out.append(none | place | {"ranges": row["start"]})
                    continue
                for c, kind in _KINDS.items():
                    parts[c].append(np.frombuffer(row[c], kind))
            if out:
                yield pa.RecordBatch.from_pylist(out, _FOUND)
        if not parts["h"]:
            return
        rows = _by_place({c: np.concatenate(x).astype(np.uint64 if c in ("h", "content") else np.int64) for c, x in parts.items()})
        moved, first = _later(rows)
        gone = {c: x[moved] for c, x in rows.items()}
        known = list(_per_document(gone["doc"], gone["variant"], gone["start"], gone["start"] + gone["size"]))
        for at in range(0, len(known), 50_000):
            doc, variant, packed = zip(*known[at : at + 50_000])
            empty = pa.nulls(len(doc), pa.int64())
            yield pa.RecordBatch.from_arrays([empty, pa.array(doc, pa.int64()), pa.array(variant, pa.int64()), empty, empty.cast(pa.int32()), pa.array(packed, pa.binary())], schema=_FOUND)
        rows = {c: x[first] for c, x in rows.items()}
        _, back, times = np.unique(rows["h"], return_inverse=True, return_counts=True)
        keep = np.flatnonzero(times[back] > 1)
        for at in range(0, len(keep), 100_000):
            own = keep[at : at + 100_000]
            columns = [rows["h"][own].view(np.int64), rows["doc"][own], rows["variant"][own], rows["start"][own], rows["size"][own].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.nulls(len(own), pa.binary())], schema=_FOUND)

    return blobs.mapInArrow(work, _ddl(_FOUND))


def _with_bytes(rows: DataFrame) -> DataFrame:
    """The passages to sort with their bytes. Passages of hot anchors are cut into their windows, each
    grouped by its own hash. Of equal windows in a batch only the earliest keeps its bytes; the rest
    repeat it and need no sorting."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            found = []
            docs, variants = batch.column("doc").to_pylist(), batch.column("variant").to_pylist()
            packed, lists = batch.column("packed"), batch.column("passages").to_pylist()
            for k, own in enumerate(lists):
                raw = unpacker.decompress(packed[k].as_py())
                for p in own:
                    low, high = p["start"], p["start"] + p["size"]
                    if not p["hot"]:
                        found.append((docs[k], variants[k], low, p["h"], raw[low:high]))
                        continue
                    for at in range(low, high - LENGTH + 1):
                        window = raw[at : at + LENGTH]
                        found.append((docs[k], variants[k], at, xxhash.xxh3_64_intdigest(window) - 2**63, window))
            found.sort(key=lambda x: x[:3])
            seen: dict[bytes, tuple] = {}
            out = []
            for n, (doc, variant, start, key, text) in enumerate(found):
                first = seen.setdefault(text, (doc, variant, start))
                again = first != (doc, variant, start)
                out.append((n if again else key, doc, variant, start, len(text), None if again else text))
            for at in range(0, len(out), 50_000):
                columns = zip(*out[at : at + 50_000])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PASSAGE)], schema=_PASSAGE)

    return rows.mapInArrow(work, _ddl(_PASSAGE))


def _sorted_groups(rows: DataFrame) -> DataFrame:
    """Byte ranges of documents that occur earlier, from passages sorted by key."""

    def ranges(group: list[tuple]) -> list[tuple]:
        """Of passages (doc, variant, start, bytes, key) in any order."""
        group.sort(key=lambda x: x[:3])
        out: list[tuple] = []
        texts: dict[bytes, tuple] = {}
        for doc, variant, start, text, key in group:
            first = texts.setdefault(text, (doc, variant, start, key))
            if first[:3] != (doc, variant, start):  # an equal passage is earlier
                out.append((doc, variant, start, start + len(text)))
        # Windows of one passage differ; so a passage alone with its key has no repeated window.
        times: dict[int, int] = {}
        for *_, key in texts.values():
            times[key] = times.get(key, 0) + 1
        own = {t: x[:3] for t, x in texts.items() if times[x[3]] > 1}
        if own:
            ids = {d: i for i, d in enumerate(dict.fromkeys(x[:2] for x in own.values()))}
            order = np.array([ids[x[:2]] << 33 | x[2] for x in own.values()], np.int64)
            for (doc, variant, start), starts in zip(own.values(), repeated_windows(list(own), order)):
                out.extend((doc, variant, start + a, start + b) for a, b in _runs(starts))
        return out

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        last, symbols = None, 0
        out: list[tuple] = []

        def result() -> pa.RecordBatch:
            made = []
            if out:
                columns = [np.array(c, np.int64) for c in zip(*sorted(out))]
                made = list(_per_document(*columns))
            out.clear()
            columns = zip(*made) if made else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RANGE)], schema=_RANGE)

        for batch in batches:
            names = ["key", "doc", "variant", "start", "size", "passage"]
            for key, doc, variant, start, size, text in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names)):
                if text is None:
                    out.append((doc, variant, start, start + size))
                    continue
                if key != last and symbols > SORT_SYMBOLS:
                    out.extend(ranges(group))
                    group, symbols = [], 0
                last = key
                group.append((doc, variant, start, text, key))
                symbols += size
            yield result()
        out.extend(ranges(group))
        yield result()

    return rows.mapInArrow(work, _ddl(_RANGE))


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, variant, ranges``: packed ranges of bytes that occur earlier (pairs of unsigned 32-bit
    numbers); they may overlap, and a document may have several rows.

    Passages count as equal when the hash of the anchor, the 64-bit hash of all bytes and their sizes
    agree, without a look at the bytes: passages around one anchor are told apart by 64 bits. Windows
    of hot anchors are grouped by a 64-bit hash and compared as bytes; what differs around a common
    anchor is sorted and compared byte by byte.
    """
    spark = docs.sparkSession
    rows = _documents(docs, id_col, text_col).filter(F.octet_length("raw") >= LENGTH)
    parts = partitions(spark)
    found = saved(_repeated(_anchors(rows, parts * BUCKETS_EACH).repartition(parts, "bucket")), "repeated-passages")
    to_sort = found.filter(F.col("h").isNotNull())
    hot = saved(hot_keys(to_sort, "h", to_sort.count()), "hot-anchors").select("h", F.lit(True).alias("hot"))
    marked = to_sort.join(F.broadcast(hot), "h", "left")
    own = F.struct("h", "start", "size", F.coalesce("hot", F.lit(False)).alias("hot"))
    by_doc = marked.groupBy("doc", "variant").agg(F.collect_set(own).alias("passages"))
    texts = _packed(rows).join(by_doc, ["doc", "variant"])
    dealt = _with_bytes(texts).repartition(parts, "key").sortWithinPartitions("key")
    sorted_ranges = saved(_sorted_groups(dealt), "sorted-ranges")
    known = found.filter(F.col("h").isNull()).select("doc", "variant", "ranges")
    return sorted_ranges.unionByName(known)


def _merged(packed: list[bytes]) -> list[tuple[int, int]]:
    if not packed:
        return []
    pairs = np.frombuffer(b"".join(packed), "<u4").reshape(-1, 2).astype(np.int64)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    end = np.maximum.accumulate(pairs[:, 1])
    first = np.flatnonzero(np.append(True, pairs[1:, 0] > end[:-1]))
    last = np.append(first[1:], len(pairs)) - 1
    return list(zip(pairs[first, 0].tolist(), end[last].tolist()))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``: one row per input row.

    Each byte goes that a string of ``LENGTH`` bytes covers which also starts earlier: in a document
    with a smaller id, or before it in the same document. Strings are judged on the input. Null texts
    count as empty; a null id comes before all others; rows that agree in id and text are one
    document, and rows that share an id with other texts follow each other by a hash of the text.
    ``kept`` are the remaining bytes, which need not be valid UTF-8. Other columns are not read.
    """
    ranges = repeated_ranges(docs, id_col, text_col)
    by_doc = ranges.groupBy("doc", "variant").agg(F.collect_list("ranges").alias("ranges"))
    rows = _packed(_documents(docs, id_col, text_col)).join(by_doc, ["doc", "variant"], "left")
    schema = pa.schema(
        [("doc", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            docs_, packed = batch.column("doc").to_pylist(), batch.column("packed")
            for k, own in enumerate(batch.column("ranges").to_pylist()):
                raw, gone = unpacker.decompress(packed[k].as_py()), _merged(own or [])
                edges = [0, *(x for r in gone for x in r), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((docs_[k], len(raw), len(raw) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept))
            columns = zip(*out) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    found = rows.mapInArrow(work, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return found.select(_id("doc").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")


def _id(name: str) -> Column:
    return F.when(F.col(name) != -(2**63), F.col(name))

"""Removal of repeated byte strings: every 100-byte string that also starts earlier.

A suffix array of the whole corpus would hold each byte many times over, so only suffixes that can repeat are
ordered. In each window of the string's length the 24-byte gram with the least hash is its anchor; equal windows have
equal anchors at equal places. Of the 76 bytes around an anchor a window has 38 at least on one side; anchor and these 38
bytes are its core, and the neighbouring windows of one core are a piece. Pieces are dealt out by hashes of their cores,
so that equal windows meet. Where all text of two pieces is equal, the later one is a repeat at once. Of pieces that
differ the suffixes to the right of the core and the prefixes to its left are ordered (deep-shallow sorting), and common
prefix lengths tell which windows are equal. A core with very many pieces is dealt out in parts; the first windows of the
parts then meet as whole strings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_slices, load, materialize, row_key, sized, text_bytes, text_or_empty
from .deep_shallow import suffix_order
from .hashing import RangeHashes, mixed, power

LENGTH, GRAM = 100, 24
#: Bytes of a window that are in its core, and those that are not.
SIDE = (LENGTH - GRAM) // 2
CORE = GRAM + SIDE
#: Bytes of text that one step works on, and pieces that a task combines at a time.
SLICE_BYTES, COMBINE_PIECES = 1 << 22, 2_000_000
#: Pieces of one core that are ordered in one task, about 100 MB with all that ordering needs.
PART_PIECES = 200_000
_NO_ID = -(1 << 63)
_MARK = "oid bigint, key bigint, start bigint, end bigint"


def _gram_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` bytes from each place on, by joining hashes of power-of-two lengths."""
    out, have = None, 0
    h, size = mixed(data.astype(np.uint64) + np.uint64(1)), 1
    while True:
        if n & size:
            out, have = (h, size) if out is None else (h[: len(h) - have] * np.uint64(power(have)) + out[size:][: len(h) - have], have + size)
        size *= 2
        if size > n:
            return out
        h = h[: len(h) - size // 2] * np.uint64(power(size // 2)) + h[size // 2 :]


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[: len(x) - size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def _pieces(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """For all documents of a slice: row, hash of the core, hash of the whole piece, first window, windows, core's place in it."""
    none = (np.zeros(0, np.int64),) * 6
    if len(data) < LENGTH:
        return none
    grams = mixed(_gram_hashes(data, GRAM))
    reach = LENGTH - GRAM + 1
    low = (1 << 24) - 1
    keyed = (grams & np.uint64(~low & (1 << 64) - 1)) | np.arange(len(grams), dtype=np.uint64)  # ties: the first one
    best = (_least(keyed, reach) & np.uint64(low)).astype(np.int64)
    row = np.searchsorted(ends, np.arange(len(best)), "right") - 1
    inside = np.arange(len(best)) + LENGTH <= ends[row + 1]
    first = np.ones(len(best), bool)
    first[1:] = (best[1:] != best[:-1]) | (row[1:] != row[:-1])
    at = np.nonzero(first & inside)[0]
    if not len(at):
        return none
    upto = np.append(np.nonzero(first)[0], len(best))
    upto = np.minimum(upto[np.searchsorted(upto, at, "right")], ends[row[at] + 1] - LENGTH + 1)
    # The first windows of an anchor have more than SIDE bytes before it, so their core begins SIDE bytes before it.
    turn = np.clip(best[at] - SIDE, at, upto)
    early, late = np.nonzero(turn > at)[0], np.nonzero(turn < upto)[0]
    core = np.concatenate([best[at[early]] - SIDE, best[at[late]]])
    start, stop = np.concatenate([at[early], turn[late]]), np.concatenate([turn[early], upto[late]])
    of = RangeHashes(data)
    whole = mixed(of(start, stop + LENGTH - 1) ^ (core - start).astype(np.uint64))
    r = row[start]
    return r, mixed(of(core, core + CORE)).view(np.int64), whole.view(np.int64), start - ends[r], stop - start, core - start


def _pack(first: np.ndarray, count: np.ndarray, off: np.ndarray) -> np.ndarray:
    return first << 16 | count << 8 | off


def _unpack(span: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return span >> 16, span >> 8 & 255, span & 255


def _merged(oid: np.ndarray, key: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Join ranges of one document that touch; each range is no shorter than ``LENGTH`` and they are few a document."""
    if not len(oid):
        return oid, key, start, end
    order = np.lexsort((start, key, oid))
    oid, key, start, end = oid[order], key[order], start[order], end[order]
    other = np.ones(len(oid), bool)
    other[1:] = (oid[1:] != oid[:-1]) | (key[1:] != key[:-1])
    group = np.cumsum(other).astype(np.int64)
    shift = group << 42  # places of one document stay below those of the next
    high = np.maximum.accumulate(end + shift)
    new = other.copy()
    new[1:] |= start[1:] + shift[1:] > high[:-1]
    at = np.nonzero(new)[0]
    last = np.append(at[1:], len(oid)) - 1
    return oid[at], key[at], start[at], high[last] - shift[last]


def _find_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, h, around, oid, key, span): candidates (kind 0), one for each core and whole piece that a task has seen,
    and marks (kind 1: around is the end, span the start) of the places that repeat them."""
    held: list[tuple[np.ndarray, ...]] = []

    def combined():
        h, around, oid, key, span = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((span, key, oid, around, h))
        h, around, oid, key, span = h[order], around[order], oid[order], key[order], span[order]
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (around[1:] == around[:-1])
        first, count, _ = _unpack(span[again])
        m_oid, m_key, m_start, m_end = _merged(oid[again], key[again], first, first + count + LENGTH - 1)
        h, around, oid, key, span = h[~again], around[~again], oid[~again], key[~again], span[~again]
        order = np.lexsort((span, key, oid))  # neighbours of one document compress well
        for lo in range(0, len(order), 200_000):
            o = order[lo : lo + 200_000]
            yield _batch(np.zeros(len(o), np.int8), h[o], around[o], oid[o], key[o], span[o])
        spread = mixed(m_oid.astype(np.uint64) ^ m_key.astype(np.uint64)).view(np.int64)
        yield _batch(np.ones(len(m_oid), np.int8), spread, m_end, m_oid, m_key, m_start)
        held.clear()

    for batch in batches:
        oid, key = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        for i, j in byte_slices(batch.column(2), SLICE_BYTES):
            for r, *rest in _of_texts(batch.column(2).slice(i, j - i)):
                held.append((rest[0], rest[1], oid[i:j][r], key[i:j][r], _pack(*rest[2:])))
        if sum(len(x[0]) for x in held) > COMBINE_PIECES:
            yield from combined()
    if held:
        yield from combined()


def _of_texts(texts: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    data, ends = text_bytes(texts)
    if len(data) < 1 << 24:
        yield _pieces(data, ends)
        return
    # One long text: pieces overlap by all that a window and its neighbours need, and repeat no window.
    step = (1 << 24) - 4096
    for k, lo in enumerate(range(0, len(data) - LENGTH + 1, step)):
        row, h, around, first, count, off = _pieces(data[lo : lo + step + LENGTH - 1], np.array([0, min(step + LENGTH - 1, len(data) - lo)]))
        yield row, h, around, first + lo, count, off


def _batch(kind, h, around, oid, key, span) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (kind, h, around, oid, key, span)], names=["kind", "h", "around", "oid", "key", "span"])


def _by_key(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Tables of whole groups of rows with equal values of ``column``, by which the rows are sorted."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        h = batch.column(column).to_numpy(zero_copy_only=False)
        cut = int(np.nonzero(np.append(True, h[1:] != h[:-1]))[0][-1])
        if held and held[-1].column(column)[-1].as_py() != h[0]:
            yield pa.Table.from_batches(held)
            held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _equal_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, h, oid, key, start, end): marks (kind 1), and the first place of each piece where a core has several
    (kind 0, start is the packed span). Rows are sorted; a core's rows pass by without being gathered, with its last
    row and a first one that may stay alone."""
    last, alone = None, None  # (h, around) of the last row; the only place of that core so far
    for batch in batches:
        kind, h, around, oid, key, span = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        mark = kind == 1
        m = [oid[mark], key[mark], span[mark], around[mark]]
        h, around, oid, key, span = (x[~mark] for x in (h, around, oid, key, span))
        if len(h):
            new_h = np.append(last is None or h[0] != last[0], h[1:] != h[:-1])
            new_c = new_h | np.append(last is None or around[0] != last[1], around[1:] != around[:-1])
            first, count, _ = _unpack(span[~new_c])
            m = [np.concatenate(x) for x in zip(m, _merged(oid[~new_c], key[~new_c], first, first + count + LENGTH - 1), strict=True)]
            last = h[-1], around[-1]
            single, place = new_h[new_c], [x[new_c] for x in (h, oid, key, span)]
            if alone is not None and len(single) and not single[0]:
                single, place = np.append(True, single), [np.append(a, x) for a, x in zip(alone, place, strict=True)]
            if len(single):
                alone = [x[-1] for x in place] if single[-1] else None
                several = ~single | np.append(~single[1:], False)  # the next place is of the same core
                h, oid, key, span = (x[several] for x in place)
            else:
                h, oid, key, span = (x[:0] for x in (h, oid, key, span))
        kinds = np.repeat(np.array([0, 1], np.int8), [len(h), len(m[0])])
        columns = [np.concatenate(x) for x in ((h, m[0]), (oid, m[0]), (key, m[1]), (span, m[2]), (np.zeros(len(h), np.int64), m[3]))]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (kinds, *columns)], names=["kind", "h", "oid", "key", "start", "end"])


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each piece that needs comparing, from documents with the lists of their pieces."""
    for batch in batches:
        for i in range(batch.num_rows):
            text = batch.column("text")[i].as_py().encode()
            places = batch.column("places").slice(i, 1).flatten()
            span = places.field("span").to_numpy(zero_copy_only=False)
            first, count, _ = _unpack(span)
            n = len(span)
            bytes_ = pa.array([text[a : a + c + LENGTH - 1] for a, c in zip(first.tolist(), count.tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [places.field("h"), pa.array(np.full(n, batch.column("oid")[i].as_py())), pa.array(np.full(n, batch.column("key")[i].as_py())), pa.array(span), bytes_], names=["h", "oid", "key", "span", "bytes"]
            )


def _same_core(h: np.ndarray, core: np.ndarray) -> np.ndarray:
    """A number for each group of rows with equal cores; ``h`` nearly always is one."""
    by = np.argsort(h, kind="stable")
    if ((h[by[1:]] == h[by[:-1]]) & (core[by[1:]] != core[by[:-1]]).any(axis=1)).any():
        return np.unique(core, axis=0, return_inverse=True)[1].reshape(-1)
    return h


def _compare(batches: Iterator[pa.RecordBatch], firsts: bool = False) -> Iterator[pa.RecordBatch]:
    """(oid, key, start, end, window): marks; and, with ``firsts``, the first place of each window, with its bytes."""
    for table in _by_key(batches, "h"):
        h, oid, key, span = (table.column(i).to_numpy() for i in range(4))
        first, count, off = _unpack(span)
        order = np.lexsort((first, key, oid))
        h, oid, key, first, count, off = (x[order] for x in (h, oid, key, first, count, off))
        joined = table.column(4).combine_chunks().cast(pa.large_binary())
        ends = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
        data = np.append(np.frombuffer(joined.buffers()[2], np.uint8), np.zeros(LENGTH, np.uint8))
        start, stop = ends[:-1][order][:, None], ends[1:][order][:, None]
        core = start + off[:, None]
        groups = _same_core(h, data[core + np.arange(CORE)])
        right_at, left_at = core + CORE + np.arange(SIDE), core - 1 - np.arange(SIDE)
        right = np.where(right_at < stop, data[right_at], 0)
        left = np.where(left_at >= start, data[np.maximum(left_at, 0)], 0)
        ranks = []
        for side in (right, left):
            by, common = suffix_order(groups, side)
            place = np.empty(len(h), np.int64)
            place[by] = np.arange(len(h))
            ranks.append((common, place))
        marked, kept = np.zeros((len(h), SIDE + 1), bool), np.zeros((len(h), SIDE + 1), bool)
        for k in range(SIDE + 1):  # the windows with k bytes before the core
            has = np.nonzero((off >= k) & (off - count < k))[0]
            ids = [np.cumsum(common < depth)[place[has]] for (common, place), depth in zip(ranks, (SIDE - k, k), strict=True)]
            _, at = np.unique(ids[0] << 32 | ids[1], return_index=True)
            later = np.ones(len(has), bool)
            later[at] = False
            marked[has[later], k] = True
            kept[has[at], k] = firsts
        r, k = np.nonzero(marked)
        begin = first[r] + off[r] - k
        yield _compared(*_merged(oid[r], key[r], begin, begin + LENGTH), None)
        r, k = np.nonzero(kept)
        for lo in range(0, len(r), 50_000):
            i, j = r[lo : lo + 50_000], k[lo : lo + 50_000]
            begin = first[i] + off[i] - j
            windows = data[(core[i] - j[:, None]) + np.arange(LENGTH)]
            yield _compared(oid[i], key[i], begin, begin + LENGTH, windows)


def _compared(oid: np.ndarray, key: np.ndarray, start: np.ndarray, end: np.ndarray, windows: np.ndarray | None) -> pa.RecordBatch:
    strings = pa.nulls(len(oid), pa.binary()) if windows is None else pa.FixedSizeBinaryArray.from_buffers(pa.binary(LENGTH), len(oid), [None, pa.py_buffer(windows.tobytes())]).cast(pa.binary())
    return pa.RecordBatch.from_arrays([*[pa.array(x) for x in (oid, key, start, end)], strings], names=["oid", "key", "start", "end", "window"])


def _touching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of a document that touch become one, batch by batch of sorted rows."""
    for batch in batches:
        columns = _merged(*(c.to_numpy(zero_copy_only=False) for c in batch.columns))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["oid", "key", "start", "end"])


def _ordered(around: DataFrame, part_pieces: int) -> DataFrame:
    """Marks of the windows that also start earlier, of pieces (h, oid, key, span, bytes) whose cores have several."""
    parts = F.ceil(F.count(F.lit(1)) / part_pieces).cast("int")
    large = materialize(around.groupBy("h").agg(parts.alias("parts")).where("parts > 1"), "large_cores")
    compared = f"{_MARK}, window binary"

    def dealt(pieces: DataFrame) -> DataFrame:
        return pieces.select("h", "oid", "key", "span", "bytes").repartition("h").sortWithinPartitions("h")

    if large.isEmpty():
        return dealt(around).mapInArrow(_compare, compared).drop("window")
    small = dealt(around.join(sized(large), "h", "left_anti")).mapInArrow(_compare, compared).drop("window")
    # Each part of a large core marks what repeats within it. The first windows of all parts meet as whole strings, which
    # are combined before they are shuffled.
    part = F.xxhash64("h", F.pmod(F.xxhash64("oid", "key", "span"), F.col("parts")))
    salted = around.join(sized(large), "h").select(part.alias("h"), "oid", "key", "span", "bytes")
    found = materialize(dealt(salted).mapInArrow(lambda batches: _compare(batches, True), compared), "parts_compared")
    firsts, place = found.where("window IS NOT NULL"), F.struct("oid", "key", "start")
    origin = materialize(firsts.groupBy("window").agg(F.min(place).alias("origin"), F.max(place).alias("top")).where("origin <> top").select("window", "origin"), "first_windows")
    later = firsts.join(origin, "window").where(place != F.col("origin")).select("oid", "key", "start", "end")
    runs = later.repartition("oid", "key").sortWithinPartitions("oid", "key", "start").mapInArrow(_touching, _MARK)
    return small.unionAll(found.where("window IS NULL").drop("window")).unionAll(runs)


def repeated_strings(docs: DataFrame, id_col: str, text_col: str, part_pieces: int = PART_PIECES) -> DataFrame:
    """``oid``, ``key``, ``start``, ``end`` (bytes): ranges, which may overlap, of strings that also start earlier."""
    rows = docs.select(F.coalesce(F.col(id_col), F.lit(_NO_ID)).alias("oid"), _key(docs, id_col, text_col).alias("key"), text_or_empty(docs[text_col]).alias("text"))
    pieces = rows.mapInArrow(_find_pieces, "kind tinyint, h bigint, around bigint, oid bigint, key bigint, span bigint")
    dealt = pieces.repartition("h").sortWithinPartitions("h", "kind", "around", "oid", "key", "span")
    found = materialize(dealt.mapInArrow(_equal_pieces, "kind tinyint, h bigint, oid bigint, key bigint, start bigint, end bigint"), "equal_pieces")
    marks = found.where("kind = 1").select("oid", "key", "start", "end")
    places = found.where("kind = 0").groupBy("oid", "key").agg(F.collect_list(F.struct("h", F.col("start").alias("span"))).alias("places"))
    around = rows.join(places, ["oid", "key"]).mapInArrow(_surroundings, "h bigint, oid bigint, key bigint, span bigint, bytes binary")
    return marks.unionAll(_ordered(materialize(around, "pieces"), part_pieces))


def _key(docs: DataFrame, id_col: str, text_col: str):
    """What tells rows of one id apart; zero where ids are unique, which keeps shuffled rows short."""
    twice = docs.groupBy(F.col(id_col).alias("id")).count().where("count > 1 AND id IS NOT NULL OR id IS NULL")
    return F.lit(0).cast("bigint") if twice.isEmpty() else row_key(id_col, text_col)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_pieces: int = PART_PIECES) -> DataFrame:
    """One row for each row of ``docs``: ``id_col``, ``n_bytes``, ``spans`` (start and end of the maximal removed runs)
    and ``kept`` (the remaining bytes, which needn't be whole characters).

    Each byte goes that is covered by a 100-byte string which also starts earlier: in a document with a smaller id
    (null ids come first; of equal ids, a smaller hash of the text), or further up in the same one. Rows repeated with
    id and text count as one document and stay alike. Null and short texts keep all they have. Ids must be integers.
    An empty table gives no rows. ``part_pieces`` bounds what is ordered in one task, not the result."""
    marks = repeated_strings(docs, id_col, text_col, part_pieces).groupBy("oid", "key").agg(F.collect_list(F.struct("start", "end")).alias("marks"))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col), F.lit(_NO_ID)).alias("oid"), _key(docs, id_col, text_col).alias("key"), text_or_empty(docs[text_col]).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for text, marks in zip(batch.column(1), batch.column(2), strict=True):
                text, runs = text.as_py().encode(), []
                if marks.is_valid:
                    pairs = marks.values
                    start, end = (pairs.field(i).to_numpy(zero_copy_only=False) for i in range(2))
                    zero = np.zeros(len(start), np.int64)
                    runs = list(zip(*(x.tolist() for x in _merged(zero, zero, start, end)[2:]), strict=True))
                inner = [0, *[x for run in runs for x in run], len(text)]
                sizes.append(len(text))
                spans.append([{"start": a, "end": b} for a, b in runs])
                kept.append(b"".join(text[a:b] for a, b in zip(inner[::2], inner[1::2], strict=True)) if runs else text)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], names=[id_col, "n_bytes", "spans", "kept"])

    joined = rows.join(marks, ["oid", "key"], "left").select("id", "text", "marks")
    return joined.mapInArrow(cut, f"`{id_col}` bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``, strings of 100 bytes."""
    out = dedup_substrings(load(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op5_suffix_dedup": op5_suffix_dedup}
ORACLE: dict[str, str] = {}

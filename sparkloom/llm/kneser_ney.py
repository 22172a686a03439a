"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays, memory-mapped to score.

Counting tasks send blocks of sorted, combined counts to shards by hash range; a shard's task folds its blocks one
after the other and writes sorted arrays to the shared folder. Bigrams are sharded by ranges of both words, so that the
followers of a very common word are split; sums of contexts are combined in a second step, as are counts of endings.
Scoring tasks map the arrays and look up sorted queries; no task or driver holds the model.

Words are 64-bit hashes; bigrams and contexts use their upper 48 bits, so that of a billion words a few thousand are
taken for another (in counts for the unsmoothed base score none)."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_slices, load, scratch_path, text_bytes, text_or_empty
from .hashing import mixed, range_hashes

#: Text that one step works on; tokens that a counting task combines at a time; text for each shard of the model; rows
#: that a shard's task reads at least before it folds them.
SLICE_BYTES, COMBINE_TOKENS, SHARD_BYTES, FOLD_ROWS = 1 << 22, 3_000_000, 1 << 25, 1 << 20
_END, _BEGIN = np.uint64(0xE4D0F7A1B3C59281), np.uint64(0xB0512D6E9A7C3F47)
_WORDS, _BIGRAMS, _BEFORE, _CONTEXTS, _STATS = range(5)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens (words in lower case, then an end for each text), of the tokens before them, and rows."""
    data, ends = text_bytes(texts)
    n = len(ends) - 1
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    blank = np.zeros(256, bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = blank[data]
    edge = np.zeros(len(data) + 1, bool)  # texts touch each other, so their ends cut words
    edge[ends] = True
    start = np.nonzero(~gap[1:-1] & (gap[:-2] | edge[:-1]))[0]
    stop = np.nonzero(~gap[1:-1] & (gap[2:] | edge[1:]))[0] + 1
    row = np.searchsorted(ends, start, "right") - 1
    words = np.bincount(row, minlength=n)
    total = len(start) + n
    last = np.cumsum(words + 1) - 1
    token = np.full(total, _END)
    is_word = np.ones(total, bool)
    is_word[last] = False
    token[is_word] = range_hashes(low[data], start, stop)
    before = np.empty(total, np.uint64)
    before[1:] = token[:-1]
    before[last - words] = _BEGIN
    return token, before, np.repeat(np.arange(n), words + 1)


def _short(token: np.ndarray) -> np.ndarray:
    return token >> np.uint64(16)


def _bigram(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mixed(before * np.uint64(0x9FB21C651E98DF25) + token)


def _pair_shard(before: np.ndarray, token: np.ndarray, bits: int) -> np.ndarray:
    """Half of the bits of a bigram's shard are of its first word, and half of its second one."""
    second = bits // 2
    return (before >> np.uint64(48 - (bits - second))) << np.uint64(second) | token >> np.uint64(48 - second)


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of one length as a block; 48-bit words take six bytes, and small counts next to nothing."""
    parts = [np.int64(len(columns[0])).tobytes()]
    for c in columns:
        raw = np.ascontiguousarray(c.astype(np.uint64)).view(np.uint8).reshape(-1, 8)
        parts.append(raw.T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpack(block: bytes, columns: int) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    planes = np.frombuffer(raw, np.uint8, offset=8).reshape(columns, 8, n)
    return [np.ascontiguousarray(planes[i].T).view(np.uint64).reshape(-1) for i in range(columns)]


def _row(kind: int, shard: int, block: bytes) -> dict:
    return {"kind": kind, "shard": int(shard), "block": block}


_SCHEMA = "kind int, shard int, block binary"
_ARROW = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("block", pa.binary())])


def _by_shard(kind: int, bits: int, at: np.ndarray, *columns: np.ndarray) -> Iterator[dict]:
    """Blocks of rows sorted by ``at`` (a shard for each row)."""
    cuts = np.searchsorted(at, np.arange((1 << bits) + 1))
    for shard in np.nonzero(np.diff(cuts))[0]:
        yield _row(kind, shard, _pack(*[c[cuts[shard] : cuts[shard + 1]] for c in columns]))


def _counted(tokens: np.ndarray, before: np.ndarray, bits: int) -> Iterator[dict]:
    words, n = np.unique(tokens, return_counts=True)
    yield from _by_shard(_WORDS, bits, words >> np.uint64(64 - bits), words, n)
    v, w = _short(before), _short(tokens)
    _, at, n = np.unique(_bigram(v, w), return_index=True, return_counts=True)
    v, w = v[at], w[at]
    shard = _pair_shard(v, w, bits)
    order = np.lexsort((w, v, shard))
    v, w, n, shard = v[order], w[order], n[order], shard[order]
    # A run of one context is a step of zero, which compresses away.
    cuts = np.searchsorted(shard, np.arange((1 << bits) + 1))
    for s in np.nonzero(np.diff(cuts))[0]:
        part = slice(cuts[s], cuts[s + 1])
        yield _row(_BIGRAMS, s, _pack(np.diff(v[part], prepend=np.uint64(0)), w[part], n[part]))


def _classes(counts: np.ndarray, name: str) -> dict[str, int]:
    """How many counts are 1, 2, 3 and 4."""
    return {f"{name}{k}": int((counts == k).sum()) for k in (1, 2, 3, 4)}


class _Folder:
    """Arrays in a folder that all workers share.

    Of a store without local paths, a task maps copies in the executor's own folder for files, which go with the task."""

    def __init__(self, uri: str):
        self.uri, where = uri, urlparse(uri)
        self.local = where.path if where.scheme in ("", "file") else None
        self.copies = None

    def put(self, name: str, array: np.ndarray) -> None:
        if self.local:
            os.makedirs(self.local, exist_ok=True)
            part = f"{self.local}/.{name}-{uuid.uuid4().hex}"
            with open(part, "wb") as f:
                np.save(f, array)
            os.replace(part, f"{self.local}/{name}.npy")  # a task that runs again writes the same
        else:
            from pyarrow import fs

            store, path = fs.FileSystem.from_uri(self.uri)
            store.create_dir(path)
            with store.open_output_stream(f"{path}/{name}.npy") as f:
                np.save(f, array)

    def map(self, name: str) -> np.ndarray:
        if self.local:
            path = f"{self.local}/{name}.npy"
            return np.load(path, mmap_mode="r") if os.path.exists(path) else np.zeros(0, np.uint64)
        from pyarrow import fs

        if self.copies is None:
            self.copies = tempfile.mkdtemp(prefix="kneser-ney-", dir=SparkFiles.getRootDirectory())
        store, path = fs.FileSystem.from_uri(self.uri)
        if store.get_file_info(f"{path}/{name}.npy").type == fs.FileType.NotFound:
            return np.zeros(0, np.uint64)
        fs.copy_files(f"{path}/{name}.npy", f"{self.copies}/{name}.npy", source_filesystem=store, destination_filesystem=fs.LocalFileSystem())
        return np.load(f"{self.copies}/{name}.npy", mmap_mode="r")

    def close(self) -> None:
        if self.copies is not None:
            shutil.rmtree(self.copies, True)


def _summed(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums of the columns for each key; keys come out sorted."""
    if not len(keys):
        return (keys, *columns)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.nonzero(np.append(True, keys[1:] != keys[:-1]))[0]
    return (keys[at], *[np.add.reduceat(c[order], at) for c in columns])


def _summed_bigrams(bigram: np.ndarray, v: np.ndarray, w: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums of ``n`` for each bigram, with its words; bigrams come out sorted."""
    order = np.argsort(bigram, kind="stable")
    bigram = bigram[order]
    at = np.nonzero(np.append(True, bigram[1:] != bigram[:-1]))[0]
    return bigram[at], v[order[at]], w[order[at]], np.add.reduceat(n[order], at)


def _folded(parts: Iterator[tuple[np.ndarray, ...]], combine: Callable[..., tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Columns of all parts, combined as they come: no more rows are held than about twice the distinct ones."""
    held: list[tuple[np.ndarray, ...]] = []
    done = size = 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size > max(FOLD_ROWS, done):
            held = [combine(*map(np.concatenate, zip(*held, strict=True)))]
            done, size = len(held[0][0]), 0
    return combine(*map(np.concatenate, zip(*held, strict=True)))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, Iterator[bytes]]]:
    """(kind, shard, blocks) from rows sorted by both; the blocks of one are read before the next."""
    rows = ((*(c[i].as_py() for c in batch.columns[:2]), batch.columns[2][i]) for batch in batches for i in range(batch.num_rows))
    for (kind, shard), group in groupby(rows, key=lambda r: r[:2]):
        yield kind, shard, (r[2].as_py() for r in group)


def _arrow(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    for row in rows:
        yield pa.RecordBatch.from_pylist([row], schema=_ARROW)


def _stats(**values: int) -> dict:
    text = ";".join(f"{k}={v}" for k, v in values.items())
    return _row(_STATS, 0, text.encode())


@dataclass
class Model:
    """Where the arrays are, how many bits of a hash name a shard, and sums over the training texts."""

    path: str
    bits: int
    stats: dict[str, int]

    def discounts(self, name: str) -> np.ndarray:
        """Discounts of counts 1, 2 and 3 or more, from the numbers of counts of 1 to 4."""
        n = [self.stats.get(f"{name}{k}", 0) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
        out = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] and n[k] else k * 0.5 for k in (1, 2, 3)]
        return np.array([0.0, *[min(max(d, 0.0), float(k)) for k, d in zip((1, 2, 3), out, strict=True)]])


def train(docs: DataFrame, path: str, text_col: str = "text") -> Model:
    """Count the texts of ``docs`` and write the model's arrays to ``path`` in a folder that all workers share.

    Null text counts as empty. No rows give a model for which all tokens are unknown."""
    text = text_or_empty(docs[text_col])
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    bits = max(3, int(np.ceil(np.log2(max(size / SHARD_BYTES, 1)))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            tokens, before = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            yield from _arrow(_counted(tokens, before, bits))

        for batch in batches:
            for i, j in byte_slices(batch.column(0), SLICE_BYTES):
                held.append(_tokens(batch.column(0).slice(i, j - i))[:2])
                if sum(len(x[0]) for x in held) > COMBINE_TOKENS:
                    yield from flush()
        if held:
            yield from flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = _Folder(path)
        for kind, shard, blocks in _groups(batches):
            if kind == _WORDS:
                words, n = _folded((tuple(_unpack(b, 2)) for b in blocks), _summed)
                folder.put(f"words-{shard}", words)
                folder.put(f"word_counts-{shard}", n)
                yield from _arrow([_stats(tokens=int(n.sum()), types=len(words))])
                continue
            parts = ((np.cumsum(v, dtype=np.uint64), w, n) for v, w, n in (_unpack(b, 3) for b in blocks))
            bigram, v, w, n = _folded(((_bigram(v, w), v, w, n) for v, w, n in parts), _summed_bigrams)
            folder.put(f"bigrams-{shard}", bigram)
            folder.put(f"bigram_counts-{shard}", np.minimum(n, 0xFFFFFFFF).astype(np.uint32))
            context, *sums = _summed(v, n, *[(n == k).astype(np.uint64) for k in (1, 2)], (n > 2).astype(np.uint64))
            yield from _arrow(_by_shard(_CONTEXTS, bits, context >> np.uint64(48 - bits), context, *sums))
            yield from _arrow([_stats(**_classes(n, "n"))])
            words, before = np.unique(w, return_counts=True)
            yield from _arrow(_by_shard(_BEFORE, bits, words >> np.uint64(48 - bits), words, before))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = _Folder(path)
        for kind, shard, blocks in _groups(batches):
            if kind == _STATS:
                found = [x.split("=") for b in blocks for x in b.decode().split(";")]
            elif kind == _CONTEXTS:
                context, *sums = _folded((tuple(_unpack(b, 5)) for b in blocks), _summed)
                folder.put(f"contexts-{shard}", context)
                folder.put(f"context_sums-{shard}", np.stack(sums, axis=1))
                continue
            else:
                words, n = _folded((tuple(_unpack(b, 2)) for b in blocks), _summed)
                folder.put(f"endings-{shard}", words)
                folder.put(f"ending_counts-{shard}", n)
                more = {"bigrams": int(n.sum()), "endings": len(n), "m3plus": int((n > 2).sum())} | _classes(n, "m")
                found = more.items()
            yield pa.RecordBatch.from_pylist([{"name": k, "n": int(x)} for k, x in found], schema=pa.schema([("name", pa.string()), ("n", pa.int64())]))

    blocks = docs.select(text).mapInArrow(count, _SCHEMA)
    merged = blocks.repartition(2 << bits, "kind", "shard").sortWithinPartitions("kind", "shard").mapInArrow(merge, _SCHEMA)
    # Statistics of shards are spread like blocks; only their sums, one row for each name, reach the driver.
    spread = F.when(F.col("kind") == _STATS, F.xxhash64("block") % 64).otherwise(F.col("shard"))
    stats = merged.repartition(2 << bits, "kind", spread).sortWithinPartitions("kind", "shard").mapInArrow(finish, "name string, n bigint")
    return Model(path, bits, {r.name: r.n for r in stats.groupBy("name").agg(F.sum("n").alias("n")).collect()})


class _Lookup:
    def __init__(self, model: Model):
        self.folder, self.bits, self.arrays = _Folder(model.path), model.bits, {}

    def array(self, name: str, shard: int) -> np.ndarray:
        if (name, shard) not in self.arrays:
            self.arrays[name, shard] = self.folder.map(f"{name}-{shard}")
        return self.arrays[name, shard]

    def get(self, keys: str, values: str, query: np.ndarray, shard: np.ndarray, width: int = 1) -> np.ndarray:
        """Values of the queries, zero where a key isn't there. Queries are best sorted by shard and key."""
        out = np.zeros((len(query), width), np.int64)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange((1 << self.bits) + 1))
        for s in np.nonzero(np.diff(cuts))[0]:
            at, have = order[cuts[s] : cuts[s + 1]], self.array(keys, s)
            if len(have):
                place = np.minimum(np.searchsorted(have, query[at]), len(have) - 1)
                hit = have[place] == query[at]
                out[at[hit]] = self.array(values, s)[place[hit]].reshape(-1, width)
        return out if width > 1 else out[:, 0]


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and, for each row: ``n_tokens`` (words and one end), ``n_known`` (tokens seen in training),
    ``train_tokens``, ``base_score`` (add-one unigrams), ``score`` (log10 probability of the text) and ``perplexity``.

    Null text counts as empty: one token, the end. Repeated rows each give their row; no rows give no rows."""
    s = model.stats
    tokens, types, bigrams, endings = (s.get(k, 0) for k in ("tokens", "types", "bigrams", "endings"))
    d, e = model.discounts("n"), model.discounts("m")
    left = sum(x * s.get(k, 0) for x, k in zip(e[1:], ("m1", "m2", "m3plus"), strict=True)) / bigrams if bigrams else 1.0

    def of_slice(lookup: _Lookup, texts: pa.Array) -> tuple[np.ndarray, ...]:
        token, before, row = _tokens(texts)
        n = len(texts)
        word, at = np.unique(token, return_inverse=True)
        c = lookup.get("words", "word_counts", word, word >> np.uint64(64 - model.bits))[at]
        ending, at = np.unique(_short(token), return_inverse=True)
        m = lookup.get("endings", "ending_counts", ending, ending >> np.uint64(48 - model.bits))
        lower = ((m - e[np.minimum(m, 3)]) / max(bigrams, 1) + left / (endings + 1))[at]
        context, at = np.unique(_short(before), return_inverse=True)
        sums = lookup.get("contexts", "context_sums", context, context >> np.uint64(48 - model.bits), 4)
        total = sums[:, 0]
        back = np.where(total > 0, (sums[:, 1:] @ d[1:]) / np.maximum(total, 1), 1.0)[at]
        bigram, first, inverse = np.unique(_bigram(_short(before), _short(token)), return_index=True, return_inverse=True)
        shard = _pair_shard(_short(before[first]), _short(token[first]), model.bits)
        k = lookup.get("bigrams", "bigram_counts", bigram, shard)[inverse]
        p = (k - d[np.minimum(k, 3)]) / np.maximum(total[at], 1) + back * lower
        base = np.log10((c + 1) / (tokens + types + 1))
        return np.bincount(row, minlength=n), np.bincount(row, c > 0, n).astype(np.int64), np.bincount(row, base, n), np.bincount(row, np.log10(p), n)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, width = _Lookup(model), len(keep)
        try:
            for batch in batches:
                texts = batch.column(width)
                parts = [of_slice(lookup, texts.slice(i, j - i)) for i, j in byte_slices(texts, SLICE_BYTES)]
                if parts:
                    n, known, base, own = (np.concatenate(x) for x in zip(*parts, strict=True))
                    new = [n, known, np.full(len(n), tokens, np.int64), base, own, 10 ** (-own / n)]
                    yield pa.RecordBatch.from_arrays([*batch.columns[:width], *[pa.array(x) for x in new]], names=[*keep, "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])
        finally:
            lookup.folder.close()

    schema = docs.select(*keep).schema
    for name in ("n_tokens", "n_known", "train_tokens"):
        schema = schema.add(name, "long")
    for name in ("base_score", "score", "perplexity"):
        schema = schema.add(name, "double")
    return docs.select(*keep, text_or_empty(docs[text_col])).mapInArrow(of, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """One row in seven, by a checksum of the id; rows without an id are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``, scored by a model of those that aren't held out."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", held_out().alias("held_out"))
    model = train(docs.where(~F.col("held_out")), scratch_path(spark, "kneser_ney"))
    return score(docs, model, keep=("doc_id", "held_out"))


QUERIES = {"op1_lm_score": op1_lm_score}
ORACLE: dict[str, str] = {}

"""SimHash near-duplicate groups through anchor points of a covering code.

A 64-bit fingerprint is cut into blocks so that two fingerprints within the largest distance differ by one bit
at most in some block. On each block the anchors are the words of a covering code of radius 1 (a Hamming code on
15 bits, every value of the rest). A fingerprint's home is the one anchor within the radius; it is also replicated
to every anchor within radius plus one. A pair that is close in a block then meets at the home of either."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, let, load, materialize, sized, space_words, text_or_empty
from .components import connected_components, toward_least
from .hashing import mixed

#: Rows of one anchor compared in one task; more are dealt out in parts, and each two parts meet in a task.
CELL_ROWS = 4096
_CODE_BITS = 15


def shingle_hashes(text: Column, k: int) -> Column:
    """XXH64 (seed 42) of each run of ``k`` words, repeats included; of the whole sequence where it is shorter."""

    def of(words: Column) -> Column:
        n = F.size(words)
        each = F.transform(F.sequence(F.lit(1), n - (k - 1)), lambda i: F.xxhash64(F.concat_ws(" ", F.slice(words, i, k))))
        return F.when(n >= k, each).when(n > 0, F.array(F.xxhash64(F.concat_ws(" ", words)))).otherwise(F.array().cast("array<bigint>"))

    return let(space_words(ascii_lower(text)), of)


def _majorities(hashes: pa.Array, sketch: int = 0) -> np.ndarray:
    """For each list of 64-bit hashes, the bits that are set in over half of them; of other hashes made from these
    for each further sketch."""
    hashes = hashes.combine_chunks() if isinstance(hashes, pa.ChunkedArray) else hashes
    ends = hashes.offsets.to_numpy().astype(np.int64)
    values = hashes.values.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if sketch:
        values = mixed(values.view(np.uint64) ^ np.uint64(sketch * 0x9E3779B97F4A7C15 & (1 << 64) - 1)).view(np.int64)
    out = np.zeros(len(hashes), np.uint64)
    i = 0
    while i < len(hashes):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + 100_000, "right")) - 1)
        sizes = np.diff(ends[i : j + 1])
        full = np.nonzero(sizes)[0]
        if len(full):
            bits = np.unpackbits(values[ends[i] : ends[j]].view(np.uint8), bitorder="little").reshape(-1, 64)
            counts = np.add.reduceat(bits, ends[i:j][full] - ends[i], axis=0, dtype=np.int32)
            ones = counts * 2 > sizes[full][:, None]
            out[i + full] = np.packbits(ones, axis=1, bitorder="little").view(np.uint64)[:, 0]
        i = j
    return out


def fingerprints(docs: DataFrame, k: int, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), sketches: int = 1) -> DataFrame:
    """The columns ``keep`` and ``fp``, the fingerprint as a signed bigint; further independent sketches are ``fp1``,
    ``fp2`` and so on. Text without words has fingerprint zero."""
    rows = docs.select(*keep, shingle_hashes(text_or_empty(docs[text_col]), k).alias("_hashes"))
    names = ["fp", *[f"fp{n}" for n in range(1, sketches)]]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [pa.array(_majorities(batch.column(len(keep)), n).view(np.int64)) for n in range(sketches)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *fps], names=[*keep, *names])

    schema = docs.select(*keep).schema
    for name in names:
        schema = schema.add(name, "long")
    return rows.mapInArrow(of, schema)


def _blocks(distance: int) -> list[tuple[int, int]]:
    """(shift, bits) of blocks of which one has at most one of ``distance`` differing bits."""
    m = distance // 2 + 1
    if not 0 <= distance <= 7:
        raise ValueError("the largest distance must be from 0 to 7: four blocks of 16 bits, one error each, allow no more")
    cuts = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _patterns(bits: int) -> list[list[int]]:
    """For each syndrome of the code, the changes of at most two bits that lead to a code word; the home's is first."""
    table: list[list[int]] = [[] for _ in range(_CODE_BITS + 1)]
    for weight in range(3):
        for places in combinations(range(bits), weight):
            syndrome = 0
            for p in places:
                syndrome ^= p + 1 if p < _CODE_BITS else 0
            table[syndrome].append(sum(1 << p for p in places))
    # Within the radius: no change, or one in the code's own bits.
    return [sorted(row, key=lambda e: (e.bit_count() > 1 or e >= 1 << _CODE_BITS, e)) for row in table]


def _block_replicas(fp: Column, n: int, shift: int, bits: int) -> Column:
    value = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << bits) - 1))
    checks = [sum(1 << (j - 1) for j in range(1, _CODE_BITS + 1) if j >> i & 1) for i in range(4)]
    syndrome = sum((F.bit_count(value.bitwiseAND(F.lit(mask))) % 2) * (1 << i) for i, mask in enumerate(checks))
    table = F.array(*[F.array(*[F.lit(e).cast("bigint") for e in row]) for row in _patterns(bits)])
    changes = F.element_at(table, (syndrome + 1).cast("int"))
    return F.transform(changes, lambda e, i: F.struct((value.bitwiseXOR(e) * 8 + n).alias("cell"), (i == 0).alias("home")))


def _replicas(fp: Column, distance: int) -> Column:
    """Array of (cell, home): the anchors of each block to which a fingerprint goes."""
    return F.concat(*[_block_replicas(fp, n, shift, bits) for n, (shift, bits) in enumerate(_blocks(distance))])


def _join_sets(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unite the sets of the ends of the links (i, j); ``label`` maps each row to its set's smallest row."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(jumped := label[label], label):
            label[:] = jumped


def _cell_links(distance: int):
    """For rows (cell, part, part, fp, value, home, and a further word if need be) sorted in that order: the links of homes
    to all rows of their cell with a near value, as one star around the least fp of each linked set."""

    def links(fp: np.ndarray, words: list[np.ndarray], home: np.ndarray, first: np.ndarray) -> np.ndarray:
        starts = np.nonzero(first)[0]
        size, start = np.diff(np.append(starts, len(fp))), starts
        group = np.cumsum(first) - 1
        homes = np.nonzero(home & (size[group] > 1))[0]
        per = size[group[homes]]
        label, ends = np.arange(len(fp)), np.cumsum(per)
        k = 0
        while k < len(homes):
            done = ends[k - 1] if k else 0
            k2 = max(k + 1, int(np.searchsorted(ends, done + 1_000_000, "right")))
            h, n = homes[k:k2], per[k:k2]
            left = np.repeat(h, n)
            right = np.repeat(start[group[h]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            near = sum(np.bitwise_count(w[left] ^ w[right]).astype(np.int16) for w in words) <= distance
            _join_sets(label, left[near], right[near])
            k = k2
        linked = np.nonzero(label != np.arange(len(fp)))[0]
        # A set of near values has the same star in each of its cells, so most links of a batch are alike.
        star = np.unique(np.stack([fp[linked], fp[label[linked]]]), axis=1)
        return star[:, star[0] != star[1]]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def joined(columns):
            cells, (fp, value, home, *further) = columns[:3], columns[3:]
            first = np.ones(len(fp), bool)
            first[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cells])
            return fp, [w.view(np.uint64) for w in (value, *further)], home.astype(bool), first

        def out(fp, words, home, first, cut=None):
            a, b = links(fp[:cut], [w[:cut] for w in words], home[:cut], first[:cut])
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = [np.concatenate(x) for x in zip(held, new, strict=True)] if held else new
            rows = joined(held)
            cut = int(np.nonzero(rows[-1])[0][-1]) if len(rows[0]) else 0
            if cut:  # the last cell may go on in the next batch
                yield out(*rows, cut)
                held = [c[cut:] for c in held]
        if held and len(held[0]):
            yield out(*joined(held))

    return of


def fingerprint_links(prints: DataFrame, distance: int, cell_rows: int = CELL_ROWS, total: int | None = None, replicas: bool = True) -> DataFrame:
    """``prints`` has rows (sketch, value, fp), each sketch and value once; an fp may have many. Returns links (a, b) of fps that connect the
    same ones as all pairs of values of one sketch within ``distance`` do: in each cell a linked set gives a star and
    not all of its pairs.

    With ``total``, ``prints`` has a further word ``check``; then pairs that meet at an anchor, as all within ``distance``
    do, are linked if value and check together differ in at most ``total`` bits. Without ``replicas`` only values with one
    home meet: some of the links, for a small part of the work."""
    further = [] if total is None else ["check"]
    of_block = F.transform(_replicas(F.col("value"), distance), lambda x: F.struct((x["cell"] * 16 + F.col("sketch")).alias("cell"), x["home"].alias("home")))
    if not replicas:
        of_block = F.filter(of_block, lambda x: x["home"])
    rows = prints.select("fp", "value", *further, F.inline(of_block))
    # An anchor with very many fingerprints is dealt out in parts; each two of its parts meet in one cell.
    large = materialize(rows.groupBy("cell").count().where(F.col("count") > cell_rows).select("cell", F.ceil(F.col("count") / cell_rows).cast("int").alias("parts")), "large_cells")
    if large.isEmpty():
        dealt = rows.select("cell", F.lit(0).alias("p"), F.lit(0).alias("q"), "fp", "value", "home", *further)
    else:
        marked = rows.join(sized(large), "cell", "left")
        part = F.pmod(F.xxhash64("value"), F.coalesce("parts", F.lit(1))).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
        dealt = marked.select("cell", "fp", "value", "home", *further, part.alias("own"), other.alias("other")).select("cell", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "fp", "value", "home", *further)
    ordered = dealt.repartition("cell", "p", "q").sortWithinPartitions("cell", "p", "q", "fp")
    return ordered.mapInArrow(_cell_links(distance if total is None else total), "a bigint, b bigint")


def near_duplicate_groups(docs: DataFrame, k: int = 5, distance: int = 6, sketches: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``id_col``, ``fp`` and ``component_id``, the smallest id that can be reached
    over links of fingerprints that differ in at most ``distance`` bits, in any of ``sketches`` independent ones.

    Null text counts as empty. Rows with a null id are grouped like others; a group of null ids only has a null
    component. Equal ids and repeated rows each give their row. No rows give no rows."""
    rows = materialize(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), k, keep=("id",), sketches=sketches), "fingerprints")
    prints = materialize(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "prints")
    if sketches == 1:
        links = fingerprint_links(prints.select(F.lit(0).alias("sketch"), F.col("fp").alias("value"), "fp"), distance)
    else:
        # A value of a sketch stands for the least first fingerprint it comes with; others that it comes with are linked.
        each = rows.select("fp", F.posexplode(F.array("fp", *[f"fp{n}" for n in range(1, sketches)])).alias("sketch", "value"))
        met = materialize(each.groupBy("sketch", "value").agg(F.min("fp").alias("fp"), F.max("fp").alias("top")), "stand_ins")
        same = each.join(met.where("fp <> top").withColumnRenamed("fp", "b"), ["sketch", "value"]).select(F.col("fp").alias("a"), "b").distinct()
        # A fingerprint has a smaller neighbour for each of its cells at most, and those of a large group share them.
        links = toward_least(fingerprint_links(met.select("sketch", "value", "fp"), distance)).unionAll(same)
    labels = connected_components(links)
    classed = prints.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("label", "fp").alias("label"))
    least = classed.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_print = materialize(classed.join(least, "label").select("fp", "component_id"), "classes")
    return rows.select("id", "fp").join(of_print, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``: four-word shingles, links at four or fewer differing bits."""
    out = near_duplicate_groups(load(spark, sf_dir, "documents"), k=4, distance=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op3_simhash": op3_simhash}
ORACLE: dict[str, str] = {}

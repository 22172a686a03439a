"""Near-duplicate documents: SimHash finds candidates, and the exact Jaccard similarity of shingle sets decides.

Each set of shingles has several independent fingerprints. Sets that meet at an anchor of the covering code in one of
them are candidates if that fingerprint and the next one together differ in few bits; the components of these links are
families. Each two sets of a family meet, and are linked for good if their similarity reaches the least one. Sets that
meet are first told apart by bitmaps: bits that differ can't be more than the shingles that do."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, sized, text_or_empty
from .components import connected_components, toward_least
from .hashing import mixed
from .simhash import _majorities, fingerprint_links, shingle_hashes

#: Fingerprints of a set; those within DISTANCE bits always meet at an anchor, and others may. Of sets with a similarity
#: of 0.8 a bit differs with a chance of 0.15, so two fingerprints differ in 19 of 128 bits on average. With over ten
#: shingles 997 of 1000 such pairs are candidates, with four or five 954 (measured in the tests).
SKETCHES, DISTANCE, TOTAL = 5, 7, 28
#: Sets and shingles of a family that are dealt out as one part; each two parts meet in a task.
PART_SETS, PART_SHINGLES = 256, 1_000_000
#: 64-bit words of a bitmap.
BITMAP_WORDS = 16


def _shingles(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, node, n, shingles): a hash of the set of shingles stands for it as ``node``."""
    each = docs.select(F.col(id_col).alias("id"), F.sort_array(F.array_distinct(shingle_hashes(text_or_empty(docs[text_col]), k))).alias("shingles"))
    return each.select("id", F.xxhash64("shingles").alias("node"), F.size("shingles").alias("n"), "shingles")


def set_prints(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, node, n, f0, f1, ...): the fingerprints of each row's set of shingles."""
    names = [f"f{i}" for i in range(SKETCHES)]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [pa.array(_majorities(batch.column(3), i).view(np.int64)) for i in range(SKETCHES)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *prints], names=["id", "node", "n", *names])

    rows = _shingles(docs, k, id_col, text_col)
    schema = rows.select("id", "node", "n").schema
    for name in names:
        schema = schema.add(name, "long")
    return rows.mapInArrow(of, schema)


def candidate_families(nodes: DataFrame) -> DataFrame:
    """``node`` and ``label``, the family, of each node (with f0, f1, ...) that is a candidate with another one."""
    pairs = [F.struct(F.col(f"f{i}").alias("value"), F.col(f"f{(i + 1) % SKETCHES}").alias("check")) for i in range(SKETCHES)]
    each = nodes.select("node", F.posexplode(F.array(*pairs)).alias("sketch", "of")).select("node", "sketch", "of.*")
    met = materialize(each.groupBy("sketch", "value", "check").agg(F.min("node").alias("fp"), F.max("node").alias("top")), "stand_ins")
    same = each.join(met.where("fp <> top"), ["sketch", "value", "check"]).select(F.col("node").alias("a"), F.col("fp").alias("b"))
    # Near copies of one text meet again and again, so nodes that one sketch's homes link stand for each other: from there
    # on a link is between two such groups.
    prints = met.select("sketch", "value", "check", "fp")
    first = fingerprint_links(prints.where("sketch = 0"), DISTANCE, total=TOTAL, replicas=False)
    groups = materialize(connected_components(first.unionAll(same)), "groups")
    group = sized(groups.select(F.col("node").alias("_node"), "label"))
    named = prints.join(group, F.col("fp") == F.col("_node"), "left").select("sketch", "value", "check", F.coalesce("label", "fp").alias("fp"))
    near = fingerprint_links(named, DISTANCE, total=TOTAL)
    return connected_components(toward_least(near).unionAll(groups.select(F.col("node").alias("a"), F.col("label").alias("b"))))


def _bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(sets), BITMAP_WORDS), np.uint64)
    for row, values in zip(out, sets, strict=True):
        bits = mixed(values.view(np.uint64)) % np.uint64(64 * BITMAP_WORDS)
        np.bitwise_or.at(row, (bits >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bits & np.uint64(63)))
    return out


def similar_links(nodes: np.ndarray, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links of nodes that connect the same ones as all pairs of sets with at least ``similarity`` do: pairs that are
    connected already are left out."""
    n, bitmaps, label, links = np.array([len(s) for s in sets]), _bitmaps(sets), np.arange(len(sets)), []
    for i in range(1, len(sets)):
        # Of s shingles in both sets together, counted twice where shared, at most this many are in one of them only.
        most = (n[:i] + n[i]) * ((1 - similarity) / (1 + similarity)) + 1e-6
        apart = np.bitwise_count(bitmaps[:i] ^ bitmaps[i]).sum(axis=1, dtype=np.int64)
        for j in np.nonzero((apart <= most) & (np.abs(n[:i] - n[i]) <= most))[0]:
            if label[i] == label[j]:
                continue
            shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if shared >= similarity * (n[i] + n[j] - shared) - 1e-9:
                links.append((nodes[i], nodes[j]))
                low, high = sorted((label[i], label[j]))
                label[label == high] = low
    return links


def verified_links(families: DataFrame, docs: DataFrame, k: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """Links (a, b) of similar nodes of one family. ``families`` has (node, label, n, first_id); the shingles of each node
    are made again from the text of its first id."""
    # A large family is dealt out in parts; each two of its parts meet in one cell.
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / PART_SETS, F.sum("n") / PART_SHINGLES)).cast("int")
    large = materialize(families.groupBy("label").agg(parts.alias("parts")).where("parts > 1"), "large_families")
    wanted = families.join(sized(large), "label", "left").select("first_id", F.col("node").alias("_node"), F.col("label").alias("family"), F.coalesce("parts", F.lit(1)).alias("parts"))
    wanted = materialize(wanted, "wanted_sets")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(sized(wanted), F.col("_id").eqNullSafe(F.col("first_id")))
    each = texts.select("_node", "family", "parts", F.sort_array(F.array_distinct(shingle_hashes(text_or_empty("_text"), k))).alias("shingles"))
    members = each.where(F.xxhash64("shingles") == F.col("_node"))  # rows with the same id may have other texts
    own, other = F.pmod(F.xxhash64(F.col("_node"), F.lit("part")), F.col("parts")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = members.select("family", F.col("_node").alias("node"), "shingles", own.alias("own"), other.alias("other")).select("family", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "node", "shingles")
    ordered = dealt.repartition("family", "p", "q").sortWithinPartitions("family", "p", "q", "node")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, nodes, sets = None, [], []

        def out() -> pa.RecordBatch:
            links = similar_links(np.array(nodes), sets, similarity)
            return pa.RecordBatch.from_arrays([pa.array([int(x[e]) for x in links], pa.int64()) for e in (0, 1)], names=["a", "b"])

        for batch in batches:
            f, p, q, node = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:4])
            ends, values = batch.column(4).offsets.to_numpy(), batch.column(4).values.to_numpy(zero_copy_only=False)
            for i in range(len(node)):
                if cell != (now := (f[i], p[i], q[i])):
                    if len(nodes) > 1:
                        yield out()
                    cell, nodes, sets = now, [], []
                if nodes and nodes[-1] == node[i]:  # a repeated row
                    continue
                nodes.append(node[i])
                sets.append(values[ends[i] : ends[i + 1]].copy())
        if len(nodes) > 1:
            yield out()

    return ordered.mapInArrow(of, "a bigint, b bigint")


def similar_groups(docs: DataFrame, k: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``id_col`` and ``component_id``, the smallest id that can be reached over
    pairs of texts whose sets of ``k``-word shingles have a Jaccard similarity of at least ``similarity``.

    Texts with the same set are alike, and so are all without words; null counts as empty. Equal ids and repeated rows each
    give their row. No rows give no rows."""
    prints = materialize(set_prints(docs, k, id_col, text_col), "set_prints")
    columns = [F.first(c).alias(c) for c in ("n", *[f"f{i}" for i in range(SKETCHES)])]
    nodes = materialize(prints.groupBy("node").agg(F.min("id").alias("first_id"), *columns), "nodes")
    families = candidate_families(nodes.where("n > 0")).join(nodes.select("node", "n", "first_id"), "node")
    labels = connected_components(verified_links(materialize(families, "families"), docs, k, similarity, id_col, text_col))
    classed = nodes.join(labels, "node", "left").select("node", "first_id", F.coalesce("label", "node").alias("label"))
    least = classed.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_node = materialize(classed.join(least, "label").select("node", "component_id"), "classes")
    return prints.select("id", "node").join(of_node, "node").select(F.col("id").alias(id_col), "component_id")


def drop_similar(docs: DataFrame, k: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one document of each group of similar ones, the one with the smallest id.

    Rows with a null id stay; so do repeated rows of the id that stays."""
    groups = similar_groups(docs.where("doc_id IS NOT NULL"), k, similarity)
    dropped = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(sized(materialize(dropped, "dropped")), "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])

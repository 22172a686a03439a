"""Line deduplication by winnowing over line hashes.

A window is a shortest run of lines, forward from a line or back from it, with at least ``min_words`` words. The
least line hash of a window is its fingerprint, so any run of at least that many words that occurs twice has the same
fingerprints in both places. Positions are joined on fingerprints that occur at two places or more; a window around
such a position is compared whole by its lines' hashes, and each that starts earlier elsewhere is repeated. As the
windows to either side of a line reach from it both ways, what they cover together is every repeated run as far as
it extends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CHARS, let, load, materialize, packed, row_key, text_or_empty, unpacked

_WORD = r"[^\x20\x09-\x0D]+"


def _lines(text: Column) -> Column:
    """(h, w, p) of each line with words: hash of the trimmed line, words, place among all lines."""
    each = F.transform(F.split(text, "\n"), lambda x, p: F.struct(F.xxhash64(F.btrim(x, F.lit(SPACE_CHARS))).alias("h"), F.regexp_count(x, F.lit(_WORD)).alias("w"), p.alias("p")))
    return F.filter(each, lambda x: x["w"] > 0)


def _reach(lines: Column, min_words: int) -> Column:
    """How many of ``lines``, from the first on, have ``min_words`` words; zero if they don't."""
    none = F.struct(F.lit(0).alias("w"), F.lit(0).alias("n"))
    add = lambda a, x: F.when(a["w"] >= min_words, a).otherwise(F.struct((a["w"] + x["w"]).alias("w"), (a["n"] + 1).alias("n")))
    return F.aggregate(lines, none, add, lambda a: F.when(a["w"] >= min_words, a["n"]).otherwise(0))


def _windows(text: Column, min_words: int) -> Column:
    """Array of windows: fingerprint, its place, hash of the lines, first and last line's places."""

    def of(lines: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(lines))
        # A line has a word at least, so no window has more lines than words.
        forward = F.transform(at, lambda i: F.struct(i.alias("i"), _reach(F.slice(lines, i, min_words), min_words).alias("n")))
        low = lambda i: F.greatest(i - (min_words - 1), F.lit(1))
        back = F.transform(at, lambda i: let(_reach(F.reverse(F.slice(lines, low(i), i - low(i) + 1)), min_words), lambda n: F.struct((i - n + 1).alias("i"), n.alias("n"))))
        spans = F.filter(F.array_distinct(F.concat(forward, back)), lambda s: s["n"] > 0)
        cut = F.transform(spans, lambda s: F.slice(lines, s["i"], s["n"]))
        return F.transform(cut, _summary)

    return let(_lines(text), lambda lines: F.when(F.size(lines) > 0, of(lines)))


def _summary(run: Column) -> Column:
    least = F.array_min(F.transform(run, lambda x: F.struct(x["h"].alias("h"), x["p"].alias("p"))))
    return F.struct(
        least["h"].alias("fp"), least["p"].alias("place"), F.xxhash64(F.transform(run, lambda x: x["h"])).alias("content"), F.get(run, F.lit(0))["p"].alias("first"), F.element_at(run, -1)["p"].alias("last")
    )


def repeated_runs(docs: DataFrame, min_words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Windows that also start earlier: ``id``, ``key`` and the places ``first`` and ``last`` of their lines."""
    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.inline(_windows(text_or_empty(docs[text_col]), min_words)))
    rows = materialize(rows, "line_windows")
    place = F.struct("id", "key", "place")
    shared = materialize(rows.groupBy("fp").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("NOT a <=> b").select("fp"), "shared_lines")
    found = rows.join(shared, "fp")
    start = F.struct("id", "key", "first")
    origin = materialize(found.groupBy("fp", "content").agg(F.min(start).alias("origin"), F.max(start).alias("b")).where("NOT origin <=> b").drop("b"), "first_runs")
    # Only windows with an earlier twin are left; the join is between two shuffled sides, which a hot line can't clog.
    return rows.join(origin, ["fp", "content"]).where(~start.eqNullSafe(F.col("origin"))).select("id", "key", "first", "last")


def _deduped(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """``row`` (packed), ``left`` (the text that stays), ``n_lines`` and ``n_removed``."""
    runs = repeated_runs(docs, min_words, id_col, text_col)
    marks = materialize(runs.groupBy("id", "key").agg(F.collect_set(F.struct("first", "last")).alias("runs")), "line_marks").withColumnsRenamed({"id": "_id", "key": "_key"})
    rows = docs.select(packed(docs).alias("row"), F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    joined = rows.join(marks, rows["id"].eqNullSafe(marks["_id"]) & (rows["key"] == marks["_key"]), "left")
    lines = F.split("text", "\n")
    covered = F.array_distinct(F.flatten(F.transform("runs", lambda s: F.sequence(s["first"], s["last"]))))
    kept = let(lines, lambda all_: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(all_) - 1), covered), lambda p: F.get(all_, p)), "\n"))
    return joined.select(
        "row",
        F.when(F.col("runs").isNull(), F.col("text")).otherwise(kept).alias("left"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("bigint").alias("n_lines"),
        F.when(F.col("runs").isNull(), 0).otherwise(F.size(covered)).cast("bigint").alias("n_removed"),
    )


def dedup_lines(docs: DataFrame, min_words: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` less the lines of repeated runs, and with ``n_lines`` and ``n_removed``.

    A line goes if it is in a run of lines, with at least ``min_words`` words, that also starts earlier: in a
    document with a smaller id, or of equal ids a smaller hash of the text (null ids come first), or further up in
    the same one. Lines are compared without white space at their ends; blank lines never tell runs apart, and go
    if they are between lines of one window. Rows repeated with id and text count as one and stay alike. Null text stays null,
    with no lines. An empty table gives no rows. Columns named n_lines or n_removed are replaced."""
    out = _deduped(docs, min_words, id_col, text_col)
    return out.select(*unpacked(docs, **{text_col: F.col("left"), "n_lines": F.col("n_lines"), "n_removed": F.col("n_removed")}))


def drop_repeated_lines(docs: DataFrame, min_words: int = 10) -> DataFrame:
    """``documents`` less the lines of repeated runs; documents of which nothing but white space is left go."""
    out = _deduped(docs, min_words, "doc_id", "text").where((F.col("n_removed") == 0) | (F.btrim("left", F.lit(SPACE_CHARS)) != ""))
    n_chars = F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(F.char_length("left"))
    return out.select(*unpacked(docs, text=F.col("left"), n_chars=n_chars))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``, runs of ten words or more."""
    out = dedup_lines(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


QUERIES = {"op6_line_dedup": op6_line_dedup}
ORACLE = {
    "op6_line_dedup": r"""
        WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
        l0 AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS p FROM d),
        l1 AS (SELECT doc_id, p, trim(line, E' \t\n\x0b\f\r') AS t, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w FROM l0),
        l AS (SELECT doc_id, p, t, w, row_number() OVER o AS i, sum(w) OVER o AS upto FROM l1 WHERE w > 0 WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
        pairs AS (SELECT a.doc_id, a.i AS i, b.i AS j FROM l a JOIN l b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i AND a.i + 9 AND b.upto - a.upto + a.w >= 10),
        win AS (SELECT doc_id, i, min(j) AS j FROM pairs GROUP BY ALL UNION SELECT doc_id, max(i) AS i, j FROM pairs GROUP BY doc_id, j),
        text AS (SELECT win.doc_id, win.i, win.j, string_agg(t, chr(10) ORDER BY l.i) AS content, min(p) AS a, max(p) AS b
                 FROM win JOIN l ON l.doc_id = win.doc_id AND l.i BETWEEN win.i AND win.j GROUP BY ALL),
        again AS (SELECT doc_id, a, b, dense_rank() OVER (PARTITION BY content ORDER BY doc_id, i) AS k FROM text),
        gone AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS p FROM again WHERE k > 1)
        SELECT d.doc_id, any_value(len(ls))::BIGINT AS n_lines, count(gone.p)::BIGINT AS n_removed,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY l0.p) FILTER (gone.p IS NULL), '')) AS kept_sha256
        FROM d JOIN l0 USING (doc_id) LEFT JOIN gone ON gone.doc_id = l0.doc_id AND gone.p = l0.p GROUP BY d.doc_id"""
}

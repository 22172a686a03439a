"""Benchmark decontamination as a prefix-filtered set join.

A window is a run of ``width`` words of a benchmark item (a shorter item is one window). Its tokens are its
shingles. As all tokens of a window must be in a document that contains it, one necessary token is enough to find
the candidates: the rarest one, in the order of the tokens' frequencies over all documents; a window with a token in no
document is done with. Candidates must leave room for the window before and after the token's place, and are then
compared word by word. Tokens are joined as hashes with their places; words are fetched for candidates only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, load, materialize, normal_words, packed, row_key, sized, spaces_in, text_or_empty, unpacked

#: Words of a token; a window with fewer words is one token.
TOKEN_WORDS = 5
_TOKEN = "array<struct<h:bigint,pos:int,rest:int>>"


def _words(text: Column) -> Column:
    return let(F.btrim(normal_words(text)), lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " ")))


def _tokens(words: Column, lengths: list[int]) -> Column:
    """Array of (h, pos, rest): the hash and first word's place of each run of as many words as ``lengths`` says, and the
    number of words from there on."""

    def of(hashes: Column) -> Column:
        none = F.array().cast(_TOKEN)
        runs = []
        for k in lengths:
            token = lambda i, k=k: F.xxhash64(F.lit(k), *[F.get(hashes, i + j) for j in range(k)])
            runs.append(F.when(F.size(hashes) >= k, F.transform(F.sequence(F.lit(0), F.size(hashes) - k), _named(token, F.size(hashes)))).otherwise(none))
        return F.concat(*runs) if runs else none

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def _by_length(own: Column, lengths: list[int]) -> Column:
    """The tokens of ``window`` of the length ``own``."""
    out = F.array().cast(_TOKEN)
    for k in lengths:
        out = F.when(own == k, _tokens(F.col("window"), [k])).otherwise(out)
    return out


def _named(token, n: Column):
    return lambda i: F.struct(token(i).alias("h"), i.alias("pos"), (n - i).alias("rest"))


def item_windows(items: DataFrame, width: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item``, ``window`` (its words) and ``wid``, a digest that stands for the window."""
    words = items.select(F.col(id_col).alias("item"), _words(text_or_empty(items[text_col])).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (width - 1), F.lit(1)))
    each = words.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, width))).alias("window"))
    return each.select("item", "window", F.md5(F.concat_ws(" ", "window")).alias("wid")).distinct()


def find_windows(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every occurrence of a window: ``id``, ``key`` (a hash of the row's id and text), ``start`` and ``end`` (word
    places, end excluded) and ``wid``; and the items of each window: ``wid`` and ``item``."""
    of_item = materialize(item_windows(items, width), "item_windows")
    windows = of_item.select("wid", "window").distinct()
    # Of the token lengths a window has the longest that fits it.
    own = F.least(F.size("window"), F.lit(TOKEN_WORDS))
    lengths = sorted(r[0] for r in windows.select(own).distinct().collect())  # five numbers at most
    of_window = materialize(windows.select("wid", F.size("window").alias("width"), (F.size("window") - own + 1).alias("all"), F.inline(_by_length(own, lengths))), "window_tokens")
    known = of_window.select("h").distinct()
    words = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), _words(text_or_empty(docs[text_col])).alias("words"))
    tokens = words.select("id", "key", F.inline(_tokens(F.col("words"), lengths)))
    places = materialize(tokens.join(sized(known), "h"), "token_places")
    frequency = places.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    rarest = of_window.join(frequency, "h").groupBy("wid", "width", "all").agg(F.min(F.struct("n", "pos", "h")).alias("t"), F.count(F.lit(1)).alias("seen")).where(F.col("seen") == F.col("all"))
    prefix = materialize(rarest.select("wid", "width", "t.h", F.col("t.pos").alias("offset")), "prefix")
    start = F.col("pos") - F.col("offset")
    with_room = places.join(sized(prefix), "h").where((start >= 0) & (F.col("width") - F.col("offset") <= places["rest"]))
    candidates = with_room.select(F.col("id").alias("_id"), F.col("key").alias("_key"), start.alias("start"), "wid").join(sized(windows), "wid")
    of_row = materialize(candidates.groupBy("_id", "_key").agg(F.collect_set(F.struct("start", "wid", "window")).alias("candidates")), "candidates")
    same = words["id"].eqNullSafe(F.col("_id")) & (words["key"] == F.col("_key"))
    found = words.join(sized(of_row), same).select("id", "key", let(F.col("words"), lambda w: F.filter("candidates", lambda c: F.slice(w, c["start"] + 1, F.size(c["window"])) == c["window"])).alias("found"))
    spans = found.select("id", "key", F.inline(F.transform("found", lambda c: F.struct(c["start"].alias("start"), (c["start"] + F.size(c["window"])).alias("end"), c["wid"].alias("wid")))))
    return spans, of_item.select("wid", "item")


def _covered(spans: Column) -> Column:
    """Words in the union of (start, end) pairs."""
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("bigint").alias("n"))
    step = lambda a, s: F.struct(F.greatest(a["upto"], s["end"]).alias("upto"), (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["upto"]))).alias("n"))
    return F.aggregate(F.array_sort(spans), zero, step, lambda a: a["n"])


def contamination(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``id_col``, ``n_words``, ``n_hit`` (words inside an occurrence of a window)
    and ``items`` (sorted ids, as strings, of the items with occurring windows).

    Null and wordless texts have no words and no hits; null and wordless items have no windows, and an item with a
    null id marks words but isn't listed. Repeated rows each give their row. Empty tables give no rows or no hits."""
    spans, of_item = find_windows(docs, items, width, id_col, text_col)
    spans = materialize(spans, "windows_found")
    hits = spans.groupBy("id", "key").agg(_covered(F.collect_set(F.struct("start", "end"))).alias("n_hit"))
    listed = spans.select("id", "key", "wid").distinct().join(sized(of_item), "wid").groupBy(F.col("id").alias("_id"), F.col("key").alias("_key")).agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    found = materialize(hits.join(listed, hits["id"].eqNullSafe(F.col("_id")) & (hits["key"] == F.col("_key"))).select("id", "key", "n_hit", "items"), "contaminated")
    n_words = spaces_in(normal_words(text_or_empty(docs[text_col]))) - 1
    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), n_words.alias("n_words"))
    same = rows["id"].eqNullSafe(found["id"]) & (rows["key"] == found["key"])
    return rows.join(sized(found), same, "left").select(
        rows["id"].alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """``docs`` without the rows in which a window occurs.

    Null and wordless texts have none and stay. Rows repeated with id and text go or stay alike; a row with the same id and
    another text is judged by its own. An empty table gives no rows; without items all rows stay."""
    found = materialize(find_windows(docs, items, width)[0].select(F.col("id").alias("_id"), F.col("key").alias("_key")).distinct(), "contaminated")
    rows = docs.select(packed(docs).alias("row"), F.col("doc_id").alias("id"), row_key("doc_id", "text").alias("key"))
    clean = rows.join(sized(found), rows["id"].eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left_anti")
    return clean.select(*unpacked(docs))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` against all of ``benchmark``, windows of ten words."""
    out = contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALL = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
QUERIES = {"op8_decontaminate": op8_decontaminate}
ORACLE = {
    "op8_decontaminate": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, {_ALL}) AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all({_LOWER}, {_ALL}) AS w FROM benchmark),
        win AS (SELECT item_id, w[s:s + 9] AS g, least(len(w), 10) AS n
                FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM b WHERE len(w) > 0)),
        lens AS (SELECT DISTINCT n FROM win),
        grams AS (SELECT r, n, s, w[s:s + n - 1] AS g
                  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, lens WHERE len(w) >= n)),
        hit AS (SELECT r, s, win.n, item_id FROM grams JOIN win ON grams.n = win.n AND grams.g = win.g),
        covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(s, s + n - 1)) AS p FROM hit) GROUP BY r),
        found AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS i FROM hit GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(i, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (r) LEFT JOIN found USING (r)"""
}

"""Language identification by Bayesian fusion of evidence.

The posterior of a document's language multiplies a smoothed prior of its host, the likelihood of its text, and the
likelihoods of its declared markup language and of its address suffix. Host priors are grouped counts of declared
languages, smoothed towards the host's domain, and the domain's towards all hosts; a row's own declaration, which is
evidence by itself, is left out of them. One more hypothesis, any other language or none, takes trigrams to be even over
all bins, and declared languages outside the set as its own."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_slices, load, materialize, packed, sized, text_bytes, unpacked

LANGUAGES = ("de", "en", "es", "fr")
#: Languages that an address suffix suggests.
SUFFIXES = {"de": "de", "at": "de", "uk": "en", "us": "en", "au": "en", "ie": "en", "es": "es", "mx": "es", "ar": "es", "co": "es", "cl": "es", "fr": "fr"}
#: Hash bins of byte trigrams, and labelled rows of each language, on average at most, that the text model learns from.
BINS, SAMPLE_ROWS = 1 << 15, 1000
#: Bytes of text that one step of a task works on.
SLICE_BYTES = 1 << 21
#: Pseudo-counts that a host's and a domain's counts are smoothed with.
HOST_STRENGTH = 20.0
#: Chance that a declared language is wrong, and that an address suffix misleads.
DECLARED_ERROR, SUFFIX_ERROR = 0.05, 0.3
#: Trigrams of one text aren't independent; their evidence levels off at that of so many.
EVIDENCE = 200.0
#: Prior of the hypothesis that a text is in none of the languages.
OTHER_PRIOR = 0.01
#: Below this posterior, or without any letter, or where none of the languages is likelier, the language is undetermined.
CONFIDENCE = 0.5


def _trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For all texts together: trigram bins of letters and gaps, and the text each one belongs to."""
    data, ends = text_bytes(texts)
    low = np.arange(256, dtype=np.uint32)
    low[65:91] += 32
    low[(low < 97) | ((low > 122) & (low < 128))] = 32
    c = low[data]
    if len(c) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(texts)), np.diff(ends))
    bins = ((c[:-2] * np.uint32(0x9E3779B1)) ^ (c[1:-1] * np.uint32(0x85EBCA6B)) ^ (c[2:] * np.uint32(0xC2B2AE35))) >> np.uint32(17)
    # A trigram is in one text and has at most one gap, so that runs of spaces and signs say nothing.
    good = (of[:-2] == of[2:]) & ((c[:-2] == 32).astype(np.int8) + (c[1:-1] == 32) + (c[2:] == 32) < 2)
    return bins[good].astype(np.int64), of[:-2][good]


def text_model(docs: DataFrame, languages: tuple[str, ...], sample_rows: int, text_col: str, declared_col: str) -> np.ndarray:
    """Log-probabilities of trigram bins for each language, learnt from whole texts of a sample of labelled rows.

    The sample is by a hash of the row, with about ``sample_rows`` rows of each language at most."""
    labelled = docs.where(F.col(declared_col).isin(*languages)).select(F.col(declared_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(*docs.columns).alias("hash"))
    rates = materialize(labelled.groupBy("lang").agg((F.lit(float(sample_rows)) / F.count(F.lit(1))).alias("rate")), "label_rates")
    share = F.pmod("hash", F.lit(1 << 20)) / float(1 << 20)
    sample = labelled.join(F.broadcast(rates), "lang").where(share < F.col("rate")).select("lang", "text")

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            which = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j in byte_slices(batch.column(1), SLICE_BYTES):
                bins, of = _trigrams(batch.column(1).slice(i, j - i))
                for lang in set(which[i:j]):
                    totals.setdefault(lang, np.zeros(BINS, np.int64))
                    totals[lang] += np.bincount(bins[(which[i:j] == lang)[of]], minlength=BINS)
        for lang, n in totals.items():
            at = np.nonzero(n)[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], names=["lang", "bin", "n"])

    counts = sample.mapInArrow(count, "lang string, bin bigint, n bigint").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    table = np.full((len(languages), BINS), 0.5)
    for r in counts.collect():  # at most languages times bins rows
        table[languages.index(r.lang), r.bin] += r.n
    return np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def host_counts(docs: DataFrame, languages: tuple[str, ...], host: Column, declared_col: str) -> DataFrame:
    """``host`` and the numbers of its rows, its domain's and all rows by declared language: arrays ``host_n``,
    ``domain_n`` and ``all_n`` in the order of ``languages``."""
    counts = [F.sum((F.col("declared") == x).cast("double")).alias(f"n_{x}") for x in languages]
    hosts = materialize(docs.select(host.alias("host"), F.col(declared_col).alias("declared")).where(F.col("declared").isin(*languages)).groupBy("host").agg(*counts), "hosts")
    hosts = hosts.withColumn("domain", _domain(F.col("host")))
    sums = [F.sum(f"n_{x}").alias(f"n_{x}") for x in languages]
    row = lambda: F.array(*[F.coalesce(f"n_{x}", F.lit(0.0)) for x in languages])
    domains = hosts.groupBy("domain").agg(*sums).select("domain", row().alias("domain_n"))
    everywhere = F.broadcast(hosts.agg(*sums).select(row().alias("all_n")))  # one row
    return hosts.join(domains, "domain").crossJoin(everywhere).select("host", row().alias("host_n"), "domain_n", "all_n")


def prior(own: Column, strength: float = HOST_STRENGTH) -> Column:
    """The host's prior from ``host_counts``, less the counts ``own``."""
    less = lambda n: F.zip_with(n, own, lambda a, b: a - b)
    even = F.transform(own, lambda x: F.lit(1.0) / F.size(own))
    size = F.size(own).cast("double")
    return _smoothed(less("host_n"), _smoothed(less("domain_n"), _smoothed(less("all_n"), even, size), strength), strength)


def host_priors(docs: DataFrame, languages: tuple[str, ...], host: Column, declared_col: str, strength: float = HOST_STRENGTH) -> DataFrame:
    """``host`` and ``prior``, an array of probabilities in the order of ``languages``."""
    none = F.array_repeat(F.lit(0.0), len(languages))
    return host_counts(docs, languages, host, declared_col).select("host", prior(none, strength).alias("prior"))


def _smoothed(counts: Column, prior: Column, strength: Column | float) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(counts, prior, lambda n, p: (n + p * strength) / (total + strength))


def _domain(host: Column) -> Column:
    labels = F.split(host, r"\.")
    return F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2))


def _identified(docs: DataFrame, host: Column, languages: tuple[str, ...], sample_rows: int, text_col: str, declared_col: str, labels: DataFrame | None) -> DataFrame:
    """``row``, the packed row, and ``found``, what ``identify`` adds."""
    own_labels, labels = labels is None, docs if labels is None else labels
    model = text_model(labels, languages, sample_rows, text_col, declared_col)
    counts = host_counts(labels, languages, F.lower(host), declared_col).withColumnRenamed("host", "_host")
    counts = sized(materialize(counts, "host_counts"))
    even = F.array_repeat(F.lit(1.0 / len(languages)), len(languages))

    def index(code: Column, other: int) -> Column:
        return reduce(lambda out, x: F.when(code == x[1], F.lit(x[0])).otherwise(out), enumerate(languages), F.when(code.isNull(), F.lit(-1)).otherwise(F.lit(other)))

    suffix = F.element_at(F.split(F.lower(host), r"\."), -1)
    suggested = F.create_map(*[F.lit(x) for kv in SUFFIXES.items() for x in kv])[suffix]
    n = len(languages)

    def likelihood(at: np.ndarray, error: float) -> np.ndarray:
        out = np.full((len(at), n + 1), np.log(error / n))
        out[np.arange(len(at))[at >= 0], at[at >= 0]] = np.log(1 - error)
        out[at < 0] = 0
        return out

    @F.arrow_udf("struct<language:string,confidence:double,text_language:string,text_score:double>")
    def fuse(text: pa.Array, prior: pa.Array, declared: pa.Array, suffixed: pa.Array) -> pa.Array:
        rows = len(text)
        each, count = np.zeros((rows, n)), np.zeros(rows, np.int64)
        for i, j in byte_slices(text, SLICE_BYTES):
            bins, of = _trigrams(text.slice(i, j - i))
            count[i:j] = np.bincount(of, minlength=j - i)
            for k in range(n):
                each[i:j, k] = np.bincount(of, model[k][bins], j - i)
        mean = each / np.maximum(count, 1)[:, None]
        evidence = mean * (count / (1 + count / EVIDENCE))[:, None]
        other = -np.log(BINS) * (count / (1 + count / EVIDENCE))
        chance = prior.flatten().to_numpy(zero_copy_only=False).reshape(rows, n) * (1 - OTHER_PRIOR)
        log = np.column_stack([evidence + np.log(chance), other + np.log(OTHER_PRIOR)])
        log += likelihood(declared.to_numpy(zero_copy_only=False), DECLARED_ERROR) + likelihood(suffixed.to_numpy(zero_copy_only=False), SUFFIX_ERROR)
        p = np.exp(log - log.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best, alone = p.argmax(axis=1), evidence.argmax(axis=1)
        sure = p.max(axis=1)
        und = (count == 0) | (sure < CONFIDENCE) | (best == n)
        names = np.array([*languages, "und"], object)
        return pa.StructArray.from_arrays(
            [pa.array(names[np.where(und, n, best)]), pa.array(sure), pa.array(names[np.where(count == 0, n, alone)]), pa.array(mean.max(axis=1))],
            names=["language", "confidence", "text_language", "text_score"],
        )

    rows = docs.select(packed(docs).alias("row"), F.col(text_col).alias("text"), F.lower(host).alias("host"), index(F.col(declared_col), n).alias("declared"), index(suggested, -1).alias("suffixed"))
    joined = rows.join(counts, rows["host"] == F.col("_host"), "left")
    own = F.array(*[((F.col("declared") == k) & F.lit(own_labels)).cast("double") for k in range(n)])
    prior_ = F.when(F.col("_host").isNull(), even).otherwise(prior(own))
    return joined.select("row", fuse(F.col("text"), prior_, F.col("declared"), F.col("suffixed")).alias("found"))


def identify(
    docs: DataFrame, host: Column, languages: tuple[str, ...] = LANGUAGES, sample_rows: int = SAMPLE_ROWS, text_col: str = "text", declared_col: str = "lang", labels: DataFrame | None = None
) -> DataFrame:
    """``docs`` with ``language`` ('und' where it can't be told), ``confidence`` (its posterior), ``text_language``
    (what the text alone says) and ``text_score`` (its mean log-likelihood).

    ``host`` is a name with or without dots; its last label is looked up as an address suffix. ``labels`` are rows
    that the text model and the host priors learn from (default: ``docs``, each row's prior without its own declaration),
    with their declared languages. Null declarations and null or unknown hosts and suffixes are no evidence; a declaration
    outside ``languages`` speaks for none of them. An unknown host has the prior of its absence, all languages alike.
    Null, empty and letterless texts are 'und', as are those in none of the languages; of equal posteriors the first in
    the order of ``languages`` wins. Repeated rows each give their row; an empty table
    gives no rows. Columns with the added names are replaced."""
    out = _identified(docs, host, languages, sample_rows, text_col, declared_col, labels)
    return out.select(*unpacked(docs, **{c: F.col("found")[c] for c in ("language", "confidence", "text_language", "text_score")}))


def identify_pages(pages: DataFrame, languages: tuple[str, ...] = LANGUAGES, sample_rows: int = SAMPLE_ROWS, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``host``, ``declared`` and what ``identify`` adds, for HTML pages: the URL gives the host and its suffix,
    ``<html lang>`` the declared markup language (its first part, so that en-GB is en), and what is left of the page
    without scripts, styles, comments and tags the text. Nulls give null evidence and 'und' without text."""
    html = F.col(html_col)
    host = F.lower(F.nullif(F.regexp_extract(url_col, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit("")))
    told = F.lower(F.nullif(F.regexp_extract(html, r"(?i)<html[^>]*?\slang\s*=\s*[\x22']?([A-Za-z]+)", 1), F.lit("")))
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;", " ")
    docs = pages.select("page_id", host.alias("host"), told.alias("declared"), text.alias("text"))
    out = identify(docs, F.col("host"), languages, sample_rows, "text", "declared")
    return out.drop("text")


def keep_identified(docs: DataFrame) -> DataFrame:
    """``documents`` whose language can be told; the others go. Null and empty texts go; repeated rows stay alike; an empty
    table stays empty."""
    out = _identified(docs, F.col("source"), LANGUAGES, SAMPLE_ROWS, "text", "lang", None)
    return out.where("found.language <> 'und'").select(*unpacked(docs))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``: ``lang`` is the declared language, ``source`` the host; they carry no address."""
    out = identify(load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), F.col("source"))
    return out.select("doc_id", F.col("lang").alias("declared"), "language", F.round("confidence", 6).alias("confidence"), "text_language", F.round("text_score", 6).alias("text_score"), (F.col("language") != "und").alias("kept"))


QUERIES = {"op7_language_id": op7_language_id}
ORACLE: dict[str, str] = {}

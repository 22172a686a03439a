"""Vectors and full text."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vector
from ..operators import fulltext
from ..operators.nearest import nearest
from .base import query, table


@query("""SELECT vec_id, len(embedding)::INT AS dim, round(list_distance(embedding::DOUBLE[], q), 5) AS euclid, round(list_cosine_distance(embedding::DOUBLE[], q), 5) AS cosine, round(list_inner_product(embedding::DOUBLE[], q), 5) AS dot
  FROM embeddings, (SELECT embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id = 0)""")
def vector_distances(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    one = F.broadcast(e.where("vec_id = 0").select(F.col("embedding").alias("q")))  # one row
    v, q = F.col("embedding"), F.col("q")
    return e.crossJoin(one).select("vec_id", vector.dim(v).alias("dim"), F.round(vector.euclidean(v, q), 5).alias("euclid"), F.round(vector.cosine(v, q), 5).alias("cosine"), F.round(vector.dot(v, q), 5).alias("dot"))


@query("""SELECT query_id, id, distance FROM (SELECT q.vec_id AS query_id, v.vec_id AS id, round(list_distance(v.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS distance FROM embeddings v, embeddings q WHERE q.vec_id % 100 = 0)
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, id) <= 10""")
def vector_nearest(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return nearest(e, e.where("vec_id % 100 = 0"), 10)


@query("SELECT c_custkey, 3 AS dim, 6.0::DOUBLE AS total, '[1.0,2.0,3.0]' AS text FROM customer")
def vector_text(spark, sf_dir):
    v = vector.from_string(F.lit("[1,2,3]"))
    return table(spark, sf_dir, "customer").select("c_custkey", vector.dim(v).alias("dim"), vector.dot(v, vector.literal([1, 1, 1])).alias("total"), vector.to_string(v).alias("text"))


_TERMS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), lambda t: t <> '')"


def _natural(where: str) -> str:
    return f"""WITH t AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents), tf AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN {where} GROUP BY ALL),
      idf AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 0.5)) AS idf FROM tf GROUP BY term)
      SELECT doc_id, round(sum(tf * idf), 6) AS relevance FROM tf JOIN idf USING (term) GROUP BY doc_id HAVING round(sum(tf * idf), 6) > 0"""


@query(_natural("('license', 'apache', 'released')"))
def fulltext_natural(spark, sf_dir):
    return fulltext.match(table(spark, sf_dir, "documents"), "doc_id", ["text"], "Apache license, released").select("doc_id", "relevance")


@query(f"""SELECT doc_id, list_contains(w, 'license')::INT + list_contains(w, 'released')::INT AS relevance FROM (SELECT doc_id, {_TERMS} AS w FROM documents) WHERE list_contains(w, 'license') AND NOT list_contains(w, 'apache')""")
def fulltext_boolean(spark, sf_dir):
    return fulltext.match(table(spark, sf_dir, "documents"), "doc_id", ["text"], "+license -apache released", fulltext.BOOLEAN).select("doc_id", "relevance")


@query(f"SELECT doc_id, 1 AS relevance FROM (SELECT doc_id, ' ' || array_to_string({_TERMS}, ' ') || ' ' AS w FROM documents) WHERE contains(w, ' under the mit license ')")
def fulltext_phrase(spark, sf_dir):
    return fulltext.match(table(spark, sf_dir, "documents"), "doc_id", ["text"], '+"under the MIT license"', fulltext.BOOLEAN).select("doc_id", "relevance")


@query()
def fulltext_expansion(spark, sf_dir):
    return fulltext.match(table(spark, sf_dir, "documents"), "doc_id", ["text"], "apache license", fulltext.EXPANSION).select("doc_id", "relevance")

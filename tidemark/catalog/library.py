"""Document change detection, chunking and retrieval over the test texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import Tables, query
from tidemark.operators import dims, retrieval, text_index, vector_index
from tidemark.plans.scratch import scratch_path


@query(
    "k01_changed_docs",
    """SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'new' ELSE 'updated' END AS change FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
       WHERE l.doc_id IS NULL OR l.quality = 0""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    known = F.when(F.col("quality") == 1, F.col("text")).otherwise(F.concat("text", F.lit(" (old)")))
    index = t.documents.join(t.labels, "doc_id").select("doc_id", F.sha2(known, 256).alias("content_hash"))
    return retrieval.changed_docs(t.documents, index, "doc_id", "text").select("doc_id", "change")


@query(
    "k02_sections",
    """SELECT doc_id AS document_id, i - 1 AS section_no, lang AS heading, i AS page_number, md5(lines[i]) AS body FROM
         (SELECT doc_id, lang, lines, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS lines FROM documents))""",
)
def _(spark, sf):
    lines = F.split("text", "\n")
    parts = F.transform(
        lines, lambda line, i: F.struct(F.col("lang").alias("heading"), line.alias("text"), (i + 1).alias("page_number"))
    )
    parsed = Tables(spark, sf).documents.select(
        F.col("doc_id").alias("document_id"), F.col("source").alias("title"),
        F.struct("lang", "n_chars").alias("metadata"), F.struct(parts.alias("sections")).alias("content"),
    )
    out = retrieval.sections(parsed)
    return out.select(
        "document_id", F.col("section_no").cast("long").alias("section_no"), "heading",
        F.col("page_number").cast("long").alias("page_number"), F.md5("text").alias("body"),
    )


_CHUNKS = """SELECT doc_id, no AS chunk_no, len(part) AS n_words, md5(array_to_string(part, ' ')) AS body, sha256(doc_id || ':' || no) AS chunk_id, lang FROM
  (SELECT doc_id, lang, no, w[no * 500 + 1 : no * 500 + 600] AS part FROM
    (SELECT doc_id, lang, w, unnest(range(0, greatest(1, CAST(ceil((len(w) - 600) / 500) AS BIGINT) + 1))) AS no FROM
      (SELECT doc_id, lang, list_filter(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM documents) WHERE len(w) > 0))"""


@query("k03_chunk", _CHUNKS)
def _(spark, sf):
    out = retrieval.chunk(Tables(spark, sf).spread("documents"), "doc_id", "text", keep=["lang"])
    return out.select(
        "doc_id", F.col("chunk_no").cast("long").alias("chunk_no"), F.col("n_words").cast("long").alias("n_words"),
        F.md5("chunk_text").alias("body"), "chunk_id", "lang",
    )


def _bm25_sql(docs: str, name: str) -> str:
    """BM25 of the benchmark texts over ``docs`` (id, text) as CTEs ending in ``name``."""
    return f"""{name}_d AS (SELECT id, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM ({docs})),
      {name}_s AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM {name}_d),
      {name}_t AS (SELECT id, len, term, count(*) AS tf FROM (SELECT id, len(w) AS len, unnest(w) AS term FROM {name}_d) GROUP BY ALL),
      {name}_f AS (SELECT term, count(*) AS df FROM {name}_t GROUP BY term),
      {name}_q AS (SELECT item_id AS query_id, unnest(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> ''))) AS term FROM benchmark),
      {name}_r AS (SELECT query_id, id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))), 9) AS score
        FROM {name}_q JOIN {name}_f USING (term) JOIN {name}_t USING (term), {name}_s GROUP BY 1, 2),
      {name} AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rnk FROM {name}_r QUALIFY rnk <= 10)"""


_ALL_DOCS = "SELECT doc_id AS id, text FROM documents"
_ENGLISH = "SELECT doc_id AS id, text FROM documents WHERE lang = 'en'"


def _asked(t):
    return t.benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


def _ranked(t, pool):
    return retrieval.bm25(pool, _asked(t), 10, "id", "text")


@query("k05_bm25", f"WITH {_bm25_sql(_ALL_DOCS, 'a')} SELECT query_id, id, round(score, 6) AS score, rnk FROM a")
def _(spark, sf):
    t = Tables(spark, sf)
    ranked = _ranked(t, t.spread("documents").select(F.col("doc_id").alias("id"), "text"))
    return ranked.withColumn("score", F.round("score", 6))


@query("k05_text_index", f"WITH {_bm25_sql(_ALL_DOCS, 'a')} SELECT query_id, id, round(score, 6) AS score, rnk FROM a")
def _(spark, sf):
    """Indexed in three batches; the later ones replace documents of the first."""
    t = Tables(spark, sf)
    docs = t.spread("documents").select(F.col("doc_id").alias("id"), "text")
    part = F.pmod("id", F.lit(3))
    root = scratch_path(spark, "text-index")
    old = F.when(part == 2, F.concat(F.reverse("text"), F.lit(" old"))).otherwise(F.col("text")).alias("text")
    text_index.add(docs.where(part != 1).select("id", old), root, 0, "id", "text", buckets=16)
    text_index.add(docs.where(part == 1), root, 1, "id", "text", buckets=16)
    text_index.add(docs.where(part == 2), root, 2, "id", "text", buckets=16)
    return text_index.search(spark, root, _asked(t), 10, "id", 16).withColumn("score", F.round("score", 6))


@query("k08_filtered_bm25", f"WITH {_bm25_sql(_ENGLISH, 'e')} SELECT query_id, id, round(score, 6) AS score, rnk FROM e")
def _(spark, sf):
    t = Tables(spark, sf)
    ranked = _ranked(t, t.spread("documents").filter("lang = 'en'").select(F.col("doc_id").alias("id"), "text"))
    return ranked.withColumn("score", F.round("score", 6))


@query(
    "k07_fuse",
    f"""WITH {_bm25_sql(_ALL_DOCS, 'a')}, {_bm25_sql(_ENGLISH, 'e')},
       v AS (SELECT query_id, id, 1.0 / (60 + rnk) AS vote FROM a UNION ALL SELECT query_id, id, 1.0 / (60 + rnk) FROM e),
       f AS (SELECT query_id, id, round(sum(CAST(vote AS DOUBLE)), 9) AS score FROM v GROUP BY 1, 2)
       SELECT query_id, id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY f.score DESC, id) AS rnk FROM f QUALIFY rnk <= 10""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    docs = t.spread("documents").select(F.col("doc_id").alias("id"), "text", "lang")
    fused = retrieval.fuse(_ranked(t, docs), _ranked(t, docs.filter("lang = 'en'")), id="id")
    return fused.withColumn("score", F.round("score", 6))


def _centres(t):
    """Mean vector per label as query vectors."""
    cells = t.embeddings.select("label", F.posexplode("embedding").alias("i", "x"))
    means = cells.groupBy("label", "i").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
    # A vector has a fixed number of components, so the list is bounded.
    whole = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v"))
    return whole.select(F.col("label").cast("long").alias("query_id"), F.col("v")["x"].alias("embedding"))


_CENTRES = """c AS (SELECT label AS query_id, list(x ORDER BY i) AS q FROM (SELECT label, i, round(avg(CAST(embedding[i] AS DOUBLE)), 6) AS x
  FROM (SELECT label, embedding, unnest(range(1, 65)) AS i FROM embeddings) GROUP BY 1, 2) GROUP BY label)"""


_KNN = f"""WITH {_CENTRES}, s AS (SELECT query_id, vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), q), 6) AS score FROM embeddings, c)
       SELECT CAST(query_id AS BIGINT) AS query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rnk FROM s QUALIFY rnk <= 10"""


@query("k06_knn", _KNN)
def _(spark, sf):
    t = Tables(spark, sf)
    return retrieval.knn(t.embeddings, _centres(t), 10)


@query("k06_vector_index", _KNN)
def _(spark, sf):
    """Half of the vectors filed later; all lists probed, so that the answer is exact."""
    t = Tables(spark, sf)
    root = scratch_path(spark, "vector-index")
    vectors = t.embeddings.select("vec_id", "embedding")
    vector_index.build(vectors.where("vec_id % 2 = 0"), root)
    vector_index.add(vectors.where("vec_id % 2 <> 0"), root)
    return vector_index.search(spark, root, _centres(t), 10, probes=vector_index.MAX_LISTS)


@query(
    "k07_hybrid_search",
    f"""WITH {_CENTRES}, m AS (SELECT count(*) AS n FROM c),
       asked AS (SELECT item_id AS query_id, q FROM benchmark, m JOIN c ON c.query_id = item_id % n),
       {_bm25_sql("SELECT doc_id AS id, text FROM documents WHERE n_chars > 200", 'a')},
       s AS (SELECT query_id, vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), q), 6) AS score FROM embeddings JOIN documents ON doc_id = vec_id, asked
         WHERE n_chars > 200),
       n AS (SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rnk FROM s QUALIFY rnk <= 10),
       v AS (SELECT query_id, id AS vec_id, 1.0 / (60 + rnk) AS vote FROM a UNION ALL
         SELECT query_id, vec_id, 1.0 / (60 + rnk) FROM n),
       f AS (SELECT query_id, vec_id, round(sum(CAST(vote AS DOUBLE)), 9) AS score FROM v GROUP BY 1, 2)
       SELECT query_id, vec_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY f.score DESC, vec_id) AS rnk FROM f QUALIFY rnk <= 10""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    vectors = t.embeddings.select("vec_id", "embedding")
    # Documents without a vector stay on the keyword side.
    chunks = t.documents.select(F.col("doc_id").alias("vec_id"), "text", "n_chars").join(vectors, "vec_id", "left")
    # Every question gets the mean vector of a label, in turn.
    centres = _centres(t)
    labels = centres.count()
    asked = _asked(t).withColumn("_label", F.col("query_id") % labels)
    asked = asked.join(centres.withColumnRenamed("query_id", "_label"), "_label").drop("_label")
    found = retrieval.search(asked, chunks, F.col("n_chars") > 200, 10, "vec_id", "text")
    return found.withColumn("score", F.round("score", 6))


@query(
    "k09_run_report",
    f"""WITH c AS ({_CHUNKS}), f AS (SELECT source, count(*) AS fetched FROM documents GROUP BY source),
       s AS (SELECT source, count(*) AS stored FROM documents WHERE n_chars >= 100 GROUP BY source),
       k AS (SELECT source, count(*) AS made, count(*) FILTER (n_words >= 50) AS indexed, count(DISTINCT doc_id) FILTER (n_words >= 50) AS papers
         FROM c JOIN documents USING (doc_id) GROUP BY source),
       r AS (SELECT *, CASE WHEN coalesce(papers, 0) = fetched THEN 0 WHEN coalesce(stored, 0) = fetched THEN 0 ELSE 1 END AS bad FROM f LEFT JOIN s USING (source) LEFT JOIN k USING (source))
       SELECT length(source) AS target_date, count(*) AS runs, CAST(sum(bad) AS BIGINT) AS failed_runs, CAST(sum(fetched) AS BIGINT) AS papers_fetched, CAST(sum(coalesce(stored, 0)) AS BIGINT) AS papers_stored,
         CAST(sum(coalesce(papers, 0)) AS BIGINT) AS papers_indexed, CAST(sum(coalesce(made, 0)) AS BIGINT) AS chunks_created, CAST(sum(coalesce(indexed, 0)) AS BIGINT) AS chunks_indexed FROM r GROUP BY 1""",
)
def _(spark, sf):
    docs = Tables(spark, sf).spread("documents")
    chunks = retrieval.chunk(docs, "doc_id", "text", keep=["source"])
    runs = retrieval.run_counters(
        docs, docs.filter("n_chars >= 100"), chunks, chunks.filter("n_words >= 50"), "source", "doc_id"
    )
    return retrieval.run_report(runs.withColumn("target_date", F.length("source").cast("long")))


@query(
    "k10_document_upsert",
    """SELECT doc_id, CASE WHEN quality = 0 THEN md5(text || ' v2') ELSE md5(text) END AS h FROM documents LEFT JOIN labels USING (doc_id)""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    stored = t.documents.select("doc_id", F.md5("text").alias("h"))
    redone = t.documents.join(t.labels.filter("quality = 0").select("doc_id"), "doc_id", "left_semi")
    return dims.upsert(stored, redone.select("doc_id", F.md5(F.concat("text", F.lit(" v2"))).alias("h")), ["doc_id"])

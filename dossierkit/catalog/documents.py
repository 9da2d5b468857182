"""Articles, chunks and retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierkit.catalog.common import squeeze, table
from dossierkit.catalog.extraction import NOISE, decoded, paragraphs_sql
from dossierkit.functions import html as H
from dossierkit.functions.text import WHITESPACE
from dossierkit.operators import retrieve, vector_index
from dossierkit.plans import articles as flow
from dossierkit.plans.answers import answers as answer_questions
from dossierkit.sources.landed import read_articles
from dossierkit.sources.sinks import read_csv, shared_folder, write_csv, write_json


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article records with whole documents as full text; some fields are missing."""
    return table(spark, sf_dir, "documents", "doc_id").select(
        F.col("lang").alias("Section"),
        F.expr("case when doc_id % 7 <> 0 then 'Document ' || cast(doc_id as string) end").alias("Title"),
        F.expr("'/d/' || cast(doc_id as string)").alias("Link"),
        F.expr("case when doc_id % 5 <> 0 then array(source, 'Desk ' || lang) end").alias("Author(s)"),
        F.expr("case when doc_id % 3 = 0 then 'Jan ' || cast(1 + doc_id % 28 as string) end").alias("Date Posted"),
        F.lit("").alias("Date Updated"),
        F.expr("'  \"quoted\", and; split' || chr(10) || source || chr(9)").alias("Updates"),
        F.col("text").alias("Full Article"),
    )


_FIELDS = {
    "Section": "coalesce(lang, '')",
    "Title": "case when doc_id % 7 <> 0 then 'Document ' || cast(doc_id as varchar) else '' end",
    "Link": "'/d/' || cast(doc_id as varchar)",
    "Author(s)": "case when doc_id % 5 <> 0 then source || '{}Desk ' || lang else '' end",
    "Date Posted": "case when doc_id % 3 = 0 then 'Jan ' || cast(1 + doc_id % 28 as varchar) else '' end",
    "Date Updated": "''",
    "Updates": "'  \"quoted\", and; split' || chr(10) || source || chr(9)",
    "Full Article": "text",
}


def _fields_sql(form: str = "{}") -> str:
    columns = {name: form.format(sql.format("; ")) for name, sql in _FIELDS.items()}
    return ", ".join(f'{sql} as "{name}"' for name, sql in columns.items())


_DOCUMENT = f"""'TITLE: ' || {_FIELDS["Title"]} || chr(10) || 'LINK: ' || {_FIELDS["Link"]} || chr(10)
    || 'DATE_POSTED: ' || {_FIELDS["Date Posted"]} || chr(10) || 'DATE_UPDATED: ' || chr(10)
    || 'AUTHORS: ' || {_FIELDS["Author(s)"].format(",")} || chr(10) || 'SECTION: ' || {_FIELDS["Section"]} || chr(10)
    || 'UPDATES: ' || {_FIELDS["Updates"]} || chr(10) || chr(10) || text"""


def compose_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select(F.col("Link").alias("link"), retrieve.compose_document().alias("document"))


def chunk_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id").select("doc_id", "text")
    return retrieve.chunk_text(documents, "text")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A card per page, and the text of the page it links to; some links lead nowhere."""
    pages = table(spark, sf_dir, "pages", "page_id")
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    card = F.concat(
        F.lit('<div class="card-post"><a class="card-post-title-link" href="'),
        F.expr("case when page_id % 6 = 0 then '/gone/' || cast(page_id as string) else url end"),
        F.lit('"></a><h3 class="card-post-title">'), title, F.lit("</h3></div>"),
    )
    listing = pages.select("page_id", card.alias("html"))
    details = pages.select("url", F.col("page_id").alias("ordinal"), "html")
    found = flow.articles(listing, details)
    return found.select(
        "page_id", F.col("Title").alias("title"), F.col("Link").alias("link"), F.col("Full Article").alias("text")
    )


def article_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow.article_chunks(records(spark, sf_dir))


def _topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question vector per label: the mean of its vectors."""
    rows = table(spark, sf_dir, "embeddings")
    values = rows.select("label", F.posexplode("embedding").alias("pos", "x"))
    means = values.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("mean"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "mean")))
    return means.groupBy(F.col("label").cast("bigint").alias("label")).agg(
        F.transform(ordered, lambda v: v["mean"]).alias("question")
    )


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.knn(
        table(spark, sf_dir, "embeddings"),
        _topics(spark, sf_dir),
        corpus_id="vec_id",
        corpus_vector="embedding",
        query_id="label",
        query_vector="question",
    )


def knn_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits(spark, sf_dir).select(
        "label", F.col("rank").cast("bigint").alias("rank"), "vec_id", F.round("distance", 4).alias("distance")
    )


# One vector in five is damaged, each in one of five ways.
_DAMAGED = """
    case vec_id % 25 when 0 then slice(embedding, 1, 63) when 5 then concat(embedding, array(cast(0 as float)))
    when 10 then transform(embedding, (x, i) -> if(i = 3, cast('NaN' as float), x))
    when 15 then transform(embedding, (x, i) -> if(i = 3, null, x)) when 20 then cast(null as array<float>) else embedding end
"""


def knn_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest of the usable vectors; more than four questions stay a table."""
    corpus = table(spark, sf_dir, "embeddings").select("vec_id", F.expr(_DAMAGED).alias("vector"))
    found = retrieve.knn(
        corpus, _topics(spark, sf_dir), corpus_id="vec_id", corpus_vector="vector", query_id="label", query_vector="question", query_limit=4
    )
    return found.select("label", F.col("rank").cast("bigint").alias("rank"), "vec_id", F.round("distance", 4).alias("distance"))


def knn_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same nearest vectors out of an index that is written first."""
    path = shared_folder(spark, "index")
    index = vector_index.build(table(spark, sf_dir, "embeddings"), path, corpus_id="vec_id", corpus_vector="embedding")
    found = vector_index.search(index, _topics(spark, sf_dir), query_id="label", query_vector="question")
    return found.select("label", F.col("rank").cast("bigint").alias("rank"), "vec_id", F.round("distance", 4).alias("distance"))


def knn_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three nearest vectors of every vector, itself first: as many questions as there are rows."""
    vectors = table(spark, sf_dir, "embeddings")
    index = vector_index.build(vectors, shared_folder(spark, "index"), corpus_id="vec_id", corpus_vector="embedding")
    questions = vectors.select(F.col("vec_id").alias("of"), "embedding")
    found = vector_index.search(index, questions, query_id="of", query_vector="embedding")
    return found.select("of", F.col("rank").cast("bigint").alias("rank"), "vec_id", F.round("distance", 4).alias("distance"))


def vector_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of the damaged vectors a search leaves out."""
    corpus = table(spark, sf_dir, "embeddings").select("vec_id", F.expr(_DAMAGED).alias("vector"))
    return retrieve.unusable_vectors(corpus, "vector", 64)


def assemble_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contexts of the hits."""
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    return retrieve.assemble_context(
        hits(spark, sf_dir), documents, query_id="label", corpus_id="vec_id", text="text"
    )


def list_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.expr(H.joined_text("regexp_extract(html, '<title>([^<]*)</title>', 1)"))
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("vec_id"), title.alias("name"), "url")
    found = retrieve.list_sources(
        hits(spark, sf_dir), pages, query_id="label", corpus_id="vec_id", title="name", link="url"
    )
    return found.withColumn("idx", F.col("idx").cast("bigint"))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context and sources per topic, with documents as chunks; a vector without a document is a chunk without a text."""
    documents = table(spark, sf_dir, "documents")
    chunks = (
        table(spark, sf_dir, "embeddings")
        .join(documents, F.col("vec_id") == F.col("doc_id"), "left")
        .select(
            F.col("vec_id").alias("chunk_id"),
            F.expr("'/d/' || cast(doc_id as string)").alias("link"),
            F.expr("case when doc_id % 2 = 0 then 'Document ' || cast(doc_id as string) end").alias("title"),
            F.col("text").alias("chunk"),
            F.col("embedding").alias("vector"),
        )
    )
    questions = _topics(spark, sf_dir).select(F.col("label").alias("question_id"), F.col("question").alias("vector"))
    found = answer_questions(chunks, questions)
    return found.select(
        "question_id", "context", F.inline("sources")
    ).select("question_id", "context", F.col("idx").cast("bigint").alias("idx"), "title", "url")


def articles_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as JSON and read back; missing fields are filled."""
    path = shared_folder(spark, "articles")
    write_json(records(spark, sf_dir), path)
    back = read_articles(spark, path)
    return back.withColumn("Author(s)", F.array_join("Author(s)", "; "))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as CSV and read back; null and '' are both empty."""
    path = shared_folder(spark, "articles-csv")
    write_csv(records(spark, sf_dir), path, flow.CSV_COLUMNS)
    return read_csv(spark, path, ", ".join(f"`{c}` string" for c in flow.CSV_COLUMNS))


QUERIES = {
    "articles": articles,
    "compose_document": compose_document,
    "chunk_text": chunk_text,
    "article_chunks": article_chunks,
    "knn_top3": knn_top3,
    "knn_damaged": knn_damaged,
    "vector_report": vector_report,
    "knn_pruned": knn_pruned,
    "knn_all": knn_all,
    "assemble_context": assemble_context,
    "list_sources": list_sources,
    "answers": answers,
    "articles_roundtrip": articles_roundtrip,
    "csv_roundtrip": csv_roundtrip,
}



def chunk_sql(source: str, size: int = 1000, overlap: int = 100) -> str:
    """Chunks of ``source(id, text)`` as a CTE ``chunks(id, chunk_no, chunk)``.

    Level by level, long pieces are cut at the next separator; neighbouring short pieces are a run.
    The recursion then goes chunk by chunk through all runs at once: a chunk ends before the first
    piece that does not fit, and the next starts where the overlap and that piece fit.
    """
    ctes = [f"texts as ({source})", "long0 as (select id, 0 as start, text as piece from texts)"]
    for level, sep in enumerate(("chr(10) || chr(10)", "chr(10)", "' '", "''")):
        ctes.append(f"""cut{level} as (
            select id, start as segment, i, case when i = 1 then part else {sep} || part end as piece from (
                select id, start, unnest(string_split(piece, {sep})) as part,
                    generate_subscripts(string_split(piece, {sep}), 1) as i from long{level}))""")
        ctes.append(f"""placed{level} as (
            select *, segment + sum(length(piece)) over w - length(piece) as start,
                sum(case when length(piece) >= {size} then 1 else 0 end) over w as run
            from cut{level} where piece <> '' window w as (partition by id, segment order by i))""")
        ctes.append(f"long{level + 1} as (select id, start, piece from placed{level} where length(piece) >= {size})")
    ctes.append(
        "runs as ("
        + " union all ".join(
            f"select id, list(start order by i) as starts, list(start + length(piece) order by i) as stops "
            f"from placed{level} where length(piece) < {size} group by id, segment, run"
            for level in range(4)
        )
        + ")"
    )
    ctes.append(f"""steps as (
        select id, starts, stops, 1 as front, 1 as i, cast(null as bigint) as a, cast(null as bigint) as b from runs
        union all
        select id, starts, stops, front + len(list_filter(starts[front:j - 1],
                lambda s: starts[j] - s > {overlap} or stops[j] - s > {size})), j,
            starts[front], case when j > len(stops) then stops[-1] else starts[j] end
        from (
            select *, i + 1 + len(list_filter(stops[i + 1:], lambda s: s - starts[front] <= {size})) as j
            from steps where i <= len(stops)))""")
    ctes.append(f"""chunks as (
        select id, cast(row_number() over (partition by id order by a) - 1 as integer) as chunk_no, chunk from (
            select id, a, trim(substr(text, a + 1, b - a), '{WHITESPACE}') as chunk
            from steps join texts using (id) where b is not null)
        where chunk <> '')""")
    return "with recursive " + ", ".join(ctes) + " "


_HITS = """
    with coords as (
        select label, cast(unnest(embedding) as double) as x, generate_subscripts(embedding, 1) as pos from embeddings
    ), means as (select label, pos, avg(x) as mean from coords group by label, pos),
    topics as (select cast(label as bigint) as label, list(mean order by pos) as question from means group by label),
    scored as (
        select topics.label, vec_id, list_distance(question, cast(embedding as double[])) ** 2 as distance
        from topics, embeddings
    ), hits as (
        select * from (
            select *, row_number() over (partition by label order by distance, vec_id) as rank from scored)
        where rank <= 3
    )
"""

ORACLE = {
    "articles": f"""
        with clean as (select *, regexp_replace(html, '{NOISE}', '<!>', 'g') as body from pages)
        select page_id, {squeeze(decoded("regexp_extract(html, '<title>([^<]*)</title>', 1)"))} as title,
            case when page_id % 6 = 0 then '/gone/' || cast(page_id as varchar) else url end as link,
            case when page_id % 6 = 0 then '' else {paragraphs_sql("body")} end as text
        from clean
    """,
    "compose_document": f'select {_FIELDS["Link"]} as link, {_DOCUMENT} as document from documents',
    "chunk_text": chunk_sql("select doc_id as id, text from documents")
    + "select id as doc_id, chunk_no, chunk from chunks",
    "article_chunks": chunk_sql(f"select doc_id as id, {_DOCUMENT} as text from documents")
    + f"""select {_FIELDS["Link"]} as link, {_FIELDS["Title"]} as title, chunk_no, chunk
        from chunks join documents on id = doc_id""",
    "knn_top3": _HITS + "select label, rank, vec_id, round(distance, 4) as distance from hits",
    "knn_pruned": _HITS + "select label, rank, vec_id, round(distance, 4) as distance from hits",
    "knn_all": """
        select of, rank, vec_id, round(distance, 4) as distance from (
            select *, row_number() over (partition by of order by distance, vec_id) as rank from (
                select q.vec_id as of, e.vec_id, list_distance(cast(q.embedding as double[]), cast(e.embedding as double[])) ** 2 as distance
                from embeddings q, embeddings e))
        where rank <= 3""",
    "assemble_context": _HITS
    + """select label, string_agg(coalesce(text, ''), chr(10) || chr(10) order by rank) as context
        from hits left join documents on vec_id = doc_id group by label""",
    "list_sources": _HITS
    + f"""select label, rank as idx, coalesce(
            {squeeze(decoded("regexp_extract(html, '<title>([^<]*)</title>', 1)"))}, 'No title found') as title,
            coalesce(url, 'No link found') as url
        from hits left join pages on vec_id = page_id""",
    "answers": _HITS
    + """, found as (select label, rank, doc_id, coalesce(text, '') as text from hits left join documents on vec_id = doc_id),
        contexts as (
            select label, string_agg(text, chr(10) || chr(10) order by rank) as context from found group by label)
        select label as question_id, context, rank as idx,
            case when doc_id % 2 = 0 then 'Document ' || cast(doc_id as varchar) else 'No title found' end as title,
            coalesce('/d/' || cast(doc_id as varchar), 'No link found') as url
        from found join contexts using (label)""",
    "knn_damaged": _HITS.replace("from topics, embeddings", "from topics, embeddings where vec_id % 5 <> 0")
    + "select label, rank, vec_id, round(distance, 4) as distance from hits",
    "vector_report": "select count(*) as n, count(*) filter (where vec_id % 5 = 0) as unusable from embeddings",
    "articles_roundtrip": f"select {_fields_sql()} from documents",
    "csv_roundtrip": f"select {_fields_sql("nullif({}, '')")} from documents",
}

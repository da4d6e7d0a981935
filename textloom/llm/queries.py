"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import bpe, exact_dedup, near_dedup, packing, quality, search, token_counts, token_io, toxicity, url_filter
from textloom.storage import work_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def newer_half() -> Column:
    """The crawl that is deduplicated against the rest: sources numbered 10 and up."""
    return F.expr("coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) as int) >= 10, false)")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and whether decoding them gives the text back."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.bpe_decode(bpe.bpe_encode(docs))
    return out.selectExpr("doc_id", "token_ids", "size(token_ids) as n_tokens", "decoded <=> text as round_trip")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with the entry of the blocklist that covers its URL.

    The blocklist is the column ``entry`` (hosts, host/path prefixes, URLs) of a table url_entries if
    there is one, else the six hosts of ``url_filter.BLOCKED_HOSTS``, which are those the SQL knows.
    """
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/url_entries.parquet")
    if where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where):
        matched = url_filter.match_urls(pages, url_filter.build(_table(spark, sf_dir, "url_entries"), work_path(spark, "urls")))
    else:
        matched = url_filter.block_hosts(spark, pages)
    return matched.select("page_id", "url", F.col("matched").isNotNull().alias("blocked"), "matched")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability of being toxic, and the verdict."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.score_toxicity(docs, _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "toxicity", F.coalesce(F.col("toxicity") >= 0.5, F.lit(False)).alias("toxic"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that has near duplicates, with the one of its group that stays."""
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability of low quality, and the verdict."""
    out = quality.score_quality(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "p_low", F.coalesce(F.col("p_low") < 0.5, F.lit(False)).alias("keep"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the equal one that stays."""
    return exact_dedup.mark_duplicates(_table(spark, sf_dir, "documents"), newer_half())


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return search.top_k(_table(spark, sf_dir, "benchmark"), _table(spark, sf_dir, "documents"))


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue of the seekable files written for all documents."""
    return token_io.write_tokens(_table(spark, sf_dir, "documents"), work_path(spark, "tokens"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of BPE tokens of every document."""
    return token_counts.token_counts(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens in packs of 2,048 along the curve."""
    return packing.pack(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (op1_bpe, op2_url_filter, op3_toxicity, op4_near_dedup, op5_quality, op6_exact_dedup, op7_topk_search, op8_token_output, op9_token_counts, op10_packing)
}

_HOSTS = ", ".join(f"'{h}'" for h in url_filter.BLOCKED_HOSTS)
SQL: dict[str, str] = {
    "op2_url_filter": f"""
        with hosts as (
            select page_id, url, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^:/?#]*)', 1)) as host from pages
        ), hit as (
            select page_id, url, (select max(e) from unnest([{_HOSTS}]) as u(e) where host = e or ends_with(host, '.' || e)) as matched from hosts
        )
        select page_id, url, matched is not null as blocked, matched from hit""",
    "op6_exact_dedup": """
        select doc_id, case when text is null then doc_id else first_value(doc_id) over w end as kept_id,
               text is not null and row_number() over w > 1 as is_duplicate
        from (select *, coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) as int) >= 10, false) as incoming from documents)
        window w as (partition by text order by incoming, doc_id nulls last)""",
    "op7_topk_search": """
        with tok as (
            select doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') as ws from documents where text is not null
        ), corpus as (select count(*) as n, sum(len(ws)) / count(*) as mean_len from tok
        ), q as (
            select item_id, w, count(*) as times from (select item_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) as w from benchmark) group by all
        ), tf as (
            select doc_id, any_value(n) as n, w, count(*) as tf from (select doc_id, len(ws) as n, unnest(ws) as w from tok) where w in (select w from q) group by doc_id, w
        ), df as (select w, count(*) as df from tf group by w
        ), s as (
            select item_id, doc_id, round(sum(times * ln(1 + (corpus.n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * tf.n / mean_len))), 4) as score
            from q join tf using (w) join df using (w), corpus group by item_id, doc_id
        )
        select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score from s
        qualify row_number() over (partition by item_id order by score desc, doc_id) <= 10""",
}

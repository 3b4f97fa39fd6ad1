"""The registered queries of this subpackage, with production parameters, and the SQL giving the same rows where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import byte_bpe, decontaminate, html_density, jaccard, line_rules, mixing, neighbours, secrets, spelling, toxicity, urls, warc, whitening

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_warc_salvage")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages")).where(F.col("gap").isNull())
    page = lambda column: F.regexp_extract(column, "^urn:page:(-?[0-9]+)$", 1).try_cast("bigint")
    return records.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"),
        F.col("uri").alias("url"))


@query("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.encode_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
        with_ids=False)
    return coded.drop("ids")


@query("op6_line_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_rules.clean_lines(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_removed_lines", F.length("clean_text").cast("bigint").alias("clean_chars"))


@query("op7_text_density")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_density.extract_main_text(table(spark, sf_dir, "pages"))


#: The rules the query applies: host, path, verdict.
URL_RULES = tuple(urls.Rule(*r) for r in (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
    ("block", "com", "/de/")))


def _url_sql() -> str:
    """SQL for the URL query: rules longest first, terms as bounded patterns."""
    fits = [
        (r, f"(host = '{r.host}' or host like '%.{r.host}') and starts_with(path, '{r.path}')")
        for r in sorted(URL_RULES, key=lambda r: -len(r.name))]
    low = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    hit = lambda term: f"regexp_matches(low, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')"
    return f"""
with addresses as (
  select page_id, url, {low} as low,
         translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path
  from pages),
judged as (
  select *, case {' '.join(f"when {fit} then '{r.name}'" for r, fit in fits)} end as rule,
         {' + '.join(f"({hit(t)})::int" for t in sorted(set(urls.SOFT_TERMS) - set(urls.STRICT_TERMS)))} as soft_hits,
         {' or '.join(hit(t) for t in urls.STRICT_TERMS)} as strict_hit
  from addresses)
select page_id, host, path, rule,
       case {' '.join(f"when rule = '{r.name}' then '{r.verdict}'" for r, _ in fits)}
            when strict_hit or soft_hits >= 2 then 'block' else 'allow' end as verdict,
       soft_hits::bigint as soft_hits
from judged"""


@query("op10_url_vocabulary", _url_sql())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge_urls(table(spark, sf_dir, "pages"), rules=URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "soft_hits")


@query("op3_toxicity_machine")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query("op4_quality_neighbours")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return neighbours.score_quality(docs, neighbours.train(docs, table(spark, sf_dir, "labels")))


@query("op5_jaccard_rtree")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(table(spark, sf_dir, "documents"))


@query("op8_secret_forest")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "word_no", "token_no", F.length("token").cast("bigint").alias("n_chars"), F.sha2("token", 256).alias("token_sha256"),
        "probability", "is_secret")


@query("op9_simhash_windows")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


#: The same mix by windows over whole sources: words as in the contract, targets by resharing 60 times, budgets by running sums.
_MIX_SQL = r"""
with recursive texts as (
  select doc_id, source, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
         md5('mix:' || coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')) as digest
  from documents),
measured as (
  select doc_id, source, len(words)::bigint as size,
         -ln((cast('0x' || substr(digest, 1, 13) as bigint) + 0.5::double) / 4503599627370496.0::double)
         / case when len(words) = 0 then 0.05::double else
             greatest(0.05::double, length(translate(text, '0123456789#*$%&|<>{}[]_=+/\^~`@', '')) / length(text)
                      * (ln(len(list_distinct(words)) + 1.0::double) / ln(len(words) + 1.0::double))) end as turn,
         cast('0x' || substr(digest, 14, 15) as bigint) as tie
  from texts),
sources as (
  select source, sum(size)::bigint as source_size,
         (row_number() over (order by source collate "C" nulls last) - 1) % 3 + 1 as share
  from measured group by source),
rates as (
  select 0 as step, (select sum(source_size) / sum(share) from sources)::double as rate
  union all
  select step + 1,
         (((select sum(source_size) from sources) - sum(case when rate * share > 3 * source_size then 3 * source_size else 0 end))
          / sum(case when rate * share > 3 * source_size then 0 else share end))::double
  from rates, sources where step < 60 group by step, rate),
targets as (
  select source, source_size, least(rate * share, (3 * source_size)::double) as target
  from sources, rates where step = 60),
planned as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as epochs from targets),
placed as (
  select m.*, p.source_size, p.target, p.epochs,
         coalesce(sum(size) over (partition by m.source order by turn, tie rows between unbounded preceding and 1 preceding), 0) as before
  from measured m join planned p on m.source is not distinct from p.source)
select doc_id, source, size, source_size, target, epochs,
       (epochs * size + greatest(0, least(size, floor(target - epochs * source_size + 0.5) - before)))::bigint as taken
from placed"""


@query("op11_exponential_mix", _MIX_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op12_bloom_variants")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.count_words(table(spark, sf_dir, "documents"), thinned=199))


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))

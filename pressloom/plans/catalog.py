"""One query per operator over the given tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.constants import DEFAULT_CATEGORY
from pressloom.functions.text import normalize_url, parse_instant, published_label, strip_fence
from pressloom.issue import Issue
from pressloom.lineage import shared_dir
from pressloom.operators import dedup, enrich, ordering, quality, report, search, title_candidates, titles
from pressloom.plans import tables as src
from pressloom.plans.digest import Collected, Settings, collect, publish
from pressloom.sources import archive, responses, states, zones

AS_OF = Issue(datetime(2024, 1, 10, 22, 0))
BASE_URL, TITLE = "https://news.example.com/digest//", "Weekly digest"

_ARTICLE = ("seq", "title", "description", "url", "source", "lang", "published_at")


def _day(df: DataFrame, column: str = "issue_date") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("string"))


def src_responses(spark: SparkSession, sf: str) -> DataFrame:
    rows = responses.raw_articles(responses.parse_responses(src.response_bodies(spark, sf)))
    return rows.drop("unreadable").withColumn("group_idx", F.col("group_idx").cast("bigint"))


def rejected_responses(spark: SparkSession, sf: str) -> DataFrame:
    rows = responses.rejected_responses(responses.parse_responses(src.response_bodies(spark, sf)))
    return rows.select(F.col("group_idx").cast("bigint").alias("group_idx"), "status", "code", "unreadable")


def landed_responses(spark: SparkSession, sf: str) -> DataFrame:
    """The responses as landed files, some of whose article lists are damaged, read back."""
    path = f"{shared_dir(spark)}/landed-{uuid.uuid4().hex}"
    body = F.when(F.col("body").contains('"group_idx":3,'), F.regexp_replace("body", '"articles":\\[.*\\]', '"articles":"oops"'))
    src.response_bodies(spark, sf).select(F.coalesce(body, F.col("body"))).write.text(path)
    read = responses.read_responses(spark, path)
    taken = responses.raw_articles(read).groupBy("group_idx").agg(F.count("*").alias("records"))
    rejected = responses.rejected_responses(read).select("group_idx", "status", "unreadable")
    both = rejected.join(taken, "group_idx", "full")
    return both.select(F.col("group_idx").cast("bigint").alias("group_idx"), "status", "unreadable", "records")


def failed_requests(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.failed_requests(src.attempts(spark, sf)).select("seq")


def project_articles(spark: SparkSession, sf: str) -> DataFrame:
    raw = quality.valid_articles(src.raw_articles(spark, sf))
    return responses.project_articles(raw.drop("event_type"))


def src_archive(spark: SparkSession, sf: str) -> DataFrame:
    """Stores all issues as files in the shared folder and reads them back."""
    path = f"{shared_dir(spark)}/archive-{uuid.uuid4().hex}"
    stored = src.issues(spark, sf).withColumn("image_url", F.lit(None).cast("string"))
    archive.write_archive(stored, path)
    return _day(archive.read_archive(spark, path))


def src_issue_files(spark: SparkSession, sf: str) -> DataFrame:
    """Stores every issue as one JSON array file and reads the files back."""
    path = f"{shared_dir(spark)}/issues-{uuid.uuid4().hex}"
    archive.write_issue_files(src.issues(spark, sf).withColumn("image_url", F.lit(None).cast("string")), path)
    return _day(archive.read_issue_files(spark, f"{path}/*.json"))


def kw_group_match(spark: SparkSession, sf: str) -> DataFrame:
    found = search.match_groups(src.articles(spark, sf), src.GROUPS)
    return found.select("seq", F.col("group_idx").cast("bigint").alias("group_idx"), "hits")


def kw_group_match_many(spark: SparkSession, sf: str) -> DataFrame:
    """The same groups among ten thousand other phrases, by one automaton."""
    others = [[f"phrase {i} of a long list", f"{i} more words"] for i in range(5_000)]
    found = search.match_groups(src.articles(spark, sf), [*src.GROUPS, *others])
    return found.select("seq", F.col("group_idx").cast("bigint").alias("group_idx"), "hits")


def date_window(spark: SparkSession, sf: str) -> DataFrame:
    return search.date_window(src.articles(spark, sf), AS_OF).select("seq", "published_at")


def date_window_files(spark: SparkSession, sf: str) -> DataFrame:
    """The same window from stored files without a date column, of which a zone map picks some."""
    path = f"{shared_dir(spark)}/zoned-{uuid.uuid4().hex}"
    src.articles(spark, sf).repartitionByRange(16, "published_at").write.parquet(path)
    zones.update_zones(spark, path, f"{path}-zones")
    return zones.read_window(spark, path, f"{path}-zones", AS_OF).select("seq", "published_at")


def lang_filter(spark: SparkSession, sf: str) -> DataFrame:
    return search.in_language(src.table(spark, sf, "documents")).select("doc_id", "lang", "source", "n_chars")


def domain_exclude(spark: SparkSession, sf: str) -> DataFrame:
    return search.exclude_domains(src.articles(spark, sf), src.DOMAINS).select("seq", "url", "source")


def domain_exclude_listed(spark: SparkSession, sf: str) -> DataFrame:
    """The same domains within a table of others, one for each order."""
    others = src.table(spark, sf, "orders").select(F.concat(F.lit("site"), "o_orderkey", F.lit(".example.edu")).alias("domain"))
    listed = others.unionByName(spark.createDataFrame([(d,) for d in src.DOMAINS], "domain string"))
    return search.exclude_listed(src.articles(spark, sf), listed).select("seq", "url", "source")


def digest_funnel(spark: SparkSession, sf: str) -> DataFrame:
    """Row counts of the whole job: found per keyword group and in all, valid, unique, final."""
    collected = _collected(spark, sf)
    return collected.funnel()


def _ranked(spark: SparkSession, sf: str) -> DataFrame:
    matches = search.match_groups(src.articles(spark, sf), src.GROUPS)
    return search.most_relevant(ordering.with_instant(matches))


def topk_per_group(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(spark, sf).select(F.col("group_idx").cast("bigint").alias("group_idx"), "rank", "seq", "hits")


def union_groups(spark: SparkSession, sf: str) -> DataFrame:
    ranked = _ranked(spark, sf).withColumn("article_id", F.col("seq"))
    return search.in_list_order(ranked).select("seq", "article_id", "title")


def valid_articles(spark: SparkSession, sf: str) -> DataFrame:
    return quality.valid_articles(src.raw_articles(spark, sf)).select("seq", "title", "description", "url")


def funnel_counts(spark: SparkSession, sf: str) -> DataFrame:
    raw = src.raw_articles(spark, sf)
    flagged = (
        raw.withColumn("valid", quality.is_valid(F.col("title"), F.col("description"), F.col("url")))
        .withColumn("readable", F.col("valid") & parse_instant(F.col("published_at")).isNotNull())
    )
    stages = {"all": F.lit(True), "valid": F.col("valid"), "dated": F.col("readable")}
    return quality.funnel_counts(flagged, "lang", stages)


def url_norm(spark: SparkSession, sf: str) -> DataFrame:
    return src.with_url_copies(spark, sf).select("seq", normalize_url(F.col("url")).alias("url_norm"))


def dedup_url(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.first_per_url(src.with_url_copies(spark, sf)).select("seq", "url")


def title_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return titles.first_similar_titles(src.with_near_copies(spark, sf))


def near_title_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """The same search by candidates, for lists of any length."""
    return title_candidates.first_similar_candidates(src.with_near_copies(spark, sf))


def sentence_pairs_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Similar sentences: all sentences and lines of the whole texts of all documents as titles."""
    texts = src.table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", r"[.!?\n]+")).alias("pos", "sentence"))
    place = (F.col("doc_id") * F.lit(1 << 32) + F.col("pos")).alias("seq")
    sentences = texts.select(place, F.trim("sentence").alias("title")).filter("title != ''")
    return title_candidates.first_similar_candidates(sentences)


def dedup_greedy(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.drop_near_duplicates(src.with_near_copies(spark, sf)).select("seq", "title", "url")


def parse_published(spark: SparkSession, sf: str) -> DataFrame:
    timed = ordering.with_instant(src.published_texts(spark, sf))
    return timed.select("seq", "published_at", F.unix_micros("published_ts").alias("micros"), "assumed_utc")


def sort_newest(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.sort_newest(src.published_texts(spark, sf)).select("position", "seq", "published_at")


def issue_topk(spark: SparkSession, sf: str) -> DataFrame:
    timed = ordering.with_instant(src.articles(spark, sf))
    return ordering.top_k(timed, ordering.newest_first()).select("position", "seq", "title", "published_at")


def request_table(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.requests(src.articles(spark, sf))


def strip_fences(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation texts, those of assistants inside a code fence."""
    text = F.col("text")
    fenced = F.concat(F.lit("\n```text\n"), text, F.when(F.col("turn") > 1, F.lit("\n```\nrest")).otherwise(F.lit("")))
    shown = F.when(F.col("role") == "assistant", fenced).otherwise(text)
    return src.table(spark, sf, "conversations").select("conv_id", "turn", strip_fence(shown).alias("content"))


def parse_response(spark: SparkSession, sf: str) -> DataFrame:
    parsed = enrich.parse_attempts(src.attempts(spark, sf))
    return parsed.select("seq", F.col("attempt").cast("bigint").alias("attempt"), "reply.*")


def norm_category(spark: SparkSession, sf: str) -> DataFrame:
    raw = enrich.pick_attempt(src.attempts(spark, sf))
    category = F.col("reply.category")
    return raw.select("seq", category.alias("raw"), enrich.normalize_category(category).alias("category"))


def pick_attempt(spark: SparkSession, sf: str) -> DataFrame:
    picked = enrich.pick_attempt(src.attempts(spark, sf))
    return picked.select("seq", F.col("attempt").cast("bigint").alias("attempt"), "reply.title_ja", "aborted")


def enrich_articles(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.enrich(src.articles(spark, sf), src.attempts(spark, sf)).select(
        *_ARTICLE, "title_ja", "summary_ja", "category"
    )


def category_label(spark: SparkSession, sf: str) -> DataFrame:
    raw = enrich.pick_attempt(src.attempts(spark, sf)).select("seq", "reply.category")
    return raw.select("seq", "category", enrich.category_label(F.col("category")).alias("label"))


def jst_date(spark: SparkSession, sf: str) -> DataFrame:
    return src.published_texts(spark, sf).select(
        "seq", "published_at", published_label(F.col("published_at")).alias("published_label")
    )


def category_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _day(report.category_counts(src.issues(spark, sf)))


def category_badges(spark: SparkSession, sf: str) -> DataFrame:
    return _day(report.category_badges(src.issues(spark, sf)))


def article_cards(spark: SparkSession, sf: str) -> DataFrame:
    return _day(report.article_cards(src.issues(spark, sf)))


def issue_header(spark: SparkSession, sf: str) -> DataFrame:
    return _day(report.issue_header(src.issues(spark, sf)))


def issue_key(spark: SparkSession, sf: str) -> DataFrame:
    """Every event time taken as the time of a run."""
    runs = src.table(spark, sf, "events").select("event_id", F.col("ts").cast("string").alias("ts"))
    day = report.issue_key(parse_instant(F.col("ts")))
    return _day(runs.select("event_id", day.alias("issue_date"), report.issue_name(day).alias("name")))


def archive_index(spark: SparkSession, sf: str) -> DataFrame:
    """Issue names from event times: padded, unpadded, one that holds no date, one impossible."""
    ts, role = F.col("ts"), F.pmod(F.col("event_id"), F.lit(5))
    suffix = (
        F.when(role == 0, F.date_format(ts, "yyyy-MM-dd"))
        .when(role == 1, F.date_format(ts, "yyyy-M-d"))
        .when(role == 2, F.concat(F.lit("special-"), F.col("event_type")))
        .when(role == 4, F.concat(F.date_format(ts, "yyyy-MM-dd"), F.lit("-extra")))
        .otherwise(F.date_format(ts, "yyyy-MM-'31x'"))
    )
    names = src.table(spark, sf, "events").select(F.concat(F.lit("weekly-news-"), suffix).alias("name"))
    return report.archive_index(names)


def digest_category_text(spark: SparkSession, sf: str) -> DataFrame:
    return _day(report.digest_category_text(src.issues(spark, sf)))


def digest_preview(spark: SparkSession, sf: str) -> DataFrame:
    return _day(report.digest_preview(src.issues(spark, sf)))


def digest_row(spark: SparkSession, sf: str) -> DataFrame:
    return _day(report.digest_row(src.issues(spark, sf), BASE_URL, TITLE))


def _kept_states(spark: SparkSession, sf: str) -> DataFrame:
    """Stores all issues, those of odd days with a wrong category, then those again as they should be;
    the states are brought up to date after each."""
    path = f"{shared_dir(spark)}/kept-{uuid.uuid4().hex}"
    articles = src.issues(spark, sf).withColumn("image_url", F.lit(None).cast("string"))
    odd = F.dayofmonth("issue_date") % 2 == 1
    wrong = F.when(odd, F.lit(DEFAULT_CATEGORY)).otherwise(F.col("category"))
    for written in (articles.withColumn("category", wrong), articles.filter(odd)):
        archive.write_archive(written, f"{path}/issues")
        states.update_states(spark, f"{path}/issues", f"{path}/states")
    return states.read_states(spark, f"{path}/issues", f"{path}/states")


def category_counts_kept(spark: SparkSession, sf: str) -> DataFrame:
    return _day(report.counts_of(_kept_states(spark, sf)))


def digest_preview_kept(spark: SparkSession, sf: str) -> DataFrame:
    return _day(report.preview_of(_kept_states(spark, sf)))


def digest_row_kept(spark: SparkSession, sf: str) -> DataFrame:
    return _day(report.notification_of(_kept_states(spark, sf), BASE_URL, TITLE))


_SETTINGS = Settings(groups=src.GROUPS, excluded=src.DOMAINS)


def _collected(spark: SparkSession, sf: str) -> Collected:
    """Articles of the runs of three weeks."""
    raw = src.raw_articles(spark, sf).withColumnsRenamed({"seq": "article_id", "source_name": "source"})
    runs = [Issue(datetime(2024, 1, day, 22, 0)) for day in (3, 10, 17)]
    return collect(raw, runs, _SETTINGS)


def digest_cards(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job for the runs of three weeks: search to report cards."""
    replies = src.attempts(spark, sf).withColumnRenamed("seq", "article_id")
    return _day(publish(_collected(spark, sf), replies, _SETTINGS).cards)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "src_responses": src_responses,
    "rejected_responses": rejected_responses,
    "landed_responses": landed_responses,
    "failed_requests": failed_requests,
    "digest_funnel": digest_funnel,
    "project_articles": project_articles,
    "src_archive": src_archive,
    "src_issue_files": src_issue_files,
    "kw_group_match": kw_group_match,
    "kw_group_match_many": kw_group_match_many,
    "date_window": date_window,
    "date_window_files": date_window_files,
    "lang_filter": lang_filter,
    "domain_exclude": domain_exclude,
    "domain_exclude_listed": domain_exclude_listed,
    "topk_per_group": topk_per_group,
    "union_groups": union_groups,
    "valid_articles": valid_articles,
    "funnel_counts": funnel_counts,
    "url_norm": url_norm,
    "dedup_url": dedup_url,
    "title_pairs": title_pairs,
    "near_title_pairs": near_title_pairs,
    "sentence_pairs_documents": sentence_pairs_documents,
    "dedup_greedy": dedup_greedy,
    "parse_published": parse_published,
    "sort_newest": sort_newest,
    "issue_topk": issue_topk,
    "request_table": request_table,
    "strip_fence": strip_fences,
    "parse_response": parse_response,
    "norm_category": norm_category,
    "pick_attempt": pick_attempt,
    "enrich_articles": enrich_articles,
    "category_label": category_label,
    "jst_date": jst_date,
    "category_counts": category_counts,
    "category_badges": category_badges,
    "article_cards": article_cards,
    "issue_header": issue_header,
    "issue_key": issue_key,
    "archive_index": archive_index,
    "digest_category_text": digest_category_text,
    "digest_preview": digest_preview,
    "digest_row": digest_row,
    "category_counts_kept": category_counts_kept,
    "digest_preview_kept": digest_preview_kept,
    "digest_row_kept": digest_row_kept,
    "digest_cards": digest_cards,
}

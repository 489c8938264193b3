"""Digest inputs derived from the general test tables, which hold no news articles.

``articles`` takes web pages as articles and the times of events as publication times. The
other tables give every article a role, so that each case of an operator occurs at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.constants import CATEGORIES
from pressloom.functions.text import report_date
from pressloom.operators.enrich import enrich
from pressloom.operators.ordering import newest_first, top_k_per_group, with_instant

#: Frequent words of the test texts stand in for the keyword groups.
GROUPS = (("the ", "and "), ("de ", "la "), ("that ", "attion"), ("eriner", "nicht "), ("of ", "que "))
DOMAINS = ("example.net", "casino-win.example.com")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    # The texts are cut out of the pages before the join, so pages are not shuffled whole.
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("seq"),
        F.trim(F.regexp_extract(html, "<title>([^<]*)</title>", 1)).alias("title"),
        F.trim(F.array_join(F.regexp_extract_all(html, F.lit("<p>(?:<b>)?([^<]+)"), F.lit(1)), " ")).alias("description"),
        "url",
        F.regexp_extract("url", "^https?://([^/?#:]+)", 1).alias("source"),
        F.regexp_extract(html, '<html lang="([a-z]+)"', 1).alias("lang"),
    )
    events = table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at"), "event_type"
    )
    return pages.join(events, F.col("event_id") == F.col("seq") * 20, "left").drop("event_id")


def _role(n: int) -> Column:
    return F.pmod(F.col("seq"), F.lit(n))


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles as a search returns them: padded, some with null, blank or removed fields."""
    role, null = _role(11), F.lit(None).cast("string")
    title, description, url = F.col("title"), F.col("description"), F.col("url")
    return articles(spark, sf_dir).select(
        "seq",
        F.when(role == 0, null)
        .when(role == 1, F.lit(" \u3000\t"))
        .when(role == 2, F.lit(" [Removed]\n"))
        .otherwise(F.concat(F.lit("\u00a0"), title, F.lit(" \n")))
        .alias("title"),
        F.when(role == 3, F.lit("[REMOVED] "))
        .when(role == 4, null)
        .otherwise(F.concat(F.lit("\t"), description))
        .alias("description"),
        F.when(role == 5, F.lit("  ")).otherwise(F.concat(url, F.lit(" "))).alias("url"),
        F.when(role == 6, null)
        .when(role == 7, F.lit(""))
        .when(role == 8, F.lit("  "))
        .otherwise(F.col("source"))
        .alias("source_name"),
        F.when(role != 9, F.col("published_at")).alias("published_at"),
        F.when(role != 10, F.concat(url, F.lit("#image"))).alias("image_url"),
        "lang",
        "event_type",
    )


def response_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search responses of ten articles each as JSON text; a response whose first article falls
    on an error event reports an error, one that starts with a purchase has no article list."""
    record = F.struct(
        F.struct(F.col("source_name").alias("name")).alias("source"),
        "title",
        "description",
        "url",
        F.col("image_url").alias("urlToImage"),
        F.col("published_at").alias("publishedAt"),
    )
    kind = F.col("kind")
    return (
        raw_articles(spark, sf_dir)
        .groupBy(F.expr("seq div 10").alias("group_idx"))
        .agg(
            F.min_by("event_type", "seq").alias("kind"),
            F.array_sort(F.collect_list(F.struct("seq", record.alias("r")))).alias("records"),
        )
        .select(
            F.to_json(
                F.struct(
                    "group_idx",
                    F.when(kind == "error", "error").otherwise("ok").alias("status"),
                    F.when(kind == "error", "unexpectedError").alias("code"),
                    F.when(kind != "purchase", F.transform("records", lambda x: x["r"])).alias("articles"),
                )
            ).alias("body")
        )
    )


def with_url_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All articles, then all of them again under a URL that differs in case and slashes."""
    base = articles(spark, sf_dir)
    offset = 1_000_000_000_000
    copies = base.withColumn("seq", F.col("seq") + offset).withColumn("url", F.concat(F.upper("url"), F.lit("//")))
    return base.unionByName(copies)


def with_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All articles and their URL copies, then four rewordings of one in three: each title differs
    from the one before by an eighth of its characters, so they form chains of like neighbours."""
    base = with_url_copies(spark, sf_dir)
    step, length = F.col("step"), F.length("title")
    again = articles(spark, sf_dir).filter(_role(3) == 0).withColumn("step", F.explode(F.array(*map(F.lit, range(1, 5)))))
    cut = F.floor(length * step / 8).cast("int")
    again = again.withColumn("title", F.concat(F.repeat(F.lit("#"), cut), F.substring(F.col("title"), cut + 1, length)))
    again = again.withColumn("url", F.concat("url", F.lit("&step="), step.cast("string")))
    again = again.withColumn("seq", F.col("seq") + (step + 1) * 1_000_000_000_000).drop("step")
    return base.unionByName(again)


def published_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publication times in different spellings, some of them unreadable."""
    role, text = _role(14), F.col("published_at")
    day, clock = F.substring(text, 1, 10), F.substring(text, 12, 8)
    return articles(spark, sf_dir).select(
        "seq",
        F.when(role == 1, F.concat(day, F.lit("T"), clock, F.lit("+09:00")))
        .when(role == 2, F.concat(day, F.lit(" "), clock))
        .when(role == 3, day)
        .when(role == 4, F.substring(text, 1, 7))
        .when(role == 5, F.concat(day, F.lit("T"), clock, F.lit(".250Z")))
        .when(role == 6, F.lit(""))
        .when(role == 7, F.concat(F.lit("on "), day))
        .when(role == 8, F.concat(day, F.lit("t"), clock, F.lit("+00:00")))
        .when(role == 9, F.concat(day, F.lit("_"), F.replace(clock, F.lit(":"), F.lit("")), F.lit("Z")))
        .when(role == 10, F.concat(day, F.lit("T"), clock, F.lit("+09:00:30")))
        .when(role == 11, F.concat(day, F.lit("T"), clock, F.lit("-23:59")))
        .when(role == 12, F.concat(_iso_week(day), F.lit("T"), clock, F.lit("Z")))
        .when(role == 13, F.replace(_iso_week(day), F.lit("-"), F.lit("")))
        .otherwise(text)
        .alias("published_at"),
    )


def _iso_week(day: Column) -> Column:
    date = day.try_cast("date")
    thursday = F.date_add(date, 3 - F.weekday(date))  # the year of a week is that of its Thursday
    week = F.lpad(F.weekofyear(date).cast("string"), 2, "0")
    return F.concat(F.year(thursday).cast("string"), F.lit("-W"), week, F.lit("-"), (F.weekday(date) + 1).cast("string"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to three model attempts per article."""
    role, seq = _role(9), F.col("seq").cast("string")
    words = F.regexp_replace("title", "[^A-Za-z0-9 ]", "")
    key = F.lit("other")
    for i, (name, _) in enumerate(CATEGORIES):
        key = F.when(F.pmod(F.expr("seq div 9"), F.lit(len(CATEGORIES))) == i, F.lit(name)).otherwise(key)
    t = F.concat(F.lit('"title_ja": "訳 '), words, F.lit('"'))
    s = F.concat(F.lit('"summary_ja": "要約 '), seq, F.lit('"'))
    c = F.concat(F.lit('"category": "'), key, F.lit('"'))

    def reply(*parts: Column) -> Column:
        return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))

    good = reply(t, s, c)
    fence = F.concat(F.lit(" ```json\n"), good, F.lit("\n```\nDone."))
    wrong = F.lit('"category": "Equipment"')
    null_category = F.concat_ws(", ", s, F.lit('"category": null'))

    def attempt(n: int, outcome: Column, text: Column) -> Column:
        return F.struct(F.lit(n).alias("attempt"), outcome.alias("outcome"), text.alias("text"))

    ok, limited, failed = F.lit("ok"), F.lit("rate_limited"), F.lit("api_error")
    none = F.lit(None).cast("string")
    first = attempt(
        1,
        F.when(role == 8, failed).otherwise(ok),
        F.when(role == 1, fence)
        .when(role == 2, reply(s, c))
        .when(role == 3, reply(t))
        .when(role == 4, reply(t, s, wrong))
        .when(role == 5, reply(t, null_category))
        .when(role == 6, F.concat(F.lit("Sorry, "), good))
        .when(role == 7, F.concat(good, F.lit(" and more")))
        .when(role == 8, none)
        .otherwise(good),
    )
    second = attempt(2, F.when(role == 7, ok).otherwise(limited), F.when(role == 7, F.lit('["title_ja"]')))
    third = attempt(
        3,
        F.when(role == 8, failed).otherwise(ok),
        F.when(role == 6, good).when(role == 7, F.lit("{'title_ja': 'x'}")),
    )
    made = F.when(role >= 6, F.array(first, second, third)).otherwise(F.array(first))
    return articles(spark, sf_dir).select("seq", F.inline(made))


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished issues, one per report date: the newest twenty articles of each, enriched."""
    dated = with_instant(articles(spark, sf_dir)).withColumn("issue_date", report_date(F.col("published_ts")))
    chosen = top_k_per_group(dated, ["issue_date"], newest_first(), 20)
    return enrich(chosen, attempts(spark, sf_dir))

"""Posts with their comments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_comments(posts: DataFrame, comments: DataFrame, key: list[str], order: str, text: str) -> DataFrame:
    """posts with comments: the texts of their comments in order, joined by line feeds; empty without any. Comments with a null key go."""
    kept = comments
    for k in key:
        kept = kept.where(F.col(k).isNotNull())
    grouped = kept.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(order, text))).alias("__c"))
    joined = posts.join(grouped, key, "left")
    return joined.withColumn("comments", F.coalesce(F.array_join(F.transform("__c", lambda x: x[text]), "\n"), F.lit(""))).drop("__c")


def flatten_threads(comments: DataFrame, thread: str = "thread") -> DataFrame:
    """Root comments and the replies inside them as one table."""
    roots = comments.drop(thread)
    replies = comments.select(F.explode(thread).alias("t")).select("t.*")
    return roots.unionByName(replies, allowMissingColumns=True)


def skip_reason(text: Column, fits: Column, least: int = 10) -> Column:
    """Why a post is left out: empty, short or language; null if it stays."""
    return F.when(F.coalesce(text, F.lit("")) == "", "empty").when(F.length(text) < least, "short").when(~fits, "language")


# --- shapes of raw records -------------------------------------------------------------------------------------

VK_POST = "struct<id:bigint,owner_id:bigint,date:bigint,text:string,likes:struct<count:bigint>,comments:struct<count:bigint>,reposts:struct<count:bigint>,views:struct<count:bigint>,attachments:array<struct<type:string,photo:struct<sizes:array<struct<url:string>>>>>>"
VK_COMMENT = "struct<id:bigint,from_id:bigint,date:bigint,text:string,likes:struct<count:bigint>,reply_to_user:bigint,reply_to_comment:bigint,parents_stack:array<bigint>>"


def vk_posts(raw: DataFrame, body: str = "body", domain: str = "domain", language: str | None = None) -> DataFrame:
    """Post records from JSON bodies of the wall's API: a title of 120 characters, the last size of the first photo, counters that default to 0."""
    from ..functions import dates, text as X

    p = raw.select(domain, F.from_json(body, VK_POST).alias("p")).select(domain, "p.*")
    photos = F.filter("attachments", lambda a: (a["type"] == "photo") & (F.size(a["photo"]["sizes"]) > 0))
    sizes = F.get(photos, F.lit(0))["photo"]["sizes"]
    count = lambda c: F.coalesce(F.col(f"{c}.count"), F.lit(0)).alias("comments_count" if c == "comments" else c)
    url = F.concat(F.lit("https://vk.com/wall"), F.col("owner_id").cast("string"), F.lit("_"), F.col("id").cast("string"))
    return p.select(
        url.alias("url"), F.substring("text", 1, 120).alias("title"), F.col("text").alias("content"), X.excerpt("text").alias("excerpt"), dates.epoch_iso("date").alias("date"),
        F.col(domain).alias("author"), F.lit(None).cast("string").alias("category"), dates.epoch_clock("date").alias("time"), F.lit("vk.com").alias("site"), X.sha(F.concat(F.coalesce("text", F.lit("")), F.col("id").cast("string"))).alias("hash"),
        F.element_at(sizes, -1)["url"].alias("image_url"), F.lit(language).cast("string").alias("language"), F.lit("social_vk_post").alias("source_type"), F.lit("post").alias("page_type"),
        F.col(domain).alias("domain"), F.col("id").alias("post_id"), "owner_id", count("likes"), count("comments"), count("reposts"), count("views"),
    )


def vk_comments(raw: DataFrame, body: str = "body", post_id: str = "post_id") -> DataFrame:
    """Comment records from JSON bodies; the parent is the last of its stack, 0 for a root."""
    from ..functions import dates

    c = raw.select(post_id, F.from_json(body, VK_COMMENT).alias("c")).select(post_id, "c.*")
    parent = F.when(F.size("parents_stack") > 0, F.element_at("parents_stack", -1)).otherwise(F.lit(0))
    return c.select(F.col("id").alias("comment_id"), post_id, parent.cast("long").alias("parent_comment_id"), F.col("text").alias("content"), dates.epoch_iso("date").alias("date"), F.col("from_id").alias("author_id"), F.coalesce("likes.count", F.lit(0)).alias("likes"), "reply_to_user", "reply_to_comment")


def telegram_posts(raw: DataFrame, channel: str) -> DataFrame:
    """Post records of a channel's messages (id, date as epoch, text, views, forwards); messages without text go."""
    from ..functions import dates, text as X

    m = raw.where(F.coalesce("text", F.lit("")) != "")
    return m.select(
        F.concat(F.lit(f"https://t.me/{channel}/"), F.col("id").cast("string")).alias("url"), F.substring("text", 1, 120).alias("title"), F.col("text").alias("content"), X.excerpt("text").alias("excerpt"), dates.epoch_iso("date").alias("date"),
        F.lit(channel).alias("author"), X.sha(F.concat("text", F.col("id").cast("string"))).alias("hash"), F.lit("social_telegram").alias("source_type"), F.lit(channel).alias("channel"), F.col("id").alias("post_id"),
        F.coalesce("views", F.lit(0)).alias("views"), F.coalesce("forwards", F.lit(0)).alias("forwards"),
    )


def vk_unified(posts: DataFrame, comments: DataFrame, language: Column | str, fits: Column, least: int = 10) -> DataFrame:
    """Posts that are long enough and in the language, with the texts of their comments that are so too."""
    from ..functions import text as X

    p = posts.withColumn("content", X.without_emoji("content"))
    kept = p.where(skip_reason(F.col("content"), fits, least).isNull())
    c = comments.withColumn("content", X.without_emoji("content"))
    replies = c.where(skip_reason(F.col("content"), fits, least).isNull()).select("post_id", "comment_id", F.col("content").alias("reply"))
    joined = with_comments(kept, replies, ["post_id"], "comment_id", "reply")
    return joined.select("title", "content", "category", "comments", "date", "url", (F.lit(language) if isinstance(language, str) else language).alias("language"), "post_id", "domain", "likes", "reposts", "views")

"""Queries over conversations, read as posts (first user turns) and comments."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scripts, text as X
from ..operators import social
from . import sql as S
from .registry import query, table


@query("emoji_strip_min_len", f"SELECT conv_id, turn, clean FROM (SELECT conv_id, turn, {S.without_emoji('text')} AS clean FROM conversations) WHERE length(clean) >= 10")
def emoji_strip_min_len(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", X.without_emoji("text").alias("clean")).where(F.length("clean") >= 10)


def posts(spark, sf_dir):
    """The first user turn of each conversation."""
    user = table(spark, sf_dir, "conversations").where("role = 'user'")
    return user.groupBy("conv_id").agg(F.min_by("text", "turn").alias("text"), F.min("turn").alias("turn"))


POSTS = "(SELECT conv_id, arg_min(text, turn) AS text, min(turn) AS turn FROM conversations WHERE role = 'user' GROUP BY conv_id)"


@query(
    "post_comment_groupjoin",
    f"""WITH c AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn, text) AS comments FROM conversations WHERE role = 'assistant' AND conv_id IS NOT NULL GROUP BY conv_id)
    SELECT conv_id, text, coalesce(comments, '') AS comments FROM {POSTS} LEFT JOIN c USING (conv_id)""",
)
def post_comment_groupjoin(spark, sf_dir):
    replies = table(spark, sf_dir, "conversations").where("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("reply"))
    return social.with_comments(posts(spark, sf_dir), replies, ["conv_id"], "turn", "reply").select("conv_id", "text", "comments")


@query(
    "post_skip_reasons",
    f"""SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM (SELECT CASE WHEN coalesce(t, '') = '' THEN 'empty' WHEN length(t) < 10 THEN 'short' WHEN NOT regexp_matches(t, '[éñö]') THEN 'language' END AS reason
    FROM (SELECT {S.without_emoji('text')} AS t FROM conversations)) GROUP BY 1""",
)
def post_skip_reasons(spark, sf_dir):
    t = table(spark, sf_dir, "conversations").select(X.without_emoji("text").alias("t"))
    return t.groupBy(F.coalesce(social.skip_reason(F.col("t"), scripts.letters_fit("t", "éñö")), F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query("reply_tree_selfjoin", "SELECT a.conv_id, a.turn, a.role, b.turn AS reply_turn, b.role AS reply_role FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1")
def reply_tree_selfjoin(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    below = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("turn").alias("reply_turn"), F.col("role").alias("reply_role"))
    return c.join(below, ["conv_id", "turn"])


@query(
    "posts_and_comments_union",
    """SELECT conv_id, turn, text, 'post' AS kind FROM conversations WHERE turn = (SELECT min(turn) FROM conversations c WHERE c.conv_id = conversations.conv_id)
    UNION ALL SELECT conv_id, turn, text, 'comment' FROM conversations WHERE turn > (SELECT min(turn) FROM conversations c WHERE c.conv_id = conversations.conv_id)""",
)
def posts_and_comments_union(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    first = c.groupBy("conv_id").agg(F.min("turn").alias("least"))
    both = c.join(first, "conv_id")
    post = both.where("turn = least").select("conv_id", "turn", "text", F.lit("post").alias("kind"))
    return post.unionByName(both.where("turn > least").select("conv_id", "turn", "text", F.lit("comment").alias("kind")))


@query(
    "vk_post_shape",
    f"""SELECT conv_id AS post_id, substr(text, 1, 120) AS title, {S.excerpt('text')} AS excerpt, substr(sha256(text || conv_id), 1, 32) AS hash, 'https://vk.com/wall-5_' || conv_id AS url, conv_id % 4 AS likes, CAST(0 AS BIGINT) AS views,
      CASE WHEN conv_id % 3 = 0 THEN 'https://a.b/large' END AS image_url, 'club5' AS author, 'social_vk_post' AS source_type FROM {POSTS}""",
)
def vk_post_shape(spark, sf_dir):
    """Bodies as the wall's API gives them, read back as post records."""
    size = lambda u: F.struct(F.lit(u).alias("url"))
    photo = F.struct(F.lit("photo").alias("type"), F.struct(F.array(size("https://a.b/small"), size("https://a.b/large")).alias("sizes")).alias("photo"))
    link = F.struct(F.lit("link").alias("type"), F.lit(None).cast("struct<sizes:array<struct<url:string>>>").alias("photo"))
    shown = F.when(F.col("conv_id") % 3 == 0, F.array(link, photo)).otherwise(F.array(link))
    body = F.to_json(F.struct(F.col("conv_id").alias("id"), F.lit(-5).alias("owner_id"), F.lit(1_700_000_000).alias("date"), "text", F.struct((F.col("conv_id") % 4).alias("count")).alias("likes"), shown.alias("attachments")))
    raw = posts(spark, sf_dir).select(F.lit("club5").alias("domain"), body.alias("body"))
    return social.vk_posts(raw).select("post_id", "title", "excerpt", "hash", "url", "likes", "views", "image_url", "author", "source_type")

"""Threaded-discussion views over the given tables, as one SQL text for Spark and DuckDB.

The given tables hold no threads, so posts are the documents and comments are the conversations: piece 0 of a turn is
its whole text, further pieces are its sentences. Every row and every text is used in full. Conversations divisible
by 3 all belong to post 0, which so owns over a third of all comments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadlens.session import scratch_path
from threadlens.sources.tables import read_parquet

TABLES = ["documents", "conversations", "pages"]

_PIECES = {
    "spark": r"""
select conv_id, turn, cast(x.s as bigint) s, x.piece
from conversations lateral view posexplode(concat(array(text), split(text, '[.\\n]+'))) x as s, piece
where trim(x.piece) <> ''
""",
    "duckdb": r"""
select conv_id, turn, s, piece from (
  select conv_id, turn, unnest(parts) piece, unnest(range(len(parts))) s
  from (select conv_id, turn, list_concat([text], regexp_split_to_array(text, '[.\n]+')) parts from conversations))
where trim(piece) <> ''
""",
}

_TIME = "concat('2024-01-', lpad(cast(1 + {n} % 28 as string), 2, '0'), '{sep}', lpad(cast({n} % 24 as string), 2, '0'), ':{min}:00')"


def _time(n: str, sep: str = " ", minute: str = "00") -> str:
    return _TIME.format(n=n, sep=sep, min=minute)


_COMMENTS = f"""
select concat('t1_', cast(conv_id as string), '_', cast(turn as string), '_', cast(s as string)) comment_id,
       concat('t3_', cast(p as string)) post_id,
       case when (conv_id + turn + s) % 31 = 7 then cast(null as string)
            when (conv_id * 7 + turn * 3 + s) % 29 = 5 then 't1_missing'
            when (conv_id * 3 + turn + s) % 97 = 11
              then concat('t1_', cast(conv_id as string), '_', cast(turn as string), '_', cast(s as string))
            when s = 0 and turn = 0 then concat('t3_', cast(p as string))
            when s = 0 then concat('t1_', cast(conv_id as string), '_', cast((turn - 1) {{div}} 2 as string), '_0')
            when s % 7 = 0 then concat('t3_', cast(p as string))
            when s % 7 = 1 or s % 7 = 4 then concat('t1_', cast(conv_id as string), '_', cast(turn as string), '_0')
            else concat('t1_', cast(conv_id as string), '_', cast(turn as string), '_', cast(s - 1 as string)) end parent_id,
       case (conv_id * 5 + turn * 3 + s) % 12
         when 0  then concat(piece, '?')
         when 1  then '[deleted]'
         when 2  then concat('  ', piece, ' ')
         when 3  then concat(piece, '?")')
         when 4  then concat(piece, '&#63;')
         when 6  then concat(piece, '? Thanks in advance')
         when 7  then concat('&quot;', piece, '&quot; &amp; great good scam')
         when 8  then concat('[Removed by mods] ', piece, '?')
         when 9  then concat(piece, '? Otherwise this is a plain remark with a long tail')
         when 10 then concat('Great Wall of New York ', piece, ' good fraud kill')
         when 11 then concat(piece, ' &amp;amp; best')
         else piece end body,
       concat('user', cast((conv_id + turn) % 50 as string)) author,
       case when (conv_id + turn * 2 + s) % 37 = 3 then cast(null as bigint)
            else (conv_id * 31 + turn * 17 + s * 7) % 101 - 10 end score,
       cast(turn as int) depth,
       cast({_time('(conv_id + turn + s)')} as timestamp) created_utc,
       cast(0.0 as double) sentiment_score, 'neutral' sentiment_label, '' keywords,
       1 + conv_id % 2 batch_id
from (select conv_id, turn, s, piece, case when conv_id % 3 = 0 then 0 else conv_id {{div}} 10 end p from pieces)
"""

_POSTS = f"""
select concat('t3_', cast(doc_id as string)) post_id, source subreddit,
       concat(source, ' Report &amp; ', lang, ' success') title,
       case doc_id % 4 when 0 then concat(text, ' submitted by someone [link] [comments]')
                       when 1 then concat('&lt;p&gt;', text, '&lt;/p&gt;')
                       else text end body,
       concat('user', cast(doc_id % 50 as string)) author, (doc_id * 13) % 97 score,
       concat('https://example.org/', cast(doc_id as string)) url,
       cast({_time('doc_id')} as timestamp) created_utc, n_chars num_comments,
       cast(0.0 as double) sentiment_score, 'neutral' sentiment_label, '' keywords, 1 + doc_id % 2 batch_id
from documents
"""

# Raw items: aliases, bare and prefixed ids, missing ids, bad times, other kinds and a second copy of a third of them.
_RAW_POSTS = f"""
select case when doc_id % 11 = 10 then 'community' else 'post' end "dataType",
       case when doc_id % 5 = 1 then cast(null as string) when doc_id % 2 = 0 then post_id else cast(doc_id as string) end id,
       case when doc_id % 15 = 1 then cast(null as string) else cast(doc_id as string) end "parsedId",
       case when doc_id % 3 = 0 then concat('r/', subreddit) end "parsedCommunityName",
       case when doc_id % 3 = 1 then subreddit end "communityName",
       case when doc_id % 4 = 2 then 'other' end "subredditName",
       case when copy = 0 then title end title, case when copy = 0 then body else concat('copy of ', body) end body,
       case when doc_id % 3 = 0 then author end "authorName", case when doc_id % 3 = 1 then author end username,
       case when doc_id % 6 = 2 then author end author,
       case when doc_id % 2 = 0 then cast(score as string) end "upVotes",
       case when doc_id % 4 = 1 then '7' when doc_id % 4 = 3 then 'many' end score,
       case when doc_id % 2 = 1 then url end "postUrl", url, case when doc_id % 3 = 1 then '4' end "commentsCount",
       case when doc_id % 3 = 2 then '5' end "numberOfComments", '6' "numComments",
       case when doc_id % 7 = 2 then 'yesterday' when doc_id % 7 = 3 then ''
            else concat({_time('(doc_id + copy)', 'T')}, 'Z') end "createdAt",
       case when doc_id % 2 = 1 then concat({_time('(doc_id + copy)', 'T', '30')}, '.250+02:00') end "crawledAt",
       1 + (doc_id + copy) % 2 load_no
from posts_numbered
"""

_RAW_COMMENTS = f"""
select case when n % 11 = 10 then 'user' else 'comment' end "dataType",
       case when n % 5 = 1 then cast(null as string) when n % 2 = 0 then comment_id else substr(comment_id, 4) end id,
       case when n % 15 = 1 then cast(null as string) else substr(comment_id, 4) end "parsedId",
       case when n % 3 = 0 then post_id end "postId",
       case when n % 3 = 1 then substr(post_id, 4) when n % 24 = 8 then '' end post_id,
       case when n % 7 = 0 then '' when n % 7 < 3 then parent_id end "parentId",
       case when n % 7 = 3 then substr(parent_id, 4) when n % 14 = 0 then '0' end parent_id,
       case when n % 7 = 4 then substr(post_id, 4) end "replyToId",
       case when n % 2 = 0 then parent_id end "parentCommentId",
       case when n % 4 = 0 then cast(depth as string) when n % 8 = 1 then 'x' when n % 8 = 5 then '3.7' end depth,
       case when n % 4 = 2 then ' 2 ' end "commentDepth",
       case when copy = 0 then body else concat('copy of ', body) end body,
       case when n % 3 = 0 then author end "authorName", case when n % 3 = 1 then author end username,
       case when n % 2 = 0 then cast(score as string) end "upVotes", case when n % 4 = 1 then '7' end score,
       case when n % 9 = 2 then 'soon' else concat({_time('(n + copy)', 'T')}, 'Z') end "createdAt",
       1 + (n + copy) % 2 load_no
from comments_numbered
"""

_NUMBERED = {
    "posts_numbered": (
        "select p.*, cast(substr(post_id, 4) as bigint) doc_id, {copy} copy from posts_fx p {copies}",
        "cast(substr(post_id, 4) as bigint) % 3 = 0",
    ),
    "comments_numbered": (
        "select p.*, coalesce(score, 0) + 10 + length(body) + depth n, {copy} copy from comments_fx p {copies}",
        "length(body) % 3 = 0",
    ),
}


def _numbered(name: str, engine: str) -> str:
    text, twice = _NUMBERED[name]
    if engine == "spark":
        return text.format(
            copy="c.copy", copies=f"lateral view explode(case when {twice} then array(0L, 1L) else array(0L) end) c as copy"
        )
    return text.format(copy=f"unnest(case when {twice} then [0, 1] else [0] end)", copies="")


def text_of(name: str, engine: str) -> str:
    """SQL of one view for one engine."""
    if name == "pieces":
        return _PIECES[engine]
    if name in _NUMBERED:
        return _numbered(name, engine)
    sql = {"comments_fx": _COMMENTS, "posts_fx": _POSTS, "raw_posts_fx": _RAW_POSTS, "raw_comments_fx": _RAW_COMMENTS}[name]
    sql = sql.replace("{div}", "div" if engine == "spark" else "//")
    return sql.replace('"', "`") if engine == "spark" and name.startswith("raw_") else sql


# View name -> the views it reads.
NEEDS = {
    "pieces": [], "comments_fx": ["pieces"], "posts_fx": [], "posts_numbered": ["posts_fx"],
    "comments_numbered": ["comments_fx"], "raw_posts_fx": ["posts_numbered"], "raw_comments_fx": ["comments_numbered"],
}


# Views stored once per session and data folder, so that queries scan Parquet like any stored table.
STORED = ("comments_fx", "posts_fx")
_PATHS: dict[tuple[str, str, str], str] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or an overlay view of the data in `sf_dir`."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if name not in NEEDS:
        return read_parquet(spark, f"{sf_dir}/{name}.parquet")
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key in _PATHS:
        return read_parquet(spark, _PATHS[key])
    for table in TABLES:
        read_parquet(spark, f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    for needed in NEEDS[name]:
        load(spark, sf_dir, needed).createOrReplaceTempView(needed)
    view = spark.sql(text_of(name, "spark"))
    if name not in STORED:
        return view
    path = scratch_path(spark, name)
    view.write.parquet(path, compression="zstd")
    _PATHS[key] = path
    return read_parquet(spark, path)


def ctes(*names: str) -> list[tuple[str, str]]:
    """DuckDB (name, SQL) definitions of views and all they read, in order."""
    out: list[tuple[str, str]] = []
    for name in names:
        for item in [*ctes(*NEEDS[name]), (name, text_of(name, "duckdb"))]:
            if item not in out:
                out.append(item)
    return out

"""DuckDB SQL for the registered queries, written independently of the Spark operators."""

from __future__ import annotations

from threadlens.functions.vocab import NEGATIVE, POSITIVE, STOPWORDS, WHITESPACE
from threadlens.operators.report import SHEETS
from workload.overlays import NEEDS, ctes
from workload.queries import INGEST_TS, VALENCES

ORACLES: dict[str, str] = {}
NUL_PAIR = "cast(0.0 as double) sentiment_score, 'neutral' sentiment_label, '' keywords"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


WS = _q(WHITESPACE)


def _list(words) -> str:
    return "(" + ", ".join(_q(w) for w in words) + ")"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def unescape(x: str) -> str:
    """Entities that occur in the data; the ampersand last keeps it a single pass."""
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#63;", "?"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]:
        x = f"replace({x}, '{entity}', '{char}')"
    return x


def clean(x: str) -> str:
    return strip(unescape(f"coalesce({x}, '')"))


def cut(x: str) -> str:
    """Tagline cut of a cleaned text."""
    return (
        f"case when contains({x}, 'submitted by') and contains({x}, '[link]') "
        f"then {strip(f'''split_part({x}, 'submitted by', 1)''')} else {x} end"
    )


def iso(x: str) -> str:
    return (
        f"coalesce(strftime({x}, '%Y-%m-%dT%H:%M:%S') || "
        f"case when strftime({x}, '%f') = '000000' then '' else '.' || strftime({x}, '%f') end, '')"
    )


def valid(t: str) -> str:
    return (
        f"({t} <> '' and not starts_with(lower({t}), '[deleted') and not starts_with(lower({t}), '[removed') "
        f"and lower({t}) <> '[ removed by reddit ]')"
    )


def question(t: str) -> str:
    closers = _q(" \"')}]")
    return (
        f"({valid(t)} and contains({t}, '?') and length({t}) <= 350 "
        f"and len(regexp_extract_all({t}, '[^\\s]+')) <= 60 "
        f"and (ends_with(rtrim({t}, {closers}), '?') or length(split_part({t}, '?', -1)) <= 25))"
    )


def oracle(name: str, body: str, *views: str, recursive: bool = False, **more: str) -> None:
    """Registers `body` behind the overlay views it reads and further named steps."""
    parts = [*ctes(*[v for v in views if v in NEEDS]), *more.items()]
    head = f"with {'recursive ' if recursive else ''}" + ", ".join(f"{n} as ({s})" for n, s in parts) if parts else ""
    ORACLES[name] = f"{head} {body}".strip()


# ---- shared steps ----

TEXT = {"c": f"select *, coalesce(score, 0) sc, {clean('body')} t from comments_fx"}
CAND = {
    **TEXT,
    "cand": f"select post_id, comment_id, parent_id, sc, t, {question('t')} is_q from c where {valid('t')}",
}
GREEDY = {
    **CAND,
    "qs": "select *, row_number() over (partition by post_id order by sc desc, comment_id) k from cand where is_q",
    "ans": "select *, row_number() over (partition by post_id order by sc desc, comment_id) r from cand where not is_q",
    "steps": """
select post_id, cast(0 as bigint) k, cast([] as bigint[]) used, cast(null as varchar) qid, cast(null as bigint) r, 0 tier
from (select distinct post_id from qs)
union all
select post_id, k, case when best is null then used else list_append(used, best % 1000000) end, qid, best % 1000000,
       cast(best // 1000000 as int)
from (select m.post_id, q.k, m.used, q.comment_id qid,
             min(case when a.parent_id = q.comment_id then 1
                      when a.parent_id = q.parent_id and q.parent_id <> '' and q.parent_id <> q.post_id then 2
                      else 3 end * 1000000 + a.r) best
      from steps m join qs q on q.post_id = m.post_id and q.k = m.k + 1
      left join ans a on a.post_id = m.post_id and not list_contains(m.used, a.r)
      group by m.post_id, q.k, m.used, q.comment_id)
""",
    "matches": """
select s.post_id, s.qid question_comment_id, a.comment_id answer_comment_id, s.tier
from steps s join ans a on a.post_id = s.post_id and a.r = s.r where s.qid is not null
""",
}
PAIRS = {
    **GREEDY,
    "pairs": """
select m.question_comment_id, m.answer_comment_id, m.post_id, q.t question, a.t answer, q.sc + a.sc score_signal,
       case m.tier when 1 then 'direct_reply' when 2 then 'thread_sibling' else 'fallback_top_score' end match_type,
       case m.tier when 1 then 'verified_direct_reply' when 2 then 'unverified_thread_sibling'
                   else 'unverified_fallback' end verification_status,
       cast(case m.tier when 1 then 0.95 when 2 then 0.70 else 0.40 end as double) confidence_score
from matches m join c q on q.comment_id = m.question_comment_id join c a on a.comment_id = m.answer_comment_id
""",
}
TREE = {
    "sib": """
select *, row_number() over (partition by post_id, parent_id order by coalesce(score, 0) desc, comment_id) sr
from comments_fx
""",
    "tree": """
select post_id, comment_id, comment_id thread_id, [sr] path from sib where parent_id = post_id
union all
select s.post_id, s.comment_id, t.thread_id, list_append(t.path, s.sr)
from tree t join sib s on s.post_id = t.post_id and s.parent_id = t.comment_id
""",
}


def _analysis(source: str, key: str) -> dict[str, str]:
    """Steps sent, kw, ana (key, sentiment_score, sentiment_label, keywords) over `source` (id, t: cleaned text)."""
    return {
        "src": source,
        "tok": r"""
select id, w, i from (select id, unnest(l) w, unnest(range(len(l))) i
                      from (select id, regexp_extract_all(lower(t), '[\p{L}\p{N}_]+') l from src))
""",
        "hits": f"""
select id, sum(case when w in {_list(POSITIVE)} then 1 else 0 end) p, sum(case when w in {_list(NEGATIVE)} then 1 else 0 end) n
from tok group by id
""",
        "sent": f"""
select s.id, case when coalesce(p + n, 0) = 0 then cast(0.0 as double)
                  else round_even(cast(p - n as double) / (p + n), 4) end score
from src s left join hits h on h.id = s.id
""",
        "wc": f"""
select id, w, count(*) n, min(i) i from tok where regexp_full_match(w, '[a-z]{{3,}}') and w not in {_list(STOPWORDS)} group by id, w
""",
        "topw": "select id, w, row_number() over (partition by id order by n desc, i) k from wc qualify k <= 7",
        "piece": r"""
select id, unnest(l) p, unnest(range(len(l))) i
from (select id, regexp_extract_all(t, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+') l from src)
""",
        "mark": f"""
select *, regexp_full_match(p, '[A-Z][a-z]{{2,}}') cap, {strip('p')} = '' gap from piece
""",
        "near": """
select *, lag(cap) over w lc, lag(cap, 2) over w lc2, lag(gap) over w lg, lead(cap) over w nc from mark
window w as (partition by id order by i)
""",
        "isle": """
select id, p, i, sum(case when cap and not (coalesce(lg, false) and coalesce(lc2, false)) then 1 else 0 end)
         over (partition by id order by i) g
from near where cap or (gap and coalesce(lc, false) and coalesce(nc, false))
""",
        "phrase": "select id, g, string_agg(p, '' order by i) e, min(i) i from isle group by id, g",
        "ent": f"""
select id, e, row_number() over (partition by id order by min(i)) k from phrase
where lower(e) not in {_list(STOPWORDS)} group by id, e
""",
        "mixed": """
select id, e w, k from ent where k <= 4
union all
select t.id, t.w, 100 + t.k from topw t where not exists (select 1 from ent x where x.id = t.id and lower(x.e) = t.w)
""",
        "kw": """
select id, string_agg(w, ', ' order by k) keywords
from (select *, row_number() over (partition by id order by k) r from mixed) where r <= 7 group by id
""",
        "ana": f"""
select s.id {key}, s.score sentiment_score,
       case when s.score >= 0.05 then 'positive' when s.score <= -0.05 then 'negative' else 'neutral' end sentiment_label,
       coalesce(k.keywords, '') keywords
from sent s left join kw k on k.id = s.id
""",
    }


DOC_ANA = _analysis(f"select doc_id id, {clean('text')} t from documents", "doc_id")
COM_ANA = _analysis(f"select comment_id id, {clean('body')} t from comments_fx", "comment_id")
_POST_TEXT = "coalesce(title, '') || ' ' || coalesce(body, '')"
POST_ANA = _analysis(f"select post_id id, {clean(_POST_TEXT)} t from posts_fx", "post_id")

# ---- sources, ingest, normalisation ----

_SHOWN = ['"dataType"', "id", '"parsedId"', "body", "author", "username", "score", '"createdAt"']


def _shown(view: str, missing=()) -> str:
    return "select " + ", ".join(f"cast(null as varchar) {c}" if c in missing else c for c in _SHOWN) + f" from {view}"


_POST_ROWS, _COMMENT_ROWS = _shown("raw_posts_fx"), _shown("raw_comments_fx", ["author"])
oracle("read_items_dump", f"{_POST_ROWS} union all {_COMMENT_ROWS}", "raw_posts_fx", "raw_comments_fx")
oracle("split_posts", f"{_POST_ROWS} where \"dataType\" = 'post'", "raw_posts_fx")
oracle("split_comments", f"{_COMMENT_ROWS} where \"dataType\" = 'comment'", "raw_comments_fx")


def _when(first: str, second: str | None) -> str:
    """Parsed time of the first non-empty alias."""
    raw = f"coalesce(nullif({first}, ''), {second})" if second else f"nullif({first}, '')"
    return (
        f"case when starts_with({raw}, '2024') then cast({raw} as timestamp) - "
        f"case when ends_with({raw}, '+02:00') then interval 2 hour else interval 0 hour end "
        f"else timestamp '{INGEST_TS}' end"
    )


NORM_POSTS = {
    "np0": f"""
select *, nullif(coalesce(id, "parsedId"), '') k, {clean('title')} ct, {clean('body')} cb
from raw_posts_fx where "dataType" = 'post'
""",
    "np": f"""
select case when starts_with(k, 't3_') then k else 't3_' || k end post_id,
       regexp_replace(coalesce("parsedCommunityName", "communityName", "subredditName", ''), '^r/', '') subreddit,
       {cut('ct')} title, {cut('cb')} body, coalesce("authorName", username, author, 'unknown') author,
       coalesce(try_cast(coalesce("upVotes", score) as bigint), 0) score, coalesce("postUrl", url, '') url,
       {_when('"createdAt"', '"crawledAt"')} created_utc,
       cast(coalesce("commentsCount", "numberOfComments", "numComments", '0') as bigint) num_comments,
       {NUL_PAIR}, cast(load_no as bigint) batch_id
from np0 where k is not null
""",
}
NORM_COMMENTS = {
    "nc0": """
select *, nullif(coalesce(id, "parsedId"), '') k, coalesce("postId", post_id, '') p0 from raw_comments_fx
where "dataType" = 'comment'
""",
    "nc1": """
select *, case when p0 = '' or starts_with(p0, 't3_') then p0 else 't3_' || p0 end pid from nc0
""",
    "nc2": """
select *, coalesce(nullif(nullif("parentId", ''), '0'), nullif(nullif(parent_id, ''), '0'), nullif(nullif("replyToId", ''), '0'),
                   nullif(nullif("parentCommentId", ''), '0'), pid) par from nc1
""",
    "nc3": """
select *, case when par = '' or par[1:3] in ('t1_', 't3_') then par
               when 't3_' || par = pid then pid else 't1_' || par end pp from nc2
""",
    "nc": f"""
select case when starts_with(k, 't1_') then k else 't1_' || k end comment_id, pid post_id, pp parent_id,
       {clean('body')} body, coalesce("authorName", username, 'unknown') author,
       coalesce(try_cast(coalesce("upVotes", score) as bigint), 0) score,
       cast(case when coalesce(depth, "commentDepth") is null then case when pp = pid or starts_with(pp, 't3_') then 0 else 1 end
                 when regexp_full_match(trim(coalesce(depth, "commentDepth")), '[0-9]+') then cast(coalesce(depth, "commentDepth") as int)
                 else 0 end as int) depth,
       {_when('"createdAt"', None)} created_utc, {NUL_PAIR}, cast(load_no as bigint) batch_id
from nc3 where k is not null
""",
}
POST_COLS = "post_id, subreddit, title, body, author, score, url, {t} created_utc, num_comments, sentiment_score, sentiment_label, keywords, {b} batch_id"
COMMENT_COLS = "comment_id, post_id, parent_id, body, author, score, depth, {t} created_utc, sentiment_score, sentiment_label, keywords, {b} batch_id"


def _cols(cols: str, batch: str = "batch_id") -> str:
    return cols.format(t=iso("created_utc"), b=batch)


ZERO = "cast(0 as bigint)"
oracle("normalize_posts", f"select {_cols(POST_COLS, ZERO)} from np", "raw_posts_fx", **NORM_POSTS)
oracle("normalize_comments", f"select {_cols(COMMENT_COLS, ZERO)} from nc", "raw_comments_fx", **NORM_COMMENTS)
oracle(
    "rejects",
    "select 'post' kind, 'missing id' reason, body from raw_posts_fx "
    "where \"dataType\" = 'post' and id is null and \"parsedId\" is null union all "
    "select 'comment', 'missing id', body from raw_comments_fx "
    "where \"dataType\" = 'comment' and id is null and \"parsedId\" is null",
    "raw_posts_fx", "raw_comments_fx",
)
FIRST_POSTS = {
    **NORM_POSTS,
    "fp": """
select *, row_number() over (partition by post_id order by batch_id, created_utc, subreddit nulls first, title nulls first,
  body nulls first, author nulls first, score nulls first, url nulls first, num_comments nulls first) rn from np qualify rn = 1
""",
}
FIRST_COMMENTS = {
    **NORM_COMMENTS,
    "fc": """
select *, row_number() over (partition by comment_id order by batch_id, created_utc, post_id nulls first,
  parent_id nulls first, body nulls first, author nulls first, score nulls first, depth nulls first) rn from nc qualify rn = 1
""",
}
oracle("insert_ignore_posts", f"select {_cols(POST_COLS)} from fp where batch_id = 2", "raw_posts_fx", **FIRST_POSTS)
oracle("update_load_posts", f"select {_cols(POST_COLS)} from fp", "raw_posts_fx", **FIRST_POSTS)
oracle("update_load_comments", f"select {_cols(COMMENT_COLS)} from fc", "raw_comments_fx", **FIRST_COMMENTS)
oracle(
    "ingest_summary",
    "select (select count(*) from fp) posts_inserted, (select count(*) from fc) comments_inserted",
    "raw_posts_fx", "raw_comments_fx", **FIRST_POSTS, **FIRST_COMMENTS,
)
_ONE_LOAD = FIRST_COMMENTS["fc"].replace("order by batch_id, ", "order by ")
oracle(
    "fresh_load", f"select {_cols(COMMENT_COLS, 'cast(1 as bigint)')} from fc1", "raw_comments_fx",
    **NORM_COMMENTS, fc1=_ONE_LOAD,
)
oracle(
    "stream_load", "select distinct comment_id from nc union all select distinct post_id from np",
    "raw_posts_fx", "raw_comments_fx", **NORM_POSTS, **NORM_COMMENTS,
)
_KEPT = "select post_id from posts_fx order by created_utc desc, post_id limit 900"
oracle(
    "cap_per_post",
    """select comment_id, post_id, score from (
         select *, row_number() over (partition by post_id order by coalesce(score, 0) desc, comment_id) rn
         from comments_fx where post_id in (select post_id from kept)) where rn <= 50
       order by coalesce(score, 0) desc, comment_id limit 45000""",
    "posts_fx", "comments_fx", kept=_KEPT,
)
oracle(
    "cap_total",
    """select comment_id, post_id, score from comments_fx where depth <= 5 and post_id in (select post_id from kept)
       order by coalesce(score, 0) desc, comment_id limit 18000""",
    "posts_fx", "comments_fx", kept=_KEPT,
)

# ---- table maintenance ----

PAIR_NULLS = (
    "cast(0 as int) score_signal, 'unverified' match_type, 'unverified_best_effort' verification_status, "
    "cast(0.5 as double) confidence_score"
)
oracle("ensure_columns", f"select *, {NUL_PAIR}, {PAIR_NULLS} from documents")
oracle(
    "reclean_posts",
    "select post_id, ct title, nb body, (title is distinct from ct or body is distinct from nb) changed from s2",
    "posts_fx", s1=f"select *, {clean('title')} ct, {clean('body')} cb from posts_fx", s2=f"select *, {cut('cb')} nb from s1",
)
oracle("reclean_comments", "select comment_id, t body, body is distinct from t changed from c", "comments_fx", **TEXT)
oracle(
    "reclean_pairs",
    f"""select comment_id question_comment_id, parent_id answer_comment_id, t question, author answer, true changed from c""",
    "comments_fx", **TEXT,
)
oracle(
    "metadata_upsert",
    """select key, value from fresh union all
       select subreddit, cast(count(*) as varchar) from posts_fx where subreddit not in (select key from fresh) group by 1""",
    "posts_fx", "comments_fx",
    fresh="""select subreddit as key, cast(count(*) as varchar) as value from posts_fx where score > 60 group by 1
             union all select author, cast(count(*) as varchar) from comments_fx group by 1""",
)
oracle("iso_times", f"select event_id, {iso('ts')} ts_iso from events")
oracle(
    "apply_enrichment",
    """select f.comment_id, case when f.batch_id = 2 then a.sentiment_score else f.sentiment_score end sentiment_score,
              case when f.batch_id = 2 then a.sentiment_label else f.sentiment_label end sentiment_label,
              case when f.batch_id = 2 then a.keywords else f.keywords end keywords
       from comments_fx f join ana a on a.comment_id = f.comment_id""",
    "comments_fx", **COM_ANA,
)
BEST = {
    **CAND,
    "bestp": "select post_id, parent_id, arg_min(comment_id, lpad(cast(1000 - sc as varchar), 5, '0') || comment_id) aid from cand where not is_q group by 1, 2",
    "besta": "select post_id, arg_min(comment_id, lpad(cast(1000 - sc as varchar), 5, '0') || comment_id) aid from cand where not is_q group by 1",
}
_PAIRED = "select q.post_id, q.comment_id question_comment_id, b.aid answer_comment_id from cand q join {b} where q.is_q"
_DIRECT = _PAIRED.format(b="bestp b on b.post_id = q.post_id and b.parent_id = q.comment_id")
_SIBLING = _PAIRED.format(b="bestp b on b.post_id = q.post_id and b.parent_id = q.parent_id and q.parent_id <> '' and q.parent_id <> q.post_id")
_FALLBACK = _PAIRED.format(b="besta b on b.post_id = q.post_id")
oracle(
    "insert_pairs",
    f"""select x.*, {PAIR_NULLS} from (select distinct * from ({_DIRECT} union all {_FALLBACK})) x
        where not exists (select 1 from matches m where m.question_comment_id = x.question_comment_id
                          and m.answer_comment_id = x.answer_comment_id)""",
    "comments_fx", recursive=True, **GREEDY, **{k: BEST[k] for k in ("bestp", "besta")},
)

# ---- reads ----

oracle("post_ids", "select post_id from posts_fx", "posts_fx")
oracle("scan_posts", f"select {_cols(POST_COLS)} from posts_fx", "posts_fx")
oracle(
    "posts_by_ids", "select post_id, title, score from posts_fx where post_id in (select post_id from comments_fx)",
    "posts_fx", "comments_fx",
)
oracle(
    "posts_by_id_list",
    "select post_id, title, score from posts_fx where post_id in ('t3_0', 't3_7', 't3_150', 't3_none')", "posts_fx",
)
for _n in ("ranked_comments", "ranked_comments_hot"):
    oracle(
        _n,
        """select post_id, comment_id, score,
                  row_number() over (partition by post_id order by coalesce(score, 0) desc, comment_id) as rank from comments_fx""",
        "comments_fx",
    )
_COUNTS = """select 'posts' {k}, count(*) n from posts_fx union all select 'comments', count(*) from comments_fx
             union all select 'qa_pairs', count(*) from matches"""
oracle("table_counts", _COUNTS.format(k="table_name"), "posts_fx", "comments_fx", recursive=True, **GREEDY)
oracle("export_summary", _COUNTS.format(k="sheet"), "posts_fx", "comments_fx", recursive=True, **GREEDY)
_LATEST_P = "order by batch_id desc, posts_fx.created_utc desc, post_id desc limit 3"
_LATEST_C = "order by batch_id desc, comments_fx.created_utc desc, comment_id desc limit 3"
_LATEST_Q = """join posts_fx on posts_fx.post_id = pairs.post_id join c on c.comment_id = pairs.question_comment_id
    order by posts_fx.batch_id desc, posts_fx.created_utc desc, pairs.post_id desc, c.sc, pairs.question_comment_id desc limit 3"""
oracle("latest_posts", f"select {_cols(POST_COLS)} from posts_fx {_LATEST_P}", "posts_fx")
oracle("latest_comments", f"select {_cols(COMMENT_COLS)} from comments_fx {_LATEST_C}", "comments_fx")
oracle("latest_pairs", f"select pairs.* from pairs {_LATEST_Q}", "comments_fx", "posts_fx", recursive=True, **PAIRS)

# ---- threads and trees ----

oracle(
    "children",
    "select post_id, parent_id, sr sibling_rank, comment_id child from sib",
    "comments_fx", sib=TREE["sib"],
)
oracle("sibling_rank", "select post_id, parent_id, comment_id, sr sibling_rank from sib", "comments_fx", sib=TREE["sib"])
for _n in ("tree_depth", "tree_depth_hot"):
    oracle(
        _n,
        """select post_id, comment_id, thread_id, array_to_string(path, '.') path, cast(len(path) - 1 as int) depth from tree""",
        "comments_fx", recursive=True, **TREE,
    )
for _n in ("preorder", "preorder_hot"):
    oracle(
        _n, "select post_id, comment_id, row_number() over (partition by post_id order by path) preorder from tree",
        "comments_fx", recursive=True, **TREE,
    )
oracle(
    "thread_records",
    """select post_id, thread_id, row_number() over (partition by post_id, thread_id order by path) as position,
              comment_id, cast(len(path) - 1 as int) as depth from tree""",
    "comments_fx", recursive=True, **TREE,
)
oracle(
    "thread_documents",
    """select post_id, n as preorder, cast(d as int) as depth,
              case when n = 1 then '[' else '' end || left(js, length(js) - 1) || ',"replies":[' ||
              case when nxt is null then repeat(']}', d + 1) || ']'
                   when nxt <= d then repeat(']}', d - nxt + 1) || ',' else '' end as fragment from docs""",
    "comments_fx", recursive=True, **TREE,
    docs="""select t.post_id, len(t.path) - 1 d, row_number() over (partition by t.post_id order by t.path) n,
                   lead(len(t.path) - 1) over (partition by t.post_id order by t.path) nxt,
                   cast(to_json({'comment_id': c.comment_id, 'post_id': c.post_id, 'parent_id': c.parent_id, 'author': c.author,
                                 'body': c.body, 'score': c.score, 'depth': len(t.path) - 1}) as varchar) js
            from tree t join comments_fx c on c.comment_id = t.comment_id""",
)
oracle("root_counts", "select post_id, count(*) top_level from comments_fx where parent_id = post_id group by 1", "comments_fx")

# ---- question-answer pairing ----

oracle("valid_text", f"select comment_id, {valid('t')} is_valid from c", "comments_fx", **TEXT)
oracle("questions", f"select comment_id, {question('t')} is_question from c", "comments_fx", **TEXT)
oracle(
    "qa_candidates",
    """select post_id, comment_id, row_number() over (partition by post_id order by sc desc, comment_id) as rank,
              is_q is_question from cand""",
    "comments_fx", **CAND,
)
oracle(
    "to_comment",
    f"""select comment_id, post_id, parent_id, 'unknown' author, body, coalesce(score, 0) score, depth,
               {iso('created_utc')} created_utc from comments_fx""",
    "comments_fx",
)
oracle("direct_replies", _DIRECT, "comments_fx", **BEST)
oracle("sibling_replies", _SIBLING, "comments_fx", **BEST)
oracle("fallback_replies", _FALLBACK, "comments_fx", **BEST)
for _n in ("match_answers", "match_answers_hot"):
    oracle(_n, "select * from matches", "comments_fx", recursive=True, **GREEDY)
oracle("qa_pairs", "select * from pairs", "comments_fx", recursive=True, **PAIRS)
oracle(
    "qa_subset", "select * from pairs where post_id in (select post_id from posts_fx where score >= 30)",
    "comments_fx", "posts_fx", recursive=True, **PAIRS,
)
oracle(
    "qa_summary",
    "select (select count(*) from posts_fx) posts_processed, (select count(*) from matches) qa_pairs_generated",
    "comments_fx", "posts_fx", recursive=True, **GREEDY,
)

# ---- text enrichment ----

oracle("clean_pages", f"select page_id, {clean('html')} cleaned from pages")
_SENT = {k: DOC_ANA[k] for k in ("src", "tok", "hits", "sent")}
_CSENT = {k: COM_ANA[k] for k in ("src", "tok", "hits", "sent")}
oracle("lexicon_sentiment", "select id comment_id, score sentiment_score from sent", "comments_fx", **_CSENT)
oracle("lexicon_sentiment_documents", "select id doc_id, score sentiment_score from sent", **_SENT)
oracle(
    "sentiment_label",
    """select id comment_id, score sentiment_score,
              case when score >= 0.05 then 'positive' when score <= -0.05 then 'negative' else 'neutral' end sentiment_label
       from sent""",
    "comments_fx", **_CSENT,
)
_VALUES = ", ".join(f"({_q(w)}, cast({v} as decimal(18, 6)))" for w, v in VALENCES)
oracle(
    "valence_sentiment",
    """select id doc_id, round_even(x / sqrt(x * x + 15), 4) sentiment_score
       from (select s.id, cast(coalesce(sum(l.v), 0) as double) x
             from src s left join tok t on t.id = s.id left join lex l on l.w = t.w group by s.id)""",
    **{k: DOC_ANA[k] for k in ("src", "tok")}, lex=f"select * from (values {_VALUES}) v(w, v)",
)
oracle(
    "entities",
    """select s.id doc_id, coalesce(string_agg(e, '|' order by k), '') entities from src s left join ent e on e.id = s.id
       group by s.id""",
    **{k: DOC_ANA[k] for k in ("src", "piece", "mark", "near", "isle", "phrase", "ent")},
)
oracle(
    "top_keywords",
    "select s.id doc_id, coalesce(string_agg(w, ' ' order by k), '') top_words from src s left join topw t on t.id = s.id group by s.id",
    **{k: DOC_ANA[k] for k in ("src", "tok", "wc", "topw")},
)
oracle("keywords", "select doc_id, keywords from ana", **DOC_ANA)
oracle("analyze", "select * from ana", **DOC_ANA)
oracle("enrich_posts", "select * from ana", "posts_fx", **POST_ANA)
oracle("enrich_comments", "select * from ana", "comments_fx", **COM_ANA)
oracle(
    "enrich_summary",
    "select (select count(*) from posts_fx) posts_enriched, (select count(*) from comments_fx) comments_enriched",
    "posts_fx", "comments_fx",
)

# ---- reporting and export ----

_EN_POSTS = "posts_fx p join ana a on a.post_id = p.post_id"
_EN_COMMENTS = "comments_fx p join ana a on a.comment_id = p.comment_id"
oracle(
    "preview_posts",
    f"""select left(title, 70) title, p.post_id, subreddit, score, num_comments, a.sentiment_label, a.sentiment_score,
               left(a.keywords, 50) keywords from {_EN_POSTS}
        order by batch_id desc, created_utc desc, p.post_id desc limit 3""",
    "posts_fx", **POST_ANA,
)
oracle(
    "preview_comments",
    f"""select author, post_id, coalesce(parent_id, 'N/A') parent_id, coalesce(score, 0) score, depth, a.sentiment_label,
               a.sentiment_score, left(a.keywords, 50) keywords, left(body, 80) body from {_EN_COMMENTS}
        order by batch_id desc, created_utc desc, p.comment_id desc limit 3""",
    "comments_fx", **COM_ANA,
)
oracle(
    "preview_pairs",
    f"""select pairs.post_id, match_type, verification_status, confidence_score, left(question, 80) question, left(answer, 80) answer
        from pairs {_LATEST_Q}""",
    "comments_fx", "posts_fx", recursive=True, **PAIRS,
)


def _sheet(table: str, prefix: dict[str, str]) -> str:
    cells = []
    for col in SHEETS[table]:
        source = prefix.get(col, col)
        shown = f"strftime({source}, '%Y-%m-%d %H:%M:%S')" if col == "created_utc" else f"cast({source} as varchar)"
        cells.append(f"coalesce({shown}, '') \"{' '.join(w.capitalize() for w in col.split('_'))}\"")
    return ", ".join(cells)


_NLP = {c: f"a.{c}" for c in ("sentiment_label", "sentiment_score", "keywords")}
oracle("export_posts", f"select {_sheet('posts', {**_NLP, 'post_id': 'p.post_id'})} from {_EN_POSTS}", "posts_fx", **POST_ANA)
oracle(
    "export_comments", f"select {_sheet('comments', {**_NLP, 'comment_id': 'p.comment_id'})} from {_EN_COMMENTS}",
    "comments_fx", **COM_ANA,
)
oracle("export_pairs", f"select {_sheet('qa_pairs', {})} from pairs", "comments_fx", recursive=True, **PAIRS)
oracle(
    "export_files",
    "select comment_id, body, strftime(created_utc, '%Y-%m-%d %H:%M:%S') created from comments_fx", "comments_fx",
)
oracle(
    "format_cells",
    """select cast(event_id as varchar) event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') ts, cast(user_id as varchar) user_id,
              coalesce(event_type, '') event_type, coalesce(cast(value as varchar), '') as value, coalesce(props, '') props
       from events""",
)
oracle("flatten_struct", "select doc_id, source origin_name, n_chars origin_stats_n_chars, lang origin_stats_lang from documents")


def _widths(columns: dict[str, str], table: str) -> str:
    return " union all ".join(
        f"select '{c}' column_name, cast(least(greatest(coalesce(max(length({e})), 0) + 3, {len(c) + 3}, 12), 50) as int) width from {table}"
        for c, e in columns.items()
    )


_NUM = "case when {c} = 0 then '' else cast({c} as varchar) end"
oracle(
    "column_widths",
    _widths(
        {
            **{c: c for c in ("post_id", "subreddit", "title", "body", "author", "url", "sentiment_label", "keywords")},
            **{c: _NUM.format(c=c) for c in ("score", "num_comments", "batch_id", "sentiment_score")},
            "created_utc": "strftime(created_utc, '%Y-%m-%d %H:%M:%S')",
        },
        "posts_fx",
    ),
    "posts_fx",
)
oracle(
    "column_widths_orders",
    _widths(
        {
            **{c: _NUM.format(c=c) for c in ("o_orderkey", "o_custkey", "o_totalprice")},
            **{c: c for c in ("o_orderstatus", "o_orderpriority")},
            "o_orderdate": "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')",
        },
        "orders",
    ),
)
oracle(
    "export_latest",
    """select cast(row_number() over (order by orders.o_orderdate desc, orders.o_orderkey desc) as varchar) place, cast(o_orderkey as varchar) o_orderkey,
              cast(o_totalprice as varchar) o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') o_orderdate
       from orders order by orders.o_orderdate desc, orders.o_orderkey desc limit 12000""",
)
for _n in ("posts", "comments"):
    ORACLES[f"mixed_loads_{_n}"] = ORACLES[f"update_load_{_n}"]
ORACLES["parallel_loads"] = ORACLES["stream_load"]

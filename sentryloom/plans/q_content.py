"""Queries of content, similarity and graph operators, with their DuckDB SQL."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import aggregates as A
from ..operators import content as C
from ..operators import graph as G
from ..operators import nearest as N
from ..operators import pages as P
from ..operators import similarity as S
from ..sources.stand_ins import frame, sql_with
from ..tables import written

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def r(df, *cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def esc(word: str) -> str:
    return re.escape(word).replace("'", "''")


def count_sql(words, text="text"):
    """Each keyword on its own, one scan each: the plain meaning that the operator's grouped scan must equal."""
    return " + ".join(f"len(regexp_extract_all({text}, '(?i)\\b{esc(w)}\\b'))" for w in words)


ART = sql_with("articles")
SCORES = ", w AS (SELECT *, greatest(1.0, len(regexp_extract_all(text, '\\S+')) / 100) AS words FROM articles), sc AS (SELECT *, " + ", ".join(f"least(1.0, ({count_sql(words)}) / words * {w}) AS {c}" for c, (w, words) in C.SECURITY.items()) + " FROM w)"
TOTAL = "(" + " + ".join(C.SECURITY) + f") / {len(C.SECURITY)}"


@query(ART + SCORES + " SELECT doc_id, " + ", ".join(f"round({c}::DOUBLE, 6) AS {c}" for c in C.SECURITY) + f", round(({TOTAL})::DOUBLE, 6) AS security FROM sc")
def security_scores(spark, d):
    return r(C.security_scores(frame(spark, d, "articles"), "text"), *C.SECURITY, "security").select("doc_id", *C.SECURITY, "security")


def _clue_list(text="lower(text)"):
    return "flatten([" + ", ".join(f"regexp_extract_all({text}, '(?i){p.replace(chr(39), chr(39) * 2)}')" for p in C.CLUES) + "])"


DISTINCT = "list_filter({l}, lambda x, i: list_position({l}, x) = i)"
CLUES = f", c0 AS (SELECT *, list_filter(list_transform({_clue_list()}, lambda x: left(trim(x), 100)), lambda x: length(x) > 5) AS l FROM sc), c AS (SELECT *, list_slice({DISTINCT.format(l='l')}, 1, 10) AS clues FROM c0)"


@query(ART + SCORES + CLUES + " SELECT doc_id, array_to_string(clues, '|') AS clues FROM c")
def context_clues(spark, d):
    return frame(spark, d, "articles").select("doc_id", F.array_join(C.context_clues(F.col("text")), "|").alias("clues"))


ALL_OTHER = tuple(w for g in C.OTHER_SUBJECTS.values() for w in g)
ANALYSE = (
    ART + SCORES + CLUES
    + f", f AS (SELECT *, least(1.0, ({count_sql(ALL_OTHER)}) / greatest(1.0, len(regexp_extract_all(text, '\\S+')) / 50)) AS other, {count_sql(C.OTHER_SUBJECTS['api_docs'])} AS api, "
    + " + ".join(f"contains(lower(text), '{p}')::INT" for p in C.PHRASES)
    + f" AS phrases, regexp_matches(text, '(?i)CVE-[0-9]{{4}}-[0-9]{{4,7}}') AS cve, regexp_matches(text, '{C.ACTOR}') AS actor, regexp_matches(text, '\\b(?:[0-9]{{1,3}}\\.){{3}}[0-9]{{1,3}}\\b') OR regexp_matches(text, '\\b(?:[a-fA-F0-9]{{32}}|[a-fA-F0-9]{{40}}|[a-fA-F0-9]{{64}})\\b') AS mark FROM c)"
    + f", g0 AS (SELECT *, greatest(0, least(1, 0.3 * {TOTAL} + least(0.25, 0.05 * len(clues)) + least(0.15, 0.03 * phrases) + least(0.3, cve::INT * 0.15 + actor::INT * 0.15 + mark::INT * 0.1) - 0.5 * other))::DOUBLE AS rough FROM f), g AS (SELECT *, round(rough + 1e-9, 6) AS confidence FROM g0)"
    + ", k AS (SELECT *, CASE WHEN confidence >= 0.7 THEN 'security_threat' WHEN confidence >= 0.4 THEN CASE WHEN cve OR actor THEN 'security_advisory' WHEN security_tools > 0.5 THEN 'security_tools' ELSE 'potential_security' END WHEN confidence >= 0.2 THEN CASE WHEN other > 0.5 THEN 'mixed_content' ELSE 'unclear' END WHEN other > 0.6 THEN CASE WHEN api > 0 THEN 'api_documentation' ELSE 'business_content' END ELSE 'general_content' END AS content_type FROM g)"
)
DEPTH = "CASE WHEN confidence >= 0.7 AND (len(clues) >= 5 OR cve OR actor OR mark) THEN 'comprehensive' WHEN confidence >= 0.4 OR len(clues) >= 3 THEN 'detailed' ELSE 'basic' END"
ROUTE = "CASE WHEN content_type IN ('security_threat', 'security_advisory', 'potential_security') THEN 'advanced' WHEN content_type IN ('api_documentation', 'security_tools') THEN 'technical' WHEN content_type IN ('mixed_content', 'unclear') THEN 'hybrid' ELSE 'basic' END"


@query(ANALYSE + f" SELECT doc_id, confidence, content_type, {DEPTH} AS depth FROM k")
def analyze_content(spark, d):
    return C.analyze_content(frame(spark, d, "articles"), "text").select("doc_id", "confidence", "content_type", "depth")


@query(ANALYSE + f" SELECT route, content_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share, round(count(*) FILTER (lang IS NULL) / count(*), 6) AS error_rate FROM (SELECT content_type, lang, {ROUTE} AS route FROM k) GROUP BY 1, 2")
def route_enrichment(spark, d):
    return r(A.route_stats(C.analyze_content(frame(spark, d, "articles"), "text"), F.col("lang").isNull()), "share", "error_rate")


@query(ART + SCORES + ", e AS (" + " UNION ALL ".join(f"SELECT doc_id, '{c}' AS category, {c} AS score FROM sc" for c in C.SECURITY) + ") SELECT doc_id, category, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, category)::INT AS rank FROM e WHERE score > 0 QUALIFY rank <= 3")
def top_indicators(spark, d):
    return C.top_indicators(C.security_scores(frame(spark, d, "articles"), "text"), "doc_id").select("doc_id", "category", "rank")


ENT = ", x AS (" + " UNION ALL ".join(f"SELECT doc_id, '{k}' AS kind, unnest(regexp_extract_all(text, '{p.replace(chr(39), chr(39) * 2)}')) AS value FROM articles" for k, (p, _) in C.ENTITIES.items()) + "), y AS (SELECT doc_id, kind, CASE WHEN kind IN ('md5', 'sha1', 'sha256') THEN lower(value) WHEN kind = 'cve' THEN upper(value) ELSE value END AS value FROM x)"


@query(ART + ENT + " SELECT kind, value, count(*) AS n FROM y GROUP BY 1, 2")
def extract_entities(spark, d):
    return C.extract_entities(frame(spark, d, "articles"), "text").groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))


@query(ART + ENT + """, v AS (SELECT DISTINCT a.source, kind, value FROM y JOIN articles a USING (doc_id) WHERE kind IN ('ipv4', 'email', 'cve') AND (kind <> 'ipv4' OR regexp_matches(value, '^(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(\\.(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$')))
SELECT source, kind, count(*) AS indicators FROM v GROUP BY 1, 2""")
def flagship_indicators(spark, d):
    found = C.extract_entities(frame(spark, d, "articles"), "text", ("ipv4", "email", "cve")).filter(X.is_valid_indicator(F.col("value"), F.col("kind")))
    return found.select("source", "kind", "value").distinct().groupBy("source", "kind").agg(F.count(F.lit(1)).alias("indicators"))


SPANS = ", m AS (" + " UNION ALL ".join(f"SELECT doc_id, text, '{k}' AS kind, regexp_extract_all(text, '{p.replace(chr(39), chr(39) * 2)}') AS ms, regexp_split_to_array(text, '{p.replace(chr(39), chr(39) * 2)}') AS gaps FROM articles" for k, (p, _) in C.ENTITIES.items()) + """), p AS (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM m),
q AS (SELECT *, coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0) + CASE WHEN i > 1 THEN list_sum(list_transform(ms[1:i - 1], lambda x: length(x))) ELSE 0 END AS s FROM p)
SELECT doc_id, kind, CASE WHEN kind IN ('md5', 'sha1', 'sha256') THEN lower(ms[i]) WHEN kind = 'cve' THEN upper(ms[i]) ELSE ms[i] END AS value, s::INT AS char_start, (s + length(ms[i]))::INT AS char_end, text[greatest(s - 20, 0)::BIGINT + 1:(s + length(ms[i]) + 20)::BIGINT] AS context FROM q"""


@query(ART + SPANS)
def entity_spans(spark, d):
    return C.entity_spans(frame(spark, d, "articles"), "text").select("doc_id", "kind", "value", "char_start", "char_end", "context")


P_SQL = r"""WITH b AS (SELECT page_id, unnest([{'rank': 0, 'method': 'article', 'body': regexp_extract(html, '(?is)<article(?:\s[^>]*)?>(.*?)</article>', 1)}, {'rank': 1, 'method': 'main', 'body': regexp_extract(html, '(?is)<main(?:\s[^>]*)?>(.*?)</main>', 1)}, {'rank': 2, 'method': 'page', 'body': html}]) AS x FROM pages),
p AS (SELECT page_id, x.rank AS rank, x.method AS method, list_filter(list_transform(regexp_extract_all(x.body, '(?is)<p(?:\s[^>]*)?>(.*?)</p>', 1), lambda x: trim(regexp_replace(regexp_replace(x, '<[^>]+>', ' ', 'g'), '[ \t\n\r\f\x0B]+', ' ', 'g'))), lambda x: length(x) > 0) AS ps FROM b),
w AS (SELECT *, array_to_string(ps, chr(10) || chr(10)) AS text, len(regexp_extract_all(array_to_string(ps, chr(10) || chr(10)), '\S+')) AS words FROM p WHERE len(ps) > 0),
c AS (SELECT *, round(greatest(0.1, least(0.9, 0.5 - CASE WHEN words < 50 THEN 0.2 ELSE 0 END - CASE WHEN len(ps) < 3 THEN 0.1 ELSE 0 END - CASE WHEN words / greatest(len(ps), 1) < 10 THEN 0.1 ELSE 0 END + CASE WHEN method = 'article' THEN 0.2 ELSE 0 END))::DOUBLE, 6) AS confidence FROM w),
best AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY confidence DESC, rank) = 1),
every AS (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)(?:\s[^>]*)?>.*?</(script|style)>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '[ \t\n\r\f\x0B]+', ' ', 'g')) AS text FROM pages)
SELECT page_id, md5(coalesce(best.text, every.text)) AS text_md5, coalesce(len(ps), 0)::INT AS paragraphs, coalesce(words, len(regexp_extract_all(every.text, '\S+')))::INT AS words, coalesce(confidence, 0.1)::DOUBLE AS confidence, coalesce(method, 'all') AS method FROM every LEFT JOIN best USING (page_id)"""


@query(P_SQL)
def article_text(spark, d):
    out = C.article_text(frame(spark, d, "pages"))
    return out.select("page_id", F.md5("text").alias("text_md5"), "paragraphs", "words", F.round("confidence", 6).alias("confidence"), "method")


@query()
def parse_pages(spark, d):
    return C.parse_pages(frame(spark, d, "pages"))


# Pages of the table have few meta tags: some are put in front, in either order of attributes and either quotes.
HEAD_ROWS = r"""SELECT page_id, coalesce(nullif(trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]*>', ' ', 'g'), '[ \t\n\r\f\x0B]+', ' ', 'g')), ''), trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<h[1-6][^>]*>.*?</h[1-6]>', 0), '<[^>]*>', ' ', 'g'), '[ \t\n\r\f\x0B]+', ' ', 'g'))) AS title,
CASE WHEN page_id % 3 <> 0 THEN 'about ' || page_id END AS description, CASE WHEN page_id % 2 = 0 THEN 'it''s ' || page_id END AS og_title, CASE WHEN page_id % 5 <> 0 THEN url END AS canonical_url, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS language, least(len(regexp_extract_all(html, '(?is)<h[1-6][^>]*>.*?</h[1-6]>')), 10)::INT AS n_headings, CASE WHEN page_id % 4 = 0 THEN 1 ELSE 0 END::INT AS n_images FROM pages"""


@query(HEAD_ROWS)
def page_metadata(spark, d):
    i = F.col("page_id")
    tag = lambda when, *parts: F.when(when, F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])).otherwise("")
    head = F.concat(
        tag(i % 3 != 0, '<meta name="description" content="about ', i, '">'), tag(i % 2 == 0, "<META content=\"it's ", i, "\" property='og:title'>"),
        tag(i % 5 != 0, "<link href='", F.col("url"), "' rel=canonical>"), tag(i % 4 == 0, '<img alt="" src="/i.png"><img alt="no source">'), F.lit("<head>"))
    pages = frame(spark, d, "pages").withColumn("html", F.replace("html", F.lit("<head>"), head))
    return C.page_metadata(pages).select("page_id", "title", "description", "og_title", "canonical_url", "language", F.size("headings").alias("n_headings"), F.size("images").alias("n_images"))


# The links of the table lead to the page's own host: each page gets one link of another kind at its end.
LINKS = r"""WITH x AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/?#]*') AS root, html || CASE page_id % 5 WHEN 0 THEN '<a href="https://other.example.org/x">far</a>' WHEN 1 THEN '<a class=c href="//other.example.org/y">near</a>' WHEN 2 THEN '<a href="z/w">deep <b>down</b></a>' WHEN 3 THEN '<a href="mailto:x@y">mail</a>' ELSE '<a href="#top">up</a>' END AS html FROM pages),
a AS (SELECT page_id, url, root, unnest(l) AS tag, generate_subscripts(l, 1) - 1 AS position FROM (SELECT *, regexp_extract_all(html, '(?is)<a\s[^>]*>.*?</a>') AS l FROM x)),
h AS (SELECT *, regexp_extract(regexp_extract(tag, '(?s)^<[^>]*>'), '(?i)\shref="([^"]*)"', 1) AS href FROM a)
SELECT page_id, position::INT AS position, trim(regexp_replace(regexp_replace(tag, '<[^>]*>', ' ', 'g'), '[ \t\n\r\f\x0B]+', ' ', 'g')) AS link_text,
CASE WHEN href LIKE 'https:%' OR href LIKE 'http:%' OR href LIKE 'mailto:%' THEN href WHEN href LIKE '//%' THEN regexp_extract(url, '^[a-z]+:') || href WHEN href LIKE '/%' THEN root || href WHEN href LIKE '#%' THEN regexp_extract(url, '^[^#]*') || href
  ELSE root || coalesce(nullif(regexp_extract(url[length(root) + 1:], '^/([^?#]*/)?'), ''), '/') || href END AS link_url,
href LIKE '%other.example.org%' OR href LIKE 'mailto:%' OR (regexp_matches(href, '^https?://') AND regexp_extract(href, '^[a-z]+://[^/?#]*') <> root) AS is_external
FROM h WHERE href <> ''"""


@query(LINKS)
def page_links(spark, d):
    i = F.col("page_id") % 5
    tail = F.when(i == 0, '<a href="https://other.example.org/x">far</a>').when(i == 1, '<a class=c href="//other.example.org/y">near</a>').when(i == 2, '<a href="z/w">deep <b>down</b></a>').when(i == 3, '<a href="mailto:x@y">mail</a>').otherwise('<a href="#top">up</a>')
    pages = frame(spark, d, "pages").withColumn("html", F.concat("html", tail))
    return C.page_links(pages).select("page_id", "position", "link_text", "link_url", "is_external")


# Sections that SQL can derive as well: the lines of a document, of which short ones are headlines.
SECTIONS = "WITH l AS (SELECT doc_id AS page_id, unnest(string_split(text, chr(10))) AS content, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS position FROM documents), s AS (SELECT *, CASE WHEN length(content) < 80 THEN 'headline' WHEN length(content) < 120 THEN 'quote' WHEN length(content) < 160 THEN 'list' ELSE 'paragraph' END AS kind FROM l) "


def _sections(spark, d):
    rows = frame(spark, d, "documents").select(F.col("doc_id").alias("page_id"), F.posexplode(F.split("text", "\n")).alias("position", "content"))
    n = F.length("content")
    return rows.withColumn("kind", F.when(n < 80, "headline").when(n < 120, "quote").when(n < 160, "list").otherwise("paragraph"))


@query(SECTIONS + "SELECT page_id, position::INT AS position, last_value(CASE WHEN kind = 'headline' THEN content END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS under FROM s")
def page_outline(spark, d):
    return C.page_outline(_sections(spark, d)).select("page_id", "position", "under")


STATS = """, t AS (SELECT page_id, count(*) AS sections, sum(len(regexp_extract_all(content, '\\S+')))::BIGINT AS words, count(*) FILTER (kind = 'headline') AS nh, count(*) FILTER (kind = 'paragraph') AS np, count(*) FILTER (kind = 'list') AS nl, count(*) FILTER (kind = 'quote') AS nq FROM s GROUP BY 1),
u AS (SELECT *, ((nh > 0)::INT * 40 + (np > 0)::INT * 10 + (nl > 0)::INT * 10 + (nq > 0)::INT * 10 + (words > 100)::INT * 20 + (words > 500)::INT * 20 + (nl + nq > 0)::INT * 20)::INT AS points FROM t)
SELECT page_id, sections, words, round((0.3 * nh + 0.4 * np + 0.2 * nl + 0.1 * nq) / sections, 6) AS density, points, CASE WHEN points >= 80 THEN 'excellent' WHEN points >= 60 THEN 'good' WHEN points >= 40 THEN 'fair' ELSE 'poor' END AS band FROM u"""


@query(SECTIONS + STATS)
def page_stats(spark, d):
    return r(C.page_stats(_sections(spark, d)).select("page_id", "sections", "words", "density", "points", "band"), "density")


@query(SECTIONS + ", h AS (SELECT page_id, lower(content) AS topic, min(position) AS p FROM s WHERE kind = 'headline' GROUP BY 1, 2) SELECT page_id, topic, row_number() OVER (PARTITION BY page_id ORDER BY p)::INT AS rank FROM h QUALIFY rank <= 10")
def page_topics(spark, d):
    return C.page_topics(_sections(spark, d)).select("page_id", "topic", "rank")


@query(SECTIONS + "SELECT page_id, position::INT AS position, coalesce(array_to_string(list(content) OVER (PARTITION BY page_id ORDER BY position ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), '|'), '') AS before, coalesce(array_to_string(list(content) OVER (PARTITION BY page_id ORDER BY position ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING), '|'), '') AS after FROM s")
def section_context(spark, d):
    return C.section_context(_sections(spark, d)).select("page_id", "position", F.array_join("before", "|").alias("before"), F.array_join("after", "|").alias("after"))


# Pages of the table with their main part in five kinds of containers, and with emphasis, a list, a quote and code after the headline.
MORE = "'</h1><p>on <em>Topic ' || page_id % 7 || '</em> and <b>phrases of four words</b></p><ul><li>one<li>two ' || page_id % 3 || '</ul><blockquote>said  so</blockquote><pre>x  y</pre>'"
TREES = rf"""WITH a AS (SELECT page_id, html, regexp_extract(replace(html, '</h1>', {MORE}), '(?s)<article>(.*?)(</article>|$)', 1) AS body FROM pages),
b AS (SELECT page_id, unnest(string_split(regexp_replace(body, '<(h1|p|ul|blockquote|pre)>', chr(1) || '\1>', 'g'), chr(1))) AS piece, generate_subscripts(string_split(regexp_replace(body, '<(h1|p|ul|blockquote|pre)>', chr(1) || '\1>', 'g'), chr(1)), 1) AS i FROM a),
r AS (SELECT page_id, i, regexp_extract(piece, '^(h1|p|ul|blockquote|pre)>', 1) AS tag, regexp_replace(regexp_extract(piece, '(?s)^[a-z0-9]+>(.*?)(</(h1|p|ul|blockquote|pre)>|$)', 1), '<br>', ' ', 'g') AS raw FROM b WHERE regexp_matches(piece, '^(h1|p|ul|blockquote|pre)>')),
t AS (SELECT *, {{text}} AS plain, list_filter(list_transform(regexp_extract_all(raw, '(?s)<(em|b)>(.*?)(</(em|b)>|$)', 2), lambda x: {{phrase}}), lambda x: x <> '') AS emphasised FROM r),
s AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i)::INT - 1 AS position, CASE tag WHEN 'h1' THEN 'headline' WHEN 'p' THEN 'paragraph' WHEN 'ul' THEN 'list' WHEN 'blockquote' THEN 'quote' ELSE 'code' END AS kind,
  CASE tag WHEN 'ul' THEN '• one' || chr(10) || '• two ' || page_id % 3 WHEN 'blockquote' THEN '"' || plain || '"' WHEN 'pre' THEN '```' || chr(10) || raw || chr(10) || '```' ELSE plain END AS content, CASE WHEN tag = 'ul' THEN 3 ELSE len(regexp_extract_all(plain, '\S+')) END::INT AS words, emphasised FROM t WHERE plain <> '') """
_PLAIN = r"trim(regexp_replace(replace(replace(replace(regexp_replace({}, '<[^>]*>', '', 'g'), '&quot;', chr(34)), '&amp;', '&'), '&amp', '&'), '[ \t\n\r\f\x0B]+', ' ', 'g'))"
TREES = TREES.format(text=_PLAIN.format("raw"), phrase=_PLAIN.format("x"))


def _trees(spark, d):
    i = F.col("page_id")
    more = F.concat(F.lit("</h1><p>on <em>Topic "), i % 7, F.lit("</em> and <b>phrases of four words</b></p><ul><li>one<li>two "), i % 3, F.lit("</ul><blockquote>said  so</blockquote><pre>x  y</pre>"))
    first = F.when(i % 5 == 0, "<article>").when(i % 5 == 1, "<main>").when(i % 5 == 2, "<div role=main>").when(i % 5 == 3, "<section class='Blog-Post'>").otherwise("<section>")
    last = F.when(i % 5 == 0, "</article>").when(i % 5 == 1, "</main>").when(i % 5 == 2, "</div>").otherwise("</section>")
    html = F.replace(F.replace(F.replace("html", F.lit("</h1>"), more), F.lit("<article>"), first), F.lit("</article>"), last)
    return P.page_tree(frame(spark, d, "pages").select("page_id", html.alias("html")))


@query(TREES + "SELECT page_id, position, kind, (kind = 'headline')::INT AS level, content, words, array_to_string(emphasised, '|') AS emphasised FROM s")
def page_sections(spark, d):
    return P.page_sections(_trees(spark, d)).withColumn("emphasised", F.array_join("emphasised", "|"))


@query(TREES + r"""SELECT a.page_id, """ + _PLAIN.format("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)") + r""" AS title, CASE a.page_id % 5 WHEN 0 THEN 'article' WHEN 1 THEN 'main' WHEN 2 THEN 'role' WHEN 3 THEN 'class post' ELSE CASE WHEN length(trim(replace(replace(replace(regexp_replace(replace(body, '<br>', chr(10)), '<[^>]*>', '', 'g'), '&quot;', chr(34)), '&amp;', '&'), '&amp', '&'), ' ' || chr(10))) > 200 THEN 'most text' END END AS how, count(*)::INT AS sections, sum(words)::BIGINT AS words,
md5(trim(string_agg(CASE WHEN kind = 'headline' THEN chr(10) || content || chr(10) ELSE content END, chr(10) || chr(10) ORDER BY position), ' ' || chr(10))) AS text_md5 FROM a JOIN s USING (page_id) GROUP BY a.page_id, html, body""")
def page_text(spark, d):
    return P.page_text(_trees(spark, d)).withColumn("text_md5", F.md5("raw_text")).drop("raw_text")


@query(TREES + """, e AS (SELECT page_id, position, 0 AS i, content AS topic FROM s WHERE kind = 'headline' UNION ALL SELECT page_id, position, unnest(range(1, len(emphasised) + 1)), unnest(emphasised) FROM s),
f AS (SELECT page_id, lower(topic) AS topic, min(position * 100000 + i) AS seat FROM e WHERE i = 0 OR len(regexp_extract_all(topic, '\\S+')) <= 3 GROUP BY 1, 2)
SELECT page_id, topic, row_number() OVER (PARTITION BY page_id ORDER BY seat)::INT AS rank FROM f QUALIFY rank <= 10""")
def page_key_topics(spark, d):
    return C.page_topics(P.page_sections(_trees(spark, d))).select("page_id", "topic", "rank")


FEEDS = "SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS root, CASE page_id % 4 WHEN 0 THEN '/feed.xml' WHEN 1 THEN 'https://f.example.org/rss' WHEN 2 THEN 'my-feed' END AS link FROM pages"


@query(f"SELECT page_id, CASE WHEN link LIKE 'https%' THEN link WHEN link LIKE '/%' THEN root || link ELSE root || '/' || link END AS feed_url FROM ({FEEDS}) WHERE link IS NOT NULL")
def find_feed_links(spark, d):
    i = F.col("page_id") % 4
    tag = F.when(i == 0, '<a href="/feed.xml">').when(i == 1, '<link rel="alternate" type="application/rss+xml" href="https://f.example.org/rss">').when(i == 2, '<a href="my-feed">').otherwise("")
    pages = frame(spark, d, "pages").select("page_id", "url", F.concat(F.regexp_replace("html", "href", "ref"), tag).alias("html"))
    return C.find_feed_links(pages, "html", "url").select("page_id", "feed_url")


@query("WITH s AS (SELECT DISTINCT regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS site FROM pages), p AS (SELECT unnest([" + ", ".join(f"'{p}'" for p in C.FEED_PATHS + C.TAXII_PATHS) + "]) AS path) SELECT site, site || path AS feed_url, CASE WHEN path LIKE '%taxii%' THEN 'taxii_discovery' ELSE 'common_paths' END AS method FROM s, p")
def discover_feed_candidates(spark, d):
    return C.discover_feed_candidates(frame(spark, d, "pages"), "url").select("site", "feed_url", "method")


@query("WITH w AS (SELECT user_id, event_id, CASE WHEN event_id % 7 = 0 THEN 0.5 ELSE value / 500 END AS w FROM events), t AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY w DESC, event_id)::INT AS rank FROM w QUALIFY rank <= 10) SELECT user_id, event_id, rank, round(w / max(w) OVER (PARTITION BY user_id), 6) AS attention FROM t")
def attention_normalize(spark, d):
    rows = frame(spark, d, "events").withColumn("weight", F.when(F.col("event_id") % 7 != 0, F.col("value") / 500))
    return r(C.attention_normalize(rows, "user_id", "event_id", "weight"), "attention")


LANG = """WITH t AS (SELECT doc_id, lang, string_split(lower(text), '') AS x FROM documents WHERE length(text) >= 3), g AS (SELECT doc_id, lang, unnest(list_transform(range(1, len(x) - 1), lambda i: x[i] || x[i + 1] || x[i + 2])) AS gram FROM t),
m AS (SELECT lang, gram, count(*) AS n FROM g WHERE lang IS NOT NULL GROUP BY 1, 2), tot AS (SELECT lang, sum(n) AS total FROM m GROUP BY 1), q AS (SELECT doc_id, gram, count(*) AS n FROM g GROUP BY 1, 2), qs AS (SELECT doc_id, sum(n) AS n FROM q GROUP BY 1),
s AS (SELECT q.doc_id, m.lang, sum(q.n * (ln((m.n + 1) / (total + 100000)) - ln(1 / (total + 100000)))) AS gain FROM q JOIN m USING (gram) JOIN tot ON tot.lang = m.lang GROUP BY 1, 2),
b AS (SELECT doc_id, arg_max(s.lang, gain + qs.n * ln(1 / (total + 100000))) AS detected FROM s JOIN qs USING (doc_id) JOIN tot ON tot.lang = s.lang GROUP BY 1)
SELECT d.doc_id, coalesce(detected, 'unknown') AS detected FROM documents d LEFT JOIN b USING (doc_id)"""


@query(LANG)
def detect_language(spark, d):
    docs = frame(spark, d, "documents")
    model = written(C.fit_language(docs, "text", "lang"))
    return C.detect_language(docs, model, "doc_id", "text", "lang")


# Similarity -----------------------------------------------------------------

SIM = r"""WITH w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[ \t\n\r\f\x0B]+'), lambda x: length(x) > 2)) AS w FROM documents), c AS (SELECT doc_id, w, count(*) AS n FROM w GROUP BY 1, 2),
h AS (SELECT doc_id, n, ('0x' || substr(md5(w), 1, 8))::BIGINT AS hi, ('0x' || substr(md5(w), 9, 8))::BIGINT AS lo FROM c),
v AS (SELECT doc_id, i, sum(CASE WHEN ((CASE WHEN i >= 32 THEN hi ELSE lo END) >> (i % 32)) & 1 = 1 THEN n ELSE -n END) AS vote FROM h, unnest(range(64)) AS u(i) GROUP BY 1, 2)
SELECT doc_id, string_agg(CASE WHEN vote > 0 THEN '1' ELSE '0' END, '' ORDER BY i DESC) AS bits FROM v GROUP BY 1 UNION ALL SELECT doc_id, repeat('0', 64) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM w)"""


@query(SIM)
def simhash(spark, d):
    return S.simhash(frame(spark, d, "documents"), "doc_id", "text").select("doc_id", F.lpad(F.conv(F.hex("simhash"), 16, 2), 64, "0").alias("bits"))


@query()
def minhash(spark, d):
    return S.minhash(frame(spark, d, "documents"), "doc_id", "text")


def _fingerprints(spark, d):
    one = S.one_of_each(frame(spark, d, "documents"), "doc_id", "text")
    return S.minhash(one, "doc_id", "text").join(S.simhash(one, "doc_id", "text"), "doc_id")


@query()
def similar_pairs(spark, d):
    """Pairs of different texts, each by its smallest id, and every exact copy with that id."""
    same = S.copies(frame(spark, d, "documents"), "doc_id", "text").withColumn("score", F.lit(1.0))
    return S.similar_pairs(written(_fingerprints(spark, d)), "doc_id", 0.8).unionByName(same)


@query()
def exact_similar_pairs(spark, d):
    """The same pairs without chance: classes of equal fingerprints by their smallest id, and every other member with that id."""
    prints = written(_fingerprints(spark, d))
    classes = S.fingerprint_classes(prints, "doc_id")
    copies = S.copies(frame(spark, d, "documents"), "doc_id", "text").join(classes.withColumnRenamed("doc_id", "a"), "a").select(F.col("class_id").alias("a"), "b")
    members = classes.filter("class_id < doc_id").select(F.col("class_id").alias("a"), F.col("doc_id").alias("b"))
    return S.exact_similar_pairs(prints, "doc_id", 0.8).unionByName(members.unionByName(copies).withColumn("score", F.lit(1.0)))


# Buckets by slots that SQL can name: four levels of each coordinate of a vector.
@query("WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: floor(4 * x)::INT) AS g FROM embeddings) SELECT vec_id, b::INT AS band, md5(array_to_string(g[b * (len(g) // 16) + 1:(b + 1) * (len(g) // 16)], ',')) AS bucket FROM s, unnest(range(16)) AS u(b)")
def lsh_buckets(spark, d):
    signature = F.transform("embedding", lambda x: F.floor(4 * x.cast("double")).cast("int"))
    return S.lsh_buckets(frame(spark, d, "embeddings").select("vec_id", signature.alias("signature")), "vec_id")


BLOCKS = SIM + ") , bl AS (SELECT doc_id, b::INT AS band, printf('%X', list_sum(list_transform(range(16), lambda i: CASE WHEN bits[(3 - b) * 16 + i::INT + 1] = '1' THEN 1 << (15 - i::INT) ELSE 0 END))::BIGINT) AS bucket FROM fp, unnest(range(4)) AS u(b) WHERE contains(bits, '1')) "
BLOCKS = BLOCKS.replace("SELECT doc_id, string_agg(CASE WHEN vote", ", fp AS (SELECT doc_id, string_agg(CASE WHEN vote", 1)


@query(BLOCKS + "SELECT doc_id, band, bucket FROM bl")
def simhash_buckets(spark, d):
    return S.simhash_buckets(S.simhash(frame(spark, d, "documents"), "doc_id", "text"), "doc_id")


@query(BLOCKS + "SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM (SELECT * FROM bl WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY md5(text))) x JOIN (SELECT * FROM bl WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY md5(text))) y ON x.band = y.band AND x.bucket = y.bucket AND x.doc_id < y.doc_id")
def candidate_pairs(spark, d):
    """Pairs of different texts that share a block of their SimHash."""
    one = S.one_of_each(frame(spark, d, "documents"), "doc_id", "text")
    return S.candidate_pairs(S.simhash_buckets(S.simhash(one, "doc_id", "text"), "doc_id"), "doc_id")


@query()
def similarity_stats(spark, d):
    return S.similarity_stats(_fingerprints(spark, d), "doc_id")


@query(r"""WITH t AS (SELECT min(doc_id) AS k, text FROM documents GROUP BY md5(text), text), w AS (SELECT k, regexp_split_to_array(trim(lower(text)), '[ \t\n\r\f\x0B]+') AS ws FROM t),
s AS (SELECT DISTINCT k, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) ELSE [array_to_string(ws, ' ')] END) AS g FROM w), n AS (SELECT k, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.k AS a, b.k AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.k < b.k GROUP BY 1, 2)
SELECT a, b, round(i / (x.n + y.n - i), 6) AS jaccard FROM p JOIN n x ON x.k = a JOIN n y ON y.k = b WHERE i / (x.n + y.n - i) >= 0.75""")
def exact_jaccard_pairs(spark, d):
    return r(S.exact_jaccard_pairs(frame(spark, d, "documents"), "doc_id", "text", 0.75), "jaccard")


def _bloom(rows):
    """A filter of the rows' URLs, sized for as many as are distinct, with its bits and hash functions."""
    m, k = S.bloom_size(max(1, rows.agg(F.count_distinct("url")).first()[0]), 0.01)
    return S.bloom_build(rows, "url", m, k), m, k


# A false positive is a matter of the hash, so SQL can only say what has to be there: every member, and few of the others.
@query("SELECT count(*) FILTER (page_id % 2 = 0) AS members, count(*) FILTER (page_id % 2 = 0) AS found, true AS few_others FROM pages")
def bloom_contains(spark, d):
    """All pages asked of a filter of the even ones: members, members found, and whether others are found no more often than 5 in 100."""
    p = frame(spark, d, "pages")
    even = F.col("page_id") % 2 == 0
    bloom, m, k = _bloom(p.filter(even))
    asked = S.bloom_contains(p, bloom, "url", "page_id", m, k)
    return asked.agg(F.count_if(even).alias("members"), F.count_if(even & F.col("maybe")).alias("found"), (F.count_if(~even & F.col("maybe")) <= 0.05 * F.count_if(~even) + 2).alias("few_others"))


@query()
def knn_by_lists(spark, d):
    """Approximate; ``tests/test_nearest.py`` measures its recall."""
    e = frame(spark, d, "embeddings")
    return r(N.knn_by_lists(e.filter("vec_id % 20 = 0"), e, 5), "cosine")


@query()
def bloom_probe(spark, d):
    """All pages asked of a filter of the even ones."""
    p = frame(spark, d, "pages")
    bloom, m, k = _bloom(p.filter("page_id % 2 = 0"))
    return S.bloom_contains(p, bloom, "url", "page_id", m, k).select("page_id", "maybe")


@query()
def bloom_stats(spark, d):
    return S.bloom_stats(*_bloom(frame(spark, d, "pages")))


# Graph ----------------------------------------------------------------------

GRAPH = sql_with("nodes", "edges")
BOTH = GRAPH.replace("WITH ", "WITH RECURSIVE ", 1) + ", u AS (SELECT source_id AS a, target_id AS b FROM edges UNION SELECT target_id, source_id FROM edges)"


@query(BOTH + ", k(origin, id, hops) AS (SELECT id, id, 0 FROM nodes WHERE label = 'Malware' AND name < 'C' UNION SELECT origin, b, hops + 1 FROM k JOIN u ON a = k.id WHERE hops < 2) SELECT origin, id, min(hops)::INT AS hops FROM k GROUP BY 1, 2")
def neighbors(spark, d):
    start = frame(spark, d, "nodes").filter("label = 'Malware' AND name < 'C'")
    return G.neighbors(frame(spark, d, "edges"), start, 2)


@query(BOTH + ", k(id, hops) AS (SELECT 'malware:1', 0 UNION SELECT b, hops + 1 FROM k JOIN u ON a = k.id WHERE hops < 4) SELECT min(hops)::INT AS length FROM k WHERE id = 'malware:2' HAVING count(*) > 0")
def shortest_path(spark, d):
    return G.shortest_path(frame(spark, d, "edges"), "malware:1", "malware:2", 4).select((F.size("path") - 1).alias("length"))


@query(GRAPH + "SELECT e.type, n.label, count(*) AS n FROM edges e JOIN nodes n ON n.id = e.target_id WHERE e.type = 'USES' GROUP BY 1, 2")
def graph_query(spark, d):
    text = "SELECT e.type, n.label, count(*) AS n FROM {edges} e JOIN {nodes} n ON n.id = e.target_id WHERE e.type = :kind GROUP BY 1, 2"
    return G.graph_query(spark, text, frame(spark, d, "nodes"), frame(spark, d, "edges"), kind="USES")


@query(GRAPH + "SELECT c.target_id AS malware, count(*) AS chains FROM edges a JOIN edges c ON c.source_id = a.target_id WHERE a.type = 'INDICATES' AND c.type = 'USES' GROUP BY 1")
def match_path(spark, d):
    chains = G.match_path(frame(spark, d, "nodes"), frame(spark, d, "edges"), ["Indicator", "ThreatActor", "Malware"], ["INDICATES", "USES"])
    return chains.groupBy(F.col("n2").alias("malware")).agg(F.count(F.lit(1)).alias("chains"))


@query("WITH m AS (SELECT DISTINCT l_orderkey AS article, l_partkey AS indicator FROM lineitem) SELECT a.article AS a, b.article AS b, count(*) AS shared FROM m a JOIN m b ON a.indicator = b.indicator AND a.article < b.article GROUP BY 1, 2")
def indicator_cooccurrence(spark, d):
    m = frame(spark, d, "lineitem").select(F.col("l_orderkey").alias("article"), F.col("l_partkey").alias("indicator")).distinct()
    return G.indicator_cooccurrence(m, "article", "indicator")


@query("WITH a AS (SELECT url, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS d, page_id FROM pages) SELECT 'source:' || d AS id, 'Source' AS label FROM a UNION ALL SELECT 'event:' || d || ':' || substr(md5(url || '|' || 't' || page_id), 1, 8), 'SightingEvent' FROM a UNION ALL SELECT 'article:' || d || ':' || substr(md5(url), 1, 8), 'Article' FROM a")
def articles_to_changeset(spark, d):
    rows = frame(spark, d, "pages").select(F.col("url").alias("source_url"), F.concat(F.lit("t"), "page_id").alias("retrieved_at"), F.lit("").alias("title"), F.col("html").alias("full_text"))
    return G.articles_to_changeset(rows)[0].select("id", "label")


@query(sql_with("indicators") + "SELECT CASE WHEN event_id % 10 = 0 THEN 'threat_actor:apt' || (user_id % 40) ELSE 'indicator:' || type || ':' || substr(md5(value), 1, 8) END AS source_id, 'misp_event:' || substr(md5('https://misp/f' || (user_id % 3)), 1, 8) || ':t' AS target_id, 'APPEARED_IN' AS type FROM indicators")
def iocs_to_changeset(spark, d):
    i = frame(spark, d, "indicators").withColumn("user", F.regexp_extract("value", "x", 0))
    e = frame(spark, d, "events").select("event_id", "user_id")
    rows = i.join(e, "event_id").select(F.concat(F.lit("https://misp/f"), F.col("user_id") % 3).alias("feed_url"), F.lit("t").alias("fetched_at"), F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("APT"), F.col("user_id") % 40)).otherwise(F.col("value")).alias("value"), "type")
    return G.iocs_to_changeset(rows)[1]


ORACLE_SQL["iocs_to_changeset"] = ORACLE_SQL["iocs_to_changeset"].replace("FROM indicators", "FROM indicators JOIN (SELECT event_id, user_id FROM events) USING (event_id)").replace("FROM events JOIN (SELECT event_id, user_id FROM events) USING (event_id)", "FROM events")


@query("SELECT CASE doc_id % 3 WHEN 0 THEN 'malware:' || source || ':' || left(substr(md5(doc_id::VARCHAR), 1, 12), 8) ELSE 'x-custom-thing:' || left(substr(md5(doc_id::VARCHAR), 1, 12), 8) END AS id, CASE doc_id % 3 WHEN 0 THEN 'Malware' ELSE 'XCustomThing' END AS label FROM documents WHERE doc_id % 3 < 2")
def stix_to_changeset(spark, d):
    i = F.col("doc_id")
    kind = F.when(i % 3 == 0, "malware").when(i % 3 == 1, "x-custom-thing").otherwise("relationship")
    tail = F.substring(F.md5(i.cast("string")), 1, 12)
    rows = frame(spark, d, "documents").select(F.concat(kind, F.lit("--"), tail).alias("id"), kind.alias("type"), F.when(i % 3 == 0, F.col("source")).alias("name"), F.lit("a").alias("source_ref"), F.lit("b").alias("target_ref"), F.lit("uses").alias("relationship_type"))
    return G.stix_to_changeset(rows)[0].select("id", "label")


@query("WITH e AS (SELECT doc_id, 'https://' || source || '.example.com/' || doc_id AS url, unnest([{'k': 'ip', 'v': '10.0.0.' || (doc_id % 250)}, {'k': 'cve', 'v': 'CVE-2024-' || (1000 + doc_id % 90)}]) AS x, source FROM documents) SELECT 'article:' || source || '.example.com:' || substr(md5(url), 1, 8) AS source_id, x.k || ':' || substr(md5(x.v), 1, 12) AS target_id, 'MENTIONS' AS type FROM e")
def intel_to_changeset(spark, d):
    i = F.col("doc_id")
    rows = frame(spark, d, "documents").select(F.concat(F.lit("https://"), "source", F.lit(".example.com/"), i).alias("url"), F.lit("").alias("title"), F.create_map(F.lit("ip"), F.array(F.concat(F.lit("10.0.0."), i % 250)), F.lit("cve"), F.array(F.concat(F.lit("CVE-2024-"), i % 90 + 1000), F.lit(""))).alias("entities"))
    return G.intel_to_changeset(rows)[1]


# One record a document, of five shapes by turns; of the relations one end is no entity of its record.
SHAPES = """WITH d AS (SELECT *, doc_id % 5 AS m, 'https://' || source || '.example.com/' || doc_id AS url, source || '.example.com' AS host, '10.0.0.' || doc_id % 250 AS ip, 'malware' || doc_id % 11 AS bad FROM (SELECT * REPLACE (coalesce(lang, 'none') AS lang) FROM documents)),
stix AS (SELECT *, CASE WHEN doc_id % 2 = 0 THEN 'tool' ELSE 'relationship' END AS kind FROM d WHERE m = 2),
nodes AS (SELECT 'Source' AS label, 'source:' || host AS id FROM d WHERE m = 0 UNION SELECT 'SightingEvent', 'event:' || host || ':' || left(md5(url || '|t'), 8) FROM d WHERE m = 0 UNION SELECT 'Article', 'article:' || host || ':' || lang || ':' || left(md5(url), 8) FROM d WHERE m = 0
  UNION SELECT 'MispEvent', 'misp_event:' || left(md5(url), 8) || ':t' FROM d WHERE m = 1 UNION SELECT 'Indicator', 'indicator:ip:' || left(md5(ip), 8) FROM d WHERE m = 1
  UNION SELECT 'Tool', 'tool:' || lang || ':' || doc_id FROM stix WHERE kind = 'tool'
  UNION SELECT 'Article', 'article:' || host || ':' || left(md5(url), 8) FROM d WHERE m = 3 UNION SELECT 'Indicator', 'ip:' || left(md5(ip), 12) FROM d WHERE m = 3 UNION SELECT 'Malware', 'malware:' || left(md5(bad), 12) FROM d WHERE m = 3 UNION SELECT 'Entity', 'entity:' || left(md5('group ' || lang), 12) FROM d WHERE m = 3
  UNION SELECT 'RawIntel', 'raw' || doc_id FROM d WHERE m = 4),
edges AS (SELECT 'REPORTED_BY' AS type, 'event:' || host || ':' || left(md5(url || '|t'), 8) AS a, 'source:' || host AS b FROM d WHERE m = 0 UNION SELECT 'ABOUT', 'article:' || host || ':' || lang || ':' || left(md5(url), 8), 'event:' || host || ':' || left(md5(url || '|t'), 8) FROM d WHERE m = 0
  UNION SELECT 'APPEARED_IN', 'indicator:ip:' || left(md5(ip), 8), 'misp_event:' || left(md5(url), 8) || ':t' FROM d WHERE m = 1 UNION SELECT 'USES', 'malware--' || doc_id, 'tool--' || doc_id FROM stix WHERE kind = 'relationship'
  UNION SELECT 'MENTIONS', 'article:' || host || ':' || left(md5(url), 8), unnest(['ip:' || left(md5(ip), 12), 'malware:' || left(md5(bad), 12)]) FROM d WHERE m = 3
  UNION SELECT 'TALKS_TO', 'malware:' || left(md5(bad), 12), 'ip:' || left(md5(ip), 12) FROM d WHERE m = 3 UNION SELECT 'RELATED_TO', 'entity:' || left(md5('group ' || lang), 12), 'malware:' || left(md5(bad), 12) FROM d WHERE m = 3)
SELECT 'node' AS part, label AS kind, id FROM nodes UNION ALL SELECT 'edge', type, a || ' ' || b FROM edges"""


@query(SHAPES)
def to_changeset(spark, d):
    i, lang = F.col("doc_id"), F.coalesce("lang", F.lit("none"))
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    url, ip, bad = text("https://", F.col("source"), ".example.com/", i), text("10.0.0.", i % 250), text("malware", i % 11)
    article = F.to_json(F.struct(url.alias("source_url"), F.lit("t").alias("retrieved_at"), lang.alias("title")))
    ioc = F.to_json(F.struct(F.lit("misp").alias("source"), url.alias("feed_url"), F.lit("t").alias("fetched_at"), F.struct(ip.alias("value"), F.lit("ip").alias("type")).alias("ioc_record")))
    thing = F.to_json(F.struct(F.lit("taxii").alias("source"), F.struct(text("tool--", i).alias("id"), F.lit("tool").alias("type"), lang.alias("name")).alias("stix_object")))
    uses = F.to_json(F.struct(F.lit("taxii").alias("source"), F.struct(text("relationship--", i).alias("id"), F.lit("relationship").alias("type"), text("malware--", i).alias("source_ref"), text("tool--", i).alias("target_ref"), F.lit("uses").alias("relationship_type")).alias("stix_object")))
    none = F.lit(None).cast("string")
    talks = F.struct(bad.alias("source"), ip.alias("target"), F.lit("talks to").alias("type"))
    linked = F.struct(text("group ", lang).alias("source"), bad.alias("target"), none.alias("type"))
    intel = F.to_json(F.struct(F.struct(F.array(ip, F.lit("")).alias("ip"), F.array(bad).alias("malware")).alias("entities"), F.array(talks, linked, F.struct(ip.alias("source"), none.alias("target"), none.alias("type"))).alias("relations"), F.struct(url.alias("link")).alias("raw_payload")))
    raw = F.to_json(F.struct(text("raw", i).alias("id"), F.col("text")))
    record = F.when(i % 5 == 0, article).when(i % 5 == 1, ioc).when((i % 5 == 2) & (i % 2 == 0), thing).when(i % 5 == 2, uses).when(i % 5 == 3, intel).otherwise(raw)
    nodes, edges = G.to_changeset(frame(spark, d, "documents").select(record.alias("record")))
    return nodes.select(F.lit("node").alias("part"), F.col("label").alias("kind"), "id").distinct().unionByName(edges.select(F.lit("edge").alias("part"), F.col("type").alias("kind"), F.concat_ws(" ", "source_id", "target_id").alias("id")))


@query("SELECT concat('n', user_id % 40) AS id, arg_max(event_type, event_id) AS last_type, count(DISTINCT event_type) AS kinds FROM events GROUP BY 1")
def merge_graph(spark, d):
    n = frame(spark, d, "events").select(F.concat(F.lit("n"), F.col("user_id") % 40).alias("id"), F.lit("Node").alias("label"), F.col("event_id").alias("version"), F.create_map(F.lit("last"), F.col("event_type"), F.col("event_type"), F.lit("seen")).alias("properties"))
    merged = G.merge_graph(n.filter("version % 2 = 0"), n.filter("version % 2 = 1"))
    return merged.select("id", F.element_at("properties", "last").alias("last_type"), (F.size("properties") - 1).cast("long").alias("kinds"))


@query("SELECT concat('ind:', p_partkey) AS source_id, concat('T1', p_partkey % 100) AS target_id, 'DESCRIBES' AS type FROM part WHERE p_partkey % 3 = 0 AND p_partkey % 100 < 60")
def technique_links(spark, d):
    p = F.col("p_partkey")
    nodes = frame(spark, d, "part").select(F.concat(F.lit("ind:"), p).alias("id"), F.lit("Indicator").alias("label"), F.when(p % 3 == 0, F.concat(F.lit("T1"), p % 100)).otherwise(F.col("p_name")).alias("name"))
    techniques = frame(spark, d, "part").filter(p % 100 < 60).select(F.concat(F.lit("T1"), p % 100).alias("technique")).distinct()
    return G.technique_links(nodes, techniques)


# Pages with what is known of them: when they were published, indicators and actors that they name.
KNOWN = """, u AS (SELECT page_id, url, regexp_extract(url, '^[^:]+://([^/?#]*)', 1) AS host, page_id % 20 AS age, list_transform(range(1, 8), lambda j: 'p' || page_id * j % 2000) AS inds, list_transform(range(1, 5), lambda j: 's' || page_id * j % 150) AS acts FROM pages),
src AS (SELECT url, (page_id % 10 + 0.5) / 10 AS reputation FROM pages WHERE page_id % 4 = 0),
known AS (SELECT host, count(*) AS n, avg(reputation) AS reputation FROM (SELECT DISTINCT host FROM u WHERE host <> '') JOIN src ON contains(src.url, host) GROUP BY 1),
unseen AS (SELECT page_id, count(*) AS unseen FROM (SELECT page_id, unnest(inds[1:5]) AS v FROM u) WHERE v NOT IN (SELECT 'p' || p_partkey FROM part WHERE p_partkey % 3 <> 0) GROUP BY 1),
coverage AS (SELECT 's' || l_suppkey AS actor, sum(n) AS articles FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) JOIN (SELECT indicator, count(*) AS n FROM mentions WHERE indicator % 50 = 0 GROUP BY 1) ON indicator = l_partkey GROUP BY 1),
gaps AS (SELECT page_id, 0.2 * count(*) AS gap FROM (SELECT page_id, unnest(acts[1:3]) AS a FROM u) LEFT JOIN coverage ON actor = a WHERE coalesce(articles, 0) < 5 GROUP BY 1),
g AS (SELECT u.*, n > 0 AS known, coalesce(reputation, 0) AS reputation, coalesce(unseen, 0) AS unseen, coalesce(gap, 0) AS gap,
  greatest(0, least(1, CASE WHEN n > 0 THEN 0.2 + CASE WHEN reputation > 0.7 THEN 0.15 ELSE 0 END ELSE 0 END + 0.1 * coalesce(unseen, 0) + 0.3 * coalesce(gap, 0) + CASE WHEN age <= 1 THEN 0.2 WHEN age <= 7 THEN 0.1 ELSE 0 END)) AS points
  FROM u LEFT JOIN known USING (host) LEFT JOIN unseen USING (page_id) LEFT JOIN gaps USING (page_id))"""


def known_pages(spark, d):
    """Pages with the graph's signals: sources, parts as indicators, suppliers as actors."""
    pages = frame(spark, d, "pages")
    i, now = F.col("page_id"), F.lit("2024-02-01T12:00:00").cast("timestamp")
    names = lambda kind, n, among: F.transform(F.sequence(F.lit(1), F.lit(n)), lambda j: F.concat(F.lit(kind), i * j % among))
    urls = pages.select("page_id", "url", (now - F.make_dt_interval((i % 20).cast("int"))).alias("published"), names("p", 7, 2000).alias("indicators"), names("s", 4, 150).alias("actors"))
    sources = pages.filter(i % 4 == 0).select("url", ((i % 10 + 0.5) / 10).alias("reputation"))
    indicators = frame(spark, d, "part").filter("p_partkey % 3 <> 0").select(F.concat(F.lit("p"), "p_partkey").alias("value"))
    actors = frame(spark, d, "lineitem").select(F.concat(F.lit("s"), "l_suppkey").alias("actor"), F.col("l_partkey").alias("indicator")).distinct()
    coverage = G.actor_coverage(actors, frame(spark, d, "mentions").filter("indicator % 50 = 0"))
    return G.graph_priorities(urls, sources, indicators, coverage, now)


@query(sql_with("mentions") + KNOWN + " SELECT page_id, coalesce(known, false) AS known, round(reputation::DOUBLE, 6) AS reputation, unseen, round(gap::DOUBLE, 6) AS gap, round(points::DOUBLE, 6) AS priority FROM g")
def graph_priority(spark, d):
    out = known_pages(spark, d)
    return out.select("page_id", "known", F.round("reputation", 6).alias("reputation"), F.col("unseen").cast("long").alias("unseen"), F.round("gap", 6).alias("gap"), F.round("graph_priority", 6).alias("priority"))


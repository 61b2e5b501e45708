"""Queries of the corpus operators over the project's tables, with the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatmill.functions import text as T
from chatmill.operators import analytics, audit, dedup, drift, evaluation, extract, network, pseudonyms, quality, reports, retrieval, scrub, taxonomy, threads
from chatmill.plans.scratch import Scratch
from chatmill.sources import exports
from chatmill.sources.tables import path, table

QUERIES: dict = {}
SQL: dict[str, str] = {}

_S = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"


def _words(t: str) -> str:
    return f"list_filter(string_split_regex(coalesce({t}, ''), '{_S}+'), lambda w: w <> '')"


def _stripped(t: str) -> str:
    return f"regexp_replace({t}, '^{_S}+|{_S}+$', '', 'g')"


def _tokens(t: str) -> str:
    return f"CAST(floor(len({_words(t)}) * CAST(1.35 AS DOUBLE)) AS BIGINT)"


def _normal(t: str) -> str:
    bare = rf"regexp_replace(lower(coalesce({t}, '')), '[^\p{{L}}\p{{N}}_\t-\r\x1c-\x20\x{{85}}\p{{Z}}]', '', 'g')"
    return _stripped(f"regexp_replace({bare}, '{_S}+', ' ', 'g')")


def _content(t: str) -> str:
    stop = ", ".join(f"'{w}'" for w in sorted(T.STOPWORDS))
    return f"list_filter(regexp_extract_all(lower(coalesce({t}, '')), '([а-яёa-z0-9]+(?:[-''][а-яёa-z0-9]+)?)', 1), lambda w: length(w) >= 2 AND NOT regexp_full_match(w, '[0-9]+') AND w NOT IN ({stop}))"


def _values(pairs) -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)
    return ", ".join("(" + ", ".join(quote(x) for x in p) + ")" for p in pairs)


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "full_clean_messages")


def _threaded(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of known threads with their place in the thread."""
    pos = F.row_number().over(Window.partitionBy("thread_id").orderBy("unixtime", "chat_id", "msg_id"))
    return _clean(spark, sf).where("thread_id is not null").withColumn("pos", pos.cast("long"))


_THREADED = "m AS (SELECT *, row_number() OVER (PARTITION BY thread_id ORDER BY unixtime, chat_id, msg_id) AS pos FROM full_clean_messages WHERE thread_id IS NOT NULL)"


# texts


@query(f"SELECT doc_id, CAST(len({_words('text')}) AS BIGINT) AS word_count, {_tokens('text')} AS token_count, coalesce(contains(text, '?'), false) AS is_question, md5({_normal('text')}) AS norm_md5 FROM documents")
def p_text_features(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf, "documents").select("doc_id", T.word_count(t).alias("word_count"), T.token_count(t).alias("token_count"), T.is_question(t).alias("is_question"), F.md5(T.normalized(t)).alias("norm_md5"))


@query("SELECT chat_id, msg_id, domain FROM full_clean_messages WHERE contains(lower(text_clean), 'кластер') AND domain = 'devops_infra' AND is_question")
def p_filter_messages(spark: SparkSession, sf: str) -> DataFrame:
    return _clean(spark, sf).where(T.contains_ignoring_case(F.col("text_clean"), "Кластер") & (F.col("domain") == "devops_infra") & F.col("is_question")).select("chat_id", "msg_id", "domain")


@query("SELECT thread_id, quality_score, turn_count FROM sft_dialogues WHERE quality_score >= 3 AND turn_count >= 4")
def p_filter_dialogues(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "sft_dialogues").where("quality_score >= 3 and turn_count >= 4").select("thread_id", "quality_score", "turn_count")


# redaction and authors


@query()
def r_scrub_messages(spark: SparkSession, sf: str) -> DataFrame:
    rows, order = table(spark, sf, "normalized_messages"), ["unixtime", "chat_id", "msg_id"]
    known = Scratch(spark, "names").save("known", pseudonyms.pseudonyms(rows, "author_id_raw", "author_raw", order))
    done = scrub.scrub_forwards(rows, "text_raw", known, order)
    return done.select("chat_id", "msg_id", scrub.tidied(F.col("text_scrubbed")).alias("text_clean"), *[c for c in done.columns if c.startswith("n_")])


_KEY = "CASE WHEN author_id_raw IS NULL OR lower(trim(author_id_raw)) IN ('', 'none', 'unknown', 'anonymous', 'null') THEN coalesce(author_raw, '') ELSE author_id_raw END"


@query(
    f"""WITH f AS (SELECT {_KEY} AS author_key, min({{'u': unixtime, 'c': chat_id, 'm': msg_id}}) AS seen FROM normalized_messages GROUP BY 1),
n AS (SELECT author_key, row_number() OVER (ORDER BY seen, author_key) AS k FROM f)
SELECT author_key, printf('user_%05d', k) AS user_pseudonym, printf('Developer_%05d', k) AS name_pseudonym FROM n"""
)
def r_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    return pseudonyms.pseudonyms(table(spark, sf, "normalized_messages"), "author_id_raw", "author_raw", ["unixtime", "chat_id", "msg_id"])


@query(
    r"""WITH t AS (SELECT {'u': unixtime, 'c': chat_id, 'm': msg_id} AS z, string_split_regex(text_raw, '[^\p{L}\p{N}_@]+') AS w FROM normalized_messages WHERE contains(text_raw, '@')),
f AS (SELECT z, i, lower(regexp_extract(w[i], '^@*@([a-zA-Z0-9_]{4,32})(?:@.*)?$', 1)) AS mention FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM t)),
g AS (SELECT mention, min({'a': z, 'i': i}) AS seen FROM f WHERE mention <> '' GROUP BY mention)
SELECT mention, row_number() OVER (ORDER BY seen, mention) AS number FROM g"""
)
def r_mentions(spark: SparkSession, sf: str) -> DataFrame:
    return scrub.numbered_mentions(table(spark, sf, "normalized_messages"), "text_raw", ["unixtime", "chat_id", "msg_id"])


@query()
def r_numbered_texts(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "normalized_messages").select("chat_id", "msg_id", "unixtime", "text_raw")
    return scrub.number_mentions(rows, "text_raw", ["unixtime", "chat_id", "msg_id"]).drop("unixtime")


@query()
def r_mask_names(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "normalized_messages")
    names = pseudonyms.author_names(rows, "author_raw")
    return pseudonyms.mask_words(rows.select("chat_id", "msg_id", "text_raw"), "text_raw", names)


# duplicates


@query(
    f"""WITH n AS (SELECT doc_id, {_normal('text')} AS t FROM documents),
k AS (SELECT doc_id, length(t) AS l, row_number() OVER (PARTITION BY md5(t) ORDER BY doc_id) AS r FROM n)
SELECT doc_id FROM k WHERE l < 15 OR r = 1"""
)
def d_exact(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.exact_duplicates_in_table(spark, path(sf, "documents"), "text", ["doc_id"]).select("doc_id")


@query(
    r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END AS s FROM w)
SELECT doc_id, CAST(len(list_distinct(s)) AS BIGINT) AS shingles FROM s"""
)
def d_shingles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.size(dedup.shingles(F.col("text"))).cast("long").alias("shingles"))


@query()
def d_near(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.near_duplicates(table(spark, sf, "documents"), "doc_id", "text")


@query(
    f"""WITH n AS (SELECT doc_id, {_normal('text')} AS t FROM documents), k AS (SELECT doc_id, length(t) AS l, row_number() OVER (PARTITION BY md5(t) ORDER BY doc_id) AS r FROM n)
SELECT d.* FROM documents d JOIN k USING (doc_id) WHERE l < 15 OR r = 1"""
)
def d_exact_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The same as of any frame, with all columns."""
    return dedup.exact_duplicates(table(spark, sf, "documents"), "text", ["doc_id"])


@query()
def d_index(spark: SparkSession, sf: str) -> DataFrame:
    """All documents against an index of those of one source."""
    rows = table(spark, sf, "documents")
    index = Scratch(spark, "index").save("index", dedup.signatures(rows.where("source = 'community_node_07'"), ["doc_id"], "text"))
    return dedup.against_index(rows.where("source <> 'community_node_07'"), "doc_id", "text", index)


# domains, tags and mood


_KEYWORDS = _values((d, k) for d, ks in taxonomy.TAXONOMY.items() for k in ks)
_SCORES = rf"""kw AS (SELECT * FROM (VALUES {_KEYWORDS}) v(domain, k)),
t AS (SELECT chat_id, msg_id, lower(coalesce(text_clean, '')) AS low, list_distinct(regexp_extract_all(lower(coalesce(text_clean, '')), '[a-zA-Zа-яё0-9_\-+#.]+')) AS toks FROM full_clean_messages),
h AS (SELECT t.chat_id, t.msg_id, kw.domain, count(*) AS score FROM (SELECT chat_id, msg_id, unnest(toks) AS k FROM t) t JOIN kw USING (k) GROUP BY ALL
  UNION ALL SELECT t.chat_id, t.msg_id, kw.domain, count(*) FROM t JOIN kw ON contains(kw.k, ' ')
  AND contains(' ' || low || ' ', ' ' || split_part(kw.k, ' ', 1) || ' ') AND contains(' ' || low || ' ', ' ' || split_part(kw.k, ' ', 2) || ' ') GROUP BY ALL),
s AS (SELECT chat_id, msg_id, domain, sum(score) AS score FROM h GROUP BY ALL),
b AS (SELECT chat_id, msg_id, arg_min(domain, {{'a': -score, 'd': domain}}) AS domain, max(score) AS best, sum(score) AS total FROM s GROUP BY ALL)"""


@query(
    f"""WITH {_SCORES} SELECT t.chat_id, t.msg_id, coalesce(b.domain, 'general_tech_chat') AS domain_found, CAST(coalesce(b.best, 0) AS BIGINT) AS domain_score,
round(coalesce(CAST(b.best AS DOUBLE) / b.total, 0), 6) AS domain_confidence FROM t LEFT JOIN b USING (chat_id, msg_id)"""
)
def t_domains(spark: SparkSession, sf: str) -> DataFrame:
    return taxonomy.classified(_clean(spark, sf), "text_clean").select("chat_id", "msg_id", "domain_found", "domain_score", F.round("domain_confidence", 6).alias("domain_confidence"))


@query(
    rf"""WITH l AS (SELECT * FROM (VALUES {_values(taxonomy.SENTIMENT.items())}) v(w, s)),
t AS (SELECT chat_id, msg_id, unnest(regexp_extract_all(lower(coalesce(text_clean, '')), '[\p{{L}}\p{{N}}_]+')) AS w FROM full_clean_messages),
s AS (SELECT chat_id, msg_id, sum(s) AS s FROM t JOIN l USING (w) GROUP BY ALL)
SELECT m.chat_id, m.msg_id, CAST(coalesce(s.s, 0) AS BIGINT) AS sentiment FROM full_clean_messages m LEFT JOIN s USING (chat_id, msg_id)"""
)
def t_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    return _clean(spark, sf).select("chat_id", "msg_id", taxonomy.sentiment(F.col("text_clean")).alias("sentiment"))


# threads


_LINKS = "l AS (SELECT c.chat_id, c.msg_id, p.msg_id AS parent_id FROM full_clean_messages c JOIN full_clean_messages p ON c.chat_id = p.chat_id AND CAST(c.reply_to_id AS BIGINT) = p.msg_id WHERE c.reply_to_id <> 0 AND c.unixtime - p.unixtime BETWEEN 0 AND 172800)"


@query(f"WITH {_LINKS} SELECT * FROM l")
def g_reply_links(spark: SparkSession, sf: str) -> DataFrame:
    return threads.reply_links(_clean(spark, sf))


@query(
    f"""WITH RECURSIVE {_LINKS},
r AS (SELECT DISTINCT l.chat_id, l.parent_id AS msg_id FROM l WHERE NOT EXISTS (SELECT 1 FROM l k WHERE k.chat_id = l.chat_id AND k.msg_id = l.parent_id)),
t AS (SELECT chat_id, msg_id, msg_id AS root, 0 AS depth FROM r UNION ALL SELECT l.chat_id, l.msg_id, t.root, t.depth + 1 FROM t JOIN l ON l.chat_id = t.chat_id AND l.parent_id = t.msg_id),
m AS (SELECT f.chat_id, f.msg_id, f.unixtime, t.root FROM full_clean_messages f LEFT JOIN t USING (chat_id, msg_id)),
b AS (SELECT *, CASE WHEN root IS NOT NULL THEN 0 WHEN lag(msg_id) OVER w IS NULL OR lag(root) OVER w IS NOT NULL OR unixtime - lag(unixtime) OVER w > 300 THEN 1 ELSE 0 END AS brk FROM m WINDOW w AS (PARTITION BY chat_id ORDER BY unixtime, msg_id)),
i AS (SELECT *, sum(brk) OVER (PARTITION BY chat_id ORDER BY unixtime, msg_id) AS run FROM b),
g AS (SELECT chat_id, root, CASE WHEN root IS NULL THEN run END AS run, count(*) AS n, min(CASE WHEN root IS NULL OR root = msg_id THEN {{'u': unixtime, 'm': msg_id}} END) AS first FROM i GROUP BY ALL),
k AS (SELECT *, CASE WHEN root IS NOT NULL THEN 0 WHEN n > 1 THEN 1 ELSE 2 END AS kind FROM g),
z AS (SELECT *, row_number() OVER (ORDER BY kind, CASE WHEN kind < 2 THEN chat_id END NULLS FIRST, first.u, first.m, chat_id) AS thread_id FROM k)
SELECT z.thread_id, ['tree', 'burst', 'single'][z.kind + 1] AS kind, i.chat_id, i.msg_id, row_number() OVER (PARTITION BY z.thread_id ORDER BY i.unixtime, coalesce(t.depth, 0), i.msg_id) AS pos
FROM i LEFT JOIN t USING (chat_id, msg_id) JOIN z ON i.chat_id = z.chat_id AND i.root IS NOT DISTINCT FROM z.root AND (i.root IS NOT NULL OR i.run = z.run)"""
)
def g_threads(spark: SparkSession, sf: str) -> DataFrame:
    return threads.build_threads(_clean(spark, sf))


# extraction


@query()
def e_dialogues(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_dialogues(_threaded(spark, sf))


@query(
    f"""WITH {_THREADED}, d AS (SELECT thread_id, coalesce(domain, 'general_tech_chat') AS domain, count(*) AS n, min(pos) AS p FROM m GROUP BY ALL)
SELECT thread_id, arg_max(domain, {{'n': n, 'a': -p}}) AS topic_domain FROM d GROUP BY thread_id"""
)
def e_primary_domain(spark: SparkSession, sf: str) -> DataFrame:
    return extract.primary_domain(_threaded(spark, sf))


# corpus statistics


@query(
    f"""SELECT count(*) AS messages, count(DISTINCT author_id_anon) AS authors, count(DISTINCT chat_id) AS chats, CAST(sum(len({_words('text_clean')})) AS BIGINT) AS words, CAST(sum({_tokens('text_clean')}) AS BIGINT) AS tokens,
CAST(sum(length(coalesce(text_clean, ''))) AS BIGINT) AS characters, CAST(greatest((max(unixtime) - min(unixtime)) // 86400, 1) AS BIGINT) AS days,
round(count(*) / CAST(greatest((max(unixtime) - min(unixtime)) // 86400, 1) AS DOUBLE), 6) AS messages_a_day FROM full_clean_messages"""
)
def a_volume(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.volume(_clean(spark, sf)).withColumn("messages_a_day", F.round("messages_a_day", 6))


def _rank_sql(rows: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    picks = ", ".join(f"max(CASE WHEN r = least(n - 1, CAST(floor(n * CAST({s} AS DOUBLE)) AS BIGINT)) + 1 THEN v END) AS p{round(s * 100)}" for s in (0.25, 0.5, 0.75, 0.9, 0.95, 0.99))
    return f"""WITH x AS (SELECT *, row_number() OVER ({part}ORDER BY v) AS r, count(*) OVER ({part[:-1] if part else ''}) AS n FROM ({rows}) WHERE v IS NOT NULL)
SELECT {keys}max(n) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS least, max(v) AS most, {picks} FROM x {'GROUP BY ' + by if by else ''}"""


@query(_rank_sql("SELECT length(text) AS v FROM documents"))
def a_length_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.rank_percentiles(table(spark, sf, "documents").withColumn("v", F.length("text").cast("long")), "v").withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query(_rank_sql("SELECT event_type, value AS v FROM events", "event_type"))
def a_event_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.rank_percentiles(table(spark, sf, "events"), "value", by=["event_type"]).withColumns({c: F.round(c, 6) for c in ("mean", "std")})


def _activity(unit: str, sql: str) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return analytics.activity(_clean(spark, sf), unit).withColumn("mean_length", F.round("mean_length", 6))

    run.__name__ = f"a_by_{unit}"
    query(f"SELECT CAST({sql} AS VARCHAR) AS bucket, count(*) AS messages, round(avg(length(text_clean)), 6) AS mean_length FROM (SELECT *, make_timestamp(unixtime * 1000000) AS ts FROM full_clean_messages WHERE unixtime IS NOT NULL) GROUP BY 1")(run)


for _unit, _sql in {"hour": "hour(ts)", "weekday": "isodow(ts) - 1", "month": "strftime(ts, '%Y-%m')", "year": "year(ts)"}.items():
    _activity(_unit, _sql)


@query(_rank_sql("SELECT g AS v FROM (SELECT unixtime - lag(unixtime) OVER (PARTITION BY chat_id ORDER BY unixtime, msg_id) AS g FROM full_clean_messages WHERE unixtime IS NOT NULL) WHERE g BETWEEN 0 AND 86400"))
def a_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.intervals(_clean(spark, sf)).withColumns({c: F.round(c, 6) for c in ("mean", "std")})


def _ngram(n: int, most: int) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return analytics.ngrams(_clean(spark, sf), "text_clean", n, most)

    run.__name__ = f"a_{n}grams"
    joined = " || ' ' || ".join(f"w[i + {k}]" if k else "w[i]" for k in range(n))
    query(f"WITH c AS (SELECT {_content('text_clean')} AS w FROM full_clean_messages), g AS (SELECT unnest(list_transform(range(1, len(w) - {n - 2}), lambda i: {joined})) AS term FROM c WHERE len(w) >= {n}) SELECT term, count(*) AS n FROM g GROUP BY term ORDER BY n DESC, term LIMIT {most}")(run)


for _n, _most in ((1, 50), (2, 30), (3, 20), (4, 15)):
    _ngram(_n, _most)


@query(
    f"""WITH c AS (SELECT unnest({_content('text_clean')}) AS term FROM full_clean_messages), k AS (SELECT term, count(*) AS c FROM c GROUP BY term)
SELECT CAST(sum(c) AS BIGINT) AS words, count(*) AS distinct_words, round(log2(sum(c)) - sum(c * log2(c)) / sum(c), 6) AS entropy, round(count(*) / CAST(sum(c) AS DOUBLE), 6) AS ttr, round(count(*) / sqrt(sum(c)), 6) AS root_ttr FROM k"""
)
def a_lexical_diversity(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.lexical_diversity(_clean(spark, sf), "text_clean").withColumns({c: F.round(c, 6) for c in ("entropy", "ttr", "root_ttr")})


@query(
    f"""WITH c AS (SELECT unnest({_content('text_clean')}) AS term FROM full_clean_messages)
SELECT term, count(*) AS n FROM c WHERE term IN ({', '.join(f"'{s}'" for s in analytics.SLANG)}) GROUP BY term ORDER BY n DESC, term LIMIT 35"""
)
def a_slang(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.slang_counts(_clean(spark, sf), "text_clean")


@query("SELECT domain AS value, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage FROM full_clean_messages GROUP BY domain")
def a_domain_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.distribution(_clean(spark, sf), "domain").withColumn("percentage", F.round("percentage", 6))


@query("SELECT tag, count(*) AS n FROM (SELECT unnest(tags) AS tag FROM full_clean_messages) WHERE tag IS NOT NULL GROUP BY tag ORDER BY n DESC, tag LIMIT 40")
def a_top_tags(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.top_tags(_clean(spark, sf))


@query("SELECT round(avg(sentiment_score), 6) AS mean, count(*) FILTER (WHERE sentiment_score > 0) AS positive, count(*) FILTER (WHERE sentiment_score < 0) AS negative, count(*) FILTER (WHERE sentiment_score = 0) AS neutral FROM full_clean_messages")
def a_mood(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.mood(_clean(spark, sf), F.col("sentiment_score")).withColumn("mean", F.round("mean", 6))


@query("SELECT count(*) AS messages, count(*) FILTER (WHERE contains(text, '?')) AS questions, count(*) FILTER (WHERE " + " OR ".join("contains(text, '" + m.replace("'", "''") + "')" for m in analytics.CODE_MARKS) + ") AS with_code FROM documents")
def a_questions_and_code(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.questions_and_code(table(spark, sf, "documents"), "text")


@query(
    f"""WITH b AS (SELECT author_anon, count(*) AS m FROM full_clean_messages GROUP BY author_anon HAVING count(*) >= 30 ORDER BY m DESC, author_anon LIMIT 25),
s AS (SELECT author_anon, unnest({_content('text_clean')}) AS term FROM full_clean_messages), o AS (SELECT term, count(*) AS o FROM s GROUP BY term),
n AS (SELECT author_anon, term, count(*) AS n FROM s JOIN b USING (author_anon) GROUP BY ALL HAVING count(*) >= 2),
r AS (SELECT author_anon, term, n, n / CAST(o + 2 AS DOUBLE) * ln(n + 1) AS score, row_number() OVER (PARTITION BY author_anon ORDER BY n / CAST(o + 2 AS DOUBLE) * ln(n + 1) DESC, term) AS place FROM n JOIN o USING (term))
SELECT author_anon, CAST(place AS INT) AS place, term, n, round(score, 6) AS score FROM r WHERE place <= 5"""
)
def a_key_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.key_phrases(_clean(spark, sf), "author_anon", "text_clean").withColumn("score", F.round("score", 6))


@query(
    f"""WITH s AS (SELECT CAST(year(make_timestamp(unixtime * 1000000)) AS INT) AS year, unnest({_content('text_clean')}) AS term FROM full_clean_messages WHERE unixtime IS NOT NULL),
n AS (SELECT year, term, count(*) AS n FROM s GROUP BY ALL), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY n DESC, term) AS INT) AS place FROM n) SELECT * FROM r WHERE place <= 8"""
)
def a_yearly_terms(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.yearly_terms(_clean(spark, sf), "text_clean")


_CLEAN = "coalesce(text_clean, '')"


@query(f"SELECT count(*) AS messages, count(*) FILTER (WHERE length({_stripped(_CLEAN)}) < 20) AS short, count(*) FILTER (WHERE len({_words('text_clean')}) = 0) AS wordless, count(*) FILTER (WHERE abs(sentiment_score) >= 2) AS emotional FROM full_clean_messages")
def a_noise(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.noise(_clean(spark, sf))


@query()
def a_topics(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.topics(_clean(spark, sf), "author_anon", "text_clean")


# who talks to whom


_EDGES = """o AS (SELECT *, coalesce(author_anon, '') AS s, lag(chat_id) OVER w AS pc, lag(unixtime) OVER w AS pt, lag(coalesce(author_anon, '')) OVER w AS ps FROM full_clean_messages WINDOW w AS (ORDER BY unixtime, chat_id, msg_id)),
e AS (SELECT o.s AS sender, CASE WHEN a.s IS NOT NULL THEN a.s WHEN o.pc = o.chat_id AND o.unixtime - o.pt <= 1800 THEN o.ps END AS recipient
  FROM o LEFT JOIN (SELECT chat_id, msg_id, coalesce(author_anon, '') AS s FROM full_clean_messages) a ON a.chat_id = o.chat_id AND a.msg_id = CAST(o.reply_to_id AS BIGINT)),
w AS (SELECT sender, recipient, count(*) AS weight FROM e WHERE recipient IS NOT NULL AND recipient <> sender GROUP BY ALL)"""


@query(f"WITH {_EDGES} SELECT * FROM w")
def n_edges(spark: SparkSession, sf: str) -> DataFrame:
    return network.edges(network.interactions(_clean(spark, sf)))


@query(
    f"""WITH {_EDGES}, d AS (SELECT recipient AS a FROM w UNION SELECT sender FROM w), p AS (SELECT count(*) AS p FROM w x JOIN w y ON x.sender = y.recipient AND x.recipient = y.sender AND x.sender < x.recipient)
SELECT (SELECT count(*) FROM d) AS nodes, count(*) AS edges, CAST(sum(weight) AS BIGINT) AS interactions, (SELECT p FROM p) AS mutual_pairs,
round(count(*) / CAST((SELECT count(*) FROM d) * ((SELECT count(*) FROM d) - 1) AS DOUBLE), 9) AS density FROM w"""
)
def n_measures(spark: SparkSession, sf: str) -> DataFrame:
    return network.graph_measures(network.edges(network.interactions(_clean(spark, sf)))).withColumn("density", F.round("density", 9))


@query(
    f"""WITH {_EDGES}, d AS (SELECT recipient AS author, weight AS r, 0 AS g FROM w UNION ALL SELECT sender, 0, weight FROM w)
SELECT author, CAST(sum(r) AS BIGINT) AS received, CAST(sum(g) AS BIGINT) AS given FROM d GROUP BY author"""
)
def n_degrees(spark: SparkSession, sf: str) -> DataFrame:
    return network.degrees(network.edges(network.interactions(_clean(spark, sf))))


@query(f"WITH {_EDGES} SELECT x.sender AS user_a, x.recipient AS user_b, x.weight + y.weight AS total FROM w x JOIN w y ON x.sender = y.recipient AND x.recipient = y.sender AND x.sender < x.recipient")
def n_mutual_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return network.mutual_pairs(network.edges(network.interactions(_clean(spark, sf))))


# retrieval


_ASKED = "как откатить образ контейнера и поднять второй кластер"
_WORDS = retrieval.keywords(_ASKED)


@query(
    rf"""WITH f AS (SELECT doc_id AS k, text AS t, {' + '.join(f"CASE WHEN contains(lower(text), '{w}') THEN 1.5 ELSE 0 END" for w in _WORDS)} AS lexical FROM documents
  WHERE {' OR '.join(f"contains(lower(text), '{w}')" for w in _WORDS)} ORDER BY lexical DESC, k LIMIT 5000),
d AS (SELECT k, regexp_extract_all(lower(t), '[\p{{L}}\p{{N}}_]{{2,}}') AS w FROM f UNION ALL SELECT NULL, regexp_extract_all('{_ASKED}', '[\p{{L}}\p{{N}}_]{{2,}}')),
g AS (SELECT k, unnest(w || list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])) AS term FROM d), b AS (SELECT k, term, count(*) AS tf FROM g GROUP BY ALL),
s AS (SELECT term, count(*) AS df, sum(tf) AS total FROM b GROUP BY term ORDER BY total DESC, term LIMIT 20000),
x AS (SELECT k, term, (1 + ln(tf)) * (ln((2.0 + (SELECT count(*) FROM f)) / (1 + df)) + 1) AS w FROM b JOIN s USING (term)), n AS (SELECT k, sqrt(sum(w * w)) AS norm FROM x GROUP BY k),
c AS (SELECT x.k, sum(x.w * q.w) AS dot FROM x JOIN (SELECT term, w FROM x WHERE k IS NULL) q USING (term) WHERE x.k IS NOT NULL GROUP BY x.k)
SELECT f.k AS doc_id, round((dot / norm / (SELECT norm FROM n WHERE k IS NULL) * 0.65 + lexical / (SELECT max(lexical) FROM f) * 0.35) * 10, 6) AS score, CAST(lexical AS DOUBLE) AS lexical
FROM f JOIN c USING (k) JOIN n USING (k) ORDER BY score DESC, doc_id LIMIT 20"""
)
def q_search(spark: SparkSession, sf: str) -> DataFrame:
    return retrieval.search(table(spark, sf, "documents"), _ASKED, "doc_id", "text", top=20).withColumn("score", F.round("score", 6))


# audits, drift and checks


@query("SELECT chat_name, count(*) AS n FROM full_clean_messages GROUP BY chat_name")
def v_sample_whole(spark: SparkSession, sf: str) -> DataFrame:
    """A sample larger than the table is the table."""
    rows = _clean(spark, sf)
    return audit.stratified_sample(rows, "chat_name", F.concat_ws("/", "chat_id", "msg_id"), 10**9).groupBy("chat_name").agg(F.count("*").alias("n"))


@query(
    """WITH c AS (SELECT chat_name, count(*) AS n FROM full_clean_messages GROUP BY chat_name), r AS (SELECT chat_name, n, n * 1000.0 / sum(n) OVER () AS raw, sum(n) OVER () AS total FROM c),
p AS (SELECT *, floor(raw) AS base, row_number() OVER (ORDER BY raw - floor(raw) DESC, chat_name) AS place FROM r),
a AS (SELECT chat_name, CAST(CASE WHEN total <= 1000 THEN n ELSE base + CASE WHEN place <= 1000 - (SELECT sum(base) FROM p) THEN 1 ELSE 0 END END AS BIGINT) AS n FROM p) SELECT chat_name, n FROM a WHERE n > 0"""
)
def v_sample_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return audit.stratified_sample(_clean(spark, sf), "chat_name", F.concat_ws("/", "chat_id", "msg_id"), 1000).groupBy("chat_name").agg(F.count("*").alias("n"))


@query()
def v_audit(spark: SparkSession, sf: str) -> DataFrame:
    return audit.run_audit(_clean(spark, sf), "text_clean", "chat_name", F.concat_ws("/", "chat_id", "msg_id"))


_Z = audit.z_value(0.95)


@query(
    f"""WITH g AS (SELECT domain, count(*) AS n, count(*) FILTER (WHERE chosen_quality > rejected_quality + 2) AS hits FROM dpo_preference_pairs GROUP BY domain)
SELECT domain, n, hits, round(hits / CAST(n AS DOUBLE), 6) AS accuracy,
round(greatest((hits / CAST(n AS DOUBLE) + {_Z**2} / (2 * n)) / (1 + {_Z**2} / n) - {_Z} * sqrt(hits / CAST(n AS DOUBLE) * (1 - hits / CAST(n AS DOUBLE)) / n + {_Z**2} / (4.0 * n * n)) / (1 + {_Z**2} / n), 0), 6) AS low,
round(least((hits / CAST(n AS DOUBLE) + {_Z**2} / (2 * n)) / (1 + {_Z**2} / n) + {_Z} * sqrt(hits / CAST(n AS DOUBLE) * (1 - hits / CAST(n AS DOUBLE)) / n + {_Z**2} / (4.0 * n * n)) / (1 + {_Z**2} / n), 1), 6) AS high FROM g"""
)
def v_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "dpo_preference_pairs").withColumn("good", F.coalesce(F.col("chosen_quality") > F.col("rejected_quality") + 2, F.lit(False)))
    return audit.accuracy(rows, "domain", "good").withColumns({c: F.round(c, 6) for c in ("accuracy", "low", "high")})


@query("SELECT count(*) FILTER (WHERE a AND b) AS both, count(*) FILTER (WHERE a AND NOT b) AS only_a, count(*) FILTER (WHERE NOT a AND b) AS only_b, count(*) FILTER (WHERE NOT a AND NOT b) AS neither FROM (SELECT length(chosen) > 100 AS a, length(rejected) > 100 AS b FROM dpo_preference_pairs)")
def v_contingency(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "dpo_preference_pairs").select((F.length("chosen") > 100).alias("a"), (F.length("rejected") > 100).alias("b"))
    return audit.mcnemar(rows, "a", "b").select("both", "only_a", "only_b", "neither")


_REF, _CUR = "unixtime % 2 = 0", "unixtime % 2 = 1"


def _halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two snapshots that together are the whole table."""
    rows = _clean(spark, sf)
    return rows.where(_REF), rows.where(_CUR)


@query(
    f"""WITH r AS (SELECT length(coalesce(text_clean, '')) AS l FROM full_clean_messages WHERE {_REF}), c AS (SELECT length(coalesce(text_clean, '')) AS l FROM full_clean_messages WHERE {_CUR}),
e AS (SELECT list_distinct(quantile_cont(l, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e FROM r),
a AS (SELECT len(list_filter(e, lambda x: x <= l)) AS b, count(*) / CAST((SELECT count(*) FROM r) AS DOUBLE) AS p FROM r, e GROUP BY b), k AS (SELECT len(list_filter(e, lambda x: x <= l)) AS b, count(*) / CAST((SELECT count(*) FROM c) AS DOUBLE) AS q FROM c, e GROUP BY b),
j AS (SELECT greatest(coalesce(p, 0), 1e-6) AS p, greatest(coalesce(q, 0), 1e-6) AS q FROM a FULL JOIN k USING (b)), s AS (SELECT sum((q - p) * ln(q / p)) AS psi FROM j)
SELECT round(psi, 6) AS psi, CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'moderate_drift' ELSE 'significant_drift' END AS verdict FROM s"""
)
def v_length_shift(spark: SparkSession, sf: str) -> DataFrame:
    return drift.length_shift(*_halves(spark, sf), "text_clean").withColumn("psi", F.round("psi", 6))


@query(
    f"""WITH r AS (SELECT coalesce(domain, 'unknown') AS label, count(*) AS r FROM full_clean_messages WHERE {_REF} GROUP BY 1), k AS (SELECT coalesce(domain, 'unknown') AS label, count(*) AS k FROM full_clean_messages WHERE {_CUR} GROUP BY 1),
j AS (SELECT label, coalesce(r, 0) / CAST(sum(r) OVER () AS DOUBLE) AS a, coalesce(k, 0) / CAST(sum(k) OVER () AS DOUBLE) AS b FROM r FULL JOIN k USING (label)),
m AS (SELECT *, a + 1e-10 AS p, b + 1e-10 AS q, (a + b + 2e-10) / 2 AS m, (b - a) * 100 AS d FROM j), s AS (SELECT sum(0.5 * p * log2(p / m) + 0.5 * q * log2(q / m)) AS x, arg_max(label, {{'a': abs(d), 'd': d, 'l': label}}) AS moved_label, arg_max(d, {{'a': abs(d), 'd': d, 'l': label}}) AS moved FROM m)
SELECT round(x, 6) AS divergence, moved_label, round(moved, 6) AS moved_points, CASE WHEN x < 0.05 THEN 'stable' WHEN x < 0.2 THEN 'moderate_drift' ELSE 'significant_drift' END AS verdict FROM s"""
)
def v_label_shift(spark: SparkSession, sf: str) -> DataFrame:
    return drift.label_shift(*_halves(spark, sf), "domain").withColumns({c: F.round(c, 6) for c in ("divergence", "moved_points")})


def _top(where: str) -> str:
    return f"(SELECT w FROM (SELECT unnest(regexp_extract_all(lower(coalesce(text_clean, '')), '[a-zA-Zа-яё0-9]{{3,}}')) AS w FROM full_clean_messages WHERE {where}) GROUP BY w ORDER BY count(*) DESC, w LIMIT 500)"


@query(
    f"""WITH r AS (SELECT w, 1 AS r FROM {_top(_REF)}), k AS (SELECT w, 1 AS k FROM {_top(_CUR)}), j AS (SELECT * FROM r FULL JOIN k USING (w)),
s AS (SELECT count(*) FILTER (WHERE r = 1 AND k = 1) AS shared, count(*) FILTER (WHERE r IS NULL) AS new_words, count(*) FILTER (WHERE k IS NULL) AS dropped_words, count(*) AS a FROM j)
SELECT round(CASE WHEN a = 0 THEN 1 ELSE shared / CAST(a AS DOUBLE) END, 6) AS jaccard, shared, new_words, dropped_words,
CASE WHEN a = 0 OR shared / CAST(a AS DOUBLE) >= 0.9 THEN 'stable' WHEN shared / CAST(a AS DOUBLE) >= 0.75 THEN 'moderate_drift' ELSE 'significant_drift' END AS verdict FROM s"""
)
def v_vocabulary_shift(spark: SparkSession, sf: str) -> DataFrame:
    return drift.vocabulary_shift(*_halves(spark, sf), "text_clean").withColumn("jaccard", F.round("jaccard", 6))


_FEATURES = f"""t AS (SELECT thread_id, list_transform(coalesce(messages, []), lambda m: {{'role': lower(coalesce(m.role, '')), 'content': coalesce(m.content, '')}}) AS t FROM sft_dialogues),
f AS (SELECT thread_id, len(t) AS turns, len(list_filter(t, lambda m: m.role = 'assistant')) AS answers, len(list_filter(t, lambda m: m.role = 'user')) AS users,
  len(list_filter(t, lambda m: m.role = 'assistant' AND {_stripped('m.content')} = '')) AS empty_answers,
  coalesce(list_median(list_transform(list_filter(t, lambda m: m.role = 'assistant' AND {_stripped('m.content')} <> ''), lambda m: CAST(length(m.content) AS DOUBLE))), 0) AS median_chars,
  len(list_filter(t, lambda m: regexp_matches(m.content, '[а-яА-ЯёЁ]'))) AS ru,
  len(list_filter(range(1, greatest(len(t), 1)), lambda i: {_stripped('t[i].content')} = {_stripped('t[i + 1].content')} AND {_stripped('t[i + 1].content')} <> '')) AS dup FROM t),
g AS (SELECT thread_id, turns, answers, empty_answers, median_chars, CASE WHEN turns > 0 THEN abs(users - answers) / CAST(turns AS DOUBLE) ELSE 1 END AS role_balance,
  CASE WHEN turns > 0 THEN ru / CAST(turns AS DOUBLE) ELSE 0 END AS russian_ratio, CASE WHEN turns > 0 THEN dup / CAST(greatest(turns - 1, 1) AS DOUBLE) ELSE 0 END AS duplicate_ratio FROM f)"""


@query(f"WITH {_FEATURES} SELECT thread_id, turns, answers, empty_answers, round(median_chars, 6) AS median_chars, round(role_balance, 6) AS role_balance, round(russian_ratio, 6) AS russian_ratio, round(duplicate_ratio, 6) AS duplicate_ratio FROM g")
def v_dialogue_features(spark: SparkSession, sf: str) -> DataFrame:
    f = quality.dialogue_features(table(spark, sf, "sft_dialogues"), "thread_id", "messages")
    return f.withColumns({c: F.round(c, 6) for c in ("median_chars", "role_balance", "russian_ratio", "duplicate_ratio")})


@query(
    f"""WITH {_FEATURES}, s AS (SELECT count(*) AS dialogues, CAST(sum(answers) AS BIGINT) AS answers, sum(empty_answers) / CAST(greatest(sum(answers), 1) AS DOUBLE) AS e, median(median_chars) AS m, avg(role_balance) AS b, avg(russian_ratio) AS r, avg(duplicate_ratio) AS d FROM g)
SELECT dialogues, answers, round(e, 6) AS empty_ratio, round(m, 6) AS median_chars, round(b, 6) AS role_balance, round(r, 6) AS russian_ratio, round(d, 6) AS duplicate_ratio,
CASE WHEN answers > 0 AND e <= 0.01 AND m >= 40 AND b <= 0.3 AND r >= 0.9 AND d <= 0.05 THEN 'pass' ELSE 'fail' END AS verdict FROM s"""
)
def v_dialogue_quality(spark: SparkSession, sf: str) -> DataFrame:
    q = quality.dialogue_quality(table(spark, sf, "sft_dialogues"), "thread_id", "messages")
    return q.withColumns({c: F.round(c, 6) for c in ("empty_ratio", "median_chars", "role_balance", "russian_ratio", "duplicate_ratio")})


@query(
    """WITH t AS (SELECT thread_id, list_transform(list_filter(coalesce(messages, []), lambda m: m.role IS DISTINCT FROM 'system'), lambda m: coalesce(m.role, '')) AS r FROM sft_dialogues)
SELECT thread_id, len(r) > 0 AND len(r) % 2 = 0 AND len(list_filter(range(1, len(r) + 1), lambda i: r[i] <> CASE WHEN i % 2 = 1 THEN 'user' ELSE 'assistant' END)) = 0 AS conforms FROM t"""
)
def v_turn_structure(spark: SparkSession, sf: str) -> DataFrame:
    return quality.turn_structure(table(spark, sf, "sft_dialogues"), "thread_id", "messages")


@query("SELECT rec_id, CASE WHEN trim(coalesce(record, '')) = '' THEN 'blank' WHEN NOT json_valid(record) OR json_type(CASE WHEN json_valid(record) THEN record END) <> 'OBJECT' THEN 'corrupt' ELSE 'valid' END AS state FROM jsonl_records")
def s_lines(spark: SparkSession, sf: str) -> DataFrame:
    return exports.lines_state(table(spark, sf, "jsonl_records"), "record").select("rec_id", "state")


@query("SELECT rec_id FROM jsonl_records ORDER BY rec_id DESC LIMIT 25")
def s_tail(spark: SparkSession, sf: str) -> DataFrame:
    return exports.tail_holdout(table(spark, sf, "jsonl_records"), ["rec_id"], 25).select("rec_id")


@query()
def v_probe(spark: SparkSession, sf: str) -> DataFrame:
    return reports.production_probe(_clean(spark, sf), "text_clean", F.concat_ws("/", "chat_id", "msg_id"))


@query(
    """SELECT (SELECT count(*) FROM full_clean_messages) AS messages, (SELECT count(DISTINCT thread_id) FROM full_clean_messages) AS threads, count(*) FILTER (WHERE ok) AS valid_lines, count(*) FILTER (WHERE NOT ok) AS other_lines
FROM (SELECT coalesce(json_valid(record) AND json_type(CASE WHEN json_valid(record) THEN record END) = 'OBJECT', false) AS ok FROM jsonl_records)"""
)
def v_ci_stats(spark: SparkSession, sf: str) -> DataFrame:
    return reports.ci_stats(_clean(spark, sf), table(spark, sf, "jsonl_records"), "record")


# exports and evaluation


@query()
def x_response_scores(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.response_score(table(spark, sf, "dpo_preference_pairs").select("pair_id", "chosen"), "chosen", ["кластер", "индекс", "модель"])


@query()
def x_choice_letters(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "dpo_preference_pairs").select("pair_id", evaluation.choice_letter(F.col("chosen")).alias("letter"))

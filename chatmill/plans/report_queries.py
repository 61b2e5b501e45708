"""Queries of reports, exports and whole-table checks, with the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmill.functions.text import count_tokens
from chatmill.operators import analytics, audit, drift, evaluation, extract, network, quality, scrub, taxonomy
from chatmill.plans import pipeline
from chatmill.plans.queries import _EDGES, _S, _THREADED, _clean, _content, _halves, _rank_sql, _stripped, _threaded, _tokens, _values, _words
from chatmill.plans.queries import SQL as _OTHER
from chatmill.sources import contract
from chatmill.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# corpus reports


@query(f"SELECT doc_id, CASE WHEN length(coalesce(text, '')) = 0 THEN 0 ELSE greatest(1, {_tokens('text')}) END AS tokens FROM documents")
def p_count_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", count_tokens(F.col("text")).alias("tokens"))


@query(
    _rank_sql(
        f"""SELECT measure, v FROM (SELECT 'characters' AS measure, length(coalesce(text_clean, '')) AS v FROM full_clean_messages UNION ALL SELECT 'words', len({_words('text_clean')}) FROM full_clean_messages
  UNION ALL SELECT 'tokens', {_tokens('text_clean')} FROM full_clean_messages UNION ALL SELECT 'messages an author', count(*) FROM full_clean_messages GROUP BY coalesce(author_anon, ''))""",
        "measure",
    )
)
def a_volume_distributions(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.volume_distributions(_clean(spark, sf)).withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query("SELECT CAST(h AS VARCHAR) AS bucket, n AS messages FROM (SELECT hour(make_timestamp(unixtime * 1000000)) AS h, count(*) AS n FROM full_clean_messages WHERE unixtime IS NOT NULL GROUP BY h) ORDER BY n DESC, h LIMIT 1")
def a_busiest_hour(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.busiest(_clean(spark, sf), "hour")


_TECHNICAL = ", ".join("('" + w.replace("'", "''") + "')" for w in sorted({*analytics.SLANG, *taxonomy.AI, *taxonomy.BACKEND, *taxonomy.DEVOPS}))


@query(
    f"""WITH s AS (SELECT CAST(year(make_timestamp(unixtime * 1000000)) AS INT) AS year, unnest({_content('text_clean')}) AS term FROM full_clean_messages WHERE unixtime IS NOT NULL),
n AS (SELECT year, term, count(*) AS n FROM s GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY n DESC, term) AS p FROM n),
k AS (SELECT year, term, n, CAST(row_number() OVER (PARTITION BY year ORDER BY n DESC, term) AS INT) AS place FROM r WHERE p <= 40 AND term IN (SELECT * FROM (VALUES {_TECHNICAL}) v(t))),
y AS (SELECT CAST(year(make_timestamp(unixtime * 1000000)) AS INT) AS year, count(*) AS messages FROM full_clean_messages WHERE unixtime IS NOT NULL GROUP BY 1)
SELECT year, term, n, place, messages FROM k JOIN y USING (year) WHERE place <= 8"""
)
def a_yearly_technology(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.yearly_technology(_clean(spark, sf), "text_clean")


@query(
    f"""WITH c AS (SELECT {_content('text_clean')} AS w, author_id_anon AS a, domain, is_question FROM full_clean_messages), k AS (SELECT t, count(*) AS c FROM (SELECT unnest(w) AS t FROM c) GROUP BY t),
e AS (SELECT log2(sum(c)) - sum(c * log2(c)) / sum(c) AS e FROM k), f AS (SELECT count(*) AS m, count(DISTINCT a) AS a, count(*) FILTER (WHERE domain <> 'general_tech_chat') AS d, count(*) FILTER (WHERE is_question) AS q FROM c),
p AS (SELECT CASE WHEN m >= 300000 THEN 25 WHEN m >= 100000 THEN 18 WHEN m >= 30000 THEN 10 ELSE 5 END AS volume_score, CASE WHEN a >= 2000 THEN 20 WHEN a >= 500 THEN 15 WHEN a >= 100 THEN 10 ELSE 5 END AS author_score,
  CASE WHEN d / greatest(m, 1) >= 0.35 THEN 20 WHEN d / greatest(m, 1) >= 0.2 THEN 15 ELSE 10 END AS technical_score, CASE WHEN q / greatest(m, 1) >= 0.15 THEN 15 ELSE 8 END AS dialogue_score,
  CASE WHEN coalesce(e, 0) >= 10 THEN 10 WHEN coalesce(e, 0) >= 7 THEN 7 ELSE 3 END AS lexical_score, 10 AS pii_score FROM f, e),
t AS (SELECT *, least(volume_score + author_score + technical_score + dialogue_score + lexical_score + pii_score, 100) AS total_score FROM p)
SELECT *, CASE WHEN total_score >= 85 THEN 'A' WHEN total_score >= 70 THEN 'B' ELSE 'C' END AS tier FROM t"""
)
def a_quality_index(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.quality_index(_clean(spark, sf))


@query(
    f"""WITH {_EDGES}, d AS (SELECT recipient AS author, weight AS r, 0 AS g FROM w UNION ALL SELECT sender, 0, weight FROM w), s AS (SELECT author, CAST(sum(r) AS BIGINT) AS r, CAST(sum(g) AS BIGINT) AS g FROM d GROUP BY author),
x AS (SELECT 'received' AS kind, CAST(row_number() OVER (ORDER BY r DESC, author) AS INT) AS place, author, r AS n FROM s WHERE r > 0 UNION ALL SELECT 'given', CAST(row_number() OVER (ORDER BY g DESC, author) AS INT), author, g FROM s WHERE g > 0)
SELECT * FROM x WHERE place <= 15"""
)
def n_top_degrees(spark: SparkSession, sf: str) -> DataFrame:
    return network.top_degrees(network.edges(network.interactions(_clean(spark, sf))))


@query(
    f"""WITH {_EDGES}, p AS (SELECT x.sender AS user_a, x.recipient AS user_b, x.weight + y.weight AS total FROM w x JOIN w y ON x.sender = y.recipient AND x.recipient = y.sender AND x.sender < x.recipient)
SELECT * FROM p WHERE total >= 10 ORDER BY total DESC, user_a, user_b LIMIT 12"""
)
def n_strong_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return network.strong_pairs(network.edges(network.interactions(_clean(spark, sf))))


# tags, dialogues and preferences

_KEYS = _values((k,) for k in sorted({k for ks in taxonomy.TAXONOMY.values() for k in ks}))


@query(
    rf"""WITH k AS (SELECT * FROM (VALUES {_KEYS}) v(tag)), t AS (SELECT chat_id, msg_id, lower(text_clean) AS low FROM full_clean_messages WHERE text_clean IS NOT NULL)
SELECT chat_id, msg_id, tag FROM t JOIN k ON contains(low, tag) WHERE regexp_matches(low, '(?:^|[^\p{{L}}\p{{N}}_-])' || regexp_escape(tag) || '(?:$|[^\p{{L}}\p{{N}}_-])')"""
)
def t_tags(spark: SparkSession, sf: str) -> DataFrame:
    return _clean(spark, sf).select("chat_id", "msg_id", F.explode(taxonomy.tags(F.col("text_clean"))).alias("tag"))


_B, _E = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"
_MARKS = (
    rf"(?i){_B}языковая{_S}+модель{_E}", rf"(?i){_B}искусственный{_S}+интеллект{_E}", rf"(?i){_B}я{_S}*[-—–]?{_S}*(?:языковая{_S}+модель|искусственный{_S}+интеллект|виртуальный{_S}+ассистент|бот|ии){_E}",
    rf"(?i){_B}(?:as{_S}+an?{_S}+ai|as{_S}+a{_S}+language{_S}+model|i{_S}+am{_S}+an?{_S}+ai|i''m{_S}+a{_S}+language{_S}+model){_E}", rf"(?i){_B}нас{_S}*\(модели{_S}+[a-z0-9_-]+\){_S}*тренируют",
    rf"(?i){_B}мои{_S}+разработчики{_S}+из{_S}+(?:openai|anthropic|google|yandex){_E}", rf"(?im){_B}(?:claude{_S}+[0-9.]+{_S}*(?:sonnet|opus|haiku)?|gemini{_S}+[0-9.]+{_S}*(?:pro|flash)?|chatgpt){_S}*$",
)


def _machine(t: str) -> str:
    return "(" + " OR ".join(f"coalesce(regexp_matches({t}, '{p}'), false)" for p in _MARKS) + ")"


_ALL = "[" + ", ".join("'" + k.replace("'", "''") + "'" for k in sorted({k for ks in taxonomy.TAXONOMY.values() for k in ks})) + "]"


def _quality(t: str) -> str:
    return f"""(CASE WHEN len({_words(t)}) < 2 THEN 0.0 WHEN {_machine(t)} THEN 0.1 WHEN regexp_replace(lower({t}), '^[!.?,]+|[!.?,]+$', '', 'g') = 'не знаю' THEN 0.2
  ELSE 1 + least(3.0, len({_words(t)}) / CAST(15.0 AS DOUBLE)) + least(3.0, CAST(0.6 AS DOUBLE) * list_sum(list_transform({_ALL}, lambda k: CAST(contains(lower({t}), k) AS INT))))
  + CASE WHEN len(regexp_extract_all({t}, '[.!?]')) >= 2 THEN 0.5 ELSE 0 END END)"""


@query(
    f"""WITH {_THREADED}, g AS (SELECT thread_id FROM m GROUP BY thread_id HAVING count(*) >= 2 AND min(coalesce(author_id_anon, '')) <> max(coalesce(author_id_anon, ''))),
s AS (SELECT *, CASE WHEN lag(pos) OVER w IS NOT NULL AND lag(author_id_anon) OVER w IS NOT DISTINCT FROM author_id_anon THEN 0 ELSE 1 END AS b FROM m WHERE length({_stripped("coalesce(text_clean, '')")}) >= 3 WINDOW w AS (PARTITION BY thread_id ORDER BY pos)),
r AS (SELECT *, sum(b) OVER (PARTITION BY thread_id ORDER BY pos) AS turn FROM s),
t AS (SELECT thread_id, turn, arg_min(coalesce(author_anon, chr(1)), pos) AS author, string_agg(text_clean, chr(10) ORDER BY pos) AS content, arg_min(text_clean, pos) AS opening FROM r WHERE turn <= 32 GROUP BY ALL),
q AS (SELECT *, {_quality('opening')} AS quality, {_tokens('content')} AS tokens, {_machine('content')} AS machine FROM t),
w AS (SELECT thread_id, max(turn) - max(turn) % 2 AS n, sum(quality) AS quality, sum(tokens) AS tokens FROM q GROUP BY thread_id HAVING max(turn) >= 2),
k AS (SELECT w.* FROM w JOIN g USING (thread_id) WHERE (w.quality / w.n >= 2 OR w.n >= 4) AND NOT EXISTS (SELECT 1 FROM q WHERE q.thread_id = w.thread_id AND q.turn <= w.n AND q.machine))
SELECT k.thread_id, CAST(q.turn - 1 AS INT) AS turn_no, nullif(q.author, chr(1)) AS author, q.content, CASE WHEN q.turn % 2 = 1 THEN 'user' ELSE 'assistant' END AS role, round(k.quality / k.n, 6) AS quality_score, CAST(k.n AS BIGINT) AS turn_count, CAST(k.tokens AS BIGINT) AS total_tokens
FROM k JOIN q ON q.thread_id = k.thread_id AND q.turn <= k.n"""
)
def e_dialogue_turns(spark: SparkSession, sf: str) -> DataFrame:
    found = extract.extract_dialogues(_threaded(spark, sf))
    return found.select("thread_id", F.posexplode("messages").alias("turn_no", "m"), F.round("quality_score", 6).alias("quality_score"), "turn_count", "total_tokens").select("thread_id", "turn_no", "m.author", "m.content", "m.role", "quality_score", "turn_count", "total_tokens")


@query(
    f"""WITH {_THREADED}, r AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY thread_id) AS n FROM m) WHERE pos = 1 AND n >= 3 AND len({_words('text_clean')}) >= 3),
o AS (SELECT m.thread_id, m.pos, m.text_clean AS reply, {_quality('m.text_clean')} AS score, r.text_clean AS prompt, r.domain FROM m JOIN r USING (thread_id)
  WHERE m.pos > 1 AND m.author_id_anon IS DISTINCT FROM r.author_id_anon AND length({_stripped('m.text_clean')}) > 3),
b AS (SELECT thread_id, count(*) AS n, arg_max({{'t': reply, 's': score}}, {{'s': score, 'p': -pos}}) AS best, arg_min({{'t': reply, 's': score}}, {{'s': score, 'p': -pos}}) AS worst, any_value(prompt) AS prompt, any_value(domain) AS domain FROM o GROUP BY thread_id)
SELECT thread_id, prompt, best.t AS chosen, worst.t AS rejected, domain, round(best.s, 6) AS chosen_quality, round(worst.s, 6) AS rejected_quality FROM b
WHERE n >= 2 AND best.s - worst.s >= 1.5 - 1e-9 AND best.s >= 3 - 1e-9 AND NOT {_machine('best.t')}"""
)
def e_preferences(spark: SparkSession, sf: str) -> DataFrame:
    found = extract.extract_preferences(_threaded(spark, sf))
    return found.withColumns({c: F.round(c, 6) for c in ("chosen_quality", "rejected_quality")})


@query(f"SELECT chat_id, msg_id, round({_quality('text_clean')}, 6) AS quality FROM full_clean_messages")
def e_message_quality(spark: SparkSession, sf: str) -> DataFrame:
    return _clean(spark, sf).select("chat_id", "msg_id", F.round(extract.message_quality(F.col("text_clean")), 6).alias("quality"))


@query(
    rf"""WITH {_THREADED}, d AS (SELECT thread_id, coalesce(domain, 'general_tech_chat') AS domain, count(*) AS n, min(pos) AS p FROM m GROUP BY ALL), o AS (SELECT thread_id, arg_max(domain, {{'n': n, 'a': -p}}) AS topic_domain FROM d GROUP BY thread_id),
g AS (SELECT thread_id, array_to_string(list_slice(list_sort(list(DISTINCT t)), 1, 6), '|') AS tags FROM (SELECT thread_id, unnest(tags) AS t FROM m) WHERE t IS NOT NULL GROUP BY thread_id),
c AS (SELECT thread_id, arg_min(chat_name, pos) AS chat_name, replace(coalesce(arg_min(coalesce(text_clean, ''), pos), ''), chr(10), ' ') AS first,
  left(arg_min(timestamp, pos), 10) AS a, left(arg_max(timestamp, pos), 10) AS b, count(DISTINCT author_anon) AS participants_count, count(*) AS message_count,
  coalesce(string_agg('[' || coalesce(author_anon, '') || ']: ' || text_clean, chr(10) ORDER BY pos) FILTER (WHERE length({_stripped("coalesce(text_clean, '')")}) > 1), '') AS content FROM m GROUP BY thread_id)
SELECT printf('rag_kb_%06d', thread_id) AS chunk_id, thread_id, chat_name, CASE WHEN length(first) > 90 THEN left(first, 90) || '...' WHEN first = '' THEN 'Technical discussion in ' || chat_name ELSE first END AS title,
topic_domain, coalesce(tags, '') AS topic_tags, CASE WHEN a = b THEN a ELSE a || ' — ' || b END AS date_range, participants_count, message_count, {_tokens('content')} AS token_count, md5(content) AS content_md5
FROM c JOIN o USING (thread_id) LEFT JOIN g USING (thread_id) WHERE {_tokens('content')} >= 15"""
)
def e_chunks(spark: SparkSession, sf: str) -> DataFrame:
    found = extract.extract_chunks(_threaded(spark, sf)).withColumn("content_md5", F.md5("content")).withColumn("topic_tags", F.array_join("topic_tags", "|"))
    return found.drop("content")


# audits and checks


@query("SELECT * FROM (VALUES " + ", ".join("('" + n + "', '" + e.replace("'", "''") + "', true)" for n, _, e in pipeline.RED_TEAM) + ") v(test_name, expected, passed)")
def v_red_team(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.red_team(spark)


@query()
def v_leak_probe(spark: SparkSession, sf: str) -> DataFrame:
    return quality.leak_probe(contract.chatml(table(spark, sf, "sft_dialogues")), "line", ["thread_id"])


@query()
def v_audit_strata(spark: SparkSession, sf: str) -> DataFrame:
    return audit.audit_strata(_clean(spark, sf), "text_clean", "chat_name", F.concat_ws("/", "chat_id", "msg_id"))


@query(f"WITH a AS ({_OTHER['v_length_shift']}), b AS ({_OTHER['v_label_shift']}), c AS ({_OTHER['v_vocabulary_shift']}), v AS (SELECT verdict FROM a UNION ALL SELECT verdict FROM b UNION ALL SELECT verdict FROM c) SELECT arg_max(verdict, list_position(['stable', 'moderate_drift', 'significant_drift'], verdict)) AS verdict FROM v")
def v_drift_verdict(spark: SparkSession, sf: str) -> DataFrame:
    a, b = _halves(spark, sf)
    return drift.overall(drift.length_shift(a, b, "text_clean"), drift.label_shift(a, b, "domain"), drift.vocabulary_shift(a, b, "text_clean"))


@query(
    """WITH t AS (SELECT count(*) FILTER (WHERE a AND b) AS both, count(*) FILTER (WHERE a AND NOT b) AS only_a, count(*) FILTER (WHERE NOT a AND b) AS only_b, count(*) FILTER (WHERE NOT a AND NOT b) AS neither FROM (SELECT length(chosen) > 100 AS a, length(rejected) > 100 AS b FROM dpo_preference_pairs)),
n AS (SELECT *, only_a + only_b AS n, least(only_a, only_b) AS k FROM t)
SELECT "both", only_a, only_b, neither, round(CASE WHEN n = 0 THEN 1 ELSE least(1.0, 2 * list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) - n * ln(2))))) END, 9) AS p_value FROM n"""
)
def v_mcnemar(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "dpo_preference_pairs").select((F.length("chosen") > 100).alias("a"), (F.length("rejected") > 100).alias("b"))
    return audit.mcnemar(rows, "a", "b").withColumn("p_value", F.round("p_value", 9))


_NEEDED = " AND ".join(f"(artifact <> '{a}' OR len(list_filter([{', '.join(repr(k) for k in ks)}], lambda k: NOT list_contains(keys, k))) = 0)" for a, ks in quality.REQUIRED_KEYS.items())


@query(
    f"""WITH s AS (SELECT artifact, trim(coalesce(record, '')) = '' AS blank, coalesce(json_valid(record) AND json_type(CASE WHEN json_valid(record) THEN record END) = 'OBJECT', false) AS ok, record FROM jsonl_records),
k AS (SELECT artifact, blank, ok, json_keys(CASE WHEN ok THEN record END) AS keys FROM s), c AS (SELECT artifact, blank, ok, coalesce({_NEEDED}, true) AS shaped FROM k)
SELECT artifact, count(*) AS lines, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE NOT blank AND NOT ok) AS corrupt, count(*) FILTER (WHERE ok AND NOT shaped) AS shape_errors, count(*) FILTER (WHERE ok AND shaped) AS valid FROM c GROUP BY artifact"""
)
def v_lines(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_lines(table(spark, sf, "jsonl_records"), "artifact", "record")


# exported lines; dialogues and pairs as JSON, which both engines write alike


@query(
    """SELECT thread_id, CAST(to_json({'id': 'dialogue_' || thread_id, 'chat': chat_name, 'domain': topic_domain, 'tags': topic_tags, 'quality_score': quality_score,
  'conversations': list_transform(messages, lambda m: {'from': CASE WHEN m.role = 'user' THEN 'human' ELSE 'gpt' END, 'value': m.content})}) AS VARCHAR) AS line FROM sft_dialogues"""
)
def k_sharegpt(spark: SparkSession, sf: str) -> DataFrame:
    return contract.sharegpt(table(spark, sf, "sft_dialogues"))


@query(
    """SELECT thread_id, CAST(to_json({'instruction': messages[i].content, 'input': '', 'output': messages[i + 1].content, 'domain': topic_domain, 'tags': topic_tags, 'quality_score': quality_score}) AS VARCHAR) AS line
FROM (SELECT *, unnest(range(1, len(messages))) AS i FROM sft_dialogues) WHERE messages[i].role = 'user' AND messages[i + 1].role = 'assistant'"""
)
def k_alpaca(spark: SparkSession, sf: str) -> DataFrame:
    return contract.alpaca(table(spark, sf, "sft_dialogues"))


@query(
    f"""SELECT thread_id, CAST(to_json({{'id': 'chat_' || thread_id, 'domain': topic_domain, 'tags': topic_tags, 'quality': quality_score,
  'messages': list_concat([{{'role': 'system', 'content': '{contract.SYSTEM_MESSAGE}'}}], list_transform(messages, lambda m: {{'role': m.role, 'content': m.content}}))}}) AS VARCHAR) AS line FROM sft_dialogues"""
)
def k_chatml(spark: SparkSession, sf: str) -> DataFrame:
    return contract.chatml(table(spark, sf, "sft_dialogues"))


@query("SELECT CAST(to_json({'thread_id': thread_id, 'prompt': prompt, 'chosen': chosen, 'rejected': rejected, 'domain': domain, 'chosen_quality': chosen_quality, 'rejected_quality': rejected_quality}) AS VARCHAR) AS line FROM dpo_preference_pairs")
def k_preference_lines(spark: SparkSession, sf: str) -> DataFrame:
    return contract.plain_lines(table(spark, sf, "dpo_preference_pairs").drop("pair_id"))


@query(
    """SELECT thread_id, i - 1 AS pair_no, messages[i].content AS instruction, messages[i + 1].content AS output, topic_domain AS domain, array_to_string(topic_tags, '|') AS tags, quality_score FROM (SELECT *, unnest(range(1, len(messages))) AS i FROM sft_dialogues)
WHERE messages[i].role = 'user' AND messages[i + 1].role = 'assistant'"""
)
def k_instruction_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return contract.instruction_pairs(table(spark, sf, "sft_dialogues")).select("thread_id", "pair_no", "instruction", "output", "domain", F.array_join("tags", "|").alias("tags"), "quality_score")


@query("SELECT thread_id, CASE WHEN n > 50 AND r > n - 50 THEN 'holdout' ELSE 'rest' END AS part FROM (SELECT thread_id, count(*) OVER () AS n, row_number() OVER (ORDER BY thread_id) AS r FROM sft_dialogues)")
def x_holdout(spark: SparkSession, sf: str) -> DataFrame:
    rows = evaluation.training_split(table(spark, sf, "sft_dialogues"), ["thread_id"], F.col("thread_id"), 50, None, 0.1)
    return rows.select("thread_id", F.when(F.col("part") == "holdout", "holdout").otherwise("rest").alias("part"))


@query(
    r"""WITH e AS (SELECT chat_id, msg_id, batch_id, ' ' || text_raw || ' ' AS t FROM normalized_messages),
r AS (SELECT *, '([^\p{L}\p{N}_])([A-Za-z0-9_][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,7})([^\p{L}\p{N}_])' AS p FROM e),
o AS (SELECT *, CASE WHEN contains(t, '@') THEN regexp_replace(regexp_replace(t, p, '\1[EMAIL_REDACTED]\3', 'g'), p, '\1[EMAIL_REDACTED]\3', 'g') ELSE t END AS s FROM r)
SELECT chat_id, msg_id, batch_id, substr(s, 2, length(s) - 2) AS text_scrubbed, CAST(coalesce((length(s) - length(replace(s, '[EMAIL_REDACTED]', ''))) // 16 - (length(t) - length(replace(t, '[EMAIL_REDACTED]', ''))) // 16, 0) AS BIGINT) AS n_emails FROM o"""
)
def r_emails(spark: SparkSession, sf: str) -> DataFrame:
    rule = [r for r in scrub.RULES if r.category == "emails"]
    return scrub.scrub(table(spark, sf, "normalized_messages"), "text_raw", rule).select("chat_id", "msg_id", "batch_id", "text_scrubbed", "n_emails")

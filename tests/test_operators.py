import itertools

import pytest
from chatmill.functions import text as T
from chatmill.operators import analytics, audit, dedup, evaluation, extract, network, pseudonyms, quality, scrub, taxonomy, threads
from chatmill.sources import contract, exports
from pyspark.sql import functions as F


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column.alias("x")).first().x


def test_text_functions(spark):
    t = F.col("t")
    assert one(spark, T.word_count(t), " а б \n") == 2 and one(spark, T.word_count(t), None) == 0 and one(spark, T.word_count(t), "") == 0
    assert one(spark, T.normalized(t), "  Привет,\tМИР_1! ") == "привет мир_1"
    assert one(spark, T.token_count(t), "a b c") == 4


SECRETS = [
    ("пиши на ivan.petrov@mail.example", "[EMAIL_REDACTED]"),
    ("звони +7 (912) 345-67-89", "[PHONE_REDACTED]"),
    ("key sk-" + "a" * 24, "[API_KEY_REDACTED]"),
    ("ghp_" + "b" * 30, "[API_KEY_REDACTED]"),
    ("AKIA" + "C" * 16, "[AWS_KEY_REDACTED]"),
    ('password = "abcdefghijkl99"', "[SECRET_REDACTED]"),
    ("postgres://u:p@h/db", "[DATABASE_URL_REDACTED]"),
    ("сервер 93.184.216.34 лежит", "[IP_REDACTED]"),
    ("t.me/joinchat/abc", "[INVITE_LINK_REDACTED]"),
    ("спроси @some_user", "@user_anon"),
    ("0x" + "a" * 40, "[CRYPTO_WALLET_ETH]"),
    ("-----BEGIN RSA PRIVATE KEY-----\nx\n-----END RSA PRIVATE KEY-----", "[PRIVATE_KEY_REDACTED]"),
]


@pytest.mark.parametrize("text, token", SECRETS)
def test_scrub(spark, text, token):
    row = scrub.scrub(spark.createDataFrame([(text,)], "t string"), "t").first()
    assert token in row.text_scrubbed
    again = scrub.scrub(spark.createDataFrame([(row.text_scrubbed,)], "t string"), "t").first()
    assert again.text_scrubbed == row.text_scrubbed


@pytest.mark.parametrize("text", ["версия 1.2.3", "127.0.0.1", "8.8.8.8", "1.2.3.4", "a=12", "", None, "просто текст"])
def test_scrub_leaves(spark, text):
    assert scrub.scrub(spark.createDataFrame([(text,)], "t string"), "t").first().text_scrubbed == text


def test_community_names(spark):
    rule = scrub.community_rule(["Тихий чат", "node"])
    row = scrub.scrub(spark.createDataFrame([("в ТИХИЙ  чат и nodejs",)], "t string"), "t", [rule]).first()
    assert row.text_scrubbed == "в [COMMUNITY_REDACTED] и nodejs" and row.n_community_names == 1


def test_pseudonyms(spark):
    rows = spark.createDataFrame([(1, "u1", "A"), (2, "u2", "A"), (3, "none", "B"), (4, "u1", "C")], "at long, id string, name string")
    got = {r.author_key: r.user_pseudonym for r in pseudonyms.pseudonyms(rows, "id", "name", ["at"]).collect()}
    assert got == {"u1": "user_00001", "u2": "user_00002", "B": "user_00003"}


def test_mask_words_both_ways(spark):
    rows = spark.createDataFrame([("Иван и Иванов, Иван!",), (None,), ("",)], "t string")
    names = spark.createDataFrame([("Иван",)], "word string")
    a = [r.text_masked for r in pseudonyms.mask_words(rows, "t", names).collect()]
    b = [r.text_masked for r in pseudonyms.mask_words(rows, "t", names, most_bytes=0).collect()]
    assert sorted(map(str, a)) == sorted(map(str, b)) and "[PERSON_REDACTED] и Иванов, [PERSON_REDACTED]!" in a


def test_exact_duplicates(spark):
    rows = spark.createDataFrame([(1, "Один длинный текст!"), (2, "один  длинный ТЕКСТ"), (3, "ок"), (4, "ок"), (5, None)], "k long, t string")
    assert sorted(r.k for r in dedup.exact_duplicates(rows, "t", ["k"]).collect()) == [1, 3, 4, 5]
    kept = dedup.exact_duplicates(rows, "t", ["k"])
    assert kept.count() == dedup.exact_duplicates(kept, "t", ["k"]).count()


def test_near_duplicates_are_greedy(spark):
    words = [f"слово{k}" for k in range(60)]
    a, b = " ".join(words), " ".join([*words[:-1], "конец"])
    rows = spark.createDataFrame([(1, a), (2, b), (3, a), (4, "совсем другой и довольно длинный текст про кошек и собак"), (5, "мало"), (6, None)], "k long, t string")
    got = {r.k: r.kept for r in dedup.near_duplicates(rows, "k", "t").collect()}
    assert got == {1: True, 2: False, 3: False, 4: True, 5: True, 6: True}


def test_near_duplicates_are_measured_on_five_words(spark):
    words = [f"слово{k}" for k in range(40)]
    # one word changed: 35 of 41 three-word shingles (0.85) and 31 of 41 five-word ones (0.76) are shared
    rows = spark.createDataFrame([(1, " ".join(words)), (2, " ".join([*words[:20], "иное", *words[21:]]))], "k long, t string")
    assert all(r.kept for r in dedup.near_duplicates(rows, "k", "t").collect())
    assert {r.k: r.kept for r in dedup.near_duplicates(rows, "k", "t", size=3).collect()} == {1: True, 2: False}


def test_near_duplicates_are_compared_exactly(spark):
    # pairs that share 36 of 45 shingles (0.8) and, with an end of one word more, 36 of 46 (0.78)
    rows = []
    for g in range(40):
        words = [f"г{g}слово{k}" for k in range(44)]
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join([*words[:-4], *[f"г{g}иное{k}" for k in range(g % 2 + 5)]]))]
    got = {r.k: r.kept for r in dedup.near_duplicates(spark.createDataFrame(rows, "k long, t string"), "k", "t").collect()}
    assert got == {k: k % 4 != 1 for k in range(80)}


def test_topics_know_late_authors(spark):
    # the last 30 of 230 authors have words of their own, as the busiest author has in the last of many messages
    rows = [(a, a, f"u{a}", " ".join(["квазар пульсар" if a >= 200 else f"сервер{a % 7} база{a % 5}"] * 15)) for a in range(230)]
    rows += [(m, m, "u0", "туманность галактика" if m >= 900 else "сервер0 база0") for m in range(300, 1000)]
    frame = spark.createDataFrame(rows, "msg_id long, unixtime long, who string, t string").withColumn("chat_id", F.lit(1))
    terms = {r.term for r in analytics.topics(frame, "who", "t", k=2, words=16).collect()}
    assert {"квазар", "пульсар", "туманность", "галактика"} <= terms


def test_taxonomy(spark):
    rows = spark.createDataFrame([("Поднял docker-compose, react native и C++ в докере",), ("docker. конец",), (None,), ("",)], "t string")
    got = taxonomy.tagged(rows, "t").collect()
    assert got[0].tags_found == ["c++", "docker-compose", "react", "react native"]
    assert got[1].domain_found == "general_tech_chat" and got[1].tags_found == ["docker"]
    assert [r.sentiment_found for r in got] == [0, 0, 0, 0]
    assert one(spark, taxonomy.sentiment(F.col("t")), "спасибо, помогло, но баг") == 2


BASE = 1_767_225_600


def messages(spark, rows):
    return spark.createDataFrame([(1, m, BASE + at, reply) for m, at, reply in rows], "chat_id long, msg_id long, unixtime long, reply_to_id long")


@pytest.mark.parametrize(
    "rows, want",
    [
        ([(1, 0, None), (2, 60, 1), (3, 120, 2)], [{1, 2, 3}]),
        ([(1, 0, None), (2, 176400, 1)], [{1}, {2}]),
        ([(1, 0, None), (2, 60, 1), (10, 200, None), (11, 260, 10)], [{1, 2}, {10, 11}]),
        ([(1, 0, None), (2, 60, None), (3, 120, None), (10, 10000, None)], [{1, 2, 3}, {10}]),
        ([(1, 0, None), (2, 60, 999)], [{1, 2}]),
        ([(1, 0, None), (2, 60, None), (3, 120, None), (10, 10000, None), (11, 10060, 10), (4, 20000, None), (5, 20060, None)], [{10, 11}, {1, 2, 3}, {4, 5}]),
        ([(1, 0, 2), (2, 0, 1)], [{1, 2}]),
        ([], []),
    ],
)
def test_threads(spark, rows, want):
    found = {}
    for r in threads.build_threads(messages(spark, rows)).collect():
        found.setdefault(r.thread_id, set()).add(r.msg_id)
    assert [found[k] for k in sorted(found)] == want


FULL = "thread_id long, pos long, chat_name string, author_anon string, author_id_anon string, text_clean string, timestamp string, domain string, tags array<string>"


def thread(spark, *said):
    return spark.createDataFrame([(1, k + 1, "c", f"n{a}", a, t, "2026-01-01T00:00:00", "d", ["x"]) for k, (a, t) in enumerate(said)], FULL)


def test_dialogue(spark):
    long = "docker и python " * 10
    rows = thread(spark, ("a", "как поднять сервер?"), ("a", "и базу?"), ("b", long), ("a", "спасибо большое"))
    d = extract.extract_dialogues(rows).first()
    assert [m.role for m in d.messages] == ["user", "assistant"] and d.messages[0].content == "как поднять сервер?\nи базу?" and d.turn_count == 2
    assert extract.extract_dialogues(thread(spark, ("a", "раз два три"), ("a", "четыре"))).count() == 0
    assert extract.extract_dialogues(thread(spark, ("a", "вопрос про это"), ("b", "как языковая модель я не могу " + long))).count() == 0


def test_preferences(spark):
    good = "docker python linux nginx redis " * 6
    rows = thread(spark, ("a", "что лучше взять?"), ("b", good), ("c", "не знаю"), ("d", "да"), ("a", "мои слова"))
    p = extract.extract_preferences(rows).first()
    assert p.chosen == good and p.rejected == "не знаю"
    assert extract.extract_chunks(rows).first().chunk_id == "rag_kb_000001"


def test_interactions(spark):
    rows = spark.createDataFrame([(1, 1, 0, "a", None), (1, 2, 60, "b", None), (2, 3, 70, "c", None), (1, 4, 80, "a", 2.0), (1, 5, 90, "a", 1.0)], "chat_id long, msg_id long, unixtime long, author_anon string, reply_to_id double")
    assert sorted(map(tuple, network.interactions(rows).collect())) == [("a", "b"), ("b", "a")]


def test_audit_numbers(spark):
    assert abs(audit.z_value(0.95) - 1.959964) < 1e-5
    rows = spark.createDataFrame([(True, False)] * 8 + [(False, True)] * 2 + [(True, True)] * 5, "a boolean, b boolean")
    assert abs(audit.mcnemar(rows, "a", "b").first().p_value - 0.109375) < 1e-9
    clean = spark.range(1000).select(F.lit("чисто").alias("t"), F.lit("s").alias("s"), "id")
    total = audit.run_audit(clean, "t", "s", F.col("id"), tolerance=0.01).where("category = 'total'").first()
    assert total.verdict == "PASSED" and total.leaks == 0
    with pytest.raises(ValueError):
        audit.run_audit(clean, "missing", "s", F.col("id"))
    assert audit.run_audit(clean.limit(0), "t", "s", F.col("id")).where("category = 'total' and messages = 0 and verdict = 'FAILED'").count() == 1


def test_quality_and_gate(spark):
    kind = "thread_id long, messages array<struct<author: string, content: string, role: string, timestamp: string>>"
    rows = spark.createDataFrame([(1, [("a", "вопрос", "user", None), ("b", "", "assistant", None)]), (2, None), (3, [])], kind)
    f = {r.thread_id: r for r in quality.dialogue_features(rows, "thread_id", "messages").collect()}
    assert f[1].empty_answers == 1 and f[2].turns == 0 and f[3].role_balance == 1.0
    assert quality.dialogue_quality(rows.limit(0), "thread_id", "messages").first().verdict == "no_data"
    assert not any(r.conforms for r in quality.turn_structure(rows, "thread_id", "messages").where("thread_id > 1").collect())
    good = {"validation": {"overall_passed": True}, "audit": {"verdict": "PASSED"}, "drift": {"overall_verdict": "moderate_drift"}}
    assert quality.release_gate(good, True)[0] == "SHIP" and quality.release_gate(good, True, synthetic=True)[0] == "HOLD"
    assert quality.release_gate({**good, "audit": None}, True)[0] == "HOLD" and quality.release_gate(good, False)[0] == "HOLD"
    runs = spark.createDataFrame([(100, 1600, 0, None, 0.0, None), (50, 1600, 0, None, 0.0, None), (100, 3200, 0, 1600, 0.0, None)], "actual_steps long, total long, holdout long, max_samples long, eval_frac double, time_budget double")
    assert [r.compliant for r in quality.training_coverage(runs).collect()] == [True, False, False]


def test_reports(tmp_path):
    from chatmill.operators import reports

    assert reports.bar(5, 10, 4) == "██░░" and reports.bar(1, 0, 2) == "░░"
    assert "| a | b |" in reports.markdown({"x": [{"a": 1, "b": "c|d"}], "y": []}) and "c\\|d" in reports.markdown({"x": [{"b": "c|d"}]})
    assert reports.load_report(str(tmp_path / "none")) == {}
    assert reports.key_figures({}, {"volume": [{"messages": 3, "authors": 2, "tokens": 9}]}) == {"messages": 3, "authors": 2, "tokens": 9, "dialogues": 0, "pairs": 0}


def test_choice_letters(spark):
    cases = {"A": "A", "Ответ: B": "B", "(C)": "C", "The answer is D": "D", "(в)": "B", "Ответ: в": "B", "Вариант В": "B", "Это вариант с": None, "Я не знаю в чём дело": None, "Compose a docker file": None, "": None, None: None}
    rows = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.x for r in rows.select("t", evaluation.choice_letter(F.col("t")).alias("x")).collect()} == cases


def test_contract_and_manifest(spark, tmp_path):
    rows = spark.createDataFrame([(1, "текст", "x"), (2, " ", "y")], "msg_id long, text_clean string, extra string")
    contract.write_artifact(rows, "full_clean_messages", str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 1 and quality.check_contract(back.schema, contract.SCHEMAS["full_clean_messages"])[0] == "VALID"
    with pytest.raises(ValueError):
        contract.align(rows, contract.SCHEMAS["full_clean_messages"], strict=True)
    (tmp_path / "f.jsonl").write_text("{}\n\n{}\n")
    entries = contract.manifest([(str(tmp_path), "f.jsonl")])
    assert entries[0]["rows"] == 2 and contract.verify_manifest(str(tmp_path), entries) == []
    (tmp_path / "f.jsonl").write_text("{}\n")
    assert contract.verify_manifest(str(tmp_path), entries) == ["f.jsonl"]
    with pytest.raises(ValueError):
        contract.manifest([(str(tmp_path), "../x")])


def test_read_exports(spark, tmp_path):
    import json

    d = tmp_path / "ChatExport_1"
    d.mkdir()
    raw = [
        {"id": 5, "type": "message", "date_unixtime": "100", "from": "A", "from_id": "u1", "text": ["при", {"type": "bold", "text": "вет"}, 1]},
        {"id": "bad", "date": "2026-01-01T00:00:00", "from": "", "actor": "B", "text": " x ", "photo": "p", "reply_to_message_id": 5},
        "junk",
        {"id": 7, "type": "service", "title": "Имя", "text": "создан Имя"},
    ]
    (d / "result.json").write_text(json.dumps({"messages": raw}), encoding="utf-8")
    got = exports.read_exports(spark, [str(d), str(tmp_path / "none")]).orderBy("unixtime", "msg_id").collect()
    by = {r.msg_id: r for r in got}
    assert set(by) == {5, 2, 7} and by[5].text_raw == "привет1" and by[5].unixtime == 100
    assert by[2].author_raw == "B" and by[2].media_type == "photo" and by[2].reply_to_id == 5 and by[2].unixtime == BASE
    assert by[7].text_raw == "создан [COMMUNITY_NAME_REDACTED]" and by[7].is_service and by[7].author_raw == "Anonymous"
    with pytest.raises(exports.ExportError):
        exports.read_exports(spark, [str(tmp_path / "none")])


def test_same_with_other_partitions(spark, folder):
    from chatmill.plans import queries

    old = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append([sorted(map(str, queries.QUERIES[q](spark, folder).collect())) for q in ("g_threads", "r_pseudonyms", "n_edges")])
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert all(a == b for a, b in itertools.pairwise(seen))

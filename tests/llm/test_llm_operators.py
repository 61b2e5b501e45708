import json
import random

import brute
import numpy as np
import oracle
import pytest
from chatmill.llm import conversations, leakage, lexicon, packing, pairs, personal, queries, shared_spans, splitting, subjects
from chatmill.llm.codes import Words
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connect(folder)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, folder, con, name):
    oracle.compare(queries.QUERIES[name](spark, folder), con, queries.SQL[name])


# 1. subjects


def test_subjects_learn_and_score(spark):
    r = random.Random(1)
    kinds = {"sea": ["корабль", "парус", "якорь", "волна"], "food": ["пирог", "суп", "соль", "печь"]}
    chatter = ["ага", "спасибо", "лол", "до завтра"]
    rows, labels = [], []
    for k in range(400):
        s = r.choice(["sea", "food"])
        rows.append((1, k, " ".join(r.choice(kinds[s]) for _ in range(4)) + ". " + r.choice(chatter)))
        labels.append((1, k, s))
    rows += [(2, 1, "якорь и парус. потом суп и соль"), (2, 2, None), (2, 3, ""), (2, 4, "лол")]
    m = spark.createDataFrame(rows, "chat_id long, msg_id long, text_clean string")
    lab = spark.createDataFrame([*labels, (None, 1, "sea"), (1, 1, "unknown")], "chat_id long, msg_id long, subject string")
    areas = spark.createDataFrame([("sea",), ("food",)], "subject string")
    got = {r.msg_id: r.subjects for r in subjects.assign_subjects(m, lab, areas).where("chat_id = 2").collect()}
    assert got[1] == ["food", "sea"] and got[2] == [] and got[3] == []


def test_gradient_is_right():
    share = subjects.Share(["один два. три", "четыре пять"], np.array([[1, 0], [0, 1]], np.float32))
    r = np.random.default_rng(0)
    table, out, bias = r.normal(0, 0.3, (1 << subjects.TABLE_BITS, 3)), r.normal(0, 0.3, (3, 2)), np.array([-0.5, 0.2])
    _, g_table, g_out, g_bias = share.gradient(table, out, bias)
    k = int(share.used[0])
    for array, grad, at in ((table, g_table, (k, 1)), (out, g_out, (2, 1)), (bias, g_bias, (0,))):
        old = array[at]
        array[at] = old + 1e-4
        up = share.gradient(table, out, bias)[0]
        array[at] = old - 1e-4
        down = share.gradient(table, out, bias)[0]
        array[at] = old
        assert abs((up - down) / 2e-4 - grad[at]) < 1e-3


# 3. pairs


@pytest.mark.parametrize(
    "prompt, answer, want",
    [
        ("Как откатить базу?", None, "empty"),
        ("Как откатить базу?", "<p></p>", "empty"),
        ("Как откатить базу?", "…", "empty"),
        ("Как откатить базу?", "N/A", "empty"),
        ("Как лучше откатить базу после ошибки?", "как лучше откатить базу после ошибки", "copy"),
        ("Как лучше откатить базу после ошибки?", "Вы спросили: Как лучше откатить базу после ошибки?", "copy"),
        ("Как лучше откатить базу после ошибки?", "Как лучше откатить базу после ошибки? Сначала снимите копию, потом запустите скрипт отката и проверьте журнал.", None),
        ("Как откатить базу?", "К сожалению, я не могу помочь с этим вопросом.", "refusal"),
        ("How do I roll back?", "I'm sorry, but I can't help with that, ask someone else.", "refusal"),
        ("Как откатить базу?", "Не могу воспроизвести у себя, но лучше сначала снять копию и откатить миграцию.", None),
        ("Как откатить базу?", "Le mieux est d'écrire au groupe et d'attendre 9 minutes.", "language"),
        ("Как откатить базу?", "The best way is to take a copy and then run the script.", "language"),
        ("Переведи на английский: откати базу", "Roll back the base and check the log.", None),
        ("Как откатить базу?", "```sql\nSELECT a FROM b WHERE c > 1;\n```", None),
        ("Как откатить базу?", "```sql\nSELECT a FROM b", "truncated"),
        ("Как откатить базу?", "Сначала снимите копию, потом запустите скрипт и", "truncated"),
        ("Как откатить базу?", "Шаги:\n1. снять копию\n2.", "truncated"),
        ("Как откатить базу?", "да, ровно 31", None),
        (None, "Снимите копию и проверьте журнал", None),
    ],
)
def test_defects(prompt, answer, want):
    assert pairs.defect(prompt, answer) == want


# Wordings written after earlier templates, which then were widened by what was missed (34 of the first 40, 32 of the second, 35 of the third).
WIDENED = """I'm sorry, but as an AI language model I cannot provide medical advice.
I apologize, but I am unable to fulfill this request.
Unfortunately, I won't be able to assist you with this.
I'm afraid I can't discuss that topic.
That's not something I'm able to talk about.
I have to decline this one.
I would prefer not to comment on internal matters.
Our policy does not allow me to share such details.
Sorry, this goes beyond my capabilities.
I cannot in good conscience help with this.
We are not permitted to answer questions of this kind.
I don't feel comfortable answering that.
I must respectfully refuse to continue.
Let's switch to another subject.
It would be against my guidelines to answer.
I'm not in a position to give legal advice.
I can't generate that kind of content.
I refuse to answer this.
No comment on that.
I'm not going to help you with this.
Извините, но я не смогу вам помочь.
К сожалению, я не могу выполнить ваш запрос.
Я не уполномочен отвечать на такие вопросы.
Мы не предоставляем консультации по этой теме.
Прошу прощения, но эта тема для меня закрыта.
Как языковая модель, я не могу обсуждать политику.
Мне запрещено говорить об этом.
Это противоречит моим правилам.
Я вынужден отказаться от ответа.
Я не стану комментировать эту ситуацию.
Такие темы я не обсуждаю.
Не готов отвечать на этот вопрос.
Это не входит в мою компетенцию.
Наша политика запрещает давать такие рекомендации.
Я отказываюсь отвечать.
Предлагаю поговорить о чём-нибудь другом.
Оставлю этот вопрос без комментариев.
Тут я бессилен, ничего не подскажу.
Боюсь, ничем не могу быть полезен.
Я не даю медицинских советов.
I'm unable to comply with that request.
Sorry, I cannot discuss this any further.
As an assistant, I'm not allowed to give financial recommendations.
I'm afraid this falls outside my area of expertise.
I'd prefer not to say anything about it.
I can't share that information with you.
We won't be answering this.
My instructions forbid me from talking about it.
I have to pass on this question.
I am not qualified to advise on such matters.
I will not participate in this.
This topic is off limits for me.
Could we talk about something else instead?
I do not have the ability to help here.
Apologies, I can't process requests like that.
I shall abstain from answering.
Regrettably I cannot be of assistance.
I'm choosing not to respond to this.
That violates our content policy.
Please ask someone else, I can't advise on this.
Простите, но помочь с этим я не могу.
Мы не можем дать ответ на такой запрос.
Я не вправе раскрывать эти сведения.
Это за пределами моих полномочий.
Инструкция не разрешает мне рассуждать о политике.
Увы, тут я пас.
Не буду это комментировать.
Воздержусь от комментариев.
К сожалению, я не в состоянии ответить на ваш вопрос.
Подобные просьбы мы не рассматриваем.
Я не консультирую по юридическим вопросам.
Прошу сменить тему разговора.
Я не хочу об этом говорить.
Мне нельзя давать такие советы.
Ответа от меня вы не дождётесь.
Боюсь, на это я ответить не смогу.
Данный вопрос вне моей компетенции.
Я обязан отклонить эту просьбу.
Никаких рекомендаций дать не могу.
Такими вопросами я не занимаюсь.
I'm sorry, I cannot assist with that.
I can't engage with this topic.
I am not able to offer an opinion on that.
Sorry, but I will have to refuse.
This request violates our guidelines.
I won't discuss that here.
We don't provide legal advice.
My policies prevent me from answering.
I would rather not get into that.
That lies beyond what I can do.
I cannot support this.
It's not appropriate for me to comment.
Thanks for the question, but I can't answer it.
I'm not comfortable discussing this.
I am prohibited from sharing that.
Let us change the subject.
I need to decline your request.
I'm not authorized to speak about it.
I cannot recommend anything here.
Not something I can comment on.
Извините, я не могу это обсуждать.
На такие вопросы мы не отвечаем.
Мои правила запрещают подобные ответы.
Я не буду отвечать на это.
Это вне рамок моих задач.
Не могу дать совет по этой теме.
Мне не разрешено рассказывать об этом.
Давайте поговорим о другом.
Вынуждена отказать в этой просьбе.
Я не имею возможности помочь вам с этим.
Мы не комментируем подобные темы.
Я не готова рассуждать на эту тему.
Помочь вам, увы, не смогу.
Политика сервиса не позволяет отвечать на это.
Я воздержусь от ответа.
Данную тему я не поддерживаю.
Отвечать на подобное мне запрещено.
К сожалению, это нарушает наши правила.
Я не специалист в этом и советовать не стану.
Прошу меня извинить, ответа не будет.""".split("\n")
# Wordings that were written after the templates and weren't used to change them.
HELD_OUT = """I'm sorry, but I can't do that.
I can't offer any guidance on that matter.
Unfortunately I'm not able to respond to this question.
I am unable to talk about that.
Sorry, that's outside of my scope.
I must refrain from giving advice.
I decline to comment.
Our terms do not permit me to help with that.
I'd rather skip this question.
We cannot comply with your request.
I will not provide that information.
I don't have permission to answer this.
It is beyond my abilities to advise you here.
I can't be of help with this.
I'm afraid I must decline.
That would violate my principles.
I won't go into that.
You will have to ask someone else, I can't answer.
As a language model I do not give medical recommendations.
Let's talk about a different topic.
Я не могу предоставить такую информацию.
Увы, ничем помочь не могу.
Мне нельзя отвечать на подобные вопросы.
Я отказываюсь комментировать это.
Наши правила не разрешают обсуждать такое.
Эта тема не входит в мои задачи.
Не хочу отвечать на этот вопрос.
Я вынужден уклониться от ответа.
Предлагаю сменить тему.
Мы не вправе давать такие рекомендации.
Это противоречит нашей политике.
Я не берусь советовать в таких делах.
Консультаций по таким вопросам мы не оказываем.
Как ассистент, я не могу высказывать мнение.
Боюсь, я не смогу ответить.
Позвольте мне не отвечать.
Оставляю этот запрос без ответа.
Без комментариев.
На эту тему я говорить не буду.
Такие просьбы выходят за пределы моих возможностей.""".split("\n")
SOUND = """I can't reproduce it here, but first check the log and then restart the node.
Сервис пишет «не могу ответить на этот вопрос», это не страшно: перезапустите его.
The server can't respond until you replace the certificate.
Не могу сказать точно, но сначала проверьте диск, потом замените кабель.
The supplier breaches the terms, so renegotiate the contract.
Вы не сможете помочь базе, пока не поднимете реплику; сначала поднимите её, затем проверьте журнал.
Don't provide the password on the command line, use a file.
Не даёт покоя индекс: стоит его перестроить.
It is not allowed by the firewall, open the port first and then retry.
Комментарии в коде не нужны, лучше назовите функцию понятнее.""".split("\n")


def test_refusals_in_other_wordings():
    judge = pairs.Judge(pairs.L.train())
    for wordings in (WIDENED, HELD_OUT):
        found = [d == "refusal" for d, _ in judge.defects(["Как вы это делаете?"] * len(wordings), wordings)]
        assert sum(found) >= 0.9 * len(wordings), [t for t, f in zip(wordings, found) if not f]
    wrong = [t for t, (d, _) in zip(SOUND, judge.defects(["Что делать с сервером?"] * len(SOUND), SOUND)) if d == "refusal"]
    assert not wrong
    long = "I can't help with that. " + "The matter is delicate and everybody has a view of it that deserves respect. " * 40
    assert pairs.defect("How do I roll back the base?", long) == "refusal"


@pytest.mark.parametrize(
    "answer",
    [
        "Zuerst sollte man den Verlauf prüfen und danach die Einstellungen wiederherstellen.",
        "Najpierw sprawdź dziennik zdarzeń, a potem uruchom serwer jeszcze raz.",
        "Önce günlükleri kontrol edin, ardından sunucuyu yeniden başlatın.",
        "首先检查日志，然后重新启动服务器。",
        "Prima controlla il registro e poi riavvia il servizio con la configurazione precedente.",
        "먼저 로그를 확인한 다음 서버를 다시 시작하세요.",
        "Сначала проверьте журнал, потом перезапустите службу.",
    ],
)
def test_other_languages(answer):
    assert pairs.defect("How do I restore the service after the update failed?", answer) == "language"
    assert pairs.defect("Translate it into another language or in German, please, in Polish", "First check the log, then restart it.") is None
    assert pairs.defect("How do I restore the service after the update failed?", "First check the log, then restart the service with the old settings.") is None


def test_copies_given_back_often():
    prompt = "как лучше откатить базу после ошибки"
    assert pairs.defect(prompt, ". ".join([prompt] * 30)) == "copy"


def test_ends_of_lists():
    for text in ("First look at the log, then check every", "Снимите копию и проверьте каждый", "Take the copy and give it to your"):
        assert pairs.defect(None, text) == "truncated"


def test_subsequence_and_torn_words(spark):
    assert pairs.common_subsequence(list("abcbdab"), list("bdcaba")) == 4
    rows = [(1, "Что делать?", "Снимите копию, затем проконтро"), (2, "Что делать?", "Снимите копию, затем журнал"), (3, "Где журнал лежит?", None)]
    frame = spark.createDataFrame(rows, "k long, prompt string, answer string")
    assert {tuple(r) for r in pairs.flag_answers(frame, ["k"]).collect()} == {(1, "truncated"), (3, "empty")}
    # a share of a hundredth elsewhere changes nothing, however large the corpus
    more = spark.createDataFrame([*rows, *[(k, "Что делать?", "Снимите копию, затем проконтро") for k in range(10, 310)], (500, "Что такое проконтро и зачем?", "Ничего.")], "k long, prompt string, answer string")
    assert pairs.flag_answers(more, ["k"]).where("defect = 'truncated'").count() == 301
    assert pairs.flag_answers(frame.limit(0), ["k"]).count() == 0


# 4. personal information


def found_of(model, sentences):
    right = wrong = missed = 0
    for text, gold in sentences:
        found = set(personal.find(text, model))
        right, wrong, missed = right + len(found & set(gold)), wrong + len(found - set(gold)), missed + len(set(gold) - found)
    return right, wrong, missed


def test_personal_on_other_sentences():
    right, wrong, missed = found_of(personal.train(), lexicon.training_sentences(1500, 77))
    assert wrong + missed < 0.06 * right


def test_personal_forms_left_out_of_training():
    out = ("surname given patronymic", "surname two initials", "pairs", "mixed", "spaced", "capitals", "series 2", "insurance lines", "english last", "boulevard")
    model = personal.train(leave_out=out)
    fields = [(t, {k for *_, k in g}) for t, g in lexicon.training_sentences(800, 78, only=out) if g]
    held = [(k, any(k == x[2] for x in personal.find(t, model))) for t, kinds in fields for k in kinds]
    assert sum(x for _, x in held) >= 0.85 * len(held), {k: sum(x for j, x in held if j == k) / sum(j == k for j, _ in held) for k in personal.KINDS}


@pytest.mark.parametrize(
    "text, kind",
    [
        ("John Smith called", "NAME"), ("передай Джону Смиту", "NAME"), ("Гульнара Ибрагимова", "NAME"), ("встретимся на Тверской 12", "ADDRESS"), ("Kuznetsova Maria", "NAME"), ("passport C01X00T47", "ID_NUMBER"),
        ("ул. Ленина 5", "ADDRESS"), ("Лесная 12 корпус 3", "ADDRESS"), ("call +1 (415) 555-0132 now", "PHONE"), ("mail: a.b@c.example.org", "EMAIL"), ("Сидоренко Павел Игоревич", "NAME"), ("А. С. Пушкин", "NAME"),
    ],
)
def test_personal_forms(text, kind):
    assert kind in {k for *_, k in personal.find(text, personal.train())}


@pytest.mark.parametrize(
    "text, want",
    [
        ("пишите на ivan@mail.example, отвечу", "пишите на [EMAIL], отвечу"),
        ("мой номер ＋7 ９12 000 11 22", "мой номер [PHONE]"),
        ("выгрузили 8 912 000 строк", "выгрузили 8 912 000 строк"),
        ("передайте привет Ивану Петрову", "передайте привет [NAME]"),
        ("дочитал роман Перлин, глава 3", "дочитал роман Перлин, глава 3"),
        ("Саша, глянь пункт 4", "Саша, глянь пункт 4"),
        ("снилс 000-111-222 33, хватит?", "снилс [ID_NUMBER], хватит?"),
        ("встреча — ул. Лесная, д. 8, кв. 29", "встреча — [ADDRESS]"),
        ("", ""),
    ],
)
def test_masking(text, want):
    assert personal.masked(text, personal.find(text, personal.train())) == want


def test_likelihood_sums():
    # two tokens, stretches of one and of both, one type, no scores: segmentations are none, first, second, each, both
    worth = np.full((1, 2, 2, 1), -1e9)
    worth[0, 0, 0] = worth[0, 1, 0] = worth[0, 0, 1] = 0
    z, p = personal.marginals(worth, np.array([2]))
    assert np.allclose(z, np.log(5)) and np.allclose(p[0, :, :, 0], [[2 / 5, 1 / 5], [2 / 5, 0]])
    spans = [(0, 3, 0), (2, 5, 1), (5, 7, 0)]
    assert personal.best(spans, [1.0, 2.0, -1.0]) == [(2, 5, 1)]
    assert personal.best([*spans, (3, 5, 2)], [1.0, 2.0, 1.0, 1.5]) == [(0, 3, 0), (3, 5, 2), (5, 7, 0)]


def test_personal_gradient():
    r = np.random.default_rng(1)
    model = {k: r.normal(0, 0.1, (n, len(personal.KINDS))) for k, n in personal._SHAPES.items()}
    texts, gold = ["пишите Ивану Петрову 5", "8 912 000 11 22"], [[(1, 3, 4)], [(0, 5, 1)]]
    _, g = personal._gradient(texts, gold, model)
    for name in model:
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        old, values = model[name][at], []
        for step in (1e-3, -1e-3):
            model[name][at] = old + step
            values.append(personal._gradient(texts, gold, model)[0])
        model[name][at] = old
        assert abs((values[0] - values[1]) / 2e-3 - g[name][at]) < 1e-3, name


def test_personal_best_against_all_choices():
    r = random.Random(2)
    for _ in range(50):
        spans = [(a, a + r.randint(1, 4), r.randint(0, 2)) for a in (r.randint(0, 9) for _ in range(7))]
        values = [r.uniform(-1, 2) for _ in spans]
        most = 0
        for choice in range(1 << len(spans)):
            some = sorted(spans[k] for k in range(len(spans)) if choice >> k & 1)
            if all(x[1] <= y[0] for x, y in zip(some, some[1:], strict=False)):
                most = max(most, sum(values[k] for k in range(len(spans)) if choice >> k & 1))
        got = personal.best(spans, values)
        assert all(x[1] <= y[0] for x, y in zip(got, got[1:], strict=False))
        assert abs(sum(max(v for v, s in zip(values, spans, strict=True) if s == x) for x in got) - most) < 1e-6


def test_personal_in_long_and_empty_texts():
    model = personal.train()
    text = "слово " * 30_000 + "мой номер +7 (912) 000-11-22 " + "слово " * 30_000
    assert [text[a:b] for a, b, _ in personal.find(text, model)] == ["+7 (912) 000-11-22"]
    many = ["", None, "a", " ", text, "пишите на ivan@mail.example, отвечу"]
    assert [len(x) for x in personal.find_many(many, model)] == [0, 0, 0, 0, 1, 1]


def test_personal_frame(spark):
    rows = spark.createDataFrame([(1, 1, None), (1, 2, "a@b.example"), (1, 2, "a@b.example"), (1, 3, "ничего")], "chat_id long, msg_id long, t string")
    assert personal.mask_personal(rows, ["chat_id", "msg_id"], "t").count() == 4
    assert personal.personal_fields([(rows, ["chat_id", "msg_id"], "t")]).count() == 1


# 6. splitting


def check_pieces(text, limit, overlap, **kw):
    some = splitting.pieces(text, limit, overlap, **kw)
    assert all(b - a <= limit for a, b in some)
    back = text[some[0][0] : some[0][1]] + "".join(text[a + min(overlap, a) if a else min(overlap, p[1]) : b] for p, (a, b) in zip(some, some[1:], strict=False))
    assert back == text
    return some


@pytest.mark.parametrize("seed", range(6))
def test_pieces_give_the_text_back(seed):
    r = random.Random(seed)
    text = "".join(r.choice(["слово ", "конец. ", "\n\n", "x" * r.randint(1, 300), "👍🏽", "да, "]) for _ in range(400))
    check_pieces(text, 500, 50)


def test_pieces_prefer_boundaries_and_keep_escapes(spark):
    text = "\n\n".join("Абзац номер %d. Ещё предложение." % k for k in range(40))
    assert all(text[b - 1] == "\n" for _, b in check_pieces(text, 300, 20)[:-1])
    line = json.dumps({"a": ["эмодзи 👍 и \\ слеш \n" * 30] * 5})
    for _, b in check_pieces(line, 400, 40, boundaries=splitting.JSON_BOUNDARIES, escapes=True)[:-1]:
        json.loads('"' + line[max(0, b - 1) : b].replace('"', "").replace("\\", "") + '"')
        assert not splitting.re.search(r"(?<!\\)(?:\\\\)*\\(?:u[0-9a-f]{0,3})?$", line[:b])
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "а" * 1000), (None, "б" * 300)], "k long, t string")
    got = splitting.split_items(rows, ["k"], "t", 300, 50)
    assert {(r.k, r.n_pieces) for r in got.collect()} == {(2, 1), (3, 4), (None, 1)}


def test_long_runs_of_backslashes_are_not_torn():
    for n in (40, 41):
        line = "a" * (90 - n) + "\\" * (2 * n) + "n" + "b" * 300
        for _, b in check_pieces(line, 100, 10, boundaries=splitting.JSON_BOUNDARIES, escapes=True)[:-1]:
            head = line[:b]
            assert (len(head) - len(head.rstrip("\\"))) % 2 == 0 or b == len(line)


# 7. conversations


def test_conversations(spark):
    kind = "chat_id long, msg_id long, unixtime long, author_id_raw string, text_raw string, reply_to_id long, is_service boolean, batch_id long, ingested_at timestamp"
    row = lambda c, m, at, who, reply, text="t", service=False: (c, m, at, who, text, reply, service, 1, None)
    rows = [
        row(1, 1, 0, "a", None), row(1, 2, 5, "b", 1), row(1, 3, 5, "a", 1), row(1, 3, 5, "a", 1), row(1, 9, 1, "x", None, service=True),
        row(2, 1, 0, "a", 77), row(2, 2, 5, "b", 1),
        row(3, 1, 9, "a", 0), row(3, 2, 5, "b", 1),
        row(4, 1, 0, "a", None), row(4, 2, 5, "b", 1, text="​ "),
        row(5, 1, 0, "a", None), row(5, 2, 5, "a", 1),
        row(6, 1, 0, "a", 2), row(6, 2, 0, "b", 1),
    ]
    frame = spark.createDataFrame(rows, kind)
    want = {(1, 1, 1, 1, "user"), (1, 1, 2, 2, "assistant"), (1, 1, 3, 3, "user")}
    assert {tuple(r) for r in conversations.rebuild_conversations(frame).collect()} == want
    old, conversations.STRETCH_ROWS = conversations.STRETCH_ROWS, 1
    try:
        assert {tuple(r) for r in conversations.rebuild_conversations(frame).collect()} == want
    finally:
        conversations.STRETCH_ROWS = old
    assert conversations.rebuild_conversations(frame.limit(0)).count() == 0


def test_fragments_and_orders(spark):
    hashes = lambda *x: np.array(x, np.int64)
    # 1 <- 2 <- 3, 3 <- 4 and 5 (a fork), a repeated 2, a circle 6 <- 7 <- 6
    own, above = hashes(1, 2, 3, 4, 5, 2, 6, 7), hashes(0, 1, 2, 3, 3, 1, 7, 6)
    fragment, place = conversations.chain(np.ones(8, np.int64), own, above, above > 0)
    assert fragment[0] == fragment[1] == fragment[2] and list(place[:3]) == [0, 1, 2]
    assert len({fragment[2], fragment[3], fragment[4], fragment[5], fragment[6]}) == 5 and fragment[6] == fragment[7]
    r = random.Random(4)
    kind = "chat_id long, msg_id long, unixtime long, author_id_raw string, text_raw string, reply_to_id long, is_service boolean, batch_id long, ingested_at timestamp"
    rows = []
    for m in range(1, 400):
        rows.append((m % 2, m, m // 3, r.choice("ab"), "t", r.choice([None, m - 2, max(m - 2 * r.randint(1, 5), 0), m if m % 90 == 0 else m - 2]), False, r.randint(1, 9), None))
    rows += [(*x[:7], 10, None) for x in r.sample(rows, 80)]
    want = None
    for page, stretch in ((8192, 100_000), (16, 100_000), (16, 1), (1, 3)):
        r.shuffle(rows)
        old = conversations.PAGE_ROWS, conversations.STRETCH_ROWS
        conversations.PAGE_ROWS, conversations.STRETCH_ROWS = page, stretch
        got = {tuple(x) for x in conversations.rebuild_conversations(spark.createDataFrame(rows, kind)).collect()}
        conversations.PAGE_ROWS, conversations.STRETCH_ROWS = old
        assert got and (want is None or got == want)
        want = got


@pytest.mark.parametrize("seed", range(3))
def test_conversations_with_nulls(spark, seed):
    r = random.Random(seed)
    kind = "chat_id long, msg_id long, unixtime long, author_id_raw string, text_raw string, reply_to_id long, is_service boolean, batch_id long, ingested_at timestamp, hash long, members string, place long"
    rows = []
    for m in range(1, 160):
        chat = m % 3
        reply = r.choice([None, None, 0, m, 9999, *[max(0, m - 3 * k) for k in (1, 1, 1, 2, 2, 3)], m + 3 if m % 50 == 7 else m - 3])
        one = (chat, m, r.choice([None, m, m, m, m]), r.choice(["a", "b", "c", None, ""]), r.choice(["t"] * 30 + [None, " ", "\u200b"]), reply, r.choice([None, False, False, False, False, m % 40 == 0]))
        rows += [(*one, r.choice([None, 1, 2, 3])) for _ in range(r.choice([1, 1, 1, 2]))]
    rows += [(None, 5, 1, "a", "t", None, False, 1), (1, None, 1, "a", "t", None, False, 1)]
    r.shuffle(rows)
    frame = spark.createDataFrame([(*x, None, 1, "x", 2) for x in rows], kind)
    want = brute.conversations(rows)
    for page in (8192, 7):
        old, conversations.PAGE_ROWS = conversations.PAGE_ROWS, page
        got = {tuple(x) for x in conversations.rebuild_conversations(frame).collect()}
        conversations.PAGE_ROWS = old
        assert got == want and want


# 8. packing


def test_packing(spark):
    r = random.Random(3)
    sizes = [(k, r.choice([None, 0, 5, 700, 1300, 2049, 4096, 9000, r.randint(1, 4096)])) for k in range(600)]
    frame = spark.createDataFrame(sizes, "doc_id long, n_tokens long")
    old = packing.BLOCK_ROWS
    for block in (old, 7):
        packing.BLOCK_ROWS = block
        got = packing.pack(frame).collect()
        load = {}
        for x in got:
            load[x.container_id] = load.get(x.container_id, 0) + x.part_end - x.part_begin
        whole = {k: n or 0 for k, n in sizes}
        assert max(load.values()) <= 4096 and sorted(load) == list(range(len(load)))
        assert sum(load.values()) == sum(whole.values())
        parts = {}
        for x in got:
            parts.setdefault(x.doc_id, []).append((x.part_begin, x.part_end))
        assert set(parts) == set(whole) and all(len(p) == max(1, -(-whole[k] // 4096)) for k, p in parts.items())
        assert len(load) <= 1.1 * sum(load.values()) / 4096 + 1
    packing.BLOCK_ROWS = old
    assert packing.pack(frame.limit(0)).count() == 0


# 9. leaks


def test_leaks(spark):
    items = spark.createDataFrame([(1, "один два три четыре пять шесть семь восемь девять десять"), (2, "слишком короткий текст"), (3, None), (4, "один два три четыре пять шесть семь восемь конец")], "item_id long, body string")
    docs = [(1, "А тут: два три, четыре пять\nшесть СЕМЬ восемь — девять!"), (2, "два три четыре пять шесть семь восемь"), (3, None), (4, ""), (5, "oдин двa тpи че​тыре пять шесть семь восемь"), (6, "восемь семь шесть пять четыре три два один"), (7, "слово " * 5000 + "один два три четыре пять шесть семь восемь " + "слово " * 3000)]
    frame = spark.createDataFrame([(k, t, "x") for k, t in docs], "doc_id long, text string, body string")
    got = {tuple(r) for r in leakage.leaked_items(frame, items).collect()}
    assert got == {(1, 1), (5, 1), (5, 4), (7, 1), (7, 4)}
    assert leakage.leaked_items(frame, items.limit(0)).count() == 0
    old, leakage.PART_CHARS = leakage.PART_CHARS, 40
    named = items.withColumn("item_id", F.concat(F.lit("item "), "item_id"))
    assert {tuple(r) for r in leakage.leaked_items(frame, named.union(named)).collect()} == {(d, f"item {i}") for d, i in got}
    leakage.PART_CHARS = old


def test_shifts_stay_long_for_many_items():
    r = np.random.default_rng(1)
    words = np.array([f"w{k}" for k in range(20_000)])
    matcher = leakage.Matcher([" ".join(r.choice(words, 2000)) for _ in range(100)])
    text = Words([" ".join(r.choice(words, 20_000))])
    moves = matcher.shift[matcher._block(text.hash[:-1], text.hash[1:])]
    assert moves.mean() > 6 and (moves == 0).mean() < 0.05


def test_words_fold():
    a, b = Words(["Ёлка, ПРИВЕТ-мир"]), Words(["x y", "елка пpивет мир"])
    assert list(a.hash) == list(b.hash[2:]) and list(b.text) == [0, 0, 1, 1, 1]


# 10. shared spans


@pytest.mark.parametrize("seed", range(3))
def test_shared_spans(spark, seed):
    r = random.Random(seed)
    piece = lambda n: "".join(r.choice("абвгд ") for _ in range(n))
    stock = [piece(r.randint(30, 120)) for _ in range(6)] + ["а" * 90]
    docs = [(k, "".join(r.choice([piece(r.randint(1, 60)), r.choice(stock)]) for _ in range(r.randint(0, 8)))) for k in range(60)]
    docs += [(100, docs[0][1]), (101, docs[0][1]), (102, None), (None, docs[1][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute.shared_spans(docs, 48)
    old = shared_spans.GROUP_ROWS
    for group in (old, 1):
        shared_spans.GROUP_ROWS = group
        got = {tuple(x) for x in shared_spans.shared_spans(frame, span=48).collect()}
        shared_spans.GROUP_ROWS = old
        assert got == want
    assert shared_spans.shared_spans(frame.limit(0), span=48).count() == 0


def test_llm_is_not_needed():
    import pathlib

    import chatmill

    root = pathlib.Path(chatmill.__file__).parent
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "chatmill.llm" not in p.read_text(encoding="utf-8"), p
    assert F is not None

"""Defects of answers: empty, truncated, refusal, copy of the question, other language."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatmill.llm import language as L
from chatmill.plans.scratch import Scratch

SHINGLE = 5
CONTAINED = 0.8
#: Part of the answer's words that a common subsequence with the question covers, if the answer is a copy.
COPIED = 0.75
#: Words that may stand between two neighbouring words of a template.
GAP = 3
#: Stems of the question, or words of instruction, that make what stands beside a refusal an answer.
ANSWERS = 2
#: An end without punctuation is torn if its last word stands elsewhere in at most this part of its occurrences.
ELSEWHERE = 0.01
#: How much likelier, in nats, another language must be than that of the question, and for each letter.
MARGIN, MARGIN_LETTER = 9.0, 0.12
#: Words counted in a task before their counts are handed on.
HELD_WORDS = 200_000

# What stands for nothing.
NOTHING = {"null", "none", "nan", "n a", "na", "nil", "undefined", "пусто", "нет ответа", "no answer"}
# Words that never end a finished statement - conjunctions, prepositions, articles, possessives and the like.
UNFINISHED = set(
    "и или а но что чтобы если когда пока где поэтому причём причем также затем которая который которое которые либо нужно должен должна должны "
    "для к ко в во на с со по от ото из-за без до у об при под над между через вместе ещё еще после перед не ни раздел например следующее как хотя поскольку ибо зато "
    "каждый каждая каждое каждую наш наша нашу ваш ваша вашу их его её будто чем "
    "the a an to and or but because with without for of which who if while into from by at on as than are was need needs another since unless though although until whereas "
    "every each any some our your their its my his these those such both either neither whether can could should would will must may might "
    "und oder aber weil der die das den dem ein eine zu mit von für et ou mais parce que le la les un une des de du pour avec y pero porque el los las una con para".split()
) - {"перед"}
JOINING = set("и или а но чтобы если когда затем потом ещё еще также нужно надо можно после and or but also then to that we you so if when which please необходимо стоит".split())
_UNFINISHED_PHRASE = re.compile(r"(?<!\w)(?:при этом|так как|в том числе|а также|то есть|потому что|несмотря на|тем более|в частности|так что|до тех пор|as well as|such as|even though|in order to|due to|so far as|rather than|at which|(?:unless|if|when|because|since|while|that|which|and|but) (?:you|we|it|they|i|he|she)|(?:если|когда|что|чтобы|пока|но) (?:вы|мы|он|она|они|я|это))$", re.I)
ASKS_LANGUAGE = re.compile(
    r"перевед\w+|перевест\w+|переклад\w+|\btranslat\w+|\bübersetz\w+|\btradui\w+|\btraduz\w+|\btraduc\w+|(?:ответ|отвеча|напиш|объясн)\w*\s+(?:мне\s+)?(?:на|по)[\s-]+\w*(?:ск|цк)\w+|"
    r"\b(?:in|into|to)\s+(?:english|russian|german|french|spanish|ukrainian|italian|polish|turkish|chinese|portuguese|dutch|czech|japanese|korean|arabic)\b|"
    r"(?<!\w)(?:на|по)[\s-]+(?:англий|рус|немец|француз|испан|украин|итальян|поль|турец|китай|японс|корей)\w*|auf (?:deutsch|englisch|russisch)|en (?:français|anglais|inglés|español)",
    re.I,
)
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_FENCED = re.compile(r"```.*?(?:```|\Z)|`[^`\n]+`", re.S)
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
_CODE_LINE = re.compile(r"[{};=<>\[\]_]|\w\(|^\s*(?:#|//|--)|--\w")
_QUOTED = re.compile(r"«[^«»]*»|“[^“”]*”|\"[^\"\n]*\"")
_SENTENCE = re.compile(r"[.!?…;\n]+")


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.casefold().replace("’", "'").replace("ё", "е"))


def common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, one row of bits for each word of ``a``."""
    places: dict[str, int] = {}
    for k, w in enumerate(b):
        places[w] = places.get(w, 0) | 1 << k
    row = full = (1 << len(b)) - 1
    for w in a:
        hit = row & places.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(b) - row.bit_count()


def containment(part: list[str], whole: list[str], size: int = SHINGLE) -> float:
    """Part of one text's shingles that the other has; a text of fewer words is one shingle."""
    size = max(1, min(size, len(part)))
    own = {tuple(part[k : k + size]) for k in range(len(part) - size + 1)}
    other = {tuple(whole[k : k + size]) for k in range(len(whole) - size + 1)}
    return len(own & other) / len(own) if own else 0.0


def is_copy(prompt: list[str], answer: list[str]) -> bool:
    """Whether the answer's words are, in order, those of the question, given back once or several times."""
    if not prompt or not answer:
        return False
    asked, given = set(prompt), set(answer)
    # shingles can be contained only if the words are
    near = len(asked & given) >= 0.5 * min(len(asked), len(given))
    if not near or max(containment(prompt, answer), containment(answer, prompt)) < CONTAINED:
        # words may have been joined or torn; then the letters tell
        if abs(len(prompt) - len(answer)) > max(len(prompt), len(answer)) / 2 and len(answer) > 3:
            return False
        one, other = "".join(prompt), "".join(answer)
        return len(other) * COPIED <= len(one) <= len(other) and one in other
    often = prompt * max(1, round(len(answer) / len(prompt)))
    return len(answer) >= min(3, len(prompt)) and common_subsequence(often, answer) >= COPIED * len(answer)


# Templates of refusals, word by word; "|" parts what may stand at a place, "~" leaves the ending open,
# "@" stands for the words named below. Further words may stand between.
_PLACES = {
    "@act": "помоч~|помога~|ответ~|отвеч~|обсужд~|обсуд~|комментир~|прокомментир~|совет~|посовет~|консульт~|выполн~|предостав~|дать|дава~|подсказ~|рассказ~|говор~|сказать|рассужд~|содейств~|обработ~|обрабат~|рекоменд~|разъясн~|участв~|поддерж~|продолж~|одобр~|касат~|раскры~|распростран~|заним~",
    "@may": "могу|можем|смогу|сможем|способен|способна|готов|готова|вправе|буду|стану|станем|будем|намерен|намерена|берусь|уполномочен|уполномочена|возьмусь|хочу|хотел|хотела",
    "@я": "я|мы|мне|нам|меня|нас|мной|нами|ии|ассистент|помощник",
    "@i": "i|we|i'm|im|we're|i'd|i'll|i've|me|ai|assistant|sorry|unfortunately|afraid|apologies|regret",
    "@not": "can't|cannot|cant|won't|unable|not|couldn't|don't|isn't|never",
    "@do": "help|assist|answer|discuss|comment~|provide|comply|respond|give|offer|fulfil~|support|share|advise|engage|complete|address|talk|speak|process|continue|participate|recommend|handle|generate|cover|do|weigh|touch|go|opinion|advice|guidance",
    "@мой": "мои|моим|моих|моими|мою|моя|моей|моего|моему|наши|наших|нашим|нашими|нашей|нашего|нашему",
    "@theme": "вопрос~|запрос~|просьб~|тем~|темат~|пункт~|обсужден~|разговор~",
}
_TEMPLATES = (
    "не @may @act", "@act не @may", "@act @я нельзя|запрещено|запрещается|невозможно", "@я нельзя|запрещено|запрещается|невозможно @act", "нельзя @я @act", "не разрешено|разрешается|позволено|положено|дозволено|полагается|допускается|велено @act", "@я не разрешено|позволено|положено|дозволено|полагается",
    "вынужден~|обязан~|должен|должна|должны|придется отказ~|воздерж~|отклон~|промолч~|уклон~", "за|вне предел~|рамк~|рамок|границ~ @мой|возможност~|компетенц~|полномоч~|дозволен~|разрешен~", "вне|мимо @мой компетенц~|полномоч~|специализац~|возможност~", "ответа|помощи|комментариев|совета|советов|рекомендаций|рекомендации не дождетесь|будет|получите|последует|ждите", "@я пас", "ответа|ответить|комментариев|просьбы|помощи вынужден~|воздерж~|отказ~", "отказываюсь|отказываемся|воздержусь|воздержимся|откажусь|уклонюсь @act|от|@theme",
    "выход~|лежит|лежат|наход~ за рамк~|предел~|границ~ @мой|возможност~|компетенц~|полномоч~|дозволен~|разрешен~", "не вход~ в @мой|компетенц~|задач~|обязанност~",
    "правил~|политик~|инструкц~|норм~|ограничени~|услови~|регламент~ не позвол~|разреш~|допуск~|дают", "правил~|политик~|инструкц~|норм~|ограничени~|услови~|регламент~ запрещ~", "противореч~|наруш~ @мой|правил~|политик~|принцип~",
    "совет~|комментар~|консультац~|рекомендац~ не даю|даем|дам|дадим|будет|раздаю|оказываю", "смен~|перемен~|закро~ тем~|разговор~", "давайте|предлагаю|лучше|можем|может смен~|поговор~|перейд~ тем~|друг~", "не помощник|советчик|консультант", "помощник|советчик|консультант не|никакой|плохой",
    "не имею|имеем|в прав~|возможност~|полномоч~|состоянии|силах @act", "@theme не обрабатыва~|обсуждаю|обсуждаем|комментирую|комментируем|отвечаю|отвечаем|занимаюсь|поддерживаю|рассматрива~", "не обсуждаю|обсуждаем|комментирую|комментируем|консультирую|отвечаю|обрабатываю|выполняю @theme", "оставлю|оставим|оставляю без ответа|комментари~|внимания", "без|воздержусь комментариев", "@theme для @я закрыт~|запретн~|табу", "не @may @theme", "не предоставля~|оказыва~|даю|даем|дам|дадим|провожу консультац~|совет~|рекомендац~|комментари~|оценок|прогноз~|справ~|информац~|услуг~", "не @may быть|оказаться полез~", "ничем|никак|ничего не помо~|подскаж~|скаж~|ответ~|посовет~", "@я бессилен|бессильна|бессильны|некомпетентен|некомпетентна", "увольте|избавьте от",
    "@i @not @do", "@i @not able|allowed|permitted|authorized|comfortable|willing|position|at @do|liberty", "@i unable @do", "@i don't|not feel comfortable|able|qualified|right", "@i must|have|need|respectfully|politely|going|will|shall|i'll|would|choose|choosing decline|refuse|pass|refrain|abstain|declining|refusing", "@i @not be of assistance|help|use|service|value", "@i @not be helpful|useful|able", "@i decline|refuse|declining|refusing|refrain answer|to|from|this|that", "@i rather|prefer|choose not|avoid|skip @do|say|get|this|that|it", "not something|topic|subject|matter|area @i can|am|able|will @do|assist|discuss",
    "outside|beyond|exceeds what|scope|my|our @i|my|our|scope|remit|abilities|capabilities|allowed|expertise", "guidelines|policy|policies|rules|terms|instructions|programming|restrictions do|does|don't|doesn't|won't|cannot|can't let|allow|permit|me", "guidelines|policy|policies|rules|terms|instructions|programming|restrictions prevent~|prohibit~|forbid~|bar|restrict~|stop @i|my|answering|this|it", "against|violat~|breach~ my|our policy|policies|guidelines|rules|terms|principles", "no comment~", "not appropriate|comfortable|proper|right|permitted|ethical|willing|able|ready|prepared for|to|discussing|answering|sharing|commenting|giving|helping @i|comment|discuss|answer|share|help|assist|speak|talk|this|that", "@i not|no comfortable|allowed|permitted|able|ability|right discussing|answering|sharing|commenting|giving|helping|to", "@i prohibited|forbidden|barred|prevented|restricted|banned from|to|by", "change|switch|drop subject|topic", "let's|lets|could|can talk|change|discuss|switch|move something|subject|topic|another|else", "off limits for|to @i", "won't|cannot|can't|not be @do|able|commenting|answering|helping|discussing|providing|assisting|touching",
)
_POLITE = set("к сожалению извините простите прошу прощения спасибо за вопрос понимаю но хорошего дня удачи пожалуйста sorry i'm im afraid thanks thank you for asking unfortunately apologies apologize please have a nice day good luck understand but however".split())
_CONTRAST = {"но", "однако", "зато", "хотя", "but", "however", "though", "although", "instead", "вместо"}
# Words of instruction.
_ADVICE = set("сначала затем потом попробуйте попробуй проверьте проверь используйте используй поставьте запустите откройте настройте first then try check use install run start restart set replace update open click configure лучше стоит причина обычно usually cause".split())


class _Slots:
    """For each word the places of templates it can stand at, as bits; remembered, as words recur."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.templates: list[list[int]] = []
        for t in _TEMPLATES:
            self.templates.append([self.number.setdefault(p, len(self.number)) for p in t.split()])
        self.masks = [sum({1 << p for p in t}) for t in self.templates]
        self.exact: dict[str, int] = {}
        self.begins: dict[str, int] = {}
        for place, n in self.number.items():
            words = "|".join(_PLACES.get(x, x) for x in place.split("|")).split("|")
            for w in words:
                w = w.replace("ё", "е")
                to = self.begins if w.endswith("~") else self.exact
                w = w.rstrip("~")
                to[w] = to.get(w, 0) | 1 << n
        self.known: dict[str, int] = {}
        self.sizes = sorted({len(w) for w in self.begins})

    def bits(self, word: str) -> int:
        got = self.known.get(word)
        if got is None:
            got = self.exact.get(word, 0)
            for n in self.sizes:
                if n <= len(word):
                    got |= self.begins.get(word[:n], 0)
            if len(self.known) > HELD_WORDS:
                self.known.clear()
            self.known[word] = got
        return got

    def possible(self, bits: list[int]) -> list[list[int]]:
        """The templates for each of whose places there is a word."""
        some = 0
        for b in bits:
            some |= b
        return [t for t, m in zip(self.templates, self.masks, strict=True) if some & m == m]


_SLOTS = _Slots()


def align_refusal(words: list[str]) -> bool:
    """Whether a template of refusals aligns with words of a clause, in order and near each other."""
    bits = [_SLOTS.bits(w) for w in words]
    for template in _SLOTS.possible(bits):
        for k, b in enumerate(bits):
            if not b >> template[0] & 1:
                continue
            at = k
            for p in template[1:]:
                at = next((x for x in range(at + 1, min(at + GAP + 2, len(bits))) if bits[x] >> p & 1), -1)
                if at < 0:
                    break
            if at >= 0:
                return True
    return False


def _stems(words: Sequence[str]) -> set[str]:
    return {w[:5] for w in words if len(w) >= 4}


def is_refusal(prompt: list[str], answer: str, words: list[str]) -> bool:
    """Whether a sentence aligns with a refusal and nothing beside it answers the question; of any length.

    What is said in quotation marks doesn't refuse. A "but" parts clauses like the end of a sentence.
    """
    if not _SLOTS.possible([_SLOTS.bits(w) for w in words]):
        return False
    refused, beside = False, []
    for sentence in _SENTENCE.split(_QUOTED.sub(" ", answer)):
        words = tokens(sentence)
        turns = [0, *(k for k, w in enumerate(words) if k and w in _CONTRAST), len(words)]
        for begin, end in zip(turns, turns[1:], strict=False):
            if end - begin > 1 and align_refusal(words[begin:end]):
                refused = True
            else:
                beside += words[begin:end]
    if not refused:
        return False
    rest = [w for w in beside if w not in _POLITE]
    return len(_stems(rest) & _stems(prompt)) < ANSWERS and len(_ADVICE.intersection(rest)) < ANSWERS


def prose(text: str) -> str:
    """The text without code."""
    if "`" in text:
        text = _FENCED.sub(" ", text)
    if not _CODE_LINE.search(text):
        return text
    return "\n".join(x for x in text.split("\n") if len(_CODE_LINE.findall(x)) < 2)


def bare_words(answer: str | None) -> list[str]:
    text = answer or ""
    if "<" in text:
        text = _TAG.sub(" ", text)
    return tokens(text.replace("```", " "))


def is_truncated(answer: str) -> bool | str:
    """True or False, or the last word where that depends on whether it is a whole word."""
    if answer.count("```") % 2:
        return True
    text = answer.rstrip()
    if text.endswith("```"):
        return False
    text = _FENCED.sub(" ", text).rstrip() if "`" in text else text
    if not text:
        return False
    if text[-1] in ",:;(—–[«“-/=+" or re.search(r"(?:^|\n)\s*(?:\d+[.)]|[-*•])$", text[-12:] if len(text) > 12 else text):
        return True
    for left, right in ("()", "[]", "{}", "«»", "“”"):
        if left in text and text.count(left) > text.count(right) and not re.search(r"[:;]-?\($", text):
            return True
    if text.count('"') % 2 and not re.search(r'\d"', text):
        return True
    if text[-1] in ".!?…)»”\"'":
        return text[-1] == "." and bool(re.search(r"(?:^|\s)\d+\.$", text[-20:])) and "\n" in text
    words = _WORD.findall(text[-400:])
    last = re.search(r"(\w[\w'’-]*)$", text[-200:])
    if not last or not words:
        return False
    several = len(words) > 1 or len(text) > 400
    if several and (last[1].casefold() in UNFINISHED or _UNFINISHED_PHRASE.search(text[-60:])):
        return True
    if len(words) > 2 and words[-1].isalpha() and words[-1].islower() and (words[-2].casefold() in JOINING or re.search(r"[A-ZА-ЯЁ]", text)):
        return words[-1]
    return False


class Judge:
    """Judges batches of answers with models of languages."""

    def __init__(self, model: np.ndarray):
        self.model = model

    def defects(self, prompts: Sequence[str | None], answers: Sequence[str | None]) -> list[tuple[str | None, str | None]]:
        """For each answer its defect, or the last word on which it depends whether the answer is truncated."""
        out: list[tuple[str | None, str | None]] = []
        open_, texts = [], []
        for k, (p, a) in enumerate(zip(prompts, answers, strict=True)):
            bare = bare_words(a)
            if not bare or " ".join(bare[:3]) in NOTHING and len(bare) < 4:
                out.append(("empty", None))
                continue
            asked = tokens(p or "")
            if is_copy(asked, bare):
                out.append(("copy", None))
            elif is_refusal(asked, a, bare):
                out.append(("refusal", None))
            else:
                out.append((None, None))
                open_.append(k)
                texts += [prose(p or ""), prose(a)]
        foreign = self._foreign(texts)
        for n, k in enumerate(open_):
            if foreign[n] and not ASKS_LANGUAGE.search(prompts[k] or ""):
                out[k] = ("language", None)
                continue
            end = is_truncated(answers[k])
            out[k] = ("truncated", None) if end is True else (None, end.casefold()) if end else (None, None)
        return out

    def _foreign(self, texts: list[str]) -> list[bool]:
        """Of each two texts, question and answer, whether the answer is in a language that the question isn't in."""
        if not texts:
            return []
        letters = L.Letters(texts)
        by_script, scores = letters.scripts(), letters.scores(self.model)
        many = by_script.sum(1)
        main = by_script.argmax(1)
        out = []
        for k in range(0, len(texts), 2):
            p, a = k, k + 1
            out.append(bool(many[p] >= 4 and many[a] >= 4) and self._differs(by_script[p] / many[p], by_script[a] / many[a], int(main[p]), int(main[a]), scores[p], scores[a], int(many[a]), texts[a]))
        return out

    def _differs(self, asked: np.ndarray, given: np.ndarray, p: int, a: int, asked_scores: np.ndarray, given_scores: np.ndarray, many: int, text: str) -> bool:
        name = L.SCRIPTS[a]
        langs = L.OF_SCRIPT.get(name)
        if a != p:
            if asked[a] >= 0.3 and name in ("latin", "cyrillic"):
                pass  # a mixed question may be answered in either of its languages
            elif name != "latin":
                return bool(given[a] >= 0.6)
            else:
                words = {w.casefold() for w in _WORD.findall(text)}
                best = int(langs[given_scores[langs].argmax()])
                return bool(given[p] <= 0.3 and (len(words) >= 4 or len(words) > 1 and L.has_function_word(words, best)))
        if langs is None:
            return False
        # the languages the question may be in are those nearly as likely as the likeliest
        likely = asked_scores[langs]
        own = langs[likely >= likely.max() - 3] if a == p else langs
        best = given_scores[langs].max()
        return bool(best - given_scores[own].max() > max(MARGIN, MARGIN_LETTER * many))


def defect(prompt: str | None, answer: str | None, model: np.ndarray | None = None, torn: bool = False) -> str | None:
    """The defect of one answer to a prompt, or None; ``torn`` tells that its last word is no whole one.

    The first that fits: empty, copy, refusal, language, truncated. Without a model the function words alone tell languages.
    """
    found, last = Judge(L.train() if model is None else model).defects([prompt], [answer])[0]
    return found or ("truncated" if last and torn else None)


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words, apart for the last ones, and of the trigrams of texts whose function words tell their language."""
    names = ["kind", "word", "bucket", "n"]
    words: tuple[Counter[str], Counter[str]] = Counter(), Counter()  # elsewhere and at ends
    grams: np.ndarray | None = None

    def counted() -> pa.RecordBatch:
        n = [len(w) for w in words]
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(2, dtype=np.int32), n)), pa.array([*words[0], *words[1]], pa.string()), pa.nulls(sum(n), pa.int32()), pa.array([*words[0].values(), *words[1].values()], pa.int64())], names)

    for batch in batches:
        texts = [t for c in ("prompt", "answer") for t in batch.column(c).to_pylist() if t]
        language, plain = [], []
        for t in texts:
            found = _WORD.findall(t.casefold())
            if found and t.rstrip()[-1:].isalpha():
                words[1][found.pop()] += 1
            own = set(found)
            words[0].update(own)
            n = L.seeded(own)
            if n >= 0:
                language.append(n)
                plain.append(prose(t))
        if plain:
            one = L.Letters(plain).counts(np.array(language))
            grams = one if grams is None else grams + one
        if len(words[0]) > HELD_WORDS:
            yield counted()
            for w in words:
                w.clear()
    if words[0] or words[1]:
        yield counted()
    if grams is not None:
        at = np.flatnonzero(grams)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), 2, np.int32)), pa.nulls(len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(grams[at])], names)


def flag_answers(answers: DataFrame, keys: list[str], prompt: str = "prompt", answer: str = "answer") -> DataFrame:
    """The key columns and ``defect`` of each answer that has one; one row for each defective row, repeats included.

    A null or blank answer is empty. Without a prompt an answer can't be a copy or in another language. Whole texts
    are judged. Keys may be null and further columns are ignored. Two passes over the texts, which are never shuffled: the
    first counts words and the letter trigrams of languages, the second judges. An answer that ends without punctuation in a
    word which elsewhere hardly occurs, by the share of its occurrences, is taken for broken off; that is settled by a
    join of keys and last words.
    """
    spark = answers.sparkSession
    scratch = Scratch(spark, "pairs")
    rows = answers.select(*[F.col(k).alias(f"k{n}") for n, k in enumerate(keys)], F.col(prompt).alias("prompt"), F.col(answer).alias("answer"))
    counts = rows.select("prompt", "answer").mapInArrow(_profile, "kind int, word string, bucket int, n long").groupBy("kind", "word", "bucket").agg(F.sum("n").alias("n"))
    counts = scratch.save("counts", counts)
    # at most one row for each language and bucket, whatever the corpus
    grams = np.zeros(len(L.LANGUAGES) * L.BUCKETS)
    for r in counts.where("kind = 2").select("bucket", "n").toArrow().to_batches():
        grams[r.column(0).to_numpy()] = r.column(1).to_numpy()
    sent = spark.sparkContext.broadcast(L.train(grams))
    schema = ", ".join([*(f"k{n} {answers.schema[k].dataType.simpleString()}" for n, k in enumerate(keys)), "defect string, last string"])
    names = [*(f"k{n}" for n in range(len(keys))), "defect", "last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(sent.value)
        for batch in batches:
            p, a = batch.column("prompt").to_pylist(), batch.column("answer").to_pylist()
            found = judge.defects(p, a)
            some = pa.array([k for k, (d, w) in enumerate(found) if d or w], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(n).take(some) for n in names[:-2]), pa.array([d for d, w in found if d or w], pa.string()), pa.array([w for d, w in found if d or w], pa.string())], names)

    judged = scratch.save("judged", rows.mapInArrow(run, schema))
    ends = counts.where("kind = 1").select(F.col("word").alias("last"), F.col("n").alias("at_end"))
    body = counts.where("kind = 0").select(F.col("word").alias("last"), F.col("n").alias("elsewhere"))
    torn = ends.join(body, "last", "left").where(F.coalesce("elsewhere", F.lit(0)) <= ELSEWHERE * (F.col("at_end") + F.coalesce("elsewhere", F.lit(0)))).select("last")
    broken = judged.where("last is not null").join(torn, "last", "left_semi").select(*names[:-2], F.lit("truncated").alias("defect"))
    return judged.where("defect is not null").select(*names[:-1]).unionByName(broken).select(*[F.col(f"k{n}").alias(k) for n, k in enumerate(keys)], "defect")


def answers_of(pairs: DataFrame, dialogues: DataFrame) -> DataFrame:
    """src, rec_id, slot, prompt, answer of both answers of each pair and of each assistant turn of each dialogue."""
    both = F.explode(F.array(F.struct(F.lit(1).cast("long").alias("slot"), F.col("chosen").alias("answer")), F.struct(F.lit(2).cast("long").alias("slot"), F.col("rejected").alias("answer")))).alias("x")
    first = pairs.select(F.lit("dpo_preference_pairs").alias("src"), F.col("pair_id").alias("rec_id"), "prompt", both).select("src", "rec_id", "x.slot", "prompt", "x.answer")
    turn = lambda k: F.get("messages", k)
    asked = F.when(turn(F.col("slot") - 1)["role"] == "user", turn(F.col("slot") - 1)["content"])
    turns = dialogues.select(F.lit("sft_dialogues").alias("src"), F.col("thread_id").alias("rec_id"), "messages", F.posexplode("messages").alias("slot", "m")).where("m.role = 'assistant'")
    return first.unionByName(turns.select("src", "rec_id", F.col("slot").cast("long").alias("slot"), F.when(F.col("slot") > 0, asked).alias("prompt"), F.col("m.content").alias("answer")))

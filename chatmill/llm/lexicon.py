"""Classes of tokens for the model of personal information, and the generator of its training sentences."""

from __future__ import annotations

import random
import re

import numpy as np

KINDS = ("EMAIL", "PHONE", "ID_NUMBER", "ADDRESS", "NAME")

# Common given names, as any list of first names by frequency has them.
RUSSIAN_MEN = "Александр Сергей Дмитрий Андрей Алексей Владимир Максим Евгений Михаил Николай Иван Павел Константин Роман Илья Артём Виктор Юрий Денис Антон Игорь Олег Кирилл Никита Егор Вадим Владислав Тимур Руслан Глеб Григорий Даниил Степан Матвей Лев Фёдор Пётр Борис Леонид Станислав Валерий Георгий Тимофей Марк Рустам Ильдар Марат".split()
RUSSIAN_WOMEN = "Елена Ольга Наталья Анна Татьяна Мария Ирина Светлана Екатерина Анастасия Юлия Марина Людмила Александра Евгения Дарья Алина Виктория Ксения Полина Елизавета Галина Валентина Надежда Вера Любовь Лариса Жанна Инга Тамара Нина Оксана Яна Диана Кристина Маргарита Софья Варвара Алла Раиса Зоя Лидия Карина Ульяна Василиса Милана Гульнара Айгуль Лилия".split()
ENGLISH = "John James Robert Michael William David Richard Thomas Charles Daniel Matthew Mark Paul Steven Andrew Kevin Brian George Edward Peter Mary Patricia Jennifer Linda Elizabeth Susan Jessica Sarah Karen Lisa Nancy Margaret Emily Laura Anna Alice Helen Julia Emma Grace".split()

_LATIN = dict(zip("абвгдеёжзийклмнопрстуфхцчшщъыьэюя", "a b v g d e yo zh z i y k l m n o p r s t u f kh ts ch sh shch  y  e yu ya".split(" "), strict=True))


def to_latin(word: str) -> str:
    return "".join(_LATIN.get(c, c) for c in word.lower())


#: Given names that lose a vowel in declension.
_STEMS = {"павел": "павл", "лев": "льв", "пётр": "петр", "любовь": "любов"}


def case_forms(name: str) -> list[str]:
    """A given name in the cases nominative, genitive, dative, accusative, instrumental, prepositional."""
    n = name.lower()
    if n in _STEMS:
        s = _STEMS[n]
        return [n, s + "и", s + "и", n, n + "ю", s + "и"] if n == "любовь" else [n, s + "а", s + "у", s + "а", s + "ом", s + "е"]
    if n.endswith("ия"):
        return [n, n[:-1] + "и", n[:-1] + "и", n[:-1] + "ю", n[:-1] + "ей", n[:-1] + "и"]
    if n.endswith("я"):
        return [n, n[:-1] + "и", n[:-1] + "е", n[:-1] + "ю", n[:-1] + "ей", n[:-1] + "е"]
    if n.endswith("а"):
        return [n, n[:-1] + ("и" if n[-2] in "гкхжшчщ" else "ы"), n[:-1] + "е", n[:-1] + "у", n[:-1] + ("ей" if n[-2] in "жшчщц" else "ой"), n[:-1] + "е"]
    if n.endswith("ий"):
        return [n, n[:-1] + "я", n[:-1] + "ю", n[:-1] + "я", n[:-1] + "ем", n[:-1] + "и"]
    if n.endswith("й") or n.endswith("ь") and name in RUSSIAN_MEN:
        return [n, n[:-1] + "я", n[:-1] + "ю", n[:-1] + "я", n[:-1] + "ем", n[:-1] + "е"]
    if n.endswith("ь"):
        return [n, n[:-1] + "и", n[:-1] + "и", n, n + "ю", n[:-1] + "и"]
    return [n, n + "а", n + "у", n + "а", n + "ом", n + "е"]


def _plain_e(w: str) -> str:
    return w.replace("ё", "е")


GIVEN = frozenset(_plain_e(f) for n in RUSSIAN_MEN + RUSSIAN_WOMEN for f in case_forms(n))
FOREIGN = "Джон Джеймс Роберт Майкл Уильям Дэвид Ричард Томас Чарльз Дэниел Кевин Брайан Джордж Эдвард Питер Мэри Линда Сьюзан Джессика Сара Лиза Эмили Лаура Эмма Грейс".split()
GIVEN = GIVEN | {_plain_e(f) for n in FOREIGN for f in case_forms(n)}
GIVEN_LATIN = frozenset(v for m in RUSSIAN_MEN + RUSSIAN_WOMEN for n in case_forms(m) for v in (to_latin(n), to_latin(_plain_e(n)), to_latin(n).replace("iy", "y"), to_latin(n).replace("kh", "h"), to_latin(n).replace("iy", "i"), to_latin(n).replace("ks", "x"))) - {"raise"} | {n.lower() for n in ENGLISH}
SURNAME = re.compile(r"[а-я]{2,}(?:[ое]в|[иы]н)(?:а|у|ым|ой|ою|е|ы|ых|ыми?)?|[а-я]{3,}(?:ск|цк)(?:ий|ая|ого|ому|им|ом|ой|ую)|[а-я]{3,}(?:енко|чук|швили|ян)|[а-я]{4,}(?:ович|евич)")
SURNAME_LATIN = re.compile(r"[a-z]{2,}(?:[oe]v|yov|[iy]n)a?|[a-z]{3,}sk(?:iy|y|aya|aia|i|a)|[a-z]{3,}(?:enko|chuk|son|man|shvili|yan)")
PATRONYMIC = re.compile(r"[а-я]{2,}(?:[ое]вич|ьич)(?:а|у|ем|е)?|[а-я]{2,}(?:[ое]вн|ичн)(?:а|ы|е|у|ой)|[a-z]{2,}(?:ovich|evich|ovna|evna|ichna)")

# Words of a kind.
_LISTS = {
    "digit": "ноль нуль один два три четыре пять шесть семь восемь девять zero one two three four five six seven eight nine",
    "at": "dog at собака", "dot": "dot точка", "plus": "плюс plus",
    "street": "ул улица улице улицы улицу пр просп проспект проспекте проспекта пер переулок переулке переулка бульвар бульваре бульвара шоссе наб набережная набережной пл площадь площади проезд проезде тупик аллея микрорайон мкр",
    "road": "street road avenue lane drive boulevard square st rd ave blvd court way terrace",
    "house": "дом доме дома домом стр строение вл владение", "room": "корпус корп подъезд квартира квартиры квартире кв эт этаж оф офис литера flat apt suite unit floor apartment room",
    "town": "город городе села село деревня пос поселок city",
    "id": "паспорт паспорта паспорту паспортные серия серии серию инн снилс налоговый налогового tax ssn passport insurance полис полиса удостоверение",
    "number": "номер номера номеру № no number", "phone": "тел телефон телефона телефоны вотсап ватсап whatsapp набери наберите звони звоните позвони позвоните звонить call ring phone мобильный мобильник sms смс mobile",
    "mail": "почта почту почте почты mail email мыло мылу пишите contact емейл cc", "place": "адрес адресу адреса живу находимся встреча доставка забирайте ship parcel офис",
    "count": "заявка заявке заявку счетчик счетчика метрика метрики сборка сборки узел узла выгрузил выгрузили порт заказ заказа артикул версия версии order ticket build попытка индекс isbn лог записей хеш id",
    "book": "дочитал дочитала читаю прочитал прочел перечитал книга книгу novel глава главу chapter том",
    "unit": "строк строки раз числа число минут минуты час часа часов дн дней дня тысяч руб рублей байт пунктов штук шагов процентов rows times bytes steps points percent minutes hours days",
    "little": "и в во на не с со по что как из за у то от для если но так же или его к о об до при мы я ты он она они вы это the a an to is it of and in on for with from by who was are be",
    "zone": "com net org ru test example invalid info io dev",
}
_WORDS = {w: k for k in reversed(list(_LISTS)) for w in _LISTS[k].split()}
_ADJECTIVE = re.compile(r"[а-я]{3,}(?:ая|яя|ой|ый|ий|ого|его|ую|ей|ом|ные)")
_MARKS = "@.,-+()/<>[]{}:;№%#\"'«»—–!?|*_=$&`~\\"
_LONE = "дгкквсуоибртгkcd"
_CASES = ("low", "cap", "all")
_KINDS_OF_WORDS = [*_LISTS, "given", "patronymic", "surname", "adjective", "word", "initial", *(f"x{c}" for c in sorted(set(_LONE)))]
CLASSES = ["border", *(f"{k} {c} {s}" for k in _KINDS_OF_WORDS for c in _CASES for s in ("cyr", "lat")), *(f"d{n}" for n in range(1, 16)), "d1 78", "d2 00", "d3 9", "d10 9", "d11 789", *_MARKS, "mark"]
_NUMBER = {c: n for n, c in enumerate(CLASSES)}
_CONTEXT = ("id", "phone", "mail", "place", "count", "book", "number", "street")
CONTEXT_BITS = np.zeros(len(CLASSES), np.int64)
for _c, _n in _NUMBER.items():
    if _c.split()[0] in _CONTEXT:
        CONTEXT_BITS[_n] = 1 << _CONTEXT.index(_c.split()[0])
#: Which classes tell of a mail address, a name, a place and a digit.
_TELLING = ({"@", "at", "%"}, {"given", "patronymic", "initial"}, {"street", "road", "house", "room", "town"}, {"digit"})
HELD = np.array([[c.split()[0] in t for c in CLASSES] for t in _TELLING], np.int64)
INITIALS = np.array([c.split()[0] == "initial" for c in CLASSES])
DOT = _NUMBER["."]


def classify(token: str) -> int:
    """Number of a token's class, by what it is made of and the lists it is in."""
    head = token[0]
    if head.isdigit():
        n = len(token)
        name = "d1 78" if token in ("7", "8") else "d2 00" if token == "00" else "d3 9" if n == 3 and head == "9" else "d10 9" if n == 10 and head == "9" else "d11 789" if n == 11 and token[:2] in ("79", "89") else f"d{min(n, 15)}"
        return _NUMBER[name]
    if not head.isalpha():
        return _NUMBER[head if head in _MARKS else "mark"]
    low = _plain_e(token.lower())
    case = "all" if len(token) > 1 and token.isupper() else "cap" if head.isupper() else "low"
    script = "cyr" if "а" <= low[0] <= "я" else "lat"
    if len(token) == 1:
        kind = "initial" if case == "cap" else f"x{low}" if low in _LONE else _WORDS.get(low, "word")
    elif low in _WORDS:
        kind = _WORDS[low]
    elif low in GIVEN or low in GIVEN_LATIN:
        kind = "given"
    elif PATRONYMIC.fullmatch(low):
        kind = "patronymic"
    elif len(low) > 4 and (SURNAME.fullmatch(low) or SURNAME_LATIN.fullmatch(low)):
        kind = "surname"
    elif _ADJECTIVE.fullmatch(low):
        kind = "adjective"
    else:
        kind = "word"
    return _NUMBER[f"{kind} {case} {script}"]


def training_sentences(count: int, seed: int, leave_out: tuple[str, ...] = (), only: tuple[str, ...] = ()) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Texts with their personal spans, written by a grammar of forms; many hold none but look alike.

    Every form has a name; those in ``leave_out`` are not used, and no others where one is in ``only``.
    """
    r = random.Random(seed)
    syllables = "ба ве ли мо ну ра со ти ко де жи фа гру шо тря кли по вен дор сил".split()
    made = lambda n: "".join(r.choice(syllables) for _ in range(n))
    num = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    some = lambda forms: r.choice([v for k, v in forms.items() if k in only] or [v for k, v in forms.items() if k not in leave_out])

    def surname(female: bool, case: int) -> str:
        root = made(2) + r.choice(["", "", made(1)])
        ending = r.choice(["ков", "лёв", "нин", "рин", "цын", "шов", "кин", "тов", "йкин", "цев", "пин", "дов", "слов", "ский", "енко", "ян", "", ""])
        if ending == "ский":
            return root + (["ская", "ской", "ской", "скую", "ской", "ской"] if female else ["ский", "ского", "скому", "ского", "ским", "ском"])[case]
        if ending == "":
            return root + r.choice(["к", "нт", "рг", "ль", "х"]) + ("" if female else ["", "а", "у", "а", "ом", "е"][case])
        if ending in ("енко", "ян"):
            return root + ending + ("" if female or ending == "енко" else ["", "а", "у", "а", "ом", "е"][case])
        return root + ending + (["а", "ой", "ой", "у", "ой", "ой"] if female else ["", "а", "у", "а", "ым", "е"])[case]

    def patronymic(female: bool, case: int) -> str:
        root = r.choice("Олег Иван Марат Тимур Борис Андрей Сергей Алексей Николай Юрий Максим Игор Роман Антон Павл Петр Глеб Денис".split()).lower()
        root = root[:-1] + "е" if root.endswith("й") else root + "о"
        return root + "в" + (["на", "ны", "не", "ну", "ной", "не"] if female else ["ич", "ича", "ичу", "ича", "ичем", "иче"])[case]

    def name() -> str:
        female, case = r.random() < 0.5, r.choice([0, 0, 0, 1, 2, 3, 4, 5])
        given = r.choice(RUSSIAN_WOMEN if female else RUSSIAN_MEN)
        g, s, p = case_forms(given)[case].capitalize(), surname(female, case).capitalize(), patronymic(female, case).capitalize()
        if r.random() < 0.1:
            s += "-" + surname(female, case).capitalize()
        i, i2 = given[0] + ".", patronymic(female, 0)[0].upper() + "."
        foreign = f"{r.choice(ENGLISH)} {r.choice(['Smith', 'Brown', 'Miller', 'Carter', 'Hughes', 'Parker', 'Wood', to_latin(made(2)).capitalize() + r.choice(['son', 'man', 'er', 'ley', 'ton'])])}"
        away, tail = r.choice(FOREIGN), r.choice(["Смит", "Браун", "Картер", "Паркер", made(2).capitalize() + r.choice(["сон", "ман", "ер", "тон"])])
        distant = f"{case_forms(away)[case].capitalize()} {tail + ('' if away[-1] in 'аяи' else ['', 'а', 'у', 'а', 'ом', 'е'][case])}"
        out = some({
            "foreign": distant, "given surname": f"{g} {s}", "surname given": f"{s} {g}", "given patronymic": f"{g} {p}", "given patronymic surname": f"{g} {p} {s}", "surname given patronymic": f"{s} {g} {p}",
            "two initials surname": f"{i}{r.choice(['', ' '])}{i2}{r.choice(['', ' '])}{s}", "surname two initials": f"{s} {i}{r.choice(['', ' '])}{i2}", "initial surname": f"{i} {s}", "surname initial": f"{s} {i}",
            "english": foreign, "given patronymic 2": f"{g} {p}",
        })
        if out is not foreign and r.random() < 0.25:
            out = " ".join(to_latin(w).capitalize() if w[-1:] != "." else "".join(x.capitalize() if x != "." else x for x in re.split(r"(\.)", to_latin(w))) for w in out.split())
        return r.choice([out, out, out, out.lower(), out.upper()] if "." not in out else [out, out, out, out.upper()])

    def phone() -> str:
        a, b, c, d = "9" + num(2), num(3), num(2), num(2)
        words = r.choice(["", "плюс "]) + " ".join(r.choice("ноль один два три четыре пять шесть семь восемь девять".split()) for _ in range(11))
        gap, line = r.choice(["", " ", "-", "."]), r.choice(["-", " ", "."])
        lead = r.choice(["+7", "8", "00 7", "+ 7", "7"])
        return some({
            "brackets": f"{lead} ({a}) {b}{line}{c}{line}{d}", "brackets 2": f"{lead}-({a})-{b}-{c}-{d}", "groups": f"{lead}{r.choice([' ', '-', ' - '])}{a}{line}{b}{line}{c}{line}{d}", "solid": r.choice(["+7", "8", "7"]) + a + b + c + d,
            "pairs": f"{lead} {a} {b} {c}{d}", "short": f"{a} {b}{gap}{c}{d}", "short groups": f"{a}{line}{b}{line}{c}{line}{d}", "mixed": f"+7-{a}-{b}.{c}.{d}",
            "american": f"+1 ({num(3)}) {num(3)}-{num(4)}", "british": f"+44 {num(4)} {num(6)}", "other": f"+{r.choice(['49', '375', '380', '972'])} {num(2)} {num(3)} {num(2)} {num(2)}", "words": words, "zone": f"({num(3)}) {num(3)}-{num(2)}-{num(2)}",
        })

    def mail() -> str:
        word = lambda: to_latin(made(r.choice([1, 2, 3]))) if r.random() < 0.8 else r.choice("aabcdeghikmnsty")
        user = (to_latin(r.choice(RUSSIAN_MEN + RUSSIAN_WOMEN)) + r.choice([".", "-", "_", ""]) + word() if r.random() < 0.3 else word()) + r.choice(["", "." + word(), "_" + word(), "-" + word(), num(2), "+" + word(), "." + word() + num(1), "_" + word() + num(2)])
        host = r.choice([word(), word() + "." + word(), "mail", "box", "team." + word()])
        zone = r.choice(["com", "ru", "org", "net", "test", "example", "invalid"])
        at, dot = r.choice([" (at) ", "(at)", " [at] ", "[@]", " {at} "]), r.choice([".", "[.]", " (dot) ", "(dot)"])
        veiled = f"{user}{at}{host.replace('.', dot)}{dot}{zone}"
        said, point = r.choice(["dog", "at", "собака"]), r.choice(["dot", "точка"])
        return some({
            "plain": f"{user}@{host}.{zone}", "plain 2": f"{user}@{host}.{zone}", "capitals": f"{user}@{host}.{zone}".upper(), "percent": f"{user}%40{host}.{zone}", "veiled": veiled, "spaced": f"{user} @ {host.replace('.', ' . ')} . {zone}",
            "spoken": f"{user} {said} {host.replace('.', r.choice(['.', f' {point} ']))} {point} {zone}",
        })

    def number() -> str:
        return some({
            "passport": f"{r.choice(['паспорт', 'паспорт:', 'Паспорт РФ', 'passport', 'паспорта'])} <{num(4)}{r.choice([' ', '-', ' № '])}{num(6)}>", "passport parts": f"паспорт <{num(2)} {num(2)} {num(6)}>", "series": f"паспорт {r.choice(['серии', 'серия'])} <{num(2)} {num(2)} номер {num(6)}>", "series 2": f"серия/номер: <{num(4)}-{num(6)}>",
            "tax": f"{r.choice(['инн', 'ИНН', 'инн:', 'ИНН:'])} <{num(r.choice([10, 12]))}>", "tax groups": f"{r.choice(['инн:', 'ИНН'])} <{num(4)} {num(4)} {num(r.choice([2, 4]))}>", "tax word": f"налоговый номер{r.choice(['', ':'])} <{num(6)}-{num(6)}>", "tax english": f"tax id{r.choice(['', ':'])} <{num(12)}>",
            "insurance": f"{r.choice(['СНИЛС', 'снилс', 'снилс:'])} <{num(3)}-{num(3)}-{num(3)} {num(2)}>", "insurance solid": f"{r.choice(['СНИЛС', 'снилс'])} <{num(11)}>", "insurance lines": f"снилс <{num(3)}-{num(3)}-{num(3)}-{num(2)}>", "social": f"SSN{r.choice(['', ':'])} <{num(3)}-{num(2)}-{num(4)}>",
            "passport english": f"passport no. <{num(r.choice([9, 10]))}>", "passport letters": f"passport{r.choice([' no.', ':', ''])} <{r.choice('CPL')}{num(2)}{r.choice('XYZ')}{num(2)}{r.choice('TRK')}{num(2)}>", "bare groups": f"<{num(3)}-{num(3)}-{num(3)} {num(2)}>",
        })

    def address() -> str:
        n, k = str(r.choice([r.randint(1, 12), r.randint(1, 150), r.randint(1, 150)])), str(r.randint(1, 300))
        root, city = made(2).capitalize(), made(3).capitalize() + r.choice(["", "ск", "град"])
        adj = root + r.choice(["ная", "ская", "вая", "чная"])
        oblique, man = adj[:-2] + "ой", adj[:-2] + ("ий" if adj[-3] == "к" else "ый")
        unit = r.choice([f", кв. {k}", f" кв {k}", f", квартира {k}", f", корп. {r.randint(1, 5)}", "", "", f", оф. {k}", f", эт. {r.randint(1, 20)}", f", подъезд {r.randint(1, 6)}, квартира {k}", f" корпус {r.randint(1, 5)}"])
        house = r.choice([n, n, f"{n}/{r.randint(1, 9)}", f"{n}к{r.randint(1, 5)}", f"{n}-{k}", n + r.choice("абв")])
        place = r.choice(["", "", f"г. {city}, ", f"{num(6)}, {city}, ", f"{num(6)}, г. {city}, ", f"{city}, "])
        english, flat = " ".join(r.choice("Mill Maple Hill Old Oak Stone River Quarry Otter Creek Windmill Church Park High Hollow".split()) for _ in range(r.choice([1, 1, 2]))), r.choice([f", Apt {k}", f", flat {k}", "", f", suite {k}"])
        return some({
            "street house": f"{place}{r.choice(['ул.', 'ул', 'улица', 'улице'])} {r.choice([adj, adj.lower(), root, surname(False, 1).capitalize()])}{r.choice([', д. ', ', ', ' ', ' д. ', ', дом '])}{house}{unit}", "house last": f"{place}{adj} {r.choice(['улица', 'ул.', 'площадь', 'наб.', 'набережная'])}{r.choice([', дом ', ', д. ', ', ', ' '])}{house}{unit}",
            "in house": f"{oblique} улице{r.choice([' в доме ', ', дом '])}{n}{unit}", "no kind": f"{place}{adj} {house}{r.choice([f', подъезд {r.randint(1, 6)}, квартира {k}', f', кв. {k}', f' корпус {r.randint(1, 5)}', f', оф. {k}', f', стр. {r.randint(1, 9)}'])}", "no kind oblique": f"{oblique} {n}",
            "avenue": f"{place}{r.choice(['пр-т', 'просп.', 'проспект', 'пр.'])} {r.choice([city, root + 'а', surname(False, 1).capitalize()])}, {house}{unit}", "lane": f"{place}{r.choice(['пер.', 'переулок', 'проезд', 'тупик'])} {man}, {house}{unit}", "boulevard": f"{root}ский {r.choice(['б-р', 'бульвар', 'проезд', 'пер.'])}, {r.choice(['стр. ', 'д. ', ''])}{house}{unit}",
            "english": f"{n} {english} {r.choice(['Road', 'Street', 'Avenue', 'Lane', 'Drive', 'St.', 'Rd'])}{flat}", "english last": f"{english} {r.choice(['Street', 'Road', 'Avenue'])} {n}{flat}",
        })

    around = {
        "NAME": ["кто помнит, где {}?", "передайте привет: {}", "Контакт: {}.", "список ведёт {}", "{} обещает ответить к 5 числу", "It was {} who reviewed it", "{}", "{}", "{}", "{}", "{} | ищу проект", "{} ✨", "созвонились с {} насчёт сборки", "отдал ключи {}", "по документам там {}, а не Тарлин", "{} — наш человек в проекте", "спасибо {} за помощь", "работал вместе с {}", "скиньте фото, кому — {}", "ask {} about it", "{} написала вчера", "звонил {}, просил ответить", "Привет, {}!", "с уважением, {}"],
        "PHONE": ["если горит — {}", "мой номер {}", "вотсап {}, пишите там", "call {} if urgent", "{} звонить днём", "старый {} не работает", "Телефон для связи: {}, спросить", "{}", "ring me: {}, evenings only", "Звоните {} после 18 часов", "набери {}", "тел. {}", "пишите если что {}", "старый {} не работает, ну да, похоже на то"],
        "EMAIL": ["пишите на {}, отвечу", "моя почта {} если что", "contact me at {} please", "{}", "дубль отправил {}, проверьте спам", "файл жду на {} до 11 числа", "пришло от <{}> в 10:10", "({}) — это рабочая", "cc: {}", "Кидайте сюда: {}", "подписка оформлена на {}"],
        "ADDRESS": ["встреча — {}, домофон сломан", "живу тут: {}", "ship it to {}", "{}", "забирайте по адресу {}, до 15:00", "офис переехал, {}", "офис переехал, теперь {}", "Доставка: {}.", "находимся {}, вход со двора", "документы ждут: {}", "the parcel goes to {}", "встречаемся на {}", "{} принимал работу курьер", "{} как лучше доехать", "that works. {} после обеда"],
        "ID_NUMBER": ["вот данные, {}, хватит?", "{} — проверьте у себя", "my {}, please keep it private", "{}", "Данные: {}", "в анкете {}, подпись стоит", "скинул {}, больше ничего нет", "в заявке указано {}, всё верно?", "please verify {}"],
    }
    makers = {"NAME": name, "PHONE": phone, "EMAIL": mail, "ADDRESS": address, "ID_NUMBER": number}

    def nothing() -> str:
        g, x = r.choice(RUSSIAN_MEN + RUSSIAN_WOMEN), made(3).capitalize()
        odd = r.choice([x + "ин", x + "ов", x + "ис", x + "ан"])
        text = r.choice([
            f"дочитал роман {odd}, глава {num(2)}", f"Читаю роман {odd}, глава {num(1)}", f"дочитал роман {odd}, глава {num(2)}", f"Роман {odd} дочитал вчера", f"Вера в успех тает, попытка {num(2)}", f"{g}, глянь пункт {num(2)}", f"{g} из поддержки", f"{g} обещает ответить к {num(1)} числу", f"{g}: смотри {odd}", f"передай {g}, что {odd} упал",
            f"выгрузили 8 912 {num(3)} строк за {num(2)} минут", f"заявка 44{num(9)} висит", f"счётчик дошёл до {num(10)}", f"счётчик дошёл до 79{num(9)}", f"номер 978-5-{num(4)}-1 в списке", f"isbn 978-5-{num(3)}-{num(5)}-1", f"метрика {num(3)}-{num(2)}-20-10 без изменений", f"метрика {num(3)}-{num(3)}-{num(3)}-10 без изменений", f"заказ {num(10)}, строка {num(3)}", f"заказ {num(12)} в пути",
            f"сборка {num(8)}.{num(4)} прошла", f"лог {num(4)} {num(6)} записей", f"улица в {x} перекрыта до 11:00", f"на улице минус {num(2)}, сижу тут", f"на улице {x} {num(2)} человек", f"ticket {num(12)} is open", f"id {num(9)}", f"хеш {num(12)}", f"{num(2)} числа", f"узел {num(3)}.{num(2)}.{num(1)}.{num(2)} отвечает", f"порт {num(4)} занят", f"версия {num(1)}.{num(2)}.{num(1)}", f"проект {odd}, попытка {num(3)}",
            f"у нас это заняло {num(3)} минут", f"разница вышла {num(3)} процентов", f"записали как случай номер {num(2)}", f"подробности в ветке {odd}", f"вариант {odd} тоже не спас", f"ждём ответа от группы {x} ещё {num(2)} дней", f"начал с варианта {odd}: сначала проверить сервер", f"потеряли на этом {num(2)} часов", f"осталось {num(2)} пунктов из {num(3)}", f"Step {num(2)}: load the {x}", f"see the {to_latin(odd).capitalize()} notes", f"the {to_latin(x).capitalize()} version failed, we logged it as case {num(3)}",
            f"run --{to_latin(x)} {num(4)}", f"{to_latin(x)}[{num(4)}] = load({num(4)})", f"SELECT {to_latin(x)}_id FROM {to_latin(x)} WHERE {to_latin(x)} > {num(3)};", f"@{to_latin(x)} глянь", f"https://{to_latin(x)}.example/{num(3)}", f"git@{to_latin(x)} не отвечает", f"{x} Studio вышел", f"встреча в {num(2)}:{num(2)}", f"{num(4)}-{num(2)}-{num(2)} {num(2)}:{num(2)}", "[PERSON_REDACTED] писал", "[EMAIL_REDACTED], отвечу", "пишите [PHONE_REDACTED]", f"в доме {num(2)} холодно", f"{x}ская {num(2)} версия", f"дом {num(2)} этажей", f"Как настроить {x} {num(1)}?",
            f"Есть идеи? {x} падает", f"кто-нибудь пробовал {odd}?", "лол", "+1", f"It took {num(4)} minutes", f"they went at {num(2)} to the {to_latin(x).capitalize()} street fair", f"look at {to_latin(x)} dot product {num(2)}", f"{g} {num(2)} лет в проекте", f"роман с {x}ом затянулся", f"лев спит, {x} работает", f"A. {x} шаг первый", f"вариант Б. {x} лучше", f"{case_forms(g)[0].capitalize()} {r.choice('🌿✨🙈🚀')}", f"{to_latin(g).capitalize()} {r.choice('🌿✨🙈🚀')}", g, to_latin(g), f"{g} | ищу проект", f"{made(2).capitalize()}{r.choice(['ой', 'ая', 'ый'])} {made(2)} — тема отдельная", f"{g} — тема отдельная",
        ])
        if r.random() < 0.4:
            text = filler()
        return r.choice([text, text, text, text.upper(), text.lower(), text.capitalize()])

    common = "a an the needs a its we should start the server again because it fails every night and nobody knows how to check what the team has done since the last release which is fine but slow".split()
    usual = "мы опять запускали сервер потому что он падает каждую ночь и никто не знает как проверить что сделала команда после последнего релиза хотя всё работает но очень медленно сначала затем настроить проверить тема отдельная время".split()
    signs = "Monday Tuesday Since How What Why Usually First Account Deleted Team Support Docker Linux Python Россия Москва Сбер Сначала Причина Ноутбук Ребят Хаб Однако".split()

    def filler() -> str:
        """Running words, lines of code and unbroken runs of characters."""
        x, y = to_latin(made(r.choice([2, 3]))), to_latin(made(2))
        words = [r.choice([*r.choice([common, usual]), *([made(3), made(3).capitalize(), to_latin(made(2)).capitalize()] if r.random() < 0.3 else [])]) for _ in range(r.randint(2, 14))]
        return r.choice([
            " ".join(words), " ".join(words).capitalize() + r.choice([".", "?", "", "!"]), f"{r.choice(signs)} {' '.join(words)}", f"{r.choice(signs)} {r.choice(signs)} {words[0]}", f"{r.choice(signs)} {r.choice(signs)}", f"{r.choice(words)} на {r.choice(['три', 'шесть', 'семь'])} {r.choice(words)}, {r.choice(words)}",
            f"```\n{x}_{y} = load({num(r.choice([1, 2, 4]))})\n```", f"{x}_{y} = {y}_{x}[{num(1)}]\n    {x}_{y} = load({num(3)})\n", f"if {x}.size > {num(3)}:\n    {y}.{x}({num(2)})", f"# {x} {y}\n# {x} {to_latin(made(3))}\n", f"return {x}[{num(2)}]\n", f"---\n{' '.join(words)}\n---", f"{r.choice('СВКОУЯИА')} {made(3)}{r.choice(['ого', 'ого', 'ая', 'ых', 'ой'])} {' '.join(words)}", f"{r.choice('СВКОУЯИ')} {' '.join(words)}", f"{r.choice('AI')} {' '.join(words)}", f"{' '.join(words)}. {r.choice('СВКОУЯИA')} {made(3)}{r.choice(['а', 'ого', 'ников', ''])} {words[0]}", f"{r.choice(['раз)', 'случай номер 54', 'часов)', words[0]])}. @{y}_{num(2)} уже ответил", f"@{x}_{num(1)} {words[0]}", f"({words[0]}) @{x}", f"{words[0]}-{y}? @{x}_{num(2)} уже ответил", f"{words[0]}{r.choice('.?!')} @{x}_{num(r.choice([1, 2, 4]))} уже ответил", f"{num(3)} of {num(4)} points remain", f"({num(3)} of {num(4)} points remain)", f"случай номер {num(3)}. Шаг {num(4)}: {words[0]}", f"the {x.capitalize()} variant failed too. {r.choice(RUSSIAN_WOMEN)} в {made(2)}, попытка {num(2)}", f"{words[0]} every {num(3)} minutes. Our {words[0]}", f"+{num(r.choice([1, 3, 6]))} @{x}_{num(2)} {words[0]}", f"+{num(r.choice([2, 4, 6, 7]))} {words[0]}", f"{num(1)}. {r.choice('🌿✨🙈🚀')} @{x}_{num(2)} уже", f"переехали из города {r.choice(RUSSIAN_MEN)} в {made(3).capitalize()}", f"in project {made(3).capitalize()}{r.choice('?.')} A {' '.join(words)}", f"{words[0]}, а {made(3)}ой {words[0]}", f"совет от {made(4).capitalize()}. {r.choice(['Шаг', 'Step', 'Пункт'])} {num(3)}: {words[0]}", f"ветке {made(4).capitalize()}. На улице минус {num(1)}", f"ветке {made(4).capitalize()}. на улице минус {num(1)}", f"{r.choice(RUSSIAN_MEN + RUSSIAN_WOMEN)}. {' '.join(words)}", f"see the {x.capitalize()} notes. A {' '.join(words)}", f"- {words[0]}\n- {' '.join(words)}\n",
            "".join(r.choice("abcdefghkmnpqrstuvwxyz0123456789") for _ in range(r.randint(20, 90))), "".join(r.choice("0123456789abcdef") for _ in range(r.choice([32, 40, 64]))), f"{x}-{y}-{num(2)}", f"{x}.{y}.{x}", f"{x}@{y}", f"{y}/{x}:{num(1)}.{num(1)}", f"{made(2)}-{made(2)} {made(3)}",
        ])

    out = []
    for _ in range(count):
        text, spans = "", []
        for _ in range(r.choice([1, 1, 2, 3])):
            if text:
                text += r.choice([". ", " ", "\n", ", ", "! ", "? ", ".. "])
            if r.random() < 0.5:
                text += nothing()
                continue
            kind = r.choice(KINDS)
            before, after = r.choice(around[kind]).split("{}")
            value = makers[kind]()
            if r.random() < 0.08:
                before, after = before.upper(), after.upper()
            if kind == "ID_NUMBER" and "<" in value:
                lead, core = value[: value.index("<")], value[value.index("<") + 1 : value.index(">")]
            else:
                lead, core = "", value
            text += before + lead
            spans.append((len(text), len(text) + len(core), kind))
            text += core
            if kind == "NAME" and r.random() < 0.12:
                value = phone()
                text += r.choice([" ", ", ", ": ", " — "])
                spans.append((len(text), len(text) + len(value), "PHONE"))
                text += value + r.choice(["", " ", "\n"])
                continue
            text += after
        out.append((text, spans))
    return out

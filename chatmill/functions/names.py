"""Forms of Russian names in the cases, by the endings of their declensions."""

from __future__ import annotations

import re

#: Given names that lose a vowel.
_STEMS = {"павел": "павл", "лев": "льв", "пётр": "петр", "петр": "петр", "любовь": "любов"}


def _women(n: str) -> list[str]:
    return [n, *(n[:-1] + e for e in (("и" if n[-2] in "гкхжшчщ" else "ы"), "е", "у", ("ей" if n[-2] in "жшчщц" else "ой")))]


def case_forms(name: str) -> list[str]:
    """The forms of a name or surname, small letters; the name itself alone where it isn't declined."""
    n = name.lower()
    if len(n) < 3 or not re.fullmatch("[а-яё-]+", n):
        return [n]
    if n in _STEMS:
        s = _STEMS[n]
        return [n, *(s + e for e in (("и", "ью") if n == "любовь" else ("а", "у", "ом", "е")))]
    if re.search("[оеё]в$|[иы]н$", n):
        return [n, *(n + e for e in ("а", "у", "ым", "ом", "е"))]
    if re.search("(?:[оеё]в|[иы]н)а$", n):
        return [n, *(n[:-1] + e for e in ("ой", "у", "ы", "е"))]
    if n.endswith(("ский", "цкий")):
        return [n, *(n[:-2] + e for e in ("ого", "ому", "им", "ом"))]
    if n.endswith(("ская", "цкая")):
        return [n, *(n[:-2] + e for e in ("ой", "ую"))]
    if n.endswith("ия"):
        return [n, *(n[:-1] + e for e in ("и", "ю", "ей"))]
    if n.endswith("я"):
        return [n, *(n[:-1] + e for e in ("и", "е", "ю", "ей"))]
    if n.endswith("а"):
        return _women(n)
    if n.endswith("ий"):
        return [n, *(n[:-1] + e for e in ("я", "ю", "ем", "и"))]
    if n.endswith(("й", "ь")):
        return [n, *(n[:-1] + e for e in ("я", "ю", "ем", "е"))]
    if n[-1] in "бвгджзклмнпрстфхцчшщ":
        return [n, *(n + e for e in ("а", "у", "ом", "е"))]
    return [n]

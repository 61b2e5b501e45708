"""Languages of texts by models of letter trigrams, learnt from the texts themselves.

Lists of function words only start the learning: a text in which those of one language clearly prevail counts for that
language's model. The models then judge all texts, also such as hold none of these words. Between scripts letters decide.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np

from chatmill.llm.codes import code_points

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
#: Trigrams a model is taken to have seen besides its own, so that a small model isn't too sure.
PRIOR = 2000
#: Part of the probability that is spread over all trigrams.
SPREAD = 0.1
#: Function words of one language that a text must hold, and hold more than of any other, to count for its model.
SURE, AHEAD = 3, 2

# Frequent function words of languages.
FUNCTION_WORDS = {
    "ru": "и в не на что с по это как из за у то от для если но так же или его ещё чтобы был при уже только всё нас она они вы мы я",
    "uk": "і та що це не на з до як для але так чи його ще щоб був під вже тільки все нас вона вони ви ми я",
    "be": "і ў не на што з да як для але так ці яго яшчэ каб быў пад ужо толькі ўсё нас яна яны вы мы я гэта",
    "bg": "и в не на че с по това как от за до но така или го още да беше при вече само всичко ни тя те вие ние аз са",
    "sr": "и у не на што са по то како из за до али тако или га још да је био при већ само све нас она они ви ми ја су",
    "kk": "және бұл бір мен үшін да де жоқ бар осы сол деп емес болып керек еді",
    "en": "the a an of to and is in that it for on with as was but this are be at by not or have from they you we if so there which would",
    "de": "der die das und ist nicht ein eine zu mit von den dem des für auf sich wir ich sie es im an aber oder wenn dann nur noch",
    "fr": "le la les de des et est un une à pour que qui dans sur ne pas nous vous je il elle avec au aux du en mais ou si plus",
    "es": "el la los las de y es un una que en por para con no se lo al del su más pero o si yo como está muy",
    "it": "il lo la gli le di e è un una che in per con non si al del sono ma o se come più questo anche",
    "pt": "o a os as de e é um uma que em por para com não se ao do da mais mas ou como está você isso também",
    "nl": "de het een en van is in dat op te zijn met voor niet aan er om ook als maar dan bij nog naar wordt",
    "pl": "i w nie na się że z do to jest jak ale po co tak za od czy tylko przez jeśli są już może aby",
    "cs": "a v na se že je to s do ale jako po co tak za od jen pokud jsou už může aby není který",
    "ro": "și în nu la că cu de pe este un o care să din mai dar sau dacă sunt pentru prin acest după",
    "tr": "ve bir bu da de için ile ne mi çok daha ama gibi kadar var yok değil olan olarak sonra",
    "sv": "och i att det som en på är av för med den till inte har de om ett men var jag vi när",
    "fi": "ja on ei se että en oli hän mutta kun niin myös ovat tai jos vain kuin ole mitä tämä",
    "id": "dan yang di ini itu dengan untuk tidak dari dalam akan pada juga ke karena ada bisa atau saya kami",
}
LANGUAGES = tuple(FUNCTION_WORDS)
SCRIPTS = ("", "latin", "cyrillic", "greek", "arabic", "hebrew", "han", "kana", "hangul", "indic", "thai", "georgian", "armenian")
SCRIPT_OF = {k: "cyrillic" if k in ("ru", "uk", "be", "bg", "sr", "kk") else "latin" for k in LANGUAGES}
# Ranges of code points of scripts.
_RANGES = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF)], "cyrillic": [(0x400, 0x52F)], "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "arabic": [(0x620, 0x6FF), (0x750, 0x77F)], "hebrew": [(0x5D0, 0x5EA)], "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)], "kana": [(0x3040, 0x30FF)],
    "hangul": [(0xAC00, 0xD7A3)], "indic": [(0x900, 0xDFF)], "thai": [(0xE00, 0xE7F)], "georgian": [(0x10A0, 0x10FF)], "armenian": [(0x530, 0x58F)],
}
_SEEDS: dict[str, tuple[int, ...]] = {}
for _n, _k in enumerate(LANGUAGES):
    for _w in FUNCTION_WORDS[_k].split():
        _SEEDS[_w] = (*_SEEDS.get(_w, ()), _n)
_SEED_WORDS = frozenset(_SEEDS)
_OWN = {k: frozenset(FUNCTION_WORDS[k].split()) for k in LANGUAGES}


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Small letter and script of each code point of the first plane; 0 for what is no letter."""
    letter, script = np.zeros(0x10000, np.uint32), np.zeros(0x10000, np.uint8)
    for name, ranges in _RANGES.items():
        for a, b in ranges:
            for cp in range(a, b + 1):
                if chr(cp).isalpha():
                    letter[cp], script[cp] = ord(chr(cp).lower()[0]), SCRIPTS.index(name)
    return letter, script


def seeded(words: set[str]) -> int:
    """The language whose function words clearly prevail among the words, or -1."""
    held = words & _SEED_WORDS
    if len(held) < SURE:
        return -1
    votes = [0] * len(LANGUAGES)
    for w in held:
        for n in _SEEDS[w]:
            votes[n] += 1
    second, most = sorted(votes)[-2:]
    return votes.index(most) if most >= SURE and most - second >= AHEAD else -1


def has_function_word(words: set[str], language: int) -> bool:
    return not _OWN[LANGUAGES[language]].isdisjoint(words)


class Letters:
    """Trigrams of several texts: bucket, text and script of each letter."""

    def __init__(self, texts: Sequence[str]):
        letter, script = _tables()
        raw = code_points("\0".join(texts))
        raw = np.where(raw < 0x10000, raw, 0)
        low = letter[raw]
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        at = np.flatnonzero(low)
        with np.errstate(over="ignore"):
            padded = np.concatenate((np.zeros(1, np.uint32), low, np.zeros(1, np.uint32))).astype(np.uint32)
            key = padded[at] * np.uint32(0x9E3779B1) ^ padded[at + 1] * np.uint32(0x85EBCA6B) ^ padded[at + 2] * np.uint32(0xC2B2AE35)
            self.bucket = ((key ^ (key >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)
        self.text = np.searchsorted(ends, at, side="right")
        self.many = len(texts)
        self.script = script[raw[at]].astype(np.int64)

    def scripts(self) -> np.ndarray:
        """Letters of each script in each text."""
        return np.bincount(self.text * len(SCRIPTS) + self.script, minlength=self.many * len(SCRIPTS)).reshape(self.many, len(SCRIPTS))

    def counts(self, language: np.ndarray) -> np.ndarray:
        """Trigrams of each language, from the texts that have one (-1 for none)."""
        own = language[self.text]
        some = own >= 0
        return np.bincount(own[some] * BUCKETS + self.bucket[some], minlength=len(LANGUAGES) * BUCKETS)

    def scores(self, model: np.ndarray) -> np.ndarray:
        """Log-likelihood of each text in each language."""
        out = np.zeros((self.many, len(LANGUAGES)), np.float32)
        starts = np.flatnonzero(np.concatenate(([True], self.text[1:] != self.text[:-1]))) if len(self.text) else np.zeros(0, np.int64)
        for a in range(0, len(starts), 512):
            part = starts[a : a + 512]
            end = starts[a + 512] if a + 512 < len(starts) else len(self.text)
            out[self.text[part]] = np.add.reduceat(model[self.bucket[part[0] : end]], part - part[0], axis=0)
        return out


def train(counts: np.ndarray | None = None) -> np.ndarray:
    """A row for each bucket and a column for each language: logarithms of the trigrams' probabilities.

    ``counts`` are the trigrams of the corpus (languages x buckets); the function words count in any case.
    """
    total = Letters([FUNCTION_WORDS[k].replace(" ", "  ") for k in LANGUAGES]).counts(np.arange(len(LANGUAGES))).astype(np.float64)
    if counts is not None:
        total += counts
    total = total.reshape(len(LANGUAGES), BUCKETS)
    share = total / (total.sum(1, keepdims=True) + PRIOR)
    return np.ascontiguousarray(np.log((1 - SPREAD) * share + SPREAD / BUCKETS).T.astype(np.float32))


OF_SCRIPT = {s: np.array([n for n, k in enumerate(LANGUAGES) if SCRIPT_OF[k] == s], np.int64) for s in ("latin", "cyrillic")}

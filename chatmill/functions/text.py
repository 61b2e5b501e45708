"""Column expressions on texts, with the same notion of words and white space everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space, also the Unicode kinds that are not in a plain \s.
SPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
#: Letters, digits and underscore of any script.
WORD = r"[\p{L}\p{N}_]"

# Russian words that carry no content.
STOPWORDS = frozenset(
    """и в на с по к у о от за для без из до при через об же бы ещё еще уже если что чтобы потому так как ну вот это этот эта эти а но или либо да нет не ни
    кто где куда когда почему зачем чей чья чьё чьи тот та то те весь вся всё все мой твой свой наш ваш их его её ее им ему ей нам вам ими мной тобой собой нами
    вами сам сама само сами тут там здесь откуда тоже также только лишь хоть хотя будто словно точно разве неужели даже просто очень совсем вообще тогда сейчас
    потом после всегда никогда иногда часто редко можно нужно надо нельзя будет было быть есть были будут""".split()
)


def words(text: Column) -> Column:
    """Runs of characters between white space; none for a blank or null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def onward(array: Column | str, first: int) -> Column:
    """The array from its ``first`` element (1-based) on."""
    a = F.col(array) if isinstance(array, str) else array
    return F.slice(a, F.lit(first), F.size(a))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def token_count(text: Column) -> Column:
    """About as many tokens as a subword tokenizer makes: 1.35 a word, rounded down."""
    return (F.size(words(text)) * F.lit(1.35)).cast("long")


def token_estimate(text: Column) -> Column:
    """``token_count``, but never under 1."""
    return F.greatest(token_count(text), F.lit(1))


def count_tokens(text: Column, ranks: str | None = None, pattern: str | None = None) -> Column:
    """Tokens of a byte-pair vocabulary, or about as many by words; 0 for a null or empty text, else 1 at least.

    ``ranks`` is a rank file that every task can read, ``pattern`` the expression that parts texts first.
    """
    some = F.length(F.coalesce(text, F.lit(""))) > 0
    if ranks is None:
        return F.when(some, token_estimate(text)).otherwise(0).cast("long")

    def count(texts):
        import base64

        import tiktoken

        parts = pattern
        if parts is None:
            import public_tokenizers

            parts = public_tokenizers.PATTERN
        with open(ranks, "rb") as f:
            known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoder = tiktoken.Encoding("counted", pat_str=parts, mergeable_ranks=known, special_tokens={})
        return texts.map(lambda t: max(1, len(encoder.encode_ordinary(t))) if t else 0)

    return F.pandas_udf(count, "long")(text)


def is_question(text: Column) -> Column:
    return F.coalesce(F.contains(text, F.lit("?")), F.lit(False))


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def normalized(text: Column) -> Column:
    """Lower case without punctuation, single spaces, trimmed; the key of exact duplicates."""
    bare = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}_\t-\r\x1c-\x20\x{85}\p{Z}]", "")
    return stripped(F.regexp_replace(bare, SPACE + "+", " "))


def lower_words(text: Column) -> Column:
    """All runs of word characters, in lower case."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORD}+)"), 1)


def content_words(text: Column) -> Column:
    """Words of at least two characters that are neither numbers nor stopwords."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([а-яёa-z0-9]+(?:[-'][а-яёa-z0-9]+)?)"), 1)
    return F.filter(found, lambda w: (F.length(w) >= 2) & ~w.rlike("^[0-9]+$") & ~w.isin(*sorted(STOPWORDS)))


def contains_ignoring_case(text: Column, part: str) -> Column:
    return F.coalesce(F.contains(F.lower(text), F.lit(part.lower())), F.lit(False))


def short_number(value: Column) -> Column:
    """1234567 as 1.2M, 12345 as 12.3k."""
    return F.when(value >= 1_000_000, F.format_string("%.1fM", value / 1e6)).when(value >= 1000, F.format_string("%.1fk", value / 1e3)).otherwise(value.cast("string"))


def parameter_tier(size: Column) -> Column:
    """Tier of a model by its size as written, such as 135M or 1.5B."""
    number = F.regexp_extract(F.upper(size), r"([0-9.]+)\s*[MB]", 1)
    billions = F.expr("1.0D") * number.try_cast("double") * F.when(F.upper(size).rlike(r"[0-9.]+\s*M"), 0.001).otherwise(1.0)
    return F.when(billions.isNull(), None).when(billions < 0.5, "tiny").when(billions < 1.2, "small").when(billions < 2.3, "mid").otherwise("large")

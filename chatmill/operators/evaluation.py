"""Scores of generated texts, and preparation of training sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmill.functions.text import word_count

# Words of technical Russian.
TECHNICAL_STEMS = "кластер деплой инференс реплика транзакция блокировк нагрузк контейнер пайплайн конфигураци сертификат прод воркер метрик".split()
_MARK = r"(?:ответ|answer|вариант|option|choice)"
_LETTER = r"[A-Da-dАВСЕавсе]"


def choice_letter(text: Column, valid: str = "ABCD") -> Column:
    """The letter a response chooses, or null.

    A letter right after a marker and a separator, or an upper case letter after a marker and spaces; else a letter in
    brackets; else an upper case Latin letter that stands alone. Cyrillic look-alikes count in the first three.
    """
    t = F.trim(F.coalesce(text, F.lit("")))
    found = []
    for p in (rf"(?iuU)\b{_MARK}\s*(?:[:=–—-]\s*[(\[{{]?|[(\[{{])\s*((?-i:{_LETTER}))(?!\w)", r"(?U)\b(?i:ответ|answer|вариант|option|choice)\s+([A-DАВСЕ])(?!\w)", rf"(?U)[(\[{{]\s*({_LETTER})\s*[)\]}}]", r"(?U)(?<!\w)([A-Z])(?!\w)"):
        letter = F.translate(F.upper(F.regexp_extract(t, p, 1)), "АВСЕ", "ABCE")
        found.append(F.when(letter.isin(*valid), letter))
    return F.coalesce(*found)


def response_score(rows: DataFrame, text: str, terms: Sequence[str], needs_code: bool = False) -> DataFrame:
    """``rows`` with concept, code, tone, length and overall scores (0 to 100, not rounded).

    Code scores 100 if a block is valid Python, 70 if there are blocks, 40 for an unfinished one, else 50, or 10 where
    code is needed.
    """
    low = F.lower(F.coalesce(text, F.lit("")))
    hits = sum((F.contains(low, F.lit(k.lower())).cast("int") for k in terms), F.lit(0))
    concept = hits * 100.0 / max(1, len(terms))

    def parses(texts):
        import ast
        import re

        def one(t: str | None) -> bool:
            for block in re.findall(r"```(?:python|py)?\n(.*?)```", t or "", re.DOTALL):
                try:
                    ast.parse(block.strip())
                    return True
                except (SyntaxError, ValueError, RecursionError, MemoryError):
                    continue
            return False

        return texts.map(one)

    blocks = F.coalesce(F.col(text).rlike(r"(?s)```(?:python|py)?\n.*?```"), F.lit(False))
    code = F.when(F.pandas_udf(parses, "boolean")(F.col(text)), 100.0).when(blocks, 70.0).when(F.contains(low, F.lit("```")), 40.0).otherwise(10.0 if needs_code else 50.0)
    tone = F.least(F.lit(100.0), sum((F.contains(low, F.lit(k)).cast("int") for k in TECHNICAL_STEMS), F.lit(0)) * 10.0)
    length = F.least(F.lit(100.0), word_count(F.col(text)) * 1.0)
    frame = rows.withColumns({"concept": concept, "code": code, "tone": tone, "length_score": length})
    return frame.withColumn("overall", F.col("concept") * 0.40 + F.col("code") * 0.25 + F.col("tone") * 0.20 + F.col("length_score") * 0.15)


def compiles(text: Column, language: Column) -> Column:
    """Percentage of a response's code blocks (or the whole text) that look right for the language; 100 without one."""

    def score(texts, languages):
        import ast
        import re

        import pandas as pd

        words = ("select", "create", "insert", "update", "table", "where", "from", "join", "index")

        def good(code: str, lang: str) -> bool:
            if lang in ("python", "py"):
                try:
                    ast.parse(code)
                    return True
                except (SyntaxError, ValueError, RecursionError, MemoryError):
                    return False
            if lang == "sql":
                return any(w in code.lower() for w in words) and not code.endswith("...")
            if lang in ("yaml", "yml"):
                return ":" in code and not code.startswith("{")
            return len(code) > 20

        out = []
        for t, lang in zip(texts, languages, strict=True):
            if not lang:
                out.append(100.0)
                continue
            found = re.findall(r"```(?:[a-zA-Z0-9_-]+)?\n(.*?)```", t or "", re.DOTALL) or [t or ""]
            out.append(100.0 * sum(bool(b.strip()) and good(b.strip(), lang) for b in found) / len(found))
        return pd.Series(out)

    return F.pandas_udf(score, "double")(text, language)


def scenario_score(concept: Column, compiled: Column) -> Column:
    return concept * 0.7 + compiled * 0.3


def training_split(rows: DataFrame, order: Sequence[str], key: Column, holdout: int, most: int | None, eval_fraction: float, seed: int = 42, most_eval: int = 256) -> DataFrame:
    """``rows`` with ``part``: holdout (the last ones), train, eval, or unused beyond ``most``.

    Evaluation rows are those with the least hash of ``key`` and the seed among the remaining, at most ``most_eval``.
    """
    from chatmill.plans.ranks import with_position

    total = rows.count()
    placed = with_position(rows, [F.col(c) for c in order], "_at")
    pool = max(0, total - holdout) if total > holdout else total
    used = min(pool, most) if most else pool
    evals = min(used - int(used * (1.0 - eval_fraction)), most_eval)
    drawn = placed.where(F.col("_at") < used).select("_at", F.xxhash64(F.lit(seed), key).alias("_h")).orderBy("_h", "_at").limit(evals).select("_at", F.lit(True).alias("_e"))
    # at most ``most_eval`` rows
    both = placed.join(F.broadcast(drawn), "_at", "left")
    part = F.when(F.col("_at") >= pool, "holdout").when(F.col("_at") >= used, "unused").when(F.col("_e"), "eval").otherwise("train")
    return both.withColumn("part", part).drop("_at", "_e")


def masked_labels(tokens: Column, prompt_length: Column) -> Column:
    """Token ids with those of the prompt replaced by -100."""
    return F.transform(tokens, lambda t, i: F.when(i < prompt_length, F.lit(-100)).otherwise(t))


def paired(a: DataFrame, b: DataFrame, key: str, correct: str) -> DataFrame:
    """Results of two variants on their common tasks."""
    return a.select(key, F.col(correct).alias("a")).join(b.select(key, F.col(correct).alias("b")), key)



"""Stable pseudonyms of authors, and masking of their names in texts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmill.functions.names import case_forms
from chatmill.functions.text import WORD, onward, stripped
from chatmill.plans.ranks import with_position
from chatmill.plans.scratch import Scratch

# Ids that identify nobody.
NOBODY = ("", "none", "unknown", "anonymous", "null")
# Words of the trade that are no names, and first names that are names in small letters too.
TRADE = """питон пайтон голанг раст джава жаба котлин плюсы шарп пыха руби свифт скала джанго фласк реакт вье ангуляр тайлвинд шадсн пайторч торч тензорфлоу
хаггингфейс дипсик опенаи антропик чатгпт клод лама мистраль квен гемини джемини грок миджорни курсор копилот постгрес постгре мускул кликхаус редис
монго эластик кдрант докер кубер кубернетес ансибл терраформ нжинкс нгинкс апач кафка кролик линукс убунту дебиан виндовс винда макос мак хетзнер
хецнер амазон гугл ажур яндекс селектел таймвеб телеграм телега гитхаб гит гитлаб джира конфлюенс ноушен слак дискорд зум хабр пикабу реддит эппл
майкрософт мета нвидиа""".split()
FIRST_NAMES = """александр алексей анатолий андрей антон артем артём артур богдан борис вадим валентин валерий василий виктор виталий владимир владислав вячеслав
георгий глеб григорий даниил данил данила денис дмитрий евгений егор иван игорь илья кирилл константин лев леонид максим марк матвей михаил никита
николай олег павел петр пётр роман ростислав руслан сергей станислав степан тимофей тимур федор фёдор филипп эдуард юрий ярослав алена алёна алина
алиса алла анастасия анна антонина валентина валерия василиса вера вероника виктория галина дарья диана евгения екатерина елена елизавета жана жанна
зинаида зоя инна ирина карина кира клавдия кристина ксения лариса лидия лилия любовь людмила маргарита марина мария марья надежда наталья наталия нина
оксана олеся ольга полина райса раиса светлана снежана софия софья таисия тамара татьяна ульяна юлия яна""".split()
# Header of a forwarded message and the name in it.
FORWARD = r"(?iuU)(?:переслано от|forwarded from)\s+([A-Za-zА-Яа-яЁё0-9_\-\s]{2,30})"


def author_key(author_id: Column, name: Column) -> Column:
    """The id, or the name where the id identifies nobody."""
    bad = author_id.isNull() | F.lower(F.trim(author_id)).isin(*NOBODY)
    return F.when(bad, F.coalesce(name, F.lit(""))).otherwise(author_id)


def pseudonyms(rows: DataFrame, author_id: str, name: str, order: Sequence[str]) -> DataFrame:
    """``author_key``, ``user_pseudonym`` and ``name_pseudonym``, numbered from 1 by first appearance, ties by key.

    Authors are reduced by key with partial aggregation; only distinct authors are put in order.
    """
    first = rows.select(author_key(F.col(author_id), F.col(name)).alias("author_key"), F.struct(*order).alias("_at")).groupBy("author_key").agg(F.min("_at").alias("_first"))
    numbered = with_position(first, [F.col("_first"), F.col("author_key")], "_n", first=1)
    return numbered.select("author_key", F.format_string("user_%05d", "_n").alias("user_pseudonym"), F.format_string("Developer_%05d", "_n").alias("name_pseudonym"))


def anonymize_authors(rows: DataFrame, author_id: str, name: str, order: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """``rows`` with author_id_anon and author_anon in place of the author columns; ``known`` are their pseudonyms."""
    known = pseudonyms(rows, author_id, name, order) if known is None else known
    keyed = rows.withColumn("author_key", author_key(F.col(author_id), F.col(name)))
    return keyed.join(known, "author_key", "left").withColumnsRenamed({"user_pseudonym": "author_id_anon", "name_pseudonym": "author_anon"}).drop("author_key", author_id, name)


def forward_headers(rows: DataFrame, column: str, known: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with the names in forward headers replaced by pseudonyms.

    A name that is the key of an author has the author's pseudonym; others are numbered after the authors by first
    appearance. A blank name becomes [PERSON_REDACTED]. Only texts with a header are joined, each different text once.
    """
    has = F.coalesce(F.col(column).rlike(FORWARD), F.lit(False))
    held = rows.where(has).withColumn("_text", F.md5(column))
    found = held.select(F.struct(*order).alias("_at"), "_text", F.posexplode(F.regexp_extract_all(column, F.lit(FORWARD), 1)).alias("_pos", "_name")).withColumn("author_key", stripped(F.col("_name")))
    new = found.where("author_key <> ''").groupBy("author_key").agg(F.min(F.struct("_at", "_pos")).alias("_first")).join(known.select("author_key"), "author_key", "left_anti")
    numbered = with_position(new, [F.col("_first"), F.col("author_key")], "_n", first=known.count() + 1)
    names = known.select("author_key", "name_pseudonym").union(numbered.select("author_key", F.format_string("Developer_%05d", "_n")))
    shown = found.select("_text", "_pos", "author_key").distinct().join(names, "author_key", "left")
    marks = shown.groupBy("_text").agg(F.array_sort(F.collect_list(F.struct("_pos", F.coalesce("name_pseudonym", F.lit("[PERSON_REDACTED]")).alias("by")))).alias("_marks"))
    pieces = F.split(column, FORWARD, -1)
    headed = F.zip_with(F.col("_marks.by"), onward(pieces, 2), lambda by, rest: F.concat(F.lit("Forwarded from "), by, rest))
    done = held.join(marks, "_text").withColumn(column, F.concat(F.element_at(pieces, 1), F.array_join(headed, "")))
    return done.select(*rows.columns).unionByName(rows.where(~has))


def author_names(rows: DataFrame, name: str, whitelist: Sequence[str] = ()) -> DataFrame:
    """``word`` of author names worth masking: capitalised Cyrillic words of three letters and more, not whitelisted."""
    word = F.explode(F.regexp_extract_all(F.col(name), F.lit(r"([А-ЯЁ][а-яё]{2,})"), 1)).alias("word")
    found = rows.select(word).distinct()
    return found.where(~F.lower("word").isin(*[w.lower() for w in whitelist])) if whitelist else found


def all_names(rows: DataFrame, name: str, inflected: bool = True) -> DataFrame:
    """``word`` of author names to be masked in published texts: those of ``author_names`` and known first names in any case.

    ``inflected`` adds their forms in the cases, by the endings of declensions.
    """
    word = F.explode(F.regexp_extract_all(F.lower(F.col(name)), F.lit(r"([\p{L}\p{N}_]+)"), 1)).alias("word")
    known = rows.select(word).where(F.col("word").isin(*FIRST_NAMES))
    found = author_names(rows, name, TRADE).select(F.lower("word").alias("word")).union(known).distinct()
    if not inflected:
        return found
    forms = F.pandas_udf(lambda words: words.map(case_forms), "array<string>")
    return found.select(F.explode(forms("word")).alias("word")).where(~F.col("word").isin(*TRADE)).distinct()


def mask_words(rows: DataFrame, column: str, names: DataFrame, out: str = "text_masked", most_bytes: int = 32 << 20, any_case: bool = False) -> DataFrame:
    """``rows`` with the given words, standing alone, replaced by [PERSON_REDACTED]; longest first.

    Words match in their own case, with ``any_case`` in every case.
    The words go to every task while they fit ``most_bytes``; beyond that the words of the texts are joined with them.
    """
    if any_case:
        names = names.select(F.lower("word").alias("word")).distinct()
    size = names.agg(F.sum(F.octet_length("word") + 16)).first()[0] or 0
    if size <= most_bytes:
        sent = rows.sparkSession.sparkContext.broadcast(frozenset(r.word for r in names.collect()))

        def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            import re

            token = re.compile(r"\w+")  # letters, digits and underscore, as below
            for texts in batches:
                known = sent.value
                yield texts.map(lambda t: None if t is None else token.sub(lambda m: "[PERSON_REDACTED]" if (m[0].lower() if any_case else m[0]) in known else m[0], t))

        return rows.withColumn(out, F.pandas_udf(mask, "string")(F.col(column)))
    # ids are made once, as both sides of the join read what is written
    keyed = Scratch(rows.sparkSession, "masked").save("keyed", rows.withColumn("_id", F.monotonically_increasing_id()))
    pieces = keyed.select("_id", F.posexplode(F.split(column, rf"(?<={WORD})(?=[^\p{{L}}\p{{N}}_])|(?<=[^\p{{L}}\p{{N}}_])(?={WORD})")).alias("_pos", "word"))
    masked = pieces.withColumn("_key", F.lower("word") if any_case else F.col("word")).join(names.select(F.col("word").alias("_key"), F.lit(True).alias("_hit")), "_key", "left").groupBy("_id").agg(F.array_sort(F.collect_list(F.struct("_pos", F.when(F.col("_hit"), "[PERSON_REDACTED]").otherwise(F.col("word")).alias("w")))).alias("_all"))
    return keyed.join(masked, "_id", "left").withColumn(out, F.when(F.col(column).isNotNull(), F.array_join(F.col("_all.w"), ""))).drop("_id", "_all")

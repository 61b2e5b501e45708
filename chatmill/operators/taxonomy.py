"""Subject domain, tags and sentiment of texts from keyword lists."""

from __future__ import annotations

import re
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmill.functions.text import lower_words

# Keywords of each domain.
AI = "ai ml nlp llm deepseek chatgpt gpt-4 gpt claude openai anthropic llama llama3 mistral qwen gemini pytorch tensorflow transformer huggingface lora qlora finetune fine-tuning sft dpo rlhf rag embedding embeddings vector qdrant chroma pinecone weaviate bert rubert tokens token tokenizer cuda gpu vram diffusion comfyui midjourney whisper ollama vllm".split()
BACKEND = "python fastapi django flask pydantic asyncio aiohttp golang go rust java kotlin spring c++ c# .net node nodejs express nest nestjs php laravel sql postgresql postgres mysql sqlite mongodb redis clickhouse elasticsearch kafka rabbitmq celery graphql rest grpc orm sqlalchemy alembic database бд база".split()
FRONTEND = [*"javascript typescript js ts react reactjs nextjs next vue vuejs nuxt angular svelte html css scss sass tailwind shadcn bootstrap webpack vite frontend фронт flutter ios swift android".split(), "react native", "kotlin multiplatform"]
DEVOPS = [*"docker docker-compose k8s kubernetes helm linux ubuntu debian centos alpine nginx caddy traefik ci/cd ci cd gitlab jenkins ansible terraform aws gcp azure hetzner ovh selectel timeweb vps vds server сервер хостинг деплой мониторинг prometheus grafana sentry loki".split(), "github actions", "yandex cloud"]
BUSINESS = "бизнес стартап startup саас saas b2b b2c ооо ип налог налоги бухгалтерия бух договор оферта юрист stripe paypal крипта crypto usdt btc eth ton платежи эквайринг банк счет инвойс релокация грузия армения кипр оаэ дубай казахстан венчур инвестор монетизация продажи маркетинг лиды выручка mrr arr".split()
SECURITY = "vpn wireguard vless shadowsocks xray proxy прокси security безопасность ssl tls certbot ddos firewall iptables ssh auth jwt oauth penetration хэк уязвимость".split()
CAREER = "зарплата зп вакансия найм собес собеседование резюме джун мидл сеньор тимлид lead pm cto оффер удаленка офис рейт апворк upwork фриланс аутсорс".split()
GENERAL = "cursor vscode ide macbook m1 m2 m3 thinkpad ноут железо клавиатура монитор телеграм tg бот bot".split()
TAXONOMY: dict[str, list[str]] = {"ai_ml_nlp": AI, "backend_databases": BACKEND, "frontend_ui": FRONTEND, "devops_infra": DEVOPS, "business_legal_fintech": BUSINESS, "sysadmin_security": SECURITY, "career_team_management": CAREER, "general_tech_chat": GENERAL}
DEFAULT_DOMAIN = "general_tech_chat"

# Weights of words that show a mood.
SENTIMENT = {
    "хорошо": 1, "отлично": 2, "прекрасно": 2, "супер": 2, "круто": 1, "класс": 1, "спасибо": 1, "благодарю": 1, "лайк": 1, "годно": 1, "топ": 1, "лучший": 1,
    "кайф": 1, "плюс": 1, "согласен": 1, "помогло": 2, "решено": 2, "заработало": 2, "стабильно": 1, "быстро": 1, "удобно": 1, "рекомендую": 2, "огонь": 2, "полезно": 1,
    "плохо": -1, "ужасно": -2, "отстой": -1, "фигня": -1, "сложно": -1, "трудно": -1, "беда": -1, "проблема": -1, "баг": -1, "ошибка": -1, "сбой": -1, "упало": -2,
    "краш": -2, "сломалось": -2, "тормозит": -1, "лагает": -1, "дрянь": -2, "хлам": -2, "неудобно": -1, "минус": -1, "говно": -2, "бред": -1, "дичь": -1,
    "ок": 0, "нормально": 0, "средне": 0, "нейтрально": 0,
}
TOKEN = r"([a-zA-Zа-яё0-9_\-+#.]+)"


def domain_scores(text: Column, taxonomy: Mapping[str, list[str]] = TAXONOMY) -> Column:
    """Array of (domain, score) with a positive score, best first; ties by name.

    A keyword counts once if it is a token. A keyword of several words counts if each of them stands between spaces
    anywhere in the text. All keywords are looked up at once, in Arrow batches.
    """
    domains = sorted(taxonomy)
    single: dict[str, list[int]] = {}
    several = []
    for n, d in enumerate(domains):
        for k in dict.fromkeys(taxonomy[d]):
            if " " in k:
                several.append((n, [f" {w} " for w in k.split()]))
            else:
                single.setdefault(k, []).append(n)
    known = frozenset(single)

    def count(texts: pd.Series) -> pd.Series:
        token = re.compile(TOKEN)

        def one(text: str | None) -> list[int]:
            low = (text or "").lower()
            out = [0] * len(domains)
            for k in known.intersection(token.findall(low)):
                for n in single[k]:
                    out[n] += 1
            padded = f" {low} "
            for n, parts in several:
                if all(p in padded for p in parts):
                    out[n] += 1
            return out

        return texts.map(one)

    scores = F.pandas_udf(count, "array<int>")(text)
    named = F.zip_with(scores, F.array(*[F.lit(d) for d in domains]), lambda s, d: F.struct((-s).alias("minus"), d.alias("domain")))
    return F.transform(F.filter(F.array_sort(named), lambda x: x["minus"] < 0), lambda x: F.struct(x["domain"].alias("domain"), (-x["minus"]).alias("score")))


def _automaton(words: list[str]):
    try:
        import ahocorasick
    except ImportError:
        return None
    automaton = ahocorasick.Automaton()
    for w in words:
        automaton.add_word(w, w)
    automaton.make_automaton()
    return automaton


def keywords_contained(text: Column, taxonomy: Mapping[str, list[str]] = TAXONOMY) -> Column:
    """How many different keywords the text contains, also within words."""
    words = sorted({k for ks in taxonomy.values() for k in ks})

    def count(texts: pd.Series) -> pd.Series:
        automaton = _automaton(words)
        if automaton is None:
            return texts.map(lambda t: sum(w in (t or "").lower() for w in words))
        return texts.map(lambda t: len({w for _, w in automaton.iter((t or "").lower())}))

    return F.pandas_udf(count, "int")(text)


def classified(rows: DataFrame, text: str, taxonomy: Mapping[str, list[str]] = TAXONOMY) -> DataFrame:
    """``rows`` with ``domain_found``, ``domain_score`` and ``domain_confidence`` (share of the best in all hits)."""
    frame = rows.withColumn("_scores", domain_scores(F.col(text), taxonomy))
    best = F.get("_scores", F.lit(0))
    total = F.aggregate("_scores", F.lit(0), lambda s, x: s + x["score"])
    return frame.withColumns({"domain_found": F.coalesce(best["domain"], F.lit(DEFAULT_DOMAIN)), "domain_score": F.coalesce(best["score"], F.lit(0)).cast("long"), "domain_confidence": F.coalesce(best["score"] / F.nullif(total, F.lit(0)), F.lit(0.0))}).drop("_scores")


def tags(text: Column, taxonomy: Mapping[str, list[str]] = TAXONOMY) -> Column:
    """Sorted keywords that occur with neither letter, digit, underscore nor hyphen next to them; overlaps count.

    All keywords are searched for at once by an automaton, in Arrow batches; a chain of expressions would lower the
    text again for every keyword.
    """
    words = sorted({k for ks in taxonomy.values() for k in ks})

    def find(texts: pd.Series) -> pd.Series:
        automaton = _automaton(words)
        joins = lambda c: c.isalnum() or c in "_-"

        def one(text: str | None) -> list[str]:
            low = (text or "").lower()
            if automaton is not None:
                hits = ((e - len(w) + 1, w) for e, w in automaton.iter(low))
            else:
                hits = ((k, w) for w in words if w in low for k in range(len(low) - len(w) + 1) if low.startswith(w, k))
            return sorted({w for k, w in hits if not (k and joins(low[k - 1])) and not (k + len(w) < len(low) and joins(low[k + len(w)]))})

        return texts.map(one)

    return F.pandas_udf(find, "array<string>")(text)


def sentiment(text: Column, lexicon: Mapping[str, int] = SENTIMENT) -> Column:
    """Sum of the weights of all words, repeats included."""
    weights = F.create_map(*[x for k, v in lexicon.items() if v for x in (F.lit(k), F.lit(v))])
    return F.aggregate(lower_words(text), F.lit(0), lambda s, w: s + F.coalesce(F.try_element_at(weights, w), F.lit(0))).cast("long")


def tagged(rows: DataFrame, text: str, taxonomy: Mapping[str, list[str]] = TAXONOMY) -> DataFrame:
    """``rows`` with domain, tags and sentiment."""
    return classified(rows, text, taxonomy).withColumns({"tags_found": tags(F.col(text), taxonomy), "sentiment_found": sentiment(F.col(text))})

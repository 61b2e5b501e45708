"""Statistical leak audit: detectors, stratified sample, confidence bounds, paired tests."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PHONE = r"(?<![\w=])(?!\d+\.\d+\.\d+(?![\d.]))(?:(?:\+?[78]|\+?380|\+?995|\+?374|\+?998|\+?375|\+?1)[\s\-\(]*\d\s*\d\s*\d[\s\-\)]*\d\s*\d\s*\d[\s\-]*\d\s*\d[\s\-]*\d\s*\d\b|(?:\+\d{1,3}[\s\-]?)?\(?\d{3,4}\)?[\s\-]?\d{3}[\s\-]?\d{2}[\s\-]?\d{2}\b)"
_BYTE = r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)"
# What counts as a leak.
DETECTORS = {
    "phones": rf"(?U){_PHONE}",
    "emails": r"(?U)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,7}\b",
    "crypto_wallets": r"(?U)\b(?:1[a-km-zA-HJ-NP-Z1-9]{25,34}|3[a-km-zA-HJ-NP-Z1-9]{25,34}|bc1[a-z0-9]{39,59})\b|\b0x[a-fA-F0-9]{40}\b|\bT[A-Za-z1-9]{33}\b|\b(?:EQ|UQ)[a-zA-Z0-9_-]{46}\b",
    "api_keys": r"(?U)\bsk-(?:proj-)?[a-zA-Z0-9_\-]{20,}\b|\b(?:ghp|gho|ghu|ghs|ghr)_[a-zA-Z0-9]{20,50}\b|\bgithub_pat_[a-zA-Z0-9_]{30,}\b|\b(?:AKIA|ABIA|ACCA|ASIA)[0-9A-Z]{16}\b|\b\d{8,12}:[a-zA-Z0-9_\-]{25,45}\b",
    "jwt_tokens": r"(?U)\beyJ[a-zA-Z0-9_-]{10,}\.eyJ[a-zA-Z0-9_-]{10,}\.[a-zA-Z0-9_-]{10,}\b",
    "ssh_keys": r"-----BEGIN [A-Z ]+PRIVATE KEY-----[\s\S]+?-----END [A-Z ]+PRIVATE KEY-----",
    "public_ips": rf"(?U)\b(?!(?:127\.0\.0\.1|1\.1\.1\.1|8\.8\.8\.8|8\.8\.4\.4)\b)(?!0+\.)(?!(?:0*[0-9]\.){{3}}0*[0-9]\b)(?:{_BYTE}\.){{3}}{_BYTE}\b",
    "secret_assignments": r"""(?iU)\b(?:api[_-]?key|secret[_-]?key|access[_-]?token|refresh[_-]?token|auth[_-]?token|client[_-]?secret|password|passwd|pwd|token)\s*[:=]\s*["']?[A-Za-z0-9_\-\./\+]{8,}["']?""",
    "private_invites": r"(?i)t\.me/(?:\+|joinchat/)[A-Za-z0-9_\-]+",
    "db_urls": r"(?i)\b(?:postgres(?:ql)?|mysql|mariadb|mongodb(?:\+srv)?|redis|amqp|mssql|clickhouse)://[^\s:@/]+:[^\s:@/]+@[^\s/]+",
    "forward_headers": r"(?iuU)(?:^|\n)\s*(?:forwarded\s+from|переслано\s+от|forward\s+from)\s*[:\-]?\s*(?![^\n]*(?:_REDACTED\]|@user_(?:anon|\d)))(?=\S)[^\n]{2,80}",
    "user_mentions": r"(?U)(?<![\w@])@(?!user_\d+\b|user_anon\b)[A-Za-z][A-Za-z0-9_]{3,31}\b",
}


def leak_counts(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with the number of leaks of each category (prefix ``leak_``); null texts have none."""
    return rows.withColumns({f"leak_{k}": F.coalesce(F.regexp_count(F.col(text), F.lit(p)), F.lit(0)).cast("long") for k, p in DETECTORS.items()})


def stratified_sample(rows: DataFrame, stratum: str, key: Column, size: int, seed: int = 42) -> DataFrame:
    """All rows if there are at most ``size``, else ``size`` of them, by strata in proportion (largest remainders first).

    Within a stratum those with the least hash of ``key`` and the seed are drawn; ``key`` must be unique. A null stratum is one.
    """
    counts = rows.groupBy(stratum).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    share = counts.crossJoin(F.broadcast(total)).withColumn("raw", F.col("n") * size / F.col("total"))
    share = share.withColumn("base", F.floor("raw"))
    order = Window.orderBy(F.desc(F.col("raw") - F.col("base")), F.col(stratum))
    # strata are few; their remainders are ranked together
    ranked = share.withColumn("place", F.row_number().over(order)).withColumn("spare", size - F.sum("base").over(Window.partitionBy()))
    alloc = ranked.select(F.col(stratum).alias("_s"), F.when(F.col("total") <= size, F.col("n")).otherwise(F.col("base") + (F.col("place") <= F.col("spare")).cast("long")).alias("_alloc"))
    # what can't be drawn goes within 64 parts of a stratum first, so that no stratum is ordered whole in one task
    hashed = rows.withColumn("_h", F.xxhash64(F.lit(seed), key)).join(F.broadcast(alloc), F.col(stratum).eqNullSafe(F.col("_s")))
    part = Window.partitionBy(stratum, F.pmod(F.shiftright("_h", 7), F.lit(64))).orderBy("_h", key)
    some = hashed.withColumn("_at", F.row_number().over(part)).where("_at <= _alloc")
    drawn = some.withColumn("_at", F.row_number().over(Window.partitionBy(stratum).orderBy("_h", key)))
    return drawn.where("_at <= _alloc").drop("_h", "_at", "_s", "_alloc")


def z_value(confidence: float, one_sided: bool = False) -> float:
    return NormalDist().inv_cdf(confidence if one_sided else 0.5 + confidence / 2)


def wilson(hits: Column, n: Column, z: float) -> tuple[Column, Column]:
    """Lower and upper Wilson bound of a rate; 0 and 1 where there are no trials."""
    n = F.nullif(n, F.lit(0))
    p = hits / n
    middle = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    return F.coalesce(F.greatest(middle - half, F.lit(0.0)), F.lit(0.0)), F.coalesce(F.least(middle + half, F.lit(1.0)), F.lit(1.0))


def required_sample(tolerance: float, confidence: float = 0.99) -> int:
    """Clean messages needed so that the one-sided upper bound at no leaks is at most ``tolerance``."""
    z = z_value(confidence, one_sided=True)
    return max(1, -(-int(z * z * (1 - tolerance) * 1e9) // int(tolerance * 1e9)))


def run_audit(rows: DataFrame, text: str, stratum: str, key: Column, size: int = 100_000, confidence: float = 0.99, tolerance: float = 1e-4) -> DataFrame:
    """A row for each category and one for ``total``: messages, with leaks, leaks, rate, bounds, examples and verdict.

    The verdict is PASSED if the one-sided upper bound is at most ``tolerance``; an empty table FAILS. Missing columns
    raise. ``examples`` are at most five keys of messages with a leak, the least ones; no leaked text is shown.
    """
    missing = [c for c in (text, stratum) if c not in rows.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    found = _audited(rows, text, stratum, key, size)
    sums = [F.struct(F.lit(k).alias("category"), F.count("*").alias("messages"), F.count_if(F.col(c) > 0).alias("with_leaks"), F.coalesce(F.sum(c), F.lit(0)).alias("leaks"), _examples(F.col(c) > 0).alias("examples")).alias(c) for k, c in _leak_columns()]
    one = found.agg(*sums).select(F.explode(F.array(*[c for _, c in _leak_columns()])).alias("x")).select("x.*")
    low, high = wilson(F.col("with_leaks"), F.col("messages"), z_value(confidence))
    _, upper = wilson(F.col("with_leaks"), F.col("messages"), z_value(confidence, one_sided=True))
    rate = F.coalesce(F.col("with_leaks") / F.nullif(F.col("messages"), F.lit(0)), F.lit(0.0))
    out = one.select("category", "messages", "with_leaks", "leaks", rate.alias("rate"), low.alias("low"), high.alias("high"), upper.alias("upper"), "examples")
    return out.withColumn("verdict", F.when((F.col("messages") > 0) & (F.col("upper") <= tolerance), "PASSED").otherwise("FAILED"))


def audit_strata(rows: DataFrame, text: str, stratum: str, key: Column, size: int = 100_000) -> DataFrame:
    """The stratum, messages drawn from it and how many of them have a leak."""
    return _audited(rows, text, stratum, key, size).groupBy(stratum).agg(F.count("*").alias("messages"), F.count_if(F.col("leak_total") > 0).alias("with_leaks"))


def _leak_columns() -> list[tuple[str, str]]:
    return [(k, f"leak_{k}") for k in (*DETECTORS, "total")]


def _audited(rows: DataFrame, text: str, stratum: str, key: Column, size: int) -> DataFrame:
    found = leak_counts(stratified_sample(rows, stratum, key, size), text)
    names = [f"leak_{k}" for k in DETECTORS]
    return found.withColumn("_key", key.cast("string")).withColumn("leak_total", sum((F.col(c) for c in names[1:]), F.col(names[0])))


def _examples(leaks: Column) -> Column:
    # a sample bounds what is collected
    return F.slice(F.array_sort(F.collect_list(F.when(leaks, F.col("_key")))), 1, 5)


def mcnemar(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """One row: the contingency table of paired booleans and the exact two-sided p-value."""
    t = pairs.agg(F.count_if(F.col(a) & F.col(b)).alias("both"), F.count_if(F.col(a) & ~F.col(b)).alias("only_a"), F.count_if(~F.col(a) & F.col(b)).alias("only_b"), F.count_if(~F.col(a) & ~F.col(b)).alias("neither"))

    def tail(only_a, only_b):
        import math

        import pandas as pd

        out = []
        for x, y in zip(only_a, only_b, strict=True):
            n, k = int(x + y), int(min(x, y))
            # logarithms, so that large counts don't overflow
            terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) - n * math.log(2) for i in range(k + 1)]
            out.append(min(1.0, 2 * math.fsum(map(math.exp, terms))) if n else 1.0)
        return pd.Series(out)

    return t.withColumn("p_value", F.pandas_udf(tail, "double")("only_a", "only_b"))


def accuracy(rows: DataFrame, variant: str, correct: str, confidence: float = 0.95) -> DataFrame:
    """Accuracy of each variant with its Wilson interval."""
    sums = rows.groupBy(variant).agg(F.count("*").alias("n"), F.count_if(F.col(correct)).alias("hits"))
    low, high = wilson(F.col("hits"), F.col("n"), z_value(confidence))
    return sums.select(variant, "n", "hits", (F.col("hits") / F.col("n")).alias("accuracy"), low.alias("low"), high.alias("high"))
